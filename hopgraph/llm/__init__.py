"""Training-data operators: quality, dedup, decontamination, mixing, sharding.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
