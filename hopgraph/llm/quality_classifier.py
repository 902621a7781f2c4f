"""Operator 4: quality by hierarchical empirical Bayes over hosts and paths.

A logistic regression over rule features gives each document its own evidence
(the probability of ``labels.quality`` = 1).  Evidence is added up by host and
by path (host and language, the site's first path level here).  Each level's
beta prior is fitted by moments to the level above it: a host's rate shrinks
to the global rate, a path's to its host's, the more the fewer documents it
has.  A document's score adds the path's shrunk log-odds, relative to the
global ones, to its own log-odds, and ``kept`` is a score of ``KEEP`` or more.

The regression is fitted on at most ``FIT_ROWS`` labelled documents whose
crc32(doc_id) mod 3 is not 1; rates and priors cover all documents.

Cases: NULL and empty texts have zero features and are scored like any other;
a NULL host or language is a value of its own; repeated rows each count; an
id's largest label counts; without labels of both classes the evidence is the
one class there is (or 0 without any); an empty table gives an empty result;
the input row is carried as a struct.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopgraph.llm.common import table, written
from hopgraph.llm.fitting import Logistic
from hopgraph.llm.quality_rules import rule_features

FIT_ROWS = 20_000
KEEP = 0.5
EVIDENCE = ["log_words", "symbols", "dup_lines", "repeats", "word_chars", "line_words", "digits", "bars", "stops"]


def evidence(docs: DataFrame) -> DataFrame:
    """``_row`` (doc_id, source, lang) and the evidence features of every document."""
    df = rule_features(docs.select("doc_id", "source", "lang", "text"))
    t = F.coalesce(F.col("_row.text"), F.lit(""))
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    dropped = lambda chars: (F.length(t) - F.length(F.translate(t, chars, ""))) / n
    return df.select(
        F.col("_row").dropFields("text").alias("_row"),
        F.log1p(F.col("n_words").cast("double")).alias("log_words"), (F.col("n_symbols") / n).alias("symbols"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("dup_lines"),
        (F.col("n_repeat_words") / n).alias("repeats"), F.least(F.lit(40.0), F.col("word_chars") / n).alias("word_chars"),
        F.log1p(n / F.greatest(F.col("n_lines"), F.lit(1))).alias("line_words"),
        dropped("0123456789").alias("digits"), dropped("|").alias("bars"), dropped(".,;:!?").alias("stops"))


def labelled_sample(rows: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``FIT_ROWS`` training rows, drawn by a hash of the id."""
    known = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
             .agg(F.max("quality").alias("y"), F.count("*").alias("c")))
    n = max(1, known.count())
    share = int((1 << 20) * min(1.0, 1.6 * FIT_ROWS / n))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20)) < share
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    chosen = known.where(draw & (fold != 1))
    fit = (rows.withColumn("doc_id", F.col("_row.doc_id")).join(chosen, "doc_id")
           .select("y", *EVIDENCE).limit(FIT_ROWS).toArrow())
    x = np.stack([fit.column(c).to_numpy() for c in EVIDENCE], 1) if fit.num_rows else np.zeros((0, len(EVIDENCE)))
    return x, (fit.column("y").to_numpy() > 0).astype(np.float64)


def logit_column(model: Logistic) -> Column:
    """A fitted regression as one DataFrame expression."""
    if model.constant is not None:
        return F.lit(30.0 if model.constant else -30.0)
    out = F.lit(float(model.weights[-1]))
    for c, w, m, d in zip(EVIDENCE, model.weights, model.mean, model.dev, strict=False):
        out = out + (F.col(c) - float(m)) * float(w / d)
    return F.greatest(F.lit(-30.0), F.least(F.lit(30.0), out))


def shrunk(level: DataFrame, prior: Column, key: str) -> DataFrame:
    """(``key``, ``n``, ``p`` sum, ``prior``) with ``rate``: shrunk to ``prior`` with moment-fitted strength."""
    df = level.withColumn("prior", prior)
    m, n = F.col("prior"), F.col("n").cast("double")
    spread = m * (1 - m)
    whole = df.agg(F.sum(n * F.pow(F.col("p") / n - m, F.lit(2))).alias("ss"), F.sum(n).alias("n"),
                   F.sum(n * spread).alias("v"), F.sum(spread).alias("w"))
    # expected by chance alone: one spread for each group; what is over is between groups
    between = (F.col("ss") - F.col("w")) / F.col("n")
    strength = whole.select(F.when(between > 0, F.least(F.lit(1e6), F.greatest(
        F.lit(1.0), F.col("v") / F.col("n") / between - 1))).otherwise(1e6).alias("k")).scalar()
    return (df.withColumn("_k", strength)
            .withColumn("rate", (F.col("p") + m * F.col("_k")) / (n + F.col("_k"))).drop("_k"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``_row`` with ``own`` (evidence alone), ``host_rate``, ``path_rate``, ``score`` and ``kept``."""
    rows = written(evidence(docs), "quality-evidence")
    model = Logistic(*labelled_sample(rows, labels))
    df = rows.select("_row", logit_column(model).alias("logit"),
                     F.struct(F.col("_row.source").alias("s")).alias("host"),
                     F.struct(F.col("_row.source").alias("s"), F.col("_row.lang").alias("l")).alias("path"))
    p = 1 / (1 + F.exp(-F.col("logit")))
    paths = written(df.groupBy("path").agg(F.count("*").alias("n"), F.sum(p).alias("p")), "quality-paths")
    hosts = paths.groupBy(F.struct("path.s").alias("host")).agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    overall = paths.agg(F.sum("p") / F.sum("n")).scalar()
    hosts = written(shrunk(hosts, overall, "host").select("host", F.col("rate").alias("host_rate"),
                                                          F.col("prior").alias("whole")), "quality-host-rates")
    paths = (paths.withColumn("host", F.struct("path.s")).join(
        hosts.withColumnRenamed("host", "_h"), F.col("host").eqNullSafe(F.col("_h"))).drop("_h"))
    paths = written(shrunk(paths, F.col("host_rate"), "path").select(
        F.col("path").alias("_p"), "host_rate", F.col("rate").alias("path_rate"), "whole"), "quality-path-rates")
    odds = lambda c: F.log(F.greatest(c, F.lit(1e-9)) / F.greatest(1 - c, F.lit(1e-9)))
    score = 1 / (1 + F.exp(-(F.col("logit") + odds(F.col("path_rate")) - odds(F.col("whole")))))
    return (df.join(paths, F.col("path").eqNullSafe(F.col("_p")), "left")
            .select("_row", p.alias("own"), "host_rate", "path_rate", score.alias("score"),
                    (score >= KEEP).alias("kept")))


def op4_quality_classifier(spark, sf_dir) -> DataFrame:
    rated = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rated.select("_row.doc_id", "_row.source", "_row.lang", "own", "host_rate", "path_rate", "score", "kept")
