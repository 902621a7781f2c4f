"""Operator 13: exact deduplication that no hot text can slow down (native).

Equal texts form a group; the row with the largest ``doc_id`` stays.  The
whole text is part of every grouping key, so a digest never decides alone:

1. *locally*: the partial aggregate of every map task merges its own copies;
2. *salted digest groups*: what is left meets by (digest, salt, text).  The
   salt of a hot digest is the map task's number modulo ``SALTS``, of any
   other 0.  Hot is a digest of more than 1/``HOT_SHARE`` of all rows, so
   fewer than ``HOT_SHARE`` of them exist, whatever the input;
3. *globally*: the salt winners of hot digests meet by (digest, text).  Cold
   digests are complete already: only their digests move on.

Last the texts of a digest are counted.  A digest of one text stands for it,
and the documents take their group by it: hot ones from a broadcast of fewer
than ``HOT_SHARE`` rows, cold ones by a shuffle of ids and digests.  Documents
of a digest with several texts (a collision) take their group by text.

Cases: a NULL text counts as empty, and empty texts are one group; a NULL id
is smaller than any other; of rows that agree in id and text one stays; other
columns are never looked at, whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopgraph.llm.common import table, written

SALTS = 64
HOT_SHARE = 10_000


def sha256_of(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def _hot(light: DataFrame) -> DataFrame:
    """Digests of more than 1/HOT_SHARE of the rows: fewer than HOT_SHARE rows of one digest each."""
    least = light.count() // HOT_SHARE
    return written(light.groupBy("digest").agg(F.count("*").alias("n"))
                   .where(F.col("n") > max(least, 1)).select("digest"), "exact-hot")


def text_groups(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """(``digest``, ``texts``, ``keep_id``, ``group_size``): how many texts a digest has, and all its rows.

    ``rows`` have ``doc_id``, ``digest`` and ``content``.  A group of one text is final; the numbers of a
    digest with several texts are of all of them together.
    """
    tagged = rows.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "digest", "left")
    salt = F.when(F.col("hot"), F.pmod(F.spark_partition_id(), F.lit(SALTS))).otherwise(0)
    winners = (tagged.withColumn("salt", salt).groupBy("digest", "salt", "hot", "content")
               .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n")))
    merged = (winners.select("digest", "hot", F.when(F.col("hot"), F.col("content")).alias("content"),
                             "keep_id", "n")
              .groupBy("digest", "hot", "content")
              .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"), F.count("*").alias("parts")))
    texts = F.when(F.col("hot"), F.lit(1)).otherwise(F.col("parts"))      # a hot row is one text by now
    return merged.groupBy("digest").agg(F.sum(texts).alias("texts"), F.max("keep_id").alias("keep_id"),
                                        F.sum("n").alias("group_size"))


def _collided(rows: DataFrame, digests: DataFrame) -> DataFrame:
    """Rows whose digest stands for several texts, grouped by the text itself."""
    own = written(rows.join(digests, "digest", "left_semi"), "exact-collided")
    group = own.groupBy("digest", "content").agg(F.max(F.struct("doc_id", "rid")).alias("top"),
                                                 F.count("*").alias("group_size"))
    return own.join(group, ["digest", "content"]).select(
        "rid", "doc_id", "digest", F.col("top.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("top.rid")).alias("kept"))


def mark_copies(rows: DataFrame, digest: Callable[[Column], Column] = sha256_of) -> DataFrame:
    """One row for each row of ``rows`` (``rid`` unique, ``doc_id``, ``text``).

    Gives ``rid``, ``doc_id``, ``digest``, ``keep_id``, ``group_size``, ``kept``.
    """
    rows = rows.withColumn("content", F.coalesce("text", F.lit(""))).select(
        "rid", "doc_id", digest(F.col("content")).alias("digest"), "content")
    light = written(rows.drop("content"), "exact-light")
    hot = _hot(light)
    top = light.groupBy("digest").agg(F.max(F.struct("doc_id", "rid")).alias("top"))
    groups = written(text_groups(rows.drop("rid"), hot).join(top, "digest"), "exact-groups")
    plain = groups.where("texts = 1").select("digest", "keep_id", "group_size", F.col("top.rid").alias("top"))
    hot_groups = plain.join(F.broadcast(hot), "digest", "left_semi")
    cold_rows = light.join(F.broadcast(hot), "digest", "left_anti")
    marked = (light.join(F.broadcast(hot_groups), "digest")
              .unionByName(cold_rows.join(plain, "digest"))
              .select("rid", "doc_id", "digest", "keep_id", "group_size", (F.col("rid") == F.col("top")).alias("kept")))
    several = groups.where("texts > 1").select("digest")
    return marked if several.isEmpty() else marked.unionByName(_collided(rows, several))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    rows = written(docs.select(F.struct("*").alias("_row")).withColumn("rid", F.monotonically_increasing_id()),
                   "exact-rows")
    marks = mark_copies(rows.select("rid", "_row.doc_id", "_row.text"))
    return rows.join(marks.where("kept").select("rid"), "rid", "left_semi").select("_row.*")


def op13_exact_dedup(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marks = mark_copies(docs.withColumn("rid", F.monotonically_increasing_id()))
    return marks.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
