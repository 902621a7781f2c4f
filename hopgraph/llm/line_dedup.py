"""Operator 1: line dedup over overlapping three-line windows.

Lines with a word are numbered in each document; every three consecutive ones
form a window, hashed to 128 bits.  A window that occurs at two places or more
in the corpus is repeated: its first place, in (doc_id, text hash, line)
order, stays, and the lines covered by any later place are removed.  Coverings
are merged, so a long repeated passage goes as a whole; the earliest place of
a line is never covered, so no line vanishes from the corpus.

Cases: blank lines belong to no window and stay; a document with fewer than
three lines with a word has no window and stays as it is, as do NULL and empty
texts; rows that agree in id and text are one document (both keep or lose the
same lines); a NULL id comes first; an empty table gives an empty result; the
input row is carried as a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopgraph.llm.common import WHITE, table, written

WINDOW = 3


def _spoken(lines: Column) -> Column:
    """Places of the lines that hold a word."""
    places = F.transform(lines, lambda x, i: F.when(F.btrim(x, F.lit(WHITE)) != "", i))
    return F.array_compact(places)


def windows(docs: DataFrame) -> DataFrame:
    """(``k`` (id, text hash), ``j``, ``h``): every window with its 128-bit hash and first line number."""
    df = docs.select(F.struct("doc_id", F.xxhash64("text").alias("t")).alias("k"),
                     F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "").alias("ls"))
    df = df.where(F.size("ls") >= WINDOW)
    at = lambda i: [F.get("ls", i + d) for d in range(WINDOW)]
    spans = F.transform(F.sequence(F.lit(0), F.size("ls") - WINDOW), lambda i: F.struct(
        i.alias("j"), F.struct(F.xxhash64(*at(i)).alias("a"),
                               F.xxhash64(F.lit("second"), *reversed(at(i))).alias("b")).alias("h")))
    return df.select("k", F.explode(spans).alias("w")).select("k", "w.j", "w.h")


def removals(docs: DataFrame) -> DataFrame:
    """(``k``, ``js``): for each document the windows that repeat an earlier place.

    Places are compared through the minimum and maximum of a hash's group, a
    partial aggregate; a hot window is a skewed join, not a gathered group.
    """
    w = windows(docs)
    place = F.struct("k", "j")
    again = (w.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last"))
             .where("first <> last").select("h", "first"))
    return (w.join(again, "h").where(place != F.col("first"))
            .groupBy("k").agg(F.sort_array(F.collect_set("j")).alias("js")))


def line_dedup(docs: DataFrame) -> DataFrame:
    """``_row`` with ``n_lines``, ``n_removed`` and the cleaned ``text``, for every row of ``docs``."""
    gone = written(removals(docs.select("doc_id", "text")), "line-removals").select(F.col("k").alias("_k"), "js")
    gone = gone.hint("merge")        # removals grow with the corpus: one plan at every size
    df = docs.select(F.struct("*").alias("_row"))
    key = F.struct(F.col("_row.doc_id").alias("doc_id"), F.xxhash64("_row.text").alias("t"))
    df = df.join(gone, key.eqNullSafe(F.col("_k")), "left")
    df = df.withColumn("_lines", F.split("_row.text", "\n")).withColumn("_at", _spoken(F.col("_lines")))
    covered = F.array_distinct(F.flatten(F.transform(
        F.col("js"), lambda j: F.array(*[F.get("_at", j + d) for d in range(WINDOW)]))))
    df = df.withColumn("_cov", covered)
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_cov"))
    cleaned = F.array_join(F.transform(left, lambda i: F.get("_lines", i)), "\n")
    return df.select(
        "_row", F.when(F.col("_row.text").isNull(), F.lit(0)).otherwise(F.size("_lines")).cast("long").alias("n_lines"),
        F.coalesce(F.size("_cov"), F.lit(0)).cast("long").alias("_n"),
        F.when(F.col("_cov").isNull(), F.col("_row.text")).otherwise(cleaned).alias("text"),
    ).select("_row", "n_lines", F.greatest("_n", F.lit(0)).alias("n_removed"), "text")


def op1_line_dedup(spark, sf_dir) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "_row.doc_id", "n_lines", "n_removed", "text")


SQL = r"""
WITH ls AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS x,
         generate_subscripts(string_split(text, chr(10)), 1) AS p
  FROM (SELECT DISTINCT doc_id, text FROM documents)),
nb AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, text ORDER BY p) AS j FROM ls
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
win AS (
  SELECT doc_id, text, j, x || chr(10) || lead(x, 1) OVER d || chr(10) || lead(x, 2) OVER d AS g
  FROM nb WINDOW d AS (PARTITION BY doc_id, text ORDER BY j)),
later AS (
  SELECT doc_id, text, j FROM (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, text, j) AS r
    FROM win WHERE g IS NOT NULL) WHERE r > 1),
cov AS (SELECT DISTINCT doc_id, text, unnest([j, j + 1, j + 2]) AS j FROM later),
cut AS (
  SELECT doc_id, text, ls.x, ls.p, cov.j IS NOT NULL AS gone
  FROM ls LEFT JOIN nb USING (doc_id, text, p) LEFT JOIN cov USING (doc_id, text, j)),
res AS (
  SELECT doc_id, text, count(*) AS n_lines, sum(gone::INT) AS n_removed,
         coalesce(string_agg(x, chr(10) ORDER BY p) FILTER (NOT gone), '') AS cleaned
  FROM cut GROUP BY doc_id, text)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, cleaned AS text
FROM documents d LEFT JOIN res ON d.doc_id = res.doc_id AND d.text = res.text
"""
