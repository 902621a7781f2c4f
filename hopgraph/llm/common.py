"""Helpers shared by the operators: tables, scratch tables, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hopgraph.session import fresh_path

WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage, survives the loss of any executor, and gives Spark the
    file size, so that later joins choose a broadcast by bytes.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; NULL and blank give an empty array."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE_RUN))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an edge list (``a`` long, ``b`` long).

    Returns (``node``, ``component``), the component being its smallest node;
    only nodes with an edge to another node appear.  Alternating large-star
    and small-star steps (Kiveris et al., 2014), each an aggregate and a join
    over an edge list that never grows beyond its input; every round is
    written to the shared folder.  Hubs stay splittable: a node's neighbours
    are joined, never collected.
    """
    def smallest(e: DataFrame) -> DataFrame:
        return e.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))

    e = (edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
         .distinct())
    e = written(e, "cc-edges")
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large-star: the larger neighbours of a node move to its smallest neighbour
        e = (both.join(smallest(both), "a").where("b > a")
             .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        # small-star: a node and its smaller neighbours move to the smallest of them
        low = smallest(e)
        moved = e.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = written(moved.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct(),
                    "cc-edges")
        now = tuple(e.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    leaf = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    root = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaf.unionByName(root)
