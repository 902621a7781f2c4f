"""Ingest: landed API pages, actor tagging, nested-record flattening, typed scans."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from hopgraph.schemas import API_PAGE
from hopgraph.sources.loads import row_id


def ingest_pages(spark: SparkSession, path: str, kind: str, schema: StructType = API_PAGE) -> DataFrame:
    """Landed API pages ``{followers|follows: [profile...], cursor}`` -> one row per profile.

    The request actor, when the landing kept it as a top-level ``actor``
    field, is carried as ``request_actor``.  A malformed page fails the read
    rather than vanish.
    """
    if kind not in ("followers", "follows"):
        raise ValueError(kind)
    if "actor" not in schema.fieldNames():
        schema = StructType(schema.fields + [StructField("actor", StringType(), True)])
    pages = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return (pages.select(F.explode(kind).alias("p"), F.col("actor").alias("request_actor"))
                 .select("p.*", "request_actor"))


def tag_actor(df: DataFrame, actor: str | Column, ingest_time: str | Column | None = None,
              time_col: str = "indexed_at") -> DataFrame:
    """Add the crawled ``actor``; optionally overwrite the index time with the ingest time.

    The Parquet crawler overwrote the API's index time with its own UTC ISO
    string; pass ``ingest_time`` (text, a Column, or ``"now"``) to do the same.
    """
    out = df.withColumn("actor", actor if isinstance(actor, Column) else F.lit(actor))
    if ingest_time is not None:
        if isinstance(ingest_time, Column):
            value = ingest_time
        elif ingest_time == "now":
            value = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        else:
            value = F.lit(ingest_time)
        out = out.withColumn(time_col, value)
    return out


def snake_case(name: str) -> str:
    """``displayName`` -> ``display_name``; ``allowIncoming`` -> ``allow_incoming``."""
    s = re.sub(r"(.)([A-Z][a-z]+)", r"\1_\2", name)
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s).lower()


def flatten_nested(df: DataFrame, sep: str = "__", snake: bool = True) -> DataFrame:
    """Nested struct fields become ``parent__child`` columns (names snake_cased)."""
    cols: list[Column] = []

    def walk(prefix_path: list[str], prefix_name: list[str], st: StructType) -> None:
        for f in st.fields:
            name = snake_case(f.name) if snake else f.name
            path, names = prefix_path + [f.name], prefix_name + [name]
            if isinstance(f.dataType, StructType):
                walk(path, names, f.dataType)
            else:
                cols.append(F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(names)))

    walk([], [], df.schema)
    return df.select(*cols)


def child_tables(df: DataFrame, name: str, id_columns: list[str | Column], sep: str = "__",
                 snake: bool = True) -> dict[str, DataFrame]:
    """I3 for records with lists: a parent table and one child table for each list, at any depth.

    The parent (``name``) has the flattened structs and a ``_dlt_id`` from
    ``id_columns`` (which should tell its rows apart).  The list ``a`` becomes
    the table ``name__a`` with one row an element: its fields (or ``value``, if
    the elements are no structs), ``_dlt_parent_id``, its place ``_dlt_list_idx``
    (from 0) and its own ``_dlt_id``.  A NULL or empty list has no rows; a NULL
    element is a row of NULLs.  Joining a child to its parent gives back the lists.
    """
    out: dict[str, DataFrame] = {}

    def grow(rows: DataFrame, table: str) -> None:
        flat = flatten_nested(rows, sep, snake)
        lists = [f for f in flat.schema.fields if isinstance(f.dataType, ArrayType)]
        out[table] = flat.drop(*[f.name for f in lists])
        for f in lists:
            item = flat.select(F.col("_dlt_id").alias("_dlt_parent_id"),
                               F.posexplode(f.name).alias("_dlt_list_idx", "_item"))
            own = row_id(["_dlt_parent_id", "_dlt_list_idx"]).alias("_dlt_id")
            fields = "_item.*" if isinstance(f.dataType.elementType, StructType) else F.col("_item").alias("value")
            grow(item.select(fields, "_dlt_parent_id", F.col("_dlt_list_idx").cast("long").alias("_dlt_list_idx"), own),
                 f"{table}{sep}{f.name}")

    grow(df.withColumn("_dlt_id", row_id(id_columns)), name)
    return out


def typed_scan(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """I8: scan with a declared schema; ``key=value`` directories fill partition columns."""
    return spark.read.schema(schema).parquet(path)
