"""Copy an external event table into a local one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def append_external(spark: SparkSession, source: str, target: str, schema: StructType | None = None,
                    partition_by: Sequence[str] = (), bootstrap: bool = False) -> DataFrame:
    """Copy every row of ``source`` into ``target``: no filter, no dedup.

    ``bootstrap=True`` is create-as-select: it writes only when ``target`` does
    not exist yet.  Running the append twice duplicates every row, as the
    reference does.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    rows = reader.parquet(source)
    writer = rows.write.mode("ignore" if bootstrap else "append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(target)
