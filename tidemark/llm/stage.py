"""Intermediate tables in the shared folder, so that lineage ends there."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tidemark.session import shared_dir


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    A fresh folder each time: a failed run never leaves half a table that a
    later one would read, and a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables; what was made of them has to be stored by then."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
