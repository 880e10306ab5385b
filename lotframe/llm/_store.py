"""Cutting lineage through the shared folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotframe.sources.shared import fresh_path, written


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet into the shared folder and reads it back, so that a lost executor costs no recomputation
    and later uses start from the files. The files stay until the folder is cleared, as the result may be read lazily."""
    return written(df, fresh_path(df.sparkSession, name))


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
