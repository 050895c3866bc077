"""Sources: catalog / path reads, parametrised SQL, dynamic names, snapshots."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def read_table(spark: SparkSession, name: str, source: str = "table", fmt: str = "parquet") -> DataFrame:
    """A catalog table (``source="table"``) or a path in ``fmt``; lazy, so filters and column
    pruning of the caller reach the scan."""
    if source == "table":
        return spark.read.table(name)
    return spark.read.format(fmt).load(name)


def read_parametrised(spark: SparkSession, sql: str, **params) -> DataFrame:
    """SQL text with named parameter markers (``:game``, ``:training_date``...). Values are bound,
    never concatenated into the text, so quoting is handled by Spark. Dates bind as DATE literals."""
    return spark.sql(sql, args=params)


def read_by_name(spark: SparkSession, table: str) -> DataFrame:
    """S3: a table chosen at run time (e.g. ``revenue_predictions.<game>``) through ``IDENTIFIER``."""
    return spark.sql("SELECT * FROM IDENTIFIER(:t)", args={"t": table})


def snapshot(df: DataFrame, path: str | None = None, mode: str = "overwrite") -> DataFrame:
    """Write an intermediate result as parquet and read it back (cuts lineage; survives the loss
    of executors). Without a path the frame goes under the shared ``spark.checkpoint.dir``."""
    spark = df.sparkSession
    if path is None:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/snapshots/{uuid.uuid4().hex}"
    df.write.mode(mode).parquet(path)
    return spark.read.parquet(path)
