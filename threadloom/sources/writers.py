"""Outputs of the jobs, named by site and start time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators.validate import REASON


# Readers that wait for finished outputs rely on the mark, whatever the session says.
MARKED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}


def output_name(site: str, kind: str, started: datetime) -> str:
    return f"{site}_{kind}_{started:%Y%m%d_%H%M%S}"


def write_rows(
    df: DataFrame, root: str, site: str, kind: str, started: datetime, fmt: str = "parquet"
) -> str:
    """Write one output folder and return its path. Parquet between jobs, CSV for people."""
    path = f"{root.rstrip('/')}/{output_name(site, kind, started)}"
    writer = df.write.mode("errorifexists").options(**MARKED)
    if fmt == "csv":
        writer = (
            writer.option("header", True)
            .option("encoding", "UTF-8")
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    writer.format(fmt).save(path)
    return path


def write_checked(df: DataFrame, root: str, site: str, kind: str, started: datetime) -> str:
    """Write accepted and rejected rows in one pass, into ``accepted=true`` and ``=false``."""
    path = f"{root.rstrip('/')}/{output_name(site, kind, started)}"
    split = df.withColumn("accepted", F.col(REASON).isNull())
    split.write.mode("errorifexists").options(**MARKED).partitionBy("accepted").parquet(path)
    return path
