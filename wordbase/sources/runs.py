"""Run-stamped datasets: one folder per area, run time and owner."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordbase.sources.csv import read_csv, write_csv

CLEANED = "cleaned"
LABELLED_CLEANED = "labelled_cleaned"
UPDATE = "update"
LABELLED_UPDATE = "labelled_update"
AREAS = (CLEANED, LABELLED_CLEANED, UPDATE, LABELLED_UPDATE)

# Fixed value: the text form of a run time
STAMP_FORMAT = "%d.%m.%Y_%H.%M.%S"


def run_stamp(when: datetime) -> str:
    return when.strftime(STAMP_FORMAT)


def run_path(root: str, area: str, stamp: str, owner: str) -> str:
    if area not in AREAS:
        raise ValueError(f"unknown area {area!r}, expected one of {', '.join(AREAS)}")
    for name, value in (("stamp", stamp), ("owner", owner)):
        if not re.fullmatch(r"[\w.\-]+", value):
            raise ValueError(f"{name} {value!r} may hold letters, digits, '_', '.' and '-' only")
    return f"{root}/{area}/run_ts={stamp}/owner={owner}"


def write_run(df: DataFrame, root: str, area: str, stamp: str, owner: str) -> str:
    path = run_path(root, area, stamp, owner)
    write_csv(df, path)
    return path


def read_run(
    spark: SparkSession, root: str, area: str, stamp: str, owner: str, schema: T.StructType
) -> DataFrame:
    """One run; the folder is addressed directly, so no other run is even listed."""
    return read_csv(spark, run_path(root, area, stamp, owner), schema)


def read_area(spark: SparkSession, root: str, area: str, schema: T.StructType) -> DataFrame:
    """All runs of an area with ``run_ts`` and ``owner`` columns; filters on them prune folders."""
    stamped = T.StructType([*schema.fields])
    stamped = stamped.add("run_ts", T.StringType()).add("owner", T.StringType())
    folder = run_path(root, area, "-", "-").split("/run_ts=")[0]
    return (
        spark.read.schema(stamped)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(folder)
        .select(*(F.col(name) for name in stamped.names))
    )
