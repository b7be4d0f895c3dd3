"""Participant roster side input (CSV) for the attendance and completion grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class MissingExtraArgumentError(ValueError):
    """An output needs a side input that was not given."""


class RosterColumnError(ValueError):
    """The roster lacks a required column."""


# Roster file columns and the names they get.
ROSTER_COLUMNS = {
    "secretUserId": "secret_id",
    "nickname": "nickname",
    "firstName": "first_name",
    "lastName": "last_name",
    "site": "site",
}
REQUIRED = ("site", "secretUserId")


def select_roster(raw: DataFrame) -> DataFrame:
    """Validate and rename roster columns; an optional ``room`` column is kept."""
    for c in REQUIRED:
        if c not in raw.columns:
            raise RosterColumnError(f"the roster has no column {c}")
    cols = [F.col(src).alias(dst) if src in raw.columns else F.lit(None).cast("string").alias(dst)
            for src, dst in ROSTER_COLUMNS.items()]
    if "room" in raw.columns:
        cols.append(F.col("room"))
    return raw.select(*cols)


def read_participants(spark: SparkSession, path: str | None) -> DataFrame:
    if not path:
        raise MissingExtraArgumentError("attendance outputs need the participants file path")
    from .exports import ExportNotFoundError, _hadoop_fs

    p, fs = _hadoop_fs(spark, path)
    if not fs.exists(p):
        raise ExportNotFoundError(f"no roster at {path}")
    raw = (spark.read.option("header", "true").option("escape", '"').option("multiLine", "true")
           .option("inferSchema", "false").csv(path))
    return select_roster(raw)
