"""Reading questionnaire response exports (CSV, one row per answered item).

* every column is read as STRING (no type inference: ``007`` stays ``007``,
  version ``1.10`` stays text); typed casts happen in ``normalize``;
* a directory is scanned non-recursively for ``*responses*.csv``, gzip-compressed (``.csv.gz``) or not;
* files are merged **by column name**: files are grouped by header, each group
  is read with one scan, and groups are unioned by name (missing -> null).
  A single multi-path read would match differing headers by position.
"""

from __future__ import annotations

import csv
import fnmatch
import io
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.normalize import normalize
from ..session import spread

# Fixed value: file-name pattern of response exports inside an export folder.
RESPONSES_PATTERN = "*responses*.csv"

CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "escape": '"',
    "encoding": "UTF-8",
    "mode": "FAILFAST",
}


class ExportNotFoundError(FileNotFoundError):
    """The export path does not exist."""


class NoExportFilesError(ValueError):
    """The export folder holds no response export file."""


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_export_files(spark: SparkSession, path: str, pattern: str = RESPONSES_PATTERN) -> list[str]:
    """Export files at ``path`` (a file, or a folder scanned non-recursively)."""
    p, fs = _hadoop_fs(spark, path)
    if not fs.exists(p):
        raise ExportNotFoundError(f"there is no export at {path}")
    if fs.getFileStatus(p).isFile():
        return [p.toString()]
    files = sorted(
        st.getPath().toString()
        for st in fs.listStatus(p)
        if st.isFile() and fnmatch.fnmatch(st.getPath().getName().removesuffix(".gz"), pattern)
    )
    if not files:
        raise NoExportFilesError(f"No files matching {pattern} in {path}.")
    return files


def _fields(record: str) -> list[str]:
    return next(csv.reader(io.StringIO(record.lstrip("\ufeff"), newline="")), [])


def _first_row_of_each_partition(df: DataFrame) -> DataFrame:
    """The first row of every partition; a task reads no further.

    ``limit`` counts over all partitions, and a Python function that returns early does not do: the JVM goes on
    sending rows as long as the worker's socket takes them, and an ended worker drains its socket.
    """
    spark = df.sparkSession
    local = df.limit(1)._jdf.queryExecution().analyzed().child()  # a limit is a global one over a local one
    return DataFrame(spark.sparkContext._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, local), spark)


def headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(header array<string>, paths array<string>): the files grouped by their first record.

    One job: every file is a partition of its own, whose task reads its first record, quoted line
    breaks included, and stops. Files without a record are in no group. Records are parsed after equal ones are grouped.
    """
    # A one-column schema makes every longer record "corrupt", and a corrupt record is handed over as its raw text.
    # Paths of files come back as URIs, with percent signs for spaces and the like.
    options = CSV_OPTIONS | {"header": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_record"}
    rows = spark.read.options(**options).schema("_first string, _record string").csv(list(paths))
    rows = _first_row_of_each_partition(rows.select(F.col("_metadata.file_path").alias("path"), "_first", "_record"))
    records = rows.groupBy("_first", "_record").agg(F.collect_list("path").alias("paths"))

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.to_pylist()
            fields = [_fields(r["_record"]) if r["_record"] is not None else [(r["_first"] or "").lstrip("\ufeff")] for r in found]
            of = [[unquote(p) for p in r["paths"]] for r in found]
            yield pa.RecordBatch.from_arrays([pa.array(fields, pa.list_(pa.string())), pa.array(of, pa.list_(pa.string()))], names=["header", "of"])

    return (records.mapInArrow(parsed, "header array<string>, of array<string>")
            .groupBy("header").agg(F.sort_array(F.flatten(F.collect_list("of"))).alias("paths")))


def _header_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[tuple[str, ...], list[str]]]:
    held = {k: spark.conf.get(k) for k in ONE_FILE_A_TASK}
    try:
        for k, v in ONE_FILE_A_TASK.items():
            spark.conf.set(k, v)
        groups = headers(spark, paths).collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    return sorted((tuple(g["header"]), list(g["paths"])) for g in groups)


def read_csv_strings(spark: SparkSession, paths: Sequence[str], header: Sequence[str]) -> DataFrame:
    """One scan over files sharing ``header``; every column STRING."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    return spark.read.options(**CSV_OPTIONS).schema(schema).csv(list(paths))


#: Settings under which the header job is planned: no two files share a task.
ONE_FILE_A_TASK = {"spark.sql.files.maxPartitionBytes": "1"}


def merge_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union frames by column name; a column missing from a frame is null there.

    Meant for all-STRING export frames: an int/string mix would be coerced
    towards the numeric type (and fail under ANSI), so cast to string first.
    """
    if not frames:
        raise NoExportFilesError("nothing to merge")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_export_frame(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Raw (un-normalised) export rows from CSV files, merged by column name.

    The first record of each file is read by a job (:func:`headers`) and the files are grouped by it there; the
    driver gets the groups. The rows themselves are read with one scan for each group.
    """
    files = list(paths)
    if not files:
        raise NoExportFilesError("No export files given.")
    frames = [read_csv_strings(spark, fs, h) for h, fs in _header_groups(spark, files) if any(h)]
    if not frames:
        raise NoExportFilesError("Export files have no header row.")
    return spread(merge_by_name(frames))


def read_export(spark: SparkSession, path: str, *, on_error: str = "null") -> DataFrame:
    """Read an export file or folder and normalise it into the nested report."""
    return normalize(read_export_frame(spark, list_export_files(spark, path)), on_error=on_error)
