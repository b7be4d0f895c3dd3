"""Batch job: read an export, produce the requested outputs, write them.

Failures propagate (the job fails instead of logging and exiting 0). The parsed report is
written once as Parquet in the shared ``spark.checkpoint.dir`` folder and read back, whatever
outputs are asked for, so the export is read and parsed once, outputs read only the columns
they need, and a lost executor costs no second parse. ``reuse='none'`` skips that table.
"""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

from ..session import configure, scratch_path
from ..sinks.writers import writer
from ..sources.exports import list_export_files, read_export_frame
from ..operators.normalize import normalize
from .outputs import CATALOGUE, default_outputs, produce

LOG = logging.getLogger(__name__)


def default_output_dir(spark: SparkSession, input_path: str) -> str:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(input_path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = p if fs.getFileStatus(p).isDirectory() else p.getParent()
    return f"{base.toString().rstrip('/')}/output"


def run(
    spark: SparkSession,
    input_path: str,
    output_dir: str | None = None,
    outputs: list[str] | None = None,
    fmt: str = "csv",
    *,
    drop_null_columns: bool = False,
    extra: dict[str, str] | None = None,
    on_error: str = "null",
    reuse: str = "table",
) -> list[str]:
    """Run the export job; returns the written paths."""
    configure(spark)
    names = outputs or default_outputs()
    unknown = [n for n in names if n not in CATALOGUE]
    if unknown:
        raise ValueError(f"no output is called {unknown[0]!r}; there are {sorted(CATALOGUE)}")
    write = writer(fmt)
    out_dir = output_dir or default_output_dir(spark, input_path)
    report = normalize(read_export_frame(spark, list_export_files(spark, input_path)), on_error=on_error)
    if reuse == "table":
        path = scratch_path(spark, "report")
        report.write.parquet(path)
        report = spark.read.schema(report.schema).parquet(path)
    written: list[str] = []
    for name in names:
        for out in produce(name, report, extra):
            LOG.info("writing %s", out.name)
            written.append(write(out, out_dir, drop_nulls=drop_null_columns))
    return written
