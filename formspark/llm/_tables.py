"""Written tables, row blocks and exact ranks shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import configure, ensure_checkpoint_dir, scratch_path

#: Rows and bytes of an Arrow batch between Spark and a Python worker.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20
BLOCK_ROWS = 1 << 18


def ready(spark: SparkSession) -> SparkSession:
    """Session settings of the operators: the library's, and Arrow batches of bounded size."""
    configure(spark)
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


#: Written tables hold rows of very different sizes: small row groups, checked after few rows,
#: bound what a writer or a reader holds in memory at a time.
PARQUET = {"compression": "zstd", "parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "8"}


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.options(**PARQUET).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocks(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task regrouped into blocks of about ``most`` bytes of ``column``.

    Rows are never split: a text longer than ``most`` is a block of its own. A block has at
    most ``BLOCK_ROWS`` rows, however short they are.
    """
    held: list[pa.RecordBatch] = []
    size = rows = 0
    for batch in batches:
        at = batch.schema.get_field_index(column)
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = before = 0
        while lo < len(batch):
            hi = int(np.searchsorted(ends, before + most - size, side="right"))
            hi = min(hi, lo + BLOCK_ROWS - rows)
            if hi <= lo and held:
                yield _joined(held)
                held, size, rows = [], 0, 0
                continue
            hi = max(hi, lo + 1)
            rows += hi - lo
            held.append(batch.slice(lo, hi - lo))
            size += int(ends[hi - 1]) - before
            lo, before = hi, int(ends[hi - 1])
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.concat_batches(held)


def gapless(df: DataFrame, group: list[str], bucket: Column, order: list[Column], out: str, per_group: int = 4096) -> DataFrame:
    """``out``: position from 0 of every row inside its ``group``, without gaps.

    No group passes through one task: rows are ranked inside ``per_group`` buckets of the
    group (``bucket``: an integer in 0 .. per_group - 1) and shifted by the rows of the
    buckets before, a table of at most ``per_group`` rows for each group.
    """
    b = df.withColumn("_bucket", bucket)
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = (b.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    shift = shift.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_bucket").alias("_gb"), "_shift")
    ranked = b.withColumn("_rank", F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy(*order)))
    on = F.col("_bucket") == F.col("_gb")
    for i, c in enumerate(group):
        on = on & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return (ranked.join(shift, on)
            .withColumn(out, (F.col("_shift") + F.col("_rank") - 1).cast("long"))
            .drop("_bucket", "_gb", "_shift", "_rank", *[f"_g{i}" for i in range(len(group))]))
