"""Output sinks: CSV and Parquet.

* CSV cannot hold nested values, so columns are encoded first: day-time
  intervals -> ``<name>_ms`` BIGINT milliseconds (the interval column is
  dropped); arrays -> JSON of a one-field struct ``{"<name>": [...]}``;
  structs -> JSON with null fields kept; map columns -> JSON. Intervals inside
  them become milliseconds, too (a field ``x`` is then called ``x_ms``).
* Parquet keeps nested types; whitespace runs in the output name become ``_``.
* ``drop_null_columns`` drops columns with no non-null value (on an empty frame every column
  counts as all-null). The frame is computed once: it is written to the shared scratch folder while
  its non-null values are counted (observed metrics of that write), and the columns that have any
  are read from there.
* Partitioned outputs use ``write.partitionBy`` (one folder ``by_<key>=value`` per key
  value, with the key column kept in the files) instead of one driver-side loop per key.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import interval_ms
from ..operators.structs import column
from ..session import ensure_checkpoint_dir, scratch_path

_JSON_OPTS = {"ignoreNullFields": "false"}


@dataclass
class NamedOutput:
    """An output table and how to lay it out on disk."""

    name: str
    frame: DataFrame
    partition_by: list[str] = field(default_factory=list)


def safe_name(name: str) -> str:
    """File-name form of an output name: whitespace runs -> ``_``, path separators removed."""
    return re.sub(r"[/\\]", "_", re.sub(r"\s+", "_", name.strip()))


def _has_interval(dt: T.DataType) -> bool:
    if isinstance(dt, T.StructType):
        return any(_has_interval(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _has_interval(dt.elementType)
    return isinstance(dt, T.DayTimeIntervalType)


def _plain(c: Column, dt: T.DataType) -> Column:
    """``c`` with every interval inside it as milliseconds; a field ``x`` becomes ``x_ms``."""
    if not _has_interval(dt):
        return c
    if isinstance(dt, T.StructType):
        fields = [_plain(c.getField(f.name), f.dataType).alias(
            f"{f.name}_ms" if isinstance(f.dataType, T.DayTimeIntervalType) else f.name) for f in dt.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: _plain(x, dt.elementType))
    return interval_ms(c)


def csv_encode(df: DataFrame) -> DataFrame:
    """Flatten a frame to CSV-writable columns (see module docstring)."""
    cols: list[Column] = []
    for f in df.schema.fields:
        c = column(f.name)
        dt = f.dataType
        if isinstance(dt, T.DayTimeIntervalType):
            cols.append(interval_ms(c).alias(f"{f.name}_ms"))
        elif isinstance(dt, T.ArrayType):
            cols.append(F.to_json(F.struct(_plain(c, dt).alias(f.name)), _JSON_OPTS).alias(f.name))
        elif isinstance(dt, (T.StructType, T.MapType)):
            cols.append(F.to_json(_plain(c, dt), _JSON_OPTS).alias(f.name))
        elif isinstance(dt, (T.BinaryType, T.VariantType)):
            continue
        else:
            cols.append(c)
    return df.select(*cols)


def staged(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` as a written table and its columns with a non-null value, counted by the same write."""
    spark = df.sparkSession
    typed = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NullType)]  # an untyped column holds nulls only
    if not typed:
        return df, []
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, "staged")
    seen = Observation()
    # Columns get generated names, so that any name and any letter case can be staged.
    plain = df.select(*[column(c).alias(f"c{i}") for i, c in enumerate(typed)])
    plain.observe(seen, *[F.count(F.col(c)).alias(c) for c in plain.columns]).write.parquet(path)
    counts = seen.get
    back = spark.read.schema(plain.schema).parquet(path)
    back = back.select(*[F.col(f"c{typed.index(c)}").alias(c) if c in typed else F.lit(None).alias(c) for c in df.columns])
    return back, [c for i, c in enumerate(typed) if counts.get(f"c{i}", 0) > 0]


def drop_null_columns(df: DataFrame) -> DataFrame:
    back, keep = staged(df)
    return back.select(*[column(c) for c in keep])


def _prepared(out: NamedOutput, df: DataFrame, drop_nulls: bool) -> tuple[DataFrame, list[str]]:
    """The frame to write and its folder columns.

    Key columns are never dropped and stay in the files; the folders are named after copies of
    them, ``by_<key>``. A frame without any value keeps its columns, as a file needs a header.
    Rows of a key are brought together first (AQE splits a large key and joins small ones),
    so that not every task writes a file for every key.
    """
    if drop_nulls:
        back, kept = staged(df)
        keep = set(kept)
        if keep:
            df = back.select(*[column(c) for c in df.columns if c in keep or c in out.partition_by])
    if not out.partition_by:
        return df, []
    df = df.hint("rebalance", *[column(c) for c in out.partition_by])
    return df.withColumns({f"by_{c}": column(c) for c in out.partition_by}), [f"by_{c}" for c in out.partition_by]


def write_csv(out: NamedOutput, output_dir: str, *, drop_nulls: bool = False, mode: str = "overwrite",
              compression: str = "none", rows_a_file: int = 0, effort: str | None = None) -> str:
    """``effort`` is a level of Hadoop's zlib (``BEST_SPEED`` ...) for ``compression='gzip'``."""
    df, folders = _prepared(out, csv_encode(out.frame), drop_nulls)
    path = f"{output_dir.rstrip('/')}/{safe_name(out.name)}.csv"
    w = (df.write.mode(mode).option("header", "true").option("escape", '"')
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
         .option("compression", compression).option("maxRecordsPerFile", rows_a_file))
    if effort is not None:
        w = w.option("zlib.compress.level", effort)
    (w.partitionBy(*folders) if folders else w).csv(path)
    return path


def write_parquet(out: NamedOutput, output_dir: str, *, drop_nulls: bool = False, mode: str = "overwrite") -> str:
    df, folders = _prepared(out, out.frame, drop_nulls)
    path = f"{output_dir.rstrip('/')}/{safe_name(out.name)}.parquet"
    w = df.write.mode(mode)
    (w.partitionBy(*folders) if folders else w).parquet(path)
    return path


WRITERS = {"csv": write_csv, "parquet": write_parquet}


def writer(fmt: str):
    try:
        return WRITERS[fmt]
    except KeyError:
        raise ValueError(f"unknown output format {fmt!r}; choose one of {sorted(WRITERS)}") from None
