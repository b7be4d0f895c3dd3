"""Option dictionary: every distinct options text of a report parsed once, joined back by its hash.

The options text of an item repeats on each of its answer rows, and a range such as
``Min: 0, Max: 1000000`` is short as text and long as a list. So texts are made distinct first
(partial aggregation, one short row per text), parsed once, and written to the shared scratch
folder as ``(key, options)``, key being the 64-bit hash of the text; two texts of one hash are an error.

Rows get their options by an equi-join on the key. The dictionary is broadcast when its
measured size is at most ``BROADCAST_BYTES``; beyond that Spark joins by shuffle, and adaptive execution
splits the partition of a text that a large share of the rows has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.options import parse_options
from ..functions.scalars import strip_all
from ..session import ensure_checkpoint_dir, scratch_path

BROADCAST_BYTES = 32 << 20
#: About what an option takes in memory beside its name.
OPTION_BYTES = 48


def text_key(text: Column) -> Column:
    """Key of an options text (null for no text)."""
    return F.when(text.isNotNull(), F.xxhash64(text))


@dataclass
class OptionDictionary:
    """The parsed texts, and whether they are small enough to be broadcast."""

    frame: DataFrame  # _key, _options (never null)
    small: bool

    def _side(self, frame: DataFrame) -> DataFrame:
        return F.broadcast(frame) if self.small else frame

    def join(self, df: DataFrame, text: Column, out: str = "_options") -> DataFrame:
        """``df`` with the options of ``text`` in column ``out``; null where it is no option list."""
        side = self.frame.select(F.col("_key").alias("_okey"), F.col("_options").alias(out))
        return df.join(self._side(side), text_key(text) == F.col("_okey"), "left").drop("_okey")

    def entries(self) -> DataFrame:
        """(_okey, _ovalue, _option): a row for every option, and one without option for each list that is not empty."""
        none = F.array(F.lit(None).cast(self.frame.schema["_options"].dataType.elementType))
        return (self.frame.where(F.size("_options") > 0)
                .select(F.col("_key").alias("_okey"), F.explode(F.concat("_options", none)).alias("_option"))
                .select("_okey", F.col("_option.value").alias("_ovalue"), "_option"))

    def match(self, df: DataFrame, text: Column, value: Column) -> DataFrame:
        """``df`` times the options of ``text`` whose value equals ``value`` (null equals null), in ``_option``.

        Without a match a row stays, without option, if ``value`` is null and ``text`` has no options.
        """
        on = (text_key(text) == F.col("_okey")) & value.eqNullSafe(F.col("_ovalue"))
        joined = df.join(self._side(self.entries()), on, "left")
        keep = F.when(F.col("_okey").isNotNull(), F.col("_option").isNotNull()).otherwise(value.isNull())
        return joined.where(keep).drop("_okey", "_ovalue")


def parsed_texts(report: DataFrame, raw: Column) -> DataFrame:
    """(_key, _options) of the distinct texts; _options is null where a text is no list.

    No filter on the options here: Spark would push it below the distinct and parse the text of every row.
    """
    texts = report.select(raw.alias("raw")).where(F.col("raw").isNotNull()).distinct()
    return texts.select(F.xxhash64("raw").alias("_key"), parse_options(strip_all(F.col("raw"))).alias("_options"))


def option_dictionary(report: DataFrame, text: Column | None = None) -> OptionDictionary:
    """The options texts of ``report`` (``item.raw_options``, or ``text``), each parsed once."""
    ensure_checkpoint_dir(report.sparkSession)
    parsed = parsed_texts(report, F.col("item.raw_options") if text is None else text)
    path = scratch_path(report.sparkSession, "options")
    parsed.write.parquet(path)
    frame = report.sparkSession.read.schema(parsed.schema).parquet(path).where(F.col("_options").isNotNull())
    names = F.aggregate("_options", F.lit(0).cast("bigint"), lambda n, o: n + F.length(o["name"]) + OPTION_BYTES)
    n, keys, size = frame.agg(F.count(F.lit(1)), F.count_distinct("_key"), F.coalesce(F.sum(names), F.lit(0))).first()
    if keys < n:
        raise ValueError("two option texts have the same 64-bit hash")
    return OptionDictionary(frame, size <= BROADCAST_BYTES)


def attached(report: DataFrame, dictionary: OptionDictionary, out: str) -> DataFrame:
    """``report`` with its options in column ``out``, and ``item`` without them.

    The item is cut down before the join: whatever filled ``item.response_options`` is not run.
    """
    fields = [f for f in report.schema["item"].dataType.fieldNames() if f != "response_options"]
    lean = report.withColumn("item", F.struct(*[F.col(f"item.{f}").alias(f) for f in fields]))
    return dictionary.join(lean, F.col("item.raw_options"), out)


def restored(df: DataFrame, out: str) -> DataFrame:
    """The ``item`` of :func:`attached` with its options again; column ``out`` goes."""
    fields = df.schema["item"].dataType.fieldNames()
    item = F.struct(*[F.col(f"item.{f}").alias(f) for f in fields], F.col(out).alias("response_options"))
    return df.withColumn("item", item).drop(out)


def with_options(report: DataFrame, dictionary: OptionDictionary | None = None) -> DataFrame:
    """``report`` with ``item.response_options`` from the dictionary, so that no row parses its own text."""
    return restored(attached(report, dictionary or option_dictionary(report), "_options"), "_options")
