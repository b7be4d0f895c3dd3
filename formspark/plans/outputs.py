"""Output tables derived from the normalised report, and their catalogue.

Every output is a function ``report -> DataFrame`` (lazy); ``produce(name,
report, extra)`` returns the list of :class:`NamedOutput` an output type
writes.  Distinct-based outputs run with partial (map-side) aggregation.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.options import parse_options
from ..functions.scalars import strip_all
from ..operators import grids, reshape, wide as wide_op
from ..operators.dictionary import option_dictionary, with_options
from ..operators.structs import unnest
from ..sinks.writers import NamedOutput
from ..sources.participants import read_participants


def _distinct_items(report: DataFrame, cols: list) -> DataFrame:
    """Distinct rows of ``cols`` plus the item's parsed options.

    The distinct runs on the options *text* and the parse happens on the
    distinct rows only (option texts repeat on every answer row); a second,
    small distinct merges texts that parse to the same list.
    """
    base = report.select(*cols, strip_all(F.col("item.raw_options")).alias("_ro")).distinct()
    return (base.withColumn("item_response_options", parse_options(F.col("_ro")))
            .drop("_ro").distinct())


def data_dictionary(report: DataFrame) -> DataFrame:
    """Distinct items with their context (output ``dictionary``)."""
    return _distinct_items(report, [
        "applet_version",
        F.col("activity_flow.id").alias("activity_flow_id"),
        F.col("activity_flow.name").alias("activity_flow_name"),
        F.col("activity.id").alias("activity_id"),
        F.col("activity.name").alias("activity_name"),
        F.col("item.id").alias("item_id"),
        F.col("item.name").alias("item_name"),
        F.col("item.prompt").alias("item_prompt"),
    ])


def data_dictionary_full(report: DataFrame) -> DataFrame:
    """Distinct items with every field of the flow, activity and item structs."""
    item_fields = [c for c in unnest(report, "item") if "response_options" not in str(c)]
    base = report.select(
        "applet_version", *unnest(report, "activity_flow"), *unnest(report, "activity"), *item_fields,
    ).distinct()
    return base.withColumn("item_response_options", parse_options(strip_all(F.col("item_raw_options"))))


def options(report: DataFrame) -> DataFrame:
    """One row per answer option of every distinct item (output ``options``)."""
    items = _distinct_items(report, [
        F.col("activity_flow.id").alias("activity_flow_id"),
        F.col("activity_flow.name").alias("activity_flow_name"),
        F.col("activity.id").alias("activity_id"),
        F.col("activity.name").alias("activity_name"),
        F.col("item.id").alias("item_id"),
        F.col("item.name").alias("item_name"),
        F.col("item.prompt").alias("item_prompt"),
    ])
    return items.select(
        "activity_flow_id", "activity_flow_name", "activity_id", "activity_name",
        "item_id", "item_name", "item_prompt",
        F.explode_outer("item_response_options").alias("_o"),
    ).select(
        "*", F.col("_o.name").alias("item_option_name"), F.col("_o.value").alias("item_option_value"),
        F.col("_o.score").alias("item_option_score"),
    ).drop("_o")


def scored_responses(report: DataFrame) -> DataFrame:
    """Answer values paired with the option they select (output ``scored``).

    Long answer rows x the row's item options, keeping pairs whose option
    value null-safely equals the answer value (``single_value``, else the
    exploded ``value`` element).  Rows whose item has no options are kept only
    when the answer value is null too.  The pairs come from one equi-join of the
    answers with the entries of the option dictionary on (options text, value), so
    neither a list is parsed nor searched per row.
    """
    d = option_dictionary(report)
    long = reshape.expand_responses(with_options(report, d))
    v = F.coalesce(F.col("response_value_single_value"), F.col("response_value_value"))
    return (
        d.match(long, F.col("item.raw_options"), v)
        .withColumnRenamed("_option", "item_response_options")
        .withColumn("item_option_name", F.col("item_response_options.name"))
        .withColumn("item_option_value", F.col("item_response_options.value"))
        .withColumn("item_option_score", F.col("item_response_options.score"))
    )


def users(report: DataFrame) -> DataFrame:
    """Distinct users of the four roles, with a ``user_type`` column: one scan, one distinct."""
    roles = [F.struct(F.lit(role).alias("user_type"), *[F.col(f"{role}.{f}").alias(f) for f in schema.USER_FIELDS])
             for role in schema.USER_ROLES]
    return report.select(F.explode(F.array(*roles)).alias("u")).select("u.*").distinct()


def role_users(report: DataFrame, role: str) -> DataFrame:
    if role not in schema.USER_ROLES:
        raise ValueError(f"role must be one of {schema.USER_ROLES}")
    return report.select(*[F.col(f"{role}.{f}").alias(f) for f in schema.USER_FIELDS]).distinct()


def long_data(report: DataFrame) -> DataFrame:
    """One row per atomic answer value; the items' options come from the option dictionary."""
    return reshape.expand_responses(with_options(report))


def preview(report: DataFrame, n: int = 5) -> DataFrame:
    return report.limit(n)


@dataclass(frozen=True)
class OutputType:
    name: str
    description: str
    default: bool
    produce: Callable[[DataFrame, dict[str, str], SparkSession], list[NamedOutput]]


def _flag(extra: dict[str, str], key: str) -> bool:
    return str(extra.get(key, "")).strip().lower() == "true"


def _wide(report, extra, spark):
    if _flag(extra, "split_activities"):
        return [NamedOutput(n, df) for n, df in wide_op.split_wide(report)]
    return [NamedOutput("wide_data", wide_op.wide(report))]


def _attendance(report, extra, spark):
    roster = read_participants(spark, extra.get("participants"))
    prefix = extra.get("daily_prefix", grids.DAILY_PREFIX)
    tz = extra.get("timezone") or None
    out: list[NamedOutput] = []
    flags = grids.activity_flags(report, tz)
    att = grids.attendance(report, roster, daily_prefix=prefix, tz=tz, flags=flags)
    if att is not None:
        out += [NamedOutput("attendance-all", att),
                NamedOutput("attendance-by_site_date", att, ["site", "activity_date"])]
    comp = grids.completion(report, roster, daily_prefix=prefix, tz=tz, flags=flags)
    if comp is not None:
        summary = grids.completion_summary(comp)
        out += [NamedOutput("completion-all", comp), NamedOutput("completion_summary-all", summary),
                NamedOutput("completion-by_site", comp, ["site"]),
                NamedOutput("completion_summary-by_site", summary, ["site"])]
    return out


CATALOGUE: dict[str, OutputType] = {
    t.name: t for t in [
        OutputType("report", "The normalised report itself.", False,
                   lambda r, e, s: [NamedOutput("report", with_options(r))]),
        OutputType("wide", "One row per submission, answer columns per item "
                   "(extra split_activities=true: one table per activity).", True, _wide),
        OutputType("long", "One row per atomic answer value.", True,
                   lambda r, e, s: [NamedOutput("long_data", long_data(r))]),
        OutputType("dictionary", "Distinct items with their context and options.", True,
                   lambda r, e, s: [NamedOutput("data_dictionary", data_dictionary(r))]),
        OutputType("options", "One row per item answer option.", True,
                   lambda r, e, s: [NamedOutput("options", options(r))]),
        OutputType("scored", "Answer values paired with the option (and score) they select.", False,
                   lambda r, e, s: [NamedOutput("scored_responses", scored_responses(r))]),
        OutputType("attendance", "Attendance (daily activities per date) and completion grids over a "
                   "participant roster (extra participants=<csv>, daily_prefix=...).", False, _attendance),
    ]
}


def available_outputs() -> dict[str, str]:
    return {k: v.description for k, v in CATALOGUE.items()}


def default_outputs() -> list[str]:
    return [k for k, v in CATALOGUE.items() if v.default]


def produce(name: str, report: DataFrame, extra: dict[str, str] | None = None) -> list[NamedOutput]:
    if name not in CATALOGUE:
        raise ValueError(f"no output is called {name!r}; there are {sorted(CATALOGUE)}")
    return CATALOGUE[name].produce(report, extra or {}, report.sparkSession)
