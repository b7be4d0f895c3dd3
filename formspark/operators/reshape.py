"""Long reshapes of the report: options and answers exploded to rows.

Answers are exploded by narrow steps (Generate/Project). Options come from the option
dictionary, a join on the text's key, so each distinct text is parsed once and no row parses its
own. Explodes are ``*_outer`` so that a null or empty list keeps one row with nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.options import parse_options
from ..functions.scalars import strip_all
from .dictionary import OptionDictionary, attached, option_dictionary, restored
from .structs import unnest


def _each_option(df: DataFrame) -> DataFrame:
    return restored(df.select("*", F.explode_outer("_list").alias("item_response_options")), "_list")


def expand_options(df: DataFrame, dictionary: OptionDictionary | None = None) -> DataFrame:
    """One row per answer option of the row's item (``item_response_options`` struct)."""
    return _each_option(attached(df, dictionary or option_dictionary(df), "_list"))


def expand_responses(report: DataFrame) -> DataFrame:
    """One row per atomic answer value.

    Adds ``response_<field>`` for every response field,
    ``response_value_<field>`` for every value field, explodes the value list
    with its 0-based index (``response_value_value`` / ``_value_index``), splits
    the geo pair into ``response_value_geo_latitude/_longitude``, explodes
    matrix rows and then each row's values with their index
    (``response_value_matrix_row``, ``_matrix_value``, ``_matrix_value_index``).
    The ``response`` and ``response_value`` structs stay.
    """
    df = report.select("*", *unnest(report, "response"))
    df = df.select("*", *[c for c in unnest(df, "response_value")])
    df = (
        df.withColumnRenamed("response_value_value", "_vals")
        .select("*", F.posexplode_outer("_vals").alias("response_value_value_index", "response_value_value"))
        .drop("_vals")
        .withColumn("response_value_geo_latitude", F.col("response_value_geo.latitude"))
        .withColumn("response_value_geo_longitude", F.col("response_value_geo.longitude"))
        .select("*", F.explode_outer("response_value_matrix").alias("_mrow"))
        .withColumn("response_value_matrix_row", F.col("_mrow.row"))
        .select("*", F.posexplode_outer("_mrow.value").alias("response_value_matrix_value_index",
                                                             "response_value_matrix_value"))
        .drop("_mrow", "response_value_matrix", "response_value_geo")
    )
    return df


def long_options_report(report: DataFrame) -> DataFrame:
    return expand_options(report)


def long_response_report(report: DataFrame) -> DataFrame:
    return expand_responses(report)


def long_report(report: DataFrame) -> DataFrame:
    """Every atomic answer value times every option of its item."""
    return _each_option(expand_responses(attached(report, option_dictionary(report), "_list")))


def item_response_options(report: DataFrame) -> DataFrame:
    """Distinct option rows keyed by the struct columns (the single-select score table).

    Columns: applet_version, activity_flow, activity, item,
    item_option_name, item_option_value, item_option_score.  Distinct items
    are found first (partial aggregation map-side) and their options parsed
    afterwards, so option texts are parsed once per distinct item. Rows of two items
    differ in the item, so equal options can only be in one list and are dropped there.
    """
    fields = [f for f in report.schema["item"].dataType.fieldNames() if f != "response_options"]
    lite = F.struct(*[F.col(f"item.{f}").alias(f) for f in fields]).alias("_item")
    items = report.select("applet_version", "activity_flow", "activity", lite).distinct()
    parsed = parse_options(strip_all(F.col("_item.raw_options")))
    item = F.struct(*[F.col(f"_item.{f}").alias(f) for f in fields], parsed.alias("response_options"))
    each = F.array_distinct(F.transform("item.response_options", lambda o: F.struct(o["name"], o["value"], o["score"])))
    return (
        items.select("applet_version", "activity_flow", "activity", item.alias("item"))
        .select("applet_version", "activity_flow", "activity", "item",
                F.explode_outer(each).alias("_o"))
        .select("applet_version", "activity_flow", "activity", "item",
                F.col("_o.name").alias("item_option_name"),
                F.col("_o.value").alias("item_option_value"),
                F.col("_o.score").alias("item_option_score"))
    )
