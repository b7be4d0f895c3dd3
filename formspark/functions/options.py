"""Answer-option list parser (item ``response_options``) as a native expression.

Accepted forms of the trimmed options text (all or nothing: any part that
does not fit makes the whole list null):

* range ``Min: a, Max: b`` or ``Max: b, Min: a`` -> every integer a..b with
  name = value = score (empty when a > b);
* scored list ``name: value (score: s), ...``;
* plain list ``name: value, ...`` (score null).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema

# --- Fixed values: option grammar, as Java regular expressions -------------
P_RANGE = r"^(Max|Min):[ \t]+([0-9]+),[ \t]+(Max|Min):[ \t]+([0-9]+)$"
_SCORED_ONE = r"([^:]+?)[ \t]*:[ \t]*([0-9]+)[ \t]+\(score:[ \t]*([+-]?[0-9]+)[ \t]*\)(?:,[ \t]*|$)"
_PLAIN_ONE = r"([^:]+?)[ \t]*:[ \t]*([0-9]+)(?:,[ \t]*|$)"
# Possessive repetition: the engine loops over elements instead of recursing, so lists of any
# length parse. An element never needs to give characters back to the next one.
P_SCORED = "^(?:" + _SCORED_ONE + ")++$"
P_PLAIN = "^(?:" + _PLAIN_ONE + ")++$"
# ---------------------------------------------------------------------------


def _range(s: Column) -> Column:
    w1 = F.regexp_extract(s, P_RANGE, 1)
    a = F.regexp_extract(s, P_RANGE, 2).try_cast("bigint")
    b = F.regexp_extract(s, P_RANGE, 4).try_cast("bigint")
    lo = F.when(w1 == "Min", a).otherwise(b)
    hi = F.when(w1 == "Min", b).otherwise(a)
    seq = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(
        seq, lambda n: F.struct(n.cast("string").alias("name"), n.alias("value"), n.alias("score"))
    )


def _listed(s: Column, one: str, scored: bool) -> Column:
    names = F.regexp_extract_all(s, F.lit(one), 1)
    values = F.regexp_extract_all(s, F.lit(one), 2)
    if scored:
        scores = F.regexp_extract_all(s, F.lit(one), 3)
        zipped = F.arrays_zip(names.alias("n"), values.alias("v"), scores.alias("s"))
        return F.transform(
            zipped,
            lambda x: F.struct(
                x["n"].alias("name"), x["v"].try_cast("bigint").alias("value"),
                x["s"].try_cast("bigint").alias("score"),
            ),
        )
    zipped = F.arrays_zip(names.alias("n"), values.alias("v"))
    return F.transform(
        zipped,
        lambda x: F.struct(
            x["n"].alias("name"), x["v"].try_cast("bigint").alias("value"),
            F.lit(None).cast("bigint").alias("score"),
        ),
    )


def classify_options(s: Column) -> Column:
    """'range' | 'scored' | 'plain' | null (not an option list)."""
    is_range = s.rlike(P_RANGE) & (F.regexp_extract(s, P_RANGE, 1) != F.regexp_extract(s, P_RANGE, 3))
    return (
        F.when(s.isNull() | (s == ""), F.lit(None).cast("string"))
        .when(is_range, F.lit("range"))
        .when(s.rlike(P_SCORED), F.lit("scored"))
        .when(s.rlike(P_PLAIN), F.lit("plain"))
    )


def build_options(kind: Column, s: Column) -> Column:
    return (
        F.when(kind == "range", _range(s))
        .when(kind == "scored", _listed(s, _SCORED_ONE, True))
        .when(kind == "plain", _listed(s, _PLAIN_ONE, False))
        .cast(schema.OPTIONS)
    )


def parse_options(s: Column) -> Column:
    """Options text (already trimmed) to ``array<struct<name,value,score>>`` or null."""
    return build_options(classify_options(s), s)
