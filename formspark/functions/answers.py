"""Answer-text parsers as native column expressions.

Every parser maps a trimmed answer string to the 14-field ``response.value``
struct (``schema.RESPONSE_VALUE``); fields a form does not set are null.
Parsing is two-step so the expensive regex classification runs once per row:

* ``classify_*`` returns a short *kind* string (which form matched), or null
  when nothing matched;
* ``build_value(kind, text)`` extracts the fields for that kind.

``normalize`` materialises the kind as its own column first; Catalyst keeps
that projection separate because the kind is referenced many times.
``parse_full`` / ``parse_typed`` compose both steps into one expression for
ad-hoc column use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema
from .scalars import null_if_empty

# --- Fixed values: answer grammar, as Java regular expressions -------------
# Building blocks: W = inline whitespace, V = value token, TM = "hr H min M"
# with optional parentheses and comma, FL = signed float that needs a decimal
# point or an exponent, OT = optional " | text: ..." suffix (multi-line).
# Repeated groups are possessive (``*+``, ``++``): the engine loops over them instead of
# recursing, so lists and matrices of any length parse.
_W = r"[ \t]+"
_V = r"[.\w]+"
_VL = _V + r"(?:,[ \t]+" + _V + r")*+"
_TM = r"\(?hr[ \t]+([0-9]{1,2}),?[ \t]+min[ \t]+([0-9]{1,2})\)?"
_FL = r"([+-]?(?:[0-9]+\.[0-9]*|\.[0-9]+|[0-9]+(?=[eE]))(?:[eE][+-]?[0-9]+)?)"
_OT = r"(?:[ \t]+\| text:[ \t]+((?s:.+)))?$"

NULL_ANSWER = "value: null"
P_TEXT = r"(?s)^text:" + _W + r"(.+)$"
P_VALUES = r"(?U)^value:" + _W + "(" + _VL + ")" + _OT
P_DATE = r"^date:" + _W + r"([0-9]{1,2})/([0-9]{1,2})/([0-9]{4}|[0-9]{2})" + _OT
P_TIME = r"^time:" + _W + _TM + _OT
P_TIME_RANGE = r"^time_range:" + _W + "from" + _W + _TM + _W + "/" + _W + "to" + _W + _TM + _OT
P_GEO = r"^geo:" + _W + "lat" + _W + r"\(?" + _FL + r"\)?" + r"[ \t]+/?[ \t]*long" + _W + r"\(?" + _FL + r"\)?" + _OT
P_MATRIX = r"(?U)^(?:" + _V + r":[ \t]*" + _VL + r"(?:(?:\r?\n)++|$))++$"
P_EXTENSION = r"(?U)\.\w{3,4}$"
# Typed forms: single select takes one integer, multi select integers only.
P_SINGLE = r"^value:" + _W + r"([0-9]+)" + _OT
P_MULTI = r"^value:" + _W + r"([0-9]+(?:,[ \t]+[0-9]+)*+)" + _OT
P_NUMBER = r"^[ \t]*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[ \t]*$"
# Two-digit years below the pivot get 2000 added, the others up to 99 get 1900.
PIVOT_YEAR = 69
# ---------------------------------------------------------------------------

# Kinds produced by the full parser, in priority order.
FULL_KINDS = ("null_value", "text", "value", "date", "time", "time_range", "geo", "matrix", "file", "raw_value")


def _lit_null(dtype) -> Column:
    return F.lit(None).cast(dtype)


def _form(s: Column, start: str, pattern: str) -> Column:
    """``s`` fits ``pattern``, whose matches begin with ``start``; other answers are told apart without a regular expression."""
    return F.startswith(s, F.lit(start)) & s.rlike(pattern)


def is_file(s: Column) -> Column:
    """One line with a ``-`` or ``/`` inside and an extension of 3 or 4 word characters; linear in its length."""
    extension = F.regexp_extract(s, P_EXTENSION, 0)
    n = F.length(s) - F.length(extension)
    inside = F.substring(s, F.lit(2), n - 2)
    return (extension != "") & (n > 2) & ~F.contains(F.substring(s, F.lit(1), n), F.lit("\n")) & inside.rlike("[-/]")


def classify_full(s: Column) -> Column:
    """Kind of an answer under the untyped grammar (forms in priority order)."""
    return (
        F.when(s.isNull() | (s == ""), _lit_null("string"))
        .when(s == NULL_ANSWER, F.lit("null_value"))
        .when(_form(s, "text:", P_TEXT), F.lit("text"))
        .when(_form(s, "value:", P_VALUES), F.lit("value"))
        .when(_form(s, "date:", P_DATE), F.lit("date"))
        .when(_form(s, "time:", P_TIME), F.lit("time"))
        .when(_form(s, "time_range:", P_TIME_RANGE), F.lit("time_range"))
        .when(_form(s, "geo:", P_GEO), F.lit("geo"))
        .when(F.contains(s, F.lit(":")) & s.rlike(P_MATRIX), F.lit("matrix"))
        .when(F.contains(s, F.lit(".")) & is_file(s), F.lit("file"))
        .otherwise(F.lit("raw_value"))
    )


def classify_single_select(s: Column) -> Column:
    return F.when(s == NULL_ANSWER, F.lit("ss_null")).when(s.rlike(P_SINGLE), F.lit("ss_value"))


def classify_multi_select(s: Column) -> Column:
    return F.when(s == NULL_ANSWER, F.lit("null_value")).when(s.rlike(P_MULTI), F.lit("ms_value"))


def classify_text(s: Column) -> Column:
    # The text parser takes the whole string; a null answer stays a text answer.
    return F.lit("text_plain")


def classify_subscale(s: Column) -> Column:
    return F.when(s.rlike(P_NUMBER), F.lit("subscale"))


def classify_date(s: Column) -> Column:
    return F.when(s.rlike(P_DATE), F.lit("date"))


def classify_geo(s: Column) -> Column:
    return F.when(s.rlike(P_GEO), F.lit("geo"))


_TYPED = {
    schema.SINGLE_SELECT: classify_single_select,
    schema.MULTI_SELECT: classify_multi_select,
    schema.TEXT: classify_text,
    schema.SUBSCALE: classify_subscale,
    schema.DATE: classify_date,
    schema.GEOLOCATION: classify_geo,
}


def classify_typed(item_type: Column, s: Column) -> Column:
    """Kind of an answer under the parser chosen by item type.

    Types with their own parser: singleSelect, multiSelect, text, subscale,
    date, geolocation; every other known label uses the full grammar.  An
    unknown or null type label classifies as ``unknown_type``.
    """
    known = item_type.isin(*schema.ITEM_TYPES)
    expr = F.when(~known | item_type.isNull(), F.lit("unknown_type"))
    for label, fn in _TYPED.items():
        expr = expr.when(item_type == label, fn(s))
    return expr.otherwise(classify_full(s))


def _ot(s: Column, pattern: str, group: int) -> Column:
    return F.when(F.contains(s, F.lit("| text:")), null_if_empty(F.regexp_extract(s, pattern, group)))


def _valid_hm(h: Column, m: Column) -> Column:
    return (h <= 23) & (m <= 59)


def _time_text(h: Column, m: Column) -> Column:
    return F.when(
        _valid_hm(h, m),
        F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":"), F.lpad(m.cast("string"), 2, "0"), F.lit(":00")),
    )


def numbers(kind: Column, s: Column) -> Column:
    """The runs of digits of a date, time or time range, without those of its optional text, in their order."""
    return F.when(kind.isin("date", "time", "time_range"), F.regexp_extract_all(F.substring_index(s, "|", 1), F.lit("[0-9]+"), F.lit(0)))


def _date_value(n: Column) -> Column:
    day = F.get(n, 0)
    month = F.get(n, 1)
    yr = F.get(n, 2).cast("int")
    year = (
        F.when(yr < PIVOT_YEAR, yr + 2000).when(yr <= 99, yr + 1900).otherwise(yr)
    )
    text = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), month, day)
    return F.try_to_date(text, "y-M-d")


def _geo_value(s: Column, pattern: str) -> Column:
    return F.struct(
        F.regexp_extract(s, pattern, 1).cast("double").alias("latitude"),
        F.regexp_extract(s, pattern, 2).cast("double").alias("longitude"),
    )


def _time_range_value(n: Column) -> Column:
    h1, m1, h2, m2 = (F.get(n, i).cast("int") for i in range(4))
    # No wrap at midnight: an earlier "to" gives a negative duration.
    return F.when(
        _valid_hm(h1, m1) & _valid_hm(h2, m2),
        F.make_dt_interval(F.lit(0), h2 - h1, m2 - m1, F.lit(0)),
    )


def _matrix_value(s: Column) -> Column:
    # A matrix has carriage returns only before line feeds, one colon a line, and blanks only after colons and commas;
    # separators of one character are split without a regular expression.
    lines = F.filter(F.split(F.translate(s, "\r", ""), "\n"), lambda x: x != "")
    return F.transform(
        lines,
        lambda x: F.struct(
            F.substring_index(x, ":", 1).alias("row"),
            F.split(F.translate(F.substring_index(x, ":", -1), " \t", ""), ",").alias("value"),
        ),
    )


def _int_list(tokens: Column) -> Column:
    # Tokens that are not integers become null elements (the text stays in raw_response); blanks around a number are no part of it.
    return F.split(tokens, ",").try_cast("array<bigint>")


def value_fields(kind: Column, s: Column, digits: Column | None = None) -> list[tuple[str, Column]]:
    """(field name, expression) of the ``response.value`` struct for an answer of known kind.

    ``digits`` is a column of :func:`numbers`, where there is one; it is read several times.
    """
    k = kind
    n = numbers(k, s) if digits is None else digits

    def on(*kinds: str) -> Column:
        return k.isin(*kinds)

    type_ = (
        F.when(on("ss_null", "ss_value", "unknown_type"), _lit_null("string"))
        .when(k == "text_plain", F.lit("text"))
        .when(k == "ms_value", F.lit("value"))
        .otherwise(k)
    )
    optional_text = (
        F.when(k == "value", _ot(s, P_VALUES, 2))
        .when(k == "ms_value", _ot(s, P_MULTI, 2))
        .when(k == "ss_value", _ot(s, P_SINGLE, 2))
        .when(k == "date", _ot(s, P_DATE, 4))
        .when(k == "time", _ot(s, P_TIME, 3))
        .when(k == "time_range", _ot(s, P_TIME_RANGE, 5))
        .when(k == "geo", _ot(s, P_GEO, 3))
    )
    return [
        ("type", type_),
        ("raw_value", F.when(k == "raw_value", s)),
        ("null_value", F.when(on("null_value", "ss_null"), F.lit(True))),
        ("single_value", F.when(k == "ss_value", F.regexp_extract(s, P_SINGLE, 1).try_cast("bigint"))),
        ("value", F.when(k == "value", _int_list(F.regexp_extract(s, P_VALUES, 1)))
         .when(k == "ms_value", _int_list(F.regexp_extract(s, P_MULTI, 1)))),
        ("text", F.when(k == "text", F.regexp_extract(s, P_TEXT, 1)).when(k == "text_plain", s)),
        ("file", F.when(k == "file", s)),
        ("date", F.when(k == "date", _date_value(n))),
        ("time", F.when(k == "time", _time_text(F.get(n, 0).cast("int"), F.get(n, 1).cast("int")))),
        ("time_range", F.when(k == "time_range", _time_range_value(n))),
        ("geo", F.when(k == "geo", _geo_value(s, P_GEO))),
        ("matrix", F.when(k == "matrix", _matrix_value(s))),
        ("optional_text", optional_text),
        ("subscale", F.when(k == "subscale", s.try_cast("double"))),
    ]


def is_parsed(kind: Column) -> Column:
    """The value struct is null for unparsable answers and unknown item types."""
    return kind.isNotNull() & (kind != "unknown_type")


def build_value(kind: Column, s: Column) -> Column:
    """The ``response.value`` struct for an answer whose kind is known."""
    value = F.struct(*[e.alias(n) for n, e in value_fields(kind, s)])
    # No struct-level cast: every field already has its schema type, and a
    # Cast around the struct would stop Catalyst from pruning unread fields
    # (a query reading ``value.text`` would still run every field's regex).
    return F.when(is_parsed(kind), value)


def parse_error(kind: Column, s: Column) -> Column:
    """True when a non-null answer could not be parsed or its item type label is unknown."""
    return F.coalesce(kind == "unknown_type", F.lit(False)) | (kind.isNull() & s.isNotNull())


def fail_on_error(kind: Column, s: Column, item_type: Column, value: Column) -> Column:
    """Wrap ``value`` so that an unparsable answer or unknown item type aborts the job."""
    return (
        F.when(kind == "unknown_type",
               F.raise_error(F.concat(F.lit("unknown item type: "), F.coalesce(item_type, F.lit("null")))))
        .when(kind.isNull() & s.isNotNull(),
              F.raise_error(F.concat(F.lit("cannot parse answer of type "),
                                     F.coalesce(item_type, F.lit("null")), F.lit(": "), s)))
        .otherwise(value)
    )


def parse_full(s: Column) -> Column:
    """Untyped parse (every form of the grammar)."""
    return build_value(classify_full(s), s)


def parse_typed(item_type: Column, s: Column) -> Column:
    """Parse with the parser chosen by item type (null for unparsable input)."""
    return build_value(classify_typed(item_type, s), s)


def parse_single_select(s: Column) -> Column:
    return build_value(classify_single_select(s), s)


def parse_multi_select(s: Column) -> Column:
    return build_value(classify_multi_select(s), s)


def parse_text(s: Column) -> Column:
    return build_value(classify_text(s), s)


def parse_subscale(s: Column) -> Column:
    return build_value(classify_subscale(s), s)


def parse_date(s: Column) -> Column:
    return build_value(classify_date(s), s)


def parse_geo(s: Column) -> Column:
    return build_value(classify_geo(s), s)


def selection(field: str):
    """A parser returning one field of the full parse (e.g. ``selection('date')``)."""

    def _parser(s: Column) -> Column:
        return parse_full(s).getField(field)

    return _parser
