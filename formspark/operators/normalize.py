"""Normalisation of a raw export frame (all STRING columns) into the nested report.

Steps, in order (each a ``DataFrame -> DataFrame`` usable with ``transform``):

1. ``drop_legacy_user_id``          drop ``legacy_user_id`` if present
2. ``check_raw_score``              ``rawScore`` must exist
3. ``unpivot_subscales``            subscale columns -> extra response rows
4. ``parse_times``                  ``*_time`` epoch ms -> timestamp; offset minutes -> interval
5. ``nest_users``                   target/source/input/account user structs
6. ``nest_item``                    item struct with parsed answer options
7. ``nest_activity_flow``
8. ``nest_activity``                activity, activity_submission, activity_time
9. ``nest_activity_schedule``
10. ``nest_response``               response struct, answer parsed by item type

(``normalize`` runs step 10 right after step 4, from the raw ``item_type``
column, and assembles the structs last; the output columns are in the order
above.)

Everything is a narrow transformation (projections and one Generate for
the subscale unpivot): no shuffle, no Python worker, one scan of the input.  Columns the steps do not
consume pass through untouched.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions import answers, options
from ..functions.scalars import epoch_ms_to_timestamp, minutes_to_interval, strip_all
from ..session import ensure_checkpoint_dir, scratch_path

# Subscale columns of the export and the prefix removed from
# their names when they become items.
SUBSCALE_PREFIX = "subscale_"
SUBSCALE_NAME_PREFIX = "subscale_name_"
SUBSCALE_EXTRA = ("activity_score", "activity_score_lookup_text")

ON_ERROR = ("null", "fail")


def _col_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(dtype)


def drop_legacy_user_id(df: DataFrame) -> DataFrame:
    return df.drop("legacy_user_id")


def check_raw_score(df: DataFrame) -> DataFrame:
    if "rawScore" not in df.columns:
        raise ValueError("export has no rawScore column")
    return df.withColumn("rawScore", F.col("rawScore").cast("string"))


def subscale_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if c.startswith(SUBSCALE_PREFIX) or c in SUBSCALE_EXTRA]


def unpivot_subscales(df: DataFrame) -> DataFrame:
    """One extra response row per input row and non-null subscale column.

    ``item_id`` = column name, ``item_name`` = name without the first
    ``subscale_name_``, ``item_type`` = 'subscale', status 'completed'.  The
    index is every column except subscale, item and response columns.  No-op
    when there is no subscale column.

    Done as one ``Generate`` per input row instead of a union of two scans of the input. It
    makes numbers only (0 for the row itself, i for the i-th subscale column that is not null); the
    fields are chosen by the number afterwards, so a field that nobody reads is not computed.
    """
    subs = subscale_columns(df.columns)
    if not subs:
        return df
    consumed = set(subs) | set(schema.ITEM_COLUMNS) | set(schema.RESPONSE_COLUMNS)
    index = [c for c in df.columns if c not in consumed]
    carried = [c for c in df.columns if c in set(schema.ITEM_COLUMNS) | set(schema.RESPONSE_COLUMNS)]
    fields = list(dict.fromkeys(carried + ["item_id", "item_name", "item_type", "item_response",
                                           "item_response_status"]))
    text = [F.col(f"`{c}`").cast("string") for c in subs]
    which = F.col("_sub")

    def each(values: list[Column]) -> Column:
        out = F.when(which == 1, values[0])
        for i, v in enumerate(values[1:], 2):
            out = out.when(which == i, v)
        return out

    extra = {
        "item_id": each([F.lit(c) for c in subs]),
        "item_name": each([F.lit(re.sub("^(.*?)" + SUBSCALE_NAME_PREFIX, r"\1", c, count=1)) for c in subs]),
        "item_type": F.lit(schema.SUBSCALE),
        "item_response": each(text),
        "item_response_status": F.lit("completed"),
    }
    null = F.lit(None).cast("string")
    rows = F.array_remove(F.array(F.lit(0), *[F.when(t.isNotNull(), F.lit(i)).otherwise(F.lit(-1)) for i, t in enumerate(text, 1)]), -1)
    # The expressions read columns of the input, so they are above the Generate, where unread ones are dropped.
    return df.select("*", F.explode(rows).alias("_sub")).select(
        *[F.col(f"`{c}`") for c in index],
        *[F.when(which == 0, F.col(f"`{f}`") if f in carried else null).otherwise(extra.get(f, null)).alias(f) for f in fields])


def parse_times(df: DataFrame) -> DataFrame:
    """Every ``*_time`` column: lenient epoch ms -> timestamp; offset minutes -> interval."""
    cols = {c: epoch_ms_to_timestamp(F.col(f"`{c}`")) for c in df.columns if c.endswith("_time")}
    if "utc_timezone_offset" in df.columns:
        cols["utc_timezone_offset"] = minutes_to_interval(F.col("utc_timezone_offset"))
    return df.withColumns(cols) if cols else df


def _user_struct(df: DataFrame, fields: dict[str, str]) -> Column:
    return F.struct(*[_col_or_null(df, fields[f]).alias(f) if f in fields else
                      F.lit(None).cast("string").alias(f) for f in schema.USER_FIELDS])


def nest_users(df: DataFrame) -> DataFrame:
    cols = {}
    for role in ("target", "source", "input"):
        prefix = f"{role}_"
        present = {c[len(prefix):]: c for c in df.columns if c.startswith(prefix)}
        cols[f"{role}_user"] = _user_struct(df, {f: present[f] for f in schema.USER_FIELDS if f in present})
    cols["account_user"] = _user_struct(df, {"id": "userId", "secret_id": "secret_user_id"})
    drop = [c for c in df.columns
            if (c.startswith(("target_", "source_", "input_")) and not c.split("_", 1)[1].startswith("u"))
            or c in ("userId", "secret_user_id")]
    return df.withColumns(cols).drop(*drop)


def nest_item(df: DataFrame) -> DataFrame:
    """``item`` struct with the parsed option list.

    The options text is classified once in its own projection (like the
    answers) and the option list is computed as a top-level column before the
    struct is assembled from plain column references.  Assembly is then cheap
    enough for Catalyst to inline into consumers, so a query that reads only
    ``item.name`` never parses options.
    """
    raw = _col_or_null(df, "item_response_options")
    staged = (df.withColumn("_opts_text", strip_all(raw))
              .withColumn("_opts_kind", options.classify_options(F.col("_opts_text")))
              .withColumn("_opts", options.build_options(F.col("_opts_kind"), F.col("_opts_text"))))
    item = F.struct(
        _col_or_null(df, "item_id").alias("id"),
        _col_or_null(df, "item_name").alias("name"),
        _col_or_null(df, "item_prompt").alias("prompt"),
        _col_or_null(df, "item_type").alias("type"),
        raw.alias("raw_options"),
        F.col("_opts").alias("response_options"),
    )
    return staged.withColumn("item", item).drop("_opts_text", "_opts_kind", "_opts", *schema.ITEM_COLUMNS)


def _nest(df: DataFrame, name: str, fields: dict[str, str], dtypes: dict[str, str] | None = None) -> DataFrame:
    dtypes = dtypes or {}
    st = F.struct(*[_col_or_null(df, src, dtypes.get(f, "string")).alias(f) for f, src in fields.items()])
    return df.withColumn(name, st).drop(*fields.values())


def nest_activity_flow(df: DataFrame) -> DataFrame:
    return _nest(df, "activity_flow", {
        "id": "activity_flow_id", "name": "activity_flow_name", "submission_id": "activity_flow_submission_id",
    })


def nest_activity(df: DataFrame) -> DataFrame:
    df = _nest(df, "activity", {"id": "activity_id", "name": "activity_name"})
    df = _nest(df, "activity_submission", {"id": "activity_submission_id", "review_id": "activity_submission_review_id"})
    return _nest(df, "activity_time", {"start_time": "activity_start_time", "end_time": "activity_end_time"},
                 {"start_time": "timestamp", "end_time": "timestamp"})


def nest_activity_schedule(df: DataFrame) -> DataFrame:
    return _nest(df, "activity_schedule", {
        "id": "activity_schedule_id", "history_id": "activity_schedule_history_id",
        "start_time": "activity_schedule_start_time",
    }, {"start_time": "timestamp"})


def nest_response(df: DataFrame, on_error: str = "null", typed: bool = True) -> DataFrame:
    """``response{status, raw_score, raw_response, value}``; value parsed by item type.

    The answer kind is materialised in its own projection first so the regex
    classification runs once per row.  ``on_error='fail'`` aborts on an
    unparsable answer, an unknown item type or a non-integer ``rawScore``;
    ``'null'`` leaves the value null (the raw text stays in ``raw_response``).
    ``typed=False`` uses the untyped grammar for every item.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    text = strip_all(_col_or_null(df, "item_response"))
    # Before ``nest_item`` the type is the raw column; classifying from it keeps
    # the (cheap) item struct assembly above this projection.
    item_type = (F.col("item_type") if "item_type" in df.columns
                 else F.col("item.type") if "item" in df.columns else F.lit(None).cast("string"))
    kind = answers.classify_typed(item_type, F.col("_answer")) if typed else answers.classify_full(F.col("_answer"))
    staged = df.withColumn("_answer", text).withColumn("_kind", kind).withColumn("_digits", answers.numbers(F.col("_kind"), F.col("_answer")))
    # Each value field is its own top-level column; the struct below is just
    # column references, so consumers reading a few fields prune the rest.
    fields = answers.value_fields(F.col("_kind"), F.col("_answer"), F.col("_digits"))
    staged = staged.select("*", *[e.alias(f"_v_{n}") for n, e in fields])
    value = F.when(answers.is_parsed(F.col("_kind")), F.struct(*[F.col(f"_v_{n}").alias(n) for n, _ in fields]))
    raw_score = _col_or_null(df, "rawScore")
    if on_error == "fail":
        value = answers.fail_on_error(F.col("_kind"), F.col("_answer"), item_type, value)
        raw_score = raw_score.cast("bigint")
    else:
        raw_score = raw_score.try_cast("bigint")
    response = F.struct(
        _col_or_null(df, "item_response_status").alias("status"),
        raw_score.alias("raw_score"),
        _col_or_null(df, "item_response").alias("raw_response"),
        value.alias("value"),
    )
    return staged.withColumn("response", response).drop(
        "_answer", "_kind", "_digits", *[f"_v_{n}" for n, _ in fields], *schema.RESPONSE_COLUMNS)


def dedupe_subscale_rows(df: DataFrame) -> DataFrame:
    """Keep one copy of identical subscale rows (a subscale value repeated on
    every answer row of a submission unpivots into identical rows).

    The input is read and unpivoted once: the rows are written to the shared scratch folder,
    answers and subscales in a folder each, and read back from their own. Only subscale rows, a few narrow
    columns, are shuffled, and their copies are combined in the map tasks; answer rows pass through.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, "unpivoted")
    is_sub = F.coalesce(F.col("item_type") == F.lit(schema.SUBSCALE), F.lit(False))
    marked = df.withColumn("_subscale", is_sub)
    marked.write.partitionBy("_subscale").parquet(path)
    back = spark.read.schema(marked.schema).parquet(path)
    part = lambda sub: back.where(F.col("_subscale") == F.lit(sub)).drop("_subscale")
    return part(False).unionByName(part(True).distinct())


def normalize(raw: DataFrame, *, on_error: str = "null", typed: bool = True,
              dedupe_subscales: bool = False) -> DataFrame:
    """Raw export frame -> nested report (see module docstring for the steps).

    ``dedupe_subscales=True`` drops repeated identical subscale rows (by
    default every non-null subscale cell becomes a row, as in the export); it writes the unpivoted
    rows once (:func:`dedupe_subscale_rows`).
    """
    unpivoted = raw.transform(drop_legacy_user_id).transform(check_raw_score).transform(unpivot_subscales)
    if dedupe_subscales and subscale_columns(raw.columns):
        unpivoted = dedupe_subscale_rows(unpivoted)
    # Answers are parsed first (their per-field columns computed in their own
    # projections); the structs are assembled last from plain column
    # references, so Catalyst can inline them into consumers and prune every
    # field a query does not read.
    out = (
        unpivoted
        .transform(parse_times)
        .transform(nest_response, on_error=on_error, typed=typed)
        .transform(nest_users)
        .transform(nest_item)
        .transform(nest_activity_flow)
        .transform(nest_activity)
        .transform(nest_activity_schedule)
    )
    structs = list(schema.USER_ROLES) + ["item", "activity_flow", "activity", "activity_submission",
                                         "activity_time", "activity_schedule", "response"]
    rest = [c for c in out.columns if c not in structs]
    return out.select(*[F.col(f"`{c}`") for c in rest + structs])
