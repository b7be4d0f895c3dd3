"""The wide table: one row per submission, answer columns per item.

Column rules by item type:

* ``multiSelect`` item ``n``: one BOOLEAN ``n_<value>`` per option value seen
  for ``n`` (true/false = option chosen or not; null = item not answered in
  that submission, or the answer is null, or the row's own item lacks that
  option);
* ``singleSelect`` item ``n``: ``n__index`` (chosen value), ``n__response``
  (chosen option's name), ``n`` (chosen option's score; the option name
  instead when none of the options chosen for the item in the table has a score);
* ``subscale`` item ``n``: ``response_value__n`` and ``response_response__n``
  (DOUBLE, both the subscale value);
* every other type: ``response_value__n`` and ``response_response__n`` with
  the answer's ``text`` field (null for answers that carry no text).

Row grain: every distinct combination of the non-answer columns (applet
version, offset, users, flow, activity, submission, times, schedule and any
pass-through column), null-safe.

Column names that differ only in case, which Spark cannot tell apart, get the
suffix ``__2``, ``__3`` ... in the order of the names.

Physical plan:

1. One scan finds the items: distinct (item, options text, chosen value), written as a small table. The
   option dictionary parses each distinct text of it once; one row for each item comes to the driver.
2. Answer rows get their options from the dictionary by a join (no row parses a text) and are
   aggregated by submission into a map from item code to answer. A submission is known by a 128-bit hash of its index
   columns, so keys are two integers. With ``on_duplicate='first'`` a level before, by (submission, item), finds the smallest answer; it combines in the
   map tasks, so an item answered any number of times costs one row of each task; answers are sorted and shuffled
   without the index columns, which are made distinct in a scan of their own and joined to the maps. With ``'fail'``, where every (submission,
   item) has one answer or the job fails, rows are dealt by submission once, ``ANSWERS_A_TASK`` of them to a task, and collected
   there; the job fails when a submission's collected answers name an item twice.
3. The columns are read from the map: work per answer row does not depend on the number of columns, and
   there is no limit on it. The duplicate check is a filter, so no projection removes it.

``split_wide`` writes the maps once, partitioned by activity; each activity's table reads its own folder.
With ``all_types=True`` non-text items also get typed columns.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..functions.scalars import interval_ms, iso_of_ms
from ..session import ensure_checkpoint_dir, scratch_path
from .dictionary import OptionDictionary, option_dictionary
from .structs import column, column_order, distinct_names, field_names

# Types pivoted by their own rule; every other type uses the text rule.
_OWN_RULE = (schema.MULTI_SELECT, schema.SINGLE_SELECT, schema.SUBSCALE)

# all_types=True: extra wide columns per answer form seen for a text-rule item
# (form -> [(column suffix, field of response.value)]).
TYPED_FIELDS: dict[str, list[tuple[str, str]]] = {
    "value": [("value", "value")],
    "date": [("date", "date")],
    "time": [("time", "time")],
    "time_range": [("time_range", "time_range")],
    "geo": [("latitude", "geo.latitude"), ("longitude", "geo.longitude")],
    "matrix": [("matrix", "matrix")],
    "file": [("file", "file")],
    "raw_value": [("raw_value", "raw_value")],
    "optional_text": [("optional_text", "optional_text")],
}


#: Answer rows that a task of the aggregation gets, about; their index columns compress too well for a size in bytes to tell.
ANSWERS_A_TASK = 500_000


@dataclass
class WideLayout:
    """The items of a wide table (one entry for each item, never for answers)."""

    multi: dict[str, list[int]] = field(default_factory=dict)   # item -> option values
    single: dict[str, bool] = field(default_factory=dict)        # item -> a chosen option has a score?
    subscale: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    typed: dict[str, list[str]] = field(default_factory=dict)  # all_types: item -> answer forms
    codes: dict[tuple[str, str], int] = field(default_factory=dict)  # (rule, item) -> map key
    dictionary: OptionDictionary | None = None                   # options of the select items
    rows: int | None = None                                      # answer rows of the report


def _rule(t: Column) -> Column:
    return F.when(t.isin(*_OWN_RULE), t).otherwise(F.lit(schema.TEXT))


def _code(rule: Column, name: Column) -> Column:
    return F.xxhash64(rule, name)


def _null_mask(cols: list[Column]) -> list[Column]:
    """Integers that tell which of ``cols`` are null (hashes skip nulls)."""
    masks = []
    for i in range(0, len(cols), 60):
        bits = [F.when(c.isNull(), F.lit(1 << j)).otherwise(F.lit(0)) for j, c in enumerate(cols[i:i + 60])]
        masks.append(reduce(lambda a, b: a + b, bits).cast("bigint"))
    return masks


def _activity_code(*parts: Column) -> Column:
    return F.concat(F.lit("a"), F.hex(F.xxhash64(*parts, *_null_mask(list(parts)))))


def _submission_key(report: DataFrame, index: list[str]) -> list[Column]:
    """128 bits that stand for one combination of the index columns, nulls included."""
    leaves: list[Column] = []
    for c in index:
        leaves += [column(c, f) for f in field_names(report, c)] if isinstance(report.schema[c].dataType, T.StructType) else [column(c)]
    structs = [column(c) for c in index if isinstance(report.schema[c].dataType, T.StructType)]
    parts = leaves + _null_mask(leaves + structs)
    return [F.xxhash64(*parts).alias("_h1"), F.xxhash64(F.lit(1), *parts).alias("_h2")]


def _layout_rows(report: DataFrame, *, by_activity: bool, all_types: bool = False) -> tuple[list, OptionDictionary, int]:
    """One row for each item [and activity]: its option values, whether a chosen option has a score, answer
    forms; the dictionary of the select items' options; and the number of rows. One scan of the report."""
    rule, act = _rule(F.col("item.type")), ["act_id", "act_name", "act_code"] if by_activity else []
    select = rule.isin(schema.MULTI_SELECT, schema.SINGLE_SELECT)
    cols = [rule.alias("rule"), F.col("item.name").alias("name"), F.when(select, F.col("item.raw_options")).alias("text"),
            F.when(rule == schema.SINGLE_SELECT, F.col("response.value.single_value")).alias("chosen")]
    if by_activity:
        cols += [F.col("activity.id").alias("act_id"), F.col("activity.name").alias("act_name")]
    if all_types:
        other = F.coalesce(F.col("item.type") != schema.TEXT, F.lit(False))
        cols += [F.when(other, F.col("response.value.type")).alias("form"),
                 (other & F.col("response.value.optional_text").isNotNull()).alias("with_text")]
    answers = Observation()
    found_items = report.select(*cols).observe(answers, F.count(F.lit(1)).alias("n")).where(F.col("name").isNotNull()).distinct()
    if by_activity:  # of distinct rows, as it is a text that only the id and the name make
        found_items = found_items.withColumn("act_code", _activity_code(F.col("act_id"), F.col("act_name")))
    ensure_checkpoint_dir(report.sparkSession)
    path = scratch_path(report.sparkSession, "items")
    found_items.write.parquet(path)
    seen = report.sparkSession.read.schema(found_items.schema).parquet(path)
    dictionary = option_dictionary(seen, F.col("text"))
    opts = F.filter("opts", lambda o: o["value"].isNotNull())
    entries = F.array_distinct(F.transform(opts, lambda o: F.struct(o["value"], o["name"], o["score"])))
    values = F.array_distinct(F.transform(opts, lambda o: o["value"]))
    single = F.col("rule") == schema.SINGLE_SELECT
    found = F.exists(opts, lambda o: (o["value"] == F.col("chosen")) & o["score"].isNotNull())
    parsed = dictionary.join(seen, F.col("text"), "opts").select(
        "*", F.when(F.col("rule") == schema.MULTI_SELECT, values).alias("values"),
        F.coalesce(single & found, F.lit(False)).alias("found"),
        F.coalesce(single & (F.size(entries) > F.size(values)), F.lit(False)).alias("bad"))
    aggs = [F.array_sort(F.array_distinct(F.flatten(F.collect_list("values")))).alias("values"),
            F.max("found").alias("scored"), F.max("bad").alias("bad")]
    if all_types:
        aggs += [F.collect_set("form").alias("forms"), F.max("with_text").alias("with_text")]
    rows = parsed.groupBy("rule", "name", *act).agg(*aggs).withColumn("code", _code(F.col("rule"), F.col("name")))
    return rows.collect(), dictionary, answers.get["n"]


def _build_layout(rows: list) -> WideLayout:
    lay = WideLayout()
    for r in sorted(rows, key=lambda r: (r["name"], r["rule"])):
        rule, name = r["rule"], r["name"]
        lay.codes[rule, name] = r["code"]
        if r["bad"]:
            raise ValueError(f"an option value of item {name} stands for several options")
        if rule == schema.MULTI_SELECT:
            if r["values"]:
                lay.multi[name] = list(r["values"])
        elif rule == schema.SINGLE_SELECT:
            lay.single[name] = bool(r["scored"])
        elif rule == schema.SUBSCALE:
            lay.subscale.append(name)
        else:
            lay.text.append(name)
            if "forms" in r.asDict():
                forms = set(r["forms"] or []) | ({"optional_text"} if r["with_text"] else set())
                if have := [f for f in TYPED_FIELDS if f in forms]:
                    lay.typed[name] = have
    if len(set(lay.codes.values())) < len(lay.codes):
        raise ValueError("two items have the same 64-bit hash")
    return lay


def layout(report: DataFrame, *, all_types: bool = False) -> WideLayout:
    """The items and their columns: one distinct over (rule, item, options text, chosen value)."""
    rows, dictionary, n = _layout_rows(report, by_activity=False, all_types=all_types)
    lay = _build_layout(rows)
    lay.dictionary, lay.rows = dictionary, n
    return lay


def _text_names(n: str, clean: bool) -> tuple[str, str]:
    return (n, f"{n}__response") if clean else (f"response_value__{n}", f"response_response__{n}")


def _path(path: str) -> str:
    return "t_" + path.replace(".", "_")


def answer_columns(lay: WideLayout, *, clean_names: bool = False) -> list[tuple[str, Column]]:
    """(name, expression over the map ``_m``) of every answer column."""
    out: list[tuple[str, Column]] = []

    def answer(rule: str, n: str) -> Column:
        return F.try_element_at(F.col("_m"), F.lit(lay.codes[rule, n]).cast("bigint"))

    for n, vals in lay.multi.items():
        e = answer(schema.MULTI_SELECT, n)
        out += [(f"{n}_{v}", F.when(F.array_contains(e["options"], F.lit(v).cast("bigint")),
                                    F.array_contains(e["values"], F.lit(v).cast("bigint")))) for v in vals]
    for n, scored in lay.single.items():
        e = answer(schema.SINGLE_SELECT, n)
        option = e["option"]
        out += [(n, option["score" if scored else "name"]), (f"{n}__index", e["chosen"]), (f"{n}__response", option["name"])]
    for n in lay.subscale:
        out += [(c, answer(schema.SUBSCALE, n)["subscale"]) for c in _text_names(n, clean_names)]
    for n in lay.text:
        out += [(c, answer(schema.TEXT, n)["text"]) for c in _text_names(n, clean_names)]
    for n, forms in lay.typed.items():
        out += [(f"{n}__{col}", answer(schema.TEXT, n)[_path(path)]) for form in forms for col, path in TYPED_FIELDS[form]]
    return out


def index_columns(report: DataFrame) -> list[str]:
    return [c for c in report.columns if c not in ("item", "response")]


OFFSET = "utc_timezone_offset"


def _ms_offset(report: DataFrame) -> DataFrame:
    """The UTC offset as milliseconds, which stand for its ISO-8601 text until submissions are collected (:func:`_iso_offset`)."""
    if OFFSET in report.columns and isinstance(report.schema[OFFSET].dataType, T.DayTimeIntervalType):
        return report.withColumn(OFFSET, interval_ms(F.col(OFFSET)))
    return report


def _iso_offset(frame: DataFrame, report: DataFrame) -> DataFrame:
    """The wide and split outputs carry the UTC offset as ISO-8601 text: written once for each row of ``frame``, not for each answer of ``report``."""
    if OFFSET in report.columns and isinstance(report.schema[OFFSET].dataType, T.DayTimeIntervalType):
        return frame.withColumn(OFFSET, iso_of_ms(F.col(OFFSET)))
    return frame


def collected(report: DataFrame, dictionary: OptionDictionary | None = None, *, on_duplicate: str = "fail",
              all_types: bool = False, n_rows: int | None = None) -> DataFrame:
    """One row per submission: the index columns and ``_m``, a map from item code to answer.

    ``n_rows``, the number of answer rows where it is known, sets the number of tasks. A second answer to an item fails the job, or with ``on_duplicate='first'`` the
    answer stays that comes first in the order of the answer fields.
    """
    if on_duplicate not in ("fail", "first"):
        raise ValueError("on_duplicate must be 'fail' or 'first'")
    index = index_columns(report)
    is_ = lambda r: F.col("_rule") == r
    rule = _rule(F.col("item.type"))
    answer = {"_chosen": "single_value", "_values": "value", "_subscale": "subscale", "_text": "text"}
    if all_types:
        paths = dict.fromkeys(path for cols in TYPED_FIELDS.values() for _, path in cols)
        answer |= {_path(p): p for p in paths}
    # Only select items need their options; a slider's range may be of any length.
    options = F.when(rule.isin(schema.MULTI_SELECT, schema.SINGLE_SELECT), F.col("item.raw_options"))
    # Every column is read once here, so that this step merges with the one that made the report and
    # nothing else of the report is computed; keys, which read columns again, come after it.
    rows = report.select(*[column(c) for c in index], F.struct(rule.alias("rule"), F.col("item.name").alias("name"), options.alias("raw")).alias("_i"),
                         *[F.col(f"response.value.{p}").alias(c) for c, p in answer.items()])
    rows = rows.select(*_submission_key(report, index), F.struct(*[column(c) for c in index]).alias("_index"), F.col("_i.rule").alias("_rule"),
                       F.col("_i.name").alias("_name"), F.col("_i.raw").alias("_raw"), *answer)
    rows = (dictionary or option_dictionary(rows, F.col("_raw"))).join(rows, F.col("_raw"), "_options")
    single = is_(schema.SINGLE_SELECT)
    option = F.get("_options", F.array_position(F.col("_options.value"), F.col("_chosen")).cast("int") - 1)
    multi = is_(schema.MULTI_SELECT)
    fields = [
        F.when(single, F.col("_chosen")).alias("chosen"), F.when(single, option).alias("option"),
        F.when(multi, F.col("_options.value")).alias("options"),
        F.when(multi, F.col("_values")).alias("values"),
        F.when(is_(schema.SUBSCALE), F.col("_subscale")).alias("subscale"),
        F.when(is_(schema.TEXT), F.col("_text")).alias("text"),
    ]
    if all_types:
        fields += [F.when(is_(schema.TEXT), F.col(_path(p))).alias(_path(p)) for p in paths]
    code = F.when(F.col("_name").isNotNull(), _code(F.col("_rule"), F.col("_name")))
    entry = F.when(F.col("_code").isNotNull(), F.struct("_code", "_answer"))
    answers = rows.select("_h1", "_h2", "_index", code.alias("_code"), F.struct(*fields).alias("_answer"))
    if on_duplicate == "first":
        items = answers.groupBy("_h1", "_h2", "_code").agg(F.min("_answer").alias("_answer"))
        maps = items.groupBy("_h1", "_h2").agg(F.collect_list(entry).alias("_l"))
        leaves = report.select(*[column(c) for c in index])
        leaves = leaves.select(*_submission_key(report, index), F.struct(*[column(c) for c in index]).alias("_index")).distinct()
        return maps.join(leaves, ["_h1", "_h2"]).select(*[column("_index", c).alias(c) for c in index], F.map_from_entries("_l").alias("_m"))
    if n_rows is None:
        answers = answers.repartition("_h1", "_h2")
    else:
        answers = answers.repartition(max(report.sparkSession.sparkContext.defaultParallelism, -(-n_rows // ANSWERS_A_TASK)), "_h1", "_h2")
    grouped = answers.groupBy("_h1", "_h2").agg(F.collect_list(entry).alias("_l"), F.first("_index").alias("_index"))
    grouped = grouped.where(F.when(
        F.size(F.array_distinct("_l._code")) < F.size("_l"),
        F.raise_error(F.lit("duplicate answers for one item in one submission")).cast("boolean")).otherwise(F.lit(True)))
    return grouped.select(*[column("_index", c).alias(c) for c in index], F.map_from_entries("_l").alias("_m"))


def _columns(frame: DataFrame, lay: WideLayout, clean_names: bool) -> DataFrame:
    """The wide table of collected submissions."""
    structs = [c for c in schema.INDEX_STRUCTS if c in frame.columns]
    out: list[tuple[str, Column]] = []
    for c in frame.columns:
        if c in structs:
            out += [(f"{c}_{f}", column(c, f)) for f in field_names(frame, c)]
        elif c != "_m":
            out.append((c, column(c)))
    fixed = ["applet_version"] + [f"{s}_{f}" for s in structs for f in field_names(frame, s)]
    out += answer_columns(lay, clean_names=clean_names)
    order = column_order([n for n, _ in out], ("applet_version", *structs), fixed)
    names = distinct_names([out[i][0] for i in order])
    return frame.select(*[out[i][1].alias(n) for i, n in zip(order, names, strict=True)])


def pivot_wide(report: DataFrame, lay: WideLayout | None = None, *, on_duplicate: str = "fail",
               clean_names: bool = False, sort: bool = False, all_types: bool = False, iso_offset: bool = False) -> DataFrame:
    """Wide table of a report (offset left as is, or as ISO text); see module docstring.

    Rows are unordered unless ``sort=True`` (a global sort on the index
    columns: a range-partitioned shuffle, so only when order matters).
    """
    lay = lay if lay is not None else layout(report, all_types=all_types)
    frame = collected(_ms_offset(report) if iso_offset else report, lay.dictionary, on_duplicate=on_duplicate, all_types=all_types, n_rows=lay.rows)
    out = _columns(_iso_offset(frame, report) if iso_offset else frame, lay, clean_names)
    index = ["applet_version"] + [f"{s}_{f}" for s in schema.INDEX_STRUCTS if s in report.columns for f in field_names(report, s)]
    return out.orderBy(*[column(c) for c in index if c in out.columns]) if sort else out


def wide(report: DataFrame, **kw) -> DataFrame:
    """Wide output (T1): offset as ISO text, then :func:`pivot_wide`."""
    return pivot_wide(report, iso_offset=True, **kw)


_SAFE = re.compile(r"[^\w.-]+")


def output_name(activity_name: str | None, activity_id: str | None) -> str:
    """File-safe output name for one activity; the id keeps equal names apart (``split_wide`` tells the rest apart)."""
    base = _SAFE.sub("_", (activity_name or "activity").strip()) or "activity"
    return f"{base}-{_SAFE.sub('_', activity_id or 'none')}"


def split_wide(report: DataFrame, *, reuse: str = "table", on_duplicate: str = "fail", clean_names: bool = False,
               all_types: bool = False) -> list[tuple[str, DataFrame]]:
    """One wide table per activity (id, name), with that activity's columns only.

    Plan: one scan for the items, **one** aggregation over the whole report (the index
    contains the activity, so submissions never mix activities), written once in the shared
    ``spark.checkpoint.dir`` as a table with a folder for each activity, of which each output
    reads its own (partition pruning). ``reuse='persist'`` keeps the aggregation in executor storage
    instead, and each output filters it.
    """
    if reuse not in ("table", "persist"):
        raise ValueError("reuse must be 'table' or 'persist'")
    r = _ms_offset(report)
    acts: dict[tuple, list] = {}
    found, dictionary, n_rows = _layout_rows(r, by_activity=True, all_types=all_types)
    for row in found:
        acts.setdefault((row["act_id"], row["act_name"], row["act_code"]), []).append(row)
    if len({code for _, _, code in acts}) < len(acts):
        raise ValueError("two activities have the same 64-bit hash")
    big = _iso_offset(collected(r, dictionary, on_duplicate=on_duplicate, all_types=all_types, n_rows=n_rows), report).withColumn(
        "_act", _activity_code(F.col("activity.id"), F.col("activity.name")))
    if reuse == "table":
        ensure_checkpoint_dir(big.sparkSession)
        path = scratch_path(big.sparkSession, "submissions")
        # Submissions of an activity are brought together (AQE splits large activities and joins small ones).
        big.hint("rebalance", "_act").write.partitionBy("_act").parquet(path)
        big = big.sparkSession.read.schema(big.schema).parquet(path)
    else:
        big = big.persist(StorageLevel.MEMORY_AND_DISK)
    ordered = sorted(acts.items(), key=lambda kv: (str(kv[0][1]), str(kv[0][0])))
    # Names that only blanks or odd characters tell apart would otherwise be one file.
    names = distinct_names([output_name(aname, aid) for (aid, aname, _), _ in ordered])
    return [(name, _columns(big.where(F.col("_act") == code).drop("_act"), _build_layout(rows), clean_names))
            for name, ((_, _, code), rows) in zip(names, ordered, strict=True)]
