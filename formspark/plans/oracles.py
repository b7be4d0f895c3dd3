"""Independent SQL (DuckDB dialect) for each query in :mod:`table_queries`.

Expected values are computed straight from the benchmark tables' columns
(the arithmetic that generated each answer), never by parsing the answer
text, so a parser bug cannot hide on both sides.
"""

from __future__ import annotations

import json

from ..sources.tables import COLOR_OPTIONS, ENERGY_OPTIONS, MOOD_OPTIONS


def V(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


ORDERS_CTE = """o AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS status, o_totalprice AS total,
         CAST(o_orderdate AS DATE) AS odate, o_orderpriority AS prio,
         date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 86400000
           + (o_orderkey % 86400) * 1000 + o_orderkey % 1000 AS start_ms
  FROM orders)"""

SUB = f"'sub-' || {V('k')} AS submission_id"

# (name, value, score) of the fixed options, from the questionnaire texts.
MOOD = [("Very bad", 0, 1), ("Bad", 1, 2), ("Okay", 2, 3), ("Good", 3, 4), ("Very good", 4, 5)]
COLORS = [("red", 0, None), ("green", 1, None), ("blue", 2, None), ("yellow", 3, None)]
ENERGY = [("Low", 0, None), ("Medium", 1, None), ("High", 2, None)]
STEPS = [(str(n), n, n) for n in range(0, 11)]
OPTIONS_OF = {"mood": MOOD, "colors": COLORS, "energy": ENERGY, "steps": STEPS}
RAW_OPTIONS_OF = {"mood": MOOD_OPTIONS, "colors": COLOR_OPTIONS, "energy": ENERGY_OPTIONS, "steps": "Min: 0, Max: 10"}
# (name, type) in questionnaire order, then the two subscale items.
ITEMS = [("mood", "singleSelect"), ("colors", "multiSelect"), ("status_note", "text"), ("order_day", "date"),
         ("sleep", "timeRange"), ("place", "geolocation"), ("grid", "singleSelectRows"), ("steps", "slider"),
         ("bedtime", "time"), ("photo", "photo"), ("energy", "singleSelect"), ("remark", "paragraphText")]
SUBSCALE_ITEMS = [("subscale_name_total", "total"), ("activity_score", "activity_score")]
NO_OPTION_ITEMS = [n for n, _ in ITEMS if n not in OPTIONS_OF] + [n for _, n in SUBSCALE_ITEMS]


def q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def n_(x) -> str:
    return "NULL" if x is None else str(x)


def _names_list(opts) -> str:
    return "[" + ", ".join(q(n) for n, _, _ in opts) + "]"


def options_values_cte() -> str:
    rows = [f"({q(item)}, {q(n)}, {v}, {n_(s)})" for item, opts in OPTIONS_OF.items() for n, v, s in opts]
    return "opts(item_name, option_name, option_value, option_score) AS (VALUES " + ", ".join(rows) + ")"


def no_option_cte() -> str:
    return "noopt(item_name) AS (VALUES " + ", ".join(f"({q(n)})" for n in NO_OPTION_ITEMS) + ")"


WIDE_INDEX = [
    ("applet_version", "CASE WHEN k % 3 = 0 THEN '2.2.4' ELSE '2.3.0' END"),
    ("target_user_id", f"'cust-' || {V('c')}"),
    ("target_user_secret_id", f"'S' || lpad({V('c')}, 6, '0')"),
    ("target_user_nickname", f"'Customer ' || {V('c')}"),
    ("target_user_relation", "CAST(NULL AS VARCHAR)"),
    ("target_user_tag", "'respondent'"),
    ("source_user_id", f"'src-' || {V('c % 50')}"),
    ("source_user_secret_id", f"'R' || {V('c % 50')}"),
    ("source_user_nickname", f"'Reporter ' || {V('c % 50')}"),
    ("source_user_relation", "CASE WHEN k % 4 = 0 THEN 'admin' END"),
    ("source_user_tag", "'reporter'"),
    ("input_user_id", f"'in-' || {V('c % 7')}"),
    ("input_user_secret_id", f"'I' || {V('c % 7')}"),
    ("input_user_nickname", f"'Input ' || {V('c % 7')}"),
    ("input_user_relation", "CAST(NULL AS VARCHAR)"),
    ("input_user_tag", "CAST(NULL AS VARCHAR)"),
    ("account_user_id", f"'acct-' || {V('c % 11')}"),
    ("account_user_secret_id", f"'A' || {V('c % 11')}"),
    ("account_user_nickname", "CAST(NULL AS VARCHAR)"),
    ("account_user_relation", "CAST(NULL AS VARCHAR)"),
    ("account_user_tag", "CAST(NULL AS VARCHAR)"),
    ("activity_flow_id", "CASE WHEN status = 'F' THEN 'flow-F' END"),
    ("activity_flow_name", "CASE WHEN status = 'F' THEN 'Finished flow' END"),
    ("activity_flow_submission_id", f"CASE WHEN status = 'F' THEN 'fs-' || {V('k')} END"),
    ("activity_id", "'act-' || substr(prio, 1, 1)"),
    ("activity_name", "prio"),
    ("activity_submission_id", f"'sub-' || {V('k')}"),
    ("activity_submission_review_id", "CAST(NULL AS VARCHAR)"),
    ("activity_time_start_time", "make_timestamp(start_ms * 1000)"),
    ("activity_time_end_time", "make_timestamp((start_ms + (k % 3600 + 60) * 1000) * 1000)"),
    ("activity_schedule_id", "'sch-' || substr(prio, 1, 1)"),
    ("activity_schedule_history_id", "'sch-' || substr(prio, 1, 1) || '_' || strftime(odate, '%Y%m%d') || '-1'"),
    ("activity_schedule_start_time", "CASE WHEN k % 4 = 0 THEN NULL ELSE make_timestamp((start_ms - 600000) * 1000) END"),
    ("utc_timezone_offset", "CASE k % 4 WHEN 0 THEN '-PT4H' WHEN 1 THEN 'PT0S' WHEN 2 THEN 'PT5H30M' ELSE '-PT5H' END"),
]


def _label(opts, idx: str) -> str:
    return f"{_names_list(opts)}[{idx} + 1]"


MOOD_COLS = [
    ("mood", "CASE WHEN k % 13 = 0 THEN NULL ELSE k % 5 + 1 END"),
    ("mood__index", "CASE WHEN k % 13 = 0 THEN NULL ELSE k % 5 END"),
    ("mood__response", f"CASE WHEN k % 13 = 0 THEN NULL ELSE {_label(MOOD, 'k % 5')} END"),
]
ENERGY_COLS = [
    ("energy", _label(ENERGY, "k % 3")),
    ("energy__index", "k % 3"),
    ("energy__response", _label(ENERGY, "k % 3")),
]
COLOR_COLS = [
    (f"colors_{v}", f"CASE WHEN k % 11 = 0 THEN NULL ELSE (k % 4 = {v} OR (k % 3 <> 0 AND (k + 1) % 4 = {v})) END")
    for v in range(4)
]


def _pair(item: str, expr: str) -> list[tuple[str, str]]:
    return [(f"response_value__{item}", expr), (f"response_response__{item}", expr)]


SUBSCALE_COLS = _pair("activity_score", "CAST(k % 100 AS DOUBLE)") + _pair("total", "total")
STATUS_TEXT = "'Status ' || status || chr(10) || prio"
TEXT_COLS = (
    _pair("bedtime", "CAST(NULL AS VARCHAR)") + _pair("grid", "CAST(NULL AS VARCHAR)")
    + _pair("order_day", "CAST(NULL AS VARCHAR)") + _pair("photo", "CAST(NULL AS VARCHAR)")
    + _pair("place", "CAST(NULL AS VARCHAR)") + _pair("remark", "prio")
    + _pair("sleep", "CAST(NULL AS VARCHAR)") + _pair("status_note", STATUS_TEXT)
    + _pair("steps", "CAST(NULL AS VARCHAR)")
)


def _select(cols: list[tuple[str, str]]) -> str:
    return ",\n  ".join(f'{e} AS "{n}"' for n, e in cols)


def wide_sql(cols: list[tuple[str, str]], extra: str = "") -> str:
    return f"WITH {ORDERS_CTE}\nSELECT {_select(WIDE_INDEX + cols)}{extra}\nFROM o"


# --- long rows ----------------------------------------------------------------------

LONG_TYPES = [
    ("response_value_type", "VARCHAR"), ("response_value_null_value", "BOOLEAN"),
    ("response_value_single_value", "BIGINT"), ("response_value_value", "BIGINT"),
    ("response_value_value_index", "INTEGER"), ("response_value_text", "VARCHAR"),
    ("response_value_file", "VARCHAR"), ("response_value_date", "DATE"), ("response_value_time", "VARCHAR"),
    ("response_value_time_range", "BIGINT"), ("response_value_geo_latitude", "DOUBLE"),
    ("response_value_geo_longitude", "DOUBLE"), ("response_value_matrix_row", "VARCHAR"),
    ("response_value_matrix_value", "VARCHAR"), ("response_value_matrix_value_index", "INTEGER"),
    ("response_value_optional_text", "VARCHAR"), ("response_value_subscale", "DOUBLE"),
]

LAT = "CAST((c % 90) * 10000 + k % 10000 AS DOUBLE) / CAST(10000 AS DOUBLE)"
LON = "-(CAST((k % 180) * 1000 + c % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE))"
SLEEP_MS = "((((k // 7) % 24) - (k % 24)) * 60 + (((k // 3) % 60) - (k % 60))) * 60000"
HHMM = "lpad(CAST(k % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(k % 60 AS VARCHAR), 2, '0') || ':00'"


#: Every item's answer text, from the order's columns.
def _day(year: str) -> str:
    return f"'date: ' || {V('day(odate)')} || '/' || {V('month(odate)')} || '/' || {year}"


RAW_ANSWERS = {
    "mood": f"CASE WHEN k % 13 = 0 THEN 'value: null' WHEN k % 7 = 0 THEN 'value: ' || {V('k % 5')} || ' | text: ' || status "
            f"ELSE 'value: ' || {V('k % 5')} END",
    "colors": f"CASE WHEN k % 11 = 0 THEN 'value: null' WHEN k % 3 = 0 THEN 'value: ' || {V('k % 4')} "
              f"ELSE 'value: ' || {V('k % 4')} || ', ' || {V('(k + 1) % 4')} END",
    "status_note": "'Status ' || status || chr(10) || prio",
    "order_day": f"CASE WHEN k % 5 = 0 THEN {_day('lpad(' + V('year(odate) % 100') + ', 2, ' + chr(39) + '0' + chr(39) + ')')} "
                 f"ELSE {_day(V('year(odate)'))} END",
    "sleep": f"'time_range: from hr ' || {V('k % 24')} || ' min ' || {V('k % 60')} || ' / to hr ' || {V('(k // 7) % 24')} "
             f"|| ' min ' || {V('(k // 3) % 60')}",
    "place": f"'geo: lat ' || {V('c % 90')} || '.' || lpad({V('k % 10000')}, 4, '0') || ' long -' || {V('k % 180')} || '.' "
             f"|| lpad({V('c % 1000')}, 3, '0')",
    "grid": f"'morning: ' || {V('k % 3')} || chr(10) || 'evening: ' || {V('(k + 1) % 3')} || ', ' || {V('k % 2 + 3')}",
    "steps": f"'value: ' || {V('k % 11')}",
    "bedtime": f"'time: hr ' || {V('k % 24')} || ' min ' || {V('k % 60')}",
    "photo": f"'uploads/photo-' || {V('k')} || '.jpg'",
    "energy": f"'value: ' || {V('k % 3')}",
    "remark": "'text: ' || prio",
    "total": V("total"),
    "activity_score": V("k % 100"),
}
OFFSET_MS = "CAST(CASE k % 4 WHEN 0 THEN -240 WHEN 1 THEN 0 WHEN 2 THEN 330 ELSE -300 END * 60000 AS BIGINT)"


def _item_columns(item: str) -> list[tuple[str, str]]:
    """Item and response columns of a row of ``item``."""
    subscale = dict((n, i) for i, n in SUBSCALE_ITEMS)
    typ = dict(ITEMS).get(item, "subscale")
    null = "CAST(NULL AS VARCHAR)"
    return [("item_id", q(subscale.get(item, f"item-{item}"))), ("item_name", q(item)),
            ("item_prompt", null if item in subscale else q(f"How about {item}?")), ("item_type", q(typ)),
            ("item_raw_options", f"CAST({q(RAW_OPTIONS_OF.get(item))} AS VARCHAR)"),
            ("item_options_json", f"CAST({q(_json(OPTIONS_OF.get(item)))} AS VARCHAR)"), ("response_status", "'completed'"),
            ("response_raw_score", "CAST(NULL AS BIGINT)" if item in subscale else "CAST(k % 40 AS BIGINT)"),
            ("response_raw_response", RAW_ANSWERS[item])]


def _json(opts) -> str | None:
    if not opts:
        return None
    return json.dumps([{k: v for k, v in (("name", n), ("value", v), ("score", s)) if v is not None}
                       for n, v, s in opts], separators=(",", ":"))


def _long_row(item: str, where: str = "", **vals: str) -> str:
    index = [(n, OFFSET_MS if n == "utc_timezone_offset" else e) for n, e in WIDE_INDEX]
    cols = [f'{e} AS "{n}"' for n, e in index + _item_columns(item)]
    for name, typ in LONG_TYPES:
        short = name[len("response_value_"):]
        e = vals.get(short)
        cols.append(f"CAST({e if e is not None else 'NULL'} AS {typ}) AS {name}")
    return f"SELECT {', '.join(cols)} FROM o" + (f" WHERE {where}" if where else "")


CUSTOMER_OPTIONS = {"service": [("poor", 0, -1), ("fair", 1, 0), ("good", 2, 4)], "channels": [("web", 0, None), ("shop", 1, None)],
                    "pain": [(str(n), n, n) for n in range(1, 5)], "segment": []}


def long_report_sql() -> str:
    """Each answer value of a customer's items, times the item's options."""
    def rows(item: str, typ: str, raw: str | None, answer: str, where: str = "", **vals: str) -> str:
        opts = CUSTOMER_OPTIONS[item]
        option = "(VALUES " + ", ".join(f"({q(n)}, {v}, {n_(s)})" for n, v, s in opts or [(None, "NULL", None)]) + ") p(n, v, s)"
        cols = [f"'cust-' || {V('c_custkey')} AS submission_id", f"{V('c_nationkey')} AS target_user_id", f"{q(item)} AS item_name",
                f"{q(typ)} AS item_type", f"CAST({q(raw)} AS VARCHAR) AS item_raw_options", f"CAST({q(_json(opts))} AS VARCHAR) AS item_options_json",
                "'completed' AS response_status", "c_custkey % 40 AS response_raw_score", f"{answer} AS response_raw_response"]
        for name, t in LONG_TYPES:
            cols.append(f"CAST({vals.get(name[len('response_value_'):], 'NULL')} AS {t}) AS {name}")
        cols += ["CAST(n AS VARCHAR) AS item_option_name", "CAST(v AS BIGINT) AS item_option_value", "CAST(s AS BIGINT) AS item_option_score"]
        return f"SELECT {', '.join(cols)} FROM customer, {option}" + (f" WHERE {where}" if where else "")

    channels = ("channels", "multiSelect", "web: 0, shop: 1")
    return "\nUNION ALL ".join([
        rows("service", "singleSelect", "poor: 0 (score: -1), fair: 1 (score: 0), good: 2 (score: 4)", f"'value: ' || {V('c_custkey % 3')}",
             single_value="c_custkey % 3"),
        rows(*channels, "'value: null'", "c_custkey % 4 = 0", type="'null_value'", null_value="TRUE"),
        rows(*channels, "'value: 0, 1'", "c_custkey % 4 <> 0", type="'value'", value="0", value_index="0"),
        rows(*channels, "'value: 0, 1'", "c_custkey % 4 <> 0", type="'value'", value="1", value_index="1"),
        rows("pain", "slider", "Min: 1, Max: 4", f"'value: ' || {V('c_custkey % 4 + 1')}", type="'value'", value="c_custkey % 4 + 1", value_index="0"),
        rows("segment", "text", None, "c_mktsegment", type="'text'", text="c_mktsegment")])


def long_sql() -> str:
    rows = [
        _long_row("mood", single_value="CASE WHEN k % 13 = 0 THEN NULL ELSE k % 5 END",
                  null_value="CASE WHEN k % 13 = 0 THEN TRUE END",
                  optional_text="CASE WHEN k % 13 <> 0 AND k % 7 = 0 THEN status END"),
        _long_row("colors", "k % 11 = 0", type="'null_value'", null_value="TRUE"),
        _long_row("colors", "k % 11 <> 0", type="'value'", value="k % 4", value_index="0"),
        _long_row("colors", "k % 11 <> 0 AND k % 3 <> 0", type="'value'", value="(k + 1) % 4", value_index="1"),
        _long_row("status_note", type="'text'", text=STATUS_TEXT),
        _long_row("order_day", type="'date'", date="odate"),
        _long_row("sleep", type="'time_range'", time_range=SLEEP_MS),
        _long_row("place", type="'geo'", geo_latitude=LAT, geo_longitude=LON),
        _long_row("grid", type="'matrix'", matrix_row="'morning'", matrix_value=V("k % 3"), matrix_value_index="0"),
        _long_row("grid", type="'matrix'", matrix_row="'evening'", matrix_value=V("(k + 1) % 3"),
                  matrix_value_index="0"),
        _long_row("grid", type="'matrix'", matrix_row="'evening'", matrix_value=V("k % 2 + 3"),
                  matrix_value_index="1"),
        _long_row("steps", type="'value'", value="k % 11", value_index="0"),
        _long_row("bedtime", type="'time'", time=HHMM),
        _long_row("photo", type="'file'", file=f"'uploads/photo-' || {V('k')} || '.jpg'"),
        _long_row("energy", single_value="k % 3"),
        _long_row("remark", type="'text'", text="prio"),
        _long_row("total", type="'subscale'", subscale="total"),
        _long_row("activity_score", type="'subscale'", subscale="k % 100"),
    ]
    return f"WITH {ORDERS_CTE}\n" + "\nUNION ALL\n".join(rows)


# --- dictionary / options ---------------------------------------------------------------

def _items_cte() -> str:
    rows = []
    for n, t in ITEMS:
        opts = OPTIONS_OF.get(n)
        rows.append(f"('item-{n}', '{n}', 'How about {n}?', '{t}', {q(RAW_OPTIONS_OF.get(n))}, "
                    f"{len(opts) if opts else 'NULL'}, {q(_json(opts))})")
    for iid, n in SUBSCALE_ITEMS:
        rows.append(f"('{iid}', '{n}', NULL, 'subscale', NULL, NULL, NULL)")
    return ("items(item_id, item_name, item_prompt, item_type, item_raw_options, n_options, item_options_json) "
            "AS (VALUES " + ", ".join(rows) + ")")


def _json_keep_nulls(opts) -> str:
    return json.dumps([{"name": n, "value": v, "score": s} for n, v, s in opts], separators=(",", ":"))


CTX_COLS = """CASE WHEN k % 3 = 0 THEN '2.2.4' ELSE '2.3.0' END AS applet_version,
  CASE WHEN status = 'F' THEN 'flow-F' END AS activity_flow_id,
  CASE WHEN status = 'F' THEN 'Finished flow' END AS activity_flow_name,
  'act-' || substr(prio, 1, 1) AS activity_id, prio AS activity_name"""


def dictionary_sql() -> str:
    return (f"WITH {ORDERS_CTE}, ctx AS (SELECT DISTINCT {CTX_COLS} FROM o), {_items_cte()}\n"
            "SELECT applet_version, activity_flow_id, activity_flow_name, activity_id, activity_name, "
            "item_id, item_name, item_prompt, item_options_json FROM ctx, items")


def dictionary_full_sql() -> str:
    return (f"WITH {ORDERS_CTE}, ctx AS (SELECT DISTINCT {CTX_COLS}, "
            f"CASE WHEN status = 'F' THEN 'fs-' || {V('k')} END AS activity_flow_submission_id FROM o), "
            f"{_items_cte()}\n"
            "SELECT applet_version, activity_flow_id, activity_flow_name, activity_flow_submission_id, "
            "activity_id, activity_name, item_id, item_name, item_prompt, item_type, item_raw_options, "
            "item_options_json FROM ctx, items")


def options_sql() -> str:
    return (f"WITH {ORDERS_CTE}, ctx AS (SELECT DISTINCT "
            "CASE WHEN status = 'F' THEN 'flow-F' END AS activity_flow_id, "
            "CASE WHEN status = 'F' THEN 'Finished flow' END AS activity_flow_name, "
            "'act-' || substr(prio, 1, 1) AS activity_id, prio AS activity_name FROM o), "
            f"{_items_cte()}, {options_values_cte()}\n"
            "SELECT ctx.*, items.item_id, items.item_name, items.item_prompt, opts.option_name AS item_option_name, "
            "CAST(opts.option_value AS BIGINT) AS item_option_value, "
            "CAST(opts.option_score AS BIGINT) AS item_option_score "
            "FROM ctx CROSS JOIN items LEFT JOIN opts ON opts.item_name = items.item_name")


def item_response_options_sql() -> str:
    return (f"WITH {ORDERS_CTE}, ctx AS (SELECT DISTINCT {CTX_COLS}, "
            f"CASE WHEN status = 'F' THEN 'fs-' || {V('k')} END AS activity_flow_submission_id FROM o), "
            f"{_items_cte()}, {options_values_cte()}\n"
            "SELECT applet_version, activity_flow_id, activity_flow_name, activity_flow_submission_id, activity_id, activity_name, "
            "items.item_id, items.item_name, items.item_prompt, items.item_type, items.item_raw_options, items.item_options_json, "
            "opts.option_name AS item_option_name, "
            "CAST(opts.option_value AS BIGINT) AS item_option_value, "
            "CAST(opts.option_score AS BIGINT) AS item_option_score "
            "FROM ctx CROSS JOIN items LEFT JOIN opts ON opts.item_name = items.item_name")


def expand_options_sql() -> str:
    return (f"WITH {ORDERS_CTE}, {options_values_cte()}, {no_option_cte()}\n"
            f"SELECT {SUB}, item_name, option_name, CAST(option_value AS BIGINT) AS option_value, "
            "CAST(option_score AS BIGINT) AS option_score FROM o, opts\n"
            f"UNION ALL SELECT {SUB}, item_name, NULL, NULL, NULL FROM o, noopt")


def scored_sql() -> str:
    cols = "submission_id, item_name, answer_value, item_option_name, item_option_value, item_option_score"
    rows = [
        f"SELECT {SUB}, 'mood', k % 5, {_label(MOOD, 'k % 5')}, k % 5, k % 5 + 1 FROM o WHERE k % 13 <> 0",
        f"SELECT {SUB}, 'colors', k % 4, {_label(COLORS, 'k % 4')}, k % 4, NULL FROM o WHERE k % 11 <> 0",
        f"SELECT {SUB}, 'colors', (k + 1) % 4, {_label(COLORS, '(k + 1) % 4')}, (k + 1) % 4, NULL FROM o "
        "WHERE k % 11 <> 0 AND k % 3 <> 0",
        f"SELECT {SUB}, 'energy', k % 3, {_label(ENERGY, 'k % 3')}, k % 3, NULL FROM o",
        f"SELECT {SUB}, 'steps', k % 11, {V('k % 11')}, k % 11, k % 11 FROM o",
    ]
    for n in NO_OPTION_ITEMS:
        reps = 3 if n == "grid" else 1
        for _ in range(reps):
            rows.append(f"SELECT {SUB}, '{n}', NULL, NULL, NULL, NULL FROM o")
    body = "\nUNION ALL ".join(rows)
    return (f"WITH {ORDERS_CTE}, s({cols}) AS ({body})\n"
            "SELECT submission_id, item_name, CAST(answer_value AS BIGINT) AS answer_value, item_option_name, "
            "CAST(item_option_value AS BIGINT) AS item_option_value, "
            "CAST(item_option_score AS BIGINT) AS item_option_score FROM s")


def csv_encode_sql() -> str:
    def opt_json(n: str) -> str:
        opts = OPTIONS_OF.get(n)
        inner = _json_keep_nulls(opts) if opts else "null"
        return q('{"response_options":' + inner + "}")

    rows = []
    for n in [i for i, _ in ITEMS] + [n for _, n in SUBSCALE_ITEMS]:
        tr = SLEEP_MS if n == "sleep" else "NULL"
        rows.append(
            f"SELECT {SUB}, '{n}' AS item_name, "
            "'{\"id\":\"act-' || substr(prio, 1, 1) || '\",\"name\":\"' || prio || '\"}' AS activity, "
            f"{opt_json(n)} AS response_options, "
            "CAST(CASE k % 4 WHEN 0 THEN -240 WHEN 1 THEN 0 WHEN 2 THEN 330 ELSE -300 END * 60000 AS BIGINT) "
            "AS utc_timezone_offset_ms, "
            f"CAST({tr} AS BIGINT) AS time_range_ms FROM o")
    return f"WITH {ORDERS_CTE}\n" + "\nUNION ALL ".join(rows)


# --- grids -------------------------------------------------------------------------------

EVENTS_CTE = """ev AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS secret_id, CAST(ts AS DATE) AS activity_date,
         CASE event_type WHEN 'click' THEN 'Student Check-In' WHEN 'view' THEN 'Student Check-Out'
              WHEN 'purchase' THEN 'Purchase survey' WHEN 'signup' THEN 'Signup survey'
              WHEN 'error' THEN 'Error report' END AS name,
         value >= 5 AS has_item
  FROM events),
p AS (
  SELECT 'U' || CAST(c_custkey AS VARCHAR) AS secret_id, c_name AS nickname,
         'First' || CAST(c_custkey AS VARCHAR) AS first_name, 'Last' || CAST(c_nationkey AS VARCHAR) AS last_name,
         c_mktsegment AS site, 'R' || CAST(c_nationkey AS VARCHAR) AS room
  FROM customer)"""

ATTENDANCE_SQL = f"""WITH {EVENTS_CTE},
daily AS (SELECT * FROM ev WHERE name LIKE 'Student Check%'),
dates AS (SELECT DISTINCT activity_date FROM daily WHERE activity_date IS NOT NULL),
att AS (SELECT secret_id, activity_date,
               bool_or(name = 'Student Check-In' AND has_item) AS ci,
               bool_or(name = 'Student Check-Out' AND has_item) AS co
        FROM daily GROUP BY secret_id, activity_date)
SELECT p.secret_id, p.nickname, p.first_name, p.last_name, p.site, p.room, d.activity_date,
       coalesce(att.ci, FALSE) AS "Student Check-In", coalesce(att.co, FALSE) AS "Student Check-Out"
FROM p CROSS JOIN dates d
LEFT JOIN att ON att.secret_id = p.secret_id AND att.activity_date = d.activity_date"""

COMPLETION_BODY = f"""WITH {EVENTS_CTE},
comp AS (SELECT secret_id,
                bool_or(name = 'Error report' AND has_item) AS er,
                bool_or(name = 'Purchase survey' AND has_item) AS pu,
                bool_or(name = 'Signup survey' AND has_item) AS si
         FROM ev WHERE name NOT LIKE 'Student Check%' GROUP BY secret_id),
g AS (SELECT p.secret_id, p.nickname, p.first_name, p.last_name, p.site, p.room,
             coalesce(comp.er, FALSE) AS "Error report", coalesce(comp.pu, FALSE) AS "Purchase survey",
             coalesce(comp.si, FALSE) AS "Signup survey"
      FROM p LEFT JOIN comp ON comp.secret_id = p.secret_id)"""

COMPLETION_SQL = COMPLETION_BODY + """
SELECT *, "Error report" AND "Purchase survey" AND "Signup survey" AS complete FROM g"""

COMPLETION_SUMMARY_SQL = COMPLETION_BODY + """
SELECT secret_id, nickname, first_name, last_name, site, room,
       "Error report" AND "Purchase survey" AND "Signup survey" AS complete FROM g"""


NAMES_CTE = f"""{EVENTS_CTE},
named AS (SELECT secret_id, activity_date, has_item, CASE name WHEN 'Student Check-In' THEN 'Student Check A'
                 WHEN 'Student Check-Out' THEN 'Student Check a' WHEN 'Purchase survey' THEN 'site' WHEN 'Signup survey' THEN 'SITE'
                 ELSE 'complete' END AS name FROM ev)"""

# Names sorted by code point: "SITE" comes before "site", so it gets the first suffix behind the roster's own column.
ATTENDANCE_NAMES_SQL = f"""WITH {NAMES_CTE},
daily AS (SELECT * FROM named WHERE name LIKE 'Student Check%'),
dates AS (SELECT DISTINCT activity_date FROM daily WHERE activity_date IS NOT NULL),
att AS (SELECT secret_id, activity_date, bool_or(name = 'Student Check A' AND has_item) AS up,
               bool_or(name = 'Student Check a' AND has_item) AS low
        FROM daily GROUP BY secret_id, activity_date)
SELECT p.*, d.activity_date, coalesce(att.up, FALSE) AS "Student Check A", coalesce(att.low, FALSE) AS "Student Check a__2"
FROM p CROSS JOIN dates d LEFT JOIN att ON att.secret_id = p.secret_id AND att.activity_date = d.activity_date"""

COMPLETION_NAMES_SQL = f"""WITH {NAMES_CTE},
comp AS (SELECT secret_id, bool_or(name = 'SITE' AND has_item) AS up, bool_or(name = 'complete' AND has_item) AS co,
                bool_or(name = 'site' AND has_item) AS low
         FROM named WHERE name NOT LIKE 'Student Check%' GROUP BY secret_id),
g AS (SELECT p.*, coalesce(up, FALSE) AS "SITE__2", coalesce(co, FALSE) AS "complete__2", coalesce(low, FALSE) AS "site__3"
      FROM p LEFT JOIN comp ON comp.secret_id = p.secret_id)
SELECT *, "SITE__2" AND "complete__2" AND "site__3" AS complete FROM g"""


# --- conversations wide ------------------------------------------------------------------

WS_CHARS = "chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"
CONV_INDEX = (
    [(f"target_user_{f}", "'speaker-' || CAST(conv_id AS VARCHAR)" if f == "id" else "CAST(NULL AS VARCHAR)")
     for f in ("id", "secret_id", "nickname", "relation", "tag")]
    + [(f"{r}_{f}", "CAST(NULL AS VARCHAR)") for r in ("source_user", "input_user", "account_user")
       for f in ("id", "secret_id", "nickname", "relation", "tag")]
    + [(f"activity_flow_{f}", "CAST(NULL AS VARCHAR)") for f in ("id", "name", "submission_id")]
    + [("activity_id", "'chat'"), ("activity_name", "'Conversation'"),
       ("activity_submission_id", "'conv-' || CAST(conv_id AS VARCHAR)"),
       ("activity_submission_review_id", "CAST(NULL AS VARCHAR)"),
       ("activity_time_start_time", "CAST(NULL AS TIMESTAMP)"), ("activity_time_end_time", "CAST(NULL AS TIMESTAMP)"),
       ("activity_schedule_id", "CAST(NULL AS VARCHAR)"), ("activity_schedule_history_id", "CAST(NULL AS VARCHAR)"),
       ("activity_schedule_start_time", "CAST(NULL AS TIMESTAMP)")]
)


def wide_text_sql(turns: int = 8) -> str:
    cols = []
    for t in range(turns):
        e = f"max(CASE WHEN turn = {t} THEN trim(text, {WS_CHARS}) END)"
        cols += [(f"response_value__turn_{t}", e), (f"response_response__turn_{t}", e)]
    return (f"SELECT {_select(CONV_INDEX + cols)}\nFROM conversations GROUP BY conv_id")


def split_wide_sql() -> str:
    name = "replace(prio, ' ', '_') || '-act-' || substr(prio, 1, 1) AS output_name"
    return wide_sql(MOOD_COLS + ENERGY_COLS + COLOR_COLS + SUBSCALE_COLS + TEXT_COLS, ",\n  " + name)


# --- everything ----------------------------------------------------------------------------

RESPONSE_SQL = f"""SELECT {V('l_orderkey')} || '/' || {V('l_linenumber')} AS submission_id, l_linestatus AS status,
  CASE WHEN l_linenumber % 3 <> 0 THEN l_partkey END AS raw_score,
  'value: ' || {V('l_linenumber')} || ', ' || {V('l_suppkey')} || ' | text: ' || l_returnflag AS raw_response,
  'value' AS value_type, CAST(l_linenumber AS BIGINT) AS first_value, l_suppkey AS second_value, l_returnflag AS optional_text
FROM lineitem"""

WIDE_FIRST_SQL = f"""WITH a AS (SELECT l_orderkey, min((l_partkey + l_linenumber) % 3) AS v,
  min(l_returnflag || '/' || l_linestatus || '/' || {V('l_linenumber')}) AS remark FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey AS order_key, [9, 5, 7][v + 1]::BIGINT AS carrier, v AS carrier__index, ['air', 'rail', 'sea'][v + 1] AS carrier__response,
  remark AS response_value__remark, remark AS response_response__remark FROM a"""

DEDUPED_SQL = f"""SELECT l_orderkey AS order_key, 'carrier' AS item_name, 'singleSelect' AS item_type, CAST(NULL AS VARCHAR) AS text,
  (l_partkey + l_linenumber) % 3 AS single_value, CAST(NULL AS DOUBLE) AS subscale FROM lineitem
UNION ALL SELECT l_orderkey, 'remark', 'text', l_returnflag || '/' || l_linestatus || '/' || {V('l_linenumber')}, NULL, NULL FROM lineitem
UNION ALL SELECT DISTINCT l_orderkey, 'order', 'subscale', NULL, NULL, CAST(l_orderkey % 10 AS DOUBLE) FROM lineitem
UNION ALL SELECT DISTINCT l_orderkey, 'activity_score', 'subscale', NULL, NULL, CAST(l_linenumber AS DOUBLE) FROM lineitem
  WHERE l_linenumber % 2 = 0"""

EXPORT_SQL = f"WITH {ORDERS_CTE}\n" + "\nUNION ALL ".join(
    f"SELECT {SUB}, CASE WHEN k % 3 = 0 THEN '2.2.4' ELSE '2.3.0' END AS applet_version, '{n}' AS item_name, '{t}' AS item_type, "
    f"CAST({q(RAW_OPTIONS_OF.get(n))} AS VARCHAR) AS raw_options, make_timestamp(start_ms * 1000) AS start_time, "
    f"CAST({ {'status_note': STATUS_TEXT, 'remark': 'prio'}.get(n, 'NULL') } AS VARCHAR) AS text, "
    f"CAST({ {'mood': 'CASE WHEN k % 13 = 0 THEN NULL ELSE k % 5 END', 'energy': 'k % 3'}.get(n, 'NULL') } AS BIGINT) AS single_value, "
    f"CAST({'odate' if n == 'order_day' else 'NULL'} AS DATE) AS answer_date, "
    f"CAST({ {'total': 'total', 'activity_score': 'k % 100'}.get(n, 'NULL') } AS DOUBLE) AS subscale FROM o"
    for n, t in [*ITEMS, *[(n, "subscale") for _, n in SUBSCALE_ITEMS]])

#: Rows of the job's outputs. Every tenth event has its activity name in blanks, an activity of its own whose output name comes first.
JOB_SQL = f"""WITH {EVENTS_CTE}, e AS (SELECT event_type, event_id % 10 = 0 AS padded, value >= 5 AS has_item,
  CASE event_type WHEN 'click' THEN 'Student_Check-In' WHEN 'view' THEN 'Student_Check-Out' WHEN 'purchase' THEN 'Purchase_survey'
  WHEN 'signup' THEN 'Signup_survey' WHEN 'error' THEN 'Error_report' END || '-act-' || event_type AS file FROM events),
i AS (SELECT count(*) AS n FROM (SELECT DISTINCT event_type, padded, has_item FROM e)), n AS (SELECT count(*) AS n FROM e),
r AS (SELECT count(*) AS n FROM p), d AS (SELECT count(DISTINCT activity_date) AS n FROM ev WHERE name LIKE 'Student Check%')
SELECT x || '.parquet' AS output, n AS n_rows FROM n, (VALUES ('report'), ('long_data')) v(x)
UNION ALL SELECT file || CASE WHEN padded THEN '' ELSE '__2' END || '.parquet', count(*) FROM e GROUP BY file, padded
UNION ALL SELECT x || '.parquet', n FROM i, (VALUES ('data_dictionary'), ('options')) v(x)
UNION ALL SELECT 'scored_responses.parquet', 0
UNION ALL SELECT x || '.parquet', d.n * r.n FROM d, r, (VALUES ('attendance-all'), ('attendance-by_site_date')) v(x)
UNION ALL SELECT x || '.parquet', r.n FROM r, (VALUES ('completion-all'), ('completion-by_site'), ('completion_summary-all'),
  ('completion_summary-by_site')) v(x)"""

ORACLES: dict[str, str] = {
    "long_report": long_report_sql(),
    "wide_first": WIDE_FIRST_SQL,
    "subscales_deduped": DEDUPED_SQL,
    "attendance_names": ATTENDANCE_NAMES_SQL,
    "completion_names": COMPLETION_NAMES_SQL,
    "export_report": EXPORT_SQL,
    "job_outputs": JOB_SQL,
    "parse_single_select": f"""WITH {ORDERS_CTE}
SELECT {SUB},
  CASE WHEN k % 13 = 0 THEN NULL ELSE k % 5 END AS single_value,
  CASE WHEN k % 13 = 0 THEN TRUE END AS null_value,
  CASE WHEN k % 13 <> 0 AND k % 7 = 0 THEN status END AS optional_text,
  CAST(NULL AS VARCHAR) AS value_type
FROM o""",
    "parse_multi_select": f"""WITH {ORDERS_CTE}
SELECT {SUB}, 'null_value' AS value_type, CAST(NULL AS INTEGER) AS value_index, CAST(NULL AS BIGINT) AS value
FROM o WHERE k % 11 = 0
UNION ALL SELECT {SUB}, 'value', 0, k % 4 FROM o WHERE k % 11 <> 0
UNION ALL SELECT {SUB}, 'value', 1, (k + 1) % 4 FROM o WHERE k % 11 <> 0 AND k % 3 <> 0""",
    "parse_date": f"WITH {ORDERS_CTE}\nSELECT {SUB}, 'date' AS value_type, odate AS answer_date FROM o",
    "parse_time_range_ms": f"WITH {ORDERS_CTE}\nSELECT {SUB}, 'time_range' AS value_type, "
                           f"CAST({SLEEP_MS} AS BIGINT) AS duration_ms FROM o",
    "parse_geo": f"WITH {ORDERS_CTE}\nSELECT {SUB}, 'geo' AS value_type, {LAT} AS latitude, {LON} AS longitude FROM o",
    "parse_matrix_long": f"""WITH {ORDERS_CTE}
SELECT {SUB}, 'morning' AS response_value_matrix_row, {V('k % 3')} AS response_value_matrix_value,
       0 AS response_value_matrix_value_index FROM o
UNION ALL SELECT {SUB}, 'evening', {V('(k + 1) % 3')}, 0 FROM o
UNION ALL SELECT {SUB}, 'evening', {V('k % 2 + 3')}, 1 FROM o""",
    "parse_form_types": """WITH b AS (SELECT o_orderkey AS k, o_orderkey % 11 AS r FROM orders)
SELECT k AS order_key,
  CASE r WHEN 0 THEN 'null_value' WHEN 1 THEN 'text' WHEN 2 THEN 'value' WHEN 3 THEN 'date' WHEN 4 THEN 'time'
         WHEN 5 THEN 'time_range' WHEN 6 THEN 'geo' WHEN 7 THEN 'matrix' WHEN 8 THEN 'file'
         WHEN 9 THEN 'raw_value' ELSE 'value' END AS value_type,
  CASE WHEN r = 9 THEN 'free answer ' || CAST(k AS VARCHAR) END AS raw_value,
  CASE WHEN r = 0 THEN TRUE END AS null_value,
  CASE WHEN r = 2 THEN k % 7 WHEN r = 10 THEN k % 3 END AS first_value,
  CAST(CASE WHEN r = 2 THEN 2 WHEN r = 10 THEN 1 END AS INTEGER) AS n_values,
  CASE WHEN r = 1 THEN 'note ' || CAST(k AS VARCHAR) END AS text,
  CASE WHEN r = 8 THEN 'docs/file-' || CAST(k AS VARCHAR) || '.pdf' END AS file,
  CASE WHEN r = 3 THEN make_date(k % 30 + 1990, k % 12 + 1, k % 28 + 1) END AS answer_date,
  CASE WHEN r = 4 THEN lpad(CAST(k % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(k % 60 AS VARCHAR), 2, '0') || ':00'
       END AS answer_time,
  CAST(CASE WHEN r = 5 THEN (6 * 60 - k % 60) * 60000 END AS BIGINT) AS time_range_ms,
  CASE WHEN r = 6 THEN CAST(k % 90 AS DOUBLE) + 0.5 END AS latitude,
  CASE WHEN r = 6 THEN -(CAST(k % 180 AS DOUBLE) + 0.25) END AS longitude,
  CAST(CASE WHEN r = 7 THEN 2 END AS INTEGER) AS matrix_rows,
  CASE WHEN r = 10 THEN 'why ' || CAST(k AS VARCHAR) END AS optional_text
FROM b""",
    "parse_options_scored": """SELECT c_custkey, 0 AS option_index, c_mktsegment AS option_name,
  CAST(c_nationkey AS BIGINT) AS option_value, CAST(c_custkey % 7 - 3 AS BIGINT) AS option_score FROM customer
UNION ALL SELECT c_custkey, 1, c_name, CAST(c_nationkey + 30 AS BIGINT), CAST(c_custkey % 5 AS BIGINT) FROM customer""",
    "parse_options_plain": """SELECT p_partkey, 0 AS option_index, p_brand AS option_name,
  CAST(p_size AS BIGINT) AS option_value, CAST(NULL AS BIGINT) AS option_score FROM part
UNION ALL SELECT p_partkey, 1, p_type, CAST(p_size + 100 AS BIGINT), NULL FROM part""",
    "parse_options_range": """SELECT s_suppkey, CAST(n - s_suppkey % 5 AS INTEGER) AS option_index,
  CAST(n AS VARCHAR) AS option_name, CAST(n AS BIGINT) AS option_value, CAST(n AS BIGINT) AS option_score
FROM (SELECT s_suppkey, unnest(generate_series(s_suppkey % 5, s_suppkey % 5 + s_nationkey % 4)) AS n FROM supplier)""",
    "epoch_ms_times": """WITH e AS (SELECT event_id, ts, (event_id % 13) * 30 AS m FROM events)
SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE date_trunc('millisecond', ts) END AS start_time,
  CASE WHEN m = 0 THEN 'PT0S' ELSE '-PT'
       || CASE WHEN m >= 60 THEN CAST(m // 60 AS VARCHAR) || 'H' ELSE '' END
       || CASE WHEN m % 60 > 0 THEN CAST(m % 60 AS VARCHAR) || 'M' ELSE '' END END AS offset_iso,
  CAST(-m * 60000 AS BIGINT) AS offset_ms
FROM e""",
    "nest_unnest_users": """SELECT CAST(c_custkey AS VARCHAR) AS target_user_id, c_name AS target_user_secret_id,
  c_mktsegment AS target_user_nickname, CAST(NULL AS VARCHAR) AS target_user_relation,
  CAST(c_nationkey AS VARCHAR) AS target_user_tag,
  CAST(NULL AS VARCHAR) AS source_user_id, CAST(NULL AS VARCHAR) AS source_user_secret_id,
  CAST(NULL AS VARCHAR) AS source_user_nickname, CAST(NULL AS VARCHAR) AS source_user_relation,
  CAST(NULL AS VARCHAR) AS source_user_tag,
  'in' || CAST(c_custkey AS VARCHAR) AS input_user_id, c_name AS input_user_secret_id,
  CAST(NULL AS VARCHAR) AS input_user_nickname, CAST(NULL AS VARCHAR) AS input_user_relation,
  CAST(NULL AS VARCHAR) AS input_user_tag,
  'acct' || CAST(c_custkey AS VARCHAR) AS account_user_id, c_name AS account_user_secret_id,
  CAST(NULL AS VARCHAR) AS account_user_nickname, CAST(NULL AS VARCHAR) AS account_user_relation,
  CAST(NULL AS VARCHAR) AS account_user_tag
FROM customer""",
    "users_distinct": f"""WITH {ORDERS_CTE}
SELECT DISTINCT 'target_user' AS user_type, 'cust-' || {V('c')} AS id, 'S' || lpad({V('c')}, 6, '0') AS secret_id,
  'Customer ' || {V('c')} AS nickname, CAST(NULL AS VARCHAR) AS relation, 'respondent' AS tag FROM o
UNION ALL SELECT DISTINCT 'source_user', 'src-' || {V('c % 50')}, 'R' || {V('c % 50')}, 'Reporter ' || {V('c % 50')},
  CASE WHEN k % 4 = 0 THEN 'admin' END, 'reporter' FROM o
UNION ALL SELECT DISTINCT 'input_user', 'in-' || {V('c % 7')}, 'I' || {V('c % 7')}, 'Input ' || {V('c % 7')},
  NULL, NULL FROM o
UNION ALL SELECT DISTINCT 'account_user', 'acct-' || {V('c % 11')}, 'A' || {V('c % 11')}, NULL, NULL, NULL FROM o""",
    "csv_merge_by_name": """SELECT CAST(c_custkey AS VARCHAR) AS target_id, c_name AS target_nickname,
  c_mktsegment AS activity_name, CAST(NULL AS VARCHAR) AS source_id FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, CAST(s_nationkey AS VARCHAR) FROM supplier""",
    "union_by_name": """SELECT CAST(c_custkey AS VARCHAR) AS target_id, c_name AS target_nickname,
  c_mktsegment AS activity_name, CAST(NULL AS VARCHAR) AS source_id FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, CAST(s_nationkey AS VARCHAR) FROM supplier""",
    "subscale_unpivot": """SELECT l_orderkey, l_linenumber, 'item-' || l_returnflag AS item_id, l_returnflag AS item_name,
  'text' AS item_type, 'completed' AS item_response_status, CAST(NULL AS DOUBLE) AS subscale_value,
  l_linestatus AS text_value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'subscale_name_quantity', 'quantity', 'subscale', 'completed', l_quantity, NULL
  FROM lineitem WHERE l_quantity IS NOT NULL
UNION ALL SELECT l_orderkey, l_linenumber, 'subscale_discount', 'subscale_discount', 'subscale', 'completed', l_discount,
  NULL FROM lineitem WHERE l_discount IS NOT NULL
UNION ALL SELECT l_orderkey, l_linenumber, 'activity_score', 'activity_score', 'subscale', 'completed', l_tax, NULL
  FROM lineitem WHERE l_tax IS NOT NULL""",
    "expand_options": expand_options_sql(),
    "long_responses": long_sql(),
    "data_dictionary": dictionary_sql(),
    "data_dictionary_full": dictionary_full_sql(),
    "options": options_sql(),
    "item_response_options": item_response_options_sql(),
    "scored_responses": scored_sql(),
    "score_join_m1": """SELECT o_custkey, o_orderkey, c_name, c_mktsegment
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "response_fields": RESPONSE_SQL,
    "response_untyped": RESPONSE_SQL,
    "parse_long_lists": """SELECT l_suppkey, count(*) AS n_options, sum(l_orderkey)::BIGINT AS sum_value,
  sum(l_linenumber)::BIGINT AS sum_score FROM lineitem GROUP BY l_suppkey""",
    "wide_mixed_scores": """WITH a AS (SELECT 'sub-' || CAST(o_orderkey AS VARCHAR) AS activity_submission_id,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 2 END AS v FROM orders)
SELECT activity_submission_id, CASE v WHEN 0 THEN 'Low' WHEN 1 THEN 'High' END AS rating, v AS rating__index,
  CASE v WHEN 0 THEN 'Low' WHEN 1 THEN 'High' END AS rating__response FROM a""",
    "partitioned_roundtrip": "SELECT o_orderkey, o_orderstatus, o_custkey, o_orderstatus AS by_o_orderstatus FROM orders",
    "roster_from_csv": """SELECT c_name AS secret_id, CAST(c_custkey AS VARCHAR) AS nickname, CAST(NULL AS VARCHAR) AS first_name,
  CAST(NULL AS VARCHAR) AS last_name, c_mktsegment AS site, CAST(c_nationkey AS VARCHAR) AS room FROM customer""",
    "wide_all": wide_sql(MOOD_COLS + ENERGY_COLS + COLOR_COLS + SUBSCALE_COLS + TEXT_COLS),
    "wide_single_select": wide_sql(MOOD_COLS + ENERGY_COLS),
    "wide_single_select_unscored": wide_sql(ENERGY_COLS),
    "wide_multi_select": wide_sql(COLOR_COLS),
    "wide_subscale": wide_sql(SUBSCALE_COLS),
    "wide_text": wide_text_sql(),
    "split_wide": split_wide_sql(),
    "align_full_outer": """WITH a AS (SELECT CASE WHEN event_type <> 'error' THEN event_type END AS kind,
                  CAST(ts AS DATE) AS day, count(*) AS n_events FROM events GROUP BY 1, 2),
b AS (SELECT CASE WHEN event_type <> 'error' THEN event_type END AS kind, CAST(ts AS DATE) AS day,
             max(event_id) AS max_big_event FROM events WHERE value > 50 GROUP BY 1, 2)
SELECT coalesce(a.kind, b.kind) AS kind, coalesce(a.day, b.day) AS day, a.n_events, b.max_big_event
FROM a FULL JOIN b ON a.kind IS NOT DISTINCT FROM b.kind AND a.day IS NOT DISTINCT FROM b.day""",
    "attendance_grid": ATTENDANCE_SQL,
    "completion_grid": COMPLETION_SQL,
    "completion_summary": COMPLETION_SUMMARY_SQL,
    "drop_null_columns": "SELECT * FROM orders",
    "csv_encode": csv_encode_sql(),
    "csv_roundtrip": "SELECT conv_id, turn, role, text FROM conversations",
    "parquet_roundtrip": wide_text_sql(),
}
