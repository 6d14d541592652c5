"""Scalar rules, predicates and projections over whole tables."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import functions as F

from estrato.functions import dates, numbers, text
from estrato.functions.dates import look_back
from estrato.functions.payload import field_or_null, payload_fields, payload_of
from estrato.operators.shape import drop_empty_or_zero
from estrato.plans.access import between_days, not_cancelled
from estrato.plans.registered.common import (
    br_text, cents, cents_sql, money, money_sql, pick, pick_sql, plain, table,
)
from estrato.plans.weather import SOURCES
from estrato.session import spread
from estrato.sources.relational import terminal_ids


def json_project(spark, sf):
    e = table(spark, sf, "events").withColumn("_p", payload_fields(F.col("props"), ["k", "none"]))
    return e.select(
        "event_id",
        field_or_null("_p", "k").alias("k_text"),
        field_or_null("_p", "k").cast("bigint").alias("k"),
        field_or_null("_p", "none").alias("absent"),
    )


JSON_PROJECT = """
select event_id, nullif(props->>'$.k', '') as k_text, cast(nullif(props->>'$.k', '') as bigint) as k,
       nullif(props->>'$.none', '') as absent
from events"""


def payload(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("DATA"),
        F.col("o_orderdate").alias("HORA"),
        F.nullif("o_orderstatus", F.lit("P")).alias("STATUS"),
        money("o_totalprice").alias("VALOR"),
        F.col("o_custkey").alias("CLIENTE"),
    )
    return o.select(
        "o_orderkey", payload_of(o, ["DATA", "HORA", "STATUS", "VALOR", "CLIENTE"]).alias("payload")
    )


PAYLOAD = f"""
select o_orderkey, concat('{{"DATA":"', strftime(o_orderdate, '%Y-%m-%d'), '","HORA":"',
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '","STATUS":',
  case when o_orderstatus = 'P' then 'null' else concat('"', o_orderstatus, '"') end,
  ',"VALOR":"', {money_sql(cents_sql('o_totalprice'))}, '","CLIENTE":', o_custkey, '}}') as payload
from orders"""


def ts_parts(spark, sf):
    ts = F.col("ts")
    return plain(
        table(spark, sf, "events").select(
            "event_id", ts.cast("date").alias("dt"), dates.time_of(ts).alias("hr")
        )
    )


TS_PARTS = """
select event_id, strftime(ts, '%Y-%m-%d') as dt, strftime(ts, '%H:%M:%S') as hr from events"""


def case_label(spark, sf):
    is_ticket = F.col("o_orderstatus") == "F"
    label = F.concat(F.lit("Ingresso - "), F.col("o_orderpriority"))
    member = F.concat(F.col("o_custkey").cast("string"), F.lit(" - "), F.col("o_orderpriority"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(is_ticket, label).otherwise(member).alias("label"),
        F.when(is_ticket, F.lit("Ingresso")).otherwise(F.lit("Sócio")).alias("kind"),
        F.trim(F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" "))).alias("name"),
    )


CASE_LABEL = """
select o_orderkey,
  case when o_orderstatus = 'F' then concat('Ingresso - ', o_orderpriority)
       else concat(o_custkey, ' - ', o_orderpriority) end as label,
  case when o_orderstatus = 'F' then 'Ingresso' else 'Sócio' end as kind,
  trim('  ' || o_orderpriority || ' ') as name
from orders"""

_GATES = "1, 5,,8,13, 21,34 "


def range_inlist(spark, sf):
    gates = terminal_ids(_GATES)
    at_gate = F.col("l_suppkey").isin(gates) | F.col("l_partkey").isin(gates)
    rows = table(spark, sf, "lineitem").where(
        between_days(F.col("l_shipdate"), date(1996, 1, 1), date(1999, 12, 31))
        & at_gate
        & not_cancelled(F.nullif("l_returnflag", F.lit("R")))
        & (F.col("l_orderkey") > 100)
    )
    return plain(
        rows.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate")
    )


RANGE_INLIST = """
select l_orderkey, l_linenumber, l_suppkey, l_partkey,
  cast(l_shipdate as varchar) as l_shipdate
from lineitem
where cast(l_shipdate as date) between date '1996-01-01' and date '1999-12-31'
  and (l_suppkey in (1, 5, 8, 13, 21, 34) or l_partkey in (1, 5, 8, 13, 21, 34))
  and coalesce(nullif(l_returnflag, 'R'), 'N') = 'N' and l_orderkey > 100"""


def lookback(spark, sf):
    since = look_back(datetime(2024, 1, 30), 48)
    rows = table(spark, sf, "events").where(F.col("ts") > F.lit(since.isoformat(" ")).cast("timestamp_ntz"))
    return plain(rows.select("event_id", "ts", "event_type"))


LOOKBACK = """
select event_id, cast(ts as varchar) as ts, event_type from events
where ts > timestamp '2024-01-30 00:00:00' - interval 48 hour"""


def split_code_label(spark, sf):
    key, name = F.col("o_orderkey"), F.col("o_orderpriority")
    k = key.cast("string")
    label = pick(
        key,
        F.concat(k, F.lit(" - "), name),
        F.concat(k, F.lit(" - "), name, F.lit(" - VIP")),
        F.concat(F.lit(" 1 "), k, F.lit(" -  x  ")),
        F.concat(F.lit("Ingresso - "), name),
        F.lit(" - "),
        F.concat(k, F.lit(" - ")),
        F.lit(""),
        F.lit(None),
        F.concat(F.lit("Semdelim"), k),
    )
    rows = table(spark, sf, "orders").select("o_orderkey", label.alias("label"))
    return rows.select(
        "o_orderkey",
        text.code_of(F.col("label")).alias("code"),
        text.label_of(F.col("label")).alias("kind"),
    )


_LABEL = pick_sql(
    "o_orderkey", "concat(o_orderkey, ' - ', o_orderpriority)",
    "concat(o_orderkey, ' - ', o_orderpriority, ' - VIP')", "concat(' 1 ', o_orderkey, ' -  x  ')",
    "concat('Ingresso - ', o_orderpriority)", "' - '", "concat(o_orderkey, ' - ')", "''", "null",
    "concat('Semdelim', o_orderkey)",
)
SPLIT_CODE_LABEL = f"""
with t as (select o_orderkey, {_LABEL} as label from orders),
h as (select *, regexp_replace(trim(split_part(label, ' - ', 1)), '\\s+', '', 'g') as head from t)
select o_orderkey,
  case when position(' - ' in coalesce(label, '')) > 0 and regexp_full_match(head, '[0-9]+')
       then cast(head as bigint) end as code,
  case when label is null or trim(label) = '' or position(' - ' in label) = 0
         or not regexp_full_match(head, '[0-9]+') then 'OUTROS'
       else nullif(trim(split_part(label, ' - ', 2)), '') end as kind
from h"""


def city_split(spark, sf):
    key, name = F.col("c_custkey"), F.col("c_name")
    raw = pick(
        key,
        F.concat(F.lit(" "), name, F.lit(",  SP ")),
        name,
        F.concat(name, F.lit(", Centro, SP")),
        F.lit(""),
        F.lit(None),
        F.concat(name, F.lit(",SP")),
    )
    rows = table(spark, sf, "customer").select("c_custkey", raw.alias("raw"))
    return rows.select(
        "c_custkey",
        text.city_of(F.col("raw")).alias("city"),
        text.state_of(F.col("raw")).alias("state"),
        numbers.digit_text_int(F.substring("raw", -2, 2)).alias("tail"),
    )


_CITY = pick_sql(
    "c_custkey", "' ' || c_name || ',  SP '", "c_name", "c_name || ', Centro, SP'", "''", "null",
    "c_name || ',SP'",
)
CITY_SPLIT = f"""
with t as (select c_custkey, {_CITY} as raw from customer),
n as (select *, case when raw is null or raw = '' then 'unknown' else trim(raw) end as place from t)
select c_custkey,
  trim(case when contains(place, ', ') then split_part(place, ', ', 1) else place end) as city,
  case when contains(place, ', ')
       then trim(substr(place, position(', ' in place) + 2)) end as state,
  case when regexp_full_match(right(raw, 2), '[0-9]+') then cast(right(raw, 2) as int) end as tail
from n"""


def br_decimal(spark, sf):
    price = cents("o_totalprice")
    raw = pick(
        F.col("o_orderkey"),
        br_text(price),
        F.concat(F.lit("  -"), br_text(price), F.lit(" ")),
        (price / 100).cast("decimal(18,2)").cast("string"),
        F.concat(F.lit("R$ "), br_text(price)),
        F.lit(""),
        F.concat(price.cast("string"), F.lit(",4567")),
        F.lit("0,0049999995"),
        F.lit("12345678901234567,00"),
    )
    rows = table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    return plain(rows.select("o_orderkey", numbers.br_decimal(F.col("raw")).alias("amount")))


_C = cents_sql("o_totalprice")
BR_DECIMAL = f"""
select o_orderkey, {pick_sql(
    'o_orderkey', money_sql(_C), "'-' || " + money_sql(_C), f"concat({_C}, '.00')", 'null', 'null',
    f"concat({_C}, '.46')", "'0.00'", "'12345678901234567.00'")} as amount
from orders"""


def digits_int(spark, sf):
    size = F.col("p_size").cast("string")
    raw = pick(
        F.col("p_partkey"),
        F.concat(size, F.lit("°")),
        F.concat(F.lit(" / "), size, F.lit("° ")),
        F.concat(F.lit("-"), size),
        F.concat(F.lit("10-"), size),
        F.lit("N/A"),
        F.concat(size, F.lit(".5")),
    )
    rows = table(spark, sf, "part").select("p_partkey", raw.alias("raw"))
    return rows.select("p_partkey", numbers.digits_int(F.col("raw")).alias("degrees"))


DIGITS_INT = f"""
select p_partkey, {pick_sql(
    'p_partkey', 'p_size', 'p_size', '-p_size', 'null', 'null', 'p_size * 10 + 5')} as degrees
from part"""


def whole_number(spark, sf):
    q = F.col("l_quantity").cast("int").cast("string")
    raw = pick(
        F.col("l_partkey"), q, F.concat(F.lit(" "), q, F.lit(".9")), F.concat(q, F.lit("d")),
        F.lit(""), F.concat(q, F.lit("e2")), F.lit("9007199254740993"), F.lit("-.75"), F.lit("0.9999999"),
    )
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", raw.alias("raw"))
    return rows.select(
        "l_orderkey", "l_partkey", numbers.whole_number(F.col("raw")).alias("qtd")
    )


_Q = "cast(l_quantity as bigint)"
WHOLE_NUMBER = f"""
select l_orderkey, l_partkey, {pick_sql('l_partkey', _Q, _Q, 'null', 'null', _Q + ' * 100', '9007199254740993', '0', '0')} as qtd
from lineitem"""


def dayfirst_date(spark, sf):
    day = F.col("o_orderdate")
    clock = F.lpad((F.col("o_custkey") % 24).cast("string"), 2, "0")
    raw = pick(
        F.col("o_orderkey"),
        F.date_format(day, "dd/MM/yyyy"),
        F.concat(F.date_format(day, "dd/MM/yyyy "), clock, F.lit(":07")),
        F.date_format(day, "yyyy-MM-dd"),
        F.concat(F.lit(" "), F.date_format(day, "d/M/yyyy "), clock, F.lit(":08:09 ")),
        F.lit("31/02/2025"),
        F.lit("N/A"),
        F.concat(F.date_format(day, "dd/MM/yy "), clock, F.lit(":07")),
        F.lit("1/2/03"),
    )
    rows = table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    stamp = dates.day_first_timestamp(F.col("raw"))
    return plain(
        rows.select(
            "o_orderkey",
            dates.day_first_date(F.col("raw")).alias("dt"),
            dates.time_of(stamp).alias("hr"),
            dates.iso_or_br_date(F.col("raw")).alias("dt_strict"),
        )
    )


_D = "strftime(o_orderdate, '%Y-%m-%d')"
_H = "lpad(cast(o_custkey % 24 as varchar), 2, '0')"
DAYFIRST_DATE = f"""
select o_orderkey, {pick_sql('o_orderkey', _D, _D, _D, _D, 'null', 'null', _D, "'2003-02-01'")} as dt,
  {pick_sql('o_orderkey', "'00:00:00'", _H + " || ':07:00'", "'00:00:00'", _H + " || ':08:09'",
            'null', 'null', _H + " || ':07:00'", "'00:00:00'")} as hr,
  {pick_sql('o_orderkey', _D, 'null', _D, 'null', 'null', 'null', 'null', 'null')} as dt_strict
from orders"""


def time_of_day(spark, sf):
    clock = F.substring(F.col("ts").cast("string"), 12, 8)
    raw = pick(
        F.col("event_id"), clock, F.substring(clock, 1, 5), F.concat(F.lit(" "), clock),
        F.lit("25:00"), F.lit(""),
    )
    rows = table(spark, sf, "events").select("event_id", raw.alias("raw"))
    return rows.select("event_id", dates.time_of_day(F.col("raw")).alias("hr"))


_T = "strftime(ts, '%H:%M:%S')"
TIME_OF_DAY = f"""
select event_id, {pick_sql('event_id', _T, f"left({_T}, 5) || ':00'", _T, 'null', 'null')} as hr
from events"""


def scrape_time(spark, sf):
    ts = F.col("ts")
    iso, clock = ts.cast("date").cast("string"), dates.time_of(ts)
    e = F.col("event_id")
    day = pick(
        e, iso, iso, F.concat_ws("/", F.substring(iso, 9, 2), F.substring(iso, 6, 2), F.substring(iso, 1, 4)),
        F.lit(None), F.lit("ontem"), iso,
    )
    hour = pick(e, clock, F.lit(None), clock, clock, clock, F.lit("agora"))
    rows = table(spark, sf, "events").select("event_id", day.alias("d"), hour.alias("h"))
    run_ts = datetime(2025, 1, 1, tzinfo=UTC)
    return plain(
        rows.select("event_id", dates.scraped_at(F.col("d"), F.col("h"), run_ts).alias("at"))
    )


_AT = "epoch_us(date_trunc('second', ts)) + 10800000000"
_RUN = "1735689600000000"
SCRAPE_TIME = f"""
select event_id, cast({pick_sql('event_id', _AT, "epoch_us(date_trunc('day', ts)) + 10800000000",
                                _AT, _RUN, _RUN, _RUN)} as bigint) as at
from events"""


def flag_match(spark, sf):
    address = F.concat(F.lit(" \t"), F.col("c_mktsegment"), F.lit("@Park.example "))
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") > 3, text.email(address)).alias("email")
    )
    return rows.select(
        "c_custkey", "email", text.match_flag(F.col("email"), "building@park.example").alias("teste")
    )


FLAG_MATCH = """
with t as (select c_custkey, case when c_nationkey > 3
  then lower(c_mktsegment) || '@park.example' end as email from customer)
select c_custkey, email, case when email = 'building@park.example' then 'SIM'
  when email is not null then 'NÃO' end as teste from t"""


def canonical(spark, sf):
    c = F.col("c_custkey")
    origin = pick(c, F.lit("ACCU x"), F.lit("AccuWeather"), F.lit("climatempo"), F.lit("outra"), F.lit(None))
    city = pick(c, F.concat(F.col("c_name"), F.lit(", SP")), F.concat(F.col("c_name"), F.lit(",SP ")), F.col("c_name"))
    state = pick(c, F.lit(" sp "), F.lit(""), F.lit(None), F.lit("rj"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        text.canonical_by_prefix(origin, SOURCES).alias("origin"),
        text.without_state(city).alias("city"),
        text.state_or(state).alias("state"),
    )


CANONICAL = f"""
select c_custkey,
  {pick_sql('c_custkey', "'AccuWeather'", "'AccuWeather'", "'Climatempo'", "'outra'", 'null')} as origin,
  c_name as city,
  {pick_sql('c_custkey', "'SP'", "'SP'", "'SP'", "'RJ'")} as state
from customer"""


def drop_zero(spark, sf):
    tenths = F.round(F.col("l_discount") * 100).cast("int").cast("string")
    raw = pick(
        F.col("l_partkey"), F.concat(tenths, F.lit("%")), F.concat(tenths, F.lit(",00 ")),
        F.lit(" null"), F.lit(None), F.lit("Produto"),
    )
    rows = spread(table(spark, sf, "lineitem")).select(
        "l_orderkey", "l_linenumber", "l_partkey", raw.alias("discount")
    )
    return drop_empty_or_zero(rows, ["discount"])


_P = "cast(cast(round(l_discount * 100) as int) as varchar)"
DROP_ZERO = f"""
with t as (select l_orderkey, l_linenumber, l_partkey, l_discount,
  {pick_sql('l_partkey', _P + " || '%'", _P + " || ',00 '", "' null'", 'null', "'Produto'")} as discount
  from lineitem)
select l_orderkey, l_linenumber, l_partkey, discount from t
where l_partkey % 5 = 4 or (l_partkey % 5 < 2 and round(l_discount * 100) > 0)"""


QUERIES = {
    "q_json_project": (json_project, JSON_PROJECT),
    "q_payload": (payload, PAYLOAD),
    "q_ts_parts": (ts_parts, TS_PARTS),
    "q_case_label": (case_label, CASE_LABEL),
    "q_range_inlist": (range_inlist, RANGE_INLIST),
    "q_lookback": (lookback, LOOKBACK),
    "q_split_code_label": (split_code_label, SPLIT_CODE_LABEL),
    "q_city_split": (city_split, CITY_SPLIT),
    "q_br_decimal": (br_decimal, BR_DECIMAL),
    "q_digits_int": (digits_int, DIGITS_INT),
    "q_whole_number": (whole_number, WHOLE_NUMBER),
    "q_dayfirst_date": (dayfirst_date, DAYFIRST_DATE),
    "q_time_of_day": (time_of_day, TIME_OF_DAY),
    "q_scrape_time": (scrape_time, SCRAPE_TIME),
    "q_flag_match": (flag_match, FLAG_MATCH),
    "q_canonical": (canonical, CANONICAL),
    "q_drop_zero": (drop_zero, DROP_ZERO),
}
