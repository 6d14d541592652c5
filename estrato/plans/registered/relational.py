"""Joins, aggregates, windows and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from estrato import schemas
from estrato.functions.payload import payload_fields
from estrato.operators.aggregates import (
    latest_per_key, newest, pivot_sources, prefer_source, text_lists,
)
from estrato.operators.audit import audit_counts, preview, profile_table
from estrato.operators.incremental import insert_new, merge_upsert, not_in
from estrato.operators.joins import (
    Dim, exclude_category, lookup_default, star_join, union_origin,
)
from estrato.operators.ordered import forward_fill
from estrato.operators.shape import align_to_schema, drop_blank_keys, drop_empty_rows
from estrato.plans.registered.common import (
    cents, cents_sql, money, pick, pick_sql, plain, table,
)


def star_multi_key(spark, sf):
    lines = table(spark, sf, "lineitem")
    lines = lines.where(F.col("l_returnflag") != "A").withColumn("l_status", F.col("l_linestatus"))
    star = star_join(lines, "l", [
        Dim(
            table(spark, sf, "orders"), "o",
            [("l.l_orderkey", "o_orderkey"), ("l.l_status", "o_orderstatus")],
            where=F.col("o_orderpriority") != "5-LOW",
        ),
        Dim(table(spark, sf, "customer"), "c", [("o.o_custkey", "c_custkey")], "left"),
        Dim(
            table(spark, sf, "supplier"), "s", [("l.l_suppkey", "s_suppkey")], "left",
            where=F.col("s_acctbal") > 0,
        ),
        Dim(table(spark, sf, "nation"), "n", [("s.s_nationkey", "n_nationkey")], "left"),
        Dim(table(spark, sf, "region"), "r", [("n.n_regionkey", "r_regionkey")], "left"),
    ])
    return star.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "c_mktsegment", "s_name",
        "n_name", "r_name",
    )


STAR_MULTI_KEY = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, c_mktsegment, s_name, n_name, r_name
from lineitem
join orders on o_orderkey = l_orderkey and o_orderstatus = l_linestatus
  and o_orderpriority <> '5-LOW'
left join customer on c_custkey = o_custkey
left join supplier on s_suppkey = l_suppkey and s_acctbal > 0
left join nation on n_nationkey = s_nationkey
left join region on r_regionkey = n_regionkey
where l_returnflag <> 'A'"""


def role_playing(spark, sf):
    nation = table(spark, sf, "nation")
    star = star_join(table(spark, sf, "lineitem"), "l", [
        Dim(table(spark, sf, "orders"), "o", [("l.l_orderkey", "o_orderkey")]),
        Dim(table(spark, sf, "customer"), "c", [("o.o_custkey", "c_custkey")]),
        Dim(table(spark, sf, "supplier"), "s", [("l.l_suppkey", "s_suppkey")]),
        Dim(nation, "n_in", [("c.c_nationkey", "n_nationkey")]),
        Dim(nation, "n_out", [("s.s_nationkey", "n_nationkey")], "left"),
    ])
    return star.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("n_in.n_name").alias("entry"), F.col("n_out.n_name").alias("exit"),
    )


ROLE_PLAYING = """
select l_orderkey, l_linenumber, l_partkey, a.n_name as entry, b.n_name as exit
from lineitem join orders o on o_orderkey = l_orderkey join customer on c_custkey = o.o_custkey
join supplier on s_suppkey = l_suppkey join nation a on a.n_nationkey = c_nationkey
left join nation b on b.n_nationkey = s_nationkey"""


def contact_rows(spark, sf):
    """Four contacts per customer, as rows of a kind and a text."""
    key = F.col("c_custkey").cast("string")
    contact = F.array(
        F.struct(F.lit("E").alias("tipo"), F.concat(key, F.lit("@b.example")).alias("informacao")),
        F.struct(F.lit("E").alias("tipo"), F.concat(key, F.lit("@a.example")).alias("informacao")),
        F.struct(
            F.when(F.col("c_acctbal") > 5000, "C").otherwise("X").alias("tipo"),
            F.concat(F.lit("9"), key).alias("informacao"),
        ),
        F.struct(
            F.lit("F").alias("tipo"),
            F.when(F.col("c_nationkey") > 3, F.concat(F.lit("2"), key)).alias("informacao"),
        ),
    )
    return table(spark, sf, "customer").select("c_custkey", F.inline(contact))


def string_agg(spark, sf):
    kinds = {"email": "E", "celular": "C", "telefone": "F"}
    return text_lists(contact_rows(spark, sf), ["c_custkey"], "tipo", "informacao", kinds)


CONTACT_ROWS = """
select c_custkey, 'E' as tipo, concat(c_custkey, '@b.example') as informacao from customer
union all select c_custkey, 'E', concat(c_custkey, '@a.example') from customer
union all select c_custkey, case when c_acctbal > 5000 then 'C' else 'X' end,
  concat('9', c_custkey) from customer
union all select c_custkey, 'F', case when c_nationkey > 3 then concat('2', c_custkey) end
  from customer"""
STRING_AGG = f"""
with t as ({CONTACT_ROWS})
select c_custkey, string_agg(informacao, ' / ' order by informacao) filter (where tipo = 'E') as email,
  string_agg(informacao, ' / ' order by informacao) filter (where tipo = 'C') as celular,
  string_agg(informacao, ' / ' order by informacao) filter (where tipo = 'F') as telefone
from t group by 1"""


def lookup(spark, sf):
    names = spark.sql(
        "select * from values ('BUILDING', 'Adulto', true), ('MACHINERY', 'OUTROS', true), "
        "('HOUSEHOLD', 'Infantil', false), ('FURNITURE', 'Senior', true) "
        "as t(c_mktsegment, tipo_publico, active)"
    )
    rows = lookup_default(
        table(spark, sf, "customer").select("c_custkey", "c_mktsegment"),
        names, "c_mktsegment", "tipo_publico", "CHECK", "active",
    )
    return exclude_category(rows, "tipo_publico", "OUTROS")


LOOKUP = """
with d(seg, tipo_publico, active) as (values ('BUILDING', 'Adulto', true),
  ('MACHINERY', 'OUTROS', true), ('HOUSEHOLD', 'Infantil', false), ('FURNITURE', 'Senior', true))
select c_custkey, c_mktsegment, coalesce(tipo_publico, 'CHECK') as tipo_publico
from customer left join d on seg = c_mktsegment and active
where tipo_publico is null or tipo_publico <> 'OUTROS'"""


def anti_incremental(spark, sf):
    orders = table(spark, sf, "orders")
    loaded = orders.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    loaded = loaded.select(F.col("o_orderkey").cast("string").alias("id_acesso"))
    source = orders.select(
        F.col("o_orderkey").cast("string").alias("id_acesso"), "o_custkey", "o_orderstatus"
    )
    return not_in(source, loaded, ["id_acesso"])


ANTI_INCREMENTAL = """
select cast(o.o_orderkey as varchar) as id_acesso, o.o_custkey, o.o_orderstatus
from orders o left join (select * from orders where o_orderdate < timestamp '1999-01-01') t
  on t.o_orderkey = o.o_orderkey where t.o_orderkey is null"""

_KEYS = ["o_custkey", "o_orderpriority"]


def insert_first(spark, sf):
    orders = table(spark, sf, "orders").select(*_KEYS, "o_orderkey", "o_orderdate", "o_orderstatus")
    target = orders.where(F.col("o_orderstatus") == "F")
    order = [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()]
    return plain(insert_new(target, orders, _KEYS, order))


INSERT_FIRST = """
select o_custkey, o_orderpriority, o_orderkey, cast(o_orderdate as varchar) as o_orderdate,
  o_orderstatus
from (select *, row_number() over (partition by o_custkey, o_orderpriority
                                   order by o_orderdate, o_orderkey) as n from orders) o
where n = 1 and not exists (select 1 from orders t where t.o_orderstatus = 'F'
  and t.o_custkey = o.o_custkey and t.o_orderpriority = o.o_orderpriority)"""


def upsert_balances(spark, sf):
    state = F.when(F.col("c_nationkey") > 5, F.col("c_mktsegment")).alias("uf")
    customers = table(spark, sf, "customer")
    target = customers.select("c_custkey", state, cents("c_acctbal").alias("balance"))
    paid = (
        table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
        .groupBy("o_custkey").agg(F.sum(cents("o_totalprice")).alias("balance"))
    )
    source = paid.join(
        customers.select("c_custkey", state), F.col("o_custkey") == F.col("c_custkey")
    ).select("c_custkey", "uf", "balance")
    return merge_upsert(target, source, ["c_custkey", "uf"])


UPSERT_BALANCES = f"""
with paid as (select o_custkey, cast(sum({cents_sql('o_totalprice')}) as bigint) as balance
  from orders where o_orderpriority = '1-URGENT' group by 1)
select c_custkey, case when c_nationkey > 5 then c_mktsegment end as uf,
  coalesce(balance, {cents_sql('c_acctbal')}) as balance
from customer left join paid on o_custkey = c_custkey"""


def latest(spark, sf):
    rows = table(spark, sf, "events").select(
        "user_id", F.nullif("event_type", F.lit("error")).alias("uf"), "event_id",
        F.when(F.col("event_type") != "click", F.col("ts")).alias("scraped"), "value",
    )
    return plain(latest_per_key(rows, ["user_id", "uf"], newest("scraped", "event_id")))


LATEST = """
select user_id, uf, event_id, scraped, value from (
  select user_id, nullif(event_type, 'error') as uf, event_id, value,
    case when event_type <> 'click' then cast(ts as varchar) end as scraped,
    row_number() over (partition by user_id, nullif(event_type, 'error')
      order by case when event_type <> 'click' then ts end desc nulls first, event_id desc) as n
  from events) where n = 1"""


def _pivoted(spark, sf):
    rows = table(spark, sf, "events").withColumn(
        "p", payload_fields(F.col("props"), ["k"])
    ).select(
        "user_id", F.to_date("ts").alias("day"), "event_type", "ts", "value",
        F.when(F.col("p.k") > "5", F.col("p.k")).otherwise(F.lit("")).alias("k"),
    )
    return pivot_sources(
        rows, ["user_id", "day"], "event_type", {"acc": "click", "cli": "purchase"},
        ["ts", "value", "k"],
    )


_PIVOTED = """
with e as (select user_id, cast(cast(ts as date) as varchar) as day, event_type, ts, value,
    case when props->>'$.k' > '5' then props->>'$.k' else '' end as k from events),
p as (select user_id, day,
    max(ts) filter (where event_type = 'click') as acc_ts,
    max(value) filter (where event_type = 'click') as acc_value,
    max(k) filter (where event_type = 'click') as acc_k,
    max(ts) filter (where event_type = 'purchase') as cli_ts,
    max(value) filter (where event_type = 'purchase') as cli_value,
    max(k) filter (where event_type = 'purchase') as cli_k
  from e group by 1, 2)"""


def pivot_max(spark, sf):
    return plain(_pivoted(spark, sf))


PIVOT_MAX = _PIVOTED + """
select user_id, day, cast(acc_ts as varchar) as acc_ts, acc_value, acc_k,
  cast(cli_ts as varchar) as cli_ts, cli_value, cli_k from p"""


def prefer(spark, sf):
    return plain(_pivoted(spark, sf).select(
        "user_id", "day",
        prefer_source(["acc", "cli"], "value").alias("value"),
        prefer_source(["acc", "cli"], "k", [""]).alias("k"),
        F.greatest("acc_ts", "cli_ts").alias("updated"),
    ))


PREFER = _PIVOTED + """
select user_id, day, coalesce(acc_value, cli_value) as value,
  coalesce(nullif(acc_k, ''), nullif(cli_k, '')) as k,
  cast(greatest(acc_ts, cli_ts) as varchar) as updated from p"""


def union_facts(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), money("c_acctbal").alias("balance")
    )
    s = table(spark, sf, "supplier").select(
        money("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    return union_origin({"C": c, "S": s}).select("origem", "id", "name", cents("balance").alias("balance"))


UNION_FACTS = f"""
select 'C' as origem, c_custkey as id, c_name as name, {cents_sql('c_acctbal')} as balance from customer
union all
select 'S', s_suppkey, s_name, {cents_sql('s_acctbal')} from supplier"""


def counts(spark, sf):
    rows = table(spark, sf, "lineitem")
    return audit_counts(rows, {
        "all": F.lit(True),
        "returned": F.col("l_returnflag") == "R",
        "discounted": F.col("l_discount") > 0,
        "without_flag": F.nullif("l_returnflag", F.lit("N")).isNull(),
    })


COUNTS = """
with t as (select * from lineitem)
select 'all' as "check", count(*) as "rows" from t
union all select 'returned', count(*) from t where l_returnflag = 'R'
union all select 'discounted', count(*) from t where l_discount > 0
union all select 'without_flag', count(*) from t where l_returnflag = 'N'"""

# The columns of the profiled tables.
_PROFILED = {
    "orders": "o_orderkey:bigint o_custkey:bigint o_orderstatus:string o_totalprice:double "
              "o_orderdate:timestamp_ntz o_orderpriority:string",
    "lineitem": "l_orderkey:bigint l_partkey:bigint l_suppkey:bigint l_linenumber:int "
                "l_quantity:double l_extendedprice:double l_discount:double l_tax:double "
                "l_returnflag:string l_linestatus:string l_shipdate:timestamp_ntz",
    "events": "event_id:bigint ts:timestamp_ntz user_id:bigint event_type:string value:double "
              "props:string",
    "documents": "doc_id:bigint text:string lang:string source:string n_chars:bigint",
}


def profile(spark, sf):
    parts = [profile_table(table(spark, sf, name), name) for name in _PROFILED]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


PROFILE = "\nunion all ".join(
    f"select '{name}' as table_name, {i} as position, '{col}' as column_name, "
    f"'{kind}' as data_type, count(*) as row_count, count(*) - count({col}) as null_count from {name}"
    for name, spec in _PROFILED.items()
    for i, (col, _, kind) in enumerate(c.partition(":") for c in spec.split())
)


def preview_rows(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", cents("l_extendedprice").alias("price")
    )
    order = [F.col("price").desc(), F.col("l_orderkey").asc(), F.col("l_linenumber").asc(), F.col("l_partkey").asc()]
    return preview(rows, order, 10)


PREVIEW = f"""
select l_orderkey, l_linenumber, l_partkey, {cents_sql('l_extendedprice')} as price from lineitem
order by price desc, l_orderkey, l_linenumber, l_partkey limit 10"""


def align(spark, sf):
    rows = table(spark, sf, "part").select(
        F.col("p_name").alias("produto"), F.col("p_type").alias("categoria"),
        F.col("p_size").alias("pax"), "p_retailprice",
    )
    return align_to_schema(rows, schemas.PRODUCTS)


ALIGN = """
select p_name as produto, cast(null as varchar) as tipo_produto, p_type as categoria,
  cast(null as varchar) as infantil, cast(p_size as bigint) as pax,
  cast(null as varchar) as fonte_tabela_bronze from part"""


def fill(spark, sf):
    rows = table(spark, sf, "events").select(
        "user_id", "event_id",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("last_value"),
        F.when(F.col("event_type") == "signup", F.col("props")).alias("last_props"),
    )
    return forward_fill(rows, ["user_id"], "event_id", ["last_value", "last_props"])


FILL = """
select user_id, event_id,
  last_value(case when event_type = 'purchase' then value end ignore nulls) over w as last_value,
  last_value(case when event_type = 'signup' then props end ignore nulls) over w as last_props
from events
window w as (partition by user_id order by event_id rows between unbounded preceding and current row)"""


def empty_rows(spark, sf):
    key = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(
        pick(key, F.col("c_name"), F.lit(None), F.lit(None)).alias("cliente"),
        pick(key, F.lit(None), F.lit(None), F.col("c_mktsegment")).alias("cidade"),
        F.concat(F.lit("c"), key.cast("string")).alias("fonte"),
    )
    return drop_empty_rows(rows, ["cliente", "cidade"])


EMPTY_ROWS = f"""
select * from (select {pick_sql('c_custkey', 'c_name', 'null', 'null')} as cliente,
  {pick_sql('c_custkey', 'null', 'null', 'c_mktsegment')} as cidade,
  concat('c', c_custkey) as fonte from customer)
where cliente is not null or cidade is not null"""


def blank_keys(spark, sf):
    voucher = pick(
        F.col("o_orderkey"), F.col("o_orderkey").cast("string"), F.lit(None), F.lit("  "),
        F.concat(F.lit(" "), F.col("o_custkey").cast("string")),
    )
    rows = table(spark, sf, "orders").select("o_orderkey", voucher.alias("voucher"))
    kept, aside = drop_blank_keys(rows, ["voucher"])
    return union_origin({"kept": kept, "aside": aside})


BLANK_KEYS = f"""
select case when trim(coalesce(voucher, '')) = '' then 'aside' else 'kept' end as origem, * from (
select o_orderkey, {pick_sql('o_orderkey', 'cast(o_orderkey as varchar)', 'null', "'  '",
                             "concat(' ', o_custkey)")} as voucher from orders)"""

QUERIES = {
    "q_star_multi_key": (star_multi_key, STAR_MULTI_KEY),
    "q_role_playing": (role_playing, ROLE_PLAYING),
    "q_string_agg": (string_agg, STRING_AGG),
    "q_lookup_default": (lookup, LOOKUP),
    "q_anti_incremental": (anti_incremental, ANTI_INCREMENTAL),
    "q_insert_new": (insert_first, INSERT_FIRST),
    "q_merge_upsert": (upsert_balances, UPSERT_BALANCES),
    "q_latest_per_key": (latest, LATEST),
    "q_pivot_max": (pivot_max, PIVOT_MAX),
    "q_prefer_source": (prefer, PREFER),
    "q_union_origin": (union_facts, UNION_FACTS),
    "q_audit_counts": (counts, COUNTS),
    "q_profile": (profile, PROFILE),
    "q_preview": (preview_rows, PREVIEW),
    "q_align_schema": (align, ALIGN),
    "q_ffill": (fill, FILL),
    "q_drop_empty_rows": (empty_rows, EMPTY_ROWS),
    "q_blank_keys": (blank_keys, BLANK_KEYS),
}
