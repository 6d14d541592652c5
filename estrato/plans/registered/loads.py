"""Writes: batches, idempotent inserts, versions, watermarks, the stream."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from estrato import schemas
from estrato.functions.dates import last_days, snapshot_until_yesterday, today_only
from estrato.functions.payload import field_or_null, payload_fields
from estrato.operators.incremental import get_watermark, set_watermark, watermark_row
from estrato.operators.joins import union_origin
from estrato.plans.registered.common import (
    RUN_MICROS, RUN_TS, cents, cents_sql, money_sql, plain, table,
)
from estrato.plans.access import between_days
from estrato.plans.weather import with_ingestion
from estrato.session import work_dir
from estrato.sources.buckets import insert_bucketed
from estrato.sources.compaction import compact, remove_replaced
from estrato.sources.tables import (
    append_batch, datasets_with_suffix, read_appended, read_current,
    truncate, upsert, write_reports, write_version,
)
from estrato.streaming import event_time
from estrato.streaming.micro_batch import insert_stream, new_files


def append_rows(spark, sf):
    rows = with_ingestion(
        table(spark, sf, "events").select("event_id", "event_type"), "scrape_run", RUN_TS
    ).drop("bronze_id")
    path = work_dir(spark, "append")
    for kind in ("click", "view"):
        append_batch(rows.where(F.col("event_type") == kind), path, kind)
    rest = rows.where(~F.col("event_type").isin("click", "view"))
    append_batch(rest, path, "rest")
    append_batch(rest, path, "rest")  # the same load again replaces its own rows
    return plain(read_appended(spark, path, rows.schema))


APPEND_ROWS = f"""
select event_id, event_type, 'scrape_run' as ingestion_type,
  cast(null as varchar) as ingestion_batch, {RUN_MICROS} as ingested_at from events"""

def truncated(spark, sf):
    """A table that is emptied and then holds what comes after."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    path = work_dir(spark, "truncate")
    upsert(rows, path, ["o_orderkey"])
    truncate(spark, path, rows.schema)
    upsert(rows.where(F.col("o_orderstatus") == "F"), path, ["o_orderkey"])
    return read_current(spark, path, rows.schema)


TRUNCATED = "select o_orderkey, o_orderstatus from orders where o_orderstatus = 'F'"


def run_windows(spark, sf):
    """The days a run takes in, by the kind of run: rows for each."""
    day = date(1996, 7, 1)
    o = table(spark, sf, "orders")
    windows = {
        "snapshot": snapshot_until_yesterday(day, date(1996, 1, 1)), "today": today_only(day),
        "days": last_days(day, 30),
    }
    counts = [F.count_if(between_days(F.col("o_orderdate").cast("date"), *w)).alias(n) for n, w in windows.items()]
    return o.agg(*counts)


RUN_WINDOWS = """
select count(*) filter (cast(o_orderdate as date) between date '1996-01-01' and date '1996-06-30') as snapshot,
  count(*) filter (cast(o_orderdate as date) = date '1996-07-01') as today,
  count(*) filter (cast(o_orderdate as date) between date '1996-06-01' and date '1996-07-01') as days
from orders"""


def evolved(spark, sf):
    """Loads of one table that gain a column and widen two: read by the schemas kept beside them."""
    o = table(spark, sf, "orders")
    number = F.col("o_custkey").cast("int")
    loads = [
        o.where("o_orderkey % 3 = 0").select("o_orderkey", number.alias("customer"), F.col("o_orderdate").cast("date").alias("day")),
        o.where("o_orderkey % 3 = 1").select("o_orderkey", "o_orderstatus", F.col("o_custkey").alias("customer"), F.col("o_orderdate").alias("day")),
        o.where("o_orderkey % 3 = 2").select("o_orderkey", "o_orderstatus", (cents("o_totalprice").cast("decimal(20,0)") / 100).cast("decimal(18,2)").alias("customer")),
    ]
    path = work_dir(spark, "evolve")
    for n, rows in enumerate(loads, 1):
        append_batch(rows, path, str(n))
    return plain(read_appended(spark, path))


EVOLVED = f"""
select o_orderkey, case when o_orderkey % 3 <> 0 then o_orderstatus end as o_orderstatus,
  case when o_orderkey % 3 = 2 then {money_sql(cents_sql('o_totalprice'))} else concat(o_custkey, '.00') end as customer,
  case o_orderkey % 3 when 0 then strftime(o_orderdate, '%Y-%m-%d 00:00:00') when 1 then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as day
from orders"""

def compacted(spark, sf):
    """A table of many small loads packed into few files; one load comes again after that."""
    rows = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    path, part = work_dir(spark, "compact"), F.col("event_id") % 9
    for n in range(9):
        append_batch(rows.where(part == n), path, str(n))
    files = compact(spark, path, rows.schema.fields)
    append_batch(rows.where(part == 4).withColumn("event_type", F.lit("again")), path, "4")
    remove_replaced(spark, path)
    return read_appended(spark, path, rows.schema).withColumn("files", F.lit(files))


COMPACTED = """
select event_id, user_id, case when event_id % 9 = 4 then 'again' else event_type end as event_type,
  cast(1 as int) as files from events"""


def inserted(spark, sf):
    """The rows that each of three inserts reports as new."""
    rows = table(spark, sf, "orders").select(*_KEYS, "o_orderkey", "o_orderstatus")
    path = work_dir(spark, "inserted")
    order = [F.col("o_orderkey").asc()]
    loads = (rows.where(F.col("o_orderstatus") == "F"), rows, rows)
    counts = [(i + 1, insert_bucketed(df, path, _KEYS, order, str(i))) for i, df in enumerate(loads)]
    return spark.createDataFrame(counts, "load int, new_rows long")


INSERTED = """
with k as (select o_custkey, o_orderpriority, bool_or(o_orderstatus = 'F') as first from orders group by all)
select 1 as load, count(*) filter (first) as new_rows from k
union all select 2, count(*) filter (not first) from k
union all select 3, 0"""

_KEYS = ["o_custkey", "o_orderpriority"]


def insert_batches(spark, sf):
    rows = table(spark, sf, "orders").select(*_KEYS, "o_orderkey", "o_orderstatus")
    path = work_dir(spark, "insert")
    order = [F.col("o_orderkey").asc()]
    insert_bucketed(rows.where(F.col("o_orderstatus") == "F"), path, _KEYS, order, "1")
    insert_bucketed(rows, path, _KEYS, order, "2")
    insert_bucketed(rows, path, _KEYS, order, "3")  # nothing is new any more
    stored = spark.read.schema("o_custkey long, o_orderpriority string, o_orderkey long, "
                               "o_orderstatus string, batch string").parquet(path)
    return stored.select(*rows.columns, "batch")


INSERT_BATCHES = """
select o_custkey, o_orderpriority, o_orderkey, o_orderstatus,
  case when o_orderstatus = 'F' then '1' else '2' end as batch
from (select *, row_number() over (partition by o_custkey, o_orderpriority
    order by case when o_orderstatus = 'F' then 0 else 1 end, o_orderkey) as n from orders)
where n = 1"""


def upsert_versions(spark, sf):
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("uf"),
        cents("c_acctbal").alias("balance"),
    )
    path = work_dir(spark, "upsert")
    write_version(customers, path)
    changed = customers.where(F.col("balance") < 200000).withColumn(
        "balance", F.lit(0).cast("long")
    )
    upsert(changed, path, ["c_custkey", "uf"])
    return read_current(spark, path, customers.schema)


UPSERT_VERSIONS = f"""
select c_custkey, nullif(c_mktsegment, 'BUILDING') as uf,
  case when {cents_sql('c_acctbal')} < 200000 then 0 else {cents_sql('c_acctbal')} end as balance
from customer"""


def report_datasets(spark, sf):
    month = F.date_format(F.col("o_orderdate"), "yyyyMM")
    rows = table(spark, sf, "orders").select(
        F.concat(F.lit("t_"), month, F.when(F.col("o_orderstatus") == "F", "_182").otherwise("_270"))
        .alias("src_table"),
        "o_orderkey", "o_orderstatus",
    )
    path = work_dir(spark, "datasets")
    write_reports(rows, path, "append")
    replaced = rows.where(F.col("o_orderstatus") == "F").withColumn("o_orderstatus", F.lit("G"))
    write_reports(replaced, path, "overwrite")
    stored = spark.read.schema(rows.schema).parquet(path)
    return datasets_with_suffix(stored, "182").unionByName(datasets_with_suffix(stored, "270"))


REPORT_DATASETS = """
select concat('t_', strftime(o_orderdate, '%Y%m'),
    case when o_orderstatus = 'F' then '_182' else '_270' end) as src_table, o_orderkey,
  case when o_orderstatus = 'F' then 'G' else o_orderstatus end as o_orderstatus
from orders"""


def watermarks(spark, sf):
    path = work_dir(spark, "watermarks")
    sources = {"orders": "o_orderkey", "events": "event_id", "lineitem": "l_orderkey"}
    for entity, key in sources.items():
        batch = table(spark, sf, entity)
        store = read_current(spark, path, schemas.WATERMARKS)
        early = watermark_row(batch, "dw", entity, key, F.col(key) - 1, RUN_TS)
        write_version(set_watermark(store, early), path)
        upsert(watermark_row(batch, "dw", entity, key, F.col(key), RUN_TS), path,
               ["source_system", "entity", "watermark_key"])
        none = watermark_row(batch.where(F.col(key) < 0), "dw", entity, key, F.col(key), RUN_TS)
        upsert(none, path, ["source_system", "entity", "watermark_key"])
    store = read_current(spark, path, schemas.WATERMARKS)
    wanted = {**sources, "pages": "page_id"}
    return union_origin(
        {e: get_watermark(store, "dw", e, k) for e, k in wanted.items()}, "entity"
    )


WATERMARKS = """
select 'orders' as entity, cast(max(o_orderkey) as varchar) as watermark_value from orders
union all select 'events', cast(max(event_id) as varchar) from events
union all select 'lineitem', cast(max(l_orderkey) as varchar) from lineitem
union all select 'pages', '0'"""


def stream_insert(spark, sf):
    schema = table(spark, sf, "events").schema

    def typed(rows):
        p = rows.withColumn("_p", payload_fields(F.col("props"), ["k"]))
        return p.select(
            "event_id", "user_id", "event_type", F.col("ts").cast("date").alias("day"),
            field_or_null("_p", "k").cast("bigint").alias("k"),
        )

    path, state = work_dir(spark, "stream-out"), work_dir(spark, "stream-state")
    for run in ("first", "again"):  # the second run finds every key in the table
        stream = new_files(spark, sf, schema, "events.parquet")
        insert_stream(
            stream, f"{path}", f"{state}/{run}", ["event_id"], [F.col("user_id").asc()], typed,
            batch_prefix=run,
        ).awaitTermination()
    out = typed(table(spark, sf, "events")).schema
    return plain(read_appended(spark, path, out))


STREAM_INSERT = """
select event_id, user_id, event_type, cast(cast(ts as date) as varchar) as day,
  cast(props->>'$.k' as bigint) as k from events"""

def first_events(spark, sf):
    """Events as they arrive in two runs of one stream: what was held back until the second run
    and all of the first run's last days come again; what is older than the delay is too late."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    early = F.col("ts") < F.lit(_TURN).cast("timestamp")
    held = F.col("event_id") % 10 == 0
    arrivals = [
        events.where(early & ~held),
        events.where(~early | held).unionByName(events.where(early & (F.col("ts") >= F.lit(_AGAIN).cast("timestamp")))),
    ]
    root = work_dir(spark, "events")
    for n, rows in enumerate(arrivals):
        rows.coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = event_time.first_events(new_files(spark, f"{root}/in", events.schema), ["event_id"], "ts", "2 days")
        event_time.append_stream(stream, f"{root}/out", f"{root}/state").awaitTermination()
    return plain(spark.read.schema(events.schema).parquet(f"{root}/out"))


_TURN, _AGAIN = "2024-01-15", "2024-01-10"
FIRST_EVENTS = f"""
with turn as (
  select max(epoch_ms(ts)) - 2 * 24 * 3600 * 1000 as watermark from events
  where ts < timestamp '{_TURN}' and event_id % 10 <> 0
)
select event_id, user_id, event_type, epoch_us(ts) as ts from events, turn
where event_id % 10 <> 0 or ts >= timestamp '{_TURN}' or epoch_us(ts) > watermark * 1000"""

QUERIES = {
    "q_first_events": (first_events, FIRST_EVENTS),
    "q_compacted": (compacted, COMPACTED),
    "q_truncate": (truncated, TRUNCATED),
    "q_run_windows": (run_windows, RUN_WINDOWS),
    "q_evolving": (evolved, EVOLVED),
    "q_inserted_counts": (inserted, INSERTED),
    "q_append_batch": (append_rows, APPEND_ROWS),
    "q_insert_batches": (insert_batches, INSERT_BATCHES),
    "q_upsert_versions": (upsert_versions, UPSERT_VERSIONS),
    "q_report_datasets": (report_datasets, REPORT_DATASETS),
    "q_watermark": (watermarks, WATERMARKS),
    "q_stream_insert": (stream_insert, STREAM_INSERT),
}
