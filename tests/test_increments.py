"""Loads whose work goes with the batch: the ledger, buckets of keys, event-time streams."""

from __future__ import annotations

import shutil
from datetime import datetime

import pytest
from conftest import RUN_TS, SF
from pyspark.sql import functions as F

from estrato import schemas
from estrato.plans import access, weather
from estrato.plans.registered.access import _GATES, tables_l, tables_q
from estrato.sources import buckets
from estrato.sources.buckets import BUCKET, bucket_of, insert_bucketed, missing_keys, read_keys
from estrato.sources.compaction import bins_of, compact, packed_loads, read_loads, remove_replaced
from estrato.sources.ledger import Ledger, read_folders
from estrato.sources.paths import folder_bytes
from estrato.sources.tables import append_batch, read_appended
from estrato.streaming.event_time import append_stream, first_events, late_rows
from estrato.streaming.micro_batch import new_files


def files_read(df):
    """The files that a read takes rows from."""
    return {r[0] for r in df.select(F.col("_metadata.file_path")).distinct().collect()}


def scans(df):
    return [line for line in df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    ).splitlines() if "PartitionFilters" in line]


# ------------------------------------------------------------------ buckets


def test_an_insert_reads_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    for n in range(3):
        some = rows.where(F.col("k") % 3 == n)
        assert insert_bucketed(some, path, ["k"], [F.col("v").asc()], str(n)) == some.count()
    one = rows.where("k = 1234")
    touched = [r[0] for r in one.select(bucket_of(["k"], 16)).collect()]
    keys = read_keys(spark, path, rows.schema, ["k"], touched)
    every = len(files_read(spark.read.parquet(path)))
    read = {f for r in spark.read.parquet(path).where(F.col(BUCKET).isin(touched)).select("_metadata.file_path").distinct().collect() for f in r}
    assert every >= 3 * 16 and len(read) == every // 16
    assert keys.count() < 4000 / 8 and any(BUCKET in line and "In" in line or touched[0] in line for line in scans(keys))
    assert insert_bucketed(rows, path, ["k"], [F.col("v").asc()], "9") == 0
    more = rows.unionByName(spark.range(4000, 4010).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("v")))
    assert insert_bucketed(more, path, ["k"], [F.col("v").asc()], "9") == 10
    assert insert_bucketed(more, path, ["k"], [F.col("v").asc()], "9") == 10  # the same batch again
    stored = read_appended(spark, path, rows.schema)
    assert stored.count() == stored.select("k").distinct().count() == 4010


def test_the_table_is_not_shuffled_for_a_small_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(1000).select(F.col("id").alias("k"))
    insert_bucketed(rows, path, ["k"], [F.col("k").asc()], "1")
    source = spark.range(995, 1005).select(F.col("id").alias("k"))
    target = read_keys(spark, path, rows.schema, ["k"])
    asked = F.broadcast(source)
    plan = target.join(asked, "k", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert sorted(r.k for r in missing_keys(source, target, ["k"]).collect()) == list(range(1000, 1005))
    # beyond the checked size both sides are joined the usual way
    assert sorted(r.k for r in missing_keys(source, target, ["k"], row_bytes=1 << 30).collect()) == list(range(1000, 1005))


def test_null_keys_odd_buckets_and_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(None, "a", 2), (None, "a", 1), (1, None, 3), (1, "é", 4)], "k long, s string, n int")
    assert insert_bucketed(rows, path, ["k", "s"], [F.col("n").asc()], "1", buckets=4) == 3
    assert insert_bucketed(rows, path, ["k", "s"], [F.col("n").asc()], "2", buckets=32) == 0  # another number of buckets
    assert insert_bucketed(rows.limit(0), path, ["k", "s"], [F.col("n").asc()], "3") == 0
    assert sorted(r.n for r in read_appended(spark, path, rows.schema).collect()) == [1, 3, 4]
    assert insert_bucketed(rows.where("n < 3"), path, ["k", "s"], None, "4", batches=["2"]) == 2  # batch 1 doesn't count
    assert read_keys(spark, str(tmp_path / "none"), rows.schema, ["k"]).count() == 0


# ------------------------------------------------------------------- ledger


@pytest.fixture
def two_layers(spark, tmp_path):
    tables = {"low": str(tmp_path / "low"), "high": str(tmp_path / "high")}
    ledger = Ledger(spark, str(tmp_path / "ledger"), tables)
    schema = spark.range(1).schema
    seen = []

    def run(batch, ids):
        """Append ids to the low layer, their tenfold to the high one; returns what high has read."""
        todo = ledger.todo("low", batch)
        n = append_batch(spark.createDataFrame([(i,) for i in ids], schema), tables["low"], batch)
        ledger.record(todo, n, RUN_TS)
        todo = ledger.todo("high", batch, ["low"])
        rows = read_folders(spark, tables["low"], schema, todo.folders("low"))
        seen.append(scans(rows))
        n = append_batch(rows.select((F.col("id") * 10).alias("id")), tables["high"], batch)
        ledger.record(todo, n, RUN_TS)
        return todo.folders("low")

    def high():
        return sorted(r.id for r in read_folders(spark, tables["high"], schema, ledger.folders("high")).collect())

    return tables, ledger, run, high, seen


def test_a_run_reads_only_new_folders(two_layers):
    _, _, run, high, seen = two_layers
    assert run("1", [1, 2]) == ["1"] and run("2", [3]) == ["2"] and run("3", []) == ["3"]
    assert high() == [10, 20, 30]
    for n, (line,) in enumerate(seen, 1):  # one scan, of the folder that is new
        assert line.strip().endswith(f"= {n})]") and line.count("batch#") == 2


def test_deleted_and_changed_folders_are_made_anew(two_layers):
    tables, ledger, run, high, _ = two_layers
    for batch, ids in (("1", [1, 2]), ("2", [3]), ("3", [4])):
        run(batch, ids)
    shutil.rmtree(f"{tables['high']}/batch=2")
    assert high() == [10, 20, 40]
    assert run("4", [5]) == ["2", "4"]  # healed with the next run
    assert high() == [10, 20, 30, 40, 50]
    assert run("1", [1, 7]) == ["1"]  # a batch that runs again replaces itself above
    assert high() == [10, 30, 40, 50, 70]
    assert run("2", [8]) == ["2", "4"]  # folder 4 was made from the old 2: both are made anew
    assert high() == [10, 40, 50, 70, 80]
    assert ledger.folders("high") == ["1", "2", "3"]  # the old folder 4 no longer counts


def test_a_run_that_failed_before_its_note_is_done_again(spark, two_layers):
    tables, ledger, run, high, _ = two_layers
    run("1", [1])
    append_batch(spark.range(90, 92), tables["high"], "2")  # rows without a note
    assert high() == [10]
    assert run("3", [3]) == ["3"] and high() == [10, 30]


# ------------------------------------------------------------ access, weather


def test_access_reads_new_batches_and_heals(spark, tmp_path):
    root = str(tmp_path / "a")
    lookups = {x: spark.sql("select * from values ('NATION_4', 'OUTROS', true) as t(tipo_ingresso, tipo_publico, active)") for x in "LQ"}
    none = access.extract_l(tables_l(spark, SF), datetime(1996, 1, 1).date(), datetime(1996, 1, 2).date()).limit(0)
    days = (datetime(2024, 1, 3).date(), datetime(2024, 1, 12).date()), (datetime(2024, 1, 10).date(), datetime(2024, 1, 28).date())

    def run(batch, some):
        q = access.extract_q(tables_q(spark, SF), *some, _GATES, min_id=0)
        return access.load_access(spark, root, batch, RUN_TS, lookups, {"L": none, "Q": q})

    first, second = run("1", days[0]), run("2", days[1])
    assert first["bronze_Q"] and second["bronze_Q"] and second["silver_Q"] == second["bronze_Q"]
    whole = {r.id_acesso for r in access.read_gold(spark, root).collect()}
    assert len(whole) == first["gold"] + second["gold"]
    again = run("3", days[1])
    assert not any(again[x] for x in ("bronze_Q", "silver_Q", "context_Q", "gold"))
    paths = access.access_tables(root)
    shutil.rmtree(f"{paths['silver_Q']}/batch=1")
    healed = run("4", days[1])
    assert healed["bronze_Q"] == 0 and healed["silver_Q"] == first["silver_Q"] and healed["gold"] == first["gold"]
    gold = access.read_gold(spark, root)
    assert gold.count() == len(whole) and {r.id_acesso for r in gold.collect()} == whole


def test_weather_heals_a_deleted_silver_batch(spark, tmp_path):
    root = str(tmp_path / "w")

    def scraped(day):
        rows = [tuple({"data_previsao": f"2025-11-{day:02d}", "cidade": "Cotia", "origem": "AccuWeather",
                       "data_scrap": "2025-11-01", "tempmax": "20"}.get(n) for n in schemas.WEATHER_RAW.names)]
        return weather.with_ingestion(spark.createDataFrame(rows, schemas.WEATHER_RAW), "scrape_run", RUN_TS)

    assert weather.load_weather(spark, root, "1", RUN_TS, [scraped(6)])["silver"] == 1
    assert weather.load_weather(spark, root, "2", RUN_TS, [scraped(7)])["silver"] == 1
    shutil.rmtree(f"{weather.weather_tables(root)['silver']}/batch=1")
    assert weather.load_weather(spark, root, "3", RUN_TS, [scraped(8)])["silver"] == 2
    assert weather.load_weather(spark, root, "4", RUN_TS, [scraped(8)])["silver"] == 0


# ------------------------------------------------------------------- streams


def test_late_and_repeated_events_over_a_restart(spark, tmp_path):
    schema = "id long, ts timestamp, v string"
    at = lambda day, hour=0: datetime(2025, 1, day, hour)
    source, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    late = []

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)
        stream = first_events(new_files(spark, source, spark.createDataFrame([], schema).schema), ["id"], "ts", "1 day")
        query = append_stream(stream, out, state)
        query.awaitTermination()
        late.append(late_rows(query))
        rows = spark.read.schema(schema).parquet(out).collect()
        return sorted(((r.id, r.v) for r in rows), key=lambda r: (r[0] is None, r[0] or 0))

    assert arrive((1, at(1), "a"), (2, at(2), "b"), (2, at(2, 1), "b again")) in ([(1, "a"), (2, "b")], [(1, "a"), (2, "b again")])
    have = arrive((2, at(2), "repeated"), (3, at(1), "late"), (4, at(1, 12), "in time"), (5, at(9), "new"), (None, at(9), "no id"))
    assert have[2:] == [(4, "in time"), (5, "new"), (None, "no id")] and late[1] == 1
    have = arrive((5, at(9), "repeated"), (6, at(7), "late"), (7, at(20), "new"))
    assert [x for x, _ in have] == [1, 2, 4, 5, 7, None]


# ---------------------------------------------------------------- compaction


def test_small_loads_become_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(12):
        append_batch(spark.range(n * 10, n * 10 + 10).repartition(3), path, f"b{n}")
    append_batch(spark.range(1000, 60_000), path, "large")
    schema = spark.range(1).schema
    sizes = [folder_bytes(spark, f"{path}/batch=b{n}") for n in range(12)]
    target = 3 * max(sizes) + 1
    before = read_appended(spark, path, schema)
    rows = sorted(r.id for r in before.collect())
    files = compact(spark, path, schema.fields, target)
    assert 4 <= files <= 6 and packed_loads(spark, path) == sorted(f"b{n}" for n in range(12))
    after = read_appended(spark, path, schema)
    assert sorted(r.id for r in before.collect()) == sorted(r.id for r in after.collect()) == rows  # a reader from before goes on
    assert len([p for p in read_loads(spark, path, schema.fields).inputFiles() if "_compacted" in p]) == files
    assert sorted(r.id for r in read_folders(spark, path, schema, ["b3", "large"]).collect())[:11] == [*range(30, 40), 1000]
    assert compact(spark, path, schema.fields, target) == 0
    append_batch(spark.range(500, 503), path, "b3")  # a load comes again
    remove_replaced(spark, path)
    assert not list((tmp_path / "t" / "batch=b2").glob("*.parquet")) and list((tmp_path / "t" / "batch=b3").glob("*.parquet"))
    want = sorted({*rows} - {*range(30, 40)} | {500, 501, 502})
    assert sorted(r.id for r in read_appended(spark, path, schema).collect()) == want
    append_batch(spark.range(700, 702), path, "b12")
    assert compact(spark, path, schema.fields, target) == 1  # b3 and b12
    assert sorted(r.id for r in read_appended(spark, path, schema).collect()) == sorted([*want, 700, 701])


def test_an_insert_meets_packed_loads(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(600).select(F.col("id").alias("k"))
    for n in range(3):
        insert_bucketed(rows.where(F.col("k") % 3 == n), path, ["k"], [F.col("k").asc()], str(n))
    fields = [*rows.schema.fields, *spark.range(1).select(F.lit("x").alias(BUCKET)).schema.fields]
    assert compact(spark, path, fields) == 1
    remove_replaced(spark, path)
    assert insert_bucketed(spark.range(590, 610).select(F.col("id").alias("k")), path, ["k"], [F.col("k").asc()], "3") == 10
    assert sorted(r.k for r in read_appended(spark, path, rows.schema).collect()) == list(range(610))


def test_bins_hold_no_more_than_their_size():
    sizes = {f"x{i}": (i * 37) % 50 + 1 for i in range(80)}
    bins = bins_of(sizes, 60)
    held = {}
    for name, b in bins.items():
        held[b] = held.get(b, 0) + sizes[name]
    assert set(bins) == set(sizes) and max(held.values()) <= 60
    assert len(held) <= -(-sum(sizes.values()) // 60) * 1.3 and bins_of({}, 60) == {}


def test_a_large_batch_meets_the_table_by_its_keys(spark, tmp_path, monkeypatch):
    """A batch over the size that is sent: only its keys are shuffled to find the new ones."""
    monkeypatch.setattr(buckets, "SENT_BYTES", 0)
    rows = spark.createDataFrame([(i, f"p{i}") for i in range(50)] + [(None, "none")], "k long, payload string")
    path = str(tmp_path / "t")
    assert buckets.insert_bucketed(rows, path, ["k"], [F.col("payload").asc()], "1") == 51
    assert buckets.insert_bucketed(rows, path, ["k"], [F.col("payload").asc()], "2") == 0
    more = rows.unionByName(spark.createDataFrame([(99, "new"), (99, "newer")], rows.schema))
    assert buckets.insert_bucketed(more, path, ["k"], None, "3") == 2
    source = more.localCheckpoint()
    found = buckets.missing_keys(source, rows.select("k").localCheckpoint(), ["k"])
    assert sorted(r.payload for r in found.collect()) == ["new", "newer"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "LeftAnti" not in plan  # the target meets keys, not rows
