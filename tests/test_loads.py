"""Idempotent loads, versions, watermarks, weather layers and the stream."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from conftest import RUN_TS
from pyspark.sql import functions as F

from estrato import schemas
from estrato.functions.text import match_flag
from estrato.operators.aggregates import latest_per_key, newest
from estrato.operators.incremental import (
    get_watermark, insert_new, merge_upsert, set_watermark, watermark_row,
)
from estrato.plans import access, weather
from estrato.session import work_dir
from estrato.sources.buckets import insert_bucketed
from estrato.sources import tables
from estrato.sources.tables import (
    MANIFEST, append_batch, read_appended, read_current, read_keyed, truncate, upsert, upsert_keyed,
    versions, write_version,
)
from estrato.streaming.micro_batch import insert_stream, new_files


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_insert_new_twice_is_insert_new_once(spark, tmp_path):
    source = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), ("c", 4)], "k string, n int")
    target = spark.createDataFrame([("c", 9)], "k string, n int")
    new = insert_new(target, source, ["k"], [F.col("n").asc()])
    assert rows_of(new) == [("a", 1), ("b", 3)]
    assert rows_of(insert_new(target.unionByName(new), source, ["k"], [F.col("n").asc()])) == []
    path = str(tmp_path / "t")
    assert insert_bucketed(source, path, ["k"], [F.col("n").asc()], "1") == 3
    assert insert_bucketed(source, path, ["k"], [F.col("n").asc()], "2") == 0
    assert insert_bucketed(source, path, ["k"], [F.col("n").asc()], "1") == 3  # the same batch again
    assert rows_of(read_appended(spark, path, source.schema)) == [("a", 1), ("b", 3), ("c", 4)]


def test_upsert_treats_null_as_a_key(spark, tmp_path):
    s = "k string, uf string, n int"
    target = spark.createDataFrame([("a", None, 1), ("a", "SP", 2), (None, None, 3)], s)
    source = spark.createDataFrame([("a", None, 7), (None, None, 8), ("z", "SP", 9)], s)
    merged = merge_upsert(target, source, ["k", "uf"])
    want = {("a", None, 7), ("a", "SP", 2), (None, None, 8), ("z", "SP", 9)}
    assert {tuple(r) for r in merged.collect()} == want
    path = str(tmp_path / "t")
    assert write_version(target, path) == 3
    assert upsert(source, path, ["k", "uf"]) == 4
    assert upsert(source, path, ["k", "uf"]) == 4
    assert {tuple(r) for r in read_current(spark, path, target.schema).collect()} == want
    (tmp_path / "t" / "version=0000000099").mkdir()  # a write that never committed
    assert len(versions(spark, path)) == 3
    assert truncate(spark, path, target.schema) == 0
    assert read_current(spark, path, target.schema).count() == 0


def test_latest_ranks_null_first(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("b", 4, 3), ("b", 4, 4), (None, 1, 5)], "k string, t int, i int")
    assert {tuple(r) for r in latest_per_key(df, ["k"], newest("t", "i")).collect()} == {
        ("a", None, 1), ("b", 4, 4), (None, 1, 5),
    }


def test_watermark(spark):
    store = spark.createDataFrame([], schemas.WATERMARKS)
    batch = spark.range(10)
    store = set_watermark(store, watermark_row(batch, "q", "acesso", "id", F.col("id"), RUN_TS))
    assert get_watermark(store, "q", "acesso", "id").first()[0] == "9"
    assert get_watermark(store, "q", "other", "id").first()[0] == "0"
    empty = watermark_row(batch.where("id < 0"), "q", "acesso", "id", F.col("id"), RUN_TS)
    assert get_watermark(set_watermark(store, empty), "q", "acesso", "id").first()[0] == "9"


def test_flag_of_a_missing_email(spark):
    df = spark.sql("select * from values ('a'), ('b'), (null) as t(x)").select(match_flag(F.col("x"), "a").alias("f"))
    assert [r.f for r in df.collect()] == ["SIM", "NÃO", None]


def test_gold_keys(spark):
    fact = "id_acesso string, n int"
    facts = {"L": spark.createDataFrame([("1", 1), ("2", 2)], fact), "Q": spark.createDataFrame([("1", 3)], fact)}
    gold = spark.createDataFrame([("L", "1")], "origem string, id_acesso string")
    both = access.gold_access(facts, gold, access.GOLD_KEYS)
    assert {(r.origem, r.id_acesso) for r in both.collect()} == {("L", "2"), ("Q", "1")}
    by_id = access.gold_access(facts, gold, ["id_acesso"])
    assert {(r.origem, r.id_acesso) for r in by_id.collect()} == {("L", "2")}


def test_access_fact_categories(spark):
    silver = spark.sql(
        "select * from values ('1', 'A'), ('2', 'B'), ('3', 'C'), ('4', 'D'), ('5', cast(null as string)), ('6', 'OUTROS') "
        "as t(id_acesso, tipo_ingresso)"
    ).withColumn("bronze_extracted_at", F.lit(None).cast("timestamp"))
    for c in ("num_ingresso", "terminal_entrada", "dt_entrada", "hr_entrada"):
        silver = silver.withColumn(c, F.lit(None).cast("string"))
    lookup = spark.sql("select * from values ('A', 'Adulto', true), ('B', 'OUTROS', true), ('C', 'x', false) "
                       "as t(tipo_ingresso, tipo_publico, ativo)")
    l_rule = access.access_fact(silver, lookup, "ativo", "f", RUN_TS)
    assert rows_of(l_rule.select("id_acesso", "tipo_publico")) == [
        ("1", "Adulto"), ("3", "CHECK"), ("4", "CHECK"), ("5", "CHECK"), ("6", "CHECK"),
    ]
    q_rule = access.access_fact(silver, lookup, "ativo", "f", RUN_TS, drop_unlabelled=True)
    assert rows_of(q_rule.select("id_acesso", "tipo_publico")) == [("1", "Adulto"), ("3", "CHECK"), ("4", "CHECK")]


WEATHER_DEFAULTS = dict(
    total_dias="15", bloco="1", tempmin="10°", tempmax="/20", sensacao_termica="", sensacao_sombra="", ind_max_uv="3",
    vento="", probab_chuva=None, relatorio="sol",
)


def scrape(spark, *rows):
    names = schemas.WEATHER_RAW.names
    data = [tuple({**WEATHER_DEFAULTS, **r}.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, schemas.WEATHER_RAW)


def test_weather_layers(spark, tmp_path):
    day = dict(data_previsao="2025-11-06", cidade="Cotia")
    first = weather.with_ingestion(scrape(
        spark,
        dict(day, origem="AccuWeather", data_scrap="2025-11-05", hora_scrap="08:00:00", vento="old"),
        dict(day, origem="AccuWeather", data_scrap="05/11/2025", hora_scrap="17:00:00", sensacao_termica="N/A"),
        dict(day, origem="Climatempo", cidade="Cotia, SP", data_scrap="2025-11-05", hora_scrap=None, vento="10 km/h",
             sensacao_termica="quente"),
        dict(day, origem="AccuWeather", data_previsao="junk", data_scrap="2025-11-05", hora_scrap="08:00:00"),
    ), "scrape_run", RUN_TS)
    root = str(tmp_path / "w")
    added = weather.load_weather(spark, root, "1", RUN_TS, [first])
    assert added == {"bronze": 4, "silver": 3, "context": 2, "gold": 1}
    gold = read_keyed(spark, f"{root}/gold/weather", schemas.GOLD_WEATHER, "dt_forecast").first()
    assert (gold.cidade, gold.uf, gold.vento, gold.sensacao_termica, gold.temp_max_c) == ("Cotia", "SP", "10 km/h", "N/A", 20)
    later = weather.with_ingestion(scrape(
        spark, dict(day, origem="AccuWeather", data_scrap="2025-11-06", hora_scrap="08:00:00", vento="new"),
    ), "scrape_run", RUN_TS + timedelta(days=1))
    added = weather.load_weather(spark, root, "2", RUN_TS, [later])
    assert added == {"bronze": 1, "silver": 1, "context": 2, "gold": 1}
    gold = read_keyed(spark, f"{root}/gold/weather", schemas.GOLD_WEATHER, "dt_forecast").first()
    assert (gold.vento, gold.sensacao_termica) == ("new", "quente")
    context = read_keyed(spark, f"{root}/silver_ctx/weather", schemas.WEATHER_CONTEXT, "dt_forecast")
    odd = weather.gold_weather(context, RUN_TS, weather.SOURCE_B, ("", "N/A")).first()
    assert odd.sensacao_termica == "quente"


def test_weather_look_back(spark):
    rows = weather.with_ingestion(
        scrape(spark, dict(data_previsao="2025-11-06", cidade="Cotia", origem="x", data_scrap="2025-11-05")), "scrape_run", RUN_TS
    )
    assert weather.silver_weather(rows, RUN_TS, RUN_TS - timedelta(hours=48)).count() == 1
    assert weather.silver_weather(rows, RUN_TS, RUN_TS).count() == 0


def test_forecast_pages(spark):
    a = (
        '<div class="daily-wrapper"><span class="high">25°</span><span class="low">/ 15°</span>'
        '<div class="precip"> 40% </div><div class="phrase">Sol</div><div class="panels">'
        '<p class="panel-item">RealFeel® <span class="value">27°</span></p>'
        '<p class="panel-item">RealFeel Shade™ <span class="value">24°</span></p>'
        '<p class="panel-item">Índice UV <span class="value">8</span></p>'
        '<p class="panel-item">Vento <span class="value">SE 9 km/h</span></p></div></div>'
        '<div class="daily-wrapper"><span class="high"></span></div><div class="precip">outside</div>'
    )
    pages = spark.createDataFrame([("Cotia", datetime(2025, 12, 31, 8), a), ("Vazia", datetime(2025, 12, 31, 8), "<p/>")],
                                  "cidade string, fetched_at timestamp_ntz, html string")
    one, two = weather.daily_blocks(pages).orderBy("bloco").collect()
    assert (one.tempmax, one.tempmin, one.probab_chuva, one.sensacao_termica) == ("25", "15", "40%", "27°")
    assert (one.sensacao_sombra, one.ind_max_uv, one.vento, one.total_dias) == ("24°", "8", "SE 9 km/h", "2")
    assert (two.tempmax, two.tempmin, two.probab_chuva, two.vento) == (None, None, "N/A", "N/A")
    assert (two.data_previsao, two.data_scrap, two.hora_scrap) == ("2026-01-01", "2025-12-31", "08:00:00")
    assert weather.card_blocks(pages).count() == 0


def test_stream_reads_each_file_once(spark, tmp_path):
    schema = spark.range(1).schema
    source, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))

    def run():
        insert_stream(new_files(spark, source, schema, files_per_batch=1), out, state, ["id"], [F.col("id").asc()]).awaitTermination()
        return read_appended(spark, out, schema)

    spark.range(5).coalesce(1).write.mode("append").parquet(source)
    assert run().count() == 5
    spark.range(3, 9).coalesce(1).write.mode("append").parquet(source)
    assert rows_of(run()) == [(i,) for i in range(9)]
    assert run().count() == 9


def test_append_batch_counts_without_a_second_scan(spark, tmp_path):
    assert append_batch(spark.range(7), str(tmp_path / "t"), "1") == 7


class _Cluster:
    """What ``work_dir`` asks of a session, on a cluster without a shared folder."""

    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)


def test_scratch_folder(spark):
    assert "/estrato/x-" in work_dir(spark, "x")
    for master in ("yarn", "local-cluster[3,2,1024]"):
        _Cluster.sparkContext.master = master
        with pytest.raises(ValueError):
            work_dir(_Cluster, "x")
    _Cluster.sparkContext.getCheckpointDir = staticmethod(lambda: "hdfs://n/ck")
    assert work_dir(_Cluster, "x").startswith("hdfs://n/ck/estrato/x-")


def _current(spark, path):
    """The folder that counts for each day."""
    return {r.value: r.folder for r in read_current(spark, f"{path}/_manifest", MANIFEST).collect()}


def test_a_failed_upsert_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "keyed")
    rows = spark.createDataFrame([("a", 1, date(2025, 1, 1)), ("a", 2, date(2025, 1, 2))], "k string, v int, day date")
    upsert_keyed(rows, path, ["k", "day"], "day")
    new = rows.withColumn("v", F.col("v") + 10)

    def stopped(*_, **__):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as m:  # the new folders are written, the manifest isn't
        m.setattr(tables, "write_version", stopped)
        with pytest.raises(RuntimeError):
            upsert_keyed(new, path, ["k", "day"], "day")
    assert len(list((tmp_path / "keyed").glob("write=*"))) == 2
    # and a write that ends between two folders leaves files that nobody reads
    rows.where("v = 1").drop("day").write.parquet(f"{path}/write=half/day=2025-01-01")
    assert sorted(r.v for r in read_keyed(spark, path, rows.schema, "day").collect()) == [1, 2]
    reader = read_keyed(spark, path, rows.schema, "day")
    assert upsert_keyed(new, path, ["k", "day"], "day") == 2
    assert sorted(r.v for r in reader.collect()) == [1, 2]  # a reader that has begun keeps its state
    assert sorted(r.v for r in read_keyed(spark, path, rows.schema, "day").collect()) == [11, 12]


def test_an_upsert_reads_and_writes_only_its_days(spark, tmp_path):
    path = str(tmp_path / "keyed")
    schema = "k string, v int, day date"
    first = spark.createDataFrame([("a", 1, date(2025, 1, d)) for d in range(1, 9)] + [(None, 2, date(2025, 1, 3))], schema)
    assert upsert_keyed(first, path, ["k", "day"], "day") == 9
    before = _current(spark, path)
    new = spark.createDataFrame([("a", 5, date(2025, 1, 3)), ("b", 6, date(2025, 1, 5)), (None, 7, date(2025, 1, 3))], schema)
    assert upsert_keyed(new, path, ["k", "day"], "day") == 4
    after = _current(spark, path)
    assert {d for d in before if before[d] != after[d]} == {"day=2025-01-03", "day=2025-01-05"} and len(after) == 8
    written = {p.name for p in (tmp_path / "keyed").glob("write=*/day=*") if after[p.name].startswith(p.parent.name)}
    assert written == set(after)
    rows = {(r.k, r.day.day): r.v for r in read_keyed(spark, path, new.schema, "day").collect()}
    assert rows == {("a", d): 1 for d in range(1, 9)} | {("a", 3): 5, (None, 3): 7, ("b", 5): 6}
    assert upsert_keyed(new.limit(0), path, ["k", "day"], "day") == 0
    some = read_keyed(spark, path, new.schema, "day").where(F.col("day") >= date(2025, 1, 7))
    assert "PartitionFilters: [isnotnull(day" in some._jdf.queryExecution().executedPlan().toString()
