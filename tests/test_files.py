"""Raw-line ingest and header CSV files from disk."""

from __future__ import annotations

import pytest
from conftest import RUN_TS
from pyspark.sql import functions as F

from estrato.plans import sales, weather
from estrato.sources.files import header_csv, new_batch_id, raw_lines, text_lines
from estrato.sources.schema_log import wider
from estrato.sources.tables import append_batch, read_appended
from estrato.sources.relational import jdbc_options, terminal_ids


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "202511_182.csv").write_bytes((chr(0xFEFF) + "Conta;é\r\n\r\n1;2\rlast").encode())
    (tmp_path / "Preço médio.csv").write_bytes("preço;1\nfim\n".encode("latin-1"))
    (tmp_path / "notes.txt").write_text("no")
    (tmp_path / "empty.csv").write_text("")
    return tmp_path


def test_lines_are_numbered_and_decoded_per_file(spark, folder):
    batch = new_batch_id()
    df = raw_lines(spark, str(folder), batch_id=batch, run_ts=RUN_TS)
    assert df.columns == ["src_table", "line_no", "raw_line", "_source_file", "_ingested_at", "_batch_id"]
    rows = sorted((r.src_table, r.line_no, r.raw_line, r._source_file) for r in df.collect())
    a, b = "202511_182.csv", "Preço médio.csv"
    assert rows == [
        ("pre_o_m_dio", 1, "preço;1", b), ("pre_o_m_dio", 2, "fim", b),
        ("t_202511_182", 1, "Conta;é", a), ("t_202511_182", 2, "", a),
        ("t_202511_182", 3, "1;2", a), ("t_202511_182", 4, "last", a),
    ]


def test_line_numbers_run_through_all_splits_of_a_file(spark, tmp_path):
    n = 5000
    (tmp_path / "big.csv").write_text("".join(f"row {i} é\n" for i in range(1, n + 1)))
    (tmp_path / "other.csv").write_text("".join(f"row {i} é\n" for i in range(1, 50)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = raw_lines(spark, str(tmp_path), batch_id="b", run_ts=RUN_TS)
        rows = df.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == n + 49
    assert all(r.raw_line == f"row {r.line_no} é" for r in rows)


def test_allow_list_and_origin(spark, folder):
    df = raw_lines(spark, str(folder), batch_id="b", run_ts=RUN_TS, allow=["202511_182.csv"], origin="pdv")
    assert df.columns == ["src_table", "line_no", "raw_line", "_source_file", "_batch_id", "origem_dado", "dt_carga"]
    assert {(r._source_file, r.origem_dado, r._batch_id) for r in df.collect()} == {("202511_182.csv", "pdv", "b")}
    with pytest.raises(FileNotFoundError):
        raw_lines(spark, str(folder), batch_id="b", run_ts=RUN_TS, allow=["gone.csv"])


def test_header_csv_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id;cidade;extra\n1;"Cotia, ""SP""";x\n2;;y\n')
    (tmp_path / "b.csv").write_text(chr(0xFEFF) + "cidade;id\nNA;3\n")
    (tmp_path / "c.csv").write_text("id;outra\n4;x\n")
    (tmp_path / "d.csv").write_text("id;cidade\n5;x;too many\n")
    rows, rejected = header_csv(spark, str(tmp_path), ["id", "cidade"])
    assert sorted((r._source_file, r.id, r.cidade) for r in rows.collect()) == [
        ("a.csv", "1", 'Cotia, "SP"'), ("a.csv", "2", ""), ("b.csv", "3", "NA"),
    ]
    assert {r._source_file: r.reason for r in rejected.collect()} == {
        "c.csv": "missing columns: cidade", "d.csv": "too_many_fields",
    }


def test_relational_options():
    got = jdbc_options("jdbc:x", "acesso", {"user": "u"}, "idAcesso", (1, 9), 4)
    assert got == {
        "url": "jdbc:x", "dbtable": "acesso", "fetchsize": "10000", "user": "u", "partitionColumn": "idAcesso",
        "lowerBound": "1", "upperBound": "9", "numPartitions": "4",
    }
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "acesso", {}, "idAcesso")
    assert terminal_ids("1, 5,,8 ") == [1, 5, 8]
    with pytest.raises(ValueError):
        terminal_ids(" , ")


def test_odd_file_names(spark, tmp_path):
    names = ["a+b 100%.csv", "x[1]{y}.csv", "z.csv"]
    for n in names:
        (tmp_path / n).write_text(n)
    df = raw_lines(spark, str(tmp_path), batch_id="b", run_ts=RUN_TS, allow=names[:2])
    assert sorted((r._source_file, r.raw_line, r.src_table) for r in df.collect()) == [
        ("a+b 100%.csv", "a+b 100%.csv", "a_b_100"), ("x[1]{y}.csv", "x[1]{y}.csv", "x_1_y"),
    ]


def test_sales_files_to_silver(spark, tmp_path):
    header = "Conta;Data;Data Visita;Qtd;Valor;Produtos-Carrinho;Pessoa;Email;Telefone;Cidade;Motivo"
    row = "{};05/11/2025;06/11/2025;2;1.000,50;Passe;José;A@B.example;1;São Roque;m"
    folder, bronze, silver = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "silver")
    folder.mkdir()
    (folder / "202511_418.csv").write_bytes("\r\n".join(["Título", header, row.format(1), row.format(2)]).encode("latin-1"))
    (folder / "202512_418.csv").write_text("\n".join([header, row.format(3), '"Total Geral";1', row.format(9)]))
    (folder / "202512_270.csv").write_text("no header")
    for mode in ("append", "overwrite"):
        sales.load_bronze(spark, str(folder), bronze, batch_id="b", run_ts=RUN_TS, mode=mode)
    for _ in range(2):
        rejects = sales.load_silver(spark, bronze, silver, sales.CARTS_418, RUN_TS)
    rows = sales.read_silver(spark, silver, sales.CARTS_418)
    assert sorted((r.id_venda, r.cliente, r.cidade, str(r.vlr_total), r.fonte_tabela_bronze) for r in rows.collect()) == [
        ("1", "José", "São Roque", "1000.50", "t_202511_418"), ("2", "José", "São Roque", "1000.50", "t_202511_418"),
        ("3", "José", "São Roque", "1000.50", "t_202512_418"),
    ]
    assert rejects.count() == 0
    rejects = sales.load_silver(spark, bronze, silver + "270", sales.SALES_270, RUN_TS)
    assert [tuple(r) for r in rejects.collect()] == [("t_202512_270", "no_header")]


def test_weather_history_files(spark, tmp_path):
    names = ["id", "data_scrap", "hora_scrap", "origem", "cidade", "total_dias", "bloco", "data_previsao", "tempmin",
             "tempmax", "sensacao_termica", "sensacao_sombra", "ind_max_uv", "vento", "probab_chuva", "relatorio"]
    (tmp_path / "h.csv").write_text(";".join(names) + "\n" + ";".join(f'"{n[:3]}"' for n in names) + "\n")
    (tmp_path / "bad.csv").write_text(";".join(names[1:]) + "\n")
    rows, rejected = weather.history_rows(spark, str(tmp_path), RUN_TS)
    row = rows.first()
    assert (row.source_id, row.ingestion_type, row.ingestion_batch, row.relatorio) == ("id", "bootstrap_csv", "h.csv", "rel")
    assert [tuple(r) for r in rejected.collect()] == [("bad.csv", "missing columns: id")]


def test_a_table_may_gain_and_widen_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    loads = [
        "select 1 as a, cast(1.5 as float) as f", "select 2 as a, 'x' as teste", "select 3000000000 as a, cast(null as string) as teste",
        "select cast(4.25 as decimal(6,2)) as a, cast(2 as double) as f",
    ]
    for n, sql in enumerate(loads):
        append_batch(spark.sql(sql), path, str(n))
    got = read_appended(spark, path)
    assert {f.name: f.dataType.simpleString() for f in got.schema} == {"a": "decimal(21,2)", "f": "double", "teste": "string"}
    rows = sorted((float(r.a), r.f, r.teste) for r in got.collect())
    assert rows == [(1.0, 1.5, None), (2.0, None, "x"), (4.25, 2.0, None), (3e9, None, None)]
    # a reader with a schema of its own gets it, whatever the loads have; a load that runs again may change its schema
    assert [r.a for r in read_appended(spark, path, got.schema, without_batch="3").orderBy("a").collect()] == [1, 2, 3000000000]
    append_batch(spark.sql("select 7 as a"), path, "3")
    assert {f.name: f.dataType.simpleString() for f in read_appended(spark, path).schema}["a"] == "bigint"
    assert read_appended(spark, path).count() == 4
    append_batch(spark.sql("select date'2025-01-01' as a"), path, "4")
    with pytest.raises(TypeError, match="a: no type holds both"):
        read_appended(spark, path)


def test_types_widen_by_the_lattice():
    from pyspark.sql import types as T

    d = T.DecimalType
    for a, b, both in [
        (T.ByteType(), T.ShortType(), T.ShortType()), (T.LongType(), T.IntegerType(), T.LongType()), (T.LongType(), d(5, 2), d(21, 2)),
        (d(10, 4), d(8, 1), d(11, 4)), (T.FloatType(), T.DoubleType(), T.DoubleType()), (T.IntegerType(), T.DoubleType(), T.DoubleType()),
        (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()), (T.NullType(), T.StringType(), T.StringType()),
    ]:
        assert wider(a, b, "c") == wider(b, a, "c") == both
    for a, b in [(T.LongType(), T.DoubleType()), (d(38, 2), d(38, 10)), (T.StringType(), T.LongType()), (T.FloatType(), T.LongType())]:
        with pytest.raises(TypeError):
            wider(a, b, "c")



def test_no_line_is_lost_when_splits_change(spark, tmp_path):
    """Other splits at the time of reading than when the plan was built."""
    (tmp_path / "many.csv").write_text("".join(f"line {i}\n" for i in range(1, 60_001)))
    keys = ("spark.sql.leafNodeDefaultParallelism", "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    try:
        spark.conf.set(keys[1], str(64 << 10))
        spark.conf.set(keys[2], "1")
        spark.conf.set(keys[0], "4")
        lines = text_lines(spark, str(tmp_path))
        spark.conf.set(keys[0], "7")
        spark.conf.set(keys[1], str(50_000))
        wrong = lines.where(F.concat(F.lit("line "), F.col("line_no").cast("string")) != F.col("raw_line"))
        assert (lines.count(), wrong.count()) == (60_000, 0)
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_encodings_by_their_bytes(spark, tmp_path):
    text = "Olá – “preço” 5 €\nlinha\r\n\nfim"
    files = {
        "utf8": text.encode(), "windows": text.encode("cp1252"), "le": b"\xff\xfe" + text.encode("utf-16-le"), "be": b"\xfe\xff" + text.encode("utf-16-be"),
        "latin": "Olá ção\nfim".encode("latin-1"), "undefined": b"Ol\xe1 \x93x\x81\nfim", "ascii": b"a\nb", "empty": b"", "marked": b"\xef\xbb\xbf" + text.encode(),
        "com esp%C3 ç+": text.encode("utf-16"),
    }
    for name, raw in files.items():
        (tmp_path / f"{name}.csv").write_bytes(raw)
    got = {}
    for r in text_lines(spark, str(tmp_path)).orderBy("line_no").collect():
        got.setdefault(r._source_file, []).append((r.line_no, r.raw_line))
    whole = list(enumerate(["Olá – “preço” 5 €", "linha", "", "fim"], 1))
    names = {k.replace("%20", " "): v for k, v in got.items()}
    assert names["utf8.csv"] == names["windows.csv"] == names["le.csv"] == names["be.csv"] == names["marked.csv"] == whole
    assert names["latin.csv"] == [(1, "Olá ção"), (2, "fim")]
    assert names["undefined.csv"] == [(1, "Olá \x93x\x81"), (2, "fim")]
    assert names["ascii.csv"] == [(1, "a"), (2, "b")] and "empty.csv" not in names
    assert sum(v == whole for v in names.values()) == 6
