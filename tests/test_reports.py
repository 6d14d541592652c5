"""Carving and parsing, against pandas on the same text and on hand-made exports."""

from __future__ import annotations

import io
import random

import pandas as pd
import pytest
from conftest import RUN_TS
from pyspark.sql import functions as F

from estrato.operators import ordered, reports
from estrato.operators.ordered import forward_fill
from estrato.plans import sales

FILE = "src_table"


def bronze(spark, files: dict[str, str]):
    rows = [(name, i, line) for name, body in files.items() for i, line in enumerate(body.split("\n"), 1)]
    return spark.createDataFrame(rows, "src_table string, line_no long, raw_line string")


def parse(spark, files, header, stops=(), span=4):
    lines = bronze(spark, files)
    bounds = reports.block_bounds(reports.marker_lines(lines, FILE, header, stops), FILE)
    block = reports.carve_block(lines, bounds, FILE)
    maps = reports.quote_maps(block, FILE, span=span)
    odd = reports.quote_exceptions(maps, FILE)
    records = reports.logical_records(reports.quote_states(maps, odd, FILE), FILE, span=span)
    unclosed = reports.unclosed_files(odd, FILE)
    parsed = reports.parse_records(records, FILE)
    at = reports.header_positions(bounds, FILE, {c: [c] for c in ("a", "b", "c")})
    bad = reports.unreadable_files(parsed, at, FILE).unionByName(unclosed.withColumn("reason", F.lit("open_quote")))
    rows = reports.select_fields(parsed, at, FILE, ["a", "b", "c"])
    return rows, {r.src_table: r.reason for r in bad.collect()}


def pandas_rows(body: str):
    lines = [x for x in body.split("\n")]
    start = next(i for i, x in enumerate(lines) if x.startswith("a;b;c"))
    kept = [x for x in lines[start:] if x.strip()]
    if len(kept) <= 1:
        return []
    df = pd.read_csv(io.StringIO("\n".join(kept) + "\n"), sep=";", dtype="string", quotechar='"', engine="python",
                     index_col=False)
    return [tuple(None if pd.isna(v) else v for v in r) for r in df[["a", "b", "c"]].itertuples(index=False)]


def test_random_files_parse_as_pandas_does(spark):
    rnd = random.Random(7)
    pieces = ["x", "1.234,50", "N/A", "", " y ", 'q"q', "ç", '"quoted"', '"a;b"', '"two\nlines"', '"dou""ble"',
              '"three\n\n;lines"', '""', '"""start"', '"end"""', '"1\n2\n3\n4\n5\n6\n7\n8\n9\n10\n11"']
    files = {}
    for f in range(60):
        body = ["title", "", "a;b;c"]
        for _ in range(rnd.randint(1, 9)):
            body.append(";".join(rnd.choice(pieces) for _ in range(3)))
            if rnd.random() < 0.2:
                body.append("   ")
        if rnd.random() < 0.1:
            body.append('z;"never closed;2')
        if rnd.random() < 0.1:
            body.append("1;2;3;4")
        if rnd.random() < 0.1:
            body.append('"x"y;2;3')
        files[f"t_{f}"] = "\n".join(body)
    rows, bad = parse(spark, files, "a;b;c")
    got: dict[str, list] = {}
    for r in rows.orderBy("src_table", "line_no").collect():
        got.setdefault(r.src_table, []).append((r.a, r.b, r.c))
    for name, body in files.items():
        try:
            want = pandas_rows(body)
        except pd.errors.ParserError:
            assert name in bad, body
            continue
        if name in bad:  # a first row that is too wide becomes an index in pandas
            assert bad[name] == "too_many_fields"
            continue
        assert [r for r in got.get(name, []) if any(v is not None for v in r)] == [
            r for r in want if any(v is not None for v in r)
        ], body


def test_quote_state_crosses_chunk_borders(spark):
    long = '"' + "\n".join(f"line {i}" for i in range(50)) + '"'
    files = {"t_1": f"a;b;c\n1;{long};2\n3;4;5", "t_2": "a;b;c\n" + "\n".join(f"{i};{i};{i}" for i in range(99))}
    for span in (1, 3, 7, 1000):
        rows, bad = parse(spark, files, "a;b;c", span=span)
        out = rows.orderBy("src_table", "line_no").collect()
        assert not bad and len(out) == 101
        assert out[0].b == "\n".join(f"line {i}" for i in range(50)) and out[1].a == "3"


def test_block_never_holds_header_stop_or_blank_lines(spark):
    header = "Conta;Data;Data Visita;"
    body = ["x", '"";"";', header, " ", "1;2;3", "\t", '  "Total Geral";9', "4;5;6", header, "7;8;9"]
    lines = bronze(spark, {"t_1_418": "\n".join(body)})
    bounds = reports.block_bounds(
        reports.marker_lines(lines, FILE, header, sales.CARTS_418.stops), FILE
    )
    assert [tuple(r)[1:] for r in bounds.collect()] == [(3, header, 7)]
    assert [r.raw_line for r in reports.carve_block(lines, bounds, FILE).collect()] == ["1;2;3"]


SALE_HEADER = "Conta;Loc VHF;Autorização;Cliente;Email;Data;Criado;Qtd;Total;Quantidade de Parcelas;"


def test_sales_export(spark):
    body = "\n".join([
        "Relatório de vendas", "", chr(0xFEFF) + SALE_HEADER,
        '"101";"";"A1";"Pessoa Um";" OPS@x.example ";"05/11/2025";"05/11/2025 10:20";"2";"1.234,50";"3.0";',
        '"102";"";"A2";"Pessoa\nDois";"b@x.example";"2025-11-06";"06/11/2025 10:20:30";"x";"12.50";"";',
        "",
        '"103";"N/A";"A3";"Três";"";"junk";"";"1";"";"";',
        '"";"";"";"";"";"";"";"";"";"";',
        '"Total Geral";"9"', "Produto;Qtd;Total", '"Leak";"1";"1"',
    ])
    lines = bronze(spark, {"t_202511_182": body, "t_202512_270": body, "t_202510_182": "nothing"})
    rows, rejects = sales.silver_report(lines, sales.SALES_182, RUN_TS, "ops@x.example")
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in sales.SALES_182.schema]
    out = {r.id_venda: r for r in rows.collect()}
    assert sorted(out) == ["101", "102", "103"]
    a, b, c = out["101"], out["102"], out["103"]
    assert (str(a.vlr_total), a.qtd, a.qtd_parcelas, a.teste, a.hr_venda) == ("1234.50", 2, 3, "SIM", "10:20:00")
    assert (str(b.vlr_total), b.qtd, b.cliente, b.teste, str(b.data)) == ("1250.00", None, "Pessoa\nDois", "NÃO", "2025-11-06")
    assert (c.data, c.teste, c.loc_vhf, c.dt_venda) == (None, None, None, None)
    assert {r.src_table: r.reason for r in rejects.collect()} == {"t_202510_182": "no_header"}
    assert sales.with_period(rows, sales.SALES_182).first().ano_mes == "202511"


def test_coupons_fill_from_the_parent_line(spark):
    header = ";".join(h for (h,) in sales.COUPONS_664.columns.values())
    parent = "7;Passe;Ana;05/11/2025;06/11/2025;;1.000,00;C1;Verão;ok;;;01/11/2025;30/11/2025"
    child = ";;;;;;;;;;{};{};;"
    body = [header, child.format("5%", "Antes"), parent, child.format("10%", "Produto X"), child.format("0%", "Y"),
            child.format("0,00", "Z"), child.format("null", "W"), child.format("15,5%", "")]
    lines = bronze(spark, {"t_202511_664": "\n".join(body), "t_202512_664": header.replace("Valor", "V") + "\n" + parent})
    rows, rejects = sales.silver_report(lines, sales.COUPONS_664, RUN_TS)
    out = sorted((r.produto, r.id_venda, r.nome_cupom, str(r.vlr_total), str(r.dt_venda)) for r in rows.collect())
    assert out == [("Antes", None, None, "None", "None"), ("Produto X", "7", "Verão", "1000.00", "2025-11-05")]
    assert {r.src_table: r.reason for r in rejects.collect()} == {"t_202512_664": "missing_parent_column"}


@pytest.mark.parametrize("summary", [ordered.SUMMARY_SPAN, 3])
def test_forward_fill_is_the_pandas_one(spark, monkeypatch, summary):
    monkeypatch.setattr(ordered, "SUMMARY_SPAN", summary)
    rnd = random.Random(3)
    rows = [
        (rnd.choice(["hot", "hot", "hot", "b", "c"]), i, rnd.choice([None, None, None, i]), rnd.choice([None, f"s{i}"]))
        for i in range(2000)
    ]
    pdf = pd.DataFrame(rows, columns=["g", "i", "x", "y"]).sort_values("i")
    pdf[["x", "y"]] = pdf.groupby("g")[["x", "y"]].ffill()
    want = [
        (r.g, r.i, None if pd.isna(r.x) else int(r.x), None if pd.isna(r.y) else r.y) for r in pdf.itertuples()
    ]
    df = spark.createDataFrame(rows, "g string, i long, x long, y string")
    for span in (1, 64, 10**6):
        got = forward_fill(df, ["g"], "i", ["x", "y"], span).orderBy("i").collect()
        assert [tuple(r) for r in got] == want


def test_cells_are_read_where_they_stand(spark):
    """A rule of a filled column meets each cell, not each row below it; what it can't read stays NULL."""
    rows = [("g", i, {0: "1", 300: "x", 600: "3"}.get(i), None if i % 2 else "5") for i in range(900)]
    df = spark.createDataFrame(rows, "g string, i long, x string, y string")

    def rule(c):
        return c.try_cast("int")

    for span in (7, 128, 10**6):
        got = forward_fill(df, ["g"], "i", ["x", "y"], span, read={"x": rule, "y": rule}).orderBy("i").collect()
        assert [(r.x, r.y) for r in got] == [({0: 1, 1: None, 2: 3}[i // 300], 5) for i in range(900)]


def test_records_of_quoted_fields_alone(spark):
    texts = ['"a";"b";', '"a";"b"', '"a"', '""', '"";"";', '"a;b";"c\nd"', '"a""b";"c"', '"a";b', '"a"x;"b"', '"a";"b";\r', 'a;b;', '"a";"b"\n', '"a";;"b"']
    records = spark.createDataFrame([("f", i, t) for i, t in enumerate(texts)], "src_table string, line_no long, raw_line string")
    got = reports.parse_records(records, FILE, na_tokens=()).orderBy("line_no").collect()
    assert [r.fields for r in got] == [
        ["a", "b", ""], ["a", "b"], ["a"], [""], ["", "", ""], ["a;b", "c\nd"], ['a"b', "c"], ["a", "b"], ["a", "b"],
        ["a", "b", "\r"], ["a", "b", ""], ["a", "b"], ["a", "", "b"],
    ]
    assert [r.strict for r in got][:8] == [True] * 8 and not got[8].strict
    plan = reports.parse_records(records, FILE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2
