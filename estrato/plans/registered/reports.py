"""Report exports: raw lines made from the order tables, and what is read from them.

Every month of orders is one dataset, framed as an export is: a title, a header, data
lines, stop markers and a second table below them that must not leak.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato.operators import reports
from estrato.operators.audit import audit_counts
from estrato.plans import sales
from estrato.plans.registered.common import (
    RUN_MICROS, RUN_TS, br_text, cents, cents_sql, money_sql, pick, pick_sql, plain, table,
)
from estrato.session import spread, work_dir, written
from estrato.sources.tables import write_reports

END = 10**15
FILE = "src_table"


def _orders(spark, sf) -> DataFrame:
    return spread(table(spark, sf, "orders"))


def _month(c: Column | str = "o_orderdate") -> Column:
    return F.date_format(c, "yyyyMM")


def _dataset(suffix: str) -> Column:
    return F.concat(F.lit("t_"), _month(), F.lit(f"_{suffix}"))


def _dataset_sql(suffix: str) -> str:
    return f"concat('t_', strftime(o_orderdate, '%Y%m'), '_{suffix}')"


def _quoted(*fields: Column | str) -> Column:
    """One record with every field in quotes and the quotes in it doubled."""
    cells = [
        F.concat(
            F.lit('"'),
            F.replace(F.coalesce(F.lit(f) if isinstance(f, str) else f.cast("string"), F.lit("")),
                      F.lit('"'), F.lit('""')),
            F.lit('"'),
        )
        for f in fields
    ]
    return F.concat(F.concat_ws(";", *cells), F.lit(";"))


def _framed(
    records: DataFrame, header: Column, stops: list[str], extra: DataFrame | None = None,
    width: int = 16,
) -> DataFrame:
    """Bronze raw lines ``(src_table, line_no, raw_line)`` of ``(src_table, at, record)``.

    ``header`` is an expression over the dataset name, ``extra`` holds more lines.
    Records may have line breaks.  Bronze is a stored layer, so the lines are written.
    """
    data = records.select(
        FILE, "at", F.posexplode(F.split("record", "\n")).alias("k", "raw_line")
    ).select(FILE, (F.col("at") * width + F.col("k") + 100).alias("line_no"), "raw_line")
    frame = [
        (1, F.lit("Relatório de vendas")), (2, F.lit("")), (3, header), (50, F.lit("  ")),
        *[(END + i, F.lit(s)) for i, s in enumerate(stops)],
        (END + 100, F.lit("Produto;Qtd;Total")), (END + 101, F.lit('"Leak";"1";"2"')),
        (END + 102, header),
    ]
    around = records.select(FILE).distinct().select(
        FILE,
        F.inline(F.array(*[
            F.struct(F.lit(n).cast("long").alias("line_no"), c.alias("raw_line")) for n, c in frame
        ])),
    )
    lines = data.unionByName(around)
    return written(lines if extra is None else lines.unionByName(extra), "bronze")


# ------------------------------------------------------------------- report 182

_HEAD = "Conta;Loc VHF;Autorização;Cliente;Endereço;Celular;"
_TAIL = "Data;Criado;Qtd;Produto;Un.;Total;Status;Data Utilização;Quantidade de Parcelas;"


def _even_year() -> Column:
    return F.substring(FILE, 3, 4).cast("int") % 2 == 0


def _header_182() -> Column:
    bom = F.lit(chr(0xFEFF))
    with_email = F.concat(bom, F.lit(f"{_HEAD}Email;Agência;{_TAIL}"))
    return F.when(_even_year(), with_email).otherwise(F.lit(f"{_HEAD}Agencia;{_TAIL}"))


def _lines_182(spark, sf, stops=('"";"";', '"Total Geral";"1"')) -> DataFrame:
    """Even years have an e-mail column and a BOM; every third address runs over two
    lines and has quotes and a separator in it."""
    sale = _orders(spark, sf).join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    address = pick(
        F.col("o_orderkey"),
        F.concat(F.lit('Rua "'), F.col("c_mktsegment"), F.lit('"; 12\nfundos')),
        F.lit("Rua Um"),
        F.lit(None),
    )
    email = pick(
        F.col("o_orderkey"), F.lit(" Gate@Park.example "),
        F.concat(F.col("c_custkey").cast("string"), F.lit("@x.example")), F.lit(""),
        F.lit("N/A"),
    )
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    first = [
        F.col("o_orderkey"), "", F.concat(F.lit("A"), F.col("o_custkey").cast("string")),
        F.col("c_name"), address, "N/A",
    ]
    rest = [
        pick(F.col("o_orderkey"), F.lit("Loja"), F.lit("null")),
        day, F.concat(day, F.lit(" 10:20")),
        (F.col("o_custkey") % 7).cast("string"), F.col("o_orderpriority"),
        F.lit("1.234,5"), br_text(cents("o_totalprice")), F.col("o_orderstatus"),
        F.lit("sem data"), pick(F.col("o_orderkey"), F.lit("1.0"), F.lit("x")),
    ]
    named = sale.withColumn(FILE, _dataset("182"))
    records = named.select(
        FILE, F.col("o_orderkey").alias("at"),
        F.when(_even_year(), _quoted(*first, email, *rest)).otherwise(_quoted(*first, *rest)).alias("record"),
    )
    return _framed(records, _header_182(), list(stops))


def carve(spark, sf):
    lines = _lines_182(spark, sf)
    r = sales.SALES_182
    markers = written(reports.marker_lines(lines, FILE, r.header, r.stops), "markers")
    bounds = written(reports.block_bounds(markers, FILE), "bounds")
    block = reports.carve_block(lines, bounds, FILE)
    return block.select(FILE, "line_no", F.length("raw_line").alias("chars"))


_YEAR_EVEN = "year(o_orderdate) % 2 = 0"


def _field_sql(expr: str) -> str:
    """Length of a quoted field and its separator."""
    return f"length(replace(coalesce(cast({expr} as varchar), ''), '\"', '\"\"')) + 3"


_ADDRESS = pick_sql("o_orderkey", "concat('Rua \"', c_mktsegment, '\"; 12', chr(10), 'fundos')",
                    "'Rua Um'", "null")
_EMAIL = pick_sql("o_orderkey", "' Gate@Park.example '", "concat(c_custkey, '@x.example')", "''", "'N/A'")
_AGENCY = pick_sql("o_orderkey", "'Loja'", "'null'")
_PARCELS = pick_sql("o_orderkey", "'1.0'", "'x'")
_BR = (
    f"concat(replace(format('{{:,}}', {cents_sql('o_totalprice')} // 100), ',', '.'), ',', "
    f"lpad(cast({cents_sql('o_totalprice')} % 100 as varchar), 2, '0'))"
)
_SALE_SQL = f"""
sale as (select *, {_ADDRESS} as address, {_EMAIL} as mail, {_AGENCY} as agency,
    {_PARCELS} as parcels, strftime(o_orderdate, '%d/%m/%Y') as day, {_BR} as total
  from orders join customer on c_custkey = o_custkey)"""
_BEFORE = " + ".join(_field_sql(x) for x in ("o_orderkey", "''", "concat('A', o_custkey)", "c_name"))
_AFTER = " + ".join(_field_sql(x) for x in (
    "'N/A'", "agency", "day", "concat(day, ' 10:20')", "o_custkey % 7", "o_orderpriority",
    "'1.234,5'", "total", "o_orderstatus", "'sem data'", "parcels"))
_WITH_MAIL = f"case when {_YEAR_EVEN} then {_field_sql('mail')} else 0 end"
CARVE = f"""
with {_SALE_SQL},
lines as (
  select {_dataset_sql('182')} as src_table, o_orderkey * 16 + 100 as line_no,
    case when o_orderkey % 3 = 0
         then {_BEFORE} + length(replace(split_part(address, chr(10), 1), '"', '""')) + 1
         else {_BEFORE} + {_field_sql('address')} + {_AFTER} + {_WITH_MAIL} end as chars
  from sale
  union all
  select {_dataset_sql('182')}, o_orderkey * 16 + 101, length('fundos') + 2 + {_AFTER} + {_WITH_MAIL}
  from sale where o_orderkey % 3 = 0)
select src_table, line_no, cast(chars as int) as chars from lines"""


def header_map(spark, sf):
    """Text columns by header name, one row per record."""
    lines = _lines_182(spark, sf)
    r = sales.SALES_182
    markers = written(reports.marker_lines(lines, FILE, r.header, r.stops), "markers")
    bounds = written(reports.block_bounds(markers, FILE), "bounds")
    maps = written(reports.quote_maps(reports.carve_block(lines, bounds, FILE), FILE), "lines")
    odd = written(reports.quote_exceptions(maps, FILE), "quotes")
    records = reports.logical_records(reports.quote_states(maps, odd, FILE), FILE)
    wanted = {"conta": ["Conta"], "cliente": ["Cliente"], "endereco": ["Endereço"],
              "celular": ["Celular"], "email": ["Email"], "agencia": ["Agencia", "Agência"],
              "total": ["Total"], "ausente": ["Ausente"]}
    at = reports.header_positions(bounds, FILE, wanted)
    return reports.select_fields(
        reports.parse_records(records, FILE), at, FILE, list(wanted)
    )


HEADER_MAP = f"""
with {_SALE_SQL}
select {_dataset_sql('182')} as src_table, o_orderkey * 16 + 100 as line_no,
  cast(o_orderkey as varchar) as conta, c_name as cliente, address as endereco,
  cast(null as varchar) as celular,
  case when {_YEAR_EVEN} then nullif(nullif(mail, ''), 'N/A') end as email,
  nullif(agency, 'null') as agencia, total, cast(null as varchar) as ausente
from sale"""

_TEST = "gate@park.example"


def report_182(spark, sf):
    rows, _ = sales.silver_report(_lines_182(spark, sf), sales.SALES_182, RUN_TS, _TEST)
    return plain(sales.with_period(rows, sales.SALES_182))


_MAIL = "nullif(nullif(lower(trim(mail)), ''), 'n/a')"
_NULL = "cast(null as varchar)"
REPORT_182 = f"""
with {_SALE_SQL}
select cast(o_orderkey as varchar) as id_venda, {_NULL} as loc_vhf,
  concat('A', o_custkey) as autorizacao, c_name as cliente, {_NULL} as dt_nascimento,
  address as endereco, {_NULL} as cidade, {_NULL} as celular, {_NULL} as telefone,
  case when {_YEAR_EVEN} then {_MAIL} end as email,
  case when not {_YEAR_EVEN} then 'NÃO' when {_MAIL} = '{_TEST}' then 'SIM'
       when {_MAIL} is not null then 'NÃO' end as teste,
  nullif(agency, 'null') as agencia, strftime(o_orderdate, '%Y-%m-%d') as data,
  strftime(o_orderdate, '%Y-%m-%d') as dt_venda, '10:20:00' as hr_venda, o_custkey % 7 as qtd,
  o_orderpriority as produto, '1234.50' as vlr_unid, {money_sql(cents_sql('o_totalprice'))} as vlr_total,
  o_orderstatus as status, {_NULL} as entregue, {_NULL} as forma_pagamento, {_NULL} as usuario,
  {_NULL} as dt_utilizacao, {_NULL} as dt_baixa, {_NULL} as nsu,
  cast(case when parcels = '1.0' then 1 end as bigint) as qtd_parcelas, {_NULL} as prazo_recebimento,
  {_NULL} as pedido_esolution, {_NULL} as dt_integracao, {RUN_MICROS} as ingested_at,
  {_dataset_sql('182')} as fonte_tabela_bronze, strftime(o_orderdate, '%Y%m') as ano_mes
from sale"""


# ------------------------------------------------------------- reports 270 and 418


def report_270(spark, sf):
    header = "Conta;Autorização;Cliente;Data;Criado;Qtd;Total;Data Utilização;Hora Utilização;Data Encerramento"
    o = _orders(spark, sf)
    day = F.date_format("o_orderdate", "d/M/yyyy")
    clock = pick(F.col("o_orderkey"), F.lit("9:05"), F.lit("23:59:58"), F.lit("?"))
    record = F.concat_ws(
        ";", F.col("o_orderkey").cast("string"), F.lit("A"), F.col("o_orderpriority"), day,
        F.date_format("o_orderdate", "yyyy-MM-dd 08:00:01"), F.lit("2.0"),
        br_text(cents("o_totalprice")), day, clock, F.lit("2025-12-31"),
    )
    records = o.select(_dataset("270").alias(FILE), F.col("o_orderkey").alias("at"), record.alias("record"))
    lines = _framed(records, F.lit(header), ["Produtos/Combos vendidos em 2025"])
    rows, _ = sales.silver_report(lines, sales.SALES_270, RUN_TS, _TEST)
    return plain(rows.select(
        "id_venda", "cliente", "email", "teste", "data", "dt_venda", "hr_venda", "qtd",
        "vlr_total", "dt_utilizacao", "hr_utilizacao", "dt_encerramento", "fonte_tabela_bronze",
    ))


_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
REPORT_270 = f"""
select cast(o_orderkey as varchar) as id_venda, o_orderpriority as cliente, {_NULL} as email,
  'NÃO' as teste, {_DAY} as data, {_DAY} as dt_venda, '08:00:01' as hr_venda,
  cast(2 as bigint) as qtd, {money_sql(cents_sql('o_totalprice'))} as vlr_total,
  {_DAY} as dt_utilizacao,
  {pick_sql('o_orderkey', "'09:05:00'", "'23:59:58'", 'null')} as hr_utilizacao,
  '2025-12-31' as dt_encerramento, {_dataset_sql('270')} as fonte_tabela_bronze
from orders"""


def report_418(spark, sf):
    header = "Conta;Data;Data Visita;Qtd;Valor;Produtos-Carrinho;Pessoa;Email;Telefone;Cidade;Motivo;"
    o = _orders(spark, sf)
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    record = _quoted(
        F.col("o_orderkey"), day, "", "x", br_text(cents("o_totalprice")),
        F.concat(F.col("o_orderpriority"), F.lit(' "promo"')), "NULL", " A@B.example",
        "11 5555", "Cotia", F.col("o_orderstatus"),
    )
    records = o.select(_dataset("418").alias(FILE), F.col("o_orderkey").alias("at"), record.alias("record"))
    lines = _framed(records, F.lit(header), ['"Total";"9"'])
    rows, _ = sales.silver_report(lines, sales.CARTS_418, RUN_TS)
    return plain(rows)


REPORT_418 = f"""
select cast(o_orderkey as varchar) as id_venda, {_DAY} as data, {_NULL} as dt_utilizacao,
  cast(null as bigint) as qtd, {money_sql(cents_sql('o_totalprice'))} as vlr_total,
  o_orderpriority || ' "promo"' as produto, {_NULL} as cliente, 'a@b.example' as email,
  '11 5555' as telefone, 'Cotia' as cidade, o_orderstatus as motivo,
  {RUN_MICROS} as ingested_at, {_dataset_sql('418')} as fonte_tabela_bronze
from orders"""


def sales_layers(spark, sf):
    """Bronze by dataset, then the silver table by dataset, and the rows read back."""
    o = _orders(spark, sf)
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    record = F.concat_ws(
        ";", F.col("o_orderkey").cast("string"), day, day, F.lit("1"),
        br_text(cents("o_totalprice")), F.col("o_orderpriority"), F.lit("p"), F.lit("e"), F.lit("t"),
        F.lit("c"), F.col("o_orderstatus"),
    )
    records = o.select(
        _dataset("418").alias(FILE), F.col("o_orderkey").alias("at"), record.alias("record")
    )
    header = "Conta;Data;Data Visita;Qtd;Valor;Produtos-Carrinho;Pessoa;Email;Telefone;Cidade;Motivo"
    lines = _framed(records, F.lit(header), ['"Total";"9"'])
    other = lines.withColumn(FILE, F.replace(F.col(FILE), F.lit("_418"), F.lit("_270")))
    root = work_dir(spark, "sales")
    write_reports(lines.unionByName(other), f"{root}/bronze", "overwrite")
    sales.load_silver(spark, f"{root}/bronze", f"{root}/silver", sales.CARTS_418, RUN_TS)
    rows = sales.read_silver(spark, f"{root}/silver", sales.CARTS_418)
    return plain(rows.select("id_venda", "data", "qtd", "vlr_total", "produto", "motivo", "fonte_tabela_bronze"))


def sales_rerun(spark, sf):
    """The datasets loaded twice; then one lands again with a broken header, and its old
    rows go."""
    o = _orders(spark, sf)
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    record = F.concat_ws(
        ";", F.col("o_orderkey").cast("string"), day, day, F.lit("1"),
        br_text(cents("o_totalprice")), F.lit("x"), F.lit("p"), F.lit("e"), F.lit("t"), F.lit("c"), F.lit("m"),
    )
    records = o.select(
        _dataset("418").alias(FILE), F.col("o_orderkey").alias("at"), record.alias("record")
    )
    header = "Conta;Data;Data Visita;Qtd;Valor;Produtos-Carrinho;Pessoa;Email;Telefone;Cidade;Motivo"
    lines = _framed(records, F.lit(header), ['"Total";"9"'])
    root = work_dir(spark, "rerun")
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    for _ in range(2):
        write_reports(lines, bronze, "overwrite")
        sales.load_silver(spark, bronze, silver, sales.CARTS_418, RUN_TS)
    broken = lines.join(records.agg(F.min(FILE).alias(FILE)), FILE).withColumn(
        "raw_line", F.replace("raw_line", F.lit("Conta;Data;"), F.lit("Other;"))
    )
    write_reports(broken, bronze, "overwrite")
    sales.load_silver(spark, bronze, silver, sales.CARTS_418, RUN_TS)
    rows = sales.read_silver(spark, silver, sales.CARTS_418)
    return plain(rows.select("id_venda", "data", "vlr_total", "fonte_tabela_bronze"))


SALES_RERUN = f"""
select cast(o_orderkey as varchar) as id_venda, {_DAY} as data,
  {money_sql(cents_sql('o_totalprice'))} as vlr_total, {_dataset_sql('418')} as fonte_tabela_bronze
from orders where strftime(o_orderdate, '%Y%m') > (select min(strftime(o_orderdate, '%Y%m')) from orders)"""

def _by_format(spark, sf):
    """Datasets whose dates are day first in odd years and month first in even ones, with some
    that are year first and some that are no date."""
    o = _orders(spark, sf)
    even = F.year("o_orderdate") % 2 == 0
    told = F.when(even, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    told = F.when(F.col("o_orderkey") % 10 == 0, "n/d").when(
        F.col("o_orderkey") % 10 == 1, F.date_format("o_orderdate", "yyyy-MM-dd")
    ).otherwise(told)
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    record = F.concat_ws(
        ";", F.col("o_orderkey").cast("string"), told, iso, F.lit("1"), F.lit("1,00"), *[F.lit(x) for x in "xpetcm"],
    )
    records = o.select(_dataset("418").alias(FILE), F.col("o_orderkey").alias("at"), record.alias("record"))
    header = "Conta;Data;Data Visita;Qtd;Valor;Produtos-Carrinho;Pessoa;Email;Telefone;Cidade;Motivo"
    lines = _framed(records, F.lit(header), ['"Total";"9"'])
    return sales.silver_report_by_format(lines, sales.CARTS_418, RUN_TS)


def date_formats(spark, sf):
    rows, _, _ = _by_format(spark, sf)
    return plain(rows.select("id_venda", "data", "dt_utilizacao", "fonte_tabela_bronze"))


def date_format_report(spark, sf):
    _, _, formats = _by_format(spark, sf)
    return formats.select(F.col(FILE).alias("dataset"), "column", "format", "filled", "unread")


_CELLS = f"""
cells as (select {_dataset_sql('418')} as dataset, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as iso,
    case o_orderkey % 10 when 0 then 'n/d' when 1 then strftime(o_orderdate, '%Y-%m-%d')
      else case when year(o_orderdate) % 2 = 0 then strftime(o_orderdate, '%m/%d/%Y') else strftime(o_orderdate, '%d/%m/%Y') end end as told
  from orders),
counts as (select dataset, count(*) as filled, count(try_strptime(told, '%d/%m/%Y')) as d,
    count(try_strptime(told, '%m/%d/%Y')) as m, count(try_strptime(told, '%Y-%m-%d')) as y from cells group by dataset),
chosen as (select dataset, filled, greatest(d, m, y) as best,
    case when greatest(d, m, y) = 0 then null when d >= m and d >= y then 'day first' when m >= y then 'month first' else 'year first' end as format
  from counts)"""
DATE_FORMATS = f"""
with {_CELLS}
select cast(o_orderkey as varchar) as id_venda, strftime(case format when 'day first' then try_strptime(told, '%d/%m/%Y')
    when 'month first' then try_strptime(told, '%m/%d/%Y') else try_strptime(told, '%Y-%m-%d') end, '%Y-%m-%d') as data,
  iso as dt_utilizacao, dataset as fonte_tabela_bronze
from cells join chosen using (dataset)"""
DATE_FORMAT_REPORT = f"""
with {_CELLS}
select dataset, 'data' as "column", format, filled, filled - best as unread from chosen
union all select dataset, 'dt_utilizacao', 'year first', filled, cast(0 as bigint) from chosen"""

SALES_LAYERS = f"""
select cast(o_orderkey as varchar) as id_venda, {_DAY} as data, cast(1 as bigint) as qtd,
  {money_sql(cents_sql('o_totalprice'))} as vlr_total, o_orderpriority as produto,
  o_orderstatus as motivo, {_dataset_sql('418')} as fonte_tabela_bronze
from orders"""


# ------------------------------------------------------------------- report 664

_HEADER_664 = (
    "Id;Tipo;Nome;Data Venda;Checkin;Checkout;Valor;Cupom;Nome do Cupom;Status;"
    "Percentual de Desconto;Produtos aplicados;Data inicial de utilização;Data final de utilização;"
)


def report_664(spark, sf):
    """Orders are parent lines, their items are child lines below them."""
    o, items = _orders(spark, sf), table(spark, sf, "lineitem")
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    parents = o.select(
        _dataset("664").alias(FILE), F.col("o_orderkey").alias("at"),
        _quoted(
            F.col("o_orderkey"), F.lit("Passaporte"), F.col("o_orderpriority"), day, day, "",
            br_text(cents("o_totalprice")),
            F.nullif("o_orderstatus", F.lit("P")), F.lit("Cupom"), F.col("o_orderstatus"),
            "", "", day, "N/A",
        ).alias("record"),
    )
    child = items.groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_partkey").alias("part"), F.max(F.round(F.col("l_discount") * 100).cast("int")).alias("pct")
    ).join(o.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    children = child.select(
        _dataset("664").alias(FILE), F.col("o_orderkey").alias("at"), "l_linenumber",
        _quoted(
            "", "", "", "", "", "", "", "", "", "",
            F.concat(F.col("pct").cast("string"), F.lit(",00%")),
            F.concat(F.lit("Produto "), F.col("part").cast("string")), "", "",
        ).alias("record"),
    )
    below = children.select(
        FILE, (F.col("at") * 16 + F.col("l_linenumber") + 100).alias("line_no"),
        F.col("record").alias("raw_line"),
    )
    lines = _framed(parents, F.lit(_HEADER_664), ['"Total Geral"'], below)
    rows, _ = sales.silver_report(lines, sales.COUPONS_664, RUN_TS)
    return plain(rows)


# The coupon code is NULL on some parents, so there it comes from the parent above.
REPORT_664 = f"""
with filled as (select *,
    last_value(nullif(o_orderstatus, 'P') ignore nulls) over (
      partition by strftime(o_orderdate, '%Y%m') order by o_orderkey
      rows between unbounded preceding and current row) as coupon
  from orders),
child as (select l_orderkey, l_linenumber, max(l_partkey) as part,
    cast(max(round(l_discount * 100)) as int) as pct from lineitem group by 1, 2)
select cast(o_orderkey as varchar) as id_venda, 'Passaporte' as tipo_produto,
  o_orderpriority as cliente, {_DAY} as dt_venda, {_DAY} as dt_utilizacao, {_NULL} as dt_saida,
  {money_sql(cents_sql('o_totalprice'))} as vlr_total, coupon as cod_cupom, 'Cupom' as nome_cupom,
  o_orderstatus as status, concat(pct, ',00%') as nome_desconto, concat('Produto ', part) as produto,
  {_DAY} as dt_inicial_uso_cupom, {_NULL} as dt_final_uso_cupom, {RUN_MICROS} as ingested_at,
  {_dataset_sql('664')} as fonte_tabela_bronze
from filled join child on l_orderkey = o_orderkey where pct > 0"""


# ------------------------------------------------------------------- dimensions


def dimensions(spark, sf):
    """Payment forms and products: the header itself names the columns."""
    part = table(spark, sf, "part")
    product = part.select(
        F.concat(F.lit("t_2025"), F.lpad((F.col("p_size") % 12 + 1).cast("string"), 2, "0"), F.lit("_produto")).alias(FILE),
        F.col("p_partkey").alias("at"),
        F.concat_ws(
            ";", F.col("p_name"), F.col("p_type"), F.col("p_brand"),
            F.when(F.col("p_size") > 25, F.lit("NA")).otherwise(F.lit("sim")),
            F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" ")),
        ).alias("record"),
    )
    header = "produto;tipo_produto;categoria;infantil; PAX"
    lines = product.select(FILE, (F.col("at") + 100).alias("line_no"), F.col("record").alias("raw_line"))
    heads = product.select(FILE).distinct().select(
        FILE, F.lit(7).cast("long").alias("line_no"), F.lit(header).alias("raw_line")
    )
    rows, _ = sales.silver_report(lines.unionByName(heads), sales.PRODUCTS, RUN_TS)
    pay = part.select(
        F.lit("t_202501_formapgto").alias(FILE), (F.col("p_partkey") + 2).alias("line_no"),
        F.concat_ws(";", F.concat(F.lit("F"), F.col("p_partkey").cast("string")), F.col("p_brand")).alias("raw_line"),
    )
    head = spark.range(1).select(
        F.lit("t_202501_formapgto").alias(FILE), F.lit(1).cast("long").alias("line_no"),
        F.lit(chr(0xFEFF) + "forma_pagamento;tipo_pagamento").alias("raw_line"),
    )
    forms, _ = sales.silver_report(pay.unionByName(head), sales.PAYMENT_FORMS, RUN_TS)
    return rows.unionByName(forms, allowMissingColumns=True)


DIMENSIONS = f"""
select p_name as produto, p_type as tipo_produto, p_brand as categoria,
  case when p_size <= 25 then 'sim' end as infantil, cast(p_size as bigint) as pax,
  concat('t_2025', lpad(cast(p_size % 12 + 1 as varchar), 2, '0'), '_produto') as fonte_tabela_bronze,
  {_NULL} as forma_pagamento, {_NULL} as tipo_pagamento
from part
union all
select {_NULL}, {_NULL}, {_NULL}, {_NULL}, null, 't_202501_formapgto', concat('F', p_partkey), p_brand
from part"""


# ---------------------------------------------------------------------- rejects


def rejects(spark, sf):
    """Each year breaks its exports in another way; what is read and why not."""
    o = _orders(spark, sf)
    year = F.substring(FILE, 3, 4)
    urgent = F.col("o_orderpriority") == "1-URGENT"
    fields = [F.col("o_orderkey"), F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit("01/02/2025")]
    rest = ["1", "1,00", "p", "c", "a@b.example", "t", "Cotia", "m"]
    good = F.concat_ws(";", *[f.cast("string") for f in fields], *[F.lit(x) for x in rest])
    record = (
        F.when((year == "1997") & urgent, F.concat(good, F.lit(";extra")))
        .when((year == "1999") & urgent, F.concat(F.lit('"a"b;'), good))
        .otherwise(good)
    )
    records = o.withColumn(FILE, _dataset("418")).select(
        FILE, F.col("o_orderkey").alias("at"), record.alias("record"), year.alias("y")
    )
    header = "Conta;Data;Data Visita;Qtd;Valor;Produtos-Carrinho;Pessoa;Email;Telefone;Cidade;Motivo"
    unclosed = records.where(F.col("y") == "1998").select(FILE).distinct().select(
        FILE, F.lit(END - 1).cast("long").alias("line_no"), F.lit('7;"open').alias("raw_line")
    )
    lines = _framed(records.drop("y"), F.lit(header), ['"Total Geral"'], unclosed)
    is_data = (F.col("line_no") > 50) & (F.col("line_no") < END)
    is_head = F.col("raw_line") == header
    lines = lines.where(~((year == "1995") & is_head) & ~((year == "1996") & is_data))
    parsed = sales.parse_report(lines, sales.CARTS_418)
    rows = sales.typed_report(parsed, sales.CARTS_418, RUN_TS)
    read = rows.groupBy("fonte_tabela_bronze").agg(F.count(F.lit(1)).alias("rows"))
    return read.select(F.col("fonte_tabela_bronze").alias(FILE), F.lit("read").alias("reason"), "rows").unionByName(
        parsed.rejects.withColumn("rows", F.lit(0).cast("long"))
    )


_REASON = """case when y in ('1995') then 'no_header' when y = '1996' then 'no_data'
  when y = '1998' then 'open_quote' when not has then 'read'
  when y = '1997' then 'too_many_fields'
  when y = '1999' then 'text_after_quote' else 'read' end"""
REJECTS = f"""
with t as (select {_dataset_sql('418')} as src_table, strftime(o_orderdate, '%Y') as y,
    count(*) as n, bool_or(o_orderpriority = '1-URGENT') as has from orders group by 1, 2),
r as (select src_table, n, {_REASON} as reason from t)
select src_table, reason, case when reason = 'read' then n else 0 end as "rows" from r"""


def report_audit(spark, sf):
    """Counts over one silver report: rows, test sales and rows without a phone."""
    rows, _ = sales.silver_report(_lines_182(spark, sf), sales.SALES_182, RUN_TS, _TEST)
    return audit_counts(rows, {
        "rows": F.lit(True), "tests": F.col("teste") == "SIM",
        "unread_dates": F.col("dt_utilizacao").isNull(),
    })


REPORT_AUDIT = f"""
select 'rows' as "check", count(*) as "rows" from orders
union all select 'tests', count(*) from orders where o_orderkey % 4 = 0 and {_YEAR_EVEN}
union all select 'unread_dates', count(*) from orders"""

QUERIES = {
    "q_carve_block": (carve, CARVE),
    "q_header_map": (header_map, HEADER_MAP),
    "q_report_182": (report_182, REPORT_182),
    "q_report_270": (report_270, REPORT_270),
    "q_report_418": (report_418, REPORT_418),
    "q_report_664": (report_664, REPORT_664),
    "q_sales_rerun": (sales_rerun, SALES_RERUN),
    "q_date_formats": (date_formats, DATE_FORMATS),
    "q_date_format_report": (date_format_report, DATE_FORMAT_REPORT),
    "q_sales_layers": (sales_layers, SALES_LAYERS),
    "q_dimensions": (dimensions, DIMENSIONS),
    "q_report_rejects": (rejects, REJECTS),
    "q_report_audit": (report_audit, REPORT_AUDIT),
}
