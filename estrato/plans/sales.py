"""Sales reports: raw lines of ``;`` exports to typed silver tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estrato import schemas
from estrato.functions import dates, numbers, text
from estrato.operators import reports
from estrato.operators.formats import chosen_formats, format_counts, with_formats
from estrato.operators.ordered import forward_fill
from estrato.operators.shape import align_to_schema, drop_empty_or_zero, read_cells
from estrato.session import written
from estrato.sources.files import TABLE, raw_lines
from estrato.sources.tables import datasets_with_suffix, empty_datasets, write_reports

Cast = Callable[[Column], Column]


@dataclass(frozen=True)
class Report:
    """What makes one kind of report differ from another.

    ``header`` opens the main block, ``stops`` close it.  ``columns`` maps a silver
    column to the header texts it may have; without it the header itself is turned into
    column names.  ``fill`` columns take the value of the parent line above them, and
    lines with an empty or zero ``need`` column are dropped after that.
    """

    suffix: str
    header: str
    schema: T.StructType
    stops: Sequence[str] = ()
    columns: Mapping[str, Sequence[str]] = field(default_factory=dict)
    casts: Mapping[str, Cast] = field(default_factory=dict)
    fill: Sequence[str] = ()
    need: Sequence[str] = ()
    test_flag: bool = False


def _one(**names: str) -> dict[str, list[str]]:
    return {column: [header] for column, header in names.items()}


# Header texts, header prefixes and stop markers of the exports.
_SALE = {
    **_one(
        id_venda="Conta", autorizacao="Autorização", cliente="Cliente", endereco="Endereço",
        cidade="Cidade", celular="Celular", telefone="Telefone", email="Email", data="Data",
        criado="Criado", qtd="Qtd", produto="Produto", vlr_unid="Un.", vlr_total="Total",
        status="Status", entregue="Entregue", forma_pagamento="Forma de Pagamento",
        usuario="Usuário", dt_utilizacao="Data Utilização", nsu="NSU",
        qtd_parcelas="Quantidade de Parcelas", prazo_recebimento="Prazo estimado do recebimento",
    ),
    "agencia": ["Agencia", "Agência"],
}
_SALE_CASTS: dict[str, Cast] = {
    "data": dates.day_first_date,
    "dt_utilizacao": dates.day_first_date,
    "qtd": numbers.whole_number,
    "qtd_parcelas": numbers.whole_number,
    "vlr_unid": numbers.br_decimal,
    "vlr_total": numbers.br_decimal,
    "email": text.email,
}

SALES_182 = Report(
    suffix="182",
    header="Conta;Loc VHF;Autorização;Cliente;",
    stops=(
        '"";"";', '"Total Geral"', '"Total";', "Produtos/Combos vendidos por período",
        "Produto;Qtd;Total",
    ),
    schema=schemas.SALES_182,
    columns={
        **_SALE,
        **_one(
            loc_vhf="Loc VHF", dt_nascimento="Data Nasc", dt_baixa="Data Baixa",
            pedido_esolution="Pedido Esolution", dt_integracao="Data Integração",
        ),
    },
    casts={
        **_SALE_CASTS,
        "dt_baixa": dates.day_first_date,
        "dt_integracao": dates.day_first_date,
    },
    test_flag=True,
)
SALES_270 = Report(
    suffix="270",
    header="Conta;Autorização;Cliente;",
    stops=(
        '"";"";', '"Total Geral"', '"Total";', "Produtos/Combos vendidos", "Produto;Qtd;Total",
    ),
    schema=schemas.SALES_270,
    columns={
        **_SALE, **_one(hr_utilizacao="Hora Utilização", dt_encerramento="Data Encerramento"),
    },
    casts={
        **_SALE_CASTS,
        "hr_utilizacao": dates.time_of_day,
        "dt_encerramento": dates.day_first_date,
    },
    test_flag=True,
)
CARTS_418 = Report(
    suffix="418",
    header="Conta;Data;Data Visita;",
    stops=('"";"";', '"Total Geral"', '"Total";'),
    schema=schemas.CARTS_418,
    columns=_one(
        id_venda="Conta", data="Data", dt_utilizacao="Data Visita", qtd="Qtd", vlr_total="Valor",
        produto="Produtos-Carrinho", cliente="Pessoa", email="Email", telefone="Telefone",
        cidade="Cidade", motivo="Motivo",
    ),
    casts={k: _SALE_CASTS[k] for k in ("data", "dt_utilizacao", "qtd", "vlr_total", "email")},
)
COUPONS_664 = Report(
    suffix="664",
    header="Id;Tipo;Nome;Data Venda;",
    stops=('"Total Geral"', '"Total";'),
    schema=schemas.COUPONS_664,
    columns=_one(
        id_venda="Id", tipo_produto="Tipo", cliente="Nome", dt_venda="Data Venda",
        dt_utilizacao="Checkin", dt_saida="Checkout", vlr_total="Valor", cod_cupom="Cupom",
        nome_cupom="Nome do Cupom", status="Status", nome_desconto="Percentual de Desconto",
        produto="Produtos aplicados", dt_inicial_uso_cupom="Data inicial de utilização",
        dt_final_uso_cupom="Data final de utilização",
    ),
    casts={
        "dt_venda": dates.day_first_date,
        "dt_utilizacao": dates.day_first_date,
        "dt_saida": dates.day_first_date,
        "dt_inicial_uso_cupom": dates.day_first_date,
        "dt_final_uso_cupom": dates.day_first_date,
        "vlr_total": numbers.br_decimal,
    },
    fill=(
        "id_venda", "tipo_produto", "cliente", "dt_venda", "dt_utilizacao", "dt_saida",
        "vlr_total", "cod_cupom", "nome_cupom", "status", "dt_inicial_uso_cupom",
        "dt_final_uso_cupom",
    ),
    need=("nome_desconto", "produto"),
)
PAYMENT_FORMS = Report(
    suffix="formapgto", header="forma_pagamento;tipo_pagamento", schema=schemas.PAYMENT_FORMS
)
PRODUCTS = Report(
    suffix="produto",
    header="produto;tipo_produto;categoria;infantil;",
    schema=schemas.PRODUCTS,
    casts={"pax": numbers.whole_number},
)

METADATA = ("ingested_at", "fonte_tabela_bronze")
MISSING_PARENT = "missing_parent_column"


@dataclass(frozen=True)
class Parsed:
    """Records of one kind of report, where each column stands, and files set aside."""

    rows: DataFrame
    positions: DataFrame
    columns: Sequence[str]
    rejects: DataFrame


def parse_report(lines: DataFrame, report: Report, file: str = TABLE) -> Parsed:
    """Carve and parse all files of one report kind at once.

    Results that several steps read are written on the way, so the raw text is read
    twice and shuffled once, whatever its size.  Small results that are joined with the
    text (block bounds, quote exceptions, rejected files) are written too: their size is
    then known, and Spark broadcasts them or, above its threshold, does not.
    """
    columns = report.columns or _one(**{c: c for c in _business(report)})
    rename = None if report.columns else text.column_name
    markers = written(
        reports.marker_lines(lines, file, report.header, report.stops), "markers"
    )
    bounds = written(reports.block_bounds(markers, file), "bounds")
    maps = written(reports.quote_maps(reports.carve_block(lines, bounds, file), file), "lines")
    odd = written(reports.quote_exceptions(maps, file), "quotes")
    records = reports.logical_records(reports.quote_states(maps, odd, file), file)
    parsed = written(reports.parse_records(records, file), "records")
    at = reports.header_positions(bounds, file, columns, rename=rename)
    rejects = written(_rejects(lines, bounds, odd, parsed, at, report, file), "rejects")
    return Parsed(
        parsed.join(rejects.select(file), file, "left_anti"), at, list(columns), rejects
    )


def _rejects(
    lines: DataFrame, bounds: DataFrame, odd: DataFrame, parsed: DataFrame, at: DataFrame,
    report: Report, file: str,
) -> DataFrame:
    """Files that are not read: ``(file, reason)``, one row each."""
    bad = reports.unreadable_files(parsed, at, file).unionByName(
        _because(reports.unclosed_files(odd, file), reports.OPEN_QUOTE)
    )
    if report.fill:
        absent = [F.col(f"at.`{c}`").isNull() for c in (*report.fill, *report.need)]
        lacking = at.where(reduce(lambda a, b: a | b, absent)).select(file)
        bad = bad.unionByName(
            _because(lacking.join(bad.select(file), file, "left_anti"), MISSING_PARENT)
        )
    heads = bounds.select(file)
    no_header = lines.select(file).distinct().join(heads, file, "left_anti")
    seen = parsed.select(file).distinct().unionByName(bad.select(file))
    no_data = heads.join(seen, file, "left_anti")
    return bad.unionByName(_because(no_header, reports.NO_HEADER)).unionByName(
        _because(no_data, reports.NO_DATA)
    )


def _because(files: DataFrame, reason: str) -> DataFrame:
    return files.withColumn("reason", F.lit(reason))


def _business(report: Report) -> list[str]:
    return [n for n in report.schema.names if n not in METADATA]


def _date_columns(parsed: Parsed, report: Report) -> list[str]:
    return [n for n, f in report.casts.items() if f is dates.day_first_date and n in parsed.columns]


def report_fields(parsed: Parsed, file: str = TABLE) -> DataFrame:
    """The fields of all records as text, without empty records."""
    filled = reports.drop_empty_records(parsed.rows)
    return reports.select_fields(filled, parsed.positions, file, parsed.columns)


def date_formats(parsed: Parsed, report: Report, file: str = TABLE) -> DataFrame:
    """The format of each date column of each dataset, and how many of its cells it leaves unread."""
    counts = format_counts(report_fields(parsed, file), file, _date_columns(parsed, report))
    return written(chosen_formats(counts, file), "date-formats")


def typed_report(
    parsed: Parsed, report: Report, run_ts: datetime, test_email: str | None = None,
    file: str = TABLE, formats: DataFrame | None = None,
) -> DataFrame:
    """Typed silver rows.  ``test_email`` is the address whose sales count as tests; with
    ``formats`` a date column is read by the one format of its dataset, else each cell by
    itself, day first and then ISO."""
    rows = report_fields(parsed, file)
    by_format = _date_columns(parsed, report) if formats is not None else []
    if by_format:
        rows = with_formats(rows, file, by_format, formats)
    cast = {n: f for n, f in report.casts.items() if n in parsed.columns and n not in by_format}
    if report.fill:
        early = {n: cast.pop(n) for n in report.fill if n in cast}
        rows = forward_fill(rows, [file], reports.LINE, report.fill, read=early)
    if report.need:
        rows = drop_empty_or_zero(rows, report.need)
    typed = read_cells(rows, cast).select(
        F.col(file).alias("fonte_tabela_bronze"),
        *parsed.columns,
        F.lit(run_ts).alias("ingested_at"),
    )
    if "criado" in parsed.columns:
        made = dates.day_first_timestamp(F.col("criado"))
        typed = typed.withColumn("dt_venda", made.cast("date")).withColumn(
            "hr_venda", dates.time_of(made)
        )
    if report.test_flag:
        has_email = parsed.positions.select(
            F.col(file).alias("fonte_tabela_bronze"),
            F.col("at.email").isNotNull().alias("_has_email"),
        )
        flag = text.match_flag(F.col("email"), test_email or "")
        typed = typed.join(has_email, "fonte_tabela_bronze").withColumn(
            "teste", F.when(F.col("_has_email"), flag).otherwise(F.lit("NÃO"))
        )
    return align_to_schema(typed, report.schema)


def silver_report(
    bronze: DataFrame, report: Report, run_ts: datetime, test_email: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """All datasets of one report kind in bronze: silver rows, and rejected datasets."""
    parsed = parse_report(datasets_with_suffix(bronze, report.suffix), report)
    return typed_report(parsed, report, run_ts, test_email), parsed.rejects


def silver_report_by_format(
    bronze: DataFrame, report: Report, run_ts: datetime, test_email: str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As ``silver_report``, with one date format for each date column of a dataset; the third
    result tells the formats and how many cells they leave unread."""
    parsed = parse_report(datasets_with_suffix(bronze, report.suffix), report)
    formats = date_formats(parsed, report)
    return typed_report(parsed, report, run_ts, test_email, formats=formats), parsed.rejects, formats


def with_period(silver: DataFrame, report: Report) -> DataFrame:
    """Add ``ano_mes``, the period in the dataset name."""
    period = reports.period_of(F.col("fonte_tabela_bronze"), report.suffix)
    return silver.withColumn("ano_mes", period)


def load_bronze(
    spark: SparkSession, folder: str, bronze: str, *, batch_id: str, run_ts: datetime,
    allow: Sequence[str] | None = None, origin: str | None = None, mode: str = "overwrite",
) -> None:
    """Land the report files of a folder as raw lines, one dataset per file name.

    A dataset that is landed again replaces its lines, so a repeated load is harmless;
    ``append`` adds them, and a line number is then no longer unique.
    """
    lines = raw_lines(
        spark, folder, batch_id=batch_id, run_ts=run_ts, allow=allow, origin=origin
    )
    write_reports(lines, bronze, mode)


def load_silver(
    spark: SparkSession, bronze: str, silver: str, report: Report, run_ts: datetime,
    test_email: str | None = None, mode: str = "overwrite",
) -> DataFrame:
    """Type all datasets of a report kind into its silver table; returns the rejects.

    ``overwrite`` replaces every dataset that was read, those that gave no row or were
    rejected too, so a second run doubles nothing and leaves nothing behind; ``append`` adds
    the rows again.
    """
    lines = spark.read.parquet(bronze)
    rows, rejects = silver_report(lines, report, run_ts, test_email)
    write_reports(rows, silver, mode, by="fonte_tabela_bronze")
    if mode == "overwrite":
        read = datasets_with_suffix(lines, report.suffix).select(F.col(TABLE).alias("fonte_tabela_bronze"))
        empty_datasets(read.distinct(), rejects.select(TABLE), silver, report.schema, "fonte_tabela_bronze")
    return rejects


def read_silver(spark: SparkSession, silver: str, report: Report) -> DataFrame:
    return spark.read.schema(report.schema).parquet(silver).select(*report.schema.names)
