"""Gate access: two relational sources to one gold fact.

Source L is keyed by voucher number, source Q by access id.  Every stage is a function
of DataFrames; the loads at the end write the layers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estrato import schemas
from estrato.functions.dates import time_of
from estrato.functions.payload import field_or_null, payload_fields, payload_of
from estrato.functions.text import code_of, label_of
from estrato.operators.aggregates import text_lists
from estrato.operators.audit import audit_counts
from estrato.operators.incremental import (
    WATERMARK_KEYS, get_watermark, not_in, set_watermark, watermark_row,
)
from estrato.operators.joins import (
    Dim, exclude_category, lookup_default, star_join, union_origin,
)
from estrato.operators.shape import align_to_schema, drop_blank_keys
from estrato.session import written
from estrato.sources.buckets import insert_bucketed
from estrato.sources.ledger import Ledger, read_folders
from estrato.sources.tables import append_batch, read_current, write_version

OTHERS, CHECK = "OUTROS", "CHECK"


def between_days(c: Column, start: date, end: date) -> Column:
    """Inclusive day range on a bare date or timestamp column, so it can be pushed down."""
    return (c >= F.lit(start)) & (c < F.lit(end + timedelta(days=1)))


def not_cancelled(c: Column) -> Column:
    return F.coalesce(c, F.lit("N")) == "N"


# ------------------------------------------------------------------ source L

# The payload fields of source L.
PAYLOAD_L = {
    "DT_HR_VOUCHER": "T.DTVENDA",
    "DATA_ACESSO": "B.DATA",
    "NRVOUCHER": "T.NRVOUCHER",
    "QRCODE": "VP.QRCODE",
    "DTBAIXA": "VP.DTBAIXA",
    "DATA_VENDA_BILHETERIA": "B.DATA",
    "HORA_VENDA_BILHETERIA": "B.HORA",
    "PONTO_VENDA": "B.PONTO_VENDA",
    "CODIGO_GRUPO": "GB.CODIGO",
    "NOME_GRUPO": "GB.NOME",
    "TIPO_BILHETE": "CB.TIPO_BILHETE",
    "CODIGO_BILHETE": "CB.CODIGO",
    "BILHETE": "CB.NOME",
    "CATEGORIA": "CC.NOME",
    "TIPO": "GB.NOME",
    "QTDE": "I.QUANTIDADE",
    "VLR_UNITARIO": "I.VLR_UNITARIO",
}


def extract_l(
    t: Mapping[str, DataFrame], start: date, end: date, company: int = 1
) -> DataFrame:
    """Ticket items with a used card, in a day range, with their lookups.

    ``t`` holds the source tables by lower-case name: ticket, item, card,
    voucher_product, voucher, ticket_type, category, group.
    """
    tickets = t["ticket"].where(
        (F.col("EMPRESA") == company)
        & between_days(F.col("DATA"), start, end)
        & not_cancelled(F.col("CANCELADO"))
    )
    star = star_join(tickets, "B", [
        Dim(t["item"], "I", [("B.EMPRESA", "EMPRESA"), ("B.CODIGO", "CODIGO")]),
        Dim(
            t["card"], "IC",
            [("I.EMPRESA", "EMPRESA"), ("I.CODIGO", "CODIGO"), ("I.SEQUENCIA", "SEQUENCIA")],
            where=F.col("STATUS") == 1,
        ),
        Dim(
            t["voucher_product"], "VP",
            [("I.EMPRESA", "EMPRESA"), ("I.VOUCHER", "IDVENDA"), ("I.VOUCHER_SEQ", "SEQUENCIA")],
            "left",
        ),
        Dim(t["voucher"], "T", [("VP.EMPRESA", "EMPRESA"), ("VP.IDVENDA", "IDVENDA")], "left"),
        Dim(t["ticket_type"], "CB", [("I.EMPRESA", "EMPRESA"), ("I.BILHETE", "CODIGO")], "left"),
        Dim(t["category"], "CC", [("I.EMPRESA", "EMPRESA"), ("I.CATEGORIA", "CODIGO")], "left"),
        Dim(t["group"], "GB", [("CB.EMPRESA", "EMPRESA"), ("CB.GRUPO", "CODIGO")], "left"),
    ])
    return star.select(*[
        (F.col(c).cast("string") if name == "NRVOUCHER" else F.col(c)).alias(name)
        for name, c in PAYLOAD_L.items()
    ])


def bronze_l(extract: DataFrame, run_ts: datetime) -> tuple[DataFrame, DataFrame]:
    """Payload rows ``(nrvoucher, payload, extracted_at)``, and rows without a voucher."""
    keyed, no_key = drop_blank_keys(extract, ["NRVOUCHER"])
    return keyed.select(
        F.trim("NRVOUCHER").alias("nrvoucher"),
        payload_of(extract).alias("payload"),
        F.lit(run_ts).alias("extracted_at"),
    ), no_key


def silver_l(bronze: DataFrame) -> DataFrame:
    p = bronze.withColumn("_p", payload_fields(F.col("payload"), list(PAYLOAD_L)))

    def raw(name: str) -> Column:
        return F.col(f"_p.`{name}`")

    def filled(name: str, kind: str) -> Column:
        return field_or_null("_p", name).cast(kind)

    sold, used = filled("DT_HR_VOUCHER", "timestamp_ntz"), filled("DTBAIXA", "timestamp_ntz")
    return p.select(
        F.col("nrvoucher").alias("id_acesso"),
        filled("DATA_ACESSO", "date").alias("dt_acesso_sys"),
        sold.alias("dt_hr_voucher"),
        sold.cast("date").alias("dt_voucher"),
        time_of(sold).alias("hr_voucher"),
        raw("QRCODE").alias("num_ingresso"),
        used.alias("dt_hr_baixa"),
        used.cast("date").alias("dt_entrada"),
        time_of(used).alias("hr_entrada"),
        raw("PONTO_VENDA").alias("terminal_entrada"),
        raw("CODIGO_GRUPO").alias("cod_grupo"),
        raw("NOME_GRUPO").alias("nome_grupo"),
        raw("TIPO_BILHETE").alias("tipo_bilhete"),
        raw("CODIGO_BILHETE").alias("cod_bilhete"),
        raw("BILHETE").alias("tipo_ingresso"),
        raw("CATEGORIA").alias("categoria"),
        raw("TIPO").alias("tipo"),
        filled("QTDE", "decimal(38,6)").alias("qtd"),
        filled("VLR_UNITARIO", "decimal(38,6)").alias("vlr_unit"),
        F.col("nrvoucher").alias("src_nrvoucher"),
        F.col("extracted_at").alias("bronze_extracted_at"),
        "payload",
    )


# ------------------------------------------------------------------ source Q

# The payload fields of source Q.
PAYLOAD_Q = [
    "idAcesso", "idEmpresaRelacionamento", "data_hora_entrada", "data_hora_saida",
    "socio_ou_ingresso", "email", "telefone", "celular", "categoria_tipo_ingresso",
    "numero_ingresso", "terminal_entrada", "terminal_saida", "tipo_acesso",
]

# The codes of the kinds of contact.
CONTACT_KINDS = {"email": "E", "celular": "C", "telefone": "F"}


def contacts(contact: DataFrame, kind: DataFrame, address: DataFrame) -> DataFrame:
    """Joined e-mails, mobiles and phones per person, from one grouped pass."""
    rows = (
        contact.join(kind.where(F.col("tipo").isin(*CONTACT_KINDS.values())), "idTipoAcessoContato")
        .join(address, "idPessoaEnderecoContato")
        .select("idPessoa", "tipo", "informacao")
    )
    return text_lists(rows, ["idPessoa"], "tipo", "informacao", CONTACT_KINDS)


def extract_q(
    t: Mapping[str, DataFrame],
    start: date,
    end: date,
    terminals: Sequence[int],
    min_id: int | None = None,
) -> DataFrame:
    """Accesses in a day range at the given entry or exit terminals, with their people.

    ``t`` holds the source tables: access, relation, relation_type, member_title, title,
    title_category, person, contact, contact_kind, contact_address, terminal, ticket,
    ticket_kind, owner_relation.
    """
    at_gate = F.col("idTerminalEntrada").isin(*terminals) | F.col("idTerminalSaida").isin(*terminals)
    access = t["access"].where(between_days(F.col("dataEntrada"), start, end) & at_gate)
    # the exit counts by its terminal row, below; the filter here only spares rows early
    at_known_gate = F.col("a.idTerminalEntrada").isin(*terminals) | F.coalesce(
        F.col("t_out.idTerminal").isin(*terminals), F.lit(False)
    )
    if min_id is not None:
        access = access.where(F.col("idAcesso") > min_id)

    relation = star_join(t["relation"], "erv", [
        Dim(
            t["relation_type"], "tre",
            [("erv.idTipoRelacionamentoEmpresa", "idTipoRelacionamentoEmpresa")],
        ),
        Dim(
            t["member_title"], "ts0",
            [("erv.idEmpresaRelacionamento", "idEmpresaRelacionamentoTitular")], "left",
        ),
        Dim(t["title"], "tit", [("ts0.idTitulo", "idTitulo")], "left"),
        Dim(
            t["title_category"], "ct0", [("ts0.idCategoriaTitulo", "idCategoriaTitulo")], "left",
        ),
        Dim(
            contacts(t["contact"], t["contact_kind"], t["contact_address"]), "con",
            [("erv.idPessoaRelacionamento", "idPessoa")], "left",
        ),
    ]).select(
        "erv.idEmpresaRelacionamento", "erv.idPessoaRelacionamento",
        "con.email", "con.telefone", "con.celular",
    )
    star = star_join(access, "a", [
        Dim(relation, "er", [("a.idEmpresaRelacionamento", "idEmpresaRelacionamento")]),
        Dim(t["person"], "pessoa", [("er.idPessoaRelacionamento", "idPessoa")]),
        Dim(t["terminal"], "t_in", [("a.idTerminalEntrada", "idTerminal")]),
        Dim(t["terminal"], "t_out", [("a.idTerminalSaida", "idTerminal")], "left"),
        Dim(
            t["member_title"], "ts",
            [("er.idEmpresaRelacionamento", "idEmpresaRelacionamentoTitular")], "left",
        ),
        Dim(t["title_category"], "ct", [("ts.idCategoriaTitulo", "idCategoriaTitulo")], "left"),
        Dim(t["ticket"], "ingresso", [("a.idIngresso", "idIngresso")], "left"),
        Dim(t["ticket_kind"], "tp", [("ingresso.idTipoIngresso", "idTipoIngresso")], "left"),
        Dim(
            t["owner_relation"], "dono",
            [("ingresso.idEmpresaRelacionamentoCliente", "idEmpresaRelacionamento")], "left",
        ),
        Dim(t["person"], "titular", [("dono.idPessoaRelacionamento", "idPessoa")], "left"),
    ])
    star = star.where(at_known_gate)
    has_ticket = F.coalesce(F.col("ingresso.idIngresso") > 0, F.lit(False))

    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    member_label = F.concat(text("ct.numero"), F.lit(" - "), text("ct.descricao"))
    ticket_label = F.concat(F.lit("Ingresso - "), text("tp.descricao"))
    return star.select(
        "a.idAcesso",
        "a.idEmpresaRelacionamento",
        F.col("a.dataEntrada").alias("data_hora_entrada"),
        F.col("a.dataSaida").alias("data_hora_saida"),
        F.when(has_ticket, F.trim("titular.nomeRazaoSocial"))
        .otherwise(F.trim("pessoa.nomeRazaoSocial")).alias("socio_ou_ingresso"),
        "er.email",
        "er.telefone",
        "er.celular",
        F.when(has_ticket, ticket_label).otherwise(member_label).alias("categoria_tipo_ingresso"),
        F.col("ingresso.numero").alias("numero_ingresso"),
        F.col("t_in.descricao").alias("terminal_entrada"),
        F.col("t_out.descricao").alias("terminal_saida"),
        F.when(has_ticket, F.lit("Ingresso")).otherwise(F.lit("Sócio")).alias("tipo_acesso"),
    )


def bronze_q(extract: DataFrame, run_ts: datetime) -> tuple[DataFrame, DataFrame]:
    """Payload rows ``(idacesso, extracted_at, payload)``, and rows without an id."""
    keyed, no_key = drop_blank_keys(extract, ["idAcesso"])
    return keyed.select(
        F.col("idAcesso").cast("string").alias("idacesso"),
        F.lit(run_ts).alias("extracted_at"),
        payload_of(extract).alias("payload"),
    ), no_key


def silver_q(bronze: DataFrame, source_table: str) -> DataFrame:
    p = bronze.withColumn("_p", payload_fields(F.col("payload"), PAYLOAD_Q))

    def filled(name: str) -> Column:
        return field_or_null("_p", name)

    came = filled("data_hora_entrada").cast("timestamp_ntz")
    left = filled("data_hora_saida").cast("timestamp_ntz")
    label = F.col("_p.categoria_tipo_ingresso")
    return p.select(
        F.col("idacesso").cast("bigint").alias("id_acesso"),
        came.alias("dt_hr_entrada"),
        came.cast("date").alias("dt_entrada"),
        time_of(came).alias("hr_entrada"),
        left.alias("dt_hr_saida"),
        left.cast("date").alias("dt_saida"),
        time_of(left).alias("hr_saida"),
        filled("terminal_entrada").alias("terminal_entrada"),
        filled("terminal_saida").alias("terminal_saida"),
        filled("tipo_acesso").alias("tipo_acesso"),
        filled("socio_ou_ingresso").alias("cliente"),
        filled("categoria_tipo_ingresso").alias("id_desc_tipo_ingresso"),
        code_of(label).alias("id_tipo_ingresso"),
        label_of(label, OTHERS).alias("tipo_ingresso"),
        filled("numero_ingresso").alias("num_ingresso"),
        filled("idEmpresaRelacionamento").cast("bigint").alias("id_emp_relac"),
        filled("email").alias("email"),
        filled("telefone").alias("telefone"),
        filled("celular").alias("celular"),
        F.lit(source_table).alias("source_table"),
        F.col("extracted_at").alias("bronze_extracted_at"),
        "payload",
    )


# ------------------------------------------------------- context and gold facts


def access_fact(
    silver: DataFrame,
    lookup: DataFrame,
    active: str,
    source_file: str,
    run_ts: datetime,
    drop_unlabelled: bool = False,
) -> DataFrame:
    """Accesses with their kind of public; those of the others category left out.

    ``drop_unlabelled`` also leaves out rows whose own label is the others category or
    missing, which is the rule of source Q.
    """
    rows = exclude_category(silver, "tipo_ingresso", OTHERS) if drop_unlabelled else silver
    known = exclude_category(
        lookup_default(rows, lookup, "tipo_ingresso", "tipo_publico", CHECK, active),
        "tipo_publico", OTHERS,
    )
    return align_to_schema(
        known.withColumn("source_file", F.lit(source_file)).withColumn(
            "ingested_at", F.coalesce("bronze_extracted_at", F.lit(run_ts))
        ),
        schemas.ACCESS_FACT,
    )


def gold_access(facts: Mapping[str, DataFrame], gold: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of all facts that the gold fact does not have yet.

    ``keys=["origem", "id_acesso"]`` keeps equal ids of two origins apart; with
    ``["id_acesso"]`` an id known from either origin counts as present.
    """
    return not_in(union_origin(facts), gold, keys)


GOLD_KEYS = ("origem", "id_acesso")


def access_tables(root: str) -> dict[str, str]:
    """Where each layer of both sources is below ``root``."""
    layers = {"bronze": "bronze", "silver": "silver_trans", "context": "silver_ctx"}
    out = {f"{layer}_{x}": f"{root}/{folder}/access_{x.lower()}" for layer, folder in layers.items() for x in "LQ"}
    return out | {"gold": f"{root}/gold/access"}


def access_ledger(spark, root: str) -> Ledger:
    return Ledger(spark, f"{root}/control/ledger", access_tables(root))


def read_gold(spark, root: str) -> DataFrame:
    """The gold fact: the folders that the ledger counts."""
    folders = access_ledger(spark, root).folders("gold")
    return read_folders(spark, access_tables(root)["gold"], schemas.GOLD_ACCESS, folders)


def load_access(
    spark, root: str, batch: str, run_ts: datetime, lookups: Mapping[str, DataFrame],
    extracts: Mapping[str, DataFrame], gold_keys: Sequence[str] = GOLD_KEYS,
) -> dict[str, int]:
    """Run both sources through all layers below ``root``; returns new rows per table.

    ``extracts`` holds the rows of ``extract_l`` as ``L`` and of ``extract_q`` as ``Q``.
    Every step asks the ledger which folders below it its layer lacks and reads those: the new
    batch, and what a failed run or a deleted folder has left open.  Bronze and gold are
    inserts into buckets of keys, so that a batch meets the keys of its buckets only.  A run
    over the same input adds nothing.  An extract is computed once, and the largest id of Q
    is stored as its watermark, from which ``next_min_id`` lets the next extract go on.  The
    counts of ``audit_q`` are of the rows that this run has brought to silver.
    """
    added: dict[str, int] = {}
    paths, ledger = access_tables(root), access_ledger(spark, root)
    extracts = {name: written(rows, f"extract-{name}") for name, rows in extracts.items()}
    keyed_l, no_voucher = bronze_l(extracts["L"], run_ts)
    keyed_q, _ = bronze_q(extracts["Q"], run_ts)
    for name, rows, key in (("bronze_L", keyed_l, "nrvoucher"), ("bronze_Q", keyed_q, "idacesso")):
        todo = ledger.todo(name, batch)
        added[name] = insert_bucketed(rows, paths[name], [key], [F.col("payload").asc()], batch)
        ledger.record(todo, added[name], run_ts)
    added["without_voucher"] = append_batch(no_voucher, f"{root}/bronze/access_l_rejects", batch)

    def step(layer: str, source: str, schema, make) -> DataFrame:
        """The rows of this run's folder of ``layer``, made from what it lacks of ``source``."""
        todo = ledger.todo(layer, batch, [source])
        rows = make(read_folders(spark, paths[source], schema, todo.folders(source)))
        added[layer] = append_batch(rows, paths[layer], batch)
        ledger.record(todo, added[layer], run_ts)
        return read_folders(spark, paths[layer], rows.schema, [batch])

    made: dict[str, tuple[DataFrame, DataFrame]] = {}
    for name, schema in (("L", keyed_l.schema), ("Q", keyed_q.schema)):
        typed = silver_l if name == "L" else partial(silver_q, source_table="bronze.access_q")
        silver = step(f"silver_{name}", f"bronze_{name}", schema, typed)
        fact = partial(
            access_fact, lookup=lookups[name], active="active", source_file=f"source:{name}", run_ts=run_ts,
            drop_unlabelled=name == "Q",
        )
        made[name] = silver, step(f"context_{name}", f"silver_{name}", silver.schema, fact)

    todo = ledger.todo("gold", batch, ["context_L", "context_Q"])
    facts = {
        name: read_folders(spark, paths[f"context_{name}"], fact.schema, todo.folders(f"context_{name}"))
        for name, (_, fact) in made.items()
    }
    counts = [r.folder for r in todo.kept.select("folder").distinct().collect()]
    added["gold"] = insert_bucketed(union_origin(facts), paths["gold"], list(gold_keys), None, batch, batches=counts)
    ledger.record(todo, added["gold"], run_ts)

    for row in audit_q(*made["Q"]).collect():  # two counts
        added[f"audit_{row['check']}"] = row["rows"]
    path = f"{root}/watermarks"
    newest_id = watermark_row(extracts["Q"], *WATERMARK, F.col("idAcesso"), run_ts)
    have = read_current(spark, path, schemas.WATERMARKS)
    kept = newest_id.join(have.select(F.col("watermark_value").alias("_had"), *WATERMARK_KEYS), WATERMARK_KEYS, "left")
    grown = kept.where(F.col("_had").isNull() | (F.col("watermark_value").cast("long") > F.col("_had").cast("long")))
    write_version(set_watermark(have, grown.select(*schemas.WATERMARKS.names)), path)
    return added


#: Source system, entity and key under which the newest access of Q is stored.
WATERMARK = ("Q", "access", "idAcesso")


def next_min_id(spark, root: str) -> int:
    """The id above which the next extract of Q begins, 0 before the first load."""
    have = read_current(spark, f"{root}/watermarks", schemas.WATERMARKS)
    return int(get_watermark(have, *WATERMARK).first()["watermark_value"])


def audit_q(silver: DataFrame, fact: DataFrame) -> DataFrame:
    """``(check, rows)``: accesses of the others category, and those the fact lacks."""
    ids = silver.select(F.col("id_acesso").cast("string").alias("id_acesso"))
    outside = not_in(ids, fact, ["id_acesso"])
    return audit_counts(silver, {"outros": F.col("tipo_ingresso") == OTHERS}).unionByName(
        audit_counts(outside, {"fora_do_contexto": F.lit(True)})
    )
