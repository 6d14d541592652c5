"""Gate access: both sources through all layers, on tables made from the order tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from estrato.functions.payload import field_or_null, payload_fields
from estrato.operators.incremental import insert_new
from estrato.plans import access
from estrato.plans.registered.common import (
    RUN_MICROS, RUN_TS, cents_sql, money, money_sql, pick, pick_sql, plain, table,
)
from estrato.plans.registered.relational import CONTACT_ROWS, contact_rows
from estrato.session import work_dir, written

# ------------------------------------------------------------ flagship: gold fact

_LOOKUP_L = "('click', 'Adulto', true), ('view', 'OUTROS', true), ('error', 'Infantil', false)"
_LOOKUP_Q = "('signup', 'Sócio', true)"


def _lookup(spark, values: str):
    return spark.sql(f"select * from values {values} as t(tipo_ingresso, tipo_publico, active)")


def _event_silver(events, kinds: list[str]):
    p = events.where(F.col("event_type").isin(kinds)).withColumn(
        "_p", payload_fields(F.col("props"), ["k"])
    )
    return p.select(
        F.col("event_id").alias("id_acesso"),
        field_or_null("_p", "k").alias("num_ingresso"),
        F.col("event_type").alias("tipo_ingresso"),
        F.lit("T1").alias("terminal_entrada"),
        F.col("ts").cast("date").alias("dt_entrada"),
        F.substring(F.col("ts").cast("string"), 12, 8).alias("hr_entrada"),
        F.lit(None).cast("timestamp").alias("bronze_extracted_at"),
    )


def gold_fact(spark, sf):
    """Events as accesses of two sources, joined with their lookups and added to gold."""
    events = table(spark, sf, "events")
    facts = {
        "L": access.access_fact(
            _event_silver(events, ["click", "view", "error"]), _lookup(spark, _LOOKUP_L), "active",
            "source:L", RUN_TS,
        ),
        "Q": access.access_fact(
            _event_silver(events, ["signup", "purchase"]), _lookup(spark, _LOOKUP_Q), "active",
            "source:Q", RUN_TS, drop_unlabelled=True,
        ),
    }
    loaded = events.where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz")).select(
        F.when(F.col("event_type").isin("click", "view", "error"), "L").otherwise("Q").alias("origem"),
        F.col("event_id").cast("string").alias("id_acesso"),
    )
    return plain(access.gold_access(facts, loaded, access.GOLD_KEYS))


GOLD_FACT = f"""
with d(kind, pub, active) as (values {_LOOKUP_L}, {_LOOKUP_Q}),
e as (select *, case when event_type in ('click', 'view', 'error') then 'L' else 'Q' end as origem
  from events)
select origem, cast(event_id as varchar) as id_acesso, nullif(props->>'$.k', '') as num_ingresso,
  event_type as tipo_ingresso, 'T1' as terminal_entrada, strftime(ts, '%Y-%m-%d') as dt_entrada,
  strftime(ts, '%H:%M:%S') as hr_entrada, coalesce(pub, 'CHECK') as tipo_publico,
  concat('source:', origem) as source_file, {RUN_MICROS} as ingested_at
from e left join d on kind = event_type and active
where coalesce(pub, 'CHECK') <> 'OUTROS' and ts >= timestamp '2024-01-08'"""


# -------------------------------------------------------------------- source L


def tables_l(spark, sf):
    """Tickets from orders, items from order lines, lookups from parts and suppliers.

    Order lines are reduced to one per order and line number, as ticket items are.
    """
    one = F.lit(1)
    orders = table(spark, sf, "orders")
    items = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_partkey").alias("part"), F.max("l_suppkey").alias("supp"),
        F.max("l_quantity").cast("int").alias("qty"), F.max("l_extendedprice").alias("price"),
        F.max("l_linestatus").alias("status"), F.max("l_shipdate").alias("shipped"),
    )
    key = [one.alias("EMPRESA"), F.col("l_orderkey").alias("CODIGO"), F.col("l_linenumber").alias("SEQUENCIA")]
    part = table(spark, sf, "part")
    return {
        "ticket": orders.select(
            one.alias("EMPRESA"), F.col("o_orderkey").alias("CODIGO"),
            F.col("o_orderdate").cast("date").alias("DATA"), F.lit("10:30").alias("HORA"),
            F.col("o_orderpriority").alias("PONTO_VENDA"),
            pick(F.col("o_custkey"), F.lit("N"), F.lit(None), F.lit("S")).alias("CANCELADO"),
        ),
        "item": items.select(
            *key, F.when(F.col("status") == "O", F.col("l_orderkey")).alias("VOUCHER"),
            F.col("l_linenumber").alias("VOUCHER_SEQ"), F.col("part").alias("BILHETE"),
            F.col("supp").alias("CATEGORIA"), F.col("qty").alias("QUANTIDADE"),
            money("price").alias("VLR_UNITARIO"),
        ),
        "card": items.select(*key, (F.col("qty") > 10).cast("int").alias("STATUS")),
        "voucher_product": items.select(
            one.alias("EMPRESA"), F.col("l_orderkey").alias("IDVENDA"),
            F.col("l_linenumber").alias("SEQUENCIA"),
            F.concat_ws("-", F.lit("QR"), "l_orderkey", "l_linenumber").alias("QRCODE"),
            F.when(F.col("qty") > 20, F.col("shipped")).alias("DTBAIXA"),
        ),
        "voucher": orders.select(
            one.alias("EMPRESA"), F.col("o_orderkey").alias("IDVENDA"),
            F.col("o_orderdate").alias("DTVENDA"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("NRVOUCHER"),
        ),
        "ticket_type": part.select(
            one.alias("EMPRESA"), F.col("p_partkey").alias("CODIGO"), F.col("p_name").alias("NOME"),
            F.col("p_type").alias("TIPO_BILHETE"), F.col("p_size").alias("GRUPO"),
        ),
        "category": table(spark, sf, "supplier").select(
            one.alias("EMPRESA"), F.col("s_suppkey").alias("CODIGO"), F.col("s_name").alias("NOME")
        ),
        "group": table(spark, sf, "nation").select(
            one.alias("EMPRESA"), F.col("n_nationkey").alias("CODIGO"), F.col("n_name").alias("NOME")
        ),
    }


_DAYS = (date(1996, 1, 1), date(2000, 12, 31))


def extract_l(spark, sf):
    return plain(access.extract_l(tables_l(spark, sf), *_DAYS))


_ITEMS = """
items as (select l_orderkey, l_linenumber, max(l_partkey) as part, max(l_suppkey) as supp,
    cast(max(l_quantity) as int) as qty, max(l_extendedprice) as price, max(l_linestatus) as status,
    max(l_shipdate) as shipped from lineitem group by 1, 2)"""
_FROM_L = f"""
from orders b join items i on i.l_orderkey = b.o_orderkey and qty > 10
left join items vp on vp.l_orderkey = case when i.status = 'O' then i.l_orderkey end
  and vp.l_linenumber = i.l_linenumber
left join orders t on t.o_orderkey = vp.l_orderkey
left join part on p_partkey = i.part left join supplier on s_suppkey = i.supp
left join nation on n_nationkey = p_size
where cast(b.o_orderdate as date) between date '1996-01-01' and date '2000-12-31'
  and {pick_sql('b.o_custkey', "'N'", "'N'", "'S'")} = 'N'"""
_VOUCHER = "case when t.o_orderstatus <> 'P' then cast(t.o_orderkey as varchar) end"
_QR = "case when vp.l_orderkey is not null then concat('QR-', vp.l_orderkey, '-', vp.l_linenumber) end"
_USED = "case when vp.qty > 20 then vp.shipped end"
EXTRACT_L = f"""
with {_ITEMS}
select cast(t.o_orderdate as varchar) as DT_HR_VOUCHER, strftime(b.o_orderdate, '%Y-%m-%d') as DATA_ACESSO,
  {_VOUCHER} as NRVOUCHER, {_QR} as QRCODE, cast({_USED} as varchar) as DTBAIXA,
  strftime(b.o_orderdate, '%Y-%m-%d') as DATA_VENDA_BILHETERIA, '10:30' as HORA_VENDA_BILHETERIA,
  b.o_orderpriority as PONTO_VENDA, n_nationkey as CODIGO_GRUPO, n_name as NOME_GRUPO,
  p_type as TIPO_BILHETE, p_partkey as CODIGO_BILHETE, p_name as BILHETE, s_name as CATEGORIA,
  n_name as TIPO, i.qty as QTDE, {money_sql(cents_sql('i.price'))} as VLR_UNITARIO
{_FROM_L}"""


def silver_l(spark, sf):
    """Bronze payloads, first per voucher, read back as typed columns."""
    rows, _ = access.bronze_l(access.extract_l(tables_l(spark, sf), *_DAYS), RUN_TS)
    none = spark.createDataFrame([], rows.schema)
    first = insert_new(none, rows, ["nrvoucher"], [F.get_json_object("payload", "$.QRCODE").asc()])
    return plain(access.silver_l(first).drop("payload"))


SILVER_L = f"""
with {_ITEMS},
x as (select t.o_orderdate as sold, {_USED} as used, b.o_orderdate as day, {_VOUCHER} as nr,
    {_QR} as qr, b.o_orderpriority as place, n_nationkey, n_name, p_type, p_partkey, p_name, s_name,
    i.qty as qty, {money_sql(cents_sql('i.price'))} as price {_FROM_L}),
f as (select *, row_number() over (partition by nr order by qr) as n from x where nr is not null)
select nr as id_acesso, strftime(day, '%Y-%m-%d') as dt_acesso_sys,
  cast(sold as varchar) as dt_hr_voucher, strftime(sold, '%Y-%m-%d') as dt_voucher,
  strftime(sold, '%H:%M:%S') as hr_voucher, qr as num_ingresso, cast(used as varchar) as dt_hr_baixa,
  strftime(used, '%Y-%m-%d') as dt_entrada, strftime(used, '%H:%M:%S') as hr_entrada,
  place as terminal_entrada, cast(n_nationkey as varchar) as cod_grupo, n_name as nome_grupo,
  p_type as tipo_bilhete, cast(p_partkey as varchar) as cod_bilhete, p_name as tipo_ingresso,
  s_name as categoria, n_name as tipo, concat(qty, '.000000') as qtd, concat(price, '0000') as vlr_unit,
  nr as src_nrvoucher, {RUN_MICROS} as bronze_extracted_at
from f where n = 1"""


# -------------------------------------------------------------------- source Q


def tables_q(spark, sf):
    """Accesses from events, people from customers, tickets from parts."""
    events, customer = table(spark, sf, "events"), table(spark, sf, "customer")
    person = customer.select(
        F.col("c_custkey").alias("idPessoa"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit("  ")).alias("nomeRazaoSocial"),
    )
    contacts = contact_rows(spark, sf)
    part = table(spark, sf, "part")
    return {
        "access": events.select(
            F.col("event_id").alias("idAcesso"), F.col("user_id").alias("idEmpresaRelacionamento"),
            F.col("ts").alias("dataEntrada"),
            F.when(F.col("event_type") != "error", F.col("ts") + F.expr("interval 2 hours")).alias("dataSaida"),
            (F.col("user_id") % 25).cast("int").alias("idTerminalEntrada"),
            (F.col("event_id") % 30).cast("int").alias("idTerminalSaida"),
            F.when(F.col("event_type") == "purchase", F.col("event_id") % 200).alias("idIngresso"),
        ),
        "relation": customer.select(
            F.col("c_custkey").alias("idEmpresaRelacionamento"),
            F.col("c_custkey").alias("idPessoaRelacionamento"),
            F.col("c_nationkey").alias("idTipoRelacionamentoEmpresa"),
        ),
        "relation_type": table(spark, sf, "nation").select(
            F.col("n_nationkey").alias("idTipoRelacionamentoEmpresa")
        ),
        "member_title": customer.where(F.col("c_acctbal") > 3000).select(
            F.col("c_custkey").alias("idEmpresaRelacionamentoTitular"),
            F.col("c_custkey").alias("idTitulo"), F.col("c_nationkey").alias("idCategoriaTitulo"),
        ),
        "title": customer.select(F.col("c_custkey").alias("idTitulo")),
        "title_category": table(spark, sf, "nation").select(
            F.col("n_nationkey").alias("idCategoriaTitulo"), F.col("n_nationkey").alias("numero"),
            F.col("n_name").alias("descricao"),
        ),
        "person": person,
        "contact": contacts.select(
            F.col("c_custkey").alias("idPessoaEnderecoContato"),
            F.col("tipo").alias("idTipoAcessoContato"), "informacao",
        ),
        "contact_kind": spark.sql(
            "select * from values ('E', 'E'), ('C', 'C'), ('F', 'F'), ('X', 'X') as t(idTipoAcessoContato, tipo)"
        ),
        "contact_address": customer.select(
            F.col("c_custkey").alias("idPessoaEnderecoContato"), F.col("c_custkey").alias("idPessoa")
        ),
        "terminal": table(spark, sf, "nation").select(
            F.col("n_nationkey").alias("idTerminal"), F.col("n_name").alias("descricao")
        ),
        "ticket": part.select(
            F.col("p_partkey").alias("idIngresso"), F.col("p_brand").alias("numero"),
            F.col("p_size").alias("idTipoIngresso"), (F.col("p_partkey") + 3).alias("idEmpresaRelacionamentoCliente"),
        ),
        "ticket_kind": table(spark, sf, "nation").select(
            F.col("n_nationkey").alias("idTipoIngresso"), F.col("n_name").alias("descricao")
        ),
        "owner_relation": customer.select(
            F.col("c_custkey").alias("idEmpresaRelacionamento"),
            F.col("c_custkey").alias("idPessoaRelacionamento"),
        ),
    }


_Q_DAYS = (date(2024, 1, 3), date(2024, 1, 28))
_GATES = [1, 2, 3, 5, 8, 13, 21]


def extract_q(spark, sf):
    return plain(access.extract_q(tables_q(spark, sf), *_Q_DAYS, _GATES, min_id=50))


_FROM_Q = f"""
con as (select c_custkey as person,
    string_agg(informacao, ' / ' order by informacao) filter (where tipo = 'E') as email,
    string_agg(informacao, ' / ' order by informacao) filter (where tipo = 'F') as telefone,
    string_agg(informacao, ' / ' order by informacao) filter (where tipo = 'C') as celular
  from ({CONTACT_ROWS}) group by 1),
x as (select event_id as "idAcesso", user_id as "idEmpresaRelacionamento", ts as came,
    case when event_type <> 'error' then ts + interval 2 hour end as gone,
    case when tk.p_partkey > 0 then trim(owner.c_name) else trim(c.c_name) end as socio_ou_ingresso,
    email, telefone, celular,
    case when tk.p_partkey > 0 then concat('Ingresso - ', coalesce(tp.n_name, ''))
         else concat(coalesce(cast(cat.n_nationkey as varchar), ''), ' - ', coalesce(cat.n_name, ''))
    end as categoria_tipo_ingresso,
    tk.p_brand as numero_ingresso, tin.n_name as terminal_entrada, tout.n_name as terminal_saida,
    case when tk.p_partkey > 0 then 'Ingresso' else 'Sócio' end as tipo_acesso
  from events join customer c on c.c_custkey = user_id
  left join con on person = c.c_custkey
  join nation tin on tin.n_nationkey = user_id % 25
  left join nation tout on tout.n_nationkey = event_id % 30
  left join nation cat on cat.n_nationkey = case when c.c_acctbal > 3000 then c.c_nationkey end
  left join part tk on tk.p_partkey = case when event_type = 'purchase' then event_id % 200 end
  left join nation tp on tp.n_nationkey = tk.p_size
  left join customer owner on owner.c_custkey = tk.p_partkey + 3
  where cast(ts as date) between date '2024-01-03' and date '2024-01-28' and event_id > 50
    and (user_id % 25 in (1, 2, 3, 5, 8, 13, 21) or event_id % 30 in (1, 2, 3, 5, 8, 13, 21)))"""
EXTRACT_Q = f"""
with {_FROM_Q}
select "idAcesso", "idEmpresaRelacionamento", cast(came as varchar) as data_hora_entrada,
  cast(gone as varchar) as data_hora_saida, socio_ou_ingresso, email, telefone, celular,
  categoria_tipo_ingresso, numero_ingresso, terminal_entrada, terminal_saida, tipo_acesso from x"""


def silver_q(spark, sf):
    rows, _ = access.bronze_q(
        access.extract_q(tables_q(spark, sf), *_Q_DAYS, _GATES, min_id=50), RUN_TS
    )
    return plain(access.silver_q(rows, "bronze.access_q").drop("payload"))


_CODE = "split_part(categoria_tipo_ingresso, ' - ', 1)"
_LABEL = f"""case when regexp_full_match({_CODE}, '[0-9]+')
    then nullif(split_part(categoria_tipo_ingresso, ' - ', 2), '') else 'OUTROS' end"""
SILVER_Q = f"""
with {_FROM_Q}
select "idAcesso" as id_acesso, cast(came as varchar) as dt_hr_entrada,
  strftime(came, '%Y-%m-%d') as dt_entrada, strftime(came, '%H:%M:%S') as hr_entrada,
  cast(gone as varchar) as dt_hr_saida, strftime(gone, '%Y-%m-%d') as dt_saida,
  strftime(gone, '%H:%M:%S') as hr_saida, terminal_entrada, terminal_saida, tipo_acesso,
  socio_ou_ingresso as cliente, categoria_tipo_ingresso as id_desc_tipo_ingresso,
  case when regexp_full_match({_CODE}, '[0-9]+') then cast({_CODE} as bigint) end as id_tipo_ingresso,
  {_LABEL} as tipo_ingresso, numero_ingresso as num_ingresso,
  "idEmpresaRelacionamento" as id_emp_relac, nullif(email, '') as email, telefone, celular,
  'bronze.access_q' as source_table, {RUN_MICROS} as bronze_extracted_at
from x"""


# ------------------------------------------------------------ all layers, written


def layers(spark, sf):
    """Both sources loaded twice through all layers; the second load adds nothing."""
    lookups = {
        "L": spark.sql("select * from values ('blue widget', 'Adulto', true), "
                       "('red widget', 'OUTROS', true) as t(tipo_ingresso, tipo_publico, active)"),
        "Q": spark.sql("select * from values ('NATION_3', 'Sócio', true), ('NATION_4', 'OUTROS', true), "
                       "('NATION_5', 'x', false) as t(tipo_ingresso, tipo_publico, active)"),
    }
    root = work_dir(spark, "access")
    extracts = {
        "L": access.extract_l(tables_l(spark, sf), *_DAYS),
        "Q": access.extract_q(tables_q(spark, sf), *_Q_DAYS, _GATES, min_id=50),
    }
    # both loads take the same rows: the joins of the sources run once
    extracts = {name: written(rows, f"source-{name}") for name, rows in extracts.items()}
    for batch in ("1", "2"):
        access.load_access(spark, root, batch, RUN_TS, lookups, extracts)
    return plain(access.read_gold(spark, root))


# Of the items of a voucher the payload that sorts first is kept.  Payloads of one voucher
# share the sale time, the day and the voucher number, and then differ by the item code.
LAYERS = f"""
with {_ITEMS},
lx as (select t.o_orderdate as sold, {_USED} as used, {_VOUCHER} as nr, {_QR} as qr,
    b.o_orderpriority as place, p_name {_FROM_L}),
l as (select *, row_number() over (partition by nr order by qr) as n from lx where nr is not null),
{_FROM_Q},
q as (select *, {_LABEL} as label from x)
select 'L' as origem, nr as id_acesso, qr as num_ingresso, p_name as tipo_ingresso,
  place as terminal_entrada, strftime(used, '%Y-%m-%d') as dt_entrada,
  strftime(used, '%H:%M:%S') as hr_entrada,
  case when p_name = 'blue widget' then 'Adulto' else 'CHECK' end as tipo_publico,
  'source:L' as source_file, {RUN_MICROS} as ingested_at
from l where n = 1 and coalesce(p_name, '') <> 'red widget'
union all
select 'Q', cast("idAcesso" as varchar), numero_ingresso, label, terminal_entrada,
  strftime(came, '%Y-%m-%d'), strftime(came, '%H:%M:%S'),
  case when label = 'NATION_3' then 'Sócio' else 'CHECK' end, 'source:Q', {RUN_MICROS}
from q where label <> 'OUTROS' and label <> 'NATION_4'"""


def incremental(spark, sf):
    """What two loads of source Q add, layer by layer, and where the next one begins."""
    lookups = {
        name: spark.sql("select * from values ('NATION_4', 'OUTROS', true) as t(tipo_ingresso, tipo_publico, active)")
        for name in "LQ"
    }
    root = work_dir(spark, "incremental")
    none = access.extract_l(tables_l(spark, sf), *_DAYS).limit(0)
    for batch in ("1", "2"):
        least = access.next_min_id(spark, root)
        q = access.extract_q(tables_q(spark, sf), *_Q_DAYS, _GATES, min_id=max(50, least))
        added = access.load_access(spark, root, batch, RUN_TS, lookups, {"L": none, "Q": q})
        if batch == "1":
            first = added
    rows = [(n, first[n]) for n in ("bronze_Q", "silver_Q", "context_Q", "gold", "audit_outros")]
    rows += [("second_load", sum(added[n] for n in ("bronze_Q", "silver_Q", "context_Q", "gold")))]
    rows += [("watermark", access.next_min_id(spark, root))]
    return spark.createDataFrame(rows, "name string, rows long")


INCREMENTAL = f"""
with {_FROM_Q}, q as (select "idAcesso" as id, {_LABEL} as label from x),
fact as (select * from q where label <> 'OUTROS' and label <> 'NATION_4')
select 'bronze_Q' as name, count(distinct id) as "rows" from q
union all select 'silver_Q', count(distinct id) from q
union all select 'context_Q', count(distinct id) from fact
union all select 'gold', count(distinct id) from fact
union all select 'audit_outros', count(*) from q where label = 'OUTROS'
union all select 'second_load', 0
union all select 'watermark', max(id) from q"""


def audit(spark, sf):
    """Accesses of source Q without a usable label, and those outside the fact."""
    rows, _ = access.bronze_q(
        access.extract_q(tables_q(spark, sf), *_Q_DAYS, _GATES, min_id=50), RUN_TS
    )
    silver = access.silver_q(rows, "bronze.access_q")
    none = spark.sql("select * from values ('NATION_4', 'OUTROS', true) as t(tipo_ingresso, tipo_publico, active)")
    fact = access.access_fact(silver, none, "active", "source:Q", RUN_TS, drop_unlabelled=True)
    return access.audit_q(silver, fact)


AUDIT = f"""
with {_FROM_Q}, q as (select {_LABEL} as label from x)
select 'outros' as "check", count(*) as "rows" from q where label = 'OUTROS'
union all
select 'fora_do_contexto', count(*) from q where label is null or label in ('OUTROS', 'NATION_4')"""

QUERIES = {
    "q_gold_fact": (gold_fact, GOLD_FACT),
    "q_access_l": (extract_l, EXTRACT_L),
    "q_access_l_silver": (silver_l, SILVER_L),
    "q_access_q": (extract_q, EXTRACT_Q),
    "q_access_q_silver": (silver_q, SILVER_Q),
    "q_access_layers": (layers, LAYERS),
    "q_access_audit": (audit, AUDIT),
    "q_access_incremental": (incremental, INCREMENTAL),
}
