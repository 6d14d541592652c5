"""Fixed schemas of the typed layers (``time`` columns are text ``HH:mm:ss``)."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "text": T.StringType(),
    "date": T.DateType(),
    "time": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "money": T.DecimalType(18, 2),
    "number": T.DecimalType(38, 6),
    "wall": T.TimestampNTZType(),
    "instant": T.TimestampType(),
}


def schema(spec: str) -> T.StructType:
    """``"a:date b c:long"`` as a StructType; text where no type is given."""
    fields = [part.partition(":") for part in spec.split()]
    return T.StructType([T.StructField(n, _TYPES[t or "text"]) for n, _, t in fields])


# Column lists of the silver and gold tables.
SALES_182 = schema(
    "id_venda loc_vhf autorizacao cliente dt_nascimento endereco cidade celular telefone email "
    "teste agencia data:date dt_venda:date hr_venda:time qtd:long produto vlr_unid:money "
    "vlr_total:money status entregue forma_pagamento usuario dt_utilizacao:date dt_baixa:date "
    "nsu qtd_parcelas:long prazo_recebimento pedido_esolution dt_integracao:date "
    "ingested_at:instant fonte_tabela_bronze"
)
SALES_270 = schema(
    "id_venda autorizacao cliente endereco cidade celular telefone email teste agencia data:date "
    "dt_venda:date hr_venda:time qtd:long produto vlr_unid:money vlr_total:money status entregue "
    "forma_pagamento usuario dt_utilizacao:date hr_utilizacao:time nsu qtd_parcelas:long "
    "prazo_recebimento dt_encerramento:date ingested_at:instant fonte_tabela_bronze"
)
CARTS_418 = schema(
    "id_venda data:date dt_utilizacao:date qtd:long vlr_total:money produto cliente email telefone "
    "cidade motivo ingested_at:instant fonte_tabela_bronze"
)
COUPONS_664 = schema(
    "id_venda tipo_produto cliente dt_venda:date dt_utilizacao:date dt_saida:date vlr_total:money "
    "cod_cupom nome_cupom status nome_desconto produto dt_inicial_uso_cupom:date "
    "dt_final_uso_cupom:date ingested_at:instant fonte_tabela_bronze"
)
PAYMENT_FORMS = schema("forma_pagamento tipo_pagamento fonte_tabela_bronze")
PRODUCTS = schema("produto tipo_produto categoria infantil pax:long fonte_tabela_bronze")

ACCESS_L = schema(
    "id_acesso dt_acesso_sys:date dt_hr_voucher:wall dt_voucher:date hr_voucher:time num_ingresso "
    "dt_hr_baixa:wall dt_entrada:date hr_entrada:time terminal_entrada cod_grupo nome_grupo "
    "tipo_bilhete cod_bilhete tipo_ingresso categoria tipo qtd:number vlr_unit:number "
    "src_nrvoucher bronze_extracted_at:instant payload"
)
ACCESS_Q = schema(
    "id_acesso:long dt_hr_entrada:wall dt_entrada:date hr_entrada:time dt_hr_saida:wall "
    "dt_saida:date hr_saida:time terminal_entrada terminal_saida tipo_acesso cliente "
    "id_desc_tipo_ingresso id_tipo_ingresso:long tipo_ingresso num_ingresso id_emp_relac:long "
    "email telefone celular source_table bronze_extracted_at:instant payload"
)
ACCESS_FACT = schema(
    "id_acesso num_ingresso tipo_ingresso terminal_entrada dt_entrada:date hr_entrada:time "
    "tipo_publico source_file ingested_at:instant"
)
GOLD_ACCESS = schema(
    "origem id_acesso num_ingresso tipo_ingresso terminal_entrada dt_entrada:date hr_entrada:time "
    "tipo_publico source_file ingested_at:instant"
)
WEATHER_RAW = schema(
    "data_scrap hora_scrap origem cidade total_dias bloco data_previsao tempmin tempmax "
    "sensacao_termica sensacao_sombra ind_max_uv vento probab_chuva relatorio"
)
WEATHER = schema(
    "origem_dado cidade dt_hr_scraping:instant dt_forecast:date ttl_dias:int bloco:int "
    "temp_min_c:int temp_max_c:int sensacao_termica sensacao_termica_sombra uv_index_max vento "
    "probabilidade_chuva relato bronze_id:long ingested_at:instant ingestion_type ingestion_batch "
    "uf id_silver:long"
)
WEATHER_CONTEXT = schema(
    "origem_dado cidade uf dt_forecast:date dt_hr_scraping:instant ingested_at:instant "
    "ttl_dias:int bloco:int temp_min_c:int temp_max_c:int sensacao_termica "
    "sensacao_termica_sombra uv_index_max vento probabilidade_chuva relato silver_id:long "
    "bronze_id:long ingestion_type ingestion_batch"
)
GOLD_WEATHER = schema(
    "cidade uf dt_forecast:date temp_min_c:int temp_max_c:int sensacao_termica "
    "sensacao_termica_sombra uv_index_max vento probabilidade_chuva relato "
    "last_updated_at:instant ingested_at:instant"
)
WATERMARKS = schema(
    "source_system entity watermark_key watermark_value updated_at:instant"
)
