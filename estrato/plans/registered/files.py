"""Raw lines and CSV files, read back from files that Spark writes from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from estrato.functions.text import column_name, dataset_name
from estrato.operators.reports import period_of
from estrato.plans import sales
from estrato.plans.registered.common import RUN_MICROS, RUN_TS, pick, pick_sql, plain, table
from estrato.session import spread, work_dir
from estrato.sources.files import CONTROLS, WINDOWS_1252, header_csv, lines_of_text, text_lines
from estrato.sources.paths import matching


def raw_lines_of_text(spark, sf):
    docs = spread(table(spark, sf, "documents"))
    docs = docs.withColumn("text", F.concat("text", F.lit("\n")))
    return lines_of_text(docs, "doc_id", "text")


_DOC_LINES = r"""
select doc_id, unnest(regexp_split_to_array(text, '\r\n|\n|\r')) as raw_line,
  generate_subscripts(regexp_split_to_array(text, '\r\n|\n|\r'), 1) as line_no
from documents"""
RAW_LINES = f"""
select doc_id, cast(line_no as bigint) as line_no, raw_line from ({_DOC_LINES})"""


def raw_files(spark, sf):
    """One file per hundred documents; its lines are numbered through all of them."""
    lines = lines_of_text(
        table(spark, sf, "documents").withColumn("text", F.concat("text", F.lit("\n"))),
        "doc_id", "text",
    ).withColumn("file_no", F.floor(F.col("doc_id") / 100))
    path = work_dir(spark, "raw-files")
    (
        lines.repartition("file_no").sortWithinPartitions("file_no", "doc_id", "line_no")
        .select("file_no", "raw_line").write.partitionBy("file_no").text(path)
    )
    read = text_lines(spark, path, "*.txt")
    folder = F.regexp_extract("_path", "file_no=([0-9]+)/", 1).cast("long")
    return read.select(folder.alias("file_no"), "line_no", "raw_line")


RAW_FILES = f"""
select doc_id // 100 as file_no, raw_line,
  row_number() over (partition by doc_id // 100 order by doc_id, line_no) as line_no
from ({_DOC_LINES})"""

def raw_bronze(spark, sf):
    """All documents as exports in two encodings, landed as bronze lines with an origin; by an
    allow-list, which leaves out a file with copies of some."""
    docs = table(spark, sf, "documents").withColumn("text", F.concat("text", F.lit("\n")))
    # dealt by a hash of the id; what Latin-1 can't hold is UTF-8
    latin = (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1) & ~F.col("text").rlike(r"[^\x00-\xFF]")
    lines = lines_of_text(docs.withColumn("latin", latin), "latin", "text").select("latin", "raw_line")
    plain_text = dict(sep=chr(2), quote=chr(1), emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    path = work_dir(spark, "exports")
    for encoding, some in (("UTF-8", ~F.col("latin")), ("ISO-8859-1", F.col("latin"))):
        lines.where(some).select("raw_line").write.mode("append").options(encoding=encoding, **plain_text).csv(path)
    allowed = [p.rsplit("/", 1)[1] for p in matching(spark, f"{path}/*.csv")]
    lines.where("latin").select("raw_line").write.mode("append").options(**plain_text).csv(path)  # not allowed
    bronze = work_dir(spark, "bronze")
    for _ in range(2):  # landing the files again changes nothing
        sales.load_bronze(spark, path, bronze, batch_id="b", run_ts=RUN_TS, allow=allowed, origin="web")
    rows = spark.read.parquet(bronze)
    return plain(rows.select("raw_line", "origem_dado", "dt_carga", (F.col("line_no") >= 1).cast("int").alias("numbered")))


RAW_BRONZE = f"""
select raw_line, 'web' as origem_dado, {RUN_MICROS} as dt_carga, 1 as numbered from ({_DOC_LINES})"""

_SIGNS = {"utf8": "ñ ✓ “q” 日本", "latin": "ñ ç ü", "windows": "ñ “q” – 5 €", "utf16": "ñ ✓ “q” 日本"}


def encodings(spark, sf):
    """Lines of events in four encodings, told apart by their bytes."""
    kind = pick(F.col("event_id"), *[F.lit(k) for k in _SIGNS])
    signs = F.create_map(*[F.lit(x) for pair in _SIGNS.items() for x in pair])[kind]
    rows = table(spark, sf, "events").select(kind.alias("kind"), F.concat_ws(";", "event_id", "event_type", signs).alias("line"))
    path = work_dir(spark, "encodings")
    plain_text = dict(sep=chr(2), quote=chr(1), emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    for name, encoding in (("utf8", "UTF-8"), ("latin", "ISO-8859-1"), ("windows", "ISO-8859-1"), ("utf16", "UTF-16")):
        # the signs of Windows-1252 are the control characters of Latin-1
        line = F.translate("line", WINDOWS_1252, CONTROLS) if name == "windows" else F.col("line")
        some = rows.where(F.col("kind") == name).select(line.alias("line")).coalesce(1)
        some.write.options(encoding=encoding, **plain_text).csv(f"{path}/{name}")
    read = text_lines(spark, f"{path}/*")
    folder = F.regexp_extract("_path", "/([a-z0-9]+)/[^/]*$", 1)
    return read.select(folder.alias("folder"), "raw_line", (F.col("line_no") >= 1).cast("int").alias("numbered"))


ENCODINGS = f"""
select {pick_sql('event_id', *[f"'{k}'" for k in _SIGNS])} as folder,
  concat_ws(';', event_id, event_type, {pick_sql('event_id', *[f"'{v}'" for v in _SIGNS.values()])}) as raw_line, cast(1 as int) as numbered
from events"""

_WANTED = ["event_id", "event_type", "props", "user_id", "note"]


def csv_history(spark, sf):
    """CSV exports with two column orders; the exports that lack a column are rejected."""
    note = pick(F.col("event_id"), F.lit(""), F.lit("a;b"), F.lit('say "x"\nbye'), F.lit(" N/A"))
    events = table(spark, sf, "events").withColumn("note", note)
    exports = {
        "first": (["click", "view"], ["event_id", "note", "event_type", "user_id", "props", "value"]),
        "second": (["purchase", "signup"], ["props", "user_id", "event_id", "event_type", "note"]),
        "broken": (["error"], ["event_id", "event_type", "props", "note"]),
    }
    path = work_dir(spark, "csv")
    for name, (kinds, columns) in exports.items():
        writer = events.where(F.col("event_type").isin(kinds)).select(columns).write
        writer.options(
            sep=";", header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False
        ).csv(f"{path}/{name}")
    rows, _ = header_csv(spark, f"{path}/*", _WANTED)
    return rows.select(*_WANTED)


CSV_HISTORY = f"""
select cast(event_id as varchar) as event_id, event_type, props, cast(user_id as varchar) as user_id,
  {pick_sql('event_id', "''", "'a;b'", "concat('say \"x\"', chr(10), 'bye')", "' N/A'")} as note
from events where event_type <> 'error'"""


def dataset_names(spark, sf):
    stem = pick(
        F.col("doc_id"),
        F.concat(F.lit(" 2025"), F.lpad((F.col("doc_id") % 12 + 1).cast("string"), 2, "0"), F.lit("_182")),
        F.concat(F.col("source"), F.lit(" Relatório (v2)--"), F.col("lang")),
        F.lit("___"),
        F.concat(F.lit("t_202511_182"), F.col("lang")),
    )
    docs = table(spark, sf, "documents").select("doc_id", stem.alias("stem"))
    name = dataset_name(F.col("stem"))
    return docs.select(
        "doc_id", name.alias("dataset"), period_of(name, "182").alias("period"),
        column_name(F.concat(F.lit(chr(0xFEFF)), F.col("stem"))).alias("column_name"),
    )


_MONTH = "concat('2025', lpad(cast(doc_id % 12 + 1 as varchar), 2, '0'))"
DATASET_NAMES = f"""
select doc_id, {pick_sql('doc_id', f"concat('t_', {_MONTH}, '_182')",
    "concat(source, '_relat_rio_v2_', lang)", "'t_unnamed'", "'t_202511_182' || lang")} as dataset,
  {pick_sql('doc_id', _MONTH, "''", "''", "''")} as period,
  {pick_sql('doc_id', f"concat({_MONTH}, '_182')", "concat(source, '_relatório_(v2)--', lang)",
            "'___'", "'t_202511_182' || lang")} as column_name
from documents"""

QUERIES = {
    "q_raw_lines": (raw_lines_of_text, RAW_LINES),
    "q_raw_files": (raw_files, RAW_FILES),
    "q_raw_bronze": (raw_bronze, RAW_BRONZE),
    "q_encodings": (encodings, ENCODINGS),
    "q_csv_history": (csv_history, CSV_HISTORY),
    "q_regexp_period": (dataset_names, DATASET_NAMES),
}
