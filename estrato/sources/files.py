"""Report files as numbered raw lines, and typed-header CSV files."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from estrato.functions.text import BOM, dataset_name
from estrato.operators import reports
from estrato.session import written
from estrato.sources.paths import any_match, escaped, plain_name

FILE, TABLE = "_source_file", "src_table"


def new_batch_id() -> str:
    return uuid.uuid4().hex


# The characters that Windows-1252 has where Latin-1 has control characters, in the
# order of their bytes, and the bytes that it leaves undefined.
WINDOWS_1252 = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
UNDEFINED = (0x81, 0x8D, 0x8F, 0x90, 0x9D)
CONTROLS = "".join(chr(b) for b in range(0x80, 0xA0) if b not in UNDEFINED)
UTF_16, UTF_8, WINDOWS, LATIN = "UTF-16", "UTF-8", "Windows-1252", "ISO-8859-1"


def _count_of(latin: Column, characters: str) -> Column:
    return F.length(latin) - F.length(F.translate(latin, characters, ""))


def _encoding(marked: Column, valid: Column, controls: Column, undefined: Column) -> Column:
    """The encoding that the bytes of a file speak for.

    A mark says UTF-16.  Lines that are all valid are UTF-8: other encodings of letters beyond
    ASCII hardly ever are.  Of the rest, bytes of 80 to 9F are signs in Windows-1252 and control
    characters in Latin-1, which texts don't hold: with some of them, none undefined, it is
    Windows-1252.
    """
    return (
        F.when(marked, UTF_16).when(valid, UTF_8)
        .when((controls > 0) & (undefined == 0), WINDOWS).otherwise(LATIN)
    )


def text_lines(
    spark: SparkSession, path: str | Sequence[str], glob: str = "*.csv"
) -> DataFrame:
    """Physical lines of all files, numbered from 1 in each file, decoded per file.

    Files are split: a file of any size is read by many tasks.  A line knows its split
    (``file_block_start``) and its place in it; the number of lines in the splits before
    gives the rest, from an aggregate with one row per split.  The files are read once:
    where splits begin depends on the cluster at that moment, so the lines are written with
    their split and place, and the numbers come from that table.  The same aggregate counts
    the bytes that tell the encodings apart (``_encoding``), and no byte is lost.  The reader
    removes a byte order mark at the start of a file.  Files in UTF-16, which can't be cut at
    line breaks of one byte, are read again, each as a whole.
    """
    read = spark.read.option("pathGlobFilter", glob).text(path if isinstance(path, str) else list(path)).select(
        "value",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias(FILE),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_at"),
    )
    lines = written(read, "text-lines")
    raw = F.col("value").cast("binary")
    latin, valid = F.decode(raw, LATIN), F.expr("is_valid_utf8(value)")
    splits = lines.groupBy("_path", "_split").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_at").alias("_first"),
        F.bool_and(valid).alias("_valid"),
        F.sum(F.when(~valid, _count_of(latin, CONTROLS)).otherwise(0)).alias("_controls"),
        F.sum(F.when(~valid, _count_of(latin, "".join(map(chr, UNDEFINED)))).otherwise(0)).alias("_undefined"),
        F.min(F.when(F.col("_split") == 0, F.struct("_at", F.hex(F.substring(raw, 1, 2)).alias("mark")))).alias("_start"),
    )
    in_file = Window.partitionBy("_path")
    above = in_file.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    marked = F.coalesce(F.max(F.col("_start.mark")).over(in_file).isin("FFFE", "FEFF"), F.lit(False))
    offsets = splits.select(
        "_path",
        "_split",
        (F.coalesce(F.sum("_n").over(above), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        _encoding(
            marked, F.min("_valid").over(in_file), F.sum("_controls").over(in_file), F.sum("_undefined").over(in_file)
        ).alias("_encoding"),
    )
    offsets = written(offsets, "splits")
    encoding = F.col("_encoding")
    decoded = F.when(encoding == UTF_8, F.col("value")).when(encoding == LATIN, latin).otherwise(
        F.translate(latin, CONTROLS, WINDOWS_1252)
    )
    out = lines.join(offsets.where(encoding != UTF_16), ["_path", "_split"]).select(
        (F.col("_at") + F.col("_shift")).alias("line_no"), decoded.alias("raw_line"), FILE, "_path",
    )
    wide = [r[0] for r in offsets.where(encoding == UTF_16).select("_path").distinct().toLocalIterator()]  # names of files
    return out.unionByName(_utf_16_lines(spark, wide)) if wide else out


def _utf_16_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of files in UTF-16, whose mark tells the order of bytes; of 2 GB each at most."""
    whole = spark.read.format("binaryFile").load([escaped(unquote(p)) for p in paths]).select(
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias(FILE),
        F.decode("content", UTF_16).alias("_text"),
    )
    parts = lines_of_text(whole.withColumn("_file", F.struct("_path", FILE)), "_file", "_text")
    return parts.select("line_no", "raw_line", f"_file.{FILE}", "_file._path")


def lines_of_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """Physical lines of a text column, numbered from 1 per row: ``(key, line_no,
    raw_line)``.  The empty rest after a final line break is no line."""
    parts = F.split(F.col(text), "\r\n|\n|\r")
    last = F.element_at(parts, -1)
    count = F.size(parts) - F.when(last == "", F.lit(1)).otherwise(F.lit(0))
    return df.select(
        key, F.posexplode(F.slice(parts, F.lit(1), count)).alias("_at", "raw_line")
    ).select(key, (F.col("_at") + 1).cast("long").alias("line_no"), "raw_line")


def raw_lines(
    spark: SparkSession,
    path: str,
    *,
    batch_id: str,
    run_ts: datetime,
    allow: Sequence[str] | None = None,
    origin: str | None = None,
    glob: str = "*.csv",
) -> DataFrame:
    """Bronze raw lines: ``src_table, line_no, raw_line, _source_file, _ingested_at,
    _batch_id`` and, with an origin, ``origem_dado, dt_carga`` in place of
    ``_ingested_at``.

    ``allow`` names the only files to read.  A folder without a matching file is an
    error.
    """
    names = [escaped(n) for n in allow] if allow else [glob]
    found = [f"{path}/{n}" for n in names if any_match(spark, f"{path}/{n}")]
    if not found:
        raise FileNotFoundError(f"no file of {names} in {path}")
    lines = text_lines(spark, found if allow else path, glob)
    lines = lines.withColumn(FILE, plain_name(F.col(FILE)))
    stem = F.regexp_replace(FILE, r"\.[^.]*$", "")
    named = lines.withColumn(TABLE, dataset_name(stem))
    common = [TABLE, "line_no", "raw_line", FILE]
    if origin is None:
        return named.select(
            *common, F.lit(run_ts).alias("_ingested_at"), F.lit(batch_id).alias("_batch_id")
        )
    return named.select(
        *common, F.lit(batch_id).alias("_batch_id"), F.lit(origin).alias("origem_dado"),
        F.lit(run_ts).alias("dt_carga"),
    )


def header_csv(
    spark: SparkSession, path: str, required: Sequence[str], sep: str = ";", glob: str = "*.csv"
) -> tuple[DataFrame, DataFrame]:
    """CSV files with a header line, by column name: ``(rows, rejected files)``.

    Files may order their columns differently and have more of them.  Every value is
    text, an empty field is the empty text.  A file that lacks a required column, or
    that a strict CSV reader refuses, is rejected as a whole with the reason.
    """
    lines = text_lines(spark, path, glob).drop(FILE)
    heads = written(
        lines.where("line_no = 1").select(
            "_path",
            F.col("line_no").alias("header_line"),
            F.ltrim(F.col("raw_line"), F.lit(BOM)).alias("header"),
            F.lit(None).cast("long").alias("stop_line"),
        ),
        "csv-heads",
    )
    block = reports.carve_block(lines, heads, "_path")
    maps = written(reports.quote_maps(block, "_path", sep), "csv-lines")
    odd = written(reports.quote_exceptions(maps, "_path"), "csv-quotes")
    records = reports.logical_records(reports.quote_states(maps, odd, "_path"), "_path")
    parsed = written(
        reports.parse_records(records, "_path", sep, na_tokens=()), "csv-records"
    )
    at = reports.header_positions(heads, "_path", {c: [c] for c in required}, sep)
    absent = F.array_compact(
        F.array(*[F.when(F.col(f"at.`{c}`").isNull(), F.lit(c)) for c in required])
    )
    rejected = (
        reports.unreadable_files(parsed, at, "_path")
        .unionByName(
            reports.unclosed_files(odd, "_path").withColumn("reason", F.lit(reports.OPEN_QUOTE))
        )
        .unionByName(
            at.select(
                "_path",
                F.concat(F.lit("missing columns: "), F.array_join(absent, ", ")).alias("reason"),
                F.size(absent).alias("_absent"),
            )
            .where("_absent > 0")
            .drop("_absent")
        )
    )
    rejected = written(rejected, "csv-rejects")
    rows = reports.select_fields(parsed, at, "_path", required).join(
        rejected.select("_path"), "_path", "left_anti"
    )
    name = plain_name(F.element_at(F.split("_path", "/"), -1)).alias(FILE)
    return rows.select(name, "line_no", *required), rejected.select(name, "reason")
