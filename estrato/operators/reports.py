"""Carving and parsing of report exports kept as raw lines.

Input is the bronze shape ``(file, line_no, raw_line)``.  A file may be of any
size: markers are found by a filter, and the state "inside a quoted field" is
handed from chunk to chunk (see :mod:`estrato.operators.ordered`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estrato.functions.text import BOM, CSV_NA, na_to_null, strip
from estrato.operators.ordered import CHUNK, CHUNK_SPAN, forward_fill, with_chunk

LINE, RAW = "line_no", "raw_line"


def _starts_with_any(c: Column, prefixes: Sequence[str]) -> Column:
    return reduce(lambda a, p: a | c.startswith(p), prefixes, F.lit(False))


def marker_lines(
    lines: DataFrame, file: str, header: str, stops: Sequence[str] = ()
) -> DataFrame:
    """Lines that may open or close the main block: ``(file, line_no, header)``.

    ``header`` is the text of a header line (BOM removed) and NULL on a stop line.
    """
    text = F.ltrim(F.col(RAW), F.lit(BOM))
    is_header = text.startswith(header)
    return lines.where(is_header | _starts_with_any(strip(F.col(RAW)), stops)).select(
        file, LINE, F.when(is_header, text).alias("header")
    )


def block_bounds(markers: DataFrame, file: str) -> DataFrame:
    """One row per file with a header: ``header_line``, ``header``, ``stop_line``.

    The first header line opens the block, the first stop line below it closes it
    (``stop_line`` is NULL when the block runs to the end of the file).
    """
    heads = markers.groupBy(file).agg(
        F.min(F.when(F.col("header").isNotNull(), F.col(LINE))).alias("header_line"),
        F.min_by("header", F.when(F.col("header").isNotNull(), F.col(LINE))).alias("header"),
    )
    heads = heads.where(F.col("header_line").isNotNull())
    stops = (
        markers.where(F.col("header").isNull())
        .join(heads.select(file, "header_line"), file)
        .where(F.col(LINE) > F.col("header_line"))
        .groupBy(file)
        .agg(F.min(LINE).alias("stop_line"))
    )
    return heads.join(stops, file, "left")


def carve_block(lines: DataFrame, bounds: DataFrame, file: str) -> DataFrame:
    """Data lines of each file: below the header, above the stop, blank ones left out."""
    below_stop = F.col("stop_line").isNull() | (F.col(LINE) < F.col("stop_line"))
    return (
        lines.where(strip(F.col(RAW)) != "")
        .join(bounds.select(file, "header_line", "stop_line"), file)
        .where((F.col(LINE) > F.col("header_line")) & below_stop)
        .select(file, LINE, RAW)
    )


# ---------------------------------------------------------------- CSV records
#
# A line maps the quote state before it (0 outside, 1 inside a quoted field) to the
# state after it.  Such a map either forces a state, keeps it, or turns it round, so
# the state before any line is: the last forced state above it, turned once for each
# turning line since.


def _ends_inside(line: Column, inside_at_start: bool, sep: str) -> Column:
    """Quote state after a line: 1 inside a quoted field, 0 outside."""
    quoted = r'"[^"]*+(?:""[^"]*+)*+'
    field = rf'(?:{quoted}"[^{sep}]*+|(?!")[^{sep}]*+)'
    text = F.concat(F.lit('"'), line) if inside_at_start else line
    open_end = text.rlike(rf"(?s)^(?:{field}{sep})*+{quoted}$").cast("int")
    has_quote = F.contains(line, F.lit('"'))
    return F.when(has_quote, open_end).otherwise(F.lit(int(inside_at_start)))


def _state_before(df: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """Add ``_forced`` and ``_turns``: what the rows above a row do to the quote state.

    ``_out0`` and ``_out1`` are the states a row leads to from 0 and from 1.
    """
    w = Window.partitionBy(*group).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    above = w.rowsBetween(Window.unboundedPreceding, -1)
    turn = (F.col("_out0") > F.col("_out1")).cast("int")
    forced = F.when(F.col("_out0") == F.col("_out1"), F.col("_out0"))
    return (
        df.withColumn("_upto", F.sum(turn).over(upto))
        .withColumn("_force", forced.bitwiseXOR((F.col("_upto") % 2).cast("int")))
        .withColumn("_forced", F.last("_force", True).over(above))
        .withColumn("_turns", ((F.col("_upto") - turn) % 2).cast("int"))
        .drop("_upto", "_force")
    )


def _entered(entry: Column) -> Column:
    return F.coalesce(F.col("_forced"), entry).bitwiseXOR(F.col("_turns"))


def _left(entry: Column) -> Column:
    return F.when(_entered(entry) == 0, F.col("_out0")).otherwise(F.col("_out1"))


def quote_maps(
    block: DataFrame, file: str, sep: str = ";", span: int = CHUNK_SPAN
) -> DataFrame:
    """Each line with its own map and that of the lines above it in its chunk.

    The one step that shuffles and sorts the text, by file and chunk.  Several steps
    read the result, so a plan writes it first.
    """
    coded = with_chunk(block, LINE, span).select(
        file, CHUNK, LINE, RAW,
        _ends_inside(F.col(RAW), False, sep).alias("_out0"),
        _ends_inside(F.col(RAW), True, sep).alias("_out1"),
    )
    return _state_before(coded, [file, CHUNK], LINE)


INSIDE, UNCLOSED = "inside", "unclosed"


def quote_exceptions(maps: DataFrame, file: str) -> DataFrame:
    """The few places where quotes matter beyond a line: ``(file, _chunk, kind)``.

    ``inside`` marks a chunk that starts inside a quoted field, ``unclosed`` a file whose
    last quote never closes.  Read from the maps without the text; a plan writes the
    result, so that its true size decides how it is joined with the text.
    """
    per_chunk = maps.groupBy(file, CHUNK).agg(
        F.max_by(_left(F.lit(0)), F.col(LINE)).alias("_out0"),
        F.max_by(_left(F.lit(1)), F.col(LINE)).alias("_out1"),
    )
    states = _state_before(per_chunk, [file], CHUNK).select(
        file, CHUNK, _entered(F.lit(0)).alias("_in"), _left(F.lit(0)).alias("_out")
    )
    ends = states.groupBy(file).agg(F.max_by("_out", CHUNK).alias("_out"))
    inside = states.where("_in = 1").select(file, CHUNK, F.lit(INSIDE).alias("kind"))
    unclosed = ends.where("_out = 1").select(
        file, F.lit(None).cast("long").alias(CHUNK), F.lit(UNCLOSED).alias("kind")
    )
    return inside.unionByName(unclosed)


def unclosed_files(exceptions: DataFrame, file: str) -> DataFrame:
    return exceptions.where(F.col("kind") == UNCLOSED).select(file)


def quote_states(maps: DataFrame, exceptions: DataFrame, file: str) -> DataFrame:
    """Each line with ``opens_in`` and ``ends_in``: 1 where it starts or ends inside a
    quoted field.  Files with an unclosed quote are left out: the tail of such a file
    would be one field, and strict CSV readers refuse it."""
    inside = exceptions.where(F.col("kind") == INSIDE).select(file, CHUNK, F.lit(1).alias("_in"))
    entry = F.coalesce(F.col("_in"), F.lit(0))
    return (
        maps.join(unclosed_files(exceptions, file), file, "left_anti")
        .join(inside, [file, CHUNK], "left")
        .select(
            file, LINE, RAW, _entered(entry).alias("opens_in"), _left(entry).alias("ends_in")
        )
    )


def logical_records(states: DataFrame, file: str, span: int = CHUNK_SPAN) -> DataFrame:
    """CSV records ``(file, line_no, raw_line)``; ``line_no`` is the first line of each.

    Most records are one line and pass by untouched; only lines of longer records are
    shuffled and joined with line breaks.
    """
    single = (F.col("opens_in") == 0) & (F.col("ends_in") == 0)
    numbered = forward_fill(
        states.where(~single).withColumn("_start", F.when(F.col("opens_in") == 0, F.col(LINE))),
        [file], LINE, ["_start"], span,
    )
    joined = numbered.groupBy(file, "_start").agg(
        F.expr(f"listagg({RAW}, '\\n') within group (order by {LINE})").alias(RAW)
    )
    singles = states.where(single).select(file, LINE, RAW)
    return singles.unionByName(joined.withColumnRenamed("_start", LINE))


_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'


def fields_of(record: Column, sep: str = ";") -> Column:
    """Field texts of one CSV record: quotes removed, doubled quotes made single."""
    pattern = rf"(?s){sep}({_QUOTED}|[^{sep}]*+)"
    raw = F.regexp_extract_all(F.concat(F.lit(sep), record), F.lit(pattern), F.lit(1))

    def unquote(f: Column) -> Column:
        body = F.substring(f, F.lit(2), F.length(f) - 2)
        return F.when(f.startswith('"'), F.replace(body, F.lit('""'), F.lit('"'))).otherwise(f)

    # with all fields in quotes and no other quotes, quotes and separator stand at the borders alone
    inner = F.when(record.endswith(sep), F.concat(F.substr(record, F.lit(2)), F.lit('"'))).otherwise(
        F.substring(record, F.lit(2), F.length(record) - 2)
    )
    has_quote = F.contains(record, F.lit('"'))
    return (
        F.when(_all_quoted(record, sep), F.split(inner, f'"{sep}"'))
        .when(has_quote, F.transform(raw, unquote))
        .otherwise(F.split(record, sep))
    )


def _all_quoted(record: Column, sep: str) -> Column:
    """Whether every field is in quotes, a last empty one aside, and no quotes are inside them."""
    return record.rlike(rf'^"[^"]*+"(?:{sep}"[^"]*+")*+{sep}?\z')


def is_well_formed(record: Column, sep: str = ";") -> Column:
    """False where text follows a closing quote: strict CSV readers refuse the file."""
    field = rf'(?:{_QUOTED}(?={sep}|$)|(?!")[^{sep}]*+)'
    strict = record.rlike(rf"(?s)^{field}(?:{sep}{field})*+$")
    return (
        F.when(_all_quoted(record, sep), F.lit(True))
        .when(F.contains(record, F.lit('"')), strict)
        .otherwise(F.lit(True))
    )


def parse_records(
    records: DataFrame, file: str, sep: str = ";", na_tokens: Sequence[str] = CSV_NA
) -> DataFrame:
    """``(file, line_no, fields, strict)``: every field as text, NA tokens as NULL."""
    fields = fields_of(F.col(RAW), sep)
    if na_tokens:
        fields = F.transform(fields, lambda f: na_to_null(f, na_tokens))
    return records.select(
        file, LINE, fields.alias("fields"), is_well_formed(F.col(RAW), sep).alias("strict")
    )


def header_positions(
    bounds: DataFrame, file: str, columns: Mapping[str, Sequence[str]], sep: str = ";",
    rename=None,
) -> DataFrame:
    """Where each wanted column stands in each file: ``(file, n_fields, at)``.

    ``columns`` maps a name to the header texts it may have; ``rename`` is applied to
    the header texts first.  ``at`` is a struct of positions from 0, NULL for a column
    the file does not have.
    """
    names = fields_of(F.col("header"), sep)
    if rename is not None:
        names = F.transform(names, rename)
    located = bounds.select(file, names.alias("_names"))

    def position(aliases: Sequence[str]) -> Column:
        found = [F.array_position("_names", a) for a in aliases]
        first = F.coalesce(*[F.when(p > 0, p) for p in found])
        return (first - 1).cast("int")

    at = F.struct(*[position(aliases).alias(name) for name, aliases in columns.items()])
    return located.select(file, F.size("_names").alias("n_fields"), at.alias("at"))


TOO_WIDE, STRAY_TEXT, OPEN_QUOTE = "too_many_fields", "text_after_quote", "open_quote"
NO_HEADER, NO_DATA = "no_header", "no_data"


def unreadable_files(parsed: DataFrame, positions: DataFrame, file: str) -> DataFrame:
    """Files with a record that has more fields than the header, or text after a quote.

    One such record makes a strict reader give up the whole file: ``(file, reason)``.
    """
    worst = parsed.groupBy(file).agg(
        F.max(F.size("fields")).alias("_widest"), F.min("strict").alias("_strict")
    )
    reason = F.when(~F.col("_strict"), F.lit(STRAY_TEXT)).when(
        F.col("_widest") > F.col("n_fields"), F.lit(TOO_WIDE)
    )
    joined = worst.join(positions.select(file, "n_fields"), file)
    return joined.select(file, reason.alias("reason")).where(F.col("reason").isNotNull())


def select_fields(
    parsed: DataFrame, positions: DataFrame, file: str, names: Sequence[str]
) -> DataFrame:
    """Named text columns of the parsed records; a column the file lacks is NULL."""
    values = [F.expr(f"get(fields, at.`{n}`) as `{n}`") for n in names]
    return parsed.join(positions.select(file, "at"), file).select(file, LINE, *values)


def drop_empty_records(parsed: DataFrame) -> DataFrame:
    """Drop records in which every field is NULL."""
    return parsed.where(F.exists("fields", lambda f: f.isNotNull()))


def period_of(name: Column, suffix: str) -> Column:
    """``202511`` of ``t_202511_182``; empty text for another name."""
    return F.regexp_extract(name, rf"t_(\d{{6}})_{suffix}$", 1)
