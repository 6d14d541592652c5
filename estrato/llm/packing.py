"""Token ids in packed rows: best-fit-decreasing with a segment tree over capacities.

Texts become 16-bit ids, texts longer than a row are cut without loss into whole rows and a
rest.  Pieces are dealt out by a hash of document, place and content; a task packs them in
blocks of a fixed number of tokens, so its memory is bounded however the pieces fall.
In a block the longest piece goes first, into the open row with the least room that holds it;
a segment tree over the capacities finds that room in logarithmic time.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import text_batches, tidied, whole_text
from estrato.llm.pieces import id_table, model_path

SEQ_LEN = 2048
#: Tokens packed together; a block's ids take two bytes each.
BLOCK_TOKENS = 1 << 21
PAD = 0

ROWS = (
    "row_id string, n_tokens int, n_segments int, doc_ids array<long>, parts array<int>, "
    "cu_seqlens array<int>, position_resets array<int>, input_ids binary"
)


class Capacities:
    """Open rows by the room left in them; a segment tree finds the least that is enough."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        i = room + self.size
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of a row with the least room of at least ``need``; it is removed."""
        count, i = self.count, need + self.size
        if not count[i]:
            # up until a right sibling has rows, then down to its leftmost
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.size
        while i:
            count[i] -= 1
            i >>= 1
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indices of the pieces of each row; every length is from 1 to ``capacity``."""
    rows: list[list[int]] = []
    open_rows = Capacities(capacity)
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = open_rows.take(lengths[piece])
        room, row = found if found else (capacity, len(rows))
        if not found:
            rows.append([])
        rows[row].append(piece)
        if room > lengths[piece]:
            open_rows.put(room - lengths[piece], row)
    return rows


def token_pieces(docs: DataFrame, path: str, seq_len: int) -> DataFrame:
    """(doc_id, part, ids): the ids of each text in pieces of at most ``seq_len``."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        table, step = id_table(path), 2 * seq_len
        for batch in tidied(batches):
            doc, part, ids, held = [], [], [], 0
            texts = batch.column("text")
            for n, d in enumerate(batch.column("doc_id").to_pylist()):
                got = table.text(texts[n].as_py())
                for k, start in enumerate(range(0, len(got), step)):
                    doc.append(d)
                    part.append(k)
                    ids.append(got[start : start + step])
                held += len(got)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(part, pa.int32()), pa.array(ids, pa.binary())], ["doc_id", "part", "ids"])
                    doc, part, ids, held = [], [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(part, pa.int32()), pa.array(ids, pa.binary())], ["doc_id", "part", "ids"])

    return rows.mapInArrow(run, "doc_id long, part int, ids binary")


def pack(
    docs: DataFrame,
    path: str | None = None,
    seq_len: int = SEQ_LEN,
    block_tokens: int = BLOCK_TOKENS,
    tasks: int | None = None,
) -> DataFrame:
    """Packed rows of all texts.

    A row has ``input_ids``, ``seq_len`` little-endian 16-bit ids padded with 0 after
    ``n_tokens``; ``cu_seqlens``, where its segments begin and the last ends;
    ``position_resets``, where positions start at 0 again: at each segment, and at the
    padding if there is any; ``doc_ids`` and ``parts``, whose and which piece a segment is.
    Pieces of one document in order of part give back its ids.

    Null and empty texts have no ids and no segment; a null id is kept as null; repeated
    rows are packed each; an empty table gives no rows.  Rows are the same on each run over
    the same number of ``tasks`` (that of the shuffle partitions if None).
    """
    path = path or model_path()
    tasks = tasks or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = token_pieces(docs, path, seq_len)
    content = F.xxhash64("doc_id", "part", "ids")
    dealt = pieces.withColumn("deal", content).repartition(tasks, "deal").sortWithinPartitions("deal", "doc_id", "part", "ids")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([
            ("row_id", pa.string()), ("n_tokens", pa.int32()), ("n_segments", pa.int32()),
            ("doc_ids", pa.list_(pa.int64())), ("parts", pa.list_(pa.int32())),
            ("cu_seqlens", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())),
            ("input_ids", pa.binary()),
        ])

        def packed(block: list[tuple], name: str):
            rows = best_fit_decreasing([len(x[2]) // 2 for x in block], seq_len)
            out = []
            for k, row in enumerate(rows):
                ids = b"".join(block[i][2] for i in row)
                ends = np.cumsum([0, *(len(block[i][2]) // 2 for i in row)]).tolist()
                n = ends[-1]
                out.append({
                    "row_id": f"{name}-{k:06d}", "n_tokens": n, "n_segments": len(row),
                    "doc_ids": [block[i][0] for i in row], "parts": [block[i][1] for i in row],
                    "cu_seqlens": ends, "position_resets": ends if n < seq_len else ends[:-1],
                    "input_ids": ids.ljust(2 * seq_len, PAD.to_bytes(1, "little")),
                })
            for at in range(0, len(out), 256):
                yield pa.RecordBatch.from_pylist(out[at : at + 256], schema=schema)

        from pyspark import TaskContext

        task, blocks = TaskContext.get().partitionId(), 0
        block, held = [], 0
        for batch in tidied(batches):
            for x in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "ids")), strict=True):
                block.append(x)
                held += len(x[2]) // 2
                if held >= block_tokens:
                    yield from packed(block, f"{task:06d}-{blocks:06d}")
                    block, held, blocks = [], 0, blocks + 1
        if block:
            yield from packed(block, f"{task:06d}-{blocks:06d}")

    return dealt.mapInArrow(run, ROWS)


def write_matrix(rows: DataFrame, path: str) -> None:
    """Write packed rows as Parquet: one fixed-width binary cell for each matrix row."""
    rows.write.mode("overwrite").parquet(path)
