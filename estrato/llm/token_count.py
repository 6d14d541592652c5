"""Token counts by the whole-token shortcut.

Vocabulary strings proven to encode alone as one token are counted by a look-up; only the
other words of a text are merged by the tokenizer, once for each worker while remembered.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estrato.llm.common import whole_text
from estrato.llm.pieces import count_table, model_path

#: Tokens of a context beyond which a document counts as too long.
LIMIT = 4096


def token_counts(
    docs: DataFrame, path: str | None = None, limit: int = LIMIT, text: str = "text"
) -> DataFrame:
    """``docs`` without its text, with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    Null and empty texts have no bytes and no tokens; any other column stays, unless it
    has the name of a new one.  Repeated rows each have their row; an empty table gives
    an empty one.  Nothing is shuffled.
    """
    path = path or model_path()
    kept = [c for c in docs.columns if c not in (text, "n_bytes", "n_tokens", "over_limit")]
    rows = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        F.octet_length(whole_text(text)).cast("long").alias("n_bytes"),
        whole_text(text).alias("_text"),
    )
    out = rows.drop("_text").withColumn("n_tokens", F.lit(0).cast("long")).schema

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        table = count_table(path)
        for batch in batches:
            n = pa.array([table.text(t) for t in batch.column("_text").to_pylist()], pa.int64())
            columns = [batch.column(c) for c in batch.schema.names if c != "_text"]
            names = [c for c in batch.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays([*columns, n], [*names, "n_tokens"])

    return rows.mapInArrow(count, out).withColumn("over_limit", F.col("n_tokens") > limit)
