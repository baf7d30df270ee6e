"""Contiguous shards of balanced bytes.

Rows are range-partitioned by their order, each partition's bytes are totalled, and the
totals' prefix sums (a few rows) give each partition the bytes before it; inside, running
sums go on.  A row belongs to the shard in which its first byte lies, when all bytes are cut
at equal targets.  Only ids and sizes move, not the texts.

Defined cases: a null or empty text has no bytes and lies where the next row begins (after the
last byte: in the last shard); texts of any length stay whole; null ids come first; ties of the order, repeated rows among them, go by size; an empty table has no shards.
``sharded`` leaves a column of the table that is called shard or byte_start as it is, and calls its own shard_2 or byte_start_2 (and so on) then.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fitted, global_sum

TARGET_BYTES = 8 << 20


def shards(docs: DataFrame, target_bytes: int = TARGET_BYTES, order: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """(*order, n_bytes, byte_start, shard); shards hold total / ceil(total / target_bytes) bytes each, but for the row across a cut."""
    sized = cut(docs.select(*order, F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes")), "bytes")
    placed, total = global_sum(sized, list(order), "n_bytes", "byte_start", ("n_bytes",))
    count = max(1, -(-total // target_bytes))
    shard = F.least(F.expr(f"byte_start * {count} div {max(total, 1)}"), F.lit(count - 1)).cast("long")
    return placed.select(*order, "n_bytes", "byte_start", shard.alias("shard"))


def free(name: str, columns: list[str]) -> str:
    """*name*, with the first number from 2 on that makes it a new one if it's taken (names differ by more than case)."""
    taken = {c.lower() for c in columns}
    return next(c for c in [name, *(f"{name}_{k}" for k in range(2, len(taken) + 3))] if c not in taken)


def sharded(docs: DataFrame, target_bytes: int = TARGET_BYTES, text_col: str = "text") -> DataFrame:
    """*docs* with ``shard`` and ``byte_start`` in the order of the stored table: file (by length of the path, so that part-100000 comes after part-99999, then path), then row.

    A table that isn't read straight from files is written to the shared folder first, and has the order in which it was written."""
    try:
        stored = docs.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    except AnalysisException:
        docs = cut(docs, "stored")
        stored = docs.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    names = {k: free(k, docs.columns) for k in ("shard", "byte_start")}
    placed = shards(stored.select(F.length("__file").alias("__size"), "__file", "__row", F.col(text_col).alias("__text")), target_bytes, ("__size", "__file", "__row"), "__text")
    at = cut(placed.select("__file", "__row", F.col("shard").alias(names["shard"]), F.col("byte_start").alias(names["byte_start"])), "shards")
    return stored.join(fitted(at, 160), ["__file", "__row"]).drop("__file", "__row")
