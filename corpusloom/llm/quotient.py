"""Exact dedup by counting quotient filters.

Every partition puts its texts' 64-bit fingerprints into a counting quotient filter: the
top bits (quotient) index a table whose occupied and run-end bits frame the runs, the rest
(remainder) is stored in sorted runs, with counters.  Filters are cut by the first bits of the
quotient and merged two by two in the order of quotients and remainders, without sorting again and losslessly: the merged counts
are those of all texts.  Texts whose fingerprint counts above one go on to byte verification,
where equal bytes, not equal fingerprints, make a group.  That is a count by text, added up before the exchange, so that
a text of very many copies crosses it once from each task; ids travel with digests only and are never gathered.

Defined cases: null texts and ids are left out; the empty text is a text like any other; repeated
rows of an id with the same text count as one document; ties keep the smallest id; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fitted

#: Quotient bits beyond those that number the slice.
RUN_BITS = 8
REMAINDER_BYTES = 7


def encode(fps: np.ndarray, counts: np.ndarray, slice_bits: int) -> bytes:
    """The filter of one slice from sorted distinct fingerprints: occupied bits, run ends, counted slots, remainders."""
    shift = 64 - slice_bits - RUN_BITS
    quotient = ((fps >> np.uint64(shift)) & np.uint64((1 << RUN_BITS) - 1)).astype(np.int64)
    occupied = np.zeros(1 << RUN_BITS, bool)
    occupied[quotient] = True
    end = np.append(quotient[1:] != quotient[:-1], True) if len(quotient) else np.zeros(0, bool)
    rest = (fps & np.uint64((1 << shift) - 1)).view(np.uint8).reshape(-1, 8)[:, :REMAINDER_BYTES]
    more = counts > 1
    head = np.array([len(fps), int(more.sum())], np.uint32).tobytes()
    return head + np.packbits(occupied).tobytes() + np.packbits(end).tobytes() + np.packbits(more).tobytes() + counts[more].astype(np.uint64).tobytes() + rest.tobytes()


def decode(blob: bytes, number: int, slice_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted fingerprints and their counts of a slice's filter."""
    n, m = np.frombuffer(blob, np.uint32, 2)
    n, m, at, shift = int(n), int(m), 8, 64 - slice_bits - RUN_BITS
    occupied = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, (1 << RUN_BITS) // 8, at)))
    at += (1 << RUN_BITS) // 8
    bits = -(-n // 8)
    end = np.unpackbits(np.frombuffer(blob, np.uint8, bits, at), count=n)
    more = np.unpackbits(np.frombuffer(blob, np.uint8, bits, at + bits), count=n).astype(bool)
    at += 2 * bits
    counts = np.ones(n, np.int64)
    counts[more] = np.frombuffer(blob[at : at + 8 * m], np.uint64)
    rest = np.zeros((n, 8), np.uint8)
    rest[:, :REMAINDER_BYTES] = np.frombuffer(blob, np.uint8, n * REMAINDER_BYTES, at + 8 * m).reshape(n, REMAINDER_BYTES)
    run = np.cumsum(end) - end
    quotient = occupied[run].astype(np.uint64) | np.uint64(number << RUN_BITS)
    return (quotient << np.uint64(shift)) | rest.view(np.uint64).ravel(), counts


def merge_two(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One filter from two: runs of both interleave by their remainders, counts of equal ones add up."""
    (fa, na), (fb, nb) = (a, b) if len(a[0]) >= len(b[0]) else (b, a)
    at = np.searchsorted(fa, fb)
    both = np.zeros(len(fb), bool)
    both[at < len(fa)] = fa[at[at < len(fa)]] == fb[at < len(fa)]
    na = na.copy()
    na[at[both]] += nb[both]
    at, fb, nb = at[~both], fb[~both], nb[~both]
    place = at + np.arange(len(at))
    fps, counts = np.empty(len(fa) + len(fb), np.uint64), np.empty(len(fa) + len(fb), np.int64)
    old = np.ones(len(fps), bool)
    old[place] = False
    fps[place], counts[place], fps[old], counts[old] = fb, nb, fa, na
    return fps, counts


def merge(filters: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One sorted filter from many, merged two by two; counts add up."""
    filters = list(filters) or [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    while len(filters) > 1:
        filters = [merge_two(*filters[k : k + 2]) if k + 1 < len(filters) else filters[k] for k in range(0, len(filters), 2)]
    return filters[0]


def _filter_batches(batches: Iterator[pa.RecordBatch], slice_bits: int) -> Iterator[pa.RecordBatch]:
    fps = [b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) for b in batches]
    if not fps:
        return
    fps, counts = np.unique(np.concatenate(fps), return_counts=True)
    number = (fps >> np.uint64(64 - slice_bits)).astype(np.int64)
    numbers, first = np.unique(number, return_index=True)
    ends = np.append(first[1:], len(fps))
    blobs = [encode(fps[a:b], counts[a:b], slice_bits) for a, b in zip(first, ends)]
    if blobs:
        yield pa.RecordBatch.from_arrays([pa.array(numbers.astype(np.int32)), pa.array(blobs, pa.binary())], ["slice", "filter"])


def _merge_slice(key, t: pa.Table, slice_bits: int) -> pa.Table:
    fps, counts = merge([decode(b, key[0].as_py(), slice_bits) for b in t["filter"].to_pylist()])
    more = counts > 1
    return pa.table({"fp": pa.array(fps[more].view(np.int64)), "n": pa.array(counts[more])})


def repeated_fingerprints(fps: DataFrame) -> DataFrame:
    """(fp, n): the values of the long column of *fps* that occur more than once."""
    parts = fps.rdd.getNumPartitions()
    bits = max(4, math.ceil(math.log2(max(1, parts) * 2)))
    filters = fps.mapInArrow(partial(_filter_batches, slice_bits=bits), "slice int, filter binary")

    def merge_slice(key, t):
        return _merge_slice(key, t, bits)

    return filters.groupBy("slice").applyInArrow(merge_slice, "fp long, n long")


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, first_doc_id, n_copies): each document whose text another has byte for byte, with the smallest id of its group."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null and text is not null").withColumn("fp", F.xxhash64("text"))
    repeated = cut(repeated_fingerprints(texts.select("fp")).select("fp"), "repeated")
    held = texts.join(fitted(repeated, 16), "fp")
    digest = F.sha2("text", 256).alias("digest")
    same = held.groupBy("fp", "text").count().where("count > 1").select("fp", digest)  # equal bytes
    members = cut(held.select("doc_id", "fp", digest).distinct(), "members")
    groups = members.groupBy("fp", "digest").agg(F.min("doc_id").alias("first_doc_id"), F.count("*").alias("n_copies")).where("n_copies > 1")
    groups = cut(groups.join(same, ["fp", "digest"], "left_semi"), "groups")
    return members.join(fitted(groups, 120), ["fp", "digest"]).select("doc_id", "first_doc_id", "n_copies")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """*docs* without the documents whose text one with a smaller id has; rows with a null id or text stay, and so do rows of an id with several texts unless a copy is among them."""
    gone = cut(copies(docs, id_col, text_col).where("doc_id <> first_doc_id").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    return docs.join(fitted(gone, 16), docs[id_col] == F.col("__gone"), "left_anti")
