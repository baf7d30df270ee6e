"""Line dedup by pairwise alignment.

A line counts by the hash of its trimmed text.  Keys pair documents: lines of ``min_chars`` characters
or more, and the shortest runs of lines from each line on and up to each line that have ``min_block``
characters, whatever their lines.  A rare key (in at most ``rare`` documents) pairs all documents that
have it; a more frequent one pairs each with the first document that has it, so pairs stay linear.
No block is lost by that: each line of a shared block of ``min_block`` characters is in such a run within the
block (from the line on or, near the end, up to the block's end), and the run's first holder is earlier too.

Each pair is aligned with patience diff, and aligned common blocks of ``min_block`` characters or more (or the
whole of the later text) are deleted from the later document, the one with the larger id.  So are the runs of
that size that the alignment leaves, as they come twice or in another order.  All pairs align original texts.
A later text under ``min_block`` characters in all pairs by single lines, and by all its lines as one run if one of them has ``min_chars``:
for that, runs of as many lines as any such text has are keys too.

Defined cases: a null text has no lines and stays null; a text of which all is deleted becomes ''; null ids keep their
text; rows of one id are one document for pairing (the first by hash) and get their
deletions by equal text only; ties are impossible, ids differ; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .common import apart, cut, fits
from .tokens import _const, _powers, mix

MIN_CHARS = 20
RARE = 8
MIN_BLOCK = 80


def patience(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """Aligned blocks (start in a, start in b, length): ends that agree, then lines unique on both sides in their longest common order, then what lies between."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        at_a: dict[int, int] = {}
        for i in range(a0, a1):
            at_a[a[i]] = -1 if a[i] in at_a else i
        at_b: dict[int, int] = {}
        for j in range(b0, b1):
            at_b[b[j]] = -1 if b[j] in at_b else j
        unique = [(at_a[x], j) for x, j in at_b.items() if j >= 0 and at_a.get(x, -1) >= 0]
        if not unique:
            continue
        tails: list[int] = []
        places: list[int] = []
        back: list[int] = []
        for k, (i, _) in enumerate(unique):  # in the order of b; longest increasing in a
            lo, hi = 0, len(tails)
            while lo < hi:
                mid = (lo + hi) // 2
                lo, hi = (mid + 1, hi) if tails[mid] < i else (lo, mid)
            if lo == len(tails):
                tails.append(i)
                places.append(k)
            else:
                tails[lo], places[lo] = i, k
            back.append(places[lo - 1] if lo else -1)
        k, chain = places[-1], []
        while k >= 0:
            chain.append(unique[k])
            k = back[k]
        for i, j in chain:  # from the last to the first
            todo.append((i, a1, j, b1))
            a1, b1 = i, j
        todo.append((a0, a1, b0, b1))
    pairs.sort()
    blocks: list[list[int]] = []
    for i, j in pairs:
        if blocks and blocks[-1][0] + blocks[-1][2] == i and blocks[-1][1] + blocks[-1][2] == j:
            blocks[-1][2] += 1
        else:
            blocks.append([i, j, 1])
    return [tuple(x) for x in blocks]


def longest_runs(a: list[int], b: list[int]) -> list[int]:
    """For each line of b, the length of the longest run up to it that a has too (by a suffix automaton of a, in linear time)."""
    follow: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for x in a:
        new = len(follow)
        follow.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and x not in follow[p]:
            follow[p][x] = new
            p = link[p]
        if p >= 0:
            q = follow[p][x]
            if length[q] != length[p] + 1:
                copy = len(follow)
                follow.append(dict(follow[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and follow[p].get(x) == q:
                    follow[p][x] = copy
                    p = link[p]
                link[q] = copy
                q = copy
            link[new] = q
        last = new
    out, at, n = [], 0, 0
    for x in b:
        while at and x not in follow[at]:
            at = link[at]
            n = length[at]
        if x in follow[at]:
            at, n = follow[at][x], n + 1
        out.append(n)
    return out


def deleted(a: list[int], b: list[int], chars: list[int], min_block: int) -> list[int]:
    """Lines of b that go, for blocks aligned with a and for runs that a has elsewhere."""
    out: set[int] = set()
    for _, j, n in patience(a, b):
        if n == len(b) or sum(chars[j : j + n]) >= min_block:
            out.update(range(j, j + n))
    known, start, open_run = set(a), 0, False
    for j in range(len(b) + 1):  # is there a stretch of a's lines that may hold more?
        if j == len(b) or b[j] not in known:
            if j > start and not out.issuperset(range(start, j)) and (j - start == len(b) or sum(chars[start:j]) >= min_block):
                open_run = True
                break
            start = j + 1
    if open_run:
        below = [0]
        for c in chars:
            below.append(below[-1] + c)
        low = len(b)
        for j, n in reversed(list(enumerate(longest_runs(a, b)))):
            if n and (n == len(b) or below[j + 1] - below[j + 1 - n] >= min_block):
                out.update(range(j + 1 - n, min(j + 1, low)))
                low = min(low, j + 1 - n)
    return sorted(out)


def _align_batches(batches: Iterator[pa.RecordBatch], min_block: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, out = batch.column(0).to_pylist(), []
        for k in range(batch.num_rows):
            a, b, c = (batch.column(i)[k].as_py() for i in (1, 2, 3))
            out.append(list(range(len(b))) if a == b else deleted(a, b, c, min_block))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.list_(pa.int32()))], ["b", "gone"])


def run_keys(h: np.ndarray, n: np.ndarray, off: np.ndarray, min_chars: int, min_block: int, whole: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(row, key), once each: lines of *min_chars* characters, the shortest runs of *min_block* from each line on and up to each line, and runs under *min_block* of as many lines as *whole* says, one of them of *min_chars*."""
    size = len(h)
    below = np.concatenate([[0], np.cumsum(n)])
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    at = np.arange(size)
    end = np.searchsorted(below, below[:-1] + min_block, "left")
    start = np.searchsorted(below, below[1:] - min_block, "right") - 1
    on, to, one = end <= off[row + 1], start >= off[row], n >= min_chars
    starts, ends = [at[on], start[to], at[one]], [end[on], at[to] + 1, at[one] + 1]
    long = np.concatenate([[0], np.cumsum(one)])
    for lines in whole:
        a = at[at + lines <= off[row + 1]]
        a = a[(below[a + lines] - below[a] < min_block) & (long[a + lines] > long[a])]
        starts.append(a)
        ends.append(a + lines)
    s, e = np.concatenate(starts), np.concatenate(ends)
    power, inverse = _const(f"lines{size.bit_length()}", lambda: _powers(1 << size.bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power[:size], dtype=np.uint64)])
    k = mix((sums[e] - sums[s]) * inverse[s])
    r = row[s]
    order = np.lexsort((k, r))
    r, k = r[order], k[order]
    first = np.ones(len(r), bool)
    first[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
    return r[first], k[first]


def _key_batches(batches: Iterator[pa.RecordBatch], min_chars: int, min_block: int, whole: tuple[int, ...]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, h, n = batch.column(0), batch.column(1), batch.column(2)
        off = h.offsets.to_numpy().astype(np.int64)
        r, k = run_keys(h.flatten().to_numpy(zero_copy_only=False).view(np.uint64), n.flatten().to_numpy(zero_copy_only=False).astype(np.int64), off - off[0], min_chars, min_block, whole)
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(r)), pa.array(k.view(np.int64))], ["id", "k"])


def line_arrays(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, h, n): hashes and characters of the lines."""
    lines = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"), F.transform(F.split(F.col(text_col), "\n", -1), lambda x: F.trim(x)).alias("lines")).where("id is not null and lines is not null")
    return lines.select("id", "th", F.transform("lines", lambda x: F.xxhash64(x)).alias("h"), F.transform("lines", lambda x: F.length(x)).alias("n"))


def line_pairs(arrays: DataFrame, min_chars: int = MIN_CHARS, rare: int = RARE, min_block: int = MIN_BLOCK) -> DataFrame:
    """(a, b), a < b: documents to align."""
    total = F.aggregate("n", F.lit(0).cast("long"), lambda x, y: x + y)
    short = arrays.where(F.size("n") > 1).where((total < min_block) & F.exists("n", lambda x: x >= min_chars))
    whole = tuple(sorted(x[0] for x in short.select(F.size("n")).distinct().collect()))
    keys = arrays.select("id", "h", "n").mapInArrow(partial(_key_batches, min_chars=min_chars, min_block=min_block, whole=whole), "id long, k long")
    keys = cut(keys, "keys")
    stats = keys.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1")
    held = cut(keys.join(stats, "k"), "held")
    hot = held.where(f"n > {rare} and id > first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    few = held.where(f"n <= {rare}").groupBy("k").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    few = few.select("ids", F.explode("ids").alias("a")).select("a", F.explode("ids").alias("b")).where("a < b")
    return hot.unionByName(few).distinct()


def deletions(docs: DataFrame, min_chars: int = MIN_CHARS, rare: int = RARE, min_block: int = MIN_BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, gone): the line numbers (from 0) that go from each document that loses any."""
    arrays = cut(line_arrays(docs, id_col, text_col), "lines")
    arrays = arrays.groupBy("id").agg(F.min(F.struct("th", "h", "n")).alias("x")).select("id", "x.*")
    arrays = cut(arrays, "arrays")
    pairs = line_pairs(arrays, min_chars, rare, min_block)
    one = arrays.select(F.col("id").alias("a"), F.col("h").alias("ha"))
    other = arrays.select(F.col("id").alias("b"), F.col("h").alias("hb"), "n")
    rows = pairs.join(other, "b").join(one, "a").select("b", "ha", "hb", "n")
    aligned = rows.mapInArrow(partial(_align_batches, min_block=min_block), "b long, gone array<int>").where("size(gone) > 0")
    union = aligned.groupBy("b").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))
    return union.join(arrays.select(F.col("id").alias("b"), "th"), "b").select(F.col("b").alias("id"), "th", "gone")


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, text, n_lines_removed) of every document.  Where the deletions are too many to send everywhere, only the documents that lose lines (and a few others) move."""
    begin = len(common.written)
    gone = cut(deletions(docs, id_col=id_col, text_col=text_col, **options).select(F.col("id").alias("__id"), F.col("th").alias("__th"), F.col("gone").alias("__gone")), "gone")
    common.discard(docs.sparkSession, common.written[begin:-1])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    if fits(gone, 64, ("__gone",)):
        return _without(rows, F.broadcast(gone))
    some, rest = apart(rows, ["doc_id", "th"], gone, ["__id", "__th"])
    return _without(some, gone).unionByName(rest.select("doc_id", "text", F.lit(0).cast("long").alias("n_lines_removed")))


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    joined = rows.join(gone, (F.col("doc_id") == F.col("__id")) & (F.col("th") == F.col("__th")), "left")
    joined = joined.withColumn("__lines", F.when(F.col("__gone").isNotNull(), F.split("text", "\n", -1)))  # referred to twice, so that it isn't moved into the lambda
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__gone")  # by a hash set
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col("__lines"), i)), "\n")
    return joined.select("doc_id", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(kept).alias("text"), F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_lines_removed"))
