"""Benchmark decontamination: a BM25 inverted index of the test items, searched by block-max WAND.

The benchmark is indexed, the training texts are the queries: every window of each text
(twice the longest unit of the index, advancing by half) asks for all items whose BM25
score reaches ``threshold`` of the item's score against itself.  An item longer than
UNIT words is indexed as several units.  Windows in which even the summed maxima of the
terms present can't reach the threshold are passed over for whole batches at a time,
by the terms that matter first; what is left runs block-max WAND over the postings.
A retrieved item counts as leaked when its question and its answer both overlap with
the window and as many words before and after it as the item has, by word 3-grams in each (single words where either has under three); the
answer is the last sentence or line of the item, the question the rest; if either is
under four words, they are the item's second and first half.

The index is shipped to the executors in shards of a bounded size: a benchmark larger
than SHARD_BYTES takes one pass over the texts for each shard.  Document frequencies
and the average length are those of the whole benchmark, whatever the shards.

Defined cases: a null or empty text or item has no words and takes no part; items of a null id are
left out, and so are documents of one in ``leaks`` (``drop_contaminated`` looks at texts only, so it drops them as well); repeated rows of an item are one item, different texts
of one item_id are all indexed and the best of them counts, as does the best of the rows of one doc_id; ties between windows keep the earliest; texts of any length are searched whole; other columns aren't looked at; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import partial
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .tokens import OWN, release, rolling, slices, tidy, words

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.5
UNIT = 128
BLOCK = 16
#: Ranges of units whose maxima are summed for many windows at a time before any search.
RANGES = 64
SHARD_BYTES = 16 << 20


def question_answer(text: str) -> tuple[str, str]:
    """An item's question and answer: all but its last sentence or line, and that; halves if there is but one."""
    own = "".join(f"{chr(a)}-{chr(b)}" for a, b in OWN)
    pieces = lambda p: re.findall(f"[{own}]|[^\\s{own}]+", p)
    parts = [p for p in re.split(r"(?<=[.!?])\s+|(?<=[。！？])\s*|\n+", text) if p.strip()]
    if len(parts) > 1 and len(pieces(parts[-1])) > 3 and sum(len(pieces(p)) for p in parts[:-1]) > 3:
        return "\n".join(parts[:-1]), parts[-1]
    w = pieces(text)
    return " ".join(w[: len(w) // 2]), " ".join(w[len(w) // 2 :])


class Index:
    """Units of items with BM25 impacts, each divided by the unit's score against itself; postings in blocks of BLOCK units with their maxima."""

    def __init__(self, items: list[tuple[int, str]], df: dict[int, int], n: int, average: float, threshold: float, longest: int = 1) -> None:
        self.items, self.threshold = [i for i, _ in items], threshold
        self.need: list[tuple[int, np.ndarray, np.ndarray, int]] = []
        term, unit, impact = [], [], []
        self.unit_item: list[int] = []
        self.longest = longest  # of the whole benchmark's units, so that windows don't depend on the shard
        for k, (_, text) in enumerate(items):
            h = words(pa.array([text]))[0]
            q, a = (words(pa.array([x]))[0] for x in question_answer(text))
            n_gram = 3 if min(len(q), len(a)) >= 3 else 1
            self.need.append((n_gram, np.unique(grams(q, n_gram)), np.unique(grams(a, n_gram)), len(h)))
            pieces = max(1, -(-len(h) // UNIT))
            self.longest = max(self.longest, -(-len(h) // pieces))
            for piece in np.array_split(h, pieces):
                t, tf = np.unique(piece, return_counts=True)
                idf = np.array([np.log(1 + (n - df[x] + 0.5) / (df[x] + 0.5)) for x in t.tolist()])
                w = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(piece) / average))
                term.append(t)
                impact.append(w / max(w.sum(), 1e-9))
                unit.append(np.full(len(t), len(self.unit_item)))
                self.unit_item.append(k)
        term, unit, impact = (np.concatenate(x) if x else np.zeros(0, d) for x, d in ((term, np.uint64), (unit, np.int64), (impact, float)))
        order = np.lexsort((unit, term))
        term, self.units, self.impacts = term[order], unit[order], impact[order]
        self.terms, first = np.unique(term, return_index=True)
        self.first = np.append(first, len(term))
        self.maxima = np.maximum.reduceat(self.impacts, first) if len(term) else np.zeros(0)
        ranges = min(RANGES, max(1, len(self.unit_item)))
        self.range_max = np.zeros((len(self.terms), ranges), np.float32)
        np.maximum.at(self.range_max, (np.repeat(np.arange(len(self.terms)), np.diff(self.first)), self.units * ranges // max(1, len(self.unit_item))), self.impacts.astype(np.float32))
        slot = np.zeros(1 << 20, np.int32)
        slot[(self.terms & np.uint64((1 << 20) - 1)).astype(np.int64)] = 1
        self.filter = slot.astype(bool)
        self.postings = [(self.units[a:b].tolist(), self.impacts[a:b].tolist()) for a, b in zip(self.first[:-1], self.first[1:])]
        self.blocks = [[(u[min(len(u), i + BLOCK) - 1], max(w[i : i + BLOCK])) for i in range(0, len(u), BLOCK)] for u, w in self.postings]
        self.ranges = [-(-r * len(self.unit_item) // ranges) for r in range(ranges + 1)]

    def lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, term numbers) of the words that the index has."""
        at = np.flatnonzero(self.filter[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if not len(at) or not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        t = np.minimum(np.searchsorted(self.terms, h[at]), len(self.terms) - 1)
        hit = self.terms[t] == h[at]
        return at[hit], t[hit]

    def search(self, query: list[int], low: int = 0, high: int = 1 << 62) -> dict[int, float]:
        """Block-max WAND: every unit from *low* up to *high* whose impacts over the query's distinct terms sum to the threshold or more."""
        found, least = {}, self.threshold - 1e-9
        cursors = []  # [unit, place, units, impacts, blocks, block, maximum]
        for t in query:
            units, impacts = self.postings[t]
            i = bisect_left(units, low)
            if i < len(units) and units[i] < high:
                cursors.append([units[i], i, units, impacts, self.blocks[t], 0, self.maxima[t]])
        while cursors:
            cursors.sort(key=itemgetter(0))
            bound, p = 0.0, -1
            for k, c in enumerate(cursors):
                bound += c[6]
                if bound >= least:
                    p = k
                    break
            if p < 0:
                break
            pivot = cursors[p][0]
            while p + 1 < len(cursors) and cursors[p + 1][0] == pivot:
                p += 1
            bound, skip = 0.0, cursors[p + 1][0] if p + 1 < len(cursors) else 1 << 62
            for c in cursors[: p + 1]:  # the maxima of the blocks that hold the pivot
                block, i = c[4], c[5]
                while i < len(block) and block[i][0] < pivot:
                    i += 1
                c[5] = i
                if i < len(block):
                    bound += block[i][1]
                    skip = min(skip, block[i][0] + 1)
            if bound < least:
                target = max(skip, pivot + 1)
            elif cursors[0][0] == pivot:
                score = sum(c[3][c[1]] for c in cursors[: p + 1])
                if score >= least:
                    found[pivot] = score
                target = pivot + 1
            else:
                target = pivot
            over = False
            for c in cursors[: p + 1]:
                if c[0] < target:
                    units = c[2]
                    i = c[1] = bisect_left(units, target, c[1])
                    c[0] = units[i] if i < len(units) else high
                    over |= c[0] >= high
            if over:
                cursors = [c for c in cursors if c[0] < high]
        return found


def grams(h: np.ndarray, n: int = 3) -> np.ndarray:
    return rolling(h, n)


def share(need: np.ndarray, there: np.ndarray) -> float:
    """Part of *need* that is *there*; all of it if nothing is needed."""
    return float(np.isin(need, there).mean()) if len(need) else 1.0


def scan(h: np.ndarray, off: np.ndarray, index: Index, overlap: float) -> Iterator[tuple[int, int, float, float, float, int]]:
    """(row, item number, score, question overlap, answer overlap, first word) of the items that leaked into the rows' words."""
    step = index.longest
    at, term = index.lookup(h)
    if not len(at):
        return
    row = np.searchsorted(off, at, "right") - 1
    chunk0 = np.concatenate([[0], np.cumsum(np.diff(off) // step + 1)])
    chunk = chunk0[row] + (at - off[row]) // step  # a window is a chunk of the text and the next one
    size, least = max(1, len(index.terms)), index.threshold - 1e-9
    key = np.unique(chunk * size + term)
    c, t = key // size, key % size
    most = np.bincount(c, index.maxima[t], chunk0[-1] + 1)
    live = np.flatnonzero(most[:-1] + most[1:] >= least)
    last_of_row = np.zeros(chunk0[-1] + 1, bool)
    last_of_row[chunk0[1:] - 1] = True
    sure = []
    for some in np.array_split(live, max(1, len(live) // 500)):  # the summed maxima of each range of units
        a, z = np.searchsorted(c, some), np.searchsorted(c, np.where(last_of_row[some], some + 1, some + 2))
        n = z - a
        w = np.repeat(np.arange(len(some)), n)
        k = np.unique(w * size + t[np.repeat(a, n) + np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n)])
        w, k = k // size, k % size
        if len(k):
            at_w, begin = np.unique(w, return_index=True)
            at_w, r = at_w[(over := np.nonzero(np.add.reduceat(index.range_max[k], begin, axis=0) >= least - 1e-4))[0]], over[1]
            sure.append(np.stack([some[at_w], r]))
    live, ranges = np.concatenate(sure, axis=1) if sure else np.zeros((2, 0), np.int64)
    lo, hi = np.searchsorted(chunk, live), np.searchsorted(chunk, live + 2)
    last = chunk0[1:] - 1
    best: dict[tuple[int, int], tuple] = {}
    for w, i, j, z in zip(live.tolist(), lo.tolist(), hi.tolist(), ranges.tolist()):
        r = int(np.searchsorted(chunk0, w, "right")) - 1
        if w == last[r]:
            j = int(np.searchsorted(chunk[i:j], w + 1)) + i
        query = np.unique(term[i:j])
        found = index.search(query.tolist(), index.ranges[z], index.ranges[z + 1])
        if not found:
            continue
        a = int(off[r] + (w - chunk0[r]) * step)
        there, short = {}, {}
        for u, score in found.items():
            k = index.unit_item[u]
            n, question, answer, length = index.need[k]
            if (n, length) not in there:  # the window, and what the item may reach beyond it
                there[n, length] = grams(h[max(int(off[r]), a - length) : min(a + 2 * step + length, int(off[r + 1]))], n)
            q, s = share(question, there[n, length]), share(answer, there[n, length])
            if q >= overlap and s >= overlap and score > short.get(k, (0,))[0] + 1e-9:
                short[k] = (score, q, s, a - int(off[r]))
        for k, x in short.items():
            if (r, k) not in best or x[0] > best[r, k][0] + 1e-9:
                best[r, k] = x
    for (r, k), x in best.items():
        yield r, k, *x


def _scan_batches(batches: Iterator[pa.RecordBatch], index: Index, overlap: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in slices(batch.column(1), 1 << 20):
            h, _, off = words(batch.column(1)[lo:hi])
            best: dict[tuple[int, int], tuple] = {}
            for r, k, *x in scan(h, off, index, overlap):  # of the texts of an item the best
                if (at := (r, index.items[k])) not in best or (-round(x[0], 9), x[3]) < (-round(best[at][0], 9), best[at][3]):
                    best[at] = tuple(x)
            if best:
                r, item = zip(*best)
                rest = list(zip(*best.values()))
                ids = batch.column(0)[lo:hi].take(pa.array(r))
                yield pa.RecordBatch.from_arrays([ids, pa.array(item, pa.int64()), *(pa.array(x) for x in rest[:3]), pa.array(rest[3], pa.int64())], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "start_word"])


def _term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h, _, off = words(batch.column(1))
        row = np.repeat(np.arange(len(off) - 1), np.diff(off))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for r in range(len(off) - 1):
            t = np.unique(h[off[r] : off[r + 1]])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(t), ids[r])), pa.array(t.view(np.int64)), pa.array(np.full(len(t), int((row == r).sum())))], ["item", "term", "words"])


def indexes(benchmark: DataFrame, threshold: float = THRESHOLD, item_col: str = "item_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> Iterator[Index]:
    """The index of the benchmark's distinct (item, text), in shards of about *shard_bytes* of text."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text")).where("item is not null and length(text) > 0").distinct()
    items = cut(items.withColumn("entry", F.xxhash64("item", F.sha2("text", 256))), "items")
    terms = cut(items.select("entry", "text").mapInArrow(_term_batches, "item long, term long, words long"), "terms")
    size = items.agg(F.sum(F.octet_length("text")).alias("b")).head()["b"] or 0
    total = terms.groupBy("item").agg(F.max("words").alias("w")).agg(F.count("*").alias("n"), F.avg("w").alias("a"), F.max(F.ceil(F.col("w") / F.ceil(F.col("w") / UNIT))).alias("longest")).head()
    shards = max(1, -(-size // shard_bytes))
    frequency = terms.groupBy("term").agg(F.count("*").alias("n"))
    if shards > 1:
        frequency = cut(frequency, "df")
    for s in range(shards):
        rows = items.where(F.pmod(F.xxhash64("entry"), F.lit(shards)) == s).orderBy("item", "text").collect()  # bounded by shard_bytes, about
        mine = frequency if shards == 1 else frequency.join(terms.where(F.pmod(F.xxhash64("item"), F.lit(shards)) == s).select("term").distinct(), "term")
        df = {r["term"] % (1 << 64): r["n"] for r in mine.collect()}
        yield Index([(r["item"], r["text"]) for r in rows if len(words(pa.array([r["text"]]))[0])], df, total["n"], total["a"] or 1.0, threshold, total["longest"] or 1)


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, start_word): each leaked item of each document, at its best window."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    out, columns = None, "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, start_word long"
    for index in indexes(benchmark, threshold, item_col, text_col, shard_bytes):
        part = texts.mapInArrow(tidy(partial(_scan_batches, index=index, overlap=overlap)), columns)
        out = part if out is None else out.unionByName(part)
    best = F.max_by(F.struct("score", "question_overlap", "answer_overlap", "start_word"), F.struct(F.round("score", 9), -F.col("start_word")))  # of rows of one id, and of an item's texts in several shards
    return out.groupBy("doc_id", "item_id").agg(best.alias("x")).select("doc_id", "item_id", "x.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, text_col: str = "text", item_col: str = "item_id", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """*docs* without the rows whose text holds a benchmark item; the texts are searched where they are, without a join."""
    for index in indexes(benchmark, threshold, item_col, "text", shard_bytes):
        docs = docs.where(_clean(index, overlap)(F.col(text_col)))
    return docs


def _clean(index: Index, overlap: float):
    @F.arrow_udf("boolean")
    def clean(text: pa.Array) -> pa.Array:
        out = np.ones(len(text), bool)
        for lo, hi in slices(text, 1 << 20):
            h, _, off = words(text[lo:hi])
            out[[lo + r for r, *_ in scan(h, off, index, overlap)]] = False
        release()
        return pa.array(out)

    return clean
