"""Suffix-array dedup: difference-cover blockwise suffix sorting of what may repeat.

Found are all passages of ``min_words`` words or more that occur twice, within or across documents.

1. Every such passage holds a winnowed 16-word anchor (the smallest hash among those of any
   ``min_words`` words) that both places choose alike.  Anchors that occur once are dropped: no
   suffix around them can have a neighbour with a long common prefix.  Equal texts count once here.
2. The words around each remaining anchor (as many as a passage that holds it can reach) are its context.  Equal
   contexts are made one before the exchange, with their smallest id, so that a passage of very many copies is one row.
   They go to the anchor's shard, whose contexts form one text.  The suffixes of its difference-cover sample
   (6 of 31 positions) are ranked first, by prefix doubling.  Then the suffixes are sorted one block at
   a time, a block being those that start at one offset: by their first 31 words, and ties by the
   ranks of the sample suffixes that the cover puts at the same distance from each.  Memory is bounded by the
   shard's text, the sample's ranks and one block.  An anchor with more than HOT different contexts, which would make a
   shard too large, is left to a plain count of its windows over all executors instead, to the same result.
3. Neighbours that share ``min_words`` words repeat; their windows are joined to passages, and those to the places of their context.

Defined cases: words are as in ``tokens``; null or short texts have no passages; null ids are left out;
repeated rows of an id with one text count once, other texts of an id are texts of their own; a document with an equal twin repeats
in full if it has ``min_words`` words; ties keep the smallest id; texts of any length are searched whole; other columns aren't looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fitted
from .tokens import raw, rolling, slices, word_places, words

MIN_WORDS = 50
ANCHOR = 16
#: A perfect difference set: for any two residues mod COVER there is one shift that takes both into it.
COVER, SAMPLE = 31, (1, 5, 11, 24, 25, 27)
#: Contexts that one shard sorts, about.
SHARD_CONTEXTS = 5_000
#: Different contexts of one anchor, beyond which its windows are counted instead.
HOT = 50_000


def anchors(h: np.ndarray, off: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the winnowed anchors of the rows' words."""
    width = min_words - ANCHOR + 1
    fp = rolling(h, ANCHOR)
    n = len(fp) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), fp[:0]
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    inside = np.flatnonzero(row[:n] == row[min_words - 1 : min_words - 1 + n])
    view = sliding_window_view(fp, width)
    at = np.zeros(len(fp), bool)
    for some in np.array_split(inside, max(1, len(inside) // 50_000)):
        at[some + view[some].argmin(axis=1)] = True
    at = np.flatnonzero(at)
    return at, fp[at]


def _anchor_batches(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Rows of anchors and, with no fp, of texts with their number of words."""
    for batch in batches:
        for lo, hi in slices(batch.column(2), 1 << 20):
            h, _, off = words(batch.column(2)[lo:hi])
            ids, th = (batch.column(i)[lo:hi].to_numpy(zero_copy_only=False) for i in (0, 1))
            at, fp = anchors(h, off, min_words)
            row = np.searchsorted(off, at, "right") - 1
            long = np.flatnonzero(np.diff(off) >= min_words)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([fp.view(np.int64), np.zeros(len(long), np.int64)]), mask=np.concatenate([np.zeros(len(fp), bool), np.ones(len(long), bool)])),
                    pa.array(np.concatenate([th[row], th[long]])),
                    pa.array(np.concatenate([ids[row], ids[long]])),
                    pa.array(np.concatenate([at - off[row], np.diff(off)[long]]).astype(np.int32)),
                ],
                ["fp", "th", "doc", "pos"],
            )


def _context_batches(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    left = min_words - ANCHOR
    width = left + min_words
    for batch in batches:
        for lo, hi in slices(batch.column(2), 1 << 19):
            h, _, off = words(batch.column(2)[lo:hi])
            fp = rolling(h, ANCHOR)
            live = batch.column(3)[lo:hi]
            pos = live.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(hi - lo), live.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            ok = pos + off[row] + ANCHOR <= off[row + 1]
            pos, row = pos[ok], row[ok]
            ids, th = (batch.column(k)[lo:hi].to_numpy(zero_copy_only=False)[row] for k in (0, 1))
            for some in np.array_split(np.arange(len(pos)), max(1, len(pos) // 5_000)):
                p, r = pos[some], row[some]
                at = (off[r] + p - left)[:, None] + np.arange(width)
                there = (at >= off[r][:, None]) & (at < off[r + 1][:, None])
                w = np.where(there, h[np.clip(at, 0, len(h) - 1)] >> np.uint64(32), 0).astype(np.uint32) | np.uint32(1)
                w[~there] = 0  # beyond the text
                flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * width), len(w), [None, pa.py_buffer(np.ascontiguousarray(w))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(fp[off[r] + p].view(np.int64)), pa.array(ids[some]), pa.array(th[some]), pa.array(p.astype(np.int32)), flat], ["fp", "doc", "th", "pos", "words"])


def _window_batches(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Every whole window of each context."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 2_000):
            part = batch.slice(lo, 2_000)
            w = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(part.num_rows, -1)
            for o in range(min_words - ANCHOR + 1):
                window = np.ascontiguousarray(w[:, o : o + min_words])
                has = np.flatnonzero((window != 0).all(axis=1))
                flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * min_words), len(has), [None, pa.py_buffer(np.ascontiguousarray(window[has]))]).cast(pa.binary())
                take = lambda k: part.column(k).take(pa.array(has))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([flat, take(0), pa.array(np.full(len(has), o)), take(2), take(3)], ["window", "kind", "o", "least", "copies"])


def _names(rows: np.ndarray) -> np.ndarray:
    """Ranks of the rows in lexicographic order, equal for equal rows."""
    flat = np.ascontiguousarray(rows.astype(">u4")).view(f"V{4 * rows.shape[1]}").ravel()
    return np.unique(flat, return_inverse=True)[1].ravel()


class Text:
    """Contexts side by side, each filled up to a multiple of COVER by words of its own, with the ranks of the sample's suffixes."""

    def __init__(self, contexts: np.ndarray) -> None:
        n, width = contexts.shape
        self.stride = -(-(width + 1) // COVER) * COVER
        t = np.zeros((n, self.stride), np.int32)
        known, ids = np.unique(contexts, return_inverse=True)
        t[:, :width] = ids.reshape(n, width)
        own = np.arange(n * self.stride, dtype=np.int32).reshape(n, self.stride) + len(known)  # like no other
        gap = np.ones((n, self.stride), bool)
        gap[:, :width] = contexts == 0
        t[gap] = own[gap]
        self.words = np.concatenate([t.ravel(), np.arange(2 * COVER, dtype=np.int32) + np.int32(n * self.stride + len(known))])
        self.size = n * self.stride
        self.shift = np.zeros((COVER, COVER), np.int64)
        for a in range(COVER):
            for b in range(COVER):
                self.shift[a, b] = next(d for d in range(COVER) if (a + d) % COVER in SAMPLE and (b + d) % COVER in SAMPLE)
        at = np.arange(self.size + COVER)
        at = at[np.isin(at % COVER, SAMPLE)]
        rank = np.full(self.size + 4 * COVER, -1)
        rank[at] = _names(sliding_window_view(self.words, COVER)[np.minimum(at, len(self.words) - COVER)]) + 1
        step = COVER
        while step < 2 * self.stride:
            pair = np.stack([rank[at], np.where(at + step < len(rank), rank[np.minimum(at + step, len(rank) - 1)], -1)], axis=1)
            _, new = np.unique(pair, axis=0, return_inverse=True)
            rank[at] = new.ravel() + 1
            if new.max() + 1 == len(at):
                break
            step *= 2
        self.rank = rank

    def sort(self, block: np.ndarray) -> np.ndarray:
        """The suffixes of one block in order."""
        first = _names(sliding_window_view(self.words, COVER)[block])
        residue = block % COVER
        own = self.rank[block + self.shift[residue, residue]]
        order = np.lexsort((own, residue, first))  # right within a residue
        block, first, residue = block[order], first[order], residue[order]
        begin = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
        for a, b in zip(begin.tolist(), np.append(begin[1:], len(block)).tolist()):
            if b - a > 1 and (residue[a:b] != residue[a]).any():  # merge residues by the shift that serves both
                def compare(i: int, j: int) -> int:
                    d = self.shift[i % COVER, j % COVER]
                    return int(self.rank[i + d]) - int(self.rank[j + d])

                from functools import cmp_to_key

                block[a:b] = sorted(block[a:b].tolist(), key=cmp_to_key(compare))
        return block


def repeated_windows(docs: np.ndarray, copies: np.ndarray, contexts: np.ndarray, min_words: int, block_size: int = 1 << 13) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, offset, smallest doc) of each window of *min_words* words that occurs twice; a context stands for *copies* places."""
    text = Text(contexts)
    left = min_words - ANCHOR
    full = np.cumsum(contexts == 0, axis=1, dtype=np.int16)
    view = sliding_window_view(text.words, min_words)
    out = []
    for o in range(left + 1):
        has = np.flatnonzero(full[:, o + min_words - 1] == (full[:, o - 1] if o else 0))
        for some in [has] if len(has) <= block_size else _by_first_word(text, has, o, block_size):
            if not len(some):
                continue
            order = text.sort(some * text.stride + o)
            same = np.zeros(len(order), bool)
            for a in range(1, len(order), 4096):
                b = min(len(order), a + 4096)
                same[a:b] = (view[order[a:b]] == view[order[a - 1 : b - 1]]).all(axis=1)
            group = np.cumsum(~same) - 1
            c = order // text.stride
            size = np.bincount(group, copies[c])
            least = np.full(len(size), np.iinfo(np.int64).max)
            np.minimum.at(least, group, docs[c])
            twice = size[group] > 1
            out.append(np.stack([c[twice], np.full(int(twice.sum()), o), least[group][twice]]))
    return tuple(np.concatenate(out, axis=1)) if out else (np.zeros(0, np.int64),) * 3


def _by_first_word(text: Text, contexts: np.ndarray, o: int, block_size: int) -> Iterator[np.ndarray]:
    """Blocks of contexts whose suffixes at offset *o* share ranges of their first word."""
    w = text.words[contexts * text.stride + o]
    order = np.argsort(w, kind="stable")
    contexts, w = contexts[order], w[order]
    begin = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
    a = 0
    while a < len(contexts):
        k = np.searchsorted(begin, a + block_size, "right")
        b = int(begin[k - 1]) if k and begin[k - 1] > a else (int(begin[k]) if k < len(begin) else len(contexts))
        b = len(contexts) if a + block_size >= len(contexts) else b
        yield contexts[a:b]
        a = b


def _sort_shard(t: pa.Table, min_words: int) -> pa.Table:
    """(kind, o, n, first): the passages of each context, from word *o* of it on."""
    w = np.frombuffer(b"".join(t["words"].to_pylist()), np.uint32).reshape(t.num_rows, -1)
    c, (o, n), first = spans_of(*repeated_windows(t["least"].to_numpy(), t["copies"].to_numpy(), w, min_words), min_words)
    return pa.table({"kind": t["kind"].take(pa.array(c)), "o": pa.array(o, pa.int64()), "n": pa.array(n, pa.int64()), "first": pa.array(first, pa.int64())})


def spans_of(c: np.ndarray, o: np.ndarray, first: np.ndarray, min_words: int) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Windows of contexts to (context, (offset, length), smallest doc), one by one for each smallest doc."""
    ids, of = np.unique(first, return_inverse=True)
    key, a, b, first = spans(c * max(1, len(ids)) + of.ravel(), o, o + min_words, first)
    return key // max(1, len(ids)), (a, b - a), first


def spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unions of overlapping or touching spans of each document, with the smallest *first* among them."""
    if not len(doc):
        return doc, start, end, first
    order = np.lexsort((start, doc))
    doc, start, end, first = doc[order], start[order], end[order], first[order]
    change = np.append(True, doc[1:] != doc[:-1])
    group = np.cumsum(change) - 1
    span = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * span) - group * span
    new = change.copy()
    new[1:] |= start[1:] > reach[:-1]
    begin = np.flatnonzero(new)
    return doc[begin], start[begin], np.maximum.reduceat(end, begin), np.minimum.reduceat(first, begin)


def _merge_spans(t: pa.Table) -> pa.Table:
    keys, of = np.unique(np.stack([t["doc"].to_numpy(), t["th"].to_numpy()], axis=1), axis=0, return_inverse=True)
    k, s, e, f = spans(of.ravel(), *(t[c].to_numpy() for c in ("start_word", "end_word", "first")))
    return pa.table({"doc": keys[k, 0], "th": keys[k, 1], "start_word": s, "end_word": e, "first": f})


def _places(docs: DataFrame, min_words: int, hot: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, int]:
    """(spans: doc, th, start_word, end_word, first; copies: th, doc, member, n_words; shards).

    th is the hash of a text.  Spans are of the first document of each text only, one for each *first* of a context; copies name
    the documents of texts that have several, of which *doc* is the first."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text")).where("doc is not null and text is not null")
    found = cut(texts.mapInArrow(partial(_anchor_batches, min_words=min_words), "fp long, th long, doc long, pos int"), "anchors")
    sizes = found.where("fp is null").groupBy("th", "doc").agg(F.max("pos").cast("long").alias("n_words"))
    members = cut(sizes, "sizes")
    twins = cut(members.groupBy("th").agg(F.min("doc").alias("rep"), F.count("*").alias("docs"), F.max("n_words").alias("n_words")).where("docs > 1"), "twins")
    places = found.where("fp is not null")
    ends = [f(c).alias(f"{k}_{c}") for c in ("th", "pos") for k, f in (("low", F.min), ("high", F.max))]
    twice = cut(places.groupBy("fp").agg(*ends).where("low_th <> high_th or low_pos <> high_pos").select("fp"), "twice")  # at two places, copies of a text apart
    live = places.join(fitted(twice, 8), "fp", "left_semi").groupBy("th", "pos").agg(F.min("doc").alias("doc")).groupBy("doc", "th").agg(F.collect_list("pos").alias("live"))
    held = texts.join(cut(live, "live"), ["doc", "th"]).select("doc", "th", "text", "live")  # never broadcast: it grows with the texts
    around = held.mapInArrow(partial(_context_batches, min_words=min_words), "fp long, doc long, th long, pos int, words binary")
    around = cut(around.withColumn("kind", F.unhex(F.md5("words"))), "around")
    place = F.xxhash64("doc", "th", "pos")
    several = F.when(F.min(place) == F.max(place), 1).otherwise(2).cast("long")  # repeated rows are one place
    kinds = around.groupBy("fp", "kind", "words").agg(F.min("doc").alias("least"), several.alias("copies"))
    kinds = cut(kinds, "kinds")
    large = cut(kinds.groupBy("fp").count().where(F.col("count") > hot).select("fp"), "hot")
    n = kinds.count()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // SHARD_CONTEXTS))

    def sort_shard(t: pa.Table) -> pa.Table:
        return _sort_shard(t, min_words)

    cold = kinds.join(fitted(large, 8), "fp", "left_anti").select(F.pmod("fp", F.lit(shards)).alias("shard"), "kind", "words", "least", "copies")
    parts = cold.groupBy("shard").applyInArrow(sort_shard, "kind binary, o long, n long, first long")
    if not large.isEmpty():
        windows = kinds.join(fitted(large, 8), "fp", "left_semi").select("kind", "words", "least", "copies").mapInArrow(partial(_window_batches, min_words=min_words), "window binary, kind binary, o long, least long, copies long")
        windows = cut(windows, "windows")
        again = windows.groupBy("window", "o").agg(F.sum("copies").alias("copies"), F.min("least").alias("first")).where("copies > 1").select("window", "o", "first")
        parts = parts.unionByName(windows.join(again, ["window", "o"]).select("kind", "o", F.lit(min_words).cast("long").alias("n"), "first"))
    parts = cut(parts, "parts")
    start = (F.col("pos") - (min_words - ANCHOR) + F.col("o")).cast("long")
    there = around.select("doc", "th", "pos", "kind").join(fitted(parts, 48), "kind").select("doc", "th", start.alias("start_word"), (start + F.col("n")).alias("end_word"), "first")
    copies = members.drop("n_words").join(twins.select("th", "rep", "n_words"), "th").select("th", F.col("rep").alias("doc"), F.col("doc").alias("member"), "n_words")
    return there, copies, shards


def _merged(spans_: DataFrame, shards: int) -> DataFrame:
    return spans_.withColumn("bucket", F.pmod(F.xxhash64("doc"), F.lit(shards))).groupBy("bucket").applyInArrow(_merge_spans, "doc long, th long, start_word long, end_word long, first long")


def repeats(docs: DataFrame, min_words: int = MIN_WORDS, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start_word, end_word, first_doc_id): the passages that occur more than once, the first occurrences included; first_doc_id is the smallest id that has any window of the passage."""
    there, copies, shards = _places(docs, min_words, hot, id_col, text_col)
    whole = copies.where("member = doc").select("doc", "th", F.lit(0).cast("long").alias("start_word"), F.col("n_words").alias("end_word"), F.col("doc").alias("first"))
    rows = _merged(there.unionByName(whole), shards).join(copies.select("doc", "th", "member"), ["doc", "th"], "left")
    return rows.select(F.coalesce("member", "doc").alias("doc_id"), "start_word", "end_word", F.col("first").alias("first_doc_id"))


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in slices(batch.column(1), 1 << 20):
            text, out = batch.column(1)[lo:hi], []
            at, off = word_places(text)
            buf, base = raw(text)
            for k, spans_ in enumerate(batch.column(2)[lo:hi].to_pylist()):
                data, from_, kept = buf[base[k] : base[k + 1]].tobytes(), 0, []
                places = at[off[k] : off[k + 1]] - base[k]
                for x in sorted(spans_, key=lambda x: x["start_word"]):
                    begin = int(places[x["start_word"]])
                    kept.append(data[from_:begin])
                    from_ = int(places[x["end_word"]]) if x["end_word"] < len(places) else len(data)
                out.append(b"".join([*kept, data[from_:]]).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(out, pa.string()), pa.array([sum(x["end_word"] - x["start_word"] for x in s) for s in batch.column(2)[lo:hi].to_pylist()], pa.int64())], ["doc_id", "text", "n_words_removed"])


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_words_removed) of every row: words in a window that a document with a smaller id has as well are gone, with what follows up to the next word.

    So every window stays where it is first, but for what a still earlier document has.  Repeats within one document stay, and so do rows with a null id or text."""
    there, copies, shards = _places(docs, min_words, hot, id_col, text_col)
    later = copies.where("member <> doc").select(F.col("member").alias("doc"), "th", F.lit(0).cast("long").alias("start_word"), F.col("n_words").alias("end_word"))
    gone = _merged(there.where("first < doc"), shards).drop("first").unionByName(later)
    gone = cut(gone.groupBy("doc", "th").agg(F.collect_list(F.struct("start_word", "end_word")).alias("gone")), "gone")  # of one text
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    joined = rows.join(fitted(gone, 24, ("gone", "gone")), ["doc", "th"], "left")
    changed = joined.where("gone is not null").select("doc", "text", "gone").mapInArrow(_cut_batches, "doc_id long, text string, n_words_removed long")
    same = joined.where("gone is null").select(F.col("doc").alias("doc_id"), "text", F.lit(0).cast("long").alias("n_words_removed"))
    return same.unionByName(changed)
