"""SimHash near-dedup by vantage-point trees.

Each text gets a 128-bit SimHash of its set of word pairs (the first word is paired with
the text's start), where a pair of 7 bytes or more weighs double.  Two documents are near copies if their fingerprints differ in at most ``radius``
bits.  The search is exact.  Among whole fingerprints distances concentrate so much that
triangle bounds prune nothing, hence the bits are dealt to blocks: of two fingerprints
within the radius, at least one block differs in ``radius // blocks`` bits or fewer.

Every block has vantage-point trees, of one kind for shards and for the search inside one.  A node takes one of
its own points as vantage point and splits its points at the median distance to it.  Distances are measured in the first
few bits (GROUP) in which the node's points still differ.  By the triangle inequality a query at distance d from the vantage point
is at least ``d - median`` bits from what lies inside, or ``median + 1 - d`` from what lies outside; bounds in different bits
add up along a branch, and it is pruned when they exceed the radius.

The tree over a sample (whose size follows the number of shards) names the shards: a fingerprint lives in the leaf it falls into
and visits the leaves that its ball overlaps, only those before its own, since overlap is mutual.  A leaf of one value that holds
too many rows is dealt to parts by id, which are visited likewise.  In a shard, the rows that share a value of the block and lie within half the radius
of one of them are a ball: the triangle inequality makes them copies of each other without comparing pairs,
and two balls whose centres are near are linked by one edge.  What the tree finds is compared in all 128 bits.

Defined cases: a null or empty text, or one without words, has no fingerprint and is
nobody's copy; rows of one doc_id are one document (the first text by hash counts); a
null doc_id is left out (``drop_near_copies`` keeps its rows); ties keep the smallest doc_id; an empty table gives no groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fitted
from .tokens import mix, release, slices, tidy, words

BITS = 128
RADIUS = 23
#: Of so many fingerprints or fewer, so many blocks: more fingerprints take wider ones, which compare fewer pairs.  The pairs found are the same.
BLOCKS = ((1 << 24, 8), (1 << 62, 6))
#: Fingerprints that live in one shard, about; those that visit it are some times as many.
SHARD_ROWS = 500_000
#: Sampled values for each shard.
SAMPLE = 64
LEAF = 8
#: Bits in which a node measures its distances.
GROUP = 2
#: Rows of one value from which on balls are looked for, and of which a ball is made.
CELL, BALL = 64, 16
_SALTS = (0x243F6A8885A308D3, 0x13198A2E03707344)


def fingerprints(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(high bits, low bits, words) of each text."""
    h, length, off = words(arr)
    rows = len(off) - 1
    count = np.diff(off)
    row = np.repeat(np.arange(rows, dtype=np.int64), count)
    before, lead = np.zeros(len(h), np.uint64), np.zeros(len(h), np.int64)
    before[1:], lead[1:] = h[:-1], length[:-1]
    begin = off[:-1][count > 0]
    before[begin], lead[begin] = 0, 0
    pair = mix(before * np.uint64(3) + h)
    _, at = np.unique(pair ^ mix(row.astype(np.uint64), 0x452821E638D01377), return_index=True)
    h, row, weight = pair[at], row[at], np.where((length + lead)[at] >= 7, 2.0, 1.0)
    sign = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1) * 2.0 - 1
    out = []
    for salt in _SALTS:
        b = mix(h, salt).view(np.uint8).reshape(-1, 8)
        total = np.empty((rows, 64))
        for j in range(8):
            total[:, 8 * j : 8 * j + 8] = np.bincount(row * 256 + b[:, j], weight, rows * 256).reshape(rows, 256) @ sign
        out.append(np.packbits(total > 0, axis=1).view(np.uint64).ravel())
    return out[0], out[1], count


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in slices(batch.column(1), 1 << 20):
            a, b, n = fingerprints(batch.column(1)[lo:hi])
            keep = n > 0
            ids = batch.column(0)[lo:hi].filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([ids, pa.array(a[keep].view(np.int64)), pa.array(b[keep].view(np.int64))], ["id", "h0", "h1"])


def block_values(h: np.ndarray, blocks: int) -> np.ndarray:
    """(rows, 2) 64-bit halves to (blocks, rows) values of the blocks' bits."""
    edges = np.linspace(0, BITS, blocks + 1).round().astype(int)
    out = np.empty((blocks, len(h)), np.uint64)
    for k in range(blocks):
        lo, hi = int(edges[k]), int(edges[k + 1])
        v = np.zeros(len(h), np.uint64)
        for half in (0, 1):
            a, b = max(lo, 64 * half) - 64 * half, min(hi, 64 * half + 64) - 64 * half
            if a < b:
                part = (h[:, half] >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)
                v |= part << np.uint64(64 * half + a - lo)
        out[k] = v
    return out


class Level:
    """The nodes of one level of a tree: a leaf has no children."""

    def __init__(self, first: np.ndarray, last: np.ndarray) -> None:
        n = len(first)
        self.first, self.last = first, last
        self.vantage, self.mask, self.mu = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, np.int8)
        self.child = np.full((n, 2), -1, np.int64)
        self.low, self.high = np.zeros((n, 2), np.int8), np.full((n, 2), GROUP, np.int8)
        self.fresh = np.ones(n, bool)  # measures in other bits than the node above
        self.number = np.full(n, -1, np.int64)


class Tree:
    """A vantage-point tree over block values, each node with a vantage point of its own and the median distance to it.

    Equal values stay together, so a leaf has *leaf* points at most, or one value.  *tight* keeps, for each
    child, the range of its points' distances; without, whatever may come to lie there.
    """

    def __init__(self, v: np.ndarray, leaf: int = LEAF, tight: bool = True, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.order = np.arange(len(v))
        self.levels: list[Level] = []
        first, last, before = np.array([0]), np.array([len(v)]), np.zeros(1, np.uint64)
        while len(first):
            level = Level(first, last)
            self.levels.append(level)
            big = np.flatnonzero(last - first > leaf)
            if not len(big):
                break
            n = last[big] - first[big]
            begin = np.cumsum(n) - n
            node = np.repeat(np.arange(len(big)), n)
            at = np.repeat(first[big] - begin, n) + np.arange(len(node))
            x = v[self.order[at]]
            differ = np.bitwise_or.reduceat(x ^ x[begin][node], begin)
            some = differ != 0
            if not some.any():
                break
            keep = some[node]
            big, n, x, at, differ = big[some], n[some], x[keep], at[keep], differ[some]
            begin = np.cumsum(n) - n
            node = np.repeat(np.arange(len(big)), n)
            lowest = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype(np.uint64)
            mask = np.uint64((1 << GROUP) - 1) << (lowest // np.uint64(GROUP) * np.uint64(GROUP))
            vantage = x[begin + (rng.random(len(big)) * n).astype(np.int64)]
            d = np.bitwise_count((x ^ vantage[node]) & mask[node]).astype(np.int64)
            count = np.bincount(node * (GROUP + 1) + d, minlength=len(big) * (GROUP + 1)).reshape(-1, GROUP + 1)
            inside = np.cumsum(count, axis=1)[:, :-1]
            mu = np.abs(2 * inside - n[:, None]).argmin(axis=1)  # the median, or what comes nearest to halves
            size = inside[np.arange(len(big)), mu]
            outer = (d > mu[node]).astype(np.int64)
            self.order[at] = self.order[at][np.argsort(node * 2 + outer, kind="stable")]
            level.vantage[big], level.mask[big], level.mu[big], level.fresh[big] = vantage, mask, mu, mask != before[big]
            level.child[big] = np.arange(2 * len(big)).reshape(-1, 2)
            level.high[big, 0], level.low[big, 1] = mu, mu + 1
            if tight:
                for side, there in ((0, np.arange(GROUP + 1) <= mu[:, None]), (1, np.arange(GROUP + 1) > mu[:, None])):
                    there &= count > 0
                    level.low[big, side], level.high[big, side] = there.argmax(axis=1), GROUP - there[:, ::-1].argmax(axis=1)
            middle = first[big] + size
            first, last = np.column_stack([first[big], middle]).ravel(), np.column_stack([middle, last[big]]).ravel()
            before = np.repeat(mask, 2)
        self.leaves = 0
        for level in self.levels:
            ends = level.child[:, 0] < 0
            level.number[ends] = self.leaves + np.arange(ends.sum())
            self.leaves += int(ends.sum())

    def home(self, q: np.ndarray) -> np.ndarray:
        """The number of the leaf that each value falls into."""
        out, at, node = np.full(len(q), -1, np.int64), np.arange(len(q)), np.zeros(len(q), np.int64)
        for level in self.levels:
            end = level.child[node, 0] < 0
            out[at[end]] = level.number[node[end]]
            at, node = at[~end], node[~end]
            outer = np.bitwise_count((q[at] ^ level.vantage[node]) & level.mask[node]) > level.mu[node]
            node = level.child[node, outer.astype(np.int64)]
        return out

    def reach(self, q: np.ndarray, radius: int, piece: int = 200_000) -> Iterator[tuple[np.ndarray, Level, np.ndarray]]:
        """(query, level, leaf of it): the leaves that balls of *radius* bits around the values may overlap.

        Queries go down in pieces, and a piece that visits too many nodes is split, so that memory stays bounded.
        """
        n = len(q)
        todo = [(0, np.arange(n), np.zeros(n, np.int64), np.full(n, radius, np.int8), np.zeros(n, np.int8))]
        while todo:
            depth, query, node, left, cost = todo.pop()
            if len(query) > piece:
                todo.extend((depth, *(x[a : a + piece] for x in (query, node, left, cost))) for a in range(0, len(query), piece))
                continue
            level = self.levels[depth]
            end = level.child[node, 0] < 0
            if end.any():
                yield query[end], level, node[end]
                query, node, left, cost = query[~end], node[~end], left[~end], cost[~end]
            if not len(query):
                continue
            fresh = level.fresh[node]
            left = np.where(fresh, left - cost, left)  # what other bits took is gone
            cost = np.where(fresh, np.int8(0), cost)
            d = np.bitwise_count((q[query] ^ level.vantage[node]) & level.mask[node]).astype(np.int8)
            parts = []
            for side in (0, 1):
                c = np.maximum(cost, np.maximum(level.low[node, side] - d, d - level.high[node, side]))
                go = c <= left
                parts.append((query[go], level.child[node[go], side], left[go], c[go]))
            todo.append((depth + 1, *(np.concatenate(x) for x in zip(*parts))))


class Shards:
    """The shards of one block: leaves of a tree over sampled values, those of too many rows in parts."""

    def __init__(self, sample: np.ndarray, rows: int, shards: int, shard_rows: int, seed: int) -> None:
        self.tree = Tree(sample, max(1, 3 * len(sample) // (2 * shards)), tight=False, seed=seed)
        size = np.bincount(self.tree.home(sample), minlength=self.tree.leaves) * (rows / max(1, len(sample)))
        self.parts = np.maximum(1, np.ceil(size / (2 * shard_rows))).astype(np.int64) if len(sample) >= 2 * shards else np.ones(self.tree.leaves, np.int64)
        self.base = np.cumsum(self.parts) - self.parts
        self.count = int(self.parts.sum())

    def visits(self, v: np.ndarray, ids: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, shard, at home) for each shard that a row's ball may reach, none beyond its home."""
        home = self.tree.home(v)
        part = mix(ids.view(np.uint64)) % self.parts[home].astype(np.uint64)
        found = [(query, level.number[node]) for query, level, node in self.tree.reach(v, radius)]
        row, leaf = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        keep = leaf <= home[row]
        row, leaf = row[keep], leaf[keep]
        own = leaf == home[row]
        n = np.where(own, part[row].astype(np.int64) + 1, self.parts[leaf])
        k = np.repeat(np.arange(len(row)), n)
        p = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
        return row[k], self.base[leaf[k]] + p, own[k] & (p == part[row[k]].astype(np.int64))


def _visit_batches(batches: Iterator[pa.RecordBatch], plans: list[Shards], radius: int) -> Iterator[pa.RecordBatch]:
    most = max(p.count for p in plans)
    for whole in batches:
        for lo in range(0, whole.num_rows, 20_000):
            batch = whole.slice(lo, 20_000)
            h = np.stack([batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (1, 2)], axis=1)
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for k, (plan, values) in enumerate(zip(plans, block_values(h, len(plans)))):
                row, shard, home = plan.visits(values, ids, radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((k * most + shard).astype(np.int64)), pa.array(home), pa.array(ids[row]), pa.array(h[row, 0].view(np.int64)), pa.array(h[row, 1].view(np.int64))],
                    ["shard", "home", "id", "h0", "h1"],
                )


def products(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, step: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(k, i, j) for all i of the range of n_a[k] from a[k] on and j of that of n_b[k] from b[k] on, in pieces."""
    size = n_a * n_b
    ends = np.cumsum(size)
    begins = ends - size
    for lo in range(0, int(ends[-1]) if len(ends) else 0, step):
        hi = min(int(ends[-1]), lo + step)
        k = np.arange(np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi - 1, "right") + 1)
        k = np.repeat(k, np.minimum(ends[k], hi) - np.maximum(begins[k], lo))
        r = np.arange(lo, hi) - begins[k]
        of_a = r // n_b[k]
        yield k, a[k] + of_a, b[k] + r - of_a * n_b[k]


def tree_join(q: np.ndarray, v: np.ndarray, radius: int, tree: Tree | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (i, j) with q[i] and v[j] within *radius* bits; whole branches are pruned by triangle bounds."""
    tree = tree or Tree(v)
    for query, level, node in tree.reach(q, radius):
        for k, _, j in products(query, np.ones(len(query), np.int64), level.first[node], level.last[node] - level.first[node]):
            i, j = query[k], tree.order[j]
            near = np.flatnonzero(np.bitwise_count(q[i] ^ v[j]) <= radius)
            yield i[near], j[near]


class Prints:
    """Fingerprints as two columns."""

    def __init__(self, h: np.ndarray) -> None:
        self.a, self.b = (np.ascontiguousarray(h[:, k]) for k in (0, 1))

    def within(self, i: np.ndarray, j: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(i, j, distance) of the pairs at *most* bits apart."""
        d = np.bitwise_count(self.a[i] ^ self.a[j])
        near = np.flatnonzero(d <= most)
        i, j, d = i[near], j[near], d[near].astype(np.int32)
        d += np.bitwise_count(self.b[i] ^ self.b[j])
        near = np.flatnonzero(d <= most)
        return i[near], j[near], d[near]


class Cells:
    """Rows (or balls of rows) by block value: distinct values, and the range of each in *at*."""

    def __init__(self, value: np.ndarray, at: np.ndarray) -> None:
        self.values, of = np.unique(value[at], return_inverse=True)
        self.at = at[np.argsort(of, kind="stable")]
        self.n = np.bincount(of, minlength=len(self.values))
        self.start = np.cumsum(self.n) - self.n


def met(value: np.ndarray, rows: np.ndarray, live: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j), once each: the pairs of *rows* within *radius* bits of *value*, of which j is *live*."""
    own, guests = Cells(value, rows[live[rows]]), Cells(value, rows[~live[rows]])
    tree = Tree(own.values)
    for q, mine in ((guests, False), (own, True)):
        for qi, vi in tree_join(q.values, own.values, radius, tree):
            if mine:
                less = own.values[qi] < own.values[vi]
                qi, vi = qi[less], vi[less]
            for _, i, j in products(q.start[qi], q.n[qi], own.start[vi], own.n[vi]):
                yield q.at[i], own.at[j]
    for _, i, j in products(own.start, own.n, own.start, own.n):
        below = i < j
        yield own.at[i[below]], own.at[j[below]]


def balls(value: np.ndarray, prints: Prints, radius: int, seed: int = 3) -> np.ndarray:
    """For each row the row whose ball (of half the radius, among the rows of its value) it is in, or itself."""
    rng, centre = np.random.default_rng(seed), np.arange(len(value))
    cells = Cells(value, centre)
    for k in np.flatnonzero(cells.n >= CELL).tolist():
        rest = cells.at[cells.start[k] : cells.start[k] + cells.n[k]]
        misses = 0
        while len(rest) >= CELL and misses < 4:
            c = rest[rng.integers(len(rest))]
            inside, _, _ = prints.within(rest, np.full(len(rest), c), radius // 2)
            if len(inside) >= BALL:
                centre[inside] = c
                rest = np.setdiff1d(rest, inside)
            else:
                misses += 1
    return centre


def shard_pairs(ids: np.ndarray, home: np.ndarray, h: np.ndarray, block: int, blocks: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, distance), a < b, for the pairs of a home row with any row of the shard within *radius*."""
    prints = Prints(h)
    for i, j in met(block_values(h, blocks)[block], np.arange(len(ids)), home, radius // blocks):
        i, j, d = prints.within(i, j, radius)
        yield np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j]), d


def shard_edges(ids: np.ndarray, home: np.ndarray, h: np.ndarray, block: int, blocks: int, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(a, b): near pairs that connect all that those of shard_pairs connect; a ball's members stand for each other."""
    prints, rows, value = Prints(h), np.arange(len(ids)), block_values(h, blocks)[block]
    centre = balls(value, prints, radius)
    inner = np.flatnonzero(centre != rows)
    yield ids[inner], ids[centre[inner]]
    live = np.zeros(len(ids), bool)
    live[centre[home]] = True  # a ball with a row that lives here, or such a row
    wide = np.zeros(len(ids), np.int32)
    members = Cells(centre, rows) if len(inner) else None
    if members:
        wide[members.values[members.n > 1]] = radius // 2
    for i, j in met(value, np.flatnonzero(centre == rows), live, radius // blocks):
        i, j, d = prints.within(i, j, radius + 2 * int(wide.max()))
        near = d <= radius
        yield ids[i[near]], ids[j[near]]
        ring = ~near & (d <= radius + wide[i] + wide[j])  # what the triangle bound leaves open
        if ring.any():
            a, b = np.searchsorted(members.values, i[ring]), np.searchsorted(members.values, j[ring])
            for _, x, y in products(members.start[a], members.n[a], members.start[b], members.n[b]):
                x, y, _ = prints.within(members.at[x], members.at[y], radius)
                yield ids[x], ids[y]


class Forest:
    """Union-find over ids that keeps the smallest id as root."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        r = x
        while (p := up.get(r, r)) != r:
            r = p
        while (p := up.get(x, x)) != r:
            up[x] = r
            x = p
        return r

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def edges(self) -> tuple[list[int], list[int]]:
        below = list(self.up)
        return [self.root(x) for x in below], below


def _search_shard(key, t: pa.Table, blocks: int, most: int, radius: int, forest: bool) -> pa.Table:
    block = key[0].as_py() // most
    ids, home = t["id"].to_numpy(), t["home"].to_numpy()
    h = np.stack([t[c].to_numpy().view(np.uint64) for c in ("h0", "h1")], axis=1)
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("distance", pa.int32())])
    if forest:
        f = Forest()
        for a, b in shard_edges(ids, home, h, block, blocks, radius):
            for x, y in zip(a.tolist(), b.tolist()):
                f.join(x, y)
        a, b = f.edges()
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(len(a), pa.int32())], schema=kind)
    parts = [pa.table([a, b, d.astype(np.int32)], schema=kind) for a, b, d in shard_pairs(ids, home, h, block, blocks, radius) if len(a)]
    return pa.concat_tables(parts) if parts else kind.empty_table()


def fingerprint_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h0, h1), written to the shared folder; one row for each document that has words."""
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    prints = cut(text.mapInArrow(tidy(_fingerprint_batches), "id long, h0 long, h1 long"), "prints")
    return prints.groupBy("id").agg(F.min(F.struct("h0", "h1")).alias("h")).select("id", "h.h0", "h.h1")


def _search(prints: DataFrame, radius: int, blocks: int | None, forest: bool, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, DataFrame]:
    """(first id and copies of each fingerprint, near: edges between first ids)."""
    spark = prints.sparkSession
    same = cut(prints.groupBy("h0", "h1").agg(F.min("id").alias("id"), F.count("*").alias("n")), "same")
    n = same.count()
    blocks = blocks or next(b for most, b in BLOCKS if n <= most)
    shards = max(-(-n // shard_rows), -(-2 * spark.sparkContext.defaultParallelism // blocks))
    rows = same.select("h0", "h1").limit(SAMPLE * shards).collect()  # rows lie by hash, so the first are a sample; it shapes shards only
    h = np.array([tuple(r) for r in rows], np.int64).reshape(-1, 2).view(np.uint64)
    values = block_values(h, blocks)
    plans = [Shards(values[k], n, shards, shard_rows, 7 + k) for k in range(blocks)]
    visits = same.select("id", "h0", "h1").mapInArrow(tidy(partial(_visit_batches, plans=plans, radius=radius // blocks)), "shard long, home boolean, id long, h0 long, h1 long")
    most = max(p.count for p in plans)

    def search_shard(key, t):
        found = _search_shard(key, t, blocks, most, radius, forest)
        release()
        return found

    return same, visits.groupBy("shard").applyInArrow(search_shard, "a long, b long, distance int")


def near_pairs(docs: DataFrame, radius: int = RADIUS, blocks: int | None = None, **cols: str) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): every pair (a, b, distance) of first ids of fingerprints within *radius* bits, a < b, and
    (doc_id, first_doc_id) of every document that has a fingerprint.  Copies share a first id and aren't expanded into pairs."""
    prints = cut(fingerprint_table(docs, **cols), "ids")
    same, near = _search(prints, radius, blocks, forest=False)
    return near.distinct(), _members(prints, same)


def _members(prints: DataFrame, same: DataFrame) -> DataFrame:
    return prints.join(same.select("h0", "h1", F.col("id").alias("first")), ["h0", "h1"]).select(F.col("id").alias("doc_id"), F.col("first").alias("first_doc_id"))


def _forest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    f = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            f.join(a, b)
    a, b = f.edges()
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def components(edges: DataFrame, local_edges: int = 2_000_000) -> DataFrame:
    """(id, root) for every id of *edges* (a, b): root is the smallest id that it is connected to.

    Up to *local_edges* edges go to one union-find task; more take large-star and
    small-star rounds over all executors, to the same result.
    """
    edges = cut(edges.where("a <> b").select("a", "b").distinct(), "edges")
    n = edges.count()
    while n > local_edges:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("v").alias("b")), F.struct(F.col("m").alias("a"), F.col("u").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        after = cut(small, "edges")
        unchanged = after.exceptAll(edges).isEmpty() and after.count() == n
        edges, n = after, after.count()
        if unchanged:
            break
    else:
        edges = edges.coalesce(1).mapInArrow(tidy(_forest_batches), "a long, b long")
    ends = edges.groupBy("b").agg(F.min("a").alias("root")).select(F.col("b").alias("id"), "root")
    return ends.unionByName(ends.select(F.col("root").alias("id"), "root").distinct())


def near_groups(docs: DataFrame, radius: int = RADIUS, blocks: int | None = None, **cols: str) -> DataFrame:
    """(doc_id, first_doc_id, n_copies): each document of a connected group of near copies, with the smallest doc_id and the number of documents of its group."""
    prints = cut(fingerprint_table(docs, **cols), "ids")
    same, near = _search(prints, radius, blocks, forest=True)
    roots = cut(components(near), "roots")
    classes = cut(same.join(fitted(roots, 16), "id", "left").select("h0", "h1", "n", F.coalesce("root", "id").alias("first")), "classes")
    size = classes.groupBy("first").agg(F.sum("n").alias("n_copies")).where("n_copies > 1")
    groups = cut(classes.drop("n").join(size, "first"), "groups")
    return prints.join(fitted(groups, 32), ["h0", "h1"]).select(F.col("id").alias("doc_id"), F.col("first").alias("first_doc_id"), "n_copies")


def drop_near_copies(docs: DataFrame, radius: int = RADIUS, blocks: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """*docs* without the documents that are near copies of one with a smaller doc_id of their group."""
    groups = near_groups(docs, radius, blocks, id_col=id_col, text_col=text_col)
    gone = cut(groups.where("doc_id <> first_doc_id").select(F.col("doc_id").alias("__gone")), "gone")
    return docs.join(fitted(gone, 16), docs[id_col] == F.col("__gone"), "left_anti")
