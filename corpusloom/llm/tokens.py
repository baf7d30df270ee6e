"""Words of whole Arrow columns as 64-bit hashes, without a Python loop over words.

A word is a maximal run of letters, marks, digits and underscores of the lower-cased text (also of
joiners, private and unassigned characters), but in scripts written without spaces (OWN) each
letter, mark or digit is a word of its own.  Work goes in pieces of bounded size, whatever a text's length.
"""

from __future__ import annotations

import ctypes
import sys
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18
#: A longer word is hashed in parts.
LONGEST = 1 << 24
_P = 0x9E3779B97F4A7C15 | 1


def _const(name: str, make):
    """Tables are made once in a worker process (functions are shipped by value)."""
    kept = vars(sys).setdefault("_corpusloom_tables", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def release() -> None:
    """Give memory that a worker has freed back to the system, since idle workers stay beside their executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """*work*, with a ``release`` at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        release()

    return run


#: Thai and Lao, Myanmar, Khmer, Han, kana and bopomofo.
OWN = ((0xE01, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x3029), (0x3041, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF))


def _kinds() -> np.ndarray:
    """By character: 0 between words, 1 in a word, 2 a word of its own."""
    t = np.ones(0x110000, np.uint8)
    for c in range(0x32000):
        kind = unicodedata.category(chr(c))
        t[c] = c in (0x5F, 0x200C, 0x200D) or not (kind[0] in "PSZ" or kind in ("Cc", "Cf"))
    t[0xE0000:0xE01F0] = 0  # tags and variation selectors
    for a, b in OWN:
        t[a : b + 1] *= 2
    t[0x2E80:0x2FE0] = 2  # radicals count as symbols
    return t


def _byte_kinds(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(is the byte in a word, does it go on with the word of the byte before), whatever the rows."""
    table = _const("characters", _kinds)
    kind = table[:256][buf]
    for p in range(0, len(buf), PIECE):
        lead = np.flatnonzero(buf[p : p + PIECE] >= 0xC0) + p
        if not len(lead):
            continue
        more = lambda k: (buf[np.minimum(lead + k, len(buf) - 1)] & 0x3F).astype(np.int64)  # noqa: B023, E731
        b = buf[lead].astype(np.int64)
        two, three = b < 0xE0, b < 0xF0
        code = np.where(two, (b & 0x1F) << 6 | more(1), np.where(three, (b & 0x0F) << 12 | more(1) << 6 | more(2), (b & 0x07) << 18 | more(1) << 12 | more(2) << 6 | more(3)))
        k, size = table[np.minimum(code, 0x10FFFF)], np.where(two, 2, np.where(three, 3, 4))
        for i in range(4):
            has = size > i
            kind[np.minimum(lead[has] + i, len(buf) - 1)] = k[has]
    joins = np.zeros(len(buf), bool)
    joins[1:] = (kind[1:] == 1) & (kind[:-1] == 1) | (kind[1:] > 0) & ((buf[1:] & 0xC0) == 0x80)
    return kind > 0, joins


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse mod 2**64."""
    inverse = pow(_P, -1, 1 << 64)
    return tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, v, np.uint64))]) for v in (_P, inverse))


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ np.uint64(salt)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def raw(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string array; a null is an empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, off - off[0]


def slices(arr: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of about *limit* bytes of text; a longer text is a range of its own."""
    _, off = raw(arr)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def words(arr: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, its length in bytes, offsets of the rows in them)."""
    return _words(arr, lower)[:3]


def word_places(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(first byte of each word within all texts as they are, offsets of the rows in them)."""
    _, _, off, places = _words(arr, lower=False)
    return places, off


def _words(arr: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    buf, off = raw(pc.utf8_lower(arr.cast(pa.large_string())) if lower else arr)
    n = len(buf)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(off), np.int64), np.zeros(0, np.int64)
    if not n:
        return none
    inside, joins = _byte_kinds(buf)
    joins[off[off < n]] = False
    hashes, lengths, places, p = [], [], [], 0
    while p < n:
        q = min(n, p + PIECE)
        if q < n:  # cut where no word is cut
            ok = np.flatnonzero(~joins[p + 1 : q + 1])
            if len(ok):  # so that what follows begins a word or stands between two
                q = p + int(ok[-1]) + 1
            else:
                more = np.flatnonzero(~joins[q:])
                q = min(q + int(more[0]) if len(more) else n, p + LONGEST)
        part = buf[p:q]
        w, goes_on = inside[p:q], joins[p:q].copy()
        goes_on[0] = False
        starts = np.flatnonzero(w & ~goes_on)
        if len(starts):
            ends = np.flatnonzero(w & ~np.append(goes_on[1:], False)) + 1
            length = ends - starts
            size = 1 << max(18, (len(part) - 1).bit_length())
            power, inverse = _const(f"power{size}", lambda size=size: _powers(size))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=sums[1:])
            hashes.append(mix((sums[ends] - sums[starts]) * inverse[starts]))
            lengths.append(length)
            places.append(starts + p)
        p = q
    if not hashes:
        return none
    at = np.concatenate(places)
    return np.concatenate(hashes), np.concatenate(lengths), np.searchsorted(at, off), at


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the *k* values from each position on; len(h) - k + 1 of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    c = np.uint64(1)
    for i in range(k):
        out += h[i : i + n] * c
        with np.errstate(over="ignore"):
            c = np.uint64((int(c) * _P) & 0xFFFFFFFFFFFFFFFF)
    return mix(out)


def hash_words(text: str) -> list[int]:
    return words(pa.array([text]))[0].tolist()
