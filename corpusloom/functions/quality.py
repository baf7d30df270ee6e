"""Four-part quality of a text: readability, coherence, information density, noise."""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import folds
from . import text as T

STOP_EN = tuple(
    """
    a about after again all also an and are as at be been before being both but by can could dare did do does each
    every few for from further had has have he her here hers him his how i if in into is it its just may me might mine
    more most my need no nor not of on once only or other our ours out over own same shall she should so some such
    than that the their theirs them then there these they this those to too up us very was we were what when where
    which who whom whose why will with would you your yours
    """.split()
)
STOP_ZH = tuple("一上下不与之也了些人仅从他以们会但低作你做其几出分刚初到前去发只可各后向吧呀呢和哈哦哪唉啊喂嗯嘛回在多大天她好如它对小少就干年底弄往很我或所才打把搞新日旧时是月有末本来此每点用的看着短秒第等给而能若被要让该说谁起过这进那都长高")
MARKS = "，。！？；：,.!?;"


def content_words(t: Column) -> Column:
    words = F.filter(F.regexp_extract_all(F.lower(t), F.lit("([a-zA-Z]+)"), 1), lambda w: F.length(w) > 1)
    signs = F.regexp_extract_all(t, F.lit(f"([{T.CJK}])"), 1)
    return F.array_except(F.array_distinct(F.concat(words, signs)), F.array(*map(F.lit, STOP_EN + STOP_ZH)))


def readability(t: Column) -> Column:
    ss = T.sentences(t)
    a = F.aggregate(ss, F.lit(0), lambda x, s: x + F.length(T.strip(s)))
    a = F.try_divide(a, F.size(ss))
    by_length = F.when(a < 10, 0.2).when(a < 30, 0.2 + 0.8 * (a - 10) / 20).when(a <= 80, 1.0).when(a <= 200, 1 - 0.7 * F.least((a - 80) / 120, F.lit(1.0))).otherwise(0.3)
    marks = sum((F.when(t.contains(m), 1).otherwise(0) for m in MARKS), F.lit(0))
    return 0.6 * by_length + 0.4 * F.least(marks / 5, F.lit(1.0))


def coherence(t: Column) -> Column:
    bags = F.transform(T.sentences(t), content_words)
    n = F.size(bags)
    pairs = F.zip_with(F.slice(bags, 1, F.greatest(n - 1, F.lit(0))), F.slice(bags, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) >= 2))
    valid = F.filter(pairs, lambda p: p.isNotNull())
    return F.when(n < 2, 0.7).when(F.size(valid) == 0, 0.5).otherwise(F.size(F.filter(valid, lambda p: p)) / F.size(valid))


def density(t: Column) -> Column:
    """Share of content words, an empty text having the full one."""
    d = F.try_divide(F.aggregate(content_words(t), F.lit(0), lambda x, w: x + F.length(w)), F.length(t))
    return F.when((F.length(t) == 0) | (d >= 0.8), 1.0).when(d <= 0.3, 0.2).otherwise(0.2 + 0.8 * (d - 0.3) / 0.5)


def noise(t: Column) -> Column:
    gone = lambda p: F.length(t) - F.length(F.regexp_replace(t, p, ""))
    odd = r"(?U)[^\p{L}\p{N}_\s一-鿿　-〿＀-￯\"（）【】《》\[\]{}()\-+*/=<>]"
    total = gone(r"(?U)https?://\S+") + gone(r"(?U)\S+@\S+\.\S+") + gone(odd) + gone(r"(.)\1{4,}")
    return F.when(F.length(t) == 0, 1.0).otherwise(F.least(F.try_divide(total, F.length(t)), F.lit(1.0)))


_SENTENCE = re.compile(r"(?<=[。！？.!?;；])\s*")
_WORD, _SIGN = re.compile("[a-z]{2,}"), re.compile("[一-鿿]")
_ODD = re.compile(r"[^\w\s一-鿿　-〿＀-￯\"\[\]{}()\-+*/=<>]+")
_URL, _MAIL = re.compile(r"https?://\S+"), re.compile(r"\S+@\S+\.\S+")
_STOP = frozenset(STOP_EN + STOP_ZH)
_CJK = re.compile("[\u2e80-\U0010ffff]")
NAMES = ("readability", "coherence", "info_density", "noise_ratio", "quality_score")


def _bag(lower: str, signs: bool) -> set[str]:
    bag = set(_WORD.findall(lower))
    if signs:
        bag.update(_SIGN.findall(lower))
    return bag - _STOP


def _run_chars(texts: list[str]) -> np.ndarray:
    """Characters of each text in runs of five or more of one character (line ends aside), for all texts at once."""
    size = np.array([len(t) for t in texts])
    c = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(c):
        return np.zeros(len(texts))
    row = np.repeat(np.arange(len(texts)), size)
    start = np.flatnonzero(np.append(True, (c[1:] != c[:-1]) | (row[1:] != row[:-1])))
    length = np.diff(np.append(start, len(c)))
    long = (length >= 5) & (c[start] != 10)
    return np.bincount(row[start[long]], length[long], len(texts))


def _parts(t: str, run: float) -> tuple[float, float, float, float]:
    ss = [x for x in map(str.strip, _SENTENCE.split(t)) if x]
    a = sum(map(len, ss)) / len(ss)
    by_length = 0.2 if a < 10 else 0.2 + 0.8 * (a - 10) / 20 if a < 30 else 1.0 if a <= 80 else 1 - 0.7 * min((a - 80) / 120, 1.0) if a <= 200 else 0.3
    signs = _CJK.search(t) is not None
    bags = [_bag(x.lower(), signs) for x in ss]
    both = [len(x & y) >= 2 for x, y in zip(bags, bags[1:]) if x and y]
    d = sum(map(len, set().union(*bags))) / len(t)  # no word crosses the end of a sentence
    n = run + sum(map(len, _ODD.findall(t)))
    if "http" in t:
        n += sum(map(len, _URL.findall(t)))
    if "@" in t:
        n += sum(map(len, _MAIL.findall(t)))
    return (
        0.6 * by_length + 0.4 * min(sum(m in t for m in MARKS) / 5, 1.0),
        0.7 if len(ss) < 2 else sum(both) / len(both) if both else 0.5,
        1.0 if d >= 0.8 else 0.2 if d <= 0.3 else 0.2 + 0.8 * (d - 0.3) / 0.5,
        min(n / len(t), 1.0),
    )


def score_batch(texts: pa.Array) -> pa.Array:
    """The same four parts and the overall score: runs of characters for the whole batch in numpy, sentences and words by compiled patterns."""
    texts = [t or "" for t in texts.to_pylist()]
    out = np.zeros((len(texts), 5))
    out[:, 3] = 1.0
    blank = np.array([not t.strip() for t in texts], bool)
    for k, run in zip(np.flatnonzero(~blank).tolist(), _run_chars(texts)[~blank].tolist()):
        out[k, :4] = _parts(texts[k], run)
    out[:, 4] = 0.3 * out[:, 0] + 0.25 * out[:, 1] + 0.25 * out[:, 2] + 0.2 * (1 - out[:, 3])
    rounded = [pa.array([round(v, 4) for v in out[:, k].tolist()], pa.float64()) for k in range(5)]
    return pa.StructArray.from_arrays(rounded, list(NAMES))


def scores(t: Column) -> Column:
    """Struct of the four parts and the overall score, rounded to four places; a blank text has none but noise."""

    @F.arrow_udf(", ".join(f"{n} double" for n in NAMES))
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return folds.in_pieces(batches, lambda rows: score_batch(pa.array([t for (t,) in rows], pa.string())))

    return score(t)
