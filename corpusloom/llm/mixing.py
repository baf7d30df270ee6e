"""Mixing sources to target weights by a low-discrepancy schedule.

Slot k of the schedule goes to the source whose share of the cumulative weights holds the
golden-ratio point frac(k * phi) (in 32-bit integers, so that any engine gets the same),
and is the r-th slot of that source.  Each source is shuffled by a hash of its ids and cut
into blocks of equal tokens, through documents where need be (only a source's last block is shorter); the r-th slot takes the r-th block.
Without weights a source weighs as the square root of its tokens.  The weights hold exactly up to the slot at which the first source has no
block for its next round, min(blocks / weight).  The blocks left then get the slots after it, the n-th left of a
source at time (n - 1/2) / weight: sources run dry one by one, and the rest keep their weights to each other, so no token is lost.
With *whole* false the schedule ends there instead.

Any number of sources will do: their totals, ranges and slots are tables, points meet ranges in an as-of merge by stretches of the circle.

A token is a piece between spaces or line ends.  Defined cases: a null or empty text has no
tokens and stays with its neighbours' block; a null source is the source ''; a null id is left out (``mixed`` puts such rows last); repeated rows
of an id are one document (its source and its most tokens), and ``mixed`` keeps all of them, side by side; sources that given weights don't name, or weigh 0,
are left out, those without tokens come last if no weights are given; ties of the hash and of times go by id and source; texts of any length count whole; other columns are kept by ``mixed`` and else not
looked at; an empty table gives an empty schedule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .common import cut, fits, fitted, global_sum, running_sum

BLOCK_TOKENS = 2048
GOLDEN = 2654435769  # 2**32 / phi
#: Weights are whole multiples of 1 / UNIT, so that their sums are exact.
UNIT = 1 << 20
#: Tokens of a file that ``mixed`` makes, about.
FILE_TOKENS = 1 << 24


def tokens(text: Column) -> Column:
    """Pieces between spaces and line ends."""
    size = F.octet_length(text)
    gaps = size - F.octet_length(F.replace(text, F.lit(" "))) + size - F.octet_length(F.replace(text, F.lit("\n")))
    return F.when(F.coalesce(size, F.lit(0)) == 0, F.lit(0)).otherwise(gaps + 1).cast("long")


def mix_hash(ident: Column, seed: int) -> Column:
    """Order of the documents in a source: 60 bits of a hash of the id."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), ident.cast("string"))), 1, 15), 16, 10).cast("long")


def _points(slots: int, spark) -> DataFrame:
    """(slot, u): the low 32 bits of slot * GOLDEN, without an overflow."""
    k = F.col("slot")
    low, high = k.bitwiseAND(0xFFFF) * GOLDEN, F.shiftright(k, 16).bitwiseAND(0xFFFF) * GOLDEN
    u = (low + F.shiftleft(high.bitwiseAND(0xFFFF), 16)).bitwiseAND(0xFFFFFFFF)
    return spark.range(1, slots + 1).select(F.col("id").alias("slot")).withColumn("u", u)


def _assigned(points: DataFrame, sources: DataFrame, rows: int) -> DataFrame:
    """(slot, source) by the range [low, high) of the circle that holds a point, merged in stretches of about PREFIX_ROWS points and ranges."""
    width = (1 << 32) >> max(0, min(32, (-(-rows // common.PREFIX_ROWS) - 1).bit_length()))
    starts = sources.where("high > low").withColumn("stretch", F.explode(F.expr(f"sequence(low div {width}, (high - 1) div {width})")))
    starts = starts.select("stretch", F.greatest("low", F.col("stretch") * width).alias("u"), F.lit(None).cast("long").alias("slot"), "source")
    points = points.select(F.expr(f"u div {width}").alias("stretch"), "u", "slot", F.lit(None).cast("string").alias("source"))
    so_far = Window.partitionBy("stretch").orderBy("u", F.col("slot").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    return starts.unionByName(points).withColumn("source", F.last("source", ignorenulls=True).over(so_far)).where("slot is not null").select("slot", "source")


def schedule(docs: DataFrame, weights: dict[str, float] | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", whole: bool = True) -> DataFrame:
    """(doc_id, source, slot, block, from_token, n_tokens, start_token): the pieces of documents in each slot's block, in the order of
    start_token (a piece's place in its source); from_token is the piece's place in its document."""
    spark = docs.sparkSession
    sized = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), tokens(F.col(text_col)).alias("n_tokens"))
        .where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("source").alias("source"), F.max("n_tokens").alias("n_tokens"))
        .withColumn("h", mix_hash(F.col("doc_id"), seed))
    )
    sized = cut(sized, "sized")
    totals = sized.groupBy("source").agg(F.sum("n_tokens").alias("t"))
    if weights is None:
        totals = totals.withColumn("w", F.floor(F.sqrt(F.col("t").cast("double")) * float(UNIT)).cast("long"))
    else:
        given = spark.createDataFrame([(s, int(w * UNIT)) for s, w in weights.items() if w * UNIT >= 1], "source string, w long").coalesce(1)
        totals = totals.where("t > 0").join(given, "source")
    totals = totals.withColumn("blocks", F.greatest(F.lit(1), F.expr(f"(t - 1) div {block_tokens} + 1")).cast("long"))
    totals, weight = global_sum(cut(totals, "totals"), ["source"], "w", "below")
    on_circle = lambda x: F.expr(f"cast(cast({x} as decimal(20,0)) * cast(4294967296 as decimal(10,0)) div cast({max(weight, 1)} as decimal(20,0)) as bigint)")
    sources = cut(totals.select("source", "w", "blocks", on_circle("below").alias("low"), on_circle("below + w").alias("high")), "sources")
    ends = sources.agg(F.min(F.expr(f"case when w > 0 then cast(blocks as decimal(20,0)) * cast({max(weight, 1)} as decimal(18,0)) div w end")).alias("slots"), F.count("*").alias("n")).head()
    slots = int(ends["slots"] or 0)
    points = _assigned(_points(slots, spark), sources, slots + ends["n"])
    points = points.select("slot", "source", F.expr(f"slot div {common.PREFIX_ROWS}").alias("bucket"), F.lit(1).cast("long").alias("one"))
    ranked = running_sum(points, ["source"], "bucket", ["slot"], "one", "block").select("source", "slot", "block")
    bits = max(0, (-(-sized.count() // common.PREFIX_ROWS) - 1).bit_length())
    placed = running_sum(sized.withColumn("bucket", F.shiftright("h", 60 - bits) if bits else F.lit(0).cast("long")), ["source"], "bucket", ["h", "doc_id"], "n_tokens", "start")
    if whole:
        ranked = cut(ranked, "ranked")
        ranked = ranked.unionByName(_left(sources, ranked, slots))
    # a document's pieces; what has no tokens goes with what is before it at the end of a source
    placed = placed.join(fitted(sources.select("source", "blocks"), 64), "source")
    first, last = F.expr(f"least(start div {block_tokens}, blocks - 1)"), F.expr(f"least(greatest(start + n_tokens - 1, start) div {block_tokens}, blocks - 1)")
    pieces = placed.withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("start"), F.col("block") * block_tokens)
    pieces = pieces.select("doc_id", "source", "block", (begin - F.col("start")).alias("from_token"), (F.least(F.col("start") + F.col("n_tokens"), (F.col("block") + 1) * block_tokens) - begin).alias("n_tokens"), begin.alias("start_token"))
    return pieces.join(ranked, ["source", "block"]).select("doc_id", "source", "slot", "block", "from_token", "n_tokens", "start_token")


def _left(sources: DataFrame, ranked: DataFrame, slots: int) -> DataFrame:
    """(source, slot, block) of the blocks without a slot in *ranked*, from *slots* + 1 on."""
    rows = common.PREFIX_ROWS
    used = ranked.groupBy("source").agg(F.count("*").alias("used"))
    left = sources.join(used, "source", "left").select("source", "w", "blocks", F.coalesce("used", F.lit(0)).alias("used")).where("used < blocks")
    left = left.withColumn("k", F.explode(F.expr(f"sequence(used div {rows}, (blocks - 1) div {rows})")))  # two steps, so that no array is long
    left = left.withColumn("block", F.explode(F.expr(f"sequence(greatest(used, k * {rows}), least(blocks, (k + 1) * {rows}) - 1)")))
    time = F.when(F.col("w") > 0, (2 * (F.col("block") - F.col("used")) + 1).cast("double") / F.col("w"))
    left = cut(left.select("source", "block", time.alias("time")), "left")
    end = left.agg(F.max("time")).head()[0] or 1.0
    at = F.coalesce("time", F.lit(2 * end))  # sources without tokens
    pieces = max(1, -(-left.count() // rows))
    left = left.select("source", "block", at.alias("time"), F.least(F.floor(at / end * pieces), F.lit(pieces)).cast("long").alias("bucket"), F.lit(1).cast("long").alias("one"), F.lit(0).alias("all"))
    placed = running_sum(left, ["all"], "bucket", ["time", "source", "block"], "one", "before")
    return placed.select("source", (F.col("before") + slots + 1).alias("slot"), "block")


def _routed(docs: DataFrame, taken: DataFrame, files: int, id_col: str, source_col: str, seed: int, how: str) -> DataFrame | None:
    """*docs* with __id and __to, the file of *taken* where a row's document lies, without a move of rows; None where that takes more than a broadcast.  Rows of no range go to the last file, or out if *how* is inner.

    In a source, documents by (hash, id), blocks, slots and files have one order, so that a file holds one range of a source's
    (hash, id).  Ranges are looked up by source and first bits of the hash.  Rows whose id has several sources get that of the document.
    """
    bits = min(40, (files - 1).bit_length())
    stretch = lambda h: F.shiftright(h, 60 - bits)
    ranges = taken.groupBy("__source", "__to").agg(F.min(F.struct(mix_hash(F.col("__taken"), seed).alias("h"), F.col("__taken").alias("id"))).alias("__low"))
    ranges = ranges.withColumn("__high", F.lead("__low").over(Window.partitionBy("__source").orderBy("__low")))
    last = F.coalesce(stretch(F.col("__high.h")), F.lit((1 << bits) - 1).cast("long"))
    ranges = ranges.withColumn("__stretch", F.explode(F.sequence(stretch(F.col("__low.h")), last)))
    ranges = cut(ranges.select(F.col("__source").alias("__of"), "__stretch", "__low", "__high", F.col("__to").alias("__file")), "ranges")
    own = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    odd = docs.select(F.col(id_col).cast("long").alias("__odd"), own.alias("s")).where("__odd is not null").groupBy("__odd").agg(F.min("s").alias("__first"), F.max("s").alias("s"))
    odd = cut(odd.where("__first < s").drop("s"), "odd")
    if not (fits(ranges, 120) and fits(odd, 64)):
        return None
    rows = docs.withColumn("__id", F.col(id_col).cast("long")).join(F.broadcast(odd), F.col("__id") == F.col("__odd"), "left")
    rows = rows.withColumn("__own", F.coalesce("__first", own)).withColumn("__key", F.struct(mix_hash(F.col("__id"), seed).alias("h"), F.col("__id").alias("id")))
    here = (F.col("__own") == F.col("__of")) & (stretch(F.col("__key.h")) == F.col("__stretch")) & F.col("__id").isNotNull()
    rows = rows.join(F.broadcast(ranges), here & (F.col("__key") >= F.col("__low")) & (F.col("__high").isNull() | (F.col("__key") < F.col("__high"))), how)
    return rows.withColumn("__to", F.coalesce("__file", F.lit(files - 1))).drop("__odd", "__first", "__own", "__key", "__of", "__stretch", "__low", "__high", "__file")


def mixed(docs: DataFrame, id_col: str = "doc_id", files: int = 0, weights: dict[str, float] | None = None, whole: bool = True, **options) -> DataFrame:
    """The documents, whole, in the order of the schedule (by partitions, and within each), each where its first piece is; its columns are those of *docs*.

    All rows of *docs* are kept, but those that weights leave out or that come after the end if *whole* is false.  Rows move once, to their
    files; only where neither the slots nor the files' ranges are small enough to send everywhere, they move to their slots first."""
    first = schedule(docs, weights, id_col=id_col, whole=whole, **options).where("from_token = 0")
    taken = cut(first.select(F.col("doc_id").alias("__taken"), F.col("source").alias("__source"), F.col("slot").alias("__slot"), F.col("start_token").alias("__start")), "mix")
    end = (taken.agg(F.max("__slot").alias("m")).head()["m"] or 0) + 1
    files = files or -(-end * options.get("block_tokens", BLOCK_TOKENS) // FILE_TOKENS)
    to = F.least(F.expr(f"cast((__slot - 1) * {files} div {end} as int)"), F.lit(files - 1))
    how = "left" if whole and weights is None else "inner"
    slots = taken.drop("__source")
    routed = None if (small := fits(slots, 32)) else _routed(docs, taken.withColumn("__to", to), files, id_col, options.get("source_col", "source"), options.get("seed", 42), how)
    if routed is not None:  # both sides lie by file, and are joined there
        slots = slots.withColumn("__at", to).repartitionById(files, "__at")
        rows = routed.repartitionById(files, "__to").join(slots, (F.col("__to") == F.col("__at")) & (F.col("__id") == F.col("__taken")), how)
        return rows.withColumn("__slot", F.coalesce("__slot", F.lit(end))).sortWithinPartitions("__slot", "__start", "__taken").drop("__id", "__to", "__at", "__taken", "__slot", "__start")
    rows = docs.join(F.broadcast(slots) if small else slots, docs[id_col] == F.col("__taken"), how).withColumn("__slot", F.coalesce("__slot", F.lit(end)))
    return rows.repartitionById(files, to).sortWithinPartitions("__slot", "__start", "__taken").drop("__taken", "__slot", "__start")
