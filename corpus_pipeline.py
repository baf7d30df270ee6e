"""Documents to training shards: quality, near copies, leaked benchmarks, source weights, shards.

Common to all stages: rows are documents (doc_id, text, source, others), and all but the last return the columns they get. Rows with
null columns, empty and very long texts, repeated rows and tables without rows are legal; each stage says what becomes of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import common, decontam, mixing, quality, sharding, simhash
from corpusloom.llm.common import cut, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quadratic discriminant doesn't reject.

    Each row is judged by its text alone: equal rows have one fate, a null text counts as empty, a null id doesn't matter, ties stay.
    Without labels of both classes everything stays.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each group of near copies, and all without a near copy.

    Texts that are null or have no words are nobody's copies and stay, as do rows of a null id; repeated rows of an id stay or go together.
    """
    return simhash.drop_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark item, whatever their id; null and empty texts hold none."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, stored in the order of the low-discrepancy schedule.

    A null source is the source ''; texts without tokens lie with their neighbours; repeated rows of an id lie side by side, those of a null id last.
    """
    return mixing.mixed(docs)


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and first byte, in the stored order; null and empty texts have no bytes and lie where the next row begins."""
    return sharding.sharded(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("source mixing", mix_sources),
    ("sharding", cut_shards),
]

#: Discriminant, fingerprints and BM25 are beyond SQL; a test holds each stage and run() against brute force over the smallest tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written to the shared folder and read again; what a stage no longer needs is deleted."""
    docs, mine = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        begin = len(common.written)
        docs = cut(stage(spark, docs, sf_dir), "stage")
        made = common.written[begin:]
        common.discard(spark, [*mine, *made[:-1]])
        mine = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
