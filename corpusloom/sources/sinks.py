"""Tables out: pretraining and rich JSON lines with their gates and counts, splits, chunks, sections, reports."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chunks, dedup, records, scale
from .files import write_json_lines

PREVIEW = 100


def put_text(df: DataFrame, path: str, text: str) -> None:
    """A small text file, written by the driver through the file system of *path*."""
    jvm, sc = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(sc._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def gate(df: DataFrame, text: str, least: int, most: int) -> Column:
    """short, long or null for what passes, by the stripped text."""
    n = F.length(T.strip(F.coalesce(F.col(text), F.lit(""))))
    return F.when(n < least, "short").when(n > most, "long")


def pretraining(df: DataFrame, path: str, text: str = "content", order: str = "chunk_index", least: int = 100, most: int = 1_000_000, rich: bool = True, prefix: bool = True, unique: bool = True) -> dict[str, int]:
    """Writes chunks (content, section_title, source_file, source_type, full_path, chunk_index and, if they have them, category, quality_score, quality)
    as pretraining records; the counts of what was written and of what was left out, and why."""
    content = T.strip(F.coalesce(F.col(text), F.lit("")))
    rows = df.withColumn("__why", gate(df, text, least, most)).withColumn("__content", content)
    passed = rows.where("__why is null")
    if unique:
        passed = dedup.keep_first(passed, T.normal_key(F.col("__content")), order)
    passed = scale.settled(passed)
    section = F.coalesce(F.col("section_title"), F.lit(""))
    record = records.section_record(section, F.col("__content")) if prefix else F.col("__content")
    meta = {"source_file": F.col("source_file"), "source_type": F.col("source_type"), "section": section, "full_path": F.col("full_path"), "chunk_index": F.col("chunk_index")}
    meta |= {k: F.col(k) for k in ("category", "quality_score", "quality") if k in df.columns}
    out = passed.select(record.alias("text"), F.struct(*(c.alias(k) for k, c in meta.items())).alias("meta")) if rich else passed.select(record.alias("text"))
    write_json_lines(out, path)
    by = {r["__why"]: r["n"] for r in rows.groupBy("__why").agg(F.count("*").alias("n")).collect()}
    written = passed.count()
    return {"total": sum(by.values()), "written": written, "skipped_short": by.get("short", 0), "skipped_long": by.get("long", 0), "duplicates": by.get(None, 0) - written}


def rich(df: DataFrame, path: str, one_file: bool = False) -> int:
    """Chunks with content as JSON lines; how many."""
    rows = df.where(F.length(T.strip(F.coalesce("content", F.lit("")))) > 0)
    write_json_lines(rows, path, one_file)
    return rows.count()


def split_files(df: DataFrame, path: str, test: float = 0.1, val: float = 0.0, seed: int = 42, order: str = "doc_id", source: str = "") -> dict:
    """Writes split=train, val and test below *path* as JSON lines, and split_info.json beside them; what that says."""
    rows = scale.settled(records.split(df, test, val, seed, order))
    rows.write.mode("overwrite").partitionBy("split").option("ignoreNullFields", False).json(path)
    info = records.split_info(rows, source, test, val, seed).head().asDict()
    put_text(df, f"{path}/split_info.json", json.dumps(info, indent=2))
    return info


def previews(df: DataFrame, text: str = "content") -> DataFrame:
    """Left-out chunks with the first characters of their text in place of it, for a report."""
    short = F.substring(text, 1, PREVIEW)
    return df.withColumn(text, F.when(F.length(text) > PREVIEW, F.concat(short, F.lit("..."))).otherwise(short))


def quality_report(scored: DataFrame, samples: int = 5) -> dict:
    """Number and mean score of chunks, and a few of them."""
    n, mean = scored.agg(F.count("*"), F.round(F.avg("quality_score"), 4)).head()
    some = previews(scored.orderBy("chunk_index").limit(samples).select("chunk_index", "content", "quality_score"))
    return {"chunks": n, "mean_score": mean, "samples": [r.asDict() for r in some.collect()]}


def paired(sections: DataFrame, path: str) -> None:
    """Sections as JSON lines and their bodies as cleaned texts, by source file."""
    sections.write.mode("overwrite").partitionBy("source_file").json(f"{path}/sections")
    sections.select("source_file", F.col("body").alias("value")).write.mode("overwrite").partitionBy("source_file").text(f"{path}/cleaned")


def headed_json(df: DataFrame, path: str, text: str = "text", source: str = "source_file") -> int:
    """Texts of ``# title`` parts as JSON lines (title, text, source_file), a line for each paragraph; how many."""
    rows = scale.settled(chunks.headed_parts(df, text, source))
    write_json_lines(rows.select("title", "text", F.col(source).alias("source_file")), path)
    return rows.count()
