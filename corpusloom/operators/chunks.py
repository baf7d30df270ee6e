"""Sections and chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import folds
from ..functions import text as T
from .scale import numbered

FILE_TYPES = ("pdf", "docx", "doc", "pptx", "ppt", "txt", "md")


def pack(pieces: Column, most: int = 500, least: int = 50, sep: str = "") -> Column:
    """Greedy packing: pieces go on until the next would pass *most*; packs under *least* go."""
    return folds.packed(pieces, most=most, least=least, sep=sep)


def chunks(df: DataFrame, most: int = 500, least: int = 50, text: str = "text", order: str = "doc_id") -> DataFrame:
    """(order, chunk_no, content, char_count), chunk_no by document."""
    rows = df.select(order, F.posexplode(folds.sentence_packs(F.col(text), most=most, least=least)).alias("chunk_no", "content"))
    return rows.withColumn("char_count", F.length("content").cast("long"))


def section_chunks(sections: DataFrame, most: int = 500, least: int = 50, source_type: str | None = None) -> DataFrame:
    """Chunks of sections (source_file, section_no, title, full_path, level, body and, if *source_type* names it, the type of the source):
    (content, section_title, full_path, source_file, source_type, chunk_index, level, char_count), chunk_index over all of them by source_file."""
    kind = F.coalesce(F.col(source_type), F.lit("unknown")) if source_type else F.lit("unknown")
    packs = folds.sentence_packs(F.col("body"), most=most, least=least)
    # sections are numbered by the counts of their chunks, so that only these are sorted; the chunks go to the numbers
    first = numbered(sections.select("source_file", "section_no", F.size(packs).alias("n")), ["source_file", "section_no"], "first", weight="n")
    rows = sections.select("source_file", "section_no", F.col("title").alias("section_title"), "full_path", kind.alias("source_type"), "level", "body")
    first = first.select(F.col("source_file").alias("__f"), F.col("section_no").alias("__s"), "first")
    rows = rows.join(first, F.col("source_file").eqNullSafe(F.col("__f")) & F.col("section_no").eqNullSafe(F.col("__s")))
    rows = rows.select("section_title", "full_path", "source_file", "source_type", "level", "first", F.posexplode(packs).alias("pos", "content")).withColumn("chunk_index", F.col("first") + F.col("pos"))
    return rows.select("content", "section_title", "full_path", "source_file", "source_type", "chunk_index", "level", F.length("content").cast("long").alias("char_count"))


def paragraphs(t: Column, most: int = 0) -> Column:
    """Parts between blank lines; those over *most* characters, if it isn't 0, in packs of sentences."""
    return folds.paragraphs(t, most=most)


def split_by(df: DataFrame, unit: str, least: int = 0, most: int = 1 << 30, text: str = "text", order: str = "doc_id") -> DataFrame:
    """(order, pos, text) of lines, paragraphs or whole documents within the bounds of length."""
    t = F.col(text)
    parts = {"line": F.transform(T.lines(t), T.strip), "paragraph": F.transform(F.split(t, "\n\n", -1), T.strip), "document": F.array(T.strip(t))}[unit]
    return df.select(order, F.posexplode(parts).alias("pos", "text")).where((F.length("text") >= max(least, 1)) & (F.length("text") <= most))


def long_sentence(t: Column, most: int = 500) -> Column:
    """A sentence of more than *most* characters cut at commas and semicolons, its parts packed again with full-width commas."""
    return folds.long_sentence(t, most=most)


def headed_parts(df: DataFrame, text: str = "text", order: str = "doc_id", least: int = 10, most: int = 0) -> DataFrame:
    """(order, section_no, pos, title, text): paragraphs of *least* characters or more of a text that # lines divide."""
    return df.select(order, F.inline(folds.headed_parts(F.col(text), least=least, most=most)))


def _sections(df: DataFrame, order: str, blocks: Column) -> DataFrame:
    return df.select(order, F.posexplode(blocks).alias("section_no", "b")).select(order, "section_no", "b.*")


def plain_sections(df: DataFrame, text: str = "text", order: str = "doc_id", least: int = 30, name: str | None = None, watermarks: tuple[str, ...] = T.WATERMARKS, mend: bool = True) -> DataFrame:
    """(order, section_no, title, full_path, level, body, char_count): parts of the cleaned text that title lines begin, longer than *least*.

    Text before the first title is called by the stem of the file that column *name* holds; a text without any part is one section."""
    names = [F.col(name).cast("string")] if name else [F.col(order).cast("string")]
    return _sections(df, order, folds.sections_of_plain(F.col(text), *names, lines={"watermarks": tuple(watermarks), "mend": mend}, least=least))


def markdown_sections(
    df: DataFrame, text: str = "text", order: str = "doc_id", skip: tuple[str, ...] = T.SKIP, least_top: int = 150, least: int = 50, watermarks: tuple[str, ...] = T.WATERMARKS, references: bool = True, garbled: bool = True
) -> DataFrame:
    """(order, section_no, title, full_path, level, body, char_count) of headed parts with more than the least letters; text before a heading goes, and so do
    sections whose own or parent's title has a part in *skip*."""
    return _sections(df, order, folds.sections_of_markdown(
        F.col(text), lines={"watermarks": tuple(watermarks), "references": references, "garbled": garbled}, sections={"skip": tuple(skip), "least_top": least_top, "least": least}
    ))


def source_type(stem: Column, known: Column | None = None, extensions: Column | None = None) -> Column:
    """The type of a source: as its metadata (*known*) has it, else the first of FILE_TYPES among the *extensions* (an array) that are there for its stem, else 'unknown'."""
    there = [F.when(F.array_contains(extensions, e), e) for e in FILE_TYPES] if extensions is not None else []
    return F.coalesce(*([F.nullif(known, F.lit(""))] if known is not None else []), *there, F.lit("unknown"))
