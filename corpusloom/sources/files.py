"""Files in, records out: scans, decoding, Office text, JSON lines, indexes, resumable state, sinks."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = {"pdf": ("pdf",), "office": ("doc", "docx", "ppt", "pptx"), "text": ("txt", "md", "markdown")}


def scan(spark: SparkSession, root: str, extensions: list[str] | None = None) -> DataFrame:
    """(path, name, ext, kind, length, modificationTime, content) of the files below *root*."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    ext = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    kind = F.lit("other")
    for k, v in KINDS.items():
        kind = F.when(F.col("ext").isin(*v), k).otherwise(kind)
    files = files.withColumn("ext", ext).withColumn("name", F.element_at(F.split("path", "/"), -1)).withColumn("kind", kind)
    return files.where(F.col("ext").isin(*(e.lower().lstrip(".") for e in extensions))) if extensions else files


def _likely(text: str) -> float:
    """The part of a decoded text that is letters, digits, blanks, usual signs or common Chinese; others tell of a wrong encoding."""
    good = sum(c.isalnum() and (c < "\u0250" or "\u0370" <= c < "\u0600" or "\u3040" <= c <= "\u9fff" or "\uac00" <= c < "\ud7b0") or c in " \t\r\n" or " " <= c < "\x7f" or "\u3000" <= c <= "\u303f" or "\uff00" <= c < "\uff60" or c in "“”‘’…—·" for c in text)
    return good / max(1, len(text))


#: Frequent characters of Chinese, simplified and traditional.
_COMMON = {"gb18030": "的一是不了在人有我他这中大来上国个到说们为子和你地出道也时年得就那要下以生会自着去之过家学对可里后小么心多天而能好都然没日于起还发成事只作当想看文无开手用主行方又如前所本见经头面公同三已老从动两长", "big5": "的一是不了在人有我他這中大來上國個到說們為子和你地出道也時年得就那要下以生會自著去之過家學對可裡後小麼心多天而能好都然沒日於起還發成事只作當想看文無開手用主行方又如前所本見經頭面公同三已老從動兩長"}


def encoding(raw: bytes) -> str:
    """utf-8, utf-16 (by its mark, or by where its zero bytes lie), else the better of GB18030 and Big5, else Latin-1; judged by the first 64 KB."""
    head = raw[:65536]
    if head.startswith((b"\xff\xfe", b"\xfe\xff")):
        return "utf-16"
    try:
        raw.decode("utf-8")
        if b"\x00" not in head:
            return "utf-8-sig"
    except UnicodeDecodeError:
        pass
    even, odd = head[::2].count(0), head[1::2].count(0)
    if max(even, odd) > len(head) // 8 and min(even, odd) < max(even, odd) // 4:
        return "utf-16-le" if odd > even else "utf-16-be"
    scores = {}
    for name in ("gb18030", "big5"):
        try:
            text = head[: len(head) - len(head) % 2].decode(name, "ignore" if len(raw) > len(head) else "strict")
            scores[name] = _likely(text) + sum(c in _COMMON[name] for c in text) / max(1, len(text))
        except UnicodeDecodeError:
            continue
    best = max(scores, key=scores.get, default=None)
    return best if best and scores[best] > 0.8 else "latin-1"


def decode(raw: bytes) -> str:
    return raw.decode(encoding(raw), "replace")


def office_text(raw: bytes, ext: str) -> str:
    """Text of a docx (headings as #) or pptx (a heading for each slide with text)."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        if ext == "docx":
            w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
            out = []
            for p in ElementTree.fromstring(z.read("word/document.xml")).iter(f"{w}p"):
                style = p.find(f"{w}pPr/{w}pStyle")
                name = style.get(f"{w}val", "") if style is not None else ""
                level = int(name[7:]) if name.lower().startswith("heading") and name[7:].isdigit() else 0
                line = "".join(t.text or "" for t in p.iter(f"{w}t")).strip()
                if line:
                    out.append("#" * level + " " * bool(level) + line)
            return "\n\n".join(out)
        a = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
        slides = sorted((n for n in z.namelist() if n.startswith("ppt/slides/slide")), key=lambda n: int("".join(c for c in n if c.isdigit())))
        out = []
        for k, n in enumerate(slides, 1):
            texts = ["".join(t.text or "" for t in p.iter(f"{a}t")).strip() for p in ElementTree.fromstring(z.read(n)).iter(f"{a}p")]
            if any(texts):
                out.append(f"## 幻灯片 {k}\n\n" + "\n".join(x for x in texts if x))
        return "\n\n".join(out)


#: By extension; callers add engines for PDF, OCR or old Office files.
ENGINES: dict[str, list[Callable[[bytes, str], str]]] = {**{e: [lambda raw, _: decode(raw)] for e in KINDS["text"]}, "docx": [office_text], "pptx": [office_text]}


def extract(files: DataFrame, engines: dict[str, list[Callable[[bytes, str], str]]] | None = None, least: int = 1) -> DataFrame:
    """(path, ext, text, engine, error): the first engine whose text has *least* characters; failures are rows with an error."""
    table = {**ENGINES, **(engines or {})}

    def run(batches):
        for batch in batches:
            out = []
            for path, ext, raw in zip(*(batch.column(k).to_pylist() for k in range(3))):
                text, used, error = None, None, None if ext in table else "no engine"
                for engine in table.get(ext, ()):
                    try:
                        text = engine(raw, ext)
                        if text is not None and len(text.strip()) >= least:
                            used, error = getattr(engine, "__name__", "engine"), None
                            break
                        text, error = None, "too short"
                    except Exception as e:  # a broken file is a row, not a failed job
                        error = f"{type(e).__name__}: {e}"
                out.append((path, ext, text, used, error))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*out)] if out else [pa.array([], pa.string())] * 5, ["path", "ext", "text", "engine", "error"])

    return files.select("path", "ext", "content").mapInArrow(run, "path string, ext string, text string, engine string, error string")


def by_method(extracted: DataFrame) -> DataFrame:
    """(method, n): files by the engine that read them; 'failed' for those that none did."""
    return extracted.groupBy(F.coalesce("engine", F.lit("failed")).alias("method")).agg(F.count("*").alias("n"))


def pending(files: DataFrame, outputs: DataFrame, least: int = 50) -> DataFrame:
    """Files (path ...) whose text (outputs: path, text or size) isn't there or has fewer than *least* bytes: candidates for another try or for OCR."""
    size = F.col("size") if "size" in outputs.columns else F.octet_length("text")
    return files.join(outputs.where(size >= least).select("path"), "path", "left_anti")


def texts_by_category(spark: SparkSession, root: str, extension: str = "txt") -> DataFrame:
    """(category, filename, path, text) of ``root/<category>/*.txt``, whole files."""
    files = spark.read.format("text").option("wholetext", True).load(f"{root}/*/*.{extension}").select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return files.select(F.element_at(F.split("path", "/"), -2).alias("category"), F.element_at(F.split("path", "/"), -1).alias("filename"), "path", "text")


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of files that hold a JSON array each, with ``source`` (the file) and, where a file is malformed, ``_corrupt``."""
    raw = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("source"), "value")
    ok = F.try_parse_json("value").isNotNull() & F.ltrim("value").startswith("[")
    rows = raw.select("source", F.explode_outer(F.when(ok, F.from_json("value", f"array<struct<{', '.join(_fields(schema))}>>"))).alias("r"), F.when(~ok, F.col("value")).alias("_corrupt"))
    return rows.where("r is not null or _corrupt is not null").select("source", "r.*", "_corrupt")


def _fields(schema: str) -> list[str]:
    """The fields of a flat schema text, as those of a struct."""
    return [f"{name}: {kind}" for name, kind in (x.strip().split(" ", 1) for x in schema.split(","))]


def trainer_texts(spark: SparkSession, path: str) -> DataFrame:
    """(text) of JSON lines, as a trainer reads them: other fields, malformed lines and records without a text are left out."""
    return json_lines(spark, path, "text string").where("text is not null").select("text")


def read_counts(rows: DataFrame) -> DataFrame:
    """(total, malformed) of rows with ``_corrupt``."""
    return rows.agg(F.count("*").alias("total"), F.count("_corrupt").alias("malformed"))


def metadata(files: DataFrame) -> DataFrame:
    """(source_file, source_path, file_size, file_type, title, author, creation_date, modification_date, page_count) of scanned files.

    Office files tell title, author and dates, PDF files what their information dictionary has in the clear; texts their first heading or line."""

    def run(batches):
        for batch in batches:
            rows = [_about(*x) for x in zip(*(batch.column(k).to_pylist() for k in range(3)))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), *(pa.array([r[1].get(k) for r in rows], pa.string()) for k in _ABOUT[:-1]), pa.array([r[1].get("page_count") for r in rows], pa.int64())], ["path", *_ABOUT])

    about = files.select("path", "ext", "content").mapInArrow(run, "path string, " + ", ".join(f"{k} string" for k in _ABOUT[:-1]) + ", page_count long")
    kind = F.when(F.col("ext").isin("pdf", "doc", "docx", "ppt", "pptx", "txt", "md"), F.col("ext")).otherwise("unknown")
    return files.select("path", F.col("name").alias("source_file"), F.col("length").alias("file_size"), kind.alias("file_type")).join(about, "path").select("source_file", F.col("path").alias("source_path"), "file_size", "file_type", *_ABOUT)


_ABOUT = ("title", "author", "creation_date", "modification_date", "page_count")


def _about(path: str, ext: str, raw: bytes) -> tuple[str, dict]:
    """What a file says of itself; nothing if it's broken."""
    try:
        if ext in ("docx", "pptx"):
            with zipfile.ZipFile(io.BytesIO(raw)) as z:
                core = ElementTree.fromstring(z.read("docProps/core.xml"))
                of = {x.tag.rsplit("}", 1)[-1]: x.text for x in core}
                pages = sum(n.startswith("ppt/slides/slide") for n in z.namelist()) or None
            return path, {"title": of.get("title"), "author": of.get("creator"), "creation_date": of.get("created"), "modification_date": of.get("modified"), "page_count": pages}
        if ext == "pdf":
            say = lambda k: (m.group(1).decode("latin-1") if (m := re.search(rb"/" + k + rb"\s*\(((?:[^()\\]|\\.)*)\)", raw)) else None)
            return path, {"title": say(b"Title"), "author": say(b"Author"), "creation_date": say(b"CreationDate"), "modification_date": say(b"ModDate"), "page_count": len(re.findall(rb"/Type\s*/Page\b", raw)) or None}
        if ext in ("txt", "md"):
            lines = [x.strip() for x in decode(raw[:4096]).split("\n")]
            return path, {"title": next((x.lstrip("#").strip() for x in lines if x.startswith("#")), next(filter(None, lines), None))}
        return path, {"title": path.rsplit("/", 1)[-1].rsplit(".", 1)[0]} if ext in ("doc", "ppt") else {}
    except Exception:  # a broken file has no metadata
        return path, {}


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines with ``_corrupt`` where a line is malformed; blank lines are none."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    kind = spark.createDataFrame([], f"{schema}, _corrupt string").schema
    return lines.select(F.from_json("value", kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r")).select("r.*")


def write_json_lines(df: DataFrame, path: str, one_file: bool = False) -> None:
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("ignoreNullFields", True).json(path)


def index(files: DataFrame) -> DataFrame:
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


def duplicate_groups(indexed: DataFrame) -> DataFrame:
    return indexed.groupBy("sha256").agg(F.sort_array(F.collect_list("path")).alias("paths"), F.count("*").alias("n")).where("n > 1")


def against_index(files: DataFrame, indexed: DataFrame) -> DataFrame:
    """Files with status: known (path and content), moved (content alone), changed (path alone) or new."""
    at, content = indexed.select("path", F.col("sha256").alias("old")), indexed.select("sha256").distinct().withColumn("seen", F.lit(True))
    rows = files.join(at, "path", "left").join(content, "sha256", "left")
    return rows.withColumn("status", F.when(F.col("old") == F.col("sha256"), "known").when(F.col("seen"), "moved").when(F.col("old").isNotNull(), "changed").otherwise("new")).drop("old", "seen")


def new_files(indexed: DataFrame, known: DataFrame) -> DataFrame:
    """Files (path, sha256, size) whose path the index doesn't have."""
    return indexed.join(known.select("path"), "path", "left_anti")


def missing(known: DataFrame, indexed: DataFrame) -> DataFrame:
    """Files of the index that are no longer there."""
    return known.join(indexed.select("path"), "path", "left_anti")


STATE = "path string, sha256 string, size long, stage string, status string, output string, error string, at timestamp"


def mark(state: DataFrame, done: DataFrame) -> DataFrame:
    """*state* after *done* (path, sha256, size, stage, status, output, error): the latest row of each path and stage stays.

    A file's hash and size are those of its latest row, so that one that changed or failed is finished once it's done as it is now."""
    rows = state.unionByName(done.withColumn("at", F.current_timestamp()), allowMissingColumns=True)
    return rows.groupBy("path", "stage").agg(F.max_by(F.struct("sha256", "size", "status", "output", "error", "at"), F.struct("at", F.col("status") == "ok")).alias("x")).select("path", "x.sha256", "x.size", "stage", "x.status", "x.output", "x.error", "x.at")


def failed(state: DataFrame, stage: str | None = None) -> DataFrame:
    """(path, stage, error) of what failed last."""
    rows = state.where("status = 'failed'")
    return (rows.where(F.col("stage") == stage) if stage else rows).select("path", "stage", "error")


def unfinished(indexed: DataFrame, state: DataFrame, stage: str, outputs: DataFrame | None = None) -> DataFrame:
    """Files whose *stage* isn't done with the same size and content or, if *outputs* (path) are given, whose declared output isn't there."""
    done = state.where((F.col("stage") == stage) & (F.col("status") == "ok"))
    if outputs is not None:
        done = done.join(outputs.select(F.col("path").alias("output")), "output", "left_semi").unionByName(done.where("output is null"), allowMissingColumns=True)
    return indexed.join(done.select("path", "sha256", "size"), ["path", "sha256", "size"], "left_anti")
