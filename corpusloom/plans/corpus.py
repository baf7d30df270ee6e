"""The corpus build from a folder of files: scan, extract, sections, chunks, scores, dedup, export, pretraining records, each step with a switch.

Every step is a table in the output folder, so that a step survives lost executors and a run that comes later takes up where files are done.
"""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import quality as Q
from ..functions import text as T
from ..operators import chunks as C
from ..operators import dedup, records
from ..sources import files, sinks

log = logging.getLogger(__name__)

STEPS = ("convert_office", "extract_pdf", "extract_text", "clean_markdown", "quality_filter", "rule_dedup", "semantic_dedup", "export", "pretrain")
SECTIONS = ("paths", "scan", "cleaner", "splitter", "dedup", "exporter")
DEFAULTS: dict[str, dict] = {
    "paths": {"input_dir": "", "output_dir": ""},
    "scan": {"supported_extensions": ["pdf", "doc", "docx", "ppt", "pptx", "txt", "md"]},
    "extractors": {"min_text_length": {"pdf": 50}},
    "cleaner": {"skip_sections": list(T.SKIP), "min_body_chars": 50, "min_final_body_chars": 150, "remove_garbled": True, "clean_refs": True, "fix_broken_lines": True, "watermark_keywords": list(T.WATERMARKS)},
    "splitter": {"max_segment_chars": 500, "min_segment_chars": 50},
    "quality": {"enabled": True, "filter_enabled": False, "min_score": 0.3, "max_noise_ratio": 0.1},
    "dedup": {"rule_dedup": {"enabled": True, "case_sensitive": False}, "semantic_dedup": {"similarity_threshold": 0.92}},
    "exporter": {"formats": ["jsonl", "json"]},
    "pretrain": {"format": "rich", "min_length": 100, "max_length": 1_000_000, "include_section_prefix": True},
    "steps": {s: s not in ("semantic_dedup",) for s in STEPS},
}


@dataclass
class Config:
    """Settings by section; what isn't given has its default."""

    values: dict[str, dict] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str, **overrides: str) -> Config:
        """From a JSON or YAML file of all sections that are required; input_dir and output_dir may be overridden."""
        with open(path, encoding="utf-8") as f:
            text = f.read()
        if path.endswith((".yaml", ".yml")):
            import yaml  # only where it's installed

            given = yaml.safe_load(text)
        else:
            given = json.loads(text)
        if not isinstance(given, dict):
            raise ValueError("the configuration is no mapping of sections")
        if absent := [s for s in SECTIONS if s not in given]:
            raise ValueError(f"sections are missing: {', '.join(absent)}")
        given.setdefault("paths", {}).update({k: v for k, v in overrides.items() if v})
        return cls(given).check()

    def check(self) -> Config:
        for k in ("input_dir", "output_dir"):
            if not self["paths"].get(k):
                raise ValueError(f"paths.{k} is empty")
        if unknown := set(self.values) - set(DEFAULTS):
            log.warning("sections that aren't known: %s", ", ".join(sorted(unknown)))
        return self

    def __getitem__(self, section: str) -> dict:
        return {**DEFAULTS.get(section, {}), **(self.values.get(section) or {})}

    def on(self, step: str) -> bool:
        return bool(self["steps"].get(step))


class Build:
    """One run; ``counts`` has what each step gave."""

    def __init__(self, spark: SparkSession, config: Config, engines: dict | None = None, embed: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """*engines* read more kinds of files (see sources.files.extract); *embed* adds ``embedding`` to chunks, for semantic dedup."""
        self.spark, self.config, self.engines, self.embed = spark, config.check(), engines, embed
        self.out = config["paths"]["output_dir"].rstrip("/")
        self.counts: dict[str, int] = {}
        self.errors: list[str] = []

    def stored(self, df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
        df.write.mode(mode).parquet(f"{self.out}/{name}")
        return self.spark.read.parquet(f"{self.out}/{name}")

    def found(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.out}/{name}")
        except AnalysisException:  # no such table yet
            return self.spark.createDataFrame([], schema)

    def extract(self, input_dir: str) -> DataFrame:
        """(path, ext, text, engine, error) of all files that are done, read now or earlier."""
        on = [*(("pdf",) if self.config.on("extract_pdf") else ()), *(files.KINDS["office"] if self.config.on("convert_office") else ()), *(files.KINDS["text"] if self.config.on("extract_text") else ())]
        scanned = files.scan(self.spark, input_dir, self.config["scan"]["supported_extensions"])
        self.counts["files_scanned"] = scanned.count()
        state = self.found("state", files.STATE)
        indexed = files.index(scanned.where(F.col("ext").isin(*on)))
        todo = files.unfinished(indexed, state, "extract")
        least = self.config["extractors"]["min_text_length"]
        new = scanned.join(todo.select("path", "sha256", "size"), "path")
        read = files.extract(new, self.engines).withColumn("error", F.coalesce("error", F.when(F.length(T.strip(F.col("text"))) < F.coalesce(*(F.when(F.col("ext") == k, F.lit(v)) for k, v in least.items()), F.lit(1)), "too short")))
        run = f"extracted/run={int(time.time() * 1000)}"
        rows = self.stored(read.join(todo.select("path", "sha256", "size"), "path"), run)
        done = rows.select("path", "sha256", "size", F.lit("extract").alias("stage"), F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("status"), F.lit(run).alias("output"), "error")
        self.stored(files.mark(state, done), "state.next")  # the old one is being read
        state = self.stored(self.spark.read.schema(files.STATE).parquet(f"{self.out}/state.next"), "state")
        ok = state.where("status = 'ok' and stage = 'extract'").select("path", F.regexp_extract("output", "run=([0-9]+)", 1).cast("long").alias("run"))
        every = self.spark.read.option("basePath", f"{self.out}/extracted").parquet(f"{self.out}/extracted").withColumn("run", F.col("run").cast("long"))
        every = every.join(ok, ["path", "run"], "left_semi").join(indexed.select("path"), "path", "left_semi")
        self.counts["files_extracted"] = every.count()
        self.errors = [f"{r['path']}: {r['error']}" for r in files.failed(state, "extract").join(indexed.select("path"), "path", "left_semi").orderBy("path").limit(20).collect()]
        self.counts["errors"] = files.failed(state, "extract").join(indexed.select("path"), "path", "left_semi").count()
        return every

    def sections(self, extracted: DataFrame) -> DataFrame:
        """Sections of markdown files by their headings, of others by title lines."""
        c = self.config["cleaner"]
        rows = extracted.select("path", F.element_at(F.split("path", "/"), -1).alias("source_file"), "ext", "text")
        marked = F.col("ext").isin("md", "markdown", "docx", "pptx")
        marks, skip = tuple(c["watermark_keywords"]), tuple(c["skip_sections"])
        headed = C.markdown_sections(rows.where(marked), order="path", skip=skip, least_top=c["min_final_body_chars"], least=c["min_body_chars"], watermarks=marks, references=c["clean_refs"], garbled=c["remove_garbled"])
        named = rows.where(~marked).select(F.struct("path", "source_file").alias("at"), F.col("source_file").alias("name"), "text")
        plain = C.plain_sections(named, order="at", name="name", watermarks=marks, mend=c["fix_broken_lines"]).withColumn("path", F.col("at.path")).drop("at")
        both = headed.unionByName(plain).join(rows.select("path", "source_file", "ext"), "path")
        return both.withColumn("source_type", C.source_type(F.col("source_file"), F.when(F.col("ext") == "markdown", "md").otherwise(F.col("ext"))))

    def run(self, input_dir: str | None = None) -> dict[str, int]:
        began, on = time.time(), self.config.on
        input_dir = input_dir or self.config["paths"]["input_dir"]
        extracted = self.extract(input_dir)
        if on("clean_markdown") and self.counts["files_extracted"]:
            sections = self.stored(self.sections(extracted), "sections")
            self.counts["files_cleaned"] = sections.select("path").distinct().count()
            if on("export") or on("pretrain"):
                self.from_sections(sections, input_dir)
        self.report(time.time() - began)
        return self.counts

    def from_sections(self, sections: DataFrame, input_dir: str) -> None:
        on, s, q = self.config.on, self.config["splitter"], self.config["quality"]
        chunks = C.section_chunks(sections, s["max_segment_chars"], s["min_segment_chars"], "source_type")
        known = records.category_map(sections.select("path").distinct(), input_dir if ":" in input_dir else "file:" + input_dir)
        chunks = self.stored(records.with_category(chunks, "source_file", known), "chunks")
        self.counts["chunks_generated"] = chunks.count()
        if on("quality_filter") and q["enabled"]:
            scored = chunks.withColumn("q", Q.scores(F.col("content"))).withColumn("quality_score", F.col("q.quality_score")).withColumn("quality", F.struct(*(F.col(f"q.{n}") for n in Q.NAMES[:4]))).drop("q")
            chunks = self.stored(scored, "scored")
            if q["filter_enabled"]:
                good = (F.col("quality_score") >= q["min_score"]) & (F.col("quality.noise_ratio") <= q["max_noise_ratio"])
                sinks.previews(chunks.where(~good)).write.mode("overwrite").json(f"{self.out}/reports/filtered_chunks")
                chunks = chunks.where(good)
            self.counts["chunks_kept"] = chunks.count()
        rule = self.config["dedup"].get("rule_dedup", {})
        if on("rule_dedup") and rule.get("enabled", True):
            chunks = self.stored(dedup.rule(chunks, "content", "chunk_index", rule.get("case_sensitive", False)), "unique")
            self.counts["chunks_after_rule_dedup"] = chunks.count()
        if on("semantic_dedup") and self.embed:
            limit = self.config["dedup"].get("semantic_dedup", {}).get("similarity_threshold", 0.92)
            judged = self.stored(dedup.semantic_reasons(self.embed(chunks), limit, "embedding", "chunk_index", "content"), "judged")
            sinks.previews(judged.where("not kept").drop("embedding")).write.mode("overwrite").json(f"{self.out}/reports/semantic_filtered_chunks")
            chunks = judged.where("kept").drop("embedding", "kept", "reason", "score")
            self.counts["chunks_after_semantic_dedup"] = chunks.count()
        if on("export"):
            self.counts["output_records"] = sinks.rich(chunks, f"{self.out}/jsonl")
            if "json" in self.config["exporter"]["formats"]:
                about = records.corpus_metadata(chunks, "source_file", "source_type", "content", "quality_score" if "quality_score" in chunks.columns else None)
                sinks.put_text(chunks, f"{self.out}/json/corpus_metadata.json", json.dumps(about.head().asDict(), ensure_ascii=False, indent=2))
        if on("pretrain"):
            p = self.config["pretrain"]
            done = sinks.pretraining(chunks, f"{self.out}/pretrain", least=p["min_length"], most=p["max_length"], rich=p["format"] == "rich", prefix=p["include_section_prefix"])
            self.counts["pretrain_records"] = done["written"]

    def report(self, seconds: float) -> None:
        lines = ["Corpus build", *(f"  {k}: {v}" for k, v in self.counts.items()), f"  seconds: {seconds:.1f}", *(f"  - {e}" for e in self.errors)]
        if self.counts.get("errors", 0) > len(self.errors):
            lines.append(f"  ... and {self.counts['errors'] - len(self.errors)} errors more")
        log.info("\n".join(lines))
        sinks.put_text(self.spark.range(1), f"{self.out}/reports/pipeline_report.txt", "\n".join(lines) + "\n")

