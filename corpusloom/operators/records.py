"""Pretraining records, chat records and their validation, dataset utilities and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import folds
from ..functions import text as T
from .dedup import keep_first
from .scale import first_rows

LANGUAGES = {
    "Python": "py", "JavaScript": "js", "TypeScript": "ts", "Java": "java", "C": "c", "C++": "cpp", "Go": "go", "Rust": "rs", "Ruby": "rb", "PHP": "php", "Swift": "swift", "Kotlin": "kt",
    "Scala": "scala", "R": "r", "Julia": "jl", "SQL": "sql", "Shell": "sh", "HTML": "html", "CSS": "css", "JSON": "json", "XML": "xml", "YAML": "yaml yml", "Markdown": "md",
}
_BY_EXTENSION = {f".{e}": name for name, es in LANGUAGES.items() for e in es.split()}


# pretraining
def language(ext: Column) -> Column:
    """Of an extension with its dot; one that isn't known stays as it is."""
    known = F.create_map(*(F.lit(x) for kv in _BY_EXTENSION.items() for x in kv))
    return F.coalesce(F.try_element_at(known, F.lower(ext)), ext)


def code_record(code: Column, repo: Column, file: Column, ext: Column) -> Column:
    """Code under a header of what is known of its repository, file and language."""
    given = lambda name, c, v: F.when(c != "", F.concat(F.lit(f"{name}: "), v))
    parts = F.concat_ws(" | ", given("Repository", repo, repo), given("File", file, file), given("Language", ext, language(ext)))
    return F.when(parts == "", code).otherwise(F.concat(F.lit("# "), parts, F.lit("\n\n"), code))


def code_records(df: DataFrame, repo: str, file: str, ext: str, texts: tuple[str, ...] = ("text",), least: int = 50) -> DataFrame:
    """(text) of the first of *texts* that isn't empty, under its header, if the code itself has *least* characters."""
    code = F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in texts))
    return df.where(F.length(code) >= least).select(code_record(code, F.col(repo), F.col(file), F.col(ext)).alias("text"))


def section_record(section: Column, content: Column) -> Column:
    bare = F.coalesce(section == "", F.lit(True)) | content.startswith("#")
    return F.when(bare, content).otherwise(F.concat(F.lit("# "), section, F.lit("\n\n"), content))


def rich_record(section: Column, content: Column, **meta: Column) -> Column:
    return F.struct(section_record(section, content).alias("text"), F.struct(*(c.alias(k) for k, c in meta.items())).alias("meta"))


def stem(path: Column) -> Column:
    """The file name without its last extension and without the cleaner's suffix."""
    name = F.regexp_extract(path, "([^/]*)$", 1)
    return F.regexp_replace(F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", ""), "_cleaned$", "")


def category(path: Column, root: str) -> Column:
    """First folder below *root* (or the file's own name if it lies there), else the parent folder, else 'unknown'."""
    below = F.regexp_extract(path, "^\\Q" + root.rstrip("/") + "\\E/([^/]+)", 1) if root else F.lit("")
    parent = F.regexp_extract(path, "([^/]+)/[^/]+$", 1)
    return F.when(below != "", below).when(parent != "", parent).otherwise("unknown")


def category_map(files: DataFrame, root: str) -> DataFrame:
    """(stem, category) of files (path): the first folder below *root*, or the name of *root* for what lies in it; of one stem the last path wins."""
    inside = F.regexp_extract("path", "^\\Q" + root.rstrip("/") + "\\E/([^/]+)/", 1)
    name = F.regexp_replace(F.regexp_extract("path", "([^/]*)$", 1), r"(?<=[^.])\.[^.]*$", "")
    rows = files.select("path", name.alias("stem"), F.when(inside != "", inside).otherwise(root.rstrip("/").rsplit("/", 1)[-1]).alias("category"))
    return rows.groupBy("stem").agg(F.max_by("category", "path").alias("category"))


def with_category(df: DataFrame, source: str, known: DataFrame, root: str = "") -> DataFrame:
    """Adds ``category``: by the stem of *source* in *known* (stem, category), else by its path."""
    by_stem = known.select(F.col("stem").alias("__stem"), F.col("category").alias("__category"))
    joined = df.join(by_stem, stem(F.col(source)) == F.col("__stem"), "left")
    return joined.withColumn("category", F.coalesce("__category", category(F.coalesce(F.col(source), F.lit("")), root))).drop("__stem", "__category")


def length_gate(df: DataFrame, least: int = 100, most: int = 1_000_000, text: str = "text") -> DataFrame:
    return df.where(F.length(T.strip(F.col(text))).between(least, most))


# chat
def message(role: str | Column, content: Column) -> Column:
    return F.struct((F.lit(role) if isinstance(role, str) else role).alias("role"), content.alias("content"))


def qa_messages(question: Column, answer: Column, context: Column | None = None) -> Column:
    ask = question if context is None else F.when(F.coalesce(context, F.lit("")) != "", F.concat(F.lit("背景信息：\n"), context, F.lit("\n\n问题："), question)).otherwise(question)
    return F.array(message("user", ask), message("assistant", answer))


def instruction_messages(instruction: Column, given: Column, output: Column) -> Column:
    return F.array(message("user", F.when(F.coalesce(given, F.lit("")) != "", F.concat(instruction, F.lit("\n\n"), given)).otherwise(instruction)), message("assistant", output))


def sharegpt_messages(conversations: Column) -> Column:
    return F.transform(conversations, lambda m: message(F.when(m["from"] == "human", "user").otherwise("assistant"), m["value"]))


def openassistant_messages(messages: Column) -> Column:
    return F.transform(messages, lambda m: message(F.coalesce(m["role"], F.lit("")), F.coalesce(m["content"], F.lit(""))))


def code_messages(code: Column, language: Column, description: Column | None = None) -> Column:
    ask = F.concat(F.lit("请用"), language, F.lit("编写代码"))
    if description is not None:
        ask = F.when(F.coalesce(description, F.lit("")) != "", F.concat(ask, F.lit("："), description)).otherwise(ask)
    return F.array(message("user", ask), message("assistant", F.concat(F.lit("```"), language, F.lit("\n"), code, F.lit("\n```"))))


def summary_messages(source: Column, summary: Column) -> Column:
    return F.array(message("user", F.concat(F.lit("请总结以下内容：\n\n"), source)), message("assistant", summary))


def translation_messages(source: Column, target: Column, of: str = "中文", to: str = "英文") -> Column:
    return F.array(message("user", F.concat(F.lit(f"请将以下{of}翻译成{to}：\n\n"), source)), message("assistant", target))


def record_format(raw: Column) -> Column:
    """Of a JSON object, by the presence of keys."""
    keys = F.json_object_keys(raw)
    has = lambda *k: F.forall(F.array(*map(F.lit, k)), lambda x: F.array_contains(keys, x))
    return F.when(has("messages"), "messages").when(has("question", "answer"), "qa").when(has("instruction"), "alpaca").when(has("conversations"), "sharegpt").otherwise("unknown")


def dataset_format(raw: Column) -> Column:
    keys = F.json_object_keys(raw)
    has = lambda *k: F.forall(F.array(*map(F.lit, k)), lambda x: F.array_contains(keys, x))
    return F.when(has("messages"), "messages").when(has("prompt", "completion"), "prompt-completion").when(has("text"), "text").otherwise("unknown")


def total_length(messages: Column) -> Column:
    return F.aggregate(messages, F.lit(0), lambda n, m: n + F.coalesce(F.length(m["content"]), F.lit(0)))


def assemble(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, messages) in the order of turns."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), F.col(role).alias("role"), F.col(text).alias("content"))))
    return turns.groupBy(conv).agg(F.transform(ordered, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def message_errors(messages: Column, strict: bool = False) -> Column:
    """What is wrong with a chat; an empty array if nothing is."""
    bad = [
        (F.size(messages) < 2, "fewer than 2 messages"),
        (F.exists(messages, lambda m: ~F.coalesce(m["role"].isin("user", "assistant", "system", "tool"), F.lit(False))), "unknown role"),
        (F.exists(messages, lambda m: m["content"].isNull()), "content is not a string"),
    ]
    if strict:
        bad.append((F.coalesce(F.try_element_at(messages, F.lit(-1))["role"] != "assistant", F.lit(True)), "last message is not the assistant's"))
    return F.filter(F.array(*(F.when(c, m) for c, m in bad)), lambda x: x.isNotNull())


def pairs_of(reply: Column) -> Column:
    """Questions and answers of a model's reply, answers over several lines; incomplete pairs go."""
    return folds.qa_pairs(reply)


def turns_of(reply: Column) -> Column:
    """User and assistant turns of a model's reply, each over several lines; what comes before the first goes."""
    return folds.turns(reply)


# datasets
def hash_order(seed: int, order: str) -> Column:
    return F.md5(F.concat(F.col(order).cast("string"), F.lit(str(seed))))


def split(df: DataFrame, test: float = 0.1, val: float = 0.0, seed: int = 42, order: str = "doc_id") -> DataFrame:
    """Adds ``split``: exact sizes int(n * share), test, then validation, then training, in the order of a hash.

    Repeated values of *order* fall on one side, as their hashes are equal."""
    n = df.count()
    part = first_rows(df, hash_order(seed, order), order, [int(n * test), int(n * val)])
    return df.withColumn("split", F.when(part == 0, "test").when(part == 1, "val").otherwise("train"))


def split_info(df: DataFrame, source: str, test: float, val: float, seed: int) -> DataFrame:
    """One row: where the rows came from, how they were split, and the sizes."""
    of = lambda k: F.count_if(F.col("split") == k).alias(k)
    return df.agg(F.count("*").alias("total"), of("train"), of("val"), of("test")).select(F.lit(source).alias("source"), F.lit(seed).alias("seed"), F.lit(test).alias("test_size"), F.lit(val).alias("val_size"), "total", "train", "val", "test")


def sample(df: DataFrame, n: int | None = None, ratio: float | None = None, seed: int = 42, order: str = "doc_id") -> DataFrame:
    """*n* rows, or int(total * ratio), without replacement; *n* wins.  Exact where *order* is unique."""
    size = n if n is not None else df.count() if ratio is None else int(df.count() * ratio)
    return df.where(first_rows(df, hash_order(seed, order), order, [size]) == 0) if size else df.limit(0)


def merge(frames: dict[str, DataFrame], text: str = "text", dedup: bool = False, order: str | None = None) -> DataFrame:
    """The frames' rows with ``origin``, those with a text, columns by name.

    With *dedup*, rows whose text comes again go: the first frame that has it keeps the row of the smallest *order* (if named)."""
    out = None
    for k, (name, df) in enumerate(frames.items()):
        df = df.where(F.length(text) > 0).withColumn("origin", F.lit(name)).withColumn("__frame", F.lit(k))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if dedup:
        out = keep_first(out, F.md5(text), "__frame", *([order] if order else []))
    return out.drop("__frame")


def merge_stats(frames: dict[str, DataFrame], text: str = "text") -> DataFrame:
    """(origin, total, unique): rows of each frame, and those that stay when repeated texts go; the sums are the run's."""
    rows = merge(frames, text)
    stay = merge({k: df.select(text) for k, df in frames.items()}, text, dedup=True).groupBy("origin").agg(F.count("*").alias("unique"))
    return rows.groupBy("origin").agg(F.count("*").alias("total")).join(stay, "origin", "left").select("origin", "total", F.coalesce("unique", F.lit(0).cast("long")).alias("unique"))


def shuffled(df: DataFrame, seed: int = 42, order: str = "doc_id") -> DataFrame:
    """The rows in the order of a hash."""
    return df.orderBy(hash_order(seed, order), order)


def analyse(df: DataFrame, text: str = "text") -> DataFrame:
    """One row: samples, characters, words, least, most and mean length, upper median (from the counts of lengths)."""
    words = F.size(F.filter(F.split(F.col(text), r"(?U)\s+"), lambda w: w != ""))
    by_length = df.groupBy(F.length(text).alias("n")).agg(F.count("*").alias("rows"), F.sum(words).alias("w"))  # a row for each length
    upto = Window.orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = by_length.withColumn("upto", F.sum("rows").over(upto)).withColumn("total", F.sum("rows").over(Window.partitionBy()))
    at = F.expr("total div 2 + 1")
    return ranked.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("samples"), F.sum(F.col("n") * F.col("rows")).cast("long").alias("chars"), F.sum("w").cast("long").alias("words"), F.min("n").cast("long").alias("min_length"), F.max("n").cast("long").alias("max_length"),
        (F.sum(F.col("n") * F.col("rows")) / F.sum(F.when(F.col("n").isNotNull(), F.col("rows")))).alias("avg_length"), F.max(F.when((F.col("upto") >= at) & (F.col("upto") - F.col("rows") < at), F.col("n"))).cast("long").alias("median_length"),
    )


def text_of_chat(text: Column, messages: Column) -> Column:
    """A record's text, or else its messages joined by blanks."""
    return F.coalesce(text, F.array_join(F.transform(messages, lambda m: F.coalesce(m["content"], F.lit(""))), " "))


def by_group(df: DataFrame, group: str = "source", text: str = "text") -> DataFrame:
    return df.groupBy(group).agg(F.count("*").alias("n"), F.sum(F.length(text)).cast("long").alias("chars"), F.round(F.sum(F.length(text)) / 1048576, 1).alias("mb"))


def human_size(n: Column) -> Column:
    out = F.format_string("%.1f TB", n / float(1 << 40))
    for power, unit in ((40, "GB"), (30, "MB"), (20, "KB"), (10, "B")):
        out = F.when(n < 1 << power, F.format_string(f"%.1f {unit}", n / float(1 << (power - 10)))).otherwise(out)
    return out


def pdf_date(s: Column) -> Column:
    """D:YYYYMMDD, with as many of HHmmSS as there are, as ISO text; other texts stay as they are, an empty one is null."""
    digits = F.regexp_extract(F.replace(F.replace(s, F.lit("D:"), F.lit("")), F.lit("'"), F.lit("")), r"^(\d{8}(?:\d{2}){0,3})", 1)
    time = F.try_to_timestamp(F.nullif(F.rpad(digits, F.when(digits == "", 0).otherwise(14), "0"), F.lit("")), F.lit("yyyyMMddHHmmss"))
    return F.nullif(F.coalesce(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"), s), F.lit(""))


def pivot_by_status(df: DataFrame, group: str | Column, status: str, values: list[str]) -> DataFrame:
    """(group, total, one column for each of *values*)."""
    group = F.col(group) if isinstance(group, str) else group
    return df.groupBy(group.alias("category")).agg(F.count("*").alias("total"), *(F.count_if(F.col(status) == v).alias(v) for v in values))


def index_stats(indexed: DataFrame, root: str = "") -> DataFrame:
    """(category, files, unique, duplicates, bytes) of an index (path, sha256, size) by the first folder below *root*."""
    kinds = indexed.groupBy(category(F.col("path"), root).alias("category"), "sha256").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    return kinds.groupBy("category").agg(F.sum("n").alias("files"), F.count("*").alias("unique"), (F.sum("n") - F.count("*")).alias("duplicates"), F.sum("bytes").alias("bytes"))


def corpus_metadata(df: DataFrame, source: str = "source", kind: str = "lang", text: str = "text", score: str | None = None) -> DataFrame:
    """One row: sources and their number, records by kind, characters, records, mean score to four places."""
    by_kind = df.groupBy(source, kind).agg(F.count("*").alias("n"), F.sum(F.length(text)).alias("chars"), (F.sum(score) if score else F.lit(None).cast("double")).alias("s"), F.count(score if score else F.lit(1)).alias("k"))
    kinds = by_kind.groupBy(kind).agg(F.sum("n").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce(F.col(kind), F.lit("unknown")), "n")))).alias("types"))
    rest = by_kind.agg(
        F.count_distinct(source).alias("n_sources"), F.array_join(F.sort_array(F.collect_set(source)), ",").alias("sources"), F.sum("chars").cast("long").alias("total_chars"),
        F.sum("n").cast("long").alias("total_records"), F.round(F.sum("s") / F.sum("k"), 4).alias("mean_score"),
    )
    return rest.join(kinds)  # one row each


def funnel(**counts: DataFrame) -> DataFrame:
    """(step, rows) of the named steps, in one job."""
    out = None
    for k, (name, df) in enumerate(counts.items()):
        one = df.agg(F.count("*").alias("rows")).select(F.lit(k).alias("step_no"), F.lit(name).alias("step"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def below(df: DataFrame, level: str, line: str = "line") -> DataFrame:
    """Log lines of ERROR, or of WARNING and ERROR, or all."""
    words = {"ERROR": ["ERROR"], "WARNING": ["WARNING", "ERROR"]}.get(level, [])
    return df.where(" or ".join(f"contains({line}, '{w}')" for w in words)) if words else df


def folder_category(path: Column, names: dict[str, str], keywords: dict[str, dict[str, str]] | None = None) -> Column:
    """The category of a file: by the number that its folder's name begins with in *names*, else the folder's name; for the numbers in *keywords* a
    keyword in the file's name picks the part of it."""
    folder, name = F.regexp_extract(path, "([^/]+)/[^/]+$", 1), F.regexp_extract(path, "([^/]+)$", 1)
    number = F.regexp_extract(folder, r"^(\d+)", 1)
    known = F.create_map(*(F.lit(x) for kv in names.items() for x in kv)) if names else None
    out = F.coalesce(F.try_element_at(known, number), folder) if names else folder
    for n, words in (keywords or {}).items():
        part = F.lit(None).cast("string")
        for w, to in reversed(words.items()):
            part = F.when(F.contains(name, F.lit(w)), F.lit(to)).otherwise(part)
        out = F.when(number == n, F.coalesce(part, out)).otherwise(out)
    return F.when(folder == "", "unknown").otherwise(out)
