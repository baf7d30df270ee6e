"""Chat data from JSON records: conversion, validation and its report, prompts for a model and calls of it."""

from __future__ import annotations

import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import records as R

_MESSAGES = "array<struct<role:string,content:string>>"
RECORD = f"question string, answer string, context string, instruction string, input string, output string, prompt string, completion string, messages {_MESSAGES}, conversations array<struct<`from`:string,value:string>>"
ROLES = ("user", "assistant", "system", "tool")


def convert(df: DataFrame, raw: str = "value", input_format: str = "auto", output_format: str = "messages", least: int = 10, most: int = 50_000) -> DataFrame:
    """Adds ``format``, ``status`` (converted, skipped, error) and ``record``, the converted JSON of what is.

    Formats: qa, alpaca, conversation, sharegpt, openassistant, messages (taken as it is) and, found out by the keys, auto.  Malformed JSON is an
    error; what has no known format or fewer than *least* or more than *most* characters is skipped.
    """
    text = F.col(raw)
    r = F.from_json(text, RECORD)
    broken = F.try_parse_json(text).isNull()
    found = R.record_format(text) if input_format == "auto" else F.lit(input_format)
    rows = df.withColumn("__r", r).withColumn("format", F.when(broken, "broken").otherwise(found))
    given = lambda c: F.coalesce(F.col(f"__r.{c}"), F.lit(""))
    none = F.array().cast(_MESSAGES)
    chat = (
        F.when(F.col("format") == "qa", R.qa_messages(given("question"), given("answer"), given("context")))
        .when(F.col("format") == "alpaca", R.instruction_messages(given("instruction"), given("input"), given("output")))
        .when(F.col("format").isin("conversation", "messages"), F.coalesce("__r.messages", none))
        .when(F.col("format") == "sharegpt", R.sharegpt_messages(F.coalesce("__r.conversations", F.array().cast("array<struct<from:string,value:string>>"))))
        .when(F.col("format") == "openassistant", R.openassistant_messages(F.coalesce("__r.messages", none)))
    )
    completion = (F.col("format") == "qa") if output_format != "messages" else F.lit(False)
    rows = rows.withColumn("__m", chat)
    size = F.when(completion, F.length(given("question")) + F.length(given("answer"))).otherwise(R.total_length(F.col("__m")))
    record = F.when(completion, F.to_json(F.struct(given("question").alias("prompt"), given("answer").alias("completion")))).when(F.col("format") == "messages", text).otherwise(F.to_json(F.struct(F.col("__m").alias("messages"))))
    ok = (F.col("__m").isNotNull() | completion) & size.between(least, most)
    status = F.when(F.col("format") == "broken", "error").when(F.coalesce(ok, F.lit(False)), "converted").otherwise("skipped")
    return rows.withColumn("status", status).withColumn("record", F.when(F.col("status") == "converted", record)).drop("__r", "__m")


def conversion_stats(converted: DataFrame) -> DataFrame:
    """(total, converted, skipped, errors)."""
    of = lambda s: F.count_if(F.col("status") == s)
    return converted.agg(F.count("*").alias("total"), of("converted").alias("converted"), of("skipped").alias("skipped"), of("error").alias("errors"))


def _kind(v: Column) -> Column:
    """The kind of a variant: OBJECT, ARRAY, STRING ..., null where there is none."""
    return F.regexp_extract(F.schema_of_variant(v), "^([A-Z]+)", 1)


def _message_errors(m: Column, i: Column) -> Column:
    role, content = F.try_variant_get(m, "$.role", "variant"), F.try_variant_get(m, "$.content", "variant")
    name = F.try_variant_get(m, "$.role", "string")
    say = lambda what: F.concat(F.lit("message "), i.cast("string"), F.lit(what))
    return F.when(_kind(m) != "OBJECT", F.array(say(" is no object"))).otherwise(
        F.array(
            F.when(role.isNull(), say(" has no role")).when(~F.coalesce(name.isin(*ROLES), F.lit(False)), F.concat(say(" has an unknown role: "), F.coalesce(name, F.lit("null")))),
            F.when(content.isNull(), say(" has no content")).when(_kind(content) != "STRING", say(" has content that is no text")),
        )
    )


def check(df: DataFrame, raw: str = "value", strict: bool = False) -> DataFrame:
    """Adds ``format`` (messages, prompt-completion, text, unknown, broken), ``errors`` and ``valid`` to JSON records."""
    rows = df.withColumn("__v", F.try_parse_json(F.col(raw)))
    rows = rows.withColumn("format", F.when(F.col("__v").isNull(), "broken").otherwise(R.dataset_format(F.col(raw))))
    messages = F.try_variant_get("__v", "$.messages", "variant")
    rows = rows.withColumn("__kind", _kind(messages)).withColumn("__m", F.try_variant_get("__v", "$.messages", "array<variant>"))
    last = F.try_variant_get(F.element_at("__m", F.size("__m")), "$.role", "string")
    each = F.flatten(F.transform("__m", _message_errors))
    each = F.concat(each, F.array(F.when(F.coalesce(last, F.lit("")) != "assistant", "last message is not the assistant's"))) if strict else each
    chat = F.when(F.col("__kind") != "ARRAY", F.array(F.lit("messages are no list"))).when(F.size("__m") < 2, F.array(F.lit("fewer than 2 messages"))).otherwise(each)
    text = lambda k: F.when(F.coalesce(_kind(F.try_variant_get("__v", f"$.{k}", "variant")), F.lit("")) != "STRING", f"{k} is no text")
    errors = (
        F.when(F.col("format") == "broken", F.array(F.lit("malformed JSON")))
        .when(F.col("format") == "messages", chat)
        .when(F.col("format") == "prompt-completion", F.array(text("prompt"), text("completion")))
        .otherwise(F.array(F.lit("unknown format")))
    )
    rows = rows.withColumn("errors", F.filter(errors, lambda e: e.isNotNull()))
    return rows.withColumn("valid", F.size("errors") == 0).drop("__v", "__m", "__kind")


def validation_stats(checked: DataFrame, raw: str = "value") -> DataFrame:
    """One row: samples, valid and invalid ones, errors; characters and messages of chats: least, most, mean."""
    chat = F.when(F.col("format") == "messages", F.coalesce(F.from_json(raw, f"messages {_MESSAGES}")["messages"], F.array().cast(_MESSAGES)))
    rows = checked.select("valid", "errors", chat.alias("m")).withColumn("chars", F.when(F.col("m").isNotNull(), R.total_length(F.col("m"))))
    return rows.agg(
        F.count("*").alias("samples"), F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("invalid"), F.coalesce(F.sum(F.size("errors")), F.lit(0)).cast("long").alias("errors"),
        F.min("chars").cast("long").alias("min_chars"), F.max("chars").cast("long").alias("max_chars"), F.avg("chars").alias("avg_chars"), F.avg(F.when(F.col("m").isNotNull(), F.size("m"))).alias("avg_messages"),
    )


def frequencies(checked: DataFrame, raw: str = "value", top_errors: int = 10) -> DataFrame:
    """(kind, name, n): how often each field, each role of chats and each of the *top_errors* errors comes."""
    fields = checked.select(F.explode(F.json_object_keys(raw)).alias("name")).groupBy("name").agg(F.count("*").alias("n")).select(F.lit("field").alias("kind"), "name", "n")
    chat = F.explode(F.from_json(raw, f"messages {_MESSAGES}")["messages"])
    roles = checked.where("format = 'messages'").select(chat.alias("m")).groupBy(F.coalesce("m.role", F.lit("unknown")).alias("name")).agg(F.count("*").alias("n")).select(F.lit("role").alias("kind"), "name", "n")
    errors = checked.select(F.explode("errors").alias("name")).groupBy("name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name").limit(top_errors).select(F.lit("error").alias("kind"), "name", "n")
    return fields.unionByName(roles).unionByName(errors)


def report(stats: DataFrame, counts: DataFrame) -> str:
    """The report as text; both tables are a few rows."""
    s = stats.head().asDict()
    out = ["SFT data", f"  samples {s['samples']}, valid {s['valid']} ({100 * s['valid'] / max(s['samples'], 1):.1f} %), invalid {s['invalid']}, errors {s['errors']}"]
    if s["min_chars"] is not None:
        out.append(f"  characters: {s['min_chars']} to {s['max_chars']}, mean {s['avg_chars']:.1f}; messages: mean {s['avg_messages']:.1f}")
    for kind in ("field", "role", "error"):
        rows = counts.where(F.col("kind") == kind).orderBy(F.desc("n"), "name").limit(100).collect()
        out += [f"{kind}s"] * bool(rows) + [f"  {r['name']}: {r['n']}" for r in rows]
    return "\n".join(out)


# prompts
QA_SYSTEM = {
    "general": "请仅依据所给材料编写优质问答。", "technical": "你熟悉工程技术，请据技术材料编写问答，术语务求准确。", "academic": "你从事学术研究，请据学术材料编写有深度的问答。",
    "code": "你精通编程，请就所给代码的功能、用法与良好实践编写问答。", "energy": "你熟悉能源行业，请据能源材料编写专业问答。",
}
CHAT_SYSTEM = {"qa": "你学识广博，回答准确。", "code": "你精通编程，能解决问题并给出示例代码。", "analysis": "你擅长分析，能给出见解。", "energy": "你熟悉能源系统、能源政策与能源技术。"}
SUMMARY = {"brief": "请用一两句话说明要点：", "detailed": "请详细概括主要观点与关键细节：", "bullet": "请列出要点："}
LANGUAGES = {"zh": "中文", "en": "英文", "ja": "日语"}


def _fill(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def qa_prompt(context: Column, questions: int = 3) -> Column:
    return _fill(f"请为下面的材料编写{questions}组问答。问题要具体且角度各异，答案要完整并只依据材料。每组写成两段，分别以Q:和A:开头。\n\n材料：\n", context)


def chat_prompt(topic: Column, rounds: int = 3, context: Column | None = None) -> Column:
    more = F.when(F.coalesce(context, F.lit("")) != "", _fill("\n参考材料：", context)).otherwise("") if context is not None else F.lit("")
    return _fill(f"请写一段{rounds}轮的对话，话题是“", topic, "”。提问逐轮深入，回答详实自然。每句以User:或Assistant:开头。", more)


def summary_prompt(text: Column, style: str = "brief") -> Column:
    return _fill(SUMMARY.get(style, SUMMARY["brief"]) + "\n\n", text)


def translation_prompt(text: Column, of: str = "zh", to: str = "en") -> Column:
    return _fill(f"请把下面的{LANGUAGES.get(of, of)}准确而流畅地译成{LANGUAGES.get(to, to)}：\n\n", text)


def code_prompt(code: Column, language: str = "python") -> Column:
    return _fill(f"请说明下面这段{language}代码做什么、怎样做、还能怎样改进：\n\n```{language}\n", code, "\n```")


def instruction_prompt(kind: str, **given: Column) -> Column:
    """A prompt of one of four kinds: classification (categories, text), extraction (entity_type, text), generation (instruction, constraints), reasoning (question, context)."""
    optional = lambda name, k: F.when(F.coalesce(given[k], F.lit("")) != "", _fill(f"\n{name}：", given[k])).otherwise("") if k in given else ""
    if kind == "classification":
        return _fill("请判断文本属于哪一类，只写类名。\n可选：", given["categories"], "\n文本：", given["text"])
    if kind == "extraction":
        return _fill("请列出文本中的全部", given["entity_type"], "。\n文本：", given["text"])
    if kind == "generation":
        return _fill("请按要求写作。\n要求：", given["instruction"], optional("限制", "constraints"))
    if kind == "reasoning":
        return _fill("请逐步推理并作答。\n问题：", given["question"], optional("已知", "context"))
    raise ValueError(f"unknown kind of instruction: {kind}")


# calls of a model
Client = Callable[[list[str]], list[str]]


def retrying(client: Client, retries: int = 3, delay: float = 1.0) -> Client:
    """*client*, tried *retries* times with pauses of *delay* seconds, twice that, and so on."""

    def call(prompts: list[str]) -> list[str]:
        for k in range(retries):
            try:
                return client(prompts)
            except Exception:
                if k + 1 == retries:
                    raise
                time.sleep(delay * (k + 1))
        return []

    return call


def generate(df: DataFrame, prompt: Column, client: Client, name: str = "reply", batch: int = 16) -> DataFrame:
    """Adds the replies of *client* (a function from prompts to replies), called on *batch* prompts at a time where the rows are, and ``<name>_error``.

    A batch that fails has null replies and says why in each of its rows."""
    @F.arrow_udf("reply string, error string")
    def ask(prompts: pa.Array) -> pa.Array:
        replies: list[str | None] = []
        errors: list[str | None] = []
        texts = prompts.to_pylist()
        for k in range(0, len(texts), batch):
            some = texts[k : k + batch]
            try:
                got, error = list(client(some)), None
                if len(got) != len(some):
                    got, error = [None] * len(some), f"{len(got)} replies to {len(some)} prompts"
            except Exception as e:  # a model's failure is data, not the job's
                got, error = [None] * len(some), f"{type(e).__name__}: {e}"
            replies += got
            errors += [error] * len(some)
        return pa.StructArray.from_arrays([pa.array(replies, pa.string()), pa.array(errors, pa.string())], ["reply", "error"])

    rows = df.withColumn("__asked", ask.asNondeterministic()(prompt))  # else a filter on replies asks again, before the rows lie as *df* has them
    return rows.withColumn(name, F.col("__asked.reply")).withColumn(f"{name}_error", F.col("__asked.error")).drop("__asked")


def qa_data(df: DataFrame, client: Client, text: str = "text", questions: int = 3) -> DataFrame:
    """(messages, context) of every question and answer that the model makes of each text."""
    asked = generate(df.select(F.col(text).alias("context")), qa_prompt(F.col("context"), questions), client)
    pairs = asked.select("context", F.inline(R.pairs_of(F.col("reply"))))
    return pairs.select(R.qa_messages(F.col("question"), F.col("answer")).alias("messages"), "context")
