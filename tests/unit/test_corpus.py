import hashlib
import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corvidex.functions import prompts, questions, text
from corvidex.operators import chunking, order, quality, reports, sampling, splitting
from corvidex.plans import corpus
from corvidex.sources import files, html


def test_html_skips_scripts():
    page = html.parse('<html><head><title>T</title><meta name="Description" content="d"></head><body><script>var a = "</p>";</script><h1>Head</h1><p>Some <a href="/x">link</a></p></body></html>')
    assert page["title"] == "T" and page["description"] == "d" and page["links"] == ["/x"]
    assert page["headings"] == [{"level": "h1", "text": "Head"}] and "var a" not in page["text"]
    assert html.parse(None)["text"] == ""


@settings(max_examples=60, deadline=None)
@given(st.text("ab .\n", max_size=400), st.integers(20, 60))
def test_kept_separators_lose_nothing(text, size):
    out = splitting.split_kept(text, size, 0)
    assert "".join("".join(out).split()) == "".join(text.split())
    assert all(len(c) <= size or " " not in c for c in out)


def test_packed_split():
    text = "one two three. " * 20
    out = splitting.split_packed(text, 60, 10)
    assert len(out) > 1 and all(out[i].startswith(out[i - 1][-10:]) or len(out[i - 1]) < 10 for i in range(1, 2))
    assert splitting.split_packed("   ", 60, 10) == []
    assert splitting.split_packed("x" * 100, 40, 10, ()) == ["x" * 40, "x" * 40, "x" * 40, "x" * 10]


def test_sections_know_fences():
    got = splitting.markdown_sections("# A\nx\n## B\n```\n# no\n```\n### C\ny")
    assert [h for h, _ in got] == [{1: "A"}, {1: "A", 2: "B"}, {1: "A", 2: "B", 3: "C"}]


def test_hierarchy(spark):
    docs = spark.createDataFrame([(1, "# A\n" + "word " * 30 + "\n### C\n" + "more " * 30)], "doc_id long, text string")
    got = chunking.hierarchical(docs).orderBy("chunk_index").collect()
    assert {r["hierarchy_path"] for r in got} == {"A", "A > C"} and {r["hierarchy_level"] for r in got} == {1}
    assert len({r["chunk_id"] for r in got}) == len(got) == got[0]["total_chunks"]


def test_boundaries_keep_columns(spark):
    s = spark.createDataFrame([(1, 0, "x" * 400, "m"), (1, 1, "y" * 400, "m")], "source_id long, section_index int, content string, meta string")
    r = chunking.boundaries(s).first()
    assert r["meta"] == "m" and (r["from_section"], r["to_section"]) == (0, 1)
    assert r["content"].startswith("x" * 300) and r["content"].endswith("y" * 300) and "x" * 301 not in r["content"]


def test_choices_and_classes(spark):
    q = "Which?\n1 one\n2 two\n① first\n10. ten"
    row = spark.createDataFrame([(q,)], "q string").select(questions.choices(F.col("q"), circled=True).alias("m"), questions.mc_lines(F.col("q")).alias("a"), questions.max_choice(F.col("q")).alias("n"), questions.question_part(F.col("q")).alias("p")).first()
    assert row["m"] == {"1": "first", "10": "ten"} and row["a"] and row["n"] == 10 and row["p"] == "Which? 1 one 2 two"


def test_answers(spark):
    rows = [("답변: 첫째\n둘째", False, "첫째"), ("정답은 3 번", True, "3"), (None, True, "1"), (None, False, questions.NO_ANSWER), ("see image", False, questions.NOT_FOUND), ("漢字", False, questions.FAILED)]
    df = spark.createDataFrame(rows, "t string, mc boolean, want string")
    assert all(r["got"] == r["want"] for r in df.select(questions.extract_answer(F.col("t"), F.col("mc")).alias("got"), "want").collect())


def test_pack_stops_at_first_overflow(spark):
    f = spark.createDataFrame([(0, 1, "a" * 50), (0, 2, "b" * 500), (0, 3, "c")], "query_id long, rank long, text string")
    r = prompts.pack(f, 100).first()
    assert r["docs"] == 1 and "c" not in r["context"]


def test_places_are_gapless(spark):
    """An outlier, a value that holds a third of all rows, repeated rows, NaN and nulls: every row keeps a place of its own, in order."""
    values = [float(i * i) for i in range(200)] + [1e300, -1e300, float("inf")] + [7.0] * 150 + [float("nan")] * 3 + [None] * 40
    df = spark.createDataFrame([(v, i % 60) for i, v in enumerate(values)], "pos double, other long")
    rows = order.places(df, "pos").orderBy("place").collect()
    assert [r["place"] for r in rows] == list(range(1, len(values) + 1))
    rank = lambda v: (2, 0.0) if v is None else (1, 0.0) if v != v else (0, v)
    assert [rank(r["pos"]) for r in rows] == sorted(map(rank, values))
    big = spark.createDataFrame([(2**60 + i % 50,) for i in range(300)], "pos long")
    own = order.places(big, "pos").orderBy("place").collect()
    assert [r["pos"] for r in own] == sorted(2**60 + i % 50 for i in range(300)) and [r["place"] for r in own] == list(range(1, 301))
    assert order.places(df.where("false"), "pos").count() == 0 and order.places(df.where("pos IS NULL"), "pos").count() == 40


def test_batches_lose_no_row(spark):
    df = spark.range(23).withColumnRenamed("id", "pos")
    assert sum(sampling.batch(df, i, 10, 23).count() for i in range(10)) == 23


def test_text_score(spark):
    rows = [("clean text that is long enough", 100.0), ("bad � text that is long enough", 68.0), ("short", 75.0), ("a" * 11 + " long enough text", 85.0), (None, 75.0)]
    df = spark.createDataFrame(rows, "t string, want double")
    assert all(r["got"] == r["want"] for r in df.select(quality.text_score(quality.text_checks(F.col("t"))).alias("got"), "want").collect())


def test_validator_finds_mixed_case_duplicates(spark):
    df = spark.createDataFrame([(1, "Is this long enough?"), (2, "IS THIS long enough?"), (3, "no mark"), (4, "a?")], "doc_id long, text string")
    got = {r["doc_id"]: r["reason"] for r in quality.validate_questions(df, script=r"\p{L}").collect()}
    assert got == {1: None, 2: "duplicate", 3: "format", 4: "length"}


def test_sections_keep_last_page(spark):
    df = spark.createDataFrame([(1, [("A", 1), ("B", 2)], ["p1", "p2", "p3"])], "doc_id long, toc array<struct<title:string,page:int>>, page_texts array<string>")
    assert [r["content"] for r in files.section_slices(df).orderBy("i").collect()] == ["p1", "p2\np3"]


def test_mixed_reader_and_questions(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("plain")
    (tmp_path / "in/b.html").write_text("<p>page</p>")
    (tmp_path / "in/c.pdf").write_bytes(b"%PDF")
    got = {r["kind"]: r for r in files.read_mixed(spark, str(tmp_path / "in")).collect()}
    assert got["txt"]["content"] == "plain" and got["html"]["content"] == "page" and "no PDF extractor" in got["pdf"]["error"]
    (tmp_path / "q.csv").write_text('﻿ID,Question\nT1,"line one\n1 a"\n', encoding="utf-8")
    r = files.read_questions(spark, str(tmp_path / "q.csv")).first()
    assert r["ID"] == "T1" and r["Question"] == "line one\n1 a"
    assert [r["content"] for r in files.read_texts(spark, str(tmp_path / "in")).collect()] == ["plain"]


def test_stream_ingest(spark, tmp_path):
    from corvidex.operators import bm25
    from corvidex.streaming import ingest

    docs = spark.createDataFrame([(i, f"word{i % 3} common text") for i in range(12)], "doc_id long, text string")
    q = spark.createDataFrame([(0, "word1 common")], "query_id long, query string")
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    docs.where("doc_id < 6").write.parquet(src)
    ingest.ingest(spark, src, out, ck, docs.schema)
    docs.where("doc_id >= 6").write.mode("append").parquet(src)
    ingest.ingest(spark, src, out, ck, docs.schema)
    got = bm25.search(ingest.read_index(spark, out), q, 4).collect()
    assert sorted(got) == sorted(bm25.search(bm25.build(docs), q, 4).collect())
    assert spark.read.parquet(f"{out}/log").agg(F.sum("documents")).first()[0] == 12


def test_pairs_format(spark):
    rows = spark.createDataFrame([(i, "p", "c", "r") for i in range(10)], "pos long, prompt string, chosen string, rejected string")
    got = prompts.preference_pairs(rows, "pos").orderBy("pos").collect()
    assert [r["split"] for r in got] == ["train"] * 9 + ["test"] and got[0]["messages"][0]["role"] == "user"
    json.dumps(got[0].asDict(recursive=True))


def written(spark, tmp_path, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_whole_texts_are_questions(spark, tmp_path):
    head = "word " * 100
    texts = {3: f"{head}\n1. one\n2. two\n7. seven", 7: head + "end one", 11: head + "end two", 15: "short text", 19: "short text"}
    d = written(spark, tmp_path, "documents", list(texts.items()), "doc_id long, text string")
    got = lambda name: {r["doc_id"]: r for r in corpus.QUERIES[name](spark, d).collect()}
    assert {i: r["mc_b"] for i, r in got("mc_classify").items()} == {i: i == 3 for i in texts}
    assert {i: r["choices"] for i, r in got("question_parts").items()} == {i: 3 if i == 3 else 0 for i in texts}
    assert {i: r["most"] for i, r in got("max_choice").items()} == {i: 7 if i == 3 else 4 for i in texts}
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    assert {(r["number"], r["choice"]) for r in corpus.QUERIES["choice_extract"](spark, d).where("doc_id = 3").collect()} == {("1", md5("one")), ("2", md5("two")), ("7", md5("seven"))}
    assert {i: r["reason"] for i, r in got("validator_reasons").items()} == {3: "length", 7: "length", 11: "length", 15: None, 19: "duplicate"}


def test_choices_are_numbered(spark):
    """Rows 7.1 to 7.7: letters become numbers, circled digits count as digits, later lines replace earlier ones."""
    q = "Which?\nA) one\nb. two\nㄷ. three\n라) four\n③ five\n⑩ ten\nK) other\nA) again"
    row = spark.createDataFrame([(q, "① x\n② y", "1 a\n2 b", "1x\n2y", "1) a", "")], "q string, circled string, loose string, bare string, one string, none string")
    c = questions.choices
    r = row.select(c(F.col("q")).alias("kept"), c(F.col("q"), circled=True).alias("numbered"), *[f(F.col(x)).alias(f"{f.__name__}_{x}") for x in ("circled", "loose", "bare") for f in (questions.mc_lines, questions.mc_digits, questions.mc_second)], *[questions.classify(F.col(x)).alias(f"is_{x}") for x in ("q", "one", "none")]).first()
    assert r["kept"] == {"1": "again", "2": "two", "3": "three", "4": "four", "③": "five", "10": "ten", "K": "other"}
    assert r["numbered"] == {"1": "again", "2": "two", "3": "five", "4": "four", "10": "ten", "K": "other"}
    assert [r[f"{f}_{x}"] for x in ("circled", "loose", "bare") for f in ("mc_lines", "mc_digits", "mc_second")] == [True, True, True, True, True, True, False, True, False]
    assert tuple(r["is_q"]) == ("multiple_choice", 0.95) and tuple(r["is_one"]) == ("open_ended", 0.3) and tuple(r["is_none"]) == ("open_ended", 0.0)
    # two lines of one number are one choice
    assert spark.createDataFrame([("1. a\n1. b",)], "q string").select(questions.classify(F.col("q")).alias("c")).first()["c"]["confidence"] == 0.3


def test_splitter_by_its_rule():
    """Row 9.1 restated as recursion over strings, on mixed, CJK and unbroken texts."""

    def plain(text, size, overlap, marks):
        if len(text) <= size:
            return [text] if text.strip() else []
        if not marks:
            return [text[a : a + size] for a in range(0, len(text), size - overlap)]
        runs, run = [], []
        for part in text.split(marks[0]):
            if run and sum(len(x) + len(marks[0]) for x in [*run, part]) > size:
                runs.append(run)
                run = []
            if len(part) > size:
                runs.append(part)
            else:
                run.append(part)
        whole = []
        for r in [*runs, run] if run else runs:
            whole += plain(r, size, overlap, marks[1:]) if isinstance(r, str) else [t for t in [marks[0].join(r)] if t.strip()]
        return [(whole[i - 1][-overlap:] if i and overlap else "") + t for i, t in enumerate(whole)]

    rng = random.Random(1)
    bits = ["\n\n", "\n", ". ", "。", "! ", "? ", "；", "，", " ", "a", "bb", "在线", "x" * 30, "  "]
    for _ in range(3000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 60)))
        size, overlap = rng.randint(5, 40), rng.randint(0, 4)
        assert splitting.split_packed(t, size, overlap) == plain(t, size, overlap, splitting.SEPARATORS)
    assert [len(t) for t in splitting.split_packed("a" * 2000, 512, 0)] == [512, 512, 512, 464]


def test_clean_for_llm_drops_references(spark):
    r = spark.createDataFrame([("1. text (see 12) and (none) (p. 3, x)",)], "t string").select(text.clean_for_llm(F.col("t"), True).alias("a"), text.clean_for_llm(F.col("t")).alias("b")).first()
    assert r["a"] == "text  and (none) " and r["b"] == "text (see 12) and (none) (p. 3, x)"


def test_repetition_counts_in_the_score(spark, tmp_path):
    import re

    bad = "�" * 2
    texts = ["a plain text of some words", "aaaaaaaaaaaa is a run", "aaaaaaaaaaa", "aaaaaaaaaa has ten", "so so so so so so so it goes", "one two " * 6 + "end", "      so so so so so so so", bad + "      aaaaaaaaaaaaa text"]
    d = written(spark, tmp_path, "documents", list(enumerate(texts, 29)), "doc_id long, text string")
    rule = {i: bool(re.search(r"(.)\1{10,}|(\S+\s+)\2{5,}", t)) for i, t in enumerate(texts, 29)}
    got = {r["doc_id"]: r for r in corpus.QUERIES["text_quality_score"](spark, d).collect()}
    plain = {r["doc_id"]: r["score"] for r in corpus.documents(spark, d).select("doc_id", quality.text_score(quality.text_checks(F.col("text"), repetition=False)).alias("score")).collect()}
    assert {i: r["repetitive_pattern"] for i, r in got.items()} == rule and 3 < sum(rule.values()) < len(texts)
    assert {i: r["score"] for i, r in got.items()} == {i: max(0, s - 15 * rule[i]) for i, s in plain.items()}
    low = {r["doc_id"] for r in corpus.answered(spark, d).select("doc_id", quality.text_score(quality.text_checks(F.col("answer"))).alias("score")).collect() if r["score"] < reports.LOW_SCORE}
    advice = {r["doc_id"]: r["advice"] for r in corpus.QUERIES["quality_advice"](spark, d).collect()}
    assert {i for i, a in advice.items() if reports.LOW["answer"] in a} == low and low


def test_overlaps_of_any_length(spark):
    rng = random.Random(5)
    brute = lambda a, b: max(k for k in range(min(len(a), len(b)) + 1) if k == 0 or a[-k:] == b[:k])
    for _ in range(300):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randrange(12))) for _ in range(2))
        assert chunking.longest_border(a, b) == brute(a, b)
    line = "".join(rng.choice("abcdefgh") for _ in range(500))
    rows = spark.createDataFrame([(1, 0, line), (1, 1, line), (1, 2, line[-450:] + "z")], "source_id long, chunk_index int, content string")
    assert {r["chunk_index"]: r["overlap"] for r in chunking.overlaps(rows).collect()} == {0: 500, 1: 450}
    chunks = chunking.chunk(corpus.documents(spark, "/root/testdata/sf0.001"), clean=False).collect()
    text = {(r["source_id"], r["chunk_index"]): r["content"] for r in chunks}
    got = {(r["source_id"], r["chunk_index"]): r["overlap"] for r in corpus.QUERIES["chunk_overlaps"](spark, "/root/testdata/sf0.001").collect()}
    assert got == {(s, i): brute(t, text[s, i + 1]) for (s, i), t in text.items() if (s, i + 1) in text} and max(got.values()) > 0


def test_a_pair_for_every_user_turn(spark, tmp_path):
    said = [(1, 0, "system", "s"), (1, 1, "user", "z"), (1, 2, "assistant", "a"), (1, 3, "user", "b"), (1, 4, "user", "c"), (1, 5, "assistant", "y"), (4, 0, "user", "alone")]
    d = written(spark, tmp_path, "conversations", said, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): (r["first_content"], r["chosen_content"], r["split"]) for r in corpus.QUERIES["preference_pairs"](spark, d).collect()}
    assert got == {(1, 1): ("z", "a", "train"), (1, 3): ("b", None, "train"), (1, 4): ("c", "y", "train"), (4, 0): ("alone", None, "test")}
