"""Phases of the pipeline: extraction, chunking, the bead chain, judging, evaluation, sinks, resumption."""

import json
import math
import random

import pytest

from sarqyt.functions import text as X
from sarqyt.operators import align, chunk, evaluation, extraction, metrics, models, quality
from sarqyt.plans import pipeline
from sarqyt.sources import files, manifest
from pyspark.sql import functions as F


def extractor():
    """As a closure, so that it travels to the workers by value."""

    def own_text(content):
        if content == b"broken":
            raise ValueError("no pages")
        return content.decode().split("\f")

    return own_text


def test_extraction_routes_and_keeps_errors(spark):
    page = "мәтін " * 40
    pdfs = [("/a/2020_Report_KAZ.pdf", f"{page}\f{page}".encode()), ("/a/2020_Report_RUS.pdf", b"short\f"), ("/a/x_ENG.pdf", b"broken"), ("/a/none.pdf", None)]
    df = spark.createDataFrame(pdfs, "path string, content binary")
    got = {r.filename: r for r in extraction.extracted(df, extractor()).collect()}
    assert got["2020_Report_KAZ.pdf"].method == "pypdf" and got["2020_Report_KAZ.pdf"].success and got["2020_Report_KAZ.pdf"].kazakh_ok
    assert got["2020_Report_RUS.pdf"].method == "pypdf_partial"
    assert not got["x_ENG.pdf"].success and "no pages" in got["x_ENG.pdf"].error and got["x_ENG.pdf"].markdown is None
    assert not got["none.pdf"].success and got["none.pdf"].char_count == 0
    scanned = {r.filename: r for r in extraction.extracted(df, extractor(), lambda c: ["scanned text"]).collect()}
    assert scanned["2020_Report_RUS.pdf"].markdown == "scanned text" and scanned["2020_Report_RUS.pdf"].method == "docling_ocr"
    t = extraction.totals(extraction.extracted(df, extractor())).first()
    assert (t.total, t.ok, t.failed) == (4, 2, 2)


def test_tables_go_line_by_line(spark):
    def model(t):
        out, inside = [], False
        for line in t.split("\n"):
            if line.strip().startswith("|"):
                inside = True
            elif not inside:
                out.append(line)
            elif not line.strip():
                inside = False
        return "\n".join(out)

    r = random.Random(1)
    rows = [("\n".join(r.choice(["p", "|a|", "rest", "", " ", "\t", "  |x", "q z"]) for _ in range(r.randint(0, 12))),) for _ in range(800)] + [("|a\n" * 20_000 + "\nend",), (None,)]
    got = spark.createDataFrame(rows, "t string").select("t", X.without_tables(F.col("t")).alias("o")).collect()
    assert all(x.o == (None if x.t is None else model(x.t)) for x in got) and sum(x.o != x.t for x in got) > 400


def test_rounding_follows_the_binary_value(spark):
    r = random.Random(2)
    v = [0.84995, 0.12345, 0.99995, 0.5] + [round(r.random(), 5) for _ in range(3000)] + [(2 * r.randrange(5000) + 1) / 2**k for k in (8, 10, 14)]
    got = spark.createDataFrame([(x,) for x in v], "v double").select("v", X.round4(F.col("v")).alias("o")).collect()
    assert all(x.o == round(x.v, 4) for x in got) and any(x.o != math.floor(x.v * 1e4 + 0.5) / 1e4 for x in got)


def test_facts_are_computed_before_the_filter(spark):
    plan = chunk.sentences(spark.createDataFrame([(1, "x")], "id int, text string"), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert not any("regexp_replace" in line and line.strip(" +-:").startswith("Filter (") for line in plan.splitlines())


def test_bead_chain_up_to_triplets(spark):
    kaz = ["қаржы комитеті учаскені жапты бүгін", "банк жаңа жоба бастады қалада кеше", "бөлек сөйлем мүлде басқа нәрсе туралы"]
    ddl = "doc string, idx int, text string"
    src = spark.createDataFrame([("d", i, t) for i, t in enumerate(kaz)], ddl)
    tgt = spark.createDataFrame([("d", 0, kaz[0] + " " + kaz[1]), ("d", 1, "совсем иное предложение о другом деле"), ("e", 0, "x")], ddl)
    found = spark.createDataFrame([("d", [0, 1], [0]), ("d", [2], []), ("d", [], [1])], "doc string, src array<int>, tgt array<int>")
    got = align.bead_pairs(found, src, tgt, models.gram_encoder).collect()
    assert [(r.pos, r.kaz, r.kind) for r in got] == [(0, f"{kaz[0]} {kaz[1]}", "2:1")] and got[0].sim > 0.99
    assert align.bead_pairs(found.limit(0), src, tgt, models.gram_encoder).count() == 0


def test_judge_corrects_all_sides(spark):
    def judge(prompts):
        assert all("Kazakh: " in p for p in prompts)
        return ['{"is_valid_alignment": true, "is_atomic": true, "quality_score": 0.9, "fixed_kaz": "K", "fixed_rus": "R", "fixed_eng": null}' if "good" in p else "no json" if "plain" in p else '{"is_valid_alignment": false, "quality_score": 0.9}' for p in prompts]

    df = spark.createDataFrame([(1, "good", "r", "e"), (2, "plain", None, "e"), (3, "bad", "r", None)], "row_id int, kaz string, rus string, eng string")
    got = {r.row_id: (r.kaz, r.rus, r.eng, r.llm_quality_score) for r in quality.judged(df, judge).collect()}
    assert got == {1: ("K", "R", "e", 0.9), 2: ("plain", None, "e", 0.7)}


def test_null_prompts_are_not_asked(spark):
    df = spark.createDataFrame([("a",), (None,), ("",)], "t string")
    got = [r.o for r in df.select(models.answered(F.col("t"), lambda p: [x + "!" for x in p]).alias("o")).collect()]
    assert got == ["a!", None, "!"]
    assert [r.v is None for r in df.select(models.encoded(F.col("t")).alias("v")).collect()] == [False, True, False]


def test_evaluation_and_comparison(spark):
    test = spark.createDataFrame([(1, "бір екі үш төрт бес", "один два три четыре пять"), (2, "алты жеті", ""), (3, None, "семь"), (4, "он бір он екі он үш", "он бір он екі он үш")], "id int, kaz string, rus string")
    got = evaluation.evaluated(test, "kaz2rus", models.echo_generator, scorer=lambda s, h, r: [1.0 if a == b else 0.0 for a, b in zip(h, r)]).first()
    assert got.num_samples == 2 and 0 < got.bleu < 100 and got.comet == 0.5 and [x.id for x in got.samples] == [1, 4]
    none = evaluation.evaluated(test, "kaz2eng", models.echo_generator).first()
    assert none.num_samples == 0 and none.bleu is None and none.samples == []
    two = {r.model: r.bleu for r in evaluation.compared(test, "kaz2rus", {"a/final": models.echo_generator, "b/final": lambda p: ["x"] * len(p)}).collect()}
    assert two["a/final"] > two["b/final"] == 0.0


def test_bleu_defaults(spark):
    def score(h, r):
        return metrics.bleu(spark.createDataFrame([(1, h, r)], "id int, hypothesis string, reference string")).first()

    assert score("The cat sat on the mat.", "The cat sat on the mat.").score == pytest.approx(100.0)
    # 3 of 4 words, 1 of 3 pairs, none of 2 and 1: smoothed to 1/4 and 1/4
    got = score("a b x d", "a b c d")
    assert [got.p1, got.p2, got.p3, got.p4] == pytest.approx([75.0, 100 / 3, 25.0, 25.0], abs=1e-5)
    assert got.score == pytest.approx((75 * 100 / 3 * 25 * 25) ** 0.25, abs=1e-4)
    assert score("", "a").score == 0.0 and score("x y z w", "a b c d").score == 0.0
    assert spark.range(1).select(metrics.tokens_13a(F.lit("Pay $5.20, now! (ok) 3-4")).alias("t")).first().t.split() == ["Pay", "$", "5.20", ",", "now", "!", "(", "ok", ")", "3", "-", "4"]


def test_sinks_and_resumption(spark, tmp_path):
    df = spark.createDataFrame([("a.md", "текст", "c1"), ("a.md", "other", "c2"), ("b.md", None, "c1")], "filename string, markdown string, collection string")
    files.write_documents(df, str(tmp_path / "docs"), group="collection")
    assert (tmp_path / "docs/c1/a.md").read_text() == "текст" and (tmp_path / "docs/c2/a.md").read_text() == "other" and not (tmp_path / "docs/c1/b.md").exists()
    files.write_stats(df.agg(F.count("*").alias("n")), str(tmp_path / "stats.json"))
    assert json.loads((tmp_path / "stats.json").read_text()) == {"n": 3}
    todo, out, ddl = spark.createDataFrame([(i,) for i in range(10)], "id int"), str(tmp_path / "out"), "id int, x string"
    build = lambda rows: rows.selectExpr("id", "'v' AS x")
    assert files.resumed(todo.where("id < 4"), out, ddl, ["id"], build) == 4
    assert files.resumed(todo, out, ddl, ["id"], build) == 6 and files.resumed(todo, out, ddl, ["id"], build) == 0
    assert sorted(r.id for r in files.read_jsonl(spark, out, ddl).collect()) == list(range(10))
    with pytest.warns(UserWarning):
        assert files.read_pdf_bytes(spark, str(tmp_path / "nowhere")).count() == 0


def test_fetch_keeps_first_and_errors(spark):
    tasks = spark.createDataFrame([("u1", "2020", "Report", "KAZ", 1), ("u2", "2020", "Report", "KAZ", 2), ("u3", "2021", "Report", "RUS", 3), ("u4", "2022", "Report", "ENG", 4)], "url string, year string, type string, lang string, position int")

    def fetch(url):
        if url == "u3":
            raise OSError("gone")
        return url.encode()

    have = spark.createDataFrame([("2022_Report_ENG.pdf",)], "filename string")
    got = {r.filename: (r.url, r.content, r.error) for r in manifest.fetched(tasks, fetch, have).collect()}
    assert got == {"2020_Report_KAZ.pdf": ("u1", bytearray(b"u1"), None), "2021_Report_RUS.pdf": ("u3", None, "OSError: gone")}


def test_all_phases(spark):
    kaz = "Қаржы комитеті {0} учаскені {1} күнге жапты, шығын шегінде қалды. Банк {0} жаңа жобаны {1} қалада бастады, нәтиже жақсы болды."
    names = ["Тайсекжол", "Мердыозек", "Буросбулак", "Кырлаксай"]
    rows = [(10 * i + k, "c", f"202{i}_Report_00000{i}_{lang}.md", True, kaz.format(n, 17 * (i + 1))) for i, n in enumerate(names) for k, lang in enumerate(("KAZ", "RUS", "ENG"))]
    rows += [(900, "c", "2020_Report_000000_KAZ.md", False, None), (901, None, None, True, None)]
    e = spark.createDataFrame(rows, "extract_id long, collection string, filename string, success boolean, text_only string")
    got = pipeline.corpus(e, lambda prompts: ["басқа жауап"] * len(prompts))
    assert got["sentences"].count() == 24
    assert got["triplets"].count() == 8 and got["triplets"].where("rus IS NULL OR eng IS NULL").count() == 0
    clean = got["cleaned"].count()
    assert clean > 0 and got["preferences"].count() == 2 * clean
