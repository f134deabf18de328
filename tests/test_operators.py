import numpy as np
import pytest

from sarqyt.operators import align, dedup, metrics, models, preference, quality
from sarqyt.operators.components import connected_components
from sarqyt.sources import files, manifest


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (200, 200), (100, 101), (None, 3)]
    got = dict(rows(connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b")))
    assert all(got[i] == 0 for i in range(41)) and got[102] == 100 and got[200] == 200
    star = spark.createDataFrame([(0, i) for i in range(1, 3000)], "a long, b long")
    assert connected_components(star, "a", "b").where("component = 0").count() == 3000
    assert connected_components(star.limit(0), "a", "b").count() == 0


def test_dedup_and_ties(spark):
    df = spark.createDataFrame([(2, "a", "x"), (1, "a", "y"), (3, None, "z"), (4, None, "w")], "row_id long, k string, __key string")
    assert {r.row_id for r in dedup.keep_first(df, df.k, "row_id").collect()} == {1, 3}
    assert {r.row_id for r in dedup.keep_last(df, df.k, "row_id").collect()} == {2, 4}
    assert dedup.keep_first(df.limit(0), df.k, "row_id").count() == 0


@pytest.mark.parametrize("n", [0, 1, 19, 1000])
def test_split_is_exact(spark, n):
    got = dedup.split_test(spark.range(n), "id")
    assert got.where("is_test").count() == -(-n * 5 // 100) and got.count() == n


def test_nearest_against_brute_force(spark):
    r = np.random.default_rng(0)
    v = r.normal(size=(60, 8))
    v[7] = v[9]
    df = spark.createDataFrame([(i, str(i % 3), [float(x) for x in v[i]]) for i in range(60)] + [(99, None, [1.0] * 8), (98, "0", None)], "id long, g string, v array<double>")
    got = {r.query: r.match for r in align.nearest(df.where("id % 5 = 0"), df, "g", "id", "v", block=4).collect()}
    for q in range(0, 60, 5):
        s = [(round(float(v[q] @ v[j]), 12), -j) for j in range(60) if j % 3 == q % 3 and j != q]
        assert got[q] == -max(s)[1]
    assert align.nearest(df.limit(0), df, "g", "id", "v").count() == 0


def test_one_to_one_is_injective(spark):
    p = spark.createDataFrame([(3, 1), (1, 1), (2, 2), (4, 2)], "s long, t long")
    assert rows(align.one_to_one(p, "s", "t").select("s", "t")) == {(1, 1), (2, 2)}


def test_beads_cover_once():
    r = np.random.default_rng(1)
    a = r.normal(size=(9, 16))
    b = np.concatenate([a[:3], (a[3] + a[4])[None], a[6:]])
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    got = align.beads(a, b)
    assert [i for p, _ in got for i in p] == list(range(9)) and [j for _, q in got for j in q] == list(range(7))
    assert ([3, 4], [3]) in got
    assert align.beads(a[:0], b[:2]) == [([], [0]), ([], [1])]


def test_triplets_full_outer(spark):
    ddl = "doc string, pos long, kaz string, text string, sim double, kind string"
    rus = spark.createDataFrame([("d", 1, "k1", "r1", 0.5, "1:1"), ("d", 2, "k1", "r2", 0.6, "1:2"), ("d", 3, "k2", "r3", 0.7, "1:1")], ddl)
    eng = spark.createDataFrame([("d", 1, "k3", "e1", 0.5, "1:1"), ("d", 2, "k2", "e2", 0.6, "1:1")], ddl)
    got = {r.id: (r.kaz, r.rus, r.eng) for r in align.triplets(rus, eng).collect()}
    assert got == {"d_0000": ("k1", "r2", None), "d_0001": ("k2", "r3", "e2"), "d_0002": ("k3", None, "e1")}


def test_reasons_cover_all(spark):
    ok = "Бұл сөйлем сапасы жағынан әбден жарамды мәтін"
    ddl = "row_id int, kaz string, rus string, eng string, similarity_kaz_rus double, similarity_kaz_eng double"
    data = [(0, None, "x", None, None, None), (1, ok, None, "", None, None), (2, "аз", ok, None, 0.9, None), (3, "аа аа аа аа аа аа аа аа", ok, None, 0.9, None), (4, ok + " appendix", ok, None, 0.9, None), (5, ok, "мал", None, 0.9, None), (6, ok, ok * 4 + " ә" * 40, None, 0.9, None), (7, ok, ok, None, 0.5, None), (8, ok, ok, None, None, None), (9, ok, ok, None, 0.9, None), (10, ok, None, ok, None, 0.1)]
    got = {r.row_id: r.reason for r in quality.with_reason(spark.createDataFrame(data, ddl)).select("row_id", "reason").collect()}
    assert got[0] == "missing_kaz" and got[1] == "no_translations" and got[2] == "kaz_length" and got[3] == "kaz_quality" and got[4] == "kaz_toc" and got[5] == "rus_length"
    assert got[7] == got[8] == "kaz_rus_similarity" and got[9] is None and got[10] == "kaz_eng_similarity" and got[6] in ("kaz_rus_ratio", "rus_quality")


def test_metrics_bounds(spark):
    ddl = "row_id int, hypothesis string, reference string"
    same = spark.createDataFrame([(1, "a b c d e f", "a b c d e f"), (2, "x y z w v", "x y z w v"), (3, None, "q"), (4, "", "")], ddl)
    b = metrics.corpus_bleu(same).first()
    assert b.score == 100.0 and b.bp == 1.0 and metrics.corpus_chrf(same).first().score == 100.0
    other = spark.createDataFrame([(1, "a b", "c d e")], ddl)
    assert metrics.corpus_bleu(other).first().score == 0.0 and metrics.corpus_bleu(other.limit(0)).first().score == 0.0


def test_preference_and_resume(spark):
    t = spark.createDataFrame([("a", "kk", "rr", None), ("b", "kk", "", "ee")], "id string, kaz string, rus string, eng string")
    asked = preference.directions(t)
    assert {(r.id, r.direction) for r in asked.collect()} == {("a", "kaz2rus"), ("a", "rus2kaz"), ("b", "kaz2eng"), ("b", "eng2kaz")}
    rej = spark.createDataFrame([("a", "kaz2rus", " RR "), ("b", "kaz2eng", "other")], "id string, direction string, rejected string")
    assert [r.example_id for r in preference.examples(asked, rej).collect()] == ["b_kaz2eng"]
    assert {r.id for r in preference.resume(t, t.where("id = 'a'"), "id").collect()} == {"b"}


def test_manifests(spark, tmp_path):
    (tmp_path / "a.txt").write_text("2024 ГОД - Казахский (KAZ)\n\nОтчет об устойчивом развитии\nhttps://x/1.pdf\n2023 ГОД - язык\nГодовой отчет\nhttps://x/2.pdf\n(Ссылка нет)\n", encoding="utf-8")
    got = manifest.carry_forward(manifest.read_lines(spark, str(tmp_path))).collect()
    assert [(r.url, r.year, r.lang, r.type) for r in got] == [("https://x/1.pdf", "2024", "KAZ", "Sustainability_Report")]
    (tmp_path / "a.txt").write_text("2021-2022 ГОД:\nKAZ: https://x/1\nKAZ: ftp\n\nRUS: https://x/2\n", encoding="utf-8")
    got = manifest.prefixed(manifest.read_lines(spark, str(tmp_path)), manifest.YEAR_RANGE, "Research_Program")
    assert {(r.url, r.year, r.lang) for r in got.collect()} == {("https://x/1", "2021-2022", "KAZ"), ("https://x/2", "2021-2022", "RUS")}
    assert manifest.duplicate_links(got).where("same_url > 1").count() == 0


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("t1", "f", 0, "kaz", None), ("t2", "f", 1, "rus", None)], files.SENTENCE)
    files.write_jsonl(df, str(tmp_path / "out"), "language")
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["language=kaz", "language=rus"]
    back = files.read_jsonl(spark, str(tmp_path / "out"), files.SENTENCE)
    assert {r.text for r in back.collect()} == {"t1", "t2"}
    (tmp_path / "md").mkdir()
    (tmp_path / "md" / "2024_Report_KAZ.md").write_text("a\nb")
    (tmp_path / "md" / "x.PDF").write_bytes(b"%PDF")
    assert rows(files.read_markdown(spark, str(tmp_path / "md"))) == {("2024_Report_KAZ.md", "a\nb")}
    assert files.read_pdf_bytes(spark, str(tmp_path / "md")).count() == 1


def test_encoder_double(spark):
    v = models.gram_encoder(["абв", "абв", ""])
    assert np.allclose(v[0], v[1]) and abs(np.linalg.norm(v[0]) - 1) < 1e-6
