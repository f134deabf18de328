from sarqyt.llm import sentence_ends as S

ABBR = ["млн. теңге бөлінді", "2013 г. на ул. Енлом", "см. рис. 3"]


def model():
    types = {}
    for l, ends, low, cap in (("w", 40, 0, 60), ("млн", 0, 90, 1), ("г", 0, 80, 2), ("ул", 0, 0, 40), ("I", 0, 0, 80), ("проф", 0, 0, 40), ("%", 5, 0, 8), ("года", 10, 0, 20), ("тенге", 20, 0, 30)):
        for kind, n in (("end", ends), ("low", low), ("cap", cap)):
            if n:
                types["text_only", l, ".", kind] = n
    return S.Model(types, {"cap": 600, "num": 100, "open": 120, "init": 20}, {"оны": 0.5}, {"қызметі": 0.3}, {S.line_key("Баспасөз қызметі Көктау")})


def cut(t, **k):
    e = model().ends(t, **k)
    return [t[a:b].strip() for a, b in zip([0, *e], e)]


def test_abbreviations_quotes_brackets():
    assert cut("В 2013 г. на ул. Енлом открыт офис. Проф. А. М. Мырза рад! Почему так?") == ["В 2013 г. на ул. Енлом открыт офис.", "Проф. А. М. Мырза рад!", "Почему так?"]
    assert cut("«Проект готов. Причину найдём», – сообщил он. Перевозка (в 10.00.) встала.") == ["«Проект готов. Причину найдём», – сообщил он.", "Перевозка (в 10.00.) встала."]
    assert cut("Было 3.5 млн. тенге.Как указано выше, всё.") == ["Было 3.5 млн. тенге.", "Как указано выше, всё."]


def test_lines_and_scripts():
    assert cut("## Заголовок\n\n- первый пункт;\n• второй\nОбычный\nабзац.") == ["## Заголовок", "- первый пункт;", "• второй", "Обычный\nабзац."]
    assert cut("水位下降了？公司培训了员工。“准备好了吗？现在开始！”主席宣布。") == ["水位下降了？", "公司培训了员工。", "“准备好了吗？现在开始！”主席宣布。"]


def test_rows_that_go_on():
    m = model()
    assert m.ends("Жобасы үшін 48 409 млн.", "теңге бөлді.", False) == []
    assert m.ends("жобасы үшін 1706", "млн теңге бөлді.", False) == []
    assert m.ends("Баспасөз қызметі Көктау", "баспасөз қызметі көктау", False) == [23]
    assert m.ends("Бекітілді тенге.", "Келесі сөйлем.", False) == [16]
    assert m.ends("соңы", None, False) == [4]


def test_defined_results():
    m = model()
    assert m.ends(None) == [] and m.ends("  \n ") == [] and m.ends("x") == [1]
    long = "Слово года. " * 20_000
    assert len(m.ends(long)) == 20_000


def test_frames(spark):
    e = spark.createDataFrame([(1, True, "pypdf", "Первое предложение года. Второе тенге.", "Первое", "f"), (2, True, "docling_ocr", "Нет.", "Нет.", "f"), (3, False, None, None, None, "f")], "extract_id long, success boolean, method string, text_only string, markdown string, field string")
    s = spark.createDataFrame([(7, "Бір сөйлем. Екінші", "a", 0, "c"), (8, "жалғасы бар.", "a", 1, "c"), (9, None, None, None, None)], "sent_id long, text string, source_file string, sentence_idx int, collection string")
    got = sorted(map(tuple, S.found(e, s).collect()))
    assert ("text_only", 1, 24) in got and ("text_only", 1, 38) in got and ("text", 8, 12) in got and not any(r[1] in (2, 3, 9) for r in got)
    assert S.units(e, s).where("rec_id = 1").orderBy("unit").first().text == "Первое предложение года."
    assert S.found(e.limit(0), s.limit(0)).count() == 0


def test_units_cover_every_text(spark):
    e = spark.createDataFrame([(1, True, "pypdf", "Первое предложение года. Второе тенге.", "x", "f"), (2, True, "docling_ocr", "Нет. Да.", "x", "f"), (3, True, "pypdf_partial", "Частично", "x", "f"), (4, False, None, None, None, "f"), (5, True, "docling_ocr", " \n", "x", "f")], "extract_id long, success boolean, method string, text_only string, markdown string, field string")
    s = spark.createDataFrame([(7, "Бір сөйлем. Жобасы үшін 48 409 млн,", "a", 0, "c"), (8, "теңге бөлді.", "a", 1, "c"), (9, "жобасы үшін,", "a", 2, "c"), (10, "мың теңге", "a", 3, "c")], "sent_id long, text string, source_file string, sentence_idx int, collection string")
    got = {}
    for r in S.units(e, s).orderBy("field", "rec_id", "unit").collect():
        got.setdefault((r.field, r.rec_id), []).append((r.unit, r.text))
    for f, rows, k in (("text_only", e.collect(), "text_only"), ("text", s.collect(), "text")):
        for r in rows:
            assert "".join("".join(x for _, x in got.get((f, r[0]), [])).split()) == "".join((r[k] or "").split())
    assert [n for n, _ in got["text", 7]] == [1, 2] and ("text", 9) in got and ("text_only", 3) in got and ("text_only", 5) not in got
    assert not any(r.rec_id in (7, 9) and r.end_pos > 11 for r in S.found(e, s).where("field = 'text'").collect())


SUBJECTS = ["банк", "завод", "комитет", "отдел", "центр", "архив", "совет", "холдинг"]
VERBS = ["закрыл", "открыл", "купил", "продал", "снизил", "утвердил"]
OBJECTS = ["участок", "дорогу", "станцию", "склад", "проект", "отчёт", "долг"]
WHEN = ["вчера", "сегодня", "весной", "осенью"]


def stories(n):
    import random

    r = random.Random(4)
    return [[" ".join([r.choice(SUBJECTS), "города", r.choice(VERBS), "новый", "важный", r.choice(OBJECTS), r.choice(WHEN)]) for _ in range(6)] for _ in range(n)]


def learned(spark, texts, script=""):
    df = spark.createDataFrame([("text_only", t, None) for t in texts], "field string, text string, nxt string")
    return S._learn(df)


def score(m, truth, texts):
    good = found = all_true = 0
    for t, ends in zip(texts, truth):
        got, want = set(m.ends(t)), set(ends)
        good, found, all_true = good + len(got & want), found + len(got), all_true + len(want)
    return good / found, good / all_true


def places(sentences, gap):
    out, at = [], 0
    for x in sentences:
        out.append(at + len(x))
        at += len(x) + len(gap)
    return out


def test_text_without_marks_is_cut(spark):
    m = learned(spark, [" ".join(x[:1].upper() + x[1:] + "." for x in s) for s in stories(300)])
    held = stories(340)[300:]
    precision, recall = score(m, [places(s, " ") for s in held], [" ".join(s) for s in held])
    assert precision > 0.95 and recall > 0.95
    # the same model cuts ordinary text at its marks alone
    assert score(m, [places([x + "." for x in s], " ") for s in held], [" ".join(x[:1].upper() + x[1:] + "." for x in s) for s in held]) == (1.0, 1.0)


def test_script_without_spaces_or_marks(spark):
    import random

    r = random.Random(5)
    rows = [["".join([r.choice("银厂局部站库"), "长", r.choice("关开买卖减批"), "新", "大", r.choice("区路图仓案报债"), r.choice("昨今春秋")]) for _ in range(6)] for _ in range(340)]
    m = learned(spark, ["。".join(s) + "。" for s in rows[:300]])
    precision, recall = score(m, [places(s, "") for s in rows[300:]], ["".join(s) for s in rows[300:]])
    assert precision > 0.95 and recall > 0.95


def test_neighbours_decide(spark):
    import numpy as np

    hazard = np.array([0.001, 0.001, 0.02, 0.1, 0.2, 0.3], np.float32)
    far, near = np.full(8, -20.0), np.full(8, -20.0)
    far[[2, 7]] = near[[2, 3]] = 3.0
    near[7] = far[7] = 30.0
    a, b = S.posteriors([(far, far), (near, near)], hazard)
    assert a[2] > b[2] and b[3] > b[2] and a[7] > 0.99


def test_window_free_and_gaps(spark):
    m = model()
    long = "ұ" * 500
    assert S.candidates(f"Ол {long}. Келесі", "")[0][1] == "w"
    assert S.candidates("Год!" + " " * 100 + "Слово", "")[0][3:] == ("cap", "слово")
    s = spark.createDataFrame([(1, "жобасы үшін 1706", "a", 0, "c"), (2, "млн теңге бөлді.", "a", 9, "c"), (3, "жобасы үшін 1706", "a", 4090, "c"), (4, "млн теңге бөлді.", "a", 9000, "c"), (5, "x", None, 0, "c"), (6, "y", None, 1, "c")], "sent_id long, text string, source_file string, sentence_idx int, collection string")
    got = {r.rec_id: r.nxt for r in S._with_next(s).collect()}
    assert got == {1: "млн теңге бөлді.", 2: "жобасы үшін 1706", 3: "млн теңге бөлді.", 4: None, 5: None, 6: None}
    assert m.ends("жобасы үшін 1706", "млн теңге бөлді.", False) == []


def test_cutting_does_not_search_for_cycles():
    """Part of the time went into the search for cycles among objects that form none."""
    import gc

    seen, before = [], gc.get_threshold()
    texts = [f"Первое дело {i}. Второе «дело», т. е. {i}.5 тонн! Третье" for i in range(300)]
    model = S.Model({}, {}, {}, {}, set())
    gc.callbacks.append(lambda phase, info: seen.append(phase))
    gc.set_threshold(50)
    try:
        ends = model.ends_of(texts, [None] * len(texts), [True] * len(texts))
        inside = len(seen)
        assert gc.isenabled()
    finally:
        gc.callbacks.pop()
        gc.set_threshold(*before)
    assert inside < 10
    assert all(e and e[-1] == len(t) for e, t in zip(ends, texts, strict=True))
    assert ends == [model.ends(t) for t in texts]


def test_marks_are_runs_of_dots_of_marks_or_of_wide_marks():
    import random
    import re

    plain = re.compile(r"(?:\.{2,}|[.!?…]+|[。！？]+)[»”\"’')\]）」』]*")
    r = random.Random(1)
    for _ in range(3000):
        t = "".join(r.choice('..!?…。！？»") a') for _ in range(r.randint(1, 12)))
        assert [m.span() for m in plain.finditer(t)] == [m.span() for m in S.MARK.finditer(t)]
