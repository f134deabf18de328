from sarqyt.llm import page_noise as P

E_DDL = "extract_id long, filename string, text_only string, field string"
C_DDL = "row_id long, kaz string, rus string"
GOOD = "показатель основной долг превысил план благодаря объекту станция построена теңге шегінде"


def run(spark, texts, rus=()):
    base = [(1000 + i, "2020_Report_000001_RUS.md", GOOD, "x") for i in range(120)]
    e = spark.createDataFrame(base + [(i, "2020_Report_000001_RUS.md", t, "x") for i, t in enumerate(texts)], E_DDL)
    c = spark.createDataFrame([(i, None, t) for i, t in enumerate(rus)], C_DDL)
    return e, c


def test_found(spark):
    texts = ["показатепь вырос", "превы¬\nсил план", "превы -\nсил план", "план вырос\n12\nдальше", "«Ақ Ойл» | Устойчивое развитие\nплан", "Тугол6ел вырос", "чистый план\nвырос", None, "", "пок- азатель план", "Годовой отчёт 2018 года"]
    e, c = run(spark, texts, ["план вырос [79] далее", "план вырос", "стоимость 5 тыс. тенге стр. 30"])
    got = {(r.field, r.rec_id) for r in P.found(e, c).collect() if r.rec_id < 1000}
    assert got == {("text_only", i) for i in (0, 1, 2, 3, 4, 5, 9)} | {("rus", 0), ("rus", 2)}


def test_repaired(spark):
    e, c = run(spark, ["показатепь превы -\nсил план\n\n12\n\n## Заголовок\n- пункт\nстан-\nция построена"], [None])
    got = {(r.field, r.rec_id): r.text for r in P.repaired(e, c).collect()}
    assert got["text_only", 0] == "показатель превысил план\n\n## Заголовок\n- пункт станция построена"
    assert ("rus", 0) not in got


def test_lines_around_furniture_meet():
    t = "сонымен бірге зер- \n13 / 184\n«Ақ Энерго» • Жылдық есеп 2016   7\nттеу зертханасы\n\n12\n\nкелесі абзац"
    assert P.mended(t, {}, set()) == "сонымен бірге зерттеу зертханасы\n\nкелесі абзац"


def test_trie_is_complete():
    words = sorted({"показатель", "основной", "долг", "план", "плане", "станция", "стенция", "шаг"})
    trie = P.Trie(words, [9] * len(words))
    near = lambda a, b: a == b or any(a[:i] + a[i + 1 :] == b or a == b[:i] + b[i + 1 :] or (len(a) == len(b) and a[:i] + a[i + 1 :] == b[:i] + b[i + 1 :]) for i in range(max(len(a), len(b))))
    for q in ("плам", "плане", "ста1ция", "пока3атель", "долгг", "паг"):
        got = set(trie.within(q, {}, 2, True))
        assert got == {w for w in words if near(q, w)}, q
    assert trie.within("показатепь", P.MISREAD_CYRILLIC, 2, False) == {"показатель": 1}
    assert "шаг" in trie.within("піаг", P.MISREAD_CYRILLIC, 2, False)


def test_empty_tables(spark):
    e, c = run(spark, [])
    assert P.found(e.limit(0), c).count() == 0


def test_copies_and_rare_words(spark):
    names = [f"участок Тайсербел номер {'абвгд'[i]}{'ежзик'[i]}{'лмнор'[i]}" for i in range(5)]
    e, c = run(spark, names + ["показатепь вырос"] * 40 + ["участок Тайсербеп закрыт"], [])
    good = spark.createDataFrame([(2000 + i, "2020_Report_000001_RUS.md", f"показатель {chr(1072 + i)}{chr(1073 + i)}", "x") for i in range(20)], E_DDL)
    got = {r.rec_id for r in P.found(e.unionByName(good), c).collect() if r.rec_id < 1000}
    assert got == set(range(5, 46))


def test_empty_texts_stay(spark):
    e, c = run(spark, ["", "план вырос"], [""])
    got = {(r.field, r.rec_id): r.text for r in P.repaired(e, c).collect()}
    assert got["text_only", 0] == "" and got["rus", 0] == "" and got["text_only", 1] == "план вырос"
    assert not {("text_only", 0), ("rus", 0)} & {(r.field, r.rec_id) for r in P.found(e, c).collect()}


def test_every_word_within_one_edit_is_a_candidate():
    words = sorted({"показатель", "станция", "развитие", "план", "год"})
    trie = P.Trie(words, [9] * len(words))
    for wrong, right in (("показазель", "показатель"), ("стансия", "станция"), ("развитне", "развитие"), ("план", "план"), ("плн", "план"), ("годд", "год"), ("рзвитие", "развитие")):
        assert right in trie.within(wrong, {}, 2, True), wrong


def test_edits_are_learned(spark):
    # the letter pair ж, ф is misread again and again; endings differ both ways
    words = ["жалоба", "железо", "живопись", "журнал", "жёлтый", "жилище", "жизнь", "жара"]
    ends = [f"{w}{e}" for w in ("завод", "договор", "разговор") for e in ("а", "у")]
    rows = [(w, 400, 300) for w in words] + [("ф" + w[1:], 1, 1) for w in words] + [(w, 40 + 30 * i, 20) for i, w in enumerate(ends)] + [("договору", 1, 1), ("железа", 2, 2)]
    counts = spark.createDataFrame([("rus", *r) for r in rows], "lang string, word string, n long, texts long")
    got = {r.word: {x.word for x in r.right} for r in P.misreadings(counts).collect()}
    assert got == {"ф" + w[1:]: {w} for w in words}


def test_headers_are_learned(spark):
    lines = ["Annual Report 2019 – Acme Holding", "страница {} из 80", "Page {}/80"]
    e = []
    for f in range(8):
        body = [f"{a} заводов{chr(1072 + f)} в {i} районе и ещё" for i, a in enumerate(["построено много", "закрыто несколько", "открыто семь", "намечено пять", "начато шесть"])]
        for k, h in enumerate(lines):
            body.insert(2 + k, h.format(f + 3))
        e.append((f, "c", f"2020_Report_00000{f}_RUS.md", "\n".join(body)))
    e.append((50, "c", "2020_Report_000050_RUS.md", "построено много\nзаводов и ещё"))
    known = P.headers(spark.createDataFrame(e, "extract_id long, collection string, filename string, text string").selectExpr("hash(filename) AS f", "text").selectExpr("cast(f AS bigint) AS file", "text"))
    assert {"страница # из #", "Page #/#"} <= set(known.lines) and any(x.startswith("Annual Report") for x in known.lines)
    assert P.furniture("построено\nстраница 77 из 80\nмного", known) and P.furniture("много Page 9/80 заводов", known) and not P.furniture("построено много в 3 районе", known)


def test_repair_brings_texts_back(spark):
    import random

    r = random.Random(6)
    vocabulary = GOOD.split()
    clean = [" ".join(r.choice(vocabulary) for _ in range(30)) for _ in range(60)]
    noisy = []
    for t in clean:
        ws = t.split()
        for _ in range(3):
            i = r.randrange(len(ws))
            if len(ws[i]) > 5:
                ws[i] = r.choice([ws[i][:3] + "¬\n" + ws[i][3:], ws[i].replace("о", "0", 1), ws[i].replace("л", "п", 1), ws[i].replace("н", "п", 1)])
        noisy.append(" ".join(ws) + r.choice(["", "\n12 / 184", "\n- 7 -"]))
    e, c = run(spark, noisy)
    got = {x.rec_id: x.text for x in P.repaired(e, c).collect()}

    def errors(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            last, row[0] = row[0], i + 1
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
        return row[-1]

    before, after = (sum(errors(x, y) for x, y in zip(s, clean)) for s in (noisy, [got[i] for i in range(60)]))
    assert after < 0.1 * before
