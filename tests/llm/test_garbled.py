import pytest

from sarqyt.llm import garbled as G

CLEAN = "Тәуелсіз бағалау бойынша, қаржы комитеті Мойтұтжол учаскесін 20 күнге жапты, шығын шегінде қалды. По независимой оценке, финансовый комитет закрыл участок на 14 дней. "


def model(spark):
    if not hasattr(model, "m"):
        df = spark.createDataFrame([(CLEAN * 20 + "By an independent estimate, the finance committee closed the “section” for 14 days. " * 20,)], "t string")
        model.m = G.learn(df, "t").value
    return model.m


@pytest.mark.parametrize("name", ["utf-8>cp1252", "utf-8>cp1251", "utf-8>cp866", "kz1048>cp1252", "kz1048>cp1251", "kz1048>koi8-r", "cp866>cp1251", "utf-8>cp1252 twice"])
def test_round_trip_of_a_span(spark, name):
    right = "финансовый комитет закрыл участок по плану" if name.startswith("cp866") else "қаржы комитеті Мойтұтжол учаскесін күнге жапты, шығын шегінде"
    text = "По независимой оценке. " + G.garble(right, G.PAIRS[name]) + ". Бойынша 20 күнге."
    got = G.spans(model(spark), [text])[0]
    assert got
    out, last = "", 0
    for a, b, _, new in got:
        out += text[last:a] + (new or text[a:b])
        last = b
    assert right[5:-5] in out + text[last:]


def test_glyph_codes_and_clean(spark):
    m = model(spark)
    got = G.spans(m, ["Т/uni04B1рғын \\uni000493 /afii10065", CLEAN, "Šimkutis résumé Façade Müller €5 ½", "ГОДОВОЙ ОТЧЁТ ЗА 2018 ГОД"])
    assert [x[3] for x in got[0] if "uni" not in (x[3] or "")] and not got[1] and not got[2] and not got[3]
    assert G.glyph_text("/uni04B1") == "ұ" and G.glyph_text("/afii10071") == "ё" and G.glyph_text("/afii10097") == "я"


def test_inverse_of_every_pair():
    for name, chain in G.PAIRS.items():
        g = G.garble("Привет", chain)
        assert g and G.restore(g, chain) == "Привет", name
    assert G.restore("퟿漢", [("kz1048", "cp1251")]) is None


def test_nulls(spark):
    df = spark.createDataFrame([(1, None, ""), (2, G.garble(CLEAN, G.PAIRS["kz1048>cp1252"]), CLEAN), (2, None, None)] + [(3 + i, CLEAN, CLEAN) for i in range(10)], "extract_id long, markdown string, text_only string")
    assert {tuple(r) for r in G.found(df).collect()} == {("markdown", 2)}
    back = {(r.field, r.extract_id, r.text) for r in G.restored(df).collect()}
    assert ("markdown", 2, CLEAN) in back and ("markdown", 1, None) in back and ("text_only", 1, "") in back
    assert G.found(df.limit(0)).count() == 0


def test_no_inverse_still_counts(spark):
    m = model(spark)
    broken = G.garble("қаржы комитеті закрыл участок", G.PAIRS["utf-8>cp1252"])
    # a lead character whose second one is lost all along: nothing to invert, but garbled all the same
    broken = broken.replace("°", "").replace("Ñ", "Ñ\u0178Ñ").replace("Ð", "ÐÐ")
    got = G.spans(m, [CLEAN + broken + CLEAN])[0]
    assert got and all(len(CLEAN) - 2 <= a < b <= len(CLEAN + broken) + 2 for a, b, *_ in got)


def test_lone_marks_and_foreign_letters(spark):
    m = model(spark)
    got = G.spans(m, ["By an independent estimate, the companyтАЩs finance committee closed.", "the finance committee of Ðalvør Łabędzin closed “the section” (½ of it)", "комитет РСФСР и СССР закрыл участок", CLEAN * 50])
    assert [x[3] for x in got[0]] == ["’"] and not got[1] and not got[2] and not got[3]


def test_share_restored(spark):
    import random

    r, m = random.Random(8), model(spark)
    words = CLEAN.split()
    right = texts = 0
    for i in range(200):
        name = r.choice([n for n in G.PAIRS if not n.startswith(("cp866", "koi8", "mac"))])
        span = " ".join(r.choice(words) for _ in range(r.randint(4, 9)))
        if (g := G.garble(span, G.PAIRS[name])) and g != span:
            t = CLEAN + g + " " + CLEAN
            out, last = "", 0
            for a, b, _, new in G.spans(m, [t])[0]:
                out, last = out + t[last:a] + (new if new is not None else t[a:b]), b
            right, texts = right + (out + t[last:] == CLEAN + span + " " + CLEAN), texts + 1
    assert right / texts > 0.9
