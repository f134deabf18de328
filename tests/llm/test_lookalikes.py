from sarqyt.llm import lookalikes


def fix(spark, kaz=None, rus=None, eng=None):
    df = spark.createDataFrame([(1, kaz, rus, eng, "x")], "row_id long, kaz string, rus string, eng string, field string")
    return lookalikes.repaired(df, "row_id").first()


def test_kinds(spark):
    r = fix(spark, "бoйынша　cатып１９ аймағ­ында IFRS", "й ё новая Cтрока ESG", "wаrеhοuse traﬁc ％ ＡＢ IFRS")
    assert r.kaz == "бойынша сатып19 аймағында IFRS"
    assert r.rus == "й ё новая Строка ESG"
    assert r.eng == "warehouse trafic % AB IFRS"


def test_ordinary_text_stays(spark):
    r = fix(spark, "№ 12 «Көк» – ESG 5%", "направ¬или работьі, IFRS и KPI", "Šimkutis & Müller – 5%")
    assert (r.kaz, r.rus, r.eng) == ("№ 12 «Көк» – ESG 5%", "направ¬или работьі, IFRS и KPI", "Šimkutis & Müller – 5%")


def test_nulls_empty_repeats(spark):
    rows = [(1, None, "", "a"), (1, None, "", "a"), (2, "а​б", None, None), (None, "а​б", None, None)]
    df = spark.createDataFrame(rows, "row_id long, kaz string, rus string, eng string")
    got = {(r.field, r.row_id) for r in lookalikes.found(df, "row_id").collect()}
    assert got == {("kaz", 2), ("kaz", None)}
    assert lookalikes.found(df.limit(0), "row_id").count() == 0


def test_long_text(spark):
    r = fix(spark, ("сөз " * 60_000) + "coз")
    assert r.kaz.endswith("соз") and len(r.kaz) == 240_003


def test_dressed_letters(spark):
    r = fix(spark, "бөлім Ⅳ, 𝐾𝑃𝐼 2 ½", "№ 5 … м² ™", "Chapter ⅳ ﬀ 𝐀𝐁")
    assert r.kaz == "бөлім IV, KPI 2 ½" and r.rus == "№ 5 … м² ™" and r.eng == "Chapter iv ff AB"
    # a Greek letter that looks like no Cyrillic one makes no Latin letter in a Cyrillic word
    assert fix(spark, "банкν").kaz == "банкν" and fix(spark, "бαнк").kaz == "банк"
