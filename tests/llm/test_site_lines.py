from sarqyt.llm import site_lines as S

DDL = "sent_id long, text string, source_file string, sentence_idx int, collection string, line string, block string"


def rows():
    out, n = [], 0
    for f in range(10):
        for i, t in enumerate([f"Мәтін № {f} жеке жол {chr(1072 + f) * 5}", "Жаңалыққа жазылыңыз!" if f < 5 else "бөлек " + "абвгдежзий"[f], "ЖАҢАЛЫҚҚА  жазылыңыз 2" if f == 0 else f"соңы {'абвгдежзий'[f]}"]):
            out.append((n, t, f"f{f}", i, "c", "x", "y"))
            n += 1
    return out


def test_found_and_cleaned(spark):
    df = spark.createDataFrame(rows(), DDL)
    got = {r.sent_id for r in S.found(df, "sent_id").collect()}
    assert got == {r[0] for r in rows() if "азылыңыз" in r[1].lower()}
    left = S.cleaned(df, "sent_id")
    assert left.count() == 30 - len(got) and left.columns == df.columns


def test_nulls_and_small(spark):
    extra = [(100 + i, None if i < 5 else "...", f"f{i}", 9, "c", "", "") for i in range(10)] + [(200, "Жаңалыққа жазылыңыз", None, None, "c", "", ""), (201, "Жаңалыққа жазылыңыз", "f1", 0, None, "", "")]
    df = spark.createDataFrame(rows() + extra, DDL)
    got = {r.sent_id for r in S.found(df, "sent_id").collect()}
    assert 200 in got and 201 not in got and not got & set(range(100, 110))
    assert S.found(df.limit(0), "sent_id").count() == 0


def test_blocks_join_neighbours(spark):
    data = [(f * 10 + i, t, f"f{f}", i, "c", "", "") for f in range(5) for i, t in enumerate(["alpha line", "beta line", f"own text {'abcde'[f]}", "gamma line"])]
    b = {r.line: r.block for r in S.blocks(spark.createDataFrame(data, DDL), "sent_id").collect()}
    assert b["alphaline"] == b["betaline"] != b["gammaline"]
