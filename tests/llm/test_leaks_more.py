import random

from sarqyt.llm import leaks as L


def test_both_ways_agree(spark):
    r = random.Random(5)
    items = [(i, " ".join(f"w{r.randrange(300)}" for _ in range(r.randint(9, 60)))) for i in range(20)]
    docs = []
    for d in range(120):
        t = [f"w{r.randrange(300)}" for _ in range(r.randint(0, 100))]
        for _ in range(d % 3):
            t[3:3] = items[r.randrange(20)][1].split()[: r.randint(5, 40)]
        docs.append((d, " ".join(t)))
    d, i = spark.createDataFrame([*docs, (None, docs[1][1]), (3, docs[2][1])], "doc_id long, text string"), spark.createDataFrame([*items, (None, items[0][1]), (50, None)], "item_id long, text string")
    a = sorted(map(tuple, L.leaks(d, i, "doc_id", "item_id").collect()))
    b = sorted(map(tuple, L.leaks(d, i, "doc_id", "item_id", broadcast_rows=0).collect()))
    assert a == b and len(a) > 20 and not any(None in x for x in a)
