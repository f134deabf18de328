import random

from sarqyt.llm import leaks as L
from sarqyt.llm.grams import WORD


def runs(t):
    w = WORD.findall((t or "").lower())
    return {tuple(w[i : i + 8]) for i in range(len(w) - 7)}


def test_against_brute_force(spark):
    r = random.Random(3)
    items = [(i, " ".join(f"w{r.randrange(400)}" for _ in range(r.randint(5, 60)))) for i in range(12)]
    docs = []
    for d in range(80):
        t = [f"w{r.randrange(400)}" for _ in range(r.randint(0, 120))]
        if d % 2:
            w = items[r.randrange(12)][1].split()
            a = r.randrange(max(1, len(w) - 8))
            t[3:3] = w[a : a + r.randint(7, 40)]
        docs.append((d, " ".join(t), "item"))
    docs += [(200, None, ""), (201, "", ""), (1, docs[1][1], "")]
    got = {tuple(x) for x in L.found(spark.createDataFrame(docs, "doc_id long, text string, item_id string").drop("item_id"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {(d, i) for d, t, _ in docs for i, u in items if runs(u) and 5 * len(runs(u) & runs(t)) >= len(runs(u))}
    assert got == want and len(want) > 5


def test_shuffled_join_gives_the_same(spark):
    t = " ".join(f"w{i}" for i in range(40))
    docs, items = spark.createDataFrame([(1, "x " + t), (2, "y z")], "doc_id long, text string"), spark.createDataFrame([(7, t)], "item_id long, text string")
    assert [tuple(x) for x in L.leaks(docs, items, "doc_id", "item_id", broadcast_rows=0).collect()] == [(1, 7, 33, 33)]
    assert L.found(docs.limit(0), items).count() == 0 and L.found(docs, items.limit(0)).count() == 0
