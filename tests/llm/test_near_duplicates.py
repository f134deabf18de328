import itertools
import random

import pytest

from sarqyt.llm import near_duplicates as N
from sarqyt.llm.grams import WORD

DDL = "row_id long, kaz string, rus string, eng string, h string"


def brute(rows):
    sets = {}
    for rid, *texts, _ in rows:
        s = set()
        for f, t in enumerate(texts):
            w = WORD.findall((t or "").lower())
            s |= {(f, *w[i : i + 3]) for i in range(len(w) - 2)}
        if s:
            sets[rid] = s
    up = {k: k for k in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b]):
            up[find(a)] = find(b)
    return {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if find(a) == find(b)}


def corpus(n, seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows, base = [], []
    for i in range(n):
        if base and r.random() < 0.6:
            t = list(r.choice(base))
            for _ in range(r.randint(0, 4)):
                t[r.randrange(len(t))] = r.choice(words)
        else:
            t = [r.choice(words) for _ in range(r.randint(3, 40))]
        base.append(t)
        half = len(t) // 2
        rows.append((i, " ".join(t[:half]), " ".join(t[half:]) if r.random() < 0.9 else None, "", "clash"))
    return rows


@pytest.mark.parametrize("block", [3, 12, 2000])
def test_against_brute_force(spark, monkeypatch, block):
    rows = corpus(150, 5)
    monkeypatch.setattr(N, "BLOCK", block)
    got = {tuple(x) for x in N.found(spark.createDataFrame(rows, DDL), "row_id").collect()}
    assert got == brute(rows)


def test_edge_rows(spark):
    t = "бір екі үш төрт бес алты"
    rows = [(1, t, None, None, ""), (2, t, None, None, ""), (2, t, None, None, ""), (3, None, None, None, ""), (4, None, None, None, ""), (5, "", "a b", None, ""), (None, t, None, None, "")]
    df = spark.createDataFrame(rows, DDL)
    assert {tuple(x) for x in N.found(df, "row_id").collect()} == {(1, 2)}
    g = {x.row_id: (x.class_id, x.class_size) for x in N.groups(df, "row_id").collect()}
    assert g == {1: (1, 2), 2: (1, 2)}
    assert N.found(df.limit(0), "row_id").count() == 0


def test_one_large_group_of_near_copies(spark, monkeypatch):
    """A third of all rows are near-copies of one text: links grow with the rows, not with their square."""
    r = random.Random(2)
    words = [f"w{i}" for i in range(4000)]
    base = r.sample(words, 60)
    rows = []
    for i in range(900):
        t = list(base) if i % 3 == 0 else r.sample(words, 40)
        t[r.randrange(len(t))] = r.choice(words)
        rows.append((i, " ".join(t), None, None, ""))
    sets = N.run_sets(spark.createDataFrame(rows, DDL), "row_id").selectExpr("xxhash64(grams) h", "grams")
    links = N.linked_pairs(sets, block=20).distinct()
    assert links.count() < 3000
    monkeypatch.setattr(N, "BLOCK", 20)
    g = N.groups(spark.createDataFrame(rows, DDL), "row_id")
    assert g.where("class_id = 0").count() == 300 and g.count() == 900


def test_blocks_of_a_group_give_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(N, "PAIR_BLOCK", 3)
    t = "бір екі үш төрт бес алты"
    df = spark.createDataFrame([(i, t, None, None, "") for i in range(12)], DDL)
    got = [tuple(x) for x in N.found(df, "row_id").collect()]
    assert len(got) == 66 == len(set(got)) and all(a < b for a, b in got)
