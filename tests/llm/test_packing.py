import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sarqyt.llm import packing as K
from sarqyt.llm.queries import TOKENIZER

pytestmark = pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer files")
DDL = "doc_id long, text string, container string, size string"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=60))
def test_best_fit_fits(sizes):
    bins = K.best_fit([(s, str(i)) for i, s in enumerate(sizes)], 50)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(max(1, sizes[i]) for i in b) <= 50 for b in bins)
    total = sum(max(1, s) for s in sizes)
    assert len(bins) <= 2 * (-(-total // 50)) + 1


def test_containers(spark):
    rows = [(i, "сөз " * (i % 40 + 1), "x", "y") for i in range(300)] + [(5, "again", "x", "y"), (900, None, "", ""), (901, "", "", ""), (902, "слово дело " * 2000, "", "")]
    df = spark.createDataFrame(rows, DDL)
    got = K.containers(df, "doc_id", tokenizer=TOKENIZER, capacity=256, task_items=50).toPandas()
    n = dict(K.sizes(df, "doc_id", tokenizer=TOKENIZER).groupBy("id").sum("tokens").collect())
    assert dict(got.groupby("doc_id").tokens.sum()) == n
    assert got.groupby("container").tokens.sum().max() <= 256
    cut = got[got.piece > 0].doc_id.unique().tolist()
    assert cut == [902] and len(got[got.doc_id == 5]) == 2
    full = K.fill(K.containers(df, "doc_id", tokenizer=TOKENIZER, capacity=256), 256).first()
    assert full.filled > 0.97 and full.items == len(got)
    assert K.containers(df.limit(0), "doc_id", tokenizer=TOKENIZER).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(spark, name):
    path = os.path.join(os.path.dirname(TOKENIZER), name)
    df = spark.createDataFrame([(1, "hello world", "", "")], DDL)
    assert K.sizes(df, "doc_id", tokenizer=path).first().tokens in (2, 3)


def test_layout_does_not_matter_and_rounds_go_on(spark):
    rows = [(i % 290 if i else None, "сөз " * (i * 7 % 60 + 1), "x", "y") for i in range(600)]
    df = spark.createDataFrame(rows, DDL)
    got = [sorted(map(str, K.containers(d, "doc_id", tokenizer=TOKENIZER, capacity=256, task_items=4).collect())) for d in (df.repartition(3), df.repartition(11, "text"))]
    assert got[0] == got[1] and len(got[0]) == 600


def test_many_rounds_lose_nothing(spark, monkeypatch):
    rounds, pack = [], K._pack

    def every_round_merges_one(bins, capacity):
        rounds.append(1)
        return pack(bins, capacity) if len(rounds) > 14 else pack(bins.limit(2), capacity).unionByName(bins.subtract(bins.limit(2)))

    monkeypatch.setattr(K, "_pack", every_round_merges_one)
    df = spark.createDataFrame([(i, "сөз " * 3, "x", "y") for i in range(40)], DDL)
    assert K.containers(df, "doc_id", tokenizer=TOKENIZER, capacity=2048, task_items=1).count() == 40
