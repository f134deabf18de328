import random

import numpy as np

from sarqyt.llm import abuse as A

DOCS = "doc_id long, text string, source string, score string"


def data(n, seed=0):
    r = random.Random(seed)
    plain = [f"plan{i}" for i in range(60)]
    bad = ["ты скотина чтоб ты сдох", "какой же ты дебил собака умнее", "вы все тупицы пошли вон отсюда"]
    docs, target = [], []
    for i in range(n):
        w = [r.choice(plain) for _ in range(r.randint(20, 90))]
        b = i % 4 == 0
        if b:
            at = r.randrange(len(w))
            w[at:at] = r.choice(bad).split()
        docs.append(" ".join(w))
        target.append(float(b))
    return docs, np.array(target)


def test_gradients():
    net = A.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(0)
    x = r.normal(0, 0.5, (20, 2 * A.DIM))
    x[0] = 0
    ids = r.integers(1, 20, (5, A.WINDOW))
    ids[0, 9:] = 0
    y, w = r.random(5), np.ones(5)
    _, g, dx = net.gradients(x, ids, y, w)
    for k in ("o", "A", "a", "Uf", "Wb", "cf"):
        i = tuple(r.integers(0, s) for s in net.p[k].shape)
        old, e = net.p[k][i], 1e-4
        net.p[k][i] = old + e
        up = net.gradients(x, ids, y, w)[0]
        net.p[k][i] = old - e
        down = net.gradients(x, ids, y, w)[0]
        net.p[k][i] = old
        assert abs((up - down) / 2 / e - g[k][i]) < 1e-4


def test_held_out_accuracy():
    docs, y = data(240)
    net = A.fit(docs, y)
    new, truth = data(120, 9)
    v = A.Vocabulary()
    ids, who = A.windows(v.numbers(new))
    top = np.full(len(new), -20.0)
    np.maximum.at(top, who, net.score(v, ids))
    assert ((A._sigmoid(top) >= net.threshold) == (truth > 0.5)).mean() > 0.93


def test_folding_and_windows():
    assert A.folded("ск0тина!") == A.folded("скотина") and A.folded("сууууука") == A.folded("сука") and A.words("whole b a s t a r d there")[1] == "bastard"
    x = np.arange(1, 101, dtype=np.int32)
    ids, who = A.windows([x, x[:3], x[:0]])
    assert set(ids[who == 0].ravel()) >= set(range(1, 101)) and (who == 1).sum() == 1 and (who == 2).sum() == 0


def test_frames(spark):
    docs, y = data(60)
    d = spark.createDataFrame([(i, t, "s", "") for i, t in enumerate(docs)] + [(900, None, None, ""), (901, " ", "s", ""), (0, docs[0], "s", "")], DOCS)
    labels = spark.createDataFrame([(i, "r", int(v)) for i, v in enumerate(y)] + [(1, "q", None)], "doc_id long, rater string, toxic int")
    s = A.scored(d.drop("score"), labels).collect()
    assert len(s) == 63 and {r.score for r in s if r.doc_id in (900, 901)} == {0.0}
    assert A.scored(d.drop("score"), labels.limit(0)).where("flagged").count() == 0
    rates = {r.source: r.documents for r in A.rates(d.drop("score"), labels).collect()}
    assert rates == {"s": 62, None: 1}


def test_every_letter_of_a_long_word_counts():
    w = "".join(chr(97 + i % 26) + chr(97 + i // 26) for i in range(100))
    assert len(A.letter_runs(w)) == 2 * len(w) - 1
    assert A.letter_runs(w + "скотина")[-5:] != A.letter_runs(w + "картина")[-5:]


def test_threshold_follows_the_corpus_not_the_rated():
    """Half of the rated documents are bad, 3 of 100 of the corpus; good ones that score high are few among the rated."""
    r = np.random.default_rng(5)
    bad, good = r.beta(30, 1, 3000), r.beta(1, 5, 97000)
    good[:1500] = r.uniform(0.6, 0.93, 1500)
    net = A.Network()
    net.threshold, net.held = 0.8, np.concatenate([r.beta(30, 1, 150), np.full(20, 0.01)])
    score = np.concatenate([bad, good])
    c = A.threshold(net, [int((score >= x).sum()) for x in A.LEVELS], len(score))
    found = (score >= c).sum()
    assert (bad >= net.threshold).sum() / (score >= net.threshold).sum() < 0.85
    assert (bad >= c).sum() / found > 0.9 and (bad >= c).mean() > 0.9
    assert A.threshold(A.Network(), [0] * len(A.LEVELS), 0) == 0.9


def test_words_of_a_grown_vocabulary_score_alike():
    docs, _ = data(40)
    net, v = A.Network(), A.Vocabulary()
    first = v.numbers(docs[:20])
    z = net.products(v)
    ids, _ = A.windows(first + v.numbers(docs[20:] + ["жаңа сөздер мұнда тұр"]))
    z = net.products(v, z)
    assert np.allclose(net.score(v, ids, z), net.score(v, ids), atol=1e-5)
    assert np.allclose(net.score(v, ids, z), [net.score(v, ids[i : i + 1])[0] for i in range(len(ids))], atol=1e-5)


def test_apart_letters_are_joined_wherever_they_stand():
    for t in ("b a s t a r d", "x с.к.о.т", "ab c d e f gh", "1 2 3 4 5", "a_b_c_d!", "т.б. 9.5 k", "a b c d", "", "..a.b.c.d..", "a-b*c.d e"):
        low = t.lower()
        want = A.APART.sub(lambda m: m[0] if m[0][0].isdigit() else "".join(c for c in m[0] if c not in " ._*-"), low)
        assert A.words(t) == want.split()
