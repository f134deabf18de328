"""Problem 10: abusive, hateful or sexual content.

A bidirectional gated recurrent network with attention pooling reads windows of words; a word enters as a word vector and
as the sum (over the root of their number) of the vectors of its letter runs, both hashed. It is trained here, in numpy, on the raters' verdicts: the
mean verdict of a document is its target. Since only a sentence or two of a document are meant, training picks the
windows: of a rated-bad document the windows that score highest (at first, by the words that bad documents share), of a
good one the highest and some others. Spelling is folded first: letters that look alike are one letter, letters drawn out
or set apart are joined, digits and signs inside words become the letters they stand for.

At most ``MAX_DOCS`` rated documents (in the order of a hash of their ids) are used for the fit, the bound on what one
task holds; every fifth of them is kept apart to set the threshold (0.9 where those hold no verdicts of both kinds). Bad
documents are rated more often than others, so shares among the rated say nothing of the corpus: where ``HELD`` bad ones or
more are kept apart, the threshold is the one that as many documents of the corpus reach as are estimated to be bad. The
fit runs once, in a task on an executor, the same number of readings of every document whatever their number, and only
its arrays come back. All overlapping windows of all documents are scored,
whole texts, in Arrow batches; the input side of the recurrences is computed once per distinct word of a task, as long as
its vocabulary has room.

Defined results: null or blank texts score 0; raters' null verdicts are no verdict; without any verdicts of both kinds
all scores are 0; repeated rows are scored apart.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarqyt.session import cut, spread

MAX_DOCS = 5000
WINDOW, STEP = 24, 12
BUCKETS, DIM, HIDDEN = 1 << 14, 16, 16
EPOCHS, BATCH = 8, 64
LEVELS = [0.3, 0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.88, 0.9, 0.92, 0.94, 0.95, 0.96, 0.97, 0.98, 0.985, 0.99, 0.995]  # thresholds to choose from
HELD = 20  # bad documents kept apart from which their share above a threshold is read
MUTE = 0.25  # share of words left out altogether in training
SEEN = 3  # documents in which a word must be to lead the choice of windows

# Letters and signs that look alike, folded to one
FOLD = str.maketrans("аеорсухкмтнвіёйүұқғңөәһ@$01346ѕј", "aeopcyxkmthbieиyykгноahasoiзчбsj")
EDGE = re.compile(r"^[^\w@*$]+|[^\w@*$]+$")
APART = re.compile(r"(?<!\w)(?:\w[ ._*-]){3,}\w(?!\w)")
HINT = re.compile(r"[ ._*-]\w[ ._*-]\w[ ._*-]")  # in every match of APART, and quickly looked for
LONG = re.compile(r"(.)\1{2,}")


def words(t: str | None) -> list[str]:
    """The folded words of a text; numbers are one word."""
    if not t:
        return []
    t = t.lower()
    if HINT.search(t):
        t = APART.sub(lambda m: re.sub(r"[ ._*-]", "", m[0]) if not m[0][0].isdigit() else m[0], t)
    return t.split()


def folded(raw: str) -> str:
    w = EDGE.sub("", raw)
    if not w:
        return raw[:2]
    if not w.isalpha() and not any(map(str.isalpha, w)):
        return "*" if "*" in w else "0"
    w = LONG.sub(r"\1", w).translate(FOLD)
    return w if w.isalnum() else re.sub(r"[^\w*]", "", w)


@lru_cache(1 << 17)
def _bucket(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s) % (BUCKETS - 1) + 1


def letter_runs(w: str) -> list[int]:
    s = f"<{w}>"
    return [_bucket(s[i : i + k]) for k in (3, 4) for i in range(len(s) - k + 1)] or [_bucket(s)]


class Vocabulary:
    """Distinct words of a batch as numbers, with their letter runs."""

    def __init__(self) -> None:
        self.ids: dict[str, int] = {"": 0}
        self.known: dict[str, int] = {}
        self.word = [0]
        self.runs: list[list[int]] = [[0]]

    def of(self, raw: str) -> int:
        w = folded(raw)
        i = self.ids.get(w)
        if i is None:
            i = self.ids[w] = len(self.word)
            self.word.append(_bucket("w" + w))
            self.runs.append(letter_runs(w))
        self.known[raw] = i
        return i

    def numbers(self, texts: list[str | None]) -> list[np.ndarray]:
        known = self.known
        out = []
        for t in texts:
            raw = words(t)
            got = list(map(known.get, raw))
            if None in got:
                got = [known[w] if w in known else self.of(w) for w in raw]
            out.append(np.array(got, np.int32))
        return out


def windows(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all documents (padded with 0) and the document of each."""
    who, rows = [], []
    for d, x in enumerate(docs):
        n = max(1, -(-(len(x) - WINDOW) // STEP) + 1) if len(x) else 0
        if n:
            padded = np.zeros((n - 1) * STEP + WINDOW, np.int32)
            padded[: len(x)] = x
            rows.append(np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STEP][:n])
            who.append(np.full(n, d, np.int32))
    if not rows:
        return np.zeros((0, WINDOW), np.int32), np.zeros(0, np.int32)
    return np.concatenate(rows), np.concatenate(who)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _summed(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers in ``at`` and the sums of their rows."""
    # numbers of two bytes are sorted in linear time
    order = np.argsort(at.astype(np.uint16) if at.max(initial=0) < 1 << 16 else at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[first], np.add.reduceat(rows[order], first, axis=0)


def _means(table: np.ndarray, flat: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Per word the sum of its rows of ``table`` over the root of their number; ``flat`` are the rows of all words."""
    return np.add.reduceat(table[flat], np.concatenate([[0], np.cumsum(size)[:-1]]), axis=0) / np.sqrt(size)[:, None].astype(np.float32)


class Network:
    """Parameters by name; two directions (f, b) of gated recurrent units."""

    def __init__(self, seed: int = 7) -> None:
        r = np.random.default_rng(seed)
        d, h = 2 * DIM, HIDDEN
        self.p: dict[str, np.ndarray] = {"Ew": r.normal(0, 0.4, (BUCKETS, DIM)), "Er": r.normal(0, 1.0, (BUCKETS, DIM))}
        for k in "fb":
            self.p["W" + k] = r.normal(0, (1 / d) ** 0.5, (d, 3 * h))
            self.p["U" + k] = r.normal(0, (1 / h) ** 0.5, (h, 3 * h))
            self.p["c" + k] = np.zeros(3 * h)
        self.p |= {"A": r.normal(0, (1 / (2 * h)) ** 0.5, (2 * h, h)), "a": r.normal(0, 0.3, h), "o": r.normal(0, 0.3, 2 * h), "z": np.array([-1.0])}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.threshold = 0.9
        self.losses: list[float] = []
        self.held = np.zeros(0)  # scores of the bad documents kept apart

    def inputs(self, v: Vocabulary, start: int = 0) -> np.ndarray:
        """The inputs of the words from number ``start`` on."""
        runs = v.runs[start:]
        size = np.array([len(x) for x in runs])
        flat = np.fromiter((r for x in runs for r in x), np.int64, int(size.sum()))
        x = np.concatenate([self.p["Ew"][np.array(v.word[start:])], _means(self.p["Er"], flat, size)], axis=1)
        if not start:
            x[0] = 0
        return x.astype(np.float32)

    def products(self, v: Vocabulary, known: np.ndarray | None = None) -> np.ndarray:
        """What all words add to the gates; ``known`` is what was returned when the vocabulary had fewer of them."""
        have = 0 if known is None else known.shape[1] // 2
        if have == len(v.word):
            return known
        new = self._products(self.inputs(v, have), not have)
        return np.concatenate([known, new], axis=1) if have else new

    def _products(self, x: np.ndarray, padded: bool = True) -> np.ndarray:
        """What the words' inputs ``x`` add to each gate in either direction: (gate, two rows a word, unit). The first word is
        the padding if ``padded``."""
        p, h = self.p, HIDDEN
        # per gate an array of its own, so that every step works on whole memory; the sigmoid is a tanh of half its argument
        z = np.empty((3, len(x), 2, h), x.dtype)
        for d, k in enumerate("fb"):
            z[:, :, d] = (x @ p["W" + k] + p["c" + k]).reshape(-1, 3, h).transpose(1, 0, 2)
        z[:2] *= 0.5
        if padded:
            z[1, 0] = -1e4  # padding leaves the state as it is
        return z.reshape(3, -1, h)

    def _run(self, z: np.ndarray, ids: np.ndarray, keep: bool):
        """Both directions side by side over windows of word numbers: the states (step, direction, window, unit), where step k
        of the second direction is at the window's word ``WINDOW - 1 - k``, and what each step computed."""
        p, n, h, kind = self.p, len(ids), HIDDEN, z.dtype.type
        ur, uq, uc = (np.stack([p["U" + k][:, i * h : i * h + h] for k in "fb"]) * kind(f) for i, f in enumerate((0.5, 0.5, 1)))
        at = np.concatenate([2 * ids.T, 2 * ids.T[::-1] + 1], axis=1)
        out = np.empty((WINDOW, 2, n, h), kind)
        s = np.zeros((2, n, h), kind)
        memo = []
        for k in range(WINDOW):
            r, q, c = (m.take(at[k], axis=0).reshape(2, n, h) for m in z)
            r += s @ ur
            np.tanh(r, out=r)
            r += 1
            r *= 0.5
            q += s @ uq
            np.tanh(q, out=q)
            q += 1
            q *= 0.5
            rs = r * s
            c += rs @ uc
            np.tanh(c, out=c)
            new = np.subtract(c, s, out=out[k])
            new *= q
            new += s
            if keep:
                memo.append((s, r, q, c, rs))
            s = new
        return out, memo

    def forward(self, z: np.ndarray, ids: np.ndarray, keep: bool = False):
        p, h = self.p, HIDDEN
        out, memo = self._run(z, ids, keep)
        f, b = out[:, 0].reshape(-1, h), np.ascontiguousarray(out[::-1, 1]).reshape(-1, h)
        att = f @ p["A"][:h]
        att += b @ p["A"][h:]
        np.tanh(att, out=att)
        e = (att @ p["a"]).reshape(WINDOW, -1)
        e[ids.T == 0] = -1e4
        e -= e.max(axis=0)
        w = np.exp(e)
        w /= w.sum(axis=0)
        said = (f @ p["o"][:h] + b @ p["o"][h:]).reshape(WINDOW, -1)
        y = (w * said).sum(axis=0) + p["z"][0]
        return y, (f, b, att, w, said, memo)

    def gradients(self, x: np.ndarray, ids: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
        p, h, n = self.p, HIDDEN, len(ids)
        y, (f, b, att, w, said, memo) = self.forward(self._products(x), ids, True)
        pr = _sigmoid(y)
        loss = float((weight * -(target * np.log(pr + 1e-7) + (1 - target) * np.log(1 - pr + 1e-7))).mean())
        dy = (weight * (pr - target) / n).astype(x.dtype)
        g = {"z": np.array([dy.sum()], x.dtype)}
        share = (w * dy).ravel()
        g["o"] = np.concatenate([share @ f, share @ b])
        dw = said * dy
        de = (w * (dw - (w * dw).sum(axis=0))).ravel()
        g["a"] = de @ att
        datt = de[:, None] * p["a"] * (1 - att**2)
        g["A"] = np.concatenate([f.T @ datt, b.T @ datt])
        part = np.empty((WINDOW, 2, n, h), x.dtype)
        part[:, 0] = (share[:, None] * p["o"][:h] + datt @ p["A"][:h].T).reshape(WINDOW, n, h)
        part[::-1, 1] = (share[:, None] * p["o"][h:] + datt @ p["A"][h:].T).reshape(WINDOW, n, h)
        tr, tq, tc = (np.stack([p["U" + k][:, i * h : i * h + h].T for k in "fb"]) for i in range(3))
        # what reaches the three gates, and the states before each step, per direction
        d = np.empty((3, 2, WINDOW, n, h), x.dtype)
        before = np.empty((2, 2, WINDOW, n, h), x.dtype)
        ds = np.zeros((2, n, h), x.dtype)
        for k in range(WINDOW - 1, -1, -1):
            s, r, q, c, rs = memo[k]
            dn = part[k]
            dn += ds
            live = dn * q
            dc = live * (1 - c * c)
            dq = live * (c - s) * (1 - q)
            drs = dc @ tc
            ds = drs * r
            dr = ds * s * (1 - r)
            ds += dn
            ds -= live
            ds += dr @ tr
            ds += dq @ tq
            d[0, :, k], d[1, :, k], d[2, :, k] = dr, dq, dc
            before[0, :, k], before[1, :, k] = s, rs
        flat, seen = d.reshape(3, 2, -1, h), before.reshape(2, 2, -1, h).transpose(0, 1, 3, 2)
        du = np.concatenate([seen[0] @ flat[0], seen[0] @ flat[1], seen[1] @ flat[2]], axis=2)
        steps = np.empty((WINDOW, n, 2, 3, h), x.dtype)
        steps[:, :, 0] = d[:, 0].transpose(1, 2, 0, 3)
        steps[::-1, :, 1] = d[:, 1].transpose(1, 2, 0, 3)
        dz = np.zeros((len(x), 6 * h), x.dtype)
        at, sums = _summed(ids.T.ravel(), steps.reshape(-1, 6 * h))
        dz[at] = sums
        dx = np.zeros_like(x)
        for i, k in enumerate("fb"):
            own = dz[:, 3 * h * i : 3 * h * (i + 1)]
            g["U" + k], g["W" + k], g["c" + k] = du[i], x.T @ own, own.sum(axis=0)
            dx += own @ p["W" + k].T
        return loss, g, dx

    def score(self, v: Vocabulary, ids: np.ndarray, z: np.ndarray | None = None, batch: int = 512) -> np.ndarray:
        """The windows' scores; ``z`` are the ``products`` of the vocabulary, if they are there already."""
        if not len(ids):
            return np.zeros(0, np.float32)
        z = self.products(v) if z is None else z
        return np.concatenate([self.forward(z, ids[i : i + batch])[0] for i in range(0, len(ids), batch)])


def _sub(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words that occur in some windows, and the windows renumbered."""
    used, back = np.unique(ids, return_inverse=True)
    if used[0] != 0:
        used, back = np.concatenate([[0], used]), back + 1
    return used, back.reshape(ids.shape).astype(np.int32)


def fit(texts: list[str], target: np.ndarray, seed: int = 7) -> Network:
    """Trains on documents with their mean verdicts (and sets the threshold on every fifth)."""
    net = Network(seed)
    r = np.random.default_rng(seed)
    bad = target > 0.5
    if not bad.any() or bad.all():
        net.p["z"][0] = -20.0
        net.p["o"][:] = 0
        return net
    v = Vocabulary()
    docs = v.numbers(texts)
    ids, who = windows(docs)
    held = np.arange(len(texts)) % 5 == 4
    if not (bad & ~held).any():
        held[:] = False
    # words that bad documents share, to start with
    inside = Counter(w for d, b, k in zip(docs, bad, held, strict=True) if b and not k for w in set(d.tolist()))
    outside = Counter(w for d, b, k in zip(docs, bad, held, strict=True) if not b and not k for w in set(d.tolist()))
    nb, ng = max(1, int((bad & ~held).sum())), max(1, int((~bad & ~held).sum()))
    odds = np.zeros(len(v.word), np.float32)
    for w in set(inside) | set(outside):
        odds[w] = np.log((inside[w] + 0.3) / (nb + 1)) - np.log((outside[w] + 0.3 * ng / nb) / (ng + 1))
    odds[0] = 0
    seen = np.array([inside[i] + outside[i] for i in range(len(v.word))])
    odds[seen < SEEN] = 0
    first = np.sort(odds[ids], axis=1)[:, -4:].sum(axis=1) + np.sort(odds[ids], axis=1)[:, :4].sum(axis=1) * 0.2
    # what the words of a good document reach at most, nearly always
    top_of = np.full(len(texts), -9.0)
    np.maximum.at(top_of, who, first)
    lead = max(4.0, float(np.quantile(top_of[~bad & ~held], 0.98)) if (~bad & ~held).any() else 4.0)
    state = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in net.p.items()}
    tick = 0
    starts = np.searchsorted(who, np.arange(len(texts)))
    ends = np.searchsorted(who, np.arange(len(texts)), side="right")
    order_docs = np.flatnonzero(~held & (ends > starts))
    word = np.array(v.word)
    sizes = np.array([len(x) for x in v.runs])
    every = np.fromiter((q for x in v.runs for q in x), np.int64, int(sizes.sum()))
    begin = np.cumsum(sizes) - sizes
    led = EPOCHS * 2 // 3
    total, taken = {k: np.zeros_like(q) for k, q in net.p.items()}, 0
    for epoch in range(EPOCHS):
        # the shared words lead at first, the network itself later
        s = first if epoch < led else net.score(v, ids)
        high = lead if epoch < led else 0.0
        pick, y, wt = [], [], []
        for d in order_docs:
            a, b = starts[d], ends[d]
            o = a + np.argsort(-s[a:b], kind="stable")
            if bad[d]:
                top = [i for i in o[:4] if (s[i] > high and first[i] > lead / 2) or first[i] > lead]
                rest = [i for i in o[len(o) // 2 :] if first[i] < lead / 2 and i not in top][:2]
                pick += top + rest
                y += [float(target[d])] * len(top) + [0.0] * len(rest)
                wt += [2.0] * len(top) + [1.0] * len(rest)
            else:
                top = list(o[:2])
                some = top + list(r.integers(a, b, 2))
                pick += some
                y += [float(target[d])] * len(top) + [0.0] * 2
                wt += [1.0] * len(some)
        pick, y, wt = np.array(pick), np.array(y, np.float32), np.array(wt, np.float32)
        order = r.permutation(len(pick))
        losses = []
        rate = 0.02 if epoch < led // 2 else 0.008 if epoch < led else 0.004
        for i in range(0, len(order), BATCH):
            j = order[i : i + BATCH]
            used, local = _sub(ids[pick[j]])
            # words are forgotten at times, rare ones always, so that their letters count
            forget = (r.random(len(used)) < 0.3) | (seen[used] < 3)
            size = sizes[used]
            owner = np.repeat(np.arange(len(used)), size)
            flat = every[np.arange(len(owner)) + (begin[used] - (np.cumsum(size) - size))[owner]]
            # some are left out whole, so that no single odd name decides
            mute = r.random(len(used)) < MUTE
            x = np.concatenate([np.where(forget[:, None], np.float32(0), net.p["Ew"][word[used]]), _means(net.p["Er"], flat, size)], axis=1)
            x[mute, DIM:] = 0
            x[0] = 0
            loss, g, dx = net.gradients(x, local, y[j], wt[j])
            losses.append(loss)
            dx[0] = 0
            dx[mute, DIM:] = 0
            tick += 1
            fix = rate * np.sqrt(1 - 0.999**tick) / (1 - 0.9**tick)
            rows = {"Ew": (word[used], np.where(forget[:, None], np.float32(0), dx[:, :DIM])), "Er": (flat, (dx[:, DIM:] / np.sqrt(size)[:, None].astype(np.float32))[owner])}
            for k, q in g.items():
                m, n = state[k]
                m *= 0.9
                m += 0.1 * q
                n *= 0.999
                n += 0.001 * q * q
                net.p[k] -= (fix * m / (np.sqrt(n) + 1e-8) + 1e-5 * net.p[k]).astype(np.float32)
            for k, (at, q) in rows.items():
                u, q2 = _summed(at, q)
                m, n = state[k]
                m[u] = 0.9 * m[u] + 0.1 * q2
                n[u] = 0.999 * n[u] + 0.001 * q2 * q2
                net.p[k][u] -= fix * m[u] / (np.sqrt(n[u]) + 1e-8) + 1e-4 * net.p[k][u]
            # of the readings that the network leads, the mean of its states is kept
            if epoch >= led and tick % 8 == 0:
                taken += 1
                for k, q in net.p.items():
                    total[k] += q
        net.losses.append(float(np.mean(losses)))
    if taken:
        net.p = {k: q / np.float32(taken) for k, q in total.items()}
    if bad[held].any() and not bad[held].all():
        s = net.score(v, ids)
        top = np.array([s[a:b].max() if b > a else -20 for a, b in zip(starts, ends, strict=True)])
        x, truth = _sigmoid(top[held]), bad[held]
        best = max((2 * (truth & (x >= c)).sum() / max(1, truth.sum() + (x >= c).sum()), -abs(c - 0.9), c) for c in (0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99))
        net.threshold = best[2]
        net.held = x[truth]
    return net


def threshold(net: Network, reach: list[int], documents: int) -> float:
    """The threshold for a corpus of which ``reach[i]`` documents score ``LEVELS[i]`` or more. No fewer than the true cases
    times their share above a threshold score above it, and hardly more above high ones: that gives the number of cases. What
    as many documents reach takes in as many wrong ones as it leaves true ones out. Wrong verdicts, on documents that do
    not even reach the lowest threshold, do not count."""
    share = (net.held[:, None] >= np.array(LEVELS)).mean(axis=0) if len(net.held) else np.zeros(len(LEVELS))
    if len(net.held) < HELD or not share[0] or not documents:
        return net.threshold
    share, part = share / share[0], np.array(reach) / documents
    fit_for = share >= 0.5
    cases = (part[fit_for] / share[fit_for]).min()
    return LEVELS[int(np.abs(part - cases)[fit_for].argmin())] if cases else net.threshold


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> Network:
    """The network fitted on at most ``max_docs`` rated documents."""
    mean = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.avg("toxic").alias("target"))
    some = mean.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    rows = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("target").alias("target")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        texts = [t for b in got for t in b.column(1).to_pylist()]
        net = fit(texts, np.array([x for b in got for x in b.column(2).to_pylist()], float))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)], pa.binary())], ["net"])

    # limit leaves one partition, in the order of the hash
    made = rows.select("doc_id", "text", "target").coalesce(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").mapInArrow(go, "net binary").collect()
    return pickle.loads(made[0]["net"]) if made else fit([], np.zeros(0))


def scored(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``(doc_id, *keep, score, flagged)``: the highest score of any window of each document. The scores are made at once and
    written, since the threshold depends on all of them."""
    keep = keep or []
    net = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kinds = dict(docs.dtypes)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = shared.value
        v, z = Vocabulary(), None
        for b in batches:
            if len(v.word) > 60_000:
                v, z = Vocabulary(), None
            score = []
            texts = b.column(0).to_pylist()
            for i in range(0, len(texts), 1000):
                ids, who = windows(v.numbers(texts[i : i + 1000]))
                z = n.products(v, z)
                top = np.full(min(1000, len(texts) - i), -20.0, np.float32)
                np.maximum.at(top, who, n.score(v, ids, z))
                score.append(_sigmoid(top))
            s = np.concatenate(score).astype(np.float64) if score else np.zeros(0)
            s[s < 1e-6] = 0.0
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(s)], ["doc_id", *keep, "score"])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in ["doc_id", *keep]), "score double"])
    rows = cut(spread(docs.select("text", "doc_id", *keep), "doc_id").mapInArrow(go, schema))
    documents, *reach = rows.agg(F.count(F.lit(1)), *(F.count_if(F.col("score") >= c) for c in LEVELS)).first()
    return rows.withColumn("flagged", F.col("score") >= threshold(net, reach, documents))


def found(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, labels).where("flagged").select("doc_id").distinct()


def rates(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per source: documents, flagged documents, their share, and the mean score."""
    s = scored(docs, labels, ["source"])
    return s.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count_if("flagged").alias("flagged"), F.avg(F.col("flagged").cast("double")).alias("rate"), F.avg("score").alias("mean_score"))
