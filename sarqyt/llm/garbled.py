"""Problem 5: text garbled by a wrong character encoding, or by glyph codes in place of letters.

A hidden Markov model with one clean state and one state per encoding pair (and one for glyph codes) labels the
characters of a text; each labelled span gets its state's inverse transform.

The model is learned from the texts themselves: one pass counts characters, pairs of letters and runs of capitals
(tables bounded by the 16-bit alphabet, summed in partial counts). The clean state emits a letter given the letter
before, in either case. What the ordinary letters would look like under a pair is computed by running them through it:
those are the emissions of its state, given the character before, so a letter that comes out as several characters has
them in order, and a letter that comes out as one may follow what its own letter may follow. What a pair leaves as it is
speaks for no state. The Viterbi path of every text decides, whole texts, all of them; no pattern looks first.

A labelled span gets the inverse of its state; where that does not exist the span stays as it is and still counts.

Defined results: null is no case and stays null; the empty text stays empty; texts are labelled whole; spans whose
inverse does not exist stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarqyt.session import spread

# Fixed values: (encoding of the bytes, encoding they were read in), applied one after another.
PAIRS: dict[str, list[tuple[str, str]]] = {
    f"{right}>{wrong}": [(right, wrong)]
    for right, wrong in [
        ("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp1251"), ("utf-8", "cp866"), ("utf-8", "koi8-r"), ("utf-8", "mac-cyrillic"), ("utf-8", "kz1048"),
        ("kz1048", "cp1252"), ("kz1048", "latin-1"), ("kz1048", "cp1251"), ("kz1048", "koi8-r"), ("kz1048", "cp866"), ("kz1048", "mac-cyrillic"),
        ("cp866", "cp1251"), ("cp866", "cp1252"), ("koi8-r", "cp1251"), ("koi8-r", "cp1252"), ("mac-cyrillic", "cp1251"),
    ]
}
PAIRS["utf-8>cp1252 twice"] = [("utf-8", "cp1252"), ("utf-8", "cp1252")]
PAIRS["utf-8>latin-1 twice"] = [("utf-8", "latin-1"), ("utf-8", "latin-1")]
PAIRS["utf-8>cp1251 twice"] = [("utf-8", "cp1251"), ("utf-8", "cp1251")]
# a pair whose stretch holds marks alone, such as a quotation mark in an English text, is a state of its own
MARK_PAIRS = {f"{name} marks": chain for name, chain in PAIRS.items() if name.startswith("utf-8")}
ALL_PAIRS = PAIRS | MARK_PAIRS
STATES = ["clean", *ALL_PAIRS, "glyph"]

KAZ = "ӘәҒғҚқҢңӨөҰұҮүҺһІі"
LETTERS = "".join(map(chr, range(0x410, 0x450))) + "Ёё" + KAZ
LATIN = "".join(map(chr, [*range(65, 91), *range(97, 123)]))
MARKS = "«»“”„’‘–—…№•·\n\t¬\u00ad"
WIDE_MARKS = "«»“”„’‘–—…№•€©®™½°ё"
GLYPH = re.compile(r"[/\\]uni(?:000[0-9A-Fa-f]{3}|[0-9A-Fa-f]{4})|[/\\]afii(?:100[1-9]\d|10110)|\(cid:\d+\)")
GLYPH_CHAR = "\ue000"
ENTER, LEAVE = -9.0, -3.0
STAY = float(np.log1p(-np.exp(LEAVE)))
GROUP, BLOCK = 1024, 100_000  # stretches labelled side by side, and characters looked at together
# states whose gains are bounded together: those of several bytes, those that make Western letters of Cyrillic ones, and
# each of the others by itself
_ONE = [n for n in PAIRS if not n.startswith("utf-8")]
_WEST = [n for n in _ONE if n.endswith(("cp1252", "latin-1"))]
BOUNDED = [[n for n in STATES if n not in _ONE and n != "clean"], _WEST, *([n] for n in _ONE if n not in _WEST)]


def _sloppy(encoding: str) -> tuple[str, dict[str, int]]:
    """What each byte is read as, and back; bytes without a character are read as the control of that number."""
    table = []
    for b in range(256):
        try:
            table.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            table.append(chr(b))
    back = {c: b for b, c in reversed(list(enumerate(table)))}
    return "".join(table), back


TABLES = {e: _sloppy(e) for p in PAIRS.values() for x in p for e in x if e != "utf-8"}


def garble(text: str, chain: list[tuple[str, str]]) -> str | None:
    for right, wrong in chain:
        if right == "utf-8":
            raw = text.encode("utf-8", "surrogatepass")
        else:
            back = TABLES[right][1]
            if not all(c in back for c in text):
                return None
            raw = bytes(back[c] for c in text)
        text = "".join(TABLES[wrong][0][b] for b in raw)
    return text


def restore(text: str, chain: list[tuple[str, str]]) -> str | None:
    """The inverse of ``garble``, or None."""
    for right, wrong in reversed(chain):
        back = TABLES[wrong][1]
        try:
            raw = bytes(back[c] if c in back else 0x3F for c in text)
            if sum(c not in back for c in text) > len(text) // 10:
                return None
            text = raw.decode("utf-8") if right == "utf-8" else "".join(TABLES[right][0][b] for b in raw)
        except (UnicodeDecodeError, KeyError):
            return None
    return text


def glyph_text(code: str) -> str | None:
    if "uni" in code:
        return chr(int(code[4:], 16))
    if "afii" in code:
        n = int(code[5:])
        # The Cyrillic glyph numbers run with the alphabet, with YO after IE
        if n == 10023 or n == 10071:
            return "Ё" if n == 10023 else "ё"
        for base, first in ((10017, 0x410), (10065, 0x430)):
            k = n - base
            if 0 <= k < 33:
                return chr(first + k - (k > 6))
    return None


class Model:
    """Emissions from the counts of characters, and the pair scores of ordinary letters."""

    def __init__(self, single: np.ndarray, pairs: np.ndarray, capitals: np.ndarray) -> None:
        total = max(1.0, float(single.sum()))
        ordinary = set(LETTERS + LATIN + MARKS)
        p: dict[str, float] = {}
        for i in np.flatnonzero(single):
            c = chr(i)
            if c in ordinary or i < 128 or 0x4E00 <= i < 0xA000 or 0x3000 <= i < 0x3040 or 0xFF00 <= i < 0xFF60:
                p[c] = max(float(single[i]) / total, 1e-7)
        for c in LETTERS:  # letters too rare to be seen must be possible
            p.setdefault(c, 1e-5)
        weight: list[dict[str, float]] = [dict(p)]
        for name, chain in ALL_PAIRS.items():
            if name in MARK_PAIRS:
                own = {c: 1.0 for c in WIDE_MARKS}
                w = self._through(own, chain)
                z = sum(w.values()) or 1.0
                weight.append({c: 0.9 * x / z for c, x in w.items() if ord(c) > 127})
                continue
            # the whole alphabet through the pair, so that what a pair leaves as it is speaks for no state
            w = self._through(p, chain)
            z = sum(w.values()) or 1.0
            weight.append({c: x / z for c, x in w.items() if ord(c) > 127})
        weight.append({GLYPH_CHAR: 0.9})
        alphabet = sorted(set().union(*weight))
        self.columns = {c: i for i, c in enumerate(alphabet)}
        self.table = np.full((len(alphabet) + 3, len(STATES)), np.log(1e-9), np.float32)
        for s, w in enumerate(weight):
            for c, x in w.items():
                self.table[self.columns[c], s] = np.log(x)
        for c, i in self.columns.items():
            if c not in p:
                self.table[i, 0] = np.log(self._foreign(c))
            elif ord(c) > 127:
                pass
            elif c.isalpha():
                self.table[i, 1:] = self.table[i, 0] - 3
            else:
                self.table[i, 1:] = self.table[i, 0]
        # characters no state knows: plain to all; private use for glyphs apart
        self.table[len(alphabet) :, :] = np.log(1e-5)
        self.table[self.columns[GLYPH_CHAR], 0] = -60
        self.lookup = np.full(0x10000, len(alphabet), np.int32)
        for c, i in self.columns.items():
            self.lookup[ord(c)] = i
        self.known = np.zeros(0x10000, bool)
        for c in p:
            self.known[ord(c)] = True
        self.other = np.float32(np.log(max(1e-6, sum(x for c, x in p.items() if c not in LETTERS + LATIN))))
        self.index = np.full(0x10000, 0, np.int32)
        for i, c in enumerate(LETTERS + LATIN):
            self.index[ord(c)] = i + 1
        self.clean = self._clean(pairs.astype(np.float64), capitals)
        self.after = self._after(p)
        self.most = [self.after[:, [STATES.index(s) for s in some]].max(axis=1) for some in BOUNDED]

    def _clean(self, pairs: np.ndarray, capitals: np.ndarray) -> np.ndarray:
        """The clean state's emissions, given the character before: log P(letter | letter before), from the case and from
        the letters in lower case, so that words in capitals are as likely as their letters. Row and column 0 stand for
        all that is no letter; what that is comes from the single characters."""
        names = [" ", *LETTERS, *LATIN]
        low = np.array([names.index(c.lower()) if c.lower() in names else i for i, c in enumerate(names)])
        case = np.array([0] + [1 + c.isupper() for c in names[1:]])
        fold = np.zeros_like(pairs)
        np.add.at(fold, (low[:, None], low[None, :]), pairs)
        base = fold.sum(axis=0) + 0.5
        fold = (fold + 2.0 * base / base.sum()) / (fold.sum(axis=1, keepdims=True) + 2.0)
        kinds = np.zeros((3, 3))
        np.add.at(kinds, (case[:, None], case[None, :]), pairs)
        kinds += [[1, 1, 1], [1, 1, 0.01], [20, 60, 20]]
        kinds /= kinds.sum(axis=1, keepdims=True)
        self.case = np.zeros(0x10000, np.int8)
        for c, k in zip(names[1:], case[1:].tolist(), strict=True):
            self.case[ord(c)] = k
        three = capitals + [2.0, 0.5, 18.0]
        self.capitals = np.log(three / three.sum() / kinds[2]).astype(np.float32)
        letter = np.where(case > 0, 1.0, 0.0)
        inner = (fold * (np.arange(len(names)) == low)).copy()  # columns of letters in lower case, and of no letter
        among = inner[low][:, low] / np.maximum(inner[low][:, 1:].sum(axis=1, keepdims=True), 1e-12)
        # abbreviations in capitals follow no letter pairs
        latin = np.array([False, *(c in LATIN for c in names[1:])])
        own = np.where(latin[:, None] == latin[None, :], base[low][None, :], 0)
        own = own / np.maximum(np.where(latin[:, None] == latin[None, :], base[None, :] * (np.arange(len(names)) == low) * (case > 0), 0).sum(axis=1, keepdims=True), 1e-12)
        among = np.where((case[:, None] == 2) & (case[None, :] == 2), 0.5 * among + 0.5 * own, among)
        p = kinds[case][:, case] * np.where(letter[None, :] > 0, among, 1.0)
        return np.log(np.maximum(p, 1e-7)).astype(np.float32)

    def _after(self, p: dict[str, float]) -> np.ndarray:
        """The emissions of the garbled states, given the character before: (before, character, state). A letter of several
        bytes comes out as a fixed order of characters; of one byte, as what its own letter may follow."""
        size = len(self.table)
        out = np.repeat(self.table[None, :, :], size, axis=0)
        # log P(the letter is over | its character so far): a state is left between letters only
        self.endings = np.zeros((size, len(STATES)), np.float32)
        for s, name in enumerate(STATES):
            if name not in ALL_PAIRS:
                continue
            chain = ALL_PAIRS[name]
            own = {c: 1.0 for c in WIDE_MARKS} if name in MARK_PAIRS else p
            made = {c: g for c in own if (g := garble(c, chain))}
            if all(len(g) == 1 for g in made.values()):
                at = np.array([self.columns.get(g, size - 3) for g in made.values()])
                codes = np.array([ord(c) for c in made])
                out[at[:, None], at[None, :], s] = self._given(codes[:, None], codes[None, :])
                continue
            w = np.zeros((size, size))
            start, stop = np.zeros(size), np.zeros(size)
            for c, g in made.items():
                at = [self.columns.get(x, size - 3) for x in g]
                start[at[0]] += own[c]
                stop[at[-1]] += own[c]
                for a, b in zip(at, at[1:], strict=False):
                    w[a, b] += own[c]
            begin = start / max(start.sum(), 1e-12)
            every = w.sum(axis=1) + stop
            self.endings[:, s] = np.where(every > 0, np.log(np.maximum(stop / np.maximum(every, 1e-12), 1e-6)), 0)
            w += stop[:, None] * begin[None, :]
            # a letter comes out from its first character on
            for y in {self.columns[x] for g in made.values() for x in g if ord(x) > 127}:
                out[:, y, s] = np.log(max(begin[y], 1e-9))
            for y in {self.columns[x] for g in made.values() for x in g if ord(x) > 127}:
                if w[y].sum():
                    out[y, :, s] = np.log(np.maximum(w[y] / w[y].sum(), 1e-9))
        return out.reshape(size * size, len(STATES))

    def clean_emissions(self, codes: np.ndarray) -> np.ndarray:
        """Of texts of one length as rows of characters: log P(character | the one before) in the clean state."""
        before = np.zeros_like(codes)
        before[:, 1:] = codes[:, :-1]
        out = self._given(before, codes)
        # after two capitals a third is usual, after one it is not
        c = self.case[codes]
        run = np.zeros(codes.shape, bool)
        run[:, 2:] = (c[:, 1:-1] == 2) & (c[:, :-2] == 2)
        return np.where(run & (c > 0), out + self.capitals[c], out)

    def _given(self, before: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """log P(character | the one before) in ordinary text: a letter comes from the letter before; another character from
        P(no letter) and its own share of those."""
        x, y = self.index[before], self.index[codes]
        own = self.table[self.lookup[codes], 0]
        return np.where(y > 0, self.clean[x, y], np.where(self.known[codes], self.clean[x, 0] + own - self.other, own))

    @staticmethod
    def _through(own: dict[str, float], chain: list[tuple[str, str]]) -> dict[str, float]:
        """The weights of the characters that come out where ``own`` goes through a pair."""
        out: dict[str, float] = {}
        for c, x in own.items():
            for y in garble(c, chain) or "":
                out[y] = out.get(y, 0.0) + x
        return out

    @staticmethod
    def _foreign(c: str) -> float:
        o = ord(c)
        if 0xC0 <= o < 0x250 or c in "½¼¾°±×€©®™§²³µ\u00a0":
            return 3e-5
        if 0x400 <= o < 0x530:
            return 3e-6
        return 1e-6

    def codes(self, t: str) -> np.ndarray:
        x = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
        return np.where(x < 0x10000, x, 0xFFFF)

    def label(self, texts: list[str]) -> list[np.ndarray]:
        """The best state of every character of each text, by Viterbi.

        Where the most that a state can gain over the clean one, summed up from the last place at which that sum was
        nothing, never pays for entering it, no best path is in that state. Stretches of which that is so for every state
        are clean, exactly, without the recursion; the others are worked off side by side. States are taken together in
        few groups, each bounded by its best."""
        out = [np.zeros(len(t), np.int8) for t in texts]
        i, work = 0, []
        while i < len(texts):
            e, size = i, 0
            while e < len(texts) and (e == i or size + len(texts[e]) < BLOCK):
                size += len(texts[e]) + 1
                e += 1
            work += self._stretches(texts[i:e], out[i:e])
            i = e
        work.sort(key=lambda x: x[2] - x[1])
        k = 0
        while k < len(work):
            top = work[min(len(work), k + GROUP) - 1]
            group = work[k : k + max(1, min(GROUP, 2_000_000 // (top[2] - top[1])))]
            k += len(group)
            self._viterbi(group)
        return out

    def _stretches(self, texts: list[str], out: list[np.ndarray]) -> list[tuple]:
        """The stretches of some texts whose best path may leave the clean state."""
        # a line end before each text: the character before its first one, and a place that nothing runs across
        codes = self.codes("\n" + "\n".join(texts)).astype(np.int64)
        border = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        clean = self.clean_emissions(codes[None, :])[0]
        at = self.lookup[codes].astype(np.int64)
        pair = np.concatenate([[0], at[:-1] * len(self.table) + at[1:]])
        change = np.zeros(len(codes) + 1, np.int32)
        for most in self.most:
            gain = most[pair].astype(np.float64)
            gain += STAY - clean
            gain[border[:-1]] = -1e7
            total = np.cumsum(gain)
            run = total - np.minimum.accumulate(total)
            # a state's first character costs no staying
            high = np.flatnonzero(run >= STAY - ENTER)
            if not len(high):
                continue
            stop = np.append(np.flatnonzero(run <= 0), len(codes))
            k = np.unique(np.searchsorted(stop, high))
            np.add.at(change, stop[k - 1] + 1, 1)
            np.add.at(change, stop[k], -1)
        inside = np.cumsum(change[:-1]) > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
        work = []
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            t = int(np.searchsorted(border, a, "right")) - 1
            first = int(border[t]) + 1
            work.append((out[t], a, b, first, pair, clean, at))
        return work

    def _viterbi(self, group: list[tuple]) -> None:
        """Labels stretches (labels of the text, start, end, start of the text, character pairs, clean emissions,
        characters), the longest last."""
        size, n, s = group[-1][2] - group[-1][1], len(group), len(STATES)
        length = np.array([x[2] - x[1] for x in group])
        pair, plain, before = np.zeros((size, n), np.int64), np.zeros((size, n), np.float32), np.zeros((size, n), np.int64)
        for r, (_, a, b, _, p, c, at) in enumerate(group):
            pair[: b - a, r], plain[: b - a, r], before[: b - a, r] = p[a:b], c[a:b], at[a - 1 : b - 1]
        first = np.searchsorted(length, np.arange(size), "right")  # the stretches that go on to each place
        score = np.full((n, s), ENTER, np.float32)
        score[:, 0] = 0
        came = np.zeros((size, n, s), np.int8)
        own = np.arange(s, dtype=np.int8)
        for k in range(size):
            f = first[k]
            now = score[f:]
            if k:
                start = now[:, :1] + ENTER
                now[:, 1:] += STAY
                enter = start > now
                whole = now + self.endings[before[k, f:]]
                best = np.argmax(whole[:, 1:], axis=1) + 1
                leave = whole[np.arange(n - f), best] + (LEAVE - STAY)
                step = np.where(enter, np.int8(0), own)
                out0 = leave > now[:, 0]
                clean = np.where(out0, leave, now[:, 0])
                step[:, 0] = np.where(out0, best, 0)
                np.maximum(now, start, out=now)
                now[:, 0] = clean
                came[k, f:] = step
            seen = self.after[pair[k, f:]]
            seen[:, 0] = plain[k, f:]
            now += seen
        # inside a text a stretch ends clean
        for r, (label, a, b, first_at, _, _, at) in enumerate(group):
            if b < first_at + len(label):
                score[r, 1:] += LEAVE + self.endings[at[b - 1], 1:]
        state = np.argmax(score, axis=1)
        path = np.zeros((n, size), np.int8)
        for k in range(size - 1, -1, -1):
            f = first[k]
            path[f:, k] = state[f:]
            state[f:] = came[k, np.arange(f, n), state[f:]]
        for r, (label, a, b, first_at, *_) in enumerate(group):
            label[a - first_at : b - first_at] = path[r, : b - a]


def learn(rows: DataFrame, column: str):
    """The broadcast model of all texts in ``column``."""
    size = len(LETTERS + LATIN) + 1

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single, pairs, three = np.zeros(0x10000, np.int64), np.zeros(size * size, np.int64), np.zeros(3, np.int64)
        index = np.zeros(0x10000, np.int64)
        case = np.zeros(size, np.int8)
        for i, c in enumerate(LETTERS + LATIN):
            index[ord(c)] = i + 1
            case[i + 1] = 1 + c.isupper()
        for b in batches:
            t = "\n".join(x for x in b.column(0).to_pylist() if x)
            for a in range(0, len(t), 4_000_000):
                x = np.frombuffer(t[a : a + 4_000_000].encode("utf-32-le", "surrogatepass"), np.uint32)
                x = np.where(x < 0x10000, x, 0xFFFF)
                single += np.bincount(x, minlength=0x10000)
                y = index[x]
                pairs += np.bincount(y[:-1] * size + y[1:], minlength=size * size)
                k = case[y]
                three += np.bincount(k[2:][(k[:-2] == 2) & (k[1:-1] == 2)], minlength=3)
        for kind, v in ((0, single), (1, pairs), (2, three)):
            at = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)), pa.array(v[at])], ["kind", "k", "n"])

    got = rows.select(column).mapInArrow(go, "kind int, k int, n bigint").groupBy("kind", "k").agg(F.sum("n").alias("n")).toArrow()
    kind, k, n = (got[c].to_numpy() for c in ("kind", "k", "n"))
    single, pairs = np.zeros(0x10000, np.int64), np.zeros(size * size, np.int64)
    single[k[kind == 0]] = n[kind == 0]
    pairs[k[kind == 1]] = n[kind == 1]
    three = np.zeros(3)
    three[k[kind == 2]] = n[kind == 2]
    return rows.sparkSession.sparkContext.broadcast(Model(single, pairs.reshape(size, size), three))


# shifts of a span's ends outwards, the smallest first
BORDERS = sorted(((l, r) for l in range(-4, 3) for r in range(-4, 3)), key=lambda x: (abs(x[0]) + abs(x[1]), x))


def _core(t: str, a: int, b: int, state: str) -> tuple[int, int]:
    """A labelled stretch without the characters at its ends that the state's pair leaves as they are."""
    chain = ALL_PAIRS[state]
    while a < b and (ord(t[a]) < 128 or restore(t[a], chain) == t[a]):
        a += 1
    while b > a and (ord(t[b - 1]) < 128 or restore(t[b - 1], chain) == t[b - 1]):
        b -= 1
    return a, b


def spans(model: Model, texts: list[str]) -> list[list[tuple[int, int, str, str | None]]]:
    """Per text its garbled spans: (start, end, state, restored, or None where the inverse does not exist)."""
    plain, codes = [], []
    for t in texts:
        coded = "uni" in t or "afii" in t or "(cid:" in t
        codes.append([m.group() for m in GLYPH.finditer(t)] if coded else [])
        plain.append(GLYPH.sub(GLYPH_CHAR, t) if coded else t)
    out = []
    for t, path, glyphs in zip(plain, model.label(plain), codes, strict=True):
        found, shift, g = [], 0, iter(glyphs)
        border = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)] if path.any() or glyphs else []
        for a, b in zip(border, border[1:], strict=False):
            piece, state = t[a:b], STATES[path[a]]
            own = [next(g) for c in piece if c == GLYPH_CHAR]
            long = len(piece) + sum(map(len, own)) - len(own)
            if state == "glyph":
                it = iter(own)
                found.append((a + shift, a + shift + long, state, "".join((glyph_text(x := next(it)) or x) if c == GLYPH_CHAR else c for c in piece)))
            elif state != "clean" and not own:
                x, y = _core(t, a, b, state)
                if x < y:
                    # the border may have cut a character of several bytes, or taken a plain one in
                    for l, r in BORDERS:
                        if 0 <= x - l < y + r <= len(t) and any(ord(c) > 127 for c in t[x - l : y + r]) and (new := restore(t[x - l : y + r], ALL_PAIRS[state])) is not None:
                            found.append((x + shift - l, y + shift + r, state, new))
                            break
                    else:
                        found.append((x + shift, y + shift, state, None))
            shift += long - len(piece)
        out.append(found)
    return out


def _each(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    some = df.select(key, *columns)
    return spread(some, key).select(key, F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in columns))).alias("x")).select("x.field", key, "x.text").where("text IS NOT NULL AND text <> ''")


def _once(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``(fields, key, text)``: each different text of a row once, with the fields that hold it."""
    some = df.select(key, *columns)
    texts = F.array_distinct(F.array(*(F.col(c) for c in columns)))
    own = F.array_compact(F.array(*(F.when(F.col(c) == F.col("text"), F.lit(c)) for c in columns)))
    return spread(some, key).select(key, *columns, F.explode(texts).alias("text")).where("text IS NOT NULL AND text <> ''").select(own.alias("fields"), key, "text")


def labelled(df: DataFrame, key: str, columns: list[str], where: str = "true") -> DataFrame:
    """``(field, key, spans, restored)`` of every garbled value: its number of garbled spans and the restored text. The model
    is that of all rows; rows outside ``where`` are of no interest to the caller and not labelled."""
    model = learn(_each(df, key, columns), "text")
    rows = _once(df.where(where), key, columns)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            some = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            rows_out = []
            for (fields, k, t), got in zip(some, spans(model.value, [x[2] for x in some]), strict=True):
                if got:
                    new, last = [], 0
                    for a, e, _, r in got:
                        if a >= last:
                            new += [t[last:a], r if r is not None else t[a:e]]
                            last = e
                    rows_out += [(f, k, len(got), "".join(new) + t[last:]) for f in fields]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows_out], ty) for j, ty in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))], ["field", key, "spans", "restored"])

    return rows.mapInArrow(go, f"field string, `{key}` bigint, spans bigint, restored string")


FIELDS = ["markdown", "text_only"]


def found(df: DataFrame) -> DataFrame:
    """``(field, extract_id)`` of every value garbled in whole or in part."""
    return labelled(df, "extract_id", FIELDS).select("field", "extract_id").distinct()


def restored(df: DataFrame) -> DataFrame:
    """``(field, extract_id, text)``: every value, garbled spans restored."""
    good = labelled(df, "extract_id", FIELDS).select("field", "extract_id", F.col("restored"))
    every = df.select("extract_id", F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in FIELDS))).alias("x")).select("x.field", "extract_id", "x.text")
    return every.join(good, ["field", "extract_id"], "left").select("field", "extract_id", F.coalesce("restored", "text").alias("text"))
