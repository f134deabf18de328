"""Problem 6: sentence boundaries across languages and scripts.

A hidden-event n-gram model: after every word (in scripts without spaces: every character) there may stand a boundary
token. Counts over all texts give the n-grams around it:

* how often a word is the last, or the first, of a sentence; how often two words stand next to each other inside one;
* where a mark could close a sentence, the word before it, the mark and the kind of word after it. How often such a word
  with its mark is the last of its text, against how often ordinary words are, and what follows it otherwise, gives the
  probability of a boundary after it, by iteration;
* how many words sentences have: the boundary token's own history, which makes neighbouring events depend on each other;
* whole lines that recur, which are units without a mark.

A paragraph (and the break to the next row) is one sequence. Its hidden states are the number of words since the last
boundary, in one of two styles: punctuated, where a boundary without a mark is next to impossible, and unpunctuated, where
none has marks. Forward-backward over all gaps gives each its posterior; those above one half end a sentence. So a text
without any marks is cut by its words and lengths, and in ordinary text a mark after an abbreviation must fit its neighbours.

Inside matching quotation marks or brackets nothing ends, and what follows the closing one in lower case or after a dash
belongs to the same sentence. Headings and list items on a line of their own are units; other line ends are space.

Defined results: null or blank texts have no ends; a text is always cut whole; rows of a file loaded twice are cut alike.
"""

from __future__ import annotations

import gc
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sarqyt.llm import garbled
from sarqyt.session import cut, spread

# two dots and more, or a run of such marks, or of wide ones; a pattern that begins with a set is looked for quickly
MARK = re.compile(r"[.!?…。！？](?:(?<=\.)\.+|(?<=[.!?…])[.!?…]*|(?<=[。！？])[。！？]*)[»”\"’')\]）」』]*")
ITEM = re.compile(r"[ \t]*(?:#{1,6}[ \t]|[-–—•*‣·][ \t]|\d{1,3}[.)][ \t])")
PAIRS = {"«": "»", "“": "”", "(": ")", "[": "]", "（": "）", "「": "」", "『": "』", "„": "“"}
WIDE = "。！？"
KINDS = ["end", "low", "cap", "init", "num", "dash", "open", "other", "wide"]
KIND_AT = {k: i for i, k in enumerate(KINDS)}
WIDE_SCRIPT = "\u3040-\u30ff\u3400-\u9fff"
WIDE_LETTER = re.compile(f"[{WIDE_SCRIPT}]")
WIDE_TOKEN = re.compile(rf"[{WIDE_SCRIPT}](?:[^\w\s]+(?=\s|$))?|[^\s{WIDE_SCRIPT}]+")
LENGTHS, MEAN_LENGTH = 32, 16
# prior odds: that a text has no marks at its boundaries, that a boundary of a text with marks has none, that one of a
# text without has one; and how surely these marks alone close a sentence
PRIOR_BARE, BARE, MARKED = log(1e-3), log(1e-5), log(1e-3)
SURE = {"w": 0.99, "!": 0.97, "…": 0.97, "q": 0.5}
BREAK = "break"  # the source of the counts of marks at the end of a row that has a next one
CLOSE, OPEN = 0.05, 0.15  # of words too rare to be counted
RARE_CLOSE, RARE_OPEN = log(CLOSE / (1 - CLOSE)), log(OPEN / (1 - OPEN))
SHORT = 6
WORD = re.compile(r"[^\W_]+")


CLOSERS = "»”\"’')]）"


def left_type(before: str) -> str:
    """The word before a mark: itself if it is short, # for a number, I for an initial, w for any other, ? for none."""
    before = before.rstrip(CLOSERS)
    if before[-1:] in ("%", "‰", "°"):
        return before[-1]
    i = len(before)
    while i and (before[i - 1].isalnum() or before[i - 1] in ".-"):
        i -= 1
    w = before[i:].lstrip(".-")
    if not w or not w[-1].isalnum():
        return "?"
    parts = w.split(".")
    k = len(parts) - 1
    while k and parts[k - 1].isalpha() and len(parts[k - 1]) <= 3:
        k -= 1
    w = ".".join(parts[k:])
    last = w.rsplit("-", 1)[-1]
    if last.isdigit():
        return "#"
    if len(last) == 1 and last.isupper():
        return "I"
    if "." in w:
        return w.lower()
    if len(last) <= SHORT:
        return ("-" if "-" in w and w[0].isdigit() else "") + last.lower()
    return "w"


def right_kind(after: str) -> str:
    s = after.lstrip(" \t\n\u00a0")
    if not s:
        return "end"
    c = s[0]
    if c in "–—-" and s[1:2] in (" ", "\u00a0"):
        return "dash"
    if c in "«“\"(„[":
        k = right_kind(s[1:])
        return "low" if k == "low" and c in "([" else "open"
    if c.isdigit():
        return "num"
    if c.isupper():
        return "init" if re.match(r"\w\.(?:\s|\w\.)", s) else "cap"
    if c.islower():
        return "low"
    if WIDE_LETTER.match(c):
        return "wide"
    return "cap" if c.isalpha() else "other"


_FENCES = "«»“”„()（）「」『』\\[\\]\""
FENCE = re.compile(f"[{_FENCES}]")
PLAIN_PAIR = re.compile("|".join(f"{re.escape(a)}[^{_FENCES}]*{re.escape(b)}" for a, b in [*PAIRS.items(), ('"', '"')]))


def shielded(p: str) -> list[tuple[int, int]]:
    """The stretches (start, end) inside matching quotation marks or brackets; the closing one is outside."""
    fences = len(FENCE.findall(p))
    if not fences:
        return []
    # mostly each closes before another opens
    simple = [m.span() for m in PLAIN_PAIR.finditer(p)]
    if 2 * len(simple) == fences:
        return [(a, b - 1) for a, b in simple]
    out: list[tuple[int, int]] = []
    stack: list[tuple[str, int]] = []
    straight: list[int] = []
    for m in FENCE.finditer(p):
        c, i = m[0], m.start()
        if c == '"':
            straight.append(i)
        elif c in PAIRS:
            stack.append((PAIRS[c], i))
        elif any(s[0] == c for s in stack):
            while stack[-1][0] != c:
                stack.pop()
            out.append((stack.pop()[1], i))
    if len(straight) % 2 == 0:
        out += zip(straight[::2], straight[1::2], strict=True)
    return out


def pieces(t: str) -> list[tuple[int, int, bool]]:
    """Paragraphs, and lines that are units of their own: (start, end, whether a line of its own)."""
    if "\n" not in t:
        return [(0, len(t), bool(ITEM.match(t)))] if t.strip() else []
    out: list[tuple[int, int, bool]] = []
    start = None
    at = 0
    for line in t.split("\n"):
        end = at + len(line)
        blank, item = not line.strip(), bool(ITEM.match(line))
        if blank or item:
            if start is not None:
                out.append((start, at - 1, False))
                start = None
            if item and not blank:
                out.append((at, end, True))
        elif start is None:
            start = at
        at = end + 1
    if start is not None:
        out.append((start, len(t), False))
    return out


ENDERS = "»”\"’')]）」』"
NEXT = re.compile(r"[^ \t\n\u00a0]")


def _outermost(fences: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that lie in no other."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b in sorted(fences):
        if not ends or a >= ends[-1]:
            starts.append(a)
            ends.append(b)
        else:
            ends[-1] = max(ends[-1], b)
    return starts, ends


def candidates(p: str, after: str, wide: bool | None = None) -> list[tuple[int, str, str, str, str]]:
    """(end, left, mark, right, next word) of each place where a mark may end a sentence; ``after`` follows the piece. The
    next word is given after exclamation and question marks."""
    fences = shielded(p)
    starts, ends = _outermost(fences) if fences else ([], [])

    def cover(i: int) -> bool:
        k = bisect_right(starts, i) - 1
        return k >= 0 and i < ends[k]

    out = []
    if wide is None:
        wide = bool(WIDE_LETTER.search(p))
    for m in MARK.finditer(p):
        first, end = m.span()
        whole = m[0]
        core = whole if whole == "." else whole.rstrip(ENDERS)
        if fences and (cover(end - 1) or (cover(first) and end - first == len(core))):
            continue
        x = NEXT.search(p, end)
        # the kind of what follows shows in its first letters
        rest, at = (p[x.start() : x.start() + 16], x.start()) if x else (after, end)
        if x and at == end and core[0] not in WIDE:
            # no space: an end only before a capital, and not inside an abbreviation, address or number
            before = p[max(0, first - 2) : first]
            if not rest[0].isupper() or len(core) == 1 and core == "." and not (len(before) == 2 and (before[1].islower() or before[1] in "%»)”") and not before[0] == "."):
                if not (rest[0] in "«“(" and core != "."):
                    continue
        mark = "." if core == "." else "w" if core[0] in WIDE else "…" if core[0] in ".…" else "!"
        if len(core) < end - first and cover(first):
            mark += "q"  # the mark was inside the quotation that closes here
        word = WORD.search(p, at) if x and mark[0] == "!" else WORD.search(after) if mark[0] == "!" else None
        out.append((end, _left(p, first, wide), mark, right_kind(rest), word[0].lower() if word else ""))
    return out


_TYPES: dict[str, str] = {}


def _left(p: str, end: int, wide) -> str:
    """The type of what stands before a mark, up to the last space (in scripts without spaces, the last such letter)."""
    i = end
    if wide:
        while i and not p[i - 1].isspace() and not WIDE_LETTER.match(p[i - 1]):
            i -= 1
        return left_type(p[i:end])
    step = 32
    while True:
        got = p[max(0, end - step) : end].rsplit(None, 1)
        word = got[-1] if got and not p[end - 1 : end].isspace() else ""
        if len(word) < step or step >= end:
            break
        step *= 4
    t = _TYPES.get(word)
    if t is None:
        if len(_TYPES) > 100_000:
            _TYPES.clear()
        t = _TYPES[word] = left_type(word)
    return t


def line_key(t: str) -> str:
    return "".join(filter(str.isalpha, t.lower()))


def closed(t: str) -> bool:
    """Whether a text ends in a closing mark, whatever quotation marks and brackets follow it."""
    return t.rstrip().rstrip(ENDERS)[-1:] in (".", "!", "?", "…", "。", "！", "？")


NUMBER = "0"


class Chunks:
    """What stands between spaces, as numbers: the hash of its first and last word, its kind, and how many quotation marks
    or brackets it opens more than it closes. The memory of a worker is bounded: it starts anew when it is full."""

    def __init__(self, model: Model | None = None, most: int = 300_000) -> None:
        self.model, self.most = model, most
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.first: list[str] = []
        self.last: list[str] = []
        size = 1024
        self.hash = np.zeros((size, 2), np.uint64)
        self.kind, self.net = np.zeros(size, np.int8), np.zeros(size, np.int16)
        self.odds = np.zeros((size, 2), np.float32)

    def add(self, c: str) -> int:
        # numbers are one word
        if c[0].isdigit() and c[-1].isdigit() and c != NUMBER and not any(map(str.isalpha, c)):
            i = self.ids[c] = self.ids[NUMBER] if NUMBER in self.ids else self.add(NUMBER)
            return i
        i = self.ids[c] = len(self.first)
        if i == len(self.kind):
            self.hash, self.odds = (np.concatenate([x, np.zeros_like(x)]) for x in (self.hash, self.odds))
            self.kind, self.net = (np.concatenate([x, np.zeros_like(x)]) for x in (self.kind, self.net))
        w = WORD.findall(c.lower())
        first, last = (w[0], w[-1]) if w else ("", "")
        self.first.append(first)
        self.last.append(last)
        h = xxhash.xxh3_64_intdigest(first)
        self.hash[i, 0] = h
        self.hash[i, 1] = h if first == last else xxhash.xxh3_64_intdigest(last)
        if FENCE.search(c):
            self.net[i] = sum(x in PAIRS for x in c) - sum(x in CLOSING for x in c)
        if self.model:
            self.odds[i, 0] = self.model.opening(first)
            self.odds[i, 1] = self.model.closing(last)
        else:
            self.kind[i] = KIND_AT[right_kind(c + " ")]
        return i

    def sequence(self, p: str, c: list[tuple[int, str, str, str, str]], wide: bool) -> tuple[list[int], list[int]]:
        """The chunks of a piece as numbers, and after which of them its candidates stand."""
        ids, at, prev = [], [], 0
        get = self.ids.get
        for end in [x[0] for x in c] + [len(p)] if not c or c[-1][0] < len(p) else [x[0] for x in c]:
            seg = p[prev:end] if c else p
            chunks = WIDE_TOKEN.findall(seg) if wide else seg.split()
            own = list(map(get, chunks))
            if None in own:
                own = [self.ids[x] if x in self.ids else self.add(x) for x in chunks]
            ids += own
            at.append(len(ids) - 1)
            prev = end
        return ids, at[: len(c)]


CLOSING = set(PAIRS.values()) - set(PAIRS)


def token_ends(p: str, c: list[tuple[int, str, str, str, str]]) -> list[int]:
    """Where the chunks of ``Chunks.sequence`` end."""
    token = WIDE_TOKEN if WIDE_LETTER.search(p) else re.compile(r"\S+")
    out, prev = [], 0
    for end in [x[0] for x in c] + [len(p)]:
        out += [prev + m.end() for m in token.finditer(p[prev:end])]
        prev = end
    return out


@contextmanager
def _uncollected() -> Iterator[None]:
    """No search for cycles among the many small objects made inside: they form none, and go when they are done with."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def _logit(x: float) -> float:
    x = min(max(x, 0.001), 0.999)
    return log(x / (1 - x))


def posteriors(sequences: list[tuple[np.ndarray, np.ndarray]], hazard: np.ndarray) -> list[np.ndarray]:
    """For sequences of evidence (log of how much likelier what is seen at each gap is after a boundary than without one; in
    the punctuated style and in the other), the posterior of a boundary at each gap, by forward-backward. States are the
    number of words since the last boundary; ``hazard`` is the chance of a boundary after so many."""
    out: list[np.ndarray] = [np.empty(0)] * len(sequences)
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i][0]))
    k = 0
    while k < len(order):
        size = len(sequences[order[k]][0])
        group = order[k : k + max(1, min(1024, 200_000 // max(1, size)))]
        k += len(group)
        n, length = len(group), np.array([len(sequences[g][0]) for g in group])
        see = np.zeros((size, n, 2), np.float32)
        for r, g in enumerate(group):
            see[: length[r], r, 0], see[: length[r], r, 1] = sequences[g]
        see = np.exp(np.clip(see, -30, 30))
        live = np.searchsorted(-length, -np.arange(size), "left")  # rows with a gap at each place; the longest come first
        state = np.zeros((n, 2, len(hazard)), np.float32)
        state[:, 0, 0], state[:, 1, 0] = 1, np.exp(PRIOR_BARE)
        cut_here, scale = np.zeros((size, n, 2), np.float32), np.ones((size, n), np.float32)
        for i in range(size):
            m = live[i]
            a = state[:m]
            ends = a * hazard
            mass = ends.sum(axis=2) * see[i, :m]
            a -= ends
            rest = a[:, :, -1].copy()
            a[:, :, 1:] = a[:, :, :-1]
            a[:, :, -1] += rest
            a[:, :, 0] = mass
            z = a.sum(axis=(1, 2))
            a /= z[:, None, None]
            cut_here[i, :m], scale[i, :m] = mass / z[:, None], z
        back = np.ones((n, 2, len(hazard)), np.float32)
        post = np.zeros((size, n), np.float32)
        for i in range(size - 1, -1, -1):
            m = live[i]
            b = back[:m]
            post[i, :m] = (cut_here[i, :m] * b[:, :, 0]).sum(axis=1)
            new = (b[:, :, :1] * see[i, :m, :, None]) * hazard
            new[:, :, :-1] += b[:, :, 1:] * (1 - hazard[:-1])
            new[:, :, -1] += b[:, :, -1] * (1 - hazard[-1])
            back[:m] = new / scale[i, :m, None, None]
        for r, g in enumerate(group):
            out[g] = post[: length[r], r]
    return out


class Model:
    """Boundary events given their neighbours. ``types`` counts (source, left, mark, right) over all texts; ``starts`` and
    ``inside`` the kinds of words that open sentences and that stand inside; ``opens`` and ``closes`` how often a word does;
    ``lines`` the lines without a mark that occur again and again, which are units of their own; ``lengths`` the words of
    sentences; ``pairs`` hashes of two neighbouring words and how much likelier the second is after the first."""

    def __init__(self, types: dict[tuple[str, str, str, str], int], starts: dict[str, int], opens: dict[str, float], closes: dict[str, float], lines: set[str], inside: dict[str, int] | None = None, lengths: dict[int, int] | None = None, pairs: tuple[np.ndarray, np.ndarray] | None = None) -> None:
        self.first = {w: _logit(x) for w, x in opens.items()}
        self.last = {w: _logit(x) for w, x in closes.items()}
        self.lines, self.memo = lines, {}
        total = sum(starts.values()) + 100
        first = np.array([0.0, 0.3, 60, 3, 10, 0.3, 20, 2, 5])
        self.after = (np.array([starts.get(x, 0) for x in KINDS], float) + first) / total
        inner = np.array([(inside or {}).get(x, 0) for x in KINDS], float)
        usual = np.array([0.001, 0.75, 0.03, 0.04, 0.12, 0.03, 0.02, 0.01, 0.01])
        # what follows a mark inside a sentence: as inside sentences in general, but not too surely
        self.other = (inner / max(1.0, inner.sum()) * 100 + usual * 100) / 200 if inner.sum() else usual
        # sentences of two words and more are alike before any were seen
        h = np.where(np.arange(LENGTHS) > 0, 1.0, 0.1)
        for k, n in (lengths or {}).items():
            h[min(k, LENGTHS) - 1] += n
        h = np.convolve(h, [0.1, 0.2, 0.4, 0.2, 0.1], "same")
        # lengths are worth half their evidence: they say less than the words do
        h = np.sqrt(h / np.cumsum(h[::-1])[::-1])
        self.hazard = np.minimum(h * (np.sqrt(1 / MEAN_LENGTH)), 0.3).astype(np.float32)
        self.rate = _logit(1 / MEAN_LENGTH)
        self.pairs = pairs or (np.empty(0, np.uint64), np.empty(0, np.float32))
        # the share of boundaries that are the last of their text, per source, from the words that are no abbreviations
        plain: dict[str, list[float]] = {}
        by: dict[tuple[str, str], list[tuple[str, str, int]]] = {}
        breaks: dict[tuple[str, str], dict[str, int]] = {}
        for (src, l, m, r), n in types.items():
            if src == BREAK:
                breaks.setdefault((l, m), {})[r] = n
                continue
            by.setdefault((l, m), []).append((src, r, n))
            if l == "w" and m == ".":
                x = plain.setdefault(src, [0.5, 1.0])
                x[1] += n
                x[0] += n * (r == "end")
        last = {src: x[0] / x[1] for src, x in plain.items()}
        self.theta: dict[tuple[str, str], float] = {}
        for key, rows in by.items():
            ends = sum(n for _, r, n in rows if r == "end")
            expected = sum(n * last.get(src, 0.3) for src, _, n in rows)
            # iterate: what is certainly inside a sentence does not count as a chance to end
            t = min(1.0, (ends + 0.02) / max(expected, 0.02))
            for _ in range(5):
                inner_n = sum(n * (1 - self._post(t, r)) for _, r, n in rows if r != "end")
                every = sum(n for *_, n in rows)
                t = 0.5 * t + 0.5 * (every - inner_n) / max(every, 1e-9) if t > 0.2 else t
            self.theta[key] = float(np.clip(t, 0.003, 0.997))

        self.broken = {(l, m, r): (n, sum(x.values()) * float(self.after[KINDS.index(r)])) for (l, m), x in breaks.items() for r, n in x.items()}

    def _post(self, t: float, right: str) -> float:
        i = KIND_AT[right]
        if right == "wide":
            return t
        a, o = t * self.after[i], (1 - t) * self.other[i]
        return a / (a + o) if a + o else 0.0

    def opening(self, word: str) -> float:
        return self.first.get(NUMBER if word.isdigit() else word, RARE_OPEN)

    def closing(self, word: str) -> float:
        return RARE_CLOSE if word[-1:].isdigit() else self.last.get(word, RARE_CLOSE)

    def marked(self, left: str, mark: str, right: str, word: str, at_break: bool = False) -> float:
        """The evidence for a boundary at a mark, from its own neighbours."""
        key = left, mark, right, at_break
        e = self.memo.get(key)
        if e is None:
            if len(self.memo) > 100_000:
                self.memo.clear()
            e = self.memo[key] = self._marked(*key)
        if right == "low" and mark == "!" and word in self.first:
            e += max(0.0, self.opening(word) + 3.0)
        return e

    def _marked(self, left: str, mark: str, right: str, at_break: bool) -> float:
        base = mark.rstrip("q")
        theta = SURE["q"] if mark.endswith("q") else SURE[base] if base in SURE else self.theta.get((left, mark), self.theta.get(("w", mark), 0.97))
        e = _logit(theta) - self.rate
        if right == "end":
            return 30.0
        if right == "wide":
            # letters without case say nothing; a quotation that is followed by more words of the sentence goes on
            return e - 6 if mark == "wq" else e
        i = KIND_AT[right]
        e += log(self.after[i] / self.other[i])
        n, same = self.broken.get((left, mark, right), (0, 0.0))
        if at_break and n >= 20 and n > 2 * same:
            # a row that ends in a mark and the kind of word the next one begins with: what is far more than sentences
            # would begin with stands inside, such as the rest of a number
            e = min(e, log(max(same, 0.5) / max(n - same, 0.5)) - self.rate)
        return e

    def breaks(self, left: str, right: str) -> float:
        """The evidence for a boundary between a row without a closing mark and the row that follows it."""
        if line_key(left) in self.lines or line_key(right) in self.lines:
            return 30.0
        if left.rstrip()[-1:] in ",;:–—-«“(/":
            return -30.0
        a, b = WORD.findall(left), WORD.match(right.lstrip("«“(\"' "))
        if not a or not b or right == "A":
            return 30.0
        # a break is as likely as not the end of a sentence
        return self.closing(a[-1].lower()) + self.opening(b[0].lower()) - self.rate

    def _evidence(self, table: Chunks, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The evidence at every gap without a mark of the pieces that begin at ``starts`` in ``ids``."""
        nxt = np.append(ids[1:], ids[-1:])
        e = table.odds[ids, 1] + table.odds[nxt, 0] - np.float32(self.rate)
        if len(self.pairs[0]):
            h = _pair(table.hash[ids, 1], table.hash[nxt, 0])
            at = np.minimum(np.searchsorted(self.pairs[0], h), len(self.pairs[0]) - 1)
            e -= np.where(self.pairs[0][at] == h, self.pairs[1][at], np.float32(0))
        e = np.clip(e, -8, 8)
        # nothing ends inside quotation marks or brackets that match
        depth = np.cumsum(table.net[ids].astype(np.int64))
        before = np.concatenate([[0], depth])[starts]
        piece = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ids))))
        depth -= before[piece]
        sound = (np.minimum.reduceat(depth, starts) >= 0) & (depth[np.append(starts[1:], len(ids)) - 1] == 0)
        e[(depth > 0) & sound[piece]] = -30
        return e

    def ends_of(self, texts: list[str | None], nexts: list[str | None], documents: list[bool], table: Chunks | None = None) -> list[list[int]]:
        """All sentence ends of each text. In a document the text's end is an end; a row may go on in the next one."""
        with _uncollected():
            return self._ends_of(texts, nexts, documents, table)

    def _ends_of(self, texts: list[str | None], nexts: list[str | None], documents: list[bool], table: Chunks | None) -> list[list[int]]:
        table = table or Chunks(self)
        if len(table.first) > table.most:
            table.clear()
        out: list[list[int]] = [[] for _ in texts]
        ids: list[int] = []
        starts: list[int] = []
        todo: list[tuple[int, int, str, list]] = []
        where: dict[int, int] = {}  # the gaps at a mark or at the end of a piece, and the places in the text
        marked: list[tuple[int, float]] = []
        final: list[tuple[int, float]] = []
        for k, (t, nxt, document) in enumerate(zip(texts, nexts, documents, strict=True)):
            if not t or not t.strip():
                continue
            parts = pieces(t)
            for j, (a, b, line) in enumerate(parts):
                p = t[a:b].rstrip()
                last = j == len(parts) - 1
                follow = (nxt or "") if last and not document else ""
                if line:
                    if not (follow and not closed(p) and not ITEM.match(follow) and self.breaks(p, follow) < self.rate * -1):
                        out[k].append(a + len(p))
                    continue
                if follow and not follow[0].isupper() and (ITEM.match(follow) or line_key(follow) in self.lines):
                    follow = "A"  # a line of its own starts anew, however it is written
                wide = bool(WIDE_LETTER.search(p))
                c = candidates(p, follow, wide)
                own, at = table.sequence(p, c, wide)
                if not own:
                    out[k].append(a + len(p))
                    continue
                base = len(ids)
                starts.append(base)
                for i, x in zip(at, c, strict=True):
                    where[base + i] = a + x[0]
                    marked.append((base + i, self.marked(*x[1:], bool(follow) and x[0] == len(p))))
                ids += own
                where[len(ids) - 1] = a + len(p)
                if not follow.strip():
                    final.append((len(ids) - 1, 30.0))
                elif not closed(p):
                    final.append((len(ids) - 1, self.breaks(p, follow)))
                elif not c or c[-1][0] < len(p):
                    final.append((len(ids) - 1, 30.0))
                todo.append((k, a, p, c))
        if ids:
            flat, begin = np.array(ids, np.int64), np.array(starts, np.int64)
            bare = self._evidence(table, flat, begin)
            usual = bare + np.float32(BARE)
            for i, e in marked:
                usual[i], bare[i] = e, e + MARKED
            for i, e in final:
                usual[i] = bare[i] = e
            stop = np.append(begin[1:], len(flat))
            post = np.concatenate(posteriors([(usual[x:y], bare[x:y]) for x, y in zip(begin.tolist(), stop.tolist(), strict=True)], self.hazard))
            hits = np.flatnonzero(post > 0.5)
            places: dict[int, list[int]] = {}
            for i, j in zip(hits.tolist(), (np.searchsorted(begin, hits, "right") - 1).tolist(), strict=True):
                k, a, p, c = todo[j]
                end = where.get(i)
                if end is None:
                    if j not in places:
                        places[j] = token_ends(p, c)
                    end = a + places[j][i - starts[j]]
                out[k].append(end)
        return [sorted(set(x)) if len(x) > 1 else x for x in out]

    def ends(self, t: str | None, nxt: str | None = None, document: bool = True) -> list[int]:
        return self.ends_of([t], [nxt], [document])[0]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ b
        return h ^ (h >> np.uint64(31))


COUNTS = pa.schema([("kind", pa.string()), ("k", pa.string()), ("h", pa.int64()), ("g", pa.int64()), ("n", pa.int64()), ("c", pa.int64())])
RARE = 100_000
STRETCH = 4096


def _learn(rows: DataFrame) -> Model:
    """From rows (field, text, nxt): the counts of all n-grams around the hidden events."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Chunks()
        types: Counter = Counter()
        starts: Counter = Counter()
        lines: Counter = Counter()
        inside, lengths = np.zeros(len(KINDS), np.int64), np.zeros(LENGTHS + 1, np.int64)
        opens: Counter = Counter()
        closes: Counter = Counter()
        every: Counter = Counter()
        by_chunk = np.zeros((3, 1024), np.int64)  # how often each chunk stands anywhere, first and last

        def to_words() -> None:
            """Counts of chunks become those of their words."""
            for at, counters in enumerate((((every, "f"), (every, "l")), ((opens, "f"),), ((closes, "l"),))):
                some = np.flatnonzero(by_chunk[at])
                for counter, side in counters:
                    word = table.first if side == "f" else table.last
                    for i, k in zip(some.tolist(), by_chunk[at, some].tolist(), strict=True):
                        counter[side, word[i]] += k
            by_chunk[:] = 0

        def count(b: pa.RecordBatch) -> pa.RecordBatch | None:
            """Counts a batch; its pairs of neighbours are returned."""
            nonlocal by_chunk, inside
            ids: list[int] = []
            no_gap: list[int] = []  # gaps with a mark, and the ends of pieces
            first: list[int] = []
            last: list[int] = []
            for field, t, nxt in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for a, e, line in pieces(t or ""):
                    p = t[a:e]
                    wide = bool(WIDE_LETTER.search(p))
                    c = [] if line else candidates(p, "", wide)
                    own, at = table.sequence(p, c, wide)
                    if not own:
                        continue
                    base, begin = len(ids), 0
                    ids += own
                    no_gap += [base + i for i in at]
                    no_gap.append(len(ids) - 1)
                    first.append(own[0])
                    last.append(own[-1])
                    if line:
                        continue
                    starts[right_kind(p)] += 1
                    for i, x in zip(at, c, strict=True):
                        types[field, x[1], x[2], x[3]] += 1
                        if x[2] == "!" and x[3] in ("cap", "init", "num", "open"):
                            starts[x[3]] += 1
                        # surely a boundary: a word longer than abbreviations are, a mark, a capital
                        if x[3] in ("cap", "end", "wide") and (x[2] in ("!", "w") or (x[1] == "w" or len(x[1]) > 4 and x[1].isalpha()) and x[2] == "."):
                            lengths[min(i + 1 - begin, LENGTHS)] += 1
                            begin = i + 1
                            if x[3] != "end":
                                last.append(own[i])
                                first += own[i + 1 : i + 2]
                    if nxt and nxt.strip() and c and x[3] == "end" and e == len(t):
                        types[BREAK, x[1], x[2], right_kind(nxt)] += 1
                if t and field == "text" and not closed(t):
                    lines[line_key(t)] += 1
            if not ids:
                return None
            x = np.array(ids, np.int64)
            gap = np.ones(len(x), bool)
            gap[no_gap] = False
            at = np.flatnonzero(gap)
            inside += np.bincount(table.kind[x[at + 1]], minlength=len(KINDS))
            if by_chunk.shape[1] < len(table.kind):
                by_chunk = np.concatenate([by_chunk, np.zeros((3, len(table.kind) - by_chunk.shape[1]), np.int64)], axis=1)
            for row, got in zip(by_chunk, (ids, first, last), strict=True):
                row += np.bincount(np.array(got, np.int64), minlength=len(row))
            left, right = table.hash[x[at], 1], table.hash[x[at + 1], 0]
            _, one, n = np.unique(_pair(left, right), return_index=True, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(["p"] * len(one), pa.string()), pa.nulls(len(one), pa.string()), pa.array(left[one].view(np.int64)), pa.array(right[one].view(np.int64)), pa.array(n), pa.array(np.zeros(len(one), np.int64))], schema=COUNTS)

        for b in batches:
            with _uncollected():
                pairs = count(b)
            if pairs is not None:
                yield pairs
            if len(table.first) > table.most:
                to_words()
                table.clear()
        to_words()
        flat = [("t", "\t".join(k), n, 0) for k, n in types.items()] + [("s", k, n, 0) for k, n in starts.items()] + [("r", k, n, 0) for k, n in lines.items() if k]
        flat += [("i", k, n, 0) for k, n in zip(KINDS, inside.tolist(), strict=True)] + [("n", str(k), n, 0) for k, n in enumerate(lengths.tolist()) if n]
        flat += [(side, w, n, (opens if side == "f" else closes)[side, w]) for (side, w), n in every.items()]
        for i in range(0, len(flat), 50_000):
            part = flat[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.string()), pa.array([r[1] for r in part], pa.string()), pa.nulls(len(part), pa.int64()), pa.nulls(len(part), pa.int64()), pa.array([r[2] for r in part], pa.int64()), pa.array([r[3] for r in part], pa.int64())], schema=COUNTS)

    got = cut(rows.select("field", "text", "nxt").mapInArrow(go, "kind string, k string, h bigint, g bigint, n bigint, c bigint").groupBy("kind", "k", "h", "g").agg(F.sum("n").alias("n"), F.sum("c").alias("c")))
    whole = {r["kind"]: r["n"] for r in got.groupBy("kind").agg(F.sum("n").alias("n")).toArrow().to_pylist()}
    # what is rarer than one in 100,000 of its kind shares one default, so at most 100,000 rows of a kind come to the driver
    need = F.create_map(*(x for k, n in whole.items() for x in (F.lit(k), F.lit(max(1, n // RARE)))))[F.col("kind")] if whole else F.lit(1)
    small = got.where((F.col("n") >= need) & (F.col("kind").isin("t", "s", "i", "n") | (F.col("n") >= 3))).toArrow()
    of: dict[str, list[tuple]] = {k: [] for k in "tsrinflp"}
    for r in zip(*(small[c].to_pylist() for c in ("kind", "k", "h", "g", "n", "c")), strict=True):
        of[r[0]].append(r[1:])
    return Model(
        {tuple(k.split("\t")): n for k, _, _, n, _ in of["t"]},
        {k: n for k, _, _, n, _ in of["s"]},
        {k: (c + 2 * OPEN) / (n + 2) for k, _, _, n, c in of["f"]},
        {k: (c + 2 * CLOSE) / (n + 2) for k, _, _, n, c in of["l"]},
        {k for k, *_ in of["r"]},
        {k: n for k, _, _, n, _ in of["i"]},
        {int(k): n for k, _, _, n, _ in of["n"]} or None,
        _lifts(of, whole.get("p", 1)),
    )


def _lifts(of: dict[str, list[tuple]], total: int) -> tuple[np.ndarray, np.ndarray]:
    """Per counted pair of neighbours the log of how much likelier the second word is after the first than anywhere."""
    count = {side: {xxhash.xxh3_64_intdigest(k): n for k, _, _, n, _ in of[side]} for side in "fl"}
    rows = [(h % 2**64, g % 2**64, n) for _, h, g, n, _ in of["p"]]
    rows = [(h, g, np.log(n * max(1, total) / (count["l"][h] * count["f"][g]))) for h, g, n in rows if h in count["l"] and g in count["f"]]
    key = _pair(np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows], np.uint64))
    o = np.argsort(key)
    return key[o], np.clip(np.array([r[2] for r in rows], np.float32)[o], -3, 8)


def texts(extractions: DataFrame, sentences: DataFrame, every: bool = False) -> DataFrame:
    """``(field, rec_id, text, nxt)`` of what is to be cut; with ``every`` also the extractions that p6_found leaves out."""
    one = extractions.where("text_only IS NOT NULL")
    if not every:
        clean = "success AND method = 'pypdf'"
        bad = cut(garbled.labelled(extractions, "extract_id", garbled.FIELDS, where=clean).select("extract_id").distinct())
        one = one.where(clean).join(bad, "extract_id", "left_anti")
    one = one.select(F.lit("text_only").alias("field"), F.col("extract_id").alias("rec_id"), F.col("text_only").alias("text"), F.lit(None).cast("string").alias("nxt"))
    return spread(one, "rec_id").unionByName(_with_next(sentences.where("text IS NOT NULL")))


def _with_next(rows: DataFrame) -> DataFrame:
    """The sentence rows, each with the text at the next place of its file (not the copy of its own place). A file is worked
    off in stretches of ``STRETCH`` places, so that one file of any size is no single task; the last row of a stretch
    goes on with the first of the next."""
    out = (F.lit("text").alias("field"), F.col("sent_id").alias("rec_id"), "text")
    placed = F.col("source_file").isNotNull() & F.col("sentence_idx").isNotNull()
    part = ["collection", "source_file", "stretch"]
    known = rows.where(placed).withColumns({"collection": F.coalesce("collection", F.lit("\x00")), "stretch": F.floor(F.col("sentence_idx") / STRETCH)})
    # downwards, so that the frame only grows
    down = Window.partitionBy(*part).orderBy(F.col("sentence_idx").desc()).rangeBetween(Window.unboundedPreceding, -1)
    own = known.select(*part, "sent_id", "text", F.last("text").over(down).alias("own"))
    heads = known.groupBy(*part).agg(F.min_by("text", F.struct("sentence_idx", "sent_id")).alias("head"))
    heads = heads.withColumn("beyond", F.lead("head").over(Window.partitionBy(*part[:2]).orderBy("stretch"))).where("beyond IS NOT NULL").drop("head")
    near = own.join(heads, part, "left").select(*out, F.coalesce("own", "beyond").alias("nxt"))
    return near.unionByName(rows.where(~placed).select(*out, F.lit(None).cast("string").alias("nxt")))


def _cut_up(table: Chunks, b: pa.RecordBatch) -> Iterator[tuple[str, int, str, list[int]]]:
    """(field, rec_id, text, ends) of the rows of a batch of (field, rec_id, text, nxt)."""
    field, rid, text, nxt = (c.to_pylist() for c in b.columns)
    return zip(field, rid, text, table.model.ends_of(text, nxt, [f == "text_only" for f in field], table), strict=True)


def found(extractions: DataFrame, sentences: DataFrame) -> DataFrame:
    """``(field, rec_id, end_pos)``: every sentence end."""
    rows = cut(texts(extractions, sentences))  # read twice: to count, and to cut
    model = rows.sparkSession.sparkContext.broadcast(_learn(rows))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Chunks(model.value)
        for b in batches:
            field, rid, end = [], [], []
            for f, r, _, e in _cut_up(table, b):
                field += [f] * len(e)
                rid += [r] * len(e)
                end += e
            yield pa.RecordBatch.from_arrays([pa.array(field, pa.string()), pa.array(rid, pa.int64()), pa.array(end, pa.int32())], ["field", "rec_id", "end_pos"])

    return rows.select("field", "rec_id", "text", "nxt").mapInArrow(go, "field string, rec_id bigint, end_pos int").distinct()


def parts(t: str, ends: list[int]) -> list[str]:
    """A text cut at its ends; what follows the last one (a sentence that the next row goes on with) is a part too."""
    got = [t[a:b].strip(" ") for a, b in zip([0, *ends], ends, strict=False)]
    rest = t[ends[-1] if ends else 0 :]
    return [*got, rest.strip(" ")] if rest.strip() else got


def units(extractions: DataFrame, sentences: DataFrame) -> DataFrame:
    """``(field, rec_id, unit, text)``: the sentence units of every value. They cover the whole text, however it was
    extracted; blank texts have none. The counts are those of ``found``."""
    model = extractions.sparkSession.sparkContext.broadcast(_learn(texts(extractions, sentences)))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Chunks(model.value)
        for b in batches:
            field, rid, unit, text = [], [], [], []
            for f, r, t, e in _cut_up(table, b):
                got = parts(t, e)
                field += [f] * len(got)
                rid += [r] * len(got)
                unit += range(1, len(got) + 1)
                text += got
            yield pa.RecordBatch.from_arrays([pa.array(field, pa.string()), pa.array(rid, pa.int64()), pa.array(unit, pa.int64()), pa.array(text, pa.string())], ["field", "rec_id", "unit", "text"])

    return texts(extractions, sentences, every=True).select("field", "rec_id", "text", "nxt").mapInArrow(go, "field string, rec_id bigint, unit bigint, text string")
