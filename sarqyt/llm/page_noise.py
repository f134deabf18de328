"""Problem 1: traces of scanned pages (words broken by line ends, misread letters, running headers, page numbers).

1. All words of all texts are counted per language, and the distinct texts they are in (partial counts per Arrow batch
   first).
2. The words seen often are the vocabulary, kept as tries (one of the words, one of the words backwards). For every
   counted word a Levenshtein automaton is intersected with the trie: it accepts exactly the words within one edit of any
   kind, or within two known misreadings (one letter for another, one for two, two for one). An edit falls into one half
   of the word, so the other half leads through the trie without branching. Nothing is left out: the search returns every
   such vocabulary word.
3. What an edit costs is learned from the counts. A scanner makes rare words of frequent ones and never the reverse, so of
   the pairs of words that a misreading sets apart nearly all are lopsided; an ending or another name is as often the
   frequent one. Edits with ``LEAST`` lopsided pairs and ``SIDED`` times as many as even ones are misreadings (a word with
   several neighbours speaks for the edit that explains most words); others need far more of a difference in frequency,
   or are none. A word is a misreading if a candidate occurs ``RATIO`` times as often as there are distinct texts with the
   word (``RATIOS`` for the rarest words).
4. Headers and footers are learned too: lines without a closing mark that recur over ``SHARE_OF_FILES`` of the files once
   numbers (and, where needed, names) are left open, and that stand as lines of their own where they occur, while the
   lines of wrapped sentences occur inside longer ones. Page numbers are known by their formats.
5. Every text is read once more: its page furniture is cut out, broken words are joined, misreadings looked up (a bitmap
   of fixed size first, then an exact join), and candidates ranked by frequency, cost and the word before (bigrams are
   counted for the candidates in question, and joined).
6. The lines that remain are reflowed into paragraphs; headings, list items and blank lines stay.

The vocabulary goes to the workers in shards of bounded size, one after another.

Defined results: a null value is no case and has no repaired row, the empty text stays empty; a text is always handled whole; rows
with the same key are handled apart.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarqyt.session import bitmap, cut, in_bitmap, spread

OFTEN = 5
RATIO = 20
RATIOS = {1: 5, 2: 10, 3: 15}  # of words in so few texts
SHARD = 60_000
LEAST, SIDED = 5, 10
UNSURE = 25  # how much more lopsided a pair must be whose edit was not learned
SHARE_OF_FILES, FEWEST_FILES, OWN_LINES, LINE_WORDS = 1 / 2000, 3, 0.4, 9
BITS = 24

# What scanners read (left) for what was printed (right).
MISREAD_CYRILLIC = {"0": "о", "1": "і", "3": "з", "4": "ч", "6": "б", "п": "лн", "г": "тғ", "ьі": "ы", "пі": "ш", ">к": "ж", "іо": "ю", "к": "қ", "о": "ө", "у": "ұү", "н": "ң", "ш": "щ"}
MISREAD_LATIN = {"0": "o", "1": "li", "5": "s", "6": "b", "c": "e", "rn": "m", "vv": "w", "cl": "d", "li": "h", "ii": "u", "l": "i", "b": "h", "9": "g"}
DIGITS = str.maketrans("01346", "оізчб")
DIGITS_LATIN = str.maketrans("01569", "olsbg")
LOW = "а-яёәғқңөұүһіa-z"
UP = "А-ЯЁӘҒҚҢӨҰҮҺІA-Z"

WORD = re.compile(r"[^\W_]+(?:>[^\W\d_]+)*")
# accents of their own and invisible characters hide in words, but are no scanner's doing
HIDDEN = re.compile("[\u00ad\u0300-\u036f\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufeff]")
NUMBER = r"\d{1,4}"
FURNITURE = re.compile(
    rf"""(?:^|(?<=\s))(?:
      \[{NUMBER}\] | \|[ ]?{NUMBER} | {NUMBER}[ ]?\| | [-–—][ ]{NUMBER}[ ][-–—] | {NUMBER}[ ]/[ ]{NUMBER} | Page[ ]\d+(?:[ ]of[ ]\d+)?
      | стр\.[ ]{NUMBER}(?=\s*(?:$|\n|[{UP}«#–•-]|[{LOW}]{{2,}})) | {NUMBER}-бет
      | (?:«[^»\n]{{2,60}}»|[A-Z][a-z]+[ ][A-Z][a-z]+)[ ][|•·][ ](?:[^\W\d_][^\n|•·.,;:]{{2,30}}?)(?:[ ]\d{{4}}|(?=\s{{2,}}|\s*\n|\s*$|[ ][{UP}«\d]|[ ]{NUMBER}))
      | [{UP}0]{{4,}}(?:[ ][{UP}]{{2,}})*[ ]·[ ]{NUMBER}
      | [{UP}0]{{4,}}(?:[ ][{UP}0]{{2,}})+[ ]\d{{4}}(?:[ ][{UP}]{{3,4}})?
    )(?=\s|$)""",
    re.X,
)
SPACED = re.compile(rf"(?m)(?:^|(?<=\S))[ ]{{2,}}{NUMBER}(?:[ ]{{2,}}|$)")
ALONE = re.compile(rf"(?m)^[ \t]*(?:p\.[ ]?)?(?:{NUMBER}|[-–—][ ]?{NUMBER}[ ]?[-–—])[ \t]*$")
PAGE_START = re.compile(rf"(?m)^p\. {NUMBER}(?= [{UP}#«])")
# a word broken at a line end, and a break that was left behind inside a line
BROKEN = re.compile(rf"(?<=[{LOW}])(?:¬[ \t]*\n?[ \t]*|[ ]?[-‐][ \t]*\n[ \t]*)(?=[{LOW}])")
SPLIT = re.compile(rf"([{UP}{LOW}][{LOW}]*)[ ]?[-‐][ ]([{LOW}]+)")
# each way begins with the character that is looked for, so that the search runs from one to the next
INSIDE = re.compile(rf"[0134569](?<=[{LOW}]\d)(?=[{LOW}])|[034569](?<=[{UP}{LOW}][{LOW}]{{2}}\d)(?![\w])|[0346](?<![\w.,/-]\d)[{LOW}]{{3,}}|>(?<=[{LOW}{UP}]>)к[{LOW}]|ьі")
GARBLED = re.compile("[\u00ae\u00a4\u00a7\u00a9\u0490\u00b0\u00b1\u00b5\u00b6\u00a6\x80-\x9f]")


def cyrillic(lang: str) -> bool:
    return lang != "eng"


CODE = rf"[/\\](?:uni|afii)|\(cid:|{GARBLED.pattern}"
ANY_CODE, CODED = re.compile(CODE), re.compile(rf"\S*(?:{CODE})\S*")


def plain_words(t: str) -> list[str]:
    """The words of a text in lower case; what a wrong encoding or glyph codes cut apart is none."""
    if ANY_CODE.search(t):
        t = CODED.sub(" ", t)
    return WORD.findall((HIDDEN.sub("", unicodedata.normalize("NFC", t)) if HIDDEN.search(t) else t).lower())


def _letters(w: str) -> bool:
    return w.isalpha()


class Trie:
    """Tries over a sorted list of words and over the same words backwards; a node is a dict of letters, and holds its word
    under the empty key."""

    def __init__(self, words: list[str], counts: list[int]) -> None:
        self.words, self.counts = words, counts
        self.root: dict = {}
        self.back: dict = {}
        for w in words:
            for root, letters in ((self.root, w), (self.back, reversed(w))):
                for c in letters:
                    root = root.setdefault(c, {})
                root[""] = w

    def misread(self, word: str, cheap: dict[str, str], most: int) -> dict[str, int]:
        """All words of the trie within ``most`` known misreadings, with their number."""
        found: dict[str, int] = {}
        stack = [(0, self.root, 0)]
        size = len(word)
        while stack:
            i, node, cost = stack.pop()
            while True:
                if i == size:
                    if (w := node.get("")) is not None:
                        found[w] = min(cost, found.get(w, most))
                    break
                if cost < most:
                    for k in (1, 2):
                        for right in cheap.get(word[i : i + k], "") if i + k <= size else "":
                            if n := node.get(right):
                                stack.append((i + k, n, cost + 1))
                            elif len(right) > 1:
                                n = node
                                for c in right:
                                    n = n.get(c) if n else None
                                if n:
                                    stack.append((i + k, n, cost + 1))
                node = node.get(word[i])
                if node is None:
                    break
                i += 1
        return found

    @staticmethod
    def _half(root: dict, word: str, begin: int, found: set[str]) -> None:
        """Words one edit away, the edit not before letter ``begin``."""
        node, size = root, len(word)
        for c in word[:begin]:
            node = node.get(c)
            if node is None:
                return
        i = begin
        while True:
            # the rest after an edit here must match letter by letter
            tries = [(i + 1, node)] if i < size else []
            for c, child in node.items():
                if c:
                    tries.append((i, child))
                    if i < size and c != word[i]:
                        tries.append((i + 1, child))
            for j, n in tries:
                for c in word[j:]:
                    n = n.get(c)
                    if n is None:
                        break
                else:
                    if (w := n.get("")) is not None:
                        found.add(w)
            if i == size or (node := node.get(word[i])) is None:
                return
            i += 1

    def edits(self, word: str) -> set[str]:
        """All words of the trie one edit away: a letter lost, added or changed."""
        found: set[str] = set()
        half = len(word) // 2
        self._half(self.root, word, half, found)
        self._half(self.back, word[::-1], len(word) - half, found)
        return found

    def within(self, word: str, cheap: dict[str, str], most: int, general: bool) -> dict[str, int]:
        """All words of the trie within cost ``most``: each known misreading costs 1; with ``general``, any one edit 2."""
        found = self.misread(word, cheap, most)
        if general and most >= 2:
            for w in self.edits(word):
                found.setdefault(w, 2)
        return found


def edit(word: str, right: str) -> str:
    """The one edit between two words, and whether it stands at the end, where words are inflected."""
    i, most = 0, min(len(word), len(right))
    while i < most and word[i] == right[i]:
        i += 1
    j = 0
    while j < most - i and word[-1 - j] == right[-1 - j]:
        j += 1
    return f"{word[i : len(word) - j]}>{right[i : len(right) - j]}{'$' if j < 2 else ''}"


def texts(extractions: DataFrame, corpus: DataFrame) -> DataFrame:
    """``(field, rec_id, lang, text)`` of the fields with traces of pages."""
    one = extractions.select(F.lit("text_only").alias("field"), F.col("extract_id").alias("rec_id"), F.lower(F.regexp_extract("filename", r"_([A-Z]{3})\.md$", 1)).alias("lang"), F.col("text_only").alias("text"))
    two = corpus.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col("row_id").alias("rec_id"), F.lit(c).alias("lang"), F.col(c).alias("text")) for c in ("kaz", "rus")))).alias("x")).select("x.*")
    return spread(one, "rec_id").unionByName(spread(two, "rec_id")).where("text IS NOT NULL")


def word_counts(rows: DataFrame) -> DataFrame:
    """``(lang, word, n, texts)``: how often a word occurs, and in how many distinct texts, which copies do not raise."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, tuple[Counter, Counter]] = {}

        def out() -> pa.RecordBatch:
            flat = [(lang, w, n, d[w]) for lang, (c, d) in totals.items() for w, n in c.items() if not w.isdigit()]
            totals.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[j] for x in flat], t) for j, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))], ["lang", "word", "n", "texts"])

        for b in batches:
            for lang, t, copies in zip(*(c.to_pylist() for c in b.columns), strict=True):
                c, d = totals.setdefault(lang, (Counter(), Counter()))
                ws = plain_words(t)
                c.update(ws if copies == 1 else {w: n * copies for w, n in Counter(ws).items()})
                d.update(set(ws))
            if sum(len(c) for c, _ in totals.values()) > 300_000:
                yield out()
        yield out()

    once = rows.groupBy("lang", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    return once.select("lang", "text", "copies").mapInArrow(go, "lang string, word string, n bigint, texts bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))


def needed(texts: int) -> int:
    """How often a word must occur to stand for one of so many distinct texts."""
    return texts * RATIOS.get(texts, RATIO)


RIGHT = "array<struct<word:string,cost:double,n:bigint,edit:string>>"


def _search(words: DataFrame, trie_rows: pa.Table) -> DataFrame:
    """Of rows (lang, word, texts, n): ``(lang, word, texts, right, edit, even)``. A row with ``right`` has the vocabulary words
    that are far more frequent; a row with ``edit`` how many pairs of the task it sets apart are of like frequency."""
    by_lang: dict[str, tuple[list, list]] = {}
    for lang, w, n in sorted(zip(*(trie_rows[c].to_pylist() for c in ("lang", "word", "n")), strict=True)):
        x = by_lang.setdefault(lang, ([], []))
        x[0].append(w)
        x[1].append(n)
    shared = words.sparkSession.sparkContext.broadcast(by_lang)
    kind = pa.struct([("word", pa.string()), ("cost", pa.float64()), ("n", pa.int64()), ("edit", pa.string())])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = {k: Trie(*v) for k, v in shared.value.items()}
        counts = {k: dict(zip(*v, strict=True)) for k, v in shared.value.items()}
        for b in batches:
            rows: list[tuple] = []
            even: Counter = Counter()
            for lang, w, texts, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                trie = tries.get(lang)
                if trie is None:
                    continue
                count, need, good = counts[lang], needed(texts), {}
                for v, cost in trie.misread(w, MISREAD_CYRILLIC if cyrillic(lang) else MISREAD_LATIN, 2).items():
                    if v != w and count[v] >= need:
                        good[v] = (v, float(cost), count[v], "")
                for v in trie.edits(w):
                    m = count[v]
                    if v == w or v in good or m < n:
                        continue
                    if m < need:
                        even[lang, edit(w, v)] += 1
                    else:
                        good[v] = (v, 2.0, m, "odd" if not _letters(w) else edit(w, v))
                if good:
                    rows.append((lang, w, texts, [dict(zip(("word", "cost", "n", "edit"), x, strict=True)) for x in good.values()], None, 0))
            rows += [(lang, None, 0, None, e, k) for (lang, e), k in even.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.list_(kind), pa.string(), pa.int64()))], ["lang", "word", "texts", "right", "edit", "even"])

    return words.select("lang", "word", "texts", "n").mapInArrow(go, f"lang string, word string, texts bigint, right {RIGHT}, edit string, even bigint")


def _costs(pairs: DataFrame) -> dict[tuple[str, str], tuple[int, int]]:
    """Per language and edit its lopsided and its even pairs. There are at most as many edits as pairs of letters. A word
    with several neighbours counts for the edit that explains most words, which takes two turns."""
    even = {(r["lang"], r["edit"]): r["n"] for r in pairs.where("edit IS NOT NULL").groupBy("lang", "edit").agg(F.sum("even").alias("n")).toArrow().to_pylist()}
    each = pairs.where("right IS NOT NULL").select("lang", "word", F.explode("right").alias("r")).select("lang", "word", F.col("r.edit").alias("edit"))
    # a word that a known misreading explains speaks for no other edit
    each = each.where(~F.exists(F.array("edit"), lambda e: e.isin("odd"))).groupBy("lang", "word").agg(F.collect_set("edit").alias("edits")).where("NOT array_contains(edits, '')")
    each = cut(each)
    strength: dict[tuple[str, str], int] = {}
    for _ in range(2):
        one = each.select("lang", "word", F.explode("edits").alias("edit"))
        if strength:
            known = each.sparkSession.createDataFrame(pa.table([pa.array([k for k, _ in strength]), pa.array([e for _, e in strength]), pa.array(list(strength.values()), pa.int64())], ["lang", "edit", "n"]))
            one = one.join(F.broadcast(known), ["lang", "edit"]).groupBy("lang", "word").agg(F.max_by("edit", F.struct("n", "edit")).alias("edit"))
        strength = {(r["lang"], r["edit"]): r["n"] for r in one.groupBy("lang", "edit").agg(F.count(F.lit(1)).alias("n")).toArrow().to_pylist()}
    return {k: (n, even.get(k, 0)) for k, n in strength.items()}


def learned(lopsided: int, even: int) -> bool:
    return lopsided >= LEAST and lopsided >= SIDED * even


def misreadings(counts: DataFrame) -> DataFrame:
    """``(lang, word, right)``: the words that are misreadings, with all vocabulary words they may stand for."""
    vocabulary = counts.where(F.col("n") >= OFTEN).where(F.col("word").rlike(r"^\p{L}{2,}$"))
    shards = max(1, -(-vocabulary.count() // SHARD))
    # letters of another script are no scanner's doing
    alphabet = F.when(F.col("lang") == "eng", F.col("word").rlike("^[a-z0-9>]+$")).otherwise(F.col("word").rlike("^[а-яёәғқңөұүһі0-9>]+$|^[a-z]+$"))
    words = counts.where(F.length("word") >= 2).where(alphabet)
    words = words.repartition(words.sparkSession.sparkContext.defaultParallelism * 2, "word")
    out = None
    for i in range(shards):
        part = vocabulary.where(F.pmod(F.xxhash64("word"), F.lit(shards)) == i).toArrow()
        got = _search(words, part)
        out = got if out is None else out.unionByName(got)
    pairs = cut(out)
    costs = _costs(pairs)
    sure = [f"{k} {e}" for (k, e), (a, b) in costs.items() if learned(a, b)]
    never = [f"{k} {e}" for (k, e), (a, b) in costs.items() if not learned(a, b) and b > 0]
    need = F.col("texts") * F.when(F.col("texts") == 1, RATIOS[1]).when(F.col("texts") == 2, RATIOS[2]).when(F.col("texts") == 3, RATIOS[3]).otherwise(RATIO)
    name = F.concat("lang", F.lit(" "), "edit")
    kept = pairs.where("right IS NOT NULL").select("lang", "word", "texts", F.inline("right").alias("to", "cost", "n", "edit"))
    short = F.length("word") < 4
    kept = kept.withColumn("kind", F.when(F.col("edit").isin("", "odd"), "known").when(name.isin(sure), "sure").when(name.isin(never), "never").otherwise("unsure"))
    # words of two and three letters have neighbours by chance
    good = F.when(short, F.col("kind").isin("known", "sure") & (F.col("n") >= need * UNSURE) & (F.col("edit") != "odd")).otherwise(F.col("kind").isin("known", "sure") | (F.col("kind") == "unsure") & (F.col("n") >= need * UNSURE) & ~F.endswith("edit", F.lit("$")))
    cost = F.when(F.col("kind") == "sure", 1.5).when(F.col("kind") == "unsure", 3.0).otherwise(F.col("cost"))
    # a list per word: its neighbours in the vocabulary
    return kept.where(good).groupBy("lang", "word").agg(F.collect_list(F.struct(F.col("to").alias("word"), cost.alias("cost"), "n")).alias("right"))


def _hash(lang: str, w: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{lang} {w}")


def _hashed(df: DataFrame) -> DataFrame:
    """Adds the same hash to Spark rows."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = np.array([_hash(*x) for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    return df.select("lang", "word").mapInArrow(go, "h bigint")


def _shouted(around: str) -> bool:
    """Whether the text around a match is itself in capitals, so that capitals mark nothing."""
    return sum(c.isupper() for c in around) > sum(c.islower() for c in around)


class Headers:
    """Learned header lines: tokens, where # stands for a number, «N» for a quoted name and N for a capitalised word."""

    def __init__(self, lines: list[str]) -> None:
        self.lines = sorted(set(lines))
        self.by: dict[str, list[re.Pattern]] = {}
        for line in self.lines:
            own = [t for t in line.split() if t not in ("N", "«N»") and re.search(r"\w{2,}", t.replace("#", ""))]
            if own:
                one = r"[ \t]+".join(r"«[^»\n]{2,60}»" if t == "«N»" else rf"[{UP}][{LOW}]{{3,}}" if t == "N" else re.escape(t).replace(r"\#", r"\d{1,4}") for t in line.split())
                # found by its longest own word, if that has no number in it
                anchor = max((t for t in own if "#" not in t), key=len, default="")
                self.by.setdefault(anchor, []).append(re.compile(rf"(?<!\S){one}(?!\S)"))
        self.anchors = set(self.by)

    def places(self, t: str) -> list[tuple[int, int]]:
        found = [m.span() for a in self.anchors.intersection(t.split()) for one in self.by[a] for m in one.finditer(t)]
        if "" in self.by:
            found += [m.span() for one in self.by[""] for m in one.finditer(t)]
        return found


NO_HEADERS = Headers([])
QUOTED = re.compile(r"«[^»\n]*»")
DIGITS_RUN = re.compile(r"\d+")
TITLE = re.compile(rf"[{UP}][{LOW}]{{3,}}")


def open_line(line: str) -> list[str]:
    """The tokens of a line, numbers and quoted names left open."""
    return DIGITS_RUN.sub("#", QUOTED.sub("«N»", line)).split()


def patterns(tokens: list[str]) -> list[str]:
    """A line with all, some and none of its capitalised words left open, from the most open one."""
    at = [i for i, t in enumerate(tokens) if TITLE.fullmatch(t)][:5]
    out = []
    for mask in range(1 << len(at)):
        gone = {i for k, i in enumerate(at) if not mask >> k & 1}
        out.append((len(gone), " ".join("N" if i in gone else t for i, t in enumerate(tokens))))
    return [p for _, p in sorted(out, key=lambda x: -x[0])]


def lone_lines(t: str) -> Iterator[list[str]]:
    """The short lines of a text that could be headers: no closing mark, no heading, no list item."""
    if "\n" in t:
        for line in t.split("\n"):
            line = line.strip()
            if line and line[-1] not in ".!?…:;,。！？" and not LIST_ITEM.match(line) and len(line) < 120:
                tokens = open_line(line)
                if len(tokens) <= LINE_WORDS:
                    yield tokens


def headers(rows: DataFrame) -> Headers:
    """The header lines learned from the texts with lines in (field, rec_id, file, text)."""
    rows = rows.where(F.contains("text", F.lit("\n")))
    counts = rows.agg(F.count_distinct("file").alias("n")).first()
    least = max(FEWEST_FILES, int((counts["n"] or 0) * SHARE_OF_FILES))

    def most_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = {(patterns(x)[0], f) for f, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for x in lone_lines(t)}
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in got], pa.string()), pa.array([f for _, f in got], pa.int64())], ["line", "file"])

    seen = rows.select("file", "text").mapInArrow(most_open, "line string, file bigint").distinct().groupBy("line").agg(F.count(F.lit(1)).alias("files"))
    # a line of a share of the files: at most the lines per file times one over the share
    wide = {r["line"] for r in seen.where(F.col("files") >= least).select("line").toArrow().to_pylist()}
    shared = rows.sparkSession.sparkContext.broadcast(wide)

    def closer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep, size = shared.value, {}
        for w in shared.value:
            size.setdefault(w.split(" ", 1)[0], set()).add(w.count(" ") + 1)
        for b in batches:
            own: set[tuple[str, str, int]] = set()
            lines: Counter = Counter()
            inside: Counter = Counter()
            for f, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for x in lone_lines(t):
                    p = patterns(x)
                    if p[0] in keep:
                        lines[p[0]] += 1
                        own.update((p[0], q, f) for q in p)
                # the same words inside longer lines
                for line in t.split("\n"):
                    x = ["N" if TITLE.fullmatch(w) else w for w in open_line(line)]
                    for i, w in enumerate(x):
                        for n in size.get(w, ()):
                            if n < len(x) and i + n <= len(x) and (q := " ".join(x[i : i + n])) in keep:
                                inside[q] += 1
            flat = [(p, q, f, 0, 0) for p, q, f in own] + [(p, None, None, lines[p], inside[p]) for p in lines.keys() | inside.keys()]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in flat], t) for j, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["wide", "line", "file", "own", "inside"])

    got = cut(rows.select("file", "text").mapInArrow(closer, "wide string, line string, file bigint, own bigint, inside bigint").groupBy("wide", "line", "file").agg(F.sum("own").alias("own"), F.sum("inside").alias("inside")))
    alone = got.where("line IS NULL").where(F.col("own") >= OWN_LINES * (F.col("own") + F.col("inside"))).select("wide")
    named = got.where("line IS NOT NULL").join(alone, "wide").groupBy("wide", "line").agg(F.count(F.lit(1)).alias("files")).where(F.col("files") >= least)
    # of a line's versions the least open ones that recur
    best = named.withColumn("open", F.size(F.filter(F.split("line", " "), lambda t: t == "N")))
    few = best.groupBy("wide").agg(F.min("open").alias("open"))
    return Headers([r["line"] for r in best.join(few, ["wide", "open"]).select("line").distinct().toArrow().to_pylist()])


def furniture(t: str, known: Headers = NO_HEADERS) -> list[tuple[int, int]]:
    """Places of page numbers and running headers; none overlaps another."""
    out = [m.span() for m in FURNITURE.finditer(t) if not (m[0].isupper() and _shouted(t[max(0, m.start() - 60) : m.start()] + t[m.end() : m.end() + 60]))]
    out += known.places(t)
    if "  " in t:
        out += [m.span() for m in SPACED.finditer(t)]
    if "\n" in t:
        out += [m.span() for m in ALONE.finditer(t) if m.group().strip()]
        out += [m.span() for m in PAGE_START.finditer(t)]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(out):
        if merged and a < merged[-1][1]:
            merged[-1] = merged[-1][0], max(b, merged[-1][1])
        else:
            merged.append((a, b))
    return merged


def breaks(t: str) -> list[tuple[int, int]]:
    """Places of line breaks inside words."""
    if "¬" not in t and "\n" not in t:
        return []
    return [m.span() for m in BROKEN.finditer(t) if not GARBLED.search(t, max(0, m.start() - 15), m.end() + 15)]


def _noise(rows: DataFrame, counts: DataFrame, wrong: DataFrame, known, context: bool) -> DataFrame:
    """``(field, rec_id, lang, sure, look)`` of the texts with a trace that needs no dictionary, or with words to look up;
    with ``context`` each with the word before it."""
    packed = rows.sparkSession.sparkContext.broadcast(bitmap(_hashed(wrong), "h", BITS))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, tuple[set[str], set[str]]] = {}
        heads = known.value
        for b in batches:
            out = []
            for field, rid, lang, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                # a digit or sign inside a word, and letters that never meet, need no dictionary either
                sure = bool(furniture(t, heads) or breaks(t) or INSIDE.search(t))
                look = _lookups(t, lang, packed.value, words, context)
                if sure or look:
                    out.append((field, rid, lang, sure, look))
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], k) for j, k in enumerate((pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.string())))], ["field", "rec_id", "lang", "sure", "look"])

    return rows.select("field", "rec_id", "lang", "text").mapInArrow(go, "field string, rec_id bigint, lang string, sure boolean, look array<string>")


def _lookups(t: str, lang: str, packed: np.ndarray, words: dict, context: bool) -> list[str]:
    """Words of a text that may be misreadings (kind w, with the word before) or, joined, vocabulary words (kind j)."""
    seen, bad = words.setdefault(lang, (set(), set()))
    if len(seen) > 300_000:
        seen.clear()
        bad.clear()
    ws = plain_words(t)
    own = set(ws)
    new = own - seen
    if new:
        seen |= new
        new = [w for w in new if len(w) > 1 and not w.isdigit()]
        if new:
            hit = in_bitmap(packed, np.array([_hash(lang, w) for w in new], np.uint64), BITS)
            bad.update(w for w, h in zip(new, hit, strict=True) if h)
    out = own & bad
    joins = ["j" + (m[1] + m[2]).lower() for m in SPLIT.finditer(t)] if "- " in t or "‐ " in t else []
    if not context:
        return ["w" + w for w in out] + joins
    return sorted({f"w{w} {a}" for a, w in zip(["", *ws], ws, strict=False) if w in out}) + joins


def _dictionary(counts: DataFrame, wrong: DataFrame) -> DataFrame:
    joined = counts.where(F.col("n") >= OFTEN).where(F.col("word").rlike(r"^\p{L}{5,}$")).select("lang", F.concat(F.lit("j"), "word").alias("look"))
    return wrong.select("lang", F.concat(F.lit("w"), "word").alias("look")).unionByName(joined)


def _learned(extractions: DataFrame, corpus: DataFrame) -> tuple:
    rows = texts(extractions, corpus)
    counts = cut(word_counts(rows))
    wrong = cut(misreadings(counts))
    own = extractions.where("text_only IS NOT NULL").select(F.xxhash64(*(c for c in ("collection", "filename") if c in extractions.columns)).alias("file"), F.col("text_only").alias("text"))
    return rows, counts, wrong, rows.sparkSession.sparkContext.broadcast(headers(spread(own, "file")))


def found(extractions: DataFrame, corpus: DataFrame) -> DataFrame:
    """``(field, rec_id)`` of every value with a broken word, a misread letter, a running header or a page number."""
    rows, counts, wrong, known = _learned(extractions, corpus)
    noise = cut(_noise(rows, counts, wrong, known, False))
    sure = noise.where("sure").select("field", "rec_id")
    look = noise.where("NOT sure").select("field", "rec_id", "lang", F.explode("look").alias("look"))
    confirmed = look.join(_dictionary(counts, wrong), ["lang", "look"], "left_semi").select("field", "rec_id")
    return sure.unionByName(confirmed).distinct()


LIST_ITEM = re.compile(r"\s*(?:[-–—•*]|\d+[.)]|#{1,6})\s")


def reflow(t: str) -> str:
    """Lines of one paragraph become one line; blank lines, headings and list items keep theirs."""
    out: list[str] = []
    for block in re.split(r"\n\s*\n", t):
        lines: list[str] = []
        heading = False
        for line in block.split("\n"):
            line = re.sub(r"[ \t]{2,}", " ", line).strip()
            if not line:
                continue
            if lines and not heading and not LIST_ITEM.match(line):
                lines[-1] += " " + line
            else:
                lines.append(line)
            heading = line.startswith("#")
        if lines:
            out.append("\n".join(lines))
    return "\n\n".join(out)


def mended(t: str, right: dict[tuple[str, str], str], joins: set[str], known: Headers = NO_HEADERS) -> str:
    """A text without furniture and breaks, its misreadings replaced by what ``right`` has for (word before, word), reflowed."""
    ws = iter(["", *WORD.findall(t.lower())])
    before = {m.start(): a for m, a in zip(WORD.finditer(t), ws, strict=False)} if right else {}
    t = WORD.sub(lambda m: _spelled(m, t, right.get((before[m.start()], m[0].lower()))), t) if right else t
    for a, b in reversed(furniture(t, known)):
        first, last = t.rfind("\n", 0, a) + 1, t.find("\n", b)
        last = len(t) if last < 0 else last
        if not t[first:a].strip() and not t[b:last].strip():
            # a line of its own goes with its end, so that the lines around it meet
            t = t[:first] + t[last + 1 :]
        else:
            t = t[:a] + (" " if t[a:b][:1] == " " else "") + t[b:]
    for a, b in reversed(breaks(t)):
        t = t[:a] + t[b:]
    t = SPLIT.sub(lambda m: m[1] + m[2] if (m[1] + m[2]).lower() in joins else m[0], t)

    return reflow(WORD.sub(lambda m: _digits(m[0]), t))


def _spelled(m: re.Match, t: str, new: str | None) -> str:
    w = m[0]
    if new is None:
        return w
    return new.upper() if w.isupper() and len(w) > 1 else new[:1].upper() + new[1:] if w[:1].isupper() or not w[:1].isalpha() and m.start() and t[m.start() - 1] == "«" else new


def _digits(w: str) -> str:
    """A word with digits inside that no vocabulary word explains, by what they look like."""
    return w if not INSIDE.search(w) else w.translate(DIGITS if re.search("[а-яё]", w) else DIGITS_LATIN)


def repaired(extractions: DataFrame, corpus: DataFrame) -> DataFrame:
    """``(field, rec_id, text)``: every value as continuous readable paragraphs."""
    rows, counts, wrong, known = _learned(extractions, corpus)
    noise = cut(_noise(rows, counts, wrong, known, True))
    look = noise.select("field", "rec_id", "lang", F.explode("look").alias("look"))
    best = _best(rows, look.where(F.startswith("look", F.lit("w"))), wrong)
    words = look.join(best, ["lang", "look"]).select("field", "rec_id", F.struct("look", "to").alias("x"), F.lit(None).cast("string").alias("j"))
    joins = look.join(_dictionary(counts, wrong).where(F.startswith("look", F.lit("j"))), ["lang", "look"], "left_semi").select("field", "rec_id", F.lit(None).cast("struct<look:string,to:string>").alias("x"), F.col("look").alias("j"))
    # lists per value: at most its own words
    per = words.unionByName(joins).groupBy("field", "rec_id").agg(F.collect_list("x").alias("words"), F.collect_list("j").alias("joins"))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, words, joins in zip(*(b.column(c).to_pylist() for c in ("text", "words", "joins")), strict=True):
                right = {(x["look"].split(" ", 1)[1], x["look"][1:].split(" ", 1)[0]): x["to"] for x in words or ()}
                out.append(mended(t, right, {j[1:] for j in joins or ()}, known.value))
            yield pa.RecordBatch.from_arrays([b.column("field"), b.column("rec_id"), pa.array(out, pa.string())], ["field", "rec_id", "text"])

    return rows.join(per, ["field", "rec_id"], "left").select("field", "rec_id", "text", "words", "joins").mapInArrow(go, "field string, rec_id bigint, text string")


def _best(rows: DataFrame, look: DataFrame, wrong: DataFrame) -> DataFrame:
    """``(lang, look, to)``: for each misreading after each word, the candidate with the best frequency, cost and bigram. The
    bigrams are counted over all texts for candidates that compete with another one, and joined."""
    asked = look.select("lang", "look").distinct().withColumns({"word": F.expr("substring_index(substring(look, 2), ' ', 1)"), "before": F.expr("substring(look, instr(look, ' ') + 1)")})
    asked = asked.join(wrong, ["lang", "word"]).select("lang", "look", "before", F.size("right").alias("rivals"), F.inline("right").alias("to", "cost", "n"))
    asked = cut(asked)
    rivals = asked.where("rivals > 1").select(F.lit("").alias("lang"), F.col("to").alias("word")).distinct()
    packed = rows.sparkSession.sparkContext.broadcast(bitmap(_hashed(rivals), "h", BITS))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, tuple[set[str], set[str]]] = {}
        for b in batches:
            c: Counter = Counter()
            for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen, good = words.setdefault("", (set(), set()))
                if len(seen) > 300_000:
                    seen.clear()
                    good.clear()
                ws = plain_words(t)
                new = [w for w in set(ws) - seen]
                if new:
                    seen.update(new)
                    hit = in_bitmap(packed.value, np.array([_hash("", w) for w in new], np.uint64), BITS)
                    good.update(w for w, h in zip(new, hit, strict=True) if h)
                c.update((lang, a, w) for a, w in zip(ws, ws[1:], strict=False) if w in good)
            flat = list(c.items())
            yield pa.RecordBatch.from_arrays([*(pa.array([k[j] for k, _ in flat], pa.string()) for j in range(3)), pa.array([n for _, n in flat], pa.int64())], ["lang", "before", "to", "pair"])

    pairs = rows.select("lang", "text").mapInArrow(go, "lang string, before string, to string, pair bigint").groupBy("lang", "before", "to").agg(F.sum("pair").alias("pair"))
    score = F.log("n") - 4 * F.col("cost") + 3 * F.log1p(F.coalesce("pair", F.lit(0)))
    return asked.join(pairs, ["lang", "before", "to"], "left").groupBy("lang", "look").agg(F.max_by("to", F.struct(score, "to")).alias("to"))
