"""Quality verdicts on triplets: one column with the first reason to reject, or null. Each row is judged on its own."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sarqyt.operators.models import Judge, answered
from sarqyt.functions.rules import DIGIT, WS, count_of, count_of_sql, quoted, word_count, word_count_sql, words, words_sql


@dataclass(frozen=True)
class Limits:
    min_similarity: float = 0.80
    strict_similarity: float = 0.85
    min_words: int = 3
    max_words: int = 300
    min_chars: int = 15
    max_ratio: float = 3.0
    strict: bool = False


TRIPLE = rf"{DIGIT}+{WS}+{DIGIT}+{WS}+{DIGIT}+"
# Words of contents pages
CONTENTS = ("содержание", "content", "мазмұны", "приложени", "appendix")


def good_length(c: Column, p: Limits = Limits()) -> Column:
    return word_count(c).between(p.min_words, p.max_words) & (F.length(c) >= p.min_chars)


def good_length_sql(e: str, p: Limits = Limits()) -> str:
    return f"({word_count_sql(e)} BETWEEN {p.min_words} AND {p.max_words} AND length({e}) >= {p.min_chars})"


def good_content(c: Column) -> Column:
    """Letters are at least 40 % of the characters, ten different characters, half of the words different."""
    letters = F.filter(F.array_distinct(F.split(F.lower(c), "")), lambda x: x != "")
    return (count_of(c, r"\p{L}") >= F.length(c) * 0.4) & (F.size(letters) >= 10) & (F.size(F.array_distinct(words(c))) >= F.size(words(c)) * 0.5) & (F.length(c) > 0)


def good_content_sql(e: str) -> str:
    return f"({count_of_sql(e, r'[\p{L}]')} >= length({e}) * 0.4 AND len(list_distinct(string_split(lower({e}), ''))) >= 10 AND len(list_distinct({words_sql(e)})) >= len({words_sql(e)}) * 0.5 AND length({e}) > 0)"


def contents_like(c: Column) -> Column:
    """More than 30 % digits, a word of contents pages, or three numbers in a row."""
    return F.rlike(c, F.lit("(?iu)" + "|".join(CONTENTS))) | F.rlike(c, F.lit(TRIPLE)) | (count_of(c, DIGIT) > F.length(c) * 0.3)


def contents_like_sql(e: str) -> str:
    return "(" + " OR ".join([f"regexp_matches({e}, {quoted(TRIPLE)})", f"{count_of_sql(e, DIGIT)} > length({e}) * 0.3", *(f"contains(lower({e}), {quoted(w)})" for w in CONTENTS)]) + ")"


def good_ratio(a: Column, b: Column, p: Limits = Limits()) -> Column:
    x, y = word_count(a), word_count(b)
    return F.coalesce(F.greatest(x, y) <= F.least(x, y) * p.max_ratio, F.lit(False))


def good_ratio_sql(a: str, b: str, p: Limits = Limits()) -> str:
    x, y = word_count_sql(a), word_count_sql(b)
    return f"coalesce(greatest({x}, {y}) <= least({x}, {y}) * {p.max_ratio}, false)"


def _missing(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def with_reason(df: DataFrame, p: Limits = Limits(), name: str = "reason") -> DataFrame:
    """Adds the first reason against a triplet (columns kaz, rus, eng and their similarities), or null, as a column. What it needs of each text is computed once per row in a
    projection of its own; inside one CASE each branch would cut the texts into words again."""
    sides = ("kaz", "rus", "eng")
    first = df.select("*", *(words(F.col(x)).alias(f"__w_{x}") for x in sides))
    facts = first.select(*df.columns, *(F.struct((~_missing(F.col(x))).alias("there"), F.size(f"__w_{x}").alias("words"), F.size(F.array_distinct(f"__w_{x}")).alias("kinds"), F.length(x).alias("chars"), count_of(F.col(x), r"\p{L}").alias("letters"), F.size(F.filter(F.array_distinct(F.split(F.lower(x), "")), lambda c: c != "")).alias("marks"), contents_like(F.col(x)).alias("toc")).alias(f"__f_{x}") for x in sides))
    f = {x: F.col(f"__f_{x}") for x in sides}

    def length(x: str) -> Column:
        return f[x]["words"].between(p.min_words, p.max_words) & (f[x]["chars"] >= p.min_chars)

    def content(x: str) -> Column:
        return (f[x]["letters"] >= f[x]["chars"] * 0.4) & (f[x]["marks"] >= 10) & (f[x]["kinds"] >= f[x]["words"] * 0.5) & (f[x]["chars"] > 0)

    out = F.when(~f["kaz"]["there"], "missing_kaz").when(~f["rus"]["there"] & ~f["eng"]["there"], "no_translations").when(~length("kaz"), "kaz_length").when(~content("kaz"), "kaz_quality").when(f["kaz"]["toc"], "kaz_toc")
    for x in ("rus", "eng"):
        there, a, b = f[x]["there"], f["kaz"]["words"], f[x]["words"]
        out = out.when(there & ~length(x), f"{x}_length").when(there & ~content(x), f"{x}_quality").when(there & f[x]["toc"], f"{x}_toc")
        out = out.when(there & ~(F.greatest(a, b) <= F.least(a, b) * p.max_ratio), f"kaz_{x}_ratio").when(there & ~F.coalesce(F.col(f"similarity_kaz_{x}") >= p.min_similarity, F.lit(False)), f"kaz_{x}_similarity")
    if p.strict:
        for x in ("rus", "eng"):
            out = out.when(f[x]["there"] & (F.coalesce(F.col(f"similarity_kaz_{x}"), F.lit(0.0)) < p.strict_similarity), f"strict_kaz_{x}_similarity")
    return facts.select(*df.columns, out.alias(name))


def triplet_reason_sql(p: Limits = Limits()) -> str:
    gone = lambda x: f"coalesce({x}, '') = ''"
    when = [(gone("kaz"), "missing_kaz"), (f"{gone('rus')} AND {gone('eng')}", "no_translations"), (f"NOT {good_length_sql('kaz', p)}", "kaz_length"), (f"NOT {good_content_sql('kaz')}", "kaz_quality"), (contents_like_sql("kaz"), "kaz_toc")]
    for x in ("rus", "eng"):
        tests = [(f"NOT {good_length_sql(x, p)}", f"{x}_length"), (f"NOT {good_content_sql(x)}", f"{x}_quality"), (contents_like_sql(x), f"{x}_toc"), (f"NOT {good_ratio_sql('kaz', x, p)}", f"kaz_{x}_ratio"), (f"NOT coalesce(similarity_kaz_{x} >= {p.min_similarity}, false)", f"kaz_{x}_similarity")]
        when += [(f"NOT ({gone(x)}) AND {t}", r) for t, r in tests]
    if p.strict:
        when += [(f"NOT ({gone(x)}) AND coalesce(similarity_kaz_{x}, 0) < {p.strict_similarity}", f"strict_kaz_{x}_similarity") for x in ("rus", "eng")]
    return "CASE " + " ".join(f"WHEN {t} THEN '{r}'" for t, r in when) + " END"


# Texts that are no sentences, tested on the lower-cased text from its start
JUNK = (r"^[\p{Nd}" + WS[1:-1] + r".,\-:]+$", f"^[A-Z{WS[1:-1]}]+$", rf"^{DIGIT}+{WS}*(млн|млрд|тыс|%)", rf"^(table|figure|рисунок|таблица){WS}*{DIGIT}")


def basic_reason() -> Column:
    """The first version's verdict on a triplet, or null."""
    kaz = F.col("kaz")
    out = F.when(_missing(kaz), "missing_kaz").when(_missing(F.col("rus")) & _missing(F.col("eng")), "missing_both_targets").when(word_count(kaz) < 5, "too_short")
    out = out.when(F.greatest(*(F.coalesce(word_count(F.col(x)), F.lit(0)) for x in ("kaz", "rus", "eng"))) > 200, "too_long")
    for p in JUNK:
        out = out.when(F.rlike(F.lower(kaz), F.lit(p)), "garbage_pattern")
    return out


def basic_reason_sql() -> str:
    n = {x: f"coalesce({word_count_sql(x)}, 0)" for x in ("kaz", "rus", "eng")}
    junk = " OR ".join(f"regexp_matches(lower(kaz), {quoted(p)})" for p in JUNK)
    return f"CASE WHEN coalesce(kaz, '') = '' THEN 'missing_kaz' WHEN coalesce(rus, '') = '' AND coalesce(eng, '') = '' THEN 'missing_both_targets' WHEN {n['kaz']} < 5 THEN 'too_short' WHEN greatest({n['kaz']}, {n['rus']}, {n['eng']}) > 200 THEN 'too_long' WHEN {junk} THEN 'garbage_pattern' END"


def histogram(df: DataFrame, c: Column, name: str, top: int | None = None) -> DataFrame:
    """Counts per value, the most frequent first (ties by value); nulls are left out."""
    # the null group counts 0; a filter on the value itself would be pushed down and the value computed twice
    out = df.select(c.alias(name)).groupBy(name).agg(F.count(name).alias("n")).where("n > 0")
    return out.orderBy(F.desc("n"), name).limit(top) if top else out


JUDGE_SCHEMA = "is_valid_alignment boolean, is_atomic boolean, quality_score double, issues array<string>, fixed_kaz string, fixed_rus string, fixed_eng string"


SIDES = ("kaz", "rus", "eng")


def parse_verdict(reply: Column) -> Column:
    """The first flat JSON object in a judge's reply; a reply without one is valid with 0.7 (the judge must not lose rows)."""
    got = F.from_json(F.regexp_extract(reply, r"(?s)\{[^{}]*\}", 0), JUDGE_SCHEMA)
    ok = got["quality_score"].isNotNull() | got["is_valid_alignment"].isNotNull()
    usual = (("is_valid_alignment", True), ("is_atomic", True), ("quality_score", 0.7))
    return F.struct(*(F.when(ok, F.coalesce(got[k], F.lit(v))).otherwise(v).alias(k) for k, v in usual), *(F.when(ok, got[f"fixed_{x}"]).alias(f"fixed_{x}") for x in SIDES))


def gated(df: DataFrame, reply: str, least: float = 0.6) -> DataFrame:
    """The triplets a judge lets pass, by the replies in a column, with its corrections of all three sides and its score."""
    rest = [c for c in df.columns if c not in (*SIDES, reply)]
    v = df.withColumn("__v", parse_verdict(F.col(reply)))
    passed = v.where(F.col("__v.is_valid_alignment") & F.col("__v.is_atomic") & (F.col("__v.quality_score") >= least))
    return passed.select(*rest, *(F.coalesce(F.nullif(F.col(f"__v.fixed_{x}"), F.lit("")), F.col(x)).alias(x) for x in SIDES), F.col("__v.quality_score").alias("llm_quality_score"))


# What a judge is asked
JUDGE_PROMPT = (
    "Check this translation triplet.\n\nKazakh: ", "\nRussian: ", "\nEnglish: ",
    "\n\nAre the texts translations of each other? Is each one unit and not several sentences merged? Are there recognition errors to correct?\nAnswer with one JSON object alone: "
    '{"is_valid_alignment": true/false, "is_atomic": true/false, "quality_score": 0.0-1.0, "issues": [], "fixed_kaz": text or null, "fixed_rus": text or null, "fixed_eng": text or null}',
)


def judge_prompt() -> Column:
    """The question about a triplet; missing sides are asked about as empty."""
    parts = []
    for p, x in zip(JUDGE_PROMPT, SIDES, strict=False):
        parts += [F.lit(p), F.coalesce(F.col(x), F.lit(""))]
    return F.concat(*parts, F.lit(JUDGE_PROMPT[3]))


def judge_prompt_sql() -> str:
    return " || ".join(f"{quoted(p)} || coalesce({x}, '')" for p, x in zip(JUDGE_PROMPT, SIDES, strict=False)) + f" || {quoted(JUDGE_PROMPT[3])}"


def judged(df: DataFrame, judge: Judge, least: float = 0.6) -> DataFrame:
    """Asks a judge about each triplet and keeps those it lets pass, corrected."""
    return gated(df.withColumn("__reply", answered(judge_prompt(), judge)), "__reply", least)


def basic_counters(df: DataFrame) -> DataFrame:
    """One row on the first version's filter: rows, each kind of rejection, rows kept, and their share."""
    r = df.select(basic_reason().alias("r"))
    count = lambda *names: F.count_if(F.coalesce(F.col("r").isin(*names), F.lit(False)))
    out = r.agg(F.count(F.lit(1)).alias("rows"), count("missing_kaz", "missing_both_targets").alias("null_filtered"), count("too_short").alias("too_short"), count("too_long").alias("too_long"), count("garbage_pattern").alias("garbage"), F.count_if(F.col("r").isNull()).alias("kept"))
    return out.select("*", F.round(F.try_divide("kept", "rows"), 6).alias("rate"))
