"""Text transforms of the corpus pipeline as column expressions; ``*_SQL`` helpers give the same in SQL for the oracle.

Null in, null out, everywhere; the empty text stays empty unless a function says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sarqyt.functions.rules import CYR_LOW, CYR_UP, DIGIT, NOT_WORD, SPACES, STRIP, WORD, WS, Rule, Rules, count_of, count_of_sql, quoted, rules, word_count, word_count_sql, words, words_sql

# Abbreviations whose period ends no sentence
ABBREVIATIONS = (
    "т.е", "т.б", "т.с.с", "т.д", "др", "пр", "г", "гг", "в", "млн", "млрд", "тыс", "руб", "тг", "долл", "евро", "ул", "пр-т", "д", "корп",
    "стр", "оф", "кв", "им", "проф", "акад", "доц", "канд", "д-р", "рис", "табл", "гл", "разд", "п", "пп", "ст",
    "Mr", "Mrs", "Ms", "Dr", "Prof", "Inc", "Ltd", "Corp", "vs", "etc", "i.e", "e.g", "fig", "no", "vol",
)
_ABBR = "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS)
MIN_CHARS, MAX_CHARS = 20, 2000
_IN_LINE = WS[:-1] + r"&&[^\n]]"


def is_abbreviation(c: Column) -> Column:
    """Whether a word without its final periods is listed, in any case."""
    return F.lower(F.regexp_replace(c, r"[.]+$", "")).isin([a.lower() for a in ABBREVIATIONS])


_START = r"A-ZА-ЯӘҒҚҢӨҰҮІa-zа-яәғқңөұүі\p{Nd}"

# The patterns of this file, whose results must equal the pipeline's
# --- cleaning of extracted markdown -------------------------------------------------------------------------------
PAGE_NUMBERS = rules(Rule(rf"\n{WS}*{DIGIT}+{WS}*\n", "\n"), Rule(rf"\n{WS}*Page{WS}+{DIGIT}+{WS}*(of{WS}+{DIGIT}+)?{WS}*\n", "\n", fold=True))
BLANK_LINES = Rule(r"\n{4,}", "\n\n\n")
FURNITURE_WORDS = Rule(rf"(confidential|internal use only|draft){WS}*\n", "", fold=True)
EMPTY_ROWS = Rule(rf"\|{WS}*\|{WS}*\|{WS}*\|")
CLEAN_MARKDOWN = rules(PAGE_NUMBERS, BLANK_LINES, FURNITURE_WORDS, EMPTY_ROWS, STRIP)


def named_glyphs() -> dict[str, str]:
    """The 66 named Cyrillic glyphs: their numbers follow the alphabet, with YO after IE, from 10017 and from 10065."""
    out = {}
    for base, yo, first in ((10017, "Ё", 0x410), (10065, "ё", 0x430)):
        alphabet = [chr(first + i) for i in range(32)]
        alphabet.insert(6, yo)
        out |= {f"/afii{base + i}": c for i, c in enumerate(alphabet)}
    return out


def decode_named_glyphs(c: Column) -> Column:
    for name, letter in named_glyphs().items():
        c = F.replace(c, F.lit(name), F.lit(letter))
    return c


def decode_named_glyphs_sql(e: str) -> str:
    for name, letter in named_glyphs().items():
        e = f"replace({e}, '{name}', '{letter}')"
    return e


def decode_escapes(c: Column) -> Column:
    """``/uniXXXX`` and ``\\uniXXXX`` to the character of that number, in the JVM: the text is cut at the escapes, and the
    four digits after each are decoded as UTF-16. Longer numbers are read as four digits and a rest."""
    parts = F.split(c, r"[/\\]uni(?=[0-9A-Fa-f]{4})")
    decoded = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.concat(F.decode(F.unhex(F.substring(p, 1, 4)), "UTF-16BE"), F.substring(p, 5, 2_000_000_000)))
    return F.concat(parts[0], F.array_join(decoded, ""))


def decode_escapes_sql(e: str) -> str:
    return rf"""list_aggregate(list_transform(string_split(regexp_replace({e}, '[/\\]uni([0-9A-Fa-f]{{4}})', chr(30) || '\1', 'g'), chr(30)), lambda p, i: CASE WHEN i = 1 THEN p ELSE chr(CAST('0x' || p[1:4] AS INTEGER)) || p[5:] END), 'string_agg', '')"""


def clean_markdown(c: Column) -> Column:
    """The whole cleaning of extracted text: glyph escapes, named glyphs, page numbers, blank lines, furniture, empty rows."""
    return CLEAN_MARKDOWN.spark(decode_named_glyphs(decode_escapes(c)))


def clean_markdown_sql(e: str) -> str:
    return CLEAN_MARKDOWN.sql(decode_named_glyphs_sql(decode_escapes_sql(e)))


def without_tables(c: Column) -> Column:
    """Drops table blocks: a line that starts with a pipe opens one, the next blank line closes it and goes too. Row-local
    and linear: a text is cut before its blank lines; of each part what stands before its first table line stays, and
    the blank line at its head unless the part before it had a table."""
    parts = F.split(c, rf"\n(?={_IN_LINE}*(?:\n|\z))")
    table = rf"(?s)(?:^|(?<=\n)){_IN_LINE}*\|.*"

    def kept(part: Column, i: Column) -> Column:
        body = F.regexp_replace(part, rf"(?s)(?:^|\n){_IN_LINE}*\|.*\z", "")
        closed = (i > 0) & F.rlike(F.get(parts, i - 1), F.lit(table))
        # lines that are left: none where a table opens the text, or closes with nothing after the blank line
        none = F.rlike(part, F.lit(rf"^{_IN_LINE}*\|")) | (closed & (F.locate("\n", body) == 0))
        return F.when(~none, F.when(closed, F.substring(body, F.locate("\n", body) + 1, F.length(body))).otherwise(body))

    return F.array_join(F.filter(F.transform(parts, kept), lambda x: x.isNotNull()), "\n")


def has_kazakh_letters(filename: Column, text: Column) -> Column:
    """False where a file that should be Kazakh has none of the letters that only Kazakh has."""
    return ~(F.contains(filename, F.lit("_KAZ")) & (F.length(text) > 100) & ~F.rlike(text, F.lit("[ӘәҒғҚқҢңӨөҰұҮүІі]")))


# --- file names ---------------------------------------------------------------------------------------------------
def language_of(filename: Column) -> Column:
    up = F.upper(filename)
    return F.when(F.contains(up, F.lit("_KAZ")), "kaz").when(F.contains(up, F.lit("_RUS")), "rus").when(F.contains(up, F.lit("_ENG")), "eng").otherwise("unknown")


LANGUAGE_SQL = "CASE WHEN contains(upper({0}), '_KAZ') THEN 'kaz' WHEN contains(upper({0}), '_RUS') THEN 'rus' WHEN contains(upper({0}), '_ENG') THEN 'eng' ELSE 'unknown' END"
# What names a type or a company in a file name, in order
TYPES = (("Annual_Report", ("annual", "report", "годовой", "отчет", "жылдық")), ("Sustainability_Report", ("sustainab", "устойчив", "esg")), ("Research_Program", ("research", "исследов", "program", "программ")))
COMPANIES = (("Halyk", ("halyk", "халык")), ("Kazahtelekom", ("telecom", "телеком", "kaz_telecom")), ("Baiterek", ("baiterek", "байтерек")), ("KEGOC", ("kegoc", "кегок")), ("National_Bank", ("national", "bank", "нацбанк", "национальн")))
SOURCES = (("Halyk Bank", ("halyk",)), ("KEGOC", ("kegoc",)), ("Казахтелеком", ("казахтелеком", "kazakhtelecom")), ("Air Astana", ("air_astana",)), ("Kaspi", ("kaspi",)), ("Kcell", ("kcell",)), ("KMG", ("kmg",)), ("Samruk-Kazyna", ("samruk",)))


def first_named(c: Column, table: tuple) -> Column:
    """The first name in the table one of whose patterns is in the lower-cased text, else null."""
    low, out = F.lower(c), None
    for name, patterns in table:
        hit = F.lit(False)
        for p in patterns:
            hit = hit | F.contains(low, F.lit(p))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def first_named_sql(e: str, table: tuple) -> str:
    return "CASE " + " ".join("WHEN " + " OR ".join(f"contains(lower({e}), {quoted(p)})" for p in patterns) + f" THEN {quoted(name)}" for name, patterns in table) + " END"


YEAR = r"^[0-9]{4}(-[0-9]{4})?$"


def year_of(filename: Column) -> Column:
    """The first part of the stem that is a year or a range of years."""
    return F.get(F.filter(F.split(F.regexp_replace(filename, r"\.md$", ""), "_"), lambda p: F.rlike(p, F.lit(YEAR))), F.lit(0))


def year_of_sql(e: str) -> str:
    return f"list_filter(string_split(regexp_replace({e}, '\\.md$', ''), '_'), lambda p: regexp_matches(p, '{YEAR}'))[1]"


def document_id(filename: Column) -> Column:
    return F.replace(F.regexp_replace(filename, r"_[^_]*$", ""), F.lit(".md"), F.lit(""))


def document_id_sql(e: str) -> str:
    return f"replace(regexp_replace({e}, '_[^_]*$', ''), '.md', '')"


# --- sentences ----------------------------------------------------------------------------------------------------
def _recase(pattern: str, abbreviation: str):
    return lambda p: F.regexp_replace(p, pattern, f"{abbreviation}.")


def split_sentences(c: Column, compat: str = "fixed") -> Column:
    """Sentences of a text as an array. A boundary is white space after ``.!?`` (unless the period belongs to an
    abbreviation) and before a letter or digit. Pieces under 20 characters go; pieces over 2000 are cut at ``. `` again.

    ``fixed`` leaves abbreviations as they are spelled; ``faithful`` also rewrites each to its listed case."""
    t = SPACES.spark(c)
    pieces = F.split(t, rf"(?<=[.!?])(?<!(?iu:(?<![\p{{L}}\p{{N}}_])(?:{_ABBR})\.)) (?=[{_START}])")
    if compat == "faithful":
        for a in ABBREVIATIONS:
            pat = rf"(?iu)(?<![\p{{L}}\p{{N}}_]){a.replace('.', chr(92) + '.')}\.(?= |$)"
            pieces = F.transform(pieces, _recase(pat, a))
    stripped = F.filter(F.transform(pieces, STRIP.spark), lambda p: F.length(p) >= MIN_CHARS)

    def again(p: Column) -> Column:
        return F.when(F.length(p) <= MAX_CHARS, F.array(p)).otherwise(F.filter(F.transform(F.split(p, r"\. "), STRIP.spark), lambda q: F.length(q).between(MIN_CHARS, MAX_CHARS)))

    return F.flatten(F.transform(stripped, again))


def split_sentences_sql(e: str) -> str:
    t = SPACES.sql(e)
    for _ in range(2):  # neighbours share the space between them
        t = f"regexp_replace({t}, {quoted(f'(?i)(^|{NOT_WORD})({_ABBR})[.]( |$)')}, '\\1\\2' || chr(31) || '\\3', 'g')"
    t = f"regexp_replace({t}, {quoted(f'([.!?]) ([{_START}])')}, '\\1' || chr(30) || '\\2', 'g')"
    pieces = f"list_transform(string_split({t}, chr(30)), lambda p: {STRIP.sql('replace(p, chr(31), chr(46))')})"
    good = f"list_filter({pieces}, lambda p: length(p) >= {MIN_CHARS})"
    inner = STRIP.sql("q")
    return f"flatten(list_transform({good}, lambda p: CASE WHEN length(p) <= {MAX_CHARS} THEN [p] ELSE list_filter(list_transform(string_split(p, '. '), lambda q: {inner}), lambda q: length(q) BETWEEN {MIN_CHARS} AND {MAX_CHARS}) END))"


CLEAN_SENTENCE = rules(Rule(r"\*\*|__|~~|`"), Rule(r"\[([^\]]+)\]\([^\)]+\)", r"\1"), Rule(rf"^#+{WS}*"), Rule(rf"^[\-\*\+]{WS}*"), Rule(rf"^{DIGIT}+\.{WS}*"), SPACES, STRIP)
_ALPHA = "[a-zA-Zа-яА-ЯәғқңөұүіӘҒҚҢӨҰҮІ]"
_GARBAGE = (r"^[\p{Nd}" + WS[1:-1] + r".,\-]+$", f"^[A-Z{WS[1:-1]}]+$", "©|®|™", r"www\.|http")


def valid_sentence(c: Column) -> Column:
    """Long enough, at least three words, at most ten numbers, half of it letters, no garbage."""
    bad = F.lit(False)
    for p in _GARBAGE:
        bad = bad | F.rlike(c, F.lit(p))
    return (F.length(c) >= MIN_CHARS) & (word_count(c) >= 3) & (count_of(c, DIGIT + "+") <= 10) & (count_of(c, _ALPHA) >= F.length(c) * 0.5) & ~bad


def valid_sentence_sql(e: str) -> str:
    bad = " OR ".join(f"regexp_matches({e}, {quoted(p)})" for p in _GARBAGE)
    return f"(length({e}) >= {MIN_CHARS} AND {word_count_sql(e)} >= 3 AND {count_of_sql(e, DIGIT + '+')} <= 10 AND {count_of_sql(e, _ALPHA)} >= length({e}) * 0.5 AND NOT ({bad}))"


# --- repair, first version: kept for its results alone, some of its rules are known to be wrong -------------------
OCR_REPAIR = rules(
    Rule(rf"Hal{WS}*yk", "Halyk"), Rule("Hal yk", "Halyk"), Rule("GrOup", "Group"), Rule("GrOUp", "Group"), Rule("GROUP", "Group"),
    Rule("Қазақста|н", "Қазақстан"), Rule("те|ңге", "теңге"), Rule(rf"({DIGIT}){WS}+({DIGIT}{{3}})", r"\1\2"), Rule("БаНК", "Банк"), Rule("БАнК", "Банк"),
    Rule(rf"([а-яәғқңөұүіА-ЯӘҒҚҢӨҰҮІ]){WS}+([а-яәғқңөұүі])", r"\1\2"), Rule(rf"{WS}{{2,}}", " "), STRIP,
)


def ocr_repair(c: Column) -> Column:
    """``(text, changed)`` of the first repair."""
    new = OCR_REPAIR.spark(c)
    return F.struct(new.alias("text"), (new != c).alias("changed"))


def round4(c: Column) -> Column:
    """Four decimals, rounded by the number's exact binary value (0.84995 is a little less than that: 0.8499), ties to even.
    The product by 10,000 is taken with its rounding error, which decides what the product alone cannot."""
    split = lambda x: (134217729.0 * x) - (134217729.0 * x - x)
    high = c * 10000.0
    a = split(c)
    low = (a * 10000.0 - high) + (c - a) * 10000.0
    base = F.floor(high)
    part = high - base
    up = (part > 0.5) | ((part == 0.5) & ((low > 0) | ((low == 0) & (F.pmod(base, F.lit(2)) == 1))))
    return (base + F.when(up, 1).otherwise(0)).cast("double") / 10000.0


# --- repair, second version ---------------------------------------------------------------------------------------
_NUMBER_LINE = r"^[\p{Nd}" + WS[1:-1] + r".,\-:()]+$"
PAGE_LINE = "|".join([rf"^{WS}*{DIGIT}+{WS}*$", rf"^(стр\.|page|бет){WS}*{DIGIT}+", rf"^{WS}*[A-ZА-ЯӘІҢҒҮҰҚӨҺ{WS[1:-1]}]{{2,50}}{WS}*{DIGIT}+{WS}*$", rf"^{DIGIT}+{WS}*/{WS}*{DIGIT}+$"])
TOC_LINE = "|".join(["содержание|content|мазмұны", rf"^{WS}*{DIGIT}+\.{DIGIT}+{WS}+", r"\.{3,}", rf"^{WS}*{DIGIT}+{WS}+[А-ЯA-ZӘІҢҒҮҰҚӨҺا-ي]"])
HEADER_LINE = rf"^{WS}*(Отчет|Report|Есеп){WS}+(об?|о|туралы)"
DOTS = Rule(r"\.{2,}")


def remove_noise(c: Column) -> Column:
    """Drops lines that are page numbers, contents entries, headers or numbers alone; joins the rest by spaces."""
    lines = F.transform(F.split(c, "\n"), STRIP.spark)
    keep = F.filter(lines, lambda s: (s != "") & ~F.rlike(s, F.lit(PAGE_LINE)) & ~F.rlike(s, F.lit(TOC_LINE)) & ~F.rlike(s, F.lit("(?iu)" + HEADER_LINE)) & ~F.rlike(s, F.lit(_NUMBER_LINE)))
    return rules(DOTS, SPACES, STRIP).spark(F.array_join(keep, " "))


def remove_noise_sql(e: str) -> str:
    lines = f"list_transform(string_split({e}, chr(10)), lambda s: {STRIP.sql('s')})"
    keep = f"list_filter({lines}, lambda s: s <> '' AND NOT regexp_matches(s, {quoted(PAGE_LINE)}) AND NOT regexp_matches(s, {quoted(TOC_LINE)}) AND NOT regexp_matches(s, {quoted('(?i)' + HEADER_LINE)}) AND NOT regexp_matches(s, {quoted(_NUMBER_LINE)}))"
    return rules(DOTS, SPACES, STRIP).sql(f"array_to_string({keep}, ' ')")


HYPHENS = rules(Rule(rf"({WORD}+){WS}+-{WS}+({WORD}+)", r"\1\2"), Rule(rf"({WORD}+)-{WS}+({WORD}+)", r"\1\2"), Rule(rf"({WORD}+){WS}+-({WORD}+)", r"\1\2"))
_FRAGMENTS = [Rule(rf"(?<![\p{{L}}\p{{N}}_])([{CYR_UP}]{{{n}}}){WS}+([{CYR_LOW}]{{2,}})(?![\p{{L}}\p{{N}}_])", r"\1\2") for n in (1, 2)]
SPACING = rules(*(_FRAGMENTS * 3), SPACES)
# the same without look-around, each rule twice since neighbours share a character
_FRAGMENTS_SQL = [Rule(rf"(^|{NOT_WORD})([{CYR_UP}]{{{n}}}){WS}+([{CYR_LOW}]{{2,}})({NOT_WORD}|$)", r"\1\2\3\4") for n in (1, 2)]
SPACING_SQL = rules(*([x for r in _FRAGMENTS_SQL for x in (r, r)] * 3), SPACES)
_BROKEN_CASE = f"[{CYR_LOW}a-z]+[{CYR_UP}A-Z]+[{CYR_LOW}a-z]+|[{CYR_UP}A-Z]+[{CYR_LOW}a-z]+[{CYR_UP}A-Z]+"


def fix_case(c: Column) -> Column:
    """Per word with capitals in strange places: mostly small letters become all small; long words of mostly capitals keep
    the first alone. Words come out separated by one space."""

    def word(w: Column) -> Column:
        small, big = count_of(w, r"\p{Ll}"), count_of(w, r"\p{Lu}")
        capital = F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1_000_000)))
        return F.when(~F.rlike(w, F.lit(_BROKEN_CASE)), w).when(small > big, F.lower(w)).when((F.length(w) > 5) & (big > (small + big) * 0.5), capital).otherwise(w)

    return F.array_join(F.transform(words(c), word), " ")


def fix_case_sql(e: str) -> str:
    small, big = count_of_sql("w", r"\p{Ll}"), count_of_sql("w", r"\p{Lu}")
    word = f"CASE WHEN NOT regexp_matches(w, {quoted(_BROKEN_CASE)}) THEN w WHEN {small} > {big} THEN lower(w) WHEN length(w) > 5 AND {big} > ({small} + {big}) * 0.5 THEN upper(w[1]) || lower(w[2:]) ELSE w END"
    return f"array_to_string(list_transform({words_sql(e)}, lambda w: {word}), ' ')"


def clean_text(c: Column) -> Column:
    """Noise, hyphens, spacing and case, in that order (compatibility forms are a stage of their own)."""
    return rules(SPACES, STRIP).spark(fix_case(SPACING.spark(HYPHENS.spark(remove_noise(c)))))


def clean_text_full(c: Column) -> Column:
    """All stages of the second repair, compatibility forms first; the empty text stays as it is."""
    from sarqyt.functions.unicode import nfkc

    return F.when(c == "", c).otherwise(clean_text(nfkc(c)))


def clean_text_sql(e: str) -> str:
    return rules(SPACES, STRIP).sql(fix_case_sql(SPACING_SQL.sql(HYPHENS.sql(remove_noise_sql(e)))))


def dedup_key(c: Column) -> Column:
    return F.lower(rules(SPACES, STRIP).spark(c))


def dedup_key_sql(e: str) -> str:
    return f"lower({rules(SPACES, STRIP).sql(e)})"


# --- prompts and answers ------------------------------------------------------------------------------------------
# Names of the languages, and the prompt's sentences
LANGUAGES = {"kaz": "Kazakh", "rus": "Russian", "eng": "English"}
DIRECTIONS = ("kaz2rus", "kaz2eng", "rus2kaz", "rus2eng", "eng2kaz", "eng2rus")
_PROMPT = "Translate the following {0} text to {1}. Provide only the translation without explanations."


def prompt(direction: str, source: Column) -> Column:
    a, b = (LANGUAGES[x] for x in direction.split("2"))
    return F.concat(F.lit(f"{_PROMPT.format(a, b)}\n\n{a}: "), source, F.lit(f"\n\n{b}:"))


def prompt_sql(direction: str, e: str) -> str:
    a, b = (LANGUAGES[x] for x in direction.split("2"))
    return f"{quoted(_PROMPT.format(a, b))} || chr(10) || chr(10) || '{a}: ' || {e} || chr(10) || chr(10) || '{b}:'"


def clean_generation(c: Column) -> Column:
    """An answer up to the first blank line or language label."""
    c = STRIP.spark(c)
    for stop in ("\n\n", *(f"{x}:" for x in LANGUAGES.values())):
        c = STRIP.spark(F.substring_index(c, stop, 1))
    return c


def clean_generation_sql(e: str) -> str:
    e = STRIP.sql(e)
    for stop in ("chr(10) || chr(10)", *(quoted(f"{x}:") for x in LANGUAGES.values())):
        e = STRIP.sql(f"string_split({e}, {stop})[1]")
    return e
