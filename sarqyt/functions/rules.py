"""Ordered rewriting rules that exist once and run in two engines: as Spark columns and as SQL text for the oracle.

Classes are spelled out, because the engines differ in what ``\\s``, ``\\w`` and ``\\d`` cover.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NOT_WS = WS.replace("[", "[^", 1)
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"
CYR_LOW = "а-яәіңғүұқөһ"
CYR_UP = "А-ЯӘІҢҒҮҰҚӨҺ"


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@dataclass(frozen=True)
class Rule:
    """One global replacement; groups are written ``\\1``. ``fold`` ignores case."""

    pattern: str
    to: str = ""
    fold: bool = False

    def spark(self, c: Column) -> Column:
        return F.regexp_replace(c, ("(?iu)" if self.fold else "") + self.pattern, self.to.replace("\\", "$"))

    def sql(self, e: str) -> str:
        return f"regexp_replace({e}, {quoted(('(?i)' if self.fold else '') + self.pattern)}, {quoted(self.to)}, 'g')"


STRIP = Rule(f"^{WS}+|{WS}+$")
SPACES = Rule(f"{WS}+", " ")


@dataclass(frozen=True)
class Rules:
    """Rules applied one after another."""

    steps: tuple[Rule, ...]

    def spark(self, c: Column) -> Column:
        for s in self.steps:
            c = s.spark(c)
        return c

    def sql(self, e: str) -> str:
        for s in self.steps:
            e = s.sql(e)
        return e


def rules(*steps: Rule | Rules) -> Rules:
    out: list[Rule] = []
    for s in steps:
        out += s.steps if isinstance(s, Rules) else [s]
    return Rules(tuple(out))


def words(c: Column) -> Column:
    """The parts between white space, none of them empty."""
    return F.filter(F.split(c, f"{WS}+"), lambda w: w != "")


def words_sql(e: str) -> str:
    return f"list_filter(string_split_regex({e}, {quoted(WS + '+')}), lambda w: w <> '')"


def word_count(c: Column) -> Column:
    return F.size(words(c))


def word_count_sql(e: str) -> str:
    return f"len({words_sql(e)})"


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def count_of_sql(e: str, pattern: str) -> str:
    return f"len(regexp_extract_all({e}, {quoted(pattern)}))"
