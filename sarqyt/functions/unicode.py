"""Compatibility forms, which Spark has no function for: an Arrow UDF that only texts with such characters reach."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: t if t is None else unicodedata.normalize("NFKC", t))


def nfkc(c: Column) -> Column:
    """Compatibility composition; texts of ASCII characters alone, and nulls, are their own."""
    return F.when(F.rlike(c, F.lit(r"[^\x00-\x7F]")), _nfkc(F.when(F.rlike(c, F.lit(r"[^\x00-\x7F]")), c))).otherwise(c)


def nfkc_sql(e: str) -> str:
    """The same in SQL: each character with a compatibility form of its own is replaced by it, then all is composed."""
    forms = {}
    for i in range(0x80, 0x10000):
        c = chr(i)
        if not 0xD800 <= i < 0xE000 and not 0xAC00 <= i < 0xD7A4 and unicodedata.decomposition(c).startswith("<"):
            forms[c] = unicodedata.normalize("NFKC", c)
    q = lambda s: "'" + s.replace("'", "''") + "'"
    table = "MAP {" + ", ".join(f"{q(c)}: {q(to)}" for c, to in forms.items()) + "}"
    return f"nfc_normalize(array_to_string(list_transform(string_split({e}, ''), lambda c: coalesce({table}[c], c)), ''))"
