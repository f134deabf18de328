"""Problem 2: one consistent form for text that looks alike.

DuckDB runs inside Arrow partitions: each record batch is a DuckDB relation, and one embedded SQL statement brings all
its text columns to one form with ``nfc_normalize``, ``translate`` and regular expressions. The same SQL serves as the
oracle on whole tables.

Steps: canonical composition; compatibility forms (full width, ligatures) and space or hyphen variants become the plain
character; invisible characters go; then, word by word, look-alike letters of another script become those of the
word's own script. A word that is wholly in its own foreign script (an abbreviation) stays.

Defined results: null stays null, the empty text stays empty; every text is handled whole, whatever its length.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarqyt.session import spread

# Look-alike letters. Position i of each string looks like position i of its partner.
LATIN = "ABCEHIKMOPTXYSJaceiopxyhsjəɵ"
CYRILLIC = "АВСЕНІКМОРТХУЅЈасеіорхуһѕјәө"
GREEK = "ΑΒΕΗΙΚΜΝΟΡΤΧΥΖοανρικυχ"
GREEK_LATIN = "ABEHIKMNOPTXYZoavpikux"
# of these, those that look like a Cyrillic letter
GREEK_TOO = "ΑΒΕΗΙΚΜΟΡΤΧΥοαρικυχ"
GREEK_CYRILLIC = "АВЕНІКМОРТХУоарікух"
SPACES = "\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
HYPHENS = "\u2010\u2011\ufe63"
INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\u2066-\u206f\ufe00-\ufe0f\ufeff"


def _same_look() -> tuple[str, str, dict[str, str]]:
    """Characters that are other ones in another dress: full width and letters of mathematical alphabets (one for one), and
    ligatures and Roman numerals (several for one). Fractions, raised figures and signs such as the numero sign do not look
    like what they decompose into, and stay."""
    one, plain, more = "", "", {}
    for i in (*range(0xFB00, 0xFB07), *range(0x2160, 0x2180), *range(0xFF01, 0xFF5F), *range(0x2102, 0x2140), *range(0x1D400, 0x1D800)):
        c = chr(i)
        kind, to = unicodedata.decomposition(c).partition(">")[0], unicodedata.normalize("NFKC", c)
        written_as = kind == "<compat" and not 0x2102 <= i < 0x2140
        if len(to) == 1 and (written_as or kind in ("<wide", "<font")):
            one, plain = one + c, plain + to
        elif written_as:
            more[c] = to
    return one, plain, more


DRESSED, PLAIN, LIGATURES = _same_look()


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def compat_sql(x: str) -> str:
    """Canonical composition, compatibility forms and invisible characters, as a DuckDB expression."""
    e = f"regexp_replace({x}, '[{INVISIBLE}]', '', 'g')"
    e = f"translate({e}, {_q(DRESSED + SPACES + HYPHENS)}, {_q(PLAIN + ' ' * len(SPACES) + '-' * len(HYPHENS))})"
    for k, v in LIGATURES.items():
        e = f"replace({e}, {_q(k)}, {_q(v)})"
    # most texts have ordinary characters alone, on which all this changes nothing
    return f"CASE WHEN regexp_matches({x}, '[^\\x{{00}}-\\x{{7F}}\\x{{0400}}-\\x{{04FF}}«»–—№•¬]') THEN nfc_normalize({e}) ELSE {x} END"


def _by_word(x: str, suspect: str, word: str) -> str:
    """Rewrites the words of texts that match ``suspect`` by the expression ``word`` over ``w``; other texts stay."""
    parts = f"regexp_extract_all({x}, '[\\p{{L}}\\p{{M}}]+|[^\\p{{L}}\\p{{M}}]+')"
    return f"CASE WHEN regexp_matches({x}, '{suspect}') THEN array_to_string(list_transform({parts}, lambda w: {word}), '') ELSE {x} END"


def cyrillic_sql(x: str) -> str:
    """Look-alikes in a field that is ordinarily Cyrillic: inside a word with Cyrillic letters, and in lower-case words
    made only of look-alikes, Latin and Greek letters become Cyrillic; in a Latin word, Cyrillic and Greek ones Latin."""
    to_cyr = f"translate(translate(w, {_q(GREEK_TOO)}, {_q(GREEK_CYRILLIC)}), {_q(LATIN)}, {_q(CYRILLIC)})"
    to_lat = f"translate(translate(w, {_q(GREEK)}, {_q(GREEK_LATIN)}), {_q(CYRILLIC)}, {_q(LATIN)})"
    own = "regexp_matches(w, '[\\x{0400}-\\x{052F}]')"
    only_like = f"regexp_matches(w, '^[{''.join(c for c in LATIN if c.islower())}]+$')"
    foreign = "regexp_matches(w, '[A-Za-z\\x{0370}-\\x{03FF}əɵƏƟ]')"
    # a Latin abbreviation with a strange letter in it has letters that exist in Latin alone
    latin = "regexp_matches(w, '[DFGJLNQRSUVWZ]')"
    word = f"CASE WHEN NOT {foreign} THEN w WHEN {latin} AND {own} AND NOT regexp_matches(w, '[а-яё]') THEN {to_lat} WHEN {own} OR {only_like} THEN {to_cyr} WHEN {latin} THEN {to_lat} WHEN regexp_matches(w, '[\\x{{0370}}-\\x{{03FF}}]') THEN {to_cyr} ELSE w END"
    return _by_word(x, "[A-Za-z\\x{0370}-\\x{03FF}əɵƏƟ]", word)


def latin_sql(x: str) -> str:
    """Look-alikes in a field that is ordinarily Latin: Cyrillic and Greek letters become Latin, unless the word has
    letters that no Latin letter looks like (a word in its own script)."""
    to_lat = f"translate(translate(translate(w, {_q(GREEK)}, {_q(GREEK_LATIN)}), {_q(CYRILLIC)}, {_q(LATIN)}), 'Ү', 'Y')"
    word = f"CASE WHEN regexp_matches(w, '[\\x{{0370}}-\\x{{052F}}]') AND (regexp_matches(w, '[A-Za-z]') OR NOT regexp_matches({to_lat}, '[\\x{{0370}}-\\x{{052F}}]')) THEN {to_lat} ELSE w END"
    return _by_word(x, "[\\x{0370}-\\x{052F}]", word)


def repair_sql(column: str, script: str) -> str:
    """The whole repair of ``column`` as one DuckDB expression; ``script`` is cyrillic or latin."""
    return (cyrillic_sql if script == "cyrillic" else latin_sql)(compat_sql(f'"{column}"'))


SCRIPTS = {"kaz": "cyrillic", "rus": "cyrillic", "eng": "latin"}


def connect():
    """A DuckDB connection of modest size for use inside one Python worker."""
    import duckdb

    return duckdb.connect(config={"threads": 1, "memory_limit": "256MB", "preserve_insertion_order": True})


def repair_table(con, batch: pa.Table, scripts: dict[str, str], keep: list[str]) -> pa.Table:
    """Runs the embedded SQL on one Arrow table."""
    con.register("batch", batch)
    # two levels, so that the composed text is computed once
    inner = ", ".join([f'"{k}"' for k in keep] + [f'"{c}", {compat_sql(chr(34) + c + chr(34))} AS "{c}__c"' for c in scripts])
    outer = ", ".join([f'"{k}"' for k in keep] + [f'"{c}", {(cyrillic_sql if s == "cyrillic" else latin_sql)(chr(34) + c + "__c" + chr(34))} AS "{c}__fixed"' for c, s in scripts.items()])
    out = con.sql(f"SELECT {outer} FROM (SELECT {inner} FROM batch)").to_arrow_table()
    con.unregister("batch")
    return out


def repaired(df: DataFrame, key: str, scripts: dict[str, str] | None = None) -> DataFrame:
    """``key`` and, for each text column, its consistent form."""
    scripts = scripts or SCRIPTS
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = connect()
        for b in batches:
            t = repair_table(con, pa.Table.from_batches([b]), scripts, [key])
            yield from t.select([key, *(f"{c}__fixed" for c in scripts)]).rename_columns([key, *scripts]).combine_chunks().to_batches()

    return spread(df.select(key, *scripts), key).mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"`{c}` string" for c in scripts))


def found(df: DataFrame, key: str, scripts: dict[str, str] | None = None) -> DataFrame:
    """``(field, key)`` of every value that the repair changes."""
    scripts = scripts or SCRIPTS
    kind = df.schema[key].dataType.simpleString()
    pick = " UNION ALL ".join(f"""SELECT '{c}' AS field, "{key}" FROM fixed WHERE "{c}" <> "{c}__fixed" """ for c in scripts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = connect()
        for b in batches:
            con.register("fixed", repair_table(con, pa.Table.from_batches([b]), scripts, [key]))
            yield from con.sql(pick).to_arrow_table().combine_chunks().to_batches()
            con.unregister("fixed")

    return spread(df.select(key, *scripts), key).mapInArrow(run, f"field string, `{key}` {kind}").distinct()
