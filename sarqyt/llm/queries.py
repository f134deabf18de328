"""Queries of the llm subpackage: name -> (spark, sf_dir) -> DataFrame, and SQL to check those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sarqyt.llm import abuse, bilingual, garbled, leaks, lookalikes, near_duplicates, packing, page_noise, sentence_ends, site_lines
from sarqyt.sources.tables import table

# where the vocabulary files of public tokenizers lie
TOKENIZERS = os.environ.get("SARQYT_TOKENIZERS", "/opt/tokenizers")
TOKENIZER = f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken"
Query = Callable[[SparkSession, str], DataFrame]


def _tables(s: SparkSession, d: str, *names: str) -> list[DataFrame]:
    return [table(s, d, n) for n in names]


def queries() -> dict[str, Query]:
    scans = ("extraction_results", "aligned_corpus")
    cut = ("extraction_results", "sentences_kaz")
    bilingual_tables = ("sentences_kaz", "sentences_rus", "sentences_eng", "aligned_corpus", "glossary")
    rated = ("documents", "doc_labels")
    return {
        "p1_found": lambda s, d: page_noise.found(*_tables(s, d, *scans)),
        "p1_repaired": lambda s, d: page_noise.repaired(*_tables(s, d, *scans)),
        "p2_found": lambda s, d: lookalikes.found(table(s, d, "aligned_corpus"), "row_id"),
        "p2_repaired": lambda s, d: lookalikes.repaired(table(s, d, "aligned_corpus"), "row_id"),
        "p3_found": lambda s, d: bilingual.found(*_tables(s, d, *bilingual_tables)),
        "p4_found": lambda s, d: site_lines.found(table(s, d, "sentences_kaz"), "sent_id"),
        "p4_cleaned": lambda s, d: site_lines.cleaned(table(s, d, "sentences_kaz"), "sent_id").select("sent_id", "collection", "source_file", "sentence_idx", "text"),
        "p4_blocks": lambda s, d: site_lines.blocks(table(s, d, "sentences_kaz"), "sent_id"),
        "p5_found": lambda s, d: garbled.found(table(s, d, "extraction_results")),
        "p5_restored": lambda s, d: garbled.restored(table(s, d, "extraction_results")),
        "p6_found": lambda s, d: sentence_ends.found(*_tables(s, d, *cut)),
        "p6_units": lambda s, d: sentence_ends.units(*_tables(s, d, *cut)),
        "p7_found": lambda s, d: near_duplicates.found(table(s, d, "aligned_corpus"), "row_id"),
        "p7_groups": lambda s, d: near_duplicates.groups(table(s, d, "aligned_corpus"), "row_id"),
        "p8_containers": lambda s, d: packing.containers(table(s, d, "documents"), "doc_id", tokenizer=TOKENIZER),
        "p8_fill": lambda s, d: packing.fill(packing.containers(table(s, d, "documents"), "doc_id", tokenizer=TOKENIZER)),
        "p9_found": lambda s, d: leaks.found(*_tables(s, d, "documents", "benchmark_items")),
        "p9_leaks": lambda s, d: leaks.leaks(*_tables(s, d, "documents", "benchmark_items"), "doc_id", "item_id"),
        "p10_found": lambda s, d: abuse.found(*_tables(s, d, *rated)),
        "p10_scores": lambda s, d: abuse.scored(*_tables(s, d, *rated)),
        "p10_rates": lambda s, d: abuse.rates(*_tables(s, d, *rated)),
    }


_P4 = r"""
WITH s AS (SELECT *, lower(regexp_replace(text, '[^\p{L}]+', '', 'g')) AS line FROM sentences_kaz),
t AS (SELECT collection, count(DISTINCT source_file) AS total FROM s GROUP BY 1),
k AS (SELECT collection, line, count(DISTINCT source_file) AS files FROM s WHERE line <> '' GROUP BY 1, 2),
kept AS (SELECT collection, line FROM k JOIN t USING (collection) WHERE files >= 4 AND files * 5 >= total)
"""
_P4_BLOCKS = (
    _P4
    + r"""
, o AS (SELECT s.collection, s.source_file, s.line, s.sentence_idx, lead(s.line) OVER w AS next, lead(s.sentence_idx) OVER w AS place FROM s JOIN kept USING (collection, line) WHERE source_file IS NOT NULL AND sentence_idx IS NOT NULL WINDOW w AS (PARTITION BY collection, source_file ORDER BY sentence_idx, sent_id)),
e AS (SELECT collection, line AS a, next AS b FROM o JOIN t USING (collection) WHERE place - sentence_idx <= 1 AND line <> next GROUP BY collection, line, next, total HAVING count(DISTINCT source_file) >= 4 AND count(DISTINCT source_file) * 5 >= total),
u AS (SELECT * FROM e UNION SELECT collection, b, a FROM e),
r AS (SELECT collection, line AS a, line AS b FROM kept UNION SELECT r.collection, r.a, u.b FROM r JOIN u ON u.collection = r.collection AND u.a = r.b)
SELECT k.collection, k.line, k.files, min(r.b) AS block FROM k JOIN kept USING (collection, line) JOIN r ON r.collection = k.collection AND r.a = k.line GROUP BY ALL
"""
).replace("WITH s AS", "WITH RECURSIVE s AS", 1)


def _p7(columns: str, tail: str) -> str:
    """Every pair of rows that share a run, its similarity, and what such links reach, by brute force."""
    fixed = ", ".join(f"{lookalikes.repair_sql(c, s)} AS {c}" for c, s in lookalikes.SCRIPTS.items())
    words = lambda c: f"list_transform(regexp_extract_all({c}, '[\\p{{L}}\\p{{N}}]+'), lambda w: lower(w))"
    runs = " UNION ALL ".join(f"SELECT row_id, '{c}' || array_to_string(w[p:p + 2], ' ') AS g FROM (SELECT row_id, {words(c)} AS w FROM f), unnest(range(1, len(w) - 1)) u(p)" for c in lookalikes.SCRIPTS)
    return f"""WITH RECURSIVE f AS (SELECT row_id, {fixed} FROM aligned_corpus), g AS (SELECT DISTINCT row_id, g FROM ({runs})), n AS (SELECT row_id, count(*) AS n FROM g GROUP BY 1),
    s AS (SELECT a.row_id AS a, b.row_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.row_id < b.row_id GROUP BY 1, 2),
    l AS (SELECT s.a, s.b FROM s JOIN n x ON x.row_id = s.a JOIN n y ON y.row_id = s.b WHERE s.c >= 0.6 * (x.n + y.n - s.c) - 1e-9),
    u AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r AS (SELECT row_id AS a, row_id AS b FROM n UNION SELECT r.a, u.b FROM r JOIN u ON u.a = r.b)
    SELECT {columns} FROM r {tail}"""


_P9 = r"""
WITH d AS (SELECT doc_id, list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+'), lambda w: lower(w)) AS w FROM documents),
i AS (SELECT item_id, list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+'), lambda w: lower(w)) AS w FROM benchmark_items),
ir AS (SELECT DISTINCT item_id, array_to_string(w[p:p + 7], ' ') AS g FROM i, unnest(range(1, len(w) - 6)) u(p)),
dr AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 7], ' ') AS g FROM d, unnest(range(1, len(w) - 6)) u(p)),
n AS (SELECT item_id, count(*) AS runs FROM ir GROUP BY 1)
SELECT doc_id, item_id, count(*) AS shared, runs FROM dr JOIN ir USING (g) JOIN n USING (item_id) GROUP BY doc_id, item_id, runs HAVING count(*) * 5 >= runs
"""


def oracle_sql() -> dict[str, str]:
    fixed = {c: lookalikes.repair_sql(c, s) for c, s in lookalikes.SCRIPTS.items()}
    return {
        "p2_found": " UNION ".join(f"SELECT '{c}' AS field, row_id FROM aligned_corpus WHERE {c} <> {e}" for c, e in fixed.items()),
        "p2_repaired": "SELECT row_id, " + ", ".join(f"{e} AS {c}" for c, e in fixed.items()) + " FROM aligned_corpus",
        "p4_found": _P4 + "SELECT DISTINCT sent_id FROM s JOIN kept USING (collection, line)",
        "p4_cleaned": _P4 + "SELECT sent_id, collection, source_file, sentence_idx, text FROM s WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.collection = s.collection AND k.line = s.line)",
        "p4_blocks": _P4_BLOCKS,
        "p7_found": _p7("a AS row_a, b AS row_b", "WHERE a < b"),
        "p7_groups": _p7("a AS row_id, min(b) AS class_id, count(*) AS class_size", "GROUP BY a"),
        "p9_found": f"SELECT doc_id, item_id FROM ({_P9})",
        "p9_leaks": _P9,
    }
