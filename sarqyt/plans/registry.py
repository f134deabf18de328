"""All core queries and their SQL oracles, by the name of the operator.

Where the tables lack what an operator acts on, the same deterministic artefact is put in by both sides (see INJECTED),
so that no query compares two texts that nothing happened to.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sarqyt.functions import text as X
from sarqyt.functions import unicode as U
from sarqyt.functions.rules import STRIP, quoted, word_count_sql
from sarqyt.operators import align, chunk, dedup, evaluation, extraction, metrics, models, preference, quality
from sarqyt.plans import pipeline
from sarqyt.session import spread
from sarqyt.sources import manifest
from sarqyt.sources.tables import table
from sarqyt.streaming import dedup as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def add(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLES[name] = sql


def wide(s: SparkSession, d: str, name: str, key: str, *columns: str) -> DataFrame:
    """Some columns of a table for CPU-heavy work: spread over the cores if its files make too few tasks."""
    return spread(table(s, d, name).select(key, *columns), key)


# --- injected artefacts: (Spark column, SQL) ----------------------------------------------------------------------
def _markdown(c: str = "markdown") -> Column:
    n = F.col("extract_id")
    return F.concat(F.col(c), F.lit("\n"), n.cast("string"), F.lit("\n"), (n + 1).cast("string"), F.lit("\n\n\n\n\n\nDraft\nPage "), n.cast("string"), F.lit(" of 9\n| | | |\ntail "), F.col(c))


_MARKDOWN = "(markdown || chr(10) || extract_id || chr(10) || (extract_id + 1) || repeat(chr(10), 6) || 'Draft' || chr(10) || 'Page ' || extract_id || ' of 9' || chr(10) || '| | | |' || chr(10) || 'tail ' || markdown)"


def _noisy() -> Column:
    """Kazakh cells with noise lines, broken hyphens, loose capitals and broken case, by row."""
    k = F.pmod(F.col("row_id"), F.lit(5))
    head = F.when(k == 0, "1.1 кіріспе\n").when(k == 1, "бет 5\nУ правление МЫ сал ").when(k == 2, "12 / 40\nполити - ка a - b - c эконо- мика ").when(k == 3, "НарОДНЫй уСТой KazTransOil теңГЕрім\n").otherwise("Отчет о чём\nжыл .... соңы\n")
    return F.concat(head, F.col("kaz"))


_NOISY = "(CASE row_id % 5 WHEN 0 THEN '1.1 кіріспе' || chr(10) WHEN 1 THEN 'бет 5' || chr(10) || 'У правление МЫ сал ' WHEN 2 THEN '12 / 40' || chr(10) || 'полити - ка a - b - c эконо- мика ' WHEN 3 THEN 'НарОДНЫй уСТой KazTransOil теңГЕрім' || chr(10) ELSE 'Отчет о чём' || chr(10) || 'жыл .... соңы' || chr(10) END || kaz)"


def _reply() -> Column:
    """A judge's answer about a triplet; without a Russian side it is no JSON."""
    body = F.concat(F.lit('{"is_valid_alignment": '), F.when(F.col("similarity_kaz_rus") >= 0.82, "true").otherwise("false"), F.lit(', "is_atomic": true, "quality_score": '), F.format_number(F.col("similarity_kaz_rus"), 4), F.lit(', "issues": [], "fixed_kaz": "'), F.col("id"), F.lit('", "fixed_rus": null, "fixed_eng": "e'), F.col("id"), F.lit('"}'))
    return F.concat(F.lit("Answer:\n"), F.when(F.col("similarity_kaz_rus").isNotNull(), body).otherwise("none {broken"))


_REPLY = """('Answer:' || chr(10) || CASE WHEN similarity_kaz_rus IS NOT NULL THEN '{"is_valid_alignment": ' || CASE WHEN similarity_kaz_rus >= 0.82 THEN 'true' ELSE 'false' END || ', "is_atomic": true, "quality_score": ' || printf('%.4f', similarity_kaz_rus) || ', "issues": [], "fixed_kaz": "' || id || '", "fixed_rus": null, "fixed_eng": "e' || id || '"}' ELSE 'none {broken' END)"""
_HAS_JSON = f"regexp_matches({_REPLY}, '[{{][^{{}}]*[}}]')"
_JSON = f"regexp_extract({_REPLY}, '[{{][^{{}}]*[}}]')"


def _lines(d: DataFrame, layout: str) -> DataFrame:
    """Manifest lines of every collection, made from its file names."""
    lang = F.regexp_extract("filename", r"_([A-Z]{3})\.md$", 1)
    word = F.when(lang == "KAZ", "Казахский (KAZ)").when(lang == "RUS", "Русский (RUS)").when(lang == "ENG", "Английский (ENG)").otherwise("Китайский (CHN)")
    year, url = F.substring("filename", 1, 4), F.concat(F.lit("https://files.example/"), F.col("filename"))
    if layout == "prefixed":
        years = F.when(F.pmod("extract_id", F.lit(4)) == 0, F.concat(year, F.lit("-"), year)).otherwise(year)
        lines = F.array(F.concat(years, F.lit(" ГОДОВЫЕ ОТЧЕТЫ:")), F.concat(lang, F.lit(": "), url), F.lit(""))
    elif layout == "ahead":
        lines = F.array(F.concat(year, F.lit(" ГОД - "), word), F.when(F.pmod("extract_id", F.lit(7)) == 0, "(ссылка)").otherwise(url), F.lit(""))
    else:
        head = F.when(F.pmod("extract_id", F.lit(3)) == 0, F.lit("")).otherwise(F.concat(year, F.lit(" ГОД - "), word))
        lines = F.array(head, F.concat(F.lit(" "), F.replace("filename", F.lit("_"), F.lit(" "))), url)
    return d.select(F.col("collection").alias("file"), F.posexplode(lines).alias("i", "line"), "extract_id").select("file", (F.col("extract_id") * 3 + F.col("i")).alias("line_no"), "line")


def _lines_sql(layout: str) -> str:
    lang = "regexp_extract(filename, '_([A-Z]{3})\\.md$', 1)"
    word = f"CASE {lang} WHEN 'KAZ' THEN 'Казахский (KAZ)' WHEN 'RUS' THEN 'Русский (RUS)' WHEN 'ENG' THEN 'Английский (ENG)' ELSE 'Китайский (CHN)' END"
    url = "'https://files.example/' || filename"
    three = {
        "prefixed": f"[filename[1:4] || CASE WHEN extract_id % 4 = 0 THEN '-' || filename[1:4] ELSE '' END || ' ГОДОВЫЕ ОТЧЕТЫ:', {lang} || ': ' || {url}, '']",
        "ahead": f"[filename[1:4] || ' ГОД - ' || {word}, CASE WHEN extract_id % 7 = 0 THEN '(ссылка)' ELSE {url} END, '']",
        "carry": f"[CASE WHEN extract_id % 3 = 0 THEN '' ELSE filename[1:4] || ' ГОД - ' || {word} END, ' ' || replace(filename, '_', ' '), {url}]",
    }[layout]
    return f"l AS (SELECT collection AS file, extract_id * 3 + i AS line_no, trim(t[i + 1]) AS line FROM (SELECT *, {three} AS t FROM extraction_results), range(3) r(i))"


_LANG_OF = "CASE WHEN contains(line, 'Казахский (KAZ)') THEN 'KAZ' WHEN contains(line, 'Русский (RUS)') THEN 'RUS' WHEN contains(line, 'Английский (ENG)') THEN 'ENG' END"
_TITLE_TYPE = "CASE WHEN contains({0}, 'устойчивом развитии') OR contains({0}, 'Sustainability') THEN 'Sustainability_Report' WHEN contains({0}, 'Годовой отчет') OR contains({0}, 'Annual Report') OR contains({0}, 'Annual_Report') THEN 'Annual_Report' WHEN contains({0}, 'Financial Statements') THEN 'Financial_Statements' ELSE 'Report' END"
_INTEGRATED = "CASE WHEN contains({0}, 'устойчивом развитии') OR contains({0}, 'Sustainability') THEN 'Sustainability_Report' WHEN contains({0}, 'Интегрирленген') OR contains({0}, 'Интегрированный') OR contains({0}, 'Integrated') THEN 'Integrated_Annual_Report' WHEN contains({0}, 'Годовой отчет') OR contains({0}, 'Annual Report') THEN 'Annual_Report' ELSE 'Report' END"


def _carry_sql(kind: str) -> str:
    return (
        "WITH " + _lines_sql("carry") + f""", h AS (SELECT *, CASE WHEN regexp_matches(line, '[0-9]{{4}}\\s+ГОД') THEN {{'y': regexp_extract(line, '([0-9]{{4}})\\s+ГОД', 1), 'g': {_LANG_OF}}} END AS head, coalesce(lag(line) OVER (PARTITION BY file ORDER BY line_no), '') AS title FROM l),
        n AS (SELECT *, last_value(head IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS now FROM h)
        SELECT file, line_no, line AS url, now.y AS year, now.g AS lang, {kind.format('title')} AS type, title FROM n WHERE head IS NULL AND starts_with(line, 'http') AND now.y IS NOT NULL AND now.g IS NOT NULL"""
    )


def _register() -> None:
    t = table
    # --- sentences of documents ---
    docs = lambda s, d: wide(s, d, "documents", "doc_id", "lang", "text")
    p_sql = f"p AS (SELECT doc_id, lang, i - 1 AS i, s[i] AS sentence FROM (SELECT doc_id, lang, {X.split_sentences_sql('text')} AS s FROM documents), unnest(range(1, len(s) + 1)) u(i))"
    c_sql = f"{p_sql}, c AS (SELECT doc_id, lang, i, {X.CLEAN_SENTENCE.sql('sentence')} AS sentence FROM p)"
    valid = X.valid_sentence_sql("sentence")
    add("split_sentences", lambda s, d: chunk.pieces(docs(s, d), "doc_id"), f"WITH {p_sql} SELECT doc_id, i AS sentence_idx, sentence FROM p")
    add("clean_sentence", lambda s, d: chunk.sentences(docs(s, d), "doc_id", valid=False).drop("ok"), f"WITH {c_sql} SELECT doc_id, i AS sentence_idx, sentence FROM c")
    add("valid_sentences", lambda s, d: chunk.sentences(docs(s, d), "doc_id").drop("ok"), f"WITH {c_sql} SELECT doc_id, i AS sentence_idx, sentence FROM c WHERE {valid}")
    add("sentence_counts_by_lang", lambda s, d: chunk.by_language(chunk.sentences(docs(s, d), "lang")), f"WITH {c_sql} SELECT coalesce(lang, 'unknown') AS lang, count(*) AS sentences FROM c WHERE {valid} GROUP BY 1")
    add("chunk_stats", lambda s, d: chunk.totals(chunk.sentences(docs(s, d), "doc_id", valid=False), "doc_id"), f"WITH {c_sql} SELECT count(DISTINCT doc_id) AS files, count(*) AS raw, count(*) FILTER (WHERE {valid}) AS valid, count(*) FILTER (WHERE NOT {valid}) AS filtered FROM c")
    add("split_sentences_faithful", lambda s, d: chunk.pieces(docs(s, d), "doc_id", compat="faithful").withColumn("sentence", F.lower("sentence")), f"WITH {p_sql} SELECT doc_id, i AS sentence_idx, lower(sentence) AS sentence FROM p")
    last = lambda c: F.element_at(F.split(c, "[ ]"), -1)
    add("abbreviation_test", lambda s, d: chunk.pieces(docs(s, d), "doc_id").select(last(F.col("sentence")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).select("word", "n", X.is_abbreviation(F.col("word")).alias("listed")), f"WITH {p_sql} SELECT word, count(*) AS n, regexp_replace(lower(word), '[.]+$', '') IN ({', '.join(quoted(a.lower()) for a in X.ABBREVIATIONS)}) AS listed FROM (SELECT string_split(sentence, ' ')[-1] AS word FROM p) GROUP BY 1")
    # --- extracted markdown ---
    for name, rule in (("page_number_strip", X.PAGE_NUMBERS), ("blank_line_collapse", X.BLANK_LINES), ("header_strip", X.FURNITURE_WORDS), ("empty_row_strip", X.EMPTY_ROWS)):
        add(name, lambda s, d, r=rule: wide(s, d, "extraction_results", "extract_id", "markdown").select("extract_id", r.spark(_markdown()).alias("text")), f"SELECT extract_id, {rule.sql(_MARKDOWN)} AS text FROM extraction_results")
    add("clean_markdown", lambda s, d: wide(s, d, "extraction_results", "extract_id", "markdown").select("extract_id", X.clean_markdown(_markdown()).alias("text")), f"SELECT extract_id, {X.clean_markdown_sql(_MARKDOWN)} AS text FROM extraction_results")
    add("named_glyphs", lambda s, d: t(s, d, "extraction_results").select("extract_id", X.decode_named_glyphs(F.col("markdown")).alias("text")), f"SELECT extract_id, {X.decode_named_glyphs_sql('markdown')} AS text FROM extraction_results")
    add("glyph_decode", lambda s, d: t(s, d, "extraction_results").select("extract_id", X.decode_escapes(F.col("markdown")).alias("text")), f"SELECT extract_id, {X.decode_escapes_sql('markdown')} AS text FROM extraction_results")
    add(
        "table_block_removal",
        lambda s, d: t(s, d, "extraction_results").where("markdown IS NOT NULL").select("extract_id", X.without_tables(F.col("markdown")).alias("text")),
        """WITH l AS (SELECT extract_id, i, s[i] AS line FROM (SELECT extract_id, string_split(markdown, chr(10)) AS s FROM extraction_results WHERE markdown IS NOT NULL), unnest(range(1, len(s) + 1)) u(i)),
        e AS (SELECT *, CASE WHEN starts_with(trim(line), '|') THEN true WHEN trim(line) = '' THEN false END AS ev FROM l),
        b AS (SELECT *, coalesce(last_value(ev IGNORE NULLS) OVER (PARTITION BY extract_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS inside FROM e)
        SELECT extract_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT inside AND ev IS DISTINCT FROM true), '') AS text FROM b GROUP BY extract_id""",
    )
    add("kazakh_letters", lambda s, d: t(s, d, "extraction_results").select("extract_id", X.has_kazakh_letters(F.col("filename"), F.col("text_only")).alias("ok")), "SELECT extract_id, NOT (contains(filename, '_KAZ') AND length(text_only) > 100 AND NOT regexp_matches(text_only, '[ӘәҒғҚқҢңӨөҰұҮүІі]')) AS ok FROM extraction_results")
    add("extraction_totals", lambda s, d: extraction.totals(t(s, d, "extraction_results")), "SELECT count(*) AS total, count(*) FILTER (WHERE success) AS ok, count(*) FILTER (WHERE NOT success) AS failed, sum(CASE WHEN success THEN char_count END)::BIGINT AS chars FROM extraction_results")
    pages = lambda s, d: t(s, d, "extraction_results").where("text_only IS NOT NULL").select("extract_id", "text_only", F.split("text_only", "\n\n").alias("p"))
    add("extract_route", lambda s, d: pages(s, d).select("extract_id", extraction.route(F.col("p"), F.pmod("extract_id", F.lit(2)) == 0).alias("method"), F.size("p").cast("bigint").alias("pages")), "SELECT extract_id, CASE WHEN len(list_filter(p, lambda x: trim(x, ' ' || chr(9) || chr(10)) <> '')) >= len(p) * 0.5 AND length(text_only) >= len(p) * 100 THEN 'pypdf' WHEN extract_id % 2 = 0 THEN 'docling_ocr' ELSE 'pypdf_partial' END AS method, len(p)::BIGINT AS pages FROM (SELECT *, string_split(text_only, chr(10) || chr(10)) AS p FROM extraction_results WHERE text_only IS NOT NULL)")
    # --- file names ---
    add("detect_language", lambda s, d: t(s, d, "extraction_results").select("extract_id", X.language_of(F.col("filename")).alias("language")), f"SELECT extract_id, {X.LANGUAGE_SQL.format('filename')} AS language FROM extraction_results")
    named = lambda: F.concat_ws("_", F.substring("filename", 1, 4), F.lower("collection"), F.col("filename"))
    n_sql = "(filename[1:4] || '_' || lower(collection) || '_' || filename)"
    add(
        "doc_metadata",
        lambda s, d: t(s, d, "extraction_results").select("extract_id", X.year_of(named()).alias("year"), X.first_named(named(), X.TYPES).alias("type"), X.language_of(named()).alias("language"), X.first_named(F.concat(F.element_at(F.array(F.lit("telecom_"), F.lit("halyk "), F.lit("x")), (F.pmod("extract_id", F.lit(3)) + 1).cast("int")), named()), X.COMPANIES).alias("company")),
        f"SELECT extract_id, {X.year_of_sql(n_sql)} AS year, {X.first_named_sql(n_sql, X.TYPES)} AS type, {X.LANGUAGE_SQL.format(n_sql)} AS language, {X.first_named_sql(chr(40) + '[' + quoted('telecom_') + ',' + quoted('halyk ') + ',' + quoted('x') + '][extract_id % 3 + 1] || ' + n_sql + chr(41), X.COMPANIES)} AS company FROM extraction_results",
    )
    add("doc_id", lambda s, d: t(s, d, "sentences_kaz").select("collection", "source_file").distinct().select("collection", "source_file", X.document_id(F.col("source_file")).alias("document")), f"SELECT DISTINCT collection, source_file, {X.document_id_sql('source_file')} AS document FROM sentences_kaz")
    src = lambda: F.concat(F.col("metadata.source_doc"), F.element_at(F.array(F.lit("_Halyk"), F.lit("_KCELL"), F.lit("_air_astana"), F.lit("")), (F.pmod("row_id", F.lit(4)) + 1).cast("int")))
    add("company_extract", lambda s, d: t(s, d, "aligned_corpus").select("row_id", F.coalesce(X.first_named(src(), X.SOURCES), F.col("metadata.company")).alias("company")), f"SELECT row_id, coalesce({X.first_named_sql('(metadata.source_doc || [' + ', '.join(map(quoted, ('_Halyk', '_KCELL', '_air_astana', ''))) + '][row_id % 4 + 1])', X.SOURCES)}, metadata.company) AS company FROM aligned_corpus")
    # --- repair of cells ---
    for name, f, sql in (
        ("noise_line_removal", X.remove_noise, X.remove_noise_sql),
        ("hyphen_repair", X.HYPHENS.spark, X.HYPHENS.sql),
        ("spacing_repair", X.SPACING.spark, X.SPACING_SQL.sql),
        ("case_repair", X.fix_case, X.fix_case_sql),
        ("clean_text_v2", X.clean_text, X.clean_text_sql),
        ("ocr_repair_v1", X.OCR_REPAIR.spark, X.OCR_REPAIR.sql),
        ("dedup_key", X.dedup_key, X.dedup_key_sql),
    ):
        add(name, lambda s, d, f=f: wide(s, d, "aligned_corpus", "row_id", "kaz").select("row_id", f(_noisy()).alias("text")), f"SELECT row_id, {sql(_NOISY)} AS text FROM aligned_corpus")
    add("nfkc", lambda s, d: t(s, d, "aligned_corpus").select("row_id", U.nfkc(F.col("kaz")).alias("text")), f"SELECT row_id, {U.nfkc_sql('kaz')} AS text FROM aligned_corpus")
    add("clean_text_full", lambda s, d: wide(s, d, "aligned_corpus", "row_id", "kaz").select("row_id", X.clean_text_full(F.col("kaz")).alias("text")), f"SELECT row_id, CASE WHEN kaz = '' THEN kaz ELSE {X.clean_text_sql(U.nfkc_sql('kaz'))} END AS text FROM aligned_corpus")
    add("ocr_repair_changed", lambda s, d: wide(s, d, "aligned_corpus", "row_id", "kaz").select("row_id", X.ocr_repair(_noisy()).alias("r")).select("row_id", "r.changed"), f"SELECT row_id, {X.OCR_REPAIR.sql(_NOISY)} <> {_NOISY} AS changed FROM aligned_corpus")
    # --- filters on triplets ---
    add("length_filter", lambda s, d: t(s, d, "aligned_corpus").where(quality.good_length(F.col("rus"))).select("row_id"), f"SELECT row_id FROM aligned_corpus WHERE {quality.good_length_sql('rus')}")
    add("content_quality", lambda s, d: t(s, d, "aligned_corpus").select("row_id", quality.good_content(F.repeat(F.substring("kaz", 1, 30), (F.pmod("row_id", F.lit(4)) + 1).cast("int"))).alias("ok")), f"SELECT row_id, {quality.good_content_sql('repeat(kaz[1:30], (row_id % 4 + 1)::INT)')} AS ok FROM aligned_corpus")
    add("toc_filter", lambda s, d: t(s, d, "aligned_corpus").select("row_id", quality.contents_like(F.concat_ws(" ", F.col("rus"), F.when(F.pmod("row_id", F.lit(6)) == 0, "Appendix"))).alias("toc")), f"SELECT row_id, {quality.contents_like_sql(chr(40) + 'concat_ws(' + quoted(' ') + ', rus, CASE WHEN row_id % 6 = 0 THEN ' + quoted('Appendix') + ' END)' + chr(41))} AS toc FROM aligned_corpus")
    add("length_ratio", lambda s, d: t(s, d, "aligned_corpus").select("row_id", quality.good_ratio(F.col("kaz"), F.repeat("eng", (F.pmod("row_id", F.lit(3)) + 1).cast("int"))).alias("ok")), f"SELECT row_id, {quality.good_ratio_sql('kaz', 'repeat(eng, (row_id % 3 + 1)::INT)')} AS ok FROM aligned_corpus")
    for name, lim in (("triplet_reason", quality.Limits(min_similarity=0.82)), ("triplet_reason_strict", quality.Limits(strict=True))):
        add(name, lambda s, d, lim=lim: quality.with_reason(wide(s, d, "aligned_corpus", "row_id", "kaz", "rus", "eng", "similarity_kaz_rus", "similarity_kaz_eng"), lim).select("row_id", "reason"), f"SELECT row_id, {quality.triplet_reason_sql(lim)} AS reason FROM aligned_corpus")
    lim = quality.Limits(min_similarity=0.82)
    add("reason_histogram", lambda s, d: quality.histogram(quality.with_reason(wide(s, d, "aligned_corpus", "row_id", "kaz", "rus", "eng", "similarity_kaz_rus", "similarity_kaz_eng"), lim), F.col("reason"), "reason", 10), f"SELECT * FROM (SELECT {quality.triplet_reason_sql(lim)} AS reason, count(*) AS n FROM aligned_corpus GROUP BY 1) WHERE reason IS NOT NULL ORDER BY n DESC, reason LIMIT 10")
    add("retention_rate", lambda s, d: quality.with_reason(wide(s, d, "aligned_corpus", "row_id", "kaz", "rus", "eng", "similarity_kaz_rus", "similarity_kaz_eng"), lim).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("reason").isNull()).alias("kept")).select("rows", "kept", F.round(F.try_divide("kept", "rows"), 6).alias("rate")), f"SELECT count(*) AS rows, count(*) FILTER (WHERE r IS NULL) AS kept, round(count(*) FILTER (WHERE r IS NULL) / count(*), 6) AS rate FROM (SELECT {quality.triplet_reason_sql(lim)} AS r FROM aligned_corpus)")
    add("basic_filter_v1", lambda s, d: wide(s, d, "aligned_corpus", "row_id", "kaz", "rus", "eng", "similarity_kaz_rus", "similarity_kaz_eng").select("row_id", quality.basic_reason().alias("reason")), f"SELECT row_id, {quality.basic_reason_sql()} AS reason FROM aligned_corpus")
    v = lambda: quality.parse_verdict(_reply())
    j = lambda f, kind, other: f"CASE WHEN {_HAS_JSON} THEN json_extract_string({_JSON}, '$.{f}')::{kind} ELSE {other} END"
    add("judge_json_parse", lambda s, d: t(s, d, "aligned_corpus").select("row_id", v().alias("v")).select("row_id", "v.is_valid_alignment", "v.is_atomic", "v.quality_score", "v.fixed_kaz"), f"SELECT row_id, {j('is_valid_alignment', 'BOOLEAN', 'true')} AS is_valid_alignment, {j('is_atomic', 'BOOLEAN', 'true')} AS is_atomic, {j('quality_score', 'DOUBLE', '0.7')} AS quality_score, {j('fixed_kaz', 'VARCHAR', 'NULL')} AS fixed_kaz FROM aligned_corpus")
    add("judge_gate", lambda s, d: quality.gated(t(s, d, "aligned_corpus").select("row_id", "kaz", "rus", "eng", _reply().alias("reply")), "reply"), f"SELECT row_id, coalesce(nullif({j('fixed_kaz', 'VARCHAR', 'NULL')}, ''), kaz) AS kaz, coalesce(nullif({j('fixed_rus', 'VARCHAR', 'NULL')}, ''), rus) AS rus, coalesce(nullif({j('fixed_eng', 'VARCHAR', 'NULL')}, ''), eng) AS eng, {j('quality_score', 'DOUBLE', '0.7')} AS llm_quality_score FROM aligned_corpus WHERE {j('is_valid_alignment', 'BOOLEAN', 'true')} AND {j('is_atomic', 'BOOLEAN', 'true')} AND {j('quality_score', 'DOUBLE', '0.7')} >= 0.6")
    question = quality.judge_prompt_sql()
    add("judge_prompt", lambda s, d: t(s, d, "aligned_corpus").select("row_id", quality.judge_prompt().alias("prompt")), f"SELECT row_id, {question} AS prompt FROM aligned_corpus")
    add("judged", lambda s, d: quality.judged(wide(s, d, "aligned_corpus", "row_id", "kaz", "rus", "eng"), models.length_judge), f"SELECT row_id, kaz, rus, eng, length({question}) % 100 / 100.0 AS llm_quality_score FROM aligned_corpus WHERE length({question}) % 2 = 0 AND length({question}) % 100 >= 60")
    reasons = {"null_filtered": "r IN ('missing_kaz', 'missing_both_targets')", "too_short": "r = 'too_short'", "too_long": "r = 'too_long'", "garbage": "r = 'garbage_pattern'", "kept": "r IS NULL"}
    add("basic_counters_v1", lambda s, d: quality.basic_counters(wide(s, d, "aligned_corpus", "row_id", "kaz", "rus", "eng")), f"SELECT count(*) AS rows, {', '.join(f'count(*) FILTER (WHERE {w}) AS {n}' for n, w in reasons.items())}, round(count(*) FILTER (WHERE r IS NULL) / count(*), 6) AS rate FROM (SELECT {quality.basic_reason_sql()} AS r FROM aligned_corpus)")
    kinds = lambda: F.explode(F.array(*(F.struct(F.lit(x).alias("side"), F.col(f"alignment_type_kaz_{x}").alias("type")) for x in ("rus", "eng")))).alias("x")
    add("alignment_type_histogram", lambda s, d: t(s, d, "aligned_corpus").select(kinds()).select("x.*").groupBy("side", "type").agg(F.count("type").alias("n")).where("n > 0"), "SELECT side, type, count(*) AS n FROM (SELECT 'rus' AS side, alignment_type_kaz_rus AS type FROM aligned_corpus UNION ALL SELECT 'eng', alignment_type_kaz_eng FROM aligned_corpus) WHERE type IS NOT NULL GROUP BY ALL")
    for side in ("rus", "eng"):
        add(f"alignment_type_histogram_{side}", lambda s, d, c=side: quality.histogram(t(s, d, "aligned_corpus"), F.col(f"alignment_type_kaz_{c}"), "type"), f"SELECT alignment_type_kaz_{side} AS type, count(*) AS n FROM aligned_corpus WHERE alignment_type_kaz_{side} IS NOT NULL GROUP BY 1")
    # --- dedup, order, sets ---
    add("dedup_keep_first", lambda s, d: dedup.keep_first(wide(s, d, "aligned_corpus", "row_id", "id", "kaz").where("kaz IS NOT NULL"), X.dedup_key(F.col("kaz")), "row_id").select("row_id", "id"), f"SELECT row_id, id FROM (SELECT *, row_number() OVER (PARTITION BY {X.dedup_key_sql('kaz')} ORDER BY row_id) AS n FROM aligned_corpus WHERE kaz IS NOT NULL) WHERE n = 1")
    add("keep_last", lambda s, d: dedup.keep_last(t(s, d, "aligned_corpus"), F.col("id"), "row_id").select("row_id", "id", "kaz"), "SELECT row_id, id, kaz FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY row_id DESC) AS n FROM aligned_corpus) WHERE n = 1")
    add("filename_dedup", lambda s, d: dedup.keep_first(t(s, d, "extraction_results").select("extract_id", "collection", "filename"), F.struct("collection", "filename"), "extract_id"), "SELECT extract_id, collection, filename FROM (SELECT *, row_number() OVER (PARTITION BY collection, filename ORDER BY extract_id) AS n FROM extraction_results) WHERE n = 1")
    add("head_n", lambda s, d: t(s, d, "aligned_corpus").orderBy("row_id").limit(100).select("row_id", "id"), "SELECT row_id, id FROM aligned_corpus ORDER BY row_id LIMIT 100")
    add("train_test_split", lambda s, d: dedup.split_test(t(s, d, "documents").select("doc_id"), "doc_id"), "SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id::VARCHAR), doc_id) <= (SELECT (count(*) * 500 + 9999) // 10000 FROM documents) AS is_test FROM documents")
    add("resume_anti_join", lambda s, d: preference.resume(t(s, d, "documents").select("doc_id", "source"), t(s, d, "doc_labels"), "doc_id"), "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM doc_labels l WHERE l.doc_id = d.doc_id)")
    key = lambda s, d, n: t(s, d, n).select("collection", X.document_id(F.col("source_file")).alias("document"))
    k_sql = lambda n: f"SELECT collection, {X.document_id_sql('source_file')} AS document FROM {n}"
    add("doc_intersect", lambda s, d: key(s, d, "sentences_kaz").intersect(key(s, d, "sentences_rus")), f"{k_sql('sentences_kaz')} INTERSECT {k_sql('sentences_rus')}")
    add("key_union_distinct", lambda s, d: key(s, d, "sentences_rus").unionByName(key(s, d, "sentences_eng")).distinct(), f"{k_sql('sentences_rus')} UNION {k_sql('sentences_eng')}")
    add(
        "doc_pairing",
        lambda s, d: chunk.documents_in_both(t(s, d, "sentences_kaz"), t(s, d, "sentences_rus"), ("kaz", "rus")),
        f"SELECT collection, document, kaz, rus FROM (SELECT collection, document, count(*) AS kaz FROM ({k_sql('sentences_kaz')}) GROUP BY ALL) JOIN (SELECT collection, document, count(*) AS rus FROM ({k_sql('sentences_rus')}) GROUP BY ALL) USING (collection, document)",
    )
    add("group_sentences", lambda s, d: chunk.by_document(t(s, d, "sentences_eng"), "collection", "source_file"), "SELECT collection, source_file, string_agg(text, ' ' ORDER BY sentence_idx, sent_id) AS text FROM sentences_eng GROUP BY ALL")
    add("first_metadata", lambda s, d: chunk.first_metadata(t(s, d, "sentences_kaz"), "collection", "source_file"), "SELECT collection, source_file, m.year AS year, m.company AS company, m.type AS doc_type FROM (SELECT collection, source_file, metadata AS m, row_number() OVER (PARTITION BY collection, source_file ORDER BY sentence_idx, sent_id) AS n FROM sentences_kaz) WHERE n = 1")
    # --- manifests ---
    add("manifest_carry_forward", lambda s, d: manifest.carry_forward(_lines(t(s, d, "extraction_results"), "carry")), _carry_sql(_TITLE_TYPE))
    add("manifest_integrated", lambda s, d: manifest.carry_forward(_lines(t(s, d, "extraction_results"), "carry"), "integrated"), _carry_sql(_INTEGRATED))
    add("manifest_lookahead", lambda s, d: manifest.look_ahead(_lines(t(s, d, "extraction_results"), "ahead")), "WITH " + _lines_sql("ahead") + f" SELECT file, line_no, url, year, lang, 'Annual_Report' AS type FROM (SELECT *, lead(line) OVER (PARTITION BY file ORDER BY line_no) AS url, regexp_extract(line, '([0-9]{{4}})\\s+ГОД', 1) AS year, {_LANG_OF} AS lang FROM l) WHERE year <> '' AND lang IS NOT NULL AND regexp_matches(url, '^https?://')")
    for name, pattern, kind in (("manifest_prefixed", "([0-9]{4})\\s+ГОДОВЫЕ ОТЧЕТЫ", None), ("manifest_year_range", "([0-9\\-]+)\\s+ГОД", "Research_Program")):
        sql = "WITH " + _lines_sql("prefixed") + f", y AS (SELECT *, nullif(regexp_extract(line, '{pattern}', 1), '') AS here FROM l), n AS (SELECT *, last_value(here IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS year FROM y) SELECT file, line_no, regexp_extract(line, '^(KAZ|RUS|ENG):\\s+(https?://.*)', 2) AS url, year, regexp_extract(line, '^(KAZ|RUS|ENG):\\s+', 1) AS lang, '{kind or 'Annual_Report'}' AS type FROM n WHERE here IS NULL AND regexp_matches(line, '^(KAZ|RUS|ENG):\\s+https?://') AND year IS NOT NULL"
        args = {} if kind is None else {"year_pattern": manifest.YEAR_RANGE, "doc_type": kind}
        add(name, lambda s, d, a=args: manifest.prefixed(_lines(t(s, d, "extraction_results"), "prefixed"), **a), sql)
    title = lambda: F.concat(F.element_at(F.array(F.lit("Годовой отчет "), F.lit("Отчет об устойчивом развитии "), F.lit("")), (F.pmod("extract_id", F.lit(3)) + 1).cast("int")), F.replace("filename", F.lit("_"), F.lit(" ")))
    add("title_doc_type", lambda s, d: t(s, d, "extraction_results").select("extract_id", manifest.title_type(title()).alias("type")), f"SELECT extract_id, {_TITLE_TYPE.format(chr(40) + '[' + ', '.join(map(quoted, ('Годовой отчет ', 'Отчет об устойчивом развитии ', ''))) + '][extract_id % 3 + 1] || replace(filename, ' + quoted('_') + ', ' + quoted(' ') + ')' + chr(41))} AS type FROM extraction_results")
    add("filename_synth", lambda s, d: t(s, d, "aligned_corpus").select("row_id", manifest.file_name(F.col("metadata.year"), F.concat(F.col("metadata.doc_type"), F.lit(" a/b:c?")), F.upper(F.lit("kaz"))).alias("name")), """SELECT row_id, regexp_replace(concat_ws('_', metadata.year, metadata.doc_type || ' a/b:c?', 'KAZ.pdf'), '[<>:"/\\\\|?*]', '_', 'g') AS name FROM aligned_corpus""")
    # --- vectors and pairs ---
    ask = lambda s, d: t(s, d, "embeddings").where("vec_id % 20 = 0")  # the stated query set of a search
    knn = lambda s, d: align.nearest(ask(s, d), t(s, d, "embeddings"), "label", "vec_id", "embedding")
    knn_sql = "k AS (SELECT q AS query, m AS match, sim AS similarity FROM (SELECT a.vec_id AS q, b.vec_id AS m, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS sim, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 12) DESC, b.vec_id) AS n FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0) WHERE n = 1)"
    add("knn_top1", lambda s, d: knn(s, d).select("query", "match", F.round("similarity", 6).alias("similarity")), f"WITH {knn_sql} SELECT query, match, round(similarity, 6) AS similarity FROM k")
    add("greedy_one_to_one", lambda s, d: align.one_to_one(knn(s, d).where("similarity >= 0.25"), "query", "match").select("query", "match"), f"WITH {knn_sql} SELECT query, match FROM (SELECT *, row_number() OVER (PARTITION BY match ORDER BY query) AS n FROM k WHERE similarity >= 0.25) WHERE n = 1")
    add("pair_filters", lambda s, d: align.pair_filters(t(s, d, "aligned_corpus"), "kaz", "rus", "similarity_kaz_rus", 0.82).select("row_id"), f"SELECT row_id FROM aligned_corpus WHERE similarity_kaz_rus >= 0.82 AND {word_count_sql('kaz')} >= 5 AND {word_count_sql('rus')} >= 5 AND {word_count_sql('kaz')} / {word_count_sql('rus')} BETWEEN 0.3 AND 3.0")
    pair = lambda s, d, x: t(s, d, "aligned_corpus").where(F.col(x).isNotNull() & F.col("kaz").isNotNull() & F.col("metadata.source_doc").isNotNull()).select(F.col("metadata.source_doc").alias("doc"), F.col("row_id").alias("pos"), "kaz", F.col(x).alias("text"), F.col(f"similarity_kaz_{x}").alias("sim"), F.col(f"alignment_type_kaz_{x}").alias("kind"))
    side = lambda x: f"SELECT doc, kaz, min(row_id) AS {x}_pos, arg_max({x}, row_id) AS {x}, arg_max(struct_pack(s := similarity_kaz_{x}, a := alignment_type_kaz_{x}), row_id) AS {x}_s FROM (SELECT *, metadata.source_doc AS doc FROM aligned_corpus) WHERE {x} IS NOT NULL AND kaz IS NOT NULL AND doc IS NOT NULL GROUP BY doc, kaz"
    full = f"SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY rus_pos NULLS LAST, eng_pos NULLS LAST) - 1 AS idx, kaz, rus, eng, round(rus_s.s, 4) AS similarity_kaz_rus, round(eng_s.s, 4) AS similarity_kaz_eng, rus_s.a AS alignment_type_kaz_rus, eng_s.a AS alignment_type_kaz_eng FROM ({side('rus')}) FULL JOIN ({side('eng')}) USING (doc, kaz)"
    add("triplets_full_outer", lambda s, d: align.triplets(pair(s, d, "rus"), pair(s, d, "eng")), f"SELECT *, printf('%s_%04d', doc, idx) AS id FROM ({full})")
    add("record_ids", lambda s, d: align.triplets(pair(s, d, "rus"), pair(s, d, "eng")).select("id"), f"SELECT printf('%s_%04d', doc, idx) AS id FROM ({full})")
    kaz = lambda s, d: t(s, d, "aligned_corpus").select("row_id", "kaz")
    left = lambda s, d, x: t(s, d, "aligned_corpus").where(F.col(x).isNotNull()).select("row_id", x)
    add("triplets_left", lambda s, d: align.left_triplets(kaz(s, d), left(s, d, "rus"), left(s, d, "eng"), "row_id"), "SELECT k.row_id, k.kaz, r.rus, e.eng FROM aligned_corpus k LEFT JOIN (SELECT row_id, rus FROM aligned_corpus WHERE rus IS NOT NULL) r USING (row_id) LEFT JOIN (SELECT row_id, eng FROM aligned_corpus WHERE eng IS NOT NULL) e USING (row_id) WHERE r.rus IS NOT NULL OR e.eng IS NOT NULL")
    add("alignment_stats", lambda s, d: align.stats(t(s, d, "aligned_corpus")), "SELECT count(rus) AS kaz_rus_pairs, count(eng) AS kaz_eng_pairs, count(*) FILTER (WHERE alignment_type_kaz_rus <> '1:1') AS kaz_rus_merged, count(*) FILTER (WHERE rus IS NOT NULL AND eng IS NOT NULL) AS full_triplets, count(*) FILTER (WHERE (rus IS NULL) <> (eng IS NULL)) AS partial_triplets FROM aligned_corpus")
    sims = lambda s, d: t(s, d, "aligned_corpus").select(F.explode(F.array(F.struct(F.lit("mexma").alias("model"), F.col("similarity_kaz_rus").alias("s")), F.struct(F.lit("labse").alias("model"), F.col("similarity_kaz_eng").alias("s")), F.struct(F.lit("sonar").alias("model"), ((F.col("similarity_kaz_rus") + F.col("similarity_kaz_eng")) / 2).alias("s")))).alias("x")).select("x.model", F.col("x.s").alias("similarity"))
    sims_sql = "s AS (SELECT 'mexma' AS model, similarity_kaz_rus AS s FROM aligned_corpus UNION ALL SELECT 'labse', similarity_kaz_eng FROM aligned_corpus UNION ALL SELECT 'sonar', (similarity_kaz_rus + similarity_kaz_eng) / 2 FROM aligned_corpus)"
    a_sql = ", ".join(f"count(*) FILTER (WHERE s > {x}) AS above_{int(x * 100)}" for x in (0.8, 0.85, 0.9))
    add("encoder_comparison", lambda s, d: align.compare_encoders(sims(s, d)), f"WITH {sims_sql} SELECT model, round(avg(s), 6) AS mean, round(median(s), 6) AS median, round(stddev_pop(s), 6) AS std, {a_sql} FROM s WHERE s IS NOT NULL GROUP BY model")
    add("encoder_winner", lambda s, d: align.winner(sims(s, d)), f"WITH {sims_sql}, c AS (SELECT model, count(*) FILTER (WHERE s > 0.85) AS n FROM s GROUP BY 1) SELECT model AS winner FROM c ORDER BY n DESC, CASE model WHEN 'mexma' THEN 0 WHEN 'sonar' THEN 1 ELSE 2 END LIMIT 1")
    pair_no = lambda: F.floor(F.col("sentence_idx") / 2).cast("bigint").alias("bead")
    add("bead_text", lambda s, d: t(s, d, "sentences_eng").select("collection", "source_file", pair_no(), "sentence_idx", "text").distinct().groupBy("collection", "source_file", "bead").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sentence_idx", "text"))), lambda x: x["text"]), " ").alias("text")), "SELECT collection, source_file, (sentence_idx // 2)::BIGINT AS bead, string_agg(text, ' ' ORDER BY sentence_idx, text) AS text FROM (SELECT DISTINCT collection, source_file, sentence_idx, text FROM sentences_eng) GROUP BY ALL")

    one_doc = lambda s, d: t(s, d, "sentences_eng").where("text IS NOT NULL").select(F.concat_ws("/", "collection", X.document_id(F.col("source_file"))).alias("doc"), F.col("sentence_idx").alias("idx"), "text").distinct()

    def made_beads(s: SparkSession, d: str) -> DataFrame:
        """Beads of two neighbouring sentences with the first of them, every third without a target."""
        n = one_doc(s, d).groupBy("doc").agg(F.count(F.lit(1)).cast("int").alias("n"))
        k = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 2).cast("int"))).alias("k")
        return n.select("doc", "n", k).select("doc", F.sequence(2 * F.col("k"), F.least(2 * F.col("k") + 1, F.col("n") - 1)).alias("src"), F.when(F.pmod("k", F.lit(3)) == 0, F.array().cast("array<int>")).otherwise(F.array(2 * F.col("k"))).alias("tgt"))

    places = f"r AS (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY idx, text) - 1 AS place, text FROM (SELECT DISTINCT concat_ws('/', collection, {X.document_id_sql('source_file')}) AS doc, sentence_idx AS idx, text FROM sentences_eng WHERE text IS NOT NULL))"
    add("bead_chain", lambda s, d: align.bead_texts(made_beads(s, d), one_doc(s, d), one_doc(s, d)), f"WITH {places} SELECT doc, min(place)::INT AS pos, string_agg(text, ' ' ORDER BY place) AS kaz, arg_min(text, place) AS text, count(*) || ':1' AS kind FROM r WHERE (place // 2) % 3 <> 0 GROUP BY doc, place // 2")
    add("pair_similarity", lambda s, d: t(s, d, "embeddings").alias("a").join(t(s, d, "embeddings").alias("b"), F.col("b.vec_id") == F.col("a.vec_id") + 1).select(F.col("a.vec_id").alias("vec_id"), F.round(align.vector_product(F.col("a.embedding"), F.col("b.embedding")), 5).alias("similarity")), "SELECT a.vec_id, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 5) AS similarity FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")

    def dp(s: SparkSession, d: str) -> DataFrame:
        rows = lambda n: t(s, d, n).where("text IS NOT NULL").select(F.concat_ws("/", "collection", X.document_id(F.col("source_file"))).alias("doc"), F.col("sentence_idx").alias("idx"), "text").distinct()
        return align.align_documents(rows("sentences_rus"), rows("sentences_eng"), models.gram_encoder).select("doc", "src", "tgt")

    add("dp_align", dp)
    add("encode_double", lambda s, d: wide(s, d, "documents", "doc_id", "text").select("doc_id", models.encoded(F.col("text")).alias("vector")))
    # --- preference data ---
    six = [(x, x[:3], x[4:]) for x in X.DIRECTIONS]
    asked = " UNION ALL ".join(f"SELECT id, row_id, '{x}' AS direction, {X.prompt_sql(x, a)} AS prompt, {a} AS source_text, {b} AS chosen FROM aligned_corpus WHERE coalesce({a}, '') <> '' AND coalesce({b}, '') <> ''" for x, a, b in six)
    add("prompt_render", lambda s, d: preference.directions(t(s, d, "aligned_corpus").withColumn("id", F.col("row_id").cast("string"))).select("id", "direction", "prompt"), f"SELECT row_id::VARCHAR AS id, direction, prompt FROM ({asked})")
    # the answer to be rejected: the chosen text of the next record
    one = lambda s, d: preference.directions(dedup.keep_first(t(s, d, "aligned_corpus"), F.col("id"), "row_id").withColumn("id", F.col("row_id").cast("string")), ("kaz2rus", "kaz2eng"))
    worse = lambda s, d: one(s, d).select((F.col("id").cast("bigint") - 1).cast("string").alias("id"), "direction", F.col("chosen").alias("rejected"))
    firsts = "f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY row_id) AS n FROM aligned_corpus) WHERE n = 1)"
    a2 = " UNION ALL ".join(f"SELECT row_id, '{x}' AS direction, {X.prompt_sql(x, a)} AS prompt, {a} AS source_text, {b} AS chosen FROM f WHERE coalesce({a}, '') <> '' AND coalesce({b}, '') <> ''" for x, a, b in six[:2])
    ex = f"WITH {firsts}, a AS ({a2}), e AS (SELECT a.row_id || '_' || a.direction AS example_id, a.row_id::VARCHAR AS id, a.direction, a.prompt, a.chosen, r.chosen AS rejected, a.source_text FROM a JOIN a r ON r.row_id = a.row_id + 1 AND r.direction = a.direction WHERE lower({STRIP.sql('r.chosen')}) <> lower({STRIP.sql('a.chosen')}))"
    add("preference_examples", lambda s, d: preference.examples(one(s, d), worse(s, d)), f"{ex} SELECT * FROM e")
    add("examples_by_direction", lambda s, d: preference.examples(one(s, d), worse(s, d)).groupBy("direction").agg(F.count(F.lit(1)).alias("n")), f"{ex} SELECT direction, count(*) AS n FROM e GROUP BY 1")
    answer = lambda: F.concat(F.lit("  "), F.col("eng"), F.when(F.pmod("row_id", F.lit(3)) == 0, F.lit("\n\nrest")).when(F.pmod("row_id", F.lit(3)) == 1, F.lit(" Kazakh: x Russian: y")).otherwise(F.lit(" \n")))
    add("generation_cleanup", lambda s, d: t(s, d, "aligned_corpus").select("row_id", X.clean_generation(answer()).alias("text")), f"SELECT row_id, {X.clean_generation_sql('(' + quoted('  ') + ' || eng || CASE row_id % 3 WHEN 0 THEN chr(10) || chr(10) || ' + quoted('rest') + ' WHEN 1 THEN ' + quoted(' Kazakh: x Russian: y') + ' ELSE ' + quoted(' ') + ' || chr(10) END)')} AS text FROM aligned_corpus")
    add("example_source_id", lambda s, d: preference.directions(t(s, d, "aligned_corpus")).select(F.concat_ws("_", "id", "direction").alias("example_id")).select("example_id", F.regexp_replace("example_id", "_[^_]*$", "").alias("id"), F.split(F.element_at(F.split("example_id", "_"), -1), "2")[0].alias("source_lang")), f"SELECT e AS example_id, regexp_replace(e, '_[^_]*$', '') AS id, string_split(string_split(e, '_')[-1], '2')[1] AS source_lang FROM (SELECT id || '_' || direction AS e FROM ({asked}))")
    # sampling is the operator here: about a tenth of the records go to the judge
    add("judge_sample", lambda s, d: dedup.sampled(t(s, d, "aligned_corpus").select("row_id", "id"), "row_id", 0.1), "SELECT row_id, id FROM aligned_corpus WHERE CAST('0x' || substr(md5(row_id::VARCHAR), 1, 8) AS BIGINT) < 429496729")
    # --- metrics: each Russian cell against the next record's ---
    graded = lambda s, d: spread(t(s, d, "aligned_corpus").select("row_id", F.col("rus").alias("reference")), "row_id").join(t(s, d, "aligned_corpus").select((F.col("row_id") - 1).alias("row_id"), F.col("rus").alias("hypothesis")), "row_id")
    g_sql = "g AS (SELECT a.row_id AS id, b.rus AS hyp, a.rus AS ref FROM aligned_corpus a JOIN aligned_corpus b ON b.row_id = a.row_id + 1 WHERE a.rus IS NOT NULL AND b.rus IS NOT NULL)"
    from sarqyt.functions.rules import words_sql

    grams = " UNION ALL ".join(f"SELECT id, {n} AS n, array_to_string(w[i:i + {n - 1}], ' ') AS g, count(*) AS c FROM (SELECT id, {{w}} AS w FROM g), unnest(range(1, len(w) - {n - 2})) u(i) GROUP BY ALL" for n in range(1, 5))
    add(
        "corpus_bleu",
        lambda s, d: metrics.corpus_bleu(graded(s, d)),
        f"WITH {g_sql}, h AS ({grams.format(w=words_sql('hyp'))}), r AS ({grams.format(w=words_sql('ref'))}), m AS (SELECT h.n, sum(least(h.c, r.c)) AS m FROM h JOIN r ON h.id = r.id AND h.n = r.n AND h.g = r.g GROUP BY 1), t AS (SELECT n, sum(c) AS t FROM h GROUP BY 1), p AS (SELECT t.n, coalesce(m, 0) / t AS p FROM t LEFT JOIN m USING (n)), s AS (SELECT sum(len({words_sql('hyp')})) / sum(len({words_sql('ref')})) AS ratio FROM g), b AS (SELECT ratio, CASE WHEN ratio >= 1 THEN 1.0 ELSE exp(1 - 1 / ratio) END AS bp FROM s)"
        " SELECT round(CASE WHEN min(p) > 0 THEN 100 * any_value(bp) * exp(sum(ln(CASE WHEN p > 0 THEN p ELSE 1 END)) / 4) ELSE 0 END, 6) AS score, " + ", ".join(f"round(100 * max(p) FILTER (WHERE n = {n}), 6) AS p{n}" for n in range(1, 5)) + ", round(any_value(bp), 6) AS bp, round(any_value(ratio), 6) AS ratio FROM p, b",
    )
    chars = " UNION ALL ".join(f"SELECT id, {n} AS n, w[i:i + {n - 1}] AS g, count(*) AS c FROM (SELECT id, array_to_string({{w}}, '') AS w FROM g), unnest(range(1, length(w) - {n - 2})) u(i) GROUP BY ALL" for n in range(1, 7))
    add(
        "corpus_chrf",
        lambda s, d: metrics.corpus_chrf(graded(s, d)),
        f"WITH {g_sql}, h AS ({chars.format(w=words_sql('hyp'))}), r AS ({chars.format(w=words_sql('ref'))}), m AS (SELECT h.n, sum(least(h.c, r.c)) AS m FROM h JOIN r ON h.id = r.id AND h.n = r.n AND h.g = r.g GROUP BY 1), x AS (SELECT avg(m / hs) AS p, avg(m / rs) AS r FROM m JOIN (SELECT n, sum(c) AS hs FROM h GROUP BY 1) USING (n) JOIN (SELECT n, sum(c) AS rs FROM r GROUP BY 1) USING (n)) SELECT round(100 * 5 * p * r / (4 * p + r), 6) AS score FROM x",
    )
    m4, h4 = [f"m{n}" for n in range(1, 5)], [f"h{n}" for n in range(1, 5)]

    def bleu_sql(pairs: str) -> str:
        """The customary BLEU of the (id, hyp, ref) in ``pairs``."""
        words = lambda e: words_sql(metrics.tokens_13a_sql(e))
        zeros = "0"
        p = []
        for m, h in zip(m4, h4, strict=True):
            zeros += f" + CASE WHEN {m} = 0 AND {h} > 0 THEN 1 ELSE 0 END"
            p.append(f"CASE WHEN {h} = 0 THEN 0 WHEN {m} = 0 THEN 100.0 / (pow(2, {zeros}) * {h}) ELSE 100.0 * {m} / {h} END")
        cells = ", ".join(f"coalesce(max(m.m) FILTER (WHERE t.n = {n}), 0) AS m{n}, coalesce(max(t.t) FILTER (WHERE t.n = {n}), 0) AS h{n}" for n in range(1, 5))
        bp = "CASE WHEN h1 = 0 THEN 0.0 WHEN h1 < rl THEN exp(1 - rl / h1) ELSE 1.0 END"
        some, whole = " + ".join(m4) + " > 0", " AND ".join(f"{h} > 0" for h in h4)
        logs = " + ".join(f"ln(CASE WHEN {x} > 0 THEN {x} ELSE 1 END)" for x in (f"({q})" for q in p))
        return (
            f"WITH g AS ({pairs}), h AS ({grams.format(w=words('hyp'))}), r AS ({grams.format(w=words('ref'))}), m AS (SELECT h.n, sum(least(h.c, r.c)) AS m FROM h JOIN r ON h.id = r.id AND h.n = r.n AND h.g = r.g GROUP BY 1), t AS (SELECT n, sum(c) AS t FROM h GROUP BY 1),"
            f" x AS (SELECT {cells}, (SELECT sum(len({words('ref')})) FROM g) AS rl FROM t LEFT JOIN m USING (n))"
            f" SELECT round(CASE WHEN {some} AND {whole} THEN {bp} * exp(({logs}) / 4) ELSE 0 END, 6) AS score, " + ", ".join(f"round(CASE WHEN {some} THEN {q} ELSE 0 END, 6) AS p{i + 1}" for i, q in enumerate(p)) + f", round({bp}, 6) AS bp, round(h1 / rl, 6) AS ratio FROM x"
        )

    add("bleu_defaults", lambda s, d: metrics.bleu(graded(s, d)), bleu_sql("SELECT a.row_id AS id, b.rus AS hyp, a.rus AS ref FROM aligned_corpus a JOIN aligned_corpus b ON b.row_id = a.row_id + 1 WHERE a.rus IS NOT NULL AND b.rus IS NOT NULL"))
    held = lambda s, d: wide(s, d, "aligned_corpus", "row_id", "kaz", "rus", "eng").withColumnRenamed("row_id", "id")
    add("eval_eligible", lambda s, d: evaluation.eligible(held(s, d), "kaz2eng"), "SELECT row_id AS id, kaz AS source, eng AS reference FROM aligned_corpus WHERE coalesce(kaz, '') <> '' AND coalesce(eng, '') <> ''")
    told = f"SELECT row_id AS id, {X.clean_generation_sql('kaz')} AS hyp, rus AS ref FROM aligned_corpus WHERE coalesce(kaz, '') <> '' AND coalesce(rus, '') <> ''"
    add("evaluate_direction", lambda s, d: evaluation.evaluated(held(s, d), "kaz2rus", models.echo_generator).select("direction", "num_samples", "bleu"), f"SELECT 'kaz2rus' AS direction, (SELECT count(*) FROM ({told})) AS num_samples, score AS bleu FROM ({bleu_sql(told)})")
    two = {"echo": models.echo_generator, "constant": lambda prompts: ["тенге"] * len(prompts)}
    constant = "SELECT row_id AS id, 'тенге' AS hyp, rus AS ref FROM aligned_corpus WHERE coalesce(kaz, '') <> '' AND coalesce(rus, '') <> ''"
    add("compare_models", lambda s, d: evaluation.compared(held(s, d), "kaz2rus", two).select("model", "bleu"), f"SELECT 'echo' AS model, score AS bleu FROM ({bleu_sql(told)}) UNION ALL SELECT 'constant', score FROM ({bleu_sql(constant)})")
    # --- the phases in one ---
    sides = {x: f"CASE WHEN {x} = '' THEN {x} ELSE {X.clean_text_sql(U.nfkc_sql(x))} END AS {x}" for x in ("kaz", "rus", "eng")}
    add(
        "pipeline_cleaned",
        lambda s, d: pipeline.cleaned(wide(s, d, "aligned_corpus", "row_id", "id", "kaz", "rus", "eng", "similarity_kaz_rus", "similarity_kaz_eng"), "row_id", pipeline.Settings(limits=lim)).select("row_id", "id", "kaz", "rus", "eng"),
        f"WITH c AS (SELECT row_id, id, {', '.join(sides.values())}, similarity_kaz_rus, similarity_kaz_eng FROM aligned_corpus), g AS (SELECT * FROM c WHERE {quality.triplet_reason_sql(lim)} IS NULL) SELECT row_id, id, kaz, rus, eng FROM (SELECT *, row_number() OVER (PARTITION BY {X.dedup_key_sql('kaz')} ORDER BY row_id) AS n FROM g) WHERE n = 1",
    )
    add("pipeline_documents", lambda s, d: pipeline.documents(t(s, d, "extraction_results")).select("collection", "source_file", "language", F.length("text").alias("chars")), f"SELECT collection, filename AS source_file, {X.LANGUAGE_SQL.format('filename')} AS language, length(text_only)::INT AS chars FROM (SELECT *, row_number() OVER (PARTITION BY collection, filename ORDER BY extract_id DESC) AS n FROM extraction_results WHERE success AND text_only IS NOT NULL) WHERE n = 1")
    # --- streams and files ---
    def stream(s: SparkSession, d: str) -> DataFrame:
        schema = s.read.parquet(f"{d}/events.parquet").schema
        live = s.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d).withColumn("ts", F.col("ts").cast("timestamp"))
        return streaming.run_available(streaming.first_events(live, "event_id", "ts"))

    add("stream_dedup", stream, "SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts) AS n FROM events) WHERE n = 1")


_register()


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


