"""The queries of the text operators: thin calls of the operators with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chunk_codec import codec_report
from .common import table
from .decontam import contaminated
from .lang_id import language_report
from .line_dedup import line_report
from .near_dedup import near_duplicate_report
from .packing import pack
from .quality_lm import quality_report
from .quality_rules import judge
from .source_audit import divergence
from .token_counts import count_tokens
from .toxicity import toxicity_report
from .url_filter import url_report
from .vector_codes import code_report


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op4_quality_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Rules of the URL query: host and path, and whether they allow.
URL_RULES = [("com/en/", False), ("example.com/en/7", True), ("net/de/", True), ("example.net/de/8", False), ("org/es/", False)]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_report(table(spark, sf_dir, "pages"), URL_RULES)


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_report(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_report(table(spark, sf_dir, "embeddings"))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


def op13_chunk_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec_report(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


LINE_DEDUP_SQL = r"""
WITH lines AS (SELECT doc_id, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.last AS gone FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


#: Assigns parts to entries; {0} is the table of entries (part, entry, pos, c), {1} the name of the result.
ASSIGN_SQL = """
{1}_d AS (SELECT vec_row, x.part, entry, CAST(sum((v - c) * (v - c)) AS BIGINT) AS d FROM x JOIN {0} b ON b.part = x.part AND b.pos = x.pos GROUP BY ALL),
{1} AS (SELECT vec_row, part, min(entry) AS entry, any_value(d) AS d FROM (SELECT *, min(d) OVER (PARTITION BY vec_row, part) AS least FROM {1}_d) WHERE d = least GROUP BY vec_row, part)"""
#: Entries of {0} replaced by the floors of the means of the parts that {1} has assigned to them.
UPDATE_SQL = """
{2} AS (SELECT b.part, b.entry, b.pos, coalesce(m.c, b.c) AS c FROM {0} b LEFT JOIN (
    SELECT x.part, a.entry, x.pos, CAST(floor(CAST(sum(v) AS DOUBLE) / count(*)) AS BIGINT) AS c FROM x JOIN {1} a ON a.vec_row = x.vec_row AND a.part = x.part GROUP BY ALL) m
    ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos)"""
VECTOR_CODES_SQL = (
    """
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS vec_row, vec_id, label, embedding FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
flat AS (SELECT vec_row, len(embedding) // 4 AS width, unnest(embedding) AS e, generate_subscripts(embedding, 1) - 1 AS i FROM kept),
x AS (SELECT vec_row, CAST(i // width AS BIGINT) AS part, CAST(i % width AS BIGINT) AS pos, CAST(floor(CAST(e AS DOUBLE) * 1024) AS BIGINT) AS v FROM flat),
b0 AS (SELECT part, vec_row AS entry, pos, v AS c FROM x WHERE vec_row < 256),"""
    + ",".join(ASSIGN_SQL.format(f"b{k}", f"a{k}") + "," + UPDATE_SQL.format(f"b{k}", f"a{k}", f"b{k + 1}") for k in range(4))
    + ","
    + ASSIGN_SQL.format("b4", "final")
    + """,
coded AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM kept JOIN final USING (vec_row) GROUP BY vec_row, vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b4) AS codebooks_sha256
FROM coded
"""
)


SOURCE_AUDIT_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
found AS (SELECT doc, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM found GROUP BY ALL HAVING count(DISTINCT doc) >= 30),
grp AS (SELECT DISTINCT lang, source FROM docs),
cell AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM grp g JOIN kept k ON k.lang = g.lang
    LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM found GROUP BY ALL) c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT *, 1 + (1000000000 * CAST(n + 5 AS HUGEINT)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p FROM cell),
q0 AS (SELECT lang, term, sum(n) AS n FROM cell GROUP BY ALL),
q AS (SELECT *, 1 + (1000000000 * CAST(n + 5 AS HUGEINT)) // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q FROM q0),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) d
    ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
term AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - q.q AS value FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op10_line_dedup": LINE_DEDUP_SQL, "op11_vector_codes": VECTOR_CODES_SQL, "op12_source_audit": SOURCE_AUDIT_SQL}
