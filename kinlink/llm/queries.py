"""The corpus operators as queries over the driver's tables, with their DuckDB oracles.

The operators return real outputs (texts, spans, files); the digest columns of
the contracts are derived here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.llm import decontam, katz, langid, licenses, lines, packing, quality, simhash, spans, tokenfile
from kinlink.llm.common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), words_each=3, max_bits=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), min_match=5, min_coverage=0.8)
    return out.select("doc_id", "item_id", "matched", "item_tokens", "coverage", F.size("tiles").cast("long").alias("n_tiles"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    out = langid.predict(docs, langid.train(docs, ~held_out))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spans.dedup_spans(table(spark, sf_dir, "documents"), run_length=3, min_words=28)
    return out.select("doc_id", "n_sentences", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), seq_len=1024, end_id=0)


def op8_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 != 0, F.lit(True))
    out = katz.score(table(spark, sf_dir, "documents"), fold)
    return out.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(table(spark, sf_dir, "documents"), wrapped=True)
    return out.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=0)


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_simhash_near_dedup, op3_benchmark_decontamination, op4_language_id, op5_substring_dedup, op6_quality_rules, op7_packing, op8_katz_backoff, op9_license_scan, op10_token_files)}

ORACLES = {
    "op1_line_dedup": r"""
WITH l AS (SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
hot AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(hot.key) AS n_dropped, sha256(coalesce(string_agg(CASE WHEN hot.key IS NULL THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM k LEFT JOIN hot USING (key) GROUP BY doc_id""",
    "op6_quality_rules": rf"""
WITH w AS (SELECT d.doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents d),
g AS (SELECT doc_id, i, list_slice(words, i, i + 4) AS window_words FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w)),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, window_words) AS n FROM g) WHERE n > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, stratum, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_full_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
v AS (SELECT *, least({", ".join("CASE" + "".join(f" WHEN n_words > 0 AND CAST({r.value} AS DOUBLE) > {c} THEN {j}" for j, c in enumerate(r.cutoffs)) + " END" for r in quality.RULES)}) AS rejected_at FROM b),
k AS (SELECT stratum, level, count(*) AS n, count(*) FILTER (rejected_at <= level) AS k FROM v JOIN labels USING (doc_id), range({len(quality.RULES[0].cutoffs)}) AS levels(level) WHERE quality = 1 AND NOT base_failed GROUP BY ALL),
unsafe AS (SELECT stratum, level FROM (SELECT *, (SELECT count(DISTINCT stratum) FROM k) AS tests FROM k)
  WHERE k >= n * 0.02 OR list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.02) + (n - i) * ln(0.98)))) > 0.05 / tests),
chosen AS (SELECT stratum, max(level) AS level FROM k WHERE level < coalesce((SELECT min(u.level) FROM unsafe u WHERE u.stratum = k.stratum), 99) GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(rejected_at > level, true) AS kept FROM v LEFT JOIN chosen USING (stratum)""",
    "op9_license_scan": rf"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM d),
p(phrase, label) AS (VALUES {", ".join(f"({p.split()}, '{x}')" for p, x in licenses.PHRASES.items())}),
f AS (SELECT doc_id, i, label FROM (SELECT doc_id, words, unnest(range(0, len(words))) AS i FROM w) JOIN p ON list_slice(words, i + 1, i + len(phrase)) = phrase),
base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM f GROUP BY doc_id),
x(label, tokens) AS (VALUES {", ".join(f"('{x}', {licenses.template_words(t)})" for x, t in licenses.TEMPLATES)}),
l AS (SELECT doc_id, list_distinct(regexp_extract_all(line, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS tokens FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
own AS (SELECT doc_id, label, len(list_intersect(l.tokens, x.tokens)) / len(x.tokens) AS containment FROM l, x WHERE len(list_intersect(l.tokens, x.tokens)) >= ceil(0.8 * len(x.tokens) - 1e-9)),
both_labels AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM own UNION ALL SELECT doc_id, label FROM f) GROUP BY doc_id),
best AS (SELECT doc_id, max(containment) AS containment FROM own GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(containment, 0) END AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN both_labels USING (doc_id) LEFT JOIN best USING (doc_id)""",
}
