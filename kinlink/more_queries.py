"""More linkage queries with their DuckDB oracles, by operator family; inputs as in ``kinlink.queries``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.functions import columns as C
from kinlink.operators import blocking, decide, features, labels, metrics, models, normalize, vectors
from kinlink.queries import DECIDE, ENTITIES, PRM, RECORDS, SCORED, TALLY, WORDS, _selected, _tallies, entities, records, scored, table
from kinlink.sources import sinks, tables
from kinlink.sources.store import kept

ORACLES: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


# ---- sources and lists


def er_row_order(spark, d):
    """Rows with their place in the table."""
    return tables.numbered(table(spark, d, "orders").select("o_orderkey"))


ORACLES["er_row_order"] = "SELECT o_orderkey, row_number() OVER () - 1 AS row_order FROM orders"


def er_load_stats(spark, d):
    """What a source table holds before empty and repeated ids go; every seventh id is empty, and customers repeat theirs."""
    rows = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 7 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("id"), F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.col("o_orderpriority")).alias("name"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderstatus")).alias("address"))
    return tables.source_stats(rows)


ORACLES["er_load_stats"] = """WITH x AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS id, o_orderkey % 5 = 0 AS no_name, o_orderkey % 3 = 0 AS no_address FROM orders)
SELECT count(*) AS n_rows, count(*) FILTER (id = '') AS empty_id_dropped, count(*) FILTER (id <> '' AND no_name) AS empty_name, count(*) FILTER (id <> '' AND no_address) AS empty_address,
  count(*) FILTER (id <> '' AND no_name AND no_address) AS empty_name_and_address, count(*) FILTER (id <> '') - count(DISTINCT id) FILTER (id <> '') AS duplicate_ids FROM x"""


def _label_rows(spark, d):
    li = table(spark, d, "lineitem")
    raw = li.select(F.col("l_orderkey").cast("string").alias("s"), F.col("l_linenumber").alias("row_order"), F.concat(F.lit("["), F.col("l_partkey").cast("string"), F.lit("]")).alias("m2"), F.concat_ws(", ", F.col("l_suppkey").cast("string"), F.col("l_suppkey").cast("string")).alias("m3"))
    return tables.project_labels(raw, "s", ["m2", "m3"])


def er_label_union(spark, d):
    """Label rows of one entity united; ids sorted for comparison."""
    return _label_rows(spark, d).select("s1_id", *(F.array_join(F.array_sort(c), ";").alias(c) for c in ("m2", "m3", "all_ids")))


ORACLES["er_label_union"] = """WITH x AS (SELECT CAST(l_orderkey AS VARCHAR) AS s1_id, CAST(l_partkey AS VARCHAR) AS a, CAST(l_suppkey AS VARCHAR) AS b FROM lineitem)
SELECT s1_id, array_to_string(list_sort(list_distinct(list(a))), ';') AS m2, array_to_string(list_sort(list_distinct(list(b))), ';') AS m3, array_to_string(list_sort(list_distinct(list(a) || list(b))), ';') AS all_ids FROM x GROUP BY s1_id"""


def er_label_sizes(spark, d):
    return tables.label_sizes(_label_rows(spark, d))


ORACLES["er_label_sizes"] = """SELECT CAST(size AS INTEGER) AS size, count(*) AS n FROM (SELECT len(list_distinct(list(CAST(l_partkey AS VARCHAR)) || list(CAST(l_suppkey AS VARCHAR)))) AS size FROM lineitem GROUP BY l_orderkey) GROUP BY 1"""


def er_label_stats(spark, d):
    return rounded(tables.label_stats(_label_rows(spark, d)))


ORACLES["er_label_stats"] = """WITH x AS (SELECT len(list_distinct(list(CAST(l_partkey AS VARCHAR)) || list(CAST(l_suppkey AS VARCHAR)))) AS size FROM lineitem GROUP BY l_orderkey)
SELECT count(*) AS entities, count(*) FILTER (size = 0) AS singletons, round(avg(CAST(size = 0 AS DOUBLE)), 6) AS singleton_rate, CAST(sum(size) AS BIGINT) AS total_label_ids FROM x"""


def er_list_styles(spark, d):
    """How most lists of each priority are written; those of even customers are in brackets."""
    rows = table(spark, d, "orders").select("o_orderpriority", F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("["), F.col("o_custkey").cast("string"), F.lit("]"))).when(F.col("o_custkey") % 7 == 0, "").otherwise("1,2").alias("x"))
    return rows.groupBy("o_orderpriority").agg(C.list_style(F.col("x")).alias("style"))


ORACLES["er_list_styles"] = "SELECT o_orderpriority, CASE WHEN avg(CASE WHEN o_custkey % 2 = 0 THEN 1.0 WHEN o_custkey % 7 = 0 THEN NULL ELSE 0.0 END) > 0.5 THEN 'bracketed' ELSE 'plain' END AS style FROM orders GROUP BY 1"


def er_squeezed(spark, d):
    """White space squeezed, whole texts."""
    return table(spark, d, "benchmark").select("item_id", F.md5(C.squeezed(F.concat(F.lit(" \t"), "text", F.lit("\n ")))).alias("md5"))


ORACLES["er_squeezed"] = r"SELECT item_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS md5 FROM benchmark"


def er_address_join(spark, d):
    """Columns of an address joined; empty ones leave no separators."""
    c = table(spark, d, "customer")
    return c.select("c_custkey", C.joined([F.col("c_name"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment")), F.when(F.col("c_custkey") % 2 == 0, F.lit(None)).otherwise(F.col("c_nationkey").cast("string"))]).alias("address"))


ORACLES["er_address_join"] = "SELECT c_custkey, concat_ws(', ', c_name, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END, CASE WHEN c_custkey % 2 <> 0 THEN CAST(c_nationkey AS VARCHAR) END) AS address FROM customer"


def er_soundex(spark, d):
    """Soundex of the first word, where no Metaphone is wanted."""
    return table(spark, d, "part").select("p_partkey", F.soundex(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("soundex"))


# ---- names and addresses


def parts(spark, d):
    """Parts as records: '<name> <brand> Incorporated' at '<size> <type> Street, Springfield, TX <zip>'."""
    p = table(spark, d, "part")
    name = F.concat_ws(" ", "p_name", F.replace("p_brand", F.lit("#"), F.lit(" ")), F.lit("Incorporated"))
    address = F.concat(F.col("p_size").cast("string"), F.lit(" "), F.initcap("p_type"), F.lit(" Street, Springfield, TX "), (75000 + F.col("p_partkey") % 500).cast("string"))
    return p.select(F.col("p_partkey").cast("string").alias("id"), name.alias("name"), address.alias("address"), F.col("p_partkey").alias("row_order"), (F.col("p_partkey") % 3 + 1).cast("int").alias("source"))


PARTS = """p AS (SELECT p_partkey AS i, p_partkey % 3 + 1 AS source, lower(p_name) || ' ' || lower(replace(p_brand, '#', ' ')) AS core, lower(p_name || replace(p_brand, '#', '')) AS flat, replace(p_brand, 'Brand#', '') AS digits,
  CAST(p_size AS VARCHAR) AS hn, lower(p_type) || ' st' AS road, CAST(75000 + p_partkey % 500 AS VARCHAR) AS pc FROM part)"""


def er_names(spark, d):
    """Names parsed: legal form, core, initials, digits."""
    out = normalize.normalised(parts(spark, d))
    return out.select("id", "name_clean", "name_core", "name_tokens", "name_nospace", "name_suffix", "name_suffix_family", "name_legal_prefix", "name_title", "name_initials", "name_digits")


ORACLES["er_names"] = f"""WITH {PARTS} SELECT CAST(i AS VARCHAR) AS id, core || ' incorporated' AS name_clean, core AS name_core, core AS name_tokens, replace(core, ' ', '') AS name_nospace, 'inc' AS name_suffix, 'corporation' AS name_suffix_family, '' AS name_legal_prefix, '' AS name_title,
  array_to_string(list_transform(string_split(core, ' '), lambda x: x[1]), '') AS name_initials, digits AS name_digits FROM p"""


def er_addresses(spark, d):
    """Addresses parsed, with the keys made of them."""
    out = normalize.normalised(parts(spark, d))
    return out.select("id", "addr_house_number", "addr_road", "addr_unit", "addr_city", "addr_state", "addr_postcode", "addr_country", "addr_landmark", "addr_suburb", "addr_numbers", "addr_street_key", "city_state_key")


ORACLES["er_addresses"] = f"""WITH {PARTS} SELECT CAST(i AS VARCHAR) AS id, hn AS addr_house_number, road AS addr_road, '' AS addr_unit, 'springfield' AS addr_city, 'tx' AS addr_state, pc AS addr_postcode, '' AS addr_country, '' AS addr_landmark, '' AS addr_suburb, hn AS addr_numbers,
  hn || '|' || string_split(road, ' ')[1] AS addr_street_key, 'springfield|tx' AS city_state_key FROM p"""


def er_block_keys(spark, d):
    """The keys that records are blocked by (those without phonetics)."""
    keys = {m: k for m, k in blocking.block_keys().items() if "phonetic" not in m}
    return blocking.keyed(normalize.normalised(parts(spark, d)), keys, "id")


ORACLES["er_block_keys"] = f"""WITH {PARTS}, k AS (SELECT CAST(i AS VARCHAR) AS id, unnest([{{'method': 'name_prefix', 'key': substr(replace(core, ' ', ''), 1, 4)}}, {{'method': 'postcode', 'key': pc}}, {{'method': 'city_state', 'key': 'springfield|tx'}},
  {{'method': 'address_key', 'key': hn || '|' || string_split(road, ' ')[1]}}], recursive := true) FROM p) SELECT id, method, key FROM k"""


def er_record_stats(spark, d):
    return normalize.record_stats(normalize.normalised(parts(spark, d)))


ORACLES["er_record_stats"] = f"WITH {PARTS} SELECT CAST(source AS INTEGER) AS source, count(*) AS records, CAST(0 AS BIGINT) AS empty_core_name, count(*) AS with_legal_suffix, count(*) AS with_postcode, count(*) AS with_house_number, count(*) AS with_city, count(*) AS with_state, CAST(0 AS BIGINT) AS with_unit, CAST(0 AS BIGINT) AS with_landmark FROM p GROUP BY source"


def er_top_suffixes(spark, d):
    """The commonest legal forms; a third of the names have another one."""
    rows = parts(spark, d).withColumn("name", F.when(F.col("source") == 2, F.replace("name", F.lit("Incorporated"), F.lit("Pvt. Ltd."))).otherwise(F.col("name")))
    return normalize.top_suffixes(normalize.normalised(rows)).withColumnRenamed("count", "n")


ORACLES["er_top_suffixes"] = "SELECT CASE WHEN p_partkey % 3 = 1 THEN 'pvt ltd' ELSE 'inc' END AS name_suffix, count(*) AS n FROM part GROUP BY 1"


def er_encoder_text(spark, d):
    """Records as lines for encoders: plain, and with tagged columns."""
    p = parts(spark, d)
    return p.select("id", normalize.serialised(p).alias("line"), normalize.ditto(F.col("name"), F.col("address"), F.regexp_extract("address", r"(\d+)$", 1), F.lit("")).alias("ditto"))


ORACLES["er_encoder_text"] = r"""WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name || ' ' || replace(p_brand, '#', ' ') || ' Incorporated' AS name, CAST(p_size AS VARCHAR) || ' ' || upper(p_type[1]) || lower(p_type[2:]) || ' Street, Springfield, TX ' || CAST(75000 + p_partkey % 500 AS VARCHAR) AS address, CAST(75000 + p_partkey % 500 AS VARCHAR) AS pc FROM part)
SELECT id, name || ' | ' || address AS line, 'COL name VAL ' || name || ' COL address VAL ' || regexp_replace(address, '(\d+)', '[NUM] \1', 'g') || ' [PC] ' || pc AS ditto FROM p"""


# ---- pairs and their features


def _part_pairs(spark, d, only):
    """Features of each part and the next one."""
    rows = parts(spark, d)
    tasks = max(1, -(-rows.count() // features.PAIRS_EACH))  # records are few bytes but much work
    n = kept(normalize.normalised(rows.repartition(tasks, "id")), "normalised")
    v = n.withColumns({"v_idx": F.col("row_order"), "source": F.lit(2)})
    s1 = n.withColumn("s1_idx", F.col("row_order"))
    pairs = blocking.flags(n.select(F.col("row_order").alias("s1_idx"), (F.col("row_order") + 1).alias("v_idx"), F.lit(2).alias("source"), F.lit(3).alias("blk_flags")).join(v.select("v_idx"), "v_idx", "left_semi"))
    return features.pair_features(pairs, s1, v, kept, only)


NEXT = f"WITH {PARTS}, x AS (SELECT a.i AS s1_idx, b.i AS v_idx, a.core AS c1, b.core AS c2, a.flat AS f1, b.flat AS f2, a.digits AS d1, b.digits AS d2, a.hn AS h1, b.hn AS h2, a.road AS r1, b.road AS r2, a.pc AS p1, b.pc AS p2, string_split(a.core, ' ') AS w1, string_split(b.core, ' ') AS w2 FROM p a JOIN p b ON b.i = a.i + 1)"


def er_feature_names(spark, d):
    """Name features: exact, edit, prefix, length."""
    names = ("name_exact_raw", "name_exact_clean", "name_exact_core", "name_exact_nospace", "name_lev", "name_jw", "name_prefix4_eq", "name_common_prefix", "name_first_token_eq", "name_len_1", "name_len_2", "name_len_ratio", "name_ntok_1", "name_ntok_2", "name_contains", "name_digits_eq", "suffix_present_1", "suffix_eq", "suffix_family_eq", "suffix_conflict")
    return rounded(_part_pairs(spark, d, names).select("s1_idx", "v_idx", *names))


ORACLES["er_feature_names"] = NEXT + """ SELECT s1_idx, v_idx, CAST(c1 = c2 AS DOUBLE) AS name_exact_raw, CAST(c1 = c2 AS DOUBLE) AS name_exact_clean, CAST(c1 = c2 AS DOUBLE) AS name_exact_core, CAST(f1 = f2 AS DOUBLE) AS name_exact_nospace_,
  round(1 - levenshtein(c1, c2) / greatest(length(c1), length(c2)), 6) AS name_lev, round(jaro_winkler_similarity(c1, c2), 6) AS name_jw, CAST(substr(replace(c1, ' ', ''), 1, 4) = substr(replace(c2, ' ', ''), 1, 4) AS DOUBLE) AS name_prefix4_eq,
  CAST(list_max(list_filter(range(0, least(length(replace(c1, ' ', '')), length(replace(c2, ' ', ''))) + 1), lambda n: substr(replace(c1, ' ', ''), 1, n) = substr(replace(c2, ' ', ''), 1, n))) AS DOUBLE) AS name_common_prefix,
  CAST(w1[1] = w2[1] AS DOUBLE) AS name_first_token_eq, CAST(length(replace(c1, ' ', '')) AS DOUBLE) AS name_len_1, CAST(length(replace(c2, ' ', '')) AS DOUBLE) AS name_len_2,
  round(least(length(replace(c1, ' ', '')), length(replace(c2, ' ', ''))) / greatest(length(replace(c1, ' ', '')), length(replace(c2, ' ', ''))), 6) AS name_len_ratio, CAST(len(w1) AS DOUBLE) AS name_ntok_1, CAST(len(w2) AS DOUBLE) AS name_ntok_2,
  CAST(contains(replace(c1, ' ', ''), replace(c2, ' ', '')) OR contains(replace(c2, ' ', ''), replace(c1, ' ', '')) AS DOUBLE) AS name_contains, CAST(d1 = d2 AS DOUBLE) AS name_digits_eq, 1.0::DOUBLE AS suffix_present_1, 1.0::DOUBLE AS suffix_eq, 1.0::DOUBLE AS suffix_family_eq, 0.0::DOUBLE AS suffix_conflict FROM x""".replace("name_exact_nospace_", "name_exact_nospace")


def er_feature_addresses(spark, d):
    """Address features: presence, equality, conflicts, numbers."""
    names = ("addr_missing_1", "addr_exact", "house_number_both", "road_both", "unit_both", "hn_eq", "hn_conflict", "city_eq", "city_conflict", "state_eq", "state_conflict", "pc_eq", "pc_conflict", "pc_prefix3_eq", "road_jw", "num_jaccard", "num_conflict", "unit_eq", "landmark_1")
    return rounded(_part_pairs(spark, d, names).select("s1_idx", "v_idx", *names))


ORACLES["er_feature_addresses"] = NEXT + """ SELECT s1_idx, v_idx, 0.0::DOUBLE AS addr_missing_1, CAST(h1 = h2 AND r1 = r2 AND p1 = p2 AS DOUBLE) AS addr_exact, 1.0::DOUBLE AS house_number_both, 1.0::DOUBLE AS road_both, 0.0::DOUBLE AS unit_both, CAST(h1 = h2 AS DOUBLE) AS hn_eq, CAST(h1 <> h2 AS DOUBLE) AS hn_conflict,
  1.0::DOUBLE AS city_eq, 0.0::DOUBLE AS city_conflict, 1.0::DOUBLE AS state_eq, 0.0::DOUBLE AS state_conflict, CAST(p1 = p2 AS DOUBLE) AS pc_eq, CAST(p1 <> p2 AS DOUBLE) AS pc_conflict, CAST(substr(p1, 1, 3) = substr(p2, 1, 3) AS DOUBLE) AS pc_prefix3_eq,
  round(jaro_winkler_similarity(r1, r2), 6) AS road_jw, CAST(h1 = h2 AS DOUBLE) AS num_jaccard, CAST(h1 <> h2 AS DOUBLE) AS num_conflict, CAST(NULL AS DOUBLE) AS unit_eq, 0.0::DOUBLE AS landmark_1 FROM x"""


def er_feature_tokens(spark, d):
    """Token features: overlap, and overlap weighted by idf."""
    names = ("name_tok_jaccard", "name_tok_overlap_min", "name_idf_overlap", "name_max_shared_idf", "name_unshared_idf", "addr_tok_jaccard")
    return rounded(_part_pairs(spark, d, names).select("s1_idx", "v_idx", *names))


ORACLES["er_feature_tokens"] = NEXT + """, t AS (SELECT i, unnest(list_distinct(string_split(core, ' '))) AS t FROM p), idf AS (SELECT t, ln((2 * (SELECT count(*) FROM p) + 1.0) / (2 * count(*) + 1.0)) + 1 AS idf FROM t GROUP BY t),
y AS (SELECT *, list_intersect(w1, w2) AS met, list_distinct(w1 || w2) AS every, string_split(h1 || ' ' || r1 || ' springfield tx ' || p1, ' ') AS a1, string_split(h2 || ' ' || r2 || ' springfield tx ' || p2, ' ') AS a2 FROM x),
z AS (SELECT s1_idx, sum(idf) AS every_idf, coalesce(sum(idf) FILTER (list_contains(met, t)), 0) AS met_idf, coalesce(max(idf) FILTER (list_contains(met, t)), 0) AS top_idf FROM (SELECT s1_idx, met, unnest(every) AS t FROM y) JOIN idf USING (t) GROUP BY s1_idx)
SELECT s1_idx, v_idx, round(len(met) / len(every), 6) AS name_tok_jaccard, round(len(met) / least(len(list_distinct(w1)), len(list_distinct(w2))), 6) AS name_tok_overlap_min, round(met_idf / every_idf, 6) AS name_idf_overlap, round(top_idf, 6) AS name_max_shared_idf, round(every_idf - met_idf, 6) AS name_unshared_idf,
  round(len(list_intersect(a1, a2)) / len(list_distinct(a1 || a2)), 6) AS addr_tok_jaccard FROM y JOIN z USING (s1_idx)"""


def er_feature_combined(spark, d):
    """Features made of others."""
    names = ("addr_components_agree", "addr_components_conflict", "addr_components_both", "contradictions", "blk_n_methods_syntactic")
    return rounded(_part_pairs(spark, d, names).select("s1_idx", "v_idx", *names))


ORACLES["er_feature_combined"] = NEXT + """ SELECT s1_idx, v_idx, 2.0 + CAST(h1 = h2 AS DOUBLE) + CAST(jaro_winkler_similarity(r1, r2) >= 0.9 AS DOUBLE) + CAST(p1 = p2 AS DOUBLE) AS addr_components_agree, CAST(h1 <> h2 AS DOUBLE) + CAST(p1 <> p2 AS DOUBLE) AS addr_components_conflict,
  5.0::DOUBLE AS addr_components_both, 2 * CAST(h1 <> h2 AS DOUBLE) + CAST(p1 <> p2 AS DOUBLE) AS contradictions, 2.0::DOUBLE AS blk_n_methods_syntactic FROM x"""


def _context(spark, d):
    rows = scored(spark, d).withColumns({"full_char_cos": F.col("p_final"), "name_soft_tfidf": (F.col("v_idx") * 13 % 101) / 101.0, "name_char_cos": (F.col("v_idx") * 17 % 103) / 103.0})
    return features.context(rows)


def er_context(spark, d):
    """The standing of each pair in its entity and source, and among the rivals for its vendor."""
    return rounded(_context(spark, d).select("s1_idx", "v_idx", "ctx_rank", "ctx_gap_to_best", "ctx_margin", "ctx_n_cands", "ctx_name_rank", "ctx_v_rank", "ctx_v_n_s1", "ctx_mutual_best"))


ORACLES["er_context"] = f"""WITH {SCORED}, b AS (SELECT *, 0.5 * p_final + 0.5 * ((v_idx * 13 % 101) / 101.0::DOUBLE) AS x, (v_idx * 17 % 103) / 103.0::DOUBLE AS y FROM s),
w AS (SELECT *, rank() OVER (PARTITION BY s1_idx, source ORDER BY x DESC) AS r, max(x) OVER (PARTITION BY s1_idx, source) AS top, coalesce(nth_value(x, 2) OVER (PARTITION BY s1_idx, source ORDER BY x DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), -1) AS sec, count(*) OVER (PARTITION BY s1_idx, source) AS n,
  rank() OVER (PARTITION BY s1_idx, source ORDER BY y DESC) AS nr, rank() OVER (PARTITION BY v_idx ORDER BY x DESC) AS vr, count(*) OVER (PARTITION BY v_idx) AS vn FROM b)
SELECT s1_idx, v_idx, CAST(r AS DOUBLE) AS ctx_rank, round(top - x, 6) AS ctx_gap_to_best, round(x - CASE WHEN x >= top THEN sec ELSE top END, 6) AS ctx_margin, CAST(n AS DOUBLE) AS ctx_n_cands, CAST(nr AS DOUBLE) AS ctx_name_rank, CAST(vr AS DOUBLE) AS ctx_v_rank, CAST(least(vn, 20) AS DOUBLE) AS ctx_v_n_s1, CAST(r = 1 AND vr = 1 AS DOUBLE) AS ctx_mutual_best FROM w"""


# ---- blocking


def _word_vectors(spark, d):
    r = records(spark, d).select(F.col("row_order").alias("rec"), "source", "name")
    p = kept(vectors.postings(r, C.words(F.col("name")), 0.1), "words").join(r.select("rec", "source"), "rec")
    return p.filter("source = 1").drop("source"), p.filter("source > 1")


def er_cosines(spark, d):
    """The cosine of each page of source 1 and the page after it."""
    pairs = records(spark, d).filter("source = 1").select(F.col("row_order").alias("s1_idx"), (F.col("row_order") + 1).alias("v_idx"))
    return rounded(vectors.cosines(pairs, *_word_vectors(spark, d), "cosine"))


ORACLES["er_cosines"] = WORDS + ", q AS (SELECT row_order AS s1_idx, row_order + 1 AS v_idx FROM r WHERE source = 1) SELECT s1_idx, v_idx, round(coalesce((SELECT sum(a.w * b.w) FROM w a JOIN w b USING (term) WHERE a.rec = s1_idx AND b.rec = v_idx), 0), 6) AS cosine FROM q"


def er_ranked_blocks(spark, d):
    """Blocks by the first letter of the title: of larger ones the eight closest of each source."""
    r, v = records(spark, d), _word_vectors(spark, d)
    keys = {"name_prefix": F.substring("name", 1, 1)}
    pairs = blocking.key_blocks(blocking.keyed(r.filter("source = 1").withColumn("s1_idx", F.col("row_order")), keys, "s1_idx"), blocking.keyed(r.filter("source > 1").withColumn("v_idx", F.col("row_order")), keys, "v_idx", "source"))
    return blocking.ranked_blocks(pairs, {"name_prefix": 8}, {"full_char": tuple(x.withColumn("w", F.round("w", 9)) for x in v)})


ORACLES["er_ranked_blocks"] = WORDS + """, k AS (SELECT *, substr(name, 1, 1) AS key FROM r WHERE name <> ''), z AS (SELECT key, source, count(*) AS size FROM k WHERE source > 1 GROUP BY ALL HAVING count(*) <= 2000),
f AS (SELECT a.row_order AS s1_idx, b.row_order AS v_idx, b.source, size FROM k a JOIN k b USING (key) JOIN z ON z.key = a.key AND z.source = b.source WHERE a.source = 1 AND b.source > 1),
c AS (SELECT a.rec AS s1_idx, b.rec AS v_idx, sum(round(a.w, 9) * round(b.w, 9)) AS sim FROM w a JOIN w b USING (term) WHERE a.source = 1 AND b.source > 1 GROUP BY ALL)
SELECT s1_idx, v_idx, source, 'name_prefix' AS method FROM f WHERE size <= 8 UNION ALL
SELECT s1_idx, v_idx, source, 'name_prefix' FROM (SELECT f.*, coalesce(sim, 0) AS sim FROM f LEFT JOIN c USING (s1_idx, v_idx) WHERE size > 8 QUALIFY row_number() OVER (PARTITION BY s1_idx, source ORDER BY coalesce(sim, 0) DESC, v_idx) <= 8)"""


def _found(spark, d):
    return scored(spark, d).withColumn("blk_flags", F.when(F.col("v_idx") % 3 == 0, 1).when(F.col("v_idx") % 3 == 1, 8).otherwise(9))


def er_blocking_report(spark, d):
    """Recall and reduction of candidates (pairs from 0.3 on) by method, source and split of entities."""
    rows = _found(spark, d)
    s1, v = table(spark, d, "orders").select(F.col("o_orderkey").alias("s1_idx")), table(spark, d, "part").select(F.col("p_partkey").alias("v_idx"), (2 + F.col("p_partkey") % 2).alias("source"))
    split = s1.select("s1_idx", F.when(F.col("s1_idx") % 5 == 0, "holdout").otherwise("fit").alias("split"))
    out = blocking.report(rows.filter("p_final >= 0.3"), rows.filter("p_final >= 0.1"), rows.filter("label = 1"), s1, v, split)
    return rounded(out.filter("method in ('all', 'name_prefix', 'city_state')"))


ORACLES["er_blocking_report"] = f"""WITH {SCORED}, m(method, mask) AS (VALUES ('all', 9), ('name_prefix', 1), ('city_state', 8)), x AS (SELECT *, CASE v_idx % 3 WHEN 0 THEN 1 WHEN 1 THEN 8 ELSE 9 END AS f, ['all', 'source_' || source, CASE WHEN s1_idx % 5 = 0 THEN 'split_holdout' ELSE 'split_fit' END] AS parts FROM s),
y AS (SELECT *, unnest(parts) AS part FROM x), h AS (SELECT part, method, count(*) AS true_pairs, count(*) FILTER (p_final >= 0.3 AND f & mask > 0) AS found, CAST(CASE WHEN method = 'all' THEN 0 ELSE count(*) FILTER (p_final >= 0.3 AND f = mask) END AS BIGINT) AS found_alone, count(*) FILTER (p_final >= 0.1) AS found_before_cap FROM y, m WHERE label = 1 GROUP BY part, method),
c AS (SELECT part, count(*) AS candidates FROM y WHERE p_final >= 0.3 GROUP BY part),
o AS (SELECT 'all' AS part, (SELECT count(*) FROM orders) * (SELECT count(*) FROM part) AS possible UNION ALL SELECT 'source_' || (2 + p_partkey % 2), count(*) * (SELECT count(*) FROM orders) FROM part GROUP BY 1 UNION ALL
  SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'split_holdout' ELSE 'split_fit' END, count(*) * (SELECT count(*) FROM part) FROM orders GROUP BY 1)
SELECT part, method, true_pairs, found, found_alone, found_before_cap, round(found / true_pairs, 6) AS completeness, round(found_before_cap / true_pairs, 6) AS completeness_before_cap, candidates, possible, round(1 - candidates / possible, 6) AS reduction_ratio FROM h JOIN c USING (part) JOIN o USING (part)"""


def er_histogram(spark, d):
    """How many entities have how many candidates; every ninth has none."""
    s1 = table(spark, d, "orders").select(F.col("o_orderkey").alias("s1_idx"))
    return blocking.histogram(scored(spark, d).filter("s1_idx % 9 <> 0"), s1)


ORACLES["er_histogram"] = f"""WITH {SCORED}, c AS (SELECT o_orderkey, count(v_idx) AS c FROM orders LEFT JOIN s ON s1_idx = o_orderkey AND s1_idx % 9 <> 0 GROUP BY o_orderkey)
SELECT CAST(CASE WHEN c <= 0 THEN 0 WHEN c <= 5 THEN 5 WHEN c <= 10 THEN 10 WHEN c <= 20 THEN 20 WHEN c <= 50 THEN 50 WHEN c <= 100 THEN 100 WHEN c <= 200 THEN 200 END AS INTEGER) AS up_to, count(*) AS n FROM c GROUP BY 1"""


# ---- labels


def _lists(spark, d):
    """Parts listed for each order by a number that a part of either source may have; some numbers belong to no part."""
    li = table(spark, d, "lineitem")
    lists = li.groupBy(F.col("l_orderkey").cast("string").alias("s1_id")).agg(F.collect_set((F.col("l_partkey") % 1900).cast("string")).alias("all_ids"))
    s1 = table(spark, d, "orders").select(F.col("o_orderkey").alias("s1_idx"), F.col("o_orderkey").cast("string").alias("id"))
    v = table(spark, d, "part").filter("p_partkey % 17 <> 0").select(F.col("p_partkey").alias("v_idx"), (2 + F.col("p_partkey") % 2).alias("source"), (F.col("p_partkey") % 1901).cast("string").alias("id"))
    return lists, s1, v


def _truth(spark, d):
    return labels.resolve(*_lists(spark, d))


LISTED = """WITH i AS (SELECT DISTINCT l_orderkey AS s1_idx, l_partkey % 1900 AS vid FROM lineitem), v AS (SELECT p_partkey AS v_idx, 2 + p_partkey % 2 AS source, p_partkey % 1901 AS vid FROM part WHERE p_partkey % 17 <> 0),
h AS (SELECT s1_idx, vid, v_idx, source, count(v_idx) OVER (PARTITION BY s1_idx, vid) AS n FROM i LEFT JOIN v USING (vid))"""


def er_truth_pairs(spark, d):
    """Ids of lists resolved to records; an id that several records have is left out."""
    return _truth(spark, d).pairs


ORACLES["er_truth_pairs"] = LISTED + " SELECT DISTINCT s1_idx, v_idx, source FROM h WHERE n = 1"


def er_truth_entities(spark, d):
    t = _truth(spark, d).entities
    return t.select("s1_idx", "labeled", F.col("n_true").cast("long"), F.col("n_unresolved").cast("long"))


ORACLES["er_truth_entities"] = LISTED + " SELECT o_orderkey AS s1_idx, true AS labeled, coalesce(t, 0) AS n_true, coalesce(t - f, 0) AS n_unresolved FROM orders LEFT JOIN (SELECT s1_idx, count(DISTINCT vid) AS t, count(*) FILTER (n = 1) AS f FROM h GROUP BY s1_idx) ON s1_idx = o_orderkey"


def er_uncertain(spark, d):
    """Pairs of listed ids whose record the list does not tell."""
    return _truth(spark, d).uncertain


ORACLES["er_uncertain"] = LISTED + " SELECT DISTINCT s1_idx, v_idx FROM h WHERE n > 1"


def er_resolved_labels(spark, d):
    """Pairs labelled by the resolved lists: true, false or uncertain."""
    return labels.attach_lists(scored(spark, d).drop("label"), *_lists(spark, d)).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


ORACLES["er_resolved_labels"] = LISTED.replace("WITH", f"WITH {SCORED},", 1) + ", t AS (SELECT DISTINCT s1_idx, v_idx, CASE WHEN n = 1 THEN 1 ELSE -1 END AS l FROM h WHERE n > 0) SELECT CAST(coalesce(l, 0) AS INTEGER) AS label, count(*) AS n FROM s LEFT JOIN t USING (s1_idx, v_idx) GROUP BY 1"


def er_shared_vendors(spark, d):
    return labels.shared_vendors(scored(spark, d).filter("label = 1"))


ORACLES["er_shared_vendors"] = f"WITH {SCORED} SELECT v_idx, count(DISTINCT s1_idx) AS n_s1 FROM s WHERE label = 1 GROUP BY v_idx HAVING count(DISTINCT s1_idx) > 1"


def er_negative_pool(spark, d):
    return labels.negative_pool(table(spark, d, "part").select(F.col("p_partkey").alias("v_idx")), scored(spark, d).filter("label = 1"))


ORACLES["er_negative_pool"] = f"WITH {SCORED} SELECT p_partkey AS v_idx FROM part WHERE p_partkey NOT IN (SELECT v_idx FROM s WHERE label = 1)"


def er_negative_types(spark, d):
    """Of what kinds the negatives are."""
    x = F.col("v_idx")
    rows = scored(spark, d).filter("label = 0").withColumns({"addr_char_cos": (x * 13 % 101) / 101.0, "hn_eq": (x % 2).cast("double"), "pc_eq": (x % 3 == 0).cast("double"), "name_jw": (x * 17 % 103) / 103.0, "name_char_cos": (x * 19 % 107) / 107.0})
    return rows.groupBy(labels.negative_type(rows).alias("type")).agg(F.count(F.lit(1)).alias("n"))


ORACLES["er_negative_types"] = f"""WITH {SCORED}, t AS (SELECT (v_idx * 13 % 101) / 101.0 >= 0.8 OR (v_idx % 2 = 1 AND v_idx % 3 = 0) AS place, (v_idx * 17 % 103) / 103.0 >= 0.9 OR (v_idx * 19 % 107) / 107.0 >= 0.7 AS name FROM s WHERE label = 0)
SELECT CASE WHEN place AND name THEN 'same_address_similar_name' WHEN place THEN 'same_address' WHEN name THEN 'similar_name' ELSE 'other' END AS type, count(*) AS n FROM t GROUP BY 1"""


def er_rescoring_pairs(spark, d):
    """Positives and the two hardest negatives of each entity, for a second model."""
    rows = scored(spark, d).withColumnRenamed("p_final", "p_lgb_raw")
    return labels.rescoring_pairs(rows, hard=2, chance=0).select("s1_idx", "v_idx", "label")


ORACLES["er_rescoring_pairs"] = f"WITH {SCORED} SELECT s1_idx, v_idx, label FROM s WHERE label = 1 UNION ALL SELECT s1_idx, v_idx, label FROM (SELECT * FROM s WHERE label = 0 QUALIFY row_number() OVER (PARTITION BY s1_idx ORDER BY p_final DESC, v_idx) <= 2)"


def er_split_sizes(spark, d):
    """Entities dealt into splits by strata of their counts."""
    rows = scored(spark, d)
    e = entities(spark, d).withColumns({"labeled": F.lit(True), "n_unresolved": F.lit(0)})
    return labels.splits(e, rows.filter("label = 1")).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


ORACLES["er_split_sizes"] = f"""WITH {SCORED}, t AS (SELECT o_orderkey, least(count(*) FILTER (label = 1 AND source = 2), 2) AS n2, least(count(*) FILTER (label = 1 AND source = 3), 2) AS n3 FROM orders LEFT JOIN s ON s1_idx = o_orderkey GROUP BY 1),
g AS (SELECT count(*) AS n FROM t GROUP BY n2, n3), c AS (SELECT round_even(0.7::DOUBLE * n, 0) AS a, round_even((0.7::DOUBLE + 0.15::DOUBLE) * n, 0) AS b, n FROM g), f AS (SELECT CAST(sum(a) AS BIGINT) AS fit, CAST(sum(b - a) AS BIGINT) AS calib, CAST(sum(n - b) AS BIGINT) AS holdout FROM c)
SELECT 'fit_val' AS split, CAST(round_even(0.15::DOUBLE * fit, 0) AS BIGINT) AS n FROM f UNION ALL SELECT 'fit', fit - CAST(round_even(0.15::DOUBLE * fit, 0) AS BIGINT) FROM f UNION ALL SELECT 'calib', calib FROM f UNION ALL SELECT 'holdout', holdout FROM f"""


def er_metric_keys(spark, d):
    """What counts as one match, with and without the source."""
    r = scored(spark, d).select("source", (F.col("v_idx") % 100).cast("string").alias("id"))
    return r.agg(F.count_distinct(labels.metric_key(F.col("source"), F.col("id"), False)).alias("ids"), F.count_distinct(labels.metric_key(F.col("source"), F.col("id"), True)).alias("keys"))


ORACLES["er_metric_keys"] = f"WITH {SCORED} SELECT count(DISTINCT v_idx % 100) AS ids, count(DISTINCT (source, v_idx % 100)) AS keys FROM s"


# ---- scores, decisions, metrics


def er_blend(spark, d):
    """A weighted blend; pairs that the second model has not seen keep the first score."""
    rows = scored(spark, d).withColumn("p_ce", F.when(F.col("v_idx") % 4 != 0, (F.col("v_idx") % 50) / 50.0))
    return rounded(rows.select("s1_idx", "v_idx", models.Blender("weighted", 0.3).apply(F.col("p_final"), F.col("p_ce")).alias("p")))


ORACLES["er_blend"] = f"WITH {SCORED} SELECT s1_idx, v_idx, round(CASE WHEN v_idx % 4 <> 0 THEN 0.7::DOUBLE * p_final + 0.3::DOUBLE * ((v_idx % 50) / 50.0::DOUBLE) ELSE p_final END, 6) AS p FROM s"


def er_isotonic(spark, d):
    """Scores through the knots of an isotonic fit."""
    c = models.Calibrator("isotonic", (0.1, 0.5, 0.9), (0.05, 0.25, 0.85))
    return rounded(scored(spark, d).select("s1_idx", "v_idx", c.apply(F.col("p_final")).alias("p")), 9)


ORACLES["er_isotonic"] = f"""WITH {SCORED} SELECT s1_idx, v_idx, round((1 - 1e-4) * CASE WHEN p_final < 0.1 THEN 0.05 WHEN p_final < 0.5 THEN 0.05 + 0.5 * (p_final - 0.1) WHEN p_final < 0.9 THEN 0.25 + 1.5 * (p_final - 0.5) ELSE 0.85 END + 1e-4 * p_final, 9) AS p FROM s"""


def er_platt(spark, d):
    """Scores through a logistic curve over their logits."""
    c = models.Calibrator("platt", (1.5,), (-0.5,))
    return rounded(scored(spark, d).select("s1_idx", "v_idx", C.logit(F.col("p_final")).alias("logit"), c.apply(F.col("p_final")).alias("p")))


ORACLES["er_platt"] = f"WITH {SCORED}, z AS (SELECT *, ln(greatest(p_final, 1e-6) / (1 - greatest(p_final, 1e-6))) AS z FROM s) SELECT s1_idx, v_idx, round(z, 6) AS logit, round(1 / (1 + exp(-(1.5 * z - 0.5))), 6) AS p FROM z"


def er_ranking(spark, d):
    """AUC, average precision and log loss."""
    return rounded(metrics.ranking(scored(spark, d), "p_final"))


ORACLES["er_ranking"] = f"""WITH {SCORED}, g AS (SELECT p_final AS p, CAST(sum(label) AS DOUBLE) AS t, CAST(sum(1 - label) AS DOUBLE) AS f FROM s GROUP BY 1), c AS (SELECT *, sum(t) OVER w AS tp, sum(f) OVER w AS fp, least(greatest(p, 1e-12), 1 - 1e-12) AS q FROM g WINDOW w AS (ORDER BY p DESC))
SELECT round(sum(f * (tp - t / 2)) / (sum(t) * sum(f)), 6) AS auc, round(sum(t * tp / (tp + fp)) / sum(t), 6) AS ap, round(-sum(t * ln(q) + f * ln(1 - q)) / (sum(t) + sum(f)), 6) AS log_loss FROM c"""


def er_calibration_error(spark, d):
    return rounded(metrics.calibration_error(scored(spark, d).withColumnRenamed("p_final", "p")))


ORACLES["er_calibration_error"] = f"""WITH {SCORED}, q AS (SELECT *, least(greatest(p_final, 1e-12), 1 - 1e-12) AS q FROM s), b AS (SELECT least(floor(p_final * 10), 9) AS bin, count(*) AS n, avg(p_final) AS m, avg(label) AS t FROM s GROUP BY 1)
SELECT round(avg((p_final - label) ** 2), 6) AS brier, round(avg(CASE WHEN label = 1 THEN -ln(q) ELSE -ln(1 - q) END), 6) AS log_loss, (SELECT round(sum(n * abs(m - t)) / sum(n), 6) FROM b) AS ece FROM q"""


def er_plateau(spark, d):
    """The threshold in the middle of the best ones, and what it scores."""
    grid = [i / 20 for i in range(20)]
    scores = [round(x, 6) for x in decide.sweep(scored(spark, d), entities(spark, d), [decide.Params(t, t, gate=t) for t in grid])]
    return spark.createDataFrame([(decide.plateau(grid, scores), max(scores))], "threshold double, macro_f double")


ORACLES["er_plateau"] = f"""WITH {SCORED}, {ENTITIES}, g AS (SELECT i, i / 20.0::DOUBLE AS t FROM range(20) z(i)), q AS (SELECT i, s1_idx, sum(label) AS tp, count(*) AS n_pred FROM s, g WHERE p_final >= t GROUP BY ALL),
m AS (SELECT i, round(avg(CASE WHEN n_true + coalesce(n_pred, 0) = 0 THEN 1.0 ELSE 1.25 * coalesce(tp, 0) / (0.25 * n_true + coalesce(n_pred, 0)) END), 6) AS f FROM (SELECT * FROM e, g) LEFT JOIN q USING (i, s1_idx) GROUP BY i),
b AS (SELECT i, f, i - row_number() OVER (ORDER BY i) AS run FROM m WHERE f = (SELECT max(f) FROM m)), r AS (SELECT min(i) AS low, max(i) AS high, max(f) AS f FROM b GROUP BY run ORDER BY count(*) DESC, min(i) LIMIT 1)
SELECT ((low + high) // 2) / 20.0::DOUBLE AS threshold, f AS macro_f FROM r"""


def er_sweep_rules(spark, d):
    """Margins, caps and gates scored in one job."""
    sets = [PRM, decide.Params(0.3, 0.3, gate=0.3, max_per_source=1), decide.Params(0.2, 0.4, margin=0.1, gate=0.5)]
    scores = decide.sweep(scored(spark, d), entities(spark, d), sets)
    return spark.createDataFrame([(i, round(x, 6)) for i, x in enumerate(scores)], "step int, macro_f double")


ORACLES["er_sweep_rules"] = f"""WITH {SCORED}, {ENTITIES}, g(step, t2, t3, margin, gate, cap) AS (VALUES (0, 0.5, 0.4, 0.3, 0.6, 2), (1, 0.3, 0.3, 1.0, 0.3, 1), (2, 0.2, 0.4, 0.1, 0.5, 99)), q AS (SELECT *, max(p_final) OVER (PARTITION BY s1_idx) AS top, row_number() OVER (PARTITION BY s1_idx, source ORDER BY p_final DESC, v_idx) AS r FROM s),
x AS (SELECT step, s1_idx, sum(label) AS tp, count(*) AS n_pred FROM q, g WHERE p_final >= CASE WHEN source = 2 THEN t2 ELSE t3 END AND p_final >= top - CAST(margin AS DOUBLE) AND top >= gate AND r <= cap GROUP BY ALL)
SELECT CAST(step AS INTEGER) AS step, round(avg(CASE WHEN n_true + coalesce(n_pred, 0) = 0 THEN 1.0 ELSE 1.25 * coalesce(tp, 0) / (0.25 * n_true + coalesce(n_pred, 0)) END), 6) AS macro_f FROM (SELECT * FROM e, g) LEFT JOIN x USING (step, s1_idx) GROUP BY step"""


def er_summary_rest(spark, d):
    """The other figures of the summary."""
    return rounded(metrics.summary(_tallies(spark, d)).select("entity_precision", "entity_recall", "singleton_false_merges", "nonsingleton_predicted_empty", "macro_f_singletons", "macro_f_nonsingletons", "pair_f"))


ORACLES["er_summary_rest"] = TALLY + """, m AS (SELECT sum(tp) / sum(n_pred) AS p, sum(tp) / sum(n_true) AS r FROM t) SELECT round(avg(tp / n_pred) FILTER (n_pred > 0), 6) AS entity_precision, round(avg(tp / n_true) FILTER (n_true > 0), 6) AS entity_recall, count(*) FILTER (n_true = 0 AND n_pred > 0) AS singleton_false_merges,
  count(*) FILTER (n_true > 0 AND n_pred = 0) AS nonsingleton_predicted_empty, round(avg(f) FILTER (n_true = 0), 6) AS macro_f_singletons, round(avg(f) FILTER (n_true > 0), 6) AS macro_f_nonsingletons, (SELECT round(1.25 * p * r / (0.25 * p + r), 6) FROM m) AS pair_f FROM f"""


def _sides(spark, d):
    s1 = table(spark, d, "orders").select(F.col("o_orderkey").alias("s1_idx"), F.concat(F.lit("O"), "o_orderkey").alias("id"), F.col("o_orderstatus").alias("name"), F.col("o_orderpriority").alias("address"))
    v = table(spark, d, "part").select(F.col("p_partkey").alias("v_idx"), F.concat(F.lit("P"), "p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("address"), (2 + F.col("p_partkey") % 2).alias("source"))
    return s1, v


def _error_tables(spark, d):
    judged = _selected(spark, d).withColumn("p_lgb", F.col("p_final"))
    return metrics.error_tables(entities(spark, d), judged, scored(spark, d).filter("label = 1"), *_sides(spark, d), threshold=0.5)


def er_false_positives(spark, d):
    """False positives with both records."""
    return _error_tables(spark, d)["false_positives"].select("s1_idx", "v_idx", "s1_id", "s1_name", "s1_address", "v_id", "v_name", "v_address")


ORACLES["er_false_positives"] = DECIDE + " SELECT s1_idx, v_idx, 'O' || s1_idx AS s1_id, o_orderstatus AS s1_name, o_orderpriority AS s1_address, 'P' || v_idx AS v_id, p_name AS v_name, p_type AS v_address FROM d JOIN orders ON o_orderkey = s1_idx JOIN part ON p_partkey = v_idx WHERE selected AND label = 0"


def er_singleton_errors(spark, d):
    """Entities without a match that got one, and entities with matches that got none."""
    t = _error_tables(spark, d)
    return t["singleton_errors"].select("s1_idx", "id", F.lit("singleton").alias("kind")).unionByName(t["predicted_empty"].select("s1_idx", "id", F.lit("empty").alias("kind")))


ORACLES["er_singleton_errors"] = TALLY + " SELECT s1_idx, 'O' || s1_idx AS id, CASE WHEN n_true = 0 THEN 'singleton' ELSE 'empty' END AS kind FROM t WHERE (n_true = 0 AND n_pred > 0) OR (n_true > 0 AND n_pred = 0)"


def er_doubtful(spark, d):
    """The 200 truths of lowest and the 200 errors of highest probability (the limit is the report's)."""
    t = _error_tables(spark, d)
    return t["doubtful_truths"].select("s1_idx", "v_idx", F.lit("doubtful").alias("kind")).unionByName(t["confident_errors"].select("s1_idx", "v_idx", F.lit("confident").alias("kind")))


ORACLES["er_doubtful"] = DECIDE + " SELECT s1_idx, v_idx, 'doubtful' AS kind FROM (SELECT * FROM d WHERE label = 1 ORDER BY p_final, s1_idx, v_idx LIMIT 200) UNION ALL SELECT s1_idx, v_idx, 'confident' FROM (SELECT * FROM d WHERE selected AND label = 0 ORDER BY p_final DESC, s1_idx, v_idx LIMIT 200)"


# ---- sinks


def er_candidate_lists(spark, d):
    s1, v = _sides(spark, d)
    return sinks.candidate_lists(scored(spark, d), s1, v)


ORACLES["er_candidate_lists"] = f"WITH {SCORED} SELECT 'O' || s1_idx AS source1_id, 'P' || v_idx AS candidate_id, CAST(2 + v_idx % 2 AS BIGINT) AS candidate_source FROM s"


def er_scored_table(spark, d):
    """The table of scored pairs for inspection."""
    rows = decide.exclusive(_found(spark, d)).withColumn("selected", F.col("p_final") >= 0.5)
    return sinks.scored_table(rows, "exclusive").select("s1_idx", "v_idx", "p_final", "graph_keep", "selected", "blocking_methods")


ORACLES["er_scored_table"] = f"WITH {SCORED} SELECT s1_idx, v_idx, p_final, p_final >= max(p_final) OVER (PARTITION BY v_idx) AS graph_keep, p_final >= 0.5 AS selected, CASE v_idx % 3 WHEN 0 THEN 'name_prefix' WHEN 1 THEN 'city_state' ELSE 'name_prefix,city_state' END AS blocking_methods FROM s"


def er_results_by_source(spark, d):
    """Lists for each source, in brackets."""
    s1, v = _sides(spark, d)
    out = sinks.matching_results(s1.withColumn("row_order", F.col("s1_idx")), v, _selected(spark, d).filter("selected").select("s1_idx", "v_idx", "p_final"), "bracketed", True)
    return out.select("s1_id", "matches_2", "matches_3")


ORACLES["er_results_by_source"] = DECIDE + """, l AS (SELECT s1_idx, string_agg('P' || v_idx, ', ' ORDER BY p_final DESC, v_idx) FILTER (v_idx % 2 = 0) AS a, string_agg('P' || v_idx, ', ' ORDER BY p_final DESC, v_idx) FILTER (v_idx % 2 = 1) AS b FROM d WHERE selected GROUP BY s1_idx)
SELECT 'O' || o_orderkey AS s1_id, '[' || coalesce(a, '') || ']' AS matches_2, '[' || coalesce(b, '') || ']' AS matches_3 FROM orders LEFT JOIN l ON s1_idx = o_orderkey"""


QUERIES = {n: f for n, f in list(globals().items()) if n.startswith("er_")}
