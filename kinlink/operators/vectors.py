"""TF-IDF vectors as postings, and joins on them.

A representation is a table (rec, term, w): sublinear term frequency, smooth
idf, length one.  Similarity joins meet on terms; terms of more than
``max_df`` of the records are left out before, which bounds what one term joins.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinlink.functions.columns import word_grams, words

#: Representation: the field it is made of, and whether of character n-grams or of words.
REPRESENTATIONS = {"name_char": ("name_tokens", "char"), "name_word": ("name_tokens", "word"), "full_char": ("full_text", "char"), "addr_char": ("addr_clean", "char")}


def terms_of(field: Column, kind: str) -> Column:
    return word_grams(field) if kind == "char" else words(field)


def idf(terms: DataFrame, n: int) -> DataFrame:
    """term, df, idf = ln((n + 1) / (df + 1)) + 1; terms: rec, term, tf."""
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")).withColumn("idf", F.log((F.lit(n) + 1.0) / (F.col("df") + 1.0)) + 1.0)


def sorted_in(df: DataFrame) -> DataFrame:
    """``df`` as a side of a merge join: a plan of many joins must not hold as many tables on the driver, each of 34 MB at least."""
    return df.hint("merge")


def counted(records: DataFrame, terms: Column) -> DataFrame:
    """rec, term, tf."""
    return records.select("rec", F.explode(terms).alias("term")).groupBy("rec", "term").agg(F.count(F.lit(1)).alias("tf"))


def postings(records: DataFrame, terms: Column, max_df: float = 1.0) -> DataFrame:
    """rec, term, w for records with a column rec."""
    n = records.count()
    tf = counted(records, terms)
    known = idf(tf, n).filter(F.col("df") <= max_df * n)
    raw = tf.join(sorted_in(known), "term").select("rec", "term", ((1.0 + F.log("tf")) * F.col("idf")).alias("x"))
    norm = raw.groupBy("rec").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    return raw.join(sorted_in(norm), "rec").select("rec", "term", (F.col("x") / F.col("norm")).alias("w"))


def best(pairs: DataFrame, k: int, by: list[str], order: str = "sim", tie: str = "v_idx") -> DataFrame:
    """The k pairs of each group with the highest ``order``; ties by id."""
    return pairs.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(order), tie))).filter(F.col("_rank") <= k).drop("_rank")


def dot(a: str, b: str) -> Column:
    """Aggregate: the sum of products in units of 1e-15, which whatever order of rows gives alike, so that equal vectors tie."""
    return F.sum(F.rint(F.col(a) * F.col(b) * 1e15).cast("long")) / F.lit(1e15)


def similar(left: DataFrame, right: DataFrame, k: int, least: float = 1e-6) -> DataFrame:
    """s1_idx, v_idx, source, sim: the k most similar records of each source; left: rec, term, w; right also source."""
    met = left.select(F.col("rec").alias("s1_idx"), "term", F.col("w").alias("wa")).join(sorted_in(right.select(F.col("rec").alias("v_idx"), "source", "term", F.col("w").alias("wb"))), "term")
    sims = met.groupBy("s1_idx", "v_idx", "source").agg(dot("wa", "wb").alias("sim")).filter(F.col("sim") >= least)
    return best(sims, k, ["s1_idx", "source"])


#: Records of each side and pairs for each task that computes their products.
RECORDS_EACH, PAIRS_EACH = 30_000, 4_000_000


def packed(postings: DataFrame, *more: str) -> DataFrame:
    """rec, more, terms, ws: one row for each record."""
    rows = postings.groupBy("rec", *more).agg(F.collect_list(F.struct("term", "w")).alias("x"))
    return rows.select("rec", *more, F.col("x.term").alias("terms"), F.col("x.w").alias("ws"))


def _tiles(left: DataFrame, right: DataFrame, n_pairs: int = 0) -> tuple[Column, Column, Callable]:
    """(block of s1_idx, block of v_idx, rows of both sides): every block of one side meets every block of the other in one group."""
    size = lambda d: d.agg(F.approx_count_distinct("rec")).first()[0]
    n_v = max(4, -(-size(right) // RECORDS_EACH))
    n_s = max(2, -(-size(left) // RECORDS_EACH), -(-n_pairs // (PAIRS_EACH * n_v)))
    at = lambda c, n: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    none, no_source = F.lit(None).cast("long"), F.lit(None).cast("int")

    def records(source: bool) -> DataFrame:
        a = packed(left).select(at("rec", n_s).alias("_i"), every(n_v).alias("_j"), F.col("rec").cast("long").alias("s1_idx"), none.alias("v_idx"), no_source.alias("_source"), "terms", "ws")
        b = packed(right, *(["source"] if source else []))
        return a.unionByName(b.select(every(n_s).alias("_i"), at("rec", n_v).alias("_j"), none.alias("s1_idx"), F.col("rec").cast("long").alias("v_idx"), (F.col("source").cast("int") if source else no_source).alias("_source"), "terms", "ws"))

    return at("s1_idx", n_s), at("v_idx", n_v), records


def _sides(t: pa.Table):
    """Of a group: (ids, starts, terms as numbers, weights) of source 1 and of vendors, the number of terms, and the rows of vendors; both by id."""
    t = t.combine_chunks()
    out, words_of, rows = [], [], []
    for c in ("s1_idx", "v_idx"):
        d = t.filter(pc.and_(pc.is_valid(t["terms"]), pc.is_valid(t[c]))).sort_by(c).combine_chunks()
        lists, weights = (d[x].chunk(0) if d.num_rows else pa.array([], t.schema.field(x).type) for x in ("terms", "ws"))
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        out.append([d[c].to_numpy(), starts, None, weights.flatten().to_numpy(zero_copy_only=False)])
        words_of.append(lists.flatten())
        rows.append(d)
    codes = pa.concat_arrays(words_of).dictionary_encode()
    flat = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    out[0][2], out[1][2] = flat[: len(words_of[0])], flat[len(words_of[0]) :]
    return out[0], out[1], len(codes.dictionary), rows[1]


def _runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which run, place) of every place of the runs."""
    n = ends - starts
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + starts[which]


def closest(left: DataFrame, right: DataFrame, k: int, least: float = 1e-6) -> DataFrame:
    """``similar``, with the products made and ranked in blocks of both sides: only the k best of a block leave it."""
    _, _, records = _tiles(left, right)

    def run(t: pa.Table) -> pa.Table:
        (s1, s_at, s_term, s_w), (v, v_at, v_term, v_w), n_terms, rows = _sides(t)
        source = rows["_source"].to_numpy()
        order = np.argsort(v_term, kind="stable")
        v_of, w_of = np.repeat(np.arange(len(v)), np.diff(v_at))[order], v_w[order]
        at = np.searchsorted(v_term[order], np.arange(n_terms + 1))
        found: list = []
        for i in range(len(s1)):
            own = s_term[s_at[i] : s_at[i + 1]]
            which, place = _runs(at[own], at[own + 1])
            sums = np.bincount(v_of[place], np.rint(s_w[s_at[i] + which] * w_of[place] * 1e15), len(v))  # whole numbers below 2**53, as lengths are one
            good = np.flatnonzero(sums / 1e15 >= least)
            for x in np.unique(source[good]):
                mine = good[source[good] == x]
                if len(mine) > k:
                    mine = mine[sums[mine] >= np.partition(sums[mine], len(mine) - k)[len(mine) - k]]
                mine = mine[np.lexsort((mine, -sums[mine]))[:k]]
                found.append((np.full(len(mine), s1[i]), v[mine], source[mine], sums[mine] / 1e15))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [[]] * 4
        return pa.table([pa.array(x, y) for x, y in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.float64()), strict=True)], ["s1_idx", "v_idx", "source", "sim"])

    near = records(True).groupBy("_i", "_j").applyInArrow(run, "s1_idx long, v_idx long, source int, sim double")
    return best(near, k, ["s1_idx", "source"]).withColumn("source", F.col("source").cast(right.schema["source"].dataType))


def cosines(pairs: DataFrame, left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    """``pairs`` (s1_idx, v_idx) with their cosine; pairs meet the vectors in blocks of both sides, and are shuffled once, never by term."""
    at_s, at_v, records = _tiles(left, right, pairs.count())
    rest = [c for c in pairs.columns if c != name]
    rows = pairs.select(at_s.alias("_i"), at_v.alias("_j"), F.struct(*rest).alias("_row"), F.col("s1_idx").cast("long").alias("s1_idx"), F.col("v_idx").cast("long").alias("v_idx"))
    schema = rows.select("_row").withColumn(name, F.lit(0.0)).schema

    def run(t: pa.Table) -> pa.Table:
        asked = t.filter(pc.is_valid(t["_row"])).sort_by("s1_idx")
        (s1, s_at, s_term, s_w), (v, v_at, v_term, v_w), n_terms, _ = _sides(t.drop_columns(["_row"]))
        s, r = asked["s1_idx"].to_numpy(), asked["v_idx"].to_numpy()
        out, dense = np.zeros(len(s)), np.zeros(n_terms)
        place = np.searchsorted(v, r)
        known = np.zeros(len(r), dtype=bool) if not len(v) else v[np.minimum(place, len(v) - 1)] == r
        for x, low, high in zip(s1, np.searchsorted(s, s1), np.searchsorted(s, s1, "right"), strict=True):
            if low == high:
                continue
            i = np.searchsorted(s1, x)
            own = s_term[s_at[i] : s_at[i + 1]]
            dense[own] = s_w[s_at[i] : s_at[i + 1]]
            for begin in range(low, high, 20_000):
                mine = np.arange(begin, min(high, begin + 20_000))
                mine = mine[known[mine]]
                which, at = _runs(v_at[place[mine]], v_at[place[mine] + 1])
                out[mine] = np.bincount(which, np.rint(dense[v_term[at]] * v_w[at] * 1e15), len(mine)) / 1e15
            dense[own] = 0.0
        return pa.table([asked["_row"].combine_chunks(), pa.array(out)], ["_row", name])

    all_ = rows.unionByName(records(False).drop("_source"), allowMissingColumns=True)
    return all_.groupBy("_i", "_j").applyInArrow(run, schema).select("_row.*", name)


def token_weights(records: DataFrame, field: str) -> DataFrame:
    """rec, weights: each distinct word of a field with its idf and its weight in a vector of length one (plain counts)."""
    tf = counted(records, words(F.col(field)))
    raw = tf.join(sorted_in(idf(tf, records.count())), "term").withColumn("x", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("rec")))
    return raw.withColumn("w", F.col("x") / norm).groupBy("rec").agg(F.array_sort(F.collect_list(F.struct("term", "w", "idf"))).alias("weights"))
