"""Katz back-off scoring of texts with a bigram model of the whole vocabulary.

The model, over the tokens of the training documents (N tokens; an end token
closes each text and a start stands before it):

    P(w)     = d1(c) c(w) / N        for every word seen
    P(?)     = what is left over     for all words not seen, together one event
    P(w | v) = d2(c) c(v w) / C(v)   where the bigram was seen
             = alpha(v) P(w)         elsewhere; alpha is 1 for contexts not seen

d1 and d2 are Good-Turing discounts for counts up to ``cutoff``.  alpha(v) is the
mass that the seen bigrams of v leave over, divided by the unigram mass of the
words not seen after v, both summed exactly, so P(. | v) adds up to one.  Where
nothing is discounted, one count is added to the denominator instead.  No word
and no bigram is left out or pooled: the model grows with the corpus.

The plan.  Texts are encoded once into units of some million tokens: a local
vocabulary and local token numbers.  Each unit asks for its distinct words, and
then for its distinct bigrams, once each, in compact lists dealt over shards.  A
word shard adds up the training counts, numbers the words it has seen, writes
its part of the unigram table and replies with counts and numbers.  Bigrams are
dealt by the number of their context, so that a shard holds all successors of a
context: it adds up the counts, writes its part of the bigram table, and replies
with the counts and, for each context, how many successors have each small
count and the unigram mass of them all.  From these a unit has C(v), the discounted
mass and alpha(v), and evaluates each token.  Contexts with more than
``max(hot, share * N)`` tokens (fewer than ``1 / share``) are dealt by both words;
the sums of their parts are the only part of the model that is broadcast.

Nothing a task holds grows with the corpus: shards and units are of fixed size,
their number grows.

Defined results: null texts are empty, and an empty text is its end token; rows
with a null id belong to the training fold if the caller's fold says so, else
not; repeated rows count each; with no training token every score is 0; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.llm.common import count_partitions, packed, stored, unpacked

END = b"\n"  # no word holds white space
SMOOTH = 0.1
TABLE, PARTS = -1, -2  # the units under which a shard writes its part of the table, and of the sums of hot contexts
UNKNOWN, START, FIRST = 0, 1, 2  # numbers of words
MIX = np.uint64(0x9E3779B97F4A7C15)


def packed_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b" ".join(words))


def unpacked_words(b: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(b).split(b" ")


def by_shard(shard: np.ndarray, shards: int) -> list[np.ndarray]:
    """The places of each shard's members, in order."""
    order = np.argsort(shard, kind="stable")
    return np.split(order, np.searchsorted(shard[order], np.arange(1, shards)))


def word_shards(words: list[bytes], shards: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) % shards for w in words], dtype=np.int64)


def pair_shards(v: np.ndarray, w: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """By the context; for hot contexts by both words.  Hot ones come after the others: shards, then shards again."""
    x = v.astype(np.uint64) * MIX + np.where(hot, (w.astype(np.uint64) + np.uint64(1)) * (MIX ^ np.uint64(0xFFFF0000)), np.uint64(0))
    return (((x ^ (x >> np.uint64(29))) * MIX) >> np.uint64(33)).astype(np.int64) % shards + shards * hot


def discounts(of_counts: dict[int, int], cutoff: int) -> np.ndarray:
    """d for counts 0 .. cutoff; Good-Turing, or an absolute discount for counts where it is not within (0, 1)."""
    n1, n2 = of_counts.get(1, 0), of_counts.get(2, 0)
    flat = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    common = (cutoff + 1) * of_counts.get(cutoff + 1, 0) / n1 if n1 else 1.0
    out = [1.0]
    for r in range(1, cutoff + 1):
        d = 0.0
        if of_counts.get(r, 0) and common < 1:
            d = ((r + 1) * of_counts.get(r + 1, 0) / of_counts[r] / r - common) / (1 - common)
        out.append(d if 0 < d < 1 else (r - flat) / r)
    return np.array(out)


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return c * np.where(c < len(d), d[np.minimum(c, len(d) - 1)], 1.0)


@dataclass
class Model:
    """What scoring needs besides the tables: a few numbers, and the sums of at most ``1 / share`` hot contexts."""

    tokens: int
    types: int
    texts: int
    d1: np.ndarray
    of_counts: dict[int, int]
    hot_above: int
    d2: np.ndarray = field(default_factory=lambda: np.ones(1))
    hot_v: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    hot_small: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), dtype=np.int64))
    hot_mass: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def __post_init__(self):
        kept = self.tokens - sum((1 - self.d1[r]) * r * self.of_counts.get(r, 0) for r in range(1, len(self.d1)))
        self.whole = self.tokens if kept < self.tokens - 1e-9 else self.tokens + 1
        self.unknown = 1 - kept / self.whole

    def p(self, c: np.ndarray) -> np.ndarray:
        """P of words by their count."""
        return np.where(c > 0, discounted(c, self.d1) / self.whole, self.unknown)

    def log_p(self, c: np.ndarray, of_context: np.ndarray, small: np.ndarray, mass: np.ndarray, p: np.ndarray) -> np.ndarray:
        """log10 P(w | v): count of the bigram and of the context, successors of v with each small count, their mass, P(w)."""
        r = np.arange(1, len(self.d2))
        kept = of_context - small @ ((1 - self.d2[1:]) * r)
        whole = np.where(small.sum(axis=1) > 0, of_context, of_context + 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            alpha = np.where(of_context > 0, (1 - kept / whole) / np.maximum(1 - mass, self.unknown), 1.0)
            return np.log10(np.where(c > 0, discounted(c, self.d2) / whole, alpha * p))


class Words(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Unit:
    """A unit's words and tokens, and what shards replied on them."""

    def __init__(self, words: bytes, tokens: bytes, shape: bytes):
        self.words, self.flat = unpacked_words(words), unpacked(tokens)
        self.lengths, learns = unpacked(shape).reshape(2, -1)
        self.learns = learns.astype(bool)
        self.of_learning = np.repeat(self.learns, self.lengths)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])

    def own_counts(self) -> np.ndarray:
        return np.bincount(self.flat[self.of_learning], minlength=len(self.words))

    def hear_words(self, shard: list[int], values: list[bytes], shards: int) -> None:
        """Counts and numbers of the unit's words, from the replies."""
        places = by_shard(word_shards(self.words, shards), shards)
        self.count, self.number = np.zeros((2, len(self.words)), dtype=np.int64)
        for k, b in zip(shard, values, strict=True):
            self.count[places[k]], self.number[places[k]] = unpacked(b).reshape(2, -1)

    def pair_up(self, model: Model) -> None:
        """The distinct bigrams in order of context and word: v, w, own count n, counts of_v and of_w; at: the bigram of each token."""
        before = np.concatenate([[-1], self.flat[:-1]])
        before[self.starts] = -1
        number, count = np.append(self.number, START if model.texts else UNKNOWN), np.append(self.count, model.texts)
        v, v_at, v_rank = np.unique(number[before], return_index=True, return_inverse=True)
        w, w_at, w_rank = np.unique(self.number[self.flat], return_index=True, return_inverse=True)
        known, self.at = np.unique(v_rank * len(w) + w_rank, return_inverse=True)
        own_v, own_w = known // len(w), known % len(w)
        self.v, self.w = v[own_v], w[own_w]
        self.of_v, self.of_w = count[before[v_at]][own_v], self.count[self.flat[w_at]][own_w]
        self.n = np.bincount(self.at[self.of_learning], minlength=len(known))

    def lists(self, model: Model, shards: int) -> list[tuple[int, np.ndarray]]:
        """The places of the bigrams asked of each shard; numbers from ``shards`` on are for hot contexts."""
        asked = np.flatnonzero(self.v != UNKNOWN)
        shard = pair_shards(self.v[asked], self.w[asked], self.of_v[asked] > model.hot_above, shards)
        return [(k, asked[x]) for k, x in enumerate(by_shard(shard, 2 * shards)) if len(x)]

    def scores(self, model: Model, shard: list[int], counts: list[bytes], small: list[bytes | None], mass: list[bytes | None], shards: int) -> np.ndarray:
        """log10 P of each token."""
        width = len(model.d2) - 1
        c, own_small, own_mass = np.zeros(len(self.v), dtype=np.int64), np.zeros((len(self.v), width), dtype=np.int64), np.zeros(len(self.v))
        places = dict(self.lists(model, shards))
        for k, a, s, m in zip(shard, counts, small, mass, strict=True):
            at = places[k]
            c[at] = unpacked(a)
            if k < shards:
                _, context = np.unique(self.v[at], return_inverse=True)
                own_small[at] = unpacked(s).reshape(-1, width)[context]
                own_mass[at] = unpacked(m).view(np.float64)[context]
            else:
                x = np.searchsorted(model.hot_v, self.v[at])
                own_small[at], own_mass[at] = model.hot_small[x], model.hot_mass[x]
        return model.log_p(c, self.of_v, own_small, own_mass, model.p(self.of_w))[self.at]


def unit_rows(docs: DataFrame, fold: Column, unit_tokens: int) -> DataFrame:
    """unit, words, tokens, shape, doc_ids: the texts, encoded in one pass."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = docs.sparkSession.createDataFrame([], f"unit long, words binary, tokens binary, shape binary, doc_ids array<{kind}>").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape, part, serial = to_arrow_schema(schema), TaskContext.get().partitionId(), 0

        def flush(words, tokens, lengths, learns, ids) -> pa.RecordBatch:
            row = {"unit": part << 32 | serial, "words": packed_words(list(words)), "tokens": packed(np.concatenate(tokens)), "shape": packed(np.array([lengths, learns], dtype=np.int64).ravel()), "doc_ids": ids}
            return pa.RecordBatch.from_pylist([row], schema=shape)

        state, total = (Words(), [], [], [], []), 0
        for b in batches:
            for doc_id, learn, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                words, tokens, lengths, learns, ids = state
                own = (text or b"").lower().split()
                own.append(END)
                tokens.append(np.array(list(map(words.__getitem__, own)), dtype=np.int64))
                lengths.append(len(own))
                learns.append(bool(learn))
                ids.append(doc_id)
                total += len(own)
                if total >= unit_tokens:
                    yield flush(*state)
                    state, total, serial = (Words(), [], [], [], []), 0, serial + 1
        if total:
            yield flush(*state)

    return docs.select("doc_id", F.coalesce(fold, F.lit(False)).alias("learn"), F.col("text").cast("binary")).mapInArrow(run, schema)


def answered_words(units: DataFrame, shards: int, cutoff: int) -> DataFrame:
    """shard, unit, words, value, stats: each shard's part of the unigram table, and its replies (counts, then numbers, in the order asked)."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, words, tokens, shape in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                unit = Unit(words, tokens, shape)
                counts = unit.own_counts()
                rows = [(k, packed_words([unit.words[i] for i in at]), packed(counts[at])) for k, at in enumerate(by_shard(word_shards(unit.words, shards), shards)) if len(at)]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([name] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], ["shard", "unit", "words", "value"])

    def reply(key: tuple, t: pa.Table) -> pa.Table:
        place, asked = Words(), []
        for a in t.column("words"):
            asked.append(np.array(list(map(place.__getitem__, unpacked_words(a.as_py()))), dtype=np.int64))
        total = np.zeros(len(place), dtype=np.int64)
        for at, n in zip(asked, t.column("value"), strict=True):
            total[at] += unpacked(n.as_py())
        k, rank = key[0].as_py(), np.empty(len(total), dtype=np.int64)
        rank[np.argsort(-total, kind="stable")] = np.arange(len(total))
        number = np.where(total > 0, FIRST + rank * shards + k, UNKNOWN)
        known, seen = list(place), np.flatnonzero(total)
        texts = int(total[place[END]]) if END in place else 0
        stats = [int(total.sum()), len(seen), texts, *np.bincount(total[total <= cutoff + 1], minlength=cutoff + 2)[1:].tolist()]
        n = len(asked) + 1
        keys = [packed_words([known[i] for i in seen]), *[None] * len(asked)]
        values = [packed(np.concatenate([total[seen], number[seen]])), *(packed(np.concatenate([total[at], number[at]])) for at in asked)]
        return pa.table({"shard": pa.array([k] * n, pa.int32()), "unit": pa.array([TABLE, *t.column("unit").to_pylist()], pa.int64()), "words": pa.array(keys, pa.binary()), "value": pa.array(values, pa.binary()), "stats": pa.array([stats, *[None] * len(asked)], pa.list_(pa.int64()))})

    asked = units.select("unit", "words", "tokens", "shape").mapInArrow(ask, "shard int, unit long, words binary, value binary")
    return asked.repartition(shards, "shard").groupBy("shard").applyInArrow(reply, "shard int, unit long, words binary, value binary, stats array<long>")


def unigram_table(answers: DataFrame) -> DataFrame:
    """word (binary), number, n: every word seen in training, by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for words, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                n, number = unpacked(value).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(unpacked_words(words) if len(n) else [], pa.binary()), pa.array(number), pa.array(n)], ["word", "number", "n"])

    return answers.filter(F.col("unit") == TABLE).select("words", "value").mapInArrow(run, "word binary, number long, n long")


LISTS = ("contexts", "sizes", "words", "own", "of_words")  # of a request
PAIR_ANSWER = "shard int, unit long, counts binary, small binary, mass binary, contexts binary, sizes binary, words binary, stats array<long>"


def answered_pairs(units: DataFrame, words: DataFrame, model, shards: int, word_shard_count: int, parts: int) -> DataFrame:
    """Each shard's part of the bigram table, the sums of its parts of hot contexts, and its replies in the order asked."""

    def ask(key: tuple, own: pa.Table, heard: pa.Table) -> pa.Table:
        m, rows = model.value, []
        for row in own.to_pylist():
            unit = Unit(row["words"], row["tokens"], row["shape"])
            unit.hear_words(heard.column("shard").to_pylist(), heard.column("value").to_pylist(), word_shard_count)
            unit.pair_up(m)
            for k, at in unit.lists(m, shards):
                contexts, sizes = np.unique(unit.v[at], return_counts=True)
                rows.append((k, row["unit"], packed(np.diff(contexts, prepend=0)), packed(sizes), packed(unit.w[at]), packed(unit.n[at]), packed(unit.of_w[at])))
        columns = list(zip(*rows, strict=True)) or [()] * 7
        return pa.table({c: pa.array(x, t) for c, x, t in zip(("shard", "unit", *LISTS), columns, (pa.int32(), pa.int64(), *[pa.binary()] * 5), strict=True)})

    def reply(key: tuple, t: pa.Table) -> pa.Table:
        m, cutoff = model.value, len(model.value.d1) - 1
        lists = [[unpacked(x.as_py()) for x in t.column(c)] for c in LISTS]
        v = np.concatenate([np.repeat(np.cumsum(a), n) for a, n in zip(lists[0], lists[1], strict=True)])
        w, own, of_w = (np.concatenate(x) for x in lists[2:])
        order = np.lexsort((w, v))
        new = np.ones(len(v), dtype=bool)
        new[1:] = (v[order[1:]] != v[order[:-1]]) | (w[order[1:]] != w[order[:-1]])
        first, group = np.flatnonzero(new), np.empty(len(v), dtype=np.int64)
        group[order] = np.cumsum(new) - 1
        total = np.add.reduceat(own[order], first)
        of_group = v[order[first]]
        context_v, context = np.unique(of_group, return_inverse=True)
        seen = total > 0
        small = np.stack([np.bincount(context[total == r], minlength=len(context_v)) for r in range(1, cutoff + 1)], axis=1)
        mass = np.bincount(context[seen], weights=m.p(of_w[order[first]][seen]), minlength=len(context_v))
        k, rows, begin = key[0].as_py(), [], 0
        some, sizes = np.unique(of_group[seen], return_counts=True)
        stats = np.bincount(total[total <= cutoff + 1], minlength=cutoff + 2)[1:].tolist()
        rows.append((k, TABLE, packed(total[seen]), None, None, packed(np.diff(some, prepend=0)), packed(sizes), packed(w[order[first]][seen]), stats))
        if k >= shards:
            rows.append((k, PARTS, None, packed(small.ravel()), packed(mass.view(np.int64)), packed(np.diff(context_v, prepend=0)), None, None, None))
        for unit, asked in zip(t.column("unit").to_pylist(), lists[1], strict=True):
            g = group[begin : begin + int(asked.sum())]
            begin += len(g)
            if k < shards:
                starts = np.concatenate([[0], np.cumsum(asked)[:-1]])
                c = context[g[starts]]
                wanted = np.add.reduceat((total[g] == 0).astype(np.int64), starts) > 0  # only then the unit backs off
                rows.append((k, unit, packed(total[g]), packed(small[c].ravel()), packed(np.where(wanted, mass[c], 0.0).view(np.int64)), None, None, None, None))
            else:
                rows.append((k, unit, packed(total[g]), None, None, None, None, None, None))
        kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 6, pa.list_(pa.int64()))
        return pa.table({f.split()[0]: pa.array(x, t) for f, x, t in zip(PAIR_ANSWER.split(", "), zip(*rows, strict=True), kinds, strict=True)})

    by = lambda d: d.repartition(parts, "unit").groupBy("unit")
    heard = words.filter(F.col("unit") != TABLE).select("unit", "shard", "value")
    asked = by(units.drop("doc_ids")).cogroup(by(heard)).applyInArrow(ask, "shard int, unit long, " + ", ".join(f"{c} binary" for c in LISTS))
    return asked.repartition(shards, "shard").groupBy("shard").applyInArrow(reply, PAIR_ANSWER)


def bigram_table(answers: DataFrame) -> DataFrame:
    """v, w, n: every bigram seen in training, by numbers of words, partitioned by context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                v = np.repeat(np.cumsum(unpacked(row["contexts"])), unpacked(row["sizes"]))
                yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(unpacked(row["words"])), pa.array(unpacked(row["counts"]))], ["v", "w", "n"])

    return answers.filter(F.col("unit") == TABLE).select("contexts", "sizes", "words", "counts").mapInArrow(run, "v long, w long, n long")


def hot_sums(answers: DataFrame, cutoff: int) -> DataFrame:
    """v, s1 .. (successors with each small count), mass: the sums over the parts of each hot context."""
    names = [f"s{r}" for r in range(1, cutoff + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for contexts, small, mass in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.cumsum(unpacked(contexts))), *map(pa.array, np.ascontiguousarray(unpacked(small).reshape(-1, cutoff).T)), pa.array(unpacked(mass).view(np.float64))], ["v", *names, "mass"])

    rows = answers.filter(F.col("unit") == PARTS).select("contexts", "small", "mass").mapInArrow(run, "v long, " + ", ".join(f"{c} long" for c in names) + ", mass double")
    return rows.groupBy("v").agg(*(F.sum(c).alias(c) for c in names), F.sum("mass").alias("mass"))


def scored(units: DataFrame, replies: DataFrame, model, shards: int, word_shard_count: int, parts: int, kind: str) -> DataFrame:
    schema = f"doc_id {kind}, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def run(key: tuple, own: pa.Table, replies: pa.Table) -> pa.Table:
        m, rows = model.value, []
        of_words, of_pairs = ([r for r in replies.to_pylist() if r["pairs"] is x] for x in (False, True))
        for row, ids in zip(own.drop_columns(["doc_ids"]).to_pylist(), own.column("doc_ids"), strict=True):
            unit = Unit(row["words"], row["tokens"], row["shape"])
            unit.hear_words([r["shard"] for r in of_words], [r["value"] for r in of_words], word_shard_count)
            unit.pair_up(m)
            katz = unit.scores(m, *([r[c] for r in of_pairs] for c in ("shard", "value", "small", "mass")), shards)
            base = np.log10((unit.count + SMOOTH) / (m.tokens + SMOOTH * (m.types + 1)))
            add = lambda x, unit=unit: pa.array(np.add.reduceat(x, unit.starts))
            rows.append(pa.table({"doc_id": ids.values, "learned": pa.array(unit.learns), "n_tokens": pa.array(unit.lengths), "n_known": add((unit.count > 0)[unit.flat].astype(np.int64)), "train_tokens": pa.array(np.full(len(unit.lengths), m.tokens)), "base_score": add(base[unit.flat]), "score": add(katz)}))
        if rows:
            return pa.concat_tables(rows)
        return pa.table({f: pa.array([], t) for f, t in (("doc_id", pa.int64()), ("learned", pa.bool_()), *((x, pa.int64()) for x in ("n_tokens", "n_known", "train_tokens")), ("base_score", pa.float64()), ("score", pa.float64()))})

    by = lambda d: d.repartition(parts, "unit").groupBy("unit")
    return by(units).cogroup(by(replies)).applyInArrow(run, schema)


def score(docs: DataFrame, fold: Column, cutoff: int = 5, share: float = 1e-6, hot: int = 200_000, unit_tokens: int = 1_000_000, shard_bytes: int = 12 << 20) -> DataFrame:
    """doc_id, learned, n_tokens, n_known, train_tokens, base_score, score (log10 probability of the text).

    ``fold`` says from which documents the model learns.  ``unit_tokens`` and
    ``shard_bytes`` (of text for each shard) set what a task holds.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = count_partitions(size, shard_bytes, 4)
    kind = docs.schema["doc_id"].dataType.simpleString()
    units = stored(unit_rows(docs, fold, unit_tokens), "katz-units")
    parts = max(1, units.count())
    words = stored(answered_words(units, shards, cutoff), "katz-words")
    sums = lambda d, n: [x or 0 for x in d.filter(F.col("unit") == TABLE).agg(*(F.sum(F.col("stats")[i]) for i in range(n))).first()]
    tokens, types, texts, *of_counts = sums(words, cutoff + 4)
    of_counts = dict(enumerate(of_counts, 1))
    model = Model(tokens, types, texts, discounts(of_counts, cutoff), of_counts, max(hot, int(share * tokens)))
    pairs = stored(answered_pairs(units, words, spark.sparkContext.broadcast(model), shards, shards, parts), "katz-pairs")
    model.d2 = discounts(dict(enumerate(sums(pairs, cutoff + 1), 1)), cutoff)
    parts_of_hot = np.array([tuple(r) for r in hot_sums(pairs, cutoff).orderBy("v").collect()], dtype=object).reshape(-1, cutoff + 2)  # fewer than 1 / share rows
    model.hot_v, model.hot_small, model.hot_mass = parts_of_hot[:, 0].astype(np.int64), parts_of_hot[:, 1:-1].astype(np.int64), parts_of_hot[:, -1].astype(np.float64)
    heard = words.filter(F.col("unit") != TABLE).select("unit", F.lit(False).alias("pairs"), "shard", "value", F.lit(None).cast("binary").alias("small"), F.lit(None).cast("binary").alias("mass"))
    heard = heard.unionByName(pairs.filter(F.col("unit") >= 0).select("unit", F.lit(True).alias("pairs"), "shard", F.col("counts").alias("value"), "small", "mass"))
    return scored(units, heard, spark.sparkContext.broadcast(model), shards, shards, parts, kind)
