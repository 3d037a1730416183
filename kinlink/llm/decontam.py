"""Benchmark decontamination by greedy string tiling.

The benchmark is taken in blocks of bounded size; each block is broadcast, and
every document is joined with it on shared-token seeds (runs of ``min_match``
tokens).  For each document and item that share a seed, running Karp-Rabin
finds the longest common runs of unmarked tokens, longest first, and marks
them, so a passage whose parts stand in another order is still covered.  An
item whose tokens are covered to ``min_coverage`` leaks into the document.

No document leaves its partition: there is no shuffle, whatever the size of
the corpus, and what is broadcast is bounded by ``block_tokens``.

Defined results: tokens are runs of word characters, lower-cased; null or empty
texts and items never match; items with fewer than ``min_match`` tokens never
match; repeated documents and items each give their own rows; an empty table
on either side gives an empty result.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.llm.common import count_partitions, kept_in_worker

WORD = re.compile(r"\w+")
BASE = 0x9E3779B97F4A7C15


def tokens(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class Running:
    """Karp-Rabin hashes (mod 2**64) of all runs of a sequence, for any length, from one running sum.

    ``BASE`` is odd, so it has an inverse mod 2**64: a run's hash is a difference of prefix sums, shifted.
    """

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        self.power = np.cumprod(np.concatenate([np.ones(1, dtype=np.uint64), np.full(n, BASE, dtype=np.uint64)]))
        back = np.cumprod(np.full(n, pow(BASE, -1, 1 << 64), dtype=np.uint64))
        self.sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(ids.astype(np.uint64) * back)])

    def of(self, n: int) -> np.ndarray:
        """The hash of each run of n ids."""
        return (self.sums[n:] - self.sums[: max(0, len(self.sums) - n)]) * self.power[n:]


def whole(free: np.ndarray, n: int) -> np.ndarray:
    """Where n free places stand in a row."""
    c = np.concatenate([[0], np.cumsum(free)])
    return c[n:] - c[: max(0, len(c) - n)] == n


def tile(pattern: np.ndarray, text: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Non-overlapping common runs as (place in pattern, place in text, length), longest first.

    Ids below 1 match nothing, not even themselves.
    """
    free_p, free_t, tiles = pattern > 0, text > 0, []
    hash_p, hash_t = Running(pattern), Running(text)
    n = min(len(pattern), len(text))
    while n >= min_match:
        places = defaultdict(list)
        hp, ht = hash_p.of(n), hash_t.of(n)
        at_p, at_t = np.flatnonzero(whole(free_p, n)), np.flatnonzero(whole(free_t, n))
        at_p, hits = at_p[np.isin(hp[at_p], ht[at_t])], at_t[np.isin(ht[at_t], hp[at_p])].tolist()
        for i in at_p.tolist():
            places[int(hp[i])].append(i)
        if not hits:
            # No run of n: the longest that is left lies between min_match and n - 1.
            n = n - 1 if n <= min_match + 1 else max(min_match, _longest(hash_p, hash_t, free_p, free_t, min_match, n - 1))
            if n < min_match:
                break
            continue
        for j in hits:
            for i in places[int(ht[j])]:
                if free_t[j : j + n].all() and free_p[i : i + n].all() and np.array_equal(pattern[i : i + n], text[j : j + n]):
                    free_p[i : i + n] = free_t[j : j + n] = False
                    tiles.append((i, j, n))
        n -= 1
    return tiles


def _longest(pattern: Running, text: Running, free_p: np.ndarray, free_t: np.ndarray, low: int, high: int) -> int:
    """The length of the longest common run of free ids, by bisection; below ``low`` if none."""
    best = low - 1
    while low <= high:
        mid = (low + high) // 2
        if np.isin(pattern.of(mid)[whole(free_p, mid)], text.of(mid)[whole(free_t, mid)]).any():
            best, low = mid, mid + 1
        else:
            high = mid - 1
    return best


class Block:
    """Benchmark items with an index of their seeds."""

    def __init__(self, items: list[tuple[object, str]], min_match: int):
        self.min_match, self.vocabulary, self.items = min_match, {}, []
        seeds = defaultdict(set)
        for item_id, text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in tokens(text)], dtype=np.int64)
            for h in Running(ids).of(min_match).tolist():
                seeds[h].add(len(self.items))
            self.items.append((item_id, ids))
        self.seeds = dict(seeds)
        self.hashes = np.array(sorted(self.seeds), dtype=np.uint64)

    def search(self, text: str | None) -> Iterator[tuple[object, int, int, list[tuple[int, int, int]]]]:
        """item id, tokens matched, tokens in the item, tiles: for each item that shares a seed."""
        words = tokens(text)
        n = self.min_match
        if len(words) < n or not len(self.hashes):
            return
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), dtype=np.int64, count=len(words))
        known = whole(ids > 0, n)
        if not known.any():
            return
        at = np.flatnonzero(known)
        h = Running(ids).of(n)[at]
        spot = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        hit = self.hashes[spot] == h
        by_item = defaultdict(list)
        for place, key in zip(at[hit].tolist(), h[hit].tolist(), strict=True):
            for k in self.seeds[key]:
                by_item[k].append(place)
        for k, places in sorted(by_item.items()):
            # Only runs of seeds can hold matches; what lies between is one id that matches nothing.
            near, where, last = [], [], -1
            for p in places:
                if p > last + 1:
                    near.append(0)
                    where.append(-1)
                for q in range(max(p, last + 1), p + n):
                    near.append(int(ids[q]))
                    where.append(q)
                last = p + n - 1
            item_id, own = self.items[k]
            tiles = tile(own, np.array(near, dtype=np.int64), n)
            yield item_id, sum(t[2] for t in tiles), len(own), sorted((i, where[j], m) for i, j, m in tiles)


def blocks(benchmark: DataFrame, block_tokens: int) -> Iterator[list[tuple[object, str]]]:
    """The benchmark's items in blocks of about ``block_tokens`` tokens."""
    rows = benchmark.select("item_id", "text").filter(F.col("text").isNotNull())
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = count_partitions(size, 4 * block_tokens)
    for k in range(n if size else 0):
        yield [tuple(r) for r in rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, min_coverage: float = 0.8, block_tokens: int = 500_000) -> DataFrame:
    """doc_id, th (hash of the text), item_id, matched, item_tokens, coverage, tiles: one row for each document and item that leaks into it."""
    sc = docs.sparkSession.sparkContext
    doc_kind, item_kind = (d.schema[c].dataType.simpleString() for d, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {doc_kind}, th long, item_id {item_kind}, matched long, item_tokens long, coverage double, tiles array<struct<item_at:long,doc_at:long,length:long>>"
    none = docs.sparkSession.createDataFrame([], schema)
    types, found = none.schema, []
    for items in blocks(benchmark, block_tokens):
        sent, name = sc.broadcast(items), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch], sent=sent, name=name) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_schema

            held, shape = kept_in_worker("decontam", dict), to_arrow_schema(types)
            if name not in held:  # one block at a time stays in a worker
                held.clear()
                held[name] = Block(sent.value, min_match)
            block = held[name]
            for b in batches:
                rows = []
                for doc_id, th, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                    for item_id, matched, n, tiles in block.search(text):
                        if matched >= min_coverage * n:
                            rows.append({"doc_id": doc_id, "th": th, "item_id": item_id, "matched": matched, "item_tokens": n, "coverage": matched / n, "tiles": [{"item_at": i, "doc_at": j, "length": m} for i, j, m in tiles]})
                yield pa.RecordBatch.from_pylist(rows, schema=shape)

        found.append(docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(run, types))
    return reduce(DataFrame.unionByName, found) if found else none
