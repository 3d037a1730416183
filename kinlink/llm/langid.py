"""Language identification by rank-order n-gram profiles.

A profile is a list of the most frequent n-grams (one to three letters, words
padded with a blank) in order of frequency.  A document's own profile is
compared with that of each language by out-of-place distance: the sum over the
document's n-grams of how far their rank is from the rank in the language, and
the full profile length for those the language lacks.  The nearest language is
predicted; ties go to the name that sorts first.

Counts for the language profiles cover every training document; they are
combined in each task before they are shuffled, and only ``size`` n-grams of
each language reach the driver (more than ``max_langs`` languages are an error,
so that what is broadcast is bounded).

Defined results: ``und`` with score 0 for a null text, a text without a letter,
or where nothing was learned; rows with a null language or a null id outside
the training fold teach nothing; repeated rows count each; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UNKNOWN = "und"
SHIFT, BLANK = 21, 1


def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool)


def grams(text: str, is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text (one to three code points in 21 bits each, 1 for the blank around words) and their counts."""
    codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le"), dtype="<u4")
    codes = np.where(is_letter[codes], codes, BLANK).astype(np.int64)
    word = codes != BLANK
    two = (codes[:-1] << SHIFT | codes[1:])[word[:-1] | word[1:]]
    three = (codes[:-2] << 2 * SHIFT | codes[1:-1] << SHIFT | codes[2:])[word[1:-1]]
    return np.unique(np.concatenate([codes[word], two, three]), return_counts=True)


def top(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent keys first, ties by key."""
    return keys[np.lexsort((keys, -counts))[:size]]


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, weights=np.concatenate([n for _, n in parts]), minlength=len(keys)).astype(np.int64)


def train(docs: DataFrame, fold: Column, size: int = 400, max_langs: int = 1000) -> dict[str, list[int]]:
    """The profile of each language, from all rows in ``fold`` whose lang is not null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter = letters()
        for b in batches:
            found: dict[str, list] = {}
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = found.setdefault(lang, [])
                own.append(grams(text, is_letter))
                if len(own) >= 200:
                    found[lang] = [merge(own)]
            for lang, parts in found.items():
                keys, counts = merge(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], ["lang", "gram", "n"])

    rows = docs.filter(fold & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    counts = rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).filter(F.col("rank") <= size)
    found: dict[str, list[int]] = {}
    rows = ranked.limit(size * max_langs + 1).collect()
    if len({r["lang"] for r in rows}) > max_langs or len(rows) > size * max_langs:
        raise ValueError(f"more than {max_langs} languages")
    for r in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        found.setdefault(r["lang"], []).append(r["gram"])
    return found


class Ranker:
    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.size, self.langs = size, sorted(profiles)
        self.profiles = [(k[o := np.argsort(k)], o) for k in (np.array(profiles[x], dtype=np.int64) for x in self.langs)]
        self.is_letter = letters()

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs:
            return UNKNOWN, 0.0
        keys, counts = grams(text, self.is_letter)
        own = top(keys, counts, self.size)
        if not len(own):
            return UNKNOWN, 0.0
        ranks, best = np.arange(len(own)), (np.inf, "")
        for lang, (known, rank) in zip(self.langs, self.profiles, strict=True):
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            away = np.where(known[at] == own, np.minimum(np.abs(rank[at] - ranks), self.size), self.size).sum()
            best = min(best, (int(away), lang))
        return best[1], 1.0 - best[0] / (self.size * len(own))


def predict(docs: DataFrame, profiles: dict[str, list[int]], size: int = 400) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1: one less the distance over the greatest)."""
    sent = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = Ranker(sent.value, size)
        for b in batches:
            out = [ranker.predict(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in out], pa.string()), pa.array([s for _, s in out], pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
