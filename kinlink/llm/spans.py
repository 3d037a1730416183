"""Substring dedup by sliding sentence spans.

A text is cut into sentences, here the pieces between marks that end a sentence
or a clause.  A piece of more than ``LONGEST`` words is cut further, after words
that a hash picks and at ``LONGEST`` words at the latest; what is picked depends
on the words alone, so a shared passage is cut alike wherever it stands, but for
its first and last piece.  So texts without punctuation have sentences too, and a
passage that starts and ends within a sentence loses a few words at each end.

Every run of ``run_length`` consecutive sentences is hashed to 128 bits and joined
globally: the first document (smallest id) that has a span keeps it, and within a
document its first occurrence.  Sentences covered by other occurrences are
repeated; a stretch of repeated sentences goes if it has ``min_words`` words.  A
longer run is a chain of such spans, so no longer runs need be hashed.

The plan.  Texts are put into chunks of some megabytes, compressed, one row each.
A chunk sends each of its distinct spans once, with the smallest id that has it,
so a span that a third of the corpus shares is one row of each chunk and no more.
A window over the spans finds the smallest id of all; a chunk is told of the spans
that a smaller id has, and cuts its texts.

Defined results: null texts are taken as empty; words are runs of word
characters, lower-cased; a null id comes after all others; rows with equal ids
count as one document; an empty table gives an empty result; other columns are
not read.  doc_id is a whole number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinlink.llm.common import count_partitions, packed, stored, unpacked

MARKS = ".!?,;:\n。！？，；：、।؟،؛"
SENTENCE = re.compile(f"[^{MARKS}]*(?:[{MARKS}]+\\s*|$)")
WORD = re.compile(r"\w+")
LONGEST, PICKED = 16, 6  # words of a sentence at most; one word in PICKED may end a part of a longer one
LAST = (1 << 63) - 1  # stands for a null id


def parts_of(sentence: str) -> list[str]:
    """A sentence of more than ``LONGEST`` words in parts."""
    words, out, begin, n = list(WORD.finditer(sentence)), [], 0, 0
    if len(words) > LONGEST:
        for word, after in zip(words, words[1:], strict=False):
            n += 1
            if n == LONGEST or xxhash.xxh3_64_intdigest(word.group().lower()) % PICKED == 0:
                out.append(sentence[begin : after.start()])
                begin, n = after.start(), 0
    return [*out, sentence[begin:]]


def sentences(text: str | None) -> list[str]:
    """The text cut into sentences; joined they give the text again."""
    return [p for s in SENTENCE.findall(text or "") if s for p in (parts_of(s) if len(s) > 2 * LONGEST else (s,))]


def spans(words: list[list[str]], run_length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (n x 2 longs) of all runs of sentences with words, and the sentences with words; run k starts at the k-th of these."""
    full = [i for i, w in enumerate(words) if w]
    size = 16 * run_length
    line = b"".join([xxhash.xxh3_128_digest(" ".join(words[i])) for i in full])
    own = b"".join([xxhash.xxh3_128_digest(line[k : k + size]) for k in range(0, len(line) - size + 1, 16)])
    return np.frombuffer(own, dtype="<i8").reshape(-1, 2), np.array(full, dtype=np.int64)


def chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """chunk, ids, sizes, texts: documents by about ``chunk_bytes`` of text, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial, ids, texts, total = TaskContext.get().partitionId(), 0, [], [], 0

        def flush() -> pa.RecordBatch:
            sizes, text = packed(np.array([len(t) for t in texts])), zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            return pa.RecordBatch.from_arrays([pa.array([part << 32 | serial], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.binary()), pa.array([text], pa.binary())], ["chunk", "ids", "sizes", "texts"])

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text or b"")
                total += len(texts[-1])
                if total >= chunk_bytes:
                    yield flush()
                    serial, ids, texts, total = serial + 1, [], [], 0
        if ids:
            yield flush()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, "chunk long, ids array<long>, sizes binary, texts binary")


class Chunk:
    """The texts of a chunk with their spans."""

    def __init__(self, ids: list[int | None], sizes: bytes, texts: bytes, run_length: int):
        self.ids = np.array([LAST if i is None else i for i in ids], dtype=np.int64)
        whole, ends = zstandard.ZstdDecompressor().decompress(texts), np.cumsum(unpacked(sizes))
        self.cut, self.counts, self.full, own = [], [], [], []
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            cut = sentences(whole[a:b].decode("utf-8", "replace"))
            words = [WORD.findall(s.lower()) for s in cut]
            hashes, full = spans(words, run_length)
            self.cut.append(cut)
            self.counts.append(np.array([len(w) for w in words], dtype=np.int64))
            self.full.append(full)
            own.append(hashes)
        self.lengths = np.array([len(h) for h in own], dtype=np.int64)
        self.hashes = np.concatenate(own) if own else np.zeros((0, 2), dtype=np.int64)
        self.doc = np.repeat(np.arange(len(self.ids)), self.lengths)

    def grouped(self, more: np.ndarray) -> np.ndarray:
        """The number of the distinct span of each row of the chunk's spans and of ``more``."""
        rows = np.concatenate([self.hashes, more])
        order = np.lexsort((rows[:, 1], rows[:, 0]))
        new = np.ones(len(rows), dtype=np.int64)
        if len(rows):
            new[1:] = (rows[order[1:]] != rows[order[:-1]]).any(axis=1)
        out = np.empty(len(rows), dtype=np.int64)
        out[order] = np.cumsum(new) - 1
        return out

    def firsts(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct spans and the smallest id that has each."""
        group = self.grouped(self.hashes[:0])
        n = int(group.max()) + 1 if len(group) else 0
        least, spot = np.full(n, LAST), np.zeros(n, dtype=np.int64)
        np.minimum.at(least, group, self.ids[self.doc])
        spot[group] = np.arange(len(group))
        return self.hashes[spot], least

    def kept(self, known: np.ndarray, first: np.ndarray, run_length: int, min_words: int) -> Iterator[tuple[int, int, str]]:
        """Sentences, sentences removed and the text kept of each document; known, first: spans that a smaller id has elsewhere, and that id."""
        group = self.grouped(known)
        n = int(group.max()) + 1 if len(group) else 0
        least = np.full(n, LAST)
        own, told = group[: len(self.doc)], group[len(self.doc) :]
        np.minimum.at(least, own, self.ids[self.doc])
        np.minimum.at(least, told, first)
        # The first of equal spans within a document comes first in a stable order by span and document.
        order = np.lexsort((self.doc, own))
        again = np.zeros(len(own), dtype=bool)
        again[order[1:]] = (own[order[1:]] == own[order[:-1]]) & (self.doc[order[1:]] == self.doc[order[:-1]])
        gone = again | (self.ids[self.doc] > least[own])
        begin = 0
        for cut, counts, full, k in zip(self.cut, self.counts, self.full, self.lengths.tolist(), strict=True):
            out = np.zeros(len(cut), dtype=bool)
            at = np.flatnonzero(gone[begin : begin + k])
            begin += k
            if len(at):
                cover = np.zeros(len(full) + 1, dtype=np.int64)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + run_length, -1)
                repeated = np.cumsum(cover[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], repeated, [0]])))
                for a, b in edges.reshape(-1, 2).tolist():
                    if counts[full[a:b]].sum() >= min_words:
                        out[full[a] : full[b - 1] + 1] = True
            yield len(cut), int(out.sum()), "".join([s for s, x in zip(cut, out, strict=True) if not x])


def span_rows(units: DataFrame, run_length: int) -> DataFrame:
    """chunk, h1, h2, doc_id: each distinct span of each chunk with the smallest id that has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, ids, sizes, texts in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                known, least = Chunk(ids, sizes, texts, run_length).firsts()
                for k in range(0, len(known), 65536):
                    some, low = np.ascontiguousarray(known[k : k + 65536].T), least[k : k + 65536]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(low), name)), pa.array(some[0]), pa.array(some[1]), pa.array(low)], ["chunk", "h1", "h2", "doc_id"])

    return units.mapInArrow(run, "chunk long, h1 long, h2 long, doc_id long")


def dedup_spans(docs: DataFrame, run_length: int = 3, min_words: int = 28, chunk_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, n_sentences, n_removed, kept (text)."""
    if docs.schema["doc_id"].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError("doc_id is a whole number")
    units = stored(chunks(docs, chunk_bytes), "span-chunks")
    parts = count_partitions(units.count(), 4, 8)
    shared = span_rows(units, run_length).repartition(parts, "h1", "h2").withColumn("first", F.min("doc_id").over(Window.partitionBy("h1", "h2")))
    told = shared.filter(F.col("first") < F.col("doc_id")).select("chunk", "h1", "h2", "first")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_sentences long, n_removed long, kept string"

    def run(key: tuple, own: pa.Table, told: pa.Table) -> pa.Table:
        rows = []
        known = np.stack([told.column("h1").to_numpy(), told.column("h2").to_numpy()], axis=1) if len(told) else np.zeros((0, 2), dtype=np.int64)
        first = told.column("first").to_numpy() if len(told) else np.zeros(0, dtype=np.int64)
        for ids, sizes, texts in zip(own.column("ids").to_pylist(), own.column("sizes").to_pylist(), own.column("texts").to_pylist(), strict=True):
            rows += [(i, *r) for i, r in zip(ids, Chunk(ids, sizes, texts, run_length).kept(known, first, run_length, min_words), strict=True)]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.table({c: pa.array(x, t) for c, x, t in zip(("doc_id", "n_sentences", "n_removed", "kept"), columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)})

    by = lambda d: d.repartition(parts, "chunk").groupBy("chunk")
    return by(units).cogroup(by(told)).applyInArrow(run, schema.replace(schema.split(",")[0], "doc_id long", 1)).select(F.col("doc_id").cast(docs.schema["doc_id"].dataType), "n_sentences", "n_removed", "kept")
