"""Token ids from a tokenizers file, fast where texts share words.

A byte-level BPE file splits a text into pieces by a pattern before it merges
bytes, and a single space between two characters that are not white space
always starts a new piece.  So the texts of a batch are cut at such spaces, the
distinct chunks encoded once, and the ids of the chunks laid out again; the
result is what the library gives for the whole text.  Texts with other white
space beside a space are encoded whole.

Most chunks are letters with marks after them, or two such with a line end
between.  Their pieces are known without the pattern (which costs more than the
merges), so distinct words are encoded as pieces, many in one call, and kept for
the batches to come, up to a number of words.  All else is array work: nothing
is done for each occurrence in Python.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from kinlink.llm.common import given_back, kept_in_worker

#: Characters that one library or another takes for white space, besides those of Unicode's property.
ALSO_SPACE = "[᠎​﻿\x1c-\x1f]"
#: Letters to every library, whatever its Unicode version; and marks that are neither letter, number nor
#: white space to the pattern (an apostrophe may begin a piece of its own kind).
LETTERS = "[A-Za-zªµºÀ-ÖØ-öø-ɏ]+"
MARKS = r'[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]*'
ONE = f"^(?P<a>{LETTERS})(?P<b>{MARKS})$"
TWO = f"^(?P<a>{LETTERS})(?P<b>{MARKS})\n(?P<c>{LETTERS})(?P<d>{MARKS})$"
CALL, GROUP = 5000, 300_000
#: Bytes of text that are taken at a time, which bounds the memory of a worker.
BATCH = 16 << 20
#: Words of each kind whose ids an encoder keeps (some 50 MB); those met later are encoded in each batch.
WORDS = 1_000_000


class Ragged:
    """Lists of ids, one after another: list k is ``flat[start[k] : start[k] + size[k]]``."""

    def __init__(self, flat: np.ndarray, size: np.ndarray, start: np.ndarray | None = None):
        self.flat, self.size = flat, size.astype(np.int64)
        self.start = np.cumsum(self.size) - self.size if start is None else start

    @classmethod
    def of(cls, lists: list) -> Ragged:
        return cls(np.array([i for x in lists for i in x], dtype="<u4"), np.array([len(x) for x in lists], dtype=np.int64))

    def places(self, k: np.ndarray) -> np.ndarray:
        size = self.size[k]
        return np.repeat(self.start[k] - (np.cumsum(size) - size), size) + np.arange(size.sum())

    def take(self, k: np.ndarray) -> Ragged:
        return Ragged(self.flat[self.places(k)], self.size[k])


def together(parts: list[Ragged]) -> Ragged:
    """List k of the result is the lists k of all parts joined."""
    size = sum(p.size for p in parts)
    start = np.cumsum(size) - size
    flat = np.empty(int(size.sum()), dtype="<u4")
    for p in parts:
        flat[np.repeat(start - (np.cumsum(p.size) - p.size), p.size) + np.arange(p.size.sum())] = p.take(np.arange(len(p.size))).flat
        start = start + p.size
    return Ragged(flat, size)


class Encoder:
    def __init__(self, source: str, batch_bytes: int = BATCH):
        """source: the text of a tokenizers JSON file; batch_bytes: more is faster, as chunks recur, and takes more memory."""
        self.batch_bytes = batch_bytes
        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        pre = self.tokenizer.pre_tokenizer
        self.cut = type(pre).__name__ == "ByteLevel" and not pre.add_prefix_space and self.tokenizer.normalizer is None
        vocabulary = self.tokenizer.get_vocab()
        self.n_ids = max(vocabulary.values(), default=0) + 1
        self.by_pattern, self.by_piece = pre, ByteLevel(add_prefix_space=False, use_regex=False)
        self.starts = {}
        for mark, name in ((" ", "Ġ"), ("\n", "Ċ")):
            self.starts[mark] = np.zeros(self.n_ids, dtype=bool)
            self.starts[mark][[i for x, i in vocabulary.items() if x.startswith(name)]] = True
        self.known = {spaced: (pa.array([], pa.large_string()), Ragged.of([])) for spaced in (True, False)}

    @classmethod
    def in_worker(cls, source: str, batch_bytes: int = BATCH) -> Encoder:
        """One encoder for all tasks that a Python worker runs."""
        return kept_in_worker(f"encoder {batch_bytes} {xxhash.xxh3_128_hexdigest(source)}", lambda: cls(source, batch_bytes))

    def whole(self, texts: list[str]) -> Ragged:
        return Ragged.of([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def parted(self, calls: list, mark: str, n: int) -> Ragged:
        """The ids of n parts that each begin with ``mark`` and hold no other."""
        ids = np.concatenate([np.zeros(0, "<u4"), *calls])
        start = np.flatnonzero(self.starts[mark][ids])
        if len(start) != n:
            raise ValueError(f"the tokenizer does not begin a token at each {mark!r}")
        return Ragged(ids, np.diff(start, append=len(ids)))

    def words(self, words: pa.Array, spaced: bool) -> Ragged:
        """Ids of words as pieces, with a space before each, or with none."""
        words, calls = words.to_numpy(zero_copy_only=False).tolist(), []
        self.tokenizer.pre_tokenizer = self.by_piece  # the same merges without the pattern
        for k in range(0, len(words), CALL):
            cut = [" " + x for x in words[k : k + CALL]] if spaced else [y for x in words[k : k + CALL] for y in ("\n", x)]
            calls.append(np.array(self.tokenizer.encode_batch_fast([cut], is_pretokenized=True, add_special_tokens=False)[0].ids, dtype="<u4"))
        self.tokenizer.pre_tokenizer = self.by_pattern
        out = self.parted(calls, " " if spaced else "\n", len(words))
        return out if spaced else Ragged(out.flat, out.size - 1, out.start + 1)

    def remembered(self, words: pa.Array, spaced: bool) -> Ragged:
        """``words`` of distinct words, of which those met in other batches are not encoded again."""
        seen, ids = self.known[spaced]
        words = words.cast(pa.large_string())
        at = pc.index_in(words, value_set=seen)
        new = at.is_null().to_numpy(zero_copy_only=False)
        fresh = words.filter(pa.array(new))
        made = self.words(fresh, spaced)
        every = Ragged(np.concatenate([ids.flat, made.take(np.arange(len(fresh))).flat]), np.concatenate([ids.size, made.size]))
        if more := min(len(fresh), WORDS - len(seen)):
            n = len(seen) + more
            self.known[spaced] = pa.concat_arrays([seen, fresh.slice(0, more)]), Ragged(every.flat[: every.size[:n].sum()].copy(), every.size[:n].copy())
        place = at.fill_null(0).to_numpy().astype(np.int64)
        place[new] = len(seen) + np.arange(len(fresh))
        return every.take(place)

    def column(self, values: pa.Array, encode) -> Ragged:
        """Ids of each value, each distinct one encoded once."""
        d = values.dictionary_encode()
        return encode(d.dictionary).take(d.indices.to_numpy(zero_copy_only=False))

    def chunks(self, parts: pa.Array) -> Ragged:
        """Ids of each part with a space before it; parts have no white space at their ends and no space inside."""
        lists, rest, at, out_at = [], parts, np.arange(len(parts)), []
        for pattern in (ONE, TWO):
            found = pc.extract_regex(rest, pattern)
            good = found.is_valid()
            here = found.filter(good)
            take = [self.column(here.field(0), lambda x: self.remembered(x, True)), self.column(here.field(1), lambda x: self.whole(x.to_pylist()))]
            if pattern is TWO:
                newline = self.whole(["\n"]).take(np.zeros(len(here), dtype=np.int64))
                take += [newline, self.column(here.field(2), lambda x: self.remembered(x, False)), self.column(here.field(3), lambda x: self.whole(x.to_pylist()))]
            lists.append(together(take))
            good = good.to_numpy(zero_copy_only=False)
            out_at.append(at[good])
            rest, at = rest.filter(pa.array(~good)), at[~good]
        hard = rest.to_pylist()
        calls = [np.array(self.tokenizer.encode_batch_fast([" " + " ".join(hard[k : k + CALL])], add_special_tokens=False)[0].ids, dtype="<u4") for k in range(0, len(hard), CALL)]
        lists.append(self.parted(calls, " ", len(hard)))
        back = np.empty(len(parts), dtype=np.int64)
        back[np.concatenate([*out_at, at])] = np.arange(len(parts))
        return Ragged(np.concatenate([x.flat for x in lists]), np.concatenate([x.size for x in lists])).take(back)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null is empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        cuts = np.searchsorted(sizes, np.arange(0, sizes[-1] if len(sizes) else 0, self.batch_bytes)[1:]).tolist()
        out: list[bytes] = []
        for low, high in zip([0, *cuts], [*cuts, len(texts)], strict=True):
            out += self.batch(texts.slice(low, high - low))
            given_back()
        return out

    def batch(self, texts: pa.Array) -> list[bytes]:
        n = len(texts)
        split = pc.split_pattern(texts, " ")
        ends = split.offsets.to_numpy()[1:] - split.offsets.to_numpy()[0]
        flat = split.flatten().dictionary_encode()
        chunks, number = flat.dictionary, flat.indices.to_numpy()
        bad = pc.or_(pc.equal(chunks, ""), pc.not_equal(chunks, pc.utf8_trim_whitespace(chunks)))
        bad = pc.or_(bad, pc.match_substring_regex(chunks, ALSO_SPACE)).to_numpy(zero_copy_only=False)
        start = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        unsafe = np.add.reduceat(bad[number], start) > 0 if n else np.zeros(0, bool)
        unsafe |= not self.cut
        sound = ~np.repeat(unsafe, ends - start)
        first = np.zeros(len(number), dtype=bool)
        first[start] = True
        used = np.zeros(len(chunks), dtype=bool)
        used[number[sound & ~first]] = True
        known, at = self.chunks(chunks.filter(pa.array(used))), (np.cumsum(used) - 1).astype(np.int32)
        out = [b""] * n
        # Ids are laid out for some texts at a time, so that memory goes with the chunks at hand.
        group = np.searchsorted(np.append(ends, 0)[:n], np.arange(0, len(number), GROUP)) if n else []
        for low, high in zip(group, [*group[1:], n], strict=True):
            docs = np.arange(low, high)[~unsafe[low:high]]
            if not len(docs):
                continue
            span = slice(start[low], ends[high - 1])
            tail = sound[span] & ~first[span]
            tails = known.take(at[number[span][tail]])
            size = np.bincount(np.repeat(np.arange(high - low), (ends - start)[low:high])[tail], weights=tails.size, minlength=high - low).astype(np.int64)
            heads = self.whole(chunks.take(pa.array(number[start[docs]])).to_pylist())
            both = together([heads, Ragged(tails.flat, size[docs - low])])  # a text's tail chunks stand next to each other
            data = both.flat.tobytes()
            for i, s, k in zip(docs.tolist(), (4 * both.start).tolist(), (4 * both.size).tolist(), strict=True):
                out[i] = data[s : s + k]
        hard = np.flatnonzero(unsafe)
        whole = self.whole(texts.take(pa.array(hard)).to_pylist())
        for i, s, k in zip(hard.tolist(), whole.start.tolist(), whole.size.tolist(), strict=True):
            out[i] = whole.flat[s : s + k].tobytes()
        return out
