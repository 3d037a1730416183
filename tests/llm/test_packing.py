import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pyarrow as pa
from kinlink.llm import cutting, packing
from kinlink.llm.encode import Encoder
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_encoder_gives_the_library_s_ids():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    texts = ["", " a", "a ", "a  b", "a \n b", "\n a", "a\u00a0 b", "<|endoftext|> x", "it's 'd we'll", "1 2  3", "é\u200b x", None, "x\x1c y", "a\u3000b c", "plain words stand here.\nNext line", "plain words"]
    texts += ["ab.\nCd, e", "a\n\nb c", "x &&&\nY*** _z", "don't. He'll\n's a", "ſtra ŉ Ω.", "a\tb c", "x a.\nb!? c&&& d1 \U0001f600", "中文 字"]
    want = [b"".join(i.to_bytes(4, "little") for i in t.encode(x or "", add_special_tokens=False).ids) for x in texts]
    assert Encoder(open(PATH).read()).encode(pa.array(texts)) == want


def test_encoder_on_whole_documents():
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).combine_chunks()
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in library.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
    assert list(Encoder(open(PATH).read()).encode(texts)) == want


def test_words_of_earlier_batches_are_not_encoded_again(monkeypatch):
    encode = Tokenizer.from_file(PATH).encode
    batches = [["one two, three\nfour two", "x two five"], ["x two five, three\nfour six", "y seven"], ["y six seven two\nfour"]]
    for most in (1_000_000, 1):
        monkeypatch.setattr("kinlink.llm.encode.WORDS", most)
        encoder, met = Encoder(open(PATH).read()), []
        of = encoder.words
        encoder.words = lambda words, spaced: met.extend((x, spaced) for x in words.to_pylist()) or of(words, spaced)  # noqa: B023
        for texts in batches:
            got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(pa.array(texts))]
            assert got == [encode(x, add_special_tokens=False).ids for x in texts]
        assert most == 1 or sorted(met) == sorted(set(met))


def test_cutting_stock_is_near_the_bound():
    r = random.Random(1)
    for sizes in ([r.randint(1, 64) for _ in range(3000)], [33] * 500, [64], [1] * 10, [21, 43] * 300):
        histogram = defaultdict(int)
        for s in sizes:
            histogram[s] += 1
        plan = cutting.solve(histogram, 64)
        made = defaultdict(int)
        for n, p in plan:
            assert sum(k * c for k, c in p.items()) <= 64
            for k, c in p.items():
                made[k] += n * c
        assert made == histogram
        least = max(-(-sum(sizes) // 64), sum(s > 32 for s in sizes))
        assert sum(n for n, _ in plan) <= 1.02 * least + 3
    assert cutting.solve({}, 64) == []


def check(rows, docs, seq_len):
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    whole = [np.array(e.ids, dtype="<u4").tobytes() for e in library.encode_batch([t or "" for _, t in docs], add_special_tokens=False)]
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for (i, _), ids in zip(docs, whole, strict=True):
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) // 4 + 1
            assert r.ids_crc32 == zlib.crc32((ids + b"\0\0\0\0")[4 * at : 4 * (at + r.length)])
            at += r.length
        assert at == len(ids) // 4 + 1
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= seq_len
    assert sorted(by_seq) == list(range(len(by_seq)))
    return sum(r.length for r in rows) / (seq_len * len(by_seq))


def test_every_id_once_and_little_padding(spark):
    r = random.Random(7)
    docs = [(i, None if i == 3 else " ".join(r.choice(["the", "cat", "Häuser", "x1"]) for _ in range(int(r.expovariate(1 / 150))))) for i in range(400)]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), PATH, 256, 0, 1, with_ids=True).collect()
    assert check(rows, docs, 256) > 0.98
    assert all(zlib.crc32(x.ids) == x.ids_crc32 for x in rows)


def test_odd_rows(odd, none):
    out = packing.pack(odd, PATH).collect()
    assert sum(r.start == 0 for r in out) == 12 and len({(r.sequence_id, r.offset) for r in out}) == len(out)
    assert packing.pack(none, PATH).count() == 0
