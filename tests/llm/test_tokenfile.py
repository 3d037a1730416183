import random
import uuid
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given
from hypothesis import strategies as st
from kinlink.llm import tokenfile
from kinlink.llm.common import shared_dir
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library_ids(text):
    """What the tokenizers library itself gives, and the end id."""
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4").tobytes()


@given(st.lists(st.integers(0, 5000), max_size=700))
def test_elias_fano_round_trip(steps):
    v = np.cumsum(np.array(steps, dtype=np.int64))
    e = tokenfile.EliasFano.from_bytes(tokenfile.EliasFano.build(v, int(v[-1]) if len(v) else 0).to_bytes())
    assert e.values().tolist() == v.tolist()
    assert [e.select(i) for i in range(0, len(v), 37)] == v.tolist()[::37]


def test_space_is_near_the_bound():
    r = np.random.default_rng(1)
    v = np.sort(r.integers(0, 10_000_000, 20_000))
    assert 8 * len(tokenfile.EliasFano.build(v, 10_000_000).to_bytes()) < 20_000 * (2.2 + np.log2(500)) + 1000


def test_against_brute_force(spark):
    r = random.Random(9)
    docs = [(3 * i - 50, None if i == 5 else " ".join(r.choice(["the", "cat", "Häuser"]) for _ in range(r.randint(0, 60)))) for i in range(300)]
    r.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    path = f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"
    tokenfile.write(df, PATH, path, 0, segment_ids=500, part_bytes=2000)
    want, at = [], 0
    for i, t in sorted(docs):
        ids = library_ids(t)
        want.append((i, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    assert sorted(map(tuple, tokenfile.boundaries(spark, path).collect())) == want
    assert spark.read.parquet(path).count() > 10
    some = df.filter("doc_id % 7 = 0").select("doc_id")
    got = {r.doc_id: (r.start, r.n_tokens, zlib.crc32(r.ids)) for r in tokenfile.lookup(spark, path, some).collect()}
    assert got == {i: (at, n, crc) for i, at, n, crc in want if i % 7 == 0} and got


def test_odd_rows(odd, none):
    out = sorted(tokenfile.round_trip(odd, PATH).collect(), key=lambda r: r.start)
    assert len(out) == 12 and out[0].doc_id is None and [r.start for r in out[1:]] == np.cumsum([r.n_tokens for r in out])[:-1].tolist()
    assert tokenfile.round_trip(none, PATH).count() == 0


def test_read_gives_the_ids(spark):
    path = f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"
    tokenfile.write(spark.createDataFrame([(2, "the cat"), (1, "a"), (3, None)], "doc_id long, text string"), PATH, path, 0)
    want = [library_ids(t) for t in ("a", "the cat", None)]
    assert [bytes(r.ids) for r in sorted(tokenfile.read(spark, path).collect(), key=lambda r: r.doc_id)] == want
