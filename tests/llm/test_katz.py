"""Against the model by its definition, over plain dictionaries, with its own discounts."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from kinlink.llm import common, katz
from pyspark.sql import functions as F


def fold():
    return F.crc32(F.col("doc_id").cast("string")) % 10 != 0


def learns(i):
    return zlib.crc32(str(i).encode()) % 10 != 0


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def good_turing(counts, k):
    """The count that Good and Turing give each count up to k, scaled so that counts above k stay as they are (Katz 1987)."""
    n = Counter(counts)
    out = {}
    for r in range(1, k + 1):
        star = (r + 1) * n[r + 1] / n[r] if n[r] else 0
        above = (k + 1) * n[k + 1] / n[1] if n[1] else 1
        d = (star / r - above) / (1 - above) if above < 1 else 0
        if not 0 < d < 1 or not n[r]:
            d = (r - (n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5)) / r
        out[r] = d
    return out


class Brute:
    def __init__(self, texts, k):
        self.c = Counter(w for t in texts for w in tokens(t))
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.after = defaultdict(Counter)
        for t in texts:
            v = "start"
            for w in tokens(t):
                self.after[v][w] += 1
                v = w
        self.d1 = good_turing(self.c.values(), k)
        self.d2 = good_turing([n for x in self.after.values() for n in x.values()], k)

    def p1(self, w):
        if not self.n:
            return 1.0
        kept = sum(n * self.d1.get(n, 1) for n in self.c.values())
        whole = self.n if kept < self.n - 1e-9 else self.n + 1
        n = self.c[w]
        return n * self.d1.get(n, 1) / whole if n else 1 - kept / whole

    def p(self, w, v):
        seen = self.after.get(v)
        if not seen:
            return self.p1(w)
        total, kept = sum(seen.values()), sum(n * self.d2.get(n, 1) for n in seen.values())
        total = total if kept < total - 1e-9 else total + 1
        if w in seen:
            return seen[w] * self.d2.get(seen[w], 1) / total
        return (1 - kept / total) / (1 - sum(self.p1(x) for x in seen)) * self.p1(w)

    def score(self, text):
        out, v = 0.0, "start"
        for w in tokens(text):
            out += math.log10(self.p(w, v))
            v = w
        return out

    def base(self, text):
        return sum(math.log10((self.c[w] + 0.1) / (self.n + 0.1 * (self.v + 1))) for w in tokens(text))


def corpus(seed, n):
    r = random.Random(seed)
    words = [f"W{i}" for i in range(60)] + ["é", "É"]
    out = []
    for i in range(n):
        at, text = r.randint(0, 61), []
        for _ in range(r.randint(0, 30)):
            text.append(words[at] if r.random() < 0.97 else f"rare{r.randint(0, 5000)}")
            at = (at * 5 + min(3, int(r.expovariate(1)))) % 62
        out.append((i, None if i == 7 else " ".join(text)))
    return out


def test_against_brute_force(spark):
    rows = corpus(1, 300)
    b = Brute([t for i, t in rows if learns(i)], 5)
    for hot, size in ((10**6, 12 << 20), (60, 300)):  # one shard; many shards, with contexts dealt by both words
        out = katz.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), fold(), hot=hot, unit_tokens=700, shard_bytes=size).collect()
        texts = dict(rows)
        assert len(out) == len(rows)
        for r in out:
            t = texts[r.doc_id]
            assert r.learned == learns(r.doc_id) and r.train_tokens == b.n
            assert (r.n_tokens, r.n_known) == (len(tokens(t)), sum(b.c[w] > 0 for w in tokens(t)))
            assert abs(r.base_score - b.base(t)) < 1e-6 and abs(r.score - b.score(t)) < 1e-6
        held = [r for r in out if not r.learned]
        assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_add_up_to_one():
    b = Brute([t for _, t in corpus(2, 120)], 5)
    for v in ["start", "never seen", *b.c]:
        assert abs(sum(b.p(w, v) for w in [*b.c, "unseen"]) - 1) < 1e-9


def test_tables_hold_every_word_and_bigram(spark):
    rows = corpus(3, 80)
    b = Brute([t for _, t in rows], 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    units = common.stored(katz.unit_rows(docs, F.lit(True), 500), "u")
    words = common.stored(katz.answered_words(units, 3, 5), "w")
    table = {bytes(r.word): (r.number, r.n) for r in katz.unigram_table(words).collect()}
    assert {(None if w == katz.END else w): n for w, (_, n) in table.items()} == b.c and len({k for k, _ in table.values()}) == len(b.c)
    of_counts = Counter(b.c.values())
    model = katz.Model(b.n, b.v, len(rows), katz.discounts(of_counts, 5), of_counts, 40)
    pairs = common.stored(katz.answered_pairs(units, words, spark.sparkContext.broadcast(model), 3, 3, 2), "p")
    name = {k: (None if w == katz.END else w) for w, (k, _) in table.items()} | {katz.START: "start"}
    found = {(name[r.v], name[r.w]): r.n for r in katz.bigram_table(pairs).collect()}
    assert found == {(v, w): n for v, x in b.after.items() for w, n in x.items()}
    sums = {name[r.v]: r for r in katz.hot_sums(pairs, 5).collect()}
    hot = {v for v, x in b.after.items() if sum(x.values()) > 40}
    assert set(sums) == hot and hot
    for v in hot:
        assert abs(sums[v].mass - sum(b.p1(w) for w in b.after[v])) < 1e-9 and sums[v].s1 == sum(n == 1 for n in b.after[v].values())


def test_packing_of_numbers():
    for a in ([], [0], [5, 5, 9, 1 << 40], [-3, 7]):
        assert common.unpacked(common.packed(np.array(a))).tolist() == a


def test_odd_rows(odd, none):
    out = {r.doc_id: r for r in katz.score(odd, fold()).collect()}
    assert out[1].n_tokens == out[2].n_tokens == out[3].n_tokens == 1 and out[9].n_tokens == 30_001 and not out[None].learned
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in out.values())
    assert katz.score(none, fold()).count() == 0
    assert {r.score for r in katz.score(odd, F.lit(False)).collect()} == {0.0}
