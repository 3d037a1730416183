import random

import numpy as np
from kinlink.llm import decontam


def brute_tile(p, t, least):
    """Greedy string tiling by definition: mark a longest free match, again and again."""
    fp, ft, covered = [x > 0 for x in p], [x > 0 for x in t], 0
    while True:
        best = (0, 0, 0)
        for i in range(len(p)):
            for j in range(len(t)):
                n = 0
                while i + n < len(p) and j + n < len(t) and fp[i + n] and ft[j + n] and p[i + n] == t[j + n]:
                    n += 1
                best = max(best, (n, -j, -i))
        n, j, i = best[0], -best[1], -best[2]
        if n < least:
            return covered
        covered += n
        for k in range(n):
            fp[i + k] = ft[j + k] = False


def test_tiling_against_definition():
    r = random.Random(2)
    for _ in range(150):
        p = [r.randint(0, 6) for _ in range(r.randint(0, 30))]
        t = [r.randint(0, 6) for _ in range(r.randint(0, 40))]
        tiles = decontam.tile(np.array(p, dtype=np.int64), np.array(t, dtype=np.int64), 3)
        assert sum(x[2] for x in tiles) == brute_tile(p, t, 3)
        assert all(p[i : i + n] == t[j : j + n] for i, j, n in tiles)


def test_running_hashes():
    r = random.Random(3)
    ids = np.array([r.randint(0, 50) for _ in range(200)], dtype=np.int64)
    for n in (1, 2, 7, 199, 200):
        want = []
        for i in range(200 - n + 1):
            h = 0
            for x in ids[i : i + n].tolist():
                h = (h * decontam.BASE + x) % (1 << 64)
            want.append(h)
        assert decontam.Running(ids).of(n).tolist() == want
    assert len(decontam.Running(ids).of(201)) == 0


def test_search_against_brute_tiling():
    """Every item of a block in random documents, whole and in pieces, against the tiling of the full texts."""
    r = random.Random(8)
    words = [f"w{i}" for i in range(25)]
    items = [(i, " ".join(r.choice(words) for _ in range(r.randint(3, 25)))) for i in range(12)]
    block = decontam.Block(items, 4)
    for _ in range(60):
        text = [r.choice(words) for _ in range(r.randint(0, 30))]
        for _, t in r.sample(items, 2):
            cut = t.split()
            k = r.randrange(len(cut))
            text += cut[k:] + [r.choice(words)] + cut[:k]
        found = {i: (n, size) for i, n, size, _ in block.search(" ".join(text)) if n}
        number = {w: k for k, w in enumerate(sorted(set(text) | {w for _, t in items for w in t.split()}), 1)}
        want = {i: (brute_tile([number[w] for w in t.split()], [number[w] for w in text], 4), len(t.split())) for i, t in items}
        assert found == {i: x for i, x in want.items() if x[0]}


BENCH = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, None), (3, "too short"), (4, "one two three four five six seven eight nine ten eleven twelve")]


def test_exact_reordered_partial(spark):
    docs = spark.createDataFrame(
        [(10, "x y Alpha, beta gamma delta epsilon ZETA eta theta iota kappa. z"), (11, "zeta eta theta iota kappa and then alpha beta gamma delta epsilon"), (12, "alpha beta gamma delta epsilon only"), (13, None), (14, ""), (15, "clean words here that share nothing at all"), (16, "one two three four five six seven eight nine ten x y")],
        "doc_id long, text string",
    )
    for size in (3, 500_000):
        out = {(r.doc_id, r.item_id): (r.matched, r.item_tokens, len(r.tiles)) for r in decontam.contaminated(docs, spark.createDataFrame(BENCH, "item_id long, text string"), block_tokens=size).collect()}
        assert out == {(10, 1): (10, 10, 1), (11, 1): (10, 10, 2), (16, 4): (10, 12, 1)}


def test_odd_rows(spark, odd, none):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    assert decontam.contaminated(odd, bench).count() == 0
    assert decontam.contaminated(none, bench).count() == 0
    assert decontam.contaminated(odd, bench.limit(0)).count() == 0
    own = spark.createDataFrame([(7, "x " * 300)], "item_id long, text string")
    assert [(r.doc_id, r.coverage) for r in decontam.contaminated(odd, own).collect()] == [(9, 1.0)]
