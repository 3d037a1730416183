import random

import xxhash
from kinlink.llm import simhash


def brute(rows, k, bits):
    fps = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        s = [b" ".join(w[j : j + k]) for j in range(max(1, len(w) - k + 1))] if w else []
        h = [xxhash.xxh64_intdigest(x, seed=42) for x in s]
        fps.append((i, sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))))
    return fps, components(fps, bits)


def components(fps, bits):
    root = {i: i for i, _ in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(fps):
        for j, b in fps[:n]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted((i, find(i)) for i, _ in fps)


def test_against_brute_force(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(60):
        t = [r.choice(words) for _ in range(r.choice([0, 1, 2, 3, 200]))]
        rows += [(4 * i, " ".join(t)), (4 * i + 1, " ".join(t[:-1])), (4 * i + 2, " ".join(t).upper()), (4 * i + 3, " ".join(t[1:]))]
    fps, comp = brute(rows, 3, 2)
    out = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 2).collect()
    assert sorted((x.doc_id, x.fp & (1 << 64) - 1) for x in out) == sorted(fps)
    assert sorted((x.doc_id, x.component_id) for x in out) == comp


def test_links_light_and_heavy_agree_with_brute_force(spark):
    r = random.Random(5)
    seeds = [r.getrandbits(64) for _ in range(6)]
    fps = {s for s in seeds}
    for _ in range(400):
        s = r.choice(seeds)
        for b in r.sample(range(64), r.randint(0, 4)):
            s ^= 1 << b
        fps.add(s)
    fps = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    for bits in (1, 2):
        want = components([(x, x & (1 << 64) - 1) for x in fps], bits)
        for heavy in (2, 64, 10_000):
            roots = {x.node: x.root for x in simhash.components(simhash.links(df, bits, heavy)).collect()}
            assert sorted((x, roots.get(x, x)) for x in fps) == want


def test_odd_rows(odd, none):
    out = {r.doc_id: r for r in simhash.near_duplicates(odd).collect()}
    assert out[1].fp == out[2].fp == out[3].fp == 0 and out[1].component_id == out[3].component_id == 1
    assert len(out) == 11 and simhash.near_duplicates(none).count() == 0
