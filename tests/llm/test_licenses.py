import random
import re

from kinlink.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return "".join(c.lower() if c.isascii() else c for c in t or "")


def brute(text, threshold, templates):
    w = WORD.findall(low(text))
    hits = sorted((i, x) for p, x in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
    best = {}
    for line in low(text).split("\n"):
        b = set(WORD.findall(line))
        for x, t in templates:
            t = set(licenses.template_words(t))
            if len(b & t) >= threshold * len(t) - 1e-9 and b & t:
                best[x] = max(best.get(x, 0), len(b & t) / len(t))
    base = sorted({x for _, x in hits})
    return len(w), len(hits), hits[0][0] if hits else None, hits[-1][0] if hits else None, base, sorted({*base, *best}), 1.0 if hits else max(best.values(), default=0.0)


def row(r):
    return r.n_words, r.n_base, r.first_word, r.last_word, list(r.base_labels), list(r.labels), r.score


def test_against_brute_force(spark):
    r = random.Random(8)
    pool = [w for _, t in licenses.TEMPLATES for w in t.split()]
    rows = []
    for i in range(300):
        lines = []
        for _ in range(r.randint(0, 5)):
            t = list(r.choice(licenses.TEMPLATES)[1].split())
            for _ in range(r.randint(0, 6)):
                t[r.randrange(len(t))] = r.choice(pool)
            lines.append(r.choice([" ".join(t), "the of and to a b", "MIT License, cc by", "GNU General\nPublic License É", ""]))
        rows.append((i, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for threshold in (0.5, 0.8, 1.0):
        out = {x.doc_id: row(x) for x in licenses.scan(df, threshold).collect()}
        assert out == {i: brute(t, threshold, licenses.TEMPLATES) for i, t in rows}
    assert sum(bool(x[5]) for x in out.values()) > 30


def test_odd_rows(odd, none):
    out = {x.doc_id: x for x in licenses.scan(odd).collect()}
    assert row(out[1]) == (0, 0, None, None, [], [], 0.0) and out[9].n_words == 30_000
    assert licenses.scan(none).count() == 0


def test_notices_over_several_lines(spark):
    r, rows, want = random.Random(9), [], []
    for x, t in licenses.TEMPLATES:
        for width in (1, 4, 9):
            w = t.split()
            body = "\n".join(" * " + " ".join(w[k : k + width]) for k in range(0, len(w), width))
            want.append(x)
            rows.append((len(rows), " ".join(r.choice(["blue", "tree", "of", "and"]) for _ in range(40)) + "\n" + body + "\nend of it"))
    w = " ".join(t for _, t in licenses.TEMPLATES).split()
    far = "\n".join(y for x in w for y in [x, *["tree"] * 20])
    df = spark.createDataFrame([*rows, (len(rows), far)], "doc_id long, text string")
    out = {x.doc_id: x for x in licenses.scan(df, wrapped=True).collect()}
    assert all(x in out[i].labels and out[i].score >= 0.8 for i, x in enumerate(want))
    assert list(out[len(rows)].labels) == [] and out[len(rows)].score == 0  # all the words, but far apart
