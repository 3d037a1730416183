"""Against a version that knows nothing of the operator's code: cut by a scan over characters, all runs, no chunks."""

import random

import xxhash
from kinlink.llm import spans

MARKS = set(".!?,;:\n。！？，；：、।؟،؛")


def words_at(s):
    out, begin = [], None
    for k, c in enumerate(s + " "):
        if c.isalnum() or c == "_":
            begin = k if begin is None else begin
        elif begin is not None:
            out.append((begin, s[begin:k].lower()))
            begin = None
    return out


def scan(text):
    cut, k = [], 0
    while k < len(text):
        end = k
        while end < len(text) and text[end] not in MARKS:
            end += 1
        while end < len(text) and text[end] in MARKS:
            end += 1
        while end < len(text) and text[end].isspace():
            end += 1
        cut.append(text[k:end])
        k = end
    out = []
    for s in cut:
        words, begin, n = words_at(s), 0, 0
        for (_, w), (after, _) in zip(words, words[1:], strict=False):
            n += 1
            if len(words) > 16 and (n == 16 or xxhash.xxh3_64_intdigest(w) % 6 == 0):
                out.append(s[begin:after])
                begin, n = after, 0
        out.append(s[begin:])
    return out


def brute(rows, least):
    """In order of id, a run of three sentences found before is repeated, and long stretches of repeated sentences go."""
    owner, out = {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        cut = scan(t or "")
        words = [[w for _, w in words_at(s)] for s in cut]
        full = [k for k, w in enumerate(words) if w]
        repeated, seen = set(), set()
        for k in range(len(full) - 2):
            run = tuple(tuple(words[x]) for x in full[k : k + 3])
            if run in seen or owner.setdefault(run, (i,)) != (i,):
                repeated |= {k, k + 1, k + 2}
            seen.add(run)
        gone, k = set(), 0
        while k < len(full):
            end = k
            while end in repeated:
                end += 1
            if end > k and sum(len(words[x]) for x in full[k:end]) >= least:
                gone |= set(range(full[k], full[end - 1] + 1))
            k = max(end, k + 1)
        out.append((i, len(cut), len(gone), "".join(s for k, s in enumerate(cut) if k not in gone)))
    return out


def corpus(seed):
    r = random.Random(seed)
    word = lambda: r.choice("abcdefghijklmnopqrstuvwxyz") + r.choice("xyz")
    sentence = lambda: " ".join(word() for _ in range(r.choice([1, 3, 5, 9, 30]))).capitalize() + r.choice([". ", "! ", "?\n", ", ", "\n\n", ""])
    shared = ["".join(sentence() for _ in range(8)) for _ in range(5)]
    return [(i, "".join(r.choice(shared) if r.random() < 0.3 else sentence() for _ in range(r.randint(0, 12)))) for i in range(80)]


def test_against_brute_force(spark):
    rows = corpus(4)
    rows += [(80, "lyon " * 300), (81, "lyon " * 200 + "und " * 200), (82, None), (None, rows[3][1] + rows[5][1])]
    for size in (1, 5000, 1 << 22):
        out = spans.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 12, size).collect()
        assert sorted(map(tuple, out), key=lambda r: (r[0] is None, r[0])) == brute(rows, 12)
    assert sum(x.n_removed for x in out) > 50


def test_planted_passages_and_clean_texts(spark):
    """Passages of 51 to 80 words, cut anywhere, into texts of other words: nine in ten lose half of their words, clean texts none."""
    r = random.Random(9)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(3000)]
    text = lambda n: [r.choice(vocabulary) + r.choice(["", "", "", "", "", ".", ",", ".\n"]) for _ in range(n)]
    passages = [text(r.randint(51, 80)) for _ in range(40)]
    rows, planted = [], []
    for i in range(240):
        own, at = text(200), r.randrange(200)
        if i < 120:
            planted.append((i, passages[i % 40]))
            own[at:at] = passages[i % 40]
        rows.append((i, " ".join(own)))
    out = {x.doc_id: x for x in spans.dedup_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[i].n_removed == 0 for i in range(120, 240)) and all(out[i].n_removed == 0 for i in range(40))
    lost = {i: len(dict(rows)[i].split()) - len(out[i].kept.split()) for i in range(40, 120)}
    assert sum(lost[i] >= len(p) / 2 for i, p in planted if i >= 40) >= 0.9 * 80
    assert all(lost[i] <= len(p) + 2 for i, p in planted if i >= 40)


def test_sentences_are_lossless():
    for t in ("", "a", "A b. C d! \n\nE?F", "...", "\n", "x. ", "no end\nnext. ", "w " * 100, "a,b;c:d"):
        assert "".join(spans.sentences(t)) == t and spans.sentences(t) == scan(t)


def test_odd_rows(odd, none):
    out = spans.dedup_spans(odd).collect()
    assert len(out) == 12 and {r.doc_id for r in out if r.n_removed} == {9}  # "x " 30,000 times is its own repeat
    assert spans.dedup_spans(none).count() == 0
