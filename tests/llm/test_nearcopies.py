import random

from kinlink.llm import nearcopies


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(120)]
        for _ in range(r.choice([1, 3, 25])):
            t = list(base)
            for _ in range(r.choice([0, 1, 3, 12])):
                t[r.randrange(len(t))] = word()
            rows.append((len(rows), " ".join(t)))
    return rows


def test_near_copies_go_and_others_stay(spark):
    rows = corpus(3)
    kept = {r.doc_id for r in nearcopies.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    shingles = lambda t: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)}
    s = {i: shingles(t) for i, t in rows}
    near = [(i, j) for i in s for j in s if i < j and len(s[i] & s[j]) >= 0.8 * len(s[i] | s[j])]
    assert near and sum(i in kept and j in kept for i, j in near) <= 0.05 * len(near)
    gone = [i for i in s if i not in kept]
    assert all(max(len(s[i] & s[j]) / len(s[i] | s[j]) for j in s if j != i) > 0.2 for i in gone)


def test_odd_rows(odd, none):
    out = nearcopies.one_of_each(odd).collect()
    assert sorted(x.doc_id or 0 for x in out) == [0, 1, 4, 5, 6, 8, 9, 10, 11] and out[0].__fields__ == odd.columns
    assert nearcopies.one_of_each(none).count() == 0


def shingle_set(t):
    w = t.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def shingle_brute(texts):
    """The first of each component of pairs with a shingle similarity of 0.8 or more."""
    s, root = [shingle_set(t) for t in texts], list(range(len(texts)))
    for i in range(len(s)):
        for j in range(i):
            if 5 * len(s[i] & s[j]) >= 4 * len(s[i] | s[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return {i for i, r in enumerate(root) if i == r}


def test_runs_of_added_text_and_shuffled_words(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    texts = []
    for n in (80, 150, 300, 700, 1500):
        for share in (0.0, 0.05, 0.12, 0.18, 0.24, 0.3):
            base, more = [word() for _ in range(n)], [word() for _ in range(int(share * n))]
            at = r.randrange(n)
            texts += [" ".join(base), " ".join(base + more), " ".join(more + base), " ".join(base[:at] + more + base[at:]), " ".join(r.sample(base, n)), " ".join(base + base[: n // 2])]
    rows = list(enumerate(texts))
    kept = {x.doc_id for x in nearcopies.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == shingle_brute(texts)
    assert all(i + 4 in kept for i in range(0, len(texts), 6))  # the same words in another order are another text


def test_simhash_pairs_come_first_and_crowds_keep_their_links(spark, monkeypatch):
    """The named operator fetches pairs; a crowd of copies less than 0.8 alike to each other makes few pairs and loses none that is."""
    r, seen = random.Random(8), []
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    base, texts = [word() for _ in range(120)], []
    for k in range(160):
        t = list(base)
        for _ in range(4 if k % 8 else 1):
            t[r.randrange(len(t))] = word()
        texts.append(" ".join(t))
    links, stored = nearcopies.simhash.links, nearcopies.stored

    def counted(df, name):
        out = stored(df, name)
        seen.append((name, out.count()))
        return out

    monkeypatch.setattr(nearcopies.simhash, "links", lambda *a: seen.append(("links", 1)) or links(*a))
    monkeypatch.setattr(nearcopies, "stored", counted)
    rows = list(enumerate(texts))
    kept = {x.doc_id for x in nearcopies.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == shingle_brute(texts)
    names = [n for n, _ in seen]
    assert names.index("links") < names.index("near-bands") and dict(seen)["near-simhash"] > 0
    likely = [n for name, n in seen if name == "near-likely"]
    assert all(n <= len(texts) for n in likely[1:4])  # one leader for each class in a round
