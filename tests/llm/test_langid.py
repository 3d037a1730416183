from collections import Counter

import numpy as np
from kinlink.llm import langid
from pyspark.sql import functions as F

TEXT = {"en": "The cat and the dog are in the house with that other thing", "de": "Der Hund und die Katze sind nicht in dem Haus für die Straße", "fr": "Le chat et la souris sont dans la forêt élevée que vous êtes"}


def brute_grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    n = Counter()
    for w in words:
        p = f" {w} "
        n.update(w)
        n.update(p[i : i + 2] for i in range(len(p) - 1))
        n.update(p[i : i + 3] for i in range(len(p) - 2))
    return n


def test_grams_against_definition():
    is_letter = langid.letters()
    for t in ("", "a", " a b", "The theatre, naïve — Straße 12x!", "日本 語", "x" * 50, "!!"):
        _, counts = langid.grams(t, is_letter)
        assert sorted(counts.tolist()) == sorted(brute_grams(t).values())


def test_held_out_accuracy(spark):
    words = {k: v.split() for k, v in TEXT.items()}
    r = np.random.default_rng(1)
    rows = [(i, " ".join(r.choice(words[k], 25)), k) for i, k in enumerate(list(TEXT) * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    fold = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    profiles = langid.train(docs, fold)
    assert sorted(profiles) == ["de", "en", "fr"]
    out = langid.predict(docs, profiles).join(docs.filter(~fold), "doc_id").collect()
    assert len(out) > 30 and all(x.lang_pred == x.lang and 0 < x.score <= 1 for x in out)


def test_profiles_against_brute_force(spark):
    rows = [(i, t, k) for i, (k, t) in enumerate(TEXT.items())] + [(9, TEXT["en"] + " the", "en"), (10, "ignored", None), (11, None, "de")]
    profiles = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), size=5)
    want = Counter(brute_grams(TEXT["en"])) + Counter(brute_grams(TEXT["en"] + " the"))
    code = lambda g: sum((1 if c == " " else ord(c)) << 21 * i for i, c in enumerate(reversed(g)))
    assert profiles["en"] == [code(g) for g, _ in sorted(want.items(), key=lambda x: (-x[1], code(x[0])))][:5]


def test_odd_rows(odd, none):
    profiles = langid.train(odd, F.lit(True))
    out = {r.doc_id: r for r in langid.predict(odd, profiles).collect()}
    assert [out[i].lang_pred for i in (1, 2, 3, 11)] == ["und"] * 4 and out[10].lang_pred == "en"
    assert langid.train(none, F.lit(True)) == {} and langid.predict(none, {}).count() == 0
    assert {r.lang_pred for r in langid.predict(odd, {}).collect()} == {"und"}
