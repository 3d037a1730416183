import numpy as np
from kinlink.llm import lines


def brute(rows, least):
    from collections import Counter

    key = lambda x: x.strip(" \t\n\x0b\x0c\r").encode().lower().decode()
    n = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    return sorted((i, "\n".join(x for x in (t or "").split("\n") if n[key(x)] < least), sum(n[key(x)] >= least for x in (t or "").split("\n"))) for i, t in rows)


def got(df):
    return sorted((r.doc_id, r.kept, r.n_dropped) for r in df.collect())


def test_filter_inserts_deletes_and_has_no_false_negative():
    keys = np.random.default_rng(1).integers(0, 256, (5000, 16), dtype=np.uint8)
    f = lines.CuckooFilter.build(keys)
    assert f.contains(keys).all()
    i, fp = f.places(keys)
    assert all(f.delete(i[k], fp[k]) for k in range(2500))
    assert f.contains(keys[2500:]).all() and f.contains(keys[:2500]).mean() < 0.02
    assert lines.CuckooFilter.from_bytes(f.to_bytes()).contains(keys[2500:]).all()


ROWS = [(i, f"Menu\n  text {i}\n\nFOOTER {i % 3}\t") for i in range(9)] + [(9, None), (10, "menu \nown")]


def test_against_brute_force(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    for least in (1, 3, 10):
        assert got(lines.dedup_lines(df, least)) == brute(ROWS, least)


def test_index_is_reversible(spark):
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    probe = frame(ROWS)
    half = lines.LineIndex.build(frame(ROWS[:5]), 4)
    full = half.insert(frame(ROWS[5:]))
    assert got(lines.filter_documents(probe, full)) == got(lines.filter_documents(probe, lines.LineIndex.build(probe, 4)))
    back = full.delete(frame(ROWS[5:]))
    assert sorted(map(tuple, back.refs.collect())) == sorted(map(tuple, half.refs.collect()))
    assert got(lines.filter_documents(probe, back)) == got(lines.filter_documents(probe, half))


def test_odd_rows(odd, none):
    out = {r.doc_id: r for r in lines.dedup_lines(odd, 2).collect()}
    assert (out[1].n_lines, out[1].n_dropped, out[1].kept) == (1, 0, "")
    assert out[6].n_dropped == 1 and out[6].kept == "" and out[None].kept == "null id here"
    assert lines.filter_documents(odd, lines.LineIndex.build(odd, 2)).columns[:8] == odd.columns
    assert lines.dedup_lines(none).count() == 0
