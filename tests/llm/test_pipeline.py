"""The pipeline's stages, one after another, against plain Python over the same rows."""

import corpus_pipeline
import pytest
from kinlink.llm import decontam, quality
from kinlink.llm.common import stored, table

from tests.llm.test_lines import brute as lines_brute
from tests.llm.test_nearcopies import shingle_brute
from tests.llm.test_packing import check as packing_check
from tests.llm.test_quality import brute as quality_brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def states(spark):
    docs, out = table(spark, SF, "documents"), []
    out.append(docs.collect())
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "state")
        out.append(docs.collect())
    return out


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_quality(spark, states):
    def good(t):
        n, _, _, _, repeat = quality_brute(t)
        return n >= 10 and 100 * repeat <= 20 * n

    counts = quality.measures(table(spark, SF, "documents"))
    assert quality.calibrate(counts, table(spark, SF, "labels")).count() == 0  # too few labels here for any level
    assert texts(states[1]) == {i: t for i, t in texts(states[0]).items() if good(t)}
    assert states[1][0].__fields__ == states[0][0].__fields__


def test_line_dedup(states):
    assert texts(states[2]) == {i: t for i, t, _ in lines_brute(list(texts(states[1]).items()), 10)}
    assert all(r.n_chars == len(r.text) for r in states[2])


def test_near_dedup(states):
    rows = sorted(texts(states[2]).items())
    kept = shingle_brute([t for _, t in rows])
    assert texts(states[3]) == {rows[k][0]: rows[k][1] for k in kept}
    assert len(states[3]) < len(states[2])


def test_decontamination(spark, states):
    items = [decontam.tokens(r.text) for r in table(spark, SF, "benchmark").collect()]

    def leaks(t):
        w = decontam.tokens(t)
        grams = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        for item in items:
            cover = {p for i in range(len(item) - 4) if tuple(item[i : i + 5]) in grams for p in range(i, i + 5)}
            if item and len(cover) >= 0.8 * len(item):
                return True
        return False

    assert texts(states[4]) == {i: t for i, t in texts(states[3]).items() if not leaks(t)}


def test_packing(states):
    assert packing_check(states[5], sorted(texts(states[4]).items()), 1024) > 0.97


def test_stages_on_odd_and_empty_tables(odd, none, spark):
    """Every stage by itself; a leaking row with a null id goes, and a clean row that shares a leaking row's id stays."""
    stages = dict(corpus_pipeline.STAGES)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns and out.count() <= 12
        assert stage(spark, none, SF).count() == 0, name
    assert {r.doc_id for r in stages["quality rules"](spark, odd, SF).collect()} == {8}
    assert stages["line dedup"](spark, odd, SF).count() == 12
    assert sum(r.start == 0 for r in stages["packing"](spark, odd, SF).collect()) == 12 and stages["packing"](spark, none, SF).count() == 0
    leak = table(spark, SF, "benchmark").filter("length(text) > 100").first().text
    rows = spark.createDataFrame([(None, leak), (5, leak), (5, "nothing of it here"), (None, "nor here"), (6, None)], "doc_id long, text string")
    kept = stages["benchmark decontamination"](spark, rows, SF).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, "nor here"), (5, "nothing of it here"), (6, "")]
