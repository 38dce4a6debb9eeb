"""The pipeline on the smallest tables, each stage against a plain version of its rule."""

import pytest

import corpus_pipeline
from medalake.llm import toxicity
from medalake.llm.common import table
from medalake.session import stage
from test_divergence import figures
from test_overlap import shingles
from test_suffixes import brute


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs, out = table(spark, sf_dir, "documents"), []
    for name, function in corpus_pipeline.STAGES:
        result = stage(function(spark, docs, sf_dir))
        out.append((name, docs, result))
        docs = result
    return {name: (before, after) for name, before, after in out}


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_in_order_keep_the_columns(steps):
    assert list(steps) == [
        "quality_rules", "toxicity", "near_duplicates", "decontamination", "packing",
    ]
    for name, (before, after) in list(steps.items())[:-1]:
        assert after.columns == before.columns and 0 < after.count() < before.count(), name


def test_rules_drop_what_fails_them(steps):
    before, after = map(rows, steps["quality_rules"])
    for id_, text in before.items():
        n, _, _, _, repeated = figures(text)
        if n < 50 or 100 * repeated > 50 * n:
            assert id_ not in after


def test_toxic_documents_go(spark, sf_dir, steps):
    before, after = steps["toxicity"]
    scorer = toxicity.fit(before, table(spark, sf_dir, "labels"))
    scores = {r.doc_id: r.score for r in toxicity.score(before, scorer).collect()}
    assert set(rows(after)) == {i for i, s in scores.items() if s < toxicity.THRESHOLD}


def test_one_of_each_group_stays(steps):
    before, after = map(rows, steps["near_duplicates"])
    sets = {i: shingles(t) for i, t in before.items()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    assert set(after) == {root(i) for i in sets}


def test_benchmark_passages_go(spark, sf_dir, steps):
    before, after = map(rows, steps["decontamination"])
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    for id_, text in before.items():
        n, hit, _ = brute(text, items)
        assert (id_ in after) == (not (hit and 20 * hit >= n))


def test_every_kept_document_is_packed_whole(steps):
    before, after = steps["packing"]
    placed = after.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r.doc_id for r in placed} == set(rows(before))
    assert all(r["sum(length)"] == r["max(doc_tokens)"] for r in placed)


def through(spark, docs, sf_dir):
    """All stages over a table of one's own; the labels and items are the given ones."""
    for _, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _dirty_text bigint, _other_id bigint, score string"


def test_empty_table(spark, sf_dir):
    empty = spark.createDataFrame([], SCHEMA)
    assert through(spark, empty, sf_dir).count() == 0


def test_odd_rows_and_clashing_columns(spark, sf_dir, steps):
    """Nulls in every column, a very long text, repeated rows and columns with names of helpers."""
    before, after = steps["packing"]
    clean = [tuple(r) for r in before.limit(40).collect()]
    long_text = " ".join(f"{t[1]}" for t in clean) * 8
    odd = [
        (None, None, None, None, None), (10**9, None, "en", "s", 0), (10**9 + 1, "", None, None, None),
        (10**9 + 2, long_text, "en", None, 5), (None, clean[0][1], "en", None, None),
    ]
    rows = [(*r, 1, 2, "x") for r in clean + odd + clean[:3]]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = stage(function(spark, out, sf_dir))
        assert out.columns == docs.columns, name
    kept = {r.doc_id for r in out.collect()}
    assert not kept & {10**9, 10**9 + 1} and kept <= {r[0] for r in rows}
    packed = corpus_pipeline.STAGES[-1][1](spark, out, sf_dir)
    assert {r.doc_id for r in packed.collect()} == kept
