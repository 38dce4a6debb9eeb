import random
from collections import Counter

import numpy as np
import pytest

from medalake.llm import resampling
from medalake.llm.shingles import ngram_hashes

DOCS, LABELS = "doc_id bigint, text string", "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def data():
    rng = random.Random(2)
    good = ["alpha", "beta", "gamma", "delta"]
    bad = ["zz", "yy", "xx", "ww"]
    docs = [(i, " ".join(rng.choices(good if i % 3 else bad, k=30))) for i in range(300)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(0, 300, 2)] + [(None, 1, 0), (1, None, 0)]
    return docs + [(None, None), (400, ""), (7, "dup"), (7, "dup")], labels


def test_ratios_against_counts(spark, frame, data):
    docs, labels = data
    got = resampling.log_ratios(frame(docs, DOCS), frame(labels, LABELS))
    good = {i for i, q, _ in labels if q == 1}
    raw, target = np.zeros(resampling.SLOTS), np.zeros(resampling.SLOTS)
    for i, text in docs:
        for slots in resampling._slots([(text or "").encode()]):
            n = np.bincount(slots, minlength=resampling.SLOTS)
            raw += n
            target += n * (i in good)
    share = lambda n: (n + 1) / (n.sum() + resampling.SLOTS)
    assert np.allclose(got, np.log(share(target)) - np.log(share(raw)))


def test_ngrams_with_repeats():
    one, two = (ngram_hashes([b"A b a B", None, b"x"], n) for n in (1, 2))
    assert Counter(Counter(one[0].tolist()).values()) == {2: 2}
    assert Counter(Counter(two[0].tolist()).values()) == {2: 1, 1: 1}
    assert len(one[1]) == 0 and len(one[2]) == len(two[2]) == 1


def test_sample_prefers_good_text(frame, data):
    docs, labels = data
    got = resampling.resample(frame(docs, DOCS), frame(labels, LABELS), share=0.6).collect()
    assert len(got) == len(docs) and sum(r.selected for r in got) == -(-len(docs) * 6 // 10)
    rate = lambda keep: np.mean([r.selected for r in got if r.doc_id and r.doc_id < 300 and keep(r.doc_id)])  # noqa: E731,E501
    assert rate(lambda i: i % 3 > 0) > 0.8 > 0.2 > rate(lambda i: i % 3 == 0)


def test_gumbel_noise_samples_in_proportion(spark):
    """Equal weights: any row is as likely; noise depends on id and text alone."""
    df = spark.range(4000).selectExpr("id AS doc_id", "cast(id % 2 AS string) AS text")
    none = spark.createDataFrame([], LABELS)
    first, again = (resampling.resample(df, none, share=0.25).collect() for _ in range(2))
    assert sum(r.selected for r in first) == 1000
    assert {r.doc_id for r in first if r.selected} == {r.doc_id for r in again if r.selected}
    assert 400 < sum(r.selected and r.doc_id % 2 for r in first) < 600


@pytest.mark.parametrize("k", [1, 5, 60, 100])
def test_largest_against_sorting(spark, k):
    values = [((i * 7919) % 53 - 20) * (1 << 56) for i in range(100)]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    edge, ties = resampling.largest(df, "v", k)
    assert edge == sorted(values)[-k]
    assert sum(v > edge for v in values) + ties == k


def test_empty_table(frame):
    assert resampling.resample(frame([], DOCS), frame([], LABELS)).count() == 0
