import random
from collections import defaultdict
from hashlib import sha256

import pytest

from medalake.llm import digests

SCHEMA = "doc_id bigint, text string, id bigint, digest string, batch string, row bigint"


def docs(spark, rows):
    """Columns named like the operator's own must not matter."""
    return spark.createDataFrame([(*r, -1, "x", "y", -2) for r in rows], SCHEMA)


@pytest.fixture
def index(spark, tmp_path):
    made = digests.DigestIndex.open(spark, str(tmp_path), 4)
    yield made
    made.close()


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        ordered = sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)
        for n, i in enumerate(ordered):
            out.append((i, keep, len(ids), n == 0, sha256(text.encode()).hexdigest()))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


ODD = [
    (1, "a"), (2, "a"), (7, "a"), (3, "A"), (4, None), (5, ""), (6, " "), (None, "b"), (None, "b"),
    (8, "b"), (None, "only null"), (None, "only null"), (9, "twice"), (9, "twice"), (9, "other"),
    (10, "é" * 100_000), (11, "é" * 100_000), (12, "é"),
]


def test_one_batch_against_brute_force(spark, index):
    random.seed(5)
    rows = ODD + [(100 + i, random.choice("uvwxyz") * random.randint(1, 3)) for i in range(300)]
    got = digests.deduplicate(docs(spark, rows), index, "one").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)
    stored = index.read().collect()
    assert len(stored) == len({r.digest for r in stored}) == len({t or "" for _, t in rows})


def test_hot_and_cold_texts_agree(spark, index, monkeypatch):
    """A text of most rows goes by broadcast, others by their digest; both give the same."""
    monkeypatch.setattr(digests, "HOT", 3)
    rows = [(i, "hot") for i in range(400)] + [(1000 + i, f"t{i // 2}") for i in range(100)]
    got = digests.deduplicate(docs(spark, rows), index, "one").collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))


def test_later_batches_meet_the_index(spark, tmp_path):
    def entered(rows, batch):
        # Opened anew each time, as by another session.
        index = digests.DigestIndex.open(spark, str(tmp_path), 4)
        out = digests.deduplicate(docs(spark, rows), index, batch).collect()
        n = index.read().count()
        index.close()
        return sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in out), n

    first = [(1, "a"), (2, "b"), (3, "a")]
    verdicts = [(1, 3, 2, False), (2, 2, 1, True), (3, 3, 2, True)]
    assert entered(first, "monday") == (verdicts, 2)
    # The same batch again changes nothing; under another name all of it is known.
    assert entered(first, "monday") == (verdicts, 2)
    assert entered(first, "again")[0] == [(i, k, n, False) for i, k, n, _ in verdicts]
    second = [(9, "a"), (4, "c"), (5, "c")]
    assert entered(second, "tuesday") == ([(4, 5, 2, False), (5, 5, 2, True), (9, 3, 1, False)], 3)
    assert entered([], "empty") == ([], 3)


def test_a_batch_that_was_half_appended_is_completed(spark, index):
    rows = [(i, f"t{i}") for i in range(20)]
    digests.deduplicate(docs(spark, rows[:11]), index, "b").collect()
    got = digests.deduplicate(docs(spark, rows), index, "b").collect()
    assert all(r.kept and r.group_size == 1 for r in got) and len(got) == 20
    assert index.read().count() == 20


def test_the_index_is_read_in_buckets_and_merged(spark, index):
    digests.deduplicate(docs(spark, [(i, str(i)) for i in range(50)]), index, "b").collect()
    other = docs(spark, [(i, str(i)) for i in range(40, 60)])
    groups = other.select(digests.digest().alias("digest"))
    plan = index.unknown(groups)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # Only the new rows are shuffled.
    assert plan.count("Exchange") == 1
    assert index.unknown(groups).count() == 10
