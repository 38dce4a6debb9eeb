import math
import random

import numpy as np
import pytest

from medalake.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, id bigint, v int, dim int, part int"


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, -1, -2, -3, -4) for r in rows], SCHEMA).repartition(3)


def brute(rows, every=10, k=5, m=5):
    by_id = {}
    for i, v, label in rows:
        if None in (i, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        by_id[i] = min(by_id.get(i, (label, q)), (label, q))
    out = []
    for a, (own, q) in by_id.items():
        if a % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(q, p)), i, label) for i, (label, p) in by_id.items() if i != a
        )
        for ps, positive, _ in [s for s in scored if s[2] == own][:k]:
            hard = [s for s in scored if s[2] != own and -80 * ps <= -100 * s[0] <= -100 * ps][:m]
            out += [(a, positive, r, i, -ps, -s) for r, (s, i, _) in enumerate(hard, start=1)]
    return sorted(out)


def found(df, **kw):
    return sorted(map(tuple, negatives.hard_negatives(df, every=10, **kw).collect()))


def vectors(n, dim, seed, spread=0.4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim))
    out = []
    for i in range(n):
        label = int(rng.integers(0, 4))
        near = centres[int(rng.integers(0, 4))] if i % 3 else centres[label]
        v = near + spread * rng.normal(size=dim)
        out.append((i, [float(x) for x in (v / np.linalg.norm(v)).astype(np.float32)], label))
    return out


def test_against_brute_force(spark, monkeypatch):
    rows = vectors(400, 8, 1)
    want = brute(rows)
    assert len(want) > 300
    assert found(frame_of(spark, rows)) == want
    # Neither the blocks nor the waves they come in matter.
    monkeypatch.setattr(negatives, "BLOCK_COMPONENTS", 8 * 50)
    monkeypatch.setattr(negatives, "ANCHOR_COMPONENTS", 8 * 7)
    monkeypatch.setattr(negatives, "WAVE", 2)
    assert found(frame_of(spark, rows)) == want


def test_ties_and_one_very_common_vector(spark):
    rng = random.Random(3)
    same = [0.5, -0.25, 0.125]
    rows = [(i, same, i % 3) for i in range(150)]
    rows += [(150 + i, [rng.choice([-0.5, 0.0, 0.5]) for _ in range(3)], i % 3) for i in range(150)]
    assert found(frame_of(spark, rows)) == brute(rows)


def test_rows_that_take_no_part(spark):
    rows = vectors(120, 4, 7)
    odd = [
        (200, None, 1), (201, [1.0, None, 0.0, 0.0], 1), (202, [float("nan")] * 4, 1),
        (203, [float("inf"), 0.0, 0.0, 0.0], 1), (204, [9.0] * 4, None), (None, [9.0] * 4, 1),
        (210, [], 1), (220, [0.0] * 4, 2), (230, [0.3, 0.1], 3), (240, [0.9] * 7, 0),
        rows[10], rows[10], (30, [0.1, 0.2, 0.3, 0.4], 3), (-40, [0.2, 0.1, 0.0, -0.5], 1),
    ]
    assert found(frame_of(spark, rows + odd)) == brute(rows + odd)


def test_fewer_rows_than_asked_for(spark):
    assert found(frame_of(spark, [])) == []
    assert found(frame_of(spark, vectors(1, 4, 2))) == []
    rows = vectors(12, 4, 5, spread=0.05)
    assert found(frame_of(spark, rows)) == brute(rows)
    # No anchors among the ids.
    assert found(frame_of(spark, [(i * 10 + 1, v, k) for i, v, k in rows])) == []


def test_walk_stops_early_and_misses_nothing():
    rng = np.random.default_rng(11)
    n, dim = 5000, 3
    v = rng.integers(-200, 200, (n, dim))
    ids = rng.permutation(n)
    block = negatives.Block(ids, np.zeros(n, np.int64), v, np.argsort(v, axis=0, kind="stable").T)
    met = []
    for _ in range(30):
        a = rng.integers(-200, 200, dim)
        scores = v @ a
        order = np.lexsort((ids, -scores))[:5]
        got, best = negatives.nearest(block, -1, a, 5)
        assert got.tolist() == ids[order].tolist() and best.tolist() == scores[order].tolist()
        rows, _ = block.walk(a, lambda r, s, t: t < negatives._kth(s, 5) if len(s) > 4 else False)
        met.append(len(rows))
    assert sum(met) < 0.5 * n * len(met)


def test_large_components_stay_exact():
    v = np.array([[1 << 28, 3], [1 << 28, 4]])
    a = np.array([1 << 30, 1])
    assert negatives._products(v, a).tolist() == [(1 << 58) + 3, (1 << 58) + 4]
    with pytest.raises(OverflowError):
        negatives._products(np.array([[1 << 40]]), np.array([1 << 40]))


def brute_rows(rows, every=10, k=5, m=5):
    """Every row for itself, whatever its id."""
    q = [[math.floor(256 * float(np.float32(x))) for x in v] for _, v, _ in rows]
    out = []
    for a, (anchor, _, own) in enumerate(rows):
        if anchor % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(q[a], q[b])), i, label)
            for b, (i, _, label) in enumerate(rows) if b != a
        )
        for ps, positive, _ in [s for s in scored if s[2] == own][:k]:
            hard = [s for s in scored if s[2] != own and -80 * ps <= -100 * s[0] <= -100 * ps][:m]
            out += [(anchor, positive, r, i, -ps, -s) for r, (s, i, _) in enumerate(hard, start=1)]
    return sorted(out)


def test_rows_that_repeat_an_id_each_take_part(spark):
    rows = vectors(200, 6, 9)
    # Copies of anchors, positives and negatives, and other vectors and labels under an id in use.
    rows += rows[::9] + rows[50:60] + [(i + 3, v, (k + 1) % 4) for i, v, k in rows[:40]]
    want = brute_rows(rows)
    assert found(frame_of(spark, rows), repeats=True) == want
    assert len(want) > len(brute(rows))


def test_query_counts_copies_as_rows(spark, tmp_path):
    rows = vectors(300, 6, 13)
    rows += rows[18::37] + [rows[100]]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(
        f"{tmp_path}/embeddings.parquet"
    )
    moved = [(i, v, (k + 1) % 10 if i % 7 == 0 else k) for i, v, k in rows]
    got = negatives.op11_threshold_negatives(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == brute_rows(moved, every=100)
