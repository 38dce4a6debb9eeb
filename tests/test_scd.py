import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from medalake.operators.scd import (
    pit_join, scd2_apply, scd2_build, scd2_from_base, scd2_stats, single_version,
)
from medalake.operators.keys import surrogate_key
from medalake.operators.star import lookup

OPEN = date(9999, 12, 31)
LOG = "id int, at timestamp_ntz, seq int, state string"


def ts(day, hour=0):
    return datetime(2024, 1, day, hour)


def versions(df):
    rows = [(r.id, r.state, r.valido_desde, r.valido_hasta, r.activo) for r in df.collect()]
    return sorted(rows, key=lambda r: (r[0], r[2]))


def build(df):
    return scd2_build(df, "id", ["state"], "at", order_by=["at", "seq"])


def test_build(spark):
    log = spark.createDataFrame(
        [
            (1, ts(1), 0, "n"),                       # no change
            (2, ts(1), 0, "n"), (2, ts(5), 1, "o"),   # one change
            (3, ts(1), 0, "n"), (3, ts(2), 1, "o"), (3, ts(9), 2, "f"),
            (4, ts(1, 8), 0, "n"), (4, ts(1, 9), 1, "o"),   # same day: last wins
            (5, ts(1), 0, "n"), (5, ts(4), 1, "n"), (5, ts(6), 2, "o"),  # no-op
            (6, ts(1), 0, None), (6, ts(2), 1, "o"),  # null is a state
        ],
        LOG,
    )
    d = lambda n: date(2024, 1, n)
    assert versions(build(log)) == [
        (1, "n", d(1), OPEN, True),
        (2, "n", d(1), d(4), False), (2, "o", d(5), OPEN, True),
        (3, "n", d(1), d(1), False), (3, "o", d(2), d(8), False), (3, "f", d(9), OPEN, True),
        (4, "o", d(1), OPEN, True),
        (5, "n", d(1), d(5), False), (5, "o", d(6), OPEN, True),
        (6, None, d(1), d(1), False), (6, "o", d(2), OPEN, True),
    ]


def random_log(n_ids=20, n=600, seed=5, hot=True):
    rng = random.Random(seed)
    return [
        (0 if hot and i % 3 == 0 else rng.randrange(n_ids),
         datetime(2024, 1, 1) + timedelta(hours=rng.randrange(24 * 120)), i, rng.choice("abc"))
        for i in range(n)
    ]


def test_versions_are_disjoint_and_gap_free(spark):
    chains = {}
    for i, state, start, end, current in versions(build(spark.createDataFrame(random_log(), LOG))):
        chains.setdefault(i, []).append((start, end, current, state))
    for chain in chains.values():
        chain.sort()
        assert [c[2] for c in chain] == [False] * (len(chain) - 1) + [True]
        for before, after in zip(chain, chain[1:]):
            assert before[1] + timedelta(days=1) == after[0] and before[3] != after[3]


@pytest.mark.parametrize("cuts", [[40], [10, 60, 90], [1, 2, 3]])
def test_apply_in_batches_equals_one_build(spark, cuts):
    rows = random_log(seed=len(cuts))
    start = datetime(2024, 1, 1)
    edges = [start, *[start + timedelta(days=c) for c in cuts], datetime(2030, 1, 1)]
    dim = None
    for lo, hi in zip(edges, edges[1:]):
        batch = spark.createDataFrame([r for r in rows if lo <= r[1] < hi], LOG)
        dim = build(batch) if dim is None else scd2_apply(
            dim, batch, "id", ["state"], "at", order_by=["at", "seq"]
        )
    assert versions(dim) == versions(build(spark.createDataFrame(rows, LOG)))


def test_apply_splits_a_day(spark):
    rows = [(1, ts(1), 0, "n"), (1, ts(5, 8), 1, "o"), (1, ts(5, 9), 2, "n"), (1, ts(7), 3, "f")]
    dim = build(spark.createDataFrame(rows[:2], LOG))
    for row in rows[2:]:
        dim = scd2_apply(
            dim, spark.createDataFrame([row], LOG), "id", ["state"], "at", order_by=["at", "seq"]
        )
    assert versions(dim) == versions(build(spark.createDataFrame(rows, LOG)))


def test_apply_keeps_issued_keys(spark):
    first = spark.createDataFrame([(1, ts(1), 0, "n"), (2, ts(1), 0, "n"), (3, ts(1), 0, "n")], LOG)
    dim = surrogate_key(build(first), "sk", ["id", "valido_desde"])
    batch = spark.createDataFrame(
        [(2, ts(5), 0, "o"), (3, ts(1, 5), 0, "f"), (4, ts(6), 0, "n"), (1, ts(9), 0, "n")], LOG
    )
    out = scd2_apply(
        dim, batch, "id", ["state"], "at", order_by=["at", "seq"], sk="sk"
    ).collect()
    got = {(r.id, r.state): (r.sk, r.activo) for r in out}
    assert got == {
        (1, "n"): (1, True), (2, "n"): (2, False), (2, "o"): (4, True),
        (3, "f"): (3, True), (4, "n"): (5, True),
    }


def test_base_and_changes(spark):
    base = spark.createDataFrame(
        [("P1", "nuevo", "CO"), ("P2", "ocasional", "US"), ("P3", "raro", "MX"), ("P4", None, "CO")],
        "id string, state string, pais string",
    )
    changes = spark.createDataFrame(
        [("P1", date(2024, 5, 1)), ("P3", date(2024, 6, 1)), ("P9", date(2024, 6, 1))],
        "id string, fecha_cambio date",
    )
    promotion = {"nuevo": "ocasional", "ocasional": "frecuente"}
    out = scd2_from_base(
        base, changes, "id", "state", "fecha_cambio", promotion=promotion, fallback="frecuente"
    )
    epoch = date(2020, 1, 1)
    assert versions(out) == [
        ("P1", "nuevo", epoch, date(2024, 4, 30), False),
        ("P1", "ocasional", date(2024, 5, 1), OPEN, True),
        ("P2", "ocasional", epoch, OPEN, True),
        ("P3", "raro", epoch, date(2024, 5, 31), False),
        ("P3", "frecuente", date(2024, 6, 1), OPEN, True),
        ("P4", None, epoch, OPEN, True),
    ]
    assert {r.pais for r in out.where("id = 'P1'").collect()} == {"CO"}
    stats = scd2_stats(out, "id").first()
    assert tuple(stats) == (4, 6, 2)  # versions = ids + changes
    assert versions(single_version(base)) == sorted(
        [(i, s, epoch, OPEN, True) for i, s, _ in base.collect()], key=lambda r: r[0]
    )


FACTS = "fid int, id int, at timestamp_ntz"


def test_point_in_time_edges(spark):
    dim = build(spark.createDataFrame([(1, ts(3), 0, "n"), (1, ts(10), 1, "o")], LOG))
    facts = spark.createDataFrame(
        [
            (0, 1, ts(2, 23)),   # before the first version
            (1, 1, ts(3)),       # first midnight
            (2, 1, ts(9)),       # midnight of the last valid day
            (3, 1, ts(9, 10)),   # 10:00 of the last valid day
            (4, 1, ts(10)),      # day of change
            (5, 1, datetime(2090, 1, 1, 5)),
            (6, 2, ts(5)),       # unknown id
            (7, None, ts(5)),
            (8, 1, None),
        ],
        FACTS,
    )

    def run(**options):
        out = pit_join(facts, dim, "id", "at", ["state"], **options)
        return {r.fid: r.state for r in out.collect()}

    by_day = {0: None, 1: "n", 2: "n", 3: "n", 4: "o", 5: "o", 6: None, 7: None, 8: None}
    assert run() == by_day
    assert run(end="closed_ts") == {**by_day, 3: None}
    assert run(how="inner") == {k: v for k, v in by_day.items() if v}
    with pytest.raises(ValueError):
        run(end="open")


@pytest.mark.parametrize("end", ["date", "closed_ts"])
def test_point_in_time_against_brute_force(spark, end):
    dim = build(spark.createDataFrame(random_log(n_ids=6, n=900), LOG))
    rng = random.Random(1)
    facts = [
        (i, 0 if i % 3 == 0 else rng.randrange(8),
         datetime(2023, 12, 1) + timedelta(minutes=rng.randrange(60 * 24 * 200)))
        for i in range(1500)
    ]
    chains = versions(dim)
    want = {}
    for fid, i, at in facts:
        hits = [
            v[1] for v in chains
            if v[0] == i and v[2] <= at.date()
            and (at.date() <= v[3] if end == "date" else at <= datetime(*v[3].timetuple()[:3]))
        ]
        assert len(hits) <= 1
        want[fid] = hits[0] if hits else None
    df = spark.createDataFrame(facts, FACTS).repartition(5)
    got = {r.fid: r.state for r in pit_join(df, dim, "id", "at", ["state"], end=end).collect()}
    assert got == want


@pytest.fixture
def small_partitions_are_skewed(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("kind", ["point in time", "lookup"])
def test_hot_id_is_split(spark, small_partitions_are_skewed, kind):
    """With a third of the facts on one id, the adaptive join splits that id's partition."""
    n = 120_000
    facts = spark.range(n, numPartitions=16).select(
        F.col("id").cast("int").alias("fid"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).cast("int").alias("id"),
        F.lit("2024-01-20").cast("timestamp_ntz").alias("at"),
    )
    ids = spark.range(1000).select(F.col("id").cast("int"))
    if kind == "lookup":
        out = lookup(facts, ids.withColumn("sk", F.col("id") + 1), "id", ["sk"])
    else:
        log = ids.select(
            "id", F.lit("2024-01-01").cast("timestamp_ntz").alias("at"),
            F.lit(0).alias("seq"), F.lit("n").alias("state"),
        )
        out = pit_join(facts, build(log), "id", "at", ["state"])
    rows = out.collect()
    assert len(rows) == n and all(r[-1] is not None for r in rows)
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_several_changes_promote_step_by_step(spark):
    """Two changes of one id, in any order, one of them before the epoch; no gap, no overlap."""
    base = spark.createDataFrame([("a", "nuevo"), ("b", "nuevo"), ("c", "x")], "id string, s string")
    changes = spark.createDataFrame(
        [("a", date(2021, 5, 1)), ("a", date(2019, 6, 1)), ("b", date(2022, 1, 1))],
        "id string, at date",
    )
    rows = scd2_from_base(
        base, changes, "id", "s", "at", date(2020, 1, 1),
        promotion={"nuevo": "ocasional", "ocasional": "frecuente"}, fallback="frecuente",
    ).orderBy("id", "valido_desde").collect()
    assert [(r.id, r.s, r.valido_desde) for r in rows] == [
        ("a", "nuevo", date(2019, 5, 31)), ("a", "ocasional", date(2019, 6, 1)),
        ("a", "frecuente", date(2021, 5, 1)), ("b", "nuevo", date(2020, 1, 1)),
        ("b", "ocasional", date(2022, 1, 1)), ("c", "x", date(2020, 1, 1)),
    ]
    for one, following in zip(rows, rows[1:]):
        if one.id == following.id:
            assert (following.valido_desde - one.valido_hasta).days == 1


def test_late_rows_need_the_history(spark):
    schema = "id int, s string, at date"
    old = spark.createDataFrame(
        [(1, "A", date(2024, 1, 1)), (1, "A", date(2024, 1, 9)), (2, "A", date(2024, 1, 1))], schema
    )
    late = spark.createDataFrame([(1, "B", date(2024, 1, 5))], schema)
    dim = scd2_build(old, "id", ["s"], "at")
    got = scd2_apply(dim, late, "id", ["s"], "at", history=old)
    want = scd2_build(old.union(late), "id", ["s"], "at")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    early = spark.createDataFrame([(1, "B", date(2023, 1, 5))], schema)
    with pytest.raises(Exception, match="needs the history"):
        scd2_apply(dim, early, "id", ["s"], "at").collect()
