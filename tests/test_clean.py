import random

import pytest
from pyspark.sql import functions as F

from medalake.operators.clean import CleanSpec, clean, quality_ledger, quality_summary
from medalake.operators import dedupe as dedupe_module
from medalake.operators.dedupe import dedupe
from medalake.plans.silver import SPECS, silver_table

ROWS = [
    # id, channel, price, lead, flag
    ("a", 1, "10.5", 3, 0),
    ("a", 1, "10.5", 3, 0),       # exact duplicate
    ("b", None, "20", 0, None),   # defaults
    ("c", 2, "-5", 4, 0),         # price
    ("d", 2, "abc", 4, 0),        # price becomes null
    ("e", 2, "7", -1, 0),         # lead
    ("f", 2, "-7", -1, 0),        # price counts, lead does not
    (None, 2, "7", 1, 0),         # key
    ("g", 2, "7", None, 0),       # null lead fails the rule
    ("b", 3, "30", 9, 1),         # same key, other payload
]
SCHEMA = "id string, channel int, price string, lead int, flag int"
SPEC = CleanSpec(
    key=["id"], casts={"price": "double"}, defaults={"channel": 4, "flag": 0},
    not_null=["id", "price"], rules=[("price", "price > 0"), ("lead", "lead >= 0")],
    order_by=["price"],
)


@pytest.fixture
def bronze(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_clean(bronze):
    out = sorted(tuple(r) for r in clean(bronze, SPEC).collect())
    assert out == [("a", 1, 10.5, 3, 0), ("b", 4, 20.0, 0, 0)]


def test_ledger_counts_each_row_once(bronze):
    ledger = {r.concepto: r.filas for r in quality_ledger(bronze, SPEC).collect()}
    assert ledger == {
        "bronze": 10, "default:channel": 1, "default:flag": 1, "not_null": 2, "price": 2,
        "lead": 2, "duplicates": 2, "silver": 2,
    }
    removed = ("not_null", "price", "lead", "duplicates")
    assert ledger["bronze"] - sum(ledger[k] for k in removed) == ledger["silver"]


def test_ledger_of_nothing(spark):
    ledger = quality_ledger(spark.createDataFrame([], SCHEMA), SPEC).collect()
    assert [r.filas for r in ledger] == [0] * 8


def test_ledger_matches_step_by_step(spark, sf_dir):
    """Against the rules applied one after the other."""
    rng = random.Random(7)
    rows = [
        (rng.choice([None, "k%d" % rng.randrange(40)]), rng.choice([None, 1, 2]),
         rng.choice(["1", "-1", "x", "3.5"]), rng.choice([None, -1, 0, 5]), rng.choice([None, 1]))
        for _ in range(500)
    ]
    left, counts = list(rows), {}

    def drop(name, keep):
        nonlocal left
        kept = [r for r in left if keep(r)]
        counts[name] = len(left) - len(kept)
        left = kept

    drop("not_null", lambda r: r[0] is not None and r[2] != "x")
    drop("price", lambda r: float(r[2]) > 0)
    drop("lead", lambda r: r[3] is not None and r[3] >= 0)
    counts["silver"] = len({r[0] for r in left})
    counts["duplicates"] = len(left) - counts["silver"]
    ledger = quality_ledger(spark.createDataFrame(rows, SCHEMA).repartition(7), SPEC).collect()
    assert {r.concepto: r.filas for r in ledger if r.concepto in counts} == counts


def test_summary(bronze):
    row = quality_summary(bronze, clean(bronze, SPEC), "price").first()
    assert tuple(row) == (10, 2, 8, 20.0, 30.5)


def test_strict_mode_raises(bronze):
    strict = CleanSpec(key=["id"], casts={"price": "double"}, on_error="fail")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean(bronze, strict).collect()


def test_text_then_cast_then_default(spark):
    spec = CleanSpec(
        key=["k"], text={"n": "strip"}, casts={"n": "int", "d": "date"},
        defaults={"n": 9, "t": "?"},
    )
    df = spark.createDataFrame(
        [(1, "\t7\n", "2024-01-02", None), (2, "x", "no", "a")], "k int, n string, d string, t string"
    )
    out = {r.k: (r.n, str(r.d), r.t) for r in clean(df, spec).collect()}
    assert out == {1: (7, "2024-01-02", "?"), 2: (9, "None", "a")}


def test_dedupe_ignores_layout(spark, shuffle_partitions):
    rng = random.Random(3)
    # One key holds a third of the rows; ties on the order column are common.
    rows = [
        (0 if i % 3 == 0 else rng.randrange(50), rng.randrange(4), rng.randrange(1000))
        for i in range(3000)
    ]
    want = {}
    for k, o, v in rows:
        want[k] = min(want.get(k, (o, v)), (o, v))
    for n in (1, 4, 64):
        shuffle_partitions(n)
        df = spark.createDataFrame(rows, "k int, o int, v int").repartition(n)
        got = {r.k: (r.o, r.v) for r in dedupe(df, ["k"], ["o"]).collect()}
        assert got == want


def test_dedupe_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = dedupe(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan[plan.index("Exchange"):]


def test_dedupe_treats_nulls_as_one_key(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (1, 5)], "k int, v int")
    assert {(r.k, r.v) for r in dedupe(df, ["k"], ["v"]).collect()} == {(None, 1), (1, 5)}


def test_booking_spec_defaults_channel(spark):
    row = ("R1", "P1", "V1", float("nan"), "2024-01-01 10:00:00", "2024-02-01 00:00:00", 31, 10.0,
           2, None, None, " confirmada ")
    schema = (
        "reserva_id string, pasajero_id string, vuelo_id string, canal_id double, "
        "fecha_reserva string, fecha_vuelo_pretendida string, dias_anticipacion long, "
        "precio_pagado double, asientos_reservados long, descuento_aplicado double, "
        "es_cancelada long, estado string"
    )
    out = silver_table("reservas", spark.createDataFrame([row], schema)).first()
    assert (out.canal_id, out.descuento_aplicado, out.es_cancelada) == (4, 0.0, 0)
    assert out.estado == "CONFIRMADA" and out.fecha_reserva.hour == 10


def test_specs_cover_six_tables():
    assert set(SPECS) == {"rutas", "canales", "vuelos", "pasajeros", "reservas", "pagos"}


def test_stored_rows_are_deduplicated_alike_without_shuffling_single_keys(spark, monkeypatch):
    rows = [(i % 70 if i % 9 else None, i % 5, f"v{i}") for i in range(140)] + [(500, 1, "x")] * 2
    df = spark.createDataFrame(rows, "k int, t int, v string").repartition(3)
    want = sorted(map(str, dedupe_module.dedupe(df, ["k"], ["t"]).collect()))
    assert sorted(map(str, dedupe_module.dedupe_stored(df, ["k"], ["t"]).collect())) == want
    # Beyond the bound of a broadcast too.
    monkeypatch.setattr(dedupe_module, "BROADCAST_KEYS", 0)
    assert sorted(map(str, dedupe_module.dedupe_stored(df, ["k"], ["t"]).collect())) == want
    single = spark.range(50).selectExpr("id AS k", "id % 3 AS t")
    found = dedupe_module.dedupe_stored(single, ["k"], ["t"])
    assert found.count() == 50
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_more_repeated_keys_than_can_be_broadcast_cost_one_shuffle(spark, monkeypatch):
    monkeypatch.setattr(dedupe_module, "BROADCAST_KEYS", 3)
    df = spark.range(40).selectExpr("id % 10 AS k", "id AS t")
    found = dedupe_module.dedupe_stored(df, ["k"], ["t"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Broadcast" not in plan
    assert rows_in(found) == [(k, k) for k in range(10)]


def rows_in(df):
    return sorted(map(tuple, df.collect()))
