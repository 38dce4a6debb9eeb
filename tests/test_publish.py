"""Versions published behind views, and the serving document."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import bookings
from medalake.plans import run
from medalake.sources import layers, publish


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE publicada")
    yield "publicada"
    spark.sql("DROP DATABASE publicada CASCADE")


def tables(spark, n, rows=3):
    fact = spark.range(rows).select("id", F.lit(n).alias("n"))
    return {"fact": fact, "dim": spark.createDataFrame([(n, f"v{n}")], "n int, name string")}


def shown(spark, database):
    return {
        t: {r.n for r in spark.table(f"{database}.{t}").collect()} for t in ("fact", "dim")
    }


def test_views_switch_together(spark, database):
    counts = publish.publish_tables(spark, tables(spark, 1), database, "v1")
    assert {r.tabla: r.filas for r in counts.collect()} == {"fact": 3, "dim": 1}
    assert shown(spark, database) == {"fact": {1}, "dim": {1}}
    assert spark.table(f"{database}.dim").columns == ["n", "name"]
    spark.sql(f"CREATE VIEW {database}.wide AS SELECT id, name FROM {database}.fact f "
              f"JOIN {database}.dim d ON f.n = d.n")
    publish.publish_tables(spark, tables(spark, 2, rows=5), database, "v2")
    assert shown(spark, database) == {"fact": {2}, "dim": {2}}
    assert {(r.id, r.name) for r in spark.table(f"{database}.wide").collect()} == {
        (i, "v2") for i in range(5)}
    # Another order of columns does not matter; an older name comes after a newer one if it is later.
    last = {k: df.select(*reversed(df.columns)) for k, df in tables(spark, 3).items()}
    publish.publish_tables(spark, last, database, "a")
    assert shown(spark, database) == {"fact": {3}, "dim": {3}}
    assert publish.published_versions(spark, database) == ["v1", "v2", "a"]


@pytest.mark.parametrize("step", ["second table", "switch"])
def test_a_failure_leaves_all_views_on_the_old_version(spark, database, monkeypatch, step):
    publish.publish_tables(spark, tables(spark, 1), database, "v1")
    broken = tables(spark, 2)
    if step == "second table":
        broken["dim"] = broken["dim"].withColumn("name", F.raise_error(F.lit("half-way")))
    else:
        def fail(*_):
            raise RuntimeError("half-way")

        monkeypatch.setattr(publish, "_switch", fail)
    with pytest.raises(Exception, match="half-way"):
        publish.publish_tables(spark, broken, database, "v2").collect()
    assert shown(spark, database) == {"fact": {1}, "dim": {1}}
    monkeypatch.undo()
    # The same version again replaces what the failed attempt wrote.
    publish.publish_tables(spark, tables(spark, 2), database, "v2")
    assert shown(spark, database) == {"fact": {2}, "dim": {2}}
    assert spark.table(f"{database}.fact").count() == 3
    with pytest.raises(ValueError, match="already"):
        publish.publish_tables(spark, tables(spark, 2), database, "v2")


def test_views_read_one_partition_and_old_ones_go(spark, database):
    for n in (1, 2, 3):
        publish.publish_tables(spark, tables(spark, n), database, f"v{n}")
    plan = spark.table(f"{database}.fact")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "version" in filters and "subquery" in filters.lower()
    publish.drop_published(spark, database, ["fact", "dim"], keep=1)
    versions = {r.version for r in spark.table(f"{database}.todas_fact").collect()}
    assert versions == {"v3"} and shown(spark, database) == {"fact": {3}, "dim": {3}}


def test_star_is_published(spark, database, tmp_path):
    star = run.run(spark, bookings.source(spark), str(tmp_path), "p", datetime(2026, 1, 1, 10))
    publish.publish_tables(spark, star.tables(), database, "v1")
    layers.create_star_view(spark, database=database)
    facts = bookings.fact_rows(bookings.rows())
    assert spark.table(f"{database}.v_reservas_full").count() == len(facts)
    # The one document, with the shape its reader expects.
    document = json.loads((tmp_path / "data.json").read_text())
    assert list(document) == [
        "top_rutas", "heatmap", "mensual", "conversion", "benchmark", "kpis", "scd2"]
    assert set(document["top_rutas"][0]) == {
        "ruta", "internacional_flag", "ingresos_M_COP", "asientos"}
    assert [d["dia"] for d in document["heatmap"]] == [
        "Lun", "Mar", "Mié", "Jue", "Vie", "Sáb", "Dom"]
    assert sum(v or 0 for d in document["heatmap"] for v in d["valores"]) == len(facts)
    assert list(document["mensual"][0]) == ["anio", "mes", "ingresos_M_COP", "reservas", "periodo"]
    months = [(m["anio"], m["mes"]) for m in document["mensual"]]
    assert months == sorted(months) and len(months) == 12
    assert set(document["kpis"]) == {
        "tasa_cancelacion", "ticket_promedio", "ventana_dias", "ingresos_B", "total_reservas",
        "confirmadas"}
    assert document["kpis"]["total_reservas"] == len(facts) and document["benchmark"] == []
    assert document["scd2"] == {"pasajeros_unicos": 40, "filas_dim": 40, "con_versiones": 0}
    revenue = [r["ingresos_M_COP"] for r in document["top_rutas"]]
    assert revenue == sorted(revenue, reverse=True) and type(revenue[0]) is float


def test_documents_are_bounded_and_replaced(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "d.json")
    some = spark.createDataFrame([(2, None), (1, "x")], "k int, v string")
    for _ in range(2):
        layers.write_document(layers.json_document(spark, {"a": (some, ["k"])}, {
            "o": some.where("k = 1"), "none": some.where("k = 9")}), path)
    assert json.loads(open(path).read()) == {
        "a": [{"k": 1, "v": "x"}, {"k": 2, "v": None}], "o": {"k": 1, "v": "x"}, "none": None}
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["d.json"]
    monkeypatch.setattr(layers, "DOCUMENT_ROWS", 1)
    with pytest.raises(Exception, match="more than 1 rows"):
        layers.json_document(spark, {"a": (some, ["k"])}, {}).collect()
