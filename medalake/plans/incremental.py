"""Gold refreshed from what changed since the version before.

Every version keeps fingerprints of the silver rows that it was built from. The next refresh
compares them with silver as it is now, and the difference decides the rest: passengers that
changed get new versions, surrogate keys come from a registry, and only booking months that the
changes reach are built again. A version lists for each of its tables, and for each month of the
fact, which version's folder holds it, so what did not change is neither read nor written.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from medalake.operators.changes import (
    DELETE, INSERT, OP, UPDATE, changed_keys, changed_parts, fingerprints,
)
from medalake.operators.keys import stable_keys, with_stable_key
from medalake.operators.scd import DW_EPOCH, scd2_apply
from medalake.operators.star import MONTH, Star, by_rows, resolve_orphans
from medalake.plans.gold import (
    DIMS, FACT_COLUMNS, FACT_KEYS, NATURAL_KEYS, SMALL_DIMS, build_dim_table, build_fact,
)
from medalake.schemas import AUDIT_COLUMNS
from medalake.session import concurrently, stage, staging
from medalake.sources.layers import (
    COMPLETE, complete_versions, drop_path, list_tables, mark_complete, read_layer, write_layer,
)
from medalake.sources.snapshots import list_snapshots

SILVER_OF = {"vuelo": "vuelos", "ruta": "rutas", "canal": "canales", "pasajero": "pasajeros"}
SILVER_KEYS = {
    "reservas": "reserva_id", "vuelos": "vuelo_id", "rutas": "ruta_id", "canales": "canal_id",
    "pasajeros": "pasajero_id",
}
FACT, EMPTY_FACT, QUARANTINE = "fact_reservas", "fact_reservas_vacia", "cuarentena"
COUNTS, PARTS = "huerfanas", "partes"
PARTS_SCHEMA = "tabla string, parte string, version string"
# Natural keys of a booking, kept with a quarantined one.
BOOKED = ("pasajero_id", "vuelo_id", "canal_id")
# Changed keys up to this number are broadcast: some 60 bytes each, and up to three times that in the
# driver while it builds the broadcast. Beyond, joins shuffle, whatever the size of the keys' files.
BROADCAST_KEYS = 250_000


def with_month(bookings: DataFrame) -> DataFrame:
    """Bookings with their month, which silver may be stored by already."""
    if MONTH in bookings.columns:
        return bookings
    return bookings.withColumn(MONTH, F.date_format("fecha_reserva", "yyyy-MM"))


# --- versions made of parts


def parts_of(spark: SparkSession, root: str, version: str) -> dict[str, dict[str, str]]:
    """For each table of a version its parts and the versions whose folders hold them. The only
    part of an unpartitioned table is ''; the fact's parts are its months."""
    tables = list_tables(spark, root, f"gold/{version}")
    if PARTS not in tables:
        # A version of a full refresh holds everything itself.
        return {t: {"": version} for t in tables}
    out: dict[str, dict[str, str]] = {}
    for row in read_layer(spark, root, f"gold/{version}", PARTS, PARTS_SCHEMA).collect():
        out.setdefault(row.tabla, {})
        if row.version is not None:
            out[row.tabla][row.parte] = row.version
    return out


def read_parts(spark: SparkSession, root: str, version: str, table: str) -> DataFrame:
    """A table of a version, wherever its parts are stored."""
    held = parts_of(spark, root, version).get(table)
    if held is None:
        raise FileNotFoundError(f"version {version} has no table {table}")
    if "" in held:
        return read_layer(spark, root, f"gold/{held['']}", table)
    if not held:
        # A fact without months still has its columns.
        return read_parts(spark, root, version, EMPTY_FACT)
    by_version: dict[str, list[str]] = {}
    for part, owner in held.items():
        by_version.setdefault(owner, []).append(part)
    frames = []
    for owner, months in sorted(by_version.items()):
        base = f"{root.rstrip('/')}/gold/{owner}/{table}"
        reader = spark.read.option("basePath", base)
        frames.append(reader.parquet(*[f"{base}/{MONTH}={m}" for m in sorted(months)]))
    typed = [f.withColumn(MONTH, F.col(MONTH).cast("string")) for f in frames]
    return reduce(DataFrame.unionByName, typed)


def drop_gold(spark: SparkSession, root: str, keep: int) -> None:
    """Delete all but the newest complete versions, except for parts that these refer to."""
    versions = complete_versions(spark, root, "gold")
    kept, old = versions[-max(1, keep):], versions[: -max(1, keep)]
    used = {
        (owner, table, part)
        for v in kept for table, held in parts_of(spark, root, v).items()
        for part, owner in held.items()
    }
    for version in old:
        drop_path(spark, root, f"gold/{COMPLETE}/{version}")
        for table in list_tables(spark, root, f"gold/{version}"):
            path = f"gold/{version}/{table}"
            if (version, table, "") in used:
                continue
            months = {m for v, t, m in used if (v, t) == (version, table)}
            if not months:
                drop_path(spark, root, path)
                continue
            for folder in list_tables(spark, root, path):
                if folder.removeprefix(f"{MONTH}=") not in months:
                    drop_path(spark, root, f"{path}/{folder}")
        if not list_tables(spark, root, f"gold/{version}"):
            drop_path(spark, root, f"gold/{version}")


# --- one refresh


class _Refresh:
    """What the steps of one refresh share: silver, the version before, and the new one."""

    def __init__(self, spark, root, version, silver, epoch, as_of, orphans, end, week_start):
        self.spark, self.root, self.version, self.silver = spark, root, version, silver
        self.epoch, self.as_of, self.orphans, self.end = epoch, as_of, orphans, end
        self.week_start = week_start
        before = complete_versions(spark, root, "gold")
        with_state = [v for v in before if PARTS in list_tables(spark, root, f"gold/{v}")]
        self.before = with_state[-1] if with_state else None
        self.held = parts_of(spark, root, self.before) if self.before else {}
        self.parts: dict[str, dict[str, str]] = {}
        self.changes: dict[str, DataFrame] = {}

    def old(self, table: str) -> DataFrame | None:
        return read_parts(self.spark, self.root, self.before, table) if table in self.held else None

    def write(self, table: str, df: DataFrame) -> DataFrame:
        write_layer(df, self.root, f"gold/{self.version}", table)
        self.parts[table] = {"": self.version}
        return read_layer(self.spark, self.root, f"gold/{self.version}", table)

    def carry(self, table: str) -> DataFrame:
        """Refer to the table of the version before."""
        self.parts[table] = dict(self.held[table])
        return self.old(table)

    def few(self, keys: DataFrame) -> DataFrame:
        return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys.hint("merge")

    # Changes

    def compare(self, table: str) -> None:
        """Fingerprints of a silver table, and how they differ from those of the version before."""
        key = SILVER_KEYS[table]
        rows, keep = self.silver[table], []
        if table == "reservas":
            rows, keep = with_month(rows), [MONTH]
        elif table == "vuelos":
            keep = ["ruta_id"]
        elif table == "pasajeros":
            keep = ["segmento"]
        # The audit columns tell of the extract, not of the row.
        compared = [c for c in rows.columns if c != key and c not in AUDIT_COLUMNS]
        now = self.write(f"huellas_{table}", fingerprints(rows, [key], compared, keep))
        old = self.old(f"huellas_{table}")
        if table == "reservas" and old is not None:
            # Only bookings of months that differ are compared one by one.
            months = changed_parts(old, now, [key], MONTH)
            here = F.col(MONTH).isin([m for m in months if m is not None])
            here = here | F.col(MONTH).isNull() if None in months else here
            old, now = old.where(here), now.where(here)
        if old is None:
            # All rows are new, and the first refresh asks for none of them.
            self.changes[table] = changed_keys(now.limit(0), now, [key], keep)
        else:
            self.changes[table] = stage(changed_keys(old, now, [key], keep))

    def keys(self, table: str, *ops: str) -> DataFrame:
        return self.changes[table].where(F.col(OP).isin(*ops)).select(SILVER_KEYS[table])

    def unchanged(self, *tables: str) -> bool:
        return self.before is not None and all(self.changes[t].isEmpty() for t in tables)

    # Dimensions

    def type1(self, name: str) -> DataFrame:
        sources = ("reservas", "vuelos") if name == "tiempo" else (SILVER_OF[name],)
        dim, registry = f"dim_{name}", f"claves_{name}"
        if self.unchanged(*sources):
            self.carry(registry)
            return self.carry(dim)
        sk, key = f"{name}_sk", [NATURAL_KEYS[name]]
        built = build_dim_table(name, self.silver, week_start=self.week_start, keyed=False)
        numbered = self.old(registry)
        numbered = None if numbered is None else by_rows(numbered)
        known = stable_keys(built, sk, key, numbered, small=name in SMALL_DIMS)
        known = by_rows(self.write(registry, known))
        return self.write(dim, with_stable_key(built, sk, key, known))

    def passengers(self) -> DataFrame:
        """Type-2 versions carried forward: those of touched ids are built again, the others pass
        without a shuffle. Versions are never taken out, so the dimension is its own registry.

        A new id's state is valid from the epoch, a new segment from the day of the snapshot. An id
        that vanished keeps its versions: its bookings refer to them. Attributes that are not
        tracked stay as they were when a version began.
        """
        if self.unchanged("pasajeros"):
            return self.carry("dim_pasajero")
        rows = self.silver["pasajeros"].select(
            "pasajero_id", "segmento", "pais_residencia", "fecha_alta"
        )
        old = self.old("dim_pasajero")
        if old is None:
            return self.write(
                "dim_pasajero", build_dim_table("pasajero", self.silver, epoch=self.epoch)
            )
        touched = self.few(self.keys("pasajeros", INSERT, UPDATE))
        known = self.few(
            old.where("activo").join(touched, "pasajero_id", "left_semi").select("pasajero_id")
        )
        since = F.when(F.col("_known"), F.lit(self.as_of)).otherwise(F.lit(self.epoch))
        updates = stage(
            rows.join(touched, "pasajero_id", "left_semi")
            .join(known.withColumn("_known", F.lit(True)), "pasajero_id", "left")
            .withColumn("_desde", since).drop("_known")
        )
        applied = scd2_apply(
            old, updates, "pasajero_id", ["segmento"], "_desde",
            carry=["pais_residencia", "fecha_alta"], sk="pasajero_sk",
            broadcast_keys=updates.count() <= BROADCAST_KEYS,
        )
        return self.write("dim_pasajero", applied)

    # Fact

    def touched_months(self, dims: dict[str, DataFrame]) -> list[str] | None:
        """Months that the changes reach, or None for all of them."""
        if self.before is None:
            return None
        booked = self.changes["reservas"]
        months = [booked.select(F.col(f"{side}_{MONTH}").alias(MONTH)) for side in ("antes", "ahora")]
        fact, waiting = self.old(FACT), self.old(QUARANTINE)

        def stored(name: str, keys: DataFrame, since: date | None = None) -> None:
            """Months of facts that refer to dimension rows of these natural keys."""
            dim = self.old(f"dim_{name}")
            sks = dim.join(self.few(keys), keys.columns, "left_semi").select(f"{name}_sk")
            rows = fact if since is None else fact.where(
                (F.col("fecha_reserva") >= F.lit(since)) & (F.col(MONTH) >= since.strftime("%Y-%m"))
            )
            months.append(rows.join(self.few(stage(sks)), f"{name}_sk", "left_semi").select(MONTH))

        def quarantined(reason: str, keys: DataFrame) -> None:
            """Months of quarantined bookings whose missing row may have come."""
            rows = waiting.where(F.col("motivo") == f"sin_{reason}_sk")
            months.append(rows.join(self.few(keys), keys.columns, "left_semi").select(MONTH))

        flights = self.changes["vuelos"]
        moved = flights.where(~F.col("antes_ruta_id").eqNullSafe(F.col("ahora_ruta_id")))
        if not self.unchanged("vuelos"):
            stored("vuelo", moved.where(F.col(OP) != INSERT).select("vuelo_id"))
            quarantined("vuelo", self.keys("vuelos", INSERT))
            quarantined("ruta", moved.select("vuelo_id"))
        if not self.unchanged("rutas"):
            stored("ruta", self.keys("rutas", DELETE))
            served = dims["vuelo"].join(self.few(self.keys("rutas", INSERT)), "ruta_id", "left_semi")
            quarantined("ruta", served.select("vuelo_id"))
        if not self.unchanged("canales"):
            stored("canal", self.keys("canales", DELETE))
            quarantined("canal", self.keys("canales", INSERT))
        if not self.unchanged("pasajeros"):
            people = self.changes["pasajeros"]
            segment = ~F.col("antes_segmento").eqNullSafe(F.col("ahora_segmento"))
            stored("pasajero", people.where((F.col(OP) == UPDATE) & segment).select("pasajero_id"),
                   self.as_of)
            quarantined("pasajero", self.keys("pasajeros", INSERT))
        found = reduce(DataFrame.union, months).where(F.col(MONTH).isNotNull()).distinct()
        return sorted(r[0] for r in found.collect())

    def fact(self, dims: dict[str, DataFrame]) -> None:
        months = self.touched_months(dims)
        if months == []:
            for table in (FACT, QUARANTINE, *({EMPTY_FACT} & set(self.held))):
                self.carry(table)
            self.write(COUNTS, self.counts(self.old(QUARANTINE)))
            return
        booked = with_month(self.silver["reservas"])
        if months is not None:
            # Silver stored by month is read in these months only.
            booked = booked.where(F.col(MONTH).isin(months))
        # The month follows from the booking's time and need not pass through the joins.
        built = build_fact(
            booked, Star(None, **dims), "keep", self.end, beside=BOOKED, stored=True
        )
        built = stage(with_month(built), "zstd")
        write_layer(
            resolve_orphans(built, FACT_KEYS, self.orphans).select(*FACT_COLUMNS, MONTH),
            self.root, f"gold/{self.version}", FACT, partition_by=[MONTH],
        )
        folders = list_tables(self.spark, self.root, f"gold/{self.version}/{FACT}")
        fresh = {f.removeprefix(f"{MONTH}="): self.version for f in folders if f.startswith(MONTH)}
        gone = set(self.held.get(FACT, ())) if months is None else set(months)
        held = {m: v for m, v in self.held.get(FACT, {}).items() if m not in gone}
        self.parts[FACT] = held | fresh
        if not self.parts[FACT]:
            self.write(EMPTY_FACT, built.select(*FACT_COLUMNS, MONTH).limit(0))
        missing = F.array(*[F.when(F.col(k).isNull(), F.lit(f"sin_{k}")) for k in FACT_KEYS])
        waiting = built.select(
            "reserva_id", F.explode(F.array_compact(missing)).alias("motivo"), *BOOKED, MONTH
        )
        if months is not None:
            others = self.old(QUARANTINE).where(~F.col(MONTH).isin(months))
            waiting = waiting.unionByName(others)
        self.write(COUNTS, self.counts(self.write(QUARANTINE, waiting)))

    def counts(self, waiting: DataFrame) -> DataFrame:
        """The row of ``orphan_measures`` over the whole fact."""
        total = self.silver["reservas"].agg(F.count(F.lit(1)).alias("filas"))
        return total.join(waiting.agg(
            F.count_distinct("reserva_id").alias("huerfanas"),
            *[F.count_if(F.col("motivo") == f"sin_{k}").alias(f"sin_{k}") for k in FACT_KEYS],
        ), how="cross")

    def finish(self) -> dict[str, int]:
        rows = [
            (table, part, owner) for table, held in self.parts.items()
            for part, owner in (held.items() or [(None, None)])
        ]
        self.write(PARTS, self.spark.createDataFrame(rows, PARTS_SCHEMA).coalesce(1))
        counts = read_layer(self.spark, self.root, f"gold/{self.version}", COUNTS).first().asDict()
        mark_complete(self.spark, self.root, "gold", self.version)
        return counts


def snapshot_day(spark: SparkSession, root: str) -> date:
    """Day of the latest bronze snapshot, from which new states are valid."""
    label = list_snapshots(spark, root, "pasajeros")[-1]
    return datetime.strptime(label, "%Y%m%d_%H%M").date()


def refresh_changed(
    spark: SparkSession, root: str, silver: dict[str, DataFrame], epoch: date = DW_EPOCH,
    as_of: date | None = None, orphans: str = "drop", end: str = "date",
    week_start: str = "monday", version: str | None = None,
) -> dict[str, int]:
    """Write the next version of gold from what changed in ``silver`` since the one before, and
    return its orphan counts. The first refresh, or the first after full ones, builds everything.

    Bookings without a dimension row wait in the table ``cuarentena``, one row for each reason; when
    the row they miss arrives, their months are built again. ``as_of`` is the day from which changed
    states are valid, by default that of the latest snapshot. The version is marked complete last.
    """
    with staging(spark):
        r = _Refresh(
            spark, root, version or datetime.now().strftime("%Y%m%d_%H%M%S_%f"), silver, epoch,
            as_of or snapshot_day(spark, root), orphans, end, week_start,
        )
        concurrently([lambda t=t: r.compare(t) for t in SILVER_KEYS])
        todo = {n: (r.passengers if n == "pasajero" else lambda n=n: r.type1(n)) for n in DIMS}
        dims = dict(zip(todo, concurrently(todo.values())))
        r.fact(dims)
        return r.finish()
