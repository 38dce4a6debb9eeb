"""Changes between two states of a table, found in the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

INSERT, UPDATE, DELETE = "insert", "update", "delete"
OP = "cambio"


def _row_hash(columns: Sequence[str], salt: int) -> Column:
    """64 bits of a row. A flag beside each value keeps a null apart from any value and a value
    from moving to its neighbour's column unseen."""
    parts = [F.lit(salt)]
    for c in columns:
        parts += [F.col(c).isNull(), F.col(c)]
    return F.xxhash64(*parts)


def fingerprints(
    df: DataFrame, key: Sequence[str], compared: Sequence[str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``key``, ``keep`` and 128 bits (``huella_1``, ``huella_2``) of the ``compared`` columns, by
    default of all that are not the key. Doubles of one value hash alike, -0.0 as 0.0."""
    columns = [c for c in df.columns if c not in key] if compared is None else list(compared)
    return df.select(
        *key, *keep, _row_hash(columns, 1).alias("huella_1"), _row_hash(columns, 2).alias("huella_2")
    )


def changed_parts(
    old: DataFrame, new: DataFrame, key: Sequence[str], part: str
) -> list[str | None]:
    """Values of ``part`` whose rows are not the same in two ``fingerprints`` that keep it.

    Rows of a part are summed up as their number and 128 bits, which do not depend on their order,
    so no row is shuffled. Keys must be unique on either side. Rows of other parts are no changes,
    and a row that moved from one part to another changes both.
    """
    row = [*key, "huella_1", "huella_2"]

    def summed(df: DataFrame, name: str) -> DataFrame:
        bits = [F.bit_xor(F.xxhash64(F.lit(salt), *row)) for salt in (3, 4)]
        sums = F.struct(F.count(F.lit(1)), *bits)
        return df.groupBy(F.struct(part).alias("_part")).agg(sums.alias(name))

    a, b = summed(old, "_then"), summed(new, "_now")
    both = a.join(b, a["_part"].eqNullSafe(b["_part"]), "full_outer")
    found = both.where(~F.col("_then").eqNullSafe(F.col("_now")))
    return [r[0] for r in found.select(F.coalesce(a["_part"], b["_part"])[part]).collect()]


def changed_keys(
    old: DataFrame, new: DataFrame, key: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Keys whose row came, went or changed between two ``fingerprints``.

    Returns ``key``, ``cambio`` (insert, update or delete), and of every column in ``keep`` the old
    value as ``antes_…`` and the new one as ``ahora_…``, null where there is no row. Keys must be
    unique on either side; a null in a key is a value like any other. Only keys and fingerprints
    are shuffled, by one full outer join.
    """
    sides = {}
    for name, df in (("antes", old), ("ahora", new)):
        sides[name] = df.select(
            F.struct(*key).alias("_key"), F.struct("huella_1", "huella_2").alias(f"_{name}"),
            *[F.col(c).alias(f"{name}_{c}") for c in keep],
        )
    # The hash of the key is never null, so the join stays an equi-join that also meets null keys.
    a, b = (df.withColumn("_hash", F.xxhash64("_key")) for df in sides.values())
    match = (a["_hash"] == b["_hash"]) & a["_key"].eqNullSafe(b["_key"])
    kind = (
        F.when(F.col("_antes").isNull(), F.lit(INSERT))
        .when(F.col("_ahora").isNull(), F.lit(DELETE))
        .when(F.col("_antes") != F.col("_ahora"), F.lit(UPDATE))
    )
    either = F.coalesce(a["_key"], b["_key"])
    return a.join(b, match, "full_outer").select(
        *[either[k].alias(k) for k in key], kind.alias(OP),
        *[f"antes_{c}" for c in keep], *[f"ahora_{c}" for c in keep],
    ).where(F.col(OP).isNotNull())


def snapshot_changes(
    old: DataFrame, new: DataFrame, key: Sequence[str], compared: Sequence[str] | None = None
) -> DataFrame:
    """``cambio`` and the changed rows of two snapshots with unique keys: the new state of inserted
    and updated rows, the last state of deleted ones. ``compared`` are the columns that count as a
    change, by default all but the key.

    The fingerprints of both snapshots meet first; full rows are only fetched for changed keys.
    """
    columns = [c for c in new.columns if c not in key] if compared is None else list(compared)
    found = changed_keys(fingerprints(old, key, columns), fingerprints(new, key, columns), key)
    gone = found.where(F.col(OP) == DELETE)
    present = found.where(F.col(OP) != DELETE)

    def rows(df: DataFrame, keys: DataFrame) -> DataFrame:
        wanted = keys.select(F.struct(*key).alias("_key"), OP).withColumn("_hash", F.xxhash64("_key"))
        held = df.withColumn("_key", F.struct(*key)).withColumn("_hash", F.xxhash64("_key"))
        match = (held["_hash"] == wanted["_hash"]) & held["_key"].eqNullSafe(wanted["_key"])
        return held.join(wanted, match).select(OP, *[held[c] for c in new.columns])

    return rows(new, present).unionByName(rows(old, gone))
