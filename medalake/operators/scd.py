"""Type-2 slowly changing dimensions and point-in-time lookups.

A version is valid from ``valido_desde`` to ``valido_hasta``, both days included; the current one
ends on 9999-12-31 and is ``activo``. Versions of one id never overlap and leave no gap.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from medalake.functions.dates import day
from medalake.functions.text import map_values
from medalake.operators.keys import surrogate_key

FROM, TO, CURRENT = "valido_desde", "valido_hasta", "activo"
# Validity of the first version and of the current one.
DW_EPOCH = date(2020, 1, 1)
OPEN_END = date(9999, 12, 31)


def scd2_build(
    log: DataFrame,
    key: str,
    tracked: Sequence[str],
    effective: str,
    order_by: Sequence[str] = (),
    carry: Sequence[str] = (),
) -> DataFrame:
    """Versions of each id from a log of states.

    The last state of an id on a day wins (``order_by`` orders states within the day), a state
    equal to the one before opens no version, and each version closes the day before the next.
    After the per-day step an id holds at most one row per calendar day, however many log rows it
    had; that step drops rows before its shuffle, so a hot id stays cheap.
    """
    columns = [key, *tracked, *carry]
    latest = [F.col(c).desc() for c in order_by]
    values = [c for c in [*tracked, *carry] if c not in order_by]
    within_day = Window.partitionBy(key, FROM).orderBy(*latest, *values)
    daily = (
        log.select(*dict.fromkeys([*columns, *order_by]), day(F.col(effective)).alias(FROM))
        .withColumn("_rank", F.row_number().over(within_day))
        .where(F.col("_rank") == 1)
        .select(*columns, FROM)
    )
    chain = Window.partitionBy(key).orderBy(FROM)
    state = F.struct(*tracked)
    following = F.lead(FROM).over(chain)
    return (
        daily.withColumn("_before", F.lag(state).over(chain))
        .where(~F.col("_before").eqNullSafe(state))
        .withColumn("_next", following)
        .select(
            *columns,
            FROM,
            F.coalesce(F.date_sub("_next", 1), F.lit(OPEN_END)).alias(TO),
            F.col("_next").isNull().alias(CURRENT),
        )
    )


def single_version(base: DataFrame, epoch: date = DW_EPOCH) -> DataFrame:
    """One open version per row of ``base``."""
    return base.select(
        "*", F.lit(epoch).alias(FROM), F.lit(OPEN_END).alias(TO), F.lit(True).alias(CURRENT)
    )


def changed_states(
    base: DataFrame,
    changes: DataFrame,
    key: str,
    tracked: str,
    effective: str,
    promotion: Mapping[str, str] | None = None,
    fallback: str | None = None,
) -> DataFrame:
    """Full rows for ids that change: ``base`` attributes with the new ``tracked`` value.

    ``changes`` holds (key, effective) and, unless a ``promotion`` map derives the new value from
    the old one, the new value itself. An id's n-th day with a change is promoted n times.
    """
    others = [c for c in base.columns if c not in (key, tracked)]
    if not promotion:
        picked = changes.select(key, effective, F.col(tracked).alias("_new"))
        return base.join(picked, key).select(key, F.col("_new").alias(tracked), *others, effective)
    # One row per id and day at most, so a hot id's window is bounded by the calendar.
    days = changes.select(key, day(F.col(effective)).alias(effective)).distinct()
    nth = F.row_number().over(Window.partitionBy(key).orderBy(effective))
    promoted = F.aggregate(
        F.sequence(F.lit(1), F.col("_nth")), F.col(tracked),
        lambda value, _: map_values(value, promotion, fallback),
    )
    return base.join(days.withColumn("_nth", nth), key).select(
        key, promoted.alias(tracked), *others, effective
    )


def scd2_from_base(
    base: DataFrame,
    changes: DataFrame,
    key: str,
    tracked: str,
    effective: str,
    epoch: date = DW_EPOCH,
    promotion: Mapping[str, str] | None = None,
    fallback: str | None = None,
) -> DataFrame:
    """Versions from a base table plus a change set.

    The base state is valid from ``epoch`` on, or from the day before an id's first change if that
    is no later than the epoch, so the base state never follows a change.
    """
    first = changes.groupBy(key).agg(F.min(day(F.col(effective))).alias("_first"))
    since = F.least(F.lit(epoch), F.date_sub("_first", 1))
    opening = (
        base.join(first, key, "left").withColumn(effective, since).drop("_first")
        .withColumn("_seq", F.lit(0))
    )
    later = changed_states(base, changes, key, tracked, effective, promotion, fallback)
    later = later.withColumn(effective, day(F.col(effective))).withColumn("_seq", F.lit(1))
    carry = [c for c in base.columns if c not in (key, tracked)]
    log = opening.unionByName(later)
    return scd2_build(log, key, [tracked], effective, order_by=["_seq"], carry=carry)


def scd2_apply(
    dim: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: Sequence[str],
    effective: str,
    order_by: Sequence[str] = (),
    carry: Sequence[str] = (),
    sk: str | None = None,
    history: DataFrame | None = None,
    broadcast_keys: bool | None = None,
) -> DataFrame:
    """Apply a batch of new states: close what changed, insert what is new.

    Ids without updates pass through untouched, and without a shuffle if ``broadcast_keys`` says
    that the caller has counted the updated ids and they are few; if it is false they are too many
    for any broadcast. With ``history``, the log rows applied before,
    updated ids are built anew from all their rows, so the outcome equals one build over the whole
    log whatever order rows arrive in. Without it, versions of updated ids re-enter as log rows
    ahead of the updates; that equals one build only if an id's batches arrive in date order, as
    states that opened no version are not in the dimension, and a row before its id's current
    version raises an error. With ``sk``, versions keep the key facts already refer to and new
    versions continue after the highest key.
    """
    touched = updates.select(key).distinct()

    def sized(df: DataFrame) -> DataFrame:
        """A side of a join with rows of updated ids only."""
        return df.hint("merge") if broadcast_keys is False else df

    touched = F.broadcast(touched) if broadcast_keys else sized(touched)
    ids = [sk] if sk else []
    state = [key, *tracked, *carry]
    at = updates.schema[effective].dataType
    held = dim.join(touched, key, "left_semi")
    known = held.select(*state, F.col(FROM).cast(at).alias(effective), *ids)
    columns = list(dict.fromkeys([*state, effective, *order_by]))
    fresh = updates.select(*columns)
    if history is None:
        started = held.groupBy(key).agg(F.max(FROM).alias("_started"))
        late = F.raise_error(F.lit("a row before its id's current version needs the history"))
        checked = F.when(day(F.col(effective)) < F.col("_started"), late.cast(at))
        fresh = fresh.join(sized(started), key, "left").select(
            *[c for c in columns if c != effective],
            checked.otherwise(F.col(effective)).alias(effective),
        )
        log = known.withColumn("_batch", F.lit(0)).unionByName(
            fresh.withColumn("_batch", F.lit(1)), allowMissingColumns=True
        )
        rebuilt = scd2_build(
            log, key, tracked, effective, order_by=["_batch", *order_by], carry=[*carry, *ids]
        )
    else:
        log = history.join(touched, key, "left_semi").select(*columns).unionByName(fresh)
        rebuilt = scd2_build(log, key, tracked, effective, order_by=order_by, carry=carry)
        for c in ids:
            rebuilt = rebuilt.withColumn(c, F.lit(None).cast(dim.schema[c].dataType))
    if sk is None:
        return dim.join(touched, key, "left_anti").select(*rebuilt.columns).unionByName(rebuilt)
    # A same-day correction replaces the state of an existing version; it keeps that version's key.
    old_keys = known.select(key, day(F.col(effective)).alias(FROM), F.col(sk).alias("_old"))
    rebuilt = (
        rebuilt.join(sized(old_keys), [key, FROM], "left")
        .withColumn(sk, F.coalesce(sk, "_old"))
        .drop("_old")
    )
    last = dim.agg(F.max(sk).alias("last"))
    keyed = rebuilt.where(F.col(sk).isNotNull())
    new = surrogate_key(rebuilt.where(F.col(sk).isNull()).drop(sk), sk, [key, FROM], start=last)
    untouched = dim.join(touched, key, "left_anti").select(*rebuilt.columns)
    return untouched.unionByName(keyed).unionByName(new).select(*dim.columns)


def scd2_stats(dim: DataFrame, key: str) -> DataFrame:
    """Distinct ids, versions, and ids with at least two versions."""
    per_id = dim.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.count(key).alias("ids"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("versions"),
        F.count_if(F.col("n") > 1).alias("ids_with_history"),
    )


def _halvings(n: Column) -> Column:
    """Steps of a binary search over ``n`` items: powers of two, largest first."""
    exponents = F.sequence(F.ceil(F.log2(n)).cast("int"), F.lit(0), F.lit(-1))
    return F.transform(exponents, lambda k: F.pow(F.lit(2), k).cast("int"))


def pit_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    at: str,
    take: Sequence[str],
    end: str = "date",
    how: str = "left",
) -> DataFrame:
    """Attach to each fact the columns ``take`` of the version valid at ``at``.

    ``end="date"`` compares days, so the last valid day counts in full. ``end="closed_ts"``
    compares the intraday timestamp with midnight of that day and so loses what happened during
    it, as a plain ``ts BETWEEN valido_desde AND valido_hasta`` does.

    Versions of an id are folded into one sorted array (an id has at most one version per calendar
    day, which bounds the array), so the join is one-to-one on the id, never multiplies facts, and
    a binary search finds the version. A hot id's facts are split by the adaptive skew join, each
    part meeting a single dimension row. That split needs both join inputs to come straight from
    an exchange; joining on the id and its hash keeps Spark from reusing the fold's partitioning
    in place of one. One bit of the hash does that, and takes next to nothing of the shuffle.
    """
    if end not in ("date", "closed_ts"):
        raise ValueError(f"end must be 'date' or 'closed_ts', not {end!r}")
    # Version columns carry a prefix, so that they cannot meet a fact column of the same name.
    fields = {c: f"_v_{c}" for c in dict.fromkeys([FROM, TO, *take])}
    bit = F.pmod(F.xxhash64(key), F.lit(2))
    start, last = fields[FROM], fields[TO]
    folded = (
        dim.groupBy(key)
        .agg(
            F.array_sort(
                F.collect_list(F.struct(*[F.col(c).alias(v) for c, v in fields.items()]))
            ).alias("_versions")
        )
        .withColumn("_steps", _halvings(F.size("_versions")))
        .withColumn("_hash", bit)
    )
    moment = day(F.col(at))

    def advance(position: Column, step: Column) -> Column:
        starts = F.get("_versions", position + step - 1)[start]
        return F.when(starts <= moment, position + step).otherwise(position)

    started = F.aggregate("_steps", F.lit(0), advance)
    hit = F.get("_versions", F.col("_started") - 1)
    instant = moment if end == "date" else F.col(at).cast("timestamp_ntz")
    limit = hit[last] if end == "date" else hit[last].cast("timestamp_ntz")
    # Unfolding the hit as rows, zero or one per fact, keeps a filter on it from being copied
    # below the search.
    found = (
        fact.withColumn("_hash", bit)
        .join(folded, [key, "_hash"], how)
        .withColumn("_started", started)
        .select(*fact.columns, F.inline_outer(F.when(instant <= limit, F.array(hit))))
    )
    if how == "inner":
        found = found.where(F.col(start).isNotNull())
    return found.select(*fact.columns, *[F.col(fields[c]).alias(c) for c in take])
