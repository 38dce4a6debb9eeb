"""Hard negatives by Fagin's threshold algorithm.

Vectors are stored in blocks with their rows sorted by each component. An anchor walks down all the
lists of a block at once, each from the end that its own component's sign favours, and scores every
row it meets. No row still unmet can score more than the sum of the anchor's products with the
values at which the lists stand; the walk ends when that sum is below what every wanted list of
best rows needs. Anchors are a stated share of the rows and meet the blocks in blocks of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from medalake.llm.common import stage

SCALE = 256
ANCHOR_EVERY = 100
POSITIVES = NEGATIVES = 5
# A negative scores between this part of its positive's score and all of it.
LOW, WHOLE = 80, 100
# Components of a block and of a block of anchors, which bound a task's memory.
BLOCK_COMPONENTS, ANCHOR_COMPONENTS = 1 << 20, 1 << 15
BLOCK_ROWS = 1 << 15
FIRST_STEP = 16
# Blocks of anchors that meet a block in one group.
WAVE = 64

BLOCK_SCHEMA = (
    "dim int, part bigint, ids binary, rows binary, labels binary, vectors binary, lists binary"
)
ASK_SCHEMA = (
    "dim int, part bigint, ids binary, rows binary, labels binary, vectors binary, windows binary"
)
POSITIVE_SCHEMA = "anchor_row bigint, anchor_id bigint, positive_id bigint, positive_score bigint"
NEGATIVE_SCHEMA = (
    "anchor_row bigint, anchor_id bigint, place bigint, positive_id bigint, positive_score bigint, "
    "negative_id bigint, negative_score bigint"
)


def integer_rows(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
    label: Column | str = "label", repeats: bool = False,
) -> DataFrame:
    """``id, label, v`` of the rows that take part: components times ``SCALE`` cut down to whole
    numbers. Rows with a null id, label or vector, or a component that is null or not finite, take
    no part. Of rows that repeat an id that of the least label, then vector, does, or with
    ``repeats`` each."""
    tag = F.col(label) if isinstance(label, str) else label
    wide = F.col(vector).cast("array<double>")
    odd = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    read = vectors.select(
        F.col(key).cast("bigint").alias("id"), tag.cast("bigint").alias("label"), wide.alias("v"),
        odd.alias("odd"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND NOT odd")
    whole = F.transform("v", lambda x: F.floor(x * SCALE))
    if repeats:
        return read.select("id", "label", whole.alias("v"))
    rows = read.select("id", F.struct("label", whole.alias("v")).alias("row"))
    return rows.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.v")


def _matrix(data: pa.Table, dim: int) -> np.ndarray:
    flat = data.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(data.num_rows, dim)


def _packed(values: np.ndarray) -> bytes:
    """A width of 2, 4 or 8 bytes, then the values in it."""
    most = int(np.abs(values).max()) if values.size else 0
    width = next(w for w in (2, 4, 8) if most < 1 << (8 * w - 1))
    return bytes([width]) + values.astype(f"<i{width}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1)


def _one_row(schema: str, values: list) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({n: pa.array([v], kinds[k]) for v, (n, k) in zip(values, fields)})


def _block(data: pa.Table) -> pa.Table:
    """Group: a block with, for each component, its rows in ascending order of it."""
    dim, part = data.column("dim")[0].as_py(), data.column("part")[0].as_py()
    ids, rows = data.column("id").to_numpy(), data.column("row").to_numpy()
    order = np.lexsort((rows, ids))
    ids, rows, labels = ids[order], rows[order], data.column("label").to_numpy()[order]
    v = _matrix(data, dim)[order]
    lists = np.argsort(v, axis=0, kind="stable").T.astype("<u2" if len(ids) <= 1 << 16 else "<u4")
    return _one_row(BLOCK_SCHEMA, [
        dim, part, ids.tobytes(), rows.tobytes(), labels.tobytes(), _packed(v),
        np.ascontiguousarray(lists).tobytes(),
    ])


def _ask(data: pa.Table) -> pa.Table:
    """Group: a block of anchors. An anchor's windows are its positives by their places, with
    their scores."""
    dim, part = data.column("dim")[0].as_py(), data.column("part")[0].as_py()
    windows = [
        (i, w["place"], w["id"], w["score"])
        for i, found in enumerate(data.column("windows").to_pylist()) for w in found
    ]
    return _one_row(ASK_SCHEMA, [
        dim, part, *[data.column(c).to_numpy().tobytes() for c in ("id", "row", "label")],
        _packed(_matrix(data, dim)), np.array(windows, np.int64).reshape(-1, 4).tobytes(),
    ])


def _dealt(rows: DataFrame, components: int) -> DataFrame:
    """Add ``dim`` and ``part``: rows of one length in parts of about so many components."""
    sized = rows.withColumn("dim", F.size("v"))
    count = F.count(F.lit(1))
    most = F.least(F.lit(BLOCK_ROWS), F.greatest(F.lit(1), F.floor(components / F.greatest("dim", F.lit(1)))))
    parts = sized.groupBy("dim").agg(count.alias("n")).select(
        "dim", F.ceil(F.col("n") / most).alias("parts")
    )
    return sized.join(parts, "dim").withColumn("part", F.pmod(F.xxhash64("row"), "parts")).drop("parts")


def blocks(rows: DataFrame) -> DataFrame:
    """Numbered ``rows`` of ``integer_rows`` in stored blocks with their sorted lists."""
    return stage(_dealt(rows, BLOCK_COMPONENTS).groupBy("dim", "part").applyInArrow(_block, BLOCK_SCHEMA))


class Block:
    """Sorted lists over a block's rows, or over those of one label. ``rows`` tells rows apart, by
    default their ids do."""

    def __init__(
        self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, lists: np.ndarray,
        rows: np.ndarray | None = None,
    ):
        self.ids, self.labels, self.v, self.lists = ids, labels, v, lists
        self.rows = ids if rows is None else rows

    def of_label(self, label: int) -> Block:
        rows = np.flatnonzero(self.labels == label)
        place = np.full(len(self.ids), -1)
        place[rows] = np.arange(len(rows))
        moved = place[self.lists]
        lists = moved[moved >= 0].reshape(len(self.lists), len(rows))
        return Block(self.ids[rows], self.labels[rows], self.v[rows], lists, self.rows[rows])

    def walk(
        self, anchor: np.ndarray, done: Callable[[np.ndarray, np.ndarray, int], bool]
    ) -> tuple[np.ndarray, np.ndarray]:
        """Rows met by the walk and their scores. After each step ``done`` is asked with both and
        the threshold, the most that a row not yet met can score. Steps double, as the walk's
        total length is at most twice what it had to be."""
        n, dims = len(self.ids), min(len(anchor), self.v.shape[1])
        used = np.flatnonzero(anchor[:dims])
        a = anchor[:dims]
        met = np.zeros(n, bool)
        rows, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        if not len(used):
            # Nothing favours any row: all score 0.
            return np.arange(n), np.zeros(n, np.int64)
        down = a[used] > 0
        lists = self.lists[used]
        depth, step = 0, FIRST_STEP
        while depth < n:
            end = min(n, depth + step)
            seen = np.concatenate([
                lists[down, n - end : n - depth].ravel(), lists[~down, depth:end].ravel()
            ])
            fresh = np.zeros(n, bool)
            fresh[seen] = True
            fresh &= ~met
            met |= fresh
            new = np.flatnonzero(fresh)
            rows = np.concatenate([rows, new])
            scores = np.concatenate([scores, _products(self.v[new, :dims], a)])
            depth, step = end, 2 * step
            at = np.where(down, lists[:, n - end], lists[:, end - 1])
            threshold = sum(int(x) * int(y) for x, y in zip(a[used], self.v[at, used]))
            if len(rows) == n or done(rows, scores, threshold):
                break
        return rows, scores


def _products(v: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles while every sum stays below 2**53, else in whole numbers of
    any size, of which those beyond 63 bits are an error."""
    if not v.size:
        return np.zeros(len(v), np.int64)
    bound = int(np.abs(v).max()) * int(np.abs(a).sum())
    if bound < 1 << 53:
        return (v.astype(np.float64) @ a.astype(np.float64)).astype(np.int64)
    return np.array([int(x) for x in v.astype(object) @ a.astype(object)], np.int64)


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by the smaller id."""
    if len(ids) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(ids))
    return some[np.lexsort((ids[some], -scores[some]))][:k]


def _kth(scores: np.ndarray, k: int) -> int | None:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else None


def nearest(block: Block, anchor_row: int, anchor: np.ndarray, k: int):
    """Ids and scores of the block's k best rows other than the anchor."""

    def done(rows, scores, threshold):
        kth = _kth(scores[block.rows[rows] != anchor_row], k)
        # A row of equal score may have a smaller id, so only a lower threshold ends the walk.
        return kth is not None and threshold < kth

    rows, scores = block.walk(anchor, done)
    other = block.rows[rows] != anchor_row
    rows, scores = rows[other], scores[other]
    best = _best(block.ids[rows], scores, k)
    return block.ids[rows[best]], scores[best]


def within(block: Block, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], k: int):
    """For each window of scores, ids and scores of its k best rows of other labels."""

    def done(rows, scores, threshold):
        other = scores[block.labels[rows] != label]
        for low, high in windows:
            kth = _kth(other[(other >= low) & (other <= high)], k)
            if threshold >= (low if kth is None else kth):
                return False
        return True

    rows, scores = block.walk(anchor, done)
    other = block.labels[rows] != label
    rows, scores = rows[other], scores[other]
    for low, high in windows:
        some = np.flatnonzero((scores >= low) & (scores <= high))
        best = some[_best(block.ids[rows[some]], scores[some], k)]
        yield block.ids[rows[best]], scores[best]


def _read(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids, rows, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "rows", "labels"))
    flat = _unpacked(row["vectors"])
    return ids, rows, labels, flat.reshape(len(ids), len(flat) // len(ids))


def _columns(schema: str, found: list[tuple]) -> pa.Table:
    names = [f.split()[0] for f in schema.split(", ")]
    columns = zip(*found) if found else [[]] * len(names)
    return pa.table([pa.array(c, pa.int64()) for c in columns], names)


def _meetings(asked: pa.Table, stored: pa.Table) -> Iterator[tuple]:
    """A block with each block of anchors of its group."""
    if not asked.num_rows or not stored.num_rows:
        return
    (row,) = stored.to_pylist()
    ids, rows, labels, v = _read(row)
    width = "<u2" if len(ids) <= 1 << 16 else "<u4"
    lists = np.frombuffer(row["lists"], width).reshape(v.shape[1], len(ids))
    block = Block(ids, labels, v, lists, rows)
    for row in asked.to_pylist():
        yield block, _read(row), np.frombuffer(row["windows"], np.int64).reshape(-1, 4)


def _search_positives(k: int):
    def run(asked: pa.Table, stored: pa.Table) -> pa.Table:
        found = []
        for block, (ids, rows, labels, v), _ in _meetings(asked, stored):
            for label in np.intersect1d(labels, block.labels):
                own = block.of_label(label)
                for i in np.flatnonzero(labels == label):
                    near, scores = nearest(own, rows[i], v[i].astype(np.int64), k)
                    anchor = int(rows[i]), int(ids[i])
                    found += [(*anchor, *x) for x in zip(near.tolist(), scores.tolist())]
        return _columns(POSITIVE_SCHEMA, found)

    return run


def _search_negatives(k: int):
    def run(asked: pa.Table, stored: pa.Table) -> pa.Table:
        found = []
        for block, (ids, rows, labels, v), windows in _meetings(asked, stored):
            for i in np.unique(windows[:, 0]):
                mine = windows[windows[:, 0] == i][:, 1:].tolist()
                # Bounds in whole numbers; no score lies in the window of a negative score.
                spans = [(-(-LOW * s // WHOLE), s) for _, _, s in mine]
                near = within(block, labels[i], v[i].astype(np.int64), spans, k)
                anchor = int(rows[i]), int(ids[i])
                for positive, (who, scores) in zip(mine, near):
                    found += [(*anchor, *positive, *x) for x in zip(who.tolist(), scores.tolist())]
        return _columns(NEGATIVE_SCHEMA, found)

    return run


def _meet(stored: DataFrame, anchors: DataFrame, search, schema: str) -> DataFrame:
    """Every block of anchors with every block: the stated set of questions against all rows.

    A group is one block and a wave of anchor blocks. So a block is sent once for each wave, a
    block of anchors once for each block, and what a group holds does not grow with the input.
    """
    asked = _dealt(anchors, ANCHOR_COMPONENTS).groupBy("dim", "part").applyInArrow(_ask, ASK_SCHEMA)
    asked = stage(asked).withColumn(
        "wave", F.struct(F.col("dim"), F.floor(F.col("part") / WAVE).alias("nth"))
    )
    waves = asked.agg(F.collect_set("wave").alias("waves")).first()["waves"]
    numbers = stored.select("dim", "part").withColumn(
        "number", F.row_number().over(Window.orderBy("dim", "part"))
    )
    n = numbers.count()
    if not waves or not n:
        return stored.sparkSession.createDataFrame([], schema)
    every = F.array(*[F.struct(F.lit(w.dim).alias("dim"), F.lit(w.nth).alias("nth")) for w in waves])
    copies = stored.join(numbers, ["dim", "part"]).withColumn("wave", F.explode(every))
    sent = asked.withColumn("number", F.explode(F.sequence(F.lit(1), F.lit(n))))
    key = [F.col("number"), F.col("wave.dim").alias("wave_dim"), F.col("wave.nth").alias("wave_nth")]
    sides = [
        sent.select(*key, "ids", "rows", "labels", "vectors", "windows"),
        copies.select(*key, "ids", "rows", "labels", "vectors", "lists"),
    ]
    sides = [side.groupBy("number", "wave_dim", "wave_nth") for side in sides]
    return sides[0].cogroup(sides[1]).applyInArrow(search, schema)


def hard_negatives(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label",
    every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
    repeats: bool = False,
) -> DataFrame:
    """For each anchor and each of its positives the best rows of other labels.

    Args:
        vectors: rows; columns other than the named ones are left out. ``integer_rows`` says which
            rows take part and what repeated ids give.
        label: column or expression. Positives have the anchor's label, negatives another.
        every: rows whose id it divides are anchors.
        repeats: rows that repeat an id all take part, each as a row of its own: as an anchor, as a
            positive (also of another row of its id) and as a negative.

    Scores are whole inner products, over the common length where lengths differ, and must fit
    into 63 bits. Higher scores come first, ties by the smaller id. An anchor's positives are its
    first ``positives`` other rows; a positive's negatives are the first ``negatives`` rows that
    score between 80 and 100 percent of it. An anchor without positives gives no rows, and neither
    do windows without negatives, such as those of negative scores, or a table without vectors.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.
    """
    rows = integer_rows(vectors, key, vector, label, repeats)
    # The number that tells rows apart is stored with them, so every later pass reads the same.
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()))
    stored = blocks(rows)
    anchors = rows.where(F.col("id") % every == 0)
    windows = "array<struct<place: bigint, id: bigint, score: bigint>>"
    near = anchors.withColumn("windows", F.array().cast(windows))
    order = Window.partitionBy("anchor_row").orderBy(F.desc("positive_score"), "positive_id")
    found = _meet(stored, near, _search_positives(positives), POSITIVE_SCHEMA)
    found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    pairs = found.groupBy(F.col("anchor_row").alias("row")).agg(F.collect_list(F.struct(
        F.col("place").cast("bigint").alias("place"), F.col("positive_id").alias("id"),
        F.col("positive_score").alias("score"),
    )).alias("windows"))
    order = Window.partitionBy("anchor_row", "place").orderBy(
        F.desc("negative_score"), "negative_id"
    )
    far = anchors.join(pairs, "row")
    return (
        _meet(stored, far, _search_negatives(negatives), NEGATIVE_SCHEMA)
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def op11_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; each seventh row's label is moved by one."""
    vectors = spark.read.schema("vec_id bigint, embedding array<float>, label int").parquet(
        f"{sf_dir.rstrip('/')}/embeddings.parquet"
    )
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return hard_negatives(vectors, label=label, repeats=True)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
    list_sum(list_transform(range(1, least(len(a.q), len(b.q)) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT
      AS score
  FROM v a JOIN v b ON a.vec_id != b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND label != own
  AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
