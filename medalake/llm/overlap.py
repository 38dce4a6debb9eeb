"""Similarity join of shingle sets by T-occurrence search.

Two sets with Jaccard similarity of at least t share T shingles or more, T following from their
sizes. So each of them has one of the other's among its rarest ``size - T + 1``: only documents
that share such a rare shingle can meet. Those that do are gathered in small groups with their
texts, and in a group every set is searched against inverted lists: the short ones are merged with
a heap, the long ones are only probed for the documents that the short ones brought up.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b
from math import log2
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from medalake.llm.common import components, released, stage, table
from medalake.llm.shingles import shingle_sets

SHINGLE = 4
# Similarity as a fraction of whole numbers, so that no link depends on rounding.
PART, WHOLE = 85, 100
CHUNK_SHINGLES = 1 << 21
CHUNK_DOCS = (1 << 16) - 1
# A shingle in more documents of a chunk than this is sent on as one entry.
COMMON_IN_CHUNK = 16
BUCKET_BYTES = 8 << 20
MIN_BUCKETS = 64
GROUP = 128
# Weight of a probe of a long list against a step of the heap, as in the method's cost formula.
PROBE_COST = 0.0085
# Up to so many ids of documents to look up are broadcast (16 bytes each); beyond, a join shuffles.
BROADCAST_IDS = 500_000

HEADER = -1
CHUNK_SCHEMA = "bucket int, chunk bigint, entries binary, common binary, ids binary, keys binary"
PREFIX_SCHEMA = (
    "id bigint, text_key bigint, n_shingles bigint, node binary, rare array<bigint>"
)


def _least_shared(n: np.ndarray) -> np.ndarray:
    """Shingles that a set of ``n`` shares at least with any set that it links to."""
    return -(-n * PART // WHOLE)


def _needed(a: int, b: int) -> int:
    """Shingles that sets of these sizes share at least if they link."""
    return -(-(a + b) * PART // (PART + WHOLE))


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values."""
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return starts, np.diff(np.append(starts, len(values)))


def _bucketed(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the high half, the hash's low 32 bits in the low half."""
    high = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return (high << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))


ENTRY = np.dtype([("rest", "<u4"), ("doc", "<u2")])
COMMON = np.dtype([("rest", "<u4"), ("docs", "<u4")])
LOCAL = np.dtype([("key", "<u8"), ("doc", "<u2")])
ANSWER = np.dtype([("rest", "<u4"), ("doc", "<u2"), ("docs", "<u4")])
DOC = np.dtype([("id", "<i8"), ("null", "?"), ("text_key", "<i8"), ("n", "<i8")])
EVERY_DOC = 0xFFFF


def _chunk_rows(chunk: int, docs: list, sets: list[np.ndarray], buckets: int) -> Iterator[tuple]:
    """A chunk's documents as one header row, its postings as a row for each bucket."""
    facts, nodes = np.zeros(len(docs), DOC), []
    first_of: dict[bytes, int] = {}
    for i, ((id_, text_key), s) in enumerate(zip(docs, sets)):
        facts[i] = (0 if id_ is None else id_, id_ is None, text_key, len(s))
        nodes.append(blake2b(s.tobytes(), digest_size=16).digest() if len(s) else bytes(16))
        first_of.setdefault(nodes[-1], i)
    # Copies within the chunk post their shingles once.
    posting = [i for i in first_of.values() if len(sets[i])]
    local = np.empty(0, LOCAL)
    out: list[tuple] = []
    if posting:
        keys = _bucketed(np.concatenate([sets[i] for i in posting]), buckets)
        owner = np.repeat(np.array(posting, np.uint16), [len(sets[i]) for i in posting])
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        starts, lengths = _runs(keys)
        many = np.repeat(lengths > COMMON_IN_CHUNK, lengths)
        local = np.empty(int(many.sum()), LOCAL)
        local["key"], local["doc"] = keys[many], owner[many]
        common_keys, common_docs = keys[starts], lengths
        kept = lengths > COMMON_IN_CHUNK
        common_keys, common_docs = common_keys[kept], common_docs[kept]
        keys, owner = keys[~many], owner[~many]
        edges = np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32)
        cuts, common_cuts = np.searchsorted(keys, edges), np.searchsorted(common_keys, edges)
        for b in range(buckets):
            e = np.empty(cuts[b + 1] - cuts[b], ENTRY)
            e["rest"], e["doc"] = keys[cuts[b] : cuts[b + 1]], owner[cuts[b] : cuts[b + 1]]
            span = slice(common_cuts[b], common_cuts[b + 1])
            c = np.empty(span.stop - span.start, COMMON)
            c["rest"], c["docs"] = common_keys[span], common_docs[span]
            if len(e) or len(c):
                out.append((b, chunk, e.tobytes(), c.tobytes(), None, None))
    yield (HEADER, chunk, local.tobytes(), None, facts.tobytes(), b"".join(nodes))
    yield from out


def _post(buckets: int):
    """Task: documents to chunks of postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId() << 32, 0
        docs, sets, held = [], [], 0

        def rows() -> pa.RecordBatch:
            found = list(_chunk_rows(part + number, docs, sets, buckets))
            types = [pa.int32(), pa.int64()] + [pa.binary()] * 4
            names = ["bucket", "chunk", "entries", "common", "ids", "keys"]
            arrays = [pa.array(c, t) for c, t in zip(zip(*found), types)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            ids = batch.column("id").to_pylist()
            text_keys = batch.column("text_key").to_pylist()
            texts = batch.column("text")
            for at in range(0, len(ids), 256):
                some = slice(at, at + 256)
                new = shingle_sets(texts.slice(at, 256).cast(pa.binary()).to_pylist(), SHINGLE)
                for doc, s in zip(zip(ids[some], text_keys[some]), new):
                    if docs and (len(docs) == CHUNK_DOCS or held + len(s) > CHUNK_SHINGLES):
                        yield rows()
                        docs, sets, held, number = [], [], 0, number + 1
                    docs.append(doc)
                    sets.append(s)
                    held += len(s)
        if docs:
            yield rows()

    return run


def _count_bucket(data: pa.Table) -> pa.Table:
    """Group of a bucket: tell each chunk which of its shingles occur in other documents too.

    Header rows, dealt out by chunk, pass through.
    """
    if data.column("bucket")[0].as_py() == HEADER:
        return data
    rows = data.to_pylist()
    entries = [np.frombuffer(r["entries"], ENTRY) for r in rows]
    common = [np.frombuffer(r["common"], COMMON) for r in rows]
    rest = np.concatenate([e["rest"] for e in entries] + [c["rest"] for c in common])
    weight = np.concatenate(
        [np.ones(sum(map(len, entries)), np.int64)] + [c["docs"].astype(np.int64) for c in common]
    )
    order = np.argsort(rest, kind="stable")
    starts, lengths = _runs(rest[order])
    docs = np.empty(len(rest), np.int64)
    docs[order] = np.repeat(np.add.reduceat(weight[order], starts), lengths)
    docs = np.minimum(docs, 0xFFFFFFFF)
    at, end, answers = 0, sum(map(len, entries)), []
    for r, e, c in zip(rows, entries, common):
        mine, every = docs[at : at + len(e)], docs[end : end + len(c)]
        at, end = at + len(e), end + len(c)
        shared = mine > 1
        a = np.empty(int(shared.sum()) + len(c), ANSWER)
        a["rest"] = np.concatenate([e["rest"][shared], c["rest"]])
        a["doc"] = np.concatenate([e["doc"][shared], np.full(len(c), EVERY_DOC, np.uint16)])
        a["docs"] = np.concatenate([mine[shared], every])
        if len(a):
            answers.append((r["bucket"], r["chunk"], a.tobytes(), None, None, None))
    columns = zip(*answers) if answers else [[]] * 6
    return pa.table([pa.array(c, t) for c, t in zip(columns, data.schema.types)], data.schema.names)


def _rare_shingles(data: pa.Table) -> pa.Table:
    """Group of a chunk: each document's rare shingles that another document has too."""
    rows = data.to_pylist()
    (header,) = [r for r in rows if r["bucket"] == HEADER]
    facts = np.frombuffer(header["ids"], DOC)
    local = np.frombuffer(header["entries"], LOCAL)
    keys, docs, counts = [], [], []
    for r in rows:
        if r["bucket"] == HEADER:
            continue
        a = np.frombuffer(r["entries"], ANSWER)
        key = (np.uint64(r["bucket"]) << np.uint64(32)) | a["rest"].astype(np.uint64)
        one = a["doc"] != EVERY_DOC
        keys.append(key[one]), docs.append(a["doc"][one]), counts.append(a["docs"][one])
        if not one.all():
            every = key[~one]
            low = np.searchsorted(local["key"], every)
            n = np.searchsorted(local["key"], every, "right") - low
            at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            keys.append(local["key"][at]), docs.append(local["doc"][at])
            counts.append(np.repeat(a["docs"][~one], n))
    key = np.concatenate(keys) if keys else np.empty(0, np.uint64)
    doc = np.concatenate(docs).astype(np.int64) if docs else np.empty(0, np.int64)
    count = np.concatenate(counts) if counts else np.empty(0, np.uint32)
    order = np.lexsort((key, count, doc))
    key, doc = key[order], doc[order]
    n = facts["n"]
    shared = np.bincount(doc, minlength=len(facts))
    # Shingles that no other document has come first in the order and need no list.
    wanted = np.clip(n - _least_shared(n) + 1 - (n - shared), 0, shared)
    first = np.cumsum(shared) - shared
    rare = np.arange(len(doc)) - first[doc] < wanted[doc]
    rare_key = key[rare].astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(wanted)]).astype(np.int32)
    nodes = [header["keys"][16 * i : 16 * i + 16] if n[i] else None for i in range(len(facts))]
    # Copies of a document in its chunk posted nothing; their node's first one speaks for them.
    return pa.table({
        "id": pa.array(facts["id"], pa.int64(), mask=facts["null"]),
        "text_key": pa.array(facts["text_key"], pa.int64()),
        "n_shingles": pa.array(n, pa.int64()),
        "node": pa.array(nodes, pa.binary()),
        "rare": pa.ListArray.from_arrays(offsets, pa.array(rare_key, pa.int64())),
    })


def rare_shingles(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``PREFIX_SCHEMA`` for each document: its set's digest and its shared rare shingles.

    Document frequencies are exact counts over all documents up to collisions of truncated hashes,
    which can only add candidates. Postings travel as packed arrays, one row for each chunk and
    bucket; a shingle common in a chunk travels once for the chunk, so the largest bucket grows
    with the number of chunks and not with a hot shingle's documents.
    """
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    buckets = max(MIN_BUCKETS, -(-size // BUCKET_BYTES))
    read = docs.select(
        F.col(key).cast("bigint").alias("id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_key"),
        F.col(text).cast("binary").alias("text"),
    )
    post = _post(buckets)
    posted = read.mapInArrow(lambda batches: released(post(batches)), CHUNK_SCHEMA)
    spread = F.when(F.col("bucket") == HEADER, F.col("chunk")).otherwise(F.lit(0).cast("bigint"))
    answered = posted.groupBy("bucket", spread.alias("spread")).applyInArrow(
        _count_bucket, CHUNK_SCHEMA
    )
    return answered.groupBy("chunk").applyInArrow(_rare_shingles, PREFIX_SCHEMA)


def divide_skip(
    sets: list[np.ndarray], sides: list[int] | None = None, joined: list[int] | None = None
) -> Iterator[tuple[int, int]]:
    """All linked pairs of sets, each once; with ``sides``, those between side 0 and side 1; with
    ``joined``, those of sets with different numbers there.

    Sets are taken by ascending size, and each searches those before it. Of its shingles' inverted
    lists the L longest are left out of the heap, L by the method's cost formula: whoever reaches T
    of all lists reaches T - L of the short ones. The longs lists are then probed by bisection
    until a document has enough or can no longer get there.
    """
    by_size = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sizes = [len(sets[i]) for i in by_size]
    side = [0 if sides is None else sides[i] for i in by_size]
    flat = np.concatenate([sets[i] for i in by_size])
    place = np.repeat(np.arange(len(sets)), sizes)
    order = np.lexsort((place, flat))
    starts, lengths = _runs(flat[order])
    number = np.empty(len(flat), np.int64)
    number[order] = np.repeat(np.arange(len(starts)), lengths)
    ordered = place[order]
    lists: dict[int, list[int]] = {
        int(k): ordered[starts[k] : starts[k] + lengths[k]].tolist()
        for k in np.flatnonzero(lengths > 1)
    }
    at = 0
    for x, n in enumerate(sizes):
        numbers, at = number[at : at + n], at + n
        least = -(-n * PART // WHOLE)
        lowest = bisect_left(sizes, least)
        if lowest >= x:
            continue
        mine = []
        for k in numbers[lengths[numbers] > 1].tolist():
            found = lists[k]
            low, high = bisect_left(found, lowest), bisect_left(found, x)
            if low < high:
                mine.append((high - low, found, low, high))
        if len(mine) < least:
            continue
        mine.sort(key=lambda m: m[0])
        longest = mine[-1][0]
        n_long = min(least - 1, int(least / (PROBE_COST * log2(longest + 1) + 1)))
        short, long = mine[: len(mine) - n_long], mine[len(mine) - n_long :]
        merged = heapq.merge(*[found[low:high] for _, found, low, high in short])
        threshold, previous, seen = least - n_long, -1, 0
        candidates = []
        for y in merged:
            if y == previous:
                seen += 1
            else:
                if seen >= threshold:
                    candidates.append((previous, seen))
                previous, seen = y, 1
        if seen >= threshold:
            candidates.append((previous, seen))
        for y, seen in candidates:
            if sides is not None and side[y] == side[x]:
                continue
            if joined is not None and joined[by_size[y]] == joined[by_size[x]]:
                continue
            needed, left = _needed(n, sizes[y]), len(long)
            for _, found, low, high in reversed(long):
                if seen >= needed or seen + left < needed:
                    break
                left -= 1
                spot = bisect_left(found, y, low, high)
                seen += spot < high and found[spot] == y
            if seen >= needed:
                yield by_size[x], by_size[y]


LINK_SCHEMA = "node binary, other binary"


def _search_group(data: pa.Table) -> pa.Table:
    """Group: a spanning forest of its links as edges, none between nodes joined before."""
    names, texts = data.column("node").to_pylist(), data.column("text").to_pylist()
    sides, joined = data.column("side").to_pylist(), data.column("joined").to_pylist()
    within = bool(data.column("within")[0].as_py())
    # Nodes of one component begin as one tree.
    first = {c: i for i, c in reversed(list(enumerate(joined)))}
    parent = [first[c] for c in joined]

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    out = []
    if len(first) > 1:
        numbers = None if len(first) == len(names) else [first[c] for c in joined]
        sets = shingle_sets(texts, SHINGLE)
        for x, y in divide_skip(sets, None if within else sides, numbers):
            a, b = root(x), root(y)
            if a != b:
                parent[a] = b
                out.append((names[x], names[y]))
    columns = zip(*out) if out else [[]] * 2
    return pa.table([pa.array(c, pa.binary()) for c in columns], ["node", "other"])


# A pair of blocks that are searched against each other, or one block within itself.
PAIR = "struct<b1: bigint, i: struct<own: binary, k: int>, b2: bigint, j: struct<own: binary, k: int>, side: int, within: boolean>"


def _pair(low_band, low, high_band, high, side, within):
    return F.struct(
        low_band.alias("b1"), low.alias("i"), high_band.alias("b2"), high.alias("j"),
        F.lit(side).alias("side"), F.lit(within).alias("within"),
    ).cast(PAIR)


def _block(k) -> Column:
    """Name of a block without a component of its own."""
    return F.struct(F.lit(None).cast("binary").alias("own"), k.cast("int").alias("k"))


def _banded(nodes: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidate nodes with the size of their candidate component, cut into bands of sizes if it
    is beyond ``GROUP``: links stay within a band or go to the next one."""
    # A little wider than the largest ratio of linked sizes, so that rounding skips no band.
    width = 1.0001 * -F.log(F.lit(PART / WHOLE))
    band = F.floor(F.log(F.col("n_shingles").cast("double")) / width)
    sizes = candidates.groupBy("root").agg(F.count(F.lit(1)).alias("all"))
    return candidates.join(nodes, "node").join(sizes, "root").select(
        "node", "rep", "root", "all",
        F.when(F.col("all") <= GROUP, F.lit(0).cast("bigint")).otherwise(band).alias("band"),
    )


def _neighbours(banded: DataFrame, *columns: str) -> DataFrame:
    """Bands of a component with what the bands next to them hold, as ``above_…``, ``below_…``."""
    out = banded
    for by, name in ((1, "above"), (-1, "below")):
        near = banded.select(
            "root", (F.col("band") - by).alias("band"), *[F.col(c).alias(f"{name}_{c}") for c in columns]
        )
        out = out.join(near, ["root", "band"], "left")
    return out


def _first_groups(placed: DataFrame) -> DataFrame:
    """Groups of the first search: a candidate component of up to ``GROUP`` nodes is searched
    whole. Of a larger one each block is searched within itself and against the first block of its
    band and of the bands beside it. So a node is in a handful of groups, whatever the size of its
    component, and near copies of one text come together here."""
    bands = placed.groupBy("root", "band").agg(
        F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("blocks")
    )
    placed = placed.join(_neighbours(bands, "blocks"), ["root", "band"]).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    own, block, first = F.col("band"), F.col("block"), _block(F.lit(0))
    none = F.array().cast(f"array<{PAIR}>")

    def every(n, start, pair):
        """A pair for each block number from ``start`` on, for nodes of a band's first block."""
        numbers = F.when(n > start, F.sequence(F.lit(start), n - 1)).otherwise(
            F.array().cast("array<int>")
        )
        return F.when(block == 0, F.transform(numbers, pair)).otherwise(none)

    def one(condition, pair):
        return F.when(condition, F.array(pair)).otherwise(none)

    above, below = F.coalesce("above_blocks", F.lit(0)), F.coalesce("below_blocks", F.lit(0))
    pairs = [
        F.array(_pair(own, _block(block), own, _block(block), 0, True)),
        one(block > 0, _pair(own, first, own, _block(block), 1, False)),
        every(F.col("blocks"), 1, lambda k: _pair(own, first, own, _block(k), 0, False)),
        one(above > 0, _pair(own, _block(block), own + 1, first, 0, False)),
        every(above, 0, lambda k: _pair(own, first, own + 1, _block(k), 0, False)),
        one(below > 0, _pair(own - 1, first, own, _block(block), 1, False)),
        every(below, 0, lambda k: _pair(own - 1, _block(k), own, first, 1, False)),
    ]
    return placed.withColumn("g", F.explode(F.array_distinct(F.concat(*pairs)))).select(
        "node", "rep", "root", "g.*", F.col("node").alias("joined")
    )


def _second_groups(placed: DataFrame, joined: DataFrame) -> DataFrame:
    """Groups of the second search: in each large candidate component that is not yet one, all
    pairs of blocks that hold nodes of different components.

    Components of a block's size or more have blocks of their own, so nodes that are joined already
    never meet; smaller ones share blocks, a component in one of them.
    """
    large = placed.where(F.col("all") > GROUP).join(joined, "node", "left").withColumn(
        "joined", F.coalesce("joined", "node")
    )
    open_ = large.groupBy("root").agg(F.min("joined").alias("a"), F.max("joined").alias("b"))
    large = large.join(open_.where("a != b").select("root"), "root")
    sizes = large.groupBy("root", "band", "joined").agg(F.count(F.lit(1)).alias("n"))
    wide = F.col("n") >= GROUP
    shared = sizes.groupBy("root", "band").agg(
        F.ceil(F.sum(F.when(~wide, F.col("n"))) / GROUP).cast("int").alias("shared")
    )
    blocks = sizes.join(shared, ["root", "band"]).select(
        "root", "band", "joined", F.when(wide, F.col("joined")).alias("own"),
        F.when(wide, F.ceil(F.col("n") / GROUP)).otherwise(F.col("shared")).cast("int").alias("k"),
    )
    large = large.join(blocks, ["root", "band", "joined"]).withColumn(
        "block", F.struct("own", F.pmod(
            F.xxhash64(F.when(F.col("own").isNull(), F.col("joined")).otherwise(F.col("node"))), "k"
        ).cast("int").alias("k"))
    )
    bands = large.groupBy("root", "band").agg(F.collect_set("block").alias("held"))
    large = large.join(_neighbours(bands, "held"), ["root", "band"])
    own, block = F.col("band"), F.col("block")

    def apart(other):
        return block["own"].isNull() | ~block["own"].eqNullSafe(other["own"])

    def near(held, pair):
        wanted = F.coalesce(F.filter(held, apart), F.array().cast("array<struct<own:binary,k:int>>"))
        return F.transform(wanted, pair)

    pairs = F.concat(
        near(F.col("held"), lambda o: F.when(
            o == block, _pair(own, block, own, block, 0, True)
        ).when(o < block, _pair(own, o, own, block, 1, False)).otherwise(
            _pair(own, block, own, o, 0, False)
        )),
        near(F.col("above_held"), lambda o: _pair(own, block, own + 1, o, 0, False)),
        near(F.col("below_held"), lambda o: _pair(own - 1, o, own, block, 1, False)),
    )
    return large.withColumn("g", F.explode(pairs)).select("node", "rep", "root", "g.*", "joined")


def _texts(docs: DataFrame, key: str, text: str, needed: DataFrame) -> DataFrame:
    """Texts of the rows that stand for the candidate nodes."""
    id_ = F.col(key).cast("bigint")
    read = docs.select(
        F.struct(
            id_.isNull().alias("none"), id_.alias("id"),
            F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_key"),
        ).alias("rep"),
        F.col(text).cast("binary").alias("text"),
    )
    if needed.count() <= BROADCAST_IDS:
        needed = F.broadcast(needed)
    texts = read.join(needed, read["rep"].eqNullSafe(needed["rep"]), "left_semi")
    # Rows that repeat an id and its text stand for each other.
    return stage(stage(texts).groupBy("rep").agg(F.min("text").alias("text")))


def _edges(groups: DataFrame, texts: DataFrame) -> DataFrame:
    members = groups.join(texts, groups["rep"].eqNullSafe(texts["rep"])).drop("rep")
    return stage(
        members.groupBy("root", "b1", "i", "b2", "j").applyInArrow(_search_group, LINK_SCHEMA)
    )


def _linked(nodes: DataFrame, candidates: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """``node`` and ``root``, the least node of its component of links, of all linked nodes."""
    placed = stage(_banded(nodes, candidates))
    texts = _texts(docs, key, text, placed.select("rep").distinct())
    linked = components(_edges(_first_groups(placed), texts), "node", "other")
    rest = stage(_second_groups(placed, linked.withColumnRenamed("root", "joined")))
    if rest.isEmpty():
        return linked
    edges = _edges(rest, texts)
    # What the second search found links components of the first; nodes follow their component.
    known = rest.select("node", "joined").distinct()
    ends = edges.join(known, "node").select("other", F.col("joined").alias("a"))
    ends = ends.join(known.select(F.col("node").alias("other"), F.col("joined").alias("b")), "other")
    merged = components(ends.select("a", "b").distinct(), "a", "b", "joined")
    every = linked.withColumnRenamed("root", "joined").unionByName(
        merged.select(F.col("joined").alias("node"), "joined").join(linked, "node", "left_anti")
    )
    merged = merged.withColumnRenamed("root", "least")
    return every.join(merged, "joined", "left").select(
        "node", F.coalesce("least", "joined").alias("root")
    )


def classes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, ``text_key`` (the text's hash), ``n_shingles``, ``component_id`` and ``first``
    (whether the row stands for its component) of each document, as a stored table."""
    known = stage(rare_shingles(docs, key, text))
    nodes = stage(
        known.where("node IS NOT NULL").groupBy("node").agg(
            F.min("id").alias("least"), F.first("n_shingles").alias("n_shingles"),
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key")).alias("rep"),
        )
    )
    rare = stage(known.select("node", F.explode("rare").alias("shingle")).distinct())
    hubs = rare.groupBy("shingle").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
    hubs = hubs.where("hub != last").select("shingle", "hub")
    near = components(rare.join(hubs, "shingle").where("node != hub"), "node", "hub")
    linked = stage(_linked(nodes, near, docs, key, text))
    rooted = nodes.join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(
        F.min("least").alias("component_id"), F.min("rep").alias("first")
    )
    verdicts = rooted.join(least, "root").select("node", "component_id", "first")
    joined = known.drop("rare").join(stage(verdicts), "node", "left")
    own = F.struct(F.col("id").isNull().alias("none"), "id", "text_key")
    return stage(joined.select(
        "id", "text_key", "n_shingles",
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
        .alias("component_id"),
        (F.col("node").isNull() | own.eqNullSafe(F.col("first"))).alias("first"),
    ))


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Classes of documents whose shingle sets link.

    Args:
        docs: documents; columns other than ``key`` and ``text`` are left out.
        key: integer id. Ids may repeat or be null; a component's id is its least id that is not
            null, and null if there is none.
        text: a null text or one without words is empty and links with nothing, so its component
            is its own id.

    Returns one row per document: ``key``, ``n_shingles`` bigint, ``component_id`` bigint.
    Documents of equal sets are one node from the start, and nodes that a first search has joined
    are not compared again; no documents give no rows.
    """
    return classes(docs, key, text).select(F.col("id").alias(key), "n_shingles", "component_id")


def one_per_class(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class with its own columns: that of the least id, then of the least
    hash of its text. Empty documents are in no class and stay; rows that repeat an id and its
    text are one document."""
    others = classes(docs, key, text).where("NOT first").select("id", "text_key").distinct()
    # Names that no column of the documents has.
    tag = f"other_{uuid4().hex}"
    renamed = others.select(*[F.col(c).alias(f"{tag}_{c}") for c in others.columns])
    same = (F.col(key).cast("bigint").eqNullSafe(F.col(f"{tag}_id"))) & (
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col(f"{tag}_text_key")
    )
    return docs.join(renamed, same, "left_anti")


def op10_t_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return similar_documents(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
    range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM docs
), sized AS (SELECT doc_id, len(s) AS n FROM sets
), shingles AS (SELECT doc_id, unnest(s) AS x FROM sets
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id != b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
  WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM sets
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, n AS n_shingles, component_id FROM sized JOIN least ON least.a = doc_id
"""
