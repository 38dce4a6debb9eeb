"""Benchmark decontamination with suffix arrays over the training text.

Each task sorts the suffixes of its documents' words, shard by shard. Every suffix of every
benchmark item is then searched in each shard by bisection: its range of suffixes that begin with
the same window are the window's occurrences, and its neighbours give the longest verbatim match.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from medalake.llm.common import table

WINDOW = 13
# A document is contaminated from one hit word in so many.
SHARE = 20
# Words of documents that a suffix array covers; a longer document has an array of its own.
SHARD_WORDS = 1 << 20
# Bytes of benchmark text in a block; blocks are searched one after another over all documents.
BLOCK_BYTES = 4 << 20

# Capitals to small letters; every other byte below 0x80 that is no digit or small
# letter separates words; bytes from 0x80 on belong to words.
_KEPT = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


class Block:
    """Benchmark items as numbers of words: 0 is any other word, items end with a 0."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int = WINDOW):
        self.ids: list[int | None] = []
        self.numbers: dict[bytes, int] = {}
        flat, starts, tests = [], [], []
        for id_, text in items:
            ws = words(text)
            if not ws:
                continue
            item = len(self.ids)
            self.ids.append(id_)
            begin = len(flat)
            flat += [self.numbers.setdefault(w, len(self.numbers) + 1) for w in ws] + [0]
            span = min(window, len(ws))
            starts += range(begin, begin + len(ws) - span + 1)
            tests += [(item, i, span) for i in range(len(ws) - span + 1)]
        self.flat = np.array(flat + [0] * window, np.int64)
        self.starts = np.array(starts, np.int64)
        table = np.array(tests, np.int64).reshape(-1, 3)
        self.item, self.offset, self.span = table.T


def suffix_array(flat: np.ndarray, length: int, depth: int, largest: int) -> np.ndarray:
    """Places below ``length`` with a known word, sorted by the words that follow them.

    The order covers at least the next ``depth`` words, which is all that a search of that many
    words can tell apart. Suffixes are sorted by as many words as fit in 63 bits, numbers going up
    to ``largest``, then by doubling: a place's rank and the rank of the place as many words on
    make the next key, for groups that are still tied. ``flat`` goes on with zeros after
    ``length``; a 0 matches nothing, so it ends a comparison.
    """
    places = np.flatnonzero(flat[:length] > 0)
    if not len(places):
        return places
    bits = largest.bit_length()
    covered = max(1, min(depth, 63 // bits))
    key = flat[places]
    for k in range(1, covered):
        key = (key << bits) | flat[places + k]
    order = np.argsort(key)
    places, key = places[order], key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    head = np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))
    rank = np.zeros(length + depth, np.int64)
    rank[places] = head + 1
    while covered < depth:
        # Tied suffixes: those in groups of two or more.
        size = np.diff(np.append(np.flatnonzero(new), len(places)))
        tied = np.flatnonzero(np.repeat(size > 1, size))
        if not len(tied):
            break
        held = places[tied]
        following = rank[np.minimum(held + covered, len(rank) - 1)]
        order = np.lexsort((following, head[tied]))
        held, following, groups = held[order], following[order], head[tied][order]
        places[tied] = held
        fresh = np.concatenate(
            [[True], (groups[1:] != groups[:-1]) | (following[1:] != following[:-1])]
        )
        new[tied] |= fresh
        head = np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))
        rank[places] = head + 1
        covered *= 2
    return places


def _compare(flat, at, test, start, limit, most):
    """How many words agree (up to ``limit``) and whether the suffix comes before the test."""
    agree = np.zeros(len(at), np.int64)
    before = np.zeros(len(at), bool)
    open_ = np.arange(len(at))
    for k in range(most):
        open_ = open_[limit[open_] > k]
        if not len(open_):
            break
        a, b = flat[at[open_] + k], test[start[open_] + k]
        same = (a == b) & (b > 0)
        agree[open_] += same
        before[open_[~same]] = (a < b)[~same]
        open_ = open_[same]
    return agree, before


def _bisect(flat, places, block, right: bool) -> np.ndarray:
    """First place in the array that is not before each test's window, or that is after it."""
    low = np.zeros(len(block.starts), np.int64)
    high = np.full(len(block.starts), len(places), np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) >> 1
        span = block.span[open_]
        agree, before = _compare(
            flat, places[middle], block.flat, block.starts[open_], span, WINDOW
        )
        go = before | ((agree == span) if right else False)
        low[open_[go]] = middle[go] + 1
        high[open_[~go]] = middle[~go]


def search(flat: np.ndarray, length: int, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of the block's windows: test numbers and the places where they begin."""
    places = suffix_array(flat, length, WINDOW, len(block.numbers))
    if not len(places) or not len(block.starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low, high = _bisect(flat, places, block, False), _bisect(flat, places, block, True)
    n = high - low
    test = np.repeat(np.arange(len(n)), n)
    at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return test, places[at]


def _extended(flat, place, block, test) -> np.ndarray:
    """Length of the verbatim match that begins with each occurrence."""
    length, open_ = block.span[test].copy(), np.arange(len(test))
    while len(open_):
        a = flat[place[open_] + length[open_]]
        b = block.flat[block.starts[test[open_]] + length[open_]]
        open_ = open_[(a == b) & (b > 0)]
        length[open_] += 1
    return length


SPANS = "array<struct<first: bigint, last: bigint>>"
HIT_SCHEMA = f"doc_id bigint, text binary, n_words bigint, hits {SPANS}, items array<string>"
HIT_FIELDS = pa.schema([
    ("doc_id", pa.int64()), ("text", pa.binary()), ("n_words", pa.int64()),
    ("hits", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
    ("items", pa.list_(pa.string())),
])
MATCH_SCHEMA = "item_id bigint, item_word bigint, doc_id bigint, doc_word bigint, length bigint"


def _shards(batches: Iterator[pa.RecordBatch], block: Block):
    """Shards of a task's documents: rows, words in each, first places, words' numbers, length."""
    rows, counts, parts, held = [], [], [], 0
    get = block.numbers.get

    def shard():
        flat = np.concatenate(parts + [np.zeros(2 * WINDOW + 63, np.int64)])
        return rows, counts, np.cumsum([0] + [c + 1 for c in counts]), flat, held

    for batch in batches:
        texts = batch.column("text")
        others = [batch.column(c) for c in batch.schema.names if c != "text"]
        for i, text in enumerate(texts):
            text = text.as_py()
            ws = words(text)
            if rows and held + len(ws) > SHARD_WORDS:
                yield shard()
                rows, counts, parts, held = [], [], [], 0
            numbers = np.zeros(len(ws) + 1, np.int64)
            numbers[:-1] = [get(w, 0) for w in ws]
            rows.append((text, *(c[i].as_py() for c in others)))
            counts.append(len(ws)), parts.append(numbers)
            held += len(ws) + 1
    if rows:
        yield shard()


def _union(spans: list[tuple[int, int]]) -> list[dict]:
    """Union of stretches of words, given and returned by their first and last words."""
    out: list[dict] = []
    for first, last in sorted(spans):
        if out and first <= out[-1]["last"] + 1:
            out[-1]["last"] = max(last, out[-1]["last"])
        else:
            out.append({"first": first, "last": last})
    return out


def _hits(block: Block, last: bool):
    """Task: add a block's hits to each row; the last block lets go of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, counts, first, flat, length in _shards(batches, block):
            test, place = search(flat, length, block)
            doc = np.searchsorted(first, place, "right") - 1
            order = np.lexsort((place, doc))
            test, place, doc = test[order], place[order], doc[order]
            cuts = np.searchsorted(doc, np.arange(len(rows) + 1))
            out = []
            for i, (text, id_, _, hits, items) in enumerate(rows):
                some = slice(cuts[i], cuts[i + 1])
                if some.start < some.stop:
                    begin = place[some] - first[i]
                    end = begin + block.span[test[some]] - 1
                    before = [(h["first"], h["last"]) for h in hits]
                    hits = _union(before + list(zip(begin.tolist(), end.tolist())))
                    found = (block.ids[k] for k in np.unique(block.item[test[some]]))
                    items = items + ["null" if k is None else str(k) for k in found]
                out.append((id_, None if last else text, counts[i], hits, items))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), HIT_FIELDS)], schema=HIT_FIELDS
            )

    return run


def _matches(block: Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, first, flat, length in _shards(batches, block):
            test, place = search(flat, length, block)
            size = _extended(flat, place, block, test)
            doc = np.searchsorted(first, place, "right") - 1
            # Of the places where a suffix occurs, its longest match, the first one of equals.
            order = np.lexsort((place, -size, test))
            best = order[np.concatenate([[True], test[order][1:] != test[order][:-1]])] \
                if len(order) else order
            columns = [
                [block.ids[k] for k in block.item[test[best]]], block.offset[test[best]].tolist(),
                [rows[k][1] for k in doc[best]], (place - first[doc])[best].tolist(),
                size[best].tolist(),
            ]
            names = ["item_id", "item_word", "doc_id", "doc_word", "length"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return run


def benchmark_blocks(benchmark: DataFrame, key: str, text: str) -> Iterator[Block]:
    """The benchmark in blocks of bounded size, read one after another.

    The benchmark is a stated set of queries against all documents. Only one block is in the
    driver's or a task's memory at a time. Null texts and texts without words have no windows.
    """
    rows = benchmark.select(
        F.col(key).cast("bigint").alias("item_id"), F.col(text).cast("binary").alias("text")
    ).where("text IS NOT NULL")
    held, size = [], 0
    for row in rows.toLocalIterator():
        if held and size + len(row["text"]) > BLOCK_BYTES:
            yield Block(held)
            held, size = [], 0
        held.append((row["item_id"], bytes(row["text"])))
        size += len(row["text"])
    yield Block(held)


def _read(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(
        F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text")
    )


def longest_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """For each benchmark suffix that occurs, its longest verbatim match and one place of it.

    ``item_id``, ``item_word`` (where the suffix begins), ``doc_id``, ``doc_word``, ``length`` in
    words, a window's length or more. Ties go to the least ``doc_id`` and word.
    """
    read = _read(docs, "doc_id", "text")
    found = None
    for block in benchmark_blocks(benchmark, "item_id", "text"):
        some = read.mapInArrow(_matches(block), MATCH_SCHEMA)
        found = some if found is None else found.union(some)
    best = F.min(F.struct((-F.col("length")).alias("n"), "doc_id", "doc_word")).alias("best")
    return found.groupBy("item_id", "item_word").agg(best).select(
        "item_id", "item_word", "best.doc_id", "best.doc_word", (-F.col("best.n")).alias("length")
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Hit words of each document.

    Args:
        docs: documents; columns other than ``key`` and ``text`` are left out. Rows may repeat, ids
            be null; a null text has no words. No documents give no rows.
        benchmark: items; an item of fewer words than a window is one window, one without words is
            none. An empty benchmark hits nothing.

    Returns ``key``, ``n_words`` bigint, ``n_hit`` bigint, ``hits`` (stretches of hit words: first
    and last), ``items`` (sorted ids, as text, of the items whose windows occur; a null id is
    "null"), ``contaminated`` boolean. Documents pass from block to block within one task, so no
    block count needs a shuffle.
    """
    blocks = benchmark_blocks(benchmark, item_key, item_text)
    found = _read(docs, key, text).select(
        "doc_id", "text", F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast(SPANS).alias("hits"), F.array().cast("array<string>").alias("items"),
    )
    block = next(blocks)
    while block is not None:
        following = next(blocks, None)
        found = found.mapInArrow(_hits(block, following is None), HIT_SCHEMA)
        block = following
    hit = F.aggregate(
        "hits", F.lit(0).cast("bigint"), lambda a, s: a + s["last"] - s["first"] + 1
    )
    return found.select(
        F.col("doc_id").alias(key), "n_words", hit.alias("n_hit"), "hits",
        F.array_sort(F.array_distinct("items")).alias("items"),
    ).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))
    )


def op7_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's hits against the whole benchmark."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with their own columns.

    A verdict is a function of the text, so it comes back to all rows of that text by its hash,
    whatever their ids.
    """
    key = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    known = docs.select(key.alias("text_key"), F.col(text).alias("text"))
    dirty = contamination(known, benchmark, "text_key").where("contaminated")
    # A name that no column of the documents has.
    name = f"dirty_{uuid4().hex}"
    dirty = dirty.select(F.col("text_key").alias(name)).distinct()
    return docs.join(dirty, key == F.col(name), "left_anti")


OP7_SQL = r"""
WITH words AS (
  SELECT 'd' AS kind, row_number() OVER () AS row, doc_id AS id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', row_number() OVER (), item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), windows AS (
  SELECT DISTINCT id AS item, least(len(w), 13) AS n,
    unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1),
      lambda i: array_to_string(w[i:i + 12], ' '))) AS x
  FROM words WHERE kind = 'b' AND len(w) > 0
), sizes AS (SELECT DISTINCT n FROM windows
), places AS (
  SELECT row, n, unnest(range(1, len(w) - n + 2)) AS spot,
    unnest(list_transform(range(1, len(w) - n + 2),
      lambda i: array_to_string(w[i:i + n - 1], ' '))) AS x
  FROM words, sizes WHERE kind = 'd' AND len(w) >= n
), found AS (SELECT row, spot, n, item FROM places JOIN windows USING (n, x)
), hit AS (
  SELECT row, count(DISTINCT word) AS n_hit FROM (
    SELECT row, unnest(range(spot, spot + n)) AS word FROM found) GROUP BY row
), items AS (
  SELECT row, count(DISTINCT item) AS n_items,
    string_agg(DISTINCT item::VARCHAR, ',' ORDER BY item::VARCHAR) AS ids FROM found GROUP BY row
)
SELECT id AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit USING (row) LEFT JOIN items USING (row) WHERE kind = 'd'
"""
