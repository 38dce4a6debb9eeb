"""Phrases whose words occur together, counted by vertical partitioning of truncated suffixes.

Every position of a text begins a suffix, of which only the first words matter. The suffixes are
divided by prefixes of words into groups that fit into memory: a word whose suffixes exceed the
budget is extended to prefixes of two words, and those again. Each group builds its subtree of
suffixes on its own and reads a phrase's count from the leaves below it. What the counts of a
phrase's parts say about it is joined in Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from medalake.llm.common import stage, table, whole_text
from medalake.llm.shingles import LOWER, mix

MAX_WORDS = 3
MIN_COUNT = 10
TOP = 2000
# A candidate goes if a longer one that holds it has this part of its count.
PART, WHOLE = 50, 100
SCORE_SCALE = 1_000_000
# Suffixes that a group may hold: the memory budget. Smaller tables are cut into a few groups too.
GROUP_SUFFIXES = 1 << 20
LEAST_GROUPS = 64
# Prefixes fall into so many fine buckets for each group; groups are stretches of buckets.
FINE = 64
CHUNK_BYTES = 4 << 20

# Fixed values of the rule: bytes that end a piece, and bytes between its words.
PIECE_ENDS, GAPS = b".,;:!?\x0a\x0b\x0c\x0d", b" \x09"
KIND = np.zeros(256, np.uint8)
KIND[list(GAPS)] = 1
KIND[list(PIECE_ENDS)] = 2
_ODD = np.uint64(0x9E3779B97F4A7C15)

WORD_SCHEMA = "lang string, word binary, code bigint, n bigint"
LOAD_SCHEMA = "bucket bigint, prefix bigint, n bigint"
SUFFIX_SCHEMA = "part bigint, codes binary, places binary, counts binary"
COUNT_SCHEMA = "phrase binary, n bigint"


@dataclass(frozen=True)
class Chunk:
    """Words of some texts: ``words[i]`` numbers the distinct (language, word) pairs, and
    ``left[i]`` is how many words its piece has from word i on."""

    words: np.ndarray
    left: np.ndarray
    langs: list[str]
    spelled: list[bytes]
    codes: np.ndarray


def _code(lang: str, word: bytes, seed: int) -> int:
    """64 bits that stand for a word of a language."""
    name = lang.encode()
    h = blake2b(len(name).to_bytes(4, "little") + name + word, digest_size=8, key=bytes([seed]))
    return int.from_bytes(h.digest(), "little")


def _distinct(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values below ``size``, ascending, and each value's place among them."""
    if size > 4 * len(values):
        found, places = np.unique(values, return_inverse=True)
        return found, places.reshape(-1)
    present = np.zeros(size, bool)
    present[values] = True
    return np.flatnonzero(present), (np.cumsum(present) - 1)[values]


def read_words(texts: list[bytes], langs: list[str], seed: int) -> Chunk:
    """Split texts at once: bytes to words, words to numbers of the distinct ones."""
    data = np.frombuffer(b"\n".join(texts).translate(LOWER) + b"\n", np.uint8)
    kind = KIND[data]
    inside = kind == 0
    starts = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]]))
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    letters = data[inside]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    array = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    )
    coded = array.dictionary_encode()
    spelled = coded.dictionary.to_pylist()
    number = coded.indices.to_numpy().astype(np.int64)
    names = sorted(set(langs))
    at = {name: i for i, name in enumerate(names)}
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    lang = np.array([at[x] for x in langs], np.int64)[
        np.searchsorted(text_ends, starts, side="right")
    ]
    size = max(1, len(spelled))
    pairs, words = _distinct(lang * size + number, size * len(names))
    pair_langs = [names[i] for i in (pairs // size).tolist()]
    pair_words = [spelled[i] for i in (pairs % size).tolist()]
    codes = np.array([_code(x, w, seed) for x, w in zip(pair_langs, pair_words)], np.uint64)
    # Pieces end at the marks, and each text ends one.
    piece = np.cumsum(kind == 2)[starts]
    last = np.flatnonzero(np.concatenate([piece[1:] != piece[:-1], [True]])) if len(piece) else piece
    left = last[np.searchsorted(last, np.arange(len(piece)))] - np.arange(len(piece)) + 1
    return Chunk(words, left, pair_langs, pair_words, codes)


def _chunks(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[Chunk]:
    texts, langs, held = [], [], 0
    for batch in batches:
        read = zip(batch.column("text").cast(pa.binary()), batch.column("lang").to_pylist())
        for text, lang in read:
            texts.append(text.as_py())
            langs.append(lang)
            held += len(texts[-1]) + 1
            if held >= CHUNK_BYTES:
                yield read_words(texts, langs, seed)
                texts, langs, held = [], [], 0
    if texts:
        yield read_words(texts, langs, seed)


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64()}
    fields = [f.split() for f in schema.split(", ")]
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _count_words(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _chunks(batches, seed):
            n = np.bincount(c.words, minlength=len(c.codes))
            yield _batch(WORD_SCHEMA, [c.langs, c.spelled, c.codes.view(np.int64), n])

    return run


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """64 bits for each row of word codes; a single word is its own code."""
    h = codes[:, 0]
    for depth in range(1, codes.shape[1]):
        h = mix(h * _ODD + codes[:, depth])
    return h


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    spot = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[spot] == values


@dataclass(frozen=True)
class Groups:
    """Vertical partition: ``heavy[d]`` holds the prefixes of d + 1 words beyond the budget, and
    ``part_of`` the group of each fine bucket of prefix hashes."""

    heavy: tuple[np.ndarray, ...]
    part_of: np.ndarray

    def of(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Group of each suffix, given its first words' codes and how many it has: that of its
        shortest prefix that is not heavy, or of all its words if every prefix is."""
        h, prefix = codes[:, 0], codes[:, 0].copy()
        growing = np.ones(len(codes), bool)
        for depth, heavy in enumerate(self.heavy, start=1):
            growing &= _among(h, heavy) & (lengths > depth)
            if depth < codes.shape[1]:
                h = mix(h * _ODD + codes[:, depth])
                prefix = np.where(growing, h, prefix)
        return self.part_of[self.bucket(prefix)]

    def bucket(self, prefix: np.ndarray) -> np.ndarray:
        high = mix(prefix) >> np.uint64(32)
        return ((high * np.uint64(len(self.part_of))) >> np.uint64(32)).astype(np.int64)


def _nodes(columns: list[np.ndarray]) -> list[np.ndarray]:
    """For each level of the tree of sorted rows of numbers, the first row of every node."""
    fresh, out = np.arange(len(columns[0])) == 0, []
    for column in columns:
        fresh[1:] |= column[1:] != column[:-1]
        out.append(np.flatnonzero(fresh))
    return out


def _order(columns: list[np.ndarray], size: int) -> np.ndarray:
    """Sorting order of rows of numbers below ``size``: by one key where it fits into 63 bits."""
    if size ** len(columns) < 1 << 63:
        key = columns[0]
        for column in columns[1:]:
            key = key * size + column
        return np.argsort(key, kind="stable")
    return np.lexsort(columns[::-1])


def _smallest(values: np.ndarray) -> bytes:
    """A width of 1, 2, 4 or 8 bytes, then the values in it."""
    most = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w))
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _send_suffixes(seed: int, max_words: int, groups: Groups):
    """Task: each chunk's distinct truncated suffixes with their counts, one row for each group.

    Suffixes of one word are left out; words are counted already. Number 0 ends a suffix that is
    shorter than ``max_words``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in _chunks(batches, seed):
            at = np.flatnonzero(c.left >= 2)
            if not len(at):
                continue
            left, size = c.left[at], len(c.codes) + 1
            padded = np.concatenate([c.words + 1, np.zeros(max_words, np.int64)])
            columns = [np.where(left > d, padded[at + d], 0) for d in range(max_words)]
            order = _order(columns, size)
            columns = [x[order] for x in columns]
            first = _nodes(columns)[-1]
            counts = np.diff(np.append(first, len(order)))
            columns = [x[first] for x in columns]
            codes = np.concatenate([np.zeros(1, np.uint64), c.codes])
            lengths = np.sum([x > 0 for x in columns], axis=0)
            part = groups.of(np.stack([codes[x] for x in columns], axis=1), lengths)
            by_part = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[by_part])) + 1
            for rows in np.split(by_part, cuts):
                used, places = np.unique(
                    np.concatenate([x[rows] for x in columns]), return_inverse=True
                )
                # Number 0 stays the end mark, also in rows that hold no short suffix.
                shift = int(used[0] != 0)
                own = codes[used] if not shift else np.concatenate([codes[:1], codes[used]])
                yield _batch(SUFFIX_SCHEMA, [
                    [int(part[rows[0]])], [own.tobytes()],
                    [_smallest(places.reshape(-1) + shift)], [_smallest(counts[rows])],
                ])

    return run


def _subtree(max_words: int, min_count: int, groups: Groups):
    """Group: merge the suffixes of all chunks into one tree; phrases of ``min_count`` or more.

    Only heavy prefixes are spread over groups; of them each group gives its part whatever it is.
    """

    def run(data: pa.Table) -> pa.Table:
        codes, places, counts = [], [], []
        for own, place, n in zip(*[data.column(c) for c in ("codes", "places", "counts")]):
            codes.append(np.frombuffer(own.as_py(), np.uint64))
            places.append(_numbers(place.as_py()).reshape(max_words, -1))
            counts.append(_numbers(n.as_py()))
        # Number 0 of every row is the end mark; the others are numbered together.
        known = np.unique(np.concatenate([x[1:] for x in codes]))
        maps = [np.concatenate([[0], np.searchsorted(known, x[1:]) + 1]) for x in codes]
        columns = [
            np.concatenate([m[p[d]] for m, p in zip(maps, places)]) for d in range(max_words)
        ]
        n = np.concatenate(counts)
        order = _order(columns, len(known) + 1)
        columns, n = [x[order] for x in columns], n[order]
        phrases, totals = [], [np.empty(0, np.int64)]
        for depth, first in enumerate(_nodes(columns), start=1):
            if depth == 1:
                continue
            # A node's leaves are neighbours in the order.
            total, ended = np.add.reduceat(n, first), columns[depth - 1][first] == 0
            first, total = first[~ended], total[~ended]
            spelled = np.stack([known[x[first] - 1] for x in columns[:depth]], axis=1)
            kept = total >= min_count
            if depth <= len(groups.heavy):
                kept |= _among(prefix_hash(spelled), groups.heavy[depth - 1])
            raw = spelled[kept].astype(">u8").tobytes()
            phrases += [raw[i : i + 8 * depth] for i in range(0, len(raw), 8 * depth)]
            totals.append(total[kept])
        n = pa.array(np.concatenate(totals), pa.int64())
        return pa.table({"phrase": pa.array(phrases, pa.binary()), "n": n})

    return run


def _bucket_loads(buckets: int, read) -> Callable:
    """Task: suffixes by fine bucket, counted over the whole task, then the prefixes that ``read``
    wants back with their counts. ``read`` gives hashes, their counts, and which are wanted."""
    place = Groups((), np.zeros(buckets, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = np.zeros(buckets, np.int64)
        for prefixes, n, wanted in read(batches):
            load += np.bincount(place.bucket(prefixes), n, buckets).astype(np.int64)
            prefixes, n = prefixes[wanted].view(np.int64), n[wanted]
            yield _batch(LOAD_SCHEMA, [np.full(len(n), -1), prefixes, n])
        at = np.flatnonzero(load)
        yield _batch(LOAD_SCHEMA, [at, np.zeros(len(at), np.int64), load[at]])

    return run


def _words_as_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        n = batch.column("n").to_numpy()
        yield batch.column("code").to_numpy().view(np.uint64), n, n > batch.column("budget").to_numpy()


def _longer_prefixes(seed: int, heavy: list[np.ndarray]) -> Callable:
    """Prefixes one word longer than the last heavy ones, counted in each chunk. Only one whose
    words are all heavy can be heavy itself, so no other is wanted back."""
    depth = len(heavy) + 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for c in _chunks(batches, seed):
            at = np.flatnonzero(c.left >= depth)
            h = c.codes[c.words[at]]
            for d in range(1, depth):
                kept = _among(h, heavy[d - 1])
                at, h = at[kept], h[kept]
                last = c.codes[c.words[at + d]]
                h = mix(h * _ODD + last)
            found, first, n = np.unique(h, return_index=True, return_counts=True)
            yield found, n, _among(last[first], heavy[0])

    return read


def _divided(loads: DataFrame, budget: int, load: np.ndarray) -> tuple[np.ndarray, int]:
    """Add the tasks' loads to ``load`` without those of heavy prefixes; these, and how many
    suffixes they have. There is less than one for each ``budget`` words of the input."""
    loads = stage(loads.groupBy("bucket", "prefix").agg(F.sum("n").alias("n")))
    for bucket, n in loads.where("bucket >= 0").select("bucket", "n").collect():
        load[bucket] += n
    rows = loads.where((F.col("bucket") < 0) & (F.col("n") > budget)).select("prefix", "n").collect()
    heavy = np.array([r.prefix for r in rows], np.int64).view(np.uint64)
    n = np.array([r.n for r in rows], np.int64)
    np.subtract.at(load, Groups((), load).bucket(heavy), n)
    return np.sort(heavy), int(n.sum())


def vertical_partition(
    texts: DataFrame, words: DataFrame, seed: int, max_words: int, budget: int | None = None
) -> Groups:
    """Groups of prefixes whose suffixes fit into the budget together.

    Heavy prefixes and the loads of the fine buckets are what the driver sees; both are bounded by
    the input's words divided by the budget. Below the deepest heavy prefixes the last word deals
    the suffixes out over all buckets; each chunk sends a suffix once, however often it has it.
    """
    total = words.agg(F.sum("n").alias("n")).first()["n"] or 0
    budget = budget or max(1, min(GROUP_SUFFIXES, total // LEAST_GROUPS))
    buckets = FINE * max(LEAST_GROUPS, -(-total // budget))
    load = np.zeros(buckets, np.int64)
    counted = words.select("code", "n", F.lit(budget).cast("bigint").alias("budget"))
    read, heavy = _words_as_prefixes, []
    while True:
        loads = counted.mapInArrow(_bucket_loads(buckets, read), LOAD_SCHEMA)
        found, below = _divided(loads, budget, load)
        heavy.append(found)
        if not len(found) or len(heavy) == max_words - 1:
            break
        counted, read = texts, _longer_prefixes(seed, list(heavy))
    load += -(-below // buckets)
    return Groups(tuple(heavy), (np.cumsum(load) - load) // budget)


def _words(texts: DataFrame) -> tuple[DataFrame, int]:
    """Count of each word of a language, and a seed under which no two of them share a code."""
    for seed in range(256):
        found = texts.mapInArrow(_count_words(seed), WORD_SCHEMA)
        words = stage(found.groupBy("lang", "word", "code").agg(F.sum("n").alias("n")))
        if words.groupBy("code").count().where("count > 1").isEmpty():
            return words, seed
    raise RuntimeError("no seed gives every word a code of its own")


def phrase_counts(
    texts: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
    budget: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Words (``lang, word, code, n``) and phrases of two words or more (``phrase, n``) of
    ``lang, text``, both stored. A phrase is the codes of its words, eight bytes each."""
    words, seed = _words(texts)
    groups = vertical_partition(texts, words, seed, max_words, budget)
    sent = texts.mapInArrow(_send_suffixes(seed, max_words, groups), SUFFIX_SCHEMA)
    parts = sent.groupBy("part").applyInArrow(_subtree(max_words, min_count, groups), COUNT_SCHEMA)
    counted = parts.groupBy("phrase").agg(F.sum("n").alias("n"))
    return words, stage(counted.where(F.col("n") >= min_count))


def _maximal(phrases: DataFrame) -> DataFrame:
    """Phrases that no longer one holds with half of their count or more."""
    size = (F.octet_length("phrase") / 8).cast("int")
    inner = (
        phrases.where(size > 2)
        .select("phrase", "n", size.alias("size"), F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
        .select("phrase", "n", "m", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("m"))).alias("at"))
        .select(F.substring("phrase", 8 * F.col("at") + 1, 8 * F.col("m")).alias("phrase"), "n")
    )
    holders = inner.groupBy("phrase").agg(F.max("n").alias("most"))
    held = F.coalesce(WHOLE * F.col("most") >= PART * F.col("n"), F.lit(False))
    return phrases.join(holders, "phrase", "left").where(~held).select("phrase", "n")


def _scored(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the maximal phrases by their lowest-scoring cut."""
    coded = F.unhex(F.lpad(F.hex("code"), 16, "0"))
    parts = words.select(coded.alias("part"), "lang", "n").unionByName(
        phrases.select(F.col("phrase").alias("part"), F.lit(None).cast("string").alias("lang"), "n")
    )
    size = (F.octet_length("phrase") / 8).cast("int")
    cuts = _maximal(phrases).select(
        "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    ).withColumns({
        "left": F.substring("phrase", F.lit(1), 8 * F.col("k")),
        "right": F.substring("phrase", 8 * F.col("k") + 1, F.octet_length("phrase")),
    })
    first = parts.select(F.col("part").alias("left"), "lang", F.col("n").alias("l"))
    rest = parts.select(F.col("part").alias("right"), F.col("n").alias("r"))
    exact = {c: f"CAST({c} AS DECIMAL(18, 0))" for c in "alr"}
    score = F.expr(
        f"({exact['a']} * {exact['a']} * {SCORE_SCALE}) DIV ({exact['l']} * {exact['r']})"
    )
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.join(first, "left").join(rest, "right").groupBy("phrase").agg(
        # The first cut's left part is the phrase's first word, which knows its language.
        F.max("lang").alias("lang"), F.max("a").alias("a"), lowest
    )
    return scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _spelled(found: DataFrame, words: DataFrame) -> DataFrame:
    """Add ``spelled``, a phrase's words joined by spaces."""
    size = (F.octet_length("phrase") / 8).cast("int")
    codes = found.select("phrase", F.posexplode(F.transform(
        F.sequence(F.lit(0), size - 1), lambda i: F.substring("phrase", 8 * i + 1, F.lit(8))
    )).alias("at", "part"))
    coded = words.select(
        F.unhex(F.lpad(F.hex("code"), 16, "0")).alias("part"), F.col("word").cast("string")
    )
    texts = codes.join(coded, "part").groupBy("phrase").agg(F.concat_ws(" ", F.transform(
        F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]
    )).alias("spelled"))
    return found.join(texts, "phrase")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", max_words: int = MAX_WORDS,
    min_count: int = MIN_COUNT, top: int = TOP, budget: int | None = None,
) -> DataFrame:
    """Each language's phrases whose words occur together most.

    Args:
        docs: documents; columns other than ``lang`` and ``text`` are left out, repeated rows
            count each time.
        lang: counts are kept by its values, a null one as ``und``.
        text: whole text, A-Z lower-cased, cut into pieces at ``.,;:!?`` and line ends and those
            into words at spaces and tabs; phrases lie within a piece. Null or empty texts have no
            words.
        max_words, min_count: longest phrase, and the least count of a candidate.
        top: rows per language. Ties go to the higher count, then to the phrase in byte order.
        budget: suffixes a group may hold; results do not depend on it.

    Returns ``lang, rank, phrase, a, l, r, n, score``: the phrase's count, the counts of the two
    parts of its lowest-scoring cut (of equal cuts the first), the language's words, and
    ``floor(10**6 * a * a / (l * r))``, computed in decimals of 38 digits. A candidate that a
    longer one holds with half of its count or more is left out. No documents give no rows.
    """
    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        whole_text(text).alias("text"),
    )
    words, phrases = phrase_counts(texts, max_words, min_count, budget)
    by_count = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # All that tie with the last rank keep their place until they are spelled.
    near = _scored(words, phrases).withColumn("place", F.rank().over(by_count))
    near = stage(near.where(F.col("place") <= top).drop("place"))
    named = _spelled(near, words).drop("phrase").withColumnRenamed("spelled", "phrase")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op13_vertical_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of all documents."""
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?
-
]')) AS piece FROM documents
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces
), grams AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
    lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM split, (VALUES (1), (2), (3)) sizes(size) WHERE len(w) >= size
), counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL
), sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts
  WHERE size > 1 AND f >= 10
), holders AS (
  SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS most
  FROM candidates, (VALUES (1), (2)) places(i) WHERE size = 3 GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r,
    ((1000000 * a::HUGEINT * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM candidates c LEFT JOIN holders h ON h.lang = c.lang AND h.phrase = c.phrase,
    (VALUES (1), (2)) ks(k)
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
  WHERE k < c.size AND NOT coalesce(100 * most >= 50 * a, FALSE)
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM lowest JOIN sizes USING (lang)
QUALIFY rank <= 2000
"""
