"""Packing of tokenized documents into sequences of one length.

Documents are cut at multiples of the sequence length. Pieces are dealt at random to groups of
bounded size, and each group packs its own by first-fit decreasing: pieces in order of falling
length, each into the first sequence with room, found by descent in a tournament tree of the room
that is left.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, filterfalse, islice

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from medalake.llm.common import stage, table

SEQUENCE = 2048
END_ID = 1
GROUP_PIECES = 4096
SEED = 7
CACHED_WORDS = 400_000
TEXT_WORDS = 200
SLICE_DOCS = 128

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


LETTER = rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])"
SIGN = rb"[!-/:-@\[-`{-~]"
# Signs that end a word after a letter are one token of their own, as they would be in place.
TAIL = re.compile(
    rb"%b(?:(?<=[a-z].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].))%b*(?=\s|\Z)" % (SIGN, SIGN)
)
# Words that are one piece for the tokenizer, alone as in place: small letters or signs. Letters of
# Latin-1 neither compose with what stands before them nor change to several.
PLAIN = re.compile(rb"%b+|%b+" % (LETTER, SIGN)).fullmatch


def _words(text: bytes | None) -> list[bytes]:
    """Parts of the text that have the same ids alone as in place, spelled as alike as possible.

    Capitals A-Z become small, as the tokenizer does itself, but not where the text may hold the
    name of a special token, which must be spelled in small letters.
    """
    if not text:
        return []
    return text.split() if b"<|" in text else TAIL.sub(rb" \g<0>", text.lower()).split()


class WordIds(dict):
    """Token ids of words, as little-endian 32-bit bytes, by the words' UTF-8 bytes.

    The tokenizer drops white space and never joins text across it, so a text's ids are those of
    its words one after another. Words split at ASCII white space only; any other stays inside.
    Words that were not met for long are let go: a full table becomes the older one, from which
    words are taken over as they occur.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.older: dict[bytes, bytes] = {}
        # Whether an id ends a piece: where all added tokens are names like <|x|>, which cannot
        # stand in plain words, those marked so by the vocabulary.
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        added = self.tokenizer.get_added_tokens_decoder().values()
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix and all("<|" in token.content for token in added):
            self.last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def learn(self, words: set[bytes]) -> None:
        """Make all of ``words`` known."""
        if len(self) + len(words) > CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        older = self.older
        plain: list[bytes] = []
        odd: list[bytes] = []
        for word in [*filterfalse(self.__contains__, words)]:
            if word in older:
                self[word] = older[word]
            elif PLAIN(word):
                plain.append(word)
            else:
                odd.append(word)
        self._learn_plain(plain)
        self._learn_each(odd)

    def look_up(self, words: list[bytes]) -> Iterator[bytes]:
        """Ids of ``words``, one after another; those not known are learned."""
        found = [*map(self.get, words)]
        new = [i for i, ids in enumerate(found) if ids is None]
        if new:
            missing = [words[i] for i in new]
            self.learn(set(missing))
            for i, word in zip(new, missing):
                found[i] = self[word]
        return iter(found)

    def _learn_each(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8", "replace") for w in words]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        for word, encoded in zip(words, found):
            self[word] = np.array(encoded.ids, "<u4").tobytes()

    def _learn_plain(self, words: list[bytes]) -> None:
        """Learn words of one piece each, many to a text: a piece's last token tells its end."""
        texts = [
            b" ".join(words[i : i + TEXT_WORDS]).decode() for i in range(0, len(words), TEXT_WORDS)
        ]
        ids: list[int] = []
        for encoded in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids += encoded.ids
        found = np.array(ids, "<u4")
        ends = (4 * np.flatnonzero(self.last[found]) + 4).tolist()
        if len(ends) != len(words):
            # Another vocabulary, which marks no ends or splits such words.
            self._learn_each(words)
            return
        held = found.tobytes()
        self.update(zip(words, [held[a:b] for a, b in zip([0, *ends], ends)]))


# A Python worker that runs several tasks keeps what it learned.
_KNOWN: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _KNOWN:
        _KNOWN[path] = WordIds(path)
    return _KNOWN[path]


def _cut(path: str, keep_ids: bool):
    """Task: documents to pieces of at most a sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(path)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_DOCS):
                part = batch.slice(at, SLICE_DOCS)
                keys = part.column("doc_id").to_pylist()
                words = [_words(t) for t in part.column("text").to_pylist()]
                found = ids_of.look_up([*chain.from_iterable(words)])
                rows: list[tuple] = []
                for key, ws in zip(keys, words):
                    ids = b"".join(islice(found, len(ws))) + end
                    n = len(ids) // 4
                    if n <= SEQUENCE:
                        row = (key, 0, n, zlib.crc32(ids), n)
                        rows.append((*row, ids) if keep_ids else row)
                        continue
                    for start in range(0, n, SEQUENCE):
                        piece = ids[4 * start : 4 * (start + SEQUENCE)]
                        row = (key, start, len(piece) // 4, zlib.crc32(piece), n)
                        rows.append((*row, piece) if keep_ids else row)
                arrays = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:5]]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    arrays.append(pa.array([r[5] for r in rows], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``SEQUENCE`` ids of each document, the last with the end id.

    Args:
        docs: documents; columns other than ``key`` and ``text`` are left out.
        key: integer id; null and repeated ids are kept as they are.
        text: whole text; a null one is empty and has the end id alone.
        tokenizer: path of the vocabulary file, by default that of the installed word vocabulary.
        keep_ids: also return ``ids``, the piece's ids as little-endian 32-bit bytes.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    read = docs.select(
        F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text")
    )
    return read.mapInArrow(_cut(path, keep_ids), PIECES + (", ids binary" if keep_ids else ""))


def first_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, in the order given, first bin with room first."""
    size = 1
    while size < len(lengths):
        size *= 2
    # Node i holds the most room below it; leaves are the bins, all empty at the start.
    room = [capacity] * (2 * size)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k, length in enumerate(lengths.tolist()):
        i = 1
        while i < size:
            i *= 2
            if room[i] < length:
                i += 1
        bins[k], offsets[k] = i - size, capacity - room[i]
        room[i] -= length
        while i > 1:
            i //= 2
            left, right = room[2 * i], room[2 * i + 1]
            room[i] = left if left > right else right
    return bins, offsets


def _pack_group(data: pa.Table) -> pa.Table:
    data = data.sort_by([
        ("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"),
        ("ids_crc32", "ascending"),
    ])
    bins, offsets = first_fit(data.column("length").to_numpy(), SEQUENCE)
    group = data.column("group")[0].as_py()
    data = data.drop_columns(["group"])
    return data.append_column("sequence_id", pa.array(bins + (group << 32), pa.int64())) \
        .append_column("offset", pa.array(offsets, pa.int64()))


def pack(cut: DataFrame, group_pieces: int = GROUP_PIECES, seed: int = SEED) -> DataFrame:
    """Place pieces (the columns of ``PIECES``, or with ``ids``) in sequences.

    Adds ``sequence_id`` bigint, unique over all groups, and ``offset`` bigint, gapless from 0 in a
    sequence. The pieces are stored first: groups are drawn at random over the stored rows, so a
    task that runs again draws the same, and rows that repeat are dealt out like any others. No
    pieces give no rows.
    """
    stored = stage(cut)
    groups = max(1, -(-stored.count() // group_pieces))
    dealt = stored.withColumn("group", F.floor(F.rand(seed) * groups))
    schema = ", ".join(f"{c} {t}" for c, t in stored.dtypes)
    return dealt.groupBy("group").applyInArrow(
        _pack_group, schema + ", sequence_id bigint, offset bigint"
    )


def sequences(placed: DataFrame, pad_id: int = 0) -> DataFrame:
    """``sequence_id``, its ``ids`` (array<int>, padded to ``SEQUENCE``) and ``n_ids`` before padding.

    ``placed`` is what ``pack`` returns over pieces with ``ids``. A sequence has few pieces: their
    lengths add up to ``SEQUENCE`` at most.
    """

    def join(data: pa.Table) -> pa.Table:
        data = data.sort_by("offset")
        ids = np.frombuffer(b"".join(data.column("ids").to_pylist()), "<u4").astype(np.int32)
        padded = np.full(SEQUENCE, pad_id, np.int32)
        padded[: len(ids)] = ids
        return pa.table({
            "sequence_id": data.column("sequence_id").slice(0, 1),
            "n_ids": pa.array([len(ids)], pa.int32()),
            "ids": pa.array([padded], pa.list_(pa.int32())),
        })

    return placed.groupBy("sequence_id").applyInArrow(
        join, "sequence_id bigint, n_ids int, ids array<int>"
    )


def op3_first_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places."""
    return pack(pieces(table(spark, sf_dir, "documents")))
