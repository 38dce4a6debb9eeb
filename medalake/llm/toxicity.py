"""Toxicity of texts that hide their words.

A writer's word went through a noisy channel: letters became look-alike digits and signs, were
repeated or set apart. Each disguised word is a lattice of what its characters may stand for, and
the Viterbi path under a character language model of the corpus gives the word back. A linear
model over the restored words then scores the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import exp
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from medalake.llm.common import released, stage, table, whole_text

# Letters that digits and signs look like.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
    "¥": "y", "§": "s", "?": "", "*": "aeiou",
}
JOINERS = " .-_"
EDGE = ".,;:!?\"'()[]{}<>#*&%/\\=~^`´“”„«»…-_"
LEFT_EDGE = EDGE.replace("!", "").replace("(", "")
# Costs of the channel (negative logarithms): a look-alike, a sign that stands for nothing, a
# character that stands for itself though it may look like a letter, a run cut to one or two, a
# pair cut to one.
AS_LETTER, AS_NOTHING, AS_ITSELF, CUT_TO_ONE, CUT_TO_TWO = 0.7, 2.5, 3.0, 0.7, 1.2
CUT_PAIR = 2.0
ORDER = 4
# A lattice of more choices than this is walked with so many states first, for a bound.
BEAM = 8
SLOTS = 1 << 17
SMOOTHING = 4.0
ALPHABET = 64

# The linear model is fitted on at most so many labelled rows, taken by the hash of their id.
MAX_LABELLED = 20_000
MIN_TOXIC_DOCS = 3
MIN_TOXIC_SHARE = 0.5
PREFIXES = (4, 5)
STEPS, RATE, RIDGE = 500, 0.2, 1e-5
THRESHOLD = 0.7
CACHED_TOKENS, CACHED_DECODED = 600_000, 100_000

SIGNS = "".join(re.escape(c) for c in LOOK_ALIKES)
# Worth a lattice: a look-alike beside a letter, a letter twice in a row, or look-alikes only.
DISGUISED = re.compile(
    rf"[{SIGNS}][^\W\d_]|[^\W\d_][{SIGNS}]|([^\W\d_])\1|\A[{SIGNS}]{{3,}}\Z"
)
ROW_OF_SIGNS = re.compile(rf"([{SIGNS}])\1+$|^([{SIGNS}])\2+")
LETTER = re.compile(r"[^\W\d_]")
# Three or more single characters set apart by white space or joiners.
APART = re.compile(rf"[\s{re.escape(JOINERS)}]+")
SPACED = re.compile(
    rf"(?<![^\W_])(?:[^\W_]|[{SIGNS}])(?:{APART.pattern}(?:[^\W_]|[{SIGNS}])){{2,}}(?![^\W_])"
)


def _slot(gram: str) -> int:
    return crc32(gram.encode("utf-8", "replace")) & (SLOTS - 1)


class CharacterModel:
    """Probability of a character after the three before it, from hashed counts."""

    def __init__(self, grams: np.ndarray, contexts: np.ndarray):
        self.grams, self.contexts = grams, contexts
        self.known: dict[str, float] = {}
        self.logs: tuple[list, list] | None = None

    def __getstate__(self):
        """Tasks get the counts and take the logarithms themselves."""
        return {"grams": self.grams, "contexts": self.contexts, "known": {}, "logs": None}

    def cost(self, before: str, c: str) -> float:
        gram = before + c
        found = self.known.get(gram)
        if found is None:
            if self.logs is None:
                self.logs = (
                    np.log(self.grams.astype(float) + SMOOTHING / ALPHABET).tolist(),
                    np.log(self.contexts.astype(float) + SMOOTHING).tolist(),
                )
            # Where hashes collide a character may seem more than certain; its cost is 0 then.
            found = max(0.0, self.logs[1][_slot(before)] - self.logs[0][_slot(gram)])
            if len(self.known) >= 1 << 18:
                self.known.clear()
            self.known[gram] = found
        return found


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each character or run of a token, what it may stand for and at what cost."""
    out, i = [], 0
    while i < len(token):
        c, end = token[i], i + 1
        while end < len(token) and token[end] == c:
            end += 1
        run, letters = end - i, LOOK_ALIKES.get(c)
        if c in JOINERS:
            out.append([(" ", 0.0), ("", AS_LETTER)])
        elif letters is not None or not c.isalnum():
            options = [("", AS_NOTHING), (c * run, AS_ITSELF * run)]
            options += [(x, AS_LETTER) for x in letters or ""]
            options += [(x * 2, AS_LETTER * 2) for x in letters or "" if run == 2]
            out.append(options)
        elif run >= 3:
            out.append([(c, CUT_TO_ONE), (c * 2, CUT_TO_TWO), (c * run, 0.0)])
        elif run == 2 and c.isalpha():
            out.append([(c, CUT_PAIR), (c * 2, 0.0)])
        else:
            out += [[(c, 0.0)]] * run
        i = end
    return out


def _walk(
    slots: list, state: str, model: CharacterModel, bound: float, beam: int | None = None
) -> dict[str, tuple[float, tuple]]:
    """States after the slots with the cost and path of the best way to each. Ways that must cost
    more than ``bound`` are left; with ``beam`` only so many of the cheapest states go on."""
    known, cost_of, keep, start = model.known, model.cost, 1 - ORDER, " " * (ORDER - 1)
    left = sum(min(channel for _, channel in options) for options in slots)
    states: dict[str, tuple[float, tuple]] = {state: (0.0, ())}
    for options in slots:
        left -= min(channel for _, channel in options)
        most = bound - left
        following: dict[str, tuple[float, tuple]] = {}
        for state, (cost, path) in states.items():
            for text, channel in options:
                now, total = state, cost + channel
                for c in text:
                    gram = now + c
                    step = known.get(gram)
                    total += cost_of(now, c) if step is None else step
                    now = start if c == " " else gram[keep:]
                if total > most:
                    continue
                best = following.get(now)
                if best is None or total < best[0]:
                    following[now] = (total, (path, text))
        states = following
        if beam is not None and len(states) > beam:
            cheapest = sorted(states.items(), key=lambda s: s[1][0])[:beam]
            states = dict(cheapest)
    return states


def decode(token: str, model: CharacterModel) -> str:
    """The likeliest text behind a token: Viterbi over its lattice, states the last characters.

    Characters before the first choice, and those that follow when the last choice has left the
    states, weigh on all paths alike and are not looked up.
    """
    slots = [*lattice(token), [(" ", 0.0)]]
    choices = [i for i, options in enumerate(slots) if len(options) > 1]
    if not choices:
        return "".join(options[0][0] for options in slots).strip()
    start = " " * (ORDER - 1)
    first, end = choices[0], choices[-1] + ORDER
    before = "".join(options[0][0] for options in slots[:first])
    state = (start + before)[1 - ORDER :]
    bound = float("inf")
    if len(choices) > BEAM:
        # Any path bounds the best one, and a few states per slot find a good one.
        tried = _walk(slots[first:end], state, model, bound, beam=BEAM)
        bound = min(cost for cost, _ in tried.values()) + 1e-6
    states = _walk(slots[first:end], state, model, bound)
    path, out = min(states.values(), key=lambda s: s[0])[1], []
    while path:
        path, text = path
        out.append(text)
    after = "".join(options[0][0] for options in slots[end:])
    return (before + "".join(reversed(out)) + after).strip()


def stripped(token: str) -> str:
    """A token in small letters without what stands around its word."""
    plain = token.lower().rstrip(EDGE).lstrip(LEFT_EDGE)
    if plain and (plain[0] in LOOK_ALIKES or plain[-1] in LOOK_ALIKES):
        plain = ROW_OF_SIGNS.sub("", plain) or plain
    return plain


def decoded_words(plain: str, model: CharacterModel) -> list[str]:
    """Words behind a ``stripped`` token that looks disguised."""
    return [w.strip(EDGE) for w in decode(plain, model).split() if LETTER.search(w)]


def written_words(plain: str) -> list[str]:
    """The word of a ``stripped`` token in which nothing looks disguised."""
    if plain.isalpha():
        return [plain]
    return [plain.strip(EDGE)] if LETTER.search(plain) else []


def restored(token: str, model: CharacterModel) -> list[str]:
    """Words behind one token between white space."""
    plain = stripped(token)
    return decoded_words(plain, model) if DISGUISED.search(plain) else written_words(plain)


def _together(match: re.Match, model: CharacterModel) -> str:
    """The likeliest text behind characters that are set apart."""
    return decode(APART.sub(" ", match[0].lower()), model)


def restored_text(text: str, model: CharacterModel) -> str:
    """The whole text with its disguised words restored, one space between words."""
    joined = SPACED.sub(lambda m: _together(m, model), text)
    return " ".join(w for t in joined.split() for w in restored(t, model))


def features(word: str) -> list[str]:
    """A word, and how it begins."""
    if len(word) < 3:
        return []
    out = [word]
    for n in PREFIXES:
        if len(word) >= n:
            out.append("^" + word[:n])
    return out


class DocumentWords:
    """Features of whole texts; what a token gives is kept for the next time it occurs, and so is
    what a decoded word gives, which stands in other tokens with other signs around it."""

    def __init__(self, model: CharacterModel, wanted: dict[str, int] | None = None):
        self.model, self.wanted = model, wanted
        self.known: dict[str, tuple] = {}
        self.plain: dict[str, tuple] = {}

    def _behind(self, token: str) -> tuple:
        plain = stripped(token)
        found = self.plain.get(plain)
        if found is not None:
            return found
        if not DISGUISED.search(plain):
            return self._wanted(written_words(plain))
        found = self._wanted(decoded_words(plain, self.model))
        if len(self.plain) >= CACHED_DECODED:
            self.plain.clear()
        self.plain[plain] = found
        return found

    def of(self, text: str | None) -> set:
        out: set = set()
        known = self.known
        for token in set((text or "").split()):
            found = known.get(token)
            if found is None:
                found = self._behind(token)
                if len(known) >= CACHED_TOKENS:
                    known.clear()
                known[token] = found
            if found:
                out.update(found)
        for match in SPACED.finditer(text or ""):
            for token in _together(match, self.model).split():
                out.update(self._behind(token))
        return out

    def _wanted(self, words: list[str]) -> tuple:
        if self.wanted is None:
            return tuple(f for w in words for f in features(w))
        number, out = self.wanted.get, []
        for word in words:
            for f in features(word):
                at = number(f)
                if at is not None:
                    out.append(at)
        return tuple(out)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: hashed counts of the characters' contexts and successors in counted words."""
    counts = np.zeros(2 * SLOTS)
    for batch in batches:
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            padded = " " * (ORDER - 1) + word + " "
            for i in range(len(word) + 1):
                counts[_slot(padded[i : i + ORDER])] += n
                counts[SLOTS + _slot(padded[i : i + ORDER - 1])] += n
    slots = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(slots, pa.int64()), pa.array(counts[slots].astype(np.int64), pa.int64())],
        ["slot", "n"],
    )


def character_model(docs: DataFrame, text: str = "text") -> CharacterModel:
    """Language model from every word of every document.

    Words are counted over the whole corpus first, so the gathered vocabulary grows with it; the
    model itself is two tables of ``SLOTS`` counts, whatever the corpus.
    """
    word = F.explode(F.split(F.lower(whole_text(text)), r"[^\p{L}]+"))
    words = docs.select(word.alias("word")).where("word != ''")
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    slots = counted.mapInArrow(_count_grams, "slot bigint, n bigint").groupBy("slot").agg(
        F.sum("n").alias("n")
    )
    counts = np.zeros(2 * SLOTS)
    for batch in slots.toArrow().to_batches():
        counts[batch.column("slot").to_numpy()] = batch.column("n").to_numpy()
    return CharacterModel(counts[:SLOTS].astype(np.float32), counts[SLOTS:].astype(np.float32))


def training_rows(labels: DataFrame, key: str = "doc_id", label: str = "toxic") -> DataFrame:
    """``doc_id`` and ``toxic`` of at most ``MAX_LABELLED`` labelled ids, the first by their hash
    among those that are not held out. Null ids and labels teach nothing; an id with several labels
    is toxic if one of them says so."""
    known = labels.select(F.col(key).alias("doc_id"), F.col(label).cast("int").alias("toxic"))
    known = known.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out("doc_id"))
    one = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)


def held_out(key: str):
    """Whether a row is never learned from."""
    return F.coalesce(
        F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False)
    )


def _fit(rows: list[list[int]], toxic: np.ndarray, n: int) -> tuple[np.ndarray, float]:
    """Logistic regression on binary features by gradient steps with momentum."""
    at = np.array([f for r in rows for f in r], np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    weights, speed = np.zeros(n + 1), np.zeros(n + 1)
    scale = np.zeros(n + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(row, weights[at], len(rows)) + weights[n]
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic
        slope = np.append(np.bincount(at, error[row], n), error.sum()) / len(rows)
        slope[:n] += RIDGE * weights[:n]
        speed = 0.9 * speed + 0.1 * slope
        scale = 0.999 * scale + 0.001 * slope**2
        weights -= RATE * (speed / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.999**step)) + 1e-8)
    return weights[:n], float(weights[n])


class Scorer:
    """What scores a text: the language model, the features' weights and the bias."""

    def __init__(self, model: CharacterModel, names: list[str], weights, bias: float):
        self.model, self.names, self.weights, self.bias = model, names, weights, bias

    def judged(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        """A task's batches with the scores of their texts."""
        words = DocumentWords(self.model, {f: i for i, f in enumerate(self.names)})
        for batch in batches:
            scores = []
            for text in batch.column("text"):
                found = sorted(words.of(text.as_py()))
                z = self.bias + float(self.weights[found].sum()) if found else self.bias
                scores.append(1 / (1 + exp(-max(-30.0, min(30.0, z)))))
            yield batch, np.array(scores, float)

    def task(self, passed: str):
        """Task: ``passed`` and the score of each row's text."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, scores in released(self.judged(batches)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(passed), pa.array(scores)], [passed, "score"]
                )

        return run


def fit(docs: DataFrame, labels: DataFrame) -> Scorer:
    """Learn a scorer: the language model from all of ``docs``, the weights from labelled rows.

    Candidate features are those that ``MIN_TOXIC_DOCS`` toxic documents or more have and whose
    documents are toxic for the most part; they are counted by Spark. The weights are fitted on
    the driver: at most ``MAX_LABELLED`` rows of candidate features. Of rows that repeat a labelled
    id the least text teaches. Without labelled rows, or
    without toxic ones, every text scores near 0.
    """
    model = character_model(docs)
    sample = stage(training_rows(labels))
    # One text for each labelled id, so that repeated ids bring no more rows than the sample has.
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(
        F.min(whole_text()).alias("text"), F.max("toxic").alias("toxic")
    )

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = DocumentWords(model)
        for batch in batches:
            found = [sorted(words.of(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"),
                 pa.array(found, pa.list_(pa.string()))],
                ["doc_id", "toxic", "features"],
            )

    seen = stage(texts.mapInArrow(lambda b: released(every(b)), "doc_id bigint, toxic int, features array<string>"))
    counted = seen.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(
        F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("docs")
    ).where(f"toxic >= {MIN_TOXIC_DOCS} AND toxic >= {MIN_TOXIC_SHARE} * docs")
    names = [r["f"] for r in counted.orderBy(F.desc("toxic"), "docs", "f").collect()]
    wanted = {f: i for i, f in enumerate(names)}

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                sorted(wanted[f] for f in row if f in wanted)
                for row in batch.column("features").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"),
                 pa.array(found, pa.list_(pa.int32()))],
                ["doc_id", "toxic", "features"],
            )

    rows = seen.mapInArrow(candidates, "doc_id bigint, toxic int, features array<int>")
    rows = rows.toArrow().sort_by("doc_id")
    toxic = np.array(rows.column("toxic").to_pylist(), float)
    if not len(toxic):
        return Scorer(model, [], np.zeros(0), -30.0)
    weights, bias = _fit(rows.column("features").to_pylist(), toxic, len(names))
    return Scorer(model, names, weights, bias)


def score(docs: DataFrame, scorer: Scorer, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``score`` (0 to 1, higher: likelier toxic) of each row.

    Only the text is an input. Null and empty texts get the score of a text without any feature,
    rows may repeat, ids may be null, other columns are left out, no rows give no rows.
    """
    read = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    found = read.mapInArrow(scorer.task("doc_id"), "doc_id bigint, score double")
    return found.withColumnRenamed("doc_id", key)


def op2_noisy_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity."""
    docs = table(spark, sf_dir, "documents")
    scorer = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, scorer).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose text scores below ``THRESHOLD``, with their own columns."""
    scorer = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, scores in released(scorer.judged(batches)):
            yield batch.filter(pa.array(scores < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
