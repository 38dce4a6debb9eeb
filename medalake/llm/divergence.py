"""Quality rules with distribution divergence, in SQL functions only.

Each language's reference comes from all its documents: the shares of five character classes and
of its most common words. A document is kept if both of its histograms are near the reference by
Jensen-Shannon distance, judged only where the text is long enough to have a histogram. Common words
say nothing across languages, character classes do: documents of a language of too few words are
judged by the character classes of all documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from medalake.llm.common import stage, table, whole_text

# The contract's white space and symbols.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
STOPS = ".,;:!?"
DIGITS = "0123456789"

COMMON_WORDS = 24
# A language needs this many words to have a reference of its own, but no share of all words, so
# that the rest of a table does not decide how a language is judged.
MIN_REFERENCE_WORDS = 2_000
# References are broadcast while all of them are smaller.
BROADCAST_BYTES = 32 << 20
# Below these lengths a histogram says nothing about its text.
MIN_CHARS = 200
MIN_WORDS = 50
MAX_CHAR_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.45
# Up to so many repeated windows, positions are found by membership instead of by sorting.
FEW_REPEATS = 12


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{SPACE}+", -1), "")


def _without(text: Column, characters: str) -> Column:
    """How many of the characters the text holds."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def uncommon_characters(text: Column) -> Column:
    """The text without white space and small letters: what the rarer classes are counted in."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D\p{L}&&[^\p{Lu}]]+", "")


def class_counts(uncommon: Column, n_chars: Column) -> Column:
    """Characters by class: small and other letters, capitals, digits, stops, the rest.

    ``uncommon`` is short, so that only one pass over the text is needed for all classes.
    """
    parts = F.struct(
        F.length(F.regexp_replace(uncommon, r"\P{Lu}+", "")).alias("capitals"),
        _without(uncommon, DIGITS).alias("digits"), _without(uncommon, STOPS).alias("stops"),
        F.length(uncommon).alias("uncommon"), n_chars.alias("n"),
    )
    return _let(parts, lambda p: F.array(
        p["n"] - p["uncommon"], p["capitals"], p["digits"], p["stops"],
        p["uncommon"] - p["capitals"] - p["digits"] - p["stops"],
    ))


def repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more.

    Windows are compared by 64-bit hashes. Texts without a repeat need no positions.
    """
    hashes = _let(words, lambda w: F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
    )).otherwise(F.array().cast("array<bigint>")))

    def by_membership(h: Column, repeats: Column) -> Column:
        at = F.transform(h, lambda x, i: F.when(F.array_contains(repeats, x), i))
        return F.array_compact(at)

    def by_sorting(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return _let(ranked, lambda z: F.array_compact(F.transform(z, lambda s, k: F.when(
            F.get(z, k - 1)["x"].eqNullSafe(s["x"]) | F.get(z, k + 1)["x"].eqNullSafe(s["x"]),
            s["i"],
        ))))

    def covered(at: Column) -> Column:
        return _let(at, lambda p: F.size(F.array_union(
            F.array_union(p, F.transform(p, lambda i: i + 1)), F.transform(p, lambda i: i + 2)
        )))

    def count(h: Column) -> Column:
        repeats = _let(F.sort_array(h), lambda s: F.array_distinct(
            F.array_compact(F.transform(s, lambda x, k: F.when(F.get(s, k - 1) == x, x)))
        ))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_let(
            repeats,
            lambda r: F.when(F.size(r) <= FEW_REPEATS, covered(by_membership(h, r)))
            .otherwise(covered(by_sorting(h))),
        ))

    return _let(hashes, count)


def divergence(counts: Column, shares: Column) -> Column:
    """Jensen-Shannon distance (0 to 1) of a histogram of counts from shares that add up to 1."""

    def half(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(x * 2 / (x + y))).otherwise(0.0)

    def term(p: Column, q: Column) -> Column:
        return half(p, q) + half(q, p)

    def of(c: Column, n: Column) -> Column:
        terms = F.zip_with(c, shares, lambda x, q: _let(x / n, lambda p: term(p, q)))
        return F.sqrt(F.greatest(
            F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, t: a + t) / 2
        ))

    def whole(c: Column) -> Column:
        total = F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x).cast("double")
        return _let(total, lambda n: F.when(n > 0, of(c, n)))

    return _let(counts, whole)


def common_counts(words: Column, common: Column) -> Column:
    """How often each common word occurs among ``words``, and last how many are others.

    One pass over the words leaves the common ones, which alone are counted word by word.
    """
    among = F.filter(words, lambda w: F.array_contains(common, w))
    hits = _let(among, lambda every: F.transform(
        common, lambda w: F.size(every) - F.size(F.array_remove(every, w))
    ))
    return _let(hits, lambda h: F.concat(h, F.array(
        F.size(words) - F.aggregate(h, F.lit(0), lambda a, c: a + c)
    )))


def language_words(df: DataFrame, lang: str, text: str) -> DataFrame:
    """How often each word occurs in each language: ``lang``, ``word``, ``n``.

    All documents count. A null language is a language of its own.
    """
    words = df.select(
        F.coalesce(F.col(lang), F.lit("")).alias("lang"),
        F.explode(words_of(whole_text(text))).alias("word"),
    )
    return words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


def language_totals(counted: DataFrame) -> DataFrame:
    """Words and characters by class of each language: ``lang``, ``words``, ``c0`` to ``c4``."""
    classes = class_counts(uncommon_characters(F.col("word")), F.length("word"))
    sums = [F.sum(F.col("n") * F.get("c", F.lit(k))).alias(f"c{k}") for k in range(5)]
    return counted.withColumn("c", classes).groupBy("lang").agg(F.sum("n").alias("words"), *sums)


def language_references(counted: DataFrame, totals: DataFrame) -> DataFrame:
    """One row for each language with enough text: ``lang``, shares of classes and common words.

    Common words are the first by number, ties go to the smaller word.
    """
    large = totals.where(f"words >= {MIN_REFERENCE_WORDS}")
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = counted.withColumn("rank", F.row_number().over(first)).where(f"rank <= {COMMON_WORDS}")
    top = top.groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("rank", "word", "n"))).alias("top")
    )
    chars = sum([F.col(f"c{k}") for k in range(1, 5)], F.col("c0"))
    share = lambda n, of: n.cast("double") / of
    others = F.col("words") - F.aggregate(
        "top", F.lit(0).cast("bigint"), lambda a, t: a + t["n"]
    )
    return large.join(top, "lang").select(
        "lang",
        F.array(*[share(F.col(f"c{k}"), chars) for k in range(5)]).alias("class_shares"),
        F.transform("top", lambda t: t["word"]).alias("common"),
        F.concat(
            F.transform("top", lambda t: share(t["n"], F.col("words"))),
            F.array(share(others, F.col("words"))),
        ).alias("word_shares"),
    )


def judge(
    df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Quality figures and verdict of each row.

    Args:
        df: documents; columns other than those named are left out. Rows may repeat, and each gets
            a row of its own; no rows give no rows.
        key, text, lang: a null key stays null, a null text is empty, a null language is one more.
        keep: columns to pass on unchanged; a clash with a figure's name is an error.

    Returns ``key``, ``keep``, the base figures, ``base_failed``, ``class_distance`` (null where
    the text is too short), ``word_distance`` (null also where its language has no reference) and
    ``kept``. Empty texts fail the base rules. A distance that is null rejects nothing. Without an
    own reference of its language, a document's character classes are compared with all documents.

    References are broadcast while all of them are smaller than ``BROADCAST_BYTES``; then a document
    needs no shuffle however its language is distributed. Beyond, documents and references meet in a
    join on the language, whose hot languages adaptive execution splits.
    """
    counted = stage(language_words(df, lang, text))
    totals = stage(language_totals(counted))
    pool = totals.agg(*[F.sum(f"c{k}").alias(f"c{k}") for k in range(5)]).first()
    characters = sum(c or 0 for c in pool)
    # Five numbers; without any character no document has a distance.
    pooled = F.array(*[F.lit((c or 0) / max(characters, 1)) for c in pool])
    references = stage(language_references(counted, totals))
    width = F.length("lang") + F.length(F.array_join("common", "")) + 32 * (COMMON_WORDS + 6)
    size = references.agg(F.sum(width).alias("n")).first()["n"] or 0
    references = references.withColumnRenamed("lang", "_lang")
    rows = df.select(
        key, *keep, F.coalesce(F.col(lang), F.lit("")).alias("_lang"),
        whole_text(text).alias("_text"), words_of(whole_text(text)).alias("_words"),
        uncommon_characters(whole_text(text)).alias("_uncommon"),
    ).join(F.broadcast(references) if size <= BROADCAST_BYTES else references, "_lang", "left")
    value = F.col("_text")
    word_chars = F.length(F.array_join("_words", ""))
    lines = F.filter(F.split(value, "\n", -1), lambda x: x.rlike(NOT_SPACE))
    figures = rows.select(
        key, *keep,
        F.size("_words").cast("bigint").alias("n_words"),
        word_chars.cast("bigint").alias("word_chars"),
        _without(F.col("_uncommon"), SYMBOLS).cast("bigint").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")
        .alias("n_dup_lines"),
        repeated_words(F.col("_words")).cast("bigint").alias("n_repeat_words"),
        F.when(F.length(value) >= MIN_CHARS, divergence(
            class_counts(F.col("_uncommon"), word_chars), F.coalesce("class_shares", pooled)
        )).alias("class_distance"),
        F.when(F.size("_words") >= MIN_WORDS, divergence(
            common_counts(F.col("_words"), F.col("common")), F.col("word_shares")
        )).alias("word_distance"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    near = (F.coalesce("class_distance", F.lit(0.0)) <= MAX_CHAR_DISTANCE) & (
        F.coalesce("word_distance", F.lit(0.0)) <= MAX_WORD_DISTANCE
    )
    # One condition, not a conjunction: a filter on it stays where the figures are at hand.
    return figures.withColumn("base_failed", failed).withColumn(
        "kept", F.when(F.col("base_failed"), False).otherwise(near)
    )


FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op8_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's figures and verdict."""
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", *FIGURES, "base_failed", "kept"
    )


def filter_documents(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that pass the rules, with their own columns."""
    whole = docs.select(
        F.col(text).alias("text"), F.col(lang).alias("lang"),
        F.struct(*[F.col(c) for c in docs.columns]).alias("document"),
    )
    return judge(whole, key="document").where("kept").select("document.*")


OP8_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{NOT_SPACE}+') AS w FROM documents
), parts AS (
  SELECT *, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    regexp_replace(t, '[\x20\x09-\x0D\p{{Ll}}\p{{Lt}}\p{{Lm}}\p{{Lo}}]+', '', 'g') AS u,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{NOT_SPACE}')) AS lines
  FROM docs
), classes AS (
  SELECT row, lang, unnest([1, 2, 3, 4, 5]) AS k, unnest([
    word_chars - length(u), caps, digits, stops, length(u) - caps - digits - stops]) AS c
  FROM (SELECT *, length(regexp_replace(u, '\P{{Lu}}+', '', 'g')) AS caps,
    length(u) - length(translate(u, '{DIGITS}', '')) AS digits,
    length(u) - length(translate(u, '{STOPS}', '')) AS stops FROM parts)
), windows AS (
  SELECT row, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1),
    lambda i: array_to_string(w[i:i + 2], ' '))) AS x FROM docs WHERE len(w) >= 3
), repeated AS (
  SELECT row, count(DISTINCT place) AS n FROM (
    SELECT row, unnest(range(i, i + 3)) AS place FROM windows
    QUALIFY count(*) OVER (PARTITION BY row, x) > 1) GROUP BY row
), counted AS (
  SELECT row, lang, word, count(*) AS n FROM (SELECT row, lang, unnest(w) AS word FROM docs)
  GROUP BY ALL
), vocabulary AS (SELECT lang, word, sum(n) AS n FROM counted GROUP BY ALL
), totals AS (
  SELECT lang, sum(n) AS words FROM vocabulary GROUP BY lang
  HAVING sum(n) >= {MIN_REFERENCE_WORDS}
), class_shares AS (
  SELECT lang, k, sum(c)::DOUBLE / sum(sum(c)) OVER (PARTITION BY lang) AS q
  FROM classes SEMI JOIN totals USING (lang) GROUP BY lang, k
), pool AS (
  SELECT k, sum(c)::DOUBLE / sum(sum(c)) OVER () AS q FROM classes GROUP BY k
), common AS (
  SELECT lang, word, n::DOUBLE / words AS q FROM vocabulary JOIN totals USING (lang)
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= {COMMON_WORDS}
), histograms AS (
  SELECT 'class' AS kind, row, q, c::DOUBLE / sum(c) OVER (PARTITION BY row) AS p
  FROM classes JOIN class_shares USING (lang, k) JOIN parts USING (row)
  WHERE length(t) >= {MIN_CHARS} AND word_chars > 0
  UNION ALL
  SELECT 'class', row, q, c::DOUBLE / sum(c) OVER (PARTITION BY row)
  FROM classes ANTI JOIN totals USING (lang) JOIN pool USING (k) JOIN parts USING (row)
  WHERE length(t) >= {MIN_CHARS} AND word_chars > 0
  UNION ALL
  SELECT 'word', row, q, coalesce(n, 0)::DOUBLE / n_words
  FROM parts JOIN common USING (lang) LEFT JOIN counted USING (row, word)
  WHERE n_words >= {MIN_WORDS}
), rest AS (
  SELECT 'word' AS kind, row, 1 - sum(q) AS q, 1 - sum(p) AS p FROM histograms
  WHERE kind = 'word' GROUP BY row
), distances AS (
  SELECT kind, row, sqrt(greatest(0, sum(
    CASE WHEN p > 1e-15 THEN p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 1e-15 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS d
  FROM (SELECT * FROM histograms UNION ALL SELECT kind, row, q, p FROM rest) GROUP BY ALL
), figures AS (
  SELECT parts.*, coalesce(r.n, 0) AS n_repeat_words, coalesce(c.d, 0) AS class_distance,
    coalesce(v.d, 0) AS word_distance
  FROM parts LEFT JOIN repeated r USING (row)
    LEFT JOIN distances c ON c.row = parts.row AND c.kind = 'class'
    LEFT JOIN distances v ON v.row = parts.row AND v.kind = 'word'
)
SELECT doc_id, n_words, word_chars, length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND class_distance <= {MAX_CHAR_DISTANCE} AND word_distance <= {MAX_WORD_DISTANCE} AS kept
FROM figures
"""
