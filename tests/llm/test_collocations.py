import random
import re
from collections import Counter

import numpy as np
import pytest

from medalake.llm import collocations

SCHEMA = "doc_id bigint, text string, lang string, phrase int, n string, word int, part string"


def docs(spark, rows, parts=3):
    return spark.createDataFrame([(i, *r, 1, "x", 2, "y") for i, r in enumerate(rows)], SCHEMA).repartition(parts)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(rows, longest=3, least=10, top=2000):
    counts = Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            words = re.findall("[^\x20\x09]+", piece)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts["und" if lang is None else lang, tuple(words[i : i + size])] += 1
    found = {}
    for (lang, p), a in counts.items():
        if len(p) < 2 or a < least:
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = counts[lang, p[:k]], counts[lang, p[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        found[lang, p] = (a, *min(cuts))
    held = set()
    for (lang, p), (a, *_) in found.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                inner = p[i : i + size]
                if 100 * a >= 50 * counts[lang, inner]:
                    held.add((lang, inner))
    out = []
    for lang in {lang for lang, _ in found}:
        n = sum(c for (x, p), c in counts.items() if x == lang and len(p) == 1)
        mine = [
            (-score, -a, " ".join(p).encode(), left, right)
            for (x, p), (a, score, _, left, right) in found.items() if x == lang and (x, p) not in held
        ]
        for rank, (score, a, phrase, left, right) in enumerate(sorted(mine)[:top], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def mined(df, **kw):
    return sorted(map(tuple, collocations.collocations(df, **kw).collect()))


def prose(seed, n=150):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)] + ["É", "ß,", "end.", "tab\tin", "a\x00b", " ", "(x)"]
    weights = [40 / (i + 1) for i in range(len(vocab))]
    rows = []
    for _ in range(n):
        words = rng.choices(vocab, weights, k=rng.randint(0, 60))
        if rng.random() < 0.4:
            words[len(words) // 2 : len(words) // 2] = ["New", "york", "CITY"]
        rows.append((" ".join(words), rng.choice(["en", "en", "fr", None, "und"])))
    return rows


ODD = [
    (None, "en"), ("", "en"), (" \t ", None), (".,;:!?", "en"), ("\n\x0b\x0c\r", "fr"), ("x " * 5000, "en"),
    ("same pair " * 40, "en"), ("İ ß Ω " * 12, ""), ("one", "only"),
]


@pytest.mark.parametrize("budget", [None, 1, 50, 100_000])
def test_against_brute_force(spark, budget):
    """Whatever the budget, so with no heavy prefixes, heavy words, and heavy pairs."""
    rows = prose(1) + ODD
    want = brute(rows)
    assert len(want) > 70 and {r[0] for r in want} >= {"en", "fr", "und", ""}
    assert mined(docs(spark, rows), budget=budget) == want


@pytest.mark.parametrize("longest", [2, 4])
def test_other_lengths(spark, longest):
    rows = prose(2, 80)
    want = brute(rows, longest=longest, least=5)
    assert mined(docs(spark, rows), max_words=longest, min_count=5, budget=60) == want


def test_top_rows_and_ties(spark):
    """Many phrases of one score: the higher count, then the byte order decides."""
    pairs = [f"a{i} b{i}" for i in range(40)] + ["é z", "z é", "~ x"]
    rows = [(". ".join(pairs * 10), "en"), (pairs[7] + ". " + pairs[9], "en")]
    assert mined(docs(spark, rows), top=7) == brute(rows, top=7)


def test_chunks_do_not_matter(spark, monkeypatch):
    rows = prose(3, 60)
    read = collocations.read_words([t.encode() for t, _ in rows], [x or "und" for _, x in rows], 0)
    parts = [collocations.read_words([t.encode()], [x or "und"], 0) for t, x in rows]
    assert sum(len(p.words) for p in parts) == len(read.words)
    assert np.concatenate([p.left for p in parts]).tolist() == read.left.tolist()
    assert np.concatenate([p.codes[p.words] for p in parts]).tolist() == read.codes[read.words].tolist()


def test_prefixes_are_divided_by_the_budget(spark):
    rows = prose(4)
    texts = docs(spark, rows).selectExpr("coalesce(lang, 'und') lang", "text")
    words, seed = collocations._words(texts)
    groups = collocations.vertical_partition(texts, words, seed, 3, 100)
    counts = {r.code & (1 << 64) - 1: r.n for r in words.collect()}
    assert set(groups.heavy[0].tolist()) == {c for c, n in counts.items() if n > 100}
    # Words within the budget that share a group fit into it together, but for the last one.
    load = Counter()
    for c, n in counts.items():
        if n <= 100:
            load[int(groups.of(np.array([[c, 0, 0]], np.uint64), np.array([1]))[0])] += n
    assert max(load.values()) <= 200 and len(load) > 5


def test_words_that_share_a_code_get_another_seed(spark, monkeypatch):
    real = collocations._code
    monkeypatch.setattr(collocations, "_code", lambda lang, w, seed: 5 if seed == 0 else real(lang, w, seed))
    read = collocations.read_words([b"a b"], ["en"], 0)
    assert read.codes.tolist() == [5, 5]
    assert len(set(collocations.read_words([b"a b"], ["en"], 1).codes.tolist())) == 2


def test_empty_table(spark):
    assert mined(docs(spark, [], 1)) == []
    assert mined(docs(spark, [(None, None), ("x", "en")], 1)) == []


def test_exact_scores_beyond_64_bits(spark):
    words = spark.createDataFrame(
        [("en", b"a", 1, 10**14), ("en", b"b", 2, 10**14 + 7)], collocations.WORD_SCHEMA
    )
    pair = (1).to_bytes(8, "big") + (2).to_bytes(8, "big")
    a = 10**14 - 3
    phrases = spark.createDataFrame([(bytearray(pair), a)], collocations.COUNT_SCHEMA)
    (row,) = collocations._scored(words, phrases).collect()
    assert row.score == 10**6 * a * a // (10**14 * (10**14 + 7))
