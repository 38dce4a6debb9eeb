import random
import re
from hashlib import sha256

import numpy as np
import pytest

from medalake.llm import suffixes

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items):
    w, hit, found, places = words(text), set(), set(), {}
    for id_, item in items:
        v = words(item)
        span = min(13, len(v))
        if span and span not in places:
            places[span] = {}
            for k in range(len(w) - span + 1):
                places[span].setdefault(tuple(w[k : k + span]), []).append(k)
        for i in range(len(v) - span + 1) if v else ():
            for k in places[span].get(tuple(v[i : i + span]), ()):
                hit.update(range(k, k + span))
                found.add(id_)
    return len(w), len(hit), sorted("null" if x is None else str(x) for x in found)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(9)
    vocab = ["a", "b", "é", "word", "x1", "中文"]
    long = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(long(rng.choice([20, 40, 13, 12])))) for i in range(12)]
    items += [(12, "Only TWO"), (13, ""), (14, None), (None, "null id words here"), (3, items[3][1])]
    docs = [(i, " ".join(long(rng.randrange(0, 60)))) for i in range(40)]
    for i in range(40, 70):
        w = words(rng.choice(items)[1])
        cut = w[rng.randrange(3) :]
        docs.append((i, ", ".join(long(rng.randrange(30)) + cut + long(rng.randrange(30)))))
    docs += [(None, items[0][1].upper()), (70, None), (70, None), (71, "only two"), (72, "!?"),
             (73, "a " * 4000), (74, "null id words here " * 3)]
    return docs, items


@pytest.mark.parametrize("shard", [1 << 20, 50])
def test_hits_against_brute_force(frame, data, monkeypatch, shard):
    docs, items = data
    monkeypatch.setattr(suffixes, "SHARD_WORDS", shard)
    got = suffixes.contamination(frame(docs, DOCS), frame(items, ITEMS)).collect()
    want = [(d, *brute(t, items)) for d, t in docs]
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got], key=repr) == sorted(
        want, key=repr
    )
    for r in got:
        assert r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words)


def test_benchmark_in_many_blocks(frame, data, monkeypatch):
    docs, items = data
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 200)
    got = suffixes.contamination(frame(docs, DOCS), frame(items, ITEMS)).collect()
    want = [(d, *brute(t, items)) for d, t in docs]
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got], key=repr) == sorted(
        want, key=repr
    )


def test_suffix_array_orders_suffixes():
    rng = np.random.default_rng(2)
    flat = np.concatenate([rng.integers(0, 3, 400), np.zeros(100, np.int64)])
    places = suffixes.suffix_array(flat, 400, 13, 2)
    keys = [tuple(flat[p : p + 13]) for p in places]

    def until_unknown(key):
        return key[: key.index(0)] if 0 in key else key

    assert [until_unknown(k) for k in keys] == sorted(until_unknown(k) for k in keys)
    assert len(places) == (flat[:400] > 0).sum()


def test_longest_matches(frame):
    item = " ".join(f"t{i}" for i in range(30))
    docs = [(1, "x " + " ".join(f"t{i}" for i in range(5, 25)) + " y"), (2, item)]
    got = {
        r.item_word: (r.doc_id, r.doc_word, r.length) for r in
        suffixes.longest_matches(frame(docs, DOCS), frame([(7, item)], ITEMS)).collect()
    }
    assert got == {k: (2, k, 30 - k) for k in range(18)}


def test_cleaning_and_empty_tables(frame, data):
    docs, items = data
    df = frame(docs, DOCS)
    kept = suffixes.clean_documents(df, frame(items, ITEMS))
    want = sum(not (h and 20 * h >= n) for n, h, _ in (brute(t, items) for _, t in docs))
    assert kept.columns == df.columns and kept.count() == want
    assert suffixes.contamination(frame([], DOCS), frame(items, ITEMS)).count() == 0
    none = suffixes.contamination(df, frame([], ITEMS))
    assert none.where("n_hit > 0").count() == 0 and none.count() == len(docs)
    assert sha256(b"").hexdigest().startswith("e3b0")
