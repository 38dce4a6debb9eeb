import random
import re
from collections import Counter
from math import log2, sqrt

import pytest

from medalake.llm import divergence

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def figures(text):
    text = text or ""
    words = re.findall(f"[^{SPACE}]+", text)
    lines, seen, repeated = text.split("\n"), set(), 0
    for line in lines:
        if re.search(f"[^{SPACE}]", line):
            repeated += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {
        k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1
        for k in (i, i + 1, i + 2)
    }
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered)
    )


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocab = ["the", "of", "and", "it", "Zug", "été", "naïve", "a", "1999", "end."]
    made = [
        " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 90))) for _ in range(60)
    ]
    return made + [
        None, "", " \n\t", "one", "a b c a b c", "x " * 5000, "l\nl\n \n \nl", "##$$ ||  <>  é",
        "a\x0bb\x0cc\x1cd", "same line\nsame line\r\nsame line", "a\n" * 200, "w" * 100_000,
    ]


def test_base_figures_row_by_row(frame, texts):
    rows = [(i, t, ["en", "de", None][i % 3]) for i, t in enumerate(texts)]
    got = {
        r.doc_id: r for r in
        divergence.judge(frame(rows, "doc_id bigint, text string, lang string")).collect()
    }
    for i, text in enumerate(texts):
        want, r = figures(text), got[i]
        assert tuple(r[c] for c in divergence.FIGURES) == want, (i, text[:60] if text else text)
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def js(p, q):
    out = 0.0
    for a, b in zip(p, q):
        out += a * log2(2 * a / (a + b)) if a else 0
        out += b * log2(2 * b / (a + b)) if b else 0
    return sqrt(max(0.0, out / 2))


def references(df):
    counted = divergence.language_words(df, "lang", "text")
    return divergence.language_references(counted, divergence.language_totals(counted))


def test_distances_against_references(frame):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(40)]
    plain = [" ".join(rng.choices(vocab, range(40, 0, -1), k=120)) for _ in range(40)]
    odd = " ".join(f"{w}###!!" for w in rng.choices(vocab, k=120))
    rows = [(i, t, "en") for i, t in enumerate(plain)] + [(99, odd, "en"), (100, plain[0], "xx")]
    df = frame(rows, "doc_id bigint, text string, lang string")
    (en,) = references(df).where("lang = 'en'").collect()
    words = Counter(w for i, t, lang in rows if lang == "en" for w in t.split())
    total = sum(words.values())
    assert en.common == [w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))][:24]
    got = {r.doc_id: r for r in divergence.judge(df).collect()}
    own = Counter(plain[0].split())
    p = [own[w] / 120 for w in en.common]
    q = [words[w] / total for w in en.common]
    assert got[0].word_distance == pytest.approx(js(p + [1 - sum(p)], q + [1 - sum(q)]), abs=1e-9)
    assert all(got[i].kept for i in range(40))
    assert not got[99].kept and not got[99].base_failed
    # A language with too little text has no common words, its classes are compared with all texts.
    assert got[100].kept and got[100].word_distance is None
    assert got[100].class_distance == pytest.approx(got[0].class_distance, abs=0.02)


def test_empty_table_and_clashing_columns(frame):
    schema = "doc_id bigint, text string, lang string"
    assert divergence.judge(frame([], schema)).count() == 0
    rows = [(1, "word " * 10, "en"), (1, "word " * 10, "en"), (None, None, None)]
    df = frame(rows, schema)
    assert divergence.judge(df).count() == 3
    assert divergence.filter_documents(df).columns == df.columns


def test_words_beyond_the_first_sixteen_count(frame):
    """Words 17 to 24 of a language are in its histogram: documents differ only there."""
    vocab = [f"w{i:02}" for i in range(24)] + [f"rare{i}" for i in range(24)]
    plain = " ".join(w for i, w in enumerate(vocab) for _ in range(60 - i if i < 24 else 1))
    odd = " ".join(w if w < "w16" else "other" for w in plain.split() if w[0] == "w")
    df = frame([(i, plain, "en") for i in range(9)] + [(9, odd, "en")], "doc_id bigint, text string, lang string")
    (en,) = references(df).collect()
    words = Counter(w for t in [plain] * 9 + [odd] for w in t.split())
    assert en.common == sorted(words, key=lambda w: (-words[w], w))[:24]
    got = {r.doc_id: r.word_distance for r in divergence.judge(df).collect()}
    total = sum(words.values())
    q = [words[w] / total for w in en.common]
    for key, text in ((0, plain), (9, odd)):
        own = Counter(text.split())
        p = [own[w] / sum(own.values()) for w in en.common]
        want = js(p + [1 - sum(p)], q + [1 - sum(q)])
        assert got[key] == pytest.approx(want, abs=1e-9)


def test_a_language_is_judged_alike_in_a_large_table(frame, monkeypatch):
    """A language of a thousandth of all words or less has its reference, by either join."""
    schema = "doc_id bigint, text string, lang string"
    rng = random.Random(2)
    plain = [" ".join(rng.choices([f"v{k}" for k in range(40)], k=120)) for _ in range(40)]
    rows = [(i, t, "xx") for i, t in enumerate(plain)] + [(99, "###!! " * 20 + plain[0], "xx")]
    large = frame(rows + [(200 + i, "the " * 100_000, "en") for i in range(60)], schema)
    langs = [r.lang for r in references(large).collect()]
    assert sorted(langs) == ["en", "xx"]
    want = {r.doc_id: r for r in divergence.judge(frame(rows, schema)).collect()}
    assert want[0].kept and not want[99].kept and not want[99].base_failed
    for size in (divergence.BROADCAST_BYTES, 0):
        monkeypatch.setattr(divergence, "BROADCAST_BYTES", size)
        got = divergence.judge(large).where("doc_id < 200").collect()
        assert {r.doc_id: r for r in got} == want


def classes(text):
    out = [0] * 5
    for c in "".join(text.split()):
        out[1 if c.isupper() else 2 if c in "0123456789" else 3 if c in ".,;:!?" else 0 if c.isalpha() else 4] += 1
    return out


def test_garbage_in_a_small_language_goes(spark, frame):
    """By the character classes of all documents, in the operator and in SQL alike."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(400)]
    vocab = [w.title() if i % 5 == 0 else w + ",.  "[i % 4].strip() for i, w in enumerate(words)]
    texts = [(i, " ".join(rng.choices(vocab, k=200)), "de") for i in range(30)]
    texts += [(50, " ".join(rng.choices(vocab[:200], k=90)), "br")]
    texts += [(51, " ".join(f"{rng.random()}|#{i}" for i in range(90)), "br")]
    texts += [(52, " ".join(f"%{i}&{i * i}>" for i in range(90)), None), (53, "too short", "xx")]
    df = frame(texts, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in divergence.judge(df).collect()}
    assert all(got[i].kept for i in range(30)) and got[50].kept
    for i in (51, 52):
        assert not got[i].kept and not got[i].base_failed and got[i].word_distance is None
    assert got[53].class_distance is None
    pool = [sum(c) for c in zip(*(classes(t) for _, t, _ in texts))]
    for i, text, _ in texts[30:33]:
        p, q = ([x / sum(h) for x in h] for h in (classes(text), pool))
        assert got[i].class_distance == pytest.approx(js(p, q), abs=1e-9)
    import duckdb
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    sql = {r[0]: r[-1] for r in con.execute(divergence.OP8_SQL).fetchall()}
    assert sql == {i: r.kept for i, r in got.items()}
