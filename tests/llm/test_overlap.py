import itertools
import random

import numpy as np
import pytest

from medalake.llm import overlap
from medalake.llm.shingles import shingle_sets

SCHEMA = "doc_id bigint, text string"


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in low.replace("\n", " ").replace("\t", " ").split(" ") if x]
    return {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set()


@pytest.fixture(scope="module")
def rows():
    """Families of near copies, exact copies, short, empty and repeated rows, null ids."""
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(200)]
    base = [[rng.choice(vocab) for _ in range(rng.choice([3, 40, 60]))] for _ in range(6)]
    out = []
    for i in range(140):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        out.append((i if i % 17 else None, " ".join(w[: len(w) - rng.choice([0, 0, 3])] or w)))
    return out + [
        (900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "A  b"), (905, "a b c"),
        (903, "a b"), (910, "z " * 3000),
    ]


@pytest.fixture(scope="module")
def brute(rows):
    sets, n = [shingles(t) for _, t in rows], len(rows)
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(n), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 85 * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    roots = [root(i) for i in range(n)]
    ids = {}
    for (id_, _), r in zip(rows, roots):
        ids[r] = min((x for x in (ids.get(r), id_) if x is not None), default=None)
    return [(rows[i][0], len(sets[i]), ids[roots[i]]) for i in range(n)], len(ids)


@pytest.mark.parametrize("group", [128, 6])
def test_components_against_all_pairs(frame, rows, brute, monkeypatch, group):
    """Whatever the size of search groups; with 6, families are cut into bands and blocks."""
    monkeypatch.setattr(overlap, "GROUP", group)
    got = overlap.similar_documents(frame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute[0], key=repr)


def near_copies(n, families=1, seed=5):
    """Texts of a few families, each text a few words away from its family's first."""
    rng = random.Random(seed)
    out = []
    for f in range(families):
        base = [f"f{f}w{k}" for k in range(200)]
        for i in range(n // families):
            w = list(base)
            for _ in range(2):
                w[rng.randrange(200)] = f"x{i}y{rng.randrange(99)}"
            out.append(" ".join(w))
    return list(enumerate(out))


@pytest.mark.parametrize("families", [1, 2])
def test_hot_groups_grow_in_proportion(frame, monkeypatch, families):
    """Rows into groups and edges of near copies double with their number."""
    seen = []
    real = overlap._edges

    def counted(groups, texts):
        edges = real(groups, texts)
        seen[-1][0] += groups.count()
        seen[-1][1] += edges.count()
        return edges

    monkeypatch.setattr(overlap, "_edges", counted)
    monkeypatch.setattr(overlap, "GROUP", 32)
    for n in (96 * families, 192 * families, 384 * families):
        seen.append([0, 0])
        rows = near_copies(n, families)
        got = overlap.similar_documents(frame(rows, SCHEMA)).collect()
        size = n // families
        assert {r.component_id for r in got} == {f * size for f in range(families)}
    for (rows, edges), (more_rows, more_edges) in zip(seen, seen[1:]):
        assert more_rows <= 2.3 * rows and more_edges <= 2.3 * edges


def test_second_search_joins_what_the_first_left(frame, monkeypatch):
    """A chain of texts, each linked with the next ones only, in many blocks."""
    monkeypatch.setattr(overlap, "GROUP", 4)
    words = [f"v{k}" for k in range(400)]
    rows = [(i, " ".join(words[i : i + 60])) for i in range(0, 120, 2)]
    rows += [(1000 + i, " ".join(words[i : i + 60])) for i in range(200, 320, 20)]
    calls = []
    real = overlap._second_groups
    monkeypatch.setattr(overlap, "_second_groups", lambda *a: calls.append(1) or real(*a))
    got = {r.doc_id: r.component_id for r in overlap.similar_documents(frame(rows, SCHEMA)).collect()}
    assert calls and got == {i: 0 if i < 1000 else i for i, _ in rows}


def test_chunks_do_not_matter(frame, rows, brute, monkeypatch):
    monkeypatch.setattr(overlap, "CHUNK_SHINGLES", 100)
    monkeypatch.setattr(overlap, "COMMON_IN_CHUNK", 1)
    got = overlap.similar_documents(frame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute[0], key=repr)


def test_one_of_each_class_stays(frame, rows, brute):
    df = frame(rows, SCHEMA)
    kept = overlap.one_per_class(df)
    # Repeated rows of an id and its text are one document, so both of them stay.
    assert kept.columns == df.columns and kept.count() == brute[1] + 1


def test_empty_table(frame):
    assert overlap.similar_documents(frame([], SCHEMA)).count() == 0


def test_divide_skip_between_two_sides():
    texts = [f"{' '.join(f'v{k}' for k in range(50))} end{i}".encode() for i in range(6)]
    sets = shingle_sets(texts, 4)
    assert len(list(overlap.divide_skip(sets))) == 15
    assert len(list(overlap.divide_skip(sets, [0, 0, 0, 1, 1, 1]))) == 9
    assert len(list(overlap.divide_skip(sets, None, [0, 0, 0, 0, 1, 2]))) == 9
    assert len(list(overlap.divide_skip(sets, [0, 0, 0, 1, 1, 1], [0, 1, 2, 0, 1, 2]))) == 6


def test_shingles_of_long_texts_in_slices(monkeypatch):
    from medalake.llm import shingles as sh

    text = " ".join(str(i % 977) for i in range(5000)).encode()
    (whole,) = sh.shingle_sets([text], 4)
    monkeypatch.setattr(sh, "SLICE_WORDS", 64)
    monkeypatch.setattr(sh, "BLOCK_BYTES", 512)
    (cut,) = sh.shingle_sets([text], 4)
    assert np.array_equal(whole, cut) and len(cut) == len(shingles(text.decode()))
    huge = b"q" * (3 << 20)
    assert len(sh.shingle_sets([huge, b"a " + huge], 4)[1]) == 1
