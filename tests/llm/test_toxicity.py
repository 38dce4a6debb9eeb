import random

import numpy as np
import pytest

from medalake.llm import toxicity

DOCS, LABELS = "doc_id bigint, text string", "doc_id bigint, quality int, toxic int"
INSULTS = ["idiot", "moron", "scum"]


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)
    vocab = ["the", "river", "stone", "garden", "window", "table", "mother", "idea", "motion", "scene"]
    docs, labels = [], []
    for i in range(400):
        w = rng.choices(vocab, k=rng.randrange(8, 30))
        toxic = i % 4 == 0
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(INSULTS)
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return docs, labels + [(None, 1, 1), (401, 1, None)]


@pytest.fixture(scope="module")
def scorer(spark, data):
    docs, labels = data
    return toxicity.fit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))


@pytest.mark.parametrize("hidden,plain", [
    ("1d10t", "idiot"), ("m0r0n", "moron"), ("$cum", "scum"), ("mooooron", "moron"),
    ("i.d.i.o.t", "idiot"), ("s c u m m", "scum"), ("IDIOT!!!", "idiot"), ("idiot###", "idiot"),
    ("the river", "the river"), ("r1v3r", "river"),
])
def test_restoration(scorer, hidden, plain):
    got = toxicity.restored_text(hidden, scorer.model)
    assert got == plain or (hidden == "s c u m m" and got in ("scum", "scumm"))


def _best(token, model):
    """Every path of the lattice, one by one."""
    paths = [(0.0, "")]
    for options in toxicity.lattice(token):
        paths = [(c + d, t + o) for c, t in paths for o, d in options]
    start, best = " " * (toxicity.ORDER - 1), None
    for cost, text in paths:
        now = start
        for c in text + " ":
            cost += model.cost(now, c)
            now = start if c == " " else (now + c)[1 - toxicity.ORDER :]
        if best is None or cost < best[0] - 1e-9:
            best = (cost, text)
    return best[1].strip()


@pytest.mark.parametrize("token", ["1d10t", "5c4m", "w1nd0w", "g4rd3n", "a.b.c.d", "rrriver", "m0+10n"])
def test_viterbi_finds_the_best_path(scorer, token):
    assert toxicity.decode(token, scorer.model) == _best(token, scorer.model)


def test_held_out_accuracy(spark, frame, data, scorer):
    docs, labels = data
    got = toxicity.score(frame(docs, DOCS), scorer).withColumn(
        "held_out", toxicity.held_out("doc_id")
    ).collect()
    truth = {i: y for i, _, y in labels}
    held = [r for r in got if r.held_out]
    assert len(held) > 100
    assert all((r.score >= toxicity.THRESHOLD) == bool(truth[r.doc_id]) for r in held)


def test_hidden_words_score_like_plain_ones(frame, scorer):
    rows = [(1, "the river garden m0r0n table"), (2, "the river garden table"), (3, None), (4, ""),
            (None, "the s c u m of the garden"), (2, "the river garden table"),
            (5, "river " * 50_000 + "1diot")]
    got = [r.score for r in toxicity.score(frame(rows, DOCS), scorer).collect()]
    assert [s >= toxicity.THRESHOLD for s in got] == [True, False, False, False, True, False, True]
    assert got[2] == got[3] and 0 <= min(got) and max(got) <= 1


def test_labels_of_held_out_rows_teach_nothing(spark, data):
    docs, labels = data
    rows = toxicity.training_rows(spark.createDataFrame(labels, LABELS))
    assert rows.where(toxicity.held_out("doc_id")).count() == 0 and rows.count() > 200


def test_filter_and_empty_tables(spark, frame, data):
    docs, labels = data
    df = frame(docs, DOCS)
    kept = toxicity.drop_toxic(df, spark.createDataFrame(labels, LABELS))
    assert kept.columns == df.columns and kept.count() == 300
    nothing = toxicity.fit(frame([], DOCS), frame([], LABELS))
    assert toxicity.score(frame([], DOCS), nothing).count() == 0
    assert toxicity.score(df, nothing).where("score >= 0.5").count() == 0


def test_fit_is_a_logistic_regression():
    rng = np.random.default_rng(1)
    rows = [sorted(rng.choice(5, 2, replace=False).tolist()) for _ in range(300)]
    toxic = np.array([float(0 in r) for r in rows])
    weights, bias = toxicity._fit(rows, toxic, 5)
    z = np.array([weights[r].sum() + bias for r in rows])
    assert ((z > 0) == (toxic > 0)).all()


@pytest.mark.parametrize("hidden,plain", [
    ("idio7", "idiot"), ("scen3", "scene"), ("iiddiioott", "idiot"), ("mmoorroonn", "moron"),
    ("t h e", "the"), ("i  d  i  o  t", "idiot"), ("i\td\ti\to\tt", "idiot"), ("i\nd\ni\no\nt", "idiot"),
    ("i. d. i. o. t", "idiot"), ("74813", "table"), ("mo7her", "mother"), ("garden", "garden"),
])
def test_restoration_of_further_disguises(scorer, hidden, plain):
    assert toxicity.restored_text(hidden, scorer.model) == plain


def test_further_disguises_score_as_toxic(frame, scorer):
    rows = ["river idio7 garden", "river iiddiioott garden", "river i\td\ti\to\tt garden",
            "river s  c  u  m garden", "river 74813 garden"]
    got = toxicity.score(frame(list(enumerate(rows)), DOCS), scorer).orderBy("doc_id").collect()
    assert [r.score >= toxicity.THRESHOLD for r in got] == [True, True, True, True, False]


@pytest.mark.parametrize("seed", range(3))
def test_bounded_walk_finds_the_same_path(scorer, monkeypatch, seed):
    """Long lattices are bounded by a few states' walk first; that changes no result."""
    rng = random.Random(seed)
    tokens = ["".join(rng.choices("0123456789$!aioot", k=rng.randrange(9, 15))) for _ in range(12)]
    bounded = [toxicity.decode(t, scorer.model) for t in tokens]
    monkeypatch.setattr(toxicity, "BEAM", 1000)
    assert bounded == [toxicity.decode(t, scorer.model) for t in tokens]


def test_repeated_ids_and_labels(spark):
    """One text and one label for each labelled id, however often either is repeated."""
    docs = [(i, f"river {INSULTS[i % 3] if i % 4 == 0 else 'garden'} {i}") for i in range(200)]
    docs += [(4, None), (4, "zzz")] + [(8, "river moron again")] * 500
    labels = [(i, 1, int(i % 4 == 0)) for i in range(200)] + [(4, 1, 0), (8, 1, 1), (8, 1, 1)]
    rows = toxicity.training_rows(spark.createDataFrame(labels, LABELS)).collect()
    assert len(rows) == len({r.doc_id for r in rows}) and {r.toxic for r in rows if r.doc_id in (4, 8)} <= {1}
    scorer = toxicity.fit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert {"moron", "idiot", "scum"} <= set(scorer.names)
