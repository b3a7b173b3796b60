"""Toxicity: entries, label model, classifier, held-out results."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from milepost.llm import queries, toxicity
from tests.llm.conftest import EDGE
from tests.llm.test_models import labels_frame


def test_entries_of_a_word():
    found = toxicity.Vocabulary(["Éclair! clowns, clown's x", "", "clown"])
    assert found.counts.tolist() == [5, 0, 1]
    words = toxicity.Words(["éclair".encode(), b"clown", b"clo", b"lown"])
    entries, good = toxicity.entries_of(words.buf, words.start, words.end)
    kinds = toxicity.kinds()
    start3, start5, end4 = kinds.index("start"), kinds.index("start") + 2, kinds.index("end")
    whole = toxicity.xxh64(words.buf, words.start, words.end - words.start, 13)
    assert entries[1, start3] == whole[2] and good[2, start3] and not good[2, start3 + 1]  # the start of a word is that word
    assert good[:, start5].tolist() == [True, True, False, False]
    assert entries[1, end4] == toxicity.xxh64(words.buf, words.start, words.end - words.start, 24)[3]


def test_signs():
    got = toxicity.signs([b"f**k this", b"hey!! you", b"fine * & fine", b"", "é## !".encode()])
    assert got.tolist() == [[True, False], [False, True], [False, False], [False, False], [True, False]]


def test_edges(spark, edge, nothing):
    labels = labels_frame(spark, [(d, 0, k % 2) for k, (d, *_) in enumerate(EDGE)] + [(1, 0, None), (None, 0, 1), (999, 1, 1)])
    got = toxicity.classify(edge, labels).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert len({r.score for r in got if r.doc_id == 10}) == 1
    assert toxicity.classify(nothing, labels).count() == 0
    assert {r.score for r in toxicity.classify(edge, labels.limit(0)).collect()} == {0.5}
    alone = toxicity.classify(edge, labels.withColumn("toxic", F.lit(0))).collect()
    assert len({r.score for r in alone}) == 1 and alone[0].score < 0.5


def test_label_model_finds_accuracies_and_copies():
    """Voters of known accuracy, three copies of one, and labels that are wrong one time in ten."""
    r = np.random.default_rng(3)
    n = 6000
    y = r.random(n) < 0.3
    right = [0.95, 0.85, 0.7, 0.6]
    said = [np.where(r.random(n) < p, y, ~y) for p in right]
    said += [np.where(r.random(n) < 0.98, said[3], ~said[3]) for _ in range(2)]
    votes = np.where(np.column_stack(said), toxicity.TOXIC, toxicity.CLEAN)
    votes[r.random(votes.shape) < 0.1] = toxicity.ABSTAIN
    labels = np.where(r.random(n) < 0.9, y, ~y).astype(np.int64)
    labels[r.random(n) < 0.5] = -1
    model, q = toxicity.fit_labels(votes, labels)
    assert np.abs(model.accuracies(votes, q)[:4] - right).max() < 0.04
    assert ((q > 0.5) == y).mean() > 0.95
    tree = {frozenset((k, p)) for k, p in enumerate(model.parents.tolist()) if p >= 0}
    assert len([e for e in tree if e <= {3, 4, 5}]) == 2
    strength = toxicity.dependence(votes, q)
    assert min(strength[3, 4], strength[3, 5]) > 10 * strength[:3, :3].max()
    alone = model.label_errors
    assert abs(alone[1, 1] - 0.9) < 0.05 and abs(alone[0, 0] - 0.9) < 0.05


def test_learns_new_words_and_their_starts(spark, make_docs):
    """A word that no list has, and a stem with endings that training never saw."""
    r = random.Random(5)
    plain = [f"{a}{b}" for a in "bdfglmnprst" for b in ("ana", "elo", "iri", "ume", "oto")]
    rows, marks = [], []
    for k in range(900):
        words = [r.choice(plain) for _ in range(30)]
        toxic = k % 4 == 0
        if toxic:
            words[3] = f"quimbo{r.choice('abcdefgh')}{k}" if k % 8 else "zwarg"
        rows.append((k, " ".join(words)))
        marks.append((k, 1, int(toxic)))
    model = toxicity.train(make_docs(rows), labels_frame(spark, marks))
    new = ["bana quimboxyz elo", "bana zwarg elo", "bana elo", "ZWARG! quimbo-7", ""]
    score = model.score(new, [t.encode() for t in new])
    assert (score >= 0.5).tolist() == [True, True, False, True, False]


@pytest.mark.parametrize("sf", ["sf0.1"])
def test_held_out(spark, sf):
    """Most toxic documents are found, and clean ones are left alone (one label in twenty is noise)."""
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
    got = queries.op11_toxicity(spark, f"/root/testdata/{sf}").filter("held_out").join(labels, "doc_id")
    row = got.agg(
        F.count_if(F.expr("toxic = 1 AND predicted = 1 AND quality = 1")).alias("hit"), F.count_if(F.expr("toxic = 1 AND quality = 1")).alias("bad"),
        F.count_if(F.expr("toxic = 0 AND predicted = 1")).alias("wrong"), F.count_if(F.expr("toxic = 0")).alias("clean"),
    ).first()
    assert row.bad > 50 and row.hit >= 0.9 * row.bad and row.wrong <= 0.005 * row.clean
