"""Near duplicates of similarity 0.8 against brute force."""

import random

import numpy as np
import pytest

from milepost.llm import packing, similar
from tests.llm.conftest import EDGE
from tests.llm.test_texts import WORD, WORDS


def shingles(text):
    w = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components_of(rows):
    """The component of each row, by comparing each with each."""
    sets = [shingles(t) for _, t, *_ in rows]
    label = list(range(len(rows)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for k, a in enumerate(sets):
        for j, b in enumerate(sets[:k]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                label[root(k)] = root(j)
    return [root(k) for k in range(len(rows))]


def staying(rows):
    least = {}
    for (d, *_), k in zip(rows, components_of(rows)):
        if d is not None:
            least[k] = min(d, least.get(k, d))
    return sorted(least.values())


def edited(r, words, n):
    """A copy with ``n`` words replaced, far enough apart that each breaks five shingles."""
    out = list(words)
    for k in r.sample(range(len(words) // 10), n):
        out[10 * k + 5] = f"edit{r.randrange(10**6)}"
    return out


def copies(seed):
    """Texts with copies of similarities on both sides of 0.8, chains of copies, and short texts."""
    r = random.Random(seed)
    rows = []
    for _ in range(12):
        base = [f"v{r.randrange(5000)}" for _ in range(r.choice([60, 200, 700]))]
        rows.append(" ".join(base))
        for share in (0.02, 0.1, 0.2, 0.24, 0.3):
            rows.append(" ".join(edited(r, base, max(1, round(share / 2 * len(base) / 5)))))
        for _ in range(3):
            base = edited(r, base, max(1, len(base) // 50))
            rows.append(" ".join(base))
        rows.append(" ".join(base[:8]))
        rows.append(" ".join(base[:9]))
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("part", [1000, similar.PART])
def test_finds_near_copies(make_docs, monkeypatch, part):
    """Also with keys that are dealt out to many parts."""
    monkeypatch.setattr(similar, "PART", part)
    rows = copies(part)
    got = similar.drop_similar(make_docs(rows))
    want = staying(rows)
    assert sorted(r.doc_id for r in got.collect()) == want and 20 < len(want) < len(rows) - 30


def test_edges(spark, edge, nothing):
    left = similar.drop_similar(edge)
    assert left.columns == edge.columns and left.exceptAll(edge).count() == 0
    assert sorted(r.doc_id for r in left.collect()) == staying(EDGE) and left.count() == len(set(components_of(EDGE)))
    assert similar.drop_similar(nothing).count() == 0


def test_repeated_shingles_do_not_hide_a_copy(make_docs):
    """Sets are compared, so a shingle that one copy has a thousand times changes nothing."""
    text = " ".join(f"w{k}" for k in range(300))
    rows = [(1, text), (2, text + " so" * 1000), (3, "other " + " ".join(f"x{k}" for k in range(300)))]
    assert sorted(r.doc_id for r in similar.drop_similar(make_docs(rows)).collect()) == [1, 3]


def test_links_are_exact():
    """Sets that share keys and fingerprints but not enough shingles are no link."""
    sets = [np.arange(a, a + 100, dtype=np.uint64) for a in (0, 11, 12, 40)]
    links = similar.confirmed_links(np.zeros(4, np.uint64), sets, 80)
    assert {tuple(sorted(x)) for x in links} == {(0, 1), (1, 2)}


def test_no_sequence_holds_two_of_a_component(make_docs):
    """Near copies of different sources are kept apart by their cluster alone."""
    rows = [(d, t, f"source {d}") for d, t in copies(3)]
    component = {d: k for (d, *_), k in zip(rows, components_of(rows))}
    bins = {}
    for g in packing.pack_documents(make_docs(rows), WORDS).collect():
        bins.setdefault(g.bin_id, set()).add(g.doc_id)
    assert sum(map(len, bins.values())) == len(rows) and max(map(len, bins.values())) > 3
    for own in bins.values():
        assert len({component[d] for d in own}) == len(own)
