"""Quality classifier: a generalised additive model with pairwise interactions.

Measures of a text (shape of words, lines, symbols, repetition) fall into bins; each measure has a
lookup table over its bins, and chosen pairs of measures have tables over coarser bins. Tables are
learned by cyclic boosting: round after round, each table in turn gets a shallow tree's small step
towards the remaining error. A score is the logistic of the sum of table entries, so scoring is a
handful of vectorised lookups and additions.

The model is fitted on the driver from at most ``max_rows`` labelled rows of measures (a few MB);
which rows is decided by a hash of the id. Everything else runs over all rows.

Defined cases: NULL is empty text; empty texts have all measures 0 and are scored; whole texts are
measured; equal texts get equal scores; rows with a NULL id are scored and never learned from;
repeated labels of a document are averaged; without labels, or with one class only, scores follow the
smoothed class share; an empty table gives no rows; other columns are ignored. Neither labels nor ids,
languages or sources enter a score.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from milepost.llm.common import Words, filtered, steps, texts_of, utf8
from milepost.llm.repetition_rules import SYMBOLS, covered, line_counts, per_text, repeated_ngrams
from milepost.session import cut_lineage

MEASURES = [
    "words", "word_chars", "symbols", "digits", "capitals", "stops", "distinct", "repeats",
    "line_words", "dup_lines", "single", "longest", "wide", "same_next", "ends",
]


def _class_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(members)] = 1
    return table


def measures(texts: list[str], raw: list[bytes]) -> np.ndarray:
    """One row of measures per text."""
    words = Words(raw)
    n = words.counts.astype(float)
    some = np.maximum(n, 1)
    size = words.end - words.start

    def bytes_in(members: bytes) -> np.ndarray:
        total = np.append(0, np.cumsum(_class_table(members)[words.buf]))
        return per_text(words, total[words.end] - total[words.start])

    tail = np.append(0, np.cumsum((words.buf & 0xC0) == 0x80))
    tails = tail[words.end] - tail[words.start]
    length = size - tails
    chars = np.maximum(per_text(words, length), 1)
    hashes, doc = words.hashes(), words.doc()
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    fresh = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1]))[: len(h)]
    distinct = np.bincount(d, weights=fresh, minlength=len(texts))
    same = np.append(False, (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1]))[: len(hashes)]
    (_, _, later), = repeated_ngrams(words, [5])
    lines = np.array([line_counts(t) for t in texts], float).reshape(-1, 4)
    longest = np.zeros(len(texts))
    np.maximum.at(longest, doc, length)
    last = words.buf[np.maximum(words.end - 1, 0)]
    out = [
        np.log1p(n), chars / some, bytes_in(SYMBOLS) / some, bytes_in(b"0123456789") / chars,
        bytes_in(bytes(range(65, 91))) / chars, bytes_in(b".,;:!?") / some, distinct / some,
        per_text(words, length * covered(later, 5)) / chars, n / np.maximum(lines[:, 0], 1),
        lines[:, 1] / np.maximum(lines[:, 0], 1), per_text(words, length == 1) / some, longest,
        per_text(words, tails > 0) / some, per_text(words, same) / some,
        per_text(words, _class_table(b".!?")[last]) / some,
    ]
    table = np.column_stack(out)
    table[n == 0] = 0
    return table


@dataclass
class Additive:
    """Bin edges and tables. ``pairs`` holds (measure, measure, table over coarse bins)."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        for k, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, rows[:, k], side="right")]
        for a, b, table in self.pairs:
            total += table[_bins(self.coarse[a], rows[:, a]), _bins(self.coarse[b], rows[:, b])]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _bins(edges: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.searchsorted(edges, values, side="right")


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _step(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _shallow(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Tree with up to three leaves over ordered bins: the best cut, then the best cut of a side."""
    cuts = [0, len(g)]
    for _ in range(2):
        best = (1e-9, None)
        for lo, hi in zip(cuts, cuts[1:]):
            if hi - lo > 1:
                gl, hl = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
                gain = _gain(gl, hl) + _gain(gl[-1] - gl, hl[-1] - hl) - _gain(gl[-1], hl[-1])
                k = int(gain[:-1].argmax())
                best = max(best, (float(gain[k]), lo + k + 1), key=lambda x: x[0])
        if best[1] is None:
            break
        cuts = sorted({*cuts, best[1]})
    out = np.empty(len(g))
    for lo, hi in zip(cuts, cuts[1:]):
        out[lo:hi] = _step(g[lo:hi].sum(), h[lo:hi].sum())
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best cut of both axes at once: its gain and the steps of its four quadrants."""
    gs, hs = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def parts(s):
        low = s[:-1, :-1]
        right, below = s[:-1, -1:] - low, s[-1:, :-1] - low
        return low, right, below, s[-1, -1] - low - right - below

    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    gain = sum(map(_gain, parts(gs), parts(hs)))
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    steps = np.empty_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            steps[rows, cols] = _step(g[rows, cols].sum(), h[rows, cols].sum())
    return float(gain[i, j]), steps


def fit(rows: np.ndarray, labels: np.ndarray, rounds: int = 150, rate: float = 0.15, bins: int = 32,
        coarse: int = 8, pairs: int = 6) -> Additive:
    """Cyclic boosting: first the tables of single measures, then those of the strongest pairs."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    model = Additive(float(np.log(share / (1 - share))))
    if len(np.unique(labels)) < 2:
        return model
    model.edges = [_edges(rows[:, k], bins) for k in range(rows.shape[1])]
    model.coarse = [_edges(rows[:, k], coarse) for k in range(rows.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    fine = [_bins(e, rows[:, k]) for k, e in enumerate(model.edges)]
    rough = [_bins(e, rows[:, k]) for k, e in enumerate(model.coarse)]
    total = np.full(len(labels), model.base)

    def left() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(rounds):
        for k, table in enumerate(model.tables):
            g, h = left()
            move = rate * _shallow(np.bincount(fine[k], g, len(table)), np.bincount(fine[k], h, len(table)))
            table += move
            total += move[fine[k]]

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        wide = len(model.coarse[b]) + 1
        shape = (len(model.coarse[a]) + 1, wide)
        return np.bincount(rough[a] * wide + rough[b], values, shape[0] * wide).reshape(shape)

    g, h = left()
    strength = {(a, b): _quadrants(grid(a, b, g), grid(a, b, h))[0] for a, b in combinations(range(rows.shape[1]), 2)}
    for a, b in sorted(strength, key=strength.get, reverse=True)[:pairs]:
        model.pairs.append((a, b, np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1))))
    for _ in range(rounds // 2):
        for a, b, table in model.pairs:
            g, h = left()
            move = rate * _quadrants(grid(a, b, g), grid(a, b, h))[1]
            table += move
            total += move[rough[a], rough[b]]
    return model


def _measure_batches(batches):
    for batch in steps(batches):
        found = measures(batch.column("text").to_pylist(), utf8(batch))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(found[:, k]) for k in range(len(MEASURES)))], ["doc_id", *MEASURES]
        )


def _score_batches(model: Additive):
    def run(batches):
        for batch in steps(batches):
            found = model.score(measures(batch.column("text").to_pylist(), utf8(batch)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    return run


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality") -> Additive:
    """Fits the model. Only the texts of the sampled ids are read for their measures."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label"))
        .filter("doc_id IS NOT NULL AND label IS NOT NULL").filter(~held_out())
        .groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("double").alias("label"))
    )
    texts = texts_of(docs, id_col, text_col)
    sample = cut_lineage(
        known.join(texts.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows),
        "label-sample",
    )
    rows = (
        texts.join(F.broadcast(sample), "doc_id")  # max_rows numbers at most
        .select("doc_id", "text")
        .mapInArrow(_measure_batches, ", ".join(["doc_id long", *(f"`{c}` double" for c in MEASURES)]))
        .join(F.broadcast(sample), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", *MEASURES).limit(max_rows)
        .select("label", *MEASURES).toPandas().to_numpy(float)
    )
    return fit(rows[:, 1:], rows[:, 0])


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """doc_id, held_out, score of every row."""
    model = train(docs, labels, max_rows, id_col, text_col, label_col)
    return texts_of(docs, id_col, text_col).mapInArrow(_score_batches(model), "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score"
    )


def keep_good(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with all their columns. No shuffle of texts."""
    model = train(docs, labels, max_rows)
    return filtered(docs, lambda texts, raw: model.score(measures(texts, raw)) >= least)
