"""Quality rules on repetition: which share of a text's characters lies in repeated pieces.

Word n-grams of several lengths get rolling 64-bit hashes over a whole slice of texts at once; an
n-gram whose hash occurred before in the same text is a duplicate, and the characters of all words
inside duplicates are counted once (the first occurrence is not held against a text). Lines are compared as they are. Longer n-grams are only looked
for where the shorter ones were duplicated, so clean text is sorted once.

Defined cases: NULL is empty text; texts without words have zero measures and fail the base rule;
whole texts are measured, however long; equal rows give equal results; a NULL id is kept; an empty
table gives no rows; other columns are ignored. Hashes of one text's n-grams are compared with each
other only: a wrong match has a chance of about n^2 / 2^65 for a text of n words.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from milepost.llm.common import Words, filtered, steps, texts_of, utf8

SYMBOLS = b"#*$%&|<>"
BASE_WINDOW = 8
#: Odd multiplier of the rolling hash.
STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Limits:
    """What a text may have at most (shares of characters, and of lines) and at least (words)."""

    min_words: int = 20
    repeat_words: int = 30  # per cent of the words, in 8-word windows
    ngrams: dict[int, float] = field(
        default_factory=lambda: {5: 0.20, 6: 0.19, 7: 0.18, 8: 0.17, 9: 0.16, 10: 0.15}
    )
    dup_lines: float = 0.50
    dup_line_chars: float = 0.20


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """True where a key occurs more than once; True where it has occurred before."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    later = np.zeros(len(keys), bool)
    later[order[1:][same]] = True
    both = later.copy()
    both[order[:-1][same]] = True
    return both, later


def repeated_ngrams(words: Words, lengths: list[int]):
    """For each length, ascending, marks at the first words of n-grams: text has it twice; had it before."""
    n = len(words.start)
    doc = words.doc()
    stop = words.first[1:][doc] if n else np.zeros(0, np.int64)
    value = words.hashes()
    with np.errstate(over="ignore"):
        salt = (np.arange(1, len(words.first), dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        salt = (salt ^ (salt >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        salt = salt[doc]
        rolling, size, found = value, 1, None
        for length in lengths:
            while size < length:
                rolling = rolling[:-1] * STEP + value[size:] if size < n else rolling[:0]
                size += 1
            at = np.arange(len(rolling))
            at = at[at + length <= stop[: len(rolling)]]
            if found is not None:  # an n-gram that repeats has repeated beginnings and ends
                gap = length - last
                both = found[at].copy()
                both &= found[at + gap]
                at = at[both]
            twice, again = _repeated(rolling[at] ^ salt[at])
            found, later = np.zeros(n, bool), np.zeros(n, bool)
            found[at[twice]] = True
            later[at[again]] = True
            last = length
            yield length, found, later


def covered(first: np.ndarray, length: int) -> np.ndarray:
    """True for each word inside an n-gram that begins at a marked word."""
    edge = np.zeros(len(first) + length + 1, np.int64)
    at = np.flatnonzero(first)
    edge[at] += 1
    np.subtract.at(edge, at + length, 1)
    return np.cumsum(edge)[: len(first)] > 0


def per_text(words: Words, values: np.ndarray) -> np.ndarray:
    """Sums of a value per word, by text."""
    total = np.append(0, np.cumsum(values))
    return total[words.first[1:]] - total[words.first[:-1]]


def line_counts(text: str) -> tuple[int, int, int, int]:
    """Lines with a word, later copies among them, and the characters of both."""
    lines = [x for x in text.split("\n") if x.strip(" \t\r\v\f")]
    if len(set(lines)) == len(lines):
        return len(lines), 0, sum(map(len, lines)), 0
    seen: set[str] = set()
    dups = [x for x in lines if x in seen or seen.add(x)]
    return len(lines), len(dups), sum(map(len, lines)), sum(map(len, dups))


def measure(texts: list[str], raw: list[bytes], lengths: list[int]) -> dict[str, np.ndarray]:
    """All measures of a slice of texts."""
    words = Words(raw)
    tail = np.append(0, np.cumsum((words.buf & 0xC0) == 0x80))
    chars = (words.end - words.start) - (tail[words.end] - tail[words.start])
    out = {
        "n_words": words.counts,
        "word_chars": per_text(words, chars),
        "n_symbols": np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in raw], np.int64),
    }
    for length, found, later in repeated_ngrams(words, sorted({BASE_WINDOW, *lengths})):
        if length == BASE_WINDOW:
            out["n_repeat_words"] = per_text(words, covered(found, length))
        if length in lengths:
            out[f"chars_{length}"] = per_text(words, chars * covered(later, length))
    lines = np.array([line_counts(t) for t in texts], np.int64).reshape(-1, 4)
    for k, name in enumerate(("n_lines", "n_dup_lines", "line_chars", "dup_line_chars")):
        out[name] = lines[:, k]
    return out


def verdicts(found: dict[str, np.ndarray], limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """Whether each text fails the base rule, and whether it is kept."""
    base = (found["n_words"] < limits.min_words) | (
        100 * found["n_repeat_words"] > limits.repeat_words * found["n_words"]
    )
    good = (found["n_dup_lines"] <= limits.dup_lines * found["n_lines"]) & (
        found["dup_line_chars"] <= limits.dup_line_chars * found["line_chars"]
    )
    for n, share in limits.ngrams.items():
        good &= found[f"chars_{n}"] <= share * found["word_chars"]
    return base, ~base & good


def _measure_batches(limits: Limits, names: list[str]):
    def run(batches):
        for batch in steps(batches):
            found = measure(batch.column("text").to_pylist(), utf8(batch), sorted(limits.ngrams))
            base, kept = verdicts(found, limits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(found[c].astype(np.int64)) for c in names), pa.array(base), pa.array(kept)],
                ["doc_id", *names, "base_failed", "kept"],
            )

    return run


def repetition_measures(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """Counts, repetition coverage and both verdicts of every row. No shuffle."""
    names = ["n_words", "word_chars", "n_symbols", "n_repeat_words", "n_lines", "n_dup_lines",
             "line_chars", "dup_line_chars", *(f"chars_{n}" for n in sorted(limits.ngrams))]
    schema = ["doc_id long", *(f"{c} long" for c in names), "base_failed boolean", "kept boolean"]
    return texts_of(docs, id_col, text_col).mapInArrow(_measure_batches(limits, names), ", ".join(schema))


def keep_good(docs: DataFrame, limits: Limits = Limits(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. No shuffle."""

    def good(texts: list[str], raw: list[bytes]) -> np.ndarray:
        return verdicts(measure(texts, raw, sorted(limits.ngrams)), limits)[1]

    return filtered(docs, good, text_col)
