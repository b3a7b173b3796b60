"""Toxicity by weak supervision: many voters, a generative model of their votes, a linear classifier.

Voters are lexicons (fixed lists of insults in four languages, and words found in toxic training texts) and patterns
(starts and ends of words found there, masked words, runs of exclamation marks). A lexicon or a pattern of words
says toxic if the text has one of its entries, otherwise clean, and abstains on texts without words; a pattern of signs says
toxic or abstains. Entries are found by a likelihood ratio between training texts with and without them, at a
level that chance doesn't reach among that many candidates.

The label model is generative: a hidden class, and for each voter a table of its votes given the class and the vote
of at most one other voter. Which voters depend on which is the spanning tree of largest mutual information
given the class, so voters that share words are not counted as independent evidence. Tables, class share and hidden
classes are estimated by EM. The label of a training text is one more vote, whose errors are estimated too.
A logistic regression on the entries and votes then learns the posterior classes; it alone scores texts.

The models are fitted on the driver from at most ``max_rows`` labelled texts, chosen by a hash of the id; what comes
there are numbers of entries, not texts. All rows are scored, each on its whole text.

Defined cases: NULL is empty text; texts without words have no entries and get the score of that case; equal
texts get equal scores; rows with a NULL id are scored and never learned from; repeated labels of a document are
averaged; without labels scores are 0.5, with one class its smoothed share; an empty table gives no rows; other columns
are ignored. Neither labels nor ids, languages or sources enter a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from milepost.llm.common import Words, small_batches, steps, texts_of, utf8, xxh64
from milepost.session import cut_lineage

# Insults by language.
INSULTS = {
    "en": "clown coward disgusting dumb filth fool freak garbage hateful idiot imbecile jerk loser moron pathetic"
          " pig scum stupid trash ugly vermin worthless",
    "de": "abschaum arschloch dreck dumm dummkopf ekelhaft feigling idiot trottel versager wertlos widerlich",
    "fr": "abruti connard crétin idiot imbécile lâche minable ordure pathétique pourri stupide",
    "es": "asqueroso basura cobarde escoria estúpido idiota imbécil inútil patético payaso tonto",
}
#: Kinds of entries: whole words, starts and ends of so many letters.
STARTS, ENDS = (3, 4, 5, 6), (4, 5, 6)
#: Entries that are kept, and the likelihood ratio (twice its logarithm) they must reach.
ENTRIES, LEAST = 600, 24.0
#: Voters among which found words, starts and ends are dealt.
DEALT = {"word": 6, "start": 6, "end": 3}
SIGNS = ["masked", "exclaimed"]
ABSTAIN, CLEAN, TOXIC = range(3)

_APART = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_MASKS = np.isin(np.arange(256), list(b"*#$@%&"))
_LETTERS = np.array([c >= 128 or chr(c).isalpha() for c in range(256)])


def kinds() -> list[str]:
    return ["word", *("start" for _ in STARTS), *("end" for _ in ENDS)]


def entries_of(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word's entries, a column per kind, and which of them the word is long enough for."""
    letter = np.flatnonzero((buf & 0xC0) != 0x80)
    first = np.searchsorted(letter, start)
    size = np.searchsorted(letter, end) - first
    out = [xxh64(buf, start, end - start, 1)]
    good = [np.ones(len(start), bool)]
    for n in STARTS:
        stop = np.where(size > n, letter[np.minimum(first + n, len(letter) - 1)], end)
        out.append(xxh64(buf, start, stop - start, 10 + n))
        good.append(size >= n)
    for n in ENDS:
        begin = np.where(size > n, letter[np.maximum(first + size - n, 0)], start)
        out.append(xxh64(buf, begin, end - begin, 20 + n))
        good.append(size >= n)
    return np.column_stack(out), np.column_stack(good)


class Vocabulary:
    """The distinct words of some texts with their entries, and which text has which word."""

    def __init__(self, texts: list[str]):
        words = Words([t.lower().encode("utf-8", "replace").translate(_APART) for t in texts])
        _, at, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
        self.counts = words.counts
        self.entries, self.good = entries_of(words.buf, words.start[at], words.end[at])
        has = np.unique(words.doc() * max(1, len(at)) + number)
        self.doc, self.word = np.divmod(has, max(1, len(at)))

    def pairs(self, word: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, entry) for entries of words."""
        order = np.argsort(word, kind="stable")
        word, entry = word[order], entry[order]
        lo, hi = np.searchsorted(word, self.word), np.searchsorted(word, self.word, side="right")
        n = hi - lo
        doc = np.repeat(self.doc, n)
        at = np.repeat(lo, n) + np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        wide = int(entry.max(initial=0)) + 1
        return np.divmod(np.unique(doc * wide + entry[at]), wide)


def signs(raw: list[bytes]) -> np.ndarray:
    """For each text whether it has masked words (a letter and two signs), and runs of exclamation marks."""
    buf = np.frombuffer(b"\n".join(raw) + b"\n\n\n", np.uint8)
    first = np.append(0, np.cumsum([len(t) + 1 for t in raw]))
    mask = _MASKS[buf]
    hits = [_LETTERS[buf[:-2]] & mask[1:-1] & mask[2:], (buf[:-2] == 33) & (buf[1:-1] == 33)]
    counts = [np.append(0, np.cumsum(h))[np.minimum(first, len(h))] for h in hits]
    return np.column_stack([np.diff(c) > 0 for c in counts])


# --- entries --------------------------------------------------------------------------------------


def _entry_batches(batches):
    for batch in steps(batches):
        found = Vocabulary(batch.column("text").to_pylist())
        toxic = batch.column("label").to_numpy(zero_copy_only=False) > 0
        for column, kind in enumerate(kinds()):
            word = np.flatnonzero(found.good[:, column])
            names, entry = np.unique(found.entries[word, column], return_inverse=True)
            if not len(names):
                continue
            doc, which = found.pairs(word, entry)
            bad = np.bincount(which, toxic[doc], len(names)).astype(np.int64)
            both = np.bincount(which, minlength=len(names))
            yield pa.RecordBatch.from_pydict({
                "kind": [kind] * len(names), "entry": pa.array(names.view(np.int64)), "bad": pa.array(bad),
                "n": pa.array(both),
            })


def ratio(bad: Column, n: Column, all_bad: int, rows: int) -> Column:
    """Twice the log of the likelihood ratio for texts with and without an entry."""

    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    share = all_bad / rows
    with_, without = n.cast("double"), F.lit(rows) - n
    cells = [
        (bad, with_ * share), (n - bad, with_ * (1 - share)),
        (F.lit(all_bad) - bad, without * share), (without - (F.lit(all_bad) - bad), without * (1 - share)),
    ]
    return 2 * sum((term(a.cast("double"), b) for a, b in cells), F.lit(0.0))


def found_entries(sample: DataFrame, all_bad: int, rows: int) -> list:
    """At most ``ENTRIES`` rows kind, entry of what marks toxic texts, the strongest first."""
    counts = sample.select("text", "label").mapInArrow(_entry_batches, "kind string, entry long, bad long, n long")
    return (
        counts.groupBy("kind", "entry").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
        .filter(F.col("bad") * rows > F.col("n") * all_bad)
        .withColumn("ratio", ratio(F.col("bad"), F.col("n"), all_bad, rows))
        .filter(F.col("ratio") >= LEAST).orderBy(F.desc("ratio"), "kind", "entry").limit(ENTRIES)
        .select("kind", "entry").collect()
    )


@dataclass(frozen=True)
class Voters:
    """Entries in ascending order, and which voter has which entry (entries x voters)."""

    entries: np.ndarray
    member: np.ndarray
    names: list[str]

    @staticmethod
    def of(found: list) -> Voters:
        names = [f"insults {lang}" for lang in INSULTS]
        names += [f"{kind} {k}" for kind, n in DEALT.items() for k in range(n)]
        held: dict[int, set[int]] = {}
        for number, listed in enumerate(INSULTS.values()):
            words = Words([listed.encode()])
            for entry in xxh64(words.buf, words.start, words.end - words.start, 1).tolist():
                held.setdefault(entry, set()).add(number)
        dealt = dict.fromkeys(DEALT, 0)
        for kind, entry in found:
            voter = names.index(f"{kind} {dealt[kind] % DEALT[kind]}")
            dealt[kind] += 1
            held.setdefault(entry & 0xFFFFFFFFFFFFFFFF, set()).add(voter)
        order = sorted(held)
        member = np.zeros((len(order), len(names)), bool)
        for k, entry in enumerate(order):
            member[k, list(held[entry])] = True
        return Voters(np.array(order, np.uint64), member, names + SIGNS)

    def hits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of each text, and the distinct (text, entry) pairs."""
        found = Vocabulary(texts)
        at = np.searchsorted(self.entries, found.entries)
        known = self.entries[np.minimum(at, len(self.entries) - 1)] == found.entries
        word, column = np.nonzero(known & found.good)
        doc, entry = found.pairs(word, at[word, column])
        return found.counts, doc, entry

    def votes(self, counts: np.ndarray, doc: np.ndarray, entry: np.ndarray, signed: np.ndarray) -> np.ndarray:
        """One row of votes per text."""
        wide = self.member.shape[1]
        out = np.where(counts[:, None] > 0, CLEAN, ABSTAIN) * np.ones((1, wide), np.int64)
        row, voter = np.nonzero(self.member[entry])
        out[doc[row], voter] = TOXIC
        return np.hstack([out, np.where(signed, TOXIC, ABSTAIN)])


# --- label model ----------------------------------------------------------------------------------


@dataclass
class LabelModel:
    """Class share, the voter that each voter depends on (-1: none), and log tables by (class, other's vote, vote)."""

    share: float
    parents: np.ndarray
    tables: np.ndarray
    label_errors: np.ndarray

    def posterior(self, votes: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Probability of the toxic class; labels are 0, 1 or -1 (none)."""
        odds = np.full(len(votes), np.log(self.share / (1 - self.share)))
        for j, parent in enumerate(self.parents):
            other = votes[:, parent] if parent >= 0 else np.zeros(len(votes), np.int64)
            odds += self.tables[j, 1, other, votes[:, j]] - self.tables[j, 0, other, votes[:, j]]
        given = labels >= 0
        errors = self.label_errors
        odds[given] += np.log(errors[1, labels[given]] / errors[0, labels[given]])
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))

    def accuracies(self, votes: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Share of each voter's votes (abstentions aside) that agree with the hidden class."""
        right = q[:, None] * (votes == TOXIC) + (1 - q)[:, None] * (votes == CLEAN)
        return right.sum(0) / np.maximum((votes != ABSTAIN).sum(0), 1)


def dependence(votes: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Mutual information of each pair of voters given the class."""
    hot = (votes[:, :, None] == np.arange(3)).astype(float)
    n, wide = votes.shape
    flat = hot.reshape(n, wide * 3)
    out = np.zeros((wide, wide))
    for weight in (q, 1 - q):
        total = weight.sum()
        if total < 1e-9:
            continue
        joint = (flat * weight[:, None]).T @ flat / total
        single = np.diag(joint)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(joint > 1e-12, joint * np.log(joint / np.outer(single, single)), 0.0)
        out += total / n * np.nan_to_num(gain).reshape(wide, 3, wide, 3).sum(axis=(1, 3))
    np.fill_diagonal(out, 0)
    return out


def spanning_tree(strength: np.ndarray, least: float) -> np.ndarray:
    """Parent of each voter in the forest of the strongest dependencies above ``least``."""
    wide = len(strength)
    parents = np.full(wide, -1)
    todo = set(range(wide))
    while todo:
        root = min(todo)
        todo.discard(root)
        tree = [root]
        while todo:
            a, b = max(((a, b) for a in tree for b in todo), key=lambda x: (strength[x], -x[0], -x[1]))
            if strength[a, b] < least:
                break
            parents[b] = a
            todo.discard(b)
            tree.append(b)
    return parents


def fit_labels(votes: np.ndarray, labels: np.ndarray, rounds: int = 20) -> tuple[LabelModel, np.ndarray]:
    """EM from the labels (missing ones: the share of toxic votes); the tree is found twice. Gives the posterior too."""
    n, wide = votes.shape
    said = (votes == TOXIC).mean(axis=1)
    q = np.where(labels >= 0, np.where(labels == 1, 0.95, 0.05), 0.05 + 0.9 * (said > 0.2))
    # a label is believed to be right nine times in ten to begin with, as firmly as a fifth of the rows
    belief = 0.2 * n * np.array([[0.9, 0.1], [0.1, 0.9]]) / 2 + 1
    parents = np.full(wide, -1)
    for step in range(rounds):
        if step in (0, rounds // 2):
            parents = spanning_tree(dependence(votes, q), 15.0 / n)
        tables = np.empty((wide, 2, 3, 3))
        for j, parent in enumerate(parents):
            other = votes[:, parent] if parent >= 0 else np.zeros(n, np.int64)
            for y, weight in enumerate((1 - q, q)):
                counts = np.bincount(3 * other + votes[:, j], weight, 9).reshape(3, 3)
                # rare cases lean on the voter's votes over all of the other's
                prior = (counts.sum(0) + 0.5) / (counts.sum() + 1.5)
                tables[j, y] = np.log((counts + 2 * prior) / (counts.sum(1, keepdims=True) + 2))
        given = labels >= 0
        errors = belief.copy()
        for y, weight in enumerate((1 - q, q)):
            errors[y] += np.bincount(labels[given], weight[given], 2)
        model = LabelModel(
            float((q.sum() + 1) / (n + 2)), parents, tables, errors / errors.sum(1, keepdims=True)
        )
        q = model.posterior(votes, labels)
    return model, q


# --- classifier -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Classifier:
    """Weights of entries and votes, and the bias."""

    voters: Voters
    entry: np.ndarray
    vote: np.ndarray
    bias: float

    def score(self, texts: list[str], raw: list[bytes]) -> np.ndarray:
        counts, doc, entry = self.voters.hits(texts)
        votes = self.voters.votes(counts, doc, entry, signs(raw))
        total = self.bias + np.bincount(doc, self.entry[entry], len(texts)) + (votes == TOXIC) @ self.vote
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def logistic(x: np.ndarray, target: np.ndarray, ridge: float = 1.0, rounds: int = 15) -> np.ndarray:
    """Weights, the bias last, by Newton's method; targets are probabilities."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    w[-1] = np.log((target.sum() + 1) / (len(target) - target.sum() + 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (target - p) - penalty * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(bend, slope)
        w += step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-6:
            break
    return w


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _hit_batches(voters: Voters):
    def run(batches):
        for batch in steps(batches):
            counts, doc, entry = voters.hits(batch.column("text").to_pylist())
            offsets = np.searchsorted(doc, np.arange(len(counts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_pydict({
                "label": batch.column("label"), "words": pa.array(counts),
                "signs": pa.array(signs(utf8(batch)).astype(np.int64) @ (1 << np.arange(len(SIGNS)))),
                "entries": pa.ListArray.from_arrays(pa.array(offsets), pa.array(entry)),
            })

    return run


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 10_000, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Classifier:
    """Finds entries, fits the label model and the classifier on at most ``max_rows`` labelled texts."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label"))
        .filter("doc_id IS NOT NULL AND label IS NOT NULL").filter(~held_out())
        .groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )
    texts = texts_of(docs, id_col, text_col)
    chosen = cut_lineage(
        known.join(texts.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows),
        "label-sample",
    )
    # an id may have several texts; all of those of up to max_rows ids are read, and max_rows of them kept
    sample = cut_lineage(
        texts.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
        .limit(max_rows).select("text", "label"), "labelled-texts",
    )
    rows, bad = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    found = found_entries(small_batches(sample), bad, rows) if 0 < bad < rows else []
    voters = Voters.of(found)
    if not 0 < bad < rows:
        share = (bad + 1) / (rows + 2)
        nothing = np.zeros(len(voters.entries)), np.zeros(len(voters.names))
        return Classifier(voters, *nothing, float(np.log(share / (1 - share))))
    hits = (
        small_batches(sample).mapInArrow(_hit_batches(voters), "label int, words long, signs long, entries array<long>")
        .orderBy("label", "words", "signs", "entries").toPandas()
    )
    doc = np.repeat(np.arange(len(hits)), hits.entries.map(len))
    entry = np.concatenate([np.zeros(0, np.int64), *hits.entries]).astype(np.int64)
    signed = (hits.signs.to_numpy()[:, None] >> np.arange(len(SIGNS)) & 1).astype(bool)
    votes = voters.votes(hits.words.to_numpy(), doc, entry, signed)
    _, q = fit_labels(votes, hits.label.to_numpy())
    x = np.zeros((len(hits), len(voters.entries)))
    x[doc, entry] = 1
    w = logistic(np.hstack([x, votes == TOXIC]), q)
    return Classifier(voters, w[: len(voters.entries)], w[len(voters.entries) : -1], float(w[-1]))


def _score_batches(model: Classifier):
    def run(batches):
        for batch in steps(batches):
            scores = model.score(batch.column("text").to_pylist(), utf8(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return run


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = 10_000, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score of every row."""
    model = train(docs, labels, max_rows, id_col, text_col, label_col)
    return texts_of(docs, id_col, text_col).mapInArrow(_score_batches(model), "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score"
    )
