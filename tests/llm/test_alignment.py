"""Cross-tokenizer alignment against the libraries and a comparison of all spans."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from milepost.llm import alignment, byte_bpe, queries
from tests.llm.conftest import EDGE, rows_of

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    " ", "   ", "\n", "a", " a", "a ", "\t\ta  b", "it's we'll they've I'd", "▁", "a▁b", "x ▁", "<|endoftext|> <s></s> <unk> <0x41>",
    "été naïve Ünï 中文字 🙂🙂 \U0001f9d1‍\U0001f4bb", "\x00\x01\x1c", "　 a b", "ﬁ ² ½ Å Å", "12345 6 7,8", "é H̱",
    "x" * 3000, "ab " * 2000, "🙂" * 700, "﻿bom", "'s 's's 'S", "<|endoftext|>", "é" * 50 + "\n\n\n  \n", " line ", "مرحبا नमस्ते",
]


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    letters = alignment.byte_letters()
    a_bytes = lambda i: bytes(letters[c] for c in a.id_to_token(i))
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def spans(ids, of):
        out, at = [], 0
        for i in ids:
            out.append((at, at + len(of(i)), i))
            at += len(of(i))
        return out

    def tokens(text):
        if not text:
            return [], []
        left, right = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        for ids, of in ((left, a_bytes), (right, b_bytes)):
            if b"".join(map(of, ids)) != (" " + text).encode():
                return [], []
        return spans(left, a_bytes), spans(right, b_bytes)

    return tokens


def aligned(left, right):
    """Links and group text, by looking for the partners of each token among all near it."""
    ends = sorted({x[1] for x in left} & {y[1] for y in right})
    links, first = [], 0
    for lo, hi, i in left:
        while right[first][1] <= lo:
            first += 1
        for y in right[first:]:
            if y[0] >= hi:
                break
            links.append((i, y[2]))
    groups, i, j = [], 0, 0
    for e in ends:
        k, m = i, j
        while k < len(left) and left[k][1] <= e:
            k += 1
        while m < len(right) and right[m][1] <= e:
            m += 1
        groups.append(",".join(str(x[2]) for x in left[i:k]) + "|" + ",".join(str(y[2]) for y in right[j:m]))
        i, j = k, m
    return links, groups


def want(rows, tokens):
    found = [(d, *tokens(t)) for d, t, *_ in rows]
    found = [(d, left, right, *aligned(left, right)) for d, left, right in found]
    counts = Counter(x for f in found for x in f[3])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    out = []
    for d, left, right, links, groups in found:
        text = ";".join(groups)
        out.append((
            d, len(left), len(right), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links),
            sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if left else "",
        ))
    return sorted(out, key=repr)


@pytest.mark.parametrize("lane", [8, alignment.LANE])
def test_edges(spark, make_docs, nothing, library, monkeypatch, lane):
    """Also with texts that take many places in the state vector."""
    monkeypatch.setattr(alignment, "LANE", lane)
    rows = EDGE + [(100 + k, t) for k, t in enumerate(ODD)] + [(50, ODD[12]), (50, ODD[12])]
    assert rows_of(alignment.align(make_docs(rows), A, B), *COLUMNS) == want(rows, library)
    assert alignment.align(nothing, A, B).count() == 0


def test_lockstep_against_spans():
    r = random.Random(4)
    for case in range(60):
        texts = [sorted(r.sample(range(1, n + 1), r.randrange(1, n + 1)) + [n]) for n in [r.randrange(1, 60) for _ in range(2 * r.randrange(1, 9))]]
        left = [sorted(set(x)) for x in texts[::2]]
        right = [sorted({*[e for e in y if e < x[-1]], x[-1]}) for x, y in zip(left, texts[1::2])]
        base = np.append(0, np.cumsum([x[-1] for x in left]))
        a_end, b_end = (np.array([e + base[k] for k, x in enumerate(s) for e in x]) for s in (left, right))
        firsts = [np.append(0, np.cumsum([len(x) for x in s])) for s in (left, right)]
        links_a, links_b, cuts_a, cuts_b = alignment.lockstep(a_end, b_end, *firsts)
        a_start, b_start = np.append(0, a_end[:-1]), np.append(0, b_end[:-1])
        pairs = {(i, j) for i in range(len(a_end)) for j in range(len(b_end)) if a_start[i] < b_end[j] and b_start[j] < a_end[i]}
        got = list(zip(links_a.tolist(), links_b.tolist()))
        assert len(got) == len(pairs) and set(got) == pairs
        shared = sorted(set(a_end.tolist()) & set(b_end.tolist()))
        assert sorted(a_end[cuts_a].tolist()) == shared and sorted(b_end[cuts_b].tolist()) == shared


def test_tables_that_begin_anew(monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN", 50)
    texts = ["one two three four " * 3, " ".join(f"w{k}" for k in range(200)), "two w3 w5 é"] * 3
    a = alignment.Aligner(A, B, byte_bpe.class_array(byte_bpe.packed_classes()))
    first = [[x.tolist() for x in side] for side in a.encode(texts)]
    for t in texts:
        a.encode([t])
    assert [[x.tolist() for x in side] for side in a.encode(texts)] == first


def test_op12(spark, sf_dir, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert rows_of(queries.op12_token_alignment(spark, sf_dir), *COLUMNS) == want(rows, library)


def test_pair_counts(spark, make_docs, library):
    rows = [(k, f"pathetic clowns word{k % 3} stupidly") for k in range(30)]
    counts = Counter(x for _, t in rows for x in aligned(*library(t))[0])
    got = {(r.a, r.b): (r.links, r.best) for r in alignment.pair_counts(alignment.aligned_batches(make_docs(rows), A, B)).collect()}
    assert {k: n for k, (n, _) in got.items()} == dict(counts)
    assert all(best == (n == max(m for (_, y), (m, _) in got.items() if y == b)) for (_, b), (n, best) in got.items())
