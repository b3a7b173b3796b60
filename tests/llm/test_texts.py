"""Token counts, repetition rules, byte-level BPE and token records against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
import xxhash
from tokenizers import Tokenizer

from milepost.llm import byte_bpe, common, queries, repetition_rules, token_counts, token_records
from milepost.session import scratch_dir
from tests.llm.conftest import EDGE, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PIECES = P.path("piece_bpe_32k.model")
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")


def documents(spark, sf_dir):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def test_xxh64():
    r = random.Random(1)
    raw = r.randbytes(4000) + bytes(40)
    at = [(r.randrange(3000), r.randrange(200)) for _ in range(2000)]
    got = common.xxh64(np.frombuffer(raw, np.uint8), *map(np.array, zip(*at)))
    assert [int(x) for x in got] == [xxhash.xxh64_intdigest(raw[a : a + n], 42) for a, n in at]


def test_words():
    w = common.Words([b" a  b\n", b"", b"\x0b", b"c", b"x y z"])
    assert w.counts.tolist() == [2, 0, 0, 1, 3]
    assert [w.buf[a:b].tobytes() for a, b in zip(w.start, w.end)] == [b"a", b"b", b"c", b"x", b"y", b"z"]


# token counts

def want_counts(rows):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    return sorted(((d, len((t or "").encode()), len(model.encode(t or ""))) for d, t, *_ in rows), key=repr)


def test_token_counts_edges(spark, edge, nothing):
    folder = scratch_dir(spark, "cache")
    assert rows_of(token_counts.token_counts(edge, PIECES, folder), "doc_id", "n_bytes", "n_tokens") == want_counts(EDGE)
    assert token_counts.token_counts(nothing, PIECES, scratch_dir(spark, "cache")).count() == 0


def test_token_counts_encodes_misses_only(spark, make_docs):
    folder = scratch_dir(spark, "cache")
    first, more = [(1, "a b"), (2, "a b"), (3, None)], [(4, "a b"), (5, "new text"), (6, "new text")]
    token_counts.token_counts(make_docs(first), PIECES, folder).collect()
    assert spark.read.parquet(folder).count() == 2
    got = token_counts.token_counts(make_docs(first + more), PIECES, folder)
    assert rows_of(got, "doc_id", "n_bytes", "n_tokens") == want_counts(first + more)
    lines = spark.read.parquet(folder)
    assert lines.count() == 3 and lines.select("tokenizer").distinct().count() == 1
    # counts of another tokenizer are not used
    other = lines.selectExpr("content", "'other' AS tokenizer", "99L AS n_tokens")
    other.write.mode("append").parquet(folder)
    assert rows_of(token_counts.token_counts(make_docs(more), PIECES, folder), "doc_id", "n_bytes", "n_tokens") == want_counts(more)


def test_word_counter_equals_library():
    counter = token_counts.WordCounter(PIECES)
    assert counter.by_word
    r = random.Random(4)
    texts = ["".join(r.choice("ab  ▁\n\té中<s>\0") for _ in range(r.randrange(40))) for _ in range(3000)] + [" ", "  ", "▁", ""]
    assert counter.count(texts) == list(map(len, counter.model.encode(texts)))


@pytest.mark.parametrize("few", [0, 3, 1000])
def test_known_texts_do_not_move(spark, make_docs, monkeypatch, few):
    """Nothing is missing: nothing is encoded or appended. Some are: by a broadcast of their digests or a join."""
    monkeypatch.setattr(token_counts, "FEW", few)
    folder = scratch_dir(spark, "cache")
    rows = [(k, f"text {k % 10} of ten") for k in range(40)]
    token_counts.token_counts(make_docs(rows), PIECES, folder).collect()
    lines = spark.read.parquet(folder).count()
    monkeypatch.setattr(token_counts, "_encode", None)  # would fail if it were called
    assert token_counts.token_counts(make_docs(rows[::-1]), PIECES, folder).count() == 40
    monkeypatch.undo()
    monkeypatch.setattr(token_counts, "FEW", few)
    more = [*rows, (50, "a new one"), (51, "a new one"), (52, None)]
    got = token_counts.token_counts(make_docs(more), PIECES, folder)
    assert rows_of(got, "doc_id", "n_bytes", "n_tokens") == want_counts(more)
    assert spark.read.parquet(folder).count() == lines + 2


def test_op1(spark, sf_dir):
    got = queries.op1_token_counts(spark, sf_dir)
    want = [(*w, w[2] > 4096) for w in want_counts(documents(spark, sf_dir))]
    assert rows_of(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)


# repetition rules

def base_measures(text):
    w = WORD.findall(text)
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i : i + 8]), []).append(i)
    inside = {k for v in at.values() if len(v) > 1 for i in v for k in range(i, i + 8)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    return sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(inside), len(w)


def later_chars(text, n):
    w, seen, inside = WORD.findall(text), set(), set()
    for i in range(len(w) - n + 1):
        gram = tuple(w[i : i + n])
        if gram in seen:
            inside.update(range(i, i + n))
        seen.add(gram)
    return sum(len(w[k]) for k in inside)


COLUMNS = ("doc_id", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_words", "base_failed", "kept")


def want_rules(rows):
    limits, out = repetition_rules.Limits(), []
    for d, t, *_ in rows:
        t = t or ""
        m = base_measures(t)
        base = m[4] < 20 or 100 * m[3] > 30 * m[4]
        n, dup, chars, dup_chars = repetition_rules.line_counts(t)
        good = dup <= limits.dup_lines * n and dup_chars <= limits.dup_line_chars * chars
        good = good and all(later_chars(t, k) <= s * m[0] for k, s in limits.ngrams.items())
        out.append((d, *m, base, not base and good))
    return sorted(out, key=repr)


def test_repetition_edges(edge, nothing):
    assert rows_of(repetition_rules.repetition_measures(edge), *COLUMNS) == want_rules(EDGE)
    assert repetition_rules.repetition_measures(nothing).count() == 0
    assert repetition_rules.keep_good(nothing).count() == 0


def test_keep_good_keeps_rows_as_they_are(edge):
    kept = {r[0:1] for r in want_rules(EDGE) if r[-1]}
    got = repetition_rules.keep_good(edge)
    assert got.columns == edge.columns and {(r.doc_id,) for r in got.collect()} == kept
    assert got.exceptAll(edge).count() == 0


def test_op4(spark, sf_dir):
    assert rows_of(queries.op4_repetition_rules(spark, sf_dir), *COLUMNS) == want_rules(documents(spark, sf_dir))


def test_clean_documents_stay(spark):
    got = queries.op4_repetition_rules(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    good = got.join(labels.filter("quality = 1"), "doc_id").filter("NOT base_failed")
    assert good.filter("NOT kept").count() <= 0.01 * good.count()


# byte-level BPE

@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(RANKS)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def test_pieces_and_merges_equal_library(codec, library):
    r = random.Random(2)
    alphabet = [*"ab strtlvedm''  \n\n\t\x0b 12,.!#éü中́　²Ⅷ\x1c\x85\xa0\x00", "re", "ll", "'ll", "'re", "'S", "\U0001F600", "\U000E0100"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(30))) for _ in range(8000)]
    texts += ["x" * 3000, " " * 700, "", "ab" * 400, "".join(chr(c) for c in range(0x3000))]
    assert codec.encode(texts) == library.encode_ordinary_batch(texts)


def test_long_merges_equal_short_ones(codec):
    r = random.Random(3)
    for _ in range(300):
        piece = bytes(r.choice(b"aabbeenrst ") for _ in range(r.randrange(2, 90)))
        assert codec.merge.__self__._many(piece) == codec.merge.__self__._few(piece)


def digests(rows, library):
    out = []
    for d, t, *_ in rows:
        ids = library.encode_ordinary(t or "")
        sha = lambda x: hashlib.sha256(x).hexdigest()
        out.append((d, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    return sorted(out, key=repr)


BPE = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def test_byte_bpe_edges(edge, nothing, library):
    assert rows_of(byte_bpe.round_trip(edge, RANKS), *BPE) == digests(EDGE, library)
    assert byte_bpe.round_trip(nothing, RANKS).count() == 0
    back = byte_bpe.decode(byte_bpe.encode(edge, RANKS), RANKS)
    assert rows_of(back, "doc_id", "text") == sorted(((d, bytearray((t or "").encode())) for d, t, *_ in EDGE), key=repr)


def test_op7(spark, sf_dir, library):
    assert rows_of(queries.op7_byte_bpe(spark, sf_dir), *BPE) == digests(documents(spark, sf_dir), library)


# token records

def want_records(rows):
    library = Tokenizer.from_file(WORDS)
    out, start = [], 0
    for d, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


RECORD = ("doc_id", "start", "n_tokens", "ids_crc32")


def test_records_edges(spark, edge, nothing):
    folder = scratch_dir(spark, "records")
    token_records.write_records(edge, folder, WORDS, 2)
    assert rows_of(token_records.read_digests(spark, folder), *RECORD) == want_records(EDGE)
    ids = {r.doc_id: r.ids for r in token_records.read_records(spark, folder).filter("doc_id = 1").collect()}
    assert ids[1] == [*Tokenizer.from_file(WORDS).encode(EDGE[0][1], add_special_tokens=False).ids, 2]
    empty = scratch_dir(spark, "records")
    token_records.write_records(nothing, empty, WORDS, 2)
    assert token_records.read_digests(spark, empty).count() == 0


def test_marks_after_capitals(spark, make_docs):
    """Pairs that have a composed form in small letters only; the tokenizer composes before it lower-cases."""
    pairs = ["H\u0331", "J\u030c", "T\u0308", "W\u030a", "Y\u030a"]
    rows = [(k, f"Plain {p}asan x{p} {p} AND {p.lower()} \u00c9T{p}") for k, p in enumerate(pairs)]
    rows += [(10, "Hello World"), (11, "H\u0331 <|x HELLO"), (12, "\u212aELVIN Kelvin")]
    folder = scratch_dir(spark, "records")
    token_records.write_records(make_docs(rows), folder, WORDS, 2)
    assert rows_of(token_records.read_digests(spark, folder), *RECORD) == want_records(rows)


def test_word_encoder_equals_library():
    """Marks, capitals, apostrophes, signs among Latin-1 letters, marks that compose, and special strings."""
    r = random.Random(6)
    parts = ["a", "B", "tion", "'s", "'LL", "\u2019", "<|", "|>", "<|endoftext|>", "<", "=", "\u0338", "\u0301", "e", "\u00e9", "\u00c9", "\u00df", "\u00d7",
             "\u00f7", "\u00ff", "\u00de", "\u00c3", "\u03a3", "\u0130", "\u212a", "\u00aa", "1", "\u4e2d", "\u3000", "\0", "\u200d", ",", ".", "!", "_", " ", " ", "\n"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(30))) for _ in range(4000)]
    encoder = token_records.WordEncoder(WORDS, 2)
    want = [x.ids for x in encoder.library.encode_batch(texts, add_special_tokens=False)]
    raw = [t.encode() for t in texts]
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(raw)] == want
    assert encoder.counts(raw, common.Words(raw)).tolist() == list(map(len, want))


class Counting:
    """A tokenizer that notes how many texts it was given."""

    def __init__(self, library):
        self.library, self.texts = library, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.library.encode_batch_fast(texts, **options)


def test_new_words_go_to_the_library_together():
    """Words of letters in few texts, whatever marks end them; others one by one."""
    r = random.Random(7)
    words = sorted({"".join(r.choices("abcdefg\u00e9\u00c0", k=9)) for _ in range(1000)})
    texts = [" ".join(words), ", ".join(words) + "...", " ".join(words).upper()]
    encoder = token_records.WordEncoder(WORDS, 2)
    want = [x.ids for x in encoder.library.encode_batch(texts, add_special_tokens=False)]
    counting = encoder.library = Counting(encoder.library)
    assert encoder.counts([t.encode() for t in texts]).tolist() == list(map(len, want))
    assert counting.texts <= len(words) / token_records.JOINED + 3
    raw = [b"a1 b2 a1 \xe4\xb8\xad"]
    assert encoder.counts(raw).tolist() == [len(counting.library.encode(raw[0].decode(), add_special_tokens=False).ids)]


def test_joined_words_need_a_suffix_each():
    """Where ends of words are not told apart by one id each, every word goes to the library by itself."""
    texts = ["some plain words here", "and more of them"]
    encoder = token_records.WordEncoder(WORDS, 2)
    want = [len(x.ids) for x in encoder.library.encode_batch(texts, add_special_tokens=False)]
    for last in (np.zeros(0, bool), ~encoder.last, np.ones_like(encoder.last)):
        other = token_records.WordEncoder(WORDS, 2)
        other.last = last
        assert other.counts([t.encode() for t in texts]).tolist() == want


def test_lower_words():
    raw = ["ABC \u00c9D z@[`{ Z".encode(), b"", b" X\n"]
    low, want = common.Words(raw).lower(), common.Words([t.lower() for t in raw])
    assert low.buf.tobytes() == want.buf.tobytes() and low.first.tolist() == want.first.tolist()


def test_shards_grow_with_the_files(spark, sf_dir, monkeypatch):
    docs = common.table(spark, sf_dir, "documents")
    size = token_records.input_bytes(docs)
    assert 0 < size == token_records.input_bytes(docs.select("doc_id", "text").filter("doc_id > 0"))
    assert token_records.input_bytes(spark.range(5).crossJoin(spark.createDataFrame([(1,)], "a int"))) == 0
    found = {}
    for bytes_ in (size + 1, size // 9):
        monkeypatch.setattr(token_records, "SHARD_INPUT", bytes_)
        folder = scratch_dir(spark, "records")
        token_records.write_records(docs, folder, WORDS, 2)
        shards = spark.read.parquet(f"{folder}/manifest").count()
        found[shards] = rows_of(token_records.read_digests(spark, folder), "doc_id", "start", "n_tokens", "ids_crc32")
    few, many = sorted(found)
    assert few <= 4 < 9 <= many and found[few] == found[many]


def test_damaged_record_is_found(spark, make_docs):
    folder = scratch_dir(spark, "records")
    token_records.write_records(make_docs([(1, "some words here")]), folder, WORDS, 2, shards=1)
    name = spark.read.parquet(f"{folder}/manifest").filter("n_records = 1").first().file
    path = f"{folder}/{name}.rec".removeprefix("file://")
    with open(path, "r+b") as f:
        f.seek(-6, 2)
        byte = f.read(1)
        f.seek(-6, 2)
        f.write(bytes([byte[0] ^ 1]))
    with pytest.raises(Exception, match="damaged record"):
        token_records.read_digests(spark, folder).collect()


def test_op8(spark, sf_dir):
    assert rows_of(queries.op8_token_records(spark, sf_dir), *RECORD) == want_records(documents(spark, sf_dir))
