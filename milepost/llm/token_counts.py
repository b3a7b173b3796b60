"""Token counts through a digest cache.

Each text is reduced to the digest of its normalised content; counts live in a Parquet cache keyed
by that digest and a digest of the tokenizer's version (file and library). A run joins its digests
to the cache, encodes each missing content once and appends the new counts.

The tokenizer's own normaliser leaves the text as it is, so normalising here is: NULL is empty text.

Words are encoded once per task: the vocabulary has no piece with the word mark after another
character, so merges never cross the start of a word and a text's pieces are those of its words.
``word_safe`` checks both properties of the model; a model without them is given whole texts.

Defined cases: NULL and empty texts have 0 tokens; equal texts share one cache line; a NULL id is
kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from pyspark.errors import AnalysisException

from milepost.llm.common import steps, texts_of
from milepost.operators.skew import one_per_key
from milepost.session import cut_lineage

#: Words kept by a task: two generations of so many, each up to so many characters.
KNOWN_WORDS, KEPT_WORD = 250_000, 32
#: Missing digests (32 bytes each) that are broadcast to the texts.
FEW = 50_000
MARK = "▁"
CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"


def tokenizer_version(model_path: str) -> str:
    """Digest of the model file and of the library that reads it."""
    with open(model_path, "rb") as f:
        body = f.read()
    return hashlib.sha256(body + sentencepiece.__version__.encode()).hexdigest()


def word_safe(model: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether words can be encoded one by one: text is not normalised, no piece crosses words."""
    if any(MARK in model.id_to_piece(i).lstrip(MARK) for i in range(model.get_piece_size())):
        return False
    probe = "  aÄﬁ  b 　 c "
    return model.decode(model.encode(probe)) == probe and not model.encode("")


class WordCounter:
    """Numbers of pieces, with a bounded table of words."""

    def __init__(self, model_path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.by_word = word_safe(self.model)
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.words = re.compile(f"{MARK}+[^{MARK}]*").findall

    def count(self, texts: list[str]) -> list[int]:
        if not self.by_word:
            return list(map(len, self.model.encode(texts, num_threads=1)))
        split = [self.words(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        table = self.known
        new = set().union(*split).difference(table)
        for w in new.intersection(self.older):
            table[w] = self.older[w]
        new = list(new.difference(table))
        # the library puts the first mark itself; a lone mark would be empty text to it
        table.update(zip(new, map(len, self.model.encode([w[1:] for w in new], num_threads=1))))
        table[MARK] = 1
        counts = [sum(map(table.__getitem__, words)) for words in split]
        if len(table) > KNOWN_WORDS:
            self.older = {w: n for w, n in table.items() if len(w) <= KEPT_WORD}
            self.known = {}
        return counts


def _encode(model_path: str, version: str):
    def run(batches):
        counter = WordCounter(model_path)
        for batch in steps(batches):
            counts = counter.count(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("content"), pa.array([version] * len(counts), pa.string()),
                 pa.array(counts, pa.int64())],
                ["content", "tokenizer", "n_tokens"],
            )

    return run


def cached_counts(spark, cache_dir: str, version: str) -> DataFrame:
    """The cache's counts of one tokenizer; lines written twice count once."""
    try:
        cache = spark.read.schema(CACHE_SCHEMA).parquet(cache_dir)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        cache = spark.createDataFrame([], CACHE_SCHEMA)
    return one_per_key(
        cache.filter(F.col("tokenizer") == version), ["content"], F.max("n_tokens").alias("n_tokens")
    )


def token_counts(docs: DataFrame, model_path: str, cache_dir: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, content (digest), n_tokens of every row; new counts go to ``cache_dir``.

    Which digests are missing is found among digests alone. With none missing no text moves; up to ``FEW`` are
    broadcast, so that only their texts do. Equal texts are merged by a partial aggregate before the shuffle, so a
    group of copies sends one text per task. The counts are joined back to narrow rows.
    """
    spark = docs.sparkSession
    version = tokenizer_version(model_path)
    keyed = texts_of(docs, id_col, text_col).withColumn("content", F.unhex(F.sha2("text", 256)))
    digests = one_per_key(keyed.select("content"), ["content"])
    missing = cut_lineage(
        digests.join(cached_counts(spark, cache_dir, version), "content", "left_anti"), "missing-digests"
    )
    n = missing.count()
    if n:
        wanted = keyed.select("content", "text")
        if n <= FEW:
            wanted = wanted.join(F.broadcast(missing), "content", "left_semi").dropDuplicates(["content"])
        else:
            wanted = wanted.dropDuplicates(["content"]).join(missing, "content", "left_semi")
        wanted.mapInArrow(_encode(model_path, version), CACHE_SCHEMA).write.mode("append").parquet(cache_dir)
    narrow = keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content")
    return narrow.join(cached_counts(spark, cache_dir, version), "content").select(
        "doc_id", "n_bytes", "n_tokens", "content"
    )
