"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from milepost.llm import (
    alignment, byte_bpe, merkle, multi_index, packing, quality_gam, repetition_rules, simhash, substring_dedup,
    token_counts, token_records, toxicity, url_filter,
)
from milepost.llm.common import table
from milepost.session import scratch_dir


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of one tokenizer through a new cache; ``over_limit``: more than a context of 4096."""
    found = token_counts.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
        scratch_dir(spark, "token-cache"),
    )
    return found.selectExpr("doc_id", "n_bytes", "n_tokens", "n_tokens > 4096 AS over_limit")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removes 50-word windows that a smaller document holds."""
    found = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores, learned from the labels that are not held out."""
    found = quality_gam.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.selectExpr("doc_id", "held_out", "score", "CAST(score >= 0.5 AS int) AS predicted")


def op4_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition measures and verdicts."""
    return repetition_rules.repetition_measures(table(spark, sf_dir, "documents"))


#: Verdict, host and start of the path.
URL_RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules first; other URLs by a model that is trained on URLs which a rule decides."""
    pages = table(spark, sf_dir, "pages")
    verdict = url_filter.by_rule(URL_RULES, 0)
    labelled = url_filter.with_parts(pages.select("url")).select(
        "host", "path", F.when(verdict == "allow", 1).when(verdict == "block", 0).alias("label")
    )
    found = url_filter.judge(pages.select("page_id", "url"), URL_RULES, *url_filter.fit(labelled))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 3-word shingles and components of links at up to 2 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", simhash.hex_of().alias("fingerprint"), "component_id")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes; digests of both."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), path)


def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the ids as binary records and reads them back."""
    folder = scratch_dir(spark, "token-records")
    token_records.write_records(
        table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2
    )
    return token_records.read_digests(spark, folder)


def op9_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every 50th vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return multi_index.nearest_neighbours(vectors, vectors.filter("vec_id % 50 = 0"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of 4096 tokens; one document of a source or cluster in each."""
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096
    )


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores, learned from the labels that are not held out."""
    found = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.selectExpr("doc_id", "held_out", "score", "CAST(score >= 0.5 AS int) AS predicted")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of a byte-level and a piece vocabulary, and how common the links are."""
    return alignment.align(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, proofs and verification of all documents, every fifth (by the CRC-32 of its id) tampered with."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.verify(table(spark, sf_dir, "documents"), tampered)


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_quality_gam": op3_quality_gam,
    "op4_repetition_rules": op4_repetition_rules,
    "op5_url_filter": op5_url_filter,
    "op6_simhash": op6_simhash,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_token_records": op8_token_records,
    "op9_multi_index": op9_multi_index,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_toxicity": op11_toxicity,
    "op12_token_alignment": op12_token_alignment,
    "op13_merkle_manifest": op13_merkle_manifest,
}
_REMOVED_SQL = r"""WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d)),
seen AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
late AS (SELECT doc_id, i FROM win JOIN seen USING (k) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS pos FROM late, range(50) AS r(j)),
word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

# crc32 bit by bit: DuckDB has no function for it
_CRC_SQL = """list_reduce(list_prepend(4294967295::UBIGINT, [ascii(c)::UBIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [k::UBIGINT FOR k IN range(8)]),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END))"""
_FIELDS_SQL = " || ".join(
    f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars")
)
_MERKLE_SQL = f"""WITH RECURSIVE hit AS (SELECT *, coalesce(xor({_CRC_SQL}, 4294967295::UBIGINT) % 5 = 0, false) AS tampered
  FROM documents),
leaf AS (SELECT doc_id, source, sha256({_FIELDS_SQL} || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256({_FIELDS_SQL} || coalesce(strlen(t) || ':' || t, '-')) AS given
  FROM (SELECT *, CASE WHEN tampered
    THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS t FROM hit)),
ranked AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
    count(*) OVER (PARTITION BY source) AS n FROM leaf),
low AS (SELECT s, 0 AS h, r, n, leaf AS d FROM ranked UNION ALL
  SELECT s, any_value(h) + 1, r // 16, any_value((n + 15) // 16), sha256(string_agg(d, '' ORDER BY r))
  FROM low WHERE n > 1 GROUP BY s, r // 16),
sub AS (SELECT s, h, d FROM low WHERE n = 1),
high AS (SELECT 0 AS h, s AS r, (SELECT count(*) FROM sub) AS n, d FROM sub UNION ALL
  SELECT any_value(h) + 1, r // 16, any_value((n + 15) // 16), sha256(string_agg(d, '' ORDER BY r))
  FROM high WHERE n > 1 GROUP BY r // 16),
node AS (SELECT s, h, r, n, d FROM low UNION ALL SELECT -1, h, r, n, d FROM high),
kin AS (SELECT a.s, a.h, a.r, coalesce(string_agg(b.d, '' ORDER BY b.r) FILTER (b.r < a.r), '') AS l,
    coalesce(string_agg(b.d, '' ORDER BY b.r) FILTER (b.r > a.r), '') AS g
  FROM node a JOIN node b ON a.s = b.s AND a.h = b.h AND a.r // 16 = b.r // 16 WHERE a.n > 1 GROUP BY a.s, a.h, a.r),
up AS (SELECT k.*, k.source_row AS x FROM (SELECT row_number() OVER () AS source_row, q.*, sub.h AS depth, sub.d AS subroot
    FROM ranked q JOIN sub USING (s)) k),
fold AS (SELECT x, 0 AS step, given AS acc, '' AS sibs FROM up UNION ALL
  SELECT x, step + 1, sha256(l || acc || g), sibs || l || g FROM fold JOIN up USING (x)
  JOIN kin ON kin.s = CASE WHEN step < depth THEN up.s ELSE -1 END
    AND kin.h = CASE WHEN step < depth THEN step ELSE step - depth END
    AND kin.r = CASE WHEN step < depth THEN up.r // (16 ** step)::BIGINT ELSE up.s // (16 ** (step - depth))::BIGINT END)
SELECT doc_id, leaf, subroot, root, sha256(sibs) AS proof_sha256, acc AS folded_root, acc = root AS verified
FROM (SELECT x, arg_max(acc, step) AS acc, arg_max(sibs, step) AS sibs FROM fold GROUP BY x) JOIN up USING (x),
  (SELECT d AS root FROM high WHERE n = 1)"""

#: What SQL can express; the other queries are tested against brute force.
ORACLES: dict[str, str] = {"op2_substring_dedup": _REMOVED_SQL, "op13_merkle_manifest": _MERKLE_SQL}
