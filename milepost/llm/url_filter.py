"""URL filter: host and path rules, and a logistic regression where no rule fits.

The regression sees hashed character n-grams of host and path. It is trained by gradient descent on
a small labelled table of URLs (at most ``max_rows``, chosen by a hash of the URL): each step is one
aggregate over the table that gives a weight's gradient per bucket, ``BUCKETS`` numbers at most.
Scoring is an array expression on each row: no explode, join or shuffle, whatever the size of the
table. Only DataFrame and SQL functions are used.

Defined cases: a NULL URL, or one without ``://``, has empty host and path, fits no rule and is judged
by the model; the longest fitting rule wins, among equally long ones the first in text order; without
labelled URLs the model allows; equal rows get equal results; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from milepost.session import cut_lineage

#: Weights of the model, and the lengths of its n-grams.
BUCKETS = 4096
SIZES = (3, 4, 5)

#: (verdict, host, start of the path)
Rule = tuple[str, str, str]


def with_parts(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host (A-Z lower-cased) and path of each URL."""
    url = F.col(f"`{url_col}`")
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))

    def part(group: int) -> Column:
        return F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", group), F.lit(""))

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return urls.withColumn("host", F.translate(part(1), upper, upper.lower())).withColumn("path", part(2))


def by_rule(rules: list[Rule], value: int) -> Column:
    """A field of the longest rule that fits (0: verdict; 1: its text), or NULL."""
    out = F.lit(None).cast("string")
    for verdict, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]), reverse=True):
        fits = (F.col("host") == host) | F.endswith("host", F.lit("." + host))
        fits &= F.startswith("path", F.lit(path))
        out = F.when(fits, F.lit((verdict, host + path)[value])).otherwise(out)
    return out


def features() -> Column:
    """Buckets of the n-grams of host and path, each counted once."""
    text = "concat('^', host, '|', path, '$')"
    grams = ", ".join(
        f"IF(length({text}) < {n}, array(), transform(sequence(1, length({text}) - {n - 1}),"
        f" i -> pmod(xxhash64(substring({text}, i, {n})), {BUCKETS})))"
        for n in SIZES
    )
    return F.expr(f"array_distinct(concat({grams}))")


def _weights(values: list[float]) -> str:
    """The weights as one constant array."""
    return f"cast(split('{','.join(map(repr, values))}', ',') AS array<double>)"


def score(weights: list[float], bias: float, grams: str = "grams") -> Column:
    """Probability of label 1: logistic of the mean-scaled sum of the weights."""
    total = f"aggregate({grams}, 0D, (s, g) -> s + element_at({_weights(weights)}, cast(g + 1 AS int)))"
    return F.expr(f"1D / (1D + exp(-({bias!r}D + {total} / sqrt(greatest(size({grams}), 1)))))")


def fit(labelled: DataFrame, max_rows: int = 2000, steps: int = 25, rate: float = 4.0,
        momentum: float = 0.8, decay: float = 1e-3) -> tuple[list[float], float]:
    """Weights and bias from host, path and label (0 or 1), both classes counting alike."""
    table = cut_lineage(
        labelled.filter("label IS NOT NULL").select("host", "path", F.col("label").cast("double").alias("label"))
        .orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(max_rows)
        .withColumn("grams", features()), "labelled-urls",
    )
    weights, bias = [0.0] * BUCKETS, 0.0
    n, ones = table.agg(F.count("*"), F.sum("label")).first()
    if not n or not 0 < ones < n:
        return weights, bias
    share = F.when(F.col("label") > 0.5, F.lit(0.5 / ones)).otherwise(F.lit(0.5 / (n - ones)))
    speed, bias_speed = [0.0] * BUCKETS, 0.0
    for _ in range(steps):
        error = table.select("grams", ((F.col("label") - score(weights, bias)) * share).alias("e"))
        # bucket -1 gathers the bias
        slopes = (
            error.select(F.explode(F.concat("grams", F.array(F.lit(-1).cast("long")))).alias("g"),
                         (F.col("e") / F.sqrt(F.size("grams"))).alias("x"), "e")
            .groupBy("g").agg(F.sum("x").alias("x"), F.sum("e").alias("e")).collect()
        )
        speed = [momentum * v - rate * decay * w for v, w in zip(speed, weights)]
        for g, x, e in slopes:
            if g < 0:
                bias_speed = momentum * bias_speed + rate * e
            else:
                speed[g] += rate * x
        weights = [w + v for w, v in zip(weights, speed)]
        bias += bias_speed
    if not all(map(math.isfinite, weights)):
        raise ArithmeticError("training diverged; lower the rate")
    return weights, bias


def judge(urls: DataFrame, rules: list[Rule], weights: list[float], bias: float, url_col: str = "url") -> DataFrame:
    """The rows with host, path, rule, score and verdict (columns of those names are replaced)."""
    parts = with_parts(urls, url_col).withColumn("rule", by_rule(rules, 1))
    scored = parts.withColumn("grams", features()).withColumn("score", score(weights, bias)).drop("grams")
    fallback = F.when(F.col("score") >= 0.5, F.lit("allow")).otherwise(F.lit("block"))
    return scored.withColumn("verdict", F.coalesce(by_rule(rules, 0), fallback))
