"""Mixing documents to target weights of domains, with soft membership.

A classifier that is learned from a labelled table (Gaussian naive Bayes over shape
features of the text) gives each document its domain posteriors. Rates, how often
each document is expected to be drawn, are the nonnegative least-squares fit of the
expected tokens per domain to their targets. It is found by projected gradient steps
from rates of 1, in the metric of tokens (so a rate depends on what a document is, not
on its length) and with residuals scaled by the inverse of the small domain-by-domain
matrix. Every step is one aggregate over the documents that gives the few domain
residuals, and a document's rate is a function of its posteriors and of all residuals
so far, so no rates are stored between steps.

Only DataFrame functions are used. A null or empty text has no tokens, posteriors
equal to the priors and the rate 1. Null labels are left out. A domain without
labelled documents has posterior 0. Without labelled documents all rates are 1.
Repeated rows get rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

#: Most steps of the fit, and the gap to the targets, as a part of all tokens, that ends it.
STEPS, CLOSE = 12, 1e-4
#: Added to the variance of a feature.
FLOOR = 1e-4


def features(text: Column) -> dict[str, Column]:
    """Shape of a text: shares of kinds of signs, length of words and lines."""
    size = F.greatest(F.length(text), F.lit(1)).cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / size

    words = F.regexp_count(text, F.lit(r"\s+")) + F.lit(1.0)
    return {
        "signs": share(r"[#$%&*+|<>=~^_@\\/{}\[\]]"),
        "digits": share(r"[0-9]"),
        "stops": share(r"[.,;:!?]"),
        "capitals": share(r"\p{Lu}"),
        "breaks": share(r"\n"),
        "word": F.log(size / words + 1),
        "size": F.log(size + 1),
    }


def tokens(text: Column) -> Column:
    """Words of the text: runs without white space."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("double")


def learn(described: DataFrame, labels: DataFrame, domain: Column, names: list[str]) -> dict[str, dict]:
    """Prior, means and variances of each domain, from one aggregate over its labelled documents."""
    marked = labels.select("doc_id", domain.alias("_domain")).where("doc_id is not null and _domain is not null")
    marked = marked.groupBy("doc_id").agg(F.min("_domain").alias("_domain"))
    known = described.where("_tokens > 0").join(marked, "doc_id")
    moments = [f(F.col(f"_{n}")).alias(f"{k}_{n}") for n in names for k, f in (("m", F.avg), ("v", F.var_pop))]
    rows = known.groupBy("_domain").agg(F.count("*").alias("n"), *moments).collect()  # one a domain
    return {r["_domain"]: r.asDict() for r in rows}


def posteriors(model: dict[str, dict], names: list[str]) -> Column:
    """Array of posteriors in the order of the domains' names."""
    total = sum(m["n"] for m in model.values())
    logs = []
    for name in sorted(model):
        m = model[name]
        log = F.lit(math.log(m["n"] / total))
        for n in names:
            spread = m[f"v_{n}"] + FLOOR
            log = log - F.pow(F.col(f"_{n}") - m[f"m_{n}"], 2) / (2 * spread) - 0.5 * math.log(spread)
        logs.append(F.when(F.col("_tokens") > 0, log).otherwise(F.lit(math.log(m["n"] / total))))
    scores = F.array(*logs)
    top = F.array_max(scores)
    powers = F.transform(scores, lambda x: F.exp(x - top))
    mass = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / mass)


def rate(steps: list[list[float]], most: float | None) -> Column:
    """Rate after the given steps, each the pull of every domain; ``most`` bounds it, if given."""
    if not steps:
        return F.lit(1.0)

    def step(before: Column, pull: Column) -> Column:
        after = F.greatest(F.lit(0.0), before - sum((F.col("_p")[k] * pull[k] for k in range(len(steps[0]))), F.lit(0.0)))
        return after if most is None else F.least(F.lit(float(most)), after)

    pulls = F.array(*(F.array(*(F.lit(float(x)) for x in pull)) for pull in steps))
    return F.when(F.col("_tokens") > 0, F.aggregate(pulls, F.lit(1.0), step)).otherwise(1.0)


def totals(described: DataFrame, size: int) -> tuple[list[float], np.ndarray]:
    """Tokens of each domain at rate 1, and the matrix of tokens by pairs of domains."""
    sums = [F.sum(F.col("_tokens") * F.col("_p")[k]).alias(f"t{k}") for k in range(size)]
    pairs = [
        F.sum(F.col("_tokens") * F.col("_p")[k] * F.col("_p")[j]).alias(f"g{k}_{j}") for k in range(size) for j in range(k, size)
    ]
    row = described.agg(*sums, *pairs).first()
    matrix = [[row[f"g{min(k, j)}_{max(k, j)}"] or 0.0 for j in range(size)] for k in range(size)]
    return [row[f"t{k}"] or 0.0 for k in range(size)], np.array(matrix)


def fit(described: DataFrame, targets: list[float], matrix: np.ndarray, most: float | None) -> list[list[float]]:
    """The steps of the fit; it ends when the expected tokens are close to the targets or stand still."""
    steps: list[list[float]] = []
    size, whole = len(targets), sum(targets) or 1.0
    inverse = np.linalg.pinv(matrix, rcond=1e-6, hermitian=True)
    before = None
    for _ in range(STEPS):
        drawn = F.col("_tokens") * rate(steps, most)
        row = described.agg(*(F.sum(drawn * F.col("_p")[k]).alias(f"t{k}") for k in range(size))).first()
        gap = np.array([(row[f"t{k}"] or 0.0) - t for k, t in enumerate(targets)])
        if np.abs(gap).max() <= CLOSE * whole or before is not None and np.abs(gap - before).max() <= 1e-3 * CLOSE * whole:
            break
        before = gap
        steps.append((inverse @ gap).tolist())
    return steps


def _rated(documents: DataFrame, labels: DataFrame, domain: Column, weights: dict[str, float], most: float | None) -> DataFrame:
    """``(doc, tokens, domains, rate)``: each row whole in one struct, so that no name of its columns can clash."""
    room = common.scratch(documents.sparkSession, "mixing")
    text = F.coalesce("text", F.lit(""))
    shape = features(text)
    names = list(shape)
    keys = documents.select("doc_id", F.xxhash64("text").alias("_key"), tokens(text).alias("_tokens"), *(c.alias(f"_{n}") for n, c in shape.items()))
    described = room.save(keys, "described")
    model = learn(described, labels, domain, names)
    domains = sorted(model)
    keyed = documents.select(F.struct("*").alias("doc"), F.xxhash64("text").alias("key"))
    if not domains:
        plain = tokens(F.coalesce("doc.text", F.lit("")))
        nowhere = F.expr("map()").cast("map<string,double>")
        return keyed.select("doc", plain.alias("tokens"), nowhere.alias("domains"), F.lit(1.0).alias("rate"))
    judged = room.save(described.select("doc_id", "_key", "_tokens", posteriors(model, names).alias("_p")), "judged")
    have, matrix = totals(judged, len(domains))
    share = np.array([weights.get(d, 0.0) for d in domains])
    share = share / (share.sum() or 1.0)
    budget = sum(have)
    if most is not None:
        budget = min([most * h / s for h, s in zip(have, share) if s], default=0.0)
    steps = fit(judged, (share * budget).tolist(), matrix, most)
    rated = judged.select("doc_id", "_key", "_tokens", "_p", rate(steps, most).alias("rate")).dropDuplicates(["doc_id", "_key"])
    by_name = F.map_from_arrays(F.array(*(F.lit(d) for d in domains)), F.col("_p"))
    rated = rated.select(F.col("doc_id").alias("id"), F.col("_key").alias("hash"), F.col("_tokens").alias("tokens"), by_name.alias("domains"), "rate")
    same = F.col("doc.doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("hash"))
    return keyed.join(rated, same).select("doc", "tokens", "domains", "rate")


def mix(documents: DataFrame, labels: DataFrame, domain: Column, weights: dict[str, float], most: float | None = None) -> DataFrame:
    """``documents`` with ``_tokens``, ``_domains`` (posteriors by domain) and ``_rate``, in place of columns so named.

    Targets are ``weights`` (scaled to 1) of all tokens; with ``most``, of as many
    tokens as the domains can give without a rate above it.
    """
    rated = _rated(documents, labels, domain, weights, most)
    own = {"_tokens": F.col("tokens"), "_domains": F.col("domains"), "_rate": F.col("rate")}
    return rated.select(*(F.col("doc")[c].alias(c) for c in documents.columns if c not in own), *(c.alias(n) for n, c in own.items()))


def draw(documents: DataFrame, labels: DataFrame, domain: Column, weights: dict[str, float], most: float | None = None) -> DataFrame:
    """Each of ``documents``, with all its columns, as often as its rate in ``mix`` says: its whole part, and
    once more by a hash of id and text."""
    chance = F.pmod(F.xxhash64(F.lit("draw"), "doc.doc_id", "doc.text"), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor(F.col("rate") + chance).cast("int")
    often = _rated(documents, labels, domain, weights, most).withColumn("copies", copies).where("copies > 0")
    return often.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
