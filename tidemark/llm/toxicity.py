"""Toxicity by a weighted lexicon that is matched with an Aho-Corasick automaton.

Texts are folded first: case, look-alike letters of other scripts, accents on Latin
look-alikes, and digits or signs in place of letters inside words; everything but
letters and digits becomes one space. Entries are beginnings of words and whole
words. Where several entries match at one place, the heaviest counts, and none
inside an exception phrase. The sum of weights, also in proportion to the length,
goes through a logistic curve.

Entries and weights are learned: ``SAMPLE`` labelled documents of each class at most
(chosen by a hash of their id, one per distinct text) give the log odds of each
beginning of a word. The rest covers all documents.

A null or empty text has no match and gets the score of an empty text. Labels that
are null are left out; a document with several labels counts once by the largest.
Without labelled documents of both classes the lexicon is empty and every score 0.
Repeated rows get rows of their own; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

#: Labelled documents of a class that the lexicon is learned from.
SAMPLE = 4000
#: Entries of the lexicon, and counts that a worker holds before it hands them on.
ENTRIES, HELD = 4000, 200_000
#: Letters of the beginnings of words; documents that must have an entry; least z of its log odds.
SHORTEST, LONGEST, LEAST, SURE = 3, 7, 4, 2.0

# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w",
    "х": "x", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ο": "o", "ⅼ": "l", "ⅰ": "i", "ꜱ": "s",
}
# Digits and signs that stand for letters inside a word.
STAND_INS = str.maketrans("013457@$!|", "oieastasii")
#: Phrases in which an entry is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "pond scum", "loser bracket")

_STAND_IN = re.compile(r"(?<=[^\W\d_])[013457@$!|]+(?=[^\W\d_])|(?<![\w@$!|])[013457@$|]+(?=[^\W\d_]{2})|(?<=[^\W\d_]{2})[01345@$|](?!\w)")
_OTHER = re.compile(r"[\W_]+")
_FOLDS = {ord(k): v for k, v in LOOK_ALIKES.items()}


def folded(text: str | None) -> str:
    """The text as lower-case words between single spaces, with a space at either end."""
    if not text:
        return " "
    if text.isascii():
        text = text.lower()
    else:
        text = unicodedata.normalize("NFKC", text).lower().translate(_FOLDS)
    text = _STAND_IN.sub(lambda m: m[0].translate(STAND_INS), text)
    return f" {_OTHER.sub(' ', text).strip()} " if text.strip() else " "


def beginnings(text: str) -> set[str]:
    """Entries that a folded text could match: beginnings of words, whole words with a space."""
    out = set()
    for word in set(text.split()):
        if len(word) >= SHORTEST:
            out.update(f" {word[:k]}" for k in range(SHORTEST, min(LONGEST, len(word)) + 1))
            out.add(f" {word} ")
    return out


@dataclass
class Lexicon:
    """Weights of entries, exception phrases, and the logistic curve over the features."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, ...] = (-40.0, 0.0, 0.0, 0.0)

    def automaton(self):
        made = ahocorasick.Automaton()
        for phrase in self.exceptions:
            made.add_word(f" {phrase} ", (0.0, len(phrase) + 2, ""))
        for entry, weight in self.weights.items():
            made.add_word(entry, (weight, len(entry), entry))
        made.make_automaton()
        return made


def features(text: str, automaton) -> tuple[float, float, float]:
    """Sum of weights of different entries, of all matches by length, and number of entries."""
    best: dict[int, tuple[float, str]] = {}
    spared: list[tuple[int, int]] = []
    for end, (weight, size, entry) in automaton.iter(text):
        start = end - size + 1
        if not entry:
            spared.append((start, end))
        elif weight > best.get(start, (0.0, ""))[0]:
            best[start] = weight, entry
    if spared:
        best = {s: b for s, b in best.items() if not any(x <= s < y for x, y in spared)}
    different = {entry: weight for weight, entry in best.values()}
    total = sum(weight for weight, _ in best.values())
    whole = sum(different.values())
    return math.log1p(whole), total / math.sqrt(text.count(" ") + 20), math.log1p(len(different))


def _chosen(documents: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """At most ``SAMPLE`` documents of each class, as (text, toxic)."""
    clean = labels.where(usable & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    clean = clean.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64("doc_id")
    some = [clean.where(F.col("toxic") == t).orderBy(order, "doc_id").limit(SAMPLE) for t in (0, 1)]
    picked = some[0].unionByName(some[1])
    # At most two samples of ids, so sending them to every task is bounded.
    joined = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return joined.groupBy(F.xxhash64("text"), F.length("text"), "toxic").agg(F.first("text").alias("text")).select("text", "toxic")


def _frequencies(sample: DataFrame) -> DataFrame:
    schema = pa.schema([("entry", pa.string()), ("n", pa.int64())])

    def work(batches):
        seen: Counter[str] = Counter()
        for (text,) in common.rows(batches, "text"):
            seen.update(beginnings(folded(text)))
            if len(seen) >= HELD:
                yield common.batch_of(schema, [list(seen), list(seen.values())])
                seen.clear()
        yield common.batch_of(schema, [list(seen), list(seen.values())])

    counted = sample.select("text").mapInArrow(work, "entry string, n long")
    return counted.groupBy("entry").agg(F.sum("n").alias("n"))


def _weighed(sample: DataFrame, toxic: int, clean: int) -> DataFrame:
    """``(entry, n, odds)`` of every entry whose log odds are large and sure enough."""
    often = _frequencies(sample.where("toxic = 1")).where(F.col("n") >= LEAST)
    other = _frequencies(sample.where("toxic = 0")).withColumnRenamed("n", "m")
    n, m = F.col("n"), F.coalesce("m", F.lit(0))
    odds = F.log((n + 0.5) / (toxic - n + 0.5)) - F.log((m + 0.5) / (clean - m + 0.5))
    z = F.col("odds") / F.sqrt(1 / (n + 0.5) + 1 / (m + 0.5))
    return often.join(other, "entry", "left").withColumn("odds", odds).where((z >= SURE) & (F.col("odds") > 2)).select("entry", "n", "odds")


def _fit(x: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, ...]:
    """Logistic regression by Newton's method, moved to the share of class 1 in the corpus."""
    scale = np.maximum(x.std(axis=0), 1e-6)
    design = np.column_stack([np.ones(len(x)), x / scale])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        penalty = np.diag([1e-6] + [1e-2] * x.shape[1])
        step = np.linalg.solve(design.T * (p * (1 - p)) @ design + penalty, design.T @ (y - p) - penalty @ beta)
        beta += np.clip(step, -5, 5)
    share = y.mean()
    beta[0] += math.log(prior / (1 - prior)) - math.log(share / (1 - share))
    return (float(beta[0]), *(float(b) for b in beta[1:] / scale))


def learn(documents: DataFrame, labels: DataFrame, usable: Column, exceptions=EXCEPTIONS) -> Lexicon:
    """The lexicon from the labelled documents for which ``usable`` holds.

    What reaches the driver is bounded: class sizes, the ``ENTRIES`` best entries, and the
    features of the sample.
    """
    room = common.scratch(documents.sparkSession, "toxicity")
    sample = room.save(_chosen(documents, labels, usable), "sample")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    shares = labels.where(usable).groupBy("toxic").count().collect()
    known = {r["toxic"]: r["count"] for r in shares if r["toxic"] is not None}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Lexicon(exceptions=exceptions)
    weight = F.col("odds") * F.sqrt("n")
    best = _weighed(sample, toxic, clean).orderBy(F.desc(weight), "entry").limit(ENTRIES).collect()
    lexicon = Lexicon({r["entry"]: r["odds"] for r in best}, exceptions)
    if not best:
        return lexicon
    schema = pa.schema([("a", pa.float64()), ("b", pa.float64()), ("c", pa.float64()), ("toxic", pa.int32())])

    def work(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            made = [features(folded(t), automaton) for t in texts]
            columns = list(zip(*made)) if made else [[], [], []]
            yield common.batch_of(schema, [*columns, batch.column("toxic")])

    rows = sample.mapInArrow(work, "a double, b double, c double, toxic int").collect()
    x = np.array([(r["a"], r["b"], r["c"]) for r in rows])
    y = np.array([r["toxic"] for r in rows], dtype=float)
    prior = known.get(1, 1) / max(1, known.get(1, 1) + known.get(0, 1))
    lexicon.curve = _fit(x, y, min(max(prior, 1e-6), 1 - 1e-6))
    return lexicon


def score(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``documents`` with ``toxicity`` from 0 to 1 and the number of entries that match."""
    schema_text = "toxicity double, entries long"
    names = documents.columns

    def work(batches):
        automaton = lexicon.automaton() if lexicon.weights else None
        bias, *slopes = lexicon.curve
        for batch in batches:
            scores, entries = [], []
            for (text,) in common.rows([batch], "text"):
                made = features(folded(text), automaton) if automaton else (0.0, 0.0, 0.0)
                z = bias + sum(s * f for s, f in zip(slopes, made))
                scores.append(1 / (1 + math.exp(-min(max(z, -700), 700))))
                entries.append(round(math.expm1(made[2])))
            columns = [batch.column(k) for k in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(scores, pa.float64()), pa.array(entries, pa.int64())],
                names=[*names, "toxicity", "entries"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(work, f"{fields}, {schema_text}")


def report(documents: DataFrame, lexicon: Lexicon, held_out: Column) -> DataFrame:
    """``(doc_id, held_out, score, predicted, entries)`` of every document."""
    scored = score(documents.select("doc_id", "text"), lexicon)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        "entries",
    )


def reject(documents: DataFrame, lexicon: Lexicon, threshold: float = 0.5) -> DataFrame:
    """The documents whose score is below ``threshold``, with their own columns."""
    own = documents.columns
    inner = [f"_{k}" for k in range(len(own))]
    renamed = documents.select(*(F.col(c).alias(n) for c, n in zip(own, inner, strict=True) if c != "text"), "text")
    kept = score(renamed, lexicon).where(F.col("toxicity") < threshold)
    return kept.select(*(F.col("text" if c == "text" else n).alias(c) for c, n in zip(own, inner, strict=True)))
