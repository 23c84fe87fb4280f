"""Language-model scores of word n-grams by a weighted backoff automaton.

The model is smoothed by interpolation: a history ``h`` seen ``c`` times gives
``P(w|h) = (1 - l(c)) * n(hw) / c + l(c) * P(w|h')`` with ``h'`` one word shorter;
``l(c)`` is the share of new words to expect after a sample of ``c`` tokens of the
corpus. Single words are discounted by Good and Turing's rule, which gives their
unseen mass to one unknown word. It sums to 1 over the known words and the unknown.

The states of the automaton are the empty history and the n-grams seen in training that are
shorter than the order. A state has an arc for each word seen after it, of weight ``log10 P(w|h)``, to
the state of the longest history the word makes; a failure arc of weight ``log10 l(c)`` leads to
the state one word shorter, and the empty state has an arc for every word. A text is read once from
left to right: a state is carried from word to word, failure arcs are followed until there is an arc,
and the weights on the way are summed. All texts of a block are read in step. As a state depends on
the last words only, a long text is read in stretches that each begin a few words early.

No worker holds the model: each block of documents, of bounded size, builds the part of
the automaton that its own n-grams can reach. A block asks for the n-grams that occur in it, sends along how often its training documents
have them, and gets back their counts over the corpus. n-grams meet by a hash, dealt
evenly over slices, so frequent words make no hot key: each is one entry per block.

A null text is empty and has one token, the end. Repeated rows count as often as they
occur. Without training documents every token is unknown. An empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.sources.fs import FileSystem

#: Tokens after which a block ends.
BLOCK_TOKENS = 700_000
#: Tokens of a text that are read in one go.
STRETCH = 1024
END = b""
BLOCKS = (
    "kind string, block long, gram int, slice int, doc_id long, held_out boolean, ids binary, hashes binary, counts binary"
)
BLOCKS_ARROW = pa.schema(
    [
        ("kind", pa.string()),
        ("block", pa.int64()),
        ("gram", pa.int32()),
        ("slice", pa.int32()),
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("ids", pa.binary()),
        ("hashes", pa.binary()),
        ("counts", pa.binary()),
    ]
)
#: Words meet by 64 bits, longer n-grams by 48: a rare collision moves a score by next to nothing.
KEPT_BITS = np.uint64(0xFFFFFFFFFFFF0000)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def squeezed(values: np.ndarray, rising: bool = False) -> bytes:
    """Bytes of unsigned numbers by place, compressed; of rising ones the steps."""
    values = values.astype("<u8")
    if rising and len(values):
        values = np.diff(values, prepend=np.uint64(0))
    planes = values.view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def restored(data: bytes, rising: bool = False) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    if not size:
        return np.empty(0, dtype=np.uint64)
    planes = pa.decompress(data[8:], 8 * size, codec="zstd", asbytes=True)
    values = np.frombuffer(planes, dtype=np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()
    return np.cumsum(values, dtype=np.uint64) if rising else values


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MULTIPLIER
    return x ^ (x >> np.uint64(29))


def grams(ids: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, order: int):
    """For each length up to ``order``: hashes of the n-grams that end at each token, and which exist."""
    place = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    own = hashes[ids]
    current = own
    yield current, np.ones(len(ids), dtype=bool)
    for size in range(2, order + 1):
        longer = np.zeros_like(current)
        longer[1:] = _mixed(current[:-1] * np.uint64(2 * size + 1) + own[1:])
        current = longer
        yield current & KEPT_BITS, place >= size - 1


def _blocks(documents: DataFrame, order: int, slices: int) -> DataFrame:
    """Documents as numbers of their block's words, and the n-grams each block asks for."""
    edges = np.array([(k << 64) // slices for k in range(1, slices)], dtype=np.uint64)

    def flush(block, words, held):
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))
        by_hash = np.argsort(hashes, kind="stable")
        rank = np.empty(len(words), dtype=np.int32)
        rank[by_hash] = np.arange(len(words), dtype=np.int32)
        out = [
            ("doc", block, 0, 0, key, held_out, pa.compress(rank[ids].astype("<i4").tobytes(), codec="zstd", asbytes=True), None, len(ids).to_bytes(8, "little"))
            for key, held_out, ids in held
        ]
        sizes = np.array([len(ids) for _, _, ids in held])
        every = rank[np.concatenate([ids for _, _, ids in held])]
        training = np.repeat(np.array([not h for _, h, _ in held]), sizes)
        for size, (keys, exist) in enumerate(grams(every, sizes, hashes[by_hash], order), 1):
            found, which = np.unique(keys[exist], return_inverse=True)
            counts = np.bincount(which, training[exist], len(found)).astype(np.uint64)
            cuts = np.searchsorted(found, edges).tolist()
            for number, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(found)])):
                out.append(("ask", block, size, number, None, None, None, squeezed(found[a:b], True), squeezed(counts[a:b])))
        for at in range(0, len(out), 1024):
            yield common.batch_of(BLOCKS_ARROW, list(zip(*out[at : at + 1024])))

    def work(batches):
        block = TaskContext.get().partitionId() << 24
        words, held, tokens = {END: 0}, [], 0
        for key, held_out, text in common.rows(batches, "doc_id", "held_out", "text"):
            found = (text or "").encode().lower().split()
            ids = [words.setdefault(w, len(words)) for w in found]
            ids.append(0)
            held.append((key, held_out, np.array(ids, dtype=np.int32)))
            tokens += len(ids)
            if tokens >= BLOCK_TOKENS:
                yield from flush(block, words, held)
                words, held, tokens, block = {END: 0}, [], 0, block + 1
        if held:
            yield from flush(block, words, held)

    return documents.mapInArrow(work, BLOCKS)


ANSWERS = "block long, gram int, slice int, hashes binary, counts binary, words array<long>, tokens array<long>"
ANSWERS_ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("gram", pa.int32()),
        ("slice", pa.int32()),
        ("hashes", pa.binary()),
        ("counts", pa.binary()),
        ("words", pa.list_(pa.int64())),
        ("tokens", pa.list_(pa.int64())),
    ]
)
BINS = 64


def _answered(asked: DataFrame) -> DataFrame:
    """Counts over the corpus of what each block asked for, and a histogram of the words' counts.

    ``words`` has the number of words by ``floor(log2(count))``, those seen once and
    twice apart in the last two places; ``tokens`` has their tokens.
    """

    def work(table: pa.Table) -> pa.Table:
        rows = table.select(["block", "gram", "slice", "hashes", "counts"]).to_pylist()
        keys = [restored(r["hashes"], True) for r in rows]
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(which, np.concatenate([restored(r["counts"]) for r in rows]).astype(np.float64))
        answers = total[which].astype(np.uint64)
        out, at, first = [], 0, rows[0]["gram"] == 1
        for r, own in zip(rows, keys, strict=True):
            counts = answers[at : at + len(own)]
            at += len(own)
            out.append((r["block"], r["gram"], r["slice"], r["hashes"] if first else None, squeezed(counts), None, None))
        if first:
            seen = total[total > 0]
            bins = np.floor(np.log2(seen)).astype(np.int64)
            words = np.bincount(bins, minlength=BINS).astype(np.int64).tolist()
            words += [int((seen == 1).sum()), int((seen == 2).sum())]
            tokens = np.bincount(bins, seen, minlength=BINS).astype(np.int64).tolist()
            out.append((-1, 1, rows[0]["slice"], None, None, words, tokens))
        return pa.Table.from_batches([common.batch_of(ANSWERS_ARROW, list(zip(*out)))])

    return asked.groupBy("gram", "slice").applyInArrow(work, ANSWERS)


class Model:
    """What the scores need of the whole corpus beside the counts: the histogram of word counts."""

    def __init__(self, words: list[int], tokens: list[int]):
        words, tokens = words or [0] * (BINS + 2), tokens or [0] * BINS
        self.types, self.tokens = sum(words[:BINS]), sum(tokens)
        once, twice = words[BINS:]
        # Good and Turing's n1 / (n1 + 2 n2), kept off 0 and 1 where either is rare.
        self.discount = (once + 1) / (once + 2 * twice + 2)
        used = [(n, t) for n, t in zip(words, tokens) if n]
        self.shares = np.array([t / self.tokens for _, t in used])
        self.rates = np.array([min(t / n / self.tokens, 0.999999) for n, t in used])
        self.unseen = self.discount * self.types / self.tokens if self.tokens else 1.0

    def novelty(self, counts: np.ndarray) -> np.ndarray:
        """Share of new words after samples of ``counts`` tokens."""
        out = np.full(len(counts), self.unseen)
        for share, rate in zip(self.shares, self.rates):
            out += share * np.exp(counts * np.log1p(-rate))
        return np.clip(out, 1e-6, 1.0)

    def word(self, counts: np.ndarray) -> np.ndarray:
        if not self.tokens:
            return np.ones(len(counts))
        return np.where(counts > 0, (counts - self.discount) / self.tokens, self.unseen)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.tokens + self.types + 1))


class Automaton:
    """States, arcs and failure arcs that the n-grams of a block can reach.

    State 0 is the empty history. ``keys`` has ``state * words + word`` of every other arc in rising
    order, ``weights`` and ``targets`` belong to them. ``first_weights`` and ``first_targets`` are the
    empty state's arcs, by word; ``failures`` and ``backoffs`` are those of each state. ``seen`` counts
    each word in training.
    """

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, counts: list[np.ndarray], model: Model):
        """``counts[m]`` belongs to the distinct n-grams of ``m + 1`` words in rising order of their hashes."""
        order, self.words = len(counts), len(hashes)
        keys, weights, targets, failures, backoffs = [], [], [], [np.zeros(1, dtype=np.int64)], [np.zeros(1)]
        states, before, chance, history = 1, np.zeros(len(ids), dtype=np.int64), None, None
        for size, (grams_here, exist) in enumerate(grams(ids, sizes, hashes, order), 1):
            _, first, which = np.unique(grams_here[exist], return_index=True, return_inverse=True)
            place = np.flatnonzero(exist)  # of each n-gram's last word
            here = np.zeros(len(ids))
            here[place] = counts[size - 1][which]
            if size == 1:
                chance = model.word(here)
                self.seen, self.first_weights = np.zeros(self.words), np.zeros(self.words)
                self.seen[ids], self.first_weights[ids] = here, np.log10(chance)
            else:
                past = np.zeros(len(ids))
                past[1:] = history[:-1]
                past[~exist] = 0
                fail = model.novelty(past)
                arc = (1 - fail) * np.divide(here, past, out=np.zeros(len(ids)), where=past > 0) + fail * chance
                chance = np.where(past > 0, arc, chance)
            known = counts[size - 1] > 0
            ends = place[first[known]]  # where each n-gram seen in training ends first in the block
            to = before[ends]
            if size < order:
                number = np.full(len(known), -1, dtype=np.int64)
                number[known] = states + np.arange(len(ends))
                states += len(ends)
                failures.append(to)
                backoffs.append(np.log10(model.novelty(here[ends])))
                to = number[known]
            if size == 1:
                self.first_targets = np.zeros(self.words, dtype=np.int64)
                self.first_targets[ids[ends]] = to
            else:
                # The state before the last word is that of the n-gram without it, as that was seen too.
                keys.append(before_last[ends - 1] * self.words + ids[ends])
                weights.append(np.log10(chance[ends]))
                targets.append(to)
            if size < order:
                longer = np.full(len(ids), -1, dtype=np.int64)
                longer[place] = number[which]
                before_last = longer
                before = np.where(longer >= 0, longer, before)
            history = here
        by_key = np.argsort(np.concatenate(keys), kind="stable") if keys else np.empty(0, dtype=np.int64)
        self.keys, self.weights, self.targets = (
            np.concatenate([*x, np.empty(0, dtype=t)])[by_key] for x, t in ((keys, np.int64), (weights, np.float64), (targets, np.int64))
        )
        self.failures, self.backoffs, self.reach = np.concatenate(failures), np.concatenate(backoffs), order - 1

    def step(self, states: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and the weights of the failure arcs and the arc that lead there."""
        at, gained = states.copy(), np.zeros(len(states))
        following, last = self.first_targets[words], self.first_weights[words]
        going = np.flatnonzero(at)
        while len(going):
            key = at[going] * self.words + words[going]
            arc = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
            there = self.keys[arc] == key if len(self.keys) else np.zeros(len(key), dtype=bool)
            found = going[there]
            following[found], last[found] = self.targets[arc[there]], self.weights[arc[there]]
            going = going[~there]
            gained[going] += self.backoffs[at[going]]
            at[going] = self.failures[at[going]]
            going = going[at[going] > 0]
        return following, gained + last

    def read(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log probability of each text: the texts stand one after the other in ``ids``."""
        parts = -(-sizes // STRETCH)
        text = np.repeat(np.arange(len(sizes)), parts)
        turn = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = turn * STRETCH
        early = np.minimum(begin, self.reach)
        length = np.minimum(sizes[text] - begin, STRETCH) + early
        begin = begin - early + (np.cumsum(sizes) - sizes)[text]
        longest = np.argsort(-length, kind="stable")
        text, begin, early, length = text[longest], begin[longest], early[longest], length[longest]
        states, total = np.zeros(len(text), dtype=np.int64), np.zeros(len(text))
        for step in range(int(length.max(initial=0))):
            live = int(np.searchsorted(-length, -step, side="left"))
            states[:live], gained = self.step(states[:live], ids[begin[:live] + step].astype(np.int64))
            total[:live] += np.where(step >= early[:live], gained, 0.0)
        return np.bincount(text, total, len(sizes))


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
SCORES_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)


def _scored(documents: DataFrame, answers: DataFrame, model: Model, order: int) -> DataFrame:
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        asked = right.select(["gram", "slice", "hashes", "counts"]).to_pylist()
        asked.sort(key=lambda r: (r["gram"], r["slice"]))
        hashes = np.concatenate([restored(r["hashes"], True) for r in asked if r["gram"] == 1])
        counts = [
            np.concatenate([restored(r["counts"]) for r in asked if r["gram"] == m]).astype(np.float64)
            for m in range(1, order + 1)
        ]
        sizes = np.array([int.from_bytes(x, "little") for x in left.column("counts").to_pylist()])
        texts = left.column("ids").to_pylist()
        ids = np.concatenate(
            [
                np.frombuffer(pa.decompress(t, 4 * int(n), codec="zstd", asbytes=True), dtype="<i4")
                for t, n in zip(texts, sizes, strict=True)
            ]
        )
        automaton = Automaton(ids, sizes, hashes, counts, model)
        words = automaton.seen[ids]
        first = np.cumsum(sizes) - sizes
        columns = [
            left.column("doc_id").combine_chunks(),
            left.column("held_out").combine_chunks(),
            sizes,
            np.add.reduceat((words > 0).astype(np.int64), first),
            np.full(len(sizes), model.tokens),
            np.add.reduceat(model.base(words), first),
            automaton.read(ids, sizes),
        ]
        return pa.Table.from_batches([common.batch_of(SCORES_ARROW, columns)])

    grouped = documents.groupBy("block").cogroup(answers.groupBy("block"))
    return grouped.applyInArrow(work, SCORES)


def score(documents: DataFrame, held_out, order: int = 2) -> DataFrame:
    """Scores of all documents by the model of those that are not ``held_out``."""
    spark = documents.sparkSession
    room = common.scratch(spark, "ngrams")
    slices = common.parts(spark)
    rows = documents.select("doc_id", held_out.alias("held_out"), "text")
    target = room.path("blocks")
    _blocks(rows, order, slices).write.partitionBy("kind").parquet(target)
    blocks = spark.read.schema(BLOCKS).parquet(target)
    asked = blocks.where("kind = 'ask'").select("block", "gram", "slice", "hashes", "counts")
    answers = room.save(_answered(asked), "answers")
    bins = answers.where("block = -1").select(F.posexplode("words").alias("bin", "n")).groupBy("bin").agg(F.sum("n").alias("n"))
    mass = answers.where("block = -1").select(F.posexplode("tokens").alias("bin", "n")).groupBy("bin").agg(F.sum("n").alias("n"))
    model = Model(*([r["n"] for r in sorted(x.collect(), key=lambda r: r["bin"])] for x in (bins, mass)))
    # The answers are stored, so what was asked is not needed any more.
    FileSystem(spark, target).delete(f"{target}/kind=ask")
    texts = spark.read.schema(BLOCKS).parquet(target).where("kind = 'doc'").select("block", "doc_id", "held_out", "ids", "counts")
    return _scored(texts, answers.where("block >= 0"), model, order)
