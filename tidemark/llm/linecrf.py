"""Quality rules whose verdict comes from labelling the lines of a document.

A linear-chain conditional random field over the lines that hold a word gives each line
a label, content or boilerplate: its scores come from what a line looks like (``FEATURES``,
shares of signs, shape and place; no word is a feature, so it holds for any language) and from the
label before it. Viterbi decoding finds the best labels of a whole document. A document
whose words stand in content lines by at least ``share`` is kept, unless the base
rules reject it.

Only documents are labelled, not lines, so the field is fitted in rounds: at first a line
has its document's label; after each round the lines of rejected documents are labelled
by the field itself, except where it finds no boilerplate at all. The likelihood of whole
sequences (forward-backward) is maximised by L-BFGS. The fit takes at most ``SAMPLE`` documents a
label, those with the least hashes, of at most ``LINES`` lines; everything else covers
all documents and whole texts.

Words are runs of signs other than the six ASCII white-space ones. Null, empty and blank
texts have no words, fail the base rules and are not kept. Repeated rows each get their row. With
labels of one kind only, or none, no field can be fitted and all lines count as content. A very
long text is worked on whole by one task, in arrays of its own size. An empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

SAMPLE, LINES = 1500, 200
#: Share of words in content lines from which on a document is kept.
SHARE = 0.5
#: Bytes of text that are worked on at once (a longer text is worked on alone).
CHUNK = 4 << 20
ROUNDS, STEPS, RIDGE = 3, 150, 1e-5
CONTENT, BOILERPLATE = 1, 0
FEATURES = (
    "always", "capitals", "symbols per word", "exclamations per word", "digits", "bars per word", "ends a sentence",
    "under 4 words", "under 10 words", "word length", "repeats a line", "same word again", "links per word",
    "first line", "last line",
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SYMBOLS = frozenset(b"#*$%&|<>")
#: Classes of bytes: bits for white space, start of a code point, capital, letter, digit, symbol, '!', '|', link sign.
_SPACE, _POINT, _CAPITAL, _LETTER, _DIGIT, _SYMBOL, _SHOUT, _BAR, _LINK = (1 << k for k in range(9))
_CLASS = np.array(
    [
        (_SPACE if b == 32 or 9 <= b <= 13 else 0)
        | (_POINT if not 128 <= b < 192 else 0)
        | (_CAPITAL if 65 <= b <= 90 else 0)
        | (_LETTER if 65 <= b <= 90 or 97 <= b <= 122 or b >= 192 else 0)
        | (_DIGIT if 48 <= b <= 57 else 0)
        | (_SYMBOL if b in _SYMBOLS else 0)
        | (_SHOUT if b == 33 else 0)
        | (_BAR if b == 124 else 0)
        | (_LINK if b in b"/@" else 0)
        for b in range(256)
    ],
    dtype=np.uint16,
)


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of 5 words which the list holds twice or more."""
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    times = Counter(windows)
    if len(times) == len(windows):
        return 0
    inside, end = 0, 0
    for start, window in enumerate(windows):
        if times[window] > 1:
            inside += start + 5 - max(end, start)
            end = start + 5
    return inside


def _within(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many flags are set between each start and end."""
    counts = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return counts[ends] - counts[starts]


class Lines:
    """The lines with a word of some documents, their features, and the base counts of the documents.

    ``document`` is each line's document (a place in ``texts``), rising; ``words`` its words.
    """

    def __init__(self, texts: list[bytes], base: bool = True):
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        kinds = _CLASS[data]
        ends = np.append(np.flatnonzero(data == 10), len(data))
        starts = np.concatenate([[0], ends[:-1] + 1])
        stops = np.cumsum([len(t) + 1 for t in texts])  # one past each document's last line break
        owner = np.searchsorted(stops, starts, side="right")
        space = (kinds & _SPACE) > 0
        first = ~space & np.concatenate([[True], space[:-1]]) if len(data) else space
        words = _within(first, starts, ends)
        held = words > 0
        starts, ends, owner, words = starts[held], ends[held], owner[held], words[held]
        self.document, self.words = owner, words

        def count(kind):
            return _within((kinds & kind) > 0, starts, ends)

        solid = count(_POINT) - count(_SPACE)
        self.n_words = np.bincount(owner, words, len(texts)).astype(np.int64)
        self.word_chars = np.bincount(owner, solid, len(texts)).astype(np.int64)
        symbols = count(_SYMBOL)
        self.n_symbols = np.bincount(owner, symbols, len(texts)).astype(np.int64)
        again = np.zeros(len(owner), dtype=bool)
        whole, at = b"\n".join(texts), 0
        seen: set[bytes] = set()
        for k, (own, a, b) in enumerate(zip(owner.tolist(), starts.tolist(), ends.tolist())):
            if own != at:
                seen, at = set(), own
            line = whole[a:b]
            again[k] = line in seen
            seen.add(line)
        self.n_dup_lines = np.bincount(owner, again, len(texts)).astype(np.int64)
        self.n_repeat_words = np.zeros(len(texts), dtype=np.int64)
        if base:
            for k, text in enumerate(texts):
                self.n_repeat_words[k] = repeated_words(text.split())
        word_starts = np.flatnonzero(first)
        line_of = np.searchsorted(starts, word_starts, side="right") - 1
        self.features = self._features(data, kinds, starts, ends, owner, words, solid, symbols, again, word_starts, line_of, count)

    @staticmethod
    def _features(data, kinds, starts, ends, owner, words, solid, symbols, again, word_starts, line_of, count):
        letters = np.maximum(count(_LETTER), 1)
        last = np.zeros(len(starts), dtype=np.uint8)
        # The last sign that is no white space.
        solid_at = np.flatnonzero((kinds & _SPACE) == 0)
        if len(starts):
            last = data[solid_at[np.searchsorted(solid_at, ends) - 1]]
        # A word whose first four bytes and length are those of the word before it, in the same line.
        same = np.zeros(len(starts))
        if len(word_starts) > 1:
            padded = np.concatenate([data, np.zeros(4, np.uint8)])
            head = sum(padded[word_starts + k].astype(np.int64) << (8 * k) for k in range(4))
            alike = (head[1:] == head[:-1]) & (line_of[1:] == line_of[:-1])
            same = np.bincount(line_of[1:][alike], minlength=len(starts)).astype(float)
        edges = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, bool)
        per_word = 1 / np.maximum(words, 1)
        return np.column_stack(
            [
                np.ones(len(starts)),
                count(_CAPITAL) / letters,
                np.minimum(symbols * per_word, 2),
                np.minimum(count(_SHOUT) * per_word, 2),
                count(_DIGIT) / np.maximum(solid, 1),
                np.minimum(count(_BAR) * per_word, 2),
                np.isin(last, np.frombuffer(b".!?:;", np.uint8)),
                words < 4,
                words < 10,
                np.minimum(solid * per_word, 30) / 10,
                again,
                same * per_word,
                np.minimum(count(_LINK) * per_word, 2),
                edges,
                np.concatenate([edges[1:], [True]]) if len(edges) else edges,
            ]
        ).astype(np.float64)


def chunks(batches, *columns: str) -> Iterator[tuple[list, list[bytes]]]:
    """``(other columns, texts)`` of at most ``CHUNK`` bytes of text, or one longer text; null is empty."""
    held, texts, size = [], [], 0
    for batch in batches:
        text = batch.column("text").cast(pa.binary())
        others = list(zip(*(batch.column(c).to_pylist() for c in columns)))
        for k in range(batch.num_rows):
            own = text[k].as_py() or b""
            if texts and size + len(own) > CHUNK:
                yield held, texts
                held, texts, size = [], [], 0
            held.append(others[k])
            texts.append(own)
            size += len(own)
    if texts:
        yield held, texts


class Field:
    """Weights of a linear-chain field with two labels: ``unary`` per feature for content against
    boilerplate, ``pair`` for each label after each."""

    def __init__(self, unary: np.ndarray, pair: np.ndarray):
        self.unary, self.pair = unary, pair

    def scores(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), 2))
        out[:, CONTENT] = features @ self.unary
        return out

    def decode(self, features: np.ndarray, document: np.ndarray) -> np.ndarray:
        """The best labels of all lines, document by document (Viterbi, all documents in step)."""
        scores, labels = self.scores(features), np.zeros(len(document), dtype=np.int8)
        places, sizes = _sequences(document)
        back = np.zeros((len(document), 2), dtype=np.int8)
        best, alive = scores[places].copy(), np.arange(len(places))
        step = 1
        while True:
            alive = alive[sizes[alive] > step]
            if not len(alive):
                break
            ways = best[alive][:, :, None] + self.pair
            back[places[alive] + step] = ways.argmax(axis=1)
            best[alive] = ways.max(axis=1) + scores[places[alive] + step]
            step += 1
        now = best.argmax(axis=1).astype(np.int8)
        for step in range(int(sizes.max(initial=0)) - 1, -1, -1):
            alive = np.flatnonzero(sizes > step)
            at = places[alive] + step
            labels[at] = now[alive]
            now[alive] = back[at, now[alive]]
        return labels


def _sequences(document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First line and number of lines of each document that has lines."""
    if not len(document):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    places = np.flatnonzero(np.concatenate([[True], document[1:] != document[:-1]]))
    return places, np.diff(np.append(places, len(document)))


def likelihood(weights: np.ndarray, features: np.ndarray, document: np.ndarray, labels: np.ndarray):
    """Mean negative log-likelihood a line of the labels, with its gradient, by forward and backward sums."""
    field = Field(weights[:-4], weights[-4:].reshape(2, 2))
    scores, (places, sizes) = field.scores(features), _sequences(document)
    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    order = np.argsort(-sizes, kind="stable")
    places, sizes = places[order], sizes[order]  # longest first: those still going are a prefix
    going = [int(np.searchsorted(-sizes, -step, side="left")) for step in range(int(sizes[0]))]  # sizes > step
    forward[places] = scores[places]
    for step in range(1, len(going)):
        at = places[: going[step]] + step
        forward[at] = np.logaddexp.reduce(forward[at - 1][:, :, None] + field.pair, axis=1) + scores[at]
    for step in range(len(going) - 1, 0, -1):
        at = places[: going[step]] + step
        backward[at - 1] = np.logaddexp.reduce(field.pair + (scores[at] + backward[at])[:, None, :], axis=2)
    total = np.zeros(len(document))
    ends = places + sizes - 1
    whole = np.logaddexp.reduce(forward[ends], axis=1)
    total[places] = whole
    norm = np.repeat(total[np.sort(places)], _sequences(document)[1])
    marginal = np.exp(forward + backward - norm[:, None])
    inner = np.flatnonzero(document[1:] == document[:-1]) + 1
    pairs = forward[inner - 1][:, :, None] + field.pair + (scores[inner] + backward[inner])[:, None, :]
    expected = np.exp(pairs - norm[inner][:, None, None]).sum(axis=0)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[inner - 1], labels[inner]), 1)
    value = whole.sum() - scores[np.arange(len(labels)), labels].sum() - (seen * field.pair).sum()
    gradient = np.concatenate([features.T @ (marginal[:, CONTENT] - (labels == CONTENT)), (expected - seen).ravel()])
    lines = len(labels)
    return value / lines + RIDGE * weights @ weights / 2, gradient / lines + RIDGE * weights


def minimised(function, start: np.ndarray, steps: int) -> np.ndarray:
    """L-BFGS with a memory of 8 steps and halved step lengths."""
    at, (value, slope) = start, function(start)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way, kept = slope.copy(), []
        for move, change in reversed(moves):
            share = move @ way / (move @ change)
            kept.append(share)
            way -= share * change
        if moves:
            move, change = moves[-1]
            way *= move @ change / (change @ change)
        for (move, change), share in zip(moves, reversed(kept), strict=True):
            way += move * (share - change @ way / (move @ change))
        length = 1.0 if moves else min(1.0, 1 / max(np.abs(slope).sum(), 1e-12))
        for _ in range(30):
            to = at - length * way
            value_to, slope_to = function(to)
            if value_to <= value - 1e-4 * length * (slope @ way):
                break
            length /= 2
        else:
            return at
        move, change = to - at, slope_to - slope
        if move @ change > 1e-12:
            moves = [*moves, (move, change)][-8:]
        done = value - value_to < 1e-7 * max(1.0, abs(value))
        at, value, slope = to, value_to, slope_to
        if done:
            break
    return at


def fit_lines(features: np.ndarray, document: np.ndarray, wanted: np.ndarray) -> Field:
    """The field for documents of which ``wanted`` says, line by line, whether their document is good."""
    labels = np.where(wanted, CONTENT, BOILERPLATE).astype(np.int64)
    weights = np.zeros(features.shape[1] + 4)
    for _ in range(ROUNDS):
        weights = minimised(lambda w: likelihood(w, features, document, labels), weights, STEPS)
        field = Field(weights[:-4], weights[-4:].reshape(2, 2))
        found = field.decode(features, document)
        places, sizes = _sequences(document)
        some = np.repeat(np.minimum.reduceat(found, places) == BOILERPLATE, sizes)
        following = np.where(wanted, CONTENT, np.where(some, found, BOILERPLATE))
        if (following == labels).all():
            break
        labels = following
    return field


def learn(documents: DataFrame, labels: DataFrame, *, key: str = "doc_id", column: str = "text", label: str = "quality") -> Field | None:
    """The field fitted on labelled documents; None where the labels are of one kind."""
    found = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("id"), F.col(label).cast("int").alias("good"))
    found = found.groupBy("id").agg(F.max("good").alias("good"), F.min("good").alias("least")).where("good = least")
    # The least hashes of each label; a job of a few numbers per task finds where they end.
    ranked = found.select("id", "good", F.xxhash64(F.lit("lines"), "id").alias("hash"))
    ends = {
        good: ranked.where(F.col("good") == good).select("hash").orderBy("hash").limit(SAMPLE).agg(F.max("hash")).first()[0]
        for good in (0, 1)
    }
    if None in ends.values():
        return None
    taken = ranked.where(F.col("hash") <= F.when(F.col("good") == 1, ends[1]).otherwise(ends[0])).select("id", "good")
    rows = documents.select(F.col(key).alias("id"), F.col(column).cast("string").alias("text"))
    rows = rows.join(F.broadcast(taken), "id").select("good", "text")  # at most 2 * SAMPLE ids

    def lined(batches):
        for held, texts in chunks(batches, "good"):
            lines = Lines(texts, base=False)
            places, sizes = _sequences(lines.document)
            for a, n in zip(places.tolist(), sizes.tolist()):
                if n <= LINES:
                    good, own = held[lines.document[a]][0], lines.features[a : a + n]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([good], pa.int32()), pa.array([own.tobytes()], pa.binary())], names=["good", "lines"]
                    )

    sample = rows.mapInArrow(lined, "good int, lines binary").orderBy("good", F.xxhash64("lines")).collect()  # bounded by SAMPLE and LINES
    if len({r["good"] for r in sample}) < 2:
        return None
    parts = [np.frombuffer(r["lines"]).reshape(-1, len(FEATURES)) for r in sample]
    document = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    wanted = np.repeat([r["good"] == 1 for r in sample], [len(p) for p in parts])
    return fit_lines(np.concatenate(parts), document, wanted)


def report(documents: DataFrame, field: Field | None, share: float = SHARE, *, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Base counts of each document, ``base_failed``, ``kept``, and its ``content_share``."""
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(column).cast("string").alias("text"))

    def judged(batches):
        for held, texts in chunks(batches, "doc_id"):
            lines = Lines(texts)
            good = np.ones(len(lines.document)) if field is None else field.decode(lines.features, lines.document) == CONTENT
            content = np.bincount(lines.document, good * lines.words, len(texts)) / np.maximum(lines.n_words, 1)
            failed = (lines.n_words < 10) | (100 * lines.n_repeat_words > 20 * lines.n_words)
            ids = pa.array([h[0] for h in held], pa.int64())
            columns = [ids, *(getattr(lines, name) for name in COUNTS), failed, ~failed & (content >= share), content]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    names = ["doc_id", *COUNTS, "base_failed", "kept", "content_share"]
    counts = ", ".join(f"{name} long" for name in COUNTS)
    return rows.mapInArrow(judged, f"doc_id long, {counts}, base_failed boolean, kept boolean, content_share double")
