"""Token ids of whole texts with a public tokenizer, as little-endian bytes.

Both supported pre-tokenizers look at a run of non-space characters, with at
most one space before it, on its own, and never join letters with the sign after
them. So the texts of a chunk are cut there together, every distinct piece is encoded
once per worker by the ``tokenizers`` library (words by its model alone), and a
document is the joined ids of its pieces. A text with white space outside ASCII,
where the cut could differ, is encoded as a whole.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: White space of Unicode that is not ASCII white space, and the separators that
#: only some libraries count as white space.
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")
#: Bytes without which a text has no such space.
ODD_BYTES = (
    b"\x1c", b"\x1d", b"\x1e", b"\x1f", b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe1\xa0\x8e",
    b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80", b"\xef\xbb\xbf",
)
#: Stands after every text; no UTF-8 text has this byte.
MARK = b"\xff"
#: Kinds of bytes: other signs, plain letters, digits and parts of longer characters, white space but the space, the space, ``MARK``.
SIGN, LETTER, MORE, WHITE, SPACE, END = range(6)
KINDS = np.full(256, SIGN, dtype=np.uint8)
KINDS[[b for b in range(128) if chr(b).isalpha()]] = LETTER
KINDS[ord("0") : ord("9") + 1] = KINDS[0x80:] = MORE
KINDS[0x09:0x0E], KINDS[0x20], KINDS[MARK[0]] = WHITE, SPACE, END
#: Signs that no supported pre-tokenizer joins with letters before them.
SIGNS = bytes(b for b in range(0x21, 0x7F) if KINDS[b] == SIGN)
#: Pieces remembered by a worker; beyond it the memory is emptied.
REMEMBERED = 1_000_000
#: Bytes of text worked on at a time.
CHUNK = 4 << 20


def byte_signs() -> dict[int, str]:
    """The sign that stands for each byte: printable Latin-1 for itself, the others from 256 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def cuts(data: bytes, spaces: bool) -> np.ndarray:
    """Where the pieces of marked texts begin. A run without white space is one, or two if it begins with plain
    letters and a sign comes next. With ``spaces`` the space before a run belongs to it, and any other white
    space there is a piece apart from what precedes it. A mark is a piece."""
    kind = KINDS[np.frombuffer(data, dtype=np.uint8)]
    word, white = kind <= MORE, (kind == WHITE) | (kind == SPACE)
    begun = word.copy()
    begun[1:] &= ~word[:-1]
    starts = white.copy()
    starts[1:] &= ~white[:-1]
    starts |= kind == END
    if spaces:
        starts[:-1] |= white[:-1] & word[1:]
        starts[:1] |= begun[:1]
        starts[1:] |= begun[1:] & (kind[:-1] != SPACE)
    else:
        starts |= begun
    edges = np.flatnonzero(np.diff(kind == LETTER, prepend=False))
    first, after = edges[::2], edges[1::2]
    starts[after[begun[first] & (kind[after] == SIGN)]] = True
    return np.flatnonzero(starts)


class Encoder:
    """Encodes texts to ids of 4 bytes. ``spaces``: the space before a word is part of it,
    and case counts; else white space is dropped and case folded."""

    def __init__(self, path: str, spaces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.spaces = spaces
        self.signs = byte_signs()
        self.known: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in done]

    def _one_word(self, piece: bytes) -> str | None:
        """The piece in the model's signs, if it is one word to the pre-tokenizer."""
        if piece.removeprefix(b" ").isalpha():
            return piece.decode().replace(" ", self.signs[32])
        text = piece.decode()
        word = text[1:] if text[0] == " " else text
        if not word.isalpha() or not self.spaces and (
            word != word.lower() or word != unicodedata.normalize("NFC", word)
        ):
            return None
        return text.encode().decode("latin-1").translate(self.signs)

    def _learn(self, wanted: list[bytes]) -> None:
        split, known, others, joined = self.tokenizer.model.tokenize, self.known, [], []
        for piece in wanted:
            if piece == MARK or not self.spaces and piece.isspace():
                known[piece] = b""
                continue
            head = piece.rstrip(SIGNS)
            word = self._one_word(head) if head else None
            if word is None:
                others.append(piece)
                continue
            if head not in known:
                known[head] = array("I", [x.id for x in split(word)]).tobytes()
            if head != piece:
                joined.append((piece, head, piece[len(head) :]))
        others += {tail for _, _, tail in joined if tail not in known}.difference(others)
        known.update(zip(others, self._ids([p.decode() for p in others]), strict=True))
        for piece, head, tail in joined:
            known[piece] = known[head] + known[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        parts, odd = [], {}
        for k, text in enumerate(texts):
            data = text.encode()
            if any(x in data for x in ODD_BYTES) and ODD_SPACE.search(text):
                odd[k], data = self._ids([text])[0], b""
            parts += (data, MARK)
        data = b"".join(parts)
        ids, ends = self._joined(data if self.spaces else data.lower())
        found = [ids[a:b] for a, b in zip([0, *ends], ends)]
        return [odd.get(k, own) for k, own in enumerate(found)]

    def _joined(self, data: bytes) -> tuple[bytes, list[int]]:
        """The ids of marked texts, one after the other, and the byte where each text's end."""
        if not data:
            return b"", []
        at = np.append(cuts(data, self.spaces), len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        distinct, codes = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        own = list(map(self.known.get, distinct))
        gaps = [k for k, ids in enumerate(own) if ids is None]
        self._learn([distinct[k] for k in gaps])
        for k in gaps:
            own[k] = self.known[distinct[k]]
        sizes = np.fromiter(map(len, own), dtype=np.int64, count=len(own)) // 4
        begins = np.cumsum(sizes) - sizes
        counts = sizes[codes]
        ends = np.cumsum(counts)
        place = np.repeat(begins[codes] - (ends - counts), counts)
        place += np.arange(len(place))
        ids = np.frombuffer(b"".join(own), dtype="<u4")[place]
        return ids.tobytes(), (4 * ends[codes == distinct.index(MARK)]).tolist()


@functools.lru_cache(maxsize=2)
def encoder(path: str, spaces: bool) -> Encoder:
    return Encoder(path, spaces)


def forget() -> None:
    """Free what this worker remembers, for tasks that encode nothing."""
    encoder.cache_clear()


def encoded(
    documents: Iterable[tuple[int, str | None]], path: str, spaces: bool, end: int
) -> Iterator[tuple[int, bytes]]:
    """``(id, bytes)`` of each document with the end id; a null text is empty."""
    coder, last = encoder(path, spaces), np.array([end], dtype="<u4").tobytes()
    held: list[tuple[int, str]] = []
    size = 0
    for key, text in documents:
        held.append((key, text or ""))
        size += len(text or "")
        if size >= CHUNK:
            yield from ((k, b + last) for (k, _), b in zip(held, coder.encode([t for _, t in held])))
            held, size = [], 0
    if held:
        yield from ((k, b + last) for (k, _), b in zip(held, coder.encode([t for _, t in held])))
