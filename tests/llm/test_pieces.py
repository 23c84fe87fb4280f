"""Cutting texts into pieces, and how little of them is encoded."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import tokens

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))

SIGNS = ["a", "Z", "é", "日", " ", " ", "\n", "\t", "\x0b", "1", ".", "'", "-", "\x00", "\x7f"]
#: The same cuts as patterns: runs without white space, and white space up to the last one before a word.
PLAIN = re.compile(rb"[a-zA-Z]++(?![0-9\x80-\xff])|[^ \t-\r]++")
SPACED = re.compile(rb" ?[a-zA-Z]++(?![0-9\x80-\xff])| ?[^ \t-\r]++|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]++")


def direct(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def marked(texts):
    return b"".join(t.encode() + tokens.MARK for t in texts)


@pytest.mark.parametrize(("pattern", "spaces"), [(PLAIN, False), (SPACED, True)])
def test_cuts_are_those_of_the_pattern(pattern, spaces):
    draw = random.Random(4)
    texts = ["", " ", "a.b", *("".join(draw.choices(SIGNS, k=draw.randrange(20))) for _ in range(5000)), ""]
    data = marked(texts)
    at = [*tokens.cuts(data, spaces).tolist(), len(data)]
    pieces = [data[a:b] for a, b in zip(at, at[1:])]
    wanted = [p for t in texts for p in (*pattern.findall(t.encode()), tokens.MARK)]
    assert [p for p in pieces if spaces or not p.isspace()] == wanted


@pytest.mark.parametrize(("path", "spaces"), [(WORD, False), (BYTE, True)])
def test_a_word_is_encoded_once_whatever_signs_follow(path, spaces):
    coder = tokens.Encoder(path, spaces)
    alone, encoded = coder._ids, []
    coder._ids = lambda texts: encoded.extend(texts) or alone(texts)
    texts = ["été été. été! été... été", "", "tête. tête", "x " + "été. " * 50]
    assert [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)] == [direct(path)(t) for t in texts]
    assert not [t for t in encoded if "t" in t]
