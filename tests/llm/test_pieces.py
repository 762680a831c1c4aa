"""Ids put together from pieces against the library's plain call on whole texts."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from starmart.llm import pieces
from starmart.llm.pieces import PieceEncoder, _word_form, closed
from starmart.llm.queries import PACKED_VOCABULARY, VOCABULARY, vocabulary_path

ODD = list("abzAZ019 .,\n\t'!-’éÉ 　 ́ \x1c\x85²½ßİΣς한字\U0001f600​\xa0\xad\n.,'ÀßÿŸñÑÆøĲſ×÷")
ODD += ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", " the", "'s", "'ll", "\r\n"]


def texts():
    rng = random.Random(5)
    out = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(4_000)]
    letters = "abCéÈñüÿŸßıİſK"
    out += [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(4)) for _ in range(2_000)]
    return [*out, "", " ", "x" * 5_000, "é" * 3_000, "Word. " * 500]


@pytest.mark.parametrize("name", [VOCABULARY, PACKED_VOCABULARY])
def test_same_ids_as_the_library(monkeypatch, name):
    """In several slices, with few pieces remembered and few encoded at a time."""
    monkeypatch.setattr(pieces, "REMEMBERED", 1_000)
    monkeypatch.setattr(pieces, "AT_ONCE", 7)
    path, own = vocabulary_path(name), texts()
    encode, plain = PieceEncoder(path), Tokenizer.from_file(path)
    assert encode.word_form is not None
    for at in range(0, len(own), 1_500):
        some = own[at : at + 1_500]
        ids, bounds = encode.encode(pa.array(some, pa.large_string()))
        want = plain.encode_batch(some, add_special_tokens=False)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [w.ids for w in want]


def test_vocabularies_of_another_kind_take_no_short_cut():
    spec = {"normalizer": None, "added_tokens": [], "model": {}}
    spec["pre_tokenizer"] = {"type": "ByteLevel", "use_regex": True, "add_prefix_space": False}
    assert _word_form(spec)(" a\xe9".encode()) == "ĠaÃ©"
    for change in (
        {"normalizer": {"type": "NFKC"}},
        {"pre_tokenizer": None},
        {"pre_tokenizer": spec["pre_tokenizer"] | {"add_prefix_space": True}},
        {"model": {"dropout": 0.1}},
        {"added_tokens": [{"content": "word"}]},
    ):
        assert _word_form(spec | change) is None


def test_end_ids():
    ids, bounds = closed(np.array([5, 6, 7], np.uint32), np.array([0, 0, 2, 3]), 9)
    assert ids.tolist() == [9, 5, 6, 9, 7, 9] and bounds.tolist() == [0, 1, 4, 6]
