"""Token ids of many texts at once: pieces are numbered in Arrow, distinct ones encoded, and ids gathered in numpy."""

from __future__ import annotations

import functools
import json
import os
import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from starmart.llm.common import flat, ranges

# What a worker process remembers between slices: this many pieces of at most so many bytes.
REMEMBERED = 1_000_000
LONGEST = 48
# Pieces encoded at a time: the library's results are far larger than the ids in them.
AT_ONCE = 4_096

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
# First bytes of white space outside ASCII; some other characters share them.
_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOP = np.zeros(256, bool)
_STOP[[0x2E, 0x2C, 0x0A]] = True  # . , and line end


# A word of ASCII and Latin-1 letters, as most pieces are: one pre-token of either kind of vocabulary.
_WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def _byte_letters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte: itself if it can be seen, else one from 256 on."""
    seen = {b for b in range(256) if 0x20 < b < 0x7F or 0xA0 < b and b != 0xAD}
    rest = iter(range(256, 512))
    return {b: chr(b if b in seen else next(rest)) for b in range(256)}


_LETTERS = _byte_letters()


def _word_form(spec: dict) -> Callable[[bytes], str] | None:
    """How the vocabulary's model gets a word, if its normalizer and pre-tokenizer are of a kind that leaves it one piece."""
    normal, cut = spec["normalizer"], spec["pre_tokenizer"] or {}
    added = [t["content"] for t in spec["added_tokens"]]
    if spec["model"].get("dropout") or any(re.fullmatch(r"\s*\w*\s*", t) for t in added):
        return None
    if normal is None and cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]:
        return lambda word: word.decode("latin-1").translate(_LETTERS)
    parts = [p["type"] for p in (normal or {}).get("normalizers", [])], cut.get("pretokenizers", [])
    if parts[0] != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in parts[1]] != ["Split", "ByteLevel"]:
        return None
    split, level = parts[1]
    if "[\\p{L}]+" not in split["pattern"].get("Regex", "").split("|") or level["use_regex"] or level["add_prefix_space"]:
        return None
    return lambda word: word.decode().lower().lstrip(" ").encode().decode("latin-1").translate(_LETTERS)


def cuts(raw: np.ndarray) -> np.ndarray:
    """Whether a pre-token of the vocabularies surely begins at each byte (the first one aside).

    Before a space that something else than white space follows; between an ASCII letter or digit and a full stop, comma
    or line end; behind a single line end between such characters.
    """
    out = np.zeros(len(raw), bool)
    if len(raw) < 2:
        return out
    space, alnum, stop = _SPACE[raw], _ALNUM[raw], _STOP[raw]
    out[:-1] = (raw[:-1] == 0x20) & ~space[1:]
    out[1:] |= stop[1:] & alnum[:-1]
    line = raw == 0x0A
    closed = alnum | (stop & ~line)
    out[2:] |= alnum[2:] & line[1:-1] & closed[:-2]
    return out


class PieceEncoder:
    """The library's plain encoding of texts, put together from that of their pieces.

    A text with the string of an added token is one piece. If an added token takes more than its plain string (white space
    in or beside it, whole words, normalized text), every text is one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        self.whole = any(
            t.lstrip or t.rstrip or t.single_word or t.normalized or re.search(r"\s", t.content) for t in added
        )
        self.known: dict[bytes, bytes] = {}
        self.word_form = _word_form(json.loads(self.tokenizer.to_str()))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's begin (one more for the end)."""
        raw, bounds = flat(texts)
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        begins = np.zeros(len(raw), bool) if self.whole else cuts(raw)
        for added in self.added:
            for i in np.flatnonzero(pc.match_substring(texts, added).to_numpy(zero_copy_only=False)):
                begins[bounds[i] : bounds[i + 1]] = False
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
        starts = np.flatnonzero(begins)
        offsets = pa.py_buffer(np.append(starts, len(raw)).astype(np.int64))
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, offsets, pa.py_buffer(raw)])
        numbered = pieces.dictionary_encode()
        ids = self._distinct(numbered.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        of_distinct = np.frombuffer(b"".join(ids), np.uint32)
        index = numbered.indices.to_numpy()
        counts = sizes[index]
        out = of_distinct[ranges((np.cumsum(sizes) - sizes)[index], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])
        return out, ends[np.searchsorted(starts, bounds)]

    def _distinct(self, pieces: list[bytes]) -> list[bytes]:
        out = list(map(self.known.get, pieces))
        fresh = [i for i, ids in enumerate(out) if ids is None]
        rest, form, model = fresh, self.word_form, self.tokenizer.model
        if form:
            # A word by itself needs the model alone, without the normalizer and the pre-tokenizer.
            rest = []
            for i in fresh:
                if _WORD.fullmatch(pieces[i]):
                    out[i] = array("I", [t.id for t in model.tokenize(form(pieces[i]))]).tobytes()
                else:
                    rest.append(i)
        for at in range(0, len(rest), AT_ONCE):
            some = rest[at : at + AT_ONCE]
            found = self.tokenizer.encode_batch_fast([pieces[i].decode() for i in some], add_special_tokens=False)
            for i, e in zip(some, found, strict=True):
                out[i] = array("I", e.ids).tobytes()
        if len(self.known) < REMEMBERED:
            self.known.update((pieces[i], out[i]) for i in fresh if len(pieces[i]) <= LONGEST)
        return out


@functools.cache
def piece_encoder(path: str) -> PieceEncoder:
    """One for a worker process; what it remembers serves the next task too."""
    return PieceEncoder(path)


def closed(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` behind each text."""
    return np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))
