"""Token ids of whole texts by the tokenizers library, exact and several times faster than text by text.

A text of nothing but Latin letters, digits, marks, spaces and line ends is cut into the tokenizer's
own pre-tokens, and the library's model merges each pre-token that the worker does not know yet. What
goes before the model is simple for such texts. Any other text goes through the whole library, and so
does one that holds an added token's text (``<|endoftext|>``), which becomes that token's id, as the library does by default.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa

from tidemark.llm.words import slices

# Bytes of the pre-tokens that a worker has met lately, and as many of those before; older ones are learned again when they come.
_HELD_BYTES = 48 << 20
# What Python needs for a known pre-token besides its text and ids.
_EACH_BYTES = 200
_PLAIN = re.compile(r"[\n\x20-\x7e\xc0-\xff]*")
# The pre-token patterns of the two kinds of vocabulary, with the classes of plain texts spelled out.
_L = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_PATTERNS = {
    "byte": rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[0-9]+| ?[^ \n{_L}0-9]+|[ \n]+(?![^ \n])|[ \n]+",
    "word": rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[0-9]|[^ \n{_L}0-9]+",
}
# The models know bytes as characters that can be seen: a visible one stands for itself, the others follow from 256 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SYMBOLS = np.arange(256, dtype="<u2")
_SYMBOLS[[b for b in range(256) if b not in _VISIBLE]] = 256 + np.arange(256 - len(_VISIBLE))
# No byte of a text in UTF-8: it stands between pre-tokens, as the end of a line.
_SYMBOLS[255] = 10
_LOADED: dict[tuple[str, str, int], Encoder] = {}


class Encoder:
    """One tokenizer file in one Python worker. ``kind``: ``byte`` (byte-level) or ``word`` (lower case, word ends);
    ``width``: bytes of an id in the results; ``added``: an added token's text becomes its id, as in all operators (``encoder``)."""

    def __init__(self, path: str, kind: str, width: int = 4, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        contents = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self.holds = re.compile("|".join(map(re.escape, contents)) or r"(?!)").search
        self.lower = kind == "word"
        self.cut = re.compile(_PATTERNS[kind]).findall
        self.kind = np.dtype(f"<u{width}")
        # The same model, fed with pre-tokens that are cut already.
        self.merge = self.tokenizer.model.tokenize
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.held = self.count = 0

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _learn(self, pieces: set[str]) -> None:
        """Know these pre-tokens, and those that were met lately."""
        if self.held > _HELD_BYTES:
            self.before, self.known, self.held, self.count = self.known, {}, 0, 0
        known, before, held = self.known, self.before, 0
        missing = pieces.difference(known)
        new = list(missing.difference(before)) if before else list(missing)
        if len(new) < len(missing):
            for piece in missing.difference(new):
                ids = known[piece] = before[piece]
                held += len(piece) + len(ids)
        if new:
            lines = np.frombuffer(b"\xff".join([p.encode() for p in new]), np.uint8)
            merge = self.merge
            merged = [[t.id for t in merge(w)] for w in _SYMBOLS[lines].tobytes().decode("utf-16-le").split("\n")]
            ids = np.fromiter(chain.from_iterable(merged), self.kind).tobytes()
            ends = [0, *accumulate(len(m) * self.kind.itemsize for m in merged)]
            known.update((p, ids[a:b]) for p, a, b in zip(new, ends, ends[1:]))
            held += len(ids) + sum(map(len, new))
        self.held += held + _EACH_BYTES * (len(known) - self.count)
        self.count = len(known)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, little-endian."""
        plain = [_PLAIN.fullmatch(t) and not self.holds(t) for t in texts]
        cuts = [self.cut(t.lower() if self.lower else t) if p else () for t, p in zip(texts, plain)]
        self._learn(set().union(*cuts))
        ids_of = self.known.__getitem__
        for text, is_plain, pieces in zip(texts, plain, cuts):
            if is_plain:
                yield b"".join(map(ids_of, pieces))
            else:
                yield self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)


def encoder(path: str, kind: str, width: int = 4) -> Encoder:
    """The worker's encoder of that file, made once."""
    found = _LOADED.get((path, kind, width))
    if found is None:
        found = _LOADED[path, kind, width] = Encoder(path, kind, width, added=True)
    return found


def in_pieces(texts: pa.Array, limit: int = 1 << 20) -> Iterator[list[str]]:
    """The texts as Python strings, about ``limit`` bytes at a time."""
    for a, b in slices(texts, limit):
        yield texts.slice(a, b - a).to_pylist()
