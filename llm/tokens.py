"""Token ids of a byte-level BPE file, with a cache of words.

Text is split into words as the tokenizer's own pre-tokenizer does it; the ids
of a word don't depend on its neighbours, so each distinct word is tokenized
once while it stays in the cache. Texts with characters on whose class Python
and the tokenizer might differ go through the tokenizer whole.
"""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

FILE = public_tokenizers.path("byte_bpe_50k.json")
CACHED = 600_000  # words (about 150 MB); then the cache starts anew

# FIXED VALUES: the word pattern of the tokenizer's file, for texts of the characters below
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
OTHER = re.compile("[^\\t\\n\\r -~¡-©«-±´¶-¸»¿-ɏΑ-ΡΣ-ωА-я‐-‧‰-⁞€]")
# FIXED VALUES: bytes that stand for themselves in the file's alphabet; the others follow from code point 256 on
PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _alphabet() -> dict[int, str]:
    rest = iter(range(256, 512))
    return {b: chr(b) if b in set(PLAIN) else chr(next(rest)) for b in range(256)}


class _Words(dict):
    """Word -> its ids as little-endian 32-bit bytes."""

    def __init__(self, model):
        super().__init__()
        self.model, self.table = model, _alphabet()

    def __missing__(self, word: str) -> bytes:
        spelled = word.encode().decode("latin-1").translate(self.table)
        ids = np.array([t.id for t in self.model.tokenize(spelled)], "<u4").tobytes()
        if len(self) >= CACHED:
            self.clear()
        self[word] = ids
        return ids


_loaded: dict[str, tuple] = {}


def encode(texts: list[str], path: str = FILE) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers, without special tokens."""
    if path not in _loaded:
        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True  # their strings in a text are ordinary text
        _loaded[path] = t, _Words(t.model)
    tokenizer, words = _loaded[path]
    out = []
    for x in texts:
        if OTHER.search(x):
            out.append(np.array(tokenizer.encode(x, add_special_tokens=False).ids, "<u4").tobytes())
        else:
            out.append(b"".join(map(words.__getitem__, WORD.findall(x))))
    return out


def forget() -> None:
    """Empty the caches; a Python worker may serve another operator next."""
    for _, words in _loaded.values():
        words.clear()
