"""Token ids of whole texts with the byte-level vocabulary.

Texts are cut at lone spaces, where no token of this vocabulary's split pattern reaches across, and each distinct piece
is encoded once per worker; that gives the ids of the whole text at a fraction of the time. Texts with other white space
between words (runs, tabs, blanks of other scripts) or with the special token go to the tokenizer as a whole.
"""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache

import numpy as np
import tiktoken
from public_tokenizers import PATTERN, path
from tokenizers import Tokenizer

END = 2
_WHOLE = re.compile(r"\s\s|[^\S \n]|<\|")
_CACHED = 400_000  # pieces kept per worker; beyond that it starts again


class ByteEncoder:
    def __init__(self, name: str = "byte_bpe_50k.json", ranks: str = "byte_bpe_50k.tiktoken"):
        file = path(name)
        self.whole = Tokenizer.from_file(file)
        with open(file) as f:
            vocabulary = json.load(f)["model"]["vocab"]
        with open(path(ranks), "rb") as f:
            ordered = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if len(ordered) != len(vocabulary):
            raise ValueError("the two vocabulary files differ")
        self.pieces = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ordered, special_tokens={})
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}

    def _new(self, piece: str, at_start: bool) -> bytes:
        ids = np.array(self.pieces.encode_ordinary(piece if at_start else " " + piece), "<u4").tobytes()
        cache = self.first if at_start else self.later
        if len(cache) >= _CACHED:
            cache.clear()
        cache[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit numbers."""
        if not text:
            return b""
        if _WHOLE.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        start, *rest = text.split(" ")
        get, new = self.later.get, self._new
        head = self.first.get(start)
        return (new(start, True) if head is None else head) + b"".join([get(p) or new(p, False) for p in rest])


@lru_cache(maxsize=1)
def encoder() -> ByteEncoder:
    """One per Python worker."""
    return ByteEncoder()
