"""Byte-level BPE ids as packed unsigned 32-bit integers."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np

#: How a byte-level BPE vocabulary splits text before its merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteBpe:
    """Encodes whole texts with a byte-level BPE vocabulary.

    ``path`` is the tokenizer's JSON file. Its rank file (same name,
    ``.tiktoken``) gives the same ids faster; texts that contain a special
    token's string go through the tokenizer itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranked = tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.ranked.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()

    def encode_many(self, texts: list[str]) -> Iterator[bytes]:
        return map(self.encode, texts)
