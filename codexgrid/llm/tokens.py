"""Sizes and offsets in tokens of a public byte-level tokenizer."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

#: The vocabulary file; a parameter of every operator that counts tokens.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published split pattern of this vocabulary (a fixed value).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoding(path: str = VOCABULARY):
    """The encoding and the length in bytes of each of its tokens, once per process."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        size[rank] = len(token)
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), size


def count(text: str, path: str = VOCABULARY) -> int:
    return len(encoding(path)[0].encode_ordinary(text))


def ends(text: str, path: str = VOCABULARY) -> np.ndarray:
    """The end of each token of ``text`` in bytes of its UTF-8 form."""
    enc, size = encoding(path)
    return np.cumsum(size[np.asarray(enc.encode_ordinary(text), np.int64)])
