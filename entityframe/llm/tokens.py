"""Token ids of a public byte-level BPE vocabulary, as the `tokenizers` library gives them."""

from __future__ import annotations

import base64
import functools
import os
import re

import numpy as np

# Characters whose class every Unicode version agrees on; other texts go to `tokenizers`.
_UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa1-ſ‐-‧‰-⁞]")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """`ids(text)` are Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids.

    Where the vocabulary has a file of ranks beside it, which hold the same merges, ordinary
    texts are encoded from that, several times as fast.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._ranked = None
        ranks_path = os.path.splitext(path)[0] + ".tiktoken"
        if os.path.exists(ranks_path):
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self._ranked = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    def _list(self, text: str) -> list[int]:
        if self._ranked is None or "<|" in text or _UNUSUAL.search(text):
            return self._whole.encode(text, add_special_tokens=False).ids
        return self._ranked.encode_ordinary(text)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self._list(text), dtype="<u4")

    def count(self, text: str) -> int:
        return len(self._list(text))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    return Encoder(path)
