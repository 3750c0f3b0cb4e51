"""Byte-level word-piece ids of a public tokenizer file.

The ids are those of ``tokenizers`` with ``add_special_tokens=False``. Another
engine with the same merges is used for speed; texts that it can't take (runs of a
million spaces) and texts that spell out a special token go to ``tokenizers`` itself.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def _byte_of() -> dict[str, int]:
    """The printable stand-in of every byte in the file's vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class WordPieces:
    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        added = {t["content"] for t in model["added_tokens"]}
        self._special = tuple(added)
        byte = _byte_of()
        ranks = {bytes(byte[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in added}
        self._fast = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._plain: Tokenizer | None = None

    def plain(self, text: str) -> list[int]:
        if self._plain is None:
            self._plain = Tokenizer.from_file(self.path)
        return self._plain.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> np.ndarray:
        if any(x in text for x in self._special):
            return np.array(self.plain(text), "<u4")
        try:
            found = self._fast.encode_ordinary(text)
        except BaseException as e:  # noqa: BLE001  the engine's own kind isn't an Exception
            if type(e).__name__ != "PanicException":
                raise
            found = self.plain(text)
        return np.array(found, "<u4")


@lru_cache(maxsize=2)
def word_pieces(path: str) -> WordPieces:
    return WordPieces(path)
