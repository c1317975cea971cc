"""Byte-level BPE ids inside tasks, from a public vocabulary file."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np

#: Two white-space characters in a row: only there does the look-ahead of the
#: vocabulary's pattern decide how the run is cut.
_RUN = re.compile(r"\s\s")
#: Fixed value: the vocabulary's pre-token pattern without its look-ahead branch.
_NO_LOOKAHEAD = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


#: Fixed value: the added token of the vocabulary's ``.json`` form.
ADDED_TOKENS = {"<|endoftext|>": 50256}


class ByteBpe:
    """``encode(text)`` gives the ids as a numpy array; null is the empty text.
    The strings of ``added`` tokens get their ids, others are ordinary text."""

    def __init__(self, ranks_path: str, pattern: str, added: dict[str, int]):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        make = lambda name, pat: tiktoken.Encoding(
            name, pat_str=pat, mergeable_ranks=ranks, special_tokens=added)
        self._added = set(added)
        self._full, self._plain = make("full", pattern), make("plain", _NO_LOOKAHEAD)

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        coder = self._full if _RUN.search(text) else self._plain
        return coder.encode_to_numpy(text, allowed_special=self._added, disallowed_special=())


@lru_cache(maxsize=2)
def byte_bpe(ranks_path: str | None = None, added_tokens: bool = False) -> ByteBpe:
    """The coder of a task's Python worker; by default that of the public
    50k byte-level vocabulary.  With its added tokens, the ids are those that
    the ``.json`` form gives by default; without, every text can be told apart
    from an end id."""
    import public_tokenizers

    return ByteBpe(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                   ADDED_TOKENS if added_tokens else {})
