"""Byte-level BPE of a public vocabulary, at corpus speed.

``ids`` are those of the ``tokenizers`` library for the given file, with special tokens'
strings taken as ordinary text. That library is slow for corpora, so texts of characters
up to U+024F go to ``tiktoken`` with the same merges, which gives the same ids there
(tested); every other text goes to ``tokenizers`` itself, whose Unicode tables decide.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np

# Letters, digits and white space are the same to all the libraries up to U+024F, but
# for four control characters.
_BEYOND = re.compile("[^\\x00-\\x1b\\x20-\u024f]")
# The vocabulary's pre-token pattern, said for Python's ``re`` within those characters.
_PRE_TOKEN = re.compile(
    "'(?:[sdmt]|ll|ve|re)| ?[^\\W\\d_²³¹¼½¾]+| ?[\\d²³¹¼½¾]+| ?(?:[^\\s\\w]|_)+|\\s+(?!\\S)|\\s+")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> "Encoder":
    """One encoder per worker process and vocabulary file."""
    return Encoder(path)


class Encoder:
    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        self.path, self.fast = path, None
        ranks = path.removesuffix(".json") + ".tiktoken"
        try:
            lines = open(ranks, "rb").read().splitlines()
        except FileNotFoundError:     # another vocabulary: the library alone
            return
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges,
                                      special_tokens={})

    @functools.cached_property
    def exact(self):
        """The library itself; loaded only where a text needs it."""
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.encode_special_tokens = True
        return tokenizer

    def pre_tokens(self, text: str) -> list[str]:
        """The text cut where no merge crosses; each piece is encoded on its own."""
        if self.fast is not None and not _BEYOND.search(text):
            return _PRE_TOKEN.findall(text)
        return [text[a:b] for _, (a, b) in self.exact.pre_tokenizer.pre_tokenize_str(text)]

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and not _BEYOND.search(text):
            return np.array(self.fast.encode_ordinary(text), dtype="<u4")
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def count(self, piece: str) -> int:
        if self.fast is not None and not _BEYOND.search(piece):
            return len(self.fast.encode_ordinary(piece))
        return len(self.exact.encode(piece, add_special_tokens=False).ids)


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
