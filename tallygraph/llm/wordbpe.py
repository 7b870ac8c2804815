"""Token ids of a word-level BPE vocabulary file, one cached chunk at a time.

The vocabulary splits a text at white space and into words before any merge, so the ids
of a text are the ids of its chunks between white space in a row, and each distinct chunk
is encoded once per worker.  Chunks of Latin letters are cut by one pattern; any other
chunk, and any that could hold a special token, goes through the tokenizer itself.
"""

from __future__ import annotations

import json
import re
from array import array

CACHED_CHUNKS = 600_000     # about 130 MB; the cache starts anew beyond that
SHORT = 6

# What the vocabulary file's own splitting rule matches below U+0250.
_WORDS = re.compile(r"[a-zªµºß-öø-ɏ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9²³¹¼½¾]|[^\sa-zªµºß-öø-ɏ0-9²³¹¼½¾]+")
_OTHER = re.compile("[\x00\x01İɐ-\U0010ffff]|<\\|")
_SEPARATORS = re.compile("[\x1c-\x1f]")     # white space to str.split, not to the vocabulary
_END = b"\x01"


def _byte_of() -> dict[str, int]:
    """Byte of each character that byte-level vocabularies write bytes with."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordBpe(dict):
    """``ids(text)``: little-endian unsigned 32-bit ids of a text as bytes."""

    def __init__(self, path: str, cached: int = CACHED_CHUNKS):
        super().__init__()
        import tiktoken
        from tokenizers import Tokenizer

        self.cached = cached
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        byte_of = _byte_of()
        ranks = {}
        for token, i in vocab.items():
            end = token.endswith("</w>")
            raw = bytes(byte_of[c] for c in (token[:-4] if end else token))
            ranks[raw + _END if end else raw] = i
        # a word ends in a mark that merges with its last byte before anything else does
        self.words = tiktoken.Encoding("words", pat_str=r"[^\x01]+\x01", mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isascii() and "<|" not in chunk:
            if len(chunk) > 1 and chunk[-1] in ".," and chunk[-2].isalpha():
                out = self[chunk[:-1]] + self[chunk[-1]]
            elif (low := chunk.lower()) != chunk:
                out = self[low]
            elif chunk.isalpha():
                return self._keep(chunk, self.words.encode_ordinary(chunk + "\x01"))
            else:
                return self._keep(chunk, self._encode(chunk))
            if len(chunk) <= SHORT:     # long ones are rare and soon put together again
                self[chunk] = out
            return out
        if len(chunk) > 1 and chunk[-1] in ".," and chunk[-2].isalpha() and not _OTHER.search(chunk.lower()):
            return self[chunk[:-1]] + self[chunk[-1]]
        return self._keep(chunk, self._encode(chunk))

    def _encode(self, chunk: str) -> list[int]:
        if _OTHER.search(chunk.lower()):        # what it becomes, as a letter below U+0250 may leave that range
            return self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return self.words.encode_ordinary("\x01".join([*_WORDS.findall(chunk.lower()), ""]))

    def _keep(self, chunk: str, ids: list[int]) -> bytes:
        if len(self) >= self.cached:
            self.clear()
        self[chunk] = out = array("I", ids).tobytes()
        return out

    def ids(self, text: str) -> bytes:
        if _SEPARATORS.search(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.__getitem__, text.split()))


_LOADED: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """One encoder per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]
