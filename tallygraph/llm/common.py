"""Small helpers the text operators share."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: white space between words in every contract of this package.
BLANKS = r"[\x20\x09-\x0D]+"

_ODD = np.uint64(0x9E3779B97F4A7C15)    # odd base of the rolling sums, invertible modulo 2**64
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8_size(text: Column) -> Column:
    """UTF-8 bytes of a text; a null has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def parts_for(amount: int | None, each: int) -> int:
    """How many parts of about ``each`` an amount needs; one at least."""
    return max(1, math.ceil((amount or 0) / each))


def mix(values: np.ndarray) -> np.ndarray:
    """Bits of 64-bit values spread evenly (splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: np.uint64 = _ODD) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)[:n]


INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word in UTF-8 bytes."""
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


HASHED_BYTES = 1 << 20      # bytes whose running sums are held at once


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word; equal words have equal hashes wherever they stand.

    Taken slice by slice, as running sums need sixteen times the memory of their bytes.
    """
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + HASHED_BYTES)))
        low, high = int(starts[i]), int(ends[j - 1])
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1 + seed)) * powers(high - low), out=sums[1:])
        begin, end = starts[i:j] - low, ends[i:j] - low
        back = powers(int(begin[-1]) + 1, INVERSE)
        lengths = (end - begin).astype(np.uint64)
        out[i:j] = mix((sums[end] - sums[begin]) * back[begin] + mix(lengths + np.uint64(seed << 32)))
        i = j
    return out


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every run of ``size`` consecutive values."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(len(words)), out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * powers(count, INVERSE))


class TextBatch:
    """The texts of a batch as one run of bytes, cut into words once for all of them.

    A line feed stands between texts, so no word spans two of them.  ``first[i]`` and
    ``first[i + 1]`` bound the words of text i.
    """

    def __init__(self, texts: list[str | None], lower: bool = False):
        parts = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        joined = b"\n".join(parts)
        if lower:
            joined = joined.lower()     # of bytes: A-Z only
        self.data = np.frombuffer(joined, np.uint8)
        self.bytes = joined
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.begin = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.starts, self.ends = word_spans(self.data)
        self.first = np.searchsorted(self.starts, self.begin)

    def __len__(self) -> int:
        return len(self.begin) - 1

    def hashes(self, seed: int = 0) -> np.ndarray:
        return word_hashes(self.data, self.starts, self.ends, seed)

    def window_hashes(self, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of ``size`` words inside one text, and the number of its first word."""
        every = window_hashes(words, size)
        counts = np.maximum(np.diff(self.first) - size + 1, 0)
        where = np.repeat(self.first[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) \
            + np.arange(counts.sum())
        return every[where], where


def slices(texts: list[str | None], limit: int):
    """Consecutive (start, end) over the texts with at most ``limit`` characters each, or one text."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > begin and size + n > limit:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)
