"""SentencePiece encoding and decoding by an Aho-Corasick automaton and one Viterbi pass.

The automaton over all ordinary pieces reads a text once.  At each position it follows
output links to every piece that ends there and relaxes the best score of that position;
walking back from the end gives the best segmentation under the model's piece scores.  A
character in no piece costs ``PENALTY`` below the worst score and becomes its UTF-8 byte
pieces, so decoding gives back every text exactly, the space marker itself included: a
text's own marker characters are written as bytes.

For a model trained by merges this is the highest sum of scores, which may differ from
replaying the merges; both decode to the same text.

Every ordinary piece takes part, runs of markers too.  Two characters that stand side by
side in no piece are always cut apart, so the best path of a text is the best paths of its
stretches between such places, and each distinct stretch is encoded once per worker, in a
bounded cache.  If no piece has a marker after another character, as in the models at hand,
a text is first cut into its runs of spaces, each with the word that follows.

A null text has null ids; an empty text has none.  Very long texts, ties (the longest last
piece wins) and repeated rows need no special care, a table without rows gives no rows, and
other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
PENALTY = 10.0
CACHED = 500_000        # stretches, about 110 MB; the cache starts anew beyond that
SHORT = 6               # characters; longer words made of several stretches are put together again
LONG = 64               # characters; longer stretches are not kept

_RUN = re.compile(" +[^ ]*")

CODED = "doc_id bigint, n_tokens bigint, n_bytes bigint, ids_crc32 bigint, decoded_crc32 bigint, round_trip boolean"


class PieceCoder(dict):
    """``encode(text)`` to little-endian 32-bit ids as bytes, ``decode(ids)`` to the text."""

    def __init__(self, pieces: list[tuple[str, float, int]], byte_ids: list[int], cached: int = CACHED):
        """``pieces``: (piece, score, id) of ordinary pieces; ``byte_ids``: id of each byte's piece."""
        super().__init__()
        import ahocorasick

        self.cached, self.byte_ids = cached, byte_ids
        self.inner: dict[str, bytes] = {}
        spaced = [(p.replace(MARK, " "), score, i) for p, score, i in pieces]    # a text's own marker is in none
        self.bigrams = {p[k:k + 2] for p, _, _ in spaced for k in range(len(p) - 1)}
        self.across = any(b[1] == " " != b[0] for b in self.bigrams)
        self.automaton = ahocorasick.Automaton()
        self.bytes_of = {i: bytes([b]) for b, i in enumerate(byte_ids)}
        for piece, score, i in spaced:
            self.bytes_of[i] = piece.encode()
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score, _ in spaced) - PENALTY

    @classmethod
    def from_model(cls, path: str) -> "PieceCoder":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        plain = [(model.id_to_piece(i), model.get_score(i), i) for i in every
                 if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        return cls(plain, [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])

    def _segment(self, stretch: str) -> list[int]:
        """Best ids of a stretch, in which spaces stand for markers."""
        n = len(stretch)
        best, last, piece = [0.0] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        done, unknown = 0, self.unknown
        for end, (length, score, i) in self.automaton.iter(stretch):
            end += 1
            while done < end:       # first as an unknown character after the position before
                done += 1
                best[done], last[done] = best[done - 1] + unknown, done - 1
            begin = end - length
            total = best[begin] + score
            if total > best[end] or (total == best[end] and begin < last[end]):
                best[end], last[end], piece[end] = total, begin, i
        for at in range(done + 1, n + 1):
            best[at], last[at] = best[at - 1] + unknown, at - 1
        ids, at = [], n
        while at:
            if piece[at] >= 0:
                ids.append(piece[at])
            else:
                raw = stretch[at - 1].encode("utf-8", "surrogatepass")
                ids += [self.byte_ids[b] for b in reversed(raw)]
            at = last[at]
        return ids[::-1]

    def __missing__(self, word: str) -> bytes:
        bigrams, inner, n = self.bigrams, self.inner, len(word)
        while n > SHORT and word[n - 1] in inner and word[n - 2:n] not in bigrams:     # known ends, one by one
            n -= 1
        if n < len(word):
            ends = b"".join([inner[c] for c in word[n:]])       # before the head, which may start the cache anew
            return self[word[:n]] + ends
        stretch = " " + word
        cuts = [k for k in range(1, len(stretch)) if stretch[k - 1:k + 1] not in bigrams]
        if not cuts:
            return self._keep(self, word, stretch)
        out = [self[stretch[1:cuts[0]]] if cuts[0] < len(stretch) else b""]
        for a, b in zip(cuts, [*cuts[1:], len(stretch)]):
            part = stretch[a:b]
            out.append(inner[part] if part in inner else self._keep(inner, part, part))
        ids = b"".join(out)
        if len(word) <= SHORT:
            self[word] = ids
        return ids

    def _keep(self, cache: dict[str, bytes], name: str, stretch: str) -> bytes:
        ids = array("I", self._segment(stretch)).tobytes()
        if len(name) <= LONG:
            if len(cache) >= self.cached:
                cache.clear()
            cache[name] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not text or self.across:
            return self[text] if text else b""
        if text[0] != " " and "  " not in text:
            return b"".join(map(self.__getitem__, text.split(" ")))
        return b"".join([self[x[1:]] for x in _RUN.findall(" " + text)])

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.bytes_of.__getitem__, array("I", ids)))
        return raw[1:].decode("utf-8", "surrogatepass")     # without the marker in front


_LOADED: dict[str, PieceCoder] = {}


def load(path: str) -> PieceCoder:
    """One coder per worker process and model file."""
    if path not in _LOADED:
        _LOADED[path] = PieceCoder.from_model(path)
    return _LOADED[path]


def encoded(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(model)
        for batch in batches:
            ids = [None if t is None else np.frombuffer(coder.encode(t), "<u4").astype(np.int32)
                   for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(docs[key].cast("bigint").alias("doc_id"), docs[text].alias("t")) \
        .mapInArrow(run, "doc_id bigint, ids array<int>")


def decoded(tokens: DataFrame, model: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``ids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(model)
        for batch in batches:
            texts = [None if x is None else coder.decode(np.asarray(x, "<u4").tobytes()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def round_trips(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text encoded and decoded again where it is read: sizes, checksums and whether it came back."""
    kinds = [pa.int64()] * 4 + [pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(model)
        for batch in batches:
            rows = []
            for t in batch.column(1).to_pylist():
                if t is None:
                    rows.append((None,) * 5)
                    continue
                ids = coder.encode(t)
                back = coder.decode(ids)
                raw = back.encode("utf-8", "surrogatepass")
                rows.append((len(ids) // 4, len(raw), zlib.crc32(ids), zlib.crc32(raw), back == t))
            cells = map(pa.array, zip(*rows), kinds) if rows else [pa.array([], kind) for kind in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cells], [c.split()[0] for c in CODED.split(", ")])

    return docs.select(docs[key].cast("bigint").alias("doc_id"), docs[text].alias("t")).mapInArrow(run, CODED)
