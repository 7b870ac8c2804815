"""Byte-level BPE through a SentencePiece model written straight from the vocabulary.

``serialised`` makes the model file of a rank file: one piece per token, its bytes mapped to
one character each, scored by the negative rank, with identity normalisation and no marker
for spaces.  Merging the best-scored neighbours first is then merging the lowest rank first.
A text is cut by the pattern; each pre-token is encoded on its own, or is a token as a whole
if the vocabulary has it, as the rank files mean it.  Decoding maps ids back to their bytes.

Texts are read in blocks of pre-tokens, so a very long text needs memory for its own
characters and one block.  A pre-token of more than ``LONG`` bytes is first cut between bytes
that stand side by side in no token, where no merge can reach across; a stretch without such
a place goes to the library whole.

A null text counts as empty, an empty text has no ids.  Repeated rows and ties need no care,
a table without rows gives no rows.  Ids of documents pass through Arrow as they are, so
nulls and large ids survive; other columns are not read, so names cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import operator
import struct
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLOCK = 50_000          # pre-tokens read at once
ROWS = 1000             # documents whose results are held at once
CACHED = 400_000        # pre-tokens, about 80 MB; the cache starts anew beyond that
KEPT = 64               # characters; longer pre-tokens are not kept
LONG = 4096             # bytes; longer pre-tokens are cut where no merge can reach across

FIRST = 0x100           # character of byte 0
_WHOLE_MATCH = operator.itemgetter(0)
_TO_CHARS = {b: FIRST + b for b in range(256)}


def ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def as_characters(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_TO_CHARS)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, value: bytes | int) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialised(vocabulary: dict[bytes, int]) -> bytes:
    """A SentencePiece model: pieces in order of rank, the unknown piece last."""
    unknown, merges, identity = 2, 2, b"identity"       # numbers of the format: piece type, model type
    pieces = [_field(1, as_characters(token).encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank))
              for token, rank in sorted(vocabulary.items(), key=lambda x: x[1])]
    pieces.append(_field(1, b"<unk>") + _field(3, unknown))
    trainer = _field(3, merges) + _field(4, len(pieces))
    as_is = _field(1, identity) + _field(3, 0) + _field(4, 0) + _field(5, 0)    # no prefix, blanks kept, no marker
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, as_is)


class ByteCoder:
    """``encode(text)`` gives ids, ``blocks(texts)`` packed ids block by block, ``decode(ids)`` bytes."""

    def __init__(self, vocabulary: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}              # packed ids of pre-tokens read before
        self.rank_of = np.array(sorted(vocabulary.values()), np.uint32)     # by number of the piece
        self.whole = {token: array("I", [rank]).tobytes() for token, rank in vocabulary.items()}
        self.bytes_of = {rank: token for token, rank in vocabulary.items()}
        self.decimal = {rank: str(rank) for rank in vocabulary.values()}
        self.pairs = {token[k:k + 2] for token in vocabulary for k in range(len(token) - 1)}
        self.pattern = regex.compile(pattern)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised(vocabulary))

    def _merged(self, raws: list[bytes]) -> list[bytes]:
        """Packed ids of pre-tokens that are no token as a whole."""
        cuts = [[0, *self._safe_cuts(raw), len(raw)] for raw in raws]
        parts = [as_characters(raw[a:b]) for raw, at in zip(raws, cuts) for a, b in itertools.pairwise(at)]
        found = self.model.encode(parts, num_threads=1)
        flat = self.rank_of[np.fromiter(itertools.chain.from_iterable(found), np.int64)].tobytes()
        ends = [0, *itertools.accumulate(4 * len(ids) for ids in found)]
        last = [0, *itertools.accumulate(len(at) - 1 for at in cuts)]
        return [flat[ends[a]:ends[b]] for a, b in itertools.pairwise(last)]

    def _safe_cuts(self, raw: bytes) -> list[int]:
        if len(raw) <= LONG:
            return []
        return [k for k in range(1, len(raw)) if raw[k - 1:k + 1] not in self.pairs]

    def _learn(self, tokens: list[str]) -> list[str]:
        """Every token looked up or encoded, all new ones in one call; returns those not to keep."""
        known, whole = self.known, self.whole
        new = [t for t in set(tokens) if t not in known]
        if len(known) + len(new) > CACHED:
            known.clear()
            new = list(set(tokens))
        raws = [t.encode("utf-8", "surrogatepass") for t in new]
        known.update((t, whole[raw]) for t, raw in zip(new, raws) if raw in whole)
        rest = [(t, raw) for t, raw in zip(new, raws) if raw not in whole]
        if rest:
            known.update(zip((t for t, _ in rest), self._merged([raw for _, raw in rest])))
        return [t for t in new if len(t) > KEPT]

    def blocks(self, texts: Iterable[str | None]) -> Iterator[tuple[int, bytes]]:
        """(number of the text, packed ids) in order, in one or more blocks for a text that has ids."""
        held, size = [], 0
        for i, text in enumerate(texts):
            found = map(_WHOLE_MATCH, self.pattern.finditer(text or ""))
            while tokens := list(itertools.islice(found, BLOCK)):
                held.append((i, tokens))
                size += len(tokens)
                if size >= BLOCK:
                    yield from self._coded(held)
                    held, size = [], 0
        yield from self._coded(held)

    def _coded(self, held: list[tuple[int, list[str]]]) -> list[tuple[int, bytes]]:
        long = self._learn(list(itertools.chain.from_iterable(tokens for _, tokens in held)))
        get = self.known.__getitem__
        out = [(i, b"".join(map(get, tokens))) for i, tokens in held]
        for token in long:
            del self.known[token]
        return out

    def encode(self, text: str | None) -> list[int]:
        return array("I", b"".join(ids for _, ids in self.blocks([text]))).tolist()

    def decode(self, ids: list[int] | array) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_LOADED: dict[tuple[str, str], ByteCoder] = {}


def load(path: str, pattern: str) -> ByteCoder:
    """One coder per worker process, rank file and pattern."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteCoder(ranks(path), pattern)
    return _LOADED[path, pattern]


def _by_text(docs: DataFrame, key: str, text: str, result: list[T.StructField], rows: Callable[[list], list]) -> DataFrame:
    """``key`` with a row of ``rows(values of text)`` for every document, some documents at a time."""
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType, True), *result])
    kinds = [_ARROW[f.dataType.simpleString()] for f in result]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                cells = zip(*rows(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, cells, kinds)], schema.names)

    return docs.select(docs[key], docs[text]).mapInArrow(run, schema)


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}


def encoded(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` of every text."""
    return _by_text(docs, key, text, [T.StructField("ids", T.ArrayType(T.IntegerType()))],
                    lambda texts: [(load(path, pattern).encode(t),) for t in texts])


def decoded(tokens: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``raw``, the bytes of every row's ids; null ids give no bytes."""
    return _by_text(tokens, key, ids, [T.StructField("raw", T.BinaryType())],
                    lambda many: [(load(path, pattern).decode(x or []),) for x in many])


def digests(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text encoded and its ids decoded again where it is read.

    ``n_tokens``, ``ids_sha256`` of the decimal ids joined by commas and ``decoded_sha256``
    of the decoded bytes, in lowercase hex.
    """
    def rows(texts: list[str | None]) -> list[tuple[int, str, str]]:
        coder = load(path, pattern)
        sizes, of_ids, of_bytes = [0] * len(texts), [hashlib.sha256() for _ in texts], [hashlib.sha256() for _ in texts]
        for i, packed in coder.blocks(texts):
            ids = array("I", packed)
            of_ids[i].update((("," if sizes[i] else "") + ",".join(map(coder.decimal.__getitem__, ids))).encode())
            of_bytes[i].update(coder.decode(ids))
            sizes[i] += len(ids)
        return [(n, a.hexdigest(), b.hexdigest()) for n, a, b in zip(sizes, of_ids, of_bytes)]

    result = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    return _by_text(docs, key, text, result, rows)
