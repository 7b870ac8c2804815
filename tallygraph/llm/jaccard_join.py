"""Exact n-gram Jaccard join: size-banded tiles, bitmap signatures, then sorted-array intersection.

A document's set holds the hashes of its distinct word n-grams.  Two sets link when
``den * |A and B| >= num * |A or B|``.  What is returned is the connected components of all
links, without writing out the links of large groups.

1. *Bands and tiles.*  Sizes fall into bands; linked sets are in the same band or in
   neighbouring ones.  Linked sets differ in at most ``d`` n-grams, ``d`` known from the
   band, so of ``d + 1 + e`` hash segments at least ``1 + e`` agree.  A tile is a band, a
   segment and its content.  Segments of few n-grams say little; a set leaves out those of
   fewer than ``low`` n-grams, or of fewer than the highest number below it that at most
   ``e`` of its segments miss, which still leaves an agreeing one.  A set with more than
   ``e`` empty segments leaves these out all the same; two such sets meet by their first
   n-grams in hash order instead, of which linked sets share one.  Tiles that hold the same
   sets as another are dropped, large ones dealt to tasks as pairs of chunks.
2. *Bitmaps.*  Inside a tile, sets are compared by hashed bitmaps: n-grams of A whose bit
   is off in B are not in B, so counts of bits bound the overlap from above.  Pairs that
   may link form families.
3. *Intersection.*  Only sets of families fetch their sorted hashes.  Members of a family
   are dealt to chunks of about ``CHUNK`` hashes within their band; every two chunks that
   can hold linked sets meet in one task, which bounds by bitmaps again and intersects
   sorted arrays.

In a tile or chunk pair, sets are visited along the links found, and each is compared only
with those not visited yet: a group of near copies costs one comparison each, and a task
returns one link per set.  Equal sets are one set from the start.  Families and components
come from iterated joins; links never reach the driver.

An empty or null text has an empty set and links with nothing; so does a row without an id,
whose component is null.  Rows that share an id are one document.  Repeated rows, ties and
very long texts need no care; a table without rows gives no rows.  Other columns are not read.
Hashes have 64 bits, equal sets are found by a 128-bit digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph.llm.common import TextBatch, mix, parts_for, slices, utf8_size, window_hashes
from tallygraph.llm.components import connected_components
from tallygraph.session import materialize

SLICE_CHARS = 2_000_000
RANGE_BYTES = 16 << 20      # text whose tiles meet in one task
GROUP_BYTES = 8 << 20       # signatures or hashes compared in one task
CHUNK = 500_000             # hashes of one chunk of a family
TILE = 2_000                # sets of one chunk of a tile


class Rule(NamedTuple):
    """Words of an n-gram and the least share ``num / den``; at least one half."""

    words: int = 5
    num: int = 80
    den: int = 100

    def differences(self, smaller: np.ndarray) -> np.ndarray:
        """Most n-grams that two linked sets differ in, by the size of the smaller."""
        return smaller * (self.den - self.num) // self.num

    def needs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least overlap of linked sets of these sizes."""
        return -(-self.num * (a + b) // (self.num + self.den))

    @property
    def low(self) -> int:
        return 3 if self.num >= 8 * (self.den - self.num) else 2

    def spare(self, differences: np.ndarray) -> np.ndarray:
        """Segments beyond those that differences can spoil; none if equal sets are all there is."""
        share = 6 if self.low == 3 else 35
        return np.where(differences > 0, -(-(differences + 1) * share // 100) + 2, 0)


@cache
def band_edges(rule: Rule) -> np.ndarray:
    """First size of each band; half as large again from one to the next, or as far apart as linked sets can be."""
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, edges[-1] * 3 // 2, -(-edges[-1] * rule.den // rule.num)))
    return np.array(edges, np.int64)


def band_of(sizes: np.ndarray, rule: Rule) -> np.ndarray:
    return np.searchsorted(band_edges(rule), sizes, side="right") - 1


def shingle_sets(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each text, one after the other, and their bounds."""
    batch = TextBatch(texts, lower=True)
    hashes = batch.hashes()
    every, at = batch.window_hashes(hashes, words)
    bounds = np.searchsorted(at, batch.first)
    counts = np.diff(batch.first)
    parts = []
    for i in range(len(texts)):
        if 0 < counts[i] < words:
            whole = window_hashes(hashes[batch.first[i]:batch.first[i + 1]], int(counts[i]))
            parts.append(mix(whole + np.uint64(counts[i])))
        else:
            part = np.sort(every[bounds[i]:bounds[i + 1]])
            parts.append(part[np.concatenate([[True], part[1:] != part[:-1]])] if len(part) else part)
    sizes = np.array([len(p) for p in parts], np.int64)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def _bits_for(size: int) -> int:
    return max(64, 1 << (int(size) - 1).bit_length())


def _bitmap(hashes: np.ndarray, bits: int) -> np.ndarray:
    on = np.zeros(bits, bool)
    on[(hashes & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(on, bitorder="little")


def _folded(bitmap: np.ndarray, bits: int) -> np.ndarray:
    """The bitmap of the same hashes in fewer bits."""
    return np.bitwise_or.reduce(bitmap.reshape(-1, bits // 8), axis=0)


def tile_keys(flat: np.ndarray, bounds: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """(set number, tile) of every tile of every set."""
    sizes = np.diff(bounds)
    bands, edges = band_of(sizes, rule), band_edges(rule)
    owners, keys = [], []
    for shift in (0, 1):        # as one of the smaller band, then as the larger set of the band below
        band = bands - shift
        upper = edges[np.maximum(band, 0) + 1] - 1
        takes = (sizes > 0) & (band >= 0) & (upper * rule.den >= sizes * rule.num if shift else True)
        which = np.flatnonzero(takes)
        if not len(which):
            continue
        differences = rule.differences(upper[which])
        spare = rule.spare(differences)
        segments = differences + 1 + spare
        first = np.concatenate([[0], np.cumsum(segments)])
        at = np.repeat(np.arange(len(which)), sizes[which])
        own = flat[np.repeat(bounds[:-1][which] - np.concatenate([[0], np.cumsum(sizes[which])[:-1]]), sizes[which])
                   + np.arange(len(at))]
        segment = first[at] + ((own >> np.uint64(33)) % segments[at].astype(np.uint64)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        content = np.bincount(segment, minlength=first[-1])
        total = np.zeros(first[-1], np.uint64)
        begin = np.flatnonzero(np.diff(segment[order], prepend=-1))
        total[segment[order][begin]] = np.add.reduceat(mix(own)[order], begin)
        owner = np.repeat(np.arange(len(which)), segments)
        least = np.zeros(len(which), np.int64)      # a segment's n-grams; 0 if too many are empty
        for size in range(1, rule.low + 1):
            least[np.bincount(owner, weights=content < size, minlength=len(which)) <= spare] = size
        keep = content >= np.maximum(least, 1)[owner]
        number = np.arange(first[-1]) - first[owner]
        name = mix((band[which][owner].astype(np.uint64) << np.uint64(40)) + number.astype(np.uint64))
        keys.append(mix(total ^ name)[keep])
        owners.append(which[owner[keep]])
        poor = np.flatnonzero(least == 0)
        if len(poor):
            many = sizes[which[poor]]
            heads = many + 1 + -many * rule.num // rule.den     # two linked sets share one of these
            at = np.repeat(np.arange(len(poor)), heads)
            place = np.arange(len(at)) - np.repeat(np.cumsum(heads) - heads, heads)
            name = mix((band[which[poor]].astype(np.uint64) << np.uint64(40)) + np.uint64((1 << 40) - 1))
            keys.append(mix(flat[bounds[:-1][which[poor]][at] + place] ^ name[at]))
            owners.append(which[poor][at])
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owners), np.concatenate(keys)


def _linked(sizes: np.ndarray, bitmaps: np.ndarray, rule: Rule, sets: list[np.ndarray] | None) -> list[tuple[int, int]]:
    """A spanning set of links between members: by bitmap bound alone, or exact if ``sets`` are given."""
    left = np.arange(len(sizes))        # not visited
    links = []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            need = rule.needs(sizes[x], sizes[left])
            near = np.flatnonzero(need <= np.minimum(sizes[x], sizes[left]))
            if len(near):
                other = bitmaps[left[near]]
                mine = np.bitwise_count(bitmaps[x] & ~other).sum(axis=1, dtype=np.int64)
                theirs = np.bitwise_count(other & ~bitmaps[x]).sum(axis=1, dtype=np.int64)
                most = np.minimum(sizes[x] - mine, sizes[left[near]] - theirs)
                near = near[most >= need[near]]
            if len(near) and sets is not None:
                joined = np.concatenate([sets[y] for y in left[near]])
                place = np.minimum(np.searchsorted(sets[x], joined), len(sets[x]) - 1)
                ends = np.cumsum(sizes[left[near]])
                hits = np.concatenate([[0], np.cumsum(sets[x][place] == joined)])
                near = near[hits[ends] - hits[ends - sizes[left[near]]] >= need[near]]
            if len(near):
                found = left[near]
                links += [(x, y) for y in found]
                queue += list(found)
                left = np.delete(left, near)
    return links


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal values."""
    begin = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else []
    return list(zip(begin, [*begin[1:], len(values)]))


def _edges(pairs: list[tuple[int, int]]) -> pa.Table:
    pairs = sorted(set(pairs))
    return pa.table({"u": pa.array([int(u) for u, _ in pairs], pa.int64()),
                     "v": pa.array([int(v) for _, v in pairs], pa.int64())})


def _described(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, ids = batch.column(1).to_pylist(), batch.column(0)
        for a, b in slices(texts, SLICE_CHARS):
            flat, bounds = shingle_sets(texts[a:b], rule.words)
            digests, maps = [], []
            for begin, end in zip(bounds[:-1], bounds[1:]):
                own = flat[begin:end]
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                maps.append(_bitmap(own, _bits_for(len(own))).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(np.diff(bounds)), pa.array(digests, pa.binary()),
                                              pa.array(maps, pa.binary())], names=["doc_id", "n", "digest", "bitmap"])


def _tiles(batches: Iterator[pa.RecordBatch], rule: Rule, ranges: int) -> Iterator[pa.RecordBatch]:
    """Tiles by range, packed; sets that recur in a slice are named once."""
    for batch in batches:
        texts, every = batch.column(1).to_pylist(), batch.column(0).to_numpy(zero_copy_only=False)
        for a, b in slices(texts, SLICE_CHARS):
            flat, bounds = shingle_sets(list(dict.fromkeys(texts[a:b])), rule.words)
            first = {t: i for i, t in reversed(list(enumerate(texts[a:b])))}
            ids = every[a:b][[first[t] for t in dict.fromkeys(texts[a:b])]].astype(np.int64)
            owners, keys = tile_keys(flat, bounds, rule)
            rng = (keys >> np.uint64(20)) % np.uint64(ranges)
            order = np.argsort(rng, kind="stable")
            cuts = _runs(rng[order])
            names = ids[owners[order]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(rng[order[i]]) for i, _ in cuts], pa.int64()),
                 pa.array([names[i:j].astype("<i8").tobytes() for i, j in cuts], pa.binary()),
                 pa.array([keys[order[i:j]].astype("<u8").tobytes() for i, j in cuts], pa.binary())],
                names=["rng", "ids", "keys"])


def _shared_tiles(rows: pa.Table) -> pa.Table:
    """Tiles with several documents, one of those that hold the same ones."""
    ids = np.concatenate([np.frombuffer(x, "<i8") for x in rows.column("ids").to_pylist()])
    keys = np.concatenate([np.frombuffer(x, "<u8") for x in rows.column("keys").to_pylist()])
    order = np.lexsort((ids, keys))
    ids, keys = ids[order], keys[order]
    fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])]) if len(keys) else np.zeros(0, bool)
    ids, keys = ids[fresh], keys[fresh]
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if not len(begin):
        return pa.table({"tile": pa.array([], pa.int64()), "doc_id": pa.array([], pa.int64())})
    count = np.diff(np.append(begin, len(keys)))
    held = np.add.reduceat(mix(ids.astype(np.uint64)), begin) + mix(count.astype(np.uint64))
    _, chosen = np.unique(np.where(count > 1, held, np.uint64(0)), return_index=True)
    keep = np.zeros(len(begin), bool)
    keep[chosen] = True
    keep = np.repeat(keep & (count > 1), count)
    return pa.table({"tile": pa.array(keys[keep].astype(np.int64)), "doc_id": pa.array(ids[keep])})


def _may_link(rows: pa.Table, rule: Rule) -> pa.Table:
    """Links between the sets of each tile that bitmaps do not rule out."""
    rows = rows.sort_by([("tile", "ascending"), ("doc_id", "ascending")])
    ids, sizes = rows.column("doc_id").to_numpy(), rows.column("n").to_numpy()
    maps, pairs = rows.column("bitmap").to_pylist(), []
    for a, b in _runs(rows.column("tile").to_numpy()):
        bits = min(8 * len(m) for m in maps[a:b])
        table = np.stack([_folded(np.frombuffer(m, np.uint8), bits) for m in maps[a:b]]).view("<u8")
        pairs += [(ids[a + x], ids[a + y]) for x, y in _linked(sizes[a:b], table, rule, None)]
    return _edges(pairs)


def _links(rows: pa.Table, rule: Rule) -> pa.Table:
    """Links between the sets of each chunk pair."""
    rows = rows.sort_by([("place", "ascending"), ("doc_id", "ascending")])
    ids, sizes = rows.column("doc_id").to_numpy(), rows.column("n").to_numpy()
    raw, pairs = rows.column("hashes"), []
    for a, b in _runs(np.array(rows.column("place").to_pylist())):
        sets = [np.frombuffer(raw[i].as_py(), "<u8") for i in range(a, b)]
        bits = _bits_for(sizes[a:b].max())
        table = np.stack([_bitmap(s, bits) for s in sets]).view("<u8")
        pairs += [(ids[a + x], ids[a + y]) for x, y in _linked(sizes[a:b], table, rule, sets)]
    return _edges(pairs)


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row."""
    rows = docs.select(docs[key].cast("bigint").alias("doc_id"), docs[text].alias("text"))
    named = rows.filter(F.col("doc_id").isNotNull())
    size = rows.agg(F.sum(utf8_size(F.col("text")))).first()[0]
    ranges = parts_for(size, RANGE_BYTES)

    described = rows.mapInArrow(lambda batches: _described(batches, rule),
                                "doc_id bigint, n bigint, digest binary, bitmap binary")
    described = materialize(described)
    first = described.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("first"))
    known = materialize(described.join(materialize(first), "digest", "left")
                        .select("doc_id", "n", F.coalesce("first", "doc_id").alias("first"), "bitmap"))

    packed = named.mapInArrow(lambda batches: _tiles(batches, rule, ranges), "rng bigint, ids binary, keys binary")
    shared = materialize(packed.groupBy("rng").applyInArrow(_shared_tiles, "tile bigint, doc_id bigint"))
    members = materialize(shared.join(known.select("doc_id", "first"), "doc_id")
                          .select("tile", F.col("first").alias("doc_id")).distinct())
    compared = materialize(_spread(members).join(known.filter("bitmap is not null and doc_id = first").select("doc_id", "n", "bitmap"), "doc_id"))
    groups = parts_for(compared.agg(F.sum(F.octet_length("bitmap") + 64)).first()[0], GROUP_BYTES)

    def may_link(rows: pa.Table) -> pa.Table:
        return _may_link(rows, rule)

    def links(rows: pa.Table) -> pa.Table:
        return _links(rows, rule)

    possible = (compared.withColumn("grp", F.pmod(F.xxhash64("tile"), F.lit(groups)))
                .groupBy("grp").applyInArrow(may_link, "u bigint, v bigint"))
    families = connected_components(possible)
    families = materialize(families.unionByName(families.select(F.col("component").alias("node"), "component")).distinct())

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in slices(texts, SLICE_CHARS):
                flat, bounds = shingle_sets(texts[a:b], rule.words)
                own = [flat[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(np.diff(bounds)),
                     pa.array(band_of(np.diff(bounds), rule).astype(np.int32)), pa.array(own, pa.binary())],
                    names=["doc_id", "family", "n", "band", "hashes"])

    wanted = named.join(families.select(F.col("node").alias("doc_id"), F.col("component").alias("family")), "doc_id")
    fetched = materialize(wanted.select("doc_id", "family", "text").mapInArrow(
        sets, "doc_id bigint, family bigint, n bigint, band int, hashes binary").filter("n > 0"))
    placed = _places(fetched)
    copied = parts_for(placed.agg(F.sum(8 * F.col("n"))).first()[0], GROUP_BYTES)      # 8 bytes a hash, each copy counted
    found = (placed.withColumn("grp", F.pmod(F.xxhash64("place"), F.lit(copied)))
             .groupBy("grp").applyInArrow(links, "u bigint, v bigint"))
    component = connected_components(found)
    return (known.select("doc_id", F.col("n").alias("n_shingles"), "first")
            .join(component, F.col("first") == F.col("node"), "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "first").alias("component_id")))


def _spread(members: DataFrame) -> DataFrame:
    """Members of tiles; those of a large tile once for every pair of chunks that they belong to."""
    large = members.groupBy("tile").agg(F.ceil(F.count("*") / F.lit(TILE)).cast("int").alias("chunks")).filter("chunks > 1")
    chunk = F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1),
                        lambda c: F.xxhash64("tile", F.least(chunk, c), F.greatest(chunk, c)))
    return (members.join(materialize(large), "tile", "left")
            .select("doc_id", F.explode(F.when(F.col("chunks").isNull(), F.array("tile")).otherwise(pairs)).alias("tile")))


def _places(fetched: DataFrame) -> DataFrame:
    """Each set once for every chunk pair of its family that it belongs to, named ``place``."""
    chunks = materialize(fetched.groupBy("family", "band").agg(F.ceil(F.sum("n") / F.lit(CHUNK)).cast("int").alias("chunks")))
    here = fetched.join(chunks, ["family", "band"])
    above = chunks.select("family", (F.col("band") - 1).alias("band"), F.col("chunks").alias("above"))
    below = chunks.select("family", (F.col("band") + 1).alias("band"), F.col("chunks").alias("below"))
    here = here.join(above, ["family", "band"], "left").join(below, ["family", "band"], "left")
    chunk = F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int")

    def others(count: str):
        return F.when(F.coalesce(F.col(count), F.lit(0)) > 0, F.sequence(F.lit(0), F.col(count) - 1)).otherwise(
            F.array().cast("array<int>"))

    def name(band, low, high):
        return F.concat_ws("/", F.col("family"), band, low, high)

    one = F.lit(1)
    same = F.transform(others("chunks"), lambda c: name(F.col("band"), F.least(chunk, c), F.concat(F.lit("="), F.greatest(chunk, c))))
    up = F.transform(others("above"), lambda c: name(F.col("band"), chunk, c))
    down = F.transform(others("below"), lambda c: name(F.col("band") - one, c, chunk))
    return here.select("doc_id", "n", "hashes", F.explode(F.concat(same, up, down)).alias("place"))
