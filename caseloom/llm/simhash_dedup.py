"""Near-duplicate components by SimHash and the generalised pigeonhole principle.

A fingerprint has a bit for each of 64 positions, set where over half of the document's
shingle hashes have it. Fingerprints of up to ``DISTANCE`` differing bits are linked.

The bits are split into parts of ``log2`` of the number of fingerprints, correlated bits
together, so that common values gather in few parts. If two fingerprints differ in at most
``d`` bits, then for any thresholds ``t`` of the parts with the sum of ``t + 1`` being
``d + 1``, they differ in at most ``t`` bits in some part; a threshold of -1 leaves a part out.
Every fingerprint takes its own thresholds, those with the least estimated number of probes
and candidates, by dynamic programming over the parts. It is put into the bucket of its value
in every part, and probes the buckets of all values within its thresholds.

A bucket's probes are verified against its members where they lie. Pairs of one component
are skipped, and a bucket hands on no more links than join its rows to trees, so what leaves
it grows with its rows and not with their pairs. Large buckets are dealt to pairs of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.near_dedup import components
from caseloom.llm.words import Words, chunks, column_of, string_bytes
from caseloom.storage import settle

SHINGLE, BITS, DISTANCE, SEED = 4, 64, 4, 42
#: Bits of a part that its histogram tells apart.
HISTOGRAM_BITS = 10
#: What a probe costs, in candidates verified.
PROBE_COST = 20.0
#: Rows of a bucket that one place compares; larger buckets are dealt to pairs of blocks.
BLOCK_ROWS = 4096
#: Pairs verified at once.
PAIRS = 1 << 20
#: A fingerprint of at least one row in so many is sent to all tasks, at most as many of them.
HOT_SHARE = 1000
#: The key that stands for null; smaller than any other.
NO_ID = -(1 << 63)


# -- fingerprints ------------------------------------------------------------------------


class LowerWords(Words):
    """Words of texts, A-Z lower-cased, and the texts of one space between neighbours."""

    def __init__(self, texts: pa.Array):
        data, offsets = string_bytes(pc.fill_null(texts.cast(pa.large_string()), ""))
        lower = data.tobytes().translate(bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)))
        super().__init__(
            pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.tobytes()), pa.py_buffer(lower))
        )


#: For each byte value, its bits as eight bytes of 0 or 1, highest first.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).copy().view(np.uint64).ravel()


def majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text, the bits set in over half of its hashes; none without hashes."""
    n = len(first) - 1
    out = np.zeros((n, BITS), bool)
    counts = first[1:] - first[:-1]
    filled = np.flatnonzero(counts)
    if not len(filled):
        return np.zeros(n, np.uint64)
    # Bytes of up to 255 hashes are added at once, eight counters in a number.
    begin = first[filled]
    blocks = (counts[filled] + 254) // 255
    of = np.repeat(np.arange(len(filled)), blocks)
    step = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts = begin[of] + 255 * step
    edges = np.searchsorted(of, np.arange(len(filled)))
    octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    for k in range(8):
        sums = np.add.reduceat(_SPREAD[octets[:, k]], starts)
        each = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), edges, axis=0)
        out[filled, 8 * k : 8 * k + 8] = 2 * each > counts[filled, None]
    return np.packbits(out, axis=1).view(">u8").astype(np.uint64).ravel()


def fingerprints(texts: pa.Array) -> np.ndarray:
    words = LowerWords(texts)
    if not len(words):
        return np.zeros(len(texts), np.uint64)
    data, begin, end = words.packed()
    counts = words.counts()
    n_shingles = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    first = np.append(0, np.cumsum(n_shingles))
    of = np.repeat(np.arange(len(counts)), n_shingles)
    at = words.first[:-1][of] + np.arange(len(of)) - first[of]
    last = np.minimum(at + SHINGLE, words.first[1:][of]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(data[a:b], SEED) for a, b in zip(begin[at].tolist(), end[last].tolist(), strict=True)),
        np.uint64, len(of),
    )
    return majority(hashes, first)


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in chunks(batches, "text"):
        found = fingerprints(column_of(table, "text")).view(np.int64)
        yield pa.RecordBatch.from_arrays([column_of(table, "id"), pa.array(found)], names=["id", "print"])


# -- parts and thresholds ----------------------------------------------------------------


def _bit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often two bits are set together, 64 x 64 rows a task."""
    sums = np.zeros((BITS, BITS), np.int64)
    for batch in batches:
        prints = np.asarray(batch.column(0)).astype(">i8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(prints, axis=1).astype(np.float32)
        sums += (bits.T @ bits).astype(np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(BITS * BITS)), pa.array(sums.ravel())], names=["cell", "n"]
    )


def correlated_parts(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits 0 (highest) to 63 in ``parts`` groups of nearly equal size, correlated bits together.

    ``together[i, j]`` counts the fingerprints with both bits. Each group begins with the bit most
    correlated to others of those left, and takes the bit most correlated to its own until it is full.
    """
    share = together / max(n, 1)
    one = np.diag(share)
    spread = np.sqrt(np.maximum(one * (1 - one), 1e-12))
    related = np.abs((share - np.outer(one, one)) / np.outer(spread, spread))
    # A bit that hardly varies is known beforehand, like one that follows from others.
    related += np.maximum.outer(np.abs(2 * one - 1), np.abs(2 * one - 1))
    np.fill_diagonal(related, 0)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        group = [max(left, key=lambda b: (related[b, left].max() if len(left) > 1 else 0, -b))]
        left.remove(group[0])
        while len(group) < size:
            group.append(max(left, key=lambda b: (related[b, group].mean(), -b)))
            left.remove(group[-1])
        groups.append(group)
    return groups


class Parts:
    """The groups of bits, and how many fingerprints have each value in a group's first bits."""

    def __init__(self, groups: list[list[int]], histograms: np.ndarray | None = None):
        self.groups = groups
        self.histograms = histograms  # groups x 2 ** HISTOGRAM_BITS

    def values(self, prints: np.ndarray, part: int) -> np.ndarray:
        """The bits of a part, the first of the group highest."""
        out = np.zeros(len(prints), np.uint64)
        for bit in self.groups[part]:
            out = (out << np.uint64(1)) | ((prints >> np.uint64(BITS - 1 - bit)) & np.uint64(1))
        return out

    def heads(self, prints: np.ndarray, part: int) -> np.ndarray:
        width = len(self.groups[part])
        return (self.values(prints, part) >> np.uint64(max(width - HISTOGRAM_BITS, 0))).astype(np.int64)

    def masks(self, part: int, radius: int) -> np.ndarray:
        width = len(self.groups[part])
        found = [
            sum(1 << b for b in some) for r in range(radius + 1) for some in combinations(range(width), r)
        ]
        return np.array(found, np.uint64)

    def costs(self, part: int, most: int) -> np.ndarray:
        """For each head value the cost of 0 to ``most`` units; ``u`` units are a threshold of ``u - 1``."""
        width = len(self.groups[part])
        near = min(width, HISTOGRAM_BITS)
        rest = width - near
        count = self.histograms[part, : 1 << near].astype(float)
        # Values at each distance within the head, and the share of the other bits near enough.
        layers = [count]
        heads = np.arange(1 << near)
        by_weight = [np.flatnonzero(np.bitwise_count(heads) == r) for r in range(most)]
        layers = [sum(count[heads ^ mask] for mask in masks.tolist()) + np.zeros(len(heads)) for masks in by_weight]
        out = np.zeros((len(heads), most + 1))
        for u in range(1, most + 1):
            probes = sum(math.comb(width, r) for r in range(u))
            met = sum(
                layers[r] * sum(math.comb(rest, s) for s in range(u - r)) / (1 << rest) for r in range(u)
            )
            out[:, u] = PROBE_COST * probes + met
        return out


def thresholds(parts: Parts, prints: np.ndarray, distance: int) -> np.ndarray:
    """For each fingerprint the units of each part, ``distance + 1`` in all, of the least cost."""
    units = distance + 1
    best = np.full((len(prints), units + 1), np.inf)
    best[:, 0] = 0
    taken = np.zeros((len(parts.groups), len(prints), units + 1), np.int8)
    for part in range(len(parts.groups)):
        cost = parts.costs(part, units)[parts.heads(prints, part)]
        new = np.full_like(best, np.inf)
        for total in range(units + 1):
            for u in range(total + 1):
                value = best[:, total - u] + cost[:, u]
                better = value < new[:, total]
                new[better, total] = value[better]
                taken[part, better, total] = u
        best = new
    out = np.zeros((len(prints), len(parts.groups)), np.int8)
    left = np.full(len(prints), units)
    for part in reversed(range(len(parts.groups))):
        out[:, part] = taken[part, np.arange(len(prints)), left]
        left = left - out[:, part]
    return out


MEMBER, PROBE, BOTH = 1, 2, 3


def _probe(parts: Parts, distance: int) -> Callable:
    """``bucket, print, role`` of every fingerprint as a member of its buckets and as a probe of others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # In pieces, since a fingerprint has many probes.
            for at in range(0, batch.num_rows, 4096):
                prints = np.asarray(batch.column(0))[at : at + 4096].view(np.uint64)
                units = thresholds(parts, prints, distance)
                for part in range(len(parts.groups)):
                    values = parts.values(prints, part)
                    for u in np.unique(units[:, part]).tolist():
                        rows = np.flatnonzero(units[:, part] == u)
                        masks = parts.masks(part, u - 1) if u else np.zeros(1, np.uint64)
                        # The first mask is 0: the own bucket.
                        bucket = (values[rows][:, None] ^ masks).ravel() | np.uint64(part << 58)
                        role = np.full((len(rows), len(masks)), PROBE, np.int8)
                        role[:, 0] = BOTH if u else MEMBER
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(bucket.view(np.int64)), pa.array(np.repeat(prints[rows], len(masks)).view(np.int64)),
                                pa.array(role.ravel()),
                            ],
                            names=["bucket", "print", "role"],
                        )

    return run


# -- verification within a place ---------------------------------------------------------


class Forest:
    """Which of some rows are joined already, and the links that joined them."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Pairs of rows; those that join two trees are kept as links."""
        while len(a):
            x, y = self.label[a], self.label[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            if not len(a):
                return
            # Each tree hangs below the smallest label it meets, over one pair.
            high, low = np.maximum(x, y), np.minimum(x, y)
            order = np.lexsort((low, high))
            first = order[np.append(True, high[order][1:] != high[order][:-1])]
            self.links += zip(a[first].tolist(), b[first].tolist(), strict=True)
            up = np.arange(len(self.label))
            up[high[first]] = low[first]
            while (up[up] != up).any():
                up = up[up]
            self.label = up[self.label]


def linked(prints: np.ndarray, probe: np.ndarray, member: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join rows of one place as all links of a probe and a member would."""
    probes, members = np.flatnonzero(probe), np.flatnonzero(member)
    if not len(probes) or not len(members):
        return []
    forest = Forest(len(prints))
    # Everyone against the first member, which settles most of a family.
    near = np.bitwise_count(prints[probes] ^ prints[members[0]]) <= distance
    forest.join(probes[near], np.full(int(near.sum()), members[0]))
    step = max(1, PAIRS // len(members))
    for at in range(0, len(probes), step):
        some = probes[at : at + step]
        near = np.bitwise_count(prints[some][:, None] ^ prints[members]) <= distance
        near &= forest.label[some][:, None] != forest.label[members]
        i, j = np.nonzero(near)
        forest.join(some[i], members[j])
    return forest.links


def _small_places(prints, role, begin, distance) -> tuple[np.ndarray, np.ndarray]:
    """All links of places of few rows, many places at once."""
    size = np.diff(begin)
    left, right = [], []
    for n in np.unique(size).tolist():
        if n < 2:
            continue
        places = np.flatnonzero(size == n)
        step = max(1, PAIRS // (n * n))
        for at in range(0, len(places), step):
            rows = begin[places[at : at + step]][:, None] + np.arange(n)
            p, r = prints[rows], role[rows]
            near = np.bitwise_count(p[:, :, None] ^ p[:, None, :]) <= distance
            near &= ((r & PROBE) > 0)[:, :, None] & ((r & MEMBER) > 0)[:, None, :]
            near &= p[:, :, None] != p[:, None, :]
            k, i, j = np.nonzero(near)
            left.append(p[k, i])
            right.append(p[k, j])
    none = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


#: Rows of a place whose pairs are few enough to be listed.
FEW = 32


def _verify(distance: int) -> Callable:
    """Rows come sorted by place. ``a, b``: links of different fingerprints."""

    def settled(keys: np.ndarray, prints: np.ndarray, role: np.ndarray) -> pa.RecordBatch:
        begin = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        begin = np.append(begin, len(keys))
        size = np.diff(begin)
        few = np.flatnonzero(size <= FEW)
        rows = np.repeat(size <= FEW, size)
        a, b = _small_places(prints[rows], role[rows], np.append(0, np.cumsum(size[few])), distance)
        left, right = [a], [b]
        for k in np.flatnonzero(size > FEW).tolist():
            own = slice(begin[k], begin[k + 1])
            found = linked(prints[own], (role[own] & PROBE) > 0, (role[own] & MEMBER) > 0, distance)
            if found:
                i, j = np.array(found).T
                left.append(prints[own][i])
                right.append(prints[own][j])
        a, b = np.concatenate(left), np.concatenate(right)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)[a != b], axis=0)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(pairs[:, k]).view(np.int64)) for k in (0, 1)], names=["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            keys = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("bucket", "one", "two")], axis=1)
            prints, role = np.asarray(batch.column("print")).view(np.uint64), np.asarray(batch.column("role"))
            if not len(keys):
                continue
            # The last place may go on in the next batch.
            last = len(keys) - int((keys == keys[-1]).all(axis=1)[::-1].argmin() or len(keys))
            if last:
                held.append((keys[:last], prints[:last], role[:last]))
                yield settled(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held = []
            elif held and (held[-1][0][-1] != keys[0]).any():
                yield settled(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held = []
            held.append((keys[last:], prints[last:], role[last:]))
        if held:
            yield settled(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


# -- the operator ------------------------------------------------------------------------


def _parts(prints: DataFrame, n: int) -> Parts:
    count = max(2, min(8, round(BITS / max(math.log2(max(n, 2)), 8))))
    cells = prints.select("print").mapInArrow(_bit_counts, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    table = cells.toArrow()  # 64 x 64 rows
    together = np.zeros(BITS * BITS, np.int64)
    together[np.asarray(table["cell"])] = np.asarray(table["n"])
    parts = Parts(correlated_parts(together.reshape(BITS, BITS), n, count))

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(count << HISTOGRAM_BITS, np.int64)
        for batch in batches:
            own = np.asarray(batch.column(0)).view(np.uint64)
            for part in range(count):
                sums += np.bincount((part << HISTOGRAM_BITS) + parts.heads(own, part), minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["cell", "n"])

    cells = prints.select("print").mapInArrow(heads, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    table = cells.toArrow()  # at most parts x 2 ** HISTOGRAM_BITS rows
    histograms = np.zeros(count << HISTOGRAM_BITS, np.int64)
    histograms[np.asarray(table["cell"])] = np.asarray(table["n"])
    parts.histograms = histograms.reshape(count, -1)
    return parts


def links(prints: DataFrame, n: int, distance: int = DISTANCE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``a, b``: pairs of the ``n`` distinct ``print`` that connect whatever all links would connect."""
    rows = settle(
        prints.select("print").mapInArrow(_probe(_parts(prints, n), distance), "bucket long, print long, role byte"),
        "probes",
    )
    large = rows.groupBy("bucket").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")).where("blocks > 1")
    rows = rows.join(settle(large, "large-buckets"), "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    mine = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    # Members of block ``one`` meet probes of block ``two``; a row of a small bucket is dealt once.
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    as_member = F.transform(every, lambda k: F.struct(mine.alias("one"), k.alias("two"), F.lit(MEMBER).cast("byte").alias("role")))
    as_probe = F.transform(every, lambda k: F.struct(k.alias("one"), mine.alias("two"), F.lit(PROBE).cast("byte").alias("role")))
    once = F.array(F.struct(F.lit(0).alias("one"), F.lit(0).alias("two"), F.col("role")))
    places = (
        F.when(F.col("blocks") == 1, once)
        .when(F.col("role") == MEMBER, as_member)
        .when(F.col("role") == PROBE, as_probe)
        .otherwise(F.concat(as_member, as_probe))
    )
    dealt = rows.select("bucket", "print", F.explode(places).alias("place")).select(
        "bucket", "place.one", "place.two", "print", "place.role"
    )
    sorted_rows = dealt.repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two")
    return sorted_rows.mapInArrow(_verify(distance), "a long, b long")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *,
    distance: int = DISTANCE, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``key, fingerprint, component_id``, one row per row of ``docs``.

    ``component_id`` is the smallest key of all rows reachable over links, the row itself
    included. Null texts and texts without a word have a fingerprint of zero, which is linked
    like any other. Keys must be integral; a null key counts as smaller than any other and
    gives its component a null id. Repeated rows are rows of their own. An empty table gives
    an empty result. Other columns are not read.
    """
    work = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text"))
    own = settle(work.mapInArrow(_fingerprint, "id long, print long"), "fingerprints")
    groups = settle(own.groupBy("print").agg(F.min("id").alias("least"), F.count("*").alias("n")), "prints")
    distinct, total = groups.agg(F.count("*"), F.sum("n")).first()
    if distinct > 1:
        label = components(links(groups, distinct, distance, block_rows)).withColumnRenamed("node", "print")
        groups = groups.join(label, "print", "left").withColumn("label", F.coalesce("label", "print"))
    else:
        groups = groups.withColumn("label", F.col("print"))
    groups = settle(groups, "labelled")
    heads = groups.groupBy("label").agg(F.min("least").alias("head"))
    heads = settle(groups.join(heads, "label").select("print", "head", "n"), "heads")
    # Rows of the most common fingerprints, at most HOT_SHARE of those, are not shuffled.
    hot = heads.where(F.col("n") * HOT_SHARE >= (total or 1)).select("print", F.col("head").alias("hot_head"))
    split = own.join(F.broadcast(hot), "print", "left")
    done = split.where("hot_head is not null").select("id", "print", F.col("hot_head").alias("head"))
    rest = split.where("hot_head is null").select("id", "print")
    done = done.unionByName(rest.join(heads.select("print", "head"), "print"))

    def shown(name: str):
        return F.when(F.col(name) != NO_ID, F.col(name))

    return done.select(
        shown("id").alias(key), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        shown("head").alias("component_id"),
    )
