"""Near-duplicate classes by ProbMinHash, banding and verification.

Every distinct run of ``SHINGLE`` tokens (see ``words.Tokens``) is an element, weighted by
how often the document has it. Elements send arrivals of a Poisson process whose rate is
the weight; each arrival falls on one of ``REGISTERS`` registers, and a register keeps
the element that reached it first. An element stops as soon as it can no longer be first
anywhere. Two documents agree in a register with the probability Jaccard similarity of
their weighted elements, which for elements that occur once is the usual Jaccard.

Documents of equal token sequence are one node. Nodes that agree in a whole band meet in
a bucket. A bucket is not expanded into pairs:

1. Its members are compared with the one that meets the most others, the likely original.
2. Where members stay apart, they are compared with one of them drawn at random.
3. What is left are pairs of members that are not connected. They are compared where the
   bucket lies: its rows carry their elements, an index of which counts what a member shares
   with all others at once. Distance is a metric, so two members whose similarities to the first
   leader differ by more than ``1 - SIMILARITY`` need no look, nor do members connected
   meanwhile. A bucket hands on no more links than join its members to trees, so its output
   grows with its rows and not with their pairs.

Links are confirmed on the elements themselves; classes are the connected components. Bands
miss one link at 0.8 in 20,000; beyond that none is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.words import WORD_FACTOR, Tokens, chunks, column_of, mixed
from caseloom.storage import settle

SHINGLE, SIMILARITY = 5, 0.8
#: 25 bands of 5: documents at 0.8 meet with probability 0.99995.
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: Rows and elements of a bucket that one place compares; larger buckets are dealt to pairs of blocks.
BLOCK_ROWS, BLOCK_ELEMENTS = 4096, 2_000_000
#: Comparisons with one leader are spread over so many places.
SALTS = 16
NO_ID = -(1 << 63)

SKETCH = "id long, mark long, node binary, bands array<long>, width int"


def shingles(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each shingle and its text; texts shorter than a shingle are one themselves."""
    n, room = len(tokens), tokens.room()
    out = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, n)):
        out[: n - k] = mixed(out[: n - k] * np.uint64(WORD_FACTOR) + tokens.hashes[k:])
    counts = tokens.first[1:] - tokens.first[:-1]
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    whole = room >= SHINGLE
    for text in short.tolist():
        a, b = tokens.first[text], tokens.first[text + 1]
        digest = hashlib.blake2b(tokens.hashes[a:b].tobytes(), digest_size=8).digest()
        out[a] = np.frombuffer(digest, np.uint64)[0]
        whole[a] = True
    at = np.flatnonzero(whole)
    return out[at], tokens.of_text[at]


def weighted(values: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each text with their counts, texts in order, and where each text begins."""
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    new = np.append(True, (values[1:] != values[:-1]) | (text[1:] != text[:-1])) if len(values) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    counts = np.diff(np.append(begin, len(values)))
    return values[begin], text[begin], counts, np.searchsorted(text[begin], np.arange(n_texts + 1))


def signatures(
    values: np.ndarray, text: np.ndarray, weights: np.ndarray, n_texts: int, registers: int = REGISTERS
) -> np.ndarray:
    """For each text the first element to arrive at each register."""
    best = np.full(n_texts * registers, np.inf)
    winner = np.zeros(n_texts * registers, np.uint64)
    active = np.arange(len(values))
    time = np.zeros(len(values))
    step = 0
    while len(active):
        drawn = mixed(values[active] + np.uint64((0x9E3779B97F4A7C15 * (2 * step + 1)) % (1 << 64)))
        uniform = ((drawn >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
        time[active] -= np.log(uniform) / weights[active]
        register = (mixed(drawn + np.uint64(step)) % np.uint64(registers)).astype(np.int64)
        place = text[active] * registers + register
        now = time[active]
        np.minimum.at(best, place, now)
        first = now == best[place]
        winner[place[first]] = values[active[first]]
        # Later arrivals of an element only come later: beyond the slowest register it is done.
        new = np.append(True, text[active][1:] != text[active][:-1])
        slowest = best.reshape(n_texts, registers)[text[active][new]].max(axis=1)
        active = active[now < slowest[np.cumsum(new) - 1]]
        step += 1
    return winner.reshape(n_texts, registers)


def bands_of(signature: np.ndarray) -> np.ndarray:
    out = np.zeros((len(signature), BANDS), np.uint64)
    for band in range(BANDS):
        value = np.full(len(signature), band + 1, np.uint64)
        for k in range(ROWS):
            value = mixed(value + signature[:, band * ROWS + k])
        out[:, band] = value
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in chunks(batches, "text", row_bytes=4 * REGISTERS):
        tokens = Tokens(column_of(table, "text"))
        n = table.num_rows
        data, edges = tokens.hashes.tobytes(), (tokens.first * 8).tolist()
        nodes = [
            hashlib.blake2b(data[a:b], digest_size=16).digest() if b > a else None
            for a, b in zip(edges[:-1], edges[1:], strict=True)
        ]
        values, text, counts, first = weighted(*shingles(tokens), n)
        bands = bands_of(signatures(values, text, counts, n)).view(np.int64)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(0, (n + 1) * BANDS, BANDS), pa.int32()), pa.array(bands.ravel())
        )
        yield pa.RecordBatch.from_arrays(
            [
                column_of(table, "id"), column_of(table, "mark"), pa.array(nodes, pa.binary()), lists,
                pa.array(np.diff(first).astype(np.int32)),
            ],
            names=["id", "mark", "node", "bands", "width"],
        )


# -- verification ----------------------------------------------------------------------


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Of elements ``a`` with weights ``x`` and ``b`` with ``y``; both sorted and distinct.

    The sum, over shared elements, of 1 over the sum of ``max(x_j / x_i, y_j / y_i)``.
    """
    _, at, there = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(at):
        return 0.0
    shared_x, shared_y = x[at].astype(float), y[there].astype(float)
    only_x, only_y = x.sum() - shared_x.sum(), y.sum() - shared_y.sum()
    ratio = shared_x / shared_y
    order = np.argsort(ratio, kind="stable")
    ratio, shared_x, shared_y = ratio[order], shared_x[order], shared_y[order]
    # For element i, those with a larger ratio count by x, the others by y.
    cut = np.searchsorted(ratio, ratio, side="right")
    below_y = np.append(0, np.cumsum(shared_y))[cut]
    above_x = np.append(np.cumsum(shared_x[::-1])[::-1], 0)[cut]
    return float((1 / ((above_x + only_x) / shared_x + (below_y + only_y) / shared_y)).sum())


def _elements(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    values, _, counts, first = weighted(*shingles(Tokens(texts)), len(texts))
    return [(values[a:b], counts[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by place; in each place the leader's text comes before the others."""
    leader, own = None, None
    for table in chunks(batches, "text"):
        found = _elements(column_of(table, "text"))
        left, right, how = [], [], []
        leaders, nodes = (column_of(table, name).to_pylist() for name in ("leader", "node"))
        for a, node, other in zip(leaders, nodes, found, strict=True):
            if node == a:
                leader, own = a, other
                continue
            if leader != a:
                raise ValueError("a leader's text is missing")
            left.append(a)
            right.append(node)
            how.append(probability_jaccard(*own, *other))
        yield pa.RecordBatch.from_arrays(
            [pa.array(left, pa.binary()), pa.array(right, pa.binary()), pa.array(how, pa.float64())],
            names=["leader", "node", "similarity"],
        )


def _compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``leader, node, similarity`` for each pair. A leader's text is sent once to each place that needs it."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    members = salted.join(texts, "node").select("leader", "salt", "node", "text")
    places = salted.select("leader", "salt").distinct()
    leaders = places.join(texts.withColumnRenamed("node", "leader"), "leader").select(
        "leader", "salt", F.col("leader").alias("node"), "text"
    )
    rows = members.unionByName(leaders).repartition("leader", "salt").sortWithinPartitions(
        "leader", "salt", F.col("node") != F.col("leader")
    )
    return rows.select("leader", "node", "text").mapInArrow(
        _verify, "leader binary, node binary, similarity double"
    )


# -- pairs that leaders did not settle ---------------------------------------------------


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, elements, weights``: a node's elements in order, 8 bytes each, and their counts, 4 bytes each."""
    for table in chunks(batches, "text"):
        found = _elements(column_of(table, "text"))
        yield pa.RecordBatch.from_arrays(
            [
                column_of(table, "node"), pa.array([v.tobytes() for v, _ in found], pa.binary()),
                pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary()),
            ],
            names=["node", "elements", "weights"],
        )


class _Place:
    """The rows of one bucket, or of two blocks of one.

    ``shared`` are all elements in order, and ``holder`` the row of each: what a row shares
    with the others is counted over its elements' holders.
    """

    def __init__(self, table: pa.Table):
        self.nodes = column_of(table, "node").to_pylist()
        self.side = np.asarray(column_of(table, "side"))
        self.label = np.asarray(column_of(table, "label").dictionary_encode().indices).astype(np.int64)
        self.pivot = np.asarray(column_of(table, "pivot"))
        lists = column_of(table, "bands")
        self.bands = np.asarray(lists.flatten()).reshape(len(lists), BANDS)
        self.bucket = column_of(table, "bucket")[0].as_py()
        elements = column_of(table, "elements").to_pylist()
        self.first = np.append(0, np.cumsum([len(e) // 8 for e in elements]))
        self.values = np.frombuffer(b"".join(elements), np.uint64)
        self.weights = np.frombuffer(b"".join(column_of(table, "weights").to_pylist()), np.int32)
        order = np.argsort(self.values, kind="stable")
        self.shared, holders = self.values[order], np.repeat(np.arange(len(elements)), np.diff(self.first))
        self.holder, self.times = holders[order], self.weights[order]
        self.total = np.add.reduceat(self.weights.astype(np.int64), self.first[:-1])
        self.plain = self.total == np.diff(self.first)

    def _own(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.first[k], self.first[k + 1])
        return self.values[part], self.weights[part]

    def _linked(self, k: int, rows: np.ndarray, similarity: float) -> np.ndarray:
        """Which of ``rows`` are linked to row ``k``."""
        values, weights = self._own(k)
        lo, hi = np.searchsorted(self.shared, values), np.searchsorted(self.shared, values, side="right")
        counts = hi - lo
        stops = np.cumsum(counts)
        at = np.arange(stops[-1]) + np.repeat(lo - (stops - counts), counts)
        holder, n = self.holder[at], len(self.nodes)
        both = np.bincount(holder, minlength=n)[rows]
        if self.plain[k] and self.plain[rows].all():
            return rows[both >= similarity * (len(values) + self.total[rows] - both) - 1e-9]
        # The similarity is at most the share of either text's weight that the other has, too.
        mine = np.bincount(holder, weights=np.repeat(weights, counts), minlength=n)[rows] / self.total[k]
        theirs = np.bincount(holder, weights=self.times[at], minlength=n)[rows] / self.total[rows]
        rows = rows[np.minimum(mine, theirs) >= similarity - 1e-9]
        near = [probability_jaccard(values, weights, *self._own(j)) >= similarity for j in rows.tolist()]
        return rows[np.array(near, bool)]

    def links(self, similarity: float) -> Iterator[tuple[bytes, bytes]]:
        """Links that join whatever all links of the place join.

        A pair belongs to the first bucket that its two nodes share.
        """
        at = int(np.flatnonzero((self.bands == self.bucket).all(axis=0))[0])
        two = bool(self.side.any())
        # Members of the largest component are met by all others and need not look themselves.
        large = self.label == np.bincount(self.label).argmax()
        for k in np.flatnonzero(~large).tolist():
            free = self.label != self.label[k]
            free &= large | (np.arange(len(free)) > k)
            if two:
                free &= self.side != self.side[k]
            rows = np.flatnonzero(free)
            rows = rows[np.abs(self.pivot[rows] - self.pivot[k]) <= 1 - similarity + 1e-9]
            if at:
                rows = rows[~(self.bands[rows, :at] == self.bands[k, :at]).any(axis=1)]
            if not len(rows):
                continue
            for other in self._linked(k, rows, similarity).tolist():
                if self.label[other] != self.label[k]:
                    self.label[self.label == self.label[other]] = self.label[k]
                    yield self.nodes[k], self.nodes[other]


def _place_links(similarity: float):
    """Rows come sorted by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def settled() -> pa.RecordBatch:
            found = list(_Place(pa.Table.from_batches(held)).links(similarity))
            return pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in found], pa.binary()) for k in (0, 1)], names=["a", "b"]
            )

        place = None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("bucket", "one", "two")), strict=True))
            edges = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                if keys[a] != place and held:
                    yield settled()
                    held.clear()
                place = keys[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield settled()

    return run


def _unsettled_links(
    entries: DataFrame, nodes: DataFrame, texts: DataFrame, similarity: float, block_rows: int
) -> DataFrame:
    """``a, b``: links between members that are not connected. ``entries``: ``bucket, node, label, pivot``.

    A bucket of more than ``block_rows``, or of more elements than a place may hold, is dealt
    to all pairs of its blocks.
    """
    carried = texts.join(entries.select("node").distinct(), "node").mapInArrow(
        _carry, "node binary, elements binary, weights binary"
    )
    # Written, since it is read twice: a smaller plan, and the joins are made once.
    rows = settle(entries.join(nodes.select("node", "bands", "width"), "node"), "placed")
    blocks = F.greatest(F.ceil(F.count("*") / block_rows), F.ceil(F.sum("width") / BLOCK_ELEMENTS))
    sizes = rows.groupBy("bucket").agg(blocks.cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = rows.join(sizes, "bucket").withColumn("mine", mine).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("theirs")
    )
    dealt = dealt.select(
        "bucket", F.least("mine", "theirs").alias("one"), F.greatest("mine", "theirs").alias("two"),
        F.when(F.col("mine") > F.col("theirs"), 1).otherwise(0).alias("side"),
        "node", "label", "pivot", "bands",
    ).join(carried, "node")
    sorted_rows = dealt.repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two")
    return sorted_rows.mapInArrow(_place_links(similarity), "a binary, b binary")


# -- components ------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node that has a link: the smallest node of its component.

    Alternates two steps that hang every node below the smallest one it knows: larger
    neighbours first, then smaller ones, until nothing changes.
    """
    edges = settle(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(),
        "links",
    )

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = settle(small, "links")
        after = state(edges)
        if after == before:
            break
        before = after
    hung = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return hung.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()


# -- the operator ----------------------------------------------------------------------


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *,
    similarity: float = SIMILARITY, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``key, mark, class_id, kept``, one row per row of ``docs``.

    ``class_id`` is the smallest key of the documents connected by links of at least
    ``similarity``; the rows with that key and, among them, the smallest ``mark`` (a
    hash of the text) are ``kept``. Documents without a token are each in a class of
    their own. A null key counts as smaller than any other and gives a null class. Rows
    repeated as a whole share a class and are kept together. An empty table gives an
    empty result. Other columns are not read.
    """
    work = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(text).alias("mark"),
        F.col(text).alias("text"),
    )
    sketches = settle(work.mapInArrow(_sketch, SKETCH), "sketches")
    nodes = sketches.where("node is not null").groupBy("node").agg(
        F.min(F.struct("id", "mark", "bands", "width")).alias("first")
    ).select("node", "first.*")
    entries = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    entries = settle(entries.join(shared, "bucket"), "entries")
    members = sketches.select("id", "mark", "node")
    if entries.isEmpty():
        return _classes(members.withColumn("label", F.col("node")), key)

    met = entries.groupBy("node").agg(F.sum("n").alias("met"))
    nodes = settle(nodes.join(met, "node"), "nodes")
    # Nodes are few beside documents; a repeated row would come along several times.
    texts = work.join(nodes.select("id", "mark", "node"), ["id", "mark"]).select("node", "text")
    texts = settle(texts.dropDuplicates(["node"]), "candidates")

    # 1. Everyone in a bucket against the member that meets the most others.
    ranked = entries.join(nodes.select("node", "met"), "node")
    first = ranked.groupBy("bucket").agg(F.max(F.struct("met", "node"))["node"].alias("leader"))
    entries = settle(entries.select("bucket", "node").join(first, "bucket"), "led")
    compared = settle(_compare(entries.where("node != leader").select("leader", "node").distinct(), texts), "first")
    labels = settle(components(_links(compared, similarity)), "labels")

    # 2. Where members stay apart, those apart from a member drawn at random against it.
    entries = _apart(entries, labels)
    drawn = F.min_by(F.struct("node", "label"), F.xxhash64("node", "bucket")).alias("drawn")
    pairs = entries.join(entries.groupBy("bucket").agg(drawn), "bucket").where("label != drawn.label")
    pairs = pairs.select(F.col("drawn.node").alias("leader"), "node").distinct()
    second = settle(_compare(pairs, texts), "second")
    links = _links(compared, similarity).unionByName(_links(second, similarity))
    labels = settle(components(links), "labels")

    # 3. All other pairs that are not connected.
    entries = _apart(entries.drop("label"), labels)
    pivot = compared.withColumnRenamed("similarity", "pivot")
    entries = entries.join(pivot, ["leader", "node"], "left").select(
        "bucket", "node", "label", F.coalesce("pivot", F.lit(1.0)).alias("pivot")
    )
    third = _unsettled_links(settle(entries, "apart"), nodes, texts, similarity, block_rows)
    third = settle(third, "third")
    if not third.isEmpty():
        labels = settle(components(links.unionByName(third)), "labels")
    members = members.join(labels, "node", "left").select(
        "id", "mark", F.coalesce("label", "node").alias("label")
    )
    return _classes(members, key)


def _links(judged: DataFrame, similarity: float) -> DataFrame:
    found = judged.where(F.col("similarity") >= similarity)
    return found.select(F.col("leader").alias("a"), F.col("node").alias("b"))


def _apart(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows, with labels, of buckets that have nodes of several components."""
    known = entries.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    known = settle(known, "labelled")
    mixed_buckets = known.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return known.join(mixed_buckets.where("low != high").select("bucket"), "bucket")


def _classes(members: DataFrame, key: str) -> DataFrame:
    """From ``id, mark, label``; a null label is a class of its own."""
    own = F.struct("id", "mark")
    # Written, so that the join below is dealt anew and a large class can be split.
    heads = settle(members.where("label is not null").groupBy("label").agg(F.min(own).alias("head")), "heads")
    done = members.join(heads, "label", "left").select("id", "mark", F.coalesce("head", own).alias("head"))

    def shown(column):
        return F.when(column != NO_ID, column)

    return done.select(
        shown(F.col("id")).alias(key), "mark", shown(F.col("head.id")).alias("class_id"),
        (own == F.col("head")).alias("kept"),
    )


def one_of_each_class(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns."""
    kept = near_duplicates(docs, key, text, **options).where("kept")
    kept = kept.select(F.col(key).alias("_key"), F.col("mark").alias("_mark")).distinct()
    same = docs[key].eqNullSafe(kept["_key"]) & (F.xxhash64(docs[text]) == kept["_mark"])
    return docs.join(kept, same, "left_semi")
