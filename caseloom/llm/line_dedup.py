"""Line deduplication by sharded minimal perfect hashing.

Lines that occur in enough documents are few among all lines. Their digests are dealt
to shards; each shard gets a minimal perfect hash function over its digests, which
numbers them without storing them, and three arrays behind those numbers: a
fingerprint, the number of documents, and the largest document id. Documents send only
digests to the shards and probe the arrays; no line is ever joined.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import fan_out, widened
from caseloom.llm.words import chunks, column_of, mixed
from caseloom.storage import settle

MIN_CHARS, MIN_DOCS = 20, 3
BLANK = " \t\n\v\f\r"
#: Digests behind one shard, at most on average; and the least number of shards.
SHARD_KEYS, LEAST_SHARDS = 200_000, 16
#: Every shard is probed in so many places, documents being spread over them.
SALTS = 8
NO_ID = -(1 << 63)


class PerfectHash:
    """Numbers ``n`` distinct keys, of one or two 64-bit numbers each, from 0 to ``n - 1``.

    Level by level, keys that fall on a place of their own in a bit array stay there;
    the others go on to the next, smaller level. A key's number is the rank of its bit.
    """

    #: Places for each key of a level; levels after which keys are looked at for repeated ones.
    SPREAD, MANY_LEVELS = 2, 64

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks = [np.cumsum(np.append(0, bits), dtype=np.int64) for bits in levels]

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        """Each level deals keys anew from all their bits, so keys that agree in one number come apart."""
        salt = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64))
        value = mixed(keys + salt) if keys.ndim == 1 else mixed(mixed(keys[:, 0] + salt) + keys[:, 1])
        return (value % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            if len(levels) == cls.MANY_LEVELS and len(np.unique(keys, axis=0)) < len(keys):
                raise ValueError("keys must be distinct")
            size = max(64, cls.SPREAD * len(keys))
            place = cls._place(keys, len(levels), size)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[place]]
        return cls(levels)

    def number(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; for keys it was not built from, any number or -1."""
        out = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            place = self._place(keys[left], level, len(bits))
            here = bits[place]
            out[left[here]] = base + ranks[place[here]]
            left, base = left[~here], base + int(ranks[-1])
        return out


def _halves(digests: pa.Array) -> np.ndarray:
    """16-byte digests as two columns of 64-bit numbers."""
    data = b"".join(digests.to_pylist())
    return np.frombuffer(data, np.uint64).reshape(-1, 2)


def line_keys(lines: pa.Array) -> pa.Array:
    """Blanks stripped at both ends, A-Z lower-cased."""
    return pc.ascii_lower(pc.ascii_trim(lines, characters=BLANK))


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All lines, and how many each text has; null is one empty line."""
    lists = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), "\n")
    return lists.flatten(), np.asarray(pc.list_value_length(lists)).astype(np.int64)


def _digests(lines: pa.Array, min_chars: int) -> list[bytes | None]:
    """The digest of each line's key, None for keys that are too short."""
    keys = line_keys(lines)
    long_enough = np.asarray(pc.greater_equal(pc.utf8_length(keys), min_chars))
    out: list[bytes | None] = [None] * len(keys)
    found = keys.filter(pa.array(long_enough)).cast(pa.large_binary()).to_pylist()
    for at, key in zip(np.flatnonzero(long_enough).tolist(), found, strict=True):
        out[at] = xxhash.xxh3_128_digest(key)
    return out


def _send(min_chars: int):
    """One row for each document and each different key it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "text"):
            lines, counts = _split(column_of(table, "text"))
            digests = _digests(lines, min_chars)
            out, of_doc, at = [], [], 0
            for doc, n in enumerate(counts.tolist()):
                own = dict.fromkeys(digests[at : at + n])
                own.pop(None, None)
                out += own
                of_doc += [doc] * len(own)
                at += n
            of_doc = pa.array(of_doc, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.binary()), column_of(table, "id").take(of_doc),
                 column_of(table, "mark").take(of_doc)],
                names=["digest", "id", "mark"],
            )

    return run


def _build(table: pa.Table) -> pa.Table:
    """The arrays of one shard, as one value."""
    halves = _halves(column_of(table, "digest"))
    function = PerfectHash.build(halves)
    number = function.number(halves)
    arrays = {}
    for name, values in (("print", halves[:, 1]), ("count", column_of(table, "n")), ("last", column_of(table, "last"))):
        values = np.asarray(values)
        arrays[name] = np.empty_like(values)
        arrays[name][number] = values
    arrays |= {f"level{k}": np.packbits(bits) for k, bits in enumerate(function.levels)}
    arrays["sizes"] = np.array([len(bits) for bits in function.levels], np.int64)
    out = io.BytesIO()
    np.savez_compressed(out, **arrays)
    return pa.table({"shard": table.column("shard")[:1], "arrays": pa.array([out.getvalue()], pa.binary())})


class Shard:
    """The arrays of one shard, ready for probes."""

    def __init__(self, blob: bytes):
        with np.load(io.BytesIO(blob)) as arrays:
            levels = [
                np.unpackbits(arrays[f"level{k}"], count=size).astype(bool)
                for k, size in enumerate(arrays["sizes"].tolist())
            ]
            self.prints, self.last = arrays["print"], arrays["last"]
        self.function = PerfectHash(levels)

    def drops(self, digests: pa.Array, ids: np.ndarray) -> np.ndarray:
        """Which documents lose the line: its key is here, and a larger id holds it."""
        halves = _halves(digests)
        number = self.function.number(halves)
        found = number >= 0
        at = np.where(found, number, 0)
        return found & (self.prints[at] == halves[:, 1]) & (self.last[at] > ids)


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard and salt, each place's arrays before its probes."""
    shard, at = None, None
    for batch in batches:
        place = np.asarray(batch.column("place"))
        edges = np.append(np.flatnonzero(np.append(True, place[1:] != place[:-1])), len(place))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            part = batch.slice(a, b - a)
            if place[a] != at:
                shard, at = None, place[a]
            if part.column("arrays").is_valid()[0].as_py():
                shard = Shard(part.column("arrays")[0].as_py())
                part = part.slice(1)
            if shard is None or not part.num_rows:
                continue
            drops = shard.drops(part.column("digest"), np.asarray(part.column("id")))
            yield part.select(["id", "mark", "digest"]).filter(pa.array(drops))


def _drop(min_chars: int, carried: list[str]):
    """Documents and the digests they lose to what is left of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "text"):
            lines, counts = _split(column_of(table, "text"))
            gone = column_of(table, "gone")
            some = np.asarray(gone.value_lengths().fill_null(0)) > 0
            # Only documents that lose something have their lines looked at again.
            digests = iter(_digests(lines.filter(pa.array(np.repeat(some, counts))), min_chars))
            texts = column_of(table, "text").cast(pa.large_binary()).to_pylist()
            kept, dropped = [], []
            for text, n, doc_gone, touched in zip(texts, counts.tolist(), gone, some.tolist(), strict=True):
                text = text or b""
                if touched:
                    lost = set(doc_gone.as_py())
                    own = text.split(b"\n")
                    stay = [line for line in own if next(digests) not in lost]
                    text = b"\n".join(stay)
                    dropped.append(n - len(stay))
                else:
                    dropped.append(0)
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [*(column_of(table, name) for name in ("id", "mark", *carried)), pa.array(counts, pa.int64()),
                 pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())],
                names=["id", "mark", *carried, "n_lines", "n_dropped", "kept", "kept_sha256"],
            )

    return run


def line_dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *,
    carry: Sequence[str] = (), min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
    shard_keys: int = SHARD_KEYS, salts: int = SALTS,
) -> DataFrame:
    """``key, mark``, the columns named by ``carry``, and ``n_lines, n_dropped, kept, kept_sha256``.

    One row per row of ``docs``.

    Lines end at ``\\n``. Lines whose key (see ``line_keys``) has at least ``min_chars``
    code points and occurs in at least ``min_docs`` documents are dropped, except in the
    document with the largest key that holds it.

    Null and empty texts are one empty line. Every row is a document; a null key counts
    as smaller than any other; rows that repeat the largest key all keep the line.
    ``mark`` tells apart rows that share a key but not a text. Other columns are not read;
    carried ones may have any name.
    """
    work = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(text).alias("mark"),
        F.col(text).alias("text"),
        *(F.col(name).alias(f"own_{name}") for name in carry),
    )
    own = [f"own_{name}" for name in carry]
    sent = work.select("id", "mark", "text").mapInArrow(_send(min_chars), "digest binary, id long, mark long")
    common = sent.groupBy("digest").agg(F.count("*").alias("n"), F.max("id").alias("last"))
    common = settle(common.where(F.col("n") >= min_docs), "common-lines")
    shards = max(LEAST_SHARDS, -(-common.count() // shard_keys))
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("long").alias("shard")
    arrays = common.select("*", shard).groupBy("shard").applyInArrow(_build, "shard long, arrays binary")
    arrays = settle(arrays, "line-shards")

    place = F.col("shard") * salts + F.col("salt")
    probes = sent.select("*", shard, F.pmod(F.xxhash64("id", "mark"), F.lit(salts)).alias("salt"))
    probes = probes.select(place.alias("place"), "digest", "id", "mark", F.lit(None).cast("binary").alias("arrays"))
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("digest", "binary"), ("id", "long"), ("mark", "long"))]
    spread = fan_out(arrays, "salt", salts).select(place.alias("place"), *none, "arrays")
    dealt = spread.unionByName(probes).repartition("place").sortWithinPartitions(
        "place", F.col("arrays").isNull()
    )
    lost = dealt.mapInArrow(_probe, "id long, mark long, digest binary")
    # A row repeated as a whole probes as often; its list then only repeats.
    lost = lost.groupBy("id", "mark").agg(F.collect_set("digest").alias("gone"))
    schema = widened(
        work.select("id", "mark", *own).schema, n_lines="long", n_dropped="long", kept="string", kept_sha256="string"
    )
    done = work.join(lost, ["id", "mark"], "left").mapInArrow(_drop(min_chars, own), schema)
    return done.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias(key),
        "mark",
        *(F.col(f"own_{name}").alias(name) for name in carry),
        "n_lines", "n_dropped", "kept", "kept_sha256",
    )


def without_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with their lines dropped, all other columns as they were."""
    others = [name for name in docs.columns if name not in (key, text)]
    done = line_dedup(docs, key, text, carry=others, **options)
    # By place, since carried columns may have the names of new ones.
    own = [f"own_{k}" for k in range(len(others))]
    done = done.toDF("key", "mark", *own, "n_lines", "n_dropped", "text", "sha256")
    place = dict(zip(others, own, strict=True)) | {key: "key", text: "text"}
    return done.select(*(F.col(place[name]).alias(name) for name in docs.columns))
