"""Substring deduplication by super-k-mers.

A window is ``window`` consecutive words. Its minimiser is the run of ``MINIMISER``
words inside it that comes first in a fixed order; neighbouring windows mostly share
it, and such neighbours travel as one packed string (a super-k-mer) to the bucket of
their minimiser. Equal windows have equal minimisers, so each bucket can sort its
windows and tell, for every window, the smallest document in which it starts.

What keeps buckets even:

* Runs of words that are frequent in the corpus come last in the order. A window that
  only touches a passage found everywhere is then led by its own words; only windows
  wholly inside such a passage meet in that passage's bucket.
* A task compares its own documents first. A window that a smaller document of the task
  holds is settled there and does not travel, so a group of copies sends one window for
  each chunk of a task, however large it is.
* A bucket that still outgrows memory is worked on in portions; only the first holders
  of its windows are carried from one portion to the next.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.words import CHUNK_BYTES, Words, chunks, column_of, mixed

WINDOW = 50
MINIMISER = 8
#: Packed text that one bucket is meant to hold, and the most it works on at once.
BUCKET_BYTES, PORTION_BYTES = 10 << 20, 16 << 20
#: A run of words is frequent from this share of all runs on, so few of them exist.
FREQUENT_SHARE = 2e-5
NO_ID = -(1 << 63)
SMALL_BLOB = 2048

COUNT_SCHEMA = "run long, n long"
TRAVEL_SCHEMA = "bucket long, id long, mark long, start long, stop long, packed binary"
RANGE_SCHEMA = "id long, mark long, start long, stop long"


# -- frequent runs ---------------------------------------------------------------------


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Locally frequent runs with their counts; under a null run, the words seen."""
    for table in chunks(batches, "text"):
        words = Words(column_of(table, "text"))
        runs = words.run_hashes(MINIMISER)[words.starts_of(MINIMISER)]
        found, n = np.unique(runs, return_counts=True)
        often = n >= max(4, len(words) * FREQUENT_SHARE)
        keys = pa.array(found[often].view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([keys, pa.nulls(1, pa.int64())]),
             pa.array(np.append(n[often], len(words)).astype(np.int64))],
            names=["run", "n"],
        )


def frequent_runs(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Sorted hashes of the frequent runs, and the number of words.

    At most ``1 / FREQUENT_SHARE`` runs can be frequent, whatever the size of the corpus.
    They only shape the order of minimisers, never the result.
    """
    counts = docs.select("text").mapInArrow(_count_runs, COUNT_SCHEMA).groupBy("run").agg(
        F.sum("n").alias("n")
    )
    total = counts.where("run is null").select("n").first()
    n_words = total["n"] if total else 0
    least = max(4, int(n_words * FREQUENT_SHARE))
    rows = counts.where((F.col("n") >= least) & F.col("run").isNotNull()).select("run").collect()
    return np.sort(np.array([row["run"] for row in rows], np.int64).view(np.uint64)), n_words


# -- windows ---------------------------------------------------------------------------


def _members(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are among a sorted list; a table of bits answers most at once."""
    hit = np.zeros(len(values), bool)
    if len(among):
        table = np.zeros(1 << 20, bool)
        low = np.uint64((1 << 20) - 1)
        table[(among & low).astype(np.int64)] = True
        maybe = np.flatnonzero(table[(values & low).astype(np.int64)])
        at = np.minimum(np.searchsorted(among, values[maybe]), len(among) - 1)
        hit[maybe] = among[at] == values[maybe]
    return hit


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours, by doubling."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _leaders(words: Words, window: int, frequent: np.ndarray) -> np.ndarray:
    """The minimiser of the window that begins at each word, as far as there are windows."""
    length = min(MINIMISER, window)
    runs = words.run_hashes(length)
    order = (mixed(runs) >> np.uint64(1)) | (_members(runs, frequent).astype(np.uint64) << np.uint64(63))
    return _sliding_min(order, window - length + 1)


def first_holders(words: Words, owner: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows, and for each whether a smaller owner holds the same words.

    ``owner[d]`` is the id of text ``d``; texts must come sorted by it. Windows are
    sorted by hash; equal hashes are compared word by word, and those that differ from
    the first of their hash are sorted out among themselves.
    """
    starts = words.starts_of(window)
    later = np.zeros(len(starts), bool)
    if not len(starts):
        return starts, later
    hashes = words.run_hashes(window)[starts]
    owners = owner[words.of_text[starts]]
    left = np.argsort(hashes, kind="stable")
    while len(left):
        sorted_hashes = hashes[left]
        new = np.append(True, sorted_hashes[1:] != sorted_hashes[:-1])
        lead = left[np.flatnonzero(new)][np.cumsum(new) - 1]
        follows = np.flatnonzero(~new)
        mine, other = starts[left[follows]], starts[lead[follows]]
        same = np.ones(len(follows), bool)
        for k in range(window):
            same &= words.ids[mine + k] == words.ids[other + k]
        equal = follows[same]
        later[left[equal]] = owners[left[equal]] > owners[lead[equal]]
        left = left[follows[~same]]
    return starts, later


def _runs(flags_change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run, given where a new one begins."""
    begin = np.flatnonzero(flags_change)
    return begin, np.append(begin[1:], len(flags_change)) - 1


def _ranges(words, starts, chosen, window, offset):
    """Text index, first and past-last word of each unbroken row of chosen windows."""
    at = starts[chosen]
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none
    text = words.of_text[at]
    new = np.append(True, (np.diff(at) != 1) | (np.diff(text) != 0))
    begin, end = _runs(new)
    text = text[begin]
    local = offset[text] - words.first[text]
    return text, at[begin] + local, at[end] + window + local


# -- travelling ------------------------------------------------------------------------


def _pack(ids, marks, starts, strings: list[bytes]) -> bytes:
    head = struct.pack("<q", len(strings))
    body = head + b"".join(x.astype("<i8").tobytes() for x in (ids, marks, starts))
    body += b"\n".join(strings)
    return b"z" + zstandard.ZstdCompressor(level=1).compress(body) if len(body) > SMALL_BLOB else b"r" + body


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    body = zstandard.ZstdDecompressor().decompress(blob[1:]) if blob[:1] == b"z" else blob[1:]
    n = struct.unpack_from("<q", body)[0]
    ids, marks, starts = np.frombuffer(body, "<i8", 3 * n, 8).reshape(3, n)
    return ids, marks, starts, body[8 + 24 * n :].split(b"\n")


def _travel_batch(bucket, ids, marks, starts, stops, packed) -> pa.RecordBatch:
    columns = [bucket, ids, marks, starts, stops]
    arrays = [x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in columns]
    return pa.RecordBatch.from_arrays(
        [*arrays, pa.array(packed, pa.binary()) if isinstance(packed, list) else packed],
        names=["bucket", "id", "mark", "start", "stop", "packed"],
    )


def _send(window: int, buckets: int, frequent: np.ndarray):
    """A task's documents to packed super-k-mers, and ranges settled in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "text"):
            table = table.sort_by("id")
            words = Words(column_of(table, "text"))
            if len(words) < window:
                continue
            ids = np.asarray(column_of(table, "id"))
            marks = np.asarray(column_of(table, "mark"))
            starts, later = first_holders(words, ids, window)
            text, a, b = _ranges(words, starts, later, window, np.zeros(len(ids), np.int64))
            if len(text):
                none = pa.nulls(len(text), pa.binary())
                yield _travel_batch(np.abs(ids[text]) % buckets, ids[text], marks[text], a, b, none)

            starts = starts[~later]
            if not len(starts):
                continue
            lead = _leaders(words, window, frequent)[starts]
            text = words.of_text[starts]
            new = np.append(True, (np.diff(starts) != 1) | (np.diff(text) != 0) | (lead[1:] != lead[:-1]))
            begin, end = _runs(new)
            bucket = (mixed(lead[begin]) % np.uint64(buckets)).astype(np.int64)
            by_bucket = np.argsort(bucket, kind="stable")
            begin, end, bucket = begin[by_bucket], end[by_bucket], bucket[by_bucket]
            joined, word_at, word_end = words.packed()
            cut = list(zip(word_at[starts[begin]].tolist(), word_end[starts[end] + window - 1].tolist(), strict=True))
            of = text[begin]
            local = starts[begin] - words.first[of]
            edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
            names, blobs, size = [], [], 0
            for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                strings = [joined[p:q] for p, q in cut[x:y]]
                names.append(int(bucket[x]))
                blobs.append(_pack(ids[of[x:y]], marks[of[x:y]], local[x:y], strings))
                size += len(blobs[-1])
                if size > CHUNK_BYTES or y == edges[-1]:
                    none = pa.nulls(len(names), pa.int64())
                    yield _travel_batch(names, none, none, none, none, blobs)
                    names, blobs, size = [], [], 0

    return run


class _Bucket:
    """The super-k-mers of one bucket; ``compare`` settles what is there so far."""

    def __init__(self, window: int):
        self.window, self.held, self.size = window, [], 0

    def add(self, blob: bytes) -> None:
        self.held.append(_unpack(blob))
        self.size += sum(map(len, self.held[-1][3])) + 24 * len(self.held[-1][3])

    def compare(self, last: bool) -> Iterator[pa.RecordBatch]:
        """Ranges that lost; unless ``last``, the first holders stay for the next portion."""
        if not self.held:
            return
        ids, marks, starts = (np.concatenate([x[k] for x in self.held]) for k in range(3))
        strings = [s for x in self.held for s in x[3]]
        self.held, self.size = [], 0
        order = np.argsort(ids, kind="stable")
        ids, marks, offset = ids[order], marks[order], starts[order]
        strings = pa.array([strings[k] for k in order.tolist()], pa.large_binary())
        words = Words(strings.cast(pa.large_string()))
        del strings
        at, later = first_holders(words, ids, self.window)
        text, a, b = _ranges(words, at, later, self.window, offset)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (ids[text], marks[text], a, b)],
            names=["id", "mark", "start", "stop"],
        )
        if not last:
            text, a, b = _ranges(words, at, ~later, self.window, offset)
            joined, word_at, word_end = words.packed()
            shift = words.first[text] - offset[text]
            cut = zip(word_at[a + shift].tolist(), word_end[b + shift - 1].tolist(), strict=True)
            kept = [joined[p:q] for p, q in cut]
            self.held = [(ids[text], marks[text], a, kept)]
            self.size = sum(map(len, kept)) + 24 * len(kept)


def _receive(window: int, portion: int):
    """Buckets one after the other; their rows arrive sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, at, limit = _Bucket(window), None, portion
        for batch in batches:
            packed = batch.column("packed")
            settled = batch.filter(packed.is_null()).select(["id", "mark", "start", "stop"])
            if settled.num_rows:
                yield settled
            for name, blob in zip(batch.column("bucket"), packed, strict=True):
                if not blob.is_valid:
                    continue
                if name.as_py() != at:
                    yield from bucket.compare(last=True)
                    bucket, at, limit = _Bucket(window), name.as_py(), portion
                bucket.add(blob.as_py())
                if bucket.size > limit:
                    yield from bucket.compare(last=False)
                    limit = portion + bucket.size
        yield from bucket.compare(last=True)

    return run


# -- the operator ----------------------------------------------------------------------


def _work(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, mark, text``: a null key is smaller than any other; rows of one key are told apart by text."""
    return docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(text).alias("mark"),
        F.col(text).alias("text"),
    )


def repeated_ranges(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *,
    window: int = WINDOW, bucket_bytes: int = BUCKET_BYTES, portion_bytes: int = PORTION_BYTES,
) -> DataFrame:
    """``id, mark, start, stop``: words ``start`` to ``stop - 1`` lie in windows of smaller documents.

    Ranges of one document may overlap. Documents shorter than a window have none.
    """
    work = _work(docs, key, text)
    frequent, n_words = frequent_runs(work)
    # A word is about six bytes, and a packed string repeats its neighbours' words.
    buckets = max(int(n_words * 6 * 3 // bucket_bytes) + 1, 1)
    sent = work.mapInArrow(_send(window, buckets, frequent), TRAVEL_SCHEMA)
    dealt = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_receive(window, portion_bytes), RANGE_SCHEMA)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and their ranges to what is left of them."""
    for table in chunks(batches, "text"):
        words = Words(column_of(table, "text"))
        joined, word_at, word_end = words.packed() if len(words) else (b"", np.zeros(0), np.zeros(0))
        gone = np.zeros(len(words) + 1, np.int64)
        lists = column_of(table, "ranges")
        text = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0)))
        flat = lists.flatten()
        a, b = (np.asarray(flat.field(k)) + words.first[text] for k in (0, 1))
        np.add.at(gone, a, 1)
        np.add.at(gone, b, -1)
        gone = np.cumsum(gone)[:-1] > 0
        removed = np.append(0, np.cumsum(gone))
        kept, n_removed = [], removed[words.first[1:]] - removed[words.first[:-1]]
        for d, (x, y) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
            if x == y:
                kept.append(b"")
                continue
            if not n_removed[d]:
                kept.append(joined[word_at[x] : word_end[y - 1]])
                continue
            stays = np.flatnonzero(~gone[x:y]) + x
            if not len(stays):
                kept.append(b"")
                continue
            begin, end = _runs(np.append(True, np.diff(stays) != 1))
            kept.append(b" ".join(joined[word_at[stays[p]] : word_end[stays[q]]] for p, q in zip(begin, end, strict=True)))
        yield pa.RecordBatch.from_arrays(
            [column_of(table, "id"), pa.array(words.counts(), pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string()),
             pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())],
            names=["id", "n_words", "n_removed", "kept", "kept_sha256"],
        )


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``key, n_words, n_removed, kept, kept_sha256``, one row per row of ``docs``.

    Every word covered by a window that also starts in a document with a smaller key is
    removed; windows are judged on the input. ``kept`` joins the other words by one space.

    Null and empty texts have no words. A null key counts as the smallest one; rows that
    repeat a key don't hold windows against each other. Other columns are not read.
    """
    ranges = repeated_ranges(docs, key, text, **options)
    ranges = ranges.groupBy("id", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    joined = _work(docs, key, text).join(ranges, ["id", "mark"], "left").select("id", "text", "ranges")
    done = joined.mapInArrow(
        _cut, "id long, n_words long, n_removed long, kept string, kept_sha256 string"
    )
    return done.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias(key), "n_words", "n_removed", "kept", "kept_sha256"
    )
