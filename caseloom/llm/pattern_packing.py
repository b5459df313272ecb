"""Best-fit packing of a whole corpus by patterns fitted to its length histogram.

Documents are encoded in one narrow stage that leaves a row of numbers per piece. Those
rows are dealt to groups of about ``GROUP_PIECES`` by a random ticket, so each group
has nearly the histogram of the corpus; each is packed on its own (see
``packing.pack_patterns``) and can cost at most part of a sequence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.packing import pack_patterns
from caseloom.llm.tokens import encoder, pieces_of
from caseloom.llm.words import chunks, column_of, mixed
from caseloom.storage import settle

CAPACITY, END_ID = 4096, 1
GROUP_PIECES = 40_000
NO_ID = -(1 << 63)

PIECES = "ticket long, id long, piece int, start long, length long, ids_crc32 long"
PLACED = "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _encode(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TaskContext.get().partitionId() << 40
        for table in chunks(batches, "text"):
            flat, first = encoder(path).encode_ended(column_of(table, "text"), end_id)
            data = flat.astype("<u4")
            rows: list[tuple[int, ...]] = []
            for doc, a, b in zip(column_of(table, "id").to_pylist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                for number, (start, n) in enumerate(pieces_of(b - a, capacity)):
                    rows.append((doc, number, start, n, zlib.crc32(data[a + start : a + start + n])))
            tickets = mixed(np.arange(counter, counter + len(rows), dtype=np.uint64)) >> np.uint64(1)
            counter += len(rows)
            columns = zip(*rows, strict=True) if rows else [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(tickets.astype(np.int64)), *arrays],
                names=["ticket", "id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def _place(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("ticket")
        lengths = np.asarray(column_of(table, "length"))
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for number, pieces in enumerate(pack_patterns(lengths, capacity)):
            ends = np.cumsum(lengths[pieces])
            sequence[pieces] = number
            offset[pieces] = ends - lengths[pieces]
        sequence += table.column("group")[0].as_py() << 32
        out = table.select(["id", "piece", "start", "length", "ids_crc32"])
        return out.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return run


def pack_documents(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", *,
    capacity: int = CAPACITY, end_id: int = END_ID, group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset``, one row per piece.

    A document is its token ids and ``end_id``. Documents over ``capacity`` ids are cut
    into pieces of ``capacity``; others are never cut. ``ids_crc32`` is taken over 32-bit
    little-endian ids. The pieces of a sequence lie one after the other from offset 0.

    Null and empty texts are a lone end id. Keys may be null or repeat. An empty table
    gives no rows. Other columns are not read.
    """
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text"))
    pieces = settle(rows.mapInArrow(_encode(vocabulary, capacity, end_id), PIECES), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("group", F.pmod("ticket", F.lit(groups)).cast("long"))
    placed = dealt.groupBy("group").applyInArrow(_place(capacity), PLACED)
    return placed.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias(key),
        "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
    )
