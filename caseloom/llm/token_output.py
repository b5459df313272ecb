"""Packed token matrices: best-fit decreasing, and what a trainer needs beside the ids.

One narrow stage reads, encodes and packs. A task packs the pieces of its own documents
in pools of some million tokens; sequences that a pool leaves badly filled are opened
again in the next one, so a task ends with about one sequence that is not full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.packing import pack_best_fit
from caseloom.llm.tokens import encoder, pieces_of
from caseloom.llm.words import chunks, column_of

POOL_TOKENS = 4 << 20
#: Sequences filled to this share are done; others wait for one more pool.
WELL_FILLED = 0.98
NO_ID = -(1 << 63)

SCHEMA = (
    "sequence_id long, n_tokens int, doc_ids array<long>, pieces array<int>, starts array<long>, "
    "cu_seqlens array<int>, ids binary, position_ids binary"
)


@dataclass(frozen=True)
class Layout:
    """``end_id`` follows every document; ``pad_id`` fills what is left of a row."""

    capacity: int = 4096
    end_id: int = 49407
    pad_id: int = 49407


@dataclass
class _Piece:
    doc: int
    number: int
    start: int
    ids: np.ndarray
    waited: bool = False


def _rows(sequences: list[list[_Piece]], first_id: int, layout: Layout) -> pa.RecordBatch:
    """One row of the matrix for each sequence; ids and positions little-endian."""
    ids = np.full((len(sequences), layout.capacity), layout.pad_id, "<u2")
    positions = np.zeros((len(sequences), layout.capacity), "<u2")
    columns = {name: [] for name in ("doc_ids", "pieces", "starts", "cu_seqlens")}
    for row, sequence in enumerate(sequences):
        at, ends = 0, [0]
        for piece in sequence:
            n = len(piece.ids)
            ids[row, at : at + n] = piece.ids
            positions[row, at : at + n] = np.arange(n)
            at += n
            ends.append(at)
        columns["doc_ids"].append([None if p.doc == NO_ID else p.doc for p in sequence])
        columns["pieces"].append([p.number for p in sequence])
        columns["starts"].append([p.start for p in sequence])
        columns["cu_seqlens"].append(ends)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(range(first_id, first_id + len(sequences)), pa.int64()),
            pa.array([e[-1] for e in columns["cu_seqlens"]], pa.int32()),
            pa.array(columns["doc_ids"], pa.list_(pa.int64())),
            pa.array(columns["pieces"], pa.list_(pa.int32())),
            pa.array(columns["starts"], pa.list_(pa.int64())),
            pa.array(columns["cu_seqlens"], pa.list_(pa.int32())),
            pa.array([row.tobytes() for row in ids], pa.binary()),
            pa.array([row.tobytes() for row in positions], pa.binary()),
        ],
        names=[part.split()[0] for part in SCHEMA.split(", ")],
    )


def _pack(path: str, layout: Layout):
    def emit(pool: list[_Piece], first_id: int, last: bool) -> tuple[list[_Piece], Iterator[pa.RecordBatch], int]:
        done, wait = [], []
        for numbers in pack_best_fit([len(p.ids) for p in pool], layout.capacity):
            sequence = [pool[k] for k in numbers]
            filled = sum(len(p.ids) for p in sequence)
            if last or filled >= WELL_FILLED * layout.capacity or any(p.waited for p in sequence):
                done.append(sequence)
            else:
                wait += sequence
        for piece in wait:
            piece.waited = True
        rows = (_rows(done[k : k + 256], first_id + k, layout) for k in range(0, len(done), 256))
        return wait, rows, first_id + len(done)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = TaskContext.get().partitionId() << 40
        pool, size = [], 0
        for table in chunks(batches, "text"):
            flat, first = encoder(path).encode_ended(column_of(table, "text"), layout.end_id)
            for doc, a, b in zip(column_of(table, "id").to_pylist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                for number, (start, n) in enumerate(pieces_of(b - a, layout.capacity)):
                    pool.append(_Piece(doc, number, start, flat[a + start : a + start + n]))
                    size += n
            if size > POOL_TOKENS:
                pool, rows, next_id = emit(pool, next_id, last=False)
                size = sum(len(p.ids) for p in pool)
                yield from rows
        yield from emit(pool, next_id, last=True)[1]

    return run


def packed_sequences(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", layout: Layout = Layout()
) -> DataFrame:
    """The packed sequences of all documents.

    ``ids`` and ``position_ids`` are rows of ``capacity`` 16-bit little-endian numbers;
    positions start again at 0 with every piece. ``cu_seqlens`` has 0 and the end of
    each piece. ``doc_ids``, ``pieces`` and ``starts`` say what each piece is: piece
    ``n`` of its document, whose ids before it are ``start`` many. Documents longer than
    a row are cut and nothing is lost. Vocabularies have at most 65,536 ids.

    Null and empty texts are a lone end id. Keys may be null or repeat. Other columns
    are not read.
    """
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(_pack(vocabulary, layout), SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the matrix as Parquet parts, one sequence a row."""
    packed.write.mode("overwrite").parquet(path)


def unpack(packed: DataFrame) -> DataFrame:
    """``doc_id, piece, start, length, sequence_id, offset``, one row per piece."""
    each = packed.select("sequence_id", "cu_seqlens", F.posexplode(F.arrays_zip("doc_ids", "pieces", "starts")))
    begin, end = F.element_at("cu_seqlens", F.col("pos") + 1), F.element_at("cu_seqlens", F.col("pos") + 2)
    return each.select(
        F.col("col.doc_ids").alias("doc_id"), F.col("col.pieces").alias("piece"), F.col("col.starts").alias("start"),
        (end - begin).alias("length"), "sequence_id", begin.alias("offset"),
    )
