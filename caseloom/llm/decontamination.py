"""Benchmark decontamination by spaced seeds.

A mask selects some of the tokens at a position and ignores the others, so a substituted
word at an ignored place does not hide a match. Hashes of the selected tokens are taken
at every position of every document and looked up among those of the benchmark; around
each hit the tokens are compared one by one.

A document overlaps an item when, without gaps, ``WINDOW`` tokens in a row (all of a
shorter item) lie over as many of the item and at least 80 % of them agree. The masks
hit every such overlap of 14 tokens or more, wherever the substitutions are; a test tries
all of them. Shorter items are found by triples, those under six tokens only whole.

The benchmark is read in blocks of a bounded size, each compared with all documents, so
nothing that grows is broadcast; documents are neither shuffled nor cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.words import Tokens, chunks, column_of, mixed

WINDOW = 20
#: One substitution is tolerated for so many tokens.
PER_SUBSTITUTION = 5
#: The selected positions of each mask.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 2, 4, 5, 6), (0, 1, 3, 4, 7, 8), (0, 1, 3, 5, 7, 8))
SHORT_MASK, SHORT, WHOLE = (0, 1, 2), 14, 6
#: Benchmark text that travels to tasks at once.
BLOCK_BYTES = 4 << 20
FILTER_BITS = 20
NO_ID = -(1 << 63)

SCHEMA = "id long, item_id long, doc_start long, item_start long, n_tokens long, n_equal long"


def substitutions(n_tokens: int) -> int:
    """How many of ``n_tokens`` aligned tokens may differ."""
    return n_tokens // PER_SUBSTITUTION if n_tokens >= WHOLE else 0


def masked(hashes: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """The hash of the selected tokens at each position that leaves room for the mask."""
    n = max(0, len(hashes) - mask[-1])
    out = np.full(n, len(mask) * 131 + mask[-1], np.uint64)
    for place in mask:
        out = mixed(out + hashes[place : place + n])
    return out


def _masks_for(n_tokens: int) -> tuple[tuple[int, ...], ...]:
    if n_tokens >= SHORT:
        return MASKS
    return (SHORT_MASK,) if n_tokens >= WHOLE else (tuple(range(n_tokens)),)


@dataclass
class Block:
    """Some benchmark items: their tokens, and for each mask the sorted seeds with item and position."""

    item_ids: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    seeds: dict[tuple[int, ...], tuple[np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, item_ids: list[int], texts: list[str | None]) -> Block:
        tokens = Tokens(pa.array(texts, pa.string()))
        found: dict[tuple[int, ...], list[tuple[np.ndarray, int]]] = {}
        for item, (a, b) in enumerate(zip(tokens.first[:-1], tokens.first[1:], strict=True)):
            for mask in _masks_for(b - a) if b > a else ():
                found.setdefault(mask, []).append((masked(tokens.hashes[a:b], mask), item))
        seeds = {}
        for mask, parts in found.items():
            values = np.concatenate([v for v, _ in parts])
            items = np.repeat([item for _, item in parts], [len(v) for v, _ in parts])
            places = np.concatenate([np.arange(len(v)) for v, _ in parts])
            order = np.argsort(values, kind="stable")
            seeds[mask] = values[order], items[order], places[order]
        return cls(np.array(item_ids, np.int64), tokens.hashes, tokens.first, seeds)


def _hits(tokens: Tokens, block: Block) -> np.ndarray:
    """Distinct rows of text, item and shift (place in the text less place in the item)."""
    room, low = tokens.room(), np.uint64((1 << FILTER_BITS) - 1)
    found = [np.zeros((0, 3), np.int64)]
    for mask, (values, items, places) in block.seeds.items():
        if len(tokens) <= mask[-1]:
            continue
        here = masked(tokens.hashes, mask)
        table = np.zeros(1 << FILTER_BITS, bool)
        table[(values & low).astype(np.int64)] = True
        maybe = np.flatnonzero(table[(here & low).astype(np.int64)])
        maybe = maybe[room[maybe] > mask[-1]]
        left, right = np.searchsorted(values, here[maybe]), np.searchsorted(values, here[maybe], side="right")
        counts = right - left
        at = np.repeat(maybe, counts)
        seed = np.arange(len(at)) + np.repeat(left - (np.cumsum(counts) - counts), counts)
        text = tokens.of_text[at]
        rows = np.stack([text, items[seed], at - tokens.first[text] - places[seed]], axis=1)
        found.append(np.unique(rows, axis=0))
    return np.unique(np.concatenate(found), axis=0)


def best_window(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int, int] | None:
    """Start in document and item, tokens and equal tokens of the best overlap on a diagonal."""
    length = min(WINDOW, len(item))
    a, b = max(0, shift), min(len(doc), shift + len(item))
    if b - a < length:
        return None
    sums = np.append(0, np.cumsum(doc[a:b] == item[a - shift : b - shift]))
    equal = sums[length:] - sums[:-length]
    at = int(np.argmax(equal))
    if equal[at] < length - substitutions(length):
        return None
    return a + at, a + at - shift, length, int(equal[at])


def _search(block: Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "text"):
            tokens = Tokens(column_of(table, "text"))
            ids = column_of(table, "id")
            best: dict[tuple[int, int], tuple[int, ...]] = {}
            for text, item, shift in _hits(tokens, block).tolist():
                found = best_window(
                    tokens.hashes[tokens.first[text] : tokens.first[text + 1]],
                    block.hashes[block.first[item] : block.first[item + 1]],
                    shift,
                )
                old = best.get((text, item))
                if found and (old is None or found[3] > old[3]):
                    best[text, item] = found
            rows = [(text, int(block.item_ids[item]), *found) for (text, item), found in best.items()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(columns[0], pa.int64())), *(pa.array(c, pa.int64()) for c in columns[1:])],
                names=["id", "item_id", "doc_start", "item_start", "n_tokens", "n_equal"],
            )

    return run


def overlaps(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``key, item_id, doc_start, item_start, n_tokens, n_equal``: the best overlap of each document and item.

    Starts count tokens (see ``words.Tokens``), and the first of equally good overlaps is
    given. Documents without an overlap have no row. Null and empty texts, of items
    too, overlap nothing; null keys are given as null; repeated rows are reported each.
    An empty benchmark gives an empty result. Other columns are not read.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_key).cast("long"), F.lit(NO_ID)).alias("item"), F.col(item_text).alias("text")
    )
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // block_bytes))
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text"))
    found = None
    for number in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number)
        own = sorted((row["item"], row["text"] or "") for row in own.collect())
        block = Block.of([item for item, _ in own], [text for _, text in own])
        part = rows.mapInArrow(_search(block), SCHEMA)
        found = part if found is None else found.unionByName(part)

    def shown(name: str):
        return F.when(F.col(name) != NO_ID, F.col(name))

    return found.select(
        shown("id").alias(key), shown("item_id").alias("item_id"), "doc_start", "item_start", "n_tokens", "n_equal"
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that overlap no item, all columns. Rows of one key go or stay together."""
    found = overlaps(docs, benchmark, key, text).select(F.col(key).alias("_found")).distinct()
    return docs.join(found, docs[key].eqNullSafe(found["_found"]), "left_anti")
