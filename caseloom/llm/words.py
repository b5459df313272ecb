"""Words of many texts at once, as numpy arrays, for use inside tasks.

A word is a run of characters other than ASCII white space. Within a ``Words`` object
equal words have equal ``ids`` exactly; ``hashes`` agree everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in chunks of about so many bytes; every row counts as so many besides.
CHUNK_BYTES, ROW_BYTES = 4 << 20, 64

# Odd multipliers of the polynomial hashes and of the final mixing.
BYTE_FACTOR = 0x9E3779B97F4A7C15
WORD_FACTOR = 0xD6E8FEB86659FD93
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number made to depend on all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(MIX_1)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(MIX_2)
    return x ^ (x >> np.uint64(31))


def powers(factor: int, n: int) -> np.ndarray:
    """``factor ** 0 .. n - 1`` modulo 2**64."""
    out = np.full(n, factor, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def running(values: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 of the first 0, 1, 2, ... values."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, dtype=np.uint64, out=out[1:])
    return out


def inverse(factor: int) -> int:
    return pow(factor, -1, 1 << 64)


def string_bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the offsets of its values in them."""
    strings = strings.cast(pa.large_string())
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[
        strings.offset : strings.offset + len(strings) + 1
    ]
    data = strings.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def hash_strings(strings: pa.Array) -> np.ndarray:
    """A 64-bit hash of each value of a string array without nulls."""
    data, offsets = string_bytes(strings)
    if not len(offsets) - 1:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(offsets) - 1, np.uint64)
    # In pieces, so that the eight bytes a byte needs here stay few.
    cuts = np.searchsorted(offsets, np.arange(0, offsets[-1] + CHUNK_BYTES, CHUNK_BYTES))
    cuts = np.unique(np.minimum(np.append(cuts, len(out)), len(out)))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        starts, stop = offsets[a:b] - offsets[a], offsets[b] - offsets[a]
        if not stop:
            continue
        piece = data[offsets[a] : offsets[b]].astype(np.uint64) + np.uint64(1)
        piece *= powers(BYTE_FACTOR, len(piece))
        sums = running(piece)
        ends = np.append(starts[1:], stop)
        out[a:b] = (sums[ends] - sums[starts]) * powers(inverse(BYTE_FACTOR), stop + 1)[starts]
    lengths = (offsets[1:] - offsets[:-1]).astype(np.uint64)
    return mixed(out + lengths * np.uint64(WORD_FACTOR))


class Words:
    """``first[d]`` to ``first[d + 1]`` are the words of text ``d``; null has none."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten()
        filled = np.asarray(pc.not_equal(pc.binary_length(words), 0))
        of_text = np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(lists)))
        if not filled.all():
            words, of_text = words.filter(pa.array(filled)), of_text[filled]
        self.first = np.searchsorted(of_text, np.arange(len(texts) + 1)).astype(np.int64)
        self.strings = words
        coded = words.dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        self.ids = np.asarray(coded.indices)
        self.dictionary = coded.dictionary
        self.distinct_hashes = hash_strings(self.dictionary)
        self.of_text = of_text

    def __len__(self) -> int:
        return len(self.ids)

    @property
    def hashes(self) -> np.ndarray:
        return self.distinct_hashes[self.ids]

    def counts(self) -> np.ndarray:
        return self.first[1:] - self.first[:-1]

    def starts_of(self, length: int) -> np.ndarray:
        """Where a run of ``length`` words of one text can begin."""
        room = np.repeat(self.first[1:], self.counts()) - np.arange(len(self))
        return np.flatnonzero(room >= length)

    def run_hashes(self, length: int) -> np.ndarray:
        """Hashes of the runs of ``length`` words that begin at each word, as far as there are any."""
        n = len(self)
        if n < length:
            return np.zeros(0, np.uint64)
        sums = running(self.hashes * powers(WORD_FACTOR, n))
        back = powers(inverse(WORD_FACTOR), n - length + 1)
        return mixed((sums[length:] - sums[:-length]) * back)

    def packed(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words, one space between neighbours, and where each begins and ends."""
        lengths = np.asarray(pc.binary_length(self.strings)).astype(np.int64)
        ends = np.cumsum(lengths + 1) - 1
        one = pa.LargeListArray.from_arrays(np.array([0, len(self)], np.int64), self.strings)
        return pc.binary_join(one, pa.scalar(" ", self.strings.type))[0].as_buffer().to_pybytes(), ends - lengths, ends


def chunks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES, row_bytes: int = ROW_BYTES
) -> Iterator[pa.Table]:
    """Rows of a task regrouped so that ``column`` holds about ``limit`` bytes in each table.

    Each row counts ``row_bytes`` more, so that very many empty or short texts are no larger
    a table than long ones; a caller that keeps more for a row names its own. A longer text
    makes a table of its own; rows are never cut.
    """
    kept: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64) + row_bytes
        at = 0
        while at < batch.num_rows:
            room = np.searchsorted(np.cumsum(lengths[at:]), limit - size, side="right")
            if not room and not kept:
                room = 1
            if room:
                kept.append(batch.slice(at, room))
                size += int(lengths[at : at + room].sum())
                at += room
            if at < batch.num_rows or size >= limit:
                yield pa.Table.from_batches(kept)
                kept, size = [], 0
    if kept:
        yield pa.Table.from_batches(kept)


def column_of(table: pa.Table, name: str) -> pa.Array:
    found = table.column(name).combine_chunks()
    return pa.concat_arrays(found.chunks) if isinstance(found, pa.ChunkedArray) else found


class Tokens:
    """Words without case and punctuation: letters and digits only, lower-cased.

    ``hashes`` holds one number per token, text after text; words without any letter or
    digit are left out. ``first[d]`` to ``first[d + 1]`` are the tokens of text ``d``.
    """

    def __init__(self, texts: pa.Array):
        words = Words(texts)
        plain = pc.utf8_lower(pc.replace_substring_regex(words.dictionary, r"[^\p{L}\p{N}]+", ""))
        filled = np.asarray(pc.binary_length(plain)).astype(np.int64)[words.ids] > 0
        self.hashes = hash_strings(plain)[words.ids][filled]
        self.of_text = words.of_text[filled]
        self.first = np.searchsorted(self.of_text, np.arange(len(texts) + 1)).astype(np.int64)

    def __len__(self) -> int:
        return len(self.hashes)

    def room(self) -> np.ndarray:
        """How many tokens of its text follow from each token on, itself included."""
        return np.repeat(self.first[1:], self.first[1:] - self.first[:-1]) - np.arange(len(self))
