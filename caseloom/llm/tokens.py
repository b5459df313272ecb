"""Token ids of whole texts with a public tokenizer file, for use inside tasks.

The vocabulary used here drops white space and never joins characters across it, so a
text's ids are the ids of its space-separated words one after the other. Each distinct
word of a chunk is encoded once, many of them in one call; the numbers of a chunk are
then gathered with numpy.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from caseloom.llm.words import Words, string_bytes

#: Words whose ids a task remembers; words encoded in one call.
CACHE, CALL = 500_000, 2000


def _gather(flat: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the named rows one after the other, and how many each has."""
    counts = offsets[rows + 1] - offsets[rows]
    stops = np.cumsum(counts)
    n = int(stops[-1]) if len(stops) else 0
    return flat[np.arange(n) + np.repeat(offsets[rows] - (stops - counts), counts)], counts


def stems(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words without the full stop or comma at their end, which the vocabulary always keeps apart.

    ASCII words are lower-cased, as the vocabulary does itself, so that fewer differ. The second
    value has what was taken off: 1 for a full stop, 2 for a comma, else 0. Other words stay as
    they are.
    """
    plain = pc.string_is_ascii(words)
    words = pc.if_else(plain, pc.ascii_lower(words), words)
    data, offsets = string_bytes(words)
    begin, end = offsets[:-1], offsets[1:]
    mark = np.zeros(len(words), np.int8)
    two = np.flatnonzero(np.asarray(plain) & (end - begin > 1))
    last, before = data[end[two] - 1], data[end[two] - 2]
    letter = (before >= 97) & (before <= 122)
    mark[two[letter & (last == ord("."))]] = 1
    mark[two[letter & (last == ord(","))]] = 2
    short = pc.utf8_slice_codeunits(words, 0, -1)
    return pc.if_else(pa.array(mark > 0), short, words), mark


class Encoder:
    """``encode`` turns an array of texts into all ids and where each text's ids begin."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        tokens = (self.tokenizer.id_to_token(k) or "" for k in range(size))
        self.lengths = np.fromiter((len(t.removesuffix("</w>")) for t in tokens), np.int64, size)
        self._forget()

    def _forget(self) -> None:
        """The empty word is row 0, the marks taken off words rows 1 and 2."""
        self.rows: dict[str, int] = {"": 0}
        self.flat, self.offsets = np.zeros(0, np.uint16), np.zeros(2, np.int64)
        self._learn([".", ","])

    def _counts(self, words: list[str], found, ids: np.ndarray) -> np.ndarray:
        """How many of ``ids`` each word has.

        A byte-level vocabulary has a letter per byte, so the ends of words are ends of tokens.
        Where a word was changed before it was encoded, tokens say themselves where they begin.
        """
        ends = np.cumsum([len(w) for w in words] if " ".join(words).isascii() else [len(w.encode()) for w in words])
        stops = np.cumsum(self.lengths[ids])
        at = np.searchsorted(stops, ends)
        if len(stops) and stops[-1] == ends[-1] and (stops[at] == ends).all():
            return np.diff(at + 1, prepend=0)
        ends = np.cumsum([len(w) + 1 for w in words])
        begin = np.fromiter((a for a, _ in found.offsets), np.int64, len(found))
        return np.bincount(np.searchsorted(ends, begin, side="right"), minlength=len(words))

    def _learn(self, words: list[str]) -> None:
        """Ids of new words; a token belongs to the word it begins in."""
        flat, counts = [self.flat], []
        for at in range(0, len(words), CALL):
            some = words[at : at + CALL]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids = np.array(found.ids, np.uint16)
            flat.append(ids)
            counts.append(self._counts(some, found, ids))
        if counts:
            stops = self.offsets[-1] + np.cumsum(np.concatenate(counts))
            self.flat, self.offsets = np.concatenate(flat), np.concatenate([self.offsets, stops])
            self.rows.update(zip(words, range(len(self.rows), len(self.rows) + len(words)), strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Null texts have no ids."""
        words = Words(texts)
        found, mark = stems(words.dictionary)
        coded = found.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        rows = np.fromiter((self.rows.get(w, -1) for w in distinct), np.int64, len(distinct))
        missing = np.flatnonzero(rows < 0)
        if len(self.rows) + len(missing) > CACHE:
            self._forget()
            rows = np.fromiter((self.rows.get(w, -1) for w in distinct), np.int64, len(distinct))
            missing = np.flatnonzero(rows < 0)
        rows[missing] = np.arange(len(self.rows), len(self.rows) + len(missing))
        self._learn([distinct[k] for k in missing.tolist()])
        both = np.empty(2 * len(mark), np.int64)
        both[::2], both[1::2] = rows[np.asarray(coded.indices)], mark
        flat, counts = _gather(self.flat, self.offsets, both)
        offsets = np.zeros(len(mark) + 1, np.int64)
        np.cumsum(counts[::2] + counts[1::2], out=offsets[1:])
        ids, counts = _gather(flat, offsets, words.ids)
        first = np.zeros(len(words) + 1, np.int64)
        np.cumsum(counts, out=first[1:])
        return ids, first[words.first]

    def encode_ended(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, with ``end_id`` after the ids of every text."""
        ids, first = self.encode(texts)
        return np.insert(ids, first[1:], np.uint16(end_id)), first + np.arange(len(first))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process, since loading the file takes a while."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """The place of a public vocabulary file, the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces_of(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces; only documents over ``capacity`` are cut."""
    return [(at, min(capacity, length - at)) for at in range(0, length, capacity)] or [(0, 0)]
