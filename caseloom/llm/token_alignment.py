"""Which tokens of two tokenizers cover the same bytes, and how often over the corpus.

Tokens of both sides lie on the bytes of space and text. In each batch ``pandas.merge_asof``,
keyed by document, finds for each token start the token of the other side that covers it;
both directions together are all overlaps, and overlaps of equal ends close a group. Two
tokens are linked where their groups are the same.

Neither vocabulary joins a character with a space or newline after it, so the tokens of a text
are those of its words one after the other, each word with the blanks before it. Distinct words
are encoded once, many in one call, and every word's tokens are compared with its bytes. Where a
character before a blank could be a blank itself, words are not parted.

The documents' linked id pairs are written with how often each has them. Their counts over
the corpus are summed by Spark, in tasks first. Up to ``SHIPPED_PAIRS`` distinct pairs, their
counts are sent to all tasks; beyond that the written pairs are joined with them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.llm.words import chunks, column_of, string_bytes
from caseloom.storage import settle

#: Bytes of words aligned at once; a longer text goes on in the next run.
RUN_BYTES = 1 << 20
#: Words a task remembers, and the longest of them in characters; characters encoded in one call.
KNOWN_WORDS, WORD_CHARS, CALL_CHARS = 200_000, 64, 20_000
#: Distinct pairs whose counts are sent to tasks, at 17 bytes each.
SHIPPED_PAIRS = 2_000_000
#: Links of one group that are written out before they are counted; larger groups count ids first.
GROUP_LINKS = 4096
#: Distinct pairs a task holds before it hands their counts on.
HELD_PAIRS = 1_000_000

ALIGNED = (
    "id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<long>"
)


# -- the two tokenizers ------------------------------------------------------------------


class ByteSide:
    """A byte-level vocabulary file; special tokens inside texts are ordinary text."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        size = self.tokenizer.get_vocab_size()
        letters = _byte_letters()
        self.pieces = [self._bytes(self.tokenizer.id_to_token(k), letters) for k in range(size)]

    @staticmethod
    def _bytes(token: str | None, letters: dict[str, int]) -> bytes:
        if token is None or not all(c in letters for c in token):
            return b""
        return bytes(letters[c] for c in token)

    def encode(self, spaced: str) -> list[int]:
        return self.tokenizer.encode(spaced, add_special_tokens=False).ids

    encode_word = encode


def _byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary shows each byte: visible ones as they are."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class PieceSide:
    """A sentence-piece model; it adds the space in front of a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [self._bytes(k) for k in range(self.model.get_piece_size())]

    def _bytes(self, k: int) -> bytes:
        piece = self.model.id_to_piece(k)
        if self.model.is_byte(k):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, spaced: str) -> list[int]:
        return self.model.encode(spaced[1:], num_threads=1)

    def encode_word(self, word: str) -> list[int]:
        """Before a newline, which no piece joins, the space added is a token of its own."""
        if word == " ":
            return [self.model.piece_to_id("▁")]
        return self.encode(word) if word[0] == " " else self.encode(" " + word)[1:]


def parts_nowhere(side) -> bool:
    """Whether ``word_starts`` would not part any piece of the vocabulary."""
    return not any(len(word_starts(np.frombuffer(piece, np.uint8))) > 1 for piece in side.pieces)


class Pair:
    """Ids of words on both sides, remembered by word.

    ``flat`` and ``offsets`` of each side hold the ids of the known words one after the
    other; a word that either side does not give back byte for byte is not ``right``.
    """

    def __init__(self, path_a: str, path_b: str):
        self.sides = (ByteSide(path_a), PieceSide(path_b))
        self.lengths = tuple(np.array([len(p) for p in side.pieces], np.int64) for side in self.sides)
        self.sizes = tuple(len(side.pieces) for side in self.sides)
        self.splits = all(parts_nowhere(side) for side in self.sides)
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.flat = [np.zeros(0, np.int32) for _ in self.sides]
        self.offsets = [np.zeros(1, np.int64) for _ in self.sides]
        self.right = np.zeros(0, bool)
        #: Whether a long word is among them; then all are forgotten before the next run.
        self.long = False

    def _alone(self, word: str) -> tuple[list[list[int]], bool]:
        """``word`` begins with a space or newline."""
        data, found, right = word.encode(), [], True
        for side in self.sides:
            ids = side.encode_word(word)
            right &= b"".join(side.pieces[k] for k in ids) == data
            found.append(ids)
        return found, right

    def _together(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Ids and where each word's end, for words that all end in a visible character."""
        text = " a" + "".join(words)
        data, ends = text.encode(), np.cumsum([2, *(len(w.encode()) for w in words)])
        found = []
        for side, lengths in zip(self.sides, self.lengths, strict=True):
            ids = side.encode(text)
            if b"".join([side.pieces[k] for k in ids]) != data:
                return None
            ids = np.array(ids, np.int32)
            stops = np.cumsum(lengths[ids])
            at = np.searchsorted(stops, ends)
            if not (stops[at] == ends).all():
                return None
            found.append((ids[at[0] + 1 :], at[1:] - at[0]))
        return found

    def _learn(self, words: list[str]) -> None:
        flat, counts, right = [[f] for f in self.flat], [[], []], [self.right]
        joined, single = [], []
        for word in words:
            (joined if len(word) <= CALL_CHARS and _visible(word[-1]) else single).append(word)
        call, room = [], CALL_CHARS
        calls = []
        for word in joined:
            if call and room < len(word):
                calls.append(call)
                call, room = [], CALL_CHARS
            call.append(word)
            room -= len(word)
        if call:
            calls.append(call)
        order: list[str] = []
        for call in calls:
            found = self._together(call)
            if found is None:
                single += call
                continue
            order += call
            right.append(np.ones(len(call), bool))
            for k, (ids, stops) in enumerate(found):
                flat[k].append(ids)
                counts[k].append(np.diff(stops, prepend=0))
        for word in single:
            ids, good = self._alone(word)
            order.append(word)
            right.append(np.array([good]))
            for k in (0, 1):
                flat[k].append(np.array(ids[k], np.int32))
                counts[k].append(np.array([len(ids[k])]))
        self.rows.update(zip(order, range(len(self.rows), len(self.rows) + len(order)), strict=True))
        self.right = np.concatenate(right)
        for k in (0, 1):
            self.flat[k] = np.concatenate(flat[k])
            stops = self.offsets[k][-1] + np.cumsum(np.concatenate(counts[k])) if counts[k] else []
            self.offsets[k] = np.concatenate([self.offsets[k], stops]).astype(np.int64)

    def rows_of(self, words: list[str]) -> np.ndarray:
        missing = [w for w in words if w not in self.rows]
        if self.long or len(self.rows) + len(missing) > KNOWN_WORDS:
            self._forget()
            missing = words
        self.long = any(len(w) > WORD_CHARS for w in missing)
        if missing:
            self._learn(missing)
        return np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))

    def gather(self, side: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the named words one after the other, and how many each has."""
        flat, offsets = self.flat[side], self.offsets[side]
        counts = offsets[rows + 1] - offsets[rows]
        stops = np.cumsum(counts)
        n = int(stops[-1]) if len(stops) else 0
        return flat[np.arange(n) + np.repeat(offsets[rows] - (stops - counts), counts)], counts


def _visible(char: str) -> bool:
    return "!" <= char <= "~" or (char > "\x7f" and not char.isspace() and char != "▁")


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair_of(path_a: str, path_b: str) -> Pair:
    """One pair of tokenizers for each worker process, since loading the files takes a while."""
    if (path_a, path_b) not in _PAIRS:
        _PAIRS[path_a, path_b] = Pair(path_a, path_b)
    return _PAIRS[path_a, path_b]


# -- words of a text ---------------------------------------------------------------------


def word_starts(data: np.ndarray) -> np.ndarray:
    """Where words begin in the bytes of one text that has a space in front.

    A word begins at a space or newline whose character before is surely none: a visible ASCII
    character, or one of two bytes or of four. Characters of three bytes may be blanks; of two, two are.
    """
    if len(data) < 2:
        return np.zeros(min(len(data), 1), np.int64)
    blank = (data == 0x20) | (data == 0x0A)
    before = data[:-1]
    ascii_ = (before > 0x20) & (before < 0x7F)
    lead2 = np.append(0, data[:-2])
    two = (before >= 0x80) & (before < 0xC0) & (lead2 >= 0xC3) & (lead2 < 0xE0)
    lead4 = np.concatenate([[0] * min(3, len(before)), data[: max(len(data) - 4, 0)]])
    four = (before >= 0x80) & (before < 0xC0) & (lead4 >= 0xF0)
    return np.append(0, np.flatnonzero(blank[1:] & (ascii_ | two | four)) + 1)


# -- groups and links of a run -----------------------------------------------------------


def covering(start_a: np.ndarray, doc_a: np.ndarray, start_b: np.ndarray, doc_b: np.ndarray) -> np.ndarray:
    """For each start of ``a`` the token of ``b`` that covers it, in the same document."""
    import pandas as pd  # in tasks alone; the driver of a pipeline has no use for it

    left = pd.DataFrame({"at": start_a, "doc": doc_a}, copy=False)
    right = pd.DataFrame({"at": start_b, "doc": doc_b, "token": np.arange(len(start_b))}, copy=False)
    return pd.merge_asof(left, right, on="at", by="doc")["token"].to_numpy(np.int64)


def group_ends(start_a, end_a, doc_a, start_b, end_b, doc_b) -> np.ndarray:
    """Ends that both sides share, from the overlaps of both directions; places rise over all documents."""
    to_b = covering(start_a, doc_a, start_b, doc_b)
    to_a = covering(start_b, doc_b, start_a, doc_a)
    from_a = end_a[end_a == end_b[to_b]]
    from_b = end_b[end_b == end_a[to_a]]
    return _distinct(np.sort(np.concatenate([from_a, from_b]), kind="stable"))


def _distinct(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.append(True, ordered[1:] != ordered[:-1])] if len(ordered) else ordered


def _expanded(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each index ``counts`` times, and 0, 1, 2, ... within each."""
    stops = np.cumsum(counts)
    return np.repeat(np.arange(len(counts)), counts), np.arange(stops[-1] if len(stops) else 0) - np.repeat(
        stops - counts, counts
    )


def linked_pairs(
    ids_a: np.ndarray, of_a: np.ndarray, ids_b: np.ndarray, of_b: np.ndarray, doc_of: np.ndarray, size_a: int, size_b: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, pair code and number of links of each distinct pair of a document; ``of_*`` are groups."""
    n = len(doc_of)
    p, q = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
    first_b = np.cumsum(q) - q
    few = p * q <= GROUP_LINKS
    left = np.flatnonzero(few[of_a])
    which, step = _expanded(q[of_a[left]])
    left = left[which]
    code = ids_a[left].astype(np.int64) * size_b + ids_b[first_b[of_a[left]] + step]
    key, times = np.unique(doc_of[of_a[left]] * (size_a * size_b) + code, return_counts=True)
    if not few.all():
        keys, many = [key], [times]
        first_a = np.cumsum(p) - p
        for g in np.flatnonzero(~few).tolist():
            a, x = np.unique(ids_a[first_a[g] : first_a[g] + p[g]], return_counts=True)
            b, y = np.unique(ids_b[first_b[g] : first_b[g] + q[g]], return_counts=True)
            code = (a.astype(np.int64)[:, None] * size_b + b).ravel()
            keys.append(doc_of[g] * (size_a * size_b) + code)
            many.append(np.outer(x, y).ravel())
        key, times = _summed(np.concatenate(keys), np.concatenate(many))
    doc, code = np.divmod(key, size_a * size_b)
    return doc, code, times


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[begin], np.add.reduceat(values, begin)


class _Document:
    """What is known of a document so far; a long one comes in several runs."""

    def __init__(self):
        self.right, self.any = True, False
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.said = hashlib.sha256()
        self.found: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, n_a: int, n_b: int, n_groups: int, n_links: int, groups: str, code: np.ndarray, times: np.ndarray):
        self.n_a, self.n_b = self.n_a + n_a, self.n_b + n_b
        self.n_groups, self.n_links = self.n_groups + n_groups, self.n_links + n_links
        self.said.update((";" * self.any + groups).encode())
        self.any = True
        self.found.append((code, times))
        if len(self.found) > 8:
            self.found = [self.pairs()]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.found) == 1:
            return self.found[0]
        none = [(np.zeros(0, np.int64),) * 2]
        return _summed(*(np.concatenate(x) for x in zip(*(self.found or none), strict=True)))


def _runs(texts: pa.Array, splits: bool) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Words of texts in bounded runs, and the text each belongs to; null and empty texts have none."""
    data, offsets = string_bytes(texts)
    held, of, size = [], [], 0
    for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        if a == b:
            continue
        text = np.concatenate([np.array([0x20], np.uint8), data[a:b]])
        starts = word_starts(text) if splits else np.zeros(1, np.int64)
        edges = np.append(starts, len(text))
        at = 0
        while at < len(starts):
            stop = max(int(np.searchsorted(edges, edges[at] + RUN_BYTES - size, side="right")) - 1, at + (not held))
            if stop > at:
                words = text[edges[at] : edges[stop]].tobytes()
                bounds = (edges[at : stop + 1] - edges[at]).astype(np.int64)
                held.append(
                    pa.LargeStringArray.from_buffers(stop - at, pa.py_buffer(bounds.tobytes()), pa.py_buffer(words))
                )
                of.append(np.full(stop - at, k))
                size += int(edges[stop] - edges[at])
                at = stop
            if at < len(starts) or size >= RUN_BYTES:
                yield pa.concat_arrays(held), np.concatenate(of)
                held, of, size = [], [], 0
    if held:
        yield pa.concat_arrays(held), np.concatenate(of)


def _joined(strings: pa.Array, edges: np.ndarray, mark: str) -> pa.Array:
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(edges), strings), pa.scalar(mark, strings.type))


def align(texts: pa.Array, pair: Pair) -> list[_Document]:
    found = [_Document() for _ in range(len(texts))]
    decimal = pa.array([str(k) for k in range(max(pair.sizes))], pa.large_string())
    for words, of in _runs(texts.cast(pa.large_string()), pair.splits):
        coded = words.dictionary_encode()
        rows = pair.rows_of(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
        wrong = np.unique(of[~pair.right[rows]])
        for k in wrong.tolist():
            found[k].right = False
        keep = ~np.isin(of, wrong)
        rows, of = rows[keep], of[keep]
        if not len(rows):
            continue
        sides = []
        for side in (0, 1):
            ids, counts = pair.gather(side, rows)
            ends = np.cumsum(pair.lengths[side][ids])
            sides.append((ids, ends - pair.lengths[side][ids], ends, np.repeat(of, counts)))
        (ids_a, start_a, end_a, doc_a), (ids_b, start_b, end_b, doc_b) = sides
        ends = group_ends(start_a, end_a, doc_a, start_b, end_b, doc_b)
        of_a, of_b = (np.searchsorted(ends, s, side="right") for s in (start_a, start_b))
        p, q = np.bincount(of_a, minlength=len(ends)), np.bincount(of_b, minlength=len(ends))
        doc_of = doc_a[np.cumsum(p) - 1]
        said = [
            _joined(decimal.take(pa.array(ids)), np.append(0, np.cumsum(n)), ",")
            for ids, n in ((ids_a, p), (ids_b, q))
        ]
        said = pc.binary_join_element_wise(*said, pa.scalar("|", pa.large_string()))
        doc, code, times = linked_pairs(ids_a, of_a, ids_b, of_b, doc_of, *pair.sizes)
        own = _distinct(doc_of)
        edges = np.append(np.searchsorted(doc_of, own), len(doc_of))
        said = _joined(said, edges, ";").to_pylist()
        n_a, n_b = (np.add.reduceat(n, edges[:-1]) for n in (p, q))
        links = np.add.reduceat(p * q, edges[:-1])
        cuts = np.append(np.searchsorted(doc, own), len(doc))
        for j, k in enumerate(own.tolist()):
            a, b = cuts[j], cuts[j + 1]
            found[k].add(
                int(n_a[j]), int(n_b[j]), int(edges[j + 1] - edges[j]), int(links[j]), said[j], code[a:b], times[a:b]
            )
    return found


def _align(path_a: str, path_b: str, kind: pa.DataType) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(path_a, path_b)
        none = np.zeros(0, np.int64)
        for table in chunks(batches, "text"):
            done = [d if d.right else _Document() for d in align(column_of(table, "text"), pair)]
            pairs = [d.pairs() if d.any else (none, none) for d in done]
            edges = pa.array(np.append(0, np.cumsum([len(c) for c, _ in pairs])), pa.int32())
            code, times = (
                pa.ListArray.from_arrays(edges, pa.array(np.concatenate([p[k] for p in pairs]), pa.int64())) for k in (0, 1)
            )
            numbers = [[getattr(d, name) for d in done] for name in ("n_a", "n_b", "n_groups", "n_links")]
            said = [d.said.hexdigest() if d.any else "" for d in done]
            yield pa.RecordBatch.from_arrays(
                [column_of(table, "id").cast(kind), *(pa.array(n, pa.int64()) for n in numbers), pa.array(said), code, times],
                names=["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
            )

    return run


# -- counts over the corpus --------------------------------------------------------------


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of the task hold each pair."""

    def handed(keys, values):
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values)], names=["pair", "n"])

    keys, values = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        # The list's own range: a batch may be a slice of a larger one.
        code = np.asarray(batch.column(0).flatten())
        more, n = np.unique(code, return_counts=True)
        keys, values = _summed(np.concatenate([keys, more]), np.concatenate([values, n]))
        if len(keys) > HELD_PAIRS:
            yield handed(keys, values)
            keys, values = keys[:0], values[:0]
    if len(keys):
        yield handed(keys, values)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: how many documents hold a pair; whether no pair of its first id has more."""
    summed = aligned.select("pairs").mapInArrow(_count_pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    own = Window.partitionBy((F.col("pair") / size_b).cast("long"))
    return summed.select("pair", "n", (F.col("n") == F.max("n").over(own)).alias("best"))


def _look_up(held, kind: pa.DataType) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = held.value
        for batch in batches:
            code, times = (np.asarray(batch.column(name).flatten()) for name in ("pairs", "times"))
            lengths = np.asarray(batch.column("pairs").value_lengths())
            at = np.searchsorted(keys, code)
            edges = np.append(0, np.cumsum(lengths))
            sums = [np.append(0, np.cumsum(v)) for v in (times * best[at], times * n[at])] if len(code) else None
            found = [s[edges[1:]] - s[edges[:-1]] for s in sums] if sums else [np.zeros(batch.num_rows, np.int64)] * 2
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(6)), *(pa.array(f, pa.int64()) for f in found)],
                names=[*batch.schema.names[:6], "n_best", "count_sum"],
            )

    return run


def aligned_tokens(
    docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", *,
    shipped_pairs: int = SHIPPED_PAIRS,
) -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, one row per row of ``docs``.

    ``n_links`` counts pairs of token occurrences of one group; ``count_sum`` adds up, over the
    links, how many documents hold the link's id pair, and ``n_best`` counts the links whose id pair
    no other pair of the same first id exceeds in that. ``groups_sha256`` digests ``a1,a2|b1;...``,
    the ids by group. Null and empty texts, and texts that a tokenizer does not give back byte for
    byte, have zeros and no digest. Every row counts as a document, repeated rows and null keys
    too; keys keep their type. An empty table gives an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    work = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = work.schema["id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(kind)
    schema = ALIGNED.format(kind=kind.simpleString())
    aligned = settle(work.mapInArrow(_align(path_a, path_b, arrow), schema), "aligned")
    counts = settle(pair_counts(aligned, piece_count(path_b)), "pair-counts")
    shown = [F.col("id").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if counts.count() <= shipped_pairs:
        # At most ``shipped_pairs`` rows of 17 bytes.
        table = counts.orderBy("pair").toArrow()
        held = spark.sparkContext.broadcast(
            (np.asarray(table["pair"]), np.asarray(table["n"]), np.asarray(table["best"]).astype(np.int64))
        )
        out = schema[: schema.index("pairs")] + "n_best long, count_sum long"
        return aligned.mapInArrow(_look_up(held, arrow), out).select(*shown)
    # Row numbers of a written table stay as they are within this one query.
    numbered = settle(aligned.withColumn("row", F.monotonically_increasing_id()), "numbered")
    links = numbered.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    links = links.select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    sums = links.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    done = numbered.drop("pairs", "times").join(sums, "row", "left")
    zero = [F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("n_best", "count_sum")]
    return done.select("id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256").select(*shown)


def piece_count(path_b: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
