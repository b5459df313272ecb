"""Toxicity by compression distance.

A zstandard dictionary is trained on ordinary text. The toxic dictionary is the same one
with the stretches that set toxic text apart put before its last ``PAD_BYTES``, so that
all else lies at equal distance from a window in both. A window is a word (long ones in
pieces) between two copies of those last bytes, so that every window compresses and
lengths differ by the word alone. The bytes that the toxic dictionary saves speak for
toxicity. What a document's windows say - the largest distance, and how many reach each of
``MARKS``, as a count and as a share - goes through a logistic curve, fitted to labelled
documents that the dictionaries have not seen. The same documents choose the length of
grams, least share, contrast and size of the toxic stretches among ``GRAMS``, ``SHARES``,
``CONTRASTS`` and ``SIZES``.

Everything learned has a fixed size: at most ``MAX_TOXIC`` and ``MAX_ORDINARY`` labelled
rows reach the driver, none with more than ``MAX_BYTES`` of text. Scoring is one narrow
stage over whole texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import unused, widened
from caseloom.llm.words import Words, chunks, column_of

#: Bounds of the labelled sample.
MAX_TOXIC, MAX_ORDINARY, MAX_BYTES = 2000, 4000, 1 << 16
#: One part of so many calibrates, the others train.
PARTS = 3

#: A gram of so many bytes sets toxic text apart when this share of toxic texts has it, in so many times
#: the windows that an ordinary text has it in; bytes of such stretches. The calibration part chooses.
GRAMS, SHARES, CONTRASTS, SIZES = (5, 7), (0.01, 0.003), (10, 5, 3), (2048, 8192)
LEAST_TEXTS = 3
BASE_BYTES, PAD_BYTES = 6000, 96
#: Ordinary texts that a dictionary is trained on, those with the smallest hash; the calibration part
#: chooses among the dictionaries of so many draws.
BASE_TEXTS, DRAWS = 1500, 4
LEVEL = 6
#: Longer words are looked at in overlapping pieces.
PIECE, STEP = 48, 40
CACHE = 200_000
#: Distances from which on windows are counted; the curve weighs them.
MARKS = (1, 2, 3, 4, 5, 6)
FEATURES = 1 + 2 * len(MARKS)
#: How far rare labels are weighted up (0 to 1).
BALANCE = 0.5


def windows(text: str) -> set[bytes]:
    return {piece for word in text.encode().lower().split() for piece in _pieces(word)}


def _pieces(word: bytes) -> list[bytes]:
    if len(word) <= PIECE:
        return [b" " + word + b" "]
    return [b" " + word[k : k + PIECE] + b" " for k in range(0, len(word) - PIECE + STEP, STEP)]


def _grams(window: bytes, gram: int) -> set[bytes]:
    return {window[k : k + gram] for k in range(len(window) - gram + 1)}


def _stretches(window: bytes, special: set[bytes], gram: int) -> list[bytes]:
    """The longest stretches of a window all of whose grams are special."""
    out, k, last = [], 0, len(window) - gram
    while k <= last:
        end = k
        while end <= last and window[end : end + gram] in special:
            end += 1
        if end > k:
            out.append(window[k : end - 1 + gram])
        k = end + 1
    return out


def _base(texts: list[str], draw: int = 0) -> bytes:
    samples = []
    for text in sorted(texts, key=lambda text: (xxhash.xxh64_intdigest(text.encode(), draw), text))[:BASE_TEXTS]:
        words = text.encode().lower().split()
        samples += [b" " + b" ".join(words[k : k + 10]) + b" " for k in range(0, len(words), 10)]
    try:
        return zstandard.train_dictionary(BASE_BYTES + 2192, samples, d=8, k=64).as_bytes()[-BASE_BYTES:]
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        return b"".join(samples)[-BASE_BYTES:].rjust(64)


def _extras(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """What sets toxic text apart, by each of the settings; the most frequent stretches last, as zstandard likes it."""
    of_toxic, of_ordinary = ([windows(text) for text in texts] for texts in (toxic, ordinary))
    uses = Counter(w for found in of_toxic for w in found)
    out = {}
    for gram in GRAMS:
        texts = Counter(g for found in of_toxic for g in {g for w in found for g in _grams(w, gram)})
        texts = {g: n for g, n in texts.items() if n >= LEAST_TEXTS}
        # Windows, not texts, are counted for the contrast: a telling word comes in many forms in one toxic text.
        here = Counter(g for w, n in uses.items() for g in _grams(w, gram) & texts.keys() for _ in range(n))
        there = Counter(g for found in of_ordinary for w in found for g in _grams(w, gram) & texts.keys())
        held: dict[frozenset[bytes], Counter] = {}
        for share, contrast in product(SHARES, CONTRASTS):
            least = max(LEAST_TEXTS, share * len(toxic))
            # A count is taken two standard deviations low, so that chance finds don't get in.
            special = frozenset(
                g for g, n in texts.items()
                if n >= least
                and here[g] * (1 - 2 / n**0.5) / len(toxic) > contrast * (there[g] + 1) / max(1, len(ordinary))
            )
            if special not in held:
                stretches = held[special] = Counter()
                for window, n in uses.items():
                    for stretch in set(_stretches(window, special, gram)):
                        stretches[stretch] += n
            for size in SIZES:
                out[_joined(held[special], least, size)] = None
    return list(out)


def _joined(stretches: Counter, least: float, size: int) -> bytes:
    chosen, length = [], 0
    for stretch, n in sorted(stretches.items(), key=lambda x: (-x[1], x[0])):
        if n < least or length > size:
            break
        if not any(stretch in other for other in chosen):
            chosen.append(stretch)
            length += len(stretch)
    return b"".join(reversed(chosen))


@dataclass
class ToxicityModel:
    """Plain data, so that it travels to tasks as it is."""

    base: bytes = b""
    extra: bytes = b""
    weights: tuple[float, ...] = ()
    offset: float = -20.0

    def _compressor(self, content: bytes) -> zstandard.ZstdCompressor:
        made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        made.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            dict_data=made, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
        )

    def meter(self):
        """A function from window to distance: 0 and less is ordinary."""
        pad = self.base[-PAD_BYTES:]
        ordinary = self._compressor(self.base).compress
        # The last bytes of a dictionary are not indexed and moved offsets cost bytes: the extra goes before them.
        toxic = self._compressor(self.base[:-PAD_BYTES] + self.extra + pad).compress
        no_word, no_word_toxic = len(ordinary(pad + pad)), len(toxic(pad + pad))
        held: dict[bytes, float] = {}

        def distance(window: bytes) -> float:
            found = held.get(window)
            if found is None:
                if len(held) >= CACHE:
                    held.clear()
                whole = pad + window + pad
                with_toxic = len(toxic(whole)) - no_word_toxic
                found = held[window] = float(len(ordinary(whole)) - no_word - with_toxic)
            return found

        return distance

    def scores(self, found: np.ndarray) -> np.ndarray:
        """From ``features``; texts without a window score 0."""
        filled = np.isfinite(found[:, 0])
        x = found[filled] @ np.array(self.weights or (0.0,) * FEATURES) + self.offset
        out = np.zeros(len(found))
        out[filled] = 1 / (1 + np.exp(-np.clip(x, -500, 500)))
        return out


def features(texts: pa.Array, distance) -> np.ndarray:
    """A row per text: largest distance (``-inf`` without a window), count and share of windows from each mark on."""
    words = Words(texts)
    out = np.zeros((len(texts), FEATURES))
    out[:, 0] = -np.inf
    if len(words):
        distinct = map(bytes.lower, words.dictionary.cast(pa.large_binary()).to_pylist())
        each = np.array([max(map(distance, _pieces(word))) for word in distinct])[words.ids]
        filled = words.counts() > 0
        at, n = words.first[:-1][filled], words.counts()[filled]
        reached = [np.add.reduceat((each >= mark).astype(np.int64), at) for mark in MARKS]
        out[filled] = np.stack(
            [np.maximum.reduceat(each, at), *map(np.log1p, reached), *(np.sqrt(m / n) for m in reached)], axis=1
        )
    return out


def _row_weights(y: np.ndarray) -> np.ndarray:
    return (0.5 / np.where(y == 1, y.mean(), 1 - y.mean())) ** BALANCE


def _loss(scores: np.ndarray, y: np.ndarray) -> float:
    """Weighted cross entropy."""
    right = np.where(y == 1, scores, 1 - scores)
    return float(-(_row_weights(y) * np.log(np.maximum(right, 1e-9))).sum())


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1) -> tuple[tuple[float, ...], float]:
    """Weights and offset of a logistic curve, by Newton steps on standardised columns."""
    rows = _row_weights(y)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (rows * (p - y)) + penalty * w
        bend = (z * (rows * p * (1 - p))[:, None]).T @ z + np.eye(len(w)) * penalty
        w = w - np.clip(np.linalg.solve(bend, slope), -2, 2)
    return tuple((w[:-1] / scale).tolist()), float(w[-1] - (w[:-1] * centre / scale).sum())


def fit(rows: Iterable[tuple[str, int, int]]) -> ToxicityModel:
    """From ``(text, label, part)``: part 0 calibrates and chooses the settings, the others train the dictionaries.

    Repeated texts count once. Unless either side has texts of both labels, every
    document scores near 0.
    """
    texts: dict[tuple[bool, int], list[str]] = {}
    for text, label, part in sorted(set(rows)):
        if text.split():
            texts.setdefault((part > 0, label), []).append(text)
    if any((side, label) not in texts for side in (False, True) for label in (0, 1)):
        return ToxicityModel()
    ordinary = texts[True, 0]
    unseen = pa.array(texts[False, 0] + texts[False, 1], pa.string())
    labels = np.repeat([0.0, 1.0], [len(texts[False, 0]), len(texts[False, 1])])

    def calibrated(base: bytes, extra: bytes) -> tuple[float, ToxicityModel]:
        model = ToxicityModel(base, extra)
        found = features(unseen, model.meter())
        model.weights, model.offset = _logistic(found, labels)
        return _loss(model.scores(found), labels), model

    base = _base(ordinary)
    tried = [calibrated(base, extra) for extra in _extras(texts[True, 1], ordinary)]
    best = min(tried, key=lambda x: x[0])
    drawn = [calibrated(_base(ordinary, draw), best[1].extra) for draw in range(1, DRAWS)]
    return min([best, *drawn], key=lambda x: x[0])[1]


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "label"
) -> ToxicityModel:
    """A model from ``docs`` and the labels (1: toxic, 0: not; others are ignored) of some of them.

    The sample is chosen among the labels: those whose keys have the smallest hash, at
    most ``MAX_TOXIC`` and ``MAX_ORDINARY``. That list is bounded, so it is broadcast to
    the documents, and only texts of the sample move.
    """
    pool = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where(
        F.col("key").isNotNull() & F.col("label").isNotNull()
    ).distinct()
    order = F.xxhash64("key")
    parts = [
        pool.where(F.col("label") == value).orderBy(order, "key").limit(bound)
        for value, bound in ((1, MAX_TOXIC), (0, MAX_ORDINARY))
    ]
    sample = F.broadcast(parts[0].unionByName(parts[1]))
    part = F.pmod(F.shiftrightunsigned(order, 20), F.lit(PARTS)).cast("int")
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = texts.where(F.octet_length("text") <= MAX_BYTES).join(sample, "key").select("text", "label", part)
    return fit(tuple(row) for row in rows.collect())


def _score(model: ToxicityModel, text: str, keep: list[str], names: tuple[str, str] = ("distance", "score")):
    """The columns ``keep``, then distance and score under ``names``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = model.meter() if model.weights else (lambda window: 0.0)
        for table in chunks(batches, text):
            found = features(column_of(table, text), distance)
            new = [pa.array(found[:, 0]), pa.array(model.scores(found))]
            columns = [*(column_of(table, name) for name in keep), *new]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *names])

    return run


def score(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, distance, score``, one row per row of ``docs``; whole texts are read.

    Null, empty and blank texts have no window: distance ``-Infinity``, score 0. Other
    columns are neither read nor returned.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = widened(rows.select("key").schema, distance="double", score="double")
    return rows.mapInArrow(_score(model, "text", ["key"]), schema).withColumnRenamed("key", key)


def clean_rows(docs: DataFrame, model: ToxicityModel, text: str = "text", cut: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``cut``, all columns, in one narrow stage.

    Rows without text stay.
    """
    names = unused("_distance", docs.columns), unused("_score", docs.columns)
    schema = widened(docs.schema, **dict.fromkeys(names, "double"))
    scored = docs.mapInArrow(_score(model, text, docs.columns, names), schema)
    return scored.where(F.col(names[1]) < cut).select(*docs.columns)
