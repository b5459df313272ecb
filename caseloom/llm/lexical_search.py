"""The best documents for each of a set of queries, by the Best Position Algorithm.

Documents are read once into a written table of the query terms each of them holds; its
counts give the statistics of the corpus. Every task then takes its documents in groups, and
for each term sorts the group's documents by impact, the term's share of the score. For a
query these lists are read from the top. A document met for the first time is looked up in
the other lists, which gives its score and its place in each of them. A list's best position
is the last up to which all places have been seen, by reading or by look-up. No document that
was not met can score more than the sum of the impacts at the best positions; when that sum
is strictly below the last of the best ``k``, reading stops, and ties are still met. The best
of earlier groups of a task count too. Queries are taken in blocks of bounded size.

Each task hands on its best ``k`` of each query, from which the best of all are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from caseloom.llm.words import Words, chunks, column_of, string_bytes
from caseloom.storage import settle

TOP = 50
#: Documents of a group, and entries of its lists.
GROUP_DOCS, GROUP_ENTRIES = 16_384, 2_000_000
#: Bytes of query texts, and queries, in a block; each block reads the documents once.
BLOCK_BYTES, BLOCK_QUERIES = 16 << 20, 20_000
#: Places read of each list before the stopping rule is first looked at; then each time as many as before.
STEP = 64

# The characters of a term, with A-Z to be lower-cased, and the constants of the score.
TERM_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
SCALE, TF_FACTOR, LENGTH_FACTOR = 1_000_000_000, 1000, 20

PLAIN = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in TERM_BYTES else 0x20 for b in range(256))


class Terms(Words):
    """Words of texts in which everything but terms is blank and A-Z is lower-cased."""

    def __init__(self, texts: pa.Array):
        data, offsets = string_bytes(pc.fill_null(texts.cast(pa.large_string()), ""))
        plain = data.tobytes().translate(PLAIN)
        super().__init__(
            pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.tobytes()), pa.py_buffer(plain))
        )


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# -- the written table -------------------------------------------------------------------

READ = "id {kind}, n long, terms array<int>, times array<int>, docs long"


def _read(held, kind: pa.DataType) -> Callable:
    """One row per document with a term, and per piece of the table one row of counts, with ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(held.value, pa.large_string())
        df, total, docs = np.zeros(len(wanted), np.int64), 0, 0

        def batch(ids, n, edges, terms, times, counts):
            edges = pa.array(edges, pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    ids, pa.array(n, pa.int64()), pa.ListArray.from_arrays(edges, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(edges, pa.array(times, pa.int32())), counts,
                ],
                names=["id", "n", "terms", "times", "docs"],
            )

        for table in chunks(batches, "text"):
            found = Terms(column_of(table, "text"))
            number = pc.index_in(found.dictionary, value_set=wanted)
            number = np.asarray(pc.fill_null(number, -1))[found.ids].astype(np.int64)
            n = found.counts()
            hit = number >= 0
            key, times = np.unique(found.of_text[hit] * len(wanted) + number[hit], return_counts=True)
            doc, term = np.divmod(key, len(wanted))
            df += np.bincount(term, minlength=len(wanted))
            total, docs = total + int(n.sum()), docs + int((n > 0).sum())
            keep = np.flatnonzero(np.bincount(doc, minlength=len(n)))
            edges = np.append(np.searchsorted(doc, keep), len(doc))
            ids = column_of(table, "id").take(pa.array(keep))
            yield batch(ids, n[keep], edges, term, times, pa.nulls(len(keep), pa.int64()))
        if docs:
            seen = np.flatnonzero(df)
            yield batch(pa.nulls(1, kind), [total], [0, len(seen)], seen, df[seen], pa.array([docs], pa.int64()))

    return run


# -- lists of a group --------------------------------------------------------------------


class Lists:
    """Impact lists of a group of documents.

    ``first[t]`` to ``first[t + 1]`` are the places of term ``t``; ``docs`` and ``impacts`` go by
    place, highest impact first. ``keys`` are term and document in order, and ``places`` theirs.
    """

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_terms: int, n_docs: int):
        order = np.lexsort((docs, -impacts, terms))
        self.docs, self.impacts = docs[order], impacts[order]
        terms = terms[order]
        self.first = np.searchsorted(terms, np.arange(n_terms + 1))
        self.n_docs = n_docs
        keys = terms * n_docs + self.docs
        self.places = np.argsort(keys, kind="stable")
        self.keys = keys[self.places]

    def look_up(self, term: int, docs: np.ndarray) -> np.ndarray:
        """Each document's place in the term's list, -1 where it has none."""
        wanted = term * self.n_docs + docs
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.places[at], -1)


def best_positions(lists: Lists, terms: np.ndarray, k: int, floor: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents and scores met for a query until no other can be among the best ``k``, and places read.

    ``floor`` is a score that ``k`` documents elsewhere have reached, 0 if none.
    """
    terms = terms[lists.first[terms + 1] > lists.first[terms]]
    begin, end = lists.first[terms], lists.first[terms + 1]
    seen = [np.zeros(b - a, bool) for a, b in zip(begin, end, strict=True)]
    best = np.zeros(len(terms), np.int64)  # places seen without a gap, from the top
    met = np.zeros(lists.n_docs, bool)
    docs, scores, depth = [], [], 0
    top = np.zeros(0, np.int64)
    while len(terms):
        new, step = [], max(step, depth)
        for j in range(len(terms)):
            upto = lists.docs[begin[j] + min(depth, len(seen[j])) : min(begin[j] + depth + step, end[j])]
            new.append(upto[~met[upto]])
            met[upto] = True
            seen[j][depth : depth + step] = True
        depth += step
        fresh = np.concatenate(new)
        if len(fresh):
            score = np.zeros(len(fresh), np.int64)
            for j, term in enumerate(terms.tolist()):
                place = lists.look_up(term, fresh)
                there = place >= 0
                score[there] += lists.impacts[place[there]]
                seen[j][place[there] - begin[j]] = True
            docs.append(fresh)
            scores.append(score)
            top = np.concatenate([top, score])
            if len(top) > k:
                top = np.partition(top, len(top) - k)[-k:]
        bound, more = 0, False
        for j in range(len(terms)):
            rest = seen[j][best[j] :]
            gap = int(rest.argmin()) if len(rest) else 0
            best[j] = best[j] + gap if len(rest) and not rest[gap] else len(seen[j])
            if best[j] < len(seen[j]):
                more = True
                # Nothing unseen lies above the best position; what follows it has at most its impact.
                bound += int(lists.impacts[begin[j] + max(best[j] - 1, 0)])
        kth = max(floor, int(top.min()) if len(top) >= k else 0)
        if not more or bound < kth:
            break
    none = np.zeros(0, np.int64)
    return (np.concatenate(docs) if docs else none), (np.concatenate(scores) if scores else none), depth


class _Best:
    """The best of a query so far."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, [], np.zeros(0, np.int64)

    @property
    def floor(self) -> int:
        return int(self.scores[-1]) if len(self.scores) >= self.k else 0

    def add(self, ids: list, scores: np.ndarray) -> None:
        """Equal scores by ascending id, null first."""
        ids, scores = [*self.ids, *ids], np.concatenate([self.scores, scores])
        order = sorted(range(len(ids)), key=lambda j: (-scores[j], ids[j] is not None, ids[j]))[: self.k]
        self.ids, self.scores = [ids[j] for j in order], scores[order]


def _search(held, k: int, kind: pa.DataType) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, n_docs, n_words = held.value
        found = [_Best(k) for _ in queries]

        def group(tables: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(tables)
            ids = column_of(rows, "id")
            n = np.asarray(column_of(rows, "n"))
            lists = column_of(rows, "terms")
            terms = np.asarray(lists.flatten()).astype(np.int64)
            times = np.asarray(column_of(rows, "times").flatten()).astype(np.int64)
            docs = np.repeat(np.arange(len(n)), np.asarray(lists.value_lengths()))
            spread = 100 - 50 + (50 * n * n_docs) // n_words
            impacts = weights[terms] * ((SCALE * times) // (TF_FACTOR * times + LENGTH_FACTOR * spread[docs]))
            keep = impacts > 0
            own = Lists(terms[keep], docs[keep], impacts[keep], len(weights), len(n))
            for query, best in zip(queries, found, strict=True):
                met, scores, _ = best_positions(own, query, k, best.floor)
                good = scores >= max(best.floor, 1)
                if good.any():
                    met, scores = met[good], scores[good]
                    if len(met) > k:
                        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
                        met, scores = met[scores >= cut], scores[scores >= cut]
                    best.add(ids.take(pa.array(met)).to_pylist(), scores)

        kept, docs, entries = [], 0, 0
        for batch in batches:
            lengths = np.asarray(batch.column("terms").value_lengths()).astype(np.int64)
            at = 0
            while at < batch.num_rows:
                room = int(np.searchsorted(np.cumsum(lengths[at:]), GROUP_ENTRIES - entries, side="right"))
                room = max(min(room, GROUP_DOCS - docs), int(not kept))
                if room:
                    kept.append(batch.slice(at, room))
                    docs, entries = docs + room, entries + int(lengths[at : at + room].sum())
                    at += room
                if at < batch.num_rows or docs >= GROUP_DOCS:
                    group(kept)
                    kept, docs, entries = [], 0, 0
        if kept:
            group(kept)
        for number, best in enumerate(found):
            if best.ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(best.ids), pa.int32()), pa.array(best.ids, kind), pa.array(best.scores)],
                    names=["query", "id", "score"],
                )

    return run


# -- the operator ------------------------------------------------------------------------


def _blocks(queries: DataFrame) -> Iterator[list[tuple]]:
    """Distinct keys and texts of queries, in order, in blocks that the driver may hold."""
    block, size = [], 0
    for row in queries.dropDuplicates().orderBy("query", "text").toLocalIterator():
        # Rows of one key stay together.
        same = block and row["query"] == block[-1][0]
        if block and not same and (size > BLOCK_BYTES or len(block) >= BLOCK_QUERIES):
            yield block
            block, size = [], 0
        block.append((row["query"], row["text"]))
        size += len(row["text"] or "")
    if block:
        yield block


def ranked(
    docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text",
    query_key: str = "item_id", query_text: str = "text", *, k: int = TOP,
) -> DataFrame:
    """``query_key, rank, key, score``: for each query its ``k`` best documents with a score above 0.

    Equal scores come by ascending key, null keys first; rows repeated as a whole are documents of
    their own. Rows of ``queries`` with one key, also null, are one query with all their terms.
    Null and empty texts have no terms. Empty tables give an empty result. Other columns are not
    read; keys keep their types.
    """
    spark = docs.sparkSession
    work = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    asked = queries.select(F.col(query_key).alias("query"), F.col(query_text).alias("text"))
    kind, query_kind = work.schema["id"].dataType, asked.schema["query"].dataType
    arrow = to_arrow_type(kind)
    done = spark.createDataFrame(
        [], f"query {query_kind.simpleString()}, rank int, id {kind.simpleString()}, score long"
    )
    for block in _blocks(asked):
        names = list(dict.fromkeys(name for name, _ in block))
        place = {name: j for j, name in enumerate(names)}
        of = np.array([place[name] for name, _ in block])
        found = Terms(pa.array([t for _, t in block], pa.large_string()))
        terms = found.dictionary.to_pylist()
        if not terms:
            continue
        pairs = np.unique(np.stack([of[found.of_text], found.ids]), axis=1)
        cuts = np.searchsorted(pairs[0], np.arange(len(names) + 1))
        held = spark.sparkContext.broadcast(terms)
        read = settle(work.mapInArrow(_read(held, arrow), READ.format(kind=kind.simpleString())), "terms")
        counts = read.where("docs is not null")
        n_words, n_docs = counts.agg(F.sum("n"), F.sum("docs")).first()
        if not n_docs:
            continue
        each = counts.select(F.explode(F.arrays_zip("terms", "times")).alias("t"))
        each = each.groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.times").alias("df")).toArrow()
        weights = np.zeros(len(terms), np.int64)
        for term, df in zip(each["term"].to_pylist(), each["df"].to_pylist(), strict=True):
            weights[term] = weight(n_docs, df)
        lists = [pairs[1, a:b].astype(np.int64) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        shared = spark.sparkContext.broadcast((lists, weights, n_docs, n_words))
        best = read.where("docs is null").mapInArrow(
            _search(shared, k, arrow), f"query int, id {kind.simpleString()}, score long"
        )
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("id"))
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        named = spark.createDataFrame(
            list(enumerate(names)), f"query int, name {query_kind.simpleString()}"
        )
        # At most BLOCK_QUERIES names.
        best = best.join(F.broadcast(named), "query").select(F.col("name").alias("query"), "rank", "id", "score")
        done = done.unionByName(settle(best, "ranked"))
    return done.select(F.col("query").alias(query_key), "rank", F.col("id").alias(key), "score")
