"""Category scores from a rule table the user can edit.

``rules.category_scores`` compiles a short list into one expression and is the fast
path. This is the path for rules that live in a table ``category, keyword, weight``
of any length. The keywords become one Aho-Corasick automaton, compiled on the driver and sent
to the tasks as one value. A task walks each text through it once, however many rules there
are, and hands on only what it found: rows of key and rule, or of key, category and score.
Texts are neither shuffled nor repeated, so no frequent keyword can slow one task down.

Rules are taken in blocks that the driver and a worker can hold, ``BLOCK_RULES`` at a time;
only tables beyond that cost a further pass over the documents.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rules of one automaton; at 20 characters each it takes about 150 MB in a worker.
BLOCK_RULES = 200_000
#: Characters of keywords that end a block before that.
BLOCK_CHARS = 4_000_000

Rule = tuple[str, str, object]


def _blocks(rules: DataFrame, block_rules: int) -> Iterator[list[Rule]]:
    """The rules in blocks, read from the table partition by partition."""
    rows = rules.select("category", "keyword", "weight").toLocalIterator(prefetchPartitions=True)
    block: list[Rule] = []
    chars = 0
    for category, keyword, weight in rows:
        if not keyword or weight is None or weight <= 0:
            raise ValueError("keywords must not be empty and weights must be positive")
        block.append((category, keyword, weight))
        chars += len(keyword)
        if len(block) >= block_rules or chars >= BLOCK_CHARS:
            yield block
            block, chars = [], 0
    if block:
        yield block


class Matcher:
    """An automaton over the keywords of a block of rules.

    ``rules_of[first[k] : first[k + 1]]`` are the rules of keyword ``k``.
    """

    def __init__(self, rules: list[Rule]):
        import ahocorasick

        keywords: dict[str, list[int]] = {}
        for number, (_, keyword, _) in enumerate(rules):
            keywords.setdefault(keyword, []).append(number)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, keyword in enumerate(keywords):
            self.automaton.add_word(keyword, number)
        self.automaton.make_automaton()
        self.first = np.append(0, np.cumsum([len(own) for own in keywords.values()]))
        self.rules_of = np.array([number for own in keywords.values() for number in own])

    def rules_in(self, text: str) -> list[int]:
        """The rules whose keyword the text holds, each once, in the order of the table."""
        met = {number for _, number in self.automaton.iter(text)}
        return sorted(rule for k in met for rule in self.rules_of[self.first[k] : self.first[k + 1]].tolist())


#: The matcher a worker process has unpacked last, by the name it was sent under.
_UNPACKED: dict[str, tuple[Matcher, pa.Table]] = {}


def _send(docs: DataFrame, rules: list[Rule], kinds: T.StructType) -> tuple[str, Broadcast]:
    """Matcher and rules, pickled: a worker unpacks them once and not for every task."""
    columns = pa.Table.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rules), to_arrow_schema(kinds).types)], names=kinds.names
    )
    return uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(pickle.dumps((Matcher(rules), columns)))


def _unpacked(sent: tuple[str, Broadcast]) -> tuple[Matcher, pa.Table]:
    name, value = sent
    if name not in _UNPACKED:
        _UNPACKED.clear()
        _UNPACKED[name] = pickle.loads(value.value)
    return _UNPACKED[name]


def _found(sent: tuple[str, Broadcast], scored: bool) -> Callable:
    """Rows come as key and text; null texts hold nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, rules = _unpacked(sent)
        categories = rules.column("category").to_pylist()
        weights = rules.column("weight").to_pylist()
        for batch in batches:
            of, hits, scores = [], [], []
            for row, text in enumerate(batch.column(1)):
                own = matcher.rules_in(text.as_py()) if text.is_valid else []
                if scored:
                    # Of a category, its first rule found and the sum of the weights.
                    first: dict[str, int] = {}
                    sums: dict[str, object] = {}
                    for rule in own:
                        name = categories[rule]
                        first.setdefault(name, rule)
                        sums[name] = sums[name] + weights[rule] if name in sums else weights[rule]
                    own = list(first.values())
                    scores += sums.values()
                of += [row] * len(own)
                hits += own
            keys = batch.column(0).take(pa.array(of, pa.int64()))
            chosen = rules.take(pa.array(hits, pa.int64())).combine_chunks()
            if scored:
                columns = [chosen.column("category"), pa.array(scores, rules.schema.field("weight").type)]
                names = ["category", "score"]
            else:
                columns, names = chosen.columns, rules.column_names
            columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
            yield pa.RecordBatch.from_arrays([keys, *columns], names=["key", *names])

    return run


def _matched(docs: DataFrame, rules: DataFrame, key: str, subject: str, block_rules: int, scored: bool) -> DataFrame:
    rows = docs.select(F.col(key).alias("key"), F.col(subject).alias("text"))
    kinds = rules.select("category", "keyword", "weight").schema
    shown = [kinds["category"], T.StructField("score", kinds["weight"].dataType)] if scored else kinds.fields
    schema = T.StructType([rows.schema["key"], *shown])
    parts = [
        rows.mapInArrow(_found(_send(docs, block, kinds), scored), schema) for block in _blocks(rules, block_rules)
    ] or [docs.sparkSession.createDataFrame([], schema)]
    return reduce(DataFrame.unionByName, parts)


def matched_rules(
    docs: DataFrame, rules: DataFrame, key: str, subject: str, block_rules: int = BLOCK_RULES
) -> DataFrame:
    """``key, category, keyword, weight`` of every rule whose keyword the text holds.

    Every row of ``docs`` is looked at by itself; rows that share a key each give theirs. A
    repeated rule counts as often as the table has it. Null texts hold no keyword.
    """
    return _matched(docs, rules, key, subject, block_rules, scored=False).withColumnRenamed("key", key)


def keyword_scores(
    docs: DataFrame, rules: DataFrame, key: str, subject: str, block_rules: int = BLOCK_RULES
) -> DataFrame:
    """``key, category, score`` of the categories with at least one hit; rows of one key add up."""
    hits = _matched(docs, rules, key, subject, block_rules, scored=True)
    return hits.groupBy(F.col("key").alias(key), "category").agg(F.sum("score").alias("score"))


def top_categories(
    docs: DataFrame, rules: DataFrame, key: str, subject: str, block_rules: int = BLOCK_RULES
) -> DataFrame:
    """``key, category`` for every document; without a hit the category is Other."""
    none = docs.select(key, F.lit("Other").alias("category"), F.lit(0).cast("long").alias("score"))
    scores = keyword_scores(docs, rules, key, subject, block_rules)
    best = F.max(F.struct("score", "category"))["category"]
    return scores.unionByName(none).groupBy(key).agg(best.alias("category"))
