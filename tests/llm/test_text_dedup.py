"""Exact, line and substring deduplication against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caseloom.llm import exact_dedup, line_dedup, substring_dedup
from caseloom.llm.words import Tokens, Words, hash_strings

from .conftest import ODD, prose

LOW = -(1 << 63)


def key_of(key):
    return LOW if key is None else key


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_exact(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[normal(text)].append(key_of(key))
    out = []
    for key, text in rows:
        own = groups[normal(text)]
        keep = min(own)
        out.append((key, None if keep == LOW else keep, len(own), hashlib.sha256(normal(text).encode()).digest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_rows", [1, 1000])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, table, hot_rows, weak):
    """Hot and cold groups, and a digest that confuses different texts."""
    rows = ODD + [(100 + k, "copy  of\ta text") for k in range(40)] + [(50, "copy of a text"), (200, "other")]
    options = {"digest": lambda c: F.unhex(F.lpad(F.hex(F.length(c) % 7), 4, "0"))} if weak else {}
    found = exact_dedup.exact_groups(table(rows), salts=4, hot_rows=hot_rows, hot_share=0.0, **options).collect()
    want = brute_exact(rows)
    got = sorted(((r.doc_id, r.keep_id, r.group_size, bytes(r.digest)) for r in found), key=repr)
    if weak:
        got, want = [r[:3] for r in got], [r[:3] for r in want]
        got.sort(key=repr), want.sort(key=repr)
    assert got == want
    # One row of each group stays, also where a row is repeated as a whole.
    assert sum(r.kept for r in found) == len({normal(text) for _, text in rows})
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def test_exact_dedup_keeps_columns(table):
    left = exact_dedup.exact_dedup(table([(2, "x"), (1, "x"), (3, None), (4, "")]))
    assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in left.collect()) == [1, 3]


def brute_lines(rows):
    def key(line):
        return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(
            str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        )

    holders = defaultdict(list)
    for at, (doc, text) in enumerate(rows):
        for found in {key(line) for line in (text or "").split("\n")}:
            holders[found].append((key_of(doc), at))
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [
            line for line in lines
            if len(key(line)) < 20 or len(holders[key(line)]) < 3 or key_of(doc) == max(holders[key(line)])[0]
        ]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard_keys", [3, 1000])
def test_lines(table, shard_keys):
    draw = random.Random(4)
    lines = [" ".join(prose(k, 4)) for k in range(30)] + ["short", "été été été été été", "x" * 20, "x" * 19]
    rows = ODD + [
        (300 + k, "\n".join(draw.choice([str.upper, str, lambda s: f" {s}\t"])(draw.choice(lines)) for _ in range(6)))
        for k in range(60)
    ]
    found = line_dedup.line_dedup(table(rows), shard_keys=shard_keys, salts=2).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in found), key=repr) == brute_lines(rows)


def test_lines_with_clashing_columns(spark):
    rows = [(k, "a line that is long enough to count", "x", 5) for k in (1, 2, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, mark string, kept int")
    left = line_dedup.without_repeated_lines(df)
    assert left.columns == df.columns
    assert sorted(tuple(r) for r in left.collect()) == [(1, "", "x", 5), (2, "", "x", 5), (3, rows[0][1], "x", 5)]


def test_perfect_hash_numbers_every_key():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64))
    function = line_dedup.PerfectHash.build(keys)
    assert sorted(function.number(keys).tolist()) == list(range(len(keys)))
    assert line_dedup.PerfectHash.build(keys[:0]).number(keys[:3]).tolist() == [-1, -1, -1]


def brute_substrings(rows, window):
    words = [(key_of(key), key, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for key, text in rows]
    first = {}
    for low, _, own in words:
        for k in range(len(own) - window + 1):
            run = tuple(own[k : k + window])
            first[run] = min(first.get(run, low), low)
    out = []
    for low, key, own in words:
        gone = set()
        for k in range(len(own) - window + 1):
            if first[tuple(own[k : k + window])] < low:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        out.append((key, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"bucket_bytes": 3000, "portion_bytes": 2000}])
def test_substrings(table, options):
    """Also with many buckets that are worked on in many portions."""
    draw = random.Random(9)
    passage, words = prose(5, 70), prose(6, 50)
    rows = list(ODD)
    for k in range(60):
        own = [draw.choice(words) for _ in range(draw.randint(0, 90))]
        cut = draw.randint(0, len(own))
        rows.append((400 + draw.randint(0, 80), " ".join(own[:cut] + passage[draw.randint(0, 15) :] + own[cut:])))
    rows += [(600 + k, "same same " * 60) for k in range(5)]
    found = substring_dedup.substring_dedup(table(rows), **options).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=repr)
    assert got == brute_substrings(rows, 50)


def test_equal_hashes_are_told_apart(monkeypatch):
    """Windows that share a hash by accident are compared word by word."""
    texts = [" ".join(prose(k % 3, 12)) for k in range(6)]
    words = Words(pa.array(texts))
    monkeypatch.setattr(words, "run_hashes", lambda n: np.zeros(len(words) - n + 1, np.uint64))
    starts, later = substring_dedup.first_holders(words, np.arange(6), 8)
    assert [bool(x) for x in later] == [words.of_text[s] >= 3 for s in starts]


def test_words_and_hashes():
    texts = ["a  b\u00a0c\n", None, "", "\x1cx y\x85z", "b a"]
    words = Words(pa.array(texts))
    assert words.strings.to_pylist() == ["a", "b\u00a0c", "\x1cx", "y\x85z", "b", "a"]
    assert words.counts().tolist() == [2, 0, 0, 2, 2]
    assert words.hashes[0] == words.hashes[5]
    many = pa.array([f"w{k}" for k in range(20_000)])
    assert len(set(hash_strings(many).tolist())) == 20_000
    assert (hash_strings(many)[5:9] == hash_strings(many[5:9])).all()
    assert len(Tokens(pa.array(["A-b, C! ... \u00c9t\u00e9", None]))) == 3


@pytest.mark.parametrize(
    "call", [exact_dedup.exact_groups, line_dedup.line_dedup, substring_dedup.substring_dedup]
)
def test_empty_table(table, call):
    assert call(table([])).collect() == []
