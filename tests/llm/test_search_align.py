from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from caseloom.llm import lexical_search, simhash_dedup, token_alignment
from caseloom.llm.tokens import vocabulary
from .conftest import prose

# -- SimHash -----------------------------------------------------------------------------


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lower = lower.replace(blank, " ")
    words = [w for w in lower.split(" ") if w]
    runs = [words[k : k + 4] for k in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64(" ".join(r).encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, distance=4):
    prints = [plain_fingerprint(text) for _, text in rows]
    label = list(range(len(rows)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                label[root(i)] = root(j)
    least = {}
    for k, (key, _) in enumerate(rows):
        least.setdefault(root(k), []).append(key)
    lowest = {r: None if None in keys else min(keys) for r, keys in least.items()}
    return sorted(
        ((key, f"{prints[k]:016x}", lowest[root(k)]) for k, (key, _) in enumerate(rows)), key=repr
    )


def family(seed, n, words=120):
    """One text and copies of it with a word or two exchanged."""
    base, draw = prose(seed, words), random.Random(seed)
    out = [" ".join(base)]
    for _ in range(n - 1):
        own = list(base)
        for _ in range(draw.randint(1, 2)):
            own[draw.randrange(words)] = "other" + str(draw.randrange(50))
        out.append(" ".join(own))
    return out


ODD_TEXTS = [None, "", "   \n", "one", "ONE", "one two", "one two three four", "A b\tc\x0bd e", "ß ñ É", "x" * 5000, "!! ??"]


def shown(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block_rows", [simhash_dedup.BLOCK_ROWS, 7])
def test_simhash_equals_all_pairs(table, block_rows):
    texts = ODD_TEXTS + family(1, 60) + family(2, 25) + [" ".join(prose(k, 40)) for k in range(3, 40)]
    texts += texts[15:20] + [texts[20]] * 30
    rows = list(enumerate(texts, start=5)) + [(5, "one"), (None, "nothing like it at all here")]
    found = simhash_dedup.near_duplicates(table(rows), block_rows=block_rows)
    assert shown(found, "doc_id", "fingerprint", "component_id") == plain_components(rows)


def test_simhash_on_random_fingerprints_finds_all_links(spark):
    draw = random.Random(5)
    prints = {draw.getrandbits(64) for _ in range(300)}
    for p in list(prints)[:100]:
        for _ in range(4):
            q = p
            for b in draw.sample(range(64), draw.randint(1, 6)):
                q ^= 1 << b
            prints.add(q)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash_dedup.links(spark.createDataFrame([(p,) for p in signed], "print long"), len(prints))
    label = {p: p for p in signed}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for row in found.collect():
        assert bin((row.a ^ row.b) & ((1 << 64) - 1)).count("1") <= 4
        label[root(row.a)] = root(row.b)
    for i, p in enumerate(prints):
        for j in range(i):
            if bin(p ^ prints[j]).count("1") <= 4:
                assert root(signed[i]) == root(signed[j])


def test_thresholds_always_spend_all_units_and_avoid_crowded_parts():
    draw = np.random.default_rng(1)
    prints = draw.integers(0, 1 << 63, 200, dtype=np.uint64)
    parts = simhash_dedup.Parts([list(range(k * 16, k * 16 + 16)) for k in range(4)])
    histograms = np.ones((4, 1 << simhash_dedup.HISTOGRAM_BITS), np.int64)
    histograms[2] = 10_000_000
    parts.histograms = histograms
    units = simhash_dedup.thresholds(parts, prints, 4)
    assert (units.sum(axis=1) == 5).all() and (units[:, 2] == 0).all()


def test_a_place_hands_on_no_more_links_than_rows():
    prints = np.array([k for k in range(1 << 9)], np.uint64)
    every = np.ones(len(prints), bool)
    found = simhash_dedup.linked(prints, every, every, 4)
    assert len(found) == len(prints) - 1


def test_simhash_of_an_empty_table(table, spark):
    assert simhash_dedup.near_duplicates(table([(1, "x")]).where("doc_id > 1")).count() == 0
    clash = spark.createDataFrame([(1, "a b c d", 7, 8)], "doc_id long, text string, id int, print int")
    assert shown(simhash_dedup.near_duplicates(clash), "doc_id", "component_id") == [(1, 1)]


# -- ranked search -----------------------------------------------------------------------


def plain_terms(text):
    out, word = [], ""
    for c in text or "":
        if c.isascii() and not c.isalnum():
            out, word = out + [word] * bool(word), ""
        else:
            word += c.lower() if c.isascii() else c
    return out + [word] * bool(word)


def plain_ranks(rows, queries, k):
    import math

    docs = [(key, Counter(plain_terms(text))) for key, text in rows]
    docs = [(key, tf) for key, tf in docs if tf]
    n, total = len(docs), sum(sum(tf.values()) for _, tf in docs)
    df = Counter(t for _, tf in docs for t in tf)
    asked = defaultdict(set)
    for key, text in queries:
        asked[key] |= set(plain_terms(text))
    out = []
    for key, terms in asked.items():
        scored = []
        for doc, tf in docs:
            m = 100 - 50 + (50 * sum(tf.values()) * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 20 * m))
                for t in terms if t in tf
            )
            if score > 0:
                scored.append((-score, doc is not None, doc, score))
        out += [(key, r, doc, score) for r, (_, _, doc, score) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("group", [lexical_search.GROUP_DOCS, 9])
def test_ranked_search_equals_scoring_all(table, spark, monkeypatch, group):
    monkeypatch.setattr(lexical_search, "GROUP_DOCS", group)
    texts = [" ".join(prose(k % 31, 5 + k % 60, 40)) for k in range(150)] + [t for t in ODD_TEXTS]
    texts += ["The the THE", "naïve Naïve-café №5 x_y", texts[3], texts[3]]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[3])]
    queries = [(k, " ".join(prose(k, 12, 40))) for k in range(12)]
    queries += [(20, None), (21, ""), (22, "!!"), (23, "unheard-of"), (24, "the Café x y"), (3, "the one"), (None, "two ONE")]
    asked = spark.createDataFrame(queries + queries[:2], "item_id long, text string")
    found = lexical_search.ranked(table(rows), asked, k=7)
    assert shown(found, "item_id", "rank", "doc_id", "score") == plain_ranks(rows, queries, 7)


def test_ranked_search_of_empty_tables(table, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "x")], "item_id long, text string")
    empty = table([(1, "x")]).where("doc_id > 1")
    assert lexical_search.ranked(table([(1, "x")]), none).count() == 0
    assert lexical_search.ranked(empty, one).count() == 0
    assert lexical_search.ranked(table([(1, None)]), one).count() == 0


def test_blocks_of_queries_give_the_same(table, spark, monkeypatch):
    rows = [(k, " ".join(prose(k, 30, 60))) for k in range(40)]
    queries = [(k % 5, " ".join(prose(50 + k, 6, 60))) for k in range(12)]
    asked = spark.createDataFrame(queries, "item_id long, text string")
    whole = shown(lexical_search.ranked(table(rows), asked, k=5), "item_id", "rank", "doc_id", "score")
    monkeypatch.setattr(lexical_search, "BLOCK_QUERIES", 2)
    assert shown(lexical_search.ranked(table(rows), asked, k=5), "item_id", "rank", "doc_id", "score") == whole


def test_best_positions_stop_before_the_end_and_meet_all_ties():
    draw = np.random.default_rng(3)
    n = 5000
    terms = np.repeat([0, 1, 2], n)
    docs = np.concatenate([draw.permutation(n) for _ in range(3)])
    impacts = (1e6 / (1 + np.arange(n) % 1000)).astype(np.int64)
    impacts = np.concatenate([impacts] * 3)
    lists = lexical_search.Lists(terms, docs, impacts, 3, n)
    total = np.bincount(docs, weights=impacts, minlength=n).astype(np.int64)
    met, scores, depth = lexical_search.best_positions(lists, np.array([0, 1, 2]), 10, 0, step=16)
    assert depth < n and (total[met] == scores).all()
    kth = np.sort(total)[-10]
    assert set(np.flatnonzero(total >= kth)) <= set(met.tolist())


# -- alignment of two tokenizers ---------------------------------------------------------

BYTES, PIECES = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
PARTS = [
    "a", "b", "the", " ", "  ", "\n", "\n\n", "\t", "é", "ñ", "\xa0", " ", "　", "中", "文", "🎉", "ﬁ", "é",
    "<s>", "<|endoftext|>", "<0x0A>", "▁", "'s", "1", "23", ".", "!!", "\r\n", "\x85", "\x00", "\x1c", "Ω", "’", "﻿", "\x7f",
]


def plain_alignment(text):
    """Groups of ids and link counts of whole texts encoded at once, or None."""
    a, b = token_alignment.pair_of(BYTES, PIECES).sides
    if not text:
        return None
    ids, data = (a.encode(" " + text), b.model.encode(text)), (" " + text).encode()
    if any(b"".join(side.pieces[k] for k in own) != data for side, own in zip((a, b), ids)):
        return None
    ends = [list(np.cumsum([len(side.pieces[k]) for k in own])) for side, own in zip((a, b), ids)]
    groups, left, right = [], 0, 0
    for stop in sorted(set(ends[0]) & set(ends[1])):
        i, j = ends[0].index(stop) + 1, ends[1].index(stop) + 1
        groups.append((ids[0][left:i], ids[1][right:j]))
        left, right = i, j
    return groups


def plain_rows(rows):
    found = [(key, plain_alignment(text)) for key, text in rows]
    links = [Counter((p, q) for g in groups or [] for p in g[0] for q in g[1]) for _, groups in found]
    count = Counter(pair for own in links for pair in own)
    most = {}
    for (p, _), n in count.items():
        most[p] = max(most.get(p, 0), n)
    out = []
    for (key, groups), own in zip(found, links):
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups or [])
        out.append((
            key, sum(len(g) for g, _ in groups or []), sum(len(h) for _, h in groups or []), len(groups or []),
            sum(own.values()), sum(n for pair, n in own.items() if count[pair] == most[pair[0]]),
            sum(n * count[pair] for pair, n in own.items()),
            hashlib.sha256(said.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def odd_texts(n, seed=1):
    draw = random.Random(seed)
    found = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 30))) for _ in range(n)]
    return found + [None, "", " ", "\n", " a", "a ", " \n ", "word\n\nword", "  two  spaces  "]


@pytest.mark.parametrize("shipped", [token_alignment.SHIPPED_PAIRS, 0])
def test_alignment_equals_whole_texts_encoded_at_once(table, shipped):
    rows = list(enumerate(odd_texts(250) + [" ".join(prose(k, 80)) + ".\n" for k in range(30)]))
    rows += [(4, rows[4][1]), (None, "the end."), (7, "the end.")]
    found = token_alignment.aligned_tokens(table(rows), BYTES, PIECES, shipped_pairs=shipped)
    assert shown(found, *COLUMNS) == plain_rows(rows)


def test_long_texts_go_over_several_runs(monkeypatch):
    monkeypatch.setattr(token_alignment, "RUN_BYTES", 40)
    texts = odd_texts(200, seed=2) + [" ".join(prose(1, 300)), "x" * 500]
    found = token_alignment.align(pa.array(texts, pa.string()), token_alignment.pair_of(BYTES, PIECES))
    for text, own in zip(texts, found):
        groups = plain_alignment(text)
        assert (own.right and own.any) == (groups is not None)
        if groups is not None:
            said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
            assert own.said.hexdigest() == hashlib.sha256(said.encode()).hexdigest()


def test_groups_of_many_tokens_count_their_links(monkeypatch):
    monkeypatch.setattr(token_alignment, "GROUP_LINKS", 2)
    ids_a, of_a = np.array([5, 5, 6, 7, 5]), np.array([0, 0, 0, 1, 1])
    ids_b, of_b = np.array([1, 2, 1, 3]), np.array([0, 0, 0, 1])
    doc, code, times = token_alignment.linked_pairs(ids_a, of_a, ids_b, of_b, np.array([4, 4]), 10, 10)
    assert dict(zip(code.tolist(), times.tolist())) == {51: 4, 52: 2, 61: 2, 62: 1, 73: 1, 53: 1}
    assert (doc == 4).all()


def test_alignment_of_an_empty_table(table):
    empty = table([(1, "x")]).where("doc_id > 1")
    assert token_alignment.aligned_tokens(empty, BYTES, PIECES).count() == 0
