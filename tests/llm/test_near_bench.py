"""Near-duplicate classes and benchmark overlaps against brute force."""

from __future__ import annotations

import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from caseloom.llm import decontamination as dc
from caseloom.llm import near_dedup as nd
from caseloom.llm.words import Tokens

from .conftest import ODD, prose


def changed(words, share, seed):
    draw = random.Random(seed)
    return [f"new{seed}x{k}" if draw.random() < share else w for k, w in enumerate(words)]


def plain_similarity(a, b):
    """Probability Jaccard straight from its definition, on counted shingles."""
    total = 0.0
    for i in a.keys() & b.keys():
        total += 1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys())
    return total


def shingled(text):
    words = [w for w in ("".join(c for c in w if c.isalnum()) for w in (text or "").lower().split()) if w]
    if not words:
        return Counter()
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def brute_classes(rows):
    bags = [shingled(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if bags[a] and bags[b] and (rows[a] == rows[b] or plain_similarity(bags[a], bags[b]) >= 0.8):
            parent[root(a)] = root(b)
    low = -(1 << 63)
    keys = [low if key is None else key for key, _ in rows]
    least = {}
    for k in range(len(rows)):
        least[root(k)] = min(least.get(root(k), keys[k]), keys[k])
    return sorted(
        ((key, None if least[root(k)] == low else least[root(k)]) for k, (key, _) in enumerate(rows)), key=repr
    )


@pytest.mark.parametrize("block_rows", [4096, 4])
def test_classes(table, block_rows):
    """Families around a document, chains, copies, and rows of all odd kinds."""
    rows = [r for r in ODD if r[0] != 10]
    for family in range(3):
        words = prose(20 + family, 90)
        rows += [(1000 * (family + 1) + k, " ".join(changed(words, 0.008 * (k % 5), 31 * family + k))) for k in range(14)]
    rows += [(5000 + k, " ".join(prose(40, 160)[10 * k : 10 * k + 100])) for k in range(5)]
    found = nd.near_duplicates(table(rows), block_rows=block_rows).collect()
    assert sorted(((r.doc_id, r.class_id) for r in found), key=repr) == brute_classes(rows)
    assert sum(r.kept for r in found) >= len({r.class_id for r in found})


def test_one_of_each_class(table):
    words = prose(3, 100)
    rows = [(2, " ".join(words)), (1, " ".join([*words[:50], "other", *words[51:]])), (4, "alone in its class"), (None, None), (9, "")]
    left = nd.one_of_each_class(table(rows))
    assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((r.doc_id for r in left.collect()), key=repr) == [1, 4, 9, None]


def test_similarity_is_probability_jaccard():
    draw = random.Random(1)
    for _ in range(30):
        a = Counter(draw.choices(range(12), k=draw.randint(1, 20)))
        b = Counter(draw.choices(range(12), k=draw.randint(1, 20)))
        x, y = (np.array(sorted(c.items()), np.uint64).T for c in (a, b))
        assert nd.probability_jaccard(x[0], x[1].astype(int), y[0], y[1].astype(int)) == pytest.approx(plain_similarity(a, b))


def test_signatures_estimate_it():
    """Agreement of registers over many seeds is close to the similarity of weighted sets."""
    a, b = {1: 5, 2: 1, 3: 2}, {1: 4, 3: 2, 4: 3}
    agreed, trials = 0, 60
    for seed in range(trials):
        pairs = [(k * 1_000_003 + seed * 7919, w, t) for t, bag in enumerate((a, b)) for k, w in bag.items()]
        values, text, weights = (np.array(x) for x in zip(*[(v, t, w) for v, w, t in pairs]))
        signature = nd.signatures(nd.mixed(values.astype(np.uint64)), text, weights, 2)
        agreed += (signature[0] == signature[1]).mean()
    assert agreed / trials == pytest.approx(plain_similarity(a, b), abs=0.03)


PLACE = pa.schema([
    ("node", pa.binary()), ("label", pa.binary()), ("side", pa.int32()), ("pivot", pa.float64()), ("bucket", pa.int64()),
    ("bands", pa.list_(pa.int64())), ("elements", pa.binary()), ("weights", pa.binary()),
])


def place_rows(n, seed, weighted):
    """Rows near one of three sets of elements, some of them in one component already."""
    rng = np.random.default_rng(seed)
    bags = []
    for k in range(n):
        values = np.arange(60) + 1000 * (k % 3)
        values[rng.integers(0, 60, rng.integers(0, 9))] += 100 + 10 * k
        values = np.unique(values).astype(np.uint64)
        weights = 1 + (values % np.uint64(4) == 0) * weighted
        weights[rng.integers(0, len(weights), 2)] += weighted
        bags.append((values, weights.astype(np.int32)))
    rows = [
        {"node": bytes([k]), "label": bytes([k if k % 5 else 0]), "side": 0, "pivot": 1.0, "bucket": 7, "bands": [7] * nd.BANDS,
         "elements": v.tobytes(), "weights": w.tobytes()}
        for k, (v, w) in enumerate(bags)
    ]
    return rows, bags


def joined(rows, pairs):
    """The components of rows by their labels and further pairs, as a set of sets of nodes."""
    label = {r["node"]: r["label"] for r in rows}
    for a, b in pairs:
        old, new = label[a], label[b]
        label = {k: new if v == old else v for k, v in label.items()}
    groups = {}
    for node, name in label.items():
        groups.setdefault(name, set()).add(node)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("weighted", [False, True])
def test_places_and_their_blocks_join_what_all_links_join(weighted):
    rows, bags = place_rows(40, 2, weighted)
    all_links = [
        (rows[i]["node"], rows[j]["node"]) for i in range(40) for j in range(i)
        if nd.probability_jaccard(*bags[i], *bags[j]) >= 0.8
    ]
    want = joined(rows, all_links)
    assert len(want) < len(joined(rows, []))
    whole = list(nd._Place(pa.Table.from_pylist(rows, PLACE)).links(0.8))
    assert joined(rows, whole) == want and len(whole) < len(rows) and set(map(frozenset, whole)) <= set(map(frozenset, all_links))
    halves = [[r | {"side": s} for r in rows if r["node"][0] % 2 == s] for s in (0, 1)]
    parts = list(nd._Place(pa.Table.from_pylist(halves[0] + halves[1], PLACE)).links(0.8))
    for half in halves:
        parts += nd._Place(pa.Table.from_pylist([r | {"side": 0} for r in half], PLACE)).links(0.8)
    assert joined(rows, parts) == want


def test_empty_table(table):
    assert nd.near_duplicates(table([])).collect() == []


# -- benchmark --------------------------------------------------------------------------


@pytest.mark.parametrize("n", range(dc.SHORT, dc.WINDOW + 1))
def test_masks_hit_every_tolerated_overlap(n):
    for wrong in itertools.combinations(range(n), dc.substitutions(n)):
        bad = set(wrong)
        assert any(
            not bad & {at + place for place in mask} for mask in dc.MASKS for at in range(n - mask[-1])
        ), wrong


@pytest.mark.parametrize("n", range(dc.WHOLE, dc.SHORT))
def test_triples_hit_every_short_overlap(n):
    for wrong in itertools.combinations(range(n), dc.substitutions(n)):
        assert any(not set(wrong) & {k, k + 1, k + 2} for k in range(n - 2))


def brute_overlaps(rows, items):
    out = {}
    for key, text in rows:
        doc = Tokens(pa.array([text], pa.string())).hashes
        for item_id, item_text in items:
            item = Tokens(pa.array([item_text], pa.string())).hashes
            for shift in range(-len(item) + 1, len(doc)):
                found = dc.best_window(doc, item, shift) if len(item) else None
                if found:
                    out[key, item_id] = max(out.get((key, item_id), 0), found[3])
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_overlaps(spark, table, block_bytes):
    items = [(k, " ".join(prose(60 + k, n))) for k, n in enumerate((40, 14, 9, 6, 4, 25, 33))]
    items += [(90, None), (91, ""), (92, "... !"), (93, " ".join(prose(60, 30)))]
    rows, draw = [(k, t) for k, t in ODD if k != 10], random.Random(8)
    for k in range(50):
        _, passage = items[draw.randrange(7)]
        some = passage.split()[draw.randint(0, 3) :]
        inside = changed(some, draw.choice([0, 0.1, 0.2, 0.3]), k)
        rows.append((700 + k, " ".join(prose(k, 20) + [w.title() + "," for w in inside] + prose(k + 99, 9))))
    bench = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, id int")
    found = dc.overlaps(table(rows), bench, block_bytes=block_bytes).collect()
    got = {(r.doc_id, r.item_id): r.n_equal for r in found}
    assert got == brute_overlaps(rows, items) and len(found) == len(got) > 20


def test_clean_documents(spark, table):
    item = " ".join(prose(1, 20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = dc.clean_documents(table([(1, f"x {item} y"), (2, "fine"), (None, None), (None, item), (3, "")]), bench)
    assert sorted(r.doc_id for r in left.collect()) == [2, 3] and "source" in left.columns
    assert dc.overlaps(table(ODD), bench.where("false")).collect() == []
    assert dc.overlaps(table([]), bench).collect() == []
