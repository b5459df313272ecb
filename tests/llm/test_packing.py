"""Tokens and packing: exact round trips, bounds, and the fit itself."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from caseloom.llm import packing, pattern_packing, token_output
from caseloom.llm import tokens as tk

from .conftest import ODD, prose


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tk.vocabulary())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_library_s(library, monkeypatch):
    texts = [t for _, t in ODD] + [
        "Don't STOP, it's 3.14 o'clock... (really?)", "\u0130stanbul \u03a3\u0391\u03a3 \ufb01 \u212b", "a<|endoftext|>b <|startoftext|>",
        "\u0301 a\u0301 \u00a0x\u2003y\u200bz \x00 \x85", "'s 't 're. end.' .,., a.. b,. '.", None, "\U0001f468\u200d\U0001f469\u200d\U0001f467 \u00bd\u00b2",
    ]
    monkeypatch.setattr(tk, "CACHE", 500)  # forgets in between
    encoder = tk.Encoder(tk.vocabulary())
    for part in (texts, texts[::-1], texts[:3]):
        ids, first = encoder.encode(pa.array(part, pa.string()))
        assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [ids_of(library, t) for t in part]


def lengths_of(seed, n, capacity):
    draw = random.Random(seed)
    return [min(capacity, int(draw.lognormvariate(6, 1.2)) + 1) for _ in range(n)]


@pytest.mark.parametrize("pack", [packing.pack_best_fit, packing.pack_patterns])
@pytest.mark.parametrize("lengths", [
    [], [4096], [1] * 5000, [2048] * 7, [4095, 1, 1], [2049] * 9, [1365] * 30, lengths_of(1, 3000, 4096), list(range(1, 4097)),
])
def test_packing_is_whole_and_tight(pack, lengths):
    found = pack(lengths, 4096)
    assert sorted(p for s in found for p in s) == list(range(len(lengths)))
    assert all(0 < sum(lengths[p] for p in s) <= 4096 for s in found)
    least = max(math.ceil(sum(lengths) / 4096), sum(n > 2048 for n in lengths))
    assert len(found) <= least * 1.01 + 1


def test_best_fit_takes_the_tightest():
    draw = random.Random(3)
    lengths = [draw.randint(1, 100) for _ in range(400)]
    plain: list[list[int]] = []
    for p in sorted(range(400), key=lambda p: -lengths[p]):
        space = [(100 - sum(lengths[q] for q in s), k) for k, s in enumerate(plain)]
        fits = [x for x in space if x[0] >= lengths[p]]
        if fits:
            plain[min(fits)[1]].append(p)
        else:
            plain.append([p])
    assert len(packing.pack_best_fit(lengths, 100)) == len(plain)


def test_spaces():
    spaces = packing.Spaces(10)
    for space in (3, 7, 7, 10):
        spaces.add(space, f"s{space}")
    assert [spaces.tightest(k) for k in (0, 3, 4, 7, 8, 10)] == [3, 3, 7, 7, 10, 10]
    assert [spaces.widest(k) for k in (2, 3, 6, 9, 10)] == [None, 3, 3, 7, 10]
    assert spaces.take(10) == "s10" and spaces.tightest(8) is None


def test_patterns_fill_all_steps():
    found = packing.patterns(8, 3)
    assert all(sum(p) == 8 and len(p) <= 3 and list(p) == sorted(p, reverse=True) for p in found)
    assert len(found) == len(set(found)) == 1 + 4 + 5


def test_least_squares():
    rng = np.random.default_rng(5)
    for _ in range(10):
        a, want = rng.random((12, 6)), np.maximum(rng.normal(size=6), 0)
        assert np.allclose(packing.nonnegative_least_squares(a, a @ want), want, atol=1e-6)
        b = rng.normal(size=12)
        x = packing.nonnegative_least_squares(a, b)
        pull = a.T @ (b - a @ x)
        assert (x >= 0).all() and (pull[x == 0] <= 1e-6).all() and np.allclose(pull[x > 0], 0, atol=1e-6)


def test_pack_documents(table, library):
    rows = ODD + [(900 + k, " ".join(prose(k, k * 7))) for k in range(60)]
    found = pattern_packing.pack_documents(table(rows), tk.vocabulary(), group_pieces=30).collect()
    want = []
    for key, text in rows:
        ids = np.array([*ids_of(library, text), 1], "<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want.append((key, k, at, len(part), zlib.crc32(part.tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    check_places([(r.sequence_id, r.offset, r.length) for r in found], 4096)
    assert pattern_packing.pack_documents(table([]), tk.vocabulary()).collect() == []


def check_places(rows, capacity):
    ends: dict[int, int] = {}
    for sequence, offset, length in sorted(rows):
        assert offset == ends.get(sequence, 0)
        ends[sequence] = offset + length
    assert max(ends.values()) <= capacity


def test_packed_sequences(table, library, monkeypatch):
    rows = ODD + [(900 + k, " ".join(prose(k, k * 7))) for k in range(60)]
    layout = token_output.Layout(capacity=512)
    packed = token_output.packed_sequences(table(rows), tk.vocabulary(), layout=layout).persist()
    pieces = token_output.unpack(packed).collect()
    check_places([(r.sequence_id, r.offset, r.length) for r in pieces], 512)
    matrix = {r.sequence_id: r for r in packed.collect()}
    parts: dict = {}
    for r in pieces:
        ids = np.frombuffer(matrix[r.sequence_id].ids, "<u2")[r.offset : r.offset + r.length]
        positions = np.frombuffer(matrix[r.sequence_id].position_ids, "<u2")[r.offset : r.offset + r.length]
        assert positions.tolist() == list(range(r.length))
        parts.setdefault(r.doc_id, []).append((r.start, r.piece, ids.tolist()))
    # Documents whose key is theirs alone come back id by id.
    alone = [key for key, _ in rows if sum(key == other for other, _ in rows) == 1]
    text = dict(rows)
    for key in alone:
        own = sorted(parts[key])
        assert [k for _, k, _ in own] == list(range(len(own)))
        assert [x for _, _, ids in own for x in ids] == [*ids_of(library, text[key]), layout.end_id]
    total = sum(len(ids_of(library, t)) + 1 for _, t in rows)
    assert sum(r.n_tokens for r in matrix.values()) == total
    for r in matrix.values():
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and len(r.ids) == 1024
        assert set(np.frombuffer(r.ids, "<u2")[r.n_tokens :].tolist()) <= {layout.pad_id}
    packed.unpersist()
    assert token_output.packed_sequences(table([]), tk.vocabulary()).collect() == []
