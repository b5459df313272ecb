"""Very many short texts, crafted keys and clashing names."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from caseloom.llm import line_dedup, sharding, toxicity
from caseloom.llm.common import unused
from caseloom.llm.near_dedup import REGISTERS
from caseloom.llm.tokens import encoder, vocabulary
from caseloom.llm.words import CHUNK_BYTES, ROW_BYTES, chunks


@pytest.mark.parametrize("word", [None, "", "word"])
def test_a_million_short_texts_make_bounded_tables(word):
    texts = pa.repeat(pa.scalar(word, pa.string()), 1_000_000)
    batches = pa.table({"text": texts}).to_batches(max_chunksize=10_000)
    for cost in (ROW_BYTES, 4 * REGISTERS):
        sizes = [t.num_rows for t in chunks(iter(batches), "text", row_bytes=cost)]
        assert sum(sizes) == 1_000_000 and max(sizes) <= CHUNK_BYTES // cost


def test_perfect_hash_of_keys_that_share_a_half():
    keys = np.array([[5, 1], [5, 2], [7, 2], [7, 1], [5, 7]], np.uint64)
    keys = np.concatenate([keys, np.stack([np.full(2000, 9), np.arange(2000)], axis=1).astype(np.uint64)])
    function = line_dedup.PerfectHash.build(keys)
    assert sorted(function.number(keys).tolist()) == list(range(len(keys)))


def test_perfect_hash_refuses_repeated_keys():
    with pytest.raises(ValueError, match="distinct"):
        line_dedup.PerfectHash.build(np.array([5, 5, 7], np.uint64))


def test_names_in_use_are_avoided():
    assert unused("_rank", ["a"]) == "_rank"
    assert unused("_rank", ["_RANK", "__rank"]) == "___rank"


def test_sharding_keeps_columns_of_any_name(spark):
    rows = [(k, k * 2, k * 3, "x", k) for k in range(50)]
    df = spark.createDataFrame(rows, "id long, _rank long, _block long, _first string, _rows long")
    plain = sharding.shard_by_key(df.select("id"), "id", 4).orderBy("id").collect()
    found = sharding.shard_by_key(df, "id", 4).orderBy("id").collect()
    assert [(r.id, r._rank, r._block, r._first, r._rows) for r in found] == rows
    assert [(r.shard, r.slot, r.grown_shard) for r in found] == [(r.shard, r.slot, r.grown_shard) for r in plain]


def test_clean_rows_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([("a text", 1, 2.0), (None, 3, 4.0)], "text string, _score long, _distance double")
    model = toxicity.fit([])
    found = toxicity.clean_rows(df, model)
    assert found.columns == df.columns and sorted(found.collect(), key=repr) == sorted(df.collect(), key=repr)


def test_encoder_with_a_small_memory_equals_whole_texts(monkeypatch):
    from caseloom.llm import tokens

    own = tokens.Encoder(vocabulary())
    monkeypatch.setattr(tokens, "CACHE", 5)
    texts = ["Don't stop, now. É. ﬁ, <|endoftext|>.", "", None, "a. A, 1. .. x", "İ ŁÓ ß 中文. K"]
    for _ in range(2):
        ids, first = own.encode_ended(pa.array(texts), 1)
        for k, text in enumerate(texts):
            want = own.tokenizer.encode(text or "", add_special_tokens=False).ids
            assert ids[first[k] : first[k + 1]].tolist() == [*want, 1]


def test_encoder_is_shared_within_a_process():
    assert encoder(vocabulary()) is encoder(vocabulary())
