"""Sharding by jump consistent hashing.

A key walks over the shard counts 1, 2, 3, ...: a generator seeded by the key says at
which count it next moves, and always into the newest shard. Its shard among ``n`` is
the last place before the walk passes ``n``, so no ring table is kept and one more
shard takes rows only into itself. The generator is the usual 64-bit linear
congruential one; products are built from 16-bit limbs, which cannot overflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from caseloom.llm.common import unused

# Multiplier and increment of the generator.
MULTIPLIER, INCREMENT = 2862933555777941757, 1

#: Rows of a shard are numbered in so many independent blocks.
BLOCKS = 256


def _next(state: Column) -> Column:
    """``state * MULTIPLIER + INCREMENT`` modulo 2**64."""
    mask = F.lit(0xFFFF).cast("long")
    a = [F.shiftrightunsigned(state, 16 * i).bitwiseAND(mask) for i in range(4)]
    c = [(MULTIPLIER >> 16 * i) & 0xFFFF for i in range(4)]
    carry, out = F.lit(INCREMENT).cast("long"), F.lit(0).cast("long")
    for k in range(4):
        total = carry
        for i in range(k + 1):
            total = total + a[i] * F.lit(c[k - i]).cast("long")
        out = out.bitwiseOR(F.shiftleft(total.bitwiseAND(mask), 16 * k))
        carry = F.shiftrightunsigned(total, 16)
    return out


def key_number(df: DataFrame, key: str) -> Column:
    """The 64-bit number of a key: an integer itself, anything else its hash; null counts as 0."""
    integral = isinstance(df.schema[key].dataType, T.IntegralType)
    number = F.col(key).cast("long") if integral else F.xxhash64(key)
    return F.coalesce(number, F.lit(0).cast("long"))


def jump_shard(number: Column, n_shards: int) -> Column:
    """The shard, 0 to ``n_shards - 1``, of a 64-bit key number.

    Every step moves on by one at least, so ``n_shards`` steps always suffice; a
    finished walk passes the remaining ones unchanged.
    """
    if n_shards < 1:
        raise ValueError("there must be a shard")
    zero = F.lit(0).cast("long")
    start = F.struct(number.alias("state"), zero.alias("at"), zero.alias("next"))

    def step(walk: Column, _: Column) -> Column:
        return F.when(walk["next"] >= n_shards, walk).otherwise(
            F.transform(
                F.array(_next(walk["state"])),
                lambda state: F.struct(
                    state.alias("state"),
                    walk["next"].alias("at"),
                    F.floor(
                        (walk["next"] + 1).cast("double")
                        * (F.lit(2147483648.0) / (F.shiftrightunsigned(state, 33) + 1).cast("double"))
                    ).alias("next"),
                ),
            )[0]
        )

    steps = F.sequence(F.lit(1), F.lit(n_shards))
    return F.aggregate(steps, start, step, lambda walk: walk["at"].cast("int"))


def block_of(number: Column, blocks: int) -> Column:
    """A block from the upper bits of the generator's first number."""
    return F.pmod(F.shiftrightunsigned(_next(number), 33), F.lit(blocks)).cast("int")


def shard_by_key(df: DataFrame, key: str, n_shards: int, *, blocks: int = BLOCKS) -> DataFrame:
    """``df`` with ``shard``, ``slot`` and ``grown_shard``.

    ``slot`` numbers the rows of a shard from 0 without a gap. A shard's rows are
    ranked in ``blocks`` blocks, each by key, and a block begins where the ones before
    it end; only ``n_shards * blocks`` counts are gathered for that, which is also the
    bound of what is broadcast. ``grown_shard`` is the shard among one more.

    Null keys share key number 0; repeated keys share shard and block and get slots of
    their own; an empty table stays empty. Columns of ``df`` named like the three new
    ones are replaced.
    """
    number = key_number(df, key)
    block, rows, first, rank = (unused(name, df.columns) for name in ("_block", "_rows", "_first", "_rank"))
    placed = df.drop("shard", "slot", "grown_shard").select(
        "*",
        jump_shard(number, n_shards).alias("shard"),
        jump_shard(number, n_shards + 1).alias("grown_shard"),
        block_of(number, blocks).alias(block),
    )
    sizes = placed.groupBy("shard", block).agg(F.count("*").alias(rows))
    before = Window.partitionBy("shard").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(
        "shard", block, F.coalesce(F.sum(rows).over(before), F.lit(0)).alias(first)
    )
    ranked = F.row_number().over(Window.partitionBy("shard", block).orderBy(key))
    return (
        placed.withColumn(rank, ranked)
        .join(F.broadcast(firsts), ["shard", block])
        .withColumn("slot", F.col(first) + F.col(rank) - 1)
        .drop(rank, first, block)
    )
