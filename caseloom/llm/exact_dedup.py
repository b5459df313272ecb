"""Exact deduplication that no large group of copies can slow down.

1. Every text gets a digest; digests that stand for very many rows are found. There
   are at most ``1 / HOT_SHARE`` of them, so that list may be broadcast.
2. Rows are grouped by digest, salt *and* content. Spark combines within each task
   before anything is shuffled; a hot digest is spread over ``SALTS`` groups, any other
   has one.
3. The winners of the salted groups are combined by digest and content again.
4. Every document learns its group from its digest. A digest that turned out to stand
   for two contents is resolved by content instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import BLANKS, fan_out
from caseloom.storage import settle

SALTS = 64
#: A digest is hot from this share of all rows, and this many rows, on.
HOT_SHARE, HOT_ROWS = 0.001, 1000
NO_ID = -(1 << 63)


def normal_text(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    *,
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
    hot_share: float = HOT_SHARE,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: ``key, keep_id, group_size, kept, digest``.

    Of rows with equal text (after ``normal_text``) the one with the smallest key stays.
    A null key counts as smaller than any other, and a kept one has a null ``keep_id``.
    Of rows that repeat key and text one is kept. Null texts are empty texts, and an
    empty table gives an empty result. Other columns are neither read nor returned.
    """
    work = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"),
        normal_text(F.col(text)).alias("content"),
    ).select("id", "content", digest(F.col("content")).alias("digest"))
    members = settle(work.select("id", "digest"), "members")

    rows = members.count()
    many = max(hot_rows, int(rows * hot_share))
    counts = members.groupBy("digest").agg(F.count("*").alias("n"))
    hot = settle(counts.where(F.col("n") > many).select("digest", F.lit(True).alias("hot")), "hot")

    def salted(df: DataFrame) -> DataFrame:
        salt = F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
        return df.join(F.broadcast(hot), "digest", "left").withColumn(
            "salt", F.coalesce(salt, F.lit(-1))
        )

    merged = salted(work).groupBy("digest", "salt", "content").agg(
        F.min("id").alias("winner"), F.count("*").alias("n")
    )
    # Only the contents of hot digests are compared once more, so only they are kept.
    merged = settle(
        merged.withColumn("content", F.when(F.col("salt") >= 0, F.col("content"))), "salted"
    )
    least = [F.min("winner").alias("winner"), F.sum("n").alias("n")]
    warm = merged.where("salt >= 0").groupBy("digest", "content").agg(*least)
    groups = merged.where("salt < 0").select("digest", "salt", "winner", "n").unionByName(
        fan_out(warm.select("digest", "winner", "n"), "salt", salts)
    )
    contents = merged.where("salt < 0").select("digest").unionByName(warm.select("digest"))
    clashes = settle(
        contents.groupBy("digest").count().where("count > 1").select("digest"), "clashes"
    )

    # Repeated rows travel as one with a count, then get their lines back.
    told = members.groupBy("id", "digest").agg(F.count("*").alias("times"))
    clash = not clashes.isEmpty()
    if clash:
        told = told.join(clashes, "digest", "left_anti")
    found = salted(told).join(groups, ["digest", "salt"]).select(
        "id", "digest", "times", "winner", "n"
    )
    if clash:
        alike = work.join(clashes, "digest", "left_semi")
        best = alike.groupBy("digest", "content").agg(
            F.min("id").alias("winner"), F.count("*").alias("n")
        )
        again = alike.groupBy("id", "digest", "content").agg(F.count("*").alias("times"))
        found = found.unionByName(
            again.join(best, ["digest", "content"]).select("id", "digest", "times", "winner", "n")
        )

    def shown(name: str) -> Column:
        return F.when(F.col(name) != NO_ID, F.col(name))

    return found.select(
        "*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("line")
    ).select(
        shown("id").alias(key),
        shown("winner").alias("keep_id"),
        F.col("n").alias("group_size"),
        ((F.col("id") == F.col("winner")) & (F.col("line") == 1)).alias("kept"),
        "digest",
    )


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, all columns; keys must identify rows."""
    kept = exact_groups(docs, key, text, **options).where("kept").select(F.col(key).alias("_kept"))
    return docs.join(kept, docs[key].eqNullSafe(kept["_kept"]), "left_semi")
