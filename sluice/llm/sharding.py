"""Operator 8: shards of bounded size by extendible hashing.

A bucket is a prefix of the key's hash. The directory starts with one bucket;
a bucket over the byte limit, and only such a one, splits on its next bit.
Since a bucket's bytes are the sum of those of the buckets under it, the shard
of a row is its shortest prefix whose bucket fits, which one aggregation over
fine prefixes gives for all buckets at once. The directory stays a table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.store import col, stage

KEY_BITS = 60
#: Bits that a pass looks beyond those an even spread would need.
SLACK_BITS = 4


def _hash60(text: str) -> str:
    return f"cast(conv(substr(md5({text}), 1, 15), 16, 10) as long)"


def _prefix(bits: int) -> list[str]:
    """The first ``bits`` of a row's 120 bits, as two numbers."""
    key, more = min(bits, KEY_BITS), max(bits - KEY_BITS, 0)
    return [
        f"shiftright(h, {KEY_BITS - key}) AS prefix",
        (f"shiftright(g, {KEY_BITS - more})" if more else "0L") + " AS overflow",
    ]


def _cut(end: int) -> list[str]:
    """The first ``depth`` bits of a prefix of ``end`` bits."""
    key, more = min(end, KEY_BITS), max(end - KEY_BITS, 0)
    return [
        f"shiftright(prefix, {key} - least(depth, {KEY_BITS})) AS p",
        f"if(depth <= {KEY_BITS}, 0L, shiftright(overflow, {more + KEY_BITS} - depth)) AS o",
    ]


def shard(
    docs: DataFrame,
    max_bytes: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All rows and columns of ``docs`` plus their shard: ``depth`` (bits of the
    hash), ``prefix`` (those bits), ``overflow`` (bits beyond the key's 60),
    ``n_bytes`` (of the row's text, UTF-8) and ``shard_bytes``.

    Each shard is of at most ``max_bytes`` or holds one row, or several that
    are alike in id and text, which no hash can part. Rows of one key that
    alone exceed the limit part by the hash of their text. Null and empty
    texts are of 0 bytes; null ids are one key. Input columns named like the
    results are replaced. An empty input gives an empty result.
    """
    results = ("depth", "prefix", "overflow", "n_bytes", "shard_bytes")
    packed = docs.select(
        F.struct(*[col(c) for c in docs.columns if c not in results], F.lit(0).alias("_")).alias("row"),
        F.coalesce(col(id_col).cast("string"), F.lit("")).alias("id"),
        F.coalesce(col(text_col), F.lit("")).alias("text"),
    ).select(
        "row",
        F.expr(_hash60("id")).alias("h"),
        F.expr(_hash60("concat(id, '|', text)")).alias("g"),
        F.octet_length("text").cast("long").alias("n_bytes"),
    )
    narrow = stage(packed.select("h", "g", "n_bytes"), "sizes")
    total = narrow.agg(F.sum("n_bytes").alias("b")).head()["b"] or 0
    even = math.ceil(math.log2(max(total / max_bytes, 1)))

    directories: list[tuple[int, DataFrame]] = []
    begin, end, active = 0, min(even + SLACK_BITS, 2 * KEY_BITS), narrow
    while not active.isEmpty():
        leaves = (
            active.selectExpr("n_bytes", *_prefix(end)).groupBy("prefix", "overflow")
            .agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n"))
        )
        ladder = leaves.selectExpr("*", f"explode(sequence({begin}, {end})) AS depth").selectExpr(
            "prefix", "overflow", "bytes", "n", "depth", *_cut(end)
        )
        fits = (
            ladder.groupBy("depth", "p", "o").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("rows"))
            .where(f"shard_bytes <= {max_bytes} OR rows = 1 OR depth = {2 * KEY_BITS}")
        )
        found = (
            ladder.join(fits.drop("rows"), ["depth", "p", "o"])
            .groupBy("prefix", "overflow")
            .agg(F.min(F.struct("depth", "p", "o", "shard_bytes")).alias("shard"))
        )
        directory = stage(found, "directory")
        directories.append((end, directory))
        keyed = active.selectExpr("*", *_prefix(end))
        left = keyed.join(directory, ["prefix", "overflow"], "left_anti")
        active = stage(left.select("h", "g", "n_bytes"), "oversized")
        begin, end = end + 1, min(end + 8, 2 * KEY_BITS)

    kind = "struct<depth:int,p:bigint,o:bigint,shard_bytes:bigint>"
    out = packed.withColumn("shard", F.lit(None).cast(kind))
    for bits, directory in directories:
        here = directory.withColumnRenamed("shard", "found")
        joined = out.selectExpr("*", *_prefix(bits)).join(here, ["prefix", "overflow"], "left")
        out = joined.select("row", "h", "g", "n_bytes", F.coalesce("shard", "found").alias("shard"))
    return out.select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns if c not in results],
        F.col("shard.depth").alias("depth"), F.col("shard.p").alias("prefix"), F.col("shard.o").alias("overflow"),
        "n_bytes", F.col("shard.shard_bytes").alias("shard_bytes"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, all rows of a shard in one file."""
    keys = ["depth", "prefix", "overflow"]
    sharded.repartition(*keys).write.partitionBy(*keys).parquet(path)
