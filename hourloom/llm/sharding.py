"""A uniform shuffle into shards of exact sizes, planned by a hypergeometric communication matrix."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.session import durable

#: Row blocks are input partitions, folded to this many at most; the matrix has one row for each block.
BLOCKS = 4096
#: Parts in which a shard is permuted.
PARTS = 64


def communication_matrix(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """How many rows each block sends to each shard, in a uniform shuffle with shard sizes at most one apart.

    Drawing a block's row without replacement from what the shards still have room for is the multivariate
    hypergeometric law; the room left carries over to the next block.
    """
    total, rng = sum(counts), np.random.default_rng(seed)
    room = np.full(shards, total // shards, np.int64)
    room[rng.permutation(shards)[: total % shards]] += 1
    sent = np.zeros((len(counts), shards), np.int64)
    for block, count in enumerate(counts):
        left = int(count)
        # one shard after the other: the marginal of the multivariate law
        after = int(room.sum())
        for shard in range(shards):
            after -= int(room[shard])
            take = left if not after else _draw(rng, int(room[shard]), after, left)
            sent[block, shard] = take
            left -= take
        room -= sent[block]
    return sent


def _draw(rng: np.random.Generator, good: int, bad: int, n: int, quick: int = 1_000_000_000) -> int:
    """Hypergeometric, of any size: how many of n rows drawn without replacement are good.

    numpy takes sums under 1e9. Beyond, the law is inverted: weights follow from the mode by the ratio of neighbours, which
    needs no logarithms of factorials, as far as twelve standard deviations and 60 rows to both sides; what lies outside
    weighs less than the last digit of the sum.
    """
    if not n or not good:
        return 0
    total = good + bad
    if total < quick:
        return int(rng.hypergeometric(good, bad, n))
    least, most = max(0, n - bad), min(n, good)
    mode = min(max((n + 1) * (good + 1) // (total + 2), least), most)
    reach = 60 + int(12 * (n * (good / total) * (bad / total) * ((total - n) / (total - 1))) ** 0.5)
    low, high = max(least, mode - reach), min(most, mode + reach)
    up, down = np.arange(mode, high, dtype=float), np.arange(mode, low, -1, dtype=float)
    after = np.cumprod((good - up) * (n - up) / ((up + 1) * (bad - n + up + 1)))
    before = np.cumprod(down * (bad - n + down) / ((good - down + 1) * (n - down + 1)))
    odds = np.cumsum(np.concatenate([before[::-1], [1.0], after]))
    return low + min(int(np.searchsorted(odds, rng.random() * odds[-1], side="right")), len(odds) - 1)


def shuffle_into_shards(docs: DataFrame, shards: int = 40, seed: int = 1) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row; shard sizes are at most one row apart.

    Rows are numbered by block (input partition) and written once, so a lost task finds the same numbers again.
    Blocks permute their rows, cut them by the communication matrix and exchange them; each shard is then permuted
    again, in parts whose sizes give the first slot of each part. Only counts per block and per part, at most
    4,096 and 64 per shard, reach the driver. Equal texts or ids are rows like all others: nothing is grouped by
    content, so no key is hot. Null text has 0 bytes and crc 0; null ids and repeated rows are kept as they are.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    spark = docs.sparkSession
    binary = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = durable(
        docs.select(
            "doc_id", (F.octet_length(binary) + 16).cast("long").alias("size"), F.crc32(binary).alias("text_crc32"),
            F.pmod(F.spark_partition_id(), F.lit(BLOCKS)).alias("block"), F.monotonically_increasing_id().alias("row"),
        )
    )
    counts = {r["block"]: r["count"] for r in rows.groupBy("block").count().collect()}
    blocks = sorted(counts)
    sent = communication_matrix([counts[b] for b in blocks], shards, seed)
    cuts = spark.createDataFrame([(b, c.tolist()) for b, c in zip(blocks, sent.cumsum(axis=1))], "block int, cuts array<long>")
    local = F.row_number().over(Window.partitionBy("block").orderBy(F.xxhash64("row", F.lit(seed)), "row")) - 1
    routed = (
        rows.withColumn("rank", local)
        .join(F.broadcast(cuts), "block")
        .withColumn("shard", F.expr("cast(size(filter(cuts, c -> c <= rank)) AS int)"))
        .withColumn("order", F.xxhash64("row", F.lit(seed), F.lit("shard")))
        .withColumn("part", F.pmod(F.shiftrightunsigned("order", 40), F.lit(PARTS)).cast("int"))
        .select("doc_id", "size", "text_crc32", "shard", "part", "order", "row")
    )
    routed = durable(routed)
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = routed.groupBy("shard", "part").count().select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    again = F.row_number().over(Window.partitionBy("shard", "part").orderBy("order", "row")) - 1
    return (
        routed.withColumn("within", again)
        .join(F.broadcast(firsts), ["shard", "part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("within")).cast("long").alias("slot"))
    )
