"""Exact duplicates: local combining, salted groups, then one winner of all salts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import ascii_lower, own_name
from hourloom.session import durable

#: Tasks over which the copies of one text are spread, when winners are merged and when they are looked up.
SALTS = 16


def _normalised(docs: DataFrame) -> DataFrame:
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    return docs.select("doc_id", text.alias("content")).withColumn("digest", F.sha2("content", 256))


def winners(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """(digest, keep_id, group_size) of every group of equal texts, letter case of A-Z aside.

    Each task first combines its own copies, then the copies of one text meet in up to ``salts`` tasks, and at last
    the winners of the salts meet. Every step groups by the digest and the whole content, so texts are equal only if
    they are the same; the digest only makes the comparison quick. A text never occurs more often in a shuffle than
    there are tasks or salts. Two different texts with one SHA-256 digest stop the job instead of being merged.
    """
    keys = ["digest", "content"]
    salted = _normalised(docs).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    merged = salted.groupBy(*keys, "salt").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    whole = merged.groupBy(*keys).agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    single = whole.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count(F.lit(1)).alias("texts"))
    clash = F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts have one digest"))).otherwise(F.col("group_size"))
    return single.select("digest", "keep_id", clash.cast("long").alias("group_size"))


def exact_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and empty texts are equal to each other. The largest doc_id of a group stays; null ids
    are smaller than all others, and a group of null ids keeps a null id. Rows that repeat the kept id and text are
    all marked kept (``drop_copies`` leaves one of them). An empty table gives no rows; further columns are ignored.
    """
    groups = winners(docs, salts).where("group_size > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = _normalised(docs).select("doc_id", "digest", F.pmod(F.hash("doc_id"), F.lit(salts)).alias("salt"))
    joined = rows.join(groups, ["digest", "salt"], "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of wholly repeated rows one stays.

    Groups are found on ids and digests; the whole rows move once, to meet the few ids that go.
    """
    groups = exact_groups(docs, salts).where("group_size > 1").groupBy("doc_id", "text_sha256", "kept").count().where("count > 1 OR NOT kept")
    other, digest, here = (own_name(docs, c) for c in ("_id", "_digest", "_here"))
    marks = durable(groups.select(F.col("doc_id").alias(other), F.col("text_sha256").alias(digest), "kept"))
    marked = docs.withColumn(here, F.sha2(ascii_lower(F.coalesce(F.col("text"), F.lit(""))), 256))
    same = F.col("doc_id").eqNullSafe(F.col(other)) & (F.col(here) == F.col(digest))
    stays = marked.join(marks.hint("shuffle_hash"), same, "left_anti").select(docs.columns)
    repeated = marks.where("kept")
    if repeated.isEmpty():
        return stays
    one = marked.join(repeated.hint("shuffle_hash"), same, "left_semi").dropDuplicates(["doc_id", here]).select(docs.columns)
    return stays.unionByName(one)
