"""Benchmark passages in documents: a prefix-filtered set join with exact verification, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.common import ascii_lower, own_name
from hourloom.session import durable

#: Words of a window.
WINDOW = 10
#: A table of windows is broadcast up to this many bytes, as counted; a larger one is joined by a shuffle.
BROADCAST_BYTES = 64_000_000
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text: runs of 0-9, a-z (A-Z counts as a-z) and all characters beyond ASCII."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, shingle, length): every window of ``window`` words; an item of fewer words, but not none, is one."""
    words = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where("size(words) > 0")
    starts = F.expr(f"sequence(1, greatest(size(words) - {window} + 1, 1))")
    rows = words.select("item_id", "words", F.explode(starts).alias("at"))
    shingle = F.expr(f"slice(words, at, {window})")
    return rows.select("item_id", shingle.alias("shingle")).withColumn("length", F.size("shingle")).distinct()


def _small(df: DataFrame, row_bytes: Column, limit: int) -> bool:
    return (df.select(F.sum(row_bytes + 64)).first()[0] or 0) <= limit


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, text_hash, start, length, item_id): every place where a window of an item occurs in a text.

    All words of a window must occur, so one necessary word is enough as its prefix: the rarest, by counts over all
    documents. Documents meet windows on that word; its place in the window gives the only possible start, which
    the text's length bounds on both sides, and the words from there are compared one by one. Windows that several items
    share are matched once. Common words are prefixes only of windows that have nothing rarer.
    """
    marked = durable(item_windows(benchmark, window).withColumn("key", F.array_join("shingle", " ")))
    distinct = marked.select("key", "shingle", "length").distinct()
    vocabulary = distinct.select(F.explode("shingle").alias("word")).distinct()
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    few = _small(distinct, F.octet_length("key"), broadcast_bytes)
    hint = F.broadcast if few else (lambda df: df)
    counts = texts.select(F.explode("words").alias("word")).join(hint(vocabulary), "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    places = distinct.select("key", "length", F.posexplode("shingle").alias("offset", "word")).join(counts, "word", "left")
    rarest = places.groupBy("key", "length").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset")).alias("rarest"))
    prefixes = durable(rarest.where("rarest.n > 0").select("key", "length", "rarest.word", "rarest.offset"))
    around = texts.select("doc_id", "text_hash", F.size("words").alias("n_words"), "words", F.posexplode("words").alias("at", "word"))
    if few:
        around, first = around, F.lit(0)
    else:  # the neighbours of a word travel with it, not the whole text
        first = F.greatest(F.col("at") - (window - 1), F.lit(0))
        around = around.select("doc_id", "text_hash", "n_words", "at", "word", F.slice("words", first + 1, 2 * window - 1).alias("words"))
    met = around.join(hint(prefixes), "word").withColumn("start", F.col("at") - F.col("offset"))
    met = met.where("start >= 0 AND start + length <= n_words")
    exact = met.where(F.array_join(F.slice("words", F.col("start") - first + 1, F.col("length")), " ") == F.col("key"))
    found = exact.select("doc_id", "text_hash", "start", "length", "key")
    return found.join(marked.select("key", "item_id"), "key").select("doc_id", "text_hash", "start", "length", "item_id").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_words, n_hit, item_ids (sorted as strings).

    n_hit counts the words inside any occurrence of a window, overlaps once. Null and empty texts have no words and no
    hits; repeated rows get equal results; null ids are compared as equal. Further columns are ignored.
    """
    found = durable(hits(docs, benchmark, window, broadcast_bytes))
    spans = found.groupBy("doc_id", "text_hash", "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    before = Window.partitionBy("doc_id", "text_hash").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(before), F.lit(0))), F.lit(0))
    covered = spans.withColumn("new", new).groupBy("doc_id", "text_hash").agg(F.sum("new").alias("n_hit"))
    items = found.select("doc_id", "text_hash", F.col("item_id").cast("string").alias("item")).distinct()
    items = items.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list("item")).alias("item_ids"))
    same = ["doc_id", "text_hash"]
    result = covered.join(items, [covered[c].eqNullSafe(items[c]) for c in same]).select(*[covered[c].alias(f"_{c}") for c in same], "n_hit", "item_ids")
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(words_of(F.col("text"))).alias("n_words"))
    joined = texts.join(result, [texts[c].eqNullSafe(F.col(f"_{c}")) for c in same], "left")
    return joined.select(
        "doc_id", "text_hash", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.expr("cast(array() AS array<string>)")).alias("item_ids"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs, with all their columns."""
    other, hashed = own_name(docs, "_id"), own_name(docs, "_hash")
    found = hits(docs, benchmark, window).select(F.col("doc_id").alias(other), F.col("text_hash").alias(hashed)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(other)) & (F.xxhash64("text") == F.col(hashed))
    return docs.join(found, same, "left_anti")
