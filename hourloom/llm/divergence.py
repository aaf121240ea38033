"""How far the sources of a language differ in their words: count-level bitmaps.

Spark counts every term by group, keeps a language's terms of enough documents and numbers them in sets of 64. A group's
bitmap for one count holds a bit for each term that occurs so often in the group; only words that hold a bit are stored. Two groups' terms with
counts (a, b) are then the ones in an AND, counted by popcount and multiplied by what one such term adds. Terms that one of the two lacks are
the complement: its level's terms without those found in the ANDs. All arithmetic is in integers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.common import slices
from hourloom.session import durable, is_small, stored

#: Letters of A-Z and all that is not ASCII make a term.
_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
#: Documents in which a language's term must be, and the scale of its share.
LEAST_DOCUMENTS, SCALE = 10, 1_000_000_000
#: Distinct terms and bytes of one text that a task holds at a time.
HELD_TERMS, CHUNK = 1_000_000, 1 << 20
#: Terms that are numbered together, and words of bitmaps, over all groups of a language, that are compared together.
NUMBERED, BLOCK_WORDS = 8192, 16_384
#: Pairs of words that are compared at a time.
COMPARED = 1 << 19


def _chunks(text: bytes) -> Iterator[bytes]:
    """A text in parts of about ``CHUNK`` bytes that end after a byte which no term holds."""
    low = 0
    while len(text) - low > CHUNK:
        high = low + CHUNK
        while high < len(text) and (text[high - 1] > 127 or chr(text[high - 1]).isalpha()):
            high += 1
        yield text[low:high]
        low = high
    yield text[low:]


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, count, documents) summed over a stretch of a task; a null term tells of the group itself."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (count, documents) in counts.items():
            terms = [None, *count]
            for low in range(0, len(terms), 50_000):
                part = terms[low : low + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                        pa.array(part, pa.binary()).cast(pa.string()),
                        pa.array([count[t] for t in part], pa.int64()), pa.array([documents[t] for t in part], pa.int64()),
                    ],
                    names=["lang", "source", "term", "count", "documents"],
                )
        counts.clear()

    for batch in slices(batches, "text"):
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            count, documents = counts.setdefault((lang, source), (Counter(), Counter()))
            before, here = len(count), set()
            for chunk in _chunks(text.encode().lower()):
                terms = _TERM.findall(chunk)
                count.update(terms)
                here.update(terms)
            documents.update(here)
            held += len(count) - before + 1
            if held > HELD_TERMS:
                yield from rows()
                held = 0
    yield from rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, documents) of every group; each group also has a row with a null term and zeros."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = texts.mapInArrow(_partial_counts, "lang string, source string, term string, count long, documents long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("documents").alias("documents"))


def _share(count: Column | str, total: Column | str, kept: Column | str) -> Column:
    """p = 1 + floor(SCALE * (count + 2) / (total + 2 * kept)), in decimals: the product may exceed 64 bits."""
    up = f"CAST({count} + 2 AS DECIMAL(20, 0)) * CAST({SCALE} AS DECIMAL(10, 0))"
    return F.expr(f"1 + ({up}) div CAST({total} + 2 * {kept} AS DECIMAL(20, 0))")


def _gap(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q}))) div (({p}) + ({q}))"


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The same in numpy: shares are at most SCALE + 1, so squares fit 64 bits."""
    return (p - q) ** 2 // (p + q)


def numbered_terms(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, total, level, bucket, word, bit) of the kept terms.

    Terms of a like total and one hash bucket are numbered together, so no window holds many more than ``NUMBERED``; rare terms
    share words, in which few counts occur.
    """
    kept = (
        counts.where("term IS NOT NULL").groupBy("lang", "term")
        .agg(F.sum("count").alias("total"), F.sum("documents").alias("documents")).where(F.col("documents") >= least)
    )
    kept = durable(kept.select("lang", "term", "total", F.floor(F.log2("total")).cast("int").alias("level")))
    buckets = kept.count() // NUMBERED + 1
    bucketed = kept.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
    number = F.row_number().over(Window.partitionBy("lang", "level", "bucket").orderBy("term")) - 1
    return (
        bucketed.withColumn("number", number)
        .withColumn("word", F.expr("CAST(number div 64 AS INT)")).withColumn("bit", F.col("number") % 64).drop("number")
    )


def _common_cells(table: pa.Table) -> pa.Table:
    """What the terms that both groups have add to each pair, less what these terms would add if one group lacked them.

    Rows are bitmap words (word, source, bits, p, p0) of one language and block; p0 is the group's share of a missing term.
    """
    source, word = table["source"].combine_chunks().dictionary_encode(), table["word"].to_numpy()
    names = source.dictionary.to_pylist()
    rank = np.argsort(np.argsort(np.array(names, object)))
    ordered = sorted(names)
    owner = rank[source.indices.to_numpy(zero_copy_only=False)]
    order = np.lexsort((owner, word))
    owner, word = owner[order], word[order]
    bits, p, p0 = (table[c].to_numpy()[order] for c in ("bits", "p", "p0"))
    bits = bits.view(np.uint64)
    # each row meets the rows of greater sources in its word: those from the end of its own run to the end of the word
    runs = np.flatnonzero(np.r_[True, (np.diff(word) != 0) | (np.diff(owner) != 0)])
    begin = np.append(runs, len(word))[np.searchsorted(runs, np.arange(len(word)), side="right")]
    end = np.searchsorted(word, word, side="right")
    pairs = end - begin
    done = np.concatenate(([0], np.cumsum(pairs)))
    found: list[pa.Table] = []
    low = 0
    while low < len(word):
        high = max(low + 1, int(np.searchsorted(done, done[low] + COMPARED, side="right")) - 1)
        i = np.repeat(np.arange(low, high), pairs[low:high])
        j = np.arange(len(i)) - (done[i] - done[low]) + begin[i]
        cells = np.bitwise_count(bits[i] & bits[j]).astype(np.int64)
        some = cells > 0
        i, j, cells = i[some], j[some], cells[some]
        value = cells * (_gaps(p[i], p[j]) - _gaps(p[i], p0[j]) - _gaps(p0[i], p[j]) + _gaps(p0[i], p0[j]))
        code, at = np.unique(owner[i] * len(ordered) + owner[j], return_inverse=True)
        total = np.zeros(len(code), np.int64)
        np.add.at(total, at, value)
        a, b = ([ordered[k] for k in part] for part in (code // len(ordered), code % len(ordered)))
        lang = [table["lang"][0].as_py()] * len(code)
        found.append(pa.table([pa.array(lang, pa.string()), pa.array(a, pa.string()), pa.array(b, pa.string()), total], names=["lang", "a", "b", "value"]))
        low = high
    return pa.concat_tables(found)


def _near(small: DataFrame) -> DataFrame:
    """Marked for a broadcast if a count shows that it is small; otherwise the join shuffles."""
    return F.broadcast(small) if is_small(small) else small


def source_divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: every pair of sources of a language, and each source's ``top`` marking terms.

    Null text, lang or source counts as empty text; repeated rows count as often as they are there, and further columns are
    ignored. A group without terms has only zero counts, and a language without kept terms has pairs of value 0; a
    language of one source has no pairs, and an empty table gives no rows. Ties go to the lesser name in UTF-8 order. Of
    pairs as many leave as there are: the square of a language's sources. A common term or large source is one row a task after
    the first count; bitmaps of a block are bounded by words and sources, not by texts.
    """
    counts = stored(term_counts(docs), "term-counts")
    terms = stored(numbered_terms(counts, least), "terms")
    rows = counts.where("term IS NOT NULL").select("lang", "source", "term", "count").join(terms, ["lang", "term"])
    rows = stored(rows, "kept-counts")  # read three times
    sums = rows.groupBy("lang", "source").agg(F.sum("count").alias("sum"))
    languages = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("lang_sum"))
    groups = counts.where("term IS NULL").select("lang", "source").join(sums, ["lang", "source"], "left").join(languages, "lang", "left")
    zero = F.lit(0).cast("long")
    groups = durable(groups.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("sum", "kept", "lang_sum")]))
    filled = groups.where("kept > 0").select("*", _share("0", "sum", "kept").alias("p0"))
    shared = rows.join(_near(filled), ["lang", "source"]).select("*", _share("count", "sum", "kept").alias("p"))

    marking = (
        shared.select("lang", "source", F.col("term").alias("item"), "p", _share("total", "lang_sum", "kept").alias("q"))
        .where("p > q").select("lang", "source", F.lit("term").alias("part"), "item", F.expr(_gap("p", "q")).alias("value"))
    )
    by_value = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    marking = marking.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)

    words = shared.groupBy("lang", "source", "level", "bucket", "word", "count", "p", "p0").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    words = stored(words, "bitmaps")
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    block = F.expr(f"CAST(word div {min(max(BLOCK_WORDS // most, 1), 256)} AS INT)")
    common = (
        words.select("lang", "source", "level", "bucket", block.alias("block"), "word", "bits", "p", "p0")
        .groupBy("lang", "level", "bucket", "block").applyInArrow(_common_cells, "lang string, a string, b string, value long")
    )
    levels = words.groupBy("lang", "source", "count", "p", "p0").agg(F.sum(F.bit_count("bits")).alias("terms"))
    other = filled.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    # a level's terms as if the other group had none of them, over the value of terms that both lack
    lone = levels.join(_near(other), "lang").where("source <> item")
    alone = f"terms * ({_gap('p', 'q0')} - {_gap('p0', 'q0')})"
    lone = lone.select("lang", F.least("source", "item").alias("a"), F.greatest("source", "item").alias("b"), F.expr(alone).alias("value"))
    both = groups.select("lang", F.col("source").alias("a"), "kept", "sum").join(
        _near(groups.select("lang", F.col("source").alias("b"), F.col("sum").alias("other"))), "lang"
    )
    p0, q0 = (f"(1 + 2 * CAST({SCALE} AS BIGINT) div ({n} + 2 * kept))" for n in ("sum", "other"))
    lacking = F.expr(f"CASE WHEN kept > 0 THEN kept * ({_gap(p0, q0)}) ELSE 0L END")
    base = both.where("a < b").select("lang", "a", "b", lacking.alias("value"))
    pairs = base.unionByName(lone).unionByName(common).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sides = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = pairs.select("lang", sides.alias("side"), "value").select("lang", "side.source", F.lit("pair").alias("part"), "side.item", "value")
    return pairs.withColumn("rank", F.row_number().over(by_value)).unionByName(marking)
