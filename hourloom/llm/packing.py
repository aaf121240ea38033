"""Bulk-synchronous best-fit packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.common import slices
from hourloom.session import durable

#: Tokens of a sequence, and the id that ends a document.
CAPACITY, END = 1024, 2
#: Ranges in which the pieces of one length are sorted.
RANGES = 256

# Fixed value: the split pattern of the vocabulary, written with possessive repeats, which match the same and run faster.
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
_SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=2)
def encoder(tokenizer: str):
    """A function from a text to its ids, the same ids as the tokenizer file gives without special tokens added.

    ``tokenizer`` is the path of a byte-level BPE file beside which the same vocabulary lies as ranks (``.tiktoken``).
    The ranks are encoded five times as fast; a text that spells out a special token goes to the file itself.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(tokenizer.removesuffix(".json") + ".tiktoken", "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    plain = tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    whole = Tokenizer.from_file(tokenizer)
    return lambda text: whole.encode(text, add_special_tokens=False).ids if _SPECIAL in text else plain(text)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _pieces(tokenizer: str | None, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer or default_tokenizer())
        for batch in slices(batches, "text", 4_000_000):
            rows: list[tuple] = []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = np.array([*encode(text or ""), END], "<u4")
                head = len(ids) % capacity if len(ids) > capacity else len(ids)
                starts = [*([0] if head else []), *range(head, len(ids), capacity)]
                for piece, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    rows.append((i, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(columns[0]), *columns[1:]], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return cut


def best_fit_rounds(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, rank from, rank to, first sequence, offset): where the pieces of each length go, by rank.

    Pieces of one length are interchangeable, and so are sequences with equal gaps; a round therefore works on runs of
    them. Rounds go from long to short pieces. In a round all pieces of a length look for their successor, the smallest gap that
    holds them; where several want one gap the lower rank has it, and the rest move on to the next gaps in order. Gaps are
    updated for the next round, and pieces that find none open sequences. There are at most ``capacity`` rounds, and
    each splits at most one run, so the plan has a bounded size however many pieces there are.
    """
    gaps: list[tuple[int, int, int]] = []  # gap, first sequence, sequences in the run
    plan, opened = [], 0
    for length in sorted((n for n, count in counts.items() if count), reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(gaps, (length, -1, -1))
            if at < len(gaps):
                gap, first, many = gaps.pop(at)
            else:
                gap, first, many = capacity, opened, -(-left // (capacity // length))
                opened += many
            each = gap // length  # a successor stays the successor of the next rank while it holds it
            filled = min(many, left // each)
            for layer in range(each if filled else 0):
                plan.append((length, rank, rank + filled, first, capacity - gap + layer * length))
                rank += filled
            left -= filled * each
            if filled and gap - each * length:
                insort(gaps, (gap - each * length, first, filled))
            first, many = first + filled, many - filled
            if many and left and left < each:
                for layer in range(left):
                    plan.append((length, rank, rank + 1, first, capacity - gap + layer * length))
                    rank += 1
                if gap - left * length:
                    insort(gaps, (gap - left * length, first, 1))
                first, many, left = first + 1, many - 1, 0
            if many:
                insort(gaps, (gap, first, many))
    return plan


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    Texts are tokenised once, into a table of pieces that is written. Spark counts pieces by length and range, at most
    ``capacity`` x 256 numbers; the rounds of ``best_fit_rounds`` turn them into ranges of ranks, and each piece finds its
    place by its rank within its length. A piece is ranked within its range, so a common length is no hot key, and a full
    piece is a sequence by itself without any rank. Null and empty texts hold the end id only; repeated rows and null
    ids are packed like others. An empty table gives no rows. ``tokenizer`` is the path of the vocabulary file.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    pieces = durable(docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer, capacity), schema).withColumn("row", F.monotonically_increasing_id()))
    pieces = pieces.withColumn("order", F.xxhash64("row")).withColumn("range", F.pmod(F.shiftrightunsigned("order", 40), F.lit(RANGES)).cast("int"))
    full = pieces.where(F.col("length") == capacity).withColumn("sequence_id", -F.col("row") - 1).withColumn("offset", F.lit(0).cast("long"))
    part = pieces.where(F.col("length") < capacity)
    counted = part.groupBy("length", "range").count().collect()
    firsts, counts = [], {}
    for row in sorted(counted):
        firsts.append((row["length"], row["range"], counts.get(row["length"], 0)))
        counts[row["length"]] = counts.get(row["length"], 0) + row["count"]
    plan = best_fit_rounds(counts, capacity)
    first = spark.createDataFrame(firsts, "length long, range int, first long")
    places = spark.createDataFrame(plan, "length long, rank_from long, rank_to long, sequence_from long, place long")
    within = F.row_number().over(Window.partitionBy("length", "range").orderBy("order", "row")) - 1
    ranked = part.withColumn("within", within).join(F.broadcast(first), ["length", "range"]).withColumn("rank", F.col("first") + F.col("within"))
    placed = ranked.join(F.broadcast(places), [ranked["length"] == places["length"], F.col("rank") >= F.col("rank_from"), F.col("rank") < F.col("rank_to")])
    placed = placed.withColumn("sequence_id", F.col("sequence_from") + F.col("rank") - F.col("rank_from")).withColumn("offset", F.col("place")).drop(places["length"])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return placed.select(columns).unionByName(full.select(columns))
