"""An interpolated modified Kneser-Ney model of any order from 2: counted by Spark, stored as sorted hash arrays, memory-mapped by workers.

An n-gram is stored by 32 bits of its 64-bit hash besides those that tell its file and its page of at most some 16 n-grams,
so 1 of 10**8 n-grams that training never saw is taken for another one, at any size of the corpus. Of its numbers (counts, sums
over what follows) the 255 most frequent rows of a file are codes of one byte; all others are listed whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.bytewords import buffers, mix, word_bounds, words
from hourloom.llm.common import open_array, remove_folder, save_array, shared_folder, shuffles_removed, slices

#: The token that ends, and as a context begins, every text.
END_HASH = np.uint64(0x5BD1E9955BD1E995)
#: Distinct keys that a task collects before it passes them on, and bytes of text for each file of the model.
_HELD, _FILE_BYTES = 1_500_000, 8_000_000
#: Bytes of text that a task scores at once: the more, the fewer times it goes through the files.
_SCORED_BYTES = 4_000_000
_KINDS = (np.uint8, np.uint32, np.uint64, np.int64)
_PACKED = pa.Codec("zstd", 3)


def _bundle(parts: list[np.ndarray]) -> np.ndarray:
    """Arrays of one or two dimensions as one, back to back after a table of their kinds and shapes."""
    head = [len(parts)]
    for p in parts:
        head += [_KINDS.index(p.dtype.type), len(p), p.shape[1] if p.ndim > 1 else 0]
    raw = [np.array(head, np.int64).tobytes(), *(p.tobytes() + bytes(-p.nbytes % 8) for p in parts)]
    return np.frombuffer(b"".join(raw), np.uint8)


def _unbundle(blob: np.ndarray) -> list[np.ndarray]:
    many = int(blob[:8].view(np.int64)[0])
    head, at, out = blob[8 : 8 + 24 * many].view(np.int64).reshape(many, 3).tolist(), 8 + 24 * many, []
    for kind, rows, columns in head:
        size = rows * max(columns, 1) * np.dtype(_KINDS[kind]).itemsize
        values = blob[at : at + size].view(_KINDS[kind])
        out.append(values.reshape(rows, columns) if columns else values)
        at += size + -size % 8
    return out


def _coded(rows: np.ndarray) -> list[np.ndarray]:
    """Rows of numbers as codes of the most frequent ones (book, codes); code 255 stands for one of those listed whole (where, rows)."""
    prints = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        prints = mix(prints + column.astype(np.uint64))
    _, first, code, many = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
    often = np.argsort(-many, kind="stable")[:255]
    place = np.full(len(many), 255, np.uint8)
    place[often] = np.arange(len(often))
    book = rows[first[often]]
    codes = place[code]
    # rows whose print is that of another row are listed too
    codes[(book[np.minimum(codes, max(len(book) - 1, 0))] != rows).any(1) if len(book) else slice(0)] = 255
    rest = np.flatnonzero(codes == 255)
    return [book, codes, rest.astype(np.uint32), rows[rest].astype(np.uint32 if rows.max(initial=0) < 1 << 32 else np.int64)]


def _decoded(book: np.ndarray, codes: np.ndarray, where: np.ndarray, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    code = codes[at]
    out = book[np.minimum(code, len(book) - 1)]
    rest = code == 255
    if rest.any():
        out[rest] = rows[np.searchsorted(where, at[rest])]
    return out


def _paged(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Sorted hashes that agree in their first bits, as starts of pages by the next bits, and the 32 bits after those."""
    page_bits = max((len(hashes) // 8).bit_length() - 1, 0)
    page = (hashes << np.uint64(bits) >> np.uint64(32)) >> np.uint64(32 - page_bits)
    starts = np.searchsorted(page, np.arange((1 << page_bits) + 1, dtype=np.uint64))
    return [starts.astype(np.uint32), (hashes << np.uint64(bits + page_bits) >> np.uint64(32)).astype(np.uint32)]


def _place(starts: np.ndarray, rest: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where the hashes stand in a paged list, -1 for those that it does not hold: bisection within their pages."""
    page_bits = (len(starts) - 1).bit_length() - 1
    page = ((hashes << np.uint64(bits) >> np.uint64(32)) >> np.uint64(32 - page_bits)).astype(np.int64)
    wanted = (hashes << np.uint64(bits + page_bits) >> np.uint64(32)).astype(np.uint32)
    low, high = starts[page].astype(np.int64), starts[page + 1].astype(np.int64)
    end = high
    while (low < high).any():
        middle = (low + high) >> 1
        less = (rest[np.minimum(middle, len(rest) - 1)] < wanted) & (low < high)
        low, high = np.where(less, middle + 1, low), np.where(less, high, np.minimum(high, middle))
    return np.where((low < end) & (rest[np.minimum(low, len(rest) - 1)] == wanted), low, -1)


def _planes(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones, and so on."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def _packed(ids: list[np.ndarray], values: list[np.ndarray]) -> bytes:
    """Sorted n-grams with their numbers, compressed: each word as the step from the n-gram before if the words before it are the same."""
    head, parts = np.arange(len(ids[0])) == 0, []
    for c in ids:
        step = np.diff(c, prepend=c[:1])
        parts.append(_planes(np.where(head, c, step)))
        head = head | (step != 0)
    parts += [_planes(v.astype(np.uint64)) for v in values]
    return np.int64(len(ids[0])).tobytes() + _PACKED.compress(b"".join(parts), asbytes=True)


def _unpacked(blob, n: int, many: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    rows = int(np.frombuffer(blob, np.int64, 1)[0])
    raw = np.frombuffer(_PACKED.decompress(memoryview(blob)[8:], rows * (4 * n + 8 * many)), np.uint8)
    head, ids, at = np.arange(rows) == 0, [], 0
    for _ in range(n):
        step = np.ascontiguousarray(raw[at : at + 4 * rows].reshape(4, rows).T).view(np.uint32).reshape(rows)
        at += 4 * rows
        total, heads = np.cumsum(step, dtype=np.uint32), np.flatnonzero(head)
        column = total - np.repeat(total[heads] - step[heads], np.diff(np.append(heads, rows)))
        head = head | (np.diff(column, prepend=column[:1]) != 0)
        ids.append(column)
    values = [np.ascontiguousarray(raw[at + 8 * rows * i : at + 8 * rows * (i + 1)].reshape(8, rows).T).view(np.int64).reshape(rows) for i in range(many)]
    return ids, values


@dataclass
class KneserNey:
    """Where the arrays are, and the few numbers that all workers need."""

    folder: str
    bits: int
    types: int = 0
    #: The id of words that training never saw, beyond all others.
    unknown: int = 0
    tokens: int = 0
    order: int = 2
    discounts: dict[int, tuple[float, float, float]] = field(default_factory=dict)
    unigram_total: int = 0
    unigram_left: float = 1.0

    def opened(self, name: str, bucket: int) -> list[np.ndarray]:
        return open_array(self.folder, f"{name}-{bucket}", _unbundle)

    def lookup(self, unique: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, count) of sorted hashes; unknown ones have the id ``unknown`` and the count 0.

        A word's id is its rank by count in its bucket times the number of buckets, plus the bucket: frequent words
        have small ids, which pack well, and no step sees all words.
        """
        ids, counts = np.full(len(unique), self.unknown, np.int64), np.zeros(len(unique), np.int64)
        for b, own in _by_bucket(unique >> np.uint64(64 - self.bits)) if self.types else ():
            hashes, ranks, *coded = self.opened("words", b)
            if not len(hashes):
                continue
            at = np.minimum(np.searchsorted(hashes, unique[own]), len(hashes) - 1)
            hit = hashes[at] == unique[own]
            ids[own] = np.where(hit, (ranks[at].astype(np.int64) << self.bits) + b, self.unknown)
            counts[own] = np.where(hit, _decoded(*coded, at)[:, 0], 0)
        return ids, counts

    def find(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """The numbers of the n-grams with these sorted hashes; zeros for those that training never saw.

        First how often it is seen (below the highest order: after how many different words); then, below the highest order,
        what follows it: tokens, and types by count.
        """
        out = np.zeros((len(hashes), 1 if n == self.order else 5), np.int64)
        for b, own in _by_bucket(hashes >> np.uint64(64 - self.bits)):
            starts, rest, *coded = self.opened(f"grams{n}", b)
            if not len(rest):
                continue
            at = _place(starts, rest, hashes[own], self.bits)
            hit = np.flatnonzero(at >= 0)
            for i in range(0, len(coded), 4):
                found = _decoded(*coded[i : i + 4], at[hit])
                out[own.start + hit, i // 4 : i // 4 + found.shape[1]] = found
        return out


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(bucket, slice) for buckets in order."""
    if len(bucket):
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        for start, end in zip(cuts, [*cuts[1:], len(bucket)]):
            yield int(bucket[start]), slice(start, end)


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return (keys[heads], *(np.add.reduceat(v[order], heads) if len(keys) else v for v in values))


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens with an end after each text, and the n + 1 positions at which texts begin."""
    raw, offsets = buffers(batch.column("text"))
    start, _, hashed = words(raw, offsets)
    bounds = word_bounds(start, offsets)
    return np.insert(hashed, bounds[1:], END_HASH), bounds + np.arange(len(bounds))


def _blobs(bucket: np.ndarray, columns: list[np.ndarray], order: np.ndarray | None = None) -> pa.RecordBatch:
    """One row a bucket: each column's values of the bucket as bytes."""
    if order is not None:
        bucket, columns = bucket[order], [c[order] for c in columns]
    rows = list(_by_bucket(bucket))
    arrays = [pa.array([b for b, _ in rows], pa.int32())]
    arrays += [pa.array([c[own].tobytes() for _, own in rows], pa.binary()) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, ["bucket", *(f"c{i}" for i in range(len(columns)))])


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(v.as_buffer(), kind) for chunk in table.column(name).chunks for v in chunk] or [np.zeros(0, kind)])


def _collect(batches: Iterator[pa.RecordBatch], keys_of: Callable[[pa.RecordBatch], np.ndarray], pack) -> Iterator[pa.RecordBatch]:
    """Counts of keys, combined in the task until it holds many different ones."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in slices(batches, "text"):
        held.append(np.unique(keys_of(batch), return_counts=True))
        if sum(len(k) for k, _ in held) > _HELD:
            keys, counts = _summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            held = [(keys, counts)]
            if len(keys) > _HELD // 2:
                yield pack(keys, counts)
                held = []
    if held:
        yield pack(*_summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])))


def _count_words(bits: int):
    def run(batches):
        yield from _collect(batches, lambda b: _tokens(b)[0], lambda k, c: _blobs(k >> np.uint64(64 - bits), [k, c.astype(np.uint64)]))

    return run


def _store_words(folder: str):
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        keys, counts = _summed(_joined(table, "c0", np.uint64), _joined(table, "c1", np.uint64))
        ranks = np.empty(len(keys), np.uint32)
        ranks[np.argsort(-counts.astype(np.int64), kind="stable")] = np.arange(len(keys))
        save_array(folder, f"words-{bucket}", _bundle([keys, ranks, *_coded(counts.astype(np.int64)[:, None])]))
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "size": [len(keys)], "tokens": [int(counts.sum())]})

    return run


def _ids(model: KneserNey, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, inverse = np.unique(hashed, return_inverse=True)
    ids, counts = model.lookup(unique)
    return ids[inverse], counts[inverse]


def _history(model: KneserNey, ids: np.ndarray, end: int, bounds: np.ndarray) -> list[np.ndarray]:
    """Columns of the n-grams that end at each token; before a text there are ends only."""
    at, begin = np.arange(len(ids)), np.repeat(bounds[:-1], np.diff(bounds))
    return [np.where(at - j >= begin, ids[np.maximum(at - j, 0)], end).astype(np.uint32) for j in range(model.order - 1, -1, -1)]


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of n-grams; no two of one or two words share one."""
    key = columns[0].astype(np.uint64)
    for i, column in enumerate(columns[1:]):
        key = (key << np.uint64(32)) | column if i == 0 else mix(mix(key) + column.astype(np.uint64))
    return mix(key)


def _merged(ids: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct n-grams in the order of their words, and the sums of their values."""
    if not len(ids[0]):
        return ids, values
    keys = [c.astype(np.uint64) << np.uint64(32) | (ids[i + 1] if i + 1 < len(ids) else np.uint32(0)) for i, c in enumerate(ids) if i % 2 == 0]
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    heads = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]))
    return [c[order[heads]] for c in ids], [np.add.reduceat(v[order], heads) for v in values]


def _dealt(model: KneserNey, name: str, ids: list[np.ndarray], values: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row a bucket: its n-grams, dealt by the hash of all words, as ``name``."""
    bucket = _hash(ids) >> np.uint64(64 - model.bits)
    order = np.argsort(bucket, kind="stable")
    ids, values = [c[order] for c in ids], [v[order] for v in values]
    rows = [(b, _packed([c[own] for c in ids], [v[own] for v in values])) for b, own in _by_bucket(bucket[order])]
    data = {name: pa.array([r for _, r in rows], pa.binary())}
    empty = pa.nulls(len(rows), pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), *(data.get(c, empty) for c in _SENT)], ["bucket", *_SENT])


#: What a task sends for a bucket: n-grams with counts, or with sums over what follows them.
_SENT = ("grams", "contexts")
_ROW = "bucket int, grams binary, contexts binary"


def _count_grams(model: KneserNey):
    """Counts of the n-grams of the highest order, combined in the task until it holds many different ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[list[np.ndarray], np.ndarray]] = []
        join = lambda: _merged([np.concatenate(c) for c in zip(*(g for g, _ in held))], [np.concatenate([n for _, n in held])])
        for batch in slices(batches, "text"):
            hashed, bounds = _tokens(batch)
            ids, _ = _ids(model, np.concatenate([[END_HASH], hashed]))
            held.append((_history(model, ids[1:], int(ids[0]), bounds), np.ones(len(hashed), np.int64)))
            if sum(len(n) for _, n in held) > _HELD:
                columns, counts = join()
                held = [(columns, counts[0])]
                if len(counts[0]) > _HELD // 2:
                    yield from _dealt(model, "grams", columns, counts)
                    held = []
        if held:
            yield from _dealt(model, "grams", *join())

    return run


def _store_grams(model: KneserNey, n: int, passed: str):
    """A bucket of n-grams, which is also passed on to the order below."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        sent = {name: [_unpacked(v.as_buffer(), n, many) for chunk in table.column(name).chunks for v in chunk if v.is_valid] for name, many in zip(_SENT, (1, 4))}
        ids = [np.concatenate(c) for c in zip(*(g for rows in sent.values() for g, _ in rows))]
        values = []
        for i in range(1 if n == model.order else 5):
            # a row tells of what precedes an n-gram or of what follows it
            seen = [v[0] if i == 0 else np.zeros(len(v[0]), np.int64) for _, v in sent["grams"]]
            values.append(np.concatenate(seen + [v[i - 1] if i else np.zeros(len(v[0]), np.int64) for _, v in sent["contexts"]]))
        ids, values = _merged(ids, values)
        counts = values[0]
        if n > 1:
            own = counts > 0
            save_array(passed, f"grams-{bucket}", np.frombuffer(_packed([c[own] for c in ids], [counts[own]]), np.uint8))
        hashes = _hash(ids)
        order = np.argsort(hashes)
        coded = [_coded(np.stack(part, 1)[order]) for part in (values[:1], values[1:]) if part]
        save_array(model.folder, f"grams{n}-{bucket}", _bundle([*_paged(hashes[order], model.bits), *(a for c in coded for a in c)]))
        told = {f"n{i}": [int((counts == i).sum())] for i in (1, 2, 3, 4)} | {"more": [int((counts > 2).sum())], "total": [int(counts.sum())]}
        return pa.table({"bucket": pa.array([bucket], pa.int32()), **told})

    return run


def _shorter(model: KneserNey, n: int, passed: str):
    """From n-grams: each without its first word, counted by what precedes it, and each without its last, with sums over what follows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket in batch.column("bucket").to_pylist():
                ids, (counts,) = _unpacked(np.asarray(open_array(passed, f"grams-{bucket}")), n, 1)
                if len(counts):
                    yield from _dealt(model, "grams", *_merged(ids[1:], [np.ones(len(counts), np.int64)]))
                    yield from _dealt(model, "contexts", *_merged(ids[:-1], [counts, *((counts == i).astype(np.int64) for i in (1, 2)), (counts > 2).astype(np.int64)]))

    return run


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and more, kept between 0 and the count where data are few."""
    if not n[0] or not n[1]:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    raw = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
    return tuple(float(min(max(d, 0.05), i + 0.95)) for i, d in enumerate(raw))


def train(docs: DataFrame, order: int = 3) -> KneserNey:
    """Count a model of ``order`` words, 2 or more, over all whole texts of ``docs``.

    Tasks combine the counts of their texts and send them sorted and compressed, one row a bucket of the hash range; words first, then
    n-grams of word ids, then from each order the one below: its n-grams counted by what precedes them, and sums over what follows
    them. Each bucket is merged, sorted and written by one task into the
    session's shared folder; the number of buckets follows the bytes of text, so a bucket stays small, and since n-grams
    are dealt by the hash of all their words a frequent word fills no bucket. What an order passes to the one below, and the
    shuffle files of each step, are removed when the step ends. The driver sees a few numbers a bucket. A
    repeated task writes the same files. Null text counts as empty, a text of one end token; an empty table gives a model
    that knows nothing.
    """
    if order < 2:
        raise ValueError("the order is 2 or more")
    with shuffles_removed(docs.sparkSession):
        return _train(docs, order)


def _train(docs: DataFrame, order: int) -> KneserNey:
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(5, (size // _FILE_BYTES).bit_length())
    spark = docs.sparkSession
    model = KneserNey(shared_folder(spark, "kneser-ney"), bits, order=order)
    texts, buckets = docs.select("text"), 1 << bits
    stored = texts.mapInArrow(_count_words(bits), "bucket int, c0 binary, c1 binary").groupBy("bucket")
    stored = stored.applyInArrow(_store_words(model.folder), "bucket int, size long, tokens long").collect()
    sizes = np.zeros(buckets, np.int64)
    for row in stored:
        sizes[row["bucket"]] = row["size"]
        model.tokens += row["tokens"]
    if not stored:
        return model
    for b in np.flatnonzero(sizes == 0).tolist():
        save_array(model.folder, f"words-{b}", _bundle([np.zeros(0, np.uint64), np.zeros(0, np.uint32), *_coded(np.zeros((0, 1), np.int64))]))
    model.types, model.unknown = int(sizes.sum()), int(sizes.max()) << bits
    if model.unknown >= 1 << 32:
        raise ValueError("ids of words pass 2**32")
    files = spark.range(0, buckets, 1, buckets).select(F.col("id").cast("int").alias("bucket"))
    told, passed = "bucket int, n1 long, n2 long, n3 long, n4 long, more long, total long", ""
    for n in range(order, 0, -1):
        above, passed = passed, shared_folder(spark, "kneser-ney-passed")
        rows = texts.mapInArrow(_count_grams(model), _ROW) if n == order else files.mapInArrow(_shorter(model, n + 1, above), _ROW)
        stored = rows.groupBy("bucket").applyInArrow(_store_grams(model, n, passed), told).collect()
        none = [np.zeros(0, np.uint32) for _ in range(n)]
        for b in sorted(set(range(buckets)) - {r["bucket"] for r in stored}):
            coded = [a for many in ((1,) if n == order else (1, 4)) for a in _coded(np.zeros((0, many), np.int64))]
            save_array(model.folder, f"grams{n}-{b}", _bundle([*_paged(np.zeros(0, np.uint64), bits), *coded]))
            if n > 1:
                save_array(passed, f"grams-{b}", np.frombuffer(_packed(none, [np.zeros(0, np.int64)]), np.uint8))
        if above:
            remove_folder(spark, above)
        many = [sum(r[f"n{i}"] for r in stored) for i in (1, 2, 3, 4)]
        d = model.discounts[n] = _discounts(many)
    model.unigram_total = sum(r["total"] for r in stored)
    model.unigram_left = (d[0] * many[0] + d[1] * many[1] + d[2] * sum(r["more"] for r in stored)) / model.unigram_total
    return model


def _discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(counts - np.array([0.0, *d])[np.minimum(counts, 3)], 0)


def _left(sums: np.ndarray, d: tuple[float, float, float] | None) -> np.ndarray:
    """What the discounts leave for the order below; all of it after a context that training never saw."""
    return np.where(sums[:, 0] > 0, sums[:, 1:] @ np.array(d or (0.5, 1.0, 1.5)) / np.maximum(sums[:, 0], 1), 1.0)


def _scores(model: KneserNey):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SCORED_BYTES):
            hashed, bounds = _tokens(batch)
            unique, inverse = np.unique(np.concatenate([[END_HASH], hashed]), return_inverse=True)
            ids, counts = model.lookup(unique)
            end, after = int(ids[inverse[0]]), inverse[1:]
            columns = _history(model, ids[after], end, bounds)
            chance = np.full(len(after), model.unigram_left / (model.types + 1))
            first, sums = bounds[:-1], None
            for n in range(1, model.order + 1) if model.types else ():
                # the n-gram that ends at each token, and last the one of ends only, which precedes each text
                ends = np.full(1, end, np.uint32)
                asked, where = np.unique(_hash([np.concatenate([c, ends]) for c in columns[-n:]]), return_inverse=True)
                found = model.find(asked, n)
                seen = _discount(found[:, 0], model.discounts[n])[where[:-1]]
                if n == 1:
                    chance = chance + seen / model.unigram_total
                else:
                    chance = seen / np.maximum(sums[:, 0], 1)[before] + _left(sums, model.discounts[n])[before] * chance
                if n < model.order:
                    sums, before = found[:, 1:], np.concatenate([where[-1:], where[:-2]])
                    before[first] = where[-1]
            base = np.log10((counts + 0.1) / (model.tokens + 0.1 * (model.types + 1)))[after]
            sums = [np.add.reduceat(v, bounds[:-1]) for v in (np.log10(chance), base, (counts > 0).astype(np.int64)[after])]
            columns = [pa.array(np.diff(bounds)), pa.array(sums[2]), pa.array(sums[1]), pa.array(sums[0])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    return run


def score(docs: DataFrame, model: KneserNey) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score, perplexity of every row of ``docs``, from its whole text.

    ``score`` is the base-10 log probability of the text's tokens and its end; words that training never saw share one
    unknown type. ``base_score`` is the sum under additively smoothed single words. Null and empty texts hold the end
    token only. Repeated rows get equal scores; null ids are kept; further columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(_scores(model), f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    return rows.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
