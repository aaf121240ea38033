"""Repeated byte passages: sharded suffix arrays by Larsson-Sadakane refinement, Kasai prefixes and merging of shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.bytewords import buffers, mix, powers
from hourloom.llm.common import slices
from hourloom.session import durable

#: Bytes of a passage, and of the content-chosen anchors by which equal passages meet.
PASSAGE, ANCHOR = 400, 32
#: Bytes of the stretches of one shard.
SHARD_BYTES = 1_500_000
#: Ranges of prints in which the shards of one anchor are merged, for each of its shards.
RANGES = 8
_PIECE = 1 << 23
_VALUES = np.random.default_rng(77).integers(1, 1 << 63, 256).astype(np.uint64)
_COLUMNS = ("anchor", "stretch", "key1", "key2", "start", "end")


def _lowest(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, from prefix and suffix minima of blocks."""
    n = len(keys)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = keys
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def stretches(raw: np.ndarray, passage: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, stretch hash, start, end): the passages of a text, dealt to anchors chosen by content alone.

    Every passage belongs to its leftmost 32-byte gram of least hash, so equal passages have equal anchors. A stretch is
    what consecutive passages of one anchor cover.
    """
    out: list[tuple] = []
    for base in range(0, max(len(raw) - passage + 1, 0), _PIECE):
        part = raw[base : base + _PIECE + passage - 1]
        ahead, back = powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_VALUES[part] * ahead[:-1], out=sums[1:])
        grams = mix((sums[anchor:] - sums[:-anchor]) * back[: len(part) - anchor + 1])
        place = np.arange(len(grams), dtype=np.uint64)
        owner = (_lowest((grams & ~np.uint64((1 << 24) - 1)) | place, passage - anchor + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
        heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        ends = np.append(heads[1:], len(owner)) - 1 + passage
        data = part.tobytes()
        digest = [hashlib.blake2b(data[s:e], digest_size=8).digest() for s, e in zip(heads.tolist(), ends.tolist())]
        out.append((grams[owner[heads]], np.frombuffer(b"".join(digest), np.uint64), heads + base, ends + base))
    if not out:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    return tuple(np.concatenate(c) for c in zip(*out))


def _union(key1: np.ndarray, key2: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """The same bytes in as few intervals as cover them: those of one text that touch or overlap are one."""
    if not len(start):
        return [key1, key2, start, end]
    order = np.lexsort((start, key2, key1))
    key1, key2, start, end = (c[order] for c in (key1, key2, start, end))
    fresh = np.concatenate([[True], (key1[1:] != key1[:-1]) | (key2[1:] != key2[:-1])])
    lift = np.cumsum(fresh) * (int(end.max()) + 1)  # a running maximum then never reaches into the next text
    reach = np.maximum.accumulate(end + lift)
    heads = np.flatnonzero(fresh | np.concatenate([[True], (start + lift)[1:] > reach[:-1]]))
    return [key1[heads], key2[heads], start[heads], reach[np.append(heads[1:], len(start)) - 1] - lift[heads]]


def _sort_rows(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Rows in order of anchor and stretch; heads of equal pairs, and sizes."""
    order = np.lexsort((columns[1], columns[0]))
    columns = [c[order] for c in columns]
    if not len(order):
        return columns, order, order
    heads = np.flatnonzero(np.concatenate([[True], (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])]))
    return columns, heads, np.diff(np.append(heads, len(order)))


def _deal(passage: int, anchor: int, bits: int):
    """Stretches by bucket of their anchor, as bytes. A stretch that a task sees twice is marked there and sent once."""
    names = ["bucket", *_COLUMNS, "again", "m_key1", "m_key2", "m_start", "m_end"]

    def pack(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns, heads, sizes = _sort_rows([np.concatenate(c) for c in zip(*parts)])
        again = sizes > 1
        marked = np.repeat(again, sizes)
        sent = [c[heads] for c in columns] + [again]
        bucket = (sent[0] >> np.uint64(64 - bits)).astype(np.int64)
        edges = np.searchsorted(bucket, np.arange((1 << bits) + 1))
        rows: list[list] = [[] for _ in names]
        marks = _union(*(c[marked] for c in columns[2:]))
        shares = np.linspace(0, len(marks[0]), (1 << bits) + 1).astype(np.int64)
        for b in range(1 << bits):
            own, share = slice(edges[b], edges[b + 1]), slice(shares[b], shares[b + 1])
            if own.start < own.stop or share.start < share.stop:
                for row, v in zip(rows, [b, *(c[own].tobytes() for c in sent), *(m[share].tobytes() for m in marks)]):
                    row.append(v)
        return pa.RecordBatch.from_arrays([pa.array(r, pa.binary() if k else pa.int32()) for k, r in enumerate(rows)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in slices(batches, "text", 4_000_000):
            raw, offsets = buffers(batch.column("text"))
            keys = [batch.column(k).to_numpy() for k in ("key1", "key2")]
            for i, (s, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                if e - s >= passage:
                    a, c, start, end = stretches(raw[s:e], passage, anchor)
                    parts.append([a, c, np.full(len(a), keys[0][i]), np.full(len(a), keys[1][i]), start, end])
                    size += len(a)
            if size > 400_000:
                yield pack(parts)
                parts, size = [], 0
        if parts:
            yield pack(parts)

    return run, ", ".join(f"{n} {'binary' if k else 'int'}" for k, n in enumerate(names))


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(v.as_buffer(), kind) for chunk in table.column(name).chunks for v in chunk] or [np.zeros(0, kind)])


def _settle(shard_bytes: int):
    """Of a bucket: stretches that occur again are marked whole; different stretches of one anchor are to be compared.

    Stretches are the same when their anchors and their own hashes are, 128 bits in all. ask is 0 for a mark, 1 for a
    stretch to compare, 2 for one that is marked already and only a partner for others. part is the shard among the
    anchor's shards, whose number is in the upper 32 bits.
    """

    def run(table: pa.Table) -> pa.Table:
        kinds = dict.fromkeys(_COLUMNS, np.int64) | {"anchor": np.uint64, "stretch": np.uint64}
        columns, heads, sizes = _sort_rows([*(_joined(table, n, kinds[n]) for n in _COLUMNS), _joined(table, "again", bool)])
        marks = [_joined(table, f"m_{n}", np.int64) for n in _COLUMNS[2:]]
        asks = [np.zeros(0, np.int64)] * 7
        if len(heads):
            again = (sizes > 1) | np.logical_or.reduceat(columns[6], heads)
            settled = np.repeat(again, sizes) & ~columns[6]
            marks = _union(*(np.concatenate([m, c[settled]]) for m, c in zip(marks, columns[2:6])))
            anchor = columns[0][heads]
            tops = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
            many = np.diff(np.append(tops, len(anchor)))
            open_ = (many > 1) & np.logical_or.reduceat(~again, tops)
            size = np.add.reduceat((columns[5] - columns[4])[heads], tops)
            parts = np.repeat(-(-size // shard_bytes), many)
            own = np.repeat(open_, many)
            part = (parts << 32) | (columns[1][heads] % parts.astype(np.uint64)).astype(np.int64)
            asks = [c[heads][own] for c in (columns[2], columns[3], columns[4], columns[5])] + [anchor[own].view(np.int64), np.where(again, 2, 1)[own], part[own]]
        n = len(marks[0])
        values = [np.concatenate([m, a]) for m, a in zip(marks, asks[:4])] + [np.concatenate([np.zeros(n, np.int64), a]) for a in asks[4:]]
        names = ("key1", "key2", "start", "end", "anchor", "ask", "part")
        return pa.table({k: v.astype(np.int64) for k, v in zip(names, values)})

    return run


def suffix_array(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions in order of their suffixes, each of which ends with its own stretch; ``ends`` gives that end by position.

    Ranks start from seven bytes. Each round sorts only groups that are not settled, by the rank that follows at the depth
    reached, which doubles. Equal suffixes of different stretches stay in order of position.
    """
    n = len(raw)
    symbols, key = np.zeros(n + 7, np.int64), np.zeros(n, np.int64)
    symbols[:n] = raw.astype(np.int64) + 1
    place = np.arange(n)
    for i in range(7):
        key = (key << 9) | np.where(place + i < ends, symbols[i : n + i], 0)
    order = np.argsort(key, kind="stable")
    heads = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    first = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    lone = heads & np.append(heads[1:], True)
    slots, depth, longest = np.flatnonzero(~lone), 7, int((ends - place).max()) if n else 0
    while len(slots) and depth < longest:
        own = order[slots]
        ahead = own + depth
        inside = ahead < ends[own]
        following = np.where(inside, rank[np.where(inside, ahead, 0)] + 1, 0)
        group = rank[own]
        joint = (group << 32) | following
        turn = np.argsort(joint, kind="stable")
        own, joint = own[turn], joint[turn]
        order[slots] = own
        heads = np.concatenate([[True], joint[1:] != joint[:-1]])
        rank[own] = slots[np.maximum.accumulate(np.where(heads, np.arange(len(own)), 0))]
        lone = heads & np.append(heads[1:], True)
        slots = slots[~lone]
        depth *= 2
    return order


def common_prefixes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Kasai's common prefixes of neighbours in the suffix array, for all stretches in step.

    Going one byte on in a stretch shortens what is shared with the neighbour by one at most. Eight bytes are
    compared at a time. ``ends`` is by position, ``starts`` by stretch.
    """
    n = len(raw)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)]).astype(np.uint64)
    eight = np.zeros(n, np.uint64)
    for i in range(8):
        eight |= padded[i : n + i] << np.uint64(8 * i)
    slot = np.empty(n, np.int64)
    slot[order] = np.arange(n)
    shared = np.zeros(n, np.int64)
    length = ends[starts] - starts
    lanes = np.argsort(-length, kind="stable")
    starts, length = starts[lanes], length[lanes]
    h = np.zeros(len(starts), np.int64)
    for p in range(int(length[0]) if len(length) else 0):
        live = int(np.searchsorted(-length, -p, side="left"))  # stretches longer than p
        at = starts[:live] + p
        r = slot[at]
        other = order[np.maximum(r - 1, 0)]
        most = np.where(r > 0, np.minimum(ends[at] - at, ends[other] - other), 0)
        own = np.minimum(np.maximum(h[:live] - 1, 0), most)
        todo = np.flatnonzero(own < most)
        while len(todo):
            x = eight[at[todo] + own[todo]] ^ eight[other[todo] + own[todo]]
            low = np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8
            grown = np.minimum(own[todo] + np.where(x == 0, 8, low), most[todo])
            going = (x == 0) & (grown < most[todo])
            own[todo] = grown
            todo = todo[going]
        h[:live] = own
        shared[r] = own
    return shared


def _repeated(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, passage: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions of passages in suffix order, whether each occurs again, whether it is the first of its kind)."""
    ends = np.repeat(starts + lengths, lengths)
    order = suffix_array(raw, ends)
    shared = common_prefixes(raw, starts, ends, order)
    long = ends[order] - order >= passage
    like = shared >= passage  # as the passage before it; what is shorter in between ends a run by itself
    slots = np.flatnonzero(long)
    before = like[slots]
    after = np.append(like[1:], False)[slots]
    return order[slots], before | after, ~before


def _prints(raw: np.ndarray, at: np.ndarray, passage: int) -> list[np.ndarray]:
    """Two independent 64-bit prints of each passage."""
    ahead, back = powers(len(raw) + 1)
    out = []
    for values in (_VALUES, _VALUES[::-1]):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[raw] * ahead[:-1])])
        out.append(mix((sums[at + passage] - sums[at]) * back[at]))
    return out


def _shards(passage: int, shard_bytes: int):
    """Marks found within shards, and of anchors that several shards hold the passages of each kind once, as sorted prints.

    A row is an interval of a text (band -1), or all prints of an anchor in one band of values, packed.
    """

    def run(table: pa.Table) -> pa.Table:
        anchor, part = table.column("anchor").to_numpy(), table.column("part").to_numpy()
        order = np.lexsort((part, anchor))
        table = table.take(pa.array(order))
        anchor, part = anchor[order], part[order]
        fields = {k: table.column(k).to_numpy() for k in ("key1", "key2", "start", "ask")}
        contents = [v.as_py() for chunk in table.column("content").chunks for v in chunk]
        sizes = np.array([len(c) for c in contents], np.int64)
        heads = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])]))
        marks: list[list] = [[np.zeros(0, np.int64)] * 4]
        packed: dict[str, list] = {"anchor": [], "band": [], "prints": []}
        total, first = np.add.reduceat(sizes, heads), 0
        while first < len(heads):
            last = first + 1
            while last < len(heads) and total[first : last + 1].sum() <= shard_bytes:
                last += 1
            own = np.arange(heads[first], heads[last] if last < len(heads) else len(contents))
            first = last
            raw = np.frombuffer(b"".join(contents[k] for k in own), np.uint8)
            lengths = sizes[own]
            starts = np.cumsum(lengths) - lengths
            where, again, fresh = _repeated(raw, starts, lengths, passage)
            stretch = np.repeat(np.arange(len(own)), lengths)
            asked, bands = fields["ask"][own] == 1, np.where(part[own] >> 32 > 1, (part[own] >> 32) * RANGES, 0)
            hit = where[again & asked[stretch[where]]]
            begin = hit - starts[stretch[hit]] + fields["start"][own[stretch[hit]]]
            marks.append(_union(*(fields[k][own[stretch[hit]]] for k in ("key1", "key2")), begin, begin + passage))
            pick = fresh & (bands > 0)[stretch[where]]
            if pick.any():
                at, known = where[pick], again[pick] | ~asked[stretch[where[pick]]]
                print1, print2 = _prints(raw, at, passage)
                s = own[stretch[at]]
                turn = np.lexsort((print2, print1, anchor[s]))
                at, s, known, print1, print2 = at[turn], s[turn], known[turn], print1[turn], print2[turn]
                band = ((print1 >> np.uint64(32)) * bands[stretch[at]].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
                begin = at - starts[stretch[at]] + fields["start"][s]
                rows = np.stack([print1.view(np.int64), print2.view(np.int64), fields["key1"][s], fields["key2"][s], begin, known])
                cuts = np.flatnonzero(np.concatenate([[True], (anchor[s][1:] != anchor[s][:-1]) | (band[1:] != band[:-1])]))
                for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)]):
                    for k, v in zip(packed, (int(anchor[s[a]]), int(band[a]), rows[:, a:b].tobytes())):
                        packed[k].append(v)
        columns = _union(*(np.concatenate(c) for c in zip(*marks)))
        n, m = len(columns[0]), len(packed["band"])
        out = {k: pa.array(np.concatenate([c, np.zeros(m, np.int64)])) for k, c in zip(("key1", "key2", "start", "end"), columns)}
        out["anchor"] = pa.array([0] * n + packed["anchor"], pa.int64())
        out["band"] = pa.array([-1] * n + packed["band"], pa.int64())
        out["prints"] = pa.array([None] * n + packed["prints"], pa.binary())
        return pa.table(out)

    return run


def _merge(passage: int):
    """Passages that several shards of one anchor hold: each looks itself up in the sorted prints of all shards.

    Binary search by the first print gives the candidates, and the second print must be the same too.
    """

    def run(table: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(v.as_buffer(), np.int64).reshape(6, -1) for chunk in table.column("prints").chunks for v in chunk]
        rows = np.concatenate(blobs, axis=1)
        rows = rows[:, np.lexsort((rows[1], rows[0]))]
        low, high = (np.searchsorted(rows[0], rows[0], side=side) for side in ("left", "right"))
        rows = rows[:, high - low > 1]
        same = (rows[0][1:] == rows[0][:-1]) & (rows[1][1:] == rows[1][:-1])
        hit = (np.append(same, False) | np.append(False, same))[: rows.shape[1]] & (rows[5] == 0)
        columns = _union(rows[2][hit], rows[3][hit], rows[4][hit], rows[4][hit] + passage)
        return pa.table(dict(zip(("key1", "key2", "start", "end"), columns)))

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the stretches that are to be compared."""
    names = ("key1", "key2", "start", "anchor", "ask", "part")
    for batch in slices(batches, "text", 8_000_000):
        rows: dict[str, list] = {k: [] for k in (*names, "content")}
        wanted = batch.column("wanted").to_pylist()
        for key1, key2, text, asks in zip(batch.column("key1").to_pylist(), batch.column("key2").to_pylist(), batch.column("text").to_pylist(), wanted):
            data = (text or "").encode()
            for ask in asks or []:
                for k, v in zip((*names, "content"), (key1, key2, ask["start"], ask["anchor"], ask["ask"], ask["part"], data[ask["start"] : ask["end"]])):
                    rows[k].append(v)
        yield pa.RecordBatch.from_arrays([*(pa.array(rows[k], pa.int64()) for k in names), pa.array(rows["content"], pa.binary())], [*names, "content"])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in slices(batches, "text", 8_000_000):
        rows: list[tuple] = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            data, merged = (text or "").encode(), []
            for s, e in sorted((x["start"], x["end"]) for x in spans or []):
                if merged and s <= merged[-1]["end"]:
                    merged[-1]["end"] = max(merged[-1]["end"], e)
                else:
                    merged.append({"start": s, "end": e})
            digest, at = hashlib.sha256(), 0
            for span in merged:
                digest.update(data[at : span["start"]])
                at = span["end"]
            digest.update(data[at:])
            rows.append((len(data), merged, digest.hexdigest()))
        size, spans, digest = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(spans, kind), pa.array(digest, pa.string())], ["doc_id", "n_bytes", "spans", "kept_sha256"])


def repeated_passages(docs: DataFrame, passage: int = PASSAGE, anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_bytes, spans (array of start, end), kept_sha256 of every row of ``docs``, whose texts are UTF-8 bytes.

    A span covers bytes of strings of ``passage`` bytes that also start elsewhere, in the same or another text.

    Each passage belongs to an anchor chosen by its content alone, and texts are cut into the stretches that the passages of one
    anchor cover. Only hashes of stretches move at first: an anchor that occurs once has no repeats, and a stretch that occurs
    twice is repeated as a whole. What is left, different stretches of one anchor, is fetched once each and sharded by
    anchor; a shard gets a suffix array by Larsson-Sadakane refinement and Kasai's prefixes, and neighbours that share
    ``passage`` bytes are repeats. An anchor with more than ``shard_bytes`` of stretches is cut into several shards; their
    sorted passages are merged by binary search over 128-bit prints, one of each kind a shard, sent packed by bands of
    values. Copies are combined within tasks, so a group of copies sends one row a task, and marked bytes travel as few
    intervals as cover them. Equal stretches, whole copies among them, are told by hashes and do not reach the suffix arrays;
    only what differs does. Neither there nor between shards are bytes compared: 128 bits decide.

    Null, empty and short texts have no spans. Rows that repeat an id and a text are copies of each other like any others.
    An empty table gives no rows; further columns are ignored.
    """
    if passage <= anchor:
        raise ValueError("a passage must be longer than its anchor")
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("key1"), F.xxhash64("doc_id", F.lit(1)).alias("key2"))
    size = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(5, (size // 16_000_000).bit_length())
    deal, blobs = _deal(passage, anchor, bits)
    rows = "key1 long, key2 long, start long, end long, anchor long, ask long, part long"
    settled = durable(texts.select("text", "key1", "key2").mapInArrow(deal, blobs).groupBy("bucket").applyInArrow(_settle(shard_bytes), rows))
    asks = settled.where("ask > 0")
    wanted = asks.groupBy("key1", "key2").agg(F.collect_list(F.struct("start", "end", "anchor", "ask", "part")).alias("wanted"))
    # repeated rows are equal, and the stretch of one of them stands for all
    cut = texts.join(wanted.hint("shuffle_hash"), ["key1", "key2"]).select("doc_id", "text", "key1", "key2", "wanted")
    cut = cut.mapInArrow(_cut, "key1 long, key2 long, start long, anchor long, ask long, part long, content binary")
    total = asks.agg(F.sum(F.col("end") - F.col("start"))).first()[0] or 0
    shards = max(8, total // shard_bytes + 1)
    sharded = cut.withColumn("bucket", F.pmod(F.xxhash64("anchor", "part"), F.lit(shards)).cast("int"))
    intervals = "key1 long, key2 long, start long, end long"
    found = durable(sharded.groupBy("bucket").applyInArrow(_shards(passage, shard_bytes), f"{intervals}, anchor long, band long, prints binary"))
    merged = found.where("band >= 0").select("anchor", "band", "prints").groupBy("anchor", "band").applyInArrow(_merge(passage), intervals)
    names = ["key1", "key2", "start", "end"]
    marks = settled.where("ask = 0").select(names).unionByName(found.where("band < 0").select(names)).unionByName(merged)
    spans = marks.groupBy("key1", "key2").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    whole = texts.join(spans.hint("shuffle_hash"), ["key1", "key2"], "left").select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return whole.mapInArrow(_removed, f"doc_id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept_sha256 string")
