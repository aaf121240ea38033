"""Near-duplicate documents: an exact Jaccard join of word n-grams by signature trees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.bytewords import buffers, chain, mix, word_bounds, words
from hourloom.llm.common import open_array, own_name, save_array, shared_folder, slices
from hourloom.llm.components import components
from hourloom.session import durable

#: Tokens (n-grams) that one task compares at once; larger groups are cut into pairs of parts of half the size.
GROUP_TOKENS = 2_000_000
#: Repeated tokens of a document that tell which groups are covered by others.
_FIRST = 4
#: Nodes of one task that share a token, from which on the task itself reports them as repeated.
_FREQUENT = 64
_NONE = np.iinfo(np.int64).max


def _sets(batch: pa.RecordBatch, n: int) -> list[np.ndarray]:
    """The set of each text as sorted 64-bit hashes: n-word shingles, or all words of a shorter text as one."""
    raw, offsets = buffers(batch.column("text"))
    start, _, hashed = words(raw, offsets)
    bounds = word_bounds(start, offsets)
    shingles = chain(hashed, n) if len(hashed) >= n else np.zeros(0, np.uint64)
    out = []
    for first, end in zip(bounds[:-1], bounds[1:]):
        if end - first >= n:
            out.append(np.unique(shingles[first : end - n + 1]))
        else:
            out.append(chain(hashed[first:end], end - first) if end > first else hashed[:0])
    return out


def _identity(tokens: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return tuple(np.frombuffer(digest, np.int64).tolist())


def _prefix(tokens: np.ndarray, percent: int) -> np.ndarray:
    """A partner shares at least percent of the tokens, so it shares one of these."""
    return tokens[: len(tokens) - (percent * len(tokens) + 99) // 100 + 1]


def _slim(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = _sets(batch, n)
            ids = [_identity(s) for s in sets]
            columns = [[len(s) for s in sets], [i[0] for i in ids], [i[1] for i in ids]]
            arrays = [batch.column("doc_id"), batch.column("text_hash"), *(pa.array(c, pa.int64()) for c in columns)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_hash", "n", "node", "check"])

    return run


def _short(tokens: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket (the first bits) and the 32 bits after it: enough to count by, as a chance count only changes an order."""
    return (tokens >> np.uint64(64 - bits)).astype(np.int64), ((tokens << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


def _all_tokens(n: int, bits: int):
    """The tokens of all sets by bucket, sorted, as differences in four byte planes, which compress well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            tokens = np.sort(np.concatenate(held))
            bucket, short = _short(tokens, bits)
            edges = np.searchsorted(bucket, np.arange((1 << bits) + 1))
            full = np.flatnonzero(np.diff(edges))
            planes = [np.diff(short[edges[b] : edges[b + 1]], prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes() for b in full]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(planes, pa.binary())], ["bucket", "tokens"])

        for batch in slices(batches, "text"):
            held += _sets(batch, n)
            size += sum(len(s) for s in held[-batch.num_rows :])
            if size > 2_000_000:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return run


def _store_counts(folder: str):
    """Keep the tokens of a bucket that occur in two or more documents, and how often."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        planes = [np.frombuffer(v.as_buffer(), np.uint8).reshape(4, -1) for chunk in table.column("tokens").chunks for v in chunk]
        short = np.concatenate([np.cumsum(np.ascontiguousarray(p.T).view(np.uint32).ravel(), dtype=np.uint32) for p in planes])
        found, counts = np.unique(short, return_counts=True)
        again = counts > 1
        save_array(folder, f"tokens-{bucket}", found[again])
        save_array(folder, f"counts-{bucket}", np.minimum(counts[again], 65_535).astype(np.uint16))
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "kept": [int(again.sum())]})

    return run


def _counts_of(folder: str, full: frozenset[int], bits: int, tokens: np.ndarray) -> np.ndarray:
    """How many documents have each of the sorted tokens; 1 stands for one or none."""
    bucket, short = _short(tokens, bits)
    edges = np.searchsorted(bucket, np.arange((1 << bits) + 1))
    out = np.ones(len(tokens), np.int64)
    for b in np.flatnonzero(np.diff(edges)).tolist():
        if b in full:
            own, stored = slice(edges[b], edges[b + 1]), open_array(folder, f"tokens-{b}")
            at = np.minimum(np.searchsorted(stored, short[own]), len(stored) - 1)
            out[own] = np.where(stored[at] == short[own], open_array(folder, f"counts-{b}")[at], 1)
    return out


def _prefix_tokens(n: int, percent: int, bits: int, folder: str, full: frozenset[int]):
    """(token, node) of the prefixes' repeated tokens, as bytes by bucket; those frequent in the task as known repeats.

    The order of tokens is by the number of documents and then by hash.
    """

    def pack(tokens: np.ndarray, nodes: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((nodes, tokens))
        tokens, nodes = tokens[order], nodes[order]
        fresh = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (nodes[1:] != nodes[:-1])])
        tokens, nodes = tokens[fresh], nodes[fresh]
        heads = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        many = np.repeat(np.diff(np.append(heads, len(tokens))), np.diff(np.append(heads, len(tokens))))
        known = many >= _FREQUENT
        mark = known.copy()
        mark[1:] &= tokens[1:] != tokens[:-1]  # one of each frequent token tells its bucket that it is repeated
        nodes_sent = np.where(known, _NONE, nodes)
        sent = ~known | mark
        bucket = (tokens >> np.uint64(64 - bits)).astype(np.int64)
        edges = np.searchsorted(bucket, np.arange((1 << bits) + 1))
        rows = {k: [] for k in ("bucket", "tokens", "nodes", "known_tokens", "known_nodes")}
        for b in np.flatnonzero(np.diff(edges)):
            own = slice(edges[b], edges[b + 1])
            s, k = sent[own], known[own]
            rows["bucket"].append(int(b))
            rows["tokens"].append(tokens[own][s].tobytes())
            rows["nodes"].append(nodes_sent[own][s].tobytes())
            rows["known_tokens"].append(b"")
            rows["known_nodes"].append(b"")
            for i in range(0, int(k.sum()), 50_000):  # spread over all buckets: they only pass these on
                part = slice(i, i + 50_000)
                rows["bucket"].append(int(mix(tokens[own][k][part][:1])[0] + np.uint64(int(nodes[own][k][part][0]) & 0xFFFF)) & ((1 << bits) - 1))
                rows["tokens"].append(b"")
                rows["nodes"].append(b"")
                rows["known_tokens"].append(tokens[own][k][part].tobytes())
                rows["known_nodes"].append(nodes[own][k][part].tobytes())
        kinds = {"bucket": pa.int32()}
        yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.binary())) for k, v in rows.items()], list(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, nodes, size = [], [], 0
        for batch in slices(batches, "text"):
            sets = _sets(batch, n)
            together, where = np.unique(np.concatenate(sets), return_inverse=True)
            counts, at = _counts_of(folder, full, bits, together)[where], 0
            for own in sets:
                count, at = counts[at : at + len(own)], at + len(own)
                if (count > 1).any():
                    order = np.argsort(count, kind="stable")[: len(_prefix(own, percent))]
                    part = own[order][count[order] > 1]
                    tokens.append(part)
                    nodes.append(np.full(len(part), _identity(own)[0]))
                    size += len(part)
            if size > 1_000_000:
                yield from pack(np.concatenate(tokens), np.concatenate(nodes))
                tokens, nodes, size = [], [], 0
        if size:
            yield from pack(np.concatenate(tokens), np.concatenate(nodes))

    return run


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(v.as_buffer(), kind) for chunk in table.column(name).chunks for v in chunk] or [np.zeros(0, kind)])


def _repeats(table: pa.Table) -> pa.Table:
    """(token, node) of tokens that more than one node has."""
    tokens, nodes = _joined(table, "tokens", np.uint64), _joined(table, "nodes", np.int64)
    order = np.lexsort((nodes, tokens))
    tokens, nodes = tokens[order], nodes[order]
    if len(tokens):
        fresh = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (nodes[1:] != nodes[:-1])])
        tokens, nodes = tokens[fresh], nodes[fresh]
        heads = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        sizes = np.diff(np.append(heads, len(tokens)))
        marked = np.logical_or.reduceat(nodes == _NONE, heads)
        keep = np.repeat((sizes > 1) | marked, sizes) & (nodes != _NONE)
        tokens, nodes = tokens[keep], nodes[keep]
    tokens = np.concatenate([tokens, _joined(table, "known_tokens", np.uint64)]).view(np.int64)
    return pa.table({"token": tokens, "node": np.concatenate([nodes, _joined(table, "known_nodes", np.int64)])})


def _needed(group_tokens: int):
    """The groups that no other group covers, with the number of parts that each is cut into."""

    def run(table: pa.Table) -> pa.Table:
        token, node, n, *first = (table.column(c).to_numpy() for c in ("token", "node", "n", *(f"f{i}" for i in range(_FIRST))))
        order = np.argsort(token, kind="stable")
        token, node, n, first = token[order], node[order], n[order], [f[order] for f in first]
        heads = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        sizes = np.diff(np.append(heads, len(token)))
        covered = np.zeros(len(heads), bool)
        candidates = [f[heads] for f in first] + [pick.reduceat(f, heads) for f in first[:2] for pick in (np.minimum, np.maximum)]
        for c in candidates:  # a smaller token that all members have brings all of them together
            wide = np.repeat(c, sizes)
            has = np.logical_or.reduce([f == wide for f in first])
            covered |= np.logical_and.reduceat(has, heads) & (c < token[heads])
        keep = np.repeat(~covered & (sizes > 1), sizes)
        parts = np.repeat(-(-np.add.reduceat(n, heads) // group_tokens), sizes)
        parts = np.where(parts > 1, 2 * parts, 1)
        return pa.table({"token": token[keep], "node": node[keep], "parts": parts[keep].astype(np.int32)})

    return run


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


class _Tree:
    """Sets in order of size, four to a node and four nodes to the next: OR-combined bitmaps and ranges of sizes."""

    def __init__(self, sets: list[np.ndarray], most_bytes: int = 64_000_000):
        n = np.array([len(s) for s in sets])
        bits = 1 << int(16 * n.max() - 1).bit_length()
        while bits > 1024 and bits // 8 * len(sets) > most_bytes:
            bits //= 2
        maps = np.zeros((len(sets), bits // 64), np.uint64)
        owner = np.repeat(np.arange(len(sets)), n)
        at = mix(np.concatenate(sets)) & np.uint64(bits - 1)
        np.bitwise_or.at(maps.reshape(-1), owner * (bits // 64) + (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        spare = n - np.bitwise_count(maps).sum(1)
        self.levels = [(maps, n, n, spare)]  # bitmaps, smallest and largest size, most tokens beyond the set bits
        while len(self.levels[-1][0]) > 4:
            maps, low, high, spare = self.levels[-1]
            cut = np.arange(0, len(maps), 4)
            self.levels.append((np.bitwise_or.reduceat(maps, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.maximum.reduceat(spare, cut)))

    def pairs(self, percent: int, block_bytes: int = 32_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs x < y that may be similar, by dual traversal from the root; node pairs that cannot hold any are cut."""
        top = len(self.levels) - 1
        i, j = np.triu_indices(len(self.levels[top][0]))
        stack = [(top, i, j)]
        while stack:
            level, i, j = stack.pop()
            maps, low, high, spare = self.levels[level]
            size = max(1, block_bytes // maps[0].nbytes)
            if len(i) > size:
                stack += [(level, i[k : k + size], j[k : k + size]) for k in range(0, len(i), size)]
                continue
            fits = 100 * high[i] >= percent * low[j]  # sets are in order of size: i never holds larger ones than j
            i, j = i[fits], j[fits]
            common = np.bitwise_count(maps[i] & maps[j]).sum(1, dtype=np.int64) + np.minimum(spare[i], spare[j])
            least = np.maximum(percent * (low[i] + low[j]) / (100 + percent), percent * low[j] / 100)
            fits = common >= least - 1e-6
            i, j = i[fits], j[fits]
            if not level:
                yield i[i < j], j[i < j]
                continue
            below = len(self.levels[level - 1][0])
            for start in range(0, len(i), size // 16 + 1):
                a, b = i[start : start + size // 16 + 1], j[start : start + size // 16 + 1]
                a, b = (np.repeat(a * 4, 16) + np.tile(np.repeat(np.arange(4), 4), len(a)), np.repeat(b * 4, 16) + np.tile(np.arange(4), 4 * len(b)))
                inside = (a < below) & (b < below) & (a <= b)
                if inside.any():
                    stack.append((level - 1, a[inside], b[inside]))


def _runs(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Arrays back to back and the positions at which they begin."""
    return np.concatenate(values), np.concatenate([[0], np.cumsum([len(v) for v in values])])


def _hits(flat: np.ndarray, starts: np.ndarray, rows: np.ndarray, flag: np.ndarray) -> np.ndarray:
    """How many values of each run are flagged."""
    n = starts[rows + 1] - starts[rows]
    before = np.cumsum(n) - n
    sums = np.concatenate([[0], np.cumsum(flag[flat[np.repeat(starts[rows] - before, n) + np.arange(n.sum())]])])
    return sums[before + n] - sums[before]


def linked_pairs(
    sets: list[np.ndarray], side: np.ndarray | None, percent: int, weight: np.ndarray | None = None, earlier: list[np.ndarray] | None = None,
) -> tuple[_Forest, np.ndarray]:
    """A forest over the sets whose trees are the classes that the similar pairs of the sets make, and the links of each set.

    Every pair that may be similar is compared exactly, whether its class is joined already or not. A set's links are
    the sum of ``weight`` (1 by default) over the sets that it links with. With ``side``, pairs of one side only are left
    to other calls. ``earlier`` names the calls before this one in which a set takes part: pairs that share one are joined
    but not counted again. Sets must be in order of size.
    """
    forest, links = _Forest(len(sets)), np.zeros(len(sets), np.int64)
    weight = np.ones(len(sets), np.int64) if weight is None else weight
    if len(sets) <= 8:
        for x in range(len(sets)):
            for y in range(x + 1, len(sets)):
                if 100 * len(sets[x]) >= percent * len(sets[y]) and (side is None or side[x] != side[y]) and _similar(sets[x], sets[y], percent):
                    forest.join(x, y)
                    if earlier is None or not len(np.intersect1d(earlier[x], earlier[y])):
                        links[x] += weight[y]
                        links[y] += weight[x]
        return forest, links
    n = np.array([len(s) for s in sets])
    flat, starts = _runs(sets)
    vocabulary, flat = np.unique(flat, return_inverse=True)
    flag = np.zeros(len(vocabulary), bool)
    if earlier is not None:
        calls, first = _runs(earlier)
        known, calls = np.unique(calls, return_inverse=True)
        shared = np.zeros(len(known), bool)
    roots = np.arange(len(sets))
    for i, j in _Tree(sets).pairs(percent):
        if side is not None:
            i, j = i[side[i] != side[j]], j[side[i] != side[j]]
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        cuts = np.searchsorted(i, np.unique(i))
        for start, end in zip(cuts, [*cuts[1:], len(i)]):
            x, ys = int(i[start]), j[start:end]
            own = flat[starts[x] : starts[x + 1]]
            flag[own] = True
            common = _hits(flat, starts, ys, flag)
            flag[own] = False
            good = ys[100 * common >= percent * (n[x] + n[ys] - common)]
            other = good[roots[good] != roots[x]]
            if len(other):
                for y in other.tolist():
                    forest.join(x, y)
                met = np.unique(np.append(roots[other], roots[x]))
                roots[np.isin(roots, met)] = met[0]
            if earlier is not None and len(good):
                own = calls[first[x] : first[x + 1]]
                shared[own] = True
                good = good[_hits(calls, first, good, shared) == 0]
                shared[own] = False
            links[x] += weight[good].sum()
            links[good] += weight[x]
    return forest, links


def _compare(percent: int):
    """Links of the groups of one bucket: each class found in a group as a star, with each member's links."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["token", "i", "j", "part", "node", "rows"]).to_pydict()
        stored, others = table.column("tokens").combine_chunks(), table.column("others").combine_chunks()
        groups: dict[tuple, list[int]] = {}
        for k, key in enumerate(zip(rows["token"], rows["i"], rows["j"])):
            groups.setdefault(key, []).append(k)
        a, b, links = [], [], []
        for (token, i, j), members in groups.items():
            nodes: dict[int, int] = {}
            for k in members:
                nodes.setdefault(rows["node"][k], k)
            sets = {k: np.frombuffer(stored[k].as_buffer(), np.uint64) for k in nodes.values()}
            order = sorted(sets, key=lambda k: len(sets[k]))
            side = np.array([rows["part"][k] for k in order]) if i != j else None
            # a pair of several groups counts in the one of the least token
            earlier = [np.array([t for t in others[k].as_py() if t < token], np.int64) for k in order] if i >= 0 else None
            forest, found = linked_pairs([sets[k] for k in order], side, percent, np.array([rows["rows"][k] for k in order], np.int64), earlier)
            classes: dict[int, list[int]] = {}
            for x, k in enumerate(order):
                classes.setdefault(forest.root(x), []).append(x)
            for own in classes.values():
                if len(own) > 1:
                    a += [rows["node"][order[x]] for x in own]
                    b += [min(rows["node"][order[x]] for x in own)] * len(own)
                    links += found[own].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "links": pa.array(links, pa.int64())})

    return run


def _full(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            arrays = [batch.column("groups"), batch.column("node"), batch.column("rows"), pa.array([s.tobytes() for s in _sets(batch, n)], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["groups", "node", "rows", "tokens"])

    return run


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, n_links of every row of ``docs``.

    Two sets of n-word shingles link when 100 * common >= percent * union; component_id is the smallest doc_id
    reachable. Equal sets are one node. A link needs a common token among the first of both sets, in any one order of all
    tokens: here rare ones come first, by counts over all documents, which are kept as sorted arrays in the shared folder
    and memory-mapped by tasks. Nodes meet on such tokens if two or more have them; a text with many words of its
    own meets none. A group that a smaller common token of all its members covers
    is left out, and groups that share members are compared as one if they fit ``group_tokens``: their sets form a
    signature tree whose dual traversal cuts pairs of tree nodes by sizes and by the largest possible overlap, and what is
    left is compared exactly. Larger unions stay single groups, and of these a group of more than ``group_tokens`` tokens is cut
    by hash into parts, of which each pair is compared, so memory has a bound and no pair is lost. A task sends one row a member that
    has links: a member of its class and the number of links, so pairs are compared and counted but never listed. n_links is the
    number of other rows that a row links with, copies and other texts alike; a pair that meets in several groups counts once.

    Null and empty texts have no shingles and no links. Repeated rows get equal results; null ids are reachable but
    are named only if a class has no other id. An empty table gives no rows; further columns are ignored.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    texts = _hashed(docs)
    slim = durable(texts.mapInArrow(_slim(n), f"doc_id {kind}, text_hash long, n long, node long, check long"))
    classes = slim.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.min("n").alias("n"), F.min("check").alias("low"), F.max("check").alias("high"), F.count(F.lit(1)).alias("rows"))
    classes = classes.select("node", "least", "rows", F.when(F.col("low") != F.col("high"), F.raise_error(F.lit("two sets have one hash")).cast("long")).otherwise(F.col("n")).alias("n"))
    tokens = slim.agg(F.sum("n")).first()[0] or 0
    bits = max(6, (tokens // 2_000_000).bit_length())
    folder = shared_folder(spark, "token-counts")
    stored = texts.mapInArrow(_all_tokens(n, bits), "bucket int, tokens binary").groupBy("bucket").applyInArrow(_store_counts(folder), "bucket int, kept long")
    full = frozenset(r["bucket"] for r in stored.where("kept > 0").collect())
    blobs = "bucket int, tokens binary, nodes binary, known_tokens binary, known_nodes binary"
    repeats = texts.mapInArrow(_prefix_tokens(n, percent, bits, folder, full), blobs).groupBy("bucket").applyInArrow(_repeats, "token long, node long")
    # which of two groups covers the other is told by signed numbers: any order of tokens serves there
    by_node = repeats.groupBy("node").agg(F.array_sort(F.collect_set("token")).alias("own")).join(classes.select("node", "n"), "node")
    first = [F.coalesce(F.get("own", F.lit(i)), F.get("own", F.lit(0))).alias(f"f{i}") for i in range(_FIRST)]
    rows = by_node.select("node", "n", *first, F.explode("own").alias("token"))
    groups = rows.withColumn("bucket", F.pmod(F.hash("token"), F.lit(1 << bits))).groupBy("bucket").applyInArrow(_needed(group_tokens), "token long, node long, parts int")
    groups = durable(groups)
    # groups that share nodes are compared as one, with each set once, as long as that fits one task
    least = groups.groupBy("token").agg(F.min("node").alias("b"))
    roots = durable(components(groups.join(least, "token").select(F.col("node").alias("a"), "b")))
    sizes = roots.join(classes.select("node", "n"), "node").groupBy("root").agg(F.sum("n").alias("total"))
    placed = roots.join(sizes, "root").select("node", "root", (F.col("total") <= group_tokens).alias("fits"))
    one = placed.where("fits").select("node", F.expr("array(struct(root AS token, -1 AS i, -1 AS j, 0 AS part)) AS groups"))
    split = groups.join(placed.where("NOT fits").select("node"), "node")
    split = split.withColumn("part", F.pmod(F.xxhash64("node", F.lit(3)), F.col("parts")).cast("int"))
    both = F.expr("transform(sequence(0, parts - 1), k -> struct(token, least(part, k) AS i, greatest(part, k) AS j, part))")
    split = split.select("node", F.explode(both).alias("group")).groupBy("node").agg(F.collect_list("group").alias("groups"))
    wanted = durable(one.unionByName(split))
    place = slim.join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("at"), F.count(F.lit(1)).alias("rows"))
    place = place.join(wanted, "node").select(F.col("at.doc_id").alias("_id"), F.col("at.text_hash").alias("_hash"), "node", "rows", "groups")
    found = texts.join(place.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    sets = found.select("text", "groups", "node", "rows").mapInArrow(_full(n), "groups array<struct<token:long,i:int,j:int,part:int>>, node long, rows long, tokens binary")
    others = F.array_distinct("groups.token").alias("others")
    members = sets.select("node", "rows", "tokens", others, F.explode("groups").alias("g")).select("node", "rows", "tokens", "others", "g.*")
    buckets = 1 << max(bits, (wanted.select(F.sum(F.size("groups"))).first()[0] or 0).bit_length() - 9)
    members = members.withColumn("bucket", F.pmod(F.xxhash64("token", "i", "j"), F.lit(buckets)).cast("int"))
    links = durable(members.groupBy("bucket").applyInArrow(_compare(percent), "a long, b long, links long"))
    counts = links.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = durable(components(links.where("a != b").select("a", "b")))
    named = roots.join(classes, "node")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = roots.join(names, "root").join(counts, "node").select("node", "component_id", "links")
    several = classes.where("rows > 1").select("node", F.col("least").alias("own_id"), "rows").join(linked, "node", "full_outer")
    many = (F.coalesce("links", F.lit(0)) + F.coalesce("rows", F.lit(1)) - 1).alias("links")
    several = several.select("node", F.coalesce("component_id", "own_id").alias("component_id"), many)
    salts = 16
    several = several.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = slim.withColumn("salt", F.pmod(F.hash("doc_id", "text_hash"), F.lit(salts))).join(several, ["node", "salt"], "left")
    component = F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    links = F.when(F.col("n") > 0, F.coalesce("links", F.lit(0))).otherwise(0).cast("long")
    return rows.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), component.alias("component_id"), links.alias("n_links"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each class the one with the smallest id.

    Rows that repeat an id and a text stay together; null ids go if their class has another id.
    """
    goes = near_duplicates(docs, n, percent).where("n_shingles > 0 AND NOT doc_id <=> component_id")
    other, hashed, here = (own_name(docs, c) for c in ("_id", "_hash", "_here"))
    goes = durable(goes.select(F.col("doc_id").alias(other), F.col("text_hash").alias(hashed)).distinct())
    same = F.col("doc_id").eqNullSafe(F.col(other)) & (F.col(here) == F.col(hashed))
    return docs.withColumn(here, F.xxhash64("text")).join(goes.hint("shuffle_hash"), same, "left_anti").select(docs.columns)
