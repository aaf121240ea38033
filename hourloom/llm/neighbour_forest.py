"""Approximate nearest neighbours: a forest of random-projection trees, one queue over all of them, exact distances at last.

A tree splits by orthonormal random directions, one for each level, at medians that a bounded sample gives, so a leaf is a box in the
tree's projection and the squared distance of a query to the box bounds its distance to every vector inside. A query searches all
trees through one priority queue of nodes, nearest box first, until it has passed as many vectors as the wanted recall needs; that number
is measured against brute force. Spark deals every vector to its leaf of each tree, and every query once to each part it
visits; a part holds its vectors, lets queries stream by and compares exactly.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.session import durable, is_small

TREES = 3
#: Vectors of a leaf that is split no further, and of the sample that a split needs.
LEAF_ROWS, LEAF_SAMPLE = 64, 16
#: Bounds of the fitted sample: vectors, and bytes of their doubles.
SAMPLE_ROWS, SAMPLE_BYTES = 65_536, 64 << 20
#: Vectors whose true neighbours set the length of the search, and the share of these neighbours that it must meet.
MEASURED, RECALL = 200, 0.95
#: Vectors that a search passes at least.
LEAST_PASSED = 2_000
#: Bytes of doubles that a part holds, and queries it compares at a time.
PART_BYTES, AT_ONCE = 8 << 20, 64

_VECTOR = "vec_id long, digest binary, vector binary"


@dataclass(frozen=True)
class Forest:
    """Directions by tree (dimension x levels) and split values by tree and level; ``rows`` of each leaf, by tree."""

    directions: list[np.ndarray]
    splits: list[list[np.ndarray]]
    rows: list[np.ndarray] | None = None

    @property
    def levels(self) -> int:
        return len(self.splits[0])

    def leaves(self, tree: int, vectors: np.ndarray) -> np.ndarray:
        at = np.zeros(len(vectors), np.int64)
        for level, place in enumerate((vectors @ self.directions[tree]).T):
            at = at * 2 + (place > self.splits[tree][level][at])
        return at


def fit_forest(sample: np.ndarray, rows: int, trees: int = TREES, seed: int = 1) -> Forest:
    """Trees of so many levels that a leaf of ``rows`` vectors holds ``LEAF_ROWS``, as far as the sample can tell."""
    rng, dimension = np.random.default_rng(seed), sample.shape[1]
    leaves = min(rows // LEAF_ROWS, len(sample) // LEAF_SAMPLE)
    levels = min(max(leaves, 1).bit_length() - 1, dimension)
    directions, splits = [], []
    for _ in range(trees):
        axes = np.linalg.qr(rng.normal(size=(dimension, dimension)))[0][:, :levels]
        at, cuts = np.zeros(len(sample), np.int64), []
        for level, place in enumerate((sample @ axes).T):
            order = np.lexsort((place, at))
            first = np.searchsorted(at[order], np.arange((1 << level) + 1))
            middle = np.minimum((first[:-1] + first[1:]) // 2, len(sample) - 1)
            cuts.append(np.where(first[1:] > first[:-1], place[order][middle], 0.0))
            at = at * 2 + (place > cuts[level][at])
        directions.append(axes)
        splits.append(cuts)
    return Forest(directions, splits)


def search_order(forest: Forest, query: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """(tree, leaf, bound) over all trees, nearest box first, through one queue of nodes that are not yet opened."""
    places = [(query @ axes).tolist() for axes in forest.directions]
    queue = [(0.0, tree, 0, 0) for tree in range(len(places))]
    while queue:
        bound, tree, level, node = heapq.heappop(queue)
        while level < forest.levels:  # down the nearer side; the other one waits in the queue
            gap = places[tree][level] - float(forest.splits[tree][level][node])
            heapq.heappush(queue, (bound + gap * gap, tree, level + 1, node * 2 + (gap <= 0)))
            level, node = level + 1, node * 2 + (gap > 0)
        yield tree, node, bound


def visited(forest: Forest, query: np.ndarray, budget: int) -> list[list[int]]:
    """Leaves by tree that a search passes before it has met ``budget`` vectors, those met by several trees counted in each."""
    found: list[list[int]] = [[] for _ in forest.directions]
    met = 0
    for tree, leaf, _ in search_order(forest, query):
        if met >= budget:
            break
        found[tree].append(leaf)
        met += int(forest.rows[tree][leaf])
    return found


# -- vectors ---------------------------------------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length, stored as little-endian doubles."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, "<f8").reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _usable(column: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and doubles of the arrays of that length without null, NaN or infinity that are not zero throughout."""
    lengths = pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == dimension)
    picked = column.take(pa.array(rows))
    flat = picked.flatten()
    gone = np.asarray(flat.is_null())
    values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(len(rows), dimension)
    good = ~gone.reshape(len(rows), dimension).any(axis=1) & np.isfinite(values).all(axis=1) & (values != 0).any(axis=1)
    return rows[good], values[good]


def vectors_of(table: DataFrame, dimension: int, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, digest, vector) of the rows that take part; a repeated row of one id and vector is still there twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = _usable(batch.column("vector"), dimension)
            values = values + 0.0  # no negative zero: equal vectors have equal bytes
            data = [v.tobytes() for v in values.astype("<f8")]
            ids = batch.column("vec_id").take(pa.array(rows))
            digests = pa.array([sha256(d).digest()[:16] for d in data], pa.binary())
            yield pa.RecordBatch.from_arrays([ids, digests, pa.array(data, pa.binary())], names=["vec_id", "digest", "vector"])

    plain = table.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    return plain.where(F.size("vector") == dimension).mapInArrow(run, _VECTOR)


def common_length(table: DataFrame, vector_column: str = "embedding") -> int:
    """The length that most vectors have; the greater of equals, 0 if there is none."""
    lengths = table.select(F.size(vector_column).alias("n")).where("n > 0").groupBy("n").count()
    first = lengths.orderBy(F.desc("count"), F.desc("n")).first()
    return first["n"] if first else 0


def without_late_copies(vectors: DataFrame, keep: int) -> DataFrame:
    """``vectors`` without those that ``keep`` equal ones of smaller id precede: no query can list them.

    Only digests and ids of vectors with more than ``keep`` copies move.
    """
    hot = vectors.groupBy("digest").count().where(F.col("count") > keep).select("digest")
    hot = durable(hot)
    if hot.isEmpty():
        return vectors
    near = F.broadcast(hot) if is_small(hot) else hot
    order = Window.partitionBy("digest").orderBy(F.col("vec_id").asc_nulls_last())
    ids = vectors.select("digest", "vec_id").join(near, "digest").distinct()
    last = ids.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    last = durable(last.groupBy("digest").agg(F.max(F.struct(F.col("vec_id").isNull(), F.col("vec_id"))).alias("last")))
    near = F.broadcast(last) if is_small(last) else last
    early = F.col("last").isNull() | (F.struct(F.col("vec_id").isNull(), F.col("vec_id")) <= F.col("last"))
    return vectors.join(near, "digest", "left").where(early).select("vec_id", "digest", "vector")


def _sample(vectors: DataFrame, rows: int, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a sample, within its bounds, of the vectors with an id, by a hash of id and digest."""
    most = max(min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dimension)), 1)
    share = min(1.0, 0.98 * most / max(rows, 1))
    picked = F.pmod(F.xxhash64("vec_id", "digest"), F.lit(1 << 30)) < int(share * (1 << 30))
    table = vectors.where(picked & F.col("vec_id").isNotNull()).select("vec_id", "vector", F.xxhash64("digest", "vec_id").alias("order")).toArrow()
    order = np.argsort(table["order"].to_numpy(), kind="stable")[:most]
    values = _matrix(table["vector"]).reshape(len(table), dimension)[order]
    return table["vec_id"].to_numpy()[order], values


def _leaf_rows(vectors: DataFrame, forest: Forest) -> list[np.ndarray]:
    """Vectors in every leaf, by tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(forest.directions), 1 << forest.levels), np.int64)
        for batch in batches:
            values = _matrix(batch.column("vector"))
            for tree in range(len(sums) if len(values) else 0):
                sums[tree] += np.bincount(forest.leaves(tree, values), minlength=sums.shape[1])
        tree, leaf = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([tree.astype(np.int32), leaf.astype(np.int32), sums[tree, leaf]], names=["tree", "leaf", "n"])

    counted = vectors.select("vector").mapInArrow(run, "tree int, leaf int, n long").groupBy("tree", "leaf").agg(F.sum("n").alias("n"))
    rows = [np.zeros(1 << forest.levels, np.int64) for _ in forest.directions]
    for r in counted.toLocalIterator():
        rows[r["tree"]][r["leaf"]] = r["n"]
    return rows


def _nearest(distances: np.ndarray, ids: np.ndarray, none: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k nearest, ties to the smaller id and null ids last."""
    if len(distances) > k:
        edge = np.partition(distances, k - 1)[k - 1]
        near = np.flatnonzero(distances <= edge)
    else:
        near = np.arange(len(distances))
    return near[np.lexsort((ids[near], none[near], distances[near]))][:k]


def _compare(values: np.ndarray, query: np.ndarray) -> np.ndarray:
    return np.sqrt(((values - query) ** 2).sum(axis=1))


def search_length(vectors: DataFrame, forest: Forest, ids: np.ndarray, queries: np.ndarray, k: int, recall: float) -> int:
    """Vectors a search must pass to meet ``recall`` of the true ``k`` nearest of these queries, found by brute force.

    A set number of queries meets all vectors in one pass; each task hands on its k nearest of each query.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[float, int, bytes]]] = [[] for _ in queries]
        for batch in batches:
            values = _matrix(batch.column("vector"))
            none = np.asarray(batch.column("vec_id").is_null())
            own = batch.column("vec_id").fill_null(0).to_numpy(zero_copy_only=False)
            for i, query in enumerate(queries if len(values) else []):
                others = np.flatnonzero((own != ids[i]) | none)
                distances = _compare(values[others], query)
                near = _nearest(distances, own[others], none[others], k)
                best[i] += [(float(distances[j]), int(own[others[j]]), values[others[j]].tobytes()) for j in near]
                best[i] = sorted(best[i])[:k]
        rows = [(i, *row) for i, found in enumerate(best) for row in found]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.float64()),
                pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary()),
            ],
            names=["query", "distance", "vec_id", "vector"],
        )

    found = vectors.select("vec_id", "vector").mapInArrow(run, "query int, distance double, vec_id long, vector binary")
    order = Window.partitionBy("query").orderBy("distance", "vec_id", "vector")
    true = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).select("query", "vector").toArrow()
    owner, values = true["query"].to_numpy(), _matrix(true["vector"])
    needed: list[int] = []
    for i, query in enumerate(queries):
        mine = values[owner == i]
        left = {}  # leaf of each tree -> neighbours that it meets
        for tree in range(len(forest.directions) if len(mine) else 0):
            for j, leaf in enumerate(forest.leaves(tree, mine).tolist()):
                left.setdefault((tree, leaf), set()).add(j)
        unmet, passed = set(range(len(mine))), 0
        for tree, leaf, _ in search_order(forest, query) if unmet else ():
            passed += int(forest.rows[tree][leaf])
            if new := left.get((tree, leaf), set()) & unmet:
                needed += [passed] * len(new)
                unmet -= new
                if not unmet:
                    break
    return int(np.quantile(needed, recall, method="higher")) if needed else 0


# -- search ----------------------------------------------------------------------------------


def _parts(rows: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of each leaf: neighbouring leaves of about ``most`` vectors; and how many blocks a leaf above that is dealt into."""
    blocks = np.maximum(-(-rows // most), 1)
    # a leaf of several blocks is a part of its own
    part, held, number = np.zeros(len(rows), np.int32), 0, 0
    for leaf, n in enumerate(rows.tolist()):
        if held and held + n > most:
            held, number = 0, number + 1
        part[leaf] = number
        held += n
    return part, blocks


def _rows_by_part(vectors: DataFrame, forest: Forest, parts: list[tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column("vector"))
            if not len(values):
                continue
            code = np.frombuffer(b"".join(batch.column("digest").to_pylist()), "<u8")[::2]
            for tree, (part, blocks) in enumerate(parts):
                leaf = forest.leaves(tree, values)
                block = (code % blocks[leaf].astype(np.uint64)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(leaf), tree, np.int32)), pa.array(part[leaf]), pa.array(block), pa.array(np.zeros(len(leaf), np.int32)),
                        pa.array([x.tobytes() for x in leaf.astype("<i4")], pa.binary()),
                        batch.column("vec_id"), batch.column("vector"),
                    ],
                    names=_DEALT_NAMES,
                )

    return vectors.select("vec_id", "digest", "vector").mapInArrow(run, _DEALT)


_DEALT = "tree int, part int, block int, kind int, leaves binary, vec_id long, vector binary"
_DEALT_NAMES = ["tree", "part", "block", "kind", "leaves", "vec_id", "vector"]


def _queries_by_part(queries: DataFrame, forest: Forest, parts: list[tuple[np.ndarray, np.ndarray]], budget: int) -> DataFrame:
    """One row for each query and block of a part it visits, with the leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                some = batch.slice(low, 256)
                rows: list[tuple] = []
                for data in some.column("vector").to_pylist():
                    for tree, leaves in enumerate(visited(forest, np.frombuffer(data, "<f8"), budget)):
                        part, blocks = parts[tree]
                        leaves = np.sort(np.array(leaves, np.int64))
                        for p in np.unique(part[leaves]).tolist():
                            mine = leaves[part[leaves] == p]
                            packed = mine.astype("<i4").tobytes()
                            rows += [(tree, p, b, 1, packed, None, data) for b in range(int(blocks[mine].max()))]
                columns = list(zip(*rows)) or [()] * 7
                kinds = [pa.int32()] * 4 + [pa.binary(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_DEALT_NAMES)

    return queries.select("vector").mapInArrow(run, _DEALT)


class _Part:
    """The vectors of one part, by leaf."""

    def __init__(self, leaves: np.ndarray, ids: np.ndarray, none: np.ndarray, values: np.ndarray) -> None:
        self.leaves, self.ids, self.none, self.values = leaves, ids, none, values
        self.squares = (values**2).sum(axis=1)
        #: Rows whose id another row of the part has too: so many of the nearest may be of ids that are listed already.
        self.repeats = len(ids) - len(np.unique(ids[~none])) - bool(none.any())

    def answer(self, queries: np.ndarray, wanted: list[np.ndarray], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, positions, distances) of the k nearest ids in the leaves that each query visits.

        A matrix product finds all that can be among them, with room for its rounding; these are then compared exactly.
        """
        sums = (queries**2).sum(axis=1)
        with np.errstate(over="ignore", invalid="ignore"):
            rough = self.squares[None] + sums[:, None] - 2 * (queries @ self.values.T)
        rough = np.nan_to_num(rough, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
        for i, leaves in enumerate(wanted):
            inside = np.flatnonzero(np.isin(self.leaves, leaves))
            near = rough[i, inside]
            room = 1e-9 * (sums[i] + (self.squares[inside].max() if len(inside) else 0.0))
            if len(inside) > (most := k + self.repeats):
                near_enough = near <= np.partition(near, most - 1)[most - 1] + room if np.isfinite(room) else np.ones(len(near), bool)
                inside = inside[near_enough]
            with np.errstate(over="ignore"):
                distances = _compare(self.values[inside], queries[i])
            best = _nearest(distances, self.ids[inside], self.none[inside], most)
            if self.repeats:
                named = np.stack([self.none[inside[best]], self.ids[inside[best]]], axis=1)
                best = best[np.sort(np.unique(named, axis=0, return_index=True)[1])][:k]
            yield i, inside[best], distances[best]


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by part, its vectors before its queries: vectors are kept, queries answered as they pass."""
    key, held, part = None, [], None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("tree", "part", "block")], axis=1)
        kind = batch.column("kind").to_numpy()
        borders = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1) | (np.diff(kind) != 0)) + 1 if len(kind) > 1 else np.zeros(0, int)
        for low, high in zip(np.r_[0, borders], np.r_[borders, len(kind)]):
            if low == high:
                continue
            run, now = batch.slice(low, high - low), tuple(keys[low])
            if now != key:
                key, held, part = now, [], None
            if kind[low] == 0:
                ids = run.column("vec_id")
                leaves = np.frombuffer(b"".join(run.column("leaves").to_pylist()), "<i4")
                held.append((leaves, ids.fill_null(0).to_numpy(zero_copy_only=False), np.asarray(ids.is_null()), _matrix(run.column("vector"))))
                continue
            if part is None and held:
                part, held = _Part(*(np.concatenate(column) for column in zip(*held))), []
            for first in range(0, run.num_rows if part is not None else 0, AT_ONCE):
                some = run.slice(first, AT_ONCE)
                data = some.column("vector").to_pylist()
                wanted = [np.frombuffer(x, "<i4") for x in some.column("leaves").to_pylist()]
                rows = [(data[i], part.ids[at], part.none[at], d) for i, at, d in part.answer(_matrix(some.column("vector")), wanted, k) if len(at)]
                if rows:
                    digests = [sha256(row[0]).digest()[:16] for row in rows]
                    sizes = [len(row[1]) for row in rows]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(np.array(digests, object), sizes), pa.binary()),
                            pa.array(np.concatenate([row[1] for row in rows]), pa.int64(), mask=np.concatenate([row[2] for row in rows])),
                            pa.array(np.concatenate([row[3] for row in rows]), pa.float64()),
                        ],
                        names=["digest", "vec_id", "score"],
                    )


def nearest_neighbours(
    table: DataFrame,
    queries: Column,
    k: int = 10,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    trees: int = TREES,
    recall: float = RECALL,
    budget: int | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: of every row for which ``queries`` holds its ``k`` nearest others that the search meets.

    ``score`` is the Euclidean distance of the vectors in doubles, ties go to the smaller id. All vectors are indexed. The trees are fitted on at
    most ``SAMPLE_ROWS`` vectors, and the search passes ``budget`` vectors of all trees together; unless given, that number is set so that
    ``MEASURED`` vectors of the sample meet ``recall`` of their true neighbours, found by brute force. A table of few vectors is searched as a whole.

    Null, empty and zero vectors, and those with a null, NaN or infinite component or a length other than the commonest one, take no part. The
    row's own id is no neighbour of it; an id is listed once, at its nearest vector, and a row that repeats id and vector counts once. A
    null id is a neighbour like others, after all ids at the same distance. Equal query vectors are searched once. Of equal vectors only the
    ``k + 1`` smallest ids are dealt, since no list can hold others. An empty table gives no rows, and further columns are ignored.
    """
    spark = table.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    dimension = common_length(table, vector_column)
    if not dimension:
        return spark.createDataFrame([], result)
    every = vectors_of(table, dimension, id_column, vector_column)
    asked = vectors_of(table.where(queries), dimension, id_column, vector_column).where("vec_id IS NOT NULL")
    vectors = without_late_copies(every, k + 1)
    rows = vectors.count()
    if not rows:
        return spark.createDataFrame([], result)
    ids, sample = _sample(vectors, rows, dimension)
    forest = fit_forest(sample if len(sample) else np.zeros((1, dimension)), rows, trees)
    forest = Forest(forest.directions, forest.splits, _leaf_rows(vectors, forest))
    if budget is None:
        budget = search_length(vectors, forest, ids[:MEASURED], sample[:MEASURED], k, recall)
    budget = max(budget, LEAST_PASSED)
    parts = [_parts(n, max(PART_BYTES // (8 * dimension), 1)) for n in forest.rows]
    single = asked.groupBy("digest").agg(F.first("vector").alias("vector"))
    dealt = _rows_by_part(vectors, forest, parts).unionByName(_queries_by_part(single, forest, parts, budget))
    keys = ["tree", "part", "block"]
    answers = dealt.repartition(*keys).sortWithinPartitions(*keys, "kind").mapInArrow(lambda batches: _search(batches, k + 1), "digest binary, vec_id long, score double")
    once = answers.groupBy("digest", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("digest").orderBy("score", F.col("vec_id").asc_nulls_last())
    best = once.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    lists = best.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found"))
    own = asked.select(F.col("vec_id").alias("query_id"), "digest").distinct()
    others = F.slice(F.filter("found", lambda x: ~x["vec_id"].eqNullSafe(F.col("query_id"))), 1, k)
    listed = own.join(lists, "digest").select("query_id", F.posexplode(others).alias("rank", "near"))
    # an id that asks with several vectors lists the nearest of all of them
    if_repeated = listed.groupBy("query_id", "near.vec_id").agg(F.min("near.score").alias("score"))
    ranked = Window.partitionBy("query_id").orderBy("score", F.col("vec_id").asc_nulls_last())
    return (
        if_repeated.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
