"""The compact forms in which the language model is sent and stored, each against plain arrays."""

import numpy as np
import pytest

from hourloom.llm import language_model as lm


@pytest.mark.parametrize("rows", [0, 1, 7, 30_000])
@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_packed_grams_come_back(rows, n):
    rng = np.random.default_rng(rows + n)
    ids = [np.minimum(rng.zipf(1.3, rows), 2**32 - 1).astype(np.uint32) for _ in range(n)]
    values = [rng.integers(0, 1 << 40, rows), np.ones(rows, np.int64)]
    for a, b in ((ids, values), lm._merged(ids, values)):  # in order of words or not
        back, numbers = lm._unpacked(lm._packed(a, b), n, 2)
        assert all(np.array_equal(x, y) for x, y in zip(back + numbers, a + b)) and len(back) == n


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_merged_grams_against_a_table(n):
    rng = np.random.default_rng(n)
    ids = [rng.integers(0, 4, 500).astype(np.uint32) + np.uint32(2**32 - 4) for _ in range(n)]
    values = [rng.integers(0, 1 << 40, 500), np.ones(500, np.int64)]
    want = {}
    for k, row in enumerate(zip(*(c.tolist() for c in ids))):
        before = want.get(row, (0, 0))
        want[row] = (before[0] + int(values[0][k]), before[1] + 1)
    got, sums = lm._merged(ids, values)
    assert list(zip(zip(*(c.tolist() for c in got)), zip(*(v.tolist() for v in sums)))) == sorted(want.items())


@pytest.mark.parametrize(("rows", "most"), [(0, 5), (1, 5), (5000, 3), (5000, 40), (5000, 1 << 40)])
def test_coded_rows_come_back(rows, most):
    rng = np.random.default_rng(rows)
    for columns in (1, 4):
        table = rng.integers(0, most, (rows, columns))
        coded = lm._unbundle(lm._bundle(lm._coded(table)))
        at = rng.permutation(rows)
        if rows:
            assert np.array_equal(lm._decoded(*coded, at), table[at])
        assert len(coded[0]) <= 255 and (most ** columns > 255 or not len(coded[2]))


@pytest.mark.parametrize("rows", [0, 1, 2, 15, 16, 17, 3000, 200_000])
@pytest.mark.parametrize("bits", [5, 12])
def test_pages_find_what_they_hold(rows, bits):
    rng = np.random.default_rng(rows + bits)
    draw = lambda many: rng.integers(0, 1 << (64 - bits), many).astype(np.uint64) | np.uint64(3 << (64 - bits))
    held = np.unique(draw(rows))
    starts, rest = lm._unbundle(lm._bundle(lm._paged(held, bits)))
    assert np.diff(starts.astype(np.int64)).max(initial=0) < 64 and starts[-1] == len(held)
    if rows:
        assert np.array_equal(lm._place(starts, rest, held, bits), np.arange(len(held)))
        other = np.setdiff1d(draw(20_000), held)
        assert (lm._place(starts, rest, other, bits) == -1).all()


def test_a_model_of_nothing_knows_nothing(spark):
    docs = spark.createDataFrame([(1, "two words"), (2, None)], "doc_id long, text string")
    got = lm.score(docs, lm.train(docs.where("doc_id > 2"))).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.base_score, r.score) for r in got] == [(3, 0, 0.0, 0.0), (1, 0, 0.0, 0.0)]


def test_frequent_words_have_small_ids(spark):
    docs = spark.createDataFrame([(i, f"often {'some' if i % 4 else ''} w{i}") for i in range(200)], "doc_id long, text string")
    model = lm.train(docs)
    hashed = np.unique(lm._tokens(docs.selectExpr("text").toArrow().combine_chunks().to_batches()[0])[0])
    ids, counts = model.lookup(hashed)
    assert len(np.unique(ids)) == len(ids) == model.types == 203 and ids.max() < model.unknown
    assert sorted(counts.tolist())[-3:] == [150, 200, 200] and ids[counts > 1].max() < 3 << model.bits


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    from hourloom.llm.common import shuffles_removed

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with shuffles_removed(spark):
        assert spark.conf.get(name) == "true"
        assert spark.range(1000).groupBy("id").count().count() == 1000
    assert spark.conf.get(name, None) == before
