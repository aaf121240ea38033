"""Fill-in-middle, source divergence and nearest neighbours on awkward rows, against plain versions."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from hourloom.llm import divergence, fill_middle, neighbour_forest


# -- fill in middle --------------------------------------------------------------------------


def _plain_output(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    letters = "ab <PSM>é漢𝄞\n"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "<P>"), (1003, "x<M>y"), (1004, "<"), (1005, "𝄞"), (None, "no id"), (None, None), (-7, "<<P<S<M"), (-8, "P>S>M>")]
    rows += [(2000 + i, ("é<" if i % 2 else "z") * 1_200_000) for i in range(3)]
    return rows + [rows[3], rows[3], (3, "other text of a repeated id")]


SCHEMA = "doc_id long, text string, output string, form string, n string, restored string, first int"


def _frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", "psm", "y", "z", 1) for d, t in rows], SCHEMA).repartition(3)


def test_fill_in_middle_against_slices(spark, texts, monkeypatch):
    got = fill_middle.fill_in_middle(_frame(spark, texts)).collect()
    want = [(d, *_plain_output(d, t)) for d, t in texts]
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_is_undone(spark, texts):
    rows = fill_middle.fill_in_middle(_frame(spark, texts)).withColumnRenamed("n", "restored")
    back, name = fill_middle.restore(rows)
    assert name == "restored_"
    assert collections.Counter((r.doc_id, r[name]) for r in back.collect()) == collections.Counter((d, t or "") for d, t in texts)


def test_fill_in_middle_by_small_windows(texts, monkeypatch):
    """Displacements carry over the windows; batches of all shapes."""
    import pyarrow as pa

    from hourloom.llm.bytewords import buffers

    monkeypatch.setattr(fill_middle, "WINDOW", 7)
    codes, markers = {"plain": 0, "psm": 1, "spm": 2}, [b"<P>", b"<S>", b"<M>"]
    some = [row for row in texts if len(row[1] or "") < 100]
    for low in range(0, len(some), 37):
        part = some[low : low + 37]
        plans = [_plain_output(d, t) for d, t in part]
        raw, offsets = buffers(pa.array([t for _, t in part], pa.string()))
        form = np.array([codes[p[1]] for p in plans])
        first = np.array([p[2] or 0 for p in plans])
        second = first + np.array([p[3] or 0 for p in plans])
        out = fill_middle.scatter(raw, offsets, np.array([p[0] for p in plans]), form, first, second, markers)
        assert out.to_pylist() == [p[4] for p in plans]
        assert fill_middle.gather(*buffers(out), form, markers).to_pylist() == [t or "" for _, t in part]


def test_fill_in_middle_of_nothing_and_bad_markers(spark):
    empty = fill_middle.fill_in_middle(_frame(spark, []).where("false"))
    assert empty.count() == 0 and fill_middle.restore(empty)[0].count() == 0
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(_frame(spark, [(1, "a")]), markers=("<P>", "<P>", "<M>"))
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(_frame(spark, [(1, "a")]), markers=("aa", "b", "c"))
    broken = spark.createDataFrame([(1, "<P>a<S>b", "psm")], "doc_id long, output string, form string")
    with pytest.raises(Exception, match="each marker once"):
        fill_middle.restore(broken)[0].collect()


def test_fill_in_middle_with_other_markers(spark):
    rows = [(i, f"text {i} of some length") for i in range(200)]
    markers = ("«pre»", "§suf", "¤")
    out = fill_middle.fill_in_middle(_frame(spark, rows), markers=markers, seed=5, cut=100, suffix_first=50)
    assert {r.form for r in out.collect()} == {"psm", "spm"}
    back, name = fill_middle.restore(out, markers=markers)
    assert {(r.doc_id, r[name]) for r in back.collect()} == set(rows)


# -- source divergence -----------------------------------------------------------------------


def _plain_divergence(rows, least, top=10):
    counts, held, groups = collections.Counter(), collections.Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode().lower())
        counts.update((lang, source, t) for t in terms)
        held.update((lang, t) for t in set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        sources = sorted(s for g, s in groups if g == lang)
        kept = sorted(t for (g, t), n in held.items() if g == lang and n >= least)
        v = len(kept)

        def share(ns):
            total = sum(ns)
            return [1 + 10**9 * (n + 2) // (total + 2 * v) for n in ns]

        p = {s: share([counts[lang, s, t] for t in kept]) for s in sources}
        q = share([sum(counts[lang, s, t] for s in sources) for t in kept])
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(map(gap, p[s], p[o])), o.encode(), o) for o in sources if o != s]
            marks = [(-gap(a, b), t, t.decode()) for t, a, b in zip(kept, p[s], q) if counts[lang, s, t] and a > b]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(marks)[:top])):
                out += [(lang, s, part, item, -value, i + 1) for i, (value, _, item) in enumerate(found)]
    return out


DOCS = "lang string, source string, text string, term string, count long, value string, a string, p0 int"


def _docs(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, "v", "a", 0) for r in rows], DOCS).repartition(4)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdéß漢") for _ in range(rng.randint(1, 4))) for _ in range(300)]
    pick = lambda: words[min(int(rng.expovariate(1 / 60)), 299)]
    rows = []
    for _ in range(500):
        lang = rng.choice(["en", "en", "en", "de", None])
        source = rng.choice(["s1", "s1", "s1", "s2", "S3", "é", "漢", None])
        text = "".join(pick().upper() + rng.choice([" ", "1", "_", "\n", "]"]) for _ in range(rng.randint(0, 80)))
        rows.append((lang, source, text))
    rows += [("en", "silent", None), ("en", "blank", " 12 "), ("xx", "only", "lone words"), ("yy", "a", None), ("yy", "b", ""), ("zz", "a", "rare"), ("zz", "b", "rare")]
    return rows + [rows[0]] * 5 + [("en", "s2", (words[0] + " ") * 50_000)]


@pytest.mark.parametrize("least", [1, 10, 10_000])
def test_source_divergence_against_plain(spark, corpus, least, monkeypatch):
    got = [tuple(r) for r in divergence.source_divergence(_docs(spark, corpus), least).collect()]
    assert sorted(got) == sorted(_plain_divergence(corpus, least))


def test_source_divergence_in_small_steps(spark, corpus, monkeypatch):
    """Blocks, buckets and compared pairs of the smallest sizes give the same."""
    monkeypatch.setattr(divergence, "NUMBERED", 20)
    monkeypatch.setattr(divergence, "BLOCK_WORDS", 1)
    got = [tuple(r) for r in divergence.source_divergence(_docs(spark, corpus), 2).collect()]
    assert sorted(got) == sorted(_plain_divergence(corpus, 2))


def test_common_cells_in_small_steps(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(1)
    names = ["b", "a", "é", "c"]
    rows = [(w, s, int(rng.integers(1, 1 << 62)), int(rng.integers(1, 10**9)), 5 + names.index(s)) for w in range(5) for s in names for _ in range(3)]
    word, source, bits, p, p0 = zip(*rows)
    table = pa.table({"lang": ["en"] * len(rows), "source": source, "word": pa.array(word, pa.int32()), "bits": pa.array(bits), "p": pa.array(p), "p0": pa.array(p0, pa.int64())})

    def summed(table):
        out = collections.Counter()
        for r in table.to_pylist():
            out[r["a"], r["b"]] += r["value"]
        return out

    want = collections.Counter()
    gap = lambda a, b: (a - b) ** 2 // (a + b)
    for x in rows:
        for y in rows:
            if x[0] == y[0] and x[1] < y[1]:
                one = gap(x[3], y[3]) - gap(x[3], y[4]) - gap(x[4], y[3]) + gap(x[4], y[4])
                want[x[1], y[1]] += (x[2] & y[2]).bit_count() * one
    assert summed(divergence._common_cells(table)) == want
    monkeypatch.setattr(divergence, "COMPARED", 4)
    assert summed(divergence._common_cells(table)) == want


def test_partial_counts_of_long_texts(monkeypatch):
    import pyarrow as pa

    text = " ".join(f"Wort{'xyzé'[i % 4]}" for i in range(4000)) + " " + "q" * 5000
    batch = pa.RecordBatch.from_pydict({"lang": ["de", "de"], "source": ["s", "s"], "text": [text, "wortx"]})
    whole = pa.Table.from_batches(divergence._partial_counts(iter([batch])))
    monkeypatch.setattr(divergence, "CHUNK", 11)
    monkeypatch.setattr(divergence, "HELD_TERMS", 1)
    parts = pa.Table.from_batches(divergence._partial_counts(iter([batch])))

    def sums(table):
        out = collections.defaultdict(lambda: [0, 0])
        for r in table.to_pylist():
            out[r["term"]][0] += r["count"]
            out[r["term"]][1] += r["documents"]
        return dict(out)

    assert sums(whole) == sums(parts) and sums(whole)["wortx"] == [1001, 2]


def test_source_divergence_of_nothing(spark, corpus):
    assert divergence.source_divergence(_docs(spark, corpus).where("false")).count() == 0


# -- nearest neighbours ----------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, digest string, tree int, part int, vector string, score string"


def _vectors(spark, rows, schema=VECTORS):
    return spark.createDataFrame([(i, v, 1, "d", 0, 0, "v", "s") for i, v in rows], schema).repartition(4)


def _true(rows, dimension, k=10):
    ok = [(i, v) for i, v in rows if v is not None and len(v) == dimension and None not in v and np.isfinite(v).all() and any(v)]
    ok = list({(i, tuple(v)) for i, v in ok})
    data = np.array([v for _, v in ok], np.float32).astype(float)
    out = {}
    for n, (i, _) in enumerate(ok):
        if i is not None and i % 100 == 0:
            near = {}
            for (j, _), d in zip(ok, np.sqrt(((data - data[n]) ** 2).sum(axis=1))):
                if j != i:
                    near[j] = min(d, near.get(j, np.inf))
            merged = out.setdefault(i, {})
            for j, d in near.items():
                merged[j] = min(d, merged.get(j, np.inf))
    top = lambda near: sorted(near.items(), key=lambda x: (x[1], x[0] is None, x[0] or 0))[:k]
    return {i: [(r + 1, j, float(d)) for r, (j, d) in enumerate(top(near))] for i, near in out.items()}


def _found(df):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r.query_id].append((r.rank, r.vec_id, r.score))
    return {i: sorted(v, key=lambda x: x[0]) for i, v in out.items()}


def _same(got, want):
    assert got.keys() == want.keys()
    for i in want:
        assert [x[:2] for x in got[i]] == [x[:2] for x in want[i]]
        assert [x[2] for x in got[i]] == pytest.approx([x[2] for x in want[i]], rel=1e-12)


@pytest.fixture(scope="module")
def awkward():
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(-100, 500)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 0.0, 0.0, 1.0]) for i in range(300)]  # many copies, queries among them
    rows += [(2000, None), (2100, []), (2200, [0.0] * 6), (2300, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2400, [float("nan")] + [1.0] * 5)]
    rows += [(2500, [float("inf")] * 6), (2600, [1.0] * 5), (None, [1.0, 2.0, 3.0, 0.0, 0.0, 1.0]), (None, [1.0, 1.0, 1.0, 0.0, 0.0, 1.0])]
    rows += [(2700, [0.0, -0.0, 1.0, 0.0, 0.0, 0.0]), (2701, [0.0, 0.0, 1.0, 0.0, 0.0, 0.0]), (2800, [3e38] * 6), (2801, [-3e38] * 6)]
    return rows + [rows[7], rows[7], (7, [1.0] * 6), (300, [0.5] * 6)]


def test_search_of_everything_is_exact(spark, awkward):
    df = neighbour_forest.nearest_neighbours(_vectors(spark, awkward), _hundredth(), budget=10**9)
    _same(_found(df), _true(awkward, 6))


def _hundredth():
    from pyspark.sql import functions as F

    return F.col("vec_id") % 100 == 0


def test_small_parts_and_blocks_are_exact(spark, awkward, monkeypatch):
    """Leaves of single vectors, parts of a few, and leaves above a part's size dealt into blocks."""
    monkeypatch.setattr(neighbour_forest, "PART_BYTES", 48 * 20)
    monkeypatch.setattr(neighbour_forest, "AT_ONCE", 2)
    for leaf_rows in (2, 10**6):
        monkeypatch.setattr(neighbour_forest, "LEAF_ROWS", leaf_rows)
        df = neighbour_forest.nearest_neighbours(_vectors(spark, awkward), _hundredth(), k=3, budget=10**9)
        _same(_found(df), _true(awkward, 6, 3))


@pytest.mark.parametrize("spread", ["even", "clustered"])
def test_recall_meets_what_is_wanted(spark, spread):
    rng = np.random.default_rng(8)
    data = rng.normal(size=(6000, 24)) if spread == "even" else rng.normal(size=(60, 24))[rng.integers(0, 60, 6000)] * 4 + rng.normal(size=(6000, 24)) / 5
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(data)]
    got, want = _found(neighbour_forest.nearest_neighbours(_vectors(spark, rows), _hundredth())), _true(rows, 24)
    met = sum(len({x[1] for x in got[i]} & {x[1] for x in want[i]}) for i in want)
    assert met >= 0.9 * sum(map(len, want.values()))
    assert all([x[0] for x in got[i]] == list(range(1, 11)) for i in want)


def test_search_order_is_nearest_box_first():
    rng = np.random.default_rng(2)
    sample = rng.normal(size=(2000, 8))
    forest = neighbour_forest.fit_forest(sample, 2000, trees=3)
    leaves = [forest.leaves(t, sample) for t in range(3)]
    query = rng.normal(size=8)
    order = list(neighbour_forest.search_order(forest, query))
    bounds = [b for _, _, b in order]
    assert bounds == sorted(bounds) and len({x[:2] for x in order}) == 3 << forest.levels
    distances = ((sample - query) ** 2).sum(axis=1)
    for tree, leaf, bound in order:
        inside = distances[leaves[tree] == leaf]
        assert len(inside) == 0 or inside.min() >= bound - 1e-9
    assert max(np.bincount(leaves[0])) <= 2 * min(np.bincount(leaves[0], minlength=1 << forest.levels))


def test_no_vectors(spark, awkward):
    nothing = _vectors(spark, awkward).where("false")
    assert neighbour_forest.nearest_neighbours(nothing, _hundredth()).count() == 0
    unusable = _vectors(spark, [(100, None), (200, []), (300, [0.0, 0.0])])
    assert neighbour_forest.nearest_neighbours(unusable, _hundredth()).count() == 0
    assert neighbour_forest.nearest_neighbours(_vectors(spark, [(100, [1.0])]), _hundredth()).count() == 0
    few = _vectors(spark, [(100, [1.0]), (1, [2.0]), (2, [2.0])])
    assert _found(neighbour_forest.nearest_neighbours(few, _hundredth())) == {100: [(1, 1, 1.0), (2, 2, 1.0)]}
