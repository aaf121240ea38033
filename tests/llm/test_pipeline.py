"""The stages of the corpus pipeline and their order, against plain Python on a small fixture."""

import collections
import random
import zlib

import pyarrow as pa
import pytest

import corpus_pipeline
from hourloom.llm import packing, toxicity
from hourloom.llm.bytewords import buffers
from tests.llm.test_operators import _sets

SCHEMA = "doc_id long, text string, lang string, text_hash string, _id long, row string, kept string, order int"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(12)
    stock = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    text = lambda n: " ".join(rng.choices(stock, k=n))
    rows = [(i, text(rng.randint(30, 80))) for i in range(160)]
    labels = [(i, i % 3 == 0) for i in range(160)] + [(None, True), (3, False), (500, None), (501, True)]
    rows = [(d, t.replace(t.split()[9], "idiot scum", 1) if d % 3 == 0 else t) for d, t in rows]
    items = [(1, text(14)), (2, "two words"), (3, None)]
    near = text(100).split()
    rows += [(200 + i, " ".join([*near[: 10 * i], "other", *near[10 * i + 1 :]])) for i in range(5)]
    rows += [(300, f"{text(20)} {items[0][1]} {text(9)}"), (301, "so TWO, words here"), (302, "two other words"), (303, items[0][1][:40])]
    rows += [(400, rows[4][1].upper()), (401, None), (402, ""), (403, "one"), (404, "ONE"), (405, "a b c d"), (500, text(20))]
    rows += [rows[5], rows[5], (None, rows[7][1]), (None, "nobody else has this text at all"), (None, "nobody else has this text at all"), (None, None), (10**12, rows[200 - 38][1])]
    folder = str(tmp_path_factory.mktemp("corpus"))
    full = [(d, t, "en", "x", 1, "r", "k", 3) for d, t in rows]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d, None if x is None else int(x)) for d, x in labels], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, labels, items


def _low(text):
    return (text or "").encode().lower()


def _without_toxic(spark, folder, rows, labels, items):
    """The sample is every labelled text that is not held out; the scores are those of single texts."""
    marked = collections.defaultdict(int)
    for d, toxic in labels:
        if d is not None and toxic is not None and zlib.crc32(str(d).encode()) % 5:
            marked[d] = max(marked[d], int(toxic))
    learned = spark.createDataFrame([(d, x) for d, x in marked.items()], "doc_id long, toxic int")
    sample = toxicity.training_sample(spark.read.parquet(f"{folder}/documents.parquet"), learned)
    assert sorted(zip(*sample)) == sorted((t, marked[d]) for d, t in rows if d in marked and t is not None)
    model = toxicity.fit_toxicity(*sample)
    return [(d, t) for d, t in rows if model.score(*buffers(pa.array([t], pa.string())))[0] < 0.5]


def _without_copies(spark, folder, rows, labels, items):
    best = {}
    for d, t in rows:
        if _low(t) not in best or (d if d is not None else -1) > (best[_low(t)] if best[_low(t)] is not None else -1):
            best[_low(t)] = d
    return [(d, t) for d, t in dict.fromkeys((d, t) for d, t in rows) if best[_low(t)] == d]


def _without_near_copies(spark, folder, rows, labels, items):
    sets = [s for _, s in _sets(rows, 5)]
    root = list(range(len(rows)))
    for _ in rows:
        before = list(root)
        for a in range(len(rows)):
            for b in range(a):
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    ids = {r: [rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None] for r in root}
    return [rows[i] for i, r in enumerate(root) if not sets[i] or rows[i][0] == min(ids[r], default=None)]


def _without_contaminated(spark, folder, rows, labels, items):
    words = lambda t: "".join(c if c.isalnum() or ord(c) > 127 else " " for c in _low(t).decode()).split()
    windows = {tuple(words(t)[k : k + 10]) for _, t in items for k in range(max(1, len(words(t)) - 9)) if words(t)}
    holds = lambda w: any(tuple(w[k : k + len(own)]) == own for own in windows for k in range(len(w)))
    return [(d, t) for d, t in rows if not holds(words(t))]


def test_stages_and_run_against_plain_python(spark, tables):
    folder, rows, labels, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plain = {"toxicity": _without_toxic, "exact_dedup": _without_copies, "ngram_join": _without_near_copies, "decontamination": _without_contaminated}
    assert [name for name, _ in corpus_pipeline.STAGES] == [*plain, "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        want = plain[name](spark, folder, rows, labels, items)
        kept = stage(spark, docs, folder)
        assert kept.schema == docs.schema
        found = kept.collect()
        assert {tuple(r)[2:] for r in found} == {("en", "x", 1, "r", "k", 3)}
        assert sorted(repr((r.doc_id, r.text)) for r in found) == sorted(map(repr, want)), name
        assert 0 < len(want) < len(rows), name
        docs, rows = spark.createDataFrame(found, SCHEMA).repartition(3), want
    encode = packing.encoder(packing.default_tokenizer())
    pieces = corpus_pipeline.packed(spark, docs, folder).collect()
    tokens = collections.Counter()
    for r in pieces:
        tokens[r.doc_id] += r.length
    expected = collections.Counter()
    for d, t in rows:
        expected[d] += len(encode(t or "")) + 1
    assert tokens == expected
    key = lambda found: sorted(repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in found)
    assert key(corpus_pipeline.run(spark, folder).collect()) == key(pieces)


def test_stages_on_an_empty_table(spark, tables):
    none = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, none, tables[0]).count() == 0, name


def test_best_fit_like_one_piece_after_another():
    rng = random.Random(6)
    for _ in range(200):
        capacity = rng.randint(2, 40)
        counts = {n: rng.randint(0, 12) for n in range(1, capacity) if rng.random() < 0.6}
        gaps = []
        for length in sorted((n for n, count in counts.items() for _ in range(count)), reverse=True):
            fits = [g for g in gaps if g >= length]
            if fits:
                gaps.remove(min(fits))
            gaps.append((min(fits) if fits else capacity) - length)
        filled = collections.Counter()
        for length, start, end, first, offset in packing.best_fit_rounds(counts, capacity):
            for sequence in range(first, first + end - start):
                filled[sequence] += length
        assert sorted(capacity - n for n in filled.values()) == sorted(gaps)
