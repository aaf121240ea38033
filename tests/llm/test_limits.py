"""Bounds that hold at any size: open files, draws beyond a billion rows, tasks that rank a language."""

import math
import multiprocessing
import resource

import numpy as np
import pytest

from hourloom.llm import common, language, sharding


def _read_all(folder, many, answers):
    """In a process of its own, which has few descriptors left."""
    resource.setrlimit(resource.RLIMIT_NOFILE, (256, 256))
    try:
        for _ in range(2):
            found = [int(common.open_array(folder, f"a-{i}")[1]) for i in range(many)]
        answers.put(found)
    except OSError as error:
        answers.put(str(error))


def test_many_arrays_need_few_descriptors(tmp_path):
    for i in range(600):
        common.save_array(str(tmp_path), f"a-{i}", np.array([0, i]))
    context = multiprocessing.get_context("spawn")
    answers = context.Queue()
    child = context.Process(target=_read_all, args=(str(tmp_path), 600, answers))
    child.start()
    assert answers.get(timeout=60) == list(range(600))
    child.join()


def test_arrays_used_longest_ago_go_first(tmp_path, monkeypatch):
    monkeypatch.setattr(common, "MAPPED", 2)
    monkeypatch.setattr(common, "_opened", type(common._opened)())
    columns = [np.arange(6, dtype=np.uint32).reshape(2, 3), np.zeros((0, 4)), np.asfortranarray(np.arange(6.0).reshape(3, 2))]
    for i, c in enumerate(columns):
        common.save_array(str(tmp_path), f"c-{i}", c)
    first = common.open_array(str(tmp_path), "c-0")
    for i in (1, 0, 2, 0, 1):
        got = common.open_array(str(tmp_path), f"c-{i}")
        assert got.dtype == columns[i].dtype and np.array_equal(got, columns[i])
    assert len(common._opened) == 2 and first.tolist() == [[0, 1, 2], [3, 4, 5]]
    assert not [p for p in tmp_path.iterdir() if p.suffix != ".npy"]


@pytest.mark.parametrize(("good", "bad", "n", "quick"), [(1_500_000_000, 600_000_000, 4, 10**9), (30, 50, 25, 1), (5, 3, 7, 1), (700_000_000, 900_000_000, 1_599_999_997, 10**9)])
def test_draws_follow_the_exact_law(good, bad, n, quick):
    rng, many = np.random.default_rng(3), 20_000
    draws = np.bincount([sharding._draw(rng, good, bad, n, quick) - max(0, n - bad) for _ in range(many)])
    small = min(n, good + bad - n)  # what is left out follows the same law
    left = lambda k: math.comb(good, k) * math.comb(bad, small - k) / math.comb(good + bad, small)
    value = lambda i: i + max(0, n - bad)
    chance = [left(value(i)) if small == n else left(good - value(i)) for i in range(len(draws))]
    assert sum((d - many * p) ** 2 / (many * p) for d, p in zip(draws, chance) if many * p > 5) < 2 * len(draws) + 20
    assert all(d == 0 or p > 0 for d, p in zip(draws, chance))


def test_large_draws_have_the_right_mean_and_spread():
    rng, good, bad, n = np.random.default_rng(4), 1_250_000_000, 48_750_000_000, 12_000_000
    draws = np.array([sharding._draw(rng, good, bad, n) for _ in range(4000)])
    mean, spread = n * good / (good + bad), (n * good / (good + bad) * bad / (good + bad) * (good + bad - n) / (good + bad - 1)) ** 0.5
    assert abs(draws.mean() - mean) < 5 * spread / 4000**0.5 and abs(draws.std() / spread - 1) < 0.06


def test_sample_of_languages_is_that_of_all_rows(spark):
    """Hashes ranked by group and then by language give the rows of one ranking, copies included."""
    rows = [(i % 70, f"text {i % 70} " + "y" * (i % 7), ("aa", "bb", None)[i % 70 % 3]) for i in range(400)] + [(None, "z", "aa"), (5, None, "bb")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    hashed = frame.selectExpr("lang", "text", "xxhash64(doc_id, lang) o", "xxhash64(text) t").where("lang is not null and text is not null")
    want = {}
    for r in sorted(hashed.collect(), key=lambda r: (r.o, r.t)):
        want.setdefault(r.lang, []).append(r.text)
    texts, langs = language.training_sample(frame.repartition(9), per_language=50)
    got = {}
    for t, y in zip(texts, langs):
        got.setdefault(y, []).append(t)
    assert got == {y: t[:50] for y, t in want.items()}


def test_prediction_equals_a_plain_version(spark):
    """Averages of one row of weights a byte n-gram, in loops, against what the operator returns."""
    rng = np.random.default_rng(2)
    words = {"aa": ["lamo", "tiro", "sené"], "bb": ["gruk", "vost", "ßenk"], "cc": ["дом", "река", "свет"]}
    rows = [(i, " ".join(rng.choice(words[y], 12)), y) for i, y in enumerate(["aa", "bb", "cc"] * 30)]
    model = language.fit_language([t for _, t, _ in rows], [y for *_, y in rows])
    rows += [(900, None, None), (901, "", None), (902, "12 ½ -", None), (903, "q", None), (904, "Lamo TIRO sené\n12 " * 4000, None)]

    def plain(text):
        if text is None or not any(c.isalpha() for c in text):
            return "und", 0.0
        codes = [b + 32 if 65 <= b <= 90 else b for b in text.encode()]
        codes = [32 if b < 128 and not 97 <= b <= 122 else b for b in codes]
        seen, total, many = {}, np.zeros(3), 0
        for n in (1, 2, 3, 4):
            for i in range(len(codes) - n + 1):
                gram = 0
                for b in codes[i : i + n]:
                    gram = (gram * 257 + b + 1) & (2**64 - 1)
                if gram not in seen:
                    h = gram
                    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xBF58476D1CE4E5B9)):
                        h = ((h ^ (h >> shift)) * factor) & (2**64 - 1)
                    seen[gram] = (h ^ (h >> 32)) >> 48
                total += model.weights[seen[gram]]
                many += 1
        odds = np.exp((total / many + model.bias) / model.temperature)
        return model.languages[int(odds.argmax())], float(odds.max() / odds.sum())

    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(frame, model).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        want = plain(text)
        assert got[i][0] == want[0] and abs(got[i][1] - want[1]) < 1e-4, (i, got[i], want)
