"""The document operators on awkward rows, each against a brute-force version or an exact property."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from hourloom.llm import decontamination, exact_dedup, language, language_model, ngram_join, packing, secrets, sharding, suffix_dedup, toxicity

SCHEMA = "doc_id long, text string, lang string, text_hash string, node long, bucket string, row string, kept string"


def _frame(spark, rows):
    """With extra columns whose names clash with those used inside."""
    return spark.createDataFrame([(d, t, "en", "x", 1, "b", "r", "k") for d, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé ß"[:6]) for _ in range(rng.randint(2, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = text(120)
    out = [(i, text(rng.randint(1, 150))) for i in range(40)]
    out += [(100 + i, f"{text(30)} {shared} {text(10)}") for i in range(6)]
    base = text(200).split()
    for i in range(25):
        own = list(base)
        for _ in range(rng.randint(0, 8)):
            own[rng.randrange(200)] = word()
        out.append((200 + i, " ".join(own)))
    out += [(300 + i, out[45][1].upper() if i % 2 else out[45][1]) for i in range(8)]
    out += [(400, None), (401, ""), (402, " \n\t "), (403, "one two"), (404, "ONE two"), (405, None), (406, "a " * 3000), (407, "x" * 5000)]
    return out + [out[3], out[3], (None, out[3][1]), (None, None), (None, None)]


def test_exact_groups(spark, rows):
    groups = collections.defaultdict(list)
    low = lambda t: bytes(t or "", "utf8").lower()
    for d, t in rows:
        groups[low(t)].append(d)
    want = []
    for d, t in rows:
        ids = [x for x in groups[low(t)] if x is not None]
        keep = max(ids) if ids else None
        want.append((d, keep, len(groups[low(t)]), d == keep, hashlib.sha256(low(t)).hexdigest()))
    got = [tuple(r) for r in exact_dedup.exact_groups(_frame(spark, rows), salts=4).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    kept = [(r.doc_id, low(r.text)) for r in exact_dedup.drop_copies(_frame(spark, rows)).collect()]
    assert len(kept) == len(set(t for _, t in kept)) == len(groups)


def test_sharding_is_exact_and_repeatable(spark, rows):
    frame = _frame(spark, rows).cache()
    got = sharding.shuffle_into_shards(frame, 7).collect()
    sizes = collections.Counter(r.shard for r in got)
    assert len(got) == len(rows) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in sizes:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sizes[shard]))
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in rows)
    assert sorted((r["size"], r.text_crc32) for r in got) == want
    assert sorted(map(repr, got)) == sorted(map(repr, sharding.shuffle_into_shards(frame, 7).collect()))


def test_communication_matrix_is_hypergeometric():
    draws = [sharding.communication_matrix([6, 4], 2, seed)[0, 0] for seed in range(4000)]
    law = {k: v / 252 for k, v in {1: 6, 2: 60, 3: 120, 4: 60, 5: 6}.items()}
    for k, p in law.items():
        assert abs(draws.count(k) / 4000 - p) < 0.03


def test_secrets_against_plain_patterns(spark):
    rng = random.Random(2)
    parts = ['api_key = "abc123xyz"', "token=token=abcdefgh", "secret=token: abcdef", "AKIA" + "Z9" * 10, "AKIAshort", "f" * 24, "0f" * 30, "password: é", "ſecret=abcdefg", "Passwd='q1w2e3r4'", "client_id=maria", "x" * 40, "Ab1" * 14]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))) for i in range(60)] + [(90, None), (91, ""), (None, parts[0]), (90, None)]
    got = collections.defaultdict(list)
    for r in secrets.find_secrets(_frame(spark, rows)).selectExpr("doc_id", "base", "linked").collect():
        kinds = [s.kind for s in r.base]
        spans = ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.base)
        got[r.doc_id].append((kinds.count("assign"), kinds.count("access"), kinds.count("hex"), hashlib.sha256(spans.encode()).hexdigest()))
    want = collections.defaultdict(list)
    for d, t in rows:
        want[d].append(secrets.brute_base(t))
    assert {d: sorted(v) for d, v in got.items()} == {d: sorted(v) for d, v in want.items()}


def test_weak_parts_need_their_complement(spark):
    key = "Ab1" * 14
    rows = [(1, f"client_id=maria and {key}"), (2, key), (3, f"client_id=maria\n\n{key}"), (4, "client_id=maria " + "w " * 300 + key), (5, f"db://host/x client_id=m1a {key}")]
    got = {r.doc_id: [s.kind for s in r.linked] for r in secrets.find_secrets(_frame(spark, rows)).collect()}
    assert got == {1: ["linked_identifier", "linked_secret"], 2: [], 3: [], 4: [], 5: ["linked_endpoint", "linked_identifier", "linked_secret"]}


def test_links_measure_the_gap_between_parts(spark):
    name, long = "client_id=maria", "Ab1" * 150
    texts = [f"{long} {name}", f"{name} {long}", f"db://{'h' * 500} {long} {name}", f"{long}{' ' * 400}{name}", f"{long}{' ' * 401}{name}", f"{name} x:// {long} {' ' * 390} a://bcde"]
    rng = random.Random(8)
    parts = [name, long, "Ab1" * 12, "secret=abcdef", "AKIA" + "Z9" * 10, "db://host/x", "\n\n", "w " * 150, "w " * 201]
    texts += [" ".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(80)]
    want = {}
    for i, text in enumerate(texts):
        runs = secrets._long_runs(text)
        base = [(s, e, {"access": "identifier"}.get(k, "secret")) for s, e, k in secrets.base_spans(text, runs)]
        weak = [w for w in secrets._weak_parts(text, runs) if all(w[1] <= s or e <= w[0] for s, e, _ in base)]
        scope = lambda s: len([m for m in secrets._BREAK.finditer(text) if m.end() <= s])
        near = lambda p, role: any(q[2] == role and scope(p[0]) == scope(q[0]) and max(p[0], q[0]) - min(p[1], q[1]) <= 400 for q in base + weak)
        needs = {"secret": ["identifier"], "identifier": ["secret"], "endpoint": ["identifier", "secret"]}
        want[i] = sorted((s, e, f"linked_{k}") for s, e, k in weak if all(near((s, e, k), r) for r in needs[k]))
    assert [len(want[i]) for i in range(5)] == [2, 2, 2, 2, 0]
    assert {r.doc_id: [tuple(s) for s in r.linked] for r in secrets.find_secrets(_frame(spark, list(enumerate(texts)))).collect()} == want


def _sets(rows, n):
    for d, t in rows:
        w = (t or "").encode().lower().split()
        yield d, frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("group_tokens", [ngram_join.GROUP_TOKENS, 4000, 400])
def test_near_duplicates(spark, rows, group_tokens):
    rows = [r for r in rows if r[0] is not None]
    sets = dict(_sets(rows, 4))
    root = {d: d for d in sets}
    for _ in root:
        before = dict(root)
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    linked = lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    links = {d: sum(linked(d, other) for other, _ in rows) - bool(sets[d]) for d in sets}
    assert max(links.values()) > 5
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in ngram_join.near_duplicates(_frame(spark, rows), 4, 85, group_tokens).collect())
    assert got == collections.Counter((d, len(sets[d]), root[d], links[d]) for d, _ in rows)


@pytest.mark.parametrize("many", [6, 40])
def test_links_are_counted_once_over_calls(many):
    rng = np.random.default_rng(many)
    base = rng.integers(1, 1 << 62, 60).astype(np.uint64)
    sets = [np.unique(np.append(rng.choice(base, 56, replace=False), rng.integers(1, 1 << 62, rng.integers(0, 6)).astype(np.uint64))) for _ in range(many)]
    sets.sort(key=len)
    weight, side = rng.integers(1, 5, many), rng.integers(0, 2, many)
    earlier = [rng.choice(9, rng.integers(0, 3), replace=False).astype(np.int64) for _ in range(many)]
    similar = lambda x, y: x != y and 100 * len(np.intersect1d(sets[x], sets[y])) >= 85 * len(np.union1d(sets[x], sets[y]))
    for sides, calls in ((None, None), (side, None), (None, earlier), (side, earlier)):
        fits = lambda x, y: similar(x, y) and (sides is None or sides[x] != sides[y])
        new = lambda x, y: calls is None or not set(calls[x]) & set(calls[y])
        forest, links = ngram_join.linked_pairs(sets, sides, 85, weight, calls)
        assert links.tolist() == [sum(int(weight[y]) for y in range(many) if fits(x, y) and new(x, y)) for x in range(many)]
        assert all(forest.root(x) == forest.root(y) for x in range(many) for y in range(many) if fits(x, y))


def _brute_passages(rows, passage):
    seen = collections.Counter(b[i : i + passage] for _, t in rows for b in [(t or "").encode()] for i in range(len(b) - passage + 1))
    want = []
    for d, t in rows:
        b, mask = (t or "").encode(), bytearray(len((t or "").encode()))
        for i in range(len(b) - passage + 1):
            if seen[b[i : i + passage]] > 1:
                mask[i : i + passage] = b"\1" * passage
        want.append((d, len(b), sum(mask), sum(1 for x in bytes(mask).split(b"\0") if x), hashlib.sha256(bytes(x for x, m in zip(b, mask) if not m)).hexdigest()))
    return sorted(map(repr, want))


def _spans_found(rows):
    got = [(r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), r.kept_sha256) for r in rows.collect()]
    return sorted(map(repr, got))


@pytest.mark.parametrize("shard_bytes", [suffix_dedup.SHARD_BYTES, 700])
def test_repeated_passages(spark, rows, shard_bytes):
    assert _spans_found(suffix_dedup.repeated_passages(_frame(spark, rows), 60, 16, shard_bytes)) == _brute_passages(rows, 60)


def test_repeated_passages_of_one_anchor_in_many_shards(spark):
    """A phrase in every text, and passages around it that two or three texts share, over more shards than texts a shard."""
    rng = random.Random(5)
    letters = lambda n: "".join(rng.choices("abcdefghij", k=n))
    phrase, sides = letters(20), [letters(70) for _ in range(12)]
    rows = [(i, letters(30) + rng.choice(sides)[rng.randrange(40) :] + phrase + rng.choice(sides)[: rng.randrange(60)] + letters(50)) for i in range(150)]
    rows += [(200, "x" * 5_000), (201, phrase), (202, rows[7][1])]
    assert _spans_found(suffix_dedup.repeated_passages(_frame(spark, rows), 60, 16, 900)) == _brute_passages(rows, 60)


def test_intervals_of_texts():
    columns = [np.array(c, np.int64) for c in zip((1, 1, 0, 4), (1, 1, 3, 6), (1, 2, 0, 9), (0, 5, 5, 6), (1, 1, 8, 9), (1, 1, 6, 7))]
    assert [c.tolist() for c in suffix_dedup._union(*columns)] == [[0, 1, 1, 1], [5, 1, 1, 2], [5, 0, 8, 0], [6, 7, 9, 9]]
    assert [len(c) for c in suffix_dedup._union(*(c[:0] for c in columns))] == [0] * 4


@pytest.mark.parametrize("limit", [decontamination.BROADCAST_BYTES, 0])
def test_contamination(spark, rows, limit):
    words = lambda t: [w for w in "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in (t or "").encode().lower().decode()).split(" ") if w]
    items = [(1, " ".join(words(rows[42][1])[40:60])), (2, "one, two"), (3, None), (4, ""), (5, rows[50][1]), (1, "zz zz")]
    windows = {(i, tuple(words(t)[k : k + 10])) for i, t in items for k in range(max(1, len(words(t)) - 9)) if words(t)}
    want = []
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for i, own in windows:
            for k in range(len(w) - len(own) + 1):
                if tuple(w[k : k + len(own)]) == own:
                    hit |= set(range(k, k + len(own)))
                    found.add(str(i))
        want.append((d, len(w), len(hit), sorted(found)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in decontamination.contamination(_frame(spark, rows), benchmark, 10, limit).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_packing_loses_no_token(spark, rows):
    encode = packing.encoder(packing.default_tokenizer())
    got = packing.pack(_frame(spark, rows), capacity=64).collect()
    for d, t in rows:
        if d is not None and d != rows[3][0]:
            pieces = sorted((r.start, r.length, r.ids_crc32) for r in got if r.doc_id == d)
            assert pieces[0][0] == 0 and sum(p[1] for p in pieces) == len(encode(t or "")) + 1 and all(p[1] == 64 for p in pieces[1:])
    total, sequences = 0, collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        total += r.length
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) <= 1.1 * total / 64 + 2


def test_ranks_give_the_ids_of_the_file():
    from tokenizers import Tokenizer

    whole, encode = Tokenizer.from_file(packing.default_tokenizer()), packing.encoder(packing.default_tokenizer())
    for text in ("", " a  b\n\n c \t", "it's 12,3 — ñandú’s　x", "x<|endoftext|>y", "  ", "\r\n \n", "don'T !!"):
        assert encode(text) == whole.encode(text, add_special_tokens=False).ids


def test_kneser_ney_sums_to_one(spark, rows):
    docs = _frame(spark, rows)
    model = language_model.train(docs)
    got = {r.doc_id: r for r in language_model.score(docs, model).collect()}
    assert model.tokens == sum(len((t or "").split()) + 1 for _, t in rows) and got[401].n_tokens == 1
    vocabulary = {w for _, t in rows for w in (t or "").encode().lower().split()}
    probe = spark.createDataFrame([(i, w.decode()) for i, w in enumerate(sorted(vocabulary))] + [(-1, "NEVERSEEN"), (-2, "")], "doc_id long, text string")
    # the chance of all first words, each without the end that follows it, is 1
    alone = {r.doc_id: r for r in language_model.score(probe, model).collect()}
    assert all(r.score < 0 for r in alone.values()) and alone[-1].n_known == 1
    assert sum(10 ** r.score for r in alone.values()) < 1


@pytest.mark.parametrize("order", [2, 3, 4])
def test_kneser_ney_against_plain_counts(spark, rows, order):
    docs = _frame(spark, rows)
    model = language_model.train(docs, order)
    split = lambda t: (t or "").encode().lower().split() + [b""]
    grams = lambda t, n: [tuple(([b""] * (order - 1) + split(t))[i - n + order : i + order]) for i in range(len(split(t)))]
    counts = {order: collections.Counter(g for _, t in rows for g in grams(t, order))}
    for n in range(order - 1, 0, -1):
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])
    words = collections.Counter(w for _, t in rows for w in split(t))
    discount, after = {}, {n: collections.defaultdict(list) for n in counts}
    for n in counts:
        discount[n] = [0, *language_model._discounts([list(counts[n].values()).count(i) for i in (1, 2, 3, 4)])]
        for g, c in counts[n].items():
            after[n][g[:-1]].append(c)

    def chance(g):
        if not g:
            return 1 / (len(words) + 1)
        seen, d = after[len(g)][g[:-1]], discount[len(g)]
        if not seen:
            return chance(g[1:])
        c = counts[len(g)][g]
        return (max(c - d[min(c, 3)], 0) + sum(d[min(x, 3)] for x in seen) * chance(g[1:])) / sum(seen)

    probe = [(i, t) for i, (_, t) in enumerate(rows)] + [(900, "never seen words"), (901, f"new {rows[3][1]} new")]
    for r in language_model.score(_frame(spark, probe), model).collect():
        t = dict(probe)[r.doc_id]
        assert r.score == pytest.approx(sum(math.log10(chance(g)) for g in grams(t, order)))
        assert r.base_score == pytest.approx(sum(math.log10((words[w] + 0.1) / (sum(words.values()) + 0.1 * (len(words) + 1))) for w in split(t)))


def test_language_and_toxicity_on_held_out_rows(spark):
    rng = random.Random(3)
    stock = {"aa": "the of and with this reading".split(), "bb": "der und nicht mit ein straße".split()}
    texts = [(i, " ".join(rng.choice(stock[k]) for _ in range(60)), k) for i in range(200) for k in [rng.choice("ab") * 2]]
    model = language.fit_language([t for _, t, _ in texts[:150]], [k for _, _, k in texts[:150]])
    got = {r.doc_id: r for r in language.identify(_frame(spark, [(i, t) for i, t, _ in texts] + [(900, None), (901, "12 !"), (902, "")]), model).collect()}
    assert sum(got[i].lang_pred == k for i, _, k in texts[150:]) >= 49
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and got[i].rejected for i in (900, 901, 902))
    toxic = [rng.random() < 0.4 for _ in range(240)]
    said = [" ".join(rng.choice(stock["aa"]) + rng.choice("xyz") for _ in range(90)) for _ in toxic]
    said = [t.replace(t.split()[40], "idiot scum", 1) if bad else t for t, bad in zip(said, toxic)]
    net = toxicity.fit_toxicity(said[:160], [int(x) for x in toxic[:160]], rounds=2, steps=40)
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(_frame(spark, [*enumerate(said), (900, None)]), net).collect()}
    assert sum((got[i] >= 0.5) == toxic[i] for i in range(160, 240)) >= 76 and got[900] < 0.5
    kept = toxicity.drop_toxic(_frame(spark, [*enumerate(said)]), net)
    assert {r.doc_id for r in kept.collect()} == {i for i in range(240) if got[i] < 0.5}


def test_every_language_is_learned(spark):
    rng = random.Random(4)
    langs = {f"l{k:02}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for k in range(70)}
    rows = [(i * 100 + j, " ".join(rng.choices(words, k=30)), lang) for i, (lang, words) in enumerate(langs.items()) for j in range(1 + i % 3 + 20 * (i == 0))]
    rows += [(None, "no id", "l00"), (None, "no id", "l00"), (1, None, "l01"), (2, "no language", None), (3, "x" * 5000, "only a long one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    texts, labels = language.training_sample(docs)
    assert sorted(zip(texts, labels)) == sorted((t, k) for _, t, k in rows if t and k)
    texts, labels = language.training_sample(docs, 5, 71 * 450)
    counts, sizes = collections.Counter(labels), collections.Counter()
    for t, k in zip(texts, labels):
        sizes[k] += len(t)
    assert set(counts) == set(langs) | {"only a long one"} and max(counts.values()) <= 5 and counts["only a long one"] == 1
    assert all(size <= 450 for k, size in sizes.items() if counts[k] > 1)
    model = language.fit_language(*language.training_sample(docs), rounds=40)
    got = {r.doc_id: r.lang_pred for r in language.identify(docs.where("doc_id % 100 = 0"), model).collect()}
    assert sum(got[i * 100] == k for i, k in enumerate(langs)) >= 65


def test_empty_tables(spark):
    empty = _frame(spark, [(1, "x")]).where("false")
    none = spark.createDataFrame([], "item_id long, text string")
    results = [
        exact_dedup.exact_groups(empty), exact_dedup.drop_copies(empty), sharding.shuffle_into_shards(empty), secrets.find_secrets(empty),
        ngram_join.near_duplicates(empty), suffix_dedup.repeated_passages(empty), decontamination.contamination(empty, none), packing.pack(empty),
        language_model.score(empty, language_model.train(empty)), language.identify(empty, language.fit_language([], [])),
        toxicity.score_toxicity(empty, toxicity.fit_toxicity([], [])),
    ]
    assert [r.count() for r in results] == [0] * len(results)
