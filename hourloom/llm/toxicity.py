"""Toxicity: a bidirectional gated recurrent network with attention pooling over word and character inputs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.bytewords import buffers, mix, word_bounds, words
from hourloom.llm.common import slices

#: Words of a window, and words between the starts of two windows: every word lies in two, but for a text's ends.
SPAN, STRIDE = 32, 16
#: Labelled documents of each class that a fit reads at most, bytes of one of them, and bytes of all.
SAMPLE, TEXT_BYTES, SAMPLE_BYTES = 1200, 20_000, 9_000_000
_CHAR_BITS = 12
#: Documents of the sample that a word must be in to have a row of its own; all others share one.
_LEAST = 5
_WORD, _CHAR, _HIDDEN = 8, 6, 8


@dataclass
class Vocabulary:
    """The different words of some texts: hashes, rows of the character table of each (flat, with offsets)."""

    hashes: np.ndarray
    grams: np.ndarray
    bounds: np.ndarray


def _unique_words(raw: np.ndarray, start: np.ndarray, end: np.ndarray, hashed: np.ndarray) -> tuple[Vocabulary, np.ndarray]:
    found, first, inverse = np.unique(hashed, return_index=True, return_inverse=True)
    start, length = start[first], (end - start)[first]
    wide = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint64)
    wide = np.concatenate([wide, np.zeros(2, np.uint64)])
    many = np.maximum(length - 2, 1)
    bounds = np.concatenate([[0], np.cumsum(many)])
    at = np.arange(bounds[-1]) + np.repeat(start - bounds[:-1], many)
    grams = mix((wide[at] << np.uint64(16)) | (wide[at + 1] << np.uint64(8)) | wide[at + 2])
    short = np.repeat(length < 3, many)
    grams[short] = np.repeat(found, many)[short]
    return Vocabulary(found, (grams >> np.uint64(64 - _CHAR_BITS)).astype(np.int32), bounds), inverse


def _windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of the overlapping windows that cover all words of every text that has any."""
    many = np.diff(bounds)
    count = np.where(many > 0, np.maximum(-(-(many - SPAN) // STRIDE), 0) + 1, 0)
    text = np.repeat(np.arange(len(many)), count)
    turn = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    first = bounds[text] + turn * STRIDE
    return text, first, np.minimum(SPAN, bounds[text + 1] - first)


@dataclass
class ToxicityModel:
    """``known`` are the sorted hashes of words with rows of their own; row 0 of ``odds`` and of the word table is any other."""

    params: dict[str, np.ndarray]
    known: np.ndarray
    odds: np.ndarray

    def row(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, at + 1, 0) if len(self.known) else np.zeros(len(hashes), np.int64)

    def vectors(self, v: Vocabulary) -> np.ndarray:
        p = self.params
        chars = np.add.reduceat(p["chars"][v.grams], v.bounds[:-1], axis=0) / np.diff(v.bounds)[:, None].astype(np.float32)
        row = self.row(v.hashes)
        return np.concatenate([p["words"][row], chars, self.odds[row, None]], 1)

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The largest window score of each text; the score of no evidence for texts without words."""
        scores = np.full(len(offsets) - 1, -np.inf, np.float32)
        start, end, hashed = words(raw, offsets)
        if len(start):
            vocabulary, inverse = _unique_words(raw, start, end, hashed)
            vectors = self.vectors(vocabulary)
            ahead, back = (vectors @ self.params[f"in_{d}"] + self.params[f"bias_{d}"] for d in "fb")
            text, first, many = _windows(word_bounds(start, offsets))
            for i in range(0, len(text), 1024):
                rows = _rows(first[i : i + 1024], many[i : i + 1024], inverse)
                np.maximum.at(scores, text[i : i + 1024], forward(self.params, ahead[rows], back[rows], many[i : i + 1024])[0])
        return _sigmoid(np.where(np.isneginf(scores), np.float32(-4), scores))


def _rows(first: np.ndarray, many: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """Word rows by step and window; steps after a window's end repeat its last word and are masked."""
    step = np.minimum(np.arange(SPAN)[:, None], many - 1)
    return inverse[first + step]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(inputs: np.ndarray, recurrent: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    steps, n, _ = inputs.shape
    h, states, cache = np.zeros((n, _HIDDEN), np.float32), np.empty((steps, n, _HIDDEN), np.float32), []
    for t in range(steps):
        own, x = h @ recurrent, inputs[t]
        gates = _sigmoid(x[:, : 2 * _HIDDEN] + own[:, : 2 * _HIDDEN])
        z, r, u = gates[:, :_HIDDEN], gates[:, _HIDDEN:], own[:, 2 * _HIDDEN :]
        new = np.tanh(x[:, 2 * _HIDDEN :] + r * u)
        if keep:
            cache.append((h, z, r, u, new))
        h = new + z * (h - new)
        states[t] = h
    return states, cache


def _run_back(cache: list, recurrent: np.ndarray, d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d_inputs, d_recurrent = np.empty((*d_states.shape[:2], 3 * _HIDDEN), np.float32), np.zeros_like(recurrent)
    carry = np.zeros_like(d_states[0])
    for t in range(len(cache) - 1, -1, -1):
        h, z, r, u, new = cache[t]
        d = d_states[t] + carry
        d_new = d * (1 - z) * (1 - new * new)
        d_own = np.concatenate([d * (h - new) * z * (1 - z), d_new * u * r * (1 - r), d_new * r], 1)
        d_inputs[t] = d_own
        d_inputs[t, :, 2 * _HIDDEN :] = d_new
        d_recurrent += h.T @ d_own
        carry = d * z + d_own @ recurrent.T
    return d_inputs, d_recurrent


def forward(p: dict, ahead: np.ndarray, back: np.ndarray, many: np.ndarray, keep: bool = False):
    """Window logits from projected inputs (step, window, gate); ``back`` is read from the last word to the first."""
    # backwards, masked steps come first: they start from repeated last words, whose weight the attention takes away
    f, cache_f = _run(ahead, p["own_f"], keep)
    b, cache_b = _run(back[::-1], p["own_b"], keep)
    states = np.concatenate([f, b[::-1]], 2)
    hidden = np.tanh(states @ p["attend"])
    energy = hidden @ p["query"]
    energy[np.arange(len(energy))[:, None] >= many] = -1e9
    weight = np.exp(energy - energy.max(0))
    weight /= weight.sum(0)
    context = np.einsum("tn,tnh->nh", weight, states)
    logits = context @ p["out"] + p["out_bias"][0]
    return (logits, (states, hidden, weight, context, cache_f, cache_b)) if keep else (logits, None)


def _gradients(p: dict, vectors: np.ndarray, rows: np.ndarray, many: np.ndarray, target: np.ndarray, weights: np.ndarray) -> tuple[dict, np.ndarray]:
    ahead, back = (vectors @ p[f"in_{d}"] + p[f"bias_{d}"] for d in "fb")
    logits, (states, hidden, weight, context, cache_f, cache_b) = forward(p, ahead[rows], back[rows], many, True)
    d_logit = ((_sigmoid(logits) - target) * weights / weights.sum()).astype(np.float32)
    g = {"out": context.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
    d_context = d_logit[:, None] * p["out"]
    d_weight = np.einsum("nh,tnh->tn", d_context, states)
    d_states = weight[:, :, None] * d_context
    d_energy = weight * (d_weight - (weight * d_weight).sum(0))
    g["query"] = np.einsum("tn,tna->a", d_energy, hidden)
    d_hidden = d_energy[:, :, None] * p["query"] * (1 - hidden * hidden)
    g["attend"] = np.einsum("tnh,tna->ha", states, d_hidden)
    d_states = d_states + d_hidden @ p["attend"].T
    d_vectors = np.zeros_like(vectors)
    flat = rows.ravel()
    for d, cache, part in (("f", cache_f, d_states[:, :, :_HIDDEN]), ("b", cache_b, d_states[::-1, :, _HIDDEN:])):
        d_inputs, g[f"own_{d}"] = _run_back(cache, p[f"own_{d}"], part)
        d_inputs = (d_inputs if d == "f" else d_inputs[::-1]).reshape(-1, 3 * _HIDDEN)
        by_word = np.zeros((len(vectors), 3 * _HIDDEN), np.float32)
        np.add.at(by_word, flat, d_inputs)
        g[f"in_{d}"], g[f"bias_{d}"] = vectors.T @ by_word, by_word.sum(0)
        d_vectors += by_word @ p[f"in_{d}"].T
    return g, d_vectors


def _fresh(rng: np.random.Generator, known: int) -> dict[str, np.ndarray]:
    size = _WORD + _CHAR + 1
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {n: (0.1 * rng.standard_normal(shape)).astype(np.float32) for n, shape in (("words", (known + 1, _WORD)), ("chars", (1 << _CHAR_BITS, _CHAR)))}
    for d in "fb":
        p |= {f"in_{d}": draw(size, 3 * _HIDDEN), f"bias_{d}": np.zeros(3 * _HIDDEN, np.float32), f"own_{d}": draw(_HIDDEN, 3 * _HIDDEN)}
    return p | {"attend": draw(2 * _HIDDEN, _HIDDEN), "query": draw(_HIDDEN), "out": draw(2 * _HIDDEN), "out_bias": np.full(1, -1, np.float32)}


def fit_toxicity(texts: list[str], toxic: list[int], rounds: int = 4, steps: int = 60, batch: int = 96, seed: int = 11) -> ToxicityModel:
    """Adam on windows. A label belongs to a document: of a toxic one, its most suspicious window is the example.

    Word log-odds over the sample, one of the inputs, choose the windows of the first round and the network those of later
    rounds; clean documents give their most suspicious windows and random ones. Without both classes the model scores
    the share of toxic documents alike for all.
    """
    rng = np.random.default_rng(seed)
    label = np.array(toxic, np.int64)
    if not len(label) or label.min() == label.max():
        p = _fresh(rng, 0)
        p["out"][:] = 0
        p["out_bias"][:] = 4 if len(label) and label[0] else -4
        return ToxicityModel(p, np.zeros(0, np.uint64), np.zeros(1, np.float32))
    hashed, grams, counts, bounds = [], {}, [], [0]
    for i in range(0, len(texts), 200):
        raw, offsets = buffers(pa.array(texts[i : i + 200]))
        start, end, h = words(raw, offsets)
        part, _ = _unique_words(raw, start, end, h) if len(h) else (None, None)
        if part:
            for k, word in enumerate(part.hashes.tolist()):
                if word not in grams:
                    grams[word] = part.grams[part.bounds[k] : part.bounds[k + 1]]
        hashed.append(h)
        counts += np.diff(word_bounds(start, offsets)).tolist()
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    unique, inverse = np.unique(np.concatenate(hashed), return_inverse=True)
    own = [grams[w] for w in unique.tolist()]
    vocabulary = Vocabulary(unique, np.concatenate(own), np.concatenate([[0], np.cumsum([len(g) for g in own])]))
    owner = np.repeat(np.arange(len(label)), np.diff(bounds))
    once = np.unique(owner * (len(unique) + 1) + inverse)
    in_toxic = label[once // (len(unique) + 1)] == 1
    word = once % (len(unique) + 1)
    seen = [np.bincount(word[in_toxic == side], minlength=len(unique)) for side in (True, False)]
    odds = np.log((seen[0] + 0.5) / ((label == 1).sum() + 1)) - np.log((seen[1] + 0.5) / ((label == 0).sum() + 1))
    known = seen[0] + seen[1] >= _LEAST
    odds = np.where(known, np.clip(odds, -4, 4), 0)
    p = _fresh(rng, int(known.sum()))
    model = ToxicityModel(p, unique[known], np.concatenate([[0], odds[known]]).astype(np.float32))
    text, first, many = _windows(bounds)
    running = np.concatenate([[0], np.cumsum(np.maximum(odds[inverse], 0))])
    suspicion = running[first + many] - running[first]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    clock = 0
    held = np.arange(len(label)) % 5 == 0
    if any(not (label[side] == kind).any() for side in (held, ~held) for kind in (0, 1)):
        held[:] = False
    for turn in range(rounds):
        order = np.lexsort((-suspicion, text))
        heads = order[np.concatenate([[True], np.diff(text[order]) > 0])]
        heads = heads[~held[text[heads]]]
        good, bad = heads[label[text[heads]] == 1], heads[label[text[heads]] == 0]
        loose = np.flatnonzero((label[text] == 0) & ~held[text])
        for _ in range(steps):
            pick = np.concatenate([rng.choice(good, batch // 3), rng.choice(bad, batch // 3), rng.choice(loose, batch // 3)])
            rows = _rows(first[pick], many[pick], inverse)
            local, rows = np.unique(rows, return_inverse=True)
            rows = rows.reshape(SPAN, len(pick))
            own = [vocabulary.grams[vocabulary.bounds[w] : vocabulary.bounds[w + 1]] for w in local]
            lengths = np.array([len(o) for o in own])
            small = Vocabulary(unique[local], np.concatenate(own), np.concatenate([[0], np.cumsum(lengths)]))
            g, d_vectors = _gradients(p, model.vectors(small), rows, many[pick], (label[text[pick]] == 1).astype(np.float32), np.ones(len(pick), np.float32))
            g["words"], g["chars"] = np.zeros_like(p["words"]), np.zeros_like(p["chars"])
            np.add.at(g["words"], model.row(small.hashes), d_vectors[:, :_WORD])
            np.add.at(g["chars"], small.grams, np.repeat(d_vectors[:, _WORD : _WORD + _CHAR] / lengths[:, None], lengths, axis=0))
            clock += 1
            for k, v in g.items():
                m, s = moments[k]
                m += 0.1 * (v - m)
                s += 0.01 * (v * v - s)
                p[k] -= (0.012 * (1 - turn / (rounds + 1)) * (m / (1 - 0.9**clock)) / (np.sqrt(s / (1 - 0.99**clock)) + 1e-8)).astype(np.float32)
        vectors = model.vectors(vocabulary)
        ahead, back = (vectors @ p[f"in_{d}"] + p[f"bias_{d}"] for d in "fb")
        suspicion = np.concatenate([forward(p, ahead[r], back[r], many[i : i + 1024])[0] for i in range(0, len(text), 1024) for r in [_rows(first[i : i + 1024], many[i : i + 1024], inverse)]])
    # the threshold of 0.5 parts the largest windows of documents that were not trained on, nearer to the toxic side: clean
    # documents are far more, and have a tail that a sample shows too little of
    top = np.full(len(label), -np.inf)
    np.maximum.at(top, text, suspicion)
    if held.any():
        top, label = top[held], label[held]
    ranked = np.argsort(top)
    wrong = np.concatenate([[(label == 0).sum()], (label == 0).sum() - np.cumsum(label[ranked] == 0)]) + np.concatenate([[0], np.cumsum(label[ranked] == 1)])
    best = np.flatnonzero(wrong == wrong.min())
    at = best[len(best) // 2]
    low, high = top[ranked[max(at - 1, 0)]], top[ranked[min(at, len(top) - 1)]]
    if np.isfinite(low + high):
        p["out_bias"] -= np.float32(0.2 * low + 0.8 * high)
    return model


def _score(model: ToxicityModel):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_500_000):
            scores = model.score(*buffers(batch.column("text"))).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return score


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE, text_bytes: int = TEXT_BYTES, all_bytes: int = SAMPLE_BYTES) -> tuple[list[str], list[int]]:
    """Whole texts of up to ``text_bytes`` and their labels: ``per_class`` of each class by the hash of the id."""
    marked = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.withColumn("order", F.xxhash64("doc_id"))
    # about three times as many ids as are wanted, before any text moves: a share of the hash range, so that few ids, some
    # 6 * per_class whatever the table's size, are broadcast
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    share = F.lit(0)
    for value, count in sizes.items():
        share = F.when(F.col("toxic") == value, int(min(1.0, 3 * per_class / count) * (1 << 20)) + 1).otherwise(share)
    chosen = marked.where(F.pmod(F.col("order"), F.lit(1 << 20)) < share)
    rows = docs.where(F.octet_length("text") <= text_bytes).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("toxic").orderBy("order", "text"))).where(F.col("rank") <= per_class)
    texts, toxic, used = [], [], 0
    for row in ranked.select("text", "toxic", "rank").orderBy("rank", "toxic").toLocalIterator():
        used += len(row["text"].encode())
        if used > all_bytes:
            break
        texts.append(row["text"])
        toxic.append(row["toxic"])
    return texts, toxic


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score (0 to 1) of every row of ``docs``: its whole text in overlapping windows, the worst one counts.

    Null and empty texts get the low score of no evidence. Repeated rows get equal scores; null ids are kept; an empty
    table gives no rows; further columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_score(model), f"doc_id {kind}, score double")


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with all their columns, in one pass."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_500_000):
            yield batch.filter(pa.array(model.score(*buffers(batch.column("text"))) < threshold))

    return docs.mapInArrow(keep, docs.schema)
