"""Language identification: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.bytewords import buffers, mix
from hourloom.llm.common import slices
from hourloom.session import BROADCAST_ROWS, durable

#: Most labelled documents of one language that a fit reads, and the bytes that all languages share.
SAMPLE, SAMPLE_BYTES = 400, 16_000_000
#: Groups of tasks whose smallest hashes of a language are ranked before those of all tasks.
GROUPS = 1024
_LETTER = re.compile(r"[^\W\d_]")  # with numerals such as fractions, which are no letters
_BUCKETS_BITS = 16
_GRAMS = (1, 2, 3, 4)
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32


def has_letter(text: str) -> bool:
    """Whether a character of Unicode category L is there."""
    return any(m[0].isalpha() for m in _LETTER.finditer(text))


@dataclass
class LanguageModel:
    """``weights`` is the product of the subword embeddings and the softmax matrix: one row of logits a bucket."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float


def _buckets(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each subword length the buckets of all byte n-grams, and the text each belongs to; none crosses a text.

    ASCII letters count as small ones; digits, signs and white space end up as one mark, so that layout says little.
    """
    codes = _LOWER[raw]
    codes = np.where((raw < 128) & ~((codes >= 97) & (codes <= 122)), np.uint64(32), codes)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    gram = np.zeros(len(raw), np.uint64)
    for n in range(1, max(_GRAMS) + 1):
        if len(raw) < n:
            return
        gram = gram[: len(raw) - n + 1] * np.uint64(257) + codes[n - 1 :] + np.uint64(1)
        inside = owner[: len(gram)] == owner[n - 1 :]
        hashed = (mix(gram) >> np.uint64(64 - _BUCKETS_BITS)).astype(np.int64)
        yield hashed[inside], owner[: len(gram)][inside]


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = buffers(pa.array([text]))
    grams = [b for b, _ in _buckets(raw, offsets)]
    if not grams:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    found, counts = np.unique(np.concatenate(grams), return_counts=True)
    return found, (counts / counts.sum()).astype(np.float32)


def _softmax(logits: np.ndarray) -> np.ndarray:
    odds = np.exp(logits - logits.max(-1, keepdims=True))
    return odds / odds.sum(-1, keepdims=True)


def fit_language(texts: list[str], labels: list[str], size: int = 16, rounds: int = 6, rate: float = 30.0, seed: int = 7) -> LanguageModel:
    """Stochastic gradient descent over whole texts; a tenth of them calibrates the temperature and the rejection.

    A language whose texts all fell into that tenth is learned from them instead.

    The threshold is the confidence under which one in a hundred right calibration answers falls. Without any labels the
    model knows no language and rejects everything.
    """
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    table = (rng.standard_normal((1 << _BUCKETS_BITS, size)) / size).astype(np.float32)
    head, bias = np.zeros((size, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    if not languages:
        return LanguageModel([], np.zeros((1 << _BUCKETS_BITS, 0), np.float32), bias, 1.0, 1.0)
    head = (rng.standard_normal(head.shape) / size).astype(np.float32)
    data = [(*_counts(t), languages.index(y)) for t, y in zip(texts, labels)]
    data = [d for d in data if len(d[0])]
    order = rng.permutation(len(data))
    held, rest = order[: len(data) // 10], order[len(data) // 10 :]
    learned = np.isin([data[i][2] for i in held], [data[i][2] for i in rest])
    held, rest = held[learned], np.concatenate([rest, held[~learned]])
    for step in range(rounds):
        pace = rate * (1 - step / rounds)
        for i in rng.permutation(rest):
            found, share, label = data[i]
            mean = share @ table[found]
            error = _softmax(mean @ head + bias)
            error[label] -= 1
            back = head @ error
            head -= 0.02 * pace * np.outer(mean, error)
            bias -= 0.001 * pace * error
            table[found] -= pace * share[:, None] * back
    weights = table @ head
    temperature, threshold = 1.0, 0.0
    if len(held):
        logits = np.array([data[i][1] @ weights[data[i][0]] + bias for i in held])
        truth = np.array([data[i][2] for i in held])
        loss = {t: -np.log(_softmax(logits / t)[np.arange(len(held)), truth] + 1e-9).mean() for t in np.geomspace(0.05, 20, 61)}
        temperature = float(min(loss, key=loss.get))
        sure = _softmax(logits / temperature)
        right = sure.argmax(1) == truth
        threshold = float(np.quantile(sure.max(1)[right], 0.01)) if right.any() else 1.0
    return LanguageModel(languages, weights.astype(np.float32), bias, temperature, threshold)


def _predict(model: LanguageModel):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [np.ascontiguousarray(c) for c in model.weights.T]
        for batch in slices(batches, "text", 1_500_000):
            texts = batch.column("text")
            raw, offsets = buffers(texts)
            n = batch.num_rows
            sums, grams = np.zeros((n, len(columns))), np.zeros(n)
            for hashed, owner in _buckets(raw, offsets):
                grams += np.bincount(owner, minlength=n)
                bounds = np.searchsorted(owner, np.arange(n + 1))
                for k, column in enumerate(columns):
                    running = np.concatenate([[0.0], np.cumsum(column[hashed], dtype=np.float64)])
                    sums[:, k] += running[bounds[1:]] - running[bounds[:-1]]
            letters = np.array([t is not None and has_letter(t) for t in texts.to_pylist()], bool)
            known = letters if model.languages else np.zeros(n, bool)
            lang, sure = np.full(n, "und", object), np.zeros(n)
            if known.any():
                odds = _softmax((sums[known] / np.maximum(grams[known], 1)[:, None] + model.bias) / model.temperature)
                lang[known] = np.array(model.languages, object)[odds.argmax(1)]
                sure[known] = odds.max(1)
            rejected = ~known | (sure < model.threshold)
            columns_out = [batch.column("doc_id"), pa.array(lang.tolist(), pa.string()), pa.array(np.clip(sure, 0, 1)), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays(columns_out, ["doc_id", "lang_pred", "score", "rejected"])

    return score


def training_sample(labelled: DataFrame, per_language: int = SAMPLE, most_bytes: int = SAMPLE_BYTES) -> tuple[list[str], list[str]]:
    """Whole texts and languages of every ``lang`` but null: up to ``per_language`` documents each, by the hash of the id.

    The languages share ``most_bytes`` evenly, and each has its first document whatever its size, so the sample is bounded by
    rows and bytes a language and none goes unlearned. Ranks are taken over hashes and sizes, without the texts; each task
    passes on its own smallest hashes only, and groups of tasks rank theirs first, so the one task that ranks a language reads at
    most ``GROUPS`` times ``per_language`` of them. What is left is one last hash a language, and a second scan reads the
    texts up to it, copies combined within tasks.
    """
    own = Window.partitionBy("lang").orderBy("order", "tie")
    so_far = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keyed = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", "text", F.xxhash64("doc_id", "lang").alias("order"), F.xxhash64("text").alias("tie"), F.octet_length("text").alias("bytes")
    )
    first = lambda rows, window: rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= per_language)
    grouped = keyed.drop("text").withColumn("group", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    ranked = durable(first(first(grouped, Window.partitionBy("lang", "group").orderBy("order", "tie")).drop("group", "rank"), own))
    languages = ranked.select("lang").distinct().count()
    if not languages:
        return [], []
    fits = (F.col("rank") == 1) | (F.sum("bytes").over(so_far) <= most_bytes // languages)
    last = ranked.withColumn("fits", fits).where("fits").groupBy("lang").agg(F.max(F.struct("order", "tie")).alias("last"), F.max("rank").alias("many"))
    if languages <= BROADCAST_ROWS:
        last = F.broadcast(last)
    texts = keyed.join(last, "lang").where(F.struct("order", "tie") <= F.col("last")).groupBy("lang", "order", "tie").agg(F.first("text").alias("text"))
    chosen = ranked.join(last, "lang").where(F.col("rank") <= F.col("many")).join(texts, ["lang", "order", "tie"])
    rows = list(chosen.select("lang", "text", "rank").orderBy("rank", "lang").toLocalIterator())
    return [r["text"] for r in rows], [r["lang"] for r in rows]


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score, rejected of every row of ``docs``, from whole texts.

    ``und`` with score 0 if the text is null or has no letter. ``rejected`` tells that the confidence is below what right
    answers have. Repeated rows get equal answers; null ids and an empty table need no care; further columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_predict(model), f"doc_id {kind}, lang_pred string, score double, rejected boolean")
