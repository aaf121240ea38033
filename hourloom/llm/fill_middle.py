"""Fill-in-middle: every document's bytes are scattered to their places in a prompt, and gathered back.

Spark plans the cuts from hashes of the id. A task then moves whole batches: an array holds, at the byte where a segment
begins, the difference of its displacement to that of the segment before; the running sum is the displacement of every
byte. The output is one scatter by it, the restored text one gather by the displacements that the markers tell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.bytewords import buffers
from hourloom.llm.common import own_name, slices

#: Markers of prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")
#: Documents of a hundred that are cut, and of these the share that starts with the suffix.
CUT_PERCENT, SUFFIX_FIRST_PERCENT = 90, 20
#: Bytes whose displacements are held at a time.
WINDOW = 1 << 22


def _check(markers: tuple[str, str, str]) -> None:
    """A marker must not be mistaken where texts and markers touch: its first character occurs once in all of them."""
    text = "".join(markers)
    if len(markers) != 3 or not all(markers) or len(set(markers)) != 3:
        raise ValueError("three different markers are needed")
    if any(m[0] in m[1:] for m in markers) or any(text.count(m[0]) != sum(o[0] == m[0] for o in markers) for m in markers):
        raise ValueError("the first character of a marker must not occur inside a marker")
    if any(a != b and a.startswith(b) for a in markers for b in markers):
        raise ValueError("no marker may begin another one")


def _numbers(doc_id: Column, seed: int) -> list[Column]:
    """The first four 32-bit numbers of the SHA-256 of ``seed:doc_id``; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def plan_cuts(
    docs: DataFrame, markers: tuple[str, str, str] = MARKERS, seed: int = 1, cut: int = CUT_PERCENT, suffix_first: int = SUFFIX_FIRST_PERCENT
) -> DataFrame:
    """doc_id, text (null as empty), n code points, form, and the code points before the first and second cut."""
    text = F.coalesce(F.col("text"), F.lit(""))
    one, two, three, four = _numbers(F.col("doc_id"), seed)
    rows = docs.select(
        "doc_id", text.alias("text"), F.char_length(text).cast("long").alias("n"),
        one.alias("one"), two.alias("two"), three.alias("three"), four.alias("four"),
    )
    marked = F.lit(False)
    for marker in markers:
        marked = marked | F.contains(F.col("text"), F.lit(marker))
    form = (
        F.when((F.col("n") == 0) | marked | (F.col("three") % 100 >= cut), "plain")
        .when(F.col("four") % 100 < suffix_first, "spm")
        .otherwise("psm")
    )
    places = [F.col(h) % (F.col("n") + 1) for h in ("one", "two")]
    return rows.select("doc_id", "text", "n", form.alias("form"), F.least(*places).alias("first"), F.greatest(*places).alias("second"))


def _cut_bytes(raw: np.ndarray, offsets: np.ndarray, chars: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Byte positions of code points: place ``places[i]`` of text i, which has ``chars[i]`` code points.

    One scan over the batch, window by window: the code point with a number below what a window has begun lies in it.
    """
    before = np.concatenate(([0], np.cumsum(chars)))[:-1]
    wanted = before + places
    found = np.where(places >= chars, offsets[1:], -1)
    open_ = np.flatnonzero(found < 0)  # ascending numbers, as texts are in order
    seen = at = 0
    for low in range(0, len(raw), WINDOW):
        begins = np.flatnonzero((raw[low : low + WINDOW] & 0xC0) != 0x80)
        to = at + int(np.searchsorted(wanted[open_[at:]], seen + len(begins)))
        found[open_[at:to]] = low + begins[wanted[open_[at:to]] - seen]
        seen, at = seen + len(begins), to
    return np.clip(np.where(found < 0, offsets[1:], found), offsets[:-1], offsets[1:])


def _displacements(begins: np.ndarray, moves: np.ndarray, total: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(low, high, displacement of each byte between them); a segment moves by ``moves`` from its ``begins`` on.

    ``begins`` ascends; of segments that begin at one byte the last one holds it, since the others are empty.
    """
    steps = np.diff(moves, prepend=0)
    carry = 0
    for low in range(0, total, WINDOW):
        high = min(low + WINDOW, total)
        a, b = np.searchsorted(begins, [low, high])
        change = np.zeros(high - low, np.int64)
        np.add.at(change, begins[a:b] - low, steps[a:b])
        change[0] += carry
        shift = np.cumsum(change)
        carry = int(shift[-1])
        yield low, high, shift


def _layout(form: np.ndarray, prefix: np.ndarray, middle: np.ndarray, suffix: np.ndarray, marks: list[int]) -> dict[str, np.ndarray]:
    """Where each part and marker of an output begins, from the beginning of the output; ``size`` is its length.

    Forms: 0 plain, 1 prefix first, 2 suffix first; ``marks`` are the byte lengths of the markers.
    """
    p, s, m = marks
    cut, late = form > 0, form == 2
    prefix_mark = np.where(late, s + suffix, 0)
    suffix_mark = np.where(late, 0, p + prefix)
    middle_mark = p + prefix + s + suffix
    return {
        "prefix_mark": prefix_mark, "suffix_mark": suffix_mark, "middle_mark": middle_mark,
        "prefix": np.where(cut, prefix_mark + p, 0),
        "suffix": np.where(cut, suffix_mark + s, prefix + middle),
        "middle": np.where(cut, middle_mark + m, prefix),
        "size": prefix + middle + suffix + np.where(cut, p + s + m, 0),
    }


def _texts(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(data))


def _segments(offsets: np.ndarray, a: np.ndarray, b: np.ndarray, to: np.ndarray, place: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Begin of every segment in the text, and how far it moves, for texts at ``offsets`` and outputs at ``to``."""
    begins = np.stack([offsets[:-1], a, b], axis=1)
    moves = np.stack([place["prefix"], place["middle"], place["suffix"]], axis=1) + to[:, None] - begins
    return begins.ravel(), moves.ravel()


def scatter(raw: np.ndarray, offsets: np.ndarray, chars: np.ndarray, form: np.ndarray, first: np.ndarray, second: np.ndarray, markers: list[bytes]) -> pa.Array:
    """The outputs of a batch of texts."""
    a, b = (np.where(form > 0, _cut_bytes(raw, offsets, chars, c), offsets[1:]) for c in (first, second))
    place = _layout(form, a - offsets[:-1], b - a, offsets[1:] - b, [len(m) for m in markers])
    ends = np.cumsum(place["size"])
    to = ends - place["size"]
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    begins, moves = _segments(offsets, a, b, to, place)
    for low, high, shift in _displacements(begins, moves, len(raw)):
        out[np.arange(low, high) + shift] = raw[low:high]
    cut = form > 0
    for name, marker in zip(("prefix_mark", "suffix_mark", "middle_mark"), markers):
        out[(to + place[name])[cut][:, None] + np.arange(len(marker))] = np.frombuffer(marker, np.uint8)
    return _texts(out, ends)


def _find(raw: np.ndarray, offsets: np.ndarray, wanted: np.ndarray, marker: bytes) -> np.ndarray:
    """Where the marker begins in each wanted text, from the text's begin; each must hold it exactly once."""
    code = np.frombuffer(marker, np.uint8)
    hits = []
    for low in range(0, len(raw) - len(code) + 1, WINDOW):
        high = min(low + WINDOW, len(raw) - len(code) + 1)
        match = raw[low:high] == code[0]
        for i in range(1, len(code)):
            match &= raw[low + i : high + i] == code[i]
        hits.append(np.flatnonzero(match) + low)
    hits = np.concatenate(hits) if hits else np.zeros(0, np.int64)
    text = np.searchsorted(offsets, hits, side="right") - 1
    inside = wanted[text] & (hits + len(code) <= offsets[text + 1])
    hits, text = hits[inside], text[inside]
    if not np.array_equal(text, np.flatnonzero(wanted)):
        raise ValueError("an output does not hold each marker once")
    at = np.zeros(len(offsets) - 1, np.int64)
    at[text] = hits - offsets[text]
    return at


def gather(raw: np.ndarray, offsets: np.ndarray, form: np.ndarray, markers: list[bytes]) -> pa.Array:
    """The texts of a batch of outputs, from the places of the markers in them."""
    p, s, m = (len(marker) for marker in markers)
    cut, late, size = form > 0, form == 2, np.diff(offsets)
    prefix_at, suffix_at, middle_at = (_find(raw, offsets, cut, marker) for marker in markers)
    prefix = np.where(cut, np.where(late, middle_at - prefix_at, suffix_at - prefix_at) - p, size)
    suffix = np.where(cut, np.where(late, prefix_at - suffix_at, middle_at - suffix_at) - s, 0)
    middle = np.where(cut, size - middle_at - m, 0)
    if (np.minimum(np.minimum(prefix, suffix), middle) < 0).any():
        raise ValueError("the markers of an output are not in the order of its form")
    place = _layout(form, prefix, middle, suffix, [p, s, m])
    ends = np.cumsum(prefix + middle + suffix)
    starts = np.concatenate(([0], ends))
    begins, moves = _segments(starts, starts[:-1] + prefix, starts[:-1] + prefix + middle, offsets[:-1], place)
    text = np.empty(int(starts[-1]), np.uint8)
    for low, high, shift in _displacements(begins, moves, len(text)):
        text[low:high] = raw[np.arange(low, high) + shift]
    return _texts(text, ends)


def _forms(values: pa.Array) -> np.ndarray:
    names = ["plain", "psm", "spm"]
    codes = pc.index_in(values, value_set=pa.array(names, pa.string()))
    if codes.null_count:
        raise ValueError("a form must be plain, psm or spm")
    return codes.to_numpy(zero_copy_only=False).astype(np.int64)


def fill_in_middle(
    docs: DataFrame, markers: tuple[str, str, str] = MARKERS, seed: int = 1, cut: int = CUT_PERCENT, suffix_first: int = SUFFIX_FIRST_PERCENT
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of every row of ``docs``.

    Cuts fall between code points, by hashes of the seed and the id, so a repeated row gets the same output. Null text
    counts as empty; empty texts and those that hold a marker stay as they are (``plain``, without cut counts), as do
    all but ``cut`` of a hundred others. A null id hashes as empty text. Texts of any length are moved window by window; an empty
    table gives no rows, and further columns are ignored, whatever their names.
    """
    _check(markers)
    codes = [m.encode() for m in markers]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            raw, offsets = buffers(batch.column("text"))
            chars, first, second = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "first", "second"))
            output = scatter(raw, offsets, chars, _forms(batch.column("form")), first, second, codes)
            rows = [batch.column(c) for c in ("doc_id", "n", "form", "prefix_chars", "middle_chars")]
            yield pa.RecordBatch.from_arrays([*rows, output], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    planned = plan_cuts(docs, markers, seed, cut, suffix_first)
    counted = F.col("form") != "plain"
    planned = planned.select(
        "*", F.when(counted, F.col("first")).alias("prefix_chars"), F.when(counted, F.col("second") - F.col("first")).alias("middle_chars")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return planned.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(rows: DataFrame, output: str = "output", form: str = "form", markers: tuple[str, str, str] = MARKERS) -> tuple[DataFrame, str]:
    """``rows`` with the text that each output was made of, and the name of that column.

    Only the output and its form are read. An output without exactly its three markers, or an unknown form, stops the job. A null output
    counts as empty.
    """
    _check(markers)
    codes, name = [m.encode() for m in markers], own_name(rows, "restored")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, output):
            raw, offsets = buffers(batch.column(output))
            yield batch.append_column(name, gather(raw, offsets, _forms(batch.column(form)), codes))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, `{name}` string"), name
