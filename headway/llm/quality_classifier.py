"""A factorisation machine that scores the quality of texts.

Features are hashed words (log frequencies, unit length), statistics of the text's structure, and the table's
``n_chars``. Besides a weight per feature, every feature has a vector of ``RANK`` numbers, and the product of two
features' vectors weighs their product. All pairs are summed in linear time: half of the squared sum less the sum of
squares, in each of the ``RANK`` dimensions.

The model is fitted on at most ``SAMPLE`` labelled rows (those with the least hashes of their ids, a documented bound) and scored on
every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from headway.llm.texts import byte_hash, text_slices, words_of

BUCKETS = 2_048
RANK = 8
#: The most labelled rows the model is fitted on.
SAMPLE = 6_000
STEPS = 250
_STATS = 14
_SYMBOLS = b"#*$%&|<>"


def _mask(*members: int) -> np.ndarray:
    mask = np.zeros(256, dtype=bool)
    mask[list(members)] = True
    return mask


#: Rows whose squares and sums are made at a time while the machine learns.
_BLOCK = 512
_MASKS = np.stack(
    [
        _mask(*_SYMBOLS),
        _mask(*range(0x30, 0x3A)),
        _mask(*range(0x41, 0x5B)),
        _mask(*b".,;:!?'\"()-"),
        _mask(0x0A),
        _mask(*range(0xC0, 0x100)),
        _mask(*range(0x00, 0x09), *range(0x0E, 0x20), 0x7F),
    ]
)


def _repeated_share(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Share of lines that equal an earlier line of the text; lines end with a line feed."""
    if len(data) == 0:
        return np.zeros(len(offsets) - 1)
    feeds = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([offsets[:-1], feeds + 1]))
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    ends = ends - (data[ends - 1] == 0x0A)
    full = ends > starts
    starts, ends = starts[full], ends[full]
    owner = np.searchsorted(offsets, starts, side="right") - 1
    lines = byte_hash(data, 61)(starts, ends)
    order = np.lexsort((lines, owner))
    again = np.zeros(len(lines), dtype=bool)
    again[1:] = (lines[order][1:] == lines[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    n = len(offsets) - 1
    return np.bincount(owner[order][again], minlength=n) / np.maximum(1, np.bincount(owner, minlength=n))


def features(offsets: np.ndarray, data: np.ndarray, n_chars: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first text, last text, rows of features) for blocks of texts."""
    starts, ends, bounds = words_of(offsets, data)
    n = len(offsets) - 1
    sizes, words = np.diff(offsets).astype(float), np.diff(bounds).astype(float)
    bucket = (byte_hash(data, 62)(starts, ends) & np.uint64(BUCKETS - 1)).astype(np.int64)
    length = np.concatenate([[0.0], np.cumsum((ends - starts).astype(float))])
    stats = np.zeros((n, _STATS), dtype=np.float32)
    for i, mask in enumerate(_MASKS):
        running = np.concatenate([[0], np.cumsum(mask[data])])
        stats[:, i] = (running[offsets[1:]] - running[offsets[:-1]]) / np.maximum(1, sizes)
    stats[:, 7] = np.log1p(sizes)
    stats[:, 8] = np.log1p(words)
    stats[:, 9] = (length[bounds[1:]] - length[bounds[:-1]]) / np.maximum(1, words)
    stats[:, 10] = _repeated_share(offsets, data)
    stats[:, 11] = np.log1p(np.maximum(0, n_chars))
    stats[:, 12] = words < 10
    for low in range(0, n, 128):
        high = min(n, low + 128)
        own = slice(bounds[low], bounds[high])
        of_text = np.repeat(np.arange(high - low), np.diff(bounds[low : high + 1]))
        counts = np.bincount(of_text * BUCKETS + bucket[own], minlength=(high - low) * BUCKETS).reshape(high - low, BUCKETS)
        stats[low:high, 13] = (counts > 0).sum(axis=1) / np.maximum(1, np.minimum(words[low:high], BUCKETS))
        logs = np.log1p(counts).astype(np.float32)
        logs /= np.maximum(1e-6, np.linalg.norm(logs, axis=1, keepdims=True))
        yield low, high, np.concatenate([logs, stats[low:high]], axis=1)


def _inputs(docs: DataFrame) -> list[Column]:
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    n_chars = docs["n_chars"].cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return [docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.coalesce(n_chars, F.length(text).cast("double")).alias("n_chars")]


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of labelled rows, the hashed words as those that are not zero."""
    names = ["quality", "places", "values", "stats"]
    for rows, offsets, data in text_slices(batches):
        for low, high, made in features(offsets, data, rows.column("n_chars").to_numpy()):
            filled = [np.flatnonzero(x[:BUCKETS]) for x in made]
            columns = (
                [p.astype("<u2").tobytes() for p in filled],
                [x[p].astype("<f4").tobytes() for x, p in zip(made, filled, strict=True)],
                [x[BUCKETS:].astype("<f4").tobytes() for x in made],
            )
            held = [pa.array(column, pa.binary()) for column in columns]
            yield pa.RecordBatch.from_arrays([rows.column("quality").slice(low, high - low), *held], names=names)


class SparseRows:
    """Feature rows: hashed words by their places, statistics in full."""

    def __init__(self, places: list[np.ndarray], values: list[np.ndarray], stats: np.ndarray):
        none = np.zeros(0, dtype=np.float32)
        self.bounds = np.append(0, np.cumsum([len(p) for p in places])).astype(np.int64)
        self.places, self.values = np.concatenate([none.astype(np.uint16), *places]), np.concatenate([none, *values])
        self.stats = stats.reshape(-1, _STATS)

    def __len__(self) -> int:
        return len(self.stats)

    def full(self, stats: np.ndarray) -> np.ndarray:
        """All rows with the given statistics: the one array of the sample's size."""
        full = np.zeros((len(self), BUCKETS + _STATS), dtype=np.float32)
        full[np.repeat(np.arange(len(self)), np.diff(self.bounds)), self.places] = self.values
        full[:, BUCKETS:] = stats
        return full


@dataclass
class FactorisationMachine:
    """Scores scaled feature rows; ``centre`` and ``spread`` scale the statistics."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray

    def scaled_stats(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.centre) / self.spread, -4, 4) * 0.25

    def scaled(self, rows: np.ndarray) -> np.ndarray:
        rows = rows.copy()
        rows[:, BUCKETS:] = self.scaled_stats(rows[:, BUCKETS:])
        return rows

    def logits(self, rows: np.ndarray) -> np.ndarray:
        sums = rows @ self.factors
        squares = (rows * rows) @ (self.factors * self.factors)
        return self.bias + rows @ self.weights + 0.5 * (sums * sums - squares).sum(axis=1)


def fit(rows: SparseRows, labels: np.ndarray, seed: int = 3) -> FactorisationMachine:
    """Logistic loss with a small penalty, by Adam over all rows at once; what is derived of them is made for ``_BLOCK`` rows at a time."""
    stats = rows.stats
    spread = np.maximum(1e-3, stats.std(axis=0)) if len(rows) else np.ones(_STATS)
    centre = stats.mean(axis=0) if len(rows) else np.zeros(_STATS)
    width = BUCKETS + _STATS
    draw = np.random.Generator(np.random.PCG64(seed))
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99))
    machine = FactorisationMachine(
        float(np.log(share / (1 - share))),
        np.zeros(width, dtype=np.float32),
        draw.normal(0, 0.01, (width, RANK)).astype(np.float32),
        centre.astype(np.float32),
        spread.astype(np.float32),
    )
    if len(rows) == 0 or labels.min() == labels.max():
        machine.factors[:] = 0  # nothing to tell texts apart by
        return machine
    held = rows.full(machine.scaled_stats(stats))
    state = [np.zeros_like(machine.weights), np.zeros_like(machine.weights), np.zeros_like(machine.factors), np.zeros_like(machine.factors), 0.0, 0.0]
    for step in range(1, STEPS + 1):
        grads = [1e-5 * machine.weights, 1e-5 * machine.factors, 0.0]
        squares = machine.factors * machine.factors
        for low in range(0, len(held), _BLOCK):
            x = held[low : low + _BLOCK]
            sums, squared = x @ machine.factors, x * x
            logits = machine.bias + x @ machine.weights + 0.5 * (sums * sums - squared @ squares).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels[low : low + _BLOCK]).astype(np.float32) / len(held)
            grads[0] += x.T @ error
            grads[1] += x.T @ (error[:, None] * sums) - machine.factors * (squared.T @ error)[:, None]
            grads[2] += float(error.sum())
        rate = 0.05 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        steps = []
        for k, grad in enumerate(grads):
            state[2 * k] = 0.9 * state[2 * k] + 0.1 * grad
            state[2 * k + 1] = 0.999 * state[2 * k + 1] + 0.001 * grad * grad
            steps.append(rate * state[2 * k] / (np.sqrt(state[2 * k + 1]) + 1e-8))
        machine.weights -= steps[0]
        machine.factors -= steps[1]
        machine.bias -= float(steps[2])
    return machine


def train(docs: DataFrame, labels: DataFrame, training: Column) -> FactorisationMachine:
    """Fit on labelled rows whose id ``training`` (over the column ``doc_id``) selects.

    Rows without a quality of 0 or 1 teach nothing; a repeated label counts as often as it is stated. Without both labels
    every text gets the same score.
    """
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("double").alias("quality"))
    known = known.where(training & F.col("quality").isin(0.0, 1.0) & F.col("doc_id").isNotNull())
    # A bounded list: at most SAMPLE rows.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(SAMPLE)
    rows = docs.select(*_inputs(docs)).join(F.broadcast(chosen), "doc_id").select("text", "n_chars", "quality")
    found = rows.mapInArrow(_sampled, "quality double, places binary, values binary, stats binary").toArrow()
    stats = np.frombuffer(b"".join(found.column("stats").to_pylist()), dtype="<f4").reshape(-1, _STATS)
    order = np.lexsort((stats[:, 9], stats[:, 7])).tolist()

    def taken(name: str, kind: str) -> list[np.ndarray]:
        column = found.column(name)
        return [np.frombuffer(column[i].as_buffer(), dtype=kind) for i in order]

    return fit(SparseRows(taken("places", "<u2"), taken("values", "<f4"), stats[order]), found.column("quality").to_numpy()[order])


def _score(machine: FactorisationMachine):
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, data in text_slices(batches):
            logits = np.zeros(rows.num_rows)
            for low, high, made in features(offsets, data, rows.column("n_chars").to_numpy()):
                logits[low:high] = machine.logits(machine.scaled(made))
            scores = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("row"), pa.array(scores)], schema=schema)

    return score


def quality_scores(docs: DataFrame, machine: FactorisationMachine) -> DataFrame:
    """``doc_id, row, score`` (0 to 1) of every row's whole text; a null text is scored as an empty one.

    ``row`` is the hash of id and text. Repeated rows each give a row; an empty table gives an empty result; texts may be of any
    length; a null ``n_chars`` is counted from the text.
    """
    doc_id, text, n_chars = _inputs(docs)
    rows = docs.select(doc_id, text, n_chars).withColumn("row", F.xxhash64("doc_id", "text"))
    return rows.mapInArrow(_score(machine), "doc_id long, row long, score double")


def drop_low_quality(docs: DataFrame, machine: FactorisationMachine, least: float = 0.3) -> DataFrame:
    """The documents with all their columns whose score is ``least`` or more."""
    rejected = quality_scores(docs, machine).where(F.col("score") < least).select("doc_id", "row").distinct()
    doc_id = docs["doc_id"].cast("long")
    row = F.xxhash64(doc_id, F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(rejected, doc_id.eqNullSafe(rejected["doc_id"]) & (row == rejected["row"]), "left_anti")
