"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1, drawn from its code point. An n-gram of letters is the product of its letters'
vectors, each rotated by its place (binding); a text is the sum of its n-grams (bundling), and a language the
sum of its training texts, each weighing the same. A text goes to the language whose prototype has the
largest cosine with it.

Bundling is a sum, so prototypes are added up by the tasks and then between them; only one vector per language
reaches the driver. Any other run of characters than letters counts as one gap, which is a symbol too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from headway.llm.texts import text_slices

DIMENSIONS = 1_024
GRAM = 3
_SEED = 9
#: Up to so many possible n-grams of a slice are told apart by counting, more by sorting.
_DENSE = 1 << 22
_MATRIX = 1 << 21

_LETTERS: dict[int, np.ndarray] = {}


def letter_vector(code: int) -> np.ndarray:
    vector = _LETTERS.get(code)
    if vector is None:
        bits = np.random.Generator(np.random.PCG64([_SEED, code])).integers(0, 2, DIMENSIONS, dtype=np.int8)
        vector = _LETTERS[code] = (2 * bits - 1).astype(np.float32)
    return vector


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text of each n-gram, number of each n-gram, vectors of the distinct n-grams, letters per text)."""
    lowered = [f"\n{t.lower()}\n" for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, lowered), dtype=np.int64, count=len(texts)))
    seen = np.flatnonzero(np.bincount(codes, minlength=1))
    symbols = np.array([c for c in seen.tolist() if chr(c).isalpha()], dtype=np.int64)
    table = np.zeros(int(seen[-1]) + 1 if len(seen) else 1, dtype=np.int64)
    table[symbols] = np.arange(1, len(symbols) + 1)
    symbol = table[codes]
    # A gap is one symbol however long; each text begins and ends with one.
    kept = np.ones(len(symbol), dtype=bool)
    kept[1:] = (symbol[1:] != 0) | (symbol[:-1] != 0) | (owner[1:] != owner[:-1])
    symbol, owner = symbol[kept], owner[kept]
    letters = np.bincount(owner[symbol != 0], minlength=len(texts))
    base = len(symbols) + 1
    n = max(0, len(symbol) - GRAM + 1)
    code = np.zeros(n, dtype=np.int64)
    for place in range(GRAM):
        code = code * base + symbol[place : place + n]
    inside = owner[:n] == owner[GRAM - 1 : GRAM - 1 + n]
    code, owner = code[inside], owner[:n][inside]
    if base**GRAM <= _DENSE:
        distinct = np.flatnonzero(np.bincount(code, minlength=1))
        number = np.zeros(base**GRAM, dtype=np.int64)
        number[distinct] = np.arange(len(distinct))
        number = number[code]
    else:
        distinct, number = np.unique(code, return_inverse=True)
    basis = np.stack([letter_vector(-1 % 2**32), *map(letter_vector, symbols.tolist())])
    vectors = np.ones((len(distinct), DIMENSIONS), dtype=np.float32)
    rest = distinct
    for place in range(GRAM):
        vectors *= np.roll(basis, place, axis=1)[rest % base]
        rest = rest // base
    return owner, number, vectors, letters


def _blocks(count: int, grams: int) -> Iterator[tuple[int, int]]:
    step = max(1, _MATRIX // max(1, grams))
    for low in range(0, count, step):
        yield low, min(count, low + step)


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of text vectors by language, one row per language and task."""
    sums: dict[str, np.ndarray] = {}
    for rows, _, _ in text_slices(batches):
        owner, number, vectors, _ = _grams(rows.column("text").to_pylist())
        if len(number) == 0:
            continue
        weight = 1.0 / np.maximum(1, np.bincount(owner, minlength=rows.num_rows))
        langs = rows.column("lang").to_pylist()
        names = sorted(set(langs))
        place = np.array([names.index(x) for x in langs])[owner]
        counts = np.bincount(place * len(vectors) + number, weights=weight[owner], minlength=len(names) * len(vectors))
        for name, vector in zip(names, counts.reshape(len(names), -1) @ vectors.astype(np.float64), strict=True):
            sums[name] = sums.get(name, 0) + vector
    if sums:
        yield pa.RecordBatch.from_pydict(
            {"lang": list(sums), "vector": [v.tolist() for v in sums.values()]},
            schema=pa.schema([("lang", pa.string()), ("vector", pa.list_(pa.float64()))]),
        )


def language_prototypes(docs: DataFrame, training: Column) -> tuple[list[str], np.ndarray]:
    """Names and unit vectors of the languages in the rows that ``training`` selects, from all of them.

    Rows with a null text or language teach nothing.
    """
    rows = docs.where(training & docs["text"].isNotNull() & docs["lang"].isNotNull())
    rows = rows.select(docs["lang"].cast("string").alias("lang"), docs["text"].cast("string").alias("text"))
    parts = rows.mapInArrow(_bundle, "lang string, vector array<double>")
    placed = parts.select("lang", F.posexplode("vector").alias("place", "value"))
    summed = placed.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    vectors = summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("v"))
    found = sorted((r["lang"], [x["value"] for x in r["v"]]) for r in vectors.collect())
    if not found:
        return [], np.zeros((0, DIMENSIONS))
    matrix = np.array([v for _, v in found])
    return [name for name, _ in found], matrix / np.maximum(1e-12, np.linalg.norm(matrix, axis=1, keepdims=True))


def _predict(names: list[str], prototypes: np.ndarray):
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    matrix = prototypes.T.astype(np.float32)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in text_slices(batches):
            owner, number, vectors, letters = _grams(rows.column("text").to_pylist())
            bounds = np.searchsorted(owner, np.arange(rows.num_rows + 1))
            best = np.zeros(rows.num_rows, dtype=np.int64)
            cosine = np.zeros(rows.num_rows)
            for low, high in _blocks(rows.num_rows if names and len(vectors) else 0, len(vectors)):
                own = slice(bounds[low], bounds[high])
                cells = (owner[own] - low) * len(vectors) + number[own]
                counts = np.bincount(cells, minlength=(high - low) * len(vectors)).reshape(high - low, -1)
                bundles = counts.astype(np.float32) @ vectors
                against = bundles @ matrix / np.maximum(1e-9, np.linalg.norm(bundles, axis=1, keepdims=True))
                best[low:high] = against.argmax(axis=1)
                cosine[low:high] = against.max(axis=1)
            told = [names[b] if names and n else "und" for b, n in zip(best.tolist(), letters.tolist(), strict=True)]
            score = np.where((letters > 0) & bool(names), np.clip((1 + cosine) / 2, 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(told, pa.string()), pa.array(score)], schema=schema)

    return predict


def identify_languages(docs: DataFrame, names: list[str], prototypes: np.ndarray) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row's whole text.

    ``score`` is the cosine moved to 0 to 1. A text that is null or has no letter is ``und`` with score 0, and so is
    every text if nothing was learned. Of equal cosines the alphabetically first language wins. Repeated rows each
    give a row; an empty table gives an empty result; texts may be of any length.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(_predict(names, prototypes), "doc_id long, lang_pred string, score double")
