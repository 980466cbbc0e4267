"""What the operators share: the input columns, texts as byte buffers, words, and hashes of spans.

Every operator reads ``doc_id`` and ``text`` only (any other column, whatever its name, is ignored),
so extra columns cannot clash with working columns. A null text counts as empty; a null ``doc_id`` is
an id like any other and comes back as null.

Inside tasks a batch of texts is one byte buffer with offsets, and words or byte spans are numpy
arrays over it. Buffers are worked through in slices of a few MB, so memory does not depend on
how much text a batch holds; only a single text longer than that is taken as a whole.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from headway.session import settle as settle_table

#: Words are maximal runs of other bytes than these (fixed values of the data contract).
SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD_SEPARATOR_PATTERN = r"[\x20\x09-\x0D]+"
SLICE_BYTES = 2_000_000

_IS_SEPARATOR = np.zeros(256, dtype=bool)
_IS_SEPARATOR[list(SEPARATORS)] = True


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long) and ``text`` (string, null as empty) of a table of documents."""
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")
    )


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Store an intermediate table in the shared folder: it is computed once and survives lost executors."""
    return settle_table(df, f"llm-{purpose}")


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the files of shuffles that nothing reads any more: it does once the driver's collector finds them unused."""
    spark.sparkContext._jvm.System.gc()


def release(*tables: DataFrame) -> None:
    """Empty stored tables that nothing reads any more, so that the shared folder holds no more than is needed.

    Shuffles that only those tables came from go too.
    """
    for table in tables:
        files = table.inputFiles()
        if files:
            nothing = table.sparkSession.createDataFrame([], table.schema).coalesce(1)
            nothing.write.mode("overwrite").parquet(files[0].rsplit("/", 1)[0])
    if tables:
        forget_shuffles(tables[0].sparkSession)


def parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def keyed(docs: DataFrame) -> DataFrame:
    """:func:`documents` with ``row``, a hash of both columns.

    ``doc_id`` and ``row`` together name a row even if ids repeat; rows equal in both are equal in all that matters.
    """
    return documents(docs).withColumn("row", F.xxhash64("doc_id", "text"))


#: The most rows of the broadcast that :func:`rows_named` makes; some 30 MB.
ID_SLOTS = 1 << 20


def rows_named(df: DataFrame, names: DataFrame, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``df`` joined with ``names`` (a stored table) on ``columns``, moving little of the rows without a name.

    Names are folded to ``ID_SLOTS`` slots, which bounds the broadcast whatever the input; rows of other
    slots never leave their scan task. Only the rest takes part in the exact join. With names in every
    slot nothing is spared, and the result is the same. The result has the columns of both.
    """

    def slot(frame: DataFrame) -> Column:
        return F.pmod(F.xxhash64(*[frame[c] for c in columns]), F.lit(ID_SLOTS)).cast("int")

    slots = F.broadcast(names.select(slot(names).alias("_slot")).distinct())
    near = df.join(slots, slot(df) == slots["_slot"], "left_semi")
    right = names.select([F.col(c).alias(f"_{c}") if c in columns else F.col(c) for c in names.columns])
    same = reduce(lambda a, b: a & b, [near[c].eqNullSafe(right[f"_{c}"]) for c in columns])
    return near.join(right.hint("merge"), same).drop(*[f"_{c}" for c in columns])


def word_array(text: Column) -> Column:
    """The words of a text, natively."""
    return F.filter(F.split(text, WORD_SEPARATOR_PATTERN), lambda w: w != "")


def spaced(text: Column) -> Column:
    """The words of a text joined by one space, natively."""
    return F.trim(F.regexp_replace(text, WORD_SEPARATOR_PATTERN, " "))


# ---------------------------------------------------------------- byte buffers


def buffer_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of an Arrow string or binary array without nulls."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    where = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    where = where[array.offset : array.offset + len(array) + 1].astype(np.int64)
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return where - where[0], held[where[0] : where[-1]]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``limit`` bytes together; at least one text each."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def text_slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, offsets, bytes) of bounded slices of batches that have a ``text`` column; the last one done, memory is given back."""
    try:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            offsets, _ = buffer_of(batch.column("text"))
            for first, last in slices(offsets, limit):
                rows = batch.slice(first, last - first)
                yield rows, *buffer_of(rows.column("text"))
    finally:
        release_memory()


def release_memory() -> None:
    """Return what a finished task held to the machine: worker processes go on to other tasks, and idle ones stay a while."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def in_words(data: np.ndarray) -> np.ndarray:
    """True for the bytes of words."""
    return ~_IS_SEPARATOR[data]


def words_of(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, bounds): byte range of every word, and the index of each text's first word (n + 1 values)."""
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[:-1] = ~_IS_SEPARATOR[data]
    step = np.empty(len(data) + 1, dtype=np.int8)
    step[0] = inside[0]
    np.subtract(inside[1:], inside[:-1], out=step[1:])
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    # A word that runs over the border of two texts is two words.
    borders = offsets[1:-1]
    borders = np.unique(borders[(borders > 0) & (borders < len(data))])
    cut = borders[(inside[borders] == 1) & (inside[borders - 1] == 1)]
    if len(cut):
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    return starts, ends, np.searchsorted(starts, offsets)


def packs(group: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole groups (neighbouring equal values), of ``most`` rows together at most, or one larger group."""
    bounds = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
    first = 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + most, side="right")) - 1)
        yield int(bounds[first]), int(bounds[last])
        first = last


def whole_groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches sorted by a column again, none of which ends inside a run of equal values."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        group = batch.column(column)
        cut = int(np.flatnonzero(group.to_numpy() != group[-1].as_py())[-1]) + 1 if group[0] != group[-1] else 0
        if cut or (rest and rest[-1].column(column)[0] != group[0]):
            held = [*rest, batch.slice(0, cut)] if cut else rest
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            rest = [batch.slice(cut)] if cut else [batch]
        else:
            rest.append(batch)
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks().to_batches()[0]


# ---------------------------------------------------------------- hashes of spans


@lru_cache(maxsize=None)
def _byte_values(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 2**64, 256, dtype=np.uint64)


def _odd(seed: int) -> tuple[int, int]:
    base = int(np.random.Generator(np.random.PCG64(seed + 1_000)).integers(2**62, 2**63, dtype=np.uint64)) * 8 + 5
    base %= 2**64
    return base, pow(base, -1, 2**64)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    known = _POWERS.get(seed)
    if known is None or len(known[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        made = []
        for base in _odd(seed):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps))
        known = (made[0], made[1])
        if size <= 1 << 22:  # a single huge text is not worth keeping tables for
            _POWERS[seed] = known
    return known[0][:n], known[1][:n]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix64 finalizer)."""
    z = values ^ (values >> np.uint64(30))
    z = z * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class SpanHash:
    """64-bit hashes of any span of a sequence, each in constant time after one pass.

    Prefix sums of value times a power of an odd base, modulo 2**64; dividing by the power at a span's
    start makes the hash independent of its place. Seeds give independent functions: two of
    them make a 128-bit key.
    """

    def __init__(self, values: np.ndarray, seed: int):
        up, self.down = _powers(seed, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def byte_hash(data: np.ndarray, seed: int) -> SpanHash:
    return SpanHash(_byte_values(seed)[data], seed)


#: Words longer than this many bytes are hashed by a cryptographic function.
LONG_WORD = 32


def word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of words.

    Sums modulo 2**64 can be equal for long strings of a regular build (such as the Thue-Morse sequence and its complement), whatever the
    base, so long words get a keyed digest instead.
    """
    hashes = byte_hash(data, seed)(starts, ends)
    view, key = memoryview(np.ascontiguousarray(data)), seed.to_bytes(8, "little")
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        digest = hashlib.blake2b(view[starts[i] : ends[i]], digest_size=8, key=key).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return hashes


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return np.where(upper, data + 32, data).astype(np.uint8)


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges [start, start + length), one range after the other."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
