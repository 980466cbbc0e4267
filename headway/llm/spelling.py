"""Spelling variants: words one edit apart, found by Gram matrices of letter counts over small blocks.

The squared distance of two words' letter counts is 2 if one letter is replaced, 1 if one is put in. A numpy product of
the letter counts of a block's words gives all these distances at once; pairs at most two apart, of equal or adjacent length, are
verified letter by letter.

Blocks would be quadratic in the vocabulary if they held whole lengths. The edit lies in one half of the shorter word, so the other half is
equal: words meet in blocks that share ``(shorter length, open half, letters outside it)``, each word once as the
shorter and once as the longer one. A block with more than ``BLOCK_WORDS`` words is cut again: the open part is halved, and what is
no longer open joins the key. An open part of one letter leaves a block no larger than the alphabet allows. Every pair
belongs to exactly one block, by the first place where its words differ.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from headway.llm.texts import buffer_of, documents, expand, lower_ascii, settle, text_slices

#: Fixed values of the data contract: one run in 31 loses a letter; words have 7 letters and occur twice at least; a form is ten times as frequent.
DAMAGED_ONE_IN = 31
LEAST_LETTERS = 7
LEAST_TIMES = 2
FORM_TIMES = 10
#: Words of a block that is not cut further.
BLOCK_WORDS = 512
#: Words whose Gram matrix is made together; a larger block is a matrix of its own, made in strips.
_PACK = 512
#: Letters that are compared together when pairs are verified.
_LETTERS = 2_000_000
#: Bytes of text whose words are counted together.
_SLICE = 4_000_000
# Letters are a to z and U+00C0 to U+00FF.
_ALPHABET = 26 + 64


def _crc_table() -> np.ndarray:
    """The table of the CRC-32 polynomial, from its definition."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def crc32_of_runs(starts: np.ndarray, ends: np.ndarray, data: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of byte ranges, each continuing the checksum ``before`` of a prefix."""
    table, out = _crc_table(), np.empty(len(starts), dtype=np.uint32)
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    long_ = int(np.searchsorted(-size[order], -64, side="left"))
    view = memoryview(data)
    for i in order[:long_].tolist():
        out[i] = zlib.crc32(view[starts[i] : ends[i]], int(before[i]))
    order = order[long_:]
    state, first, size = ~before[order], starts[order], size[order]
    active = len(order)
    for k in range(int(size[0]) if active else 0):
        active = int(np.searchsorted(-size, -k, side="left"))
        part = state[:active]
        state[:active] = table[(part ^ data[first[:active] + k]) & 0xFF] ^ (part >> np.uint32(8))
    out[order] = ~state
    return out


def letter_runs(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of maximal runs of letters; none reaches over the border of two texts."""
    letter = ((data >= 0x61) & (data <= 0x7A)) | ((data >= 0x41) & (data <= 0x5A))
    lead = np.flatnonzero(data[:-1] == 0xC3)  # U+00C0 to U+00FF
    letter[lead] = True
    letter[lead + 1] = True
    inside = np.append(letter, False)
    begins, ends = inside[:-1].copy(), inside[:-1].copy()
    begins[1:] &= ~letter[:-1]
    ends &= ~inside[1:]
    border = offsets[1:-1]
    border = border[(border > 0) & (border < len(data))]
    begins[border] |= letter[border]
    ends[border - 1] |= letter[border - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _words_of_slice(doc_ids: list[int | None], offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    """The words of texts, with the letter deleted that the checksum names, short ones left out."""
    data = lower_ascii(data)
    starts, ends = letter_runs(offsets, data)
    wide = np.append(0, np.cumsum(data == 0xC3))
    letters = (ends - starts) - (wide[ends] - wide[starts])
    kept = letters >= LEAST_LETTERS
    starts, ends, letters = starts[kept], ends[kept], letters[kept]
    prefix = np.array([zlib.crc32(b"%s:" % (b"" if i is None else str(i).encode())) for i in doc_ids], dtype=np.uint32)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    checksum = crc32_of_runs(starts, ends, data, prefix[owner])
    damaged = np.flatnonzero(checksum % DAMAGED_ONE_IN == 0)
    first_byte = np.flatnonzero((data & 0xC0) != 0x80)
    at = first_byte[np.searchsorted(first_byte, starts[damaged]) + checksum[damaged] % letters[damaged]]
    stays = np.ones(len(data), dtype=bool)
    stays[at] = False
    stays[at[data[at] == 0xC3] + 1] = False
    letters[damaged] -= 1
    kept = letters >= LEAST_LETTERS
    place = expand(starts[kept], (ends - starts)[kept])
    stays = stays[place]
    bounds = np.append(0, np.cumsum(stays))[np.append(0, np.cumsum((ends - starts)[kept]))]
    held = np.ascontiguousarray(data[place][stays])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(held)]
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, offsets, data in text_slices(batches, _SLICE):
        counted = pc.value_counts(_words_of_slice(rows.column("doc_id").to_pylist(), offsets, data))
        word = counted.field("values").cast(pa.large_string())
        for low in range(0, len(word), 50_000):
            part = slice(low, low + 50_000)
            yield pa.RecordBatch.from_arrays([word[part].cast(pa.string()), counted.field("counts")[part]], names=["word", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` of the words that :func:`spelling_variants` compares."""
    counted = documents(docs).mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TIMES)


# ---------------------------------------------------------------- blocks

_OPEN = ["word", "n", "least", "longer", "low", "high"]


def _halved(rows: DataFrame) -> DataFrame:
    """Every row twice, with either half of its open part."""
    low, high = F.col("low"), F.col("high")
    middle = F.floor((low + high + 1) / 2).cast("int")
    halves = F.array(F.struct(low.alias("low"), middle.alias("high")), F.struct(middle.alias("low"), high.alias("high")))
    kept = [c for c in _OPEN if c not in ("low", "high")]
    return rows.select(*kept, F.explode(halves).alias("_half")).select(*kept, "_half.low", "_half.high")


def _block() -> Column:
    """What the words of a block share; equal hashes of different blocks only make a block larger."""
    outside = [F.col("word").substr(F.lit(1), F.col("low")), F.col("word").substr(F.col("high") + F.col("longer") + 1, F.length("word"))]
    return F.xxhash64("least", "low", "high", *outside)


def blocks(words: DataFrame, most: int = BLOCK_WORDS) -> DataFrame:
    """``block`` for every word and role: its open part ``[low, high)`` in the shorter of two words, ``least`` letters long.

    Blocks with more than ``most`` words are halved until their open part is one letter long, at most log2 of the
    longest word's length times; only their rows are looked at again.
    """
    roles = F.array(F.struct(F.length("word").alias("least"), F.lit(0).alias("longer")), F.struct((F.length("word") - 1).alias("least"), F.lit(1).alias("longer")))
    whole = words.select("word", "n", F.explode(roles).alias("_role")).select("word", "n", "_role.*")
    open_ = _halved(whole.withColumns({"low": F.lit(0), "high": F.col("least")}))
    done = None
    while True:
        open_ = settle(open_.withColumn("block", _block()), "blocks")
        large = open_.groupBy("block").agg(F.count(F.lit(1)).alias("_n"), F.max(F.col("high") - F.col("low")).alias("_open"))
        large = settle(large.where((F.col("_n") > most) & (F.col("_open") > 1)).select("block"), "large-blocks")
        if large.isEmpty():
            return open_ if done is None else done.unionByName(open_)
        small = open_.join(large, "block", "left_anti")
        done = small if done is None else done.unionByName(small)
        open_ = _halved(open_.join(large, "block", "left_semi").drop("block"))


# ---------------------------------------------------------------- pairs within blocks


class _Words:
    """Rows of whole blocks: letters of all words one after the other, and their counts."""

    def __init__(self, rows: pa.RecordBatch):
        offsets, data = buffer_of(rows.column("word"))
        wide = data == 0xC3
        tail = np.flatnonzero(wide) + 1
        codes = data.astype(np.int16) - 0x61
        codes[tail] = data[tail].astype(np.int16) - 0x80 + 26
        first = ~wide  # of a wide letter the second byte carries the code
        self.letters = codes[first].astype(np.uint8)
        bounds = np.append(0, np.cumsum(first))[offsets]
        self.starts, self.size = bounds[:-1], np.diff(bounds)
        self.block, self.low, self.high = (rows.column(c).to_numpy() for c in ("block", "low", "high"))
        self.longer = rows.column("longer").to_numpy() == 1

    def counts(self, low: int, high: int) -> np.ndarray:
        size = self.size[low:high]
        cell = np.repeat(np.arange(high - low) * _ALPHABET, size) + self.letters[self.starts[low] : self.starts[low] + size.sum()]
        return np.bincount(cell, minlength=(high - low) * _ALPHABET).reshape(high - low, _ALPHABET).astype(np.float32)

    def near(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (shorter or equal, other) of rows in ``low:high`` that one edit apart and belong to their block."""
        counts = self.counts(low, high)
        norm = np.einsum("ij,ij->i", counts, counts)
        longer, block = self.longer[low:high], self.block[low:high]
        shorter = np.flatnonzero(~longer)
        found = []
        for strip in range(0, len(shorter), _PACK):
            own = shorter[strip : strip + _PACK]
            distance = norm[own][:, None] + norm[None, :] - 2 * (counts[own] @ counts.T)
            a, b = np.nonzero((distance <= 2) & (block[own][:, None] == block[None, :]))
            a = own[a]
            apart = longer[b] | (a < b)
            found.append((a[apart], b[apart]))
        a, b = (np.concatenate(x) + low if found else np.zeros(0, dtype=np.int64) for x in (zip(*found, strict=True) if found else ((), ())))
        same = (self.low[a] == self.low[b]) & (self.high[a] == self.high[b]) & (self.size[a] + self.longer[b] == self.size[b])
        return self._verified(a[same], b[same])

    def _verified(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        good = np.zeros(len(a), dtype=bool)
        ends = np.cumsum(self.size[a])
        first = 0
        while first < len(a):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + _LETTERS, side="right")))
            good[first:last] = self._one_edit(a[first:last], b[first:last])
            first = last
        return a[good], b[good]

    def _one_edit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """One letter replaced or put in, at a place that lies in the open part."""
        size = self.size[a]
        begins = np.cumsum(size) - size
        own, other = expand(self.starts[a], size), expand(self.starts[b], size)
        left = self.letters[own]
        differs = np.flatnonzero(left != self.letters[other])
        at = np.searchsorted(differs, begins)
        until = np.searchsorted(differs, begins + size)
        differs = np.append(differs, 0)
        first = np.where(at < until, differs[at] - begins, size)
        good = until - at == 1
        put_in = np.flatnonzero(self.longer[b])
        if len(put_in):
            # Letters behind the first difference must equal those one further on: the last that doesn't lies before it.
            moved = np.append(self.letters, 0)[other + 1] != left
            moved = np.flatnonzero(moved)
            to = np.searchsorted(moved, (begins + size)[put_in])
            some = to > np.searchsorted(moved, begins[put_in])
            last = np.where(some, np.append(moved, 0)[to - 1] - begins[put_in], -1)
            good[put_in] = last < first[put_in]
        low, high = self.low[a], self.high[a]
        return good & (low <= first) & ((first < high) | ((first == size) & (high == size)))


def _packs(block: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole blocks, of ``_PACK`` rows together or one larger block."""
    bounds = np.append(np.flatnonzero(np.diff(block, prepend=block[0] - 1)), len(block))
    first = 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + _PACK, side="right")) - 1)
        yield int(bounds[first]), int(bounds[last])
        first = last


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs, both ways round, from rows sorted by block."""
    names = ["word", "near", "near_n"]

    def pairs_of(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words, block = _Words(rows), rows.column("block").to_numpy()
        found = [words.near(low, high) for low, high in _packs(block)]
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        for low in range(0, len(a), 50_000):
            left, right = (rows.take(pa.array(x[low : low + 50_000])) for x in (a, b))
            for one, other in ((left, right), (right, left)):
                yield pa.RecordBatch.from_arrays([one.column("word"), other.column("word"), other.column("n")], names=names)

    rest: list[pa.RecordBatch] = []
    for batch in batches:
        block = batch.column("block").to_numpy()
        if len(block) == 0:
            continue
        # The last block of a batch may go on in the next one.
        whole = int(np.searchsorted(block, block[-1], side="left"))
        begun = not rest or rest[-1].column("block")[0].as_py() == block[0]
        if whole or not begun:
            done = [*rest, batch.slice(0, whole)] if whole else rest
            rest = [batch.slice(whole)] if whole else [batch]
            yield from pairs_of(pa.Table.from_batches(done).combine_chunks().to_batches()[0])
        else:
            rest.append(batch)
    if rest:
        yield from pairs_of(pa.Table.from_batches(rest).combine_chunks().to_batches()[0])


def near_pairs(words: DataFrame, most: int = BLOCK_WORDS) -> DataFrame:
    """``word, near, near_n``: every two words one edit apart, once either way round."""
    dealt = blocks(words, most).repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(_pairs, "word string, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` by doubling: forms are ten times as frequent each, so 64-bit counts allow five rounds at most."""
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        reached = settle(reached, "roots")
        further = reached.select(F.col("word").alias("_from"), F.col("root").alias("_to"))
        joined = reached.join(further, reached["root"] == further["_from"], "left")
        if joined.where(F.col("_to").isNotNull()).isEmpty():
            return reached
        reached = joined.select("word", F.coalesce("_to", "root").alias("root"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every word of the texts.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lowered; a run whose CRC-32 with its ``doc_id`` is divisible by
    ``DAMAGED_ONE_IN`` loses one letter. Counted are words of at least ``LEAST_LETTERS`` letters and ``LEAST_TIMES`` occurrences.
    ``n_near`` is the number of words one insertion, deletion or replacement away, ``form`` the most frequent of them (on a tie the
    first in code-point order) if it is at least ``FORM_TIMES`` times as frequent as the word, ``root`` where following
    the forms ends, the word itself without a form.

    Null and empty texts have no words; repeated rows count each; a null id is written as nothing. An empty table
    gives an empty result; texts and words may be of any length.
    """
    words = settle(word_counts(docs), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("word"))).alias("best")
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    known = words.join(near, "word", "left").withColumn("_form_n", -F.col("best.rank"))
    fits = F.col("_form_n") >= FORM_TIMES * F.col("n")
    known = settle(
        known.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("best.word")).alias("form"),
            F.when(fits, F.col("_form_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(known.where(F.col("form").isNotNull()))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
