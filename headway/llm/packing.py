"""Packing of token pieces into sequences by exact complements, then by best fit.

Pieces of one length are interchangeable, so the packing is decided on how many pieces of each length
there are: at most ``capacity`` numbers, whatever the input. Lengths are taken from the longest down. Its gap to a
full sequence is looked up among single lengths, sums of pairs and sums of triples; a combination that fills it exactly is
used as often as its members last. Lengths that no combination completes go, longest first, into the
tightest gap they fit, again as many at a time as there are such gaps.

The decision is a list of patterns (the lengths of a sequence, and how often). Pieces are then numbered within
their length, in parallel, and the number tells each its sequence and its place there.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from headway.llm.ranks import number_within

CAPACITY = 2_048


@dataclass(frozen=True)
class Pattern:
    """``times`` sequences that hold pieces of these lengths, in this order."""

    lengths: tuple[int, ...]
    times: int


class _Stock:
    """Pieces left of each length, and the exact complements among them."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            self.left[length] = n

    def pair(self, total: int) -> tuple[int, ...] | None:
        """Two lengths that make ``total``, the longer as long as possible."""
        if total < 2:
            return None
        longer = np.arange(total - 1, (total - 1) // 2, -1)
        shorter = total - longer
        fits = (self.left[longer] > 0) & (self.left[shorter] > (longer == shorter))
        found = np.flatnonzero(fits)
        return (int(longer[found[0]]), int(shorter[found[0]])) if len(found) else None

    def complement(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three lengths that fill a gap exactly."""
        if self.left[gap] > 0:
            return (gap,)
        if two := self.pair(gap):
            return two
        for longest in np.flatnonzero(self.left[: max(0, gap - 1)])[::-1]:
            if 3 * longest < gap:
                return None
            self.left[longest] -= 1
            two = self.pair(gap - int(longest))
            self.left[longest] += 1
            if two:
                return (int(longest), *two)
        return None

    def take(self, lengths: tuple[int, ...]) -> int:
        """Use a combination as often as its members last."""
        need = defaultdict(int)
        for length in lengths:
            need[length] += 1
        times = min(int(self.left[length]) // n for length, n in need.items())
        for length, n in need.items():
            self.left[length] -= times * n
        return times


def plan_patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use every piece once; ``counts`` has the number of pieces of each length from 1 to ``capacity``."""
    stock = _Stock(counts, capacity)
    patterns = []
    if stock.left[capacity]:
        patterns.append(Pattern((capacity,), int(stock.left[capacity])))
        stock.left[capacity] = 0
    for length in range(capacity - 1, 0, -1):
        while stock.left[length] > 0:
            stock.left[length] -= 1
            rest = stock.complement(capacity - length)
            stock.left[length] += 1
            if rest is None:
                break
            patterns.append(Pattern((length, *rest), stock.take((length, *rest))))

    # Open sequences by gap; equal ones are kept together with their number.
    opened: dict[int, list[list]] = defaultdict(list)
    gaps: list[int] = []
    for length in range(capacity - 1, 0, -1):
        n = int(stock.left[length])
        while n:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                fit = capacity // length  # no gap left: as many fresh sequences as needed, filled with this length
                whole, rest = divmod(n, fit)
                fresh = [[(length,) * fit, whole]] * bool(whole) + [[(length,) * rest, 1]] * bool(rest)
                n = 0
            else:
                gap = gaps[at]
                lengths, times = opened[gap].pop()
                if not opened[gap]:
                    gaps.pop(at)
                used = min(n, times)
                n -= used
                fresh = [[(*lengths, length), used]] + [[lengths, times - used]] * (times > used)
            for lengths, times in fresh:
                gap = capacity - sum(lengths)
                if not opened[gap]:
                    insort(gaps, gap)
                opened[gap].append([lengths, times])
    patterns += [Pattern(tuple(lengths), times) for group in opened.values() for lengths, times in group]
    return patterns


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a stored table with ``doc_id``, ``piece`` and ``length``) with ``sequence_id`` and ``offset``.

    Sequences hold at most ``capacity`` tokens, without gaps from 0. Every row is placed once, equal rows as well;
    lengths must be 1 to ``capacity``. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    # One row per length, 1 to capacity.
    counts = {int(r["length"]): r["count"] for r in pieces.groupBy("length").count().collect()}
    rows, sequence, used = [], 0, defaultdict(int)
    for pattern in plan_patterns(counts, capacity):
        per_sequence = defaultdict(int)
        for length in pattern.lengths:
            per_sequence[length] += 1
        offset, nth = 0, defaultdict(int)
        for length in pattern.lengths:
            # Pieces of a length are dealt to a pattern in blocks, one block for each place it has for them.
            first = used[length] + nth[length] * pattern.times
            rows.append((length, first, pattern.times, sequence, offset))
            nth[length] += 1
            offset += length
        for length, n in per_sequence.items():
            used[length] += n * pattern.times
        sequence += pattern.times
    plan = spark.createDataFrame(rows, "_length int, _from long, _times long, _sequence long, _offset int")
    numbered = number_within(
        pieces.withColumn("_len", F.col("length").cast("int")),
        "_len",
        [F.col("doc_id"), F.col("piece")],
        F.xxhash64("doc_id", "piece"),
        counts,
        "_number",
    )
    # A row per place of a pattern: their number depends on the capacity, not on the input.
    joined = numbered.join(
        F.broadcast(plan),
        (F.col("_len") == F.col("_length")) & (F.col("_number") >= F.col("_from")) & (F.col("_number") < F.col("_from") + F.col("_times")),
    )
    return joined.select(
        *pieces.columns,
        (F.col("_sequence") + F.col("_number") - F.col("_from")).alias("sequence_id"),
        F.col("_offset").cast("long").alias("offset"),
    )
