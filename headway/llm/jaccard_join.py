"""Join of documents by the Jaccard similarity of their word n-grams, with parity sketches.

A document's n-grams are a set of 64-bit hashes. XOR-ing them into buckets gives a parity sketch: tokens that two sets
share cancel out, so sketches differ in no more places than the sets do. The size of the smaller set and the wanted similarity bound
the number D of n-grams in which two linked sets can differ (see :func:`most_differences`).

1. *Bands.* Sizes are cut into bands; a set meets its own band and, if it is within reach, the one below, so linked sets
   always meet. A band fixes D and cuts the hash space into ``D + 1 + spare`` ranges.
2. *Pigeonhole.* The sketch of a range is the XOR of the n-grams in it. Linked sets differ in at most D ranges, so at
   least ``1 + spare`` range sketches are equal. Sketches have one order, by how many sets have them, and each set leaves out its
   ``spare`` most frequent ones (empty ranges, boilerplate). Of the sketches that two linked sets share, these are the
   first ``spare`` at most, so one is left for sure. Sets that share a sketch are candidates.
3. *Hamming bound.* Candidates whose whole 256-bit sketches differ in more than the allowed number of bits are dropped.
4. *Verification* counts common n-grams exactly.

Groups of sets that share a sketch may be huge. Sets equal in all n-grams count as one from the start. A scan task sends one set of each
group it meets, the others are known to belong to it. Candidates are then taken in two rounds. First each set is compared with
``PARTNERS`` of those that stand next to it in its groups, in several random orders; that makes one component of
nearly every group of near copies. Then all members of a group that are in different components are compared by size and whole
sketch, inside tasks that hold tiles of a group; only pairs that may link become rows. Pairs inside a component need
no comparison, so the pairs of a group of near copies are never listed, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from headway.llm.components import components
from headway.llm.texts import (
    SpanHash,
    expand,
    forget_shuffles,
    keyed,
    lower_ascii,
    mixed,
    packs,
    release,
    rows_named,
    settle,
    signed,
    text_slices,
    whole_groups,
    word_hash,
    words_of,
)

#: Ratio of the largest to the smallest size of a band.
BAND = Fraction(5, 4)
_ROW = ["doc_id", "row"]
#: Sketch rows that a scan task gathers before it folds those of equal key.
_FOLD_ROWS = 1_500_000
_BITS = ["bits0", "bits1", "bits2", "bits3"]
#: Shares of the keys that are matched one after the other: only one share's sketch rows are on disk at a time.
SHARES = 2
#: Shares of the cells of the second round, likewise.
CELL_SHARES = 4
#: Neighbours that the first round compares a set with, and the random orders they are taken from.
PARTNERS, ORDERS = 8, 3
#: Members of a group that the first round keeps together.
_GATHERED = 2_000
#: Members of a group that the second round compares in one task, and how many of them with all others at once.
TILE = 2_000
_STRIP = 256
#: Pairs whose common keys are looked up together.
_PAIRS = 20_000
#: Pairs whose sketches are compared together.
_HAMMING = 200_000


def most_differences(smaller: int, percent: int) -> int:
    """The most n-grams in which two linked sets differ if the smaller one has ``smaller`` n-grams.

    With sizes a <= c and d differences, the intersection is (a + c - d) / 2 and the union (a + c + d) / 2, so the
    similarity asks for d <= (100 - p) / (100 + p) (a + c), and c can be at most 100 a / p.
    """
    return (100 - percent) * (smaller + 100 * smaller // percent) // (100 + percent)


@lru_cache(maxsize=None)
def _bands(percent: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(least size, ranges, spare ranges) of every band up to size ``most``."""
    lows, ranges, spares, low = [], [], [], 1
    while True:
        high = max(low + 1, int(low * BAND))
        d = most_differences(high - 1, percent)
        spare = min(d, 2 + d // 2)
        lows.append(low)
        ranges.append(d + 1 + spare)
        spares.append(spare)
        if high > most:
            return tuple(np.array(x, dtype=np.int64) for x in (lows, ranges, spares))
        low = high


def shingle_sets(offsets: np.ndarray, data: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the distinct n-grams of each text, sorted; with fewer words, all of them as one."""
    data = lower_ascii(data)
    starts, ends, bounds = words_of(offsets, data)
    words = SpanHash(word_hash(data, starts, ends, 51), 52)
    count = np.diff(bounds)
    grams = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    first = expand(bounds[:-1], grams)
    last = first + np.repeat(np.minimum(count, n), grams)
    hashes = words(first, last)
    cuts = np.concatenate([[0], np.cumsum(grams)])
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        hashes[low:high].sort()
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = hashes[1:] != hashes[:-1]
    fresh[cuts[:-1][grams > 0]] = True
    return hashes[fresh], np.concatenate([[0], np.cumsum(fresh)])[cuts]


def _folded(values: np.ndarray, bounds: np.ndarray, combine: np.ufunc) -> np.ndarray:
    out = np.zeros(len(bounds) - 1, dtype=values.dtype)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = combine.reduceat(values, bounds[:-1][full])
    return out


def _signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64 bits that tell sets apart; 0 for the empty set."""
    total = _folded(mixed(hashes + np.uint64(0x9E3779B97F4A7C15)), bounds, np.add)
    parity = _folded(hashes, bounds, np.bitwise_xor)
    return np.where(np.diff(bounds) > 0, mixed(total ^ (parity * np.uint64(3))) | np.uint64(1), np.uint64(0))


def _describe(n: int):
    """Per row: number of n-grams, signature, and the 256-bit parity sketch."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, data in text_slices(batches):
            hashes, bounds = shingle_sets(offsets, data, n)
            owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            bucket = (mixed(hashes) & np.uint64(255)).astype(np.int64)
            parity = np.bincount(owner * 256 + bucket, minlength=256 * (len(bounds) - 1)).astype(np.uint8) & 1
            sketch = np.packbits(parity.reshape(-1, 256), axis=1).view(np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("row"),
                    pa.array(np.diff(bounds)),
                    pa.array(signed(_signatures(hashes, bounds))),
                    *[pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(4)],
                ],
                names=[*_ROW, "n_shingles", "sig", *_BITS],
            )

    return describe


def range_sketches(hashes: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, index of the set, sketches the set may leave out) for all range sketches of all sets."""
    size = np.diff(bounds)
    lows, ranges, spares = _bands(percent, int(size.max(initial=1)))
    band = np.searchsorted(lows, size, side="right") - 1
    below = (band > 0) & (size * percent < 100 * lows[np.maximum(band, 0)])
    leave = spares[np.maximum(0, band - 1)]
    keys, owners = [], []
    for chosen, group in ((size > 0, band), (below & (size > 0), band - 1)):
        which = np.flatnonzero(chosen)
        if len(which) == 0:
            continue
        group = group[which]
        m = ranges[group]
        own = hashes[expand(bounds[which], size[which])]
        nth = np.repeat(np.arange(len(which)), size[which])
        base = np.cumsum(m) - m
        cell = base[nth] + ((own >> np.uint64(32)) * m[nth].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        begins = np.flatnonzero(np.diff(cell, prepend=-1))
        sketch = np.zeros(int(m.sum()), dtype=np.uint64)
        sketch[cell[begins]] = np.bitwise_xor.reduceat(mixed(own), begins)
        of_set = np.repeat(np.arange(len(which)), m)
        place = (group[of_set] << 32) | (np.arange(len(sketch)) - base[of_set])
        keys.append(mixed(sketch ^ mixed(place.astype(np.uint64) + np.uint64(1))))
        owners.append(which[of_set])
    if not keys:
        nothing = np.zeros(0, dtype=np.int64)
        return nothing.view(np.uint64), nothing, nothing
    owner = np.concatenate(owners)
    return np.concatenate(keys), owner, leave[owner]


def _sketch_rows(n: int, percent: int, share: int, shares: int):
    """``key, sig, spare, known``: one row per key and task to be matched, the others marked as known to share the key.

    Only keys of one share of all keys are given; a key is in one share, whichever set has it.
    """

    def fold(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        key, sig, spare = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((sig, key))
        key, sig, spare = key[order], sig[order], spare[order]
        distinct = np.ones(len(key), dtype=bool)
        distinct[1:] = (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])
        key, sig, spare = key[distinct], sig[distinct], spare[distinct]
        first = np.ones(len(key), dtype=bool)
        first[1:] = key[1:] != key[:-1]
        begins = np.flatnonzero(first)
        shared = np.diff(np.append(begins, len(key))) > 1
        # 0: to be matched; 1: to be matched, others of this task share the key; 2: one of those others.
        known = np.full(len(key), 2, dtype=np.int8)
        known[begins] = shared
        return pa.RecordBatch.from_arrays(
            [pa.array(signed(key)), pa.array(signed(sig)), pa.array(spare.astype(np.int32)), pa.array(known)],
            names=["key", "sig", "spare", "known"],
        )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for _, offsets, data in text_slices(batches):
            hashes, bounds = shingle_sets(offsets, data, n)
            key, owner, spare = range_sketches(hashes, bounds, percent)
            own = key % np.uint64(shares) == np.uint64(share)
            key, owner, spare = key[own], owner[own], spare[own]
            held.append((key, _signatures(hashes, bounds)[owner], spare))
            rows += len(key)
            if rows >= _FOLD_ROWS:
                yield fold(held)
                held, rows = [], 0
        if rows:
            yield fold(held)

    return spread


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, those whose key some other set has; a key's rows may run over batches."""
    rest = None
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("key", "sig", "spare", "known")]
        if rest is not None:
            columns = [np.concatenate([a, b]) for a, b in zip(rest, columns, strict=True)]
        cut = int(np.searchsorted(columns[0], columns[0][-1])) if len(columns[0]) else 0
        rest = [c[cut:] for c in columns]
        yield from _shared_of([c[:cut] for c in columns])
    if rest is not None:
        yield from _shared_of(rest)


def _shared_of(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    key, sig, spare, known = columns
    if len(key) == 0:
        return
    begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(begins, len(key)))
    unlike = (np.minimum.reduceat(sig, begins) != np.maximum.reduceat(sig, begins)) | (known == 1)[begins]
    unlike |= np.maximum.reduceat(known, begins) > 0
    keep = np.repeat(unlike, sizes)
    yield pa.RecordBatch.from_arrays(
        [pa.array(key[keep]), pa.array(sig[keep]), pa.array(spare[keep])], names=["key", "sig", "spare"]
    )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of members that stand next to each other in their group, in random orders, as far as a batch holds the group."""
    for batch in batches:
        key, sig = (batch.column(c).to_numpy() for c in ("key", "sig"))
        found = []
        for turn in range(ORDERS):
            order = np.lexsort((mixed(sig.view(np.uint64) + np.uint64(turn)), key))
            a, b = sig[order][:-1], sig[order][1:]
            together = (key[order][:-1] == key[order][1:]) & (a != b)
            found.append(np.stack([np.minimum(a, b)[together], np.maximum(a, b)[together]], axis=1))
        pairs, often = np.unique(np.concatenate(found), axis=0, return_counts=True)
        a, b = (np.ascontiguousarray(pairs[:, i]) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(often.astype(np.int64))], names=["a", "b", "often"])


class _Cells:
    """Rows of whole cells: members of groups with their component, size, sketch and sorted keys."""

    def __init__(self, rows: pa.RecordBatch, percent: int):
        self.percent = percent
        self.cell, self.component, self.size, self.tile, self.sig = (
            rows.column(c).to_numpy() for c in ("cell", "component", "n_shingles", "tile", "sig")
        )
        self.crossing = rows.column("crossing").to_numpy(zero_copy_only=False)
        self.bits = np.stack([rows.column(b).to_numpy() for b in _BITS], axis=1).view(np.uint64)
        lists = rows.column("keys")
        self.listed = lists.value_lengths().to_numpy().astype(np.int64)
        self.begins = np.cumsum(self.listed) - self.listed
        keys, self.number = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        self.kinds, self.key = len(keys), np.searchsorted(keys, rows.column("key").to_numpy())
        # Ascending, because each row's keys are sorted.
        self.held = np.repeat(np.arange(len(self.listed)), self.listed) * self.kinds + self.number

    def first_met(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of rows have no lesser key in common than that of their cell."""
        first = np.ones(len(a), dtype=bool)
        for low in range(0, len(a), _PAIRS):
            one, two = a[low : low + _PAIRS], b[low : low + _PAIRS]
            pair = np.repeat(np.arange(len(one)), self.listed[one])
            asked = self.number[expand(self.begins[one], self.listed[one])]
            code = two[pair] * self.kinds + asked
            common = self.held[np.minimum(np.searchsorted(self.held, code), len(self.held) - 1)] == code
            first[low + pair[common & (asked < self.key[one][pair])]] = False
        return first

    def near(self, low: int, high: int) -> Iterator[np.ndarray]:
        """Pairs of rows of ``low:high``, a strip of rows against all others at a time."""
        own = np.arange(low, high)
        if self.cell[low] == self.cell[high - 1]:  # every pair sought has a member outside the most frequent component
            kinds, often = np.unique(self.component[low:high], return_counts=True)
            own = own[self.component[low:high] != kinds[np.argmax(often)]]
        is_own = np.zeros(high - low, dtype=bool)
        is_own[own - low] = True
        every = slice(low, high)
        for strip in range(0, len(own), _STRIP):
            some = own[strip : strip + _STRIP]
            fits = (self.component[some][:, None] != self.component[None, every]) & (self.cell[some][:, None] == self.cell[None, every])
            fits &= ~self.crossing[some][:, None] | (self.tile[some][:, None] != self.tile[None, every])
            fits &= ~is_own[None, :] | (some[:, None] < np.arange(low, high)[None, :])
            fits &= 100 * self.size[some][:, None] >= self.percent * self.size[None, every]
            fits &= 100 * self.size[None, every] >= self.percent * self.size[some][:, None]
            at, b = np.nonzero(fits)
            for part in range(0, len(at), _HAMMING):
                one, two = some[at[part : part + _HAMMING]], b[part : part + _HAMMING] + low
                apart = np.bitwise_count(self.bits[one] ^ self.bits[two]).sum(axis=1, dtype=np.int64)
                kept = (100 + self.percent) * apart <= (100 - self.percent) * (self.size[one] + self.size[two])
                one, two = one[kept], two[kept]
                first = self.first_met(one, two)
                yield np.stack([self.sig[one[first]], self.sig[two[first]]], axis=1)


def _cell_pairs(percent: int):
    """Pairs of a cell's members in different components whose sizes and whole sketches allow a link.

    A pair is given where its group has the least key of those that both members have, so it is given once.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "cell"):
            cells = _Cells(rows, percent)
            for low, high in packs(cells.cell, _STRIP):
                met = [m for m in cells.near(low, high) if len(m)]
                if met:
                    found = np.sort(np.concatenate(met), axis=1)
                    a, b = (pa.array(np.ascontiguousarray(found[:, i])) for i in (0, 1))
                    yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    return pairs


def _sets(n: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, data in text_slices(batches):
            hashes, bounds = shingle_sets(offsets, data, n)
            held = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(signed(hashes)))
            yield pa.RecordBatch.from_arrays([rows.column("sig"), held], names=["sig", "hashes"])

    return sets


class _Join:
    """The candidate rounds over one corpus."""

    def __init__(self, docs: DataFrame, n: int, percent: int):
        self.texts, self.n, self.percent = keyed(docs), n, percent
        schema = f"doc_id long, row long, n_shingles long, sig long, {', '.join(f'{b} long' for b in _BITS)}"
        self.described = settle(self.texts.mapInArrow(_describe(n), schema), "described")

    def shared_sketches(self, share: int) -> DataFrame:
        """``key, sig, spare``: the range sketches of one share of the keys that a set has in common with others."""
        schema = "key long, sig long, spare int, known byte"
        rows = self.texts.select("text").mapInArrow(_sketch_rows(self.n, self.percent, share, SHARES), schema)
        # Rows whose key needs no more matching are dealt by their set, so that a frequent key does not meet in one task.
        dealt = rows.repartition(F.when(F.col("known") == 2, F.xxhash64("key", "sig")).otherwise(F.col("key")))
        shared = dealt.sortWithinPartitions("key", "sig").mapInArrow(_shared_keys, "key long, sig long, spare int")
        shared = settle(shared.distinct(), "shared-sketches")
        forget_shuffles(shared.sparkSession)
        return shared

    def members(self) -> DataFrame:
        """``key, sig, n``: the range sketches that a set has in common with others, without its most frequent ones."""
        found = [self.shared_sketches(share) for share in range(SHARES)]
        shared = reduce(DataFrame.union, found)
        counts = settle(shared.groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("n")), "sketch-counts")
        counted = shared.join(counts.hint("merge"), F.col("key") == F.col("_key"))
        # A set has a bounded number of sketches, so ranking them is a small sort.
        rank = F.row_number().over(Window.partitionBy("sig").orderBy(F.desc("n"), "key"))
        kept = counted.withColumn("_rank", rank).where("_rank > spare AND n > 1").select("key", "sig", "n")
        kept = settle(kept, "members")
        release(*found, counts)
        return kept

    def candidate_sets(self, members: DataFrame) -> None:
        """Size, sketch and n-grams of every set that has candidates, from one row that has the set."""
        wanted = settle(members.select(F.col("sig").alias("_sig")).distinct(), "candidate-ids")
        holders = self.described.groupBy("sig").agg(F.min(F.struct(*_ROW, "n_shingles", *_BITS)).alias("s"))
        holders = settle(holders.join(wanted.hint("merge"), F.col("sig") == F.col("_sig")).select("sig", "s.*"), "holders")
        self.sigs = holders.select("sig", "n_shingles", *_BITS)
        read = rows_named(self.texts, holders.select("sig", *_ROW), ("doc_id", "row")).dropDuplicates(["sig"])
        self.sets = settle(read.select("sig", "text").mapInArrow(_sets(self.n), "sig long, hashes array<long>"), "sets")

    def near(self, pairs: DataFrame) -> DataFrame:
        """Candidates (``a, b``) that sizes and sketches do not rule out."""
        for side in ("a", "b"):
            renamed = self.sigs.select(
                F.col("sig").alias(f"_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in ["n_shingles", *_BITS]]
            )
            pairs = pairs.join(renamed.hint("merge"), F.col(side) == F.col(f"_{side}"))
        apart: Column = F.lit(0)
        for b in _BITS:
            apart = apart + F.bit_count(F.col(f"{b}_a").bitwiseXOR(F.col(f"{b}_b")))
        small, large = F.least("n_shingles_a", "n_shingles_b"), F.greatest("n_shingles_a", "n_shingles_b")
        allowed = (100 - self.percent) * (small + large)
        return pairs.where((100 * small >= self.percent * large) & ((100 + self.percent) * apart <= allowed)).select("a", "b")

    def mixed_members(self, left: DataFrame) -> DataFrame:
        """Members of mixed groups (``key, sig, component``) with size, sketch, the set's keys and the number of the group's tiles."""
        tiles = left.groupBy(F.col("key").alias("_key")).agg((1 + F.floor(F.count(F.lit(1)) / TILE)).alias("_tiles"))
        described = self.sigs.select(F.col("sig").alias("_sig"), "n_shingles", *_BITS)
        rows = left.join(settle(tiles, "tiles").hint("merge"), F.col("key") == F.col("_key"))
        # A set has a bounded number of sketches, so its list of keys is short.
        lists = left.groupBy(F.col("sig").alias("_sig")).agg(F.sort_array(F.collect_list("key")).alias("keys"))
        described = settle(described.join(lists.hint("merge"), "_sig"), "mixed-sets")
        return rows.join(described.hint("merge"), F.col("sig") == F.col("_sig"))

    def cells(self, rows: DataFrame, share: int) -> DataFrame:
        """:meth:`mixed_members`, dealt to cells where they are compared; one share of all cells, of large groups as of small ones.

        A group of up to ``TILE`` members is one cell. A larger one is cut into tiles by hash, and every two tiles are a
        cell, so no task holds a group, and comparisons are made in the task and never become rows.
        """
        rows = rows.withColumn("tile", F.pmod(F.xxhash64("sig", "key"), "_tiles"))
        rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tiles") - 1)))
        pair = F.xxhash64("key", F.least("tile", "_other"), F.greatest("tile", "_other"))
        rows = rows.select(
            pair.alias("cell"), "key", "keys", "sig", "component", "n_shingles", *_BITS, "tile", (F.col("tile") != F.col("_other")).alias("crossing")
        )
        rows = rows.where(F.pmod(F.col("cell"), F.lit(CELL_SHARES)) == share)
        # A cell of two tiles compares across; what they have of themselves is a cell of its own.
        return rows.repartition("cell").sortWithinPartitions("cell")

    def near_pairs(self, described: DataFrame, share: int) -> DataFrame:
        """Pairs (``a, b``) to verify that one share of the cells gives."""
        pairs = settle(self.cells(described, share).mapInArrow(_cell_pairs(self.percent), "a long, b long").distinct(), "near-pairs")
        forget_shuffles(pairs.sparkSession)
        return pairs

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """Those of stored candidates that are links."""
        one = self.sets.select(F.col("sig").alias("_a"), F.col("hashes").alias("one"))
        two = self.sets.select(F.col("sig").alias("_b"), F.col("hashes").alias("two"))
        both = pairs.join(one.hint("merge"), F.col("a") == F.col("_a")).join(two.hint("merge"), F.col("b") == F.col("_b"))
        common = F.size(F.array_intersect("one", "two"))
        linked = 100 * common >= self.percent * (F.size("one") + F.size("two") - common)
        return settle(both.where(linked).select("a", "b"), name)

    def run(self) -> DataFrame:
        """``vertex, component`` of all sets that link with another."""
        members = self.members()
        self.candidate_sets(members)

        # Large groups are gathered in parts, small ones as a whole.
        part = F.pmod(F.xxhash64("sig"), 1 + F.floor(F.col("n") / _GATHERED))
        gathered = members.select("key", "sig", part.alias("_part")).repartition("key", "_part").sortWithinPartitions("key", "_part")
        beside = settle(gathered.select("key", "sig").mapInArrow(_neighbours, "a long, b long, often long"), "neighbours")
        # Neighbours in many groups share many sketches; those are the likeliest to link.
        often = beside.groupBy("a", "b").agg(F.sum("often").alias("often"))
        turn = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("often"), F.xxhash64("a", "b"), "b"))
        some = settle(often.withColumn("_turn", turn).where(F.col("_turn") <= PARTNERS).select("a", "b"), "partners")
        links = self.verified(settle(self.near(some), "near-partners"), "first-links")

        found = settle(components(links), "first-components").select(F.col("vertex").alias("_v"), "component")
        placed = members.join(found.hint("merge"), F.col("sig") == F.col("_v"), "left")
        placed = settle(placed.select("key", "sig", F.coalesce("component", "sig").alias("component")), "placed")
        prints = [F.bit_xor(F.xxhash64("sig", F.lit(seed))).alias(f"_print{seed}") for seed in (1, 2)]
        kinds = placed.groupBy("key").agg(
            F.min("component").alias("_low"), F.max("component").alias("_high"), F.count(F.lit(1)).alias("_n"), *prints
        )
        # Sets that share much are together in many groups; of groups with the same members one is enough.
        unlike = kinds.where("_low < _high").groupBy("_n", "_print1", "_print2").agg(F.min("key").alias("_key"))
        mixed_keys = settle(unlike.select("_key"), "mixed-keys")
        left = settle(placed.join(mixed_keys.hint("merge"), F.col("key") == F.col("_key")).drop("_key"), "mixed-members")
        release(members, placed, beside)
        described = self.mixed_members(left)
        # A pair is given in one cell, that of its least common key and its tiles.
        crossed = [self.near_pairs(described, share) for share in range(CELL_SHARES)]
        more = self.verified(reduce(DataFrame.union, crossed), "more-links")
        # The components so far are stars, which stand for their links.
        stars = found.select(F.col("_v").alias("a"), F.col("component").alias("b"))
        return settle(components(stars.union(more)), "components")


def near_duplicate_classes(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: ``doc_id, row, n_shingles, component_id``.

    Words are runs of other characters than ASCII white space, A-Z lowered; the set is of ``n`` consecutive words, or
    of all words as one item if there are fewer. Rows link if the sets' Jaccard similarity is ``percent`` or more;
    empty sets (null or empty texts) link with nothing. ``component_id`` is the least ``doc_id`` reachable over links, the
    row's own included; null ids count as larger than any. Rows with the same id are rows of their own. An empty
    table gives an empty result; texts may be of any length.
    """
    join = _Join(docs, n, percent)
    found = join.run().select(F.col("vertex").alias("_v"), "component")
    rows = join.described
    vertex = F.when(F.col("sig") == 0, F.lit(None)).otherwise(F.col("sig"))
    placed = rows.join(found.hint("merge"), vertex == F.col("_v"), "left")
    placed = settle(placed.select(*_ROW, "n_shingles", F.coalesce("component", vertex).alias("_class")), "classes")
    least = placed.where(F.col("_class").isNotNull()).groupBy(F.col("_class").alias("_c")).agg(F.min("doc_id").alias("_least"))
    least = settle(least, "class-ids")
    named = placed.join(least.hint("merge"), F.col("_class") == F.col("_c"), "left")
    own = F.when(F.col("_class").isNull(), F.col("doc_id")).otherwise(F.col("_least"))
    return named.select(*_ROW, F.col("n_shingles").cast("long").alias("n_shingles"), own.alias("component_id"))


def drop_near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents with all their columns, one row of each class: the one with the least ``doc_id`` (of equal ids, the least row hash)."""
    classes = near_duplicate_classes(docs, n, percent).where("n_shingles > 0 AND component_id IS NOT NULL")
    dropped = settle(classes.where("doc_id IS NULL OR doc_id <> component_id").select(*_ROW).distinct(), "near-copies")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    doc_id = docs["doc_id"].cast("long")
    same = doc_id.eqNullSafe(dropped["doc_id"]) & (F.xxhash64(doc_id, text) == dropped["row"])
    return docs.join(dropped, same, "left_anti")
