"""Removal of repeated byte strings with suffix arrays of shards, built by induced sorting.

A whole corpus has no single suffix array here. Its text is cut so that equal strings always meet in one shard:

1. The ``window`` bytes from each position are folded to runs of positions with the same minimizer
   (see ``superkmers``). Equal strings have equal minimizers, so a run whose minimizer occurs nowhere else is
   done with: this leaves the neighbourhood of repeats.
2. A run that occurs twice as a whole is repeated in all its positions; its copies are one row from then on.
3. What is left are different runs around the same minimizer: the borders of repeats. They are dealt to
   shards by minimizer, and each shard sorts all suffixes of its runs. A position is repeated if it shares
   ``window`` bytes with the suffix sorted before or after it.

A shard holds about ``SHARD_BYTES``. A minimizer with more than ``CROWD`` different runs (a frequent passage with a
different surrounding each time) would make a shard of any size, so its runs are told apart by hashes, which are
aggregated before they are shuffled, and nothing is left out: runs are cut into blocks of ``BLOCK`` positions at the same
distance from the minimizer; blocks whose common bytes (those all their positions read) occur once are done with, equal
blocks are one, and only the positions of the others are compared one by one. Keys of strings are 128 bits wide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from headway.llm.suffixes import common_prefixes, joined_pieces, suffix_array
from headway.llm.superkmers import owner_of, runs_of
from headway.llm.texts import buffer_of, byte_hash, expand, keyed, rows_named, settle, signed, text_slices

WINDOW = 400
#: Bytes of a minimizer.
MINIMIZER = 32
SHARD_BYTES = 1_000_000
#: Different runs around one minimizer that a shard takes.
CROWD = 256
#: Neighbouring positions of a crowded run that are told apart together.
BLOCK = 16
_ROW = ["doc_id", "row"]
_RUN = ["hull", "hull2"]
#: Texts are folded in slices of this size: hashes of every byte take some ten times their room.
_FOLD_BYTES = 1_000_000


def _runs(window: int, k: int):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, data in text_slices(batches, _FOLD_BYTES):
            one = byte_hash(data, 31)
            runs = runs_of(one, offsets, window, k)
            if len(runs.start) == 0:
                continue
            two = byte_hash(data, 32)
            owner = owner_of(offsets, runs.start)
            end = runs.start + runs.count - 1 + window
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").take(pa.array(owner)),
                    rows.column("row").take(pa.array(owner)),
                    pa.array(runs.start - offsets[owner]),
                    pa.array(runs.count.astype(np.int32)),
                    pa.array((runs.anchor - runs.start).astype(np.int32)),
                    pa.array(signed(one(runs.anchor, runs.anchor + k))),
                    pa.array(signed(one(runs.start, end))),
                    pa.array(signed(two(runs.start, end))),
                ],
                names=["doc_id", "row", "start", "n", "at", "anchor", "hull", "hull2"],
            )

    return fold


def _pieces(window: int):
    """The bytes of chosen runs of each text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, data in text_slices(batches):
            lists = rows.column("runs")
            chosen = lists.flatten()
            text = np.repeat(np.arange(rows.num_rows), lists.value_lengths().to_numpy())
            first = offsets[text] + chosen.field("start").to_numpy()
            length = chosen.field("n").to_numpy().astype(np.int64) + window - 1
            held = data[expand(first, length)]
            ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
            piece = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(length), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(held.tobytes())]
            )
            names = ["anchor", "at", *_RUN, "copies", "crowded"]
            yield pa.RecordBatch.from_arrays(
                [*[chosen.field(c) for c in names], piece.cast(pa.binary())], names=[*names, "piece"]
            )

    return cut


def _repeated_in_shard(window: int):
    """Positions of single runs that share ``window`` bytes with another suffix of the shard."""

    def sort(table: pa.Table) -> pa.Table:
        offsets, data = buffer_of(table.column("piece"))
        text, starts = joined_pieces(offsets, data)
        order = suffix_array(text)
        shared, partner = common_prefixes(text, order, starts)
        long = shared >= window
        hit = long.copy()
        hit[partner[np.flatnonzero(long)]] = True
        places = np.flatnonzero(hit)
        piece = np.searchsorted(starts, places, side="right") - 1
        single = table.column("copies").to_numpy()[piece] == 1
        places, piece = places[single], piece[single]
        # Neighbouring positions of a run are one row.
        follows = (np.diff(places, prepend=-2) == 1) & (np.diff(piece, prepend=-1) == 0)
        first = np.flatnonzero(~follows)
        n = np.diff(np.append(first, len(places)))
        places, piece = places[first], piece[first]
        taken = pa.array(piece)
        return pa.table(
            {
                "hull": table.column("hull").take(taken),
                "hull2": table.column("hull2").take(taken),
                "nth": pa.array((places - starts[piece]).astype(np.int32)),
                "n": pa.array(n.astype(np.int32)),
            }
        )

    return sort


def _blocks(window: int):
    """Blocks of crowded runs: hashes of the bytes common to their positions, of all their bytes, and of each position's."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                rows = batch.slice(low, 256)
                offsets, data = buffer_of(rows.column("piece"))
                hashes = [byte_hash(data, seed) for seed in (31, 32)]
                n = np.diff(offsets) - window + 1
                place = expand(offsets[:-1], n)
                piece = np.repeat(np.arange(rows.num_rows), n)
                anchor = offsets[:-1] + rows.column("at").to_numpy()
                block = (anchor[piece] - place) // BLOCK
                fresh = np.ones(len(place), dtype=bool)
                fresh[1:] = (piece[1:] != piece[:-1]) | (block[1:] != block[:-1])
                first = np.flatnonzero(fresh)
                count = np.diff(np.append(first, len(place)))
                owner, number = piece[first], block[first]
                begin, end = place[first], place[first] + count - 1 + window
                core = anchor[owner] - number * BLOCK
                core_end = core - (BLOCK - 1) + window
                cuts = pa.array(np.append(first, len(place)).astype(np.int32))
                taken = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[rows.column(c).take(taken) for c in (*_RUN, "copies")],
                        pa.array((begin - offsets[owner]).astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        *[pa.array(signed(h(core, core_end))) for h in hashes],
                        *[pa.array(signed(h(begin, end))) for h in hashes],
                        *[pa.ListArray.from_arrays(cuts, pa.array(signed(h(place, place + window)))) for h in hashes],
                    ],
                    names=[*_RUN, "copies", "nth", "n", "core", "core2", "block", "block2", "keys", "keys2"],
                )

    return cut


def _repeated_in_crowds(pieces: DataFrame, window: int) -> DataFrame:
    """``hull, hull2, nth, n``: positions of single crowded runs that occur again."""
    schema = (
        "hull long, hull2 long, copies long, nth int, n int, core long, core2 long, block long, block2 long, "
        "keys array<long>, keys2 array<long>"
    )
    blocks = settle(pieces.mapInArrow(_blocks(window), schema), "blocks")
    cores = blocks.groupBy("core", "core2").agg(F.sum("copies").alias("_n")).where("_n > 1")
    cores = settle(cores.select(F.col("core").alias("_c"), F.col("core2").alias("_c2")), "block-cores")
    left = blocks.join(cores.hint("merge"), (F.col("core") == F.col("_c")) & (F.col("core2") == F.col("_c2")))
    left = settle(left.drop("_c", "_c2", "core", "core2"), "open-blocks")
    kinds = left.groupBy("block", "block2").agg(
        F.sum("copies").alias("_times"),
        F.min(F.struct(*_RUN, "nth")).alias("_run"),
        F.min(F.struct("keys", "keys2")).alias("_keys"),
    )
    kinds = settle(kinds, "block-kinds")

    again = kinds.where("_times > 1").select(F.col("block").alias("_b"), F.col("block2").alias("_b2"))
    whole = left.where("copies = 1").join(settle(again, "copied-blocks").hint("merge"), (F.col("block") == F.col("_b")) & (F.col("block2") == F.col("_b2")))

    places = kinds.select("_times", "_run", F.posexplode(F.arrays_zip("_keys.keys", "_keys.keys2")).alias("_at", "_key"))
    places = places.select("_times", "_run.*", "_at", F.col("_key.keys").alias("key"), F.col("_key.keys2").alias("key2"))
    places = settle(places, "block-positions")
    twice = places.groupBy("key", "key2").agg(F.sum("_times").alias("_n")).where("_n > 1")
    twice = settle(twice.select(F.col("key").alias("_k"), F.col("key2").alias("_k2")), "repeated-keys")
    met = places.where("_times = 1").join(twice.hint("merge"), (F.col("key") == F.col("_k")) & (F.col("key2") == F.col("_k2")))
    return whole.select(*_RUN, "nth", "n").unionByName(
        met.select(*_RUN, (F.col("nth") + F.col("_at")).alias("nth"), F.lit(1).alias("n"))
    )


def repeated_positions(docs: DataFrame, window: int = WINDOW, k: int = MINIMIZER) -> DataFrame:
    """``doc_id, row, start, n``: positions [start, start + n) from where ``window`` bytes also start elsewhere."""
    texts = keyed(docs)
    schema = "doc_id long, row long, start long, n int, at int, anchor long, hull long, hull2 long"
    runs = settle(texts.mapInArrow(_runs(window, k), schema), "runs")
    shared = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    shared = settle(shared.select(F.col("anchor").alias("_anchor")), "run-anchors")
    suspects = runs.join(shared.hint("merge"), F.col("anchor") == F.col("_anchor")).drop("_anchor")
    suspects = settle(suspects, "suspect-runs")

    kinds = suspects.groupBy("anchor", *_RUN).agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "row", "start")).alias("s"), F.max("n").alias("n"), F.max("at").alias("at")
    )
    kinds = settle(kinds.select("anchor", *_RUN, "copies", "n", "at", "s.*"), "run-kinds")
    copied = settle(kinds.where("copies > 1").select(F.col("hull").alias("_h"), F.col("hull2").alias("_h2")), "copied-runs")
    whole = suspects.join(copied.hint("merge"), (F.col("hull") == F.col("_h")) & (F.col("hull2") == F.col("_h2")))
    whole = whole.select(*_ROW, "start", "n")

    crowds = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("_kinds"), F.min("copies").alias("_least"))
    crowds = crowds.where("_kinds > 1 AND _least = 1").select(F.col("anchor").alias("_anchor"), (F.col("_kinds") > CROWD).alias("crowded"))
    unlike = kinds.join(settle(crowds, "crowds").hint("merge"), F.col("anchor") == F.col("_anchor")).drop("_anchor")
    lists = unlike.groupBy(*_ROW).agg(F.collect_list(F.struct("start", "n", "anchor", "at", *_RUN, "copies", "crowded")).alias("runs"))
    listed = rows_named(texts, settle(lists, "run-lists"), ("doc_id", "row")).dropDuplicates(_ROW)
    schema = "anchor long, at int, hull long, hull2 long, copies long, crowded boolean, piece binary"
    pieces = settle(listed.select("text", "runs").mapInArrow(_pieces(window), schema), "pieces")

    total = pieces.where(~F.col("crowded")).agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    shards = F.pmod(F.xxhash64("anchor"), F.lit(1 + total // SHARD_BYTES))
    alone = (
        pieces.where(~F.col("crowded"))
        .select(shards.alias("shard"), *_RUN, "copies", "piece")
        .groupBy("shard")
        .applyInArrow(_repeated_in_shard(window), "hull long, hull2 long, nth int, n int")
    )
    crowded = pieces.where("crowded").select(*_RUN, "at", "copies", "piece")
    partly = settle(alone.unionByName(_repeated_in_crowds(crowded, window)), "repeated-positions")
    owners = kinds.where("copies = 1").select(F.col("hull").alias("_h"), F.col("hull2").alias("_h2"), *_ROW, "start")
    placed = partly.join(owners.hint("merge"), (F.col("hull") == F.col("_h")) & (F.col("hull2") == F.col("_h2")))
    placed = placed.select(*_ROW, (F.col("start") + F.col("nth")).alias("start"), "n")
    return whole.unionByName(placed)


def _cut_out(window: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("row", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, data in text_slices(batches):
            lists = rows.column("positions")
            begun = lists.flatten()
            text = np.repeat(np.arange(rows.num_rows), lists.value_lengths().to_numpy())
            start = offsets[text] + begun.field("start").to_numpy()
            end = start + begun.field("n").to_numpy() + window - 1
            depth = np.zeros(len(data) + 1, dtype=np.int64)
            np.add.at(depth, start, 1)
            np.add.at(depth, end, -1)
            gone = np.cumsum(depth[:-1]) > 0
            border = np.zeros(len(data), dtype=bool)
            border[offsets[:-1][np.diff(offsets) > 0]] = True
            opens = gone & (border | ~np.concatenate([[False], gone[:-1]]))
            out = []
            ids, keys = rows.column("doc_id").to_pylist(), rows.column("row").to_pylist()
            for i, (first, last) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
                lost = gone[first:last]
                out.append(
                    {"doc_id": ids[i], "row": keys[i], "n_removed": int(lost.sum()), "n_spans": int(opens[first:last].sum()), "kept": data[first:last][~lost].tobytes()}
                )
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return cut


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW, k: int = MINIMIZER) -> DataFrame:
    """Documents that lose bytes: ``doc_id, row, n_removed, n_spans, kept`` (binary: the bytes that stay, concatenated).

    A byte goes if a string of ``window`` bytes covers it that also starts anywhere else, in the same text or
    another; strings are judged on the input and never cross texts. A cut may fall inside a character, so
    ``kept`` is bytes. A null text is empty. Rows that repeat an id and a text are copies of each other. An empty
    table gives an empty result; texts may be of any length.
    """
    begun = repeated_positions(docs, window, k)
    lists = begun.groupBy(*_ROW).agg(F.collect_list(F.struct("start", "n")).alias("positions"))
    touched = rows_named(keyed(docs), settle(lists, "position-lists"), ("doc_id", "row")).dropDuplicates(_ROW)
    schema = "doc_id long, row long, n_removed long, n_spans long, kept binary"
    return touched.select("doc_id", "row", "text", "positions").mapInArrow(_cut_out(window), schema)


def byte_removal_digests(docs: DataFrame, window: int = WINDOW, k: int = MINIMIZER) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    removed = remove_repeated_bytes(docs, window, k)
    removed = settle(removed.select("doc_id", "row", "n_removed", "n_spans", F.sha2("kept", 256).alias("_kept")), "bytes-removed")
    rows = keyed(docs).select(
        "doc_id", "row", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("_all")
    )
    a, r = settle(rows, "byte-digests").alias("a"), removed.alias("r")
    same = F.col("a.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("a.row") == F.col("r.row"))
    return a.join(r, same, "left").select(
        F.col("a.doc_id").alias("doc_id"),
        F.col("a.n_bytes").alias("n_bytes"),
        F.coalesce(F.col("r.n_removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.col("r.n_spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce(F.col("r._kept"), F.col("a._all")).alias("kept_sha256"),
    )
