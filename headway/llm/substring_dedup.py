"""Removal of long repeated word sequences by compaction of their De Bruijn graph.

Edges of the graph are the windows of ``window`` words; a window that occurs in documents with different ids is
a repeated edge. Writing a row per edge would multiply the corpus, so paths are compacted first:

1. *Super-k-mers*: neighbouring windows with the same minimizer form a nonbranching path inside a document and are
   one row (some twenty windows). A path whose minimizer occurs in one document id only holds no repeated
   edge and goes no further.
2. Equal paths meet in a join on their hash: every edge of a path that a smaller id has as well is repeated.
3. Only where different paths share a minimizer does the graph branch. There one path of each kind (the one
   with the smallest id) is cut into its edges, and these meet in a join.
4. Repeated paths and edges that continue each other in the document and in its source are glued to long spans.
5. Source coordinates verify each span: the words at the source, hashed with SHA-256, must equal the
   words to be removed.

Hot passages: aggregations fold them before the shuffle, and joins on their hash are between two stored tables,
whose large partitions Spark may split. Texts move only if they hold a path of steps 3 to 5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from headway.llm.superkmers import owner_of, runs_of
from headway.llm.texts import SpanHash, expand, keyed, rows_named, settle, signed, spaced, text_slices, word_hash, words_of

WINDOW = 50
#: Words of a minimizer; longer ones are rarer by chance, shorter ones make longer paths.
MINIMIZER = 10
_PATH = ["hull", "hull2"]


def _tokens(offsets: np.ndarray, data: np.ndarray) -> tuple[SpanHash, SpanHash, np.ndarray]:
    starts, ends, bounds = words_of(offsets, data)
    words = word_hash(data, starts, ends, 21)
    other = word_hash(data, starts, ends, 22)
    return SpanHash(words, 23), SpanHash(other, 24), bounds


def _paths(window: int, k: int):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, data in text_slices(batches):
            one, two, bounds = _tokens(offsets, data)
            runs = runs_of(one, bounds, window, k)
            if len(runs.start) == 0:
                continue
            owner = owner_of(bounds, runs.start)
            end = runs.start + runs.count - 1 + window
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").take(pa.array(owner)),
                    rows.column("row").take(pa.array(owner)),
                    pa.array((runs.start - bounds[owner]).astype(np.int32)),
                    pa.array(runs.count.astype(np.int32)),
                    pa.array(signed(one(runs.anchor, runs.anchor + k))),
                    pa.array(signed(one(runs.start, end))),
                    pa.array(signed(two(runs.start, end))),
                ],
                names=["doc_id", "row", "start", "n", "anchor", "hull", "hull2"],
            )

    return fold


def _edges(window: int):
    """The windows of chosen paths of each text, as (path, place in the path, window hash)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, offsets, data in text_slices(batches):
            one, two, bounds = _tokens(offsets, data)
            lists = rows.column("paths")
            chosen = lists.flatten()
            text = np.repeat(np.arange(rows.num_rows), lists.value_lengths().to_numpy())
            start = chosen.field("start").to_numpy().astype(np.int64)
            n = chosen.field("n").to_numpy().astype(np.int64)
            place = expand(bounds[text] + start, n)
            path = pa.array(np.repeat(np.arange(len(n)), n))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").take(pa.array(text)).take(path),
                    rows.column("row").take(pa.array(text)).take(path),
                    pa.array((place - bounds[np.repeat(text, n)]).astype(np.int32)),
                    pa.array((place - np.repeat(bounds[text] + start, n)).astype(np.int32)),
                    chosen.field("hull").take(path),
                    chosen.field("hull2").take(path),
                    pa.array(signed(one(place, place + window))),
                    pa.array(signed(two(place, place + window))),
                ],
                names=["doc_id", "row", "start", "nth", "hull", "hull2", "edge", "edge2"],
            )

    return cut


def _word_slices(text: str) -> tuple[bytes, np.ndarray, np.ndarray]:
    raw = text.encode()
    data = np.frombuffer(raw, dtype=np.uint8)
    starts, ends, _ = words_of(np.array([0, len(data)]), data)
    return raw, starts, ends


def _digest(raw: bytes, starts: np.ndarray, ends: np.ndarray, first: int, last: int) -> bytes:
    """Hash of the words [first, last), whatever separates them."""
    return hashlib.sha256(b" ".join(raw[s:e] for s, e in zip(starts[first:last], ends[first:last], strict=True))).digest()


def _source_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: list[dict] = []
        for row in batch.to_pylist():
            raw, starts, ends = _word_slices(row["text"])
            for span in row["spans"]:
                first, last = span["source_start"], span["source_start"] + span["n_words"]
                found.append(
                    {"source": row["doc_id"], "source_row": row["row"], "source_start": first, "n_words": span["n_words"], "digest": _digest(raw, starts, ends, first, last)}
                )
        yield pa.RecordBatch.from_pylist(
            found,
            schema=pa.schema(
                [("source", pa.int64()), ("source_row", pa.int64()), ("source_start", pa.int32()), ("n_words", pa.int32()), ("digest", pa.binary())]
            ),
        )


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
    for batch in batches:
        for row in batch.to_pylist():
            raw, starts, ends = _word_slices(row["text"])
            gone = np.zeros(len(starts), dtype=bool)
            for span in row["spans"]:
                first, last = span["start"], span["start"] + span["n_words"]
                if _digest(raw, starts, ends, first, last) == span["digest"]:
                    gone[first:last] = True
            kept = b" ".join(raw[s:e] for s, e in zip(starts[~gone], ends[~gone], strict=True)).decode()
            yield pa.RecordBatch.from_pylist(
                [{"doc_id": row["doc_id"], "row": row["row"], "n_removed": int(gone.sum()), "kept": kept}], schema=schema
            )


def _glue(found: DataFrame, window: int) -> DataFrame:
    """Join repeated paths and edges that follow each other in the document and in the source alike."""
    along = Window.partitionBy("doc_id", "row").orderBy("start", "source_start")
    follows = (
        (F.lag("source").over(along) == F.col("source"))
        & (F.lag("source_row").over(along) == F.col("source_row"))
        & (F.lag(F.col("start") + F.col("n")).over(along) == F.col("start"))
        & (F.lag(F.col("source_start") + F.col("n")).over(along) == F.col("source_start"))
    )
    numbered = found.withColumn("_span", F.sum(F.when(follows, 0).otherwise(1)).over(along))
    spans = numbered.groupBy("doc_id", "row", "_span").agg(
        F.min("start").alias("start"),
        F.min("source_start").alias("source_start"),
        F.first("source").alias("source"),
        F.first("source_row").alias("source_row"),
        (F.sum("n") + (window - 1)).cast("int").alias("n_words"),
    )
    return spans.drop("_span")


def _source(doc_id: str, row: str, start: str) -> Column:
    return F.min(F.struct(F.col(doc_id).alias("source"), F.col(row).alias("source_row"), F.col(start).alias("source_start")))


def repeated_spans(docs: DataFrame, window: int = WINDOW, k: int = MINIMIZER) -> DataFrame:
    """Word spans to remove: ``doc_id, row, start, n_words, source, source_row, source_start``.

    A span is covered by windows that also start in a document with a smaller id, the source. Rows without an id
    are neither sources nor targets.
    """
    texts = keyed(docs).where(F.col("doc_id").isNotNull())
    schema = "doc_id long, row long, start int, n int, anchor long, hull long, hull2 long"
    paths = settle(texts.mapInArrow(_paths(window, k), schema), "paths")
    shared = paths.groupBy("anchor").agg(F.min("doc_id").alias("_low"), F.max("doc_id").alias("_high"))
    shared = settle(shared.where("_low < _high").select(F.col("anchor").alias("_anchor")), "anchors")
    suspects = paths.join(shared.hint("merge"), F.col("anchor") == F.col("_anchor")).drop("_anchor")
    suspects = settle(suspects, "suspect-paths")

    kinds = suspects.groupBy("anchor", *_PATH).agg(_source("doc_id", "row", "start").alias("s"), F.max("n").alias("n"))
    kinds = settle(kinds.select("anchor", *_PATH, "n", "s.*"), "path-kinds")
    by_path = suspects.join(
        kinds.select(*[F.col(c).alias(f"_{c}") for c in _PATH], "source", "source_row", "source_start").hint("merge"),
        (F.col("hull") == F.col("_hull")) & (F.col("hull2") == F.col("_hull2")),
    )
    whole = by_path.where("doc_id > source").select("doc_id", "row", "start", "n", "source", "source_row", "source_start")
    # The paths of the smallest id itself: repeated in part at most, edge by edge.
    firsts = by_path.where("doc_id = source").select("doc_id", "row", "start", *_PATH)

    branching = kinds.groupBy("anchor").agg(F.min("source").alias("_low"), F.max("source").alias("_high"))
    branching = settle(branching.where("_low < _high").select(F.col("anchor").alias("_anchor")), "branches")
    cut = kinds.join(branching.hint("merge"), F.col("anchor") == F.col("_anchor"))
    lists = cut.groupBy(F.col("source").alias("doc_id"), F.col("source_row").alias("row")).agg(
        F.collect_list(F.struct(F.col("source_start").alias("start"), "n", *_PATH)).alias("paths")
    )
    listed = rows_named(texts, settle(lists, "branch-lists"), ("doc_id", "row"))
    schema = "doc_id long, row long, start int, nth int, hull long, hull2 long, edge long, edge2 long"
    edges = settle(listed.select("doc_id", "row", "text", "paths").mapInArrow(_edges(window), schema), "edges")
    least = edges.groupBy("edge", "edge2").agg(
        _source("doc_id", "row", "start").alias("s"), F.max("doc_id").alias("_high")
    )
    least = least.where("s.source < _high").select(F.col("edge").alias("_e"), F.col("edge2").alias("_e2"), "s.*")
    least = settle(least, "edge-sources")
    hits = edges.join(least.hint("merge"), (F.col("edge") == F.col("_e")) & (F.col("edge2") == F.col("_e2")))
    hits = settle(hits.where("doc_id > source").select(*_PATH, "nth", "source", "source_row", "source_start"), "edge-hits")
    hits = hits.select(*[F.col(c).alias(f"_{c}") for c in _PATH], "nth", "source", "source_row", "source_start")
    settled_firsts = settle(firsts, "first-paths")
    partly = settled_firsts.join(hits.hint("merge"), (F.col("hull") == F.col("_hull")) & (F.col("hull2") == F.col("_hull2")))
    partly = partly.select(
        "doc_id", "row", (F.col("start") + F.col("nth")).alias("start"), F.lit(1).alias("n"), "source", "source_row", "source_start"
    )
    return _glue(whole.unionByName(partly), window)


def remove_repeats(docs: DataFrame, window: int = WINDOW, k: int = MINIMIZER) -> DataFrame:
    """Documents that lose words: ``doc_id, row, n_removed, kept``, ``kept`` being the other words joined by one space.

    A word goes if a window of ``window`` consecutive words covers it whose words also start in a document with
    a smaller ``doc_id``; windows are judged on the input. Words are compared as bytes. A null text has no words; a row
    with a null id loses nothing and takes nothing from others; rows with the same id never take words from each
    other. An empty table gives an empty result; texts may be of any length.
    """
    texts = keyed(docs).where(F.col("doc_id").isNotNull())
    spans = settle(repeated_spans(docs, window, k), "spans")
    place = ["source", "source_row", "source_start", "n_words"]
    wanted = spans.select(*place).distinct().groupBy(F.col("source").alias("doc_id"), F.col("source_row").alias("row"))
    wanted = settle(wanted.agg(F.collect_list(F.struct("source_start", "n_words")).alias("spans")), "source-lists")
    read = rows_named(texts, wanted, ("doc_id", "row")).dropDuplicates(["doc_id", "row"]).select("doc_id", "row", "text", "spans")
    digests = read.mapInArrow(
        _source_digests, "source long, source_row long, source_start int, n_words int, digest binary"
    )
    known = spans.join(settle(digests, "source-digests").hint("merge"), place)
    lists = known.groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "n_words", "digest")).alias("spans"))
    touched = rows_named(texts, settle(lists, "span-lists"), ("doc_id", "row"))
    touched = touched.dropDuplicates(["doc_id", "row"]).select("doc_id", "row", "text", "spans")
    return touched.mapInArrow(_cut_out, "doc_id long, row long, n_removed long, kept string")


def with_repeats_removed(docs: DataFrame, window: int = WINDOW, k: int = MINIMIZER) -> DataFrame:
    """The documents with all their columns; texts that lose words become their other words, ``n_chars`` follows."""
    removed = remove_repeats(docs, window, k).select("doc_id", "row", "kept")
    removed = settle(removed.select(F.struct("doc_id", "row", "kept").alias("_removed")), "kept-texts")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    doc_id = docs["doc_id"].cast("long")
    same = (doc_id == removed["_removed.doc_id"]) & (F.xxhash64(doc_id, text) == removed["_removed.row"])
    joined = docs.join(removed, same, "left")
    changed = removed["_removed"].isNotNull()
    columns = []
    for name in docs.columns:
        column = docs[name]
        if name == "text":
            column = F.when(changed, removed["_removed.kept"]).otherwise(column)
        elif name == "n_chars":
            column = F.when(changed, F.length(removed["_removed.kept"])).otherwise(column).cast(docs.schema[name].dataType)
        columns.append(column.alias(name))
    return joined.select(*columns)


def removal_digests(docs: DataFrame, window: int = WINDOW, k: int = MINIMIZER) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_sha256`` of the words that stay, joined by one space."""
    removed = remove_repeats(docs, window, k)
    removed = settle(removed.select("doc_id", "row", "n_removed", F.sha2("kept", 256).alias("_kept")), "removed").alias("r")
    rows = keyed(docs).select("doc_id", "row", spaced(F.col("text")).alias("_words"))
    n_words = F.when(F.col("_words") == "", F.lit(0)).otherwise(F.size(F.split("_words", " "))).cast("long")
    rows = settle(rows.select("doc_id", "row", n_words.alias("n_words"), F.sha2("_words", 256).alias("_all")), "word-digests")
    a = rows.alias("a")
    same = (F.col("a.doc_id") == F.col("r.doc_id")) & (F.col("a.row") == F.col("r.row"))
    return a.join(removed, same, "left").select(
        F.col("a.doc_id").alias("doc_id"),
        F.col("a.n_words").alias("n_words"),
        F.coalesce(F.col("r.n_removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.col("r._kept"), F.col("a._all")).alias("kept_sha256"),
    )
