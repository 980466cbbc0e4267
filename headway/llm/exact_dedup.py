"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Each scan task (a *sender*) hashes its texts to 64 bits and sorts the fingerprints. The hash space is
   cut into as many equal ranges as there are *owners*; a sender sends each owner the distinct
   fingerprints of its range, as Golomb-coded gaps: about a byte and a half more than
   log2(range / count) bits each, instead of eight bytes.
2. An owner decodes its messages, finds fingerprints sent by two or more senders, and answers each
   message with a bitmap. Fingerprints that a sender holds twice are marked by the sender itself.
3. Only documents whose bit is set (*suspects*) move their text. Suspects are grouped by the text itself,
   so a collision of fingerprints cannot merge different texts.

The senders' rows are stored with their document ids before anything is sent, so an answer always
meets the rows it was asked for, whatever is recomputed. A sender holds at most ``SENDER_ROWS`` rows
(a larger task makes several senders). A text with very many copies is one fingerprint per sender in step 2;
in step 3 copies are pre-aggregated where they are read, and each is then compared with its group's
one stored row, in a join whose large partitions Spark may split.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from headway.llm.texts import byte_hash, documents, parts, rows_named, settle, signed, text_slices

SENDER_ROWS = 500_000
_SENT = "sender string, owner long, n long, divisor long, quotients binary, remainders binary, doc_ids binary, places binary, doubled binary"
_SENT_TYPE = pa.schema(
    [
        ("sender", pa.string()),
        ("owner", pa.int64()),
        ("n", pa.int64()),
        ("divisor", pa.int64()),
        ("quotients", pa.binary()),
        ("remainders", pa.binary()),
        ("doc_ids", pa.binary()),
        ("places", pa.binary()),
        ("doubled", pa.binary()),
    ]
)
#: Fingerprints are cut to so many bits inside an owner's range; a chance collision only makes a suspect.
GAP_BITS = 62


def golomb_encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """(divisor, unary quotients, binary remainders) of the gaps of sorted distinct integers.

    The divisor is ln 2 times the mean gap, which is the best for random gaps. Remainders have the
    least whole number of bits that the divisor needs.
    """
    if len(values) == 0:
        return 1, b"", b""
    gaps = np.diff(values, prepend=np.int64(0))
    divisor = max(1, round(math.log(2) * (int(values[-1]) // len(values) + 1)))
    quotient, remainder = np.divmod(gaps, divisor)
    stops = np.cumsum(quotient + 1) - 1
    unary = np.zeros(int(stops[-1]) + 1, dtype=np.uint8)
    unary[stops] = 1
    width = max(1, (divisor - 1).bit_length())
    shifts = np.arange(width - 1, -1, -1, dtype=np.int64)
    bits = ((remainder[:, None] >> shifts) & 1).astype(np.uint8)
    return divisor, np.packbits(unary).tobytes(), np.packbits(bits.ravel()).tobytes()


def golomb_decode(n: int, divisor: int, quotients: bytes, remainders: bytes) -> np.ndarray:
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(quotients, dtype=np.uint8)))[:n]
    quotient = np.diff(stops, prepend=-1) - 1
    width = max(1, (divisor - 1).bit_length())
    bits = np.unpackbits(np.frombuffer(remainders, dtype=np.uint8))[: n * width].reshape(n, width)
    weights = np.left_shift(np.int64(1), np.arange(width - 1, -1, -1, dtype=np.int64))
    return np.cumsum(quotient.astype(np.int64) * divisor + bits.astype(np.int64) @ weights)


def _messages(name: str, ids: np.ndarray, known: np.ndarray, prints: np.ndarray, owners: int) -> Iterator[dict]:
    """One message per owner; ``doc_ids`` and ``places`` stay with the sender's stored row."""
    span = 2**GAP_BITS // owners
    owner = np.minimum(prints // span, owners - 1)
    order = np.argsort(prints, kind="stable")
    prints, owner, ids, known = prints[order], owner[order], ids[order], known[order]
    for start, end in zip(*_runs(owner), strict=True):
        own = prints[start:end]
        distinct, place, count = np.unique(own, return_inverse=True, return_counts=True)
        divisor, unary, binary = golomb_encode(distinct - owner[start] * span)
        yield {
            "sender": name,
            "owner": int(owner[start]),
            "n": len(distinct),
            "divisor": divisor,
            "quotients": unary,
            "remainders": binary,
            "doc_ids": ids[start:end].tobytes() + np.packbits(known[start:end]).tobytes(),
            "places": place.astype(np.int32).tobytes(),
            "doubled": np.packbits(count > 1).tobytes(),
        }


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.diff(values, prepend=values[:1] - 1))
    return starts, np.append(starts[1:], len(values))


def _sender(owners: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        sent = rows_held = 0
        attempt = TaskContext.get().taskAttemptId()

        def flush() -> pa.RecordBatch:
            ids, known, prints = (np.concatenate(x) for x in zip(*held, strict=True))
            messages = list(_messages(f"{attempt}.{sent}", ids, known, prints, owners))
            return pa.RecordBatch.from_pylist(messages, schema=_SENT_TYPE)

        for rows, offsets, data in text_slices(batches):
            prints = byte_hash(data, 11)(offsets[:-1], offsets[1:])
            ids = rows.column("doc_id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            held.append((ids.fill_null(0).to_numpy(), known, signed(prints >> np.uint64(64 - GAP_BITS))))
            rows_held += len(known)
            if rows_held >= SENDER_ROWS:
                yield flush()
                held, rows_held, sent = [], 0, sent + 1
        if held:
            yield flush()

    return send


def _owner(messages):
    """Bitmaps over the fingerprints of each message: set where another sender has it too."""
    lists = [
        golomb_decode(int(m.n), int(m.divisor), m.quotients, m.remainders)
        for m in messages.itertuples(index=False)
    ]
    everything = np.sort(np.concatenate(lists))
    twice = np.unique(everything[1:][everything[1:] == everything[:-1]])
    answers = messages[["sender", "owner"]].copy()
    answers["shared"] = [np.packbits(np.isin(x, twice, assume_unique=True)).tobytes() for x in lists]
    return answers


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            marks = np.unpackbits(np.frombuffer(row["doubled"], dtype=np.uint8)) | np.unpackbits(
                np.frombuffer(row["shared"], dtype=np.uint8)
            )
            place = np.frombuffer(row["places"], dtype=np.int32)
            ids = np.frombuffer(row["doc_ids"][: 8 * len(place)], dtype=np.int64)
            known = np.unpackbits(np.frombuffer(row["doc_ids"][8 * len(place) :], dtype=np.uint8))[: len(place)] == 1
            hit = marks[place] == 1
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit], mask=~known[hit])], names=["doc_id"])


def suspect_ids(docs: DataFrame) -> DataFrame:
    """Distinct ids of documents whose fingerprint some other row has too (a superset of the duplicates)."""
    owners = parts(docs.sparkSession)
    sent = settle(documents(docs).mapInArrow(_sender(owners), _SENT), "fingerprints")
    answers = (
        sent.select("sender", "owner", "n", "divisor", "quotients", "remainders")
        .groupBy("owner")
        .applyInPandas(_owner, "sender string, owner long, shared binary")
    )
    asked = sent.select("sender", "owner", "doc_ids", "places", "doubled")
    return asked.join(answers, ["sender", "owner"]).mapInArrow(_suspects, "doc_id long").distinct()


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the largest ``doc_id`` stays; texts are compared byte for byte, null as empty.
    Rows that repeat both id and text count in ``group_size`` and are kept or dropped together. A null
    id never wins over a number; a group without any number keeps its rows (``keep_id`` is null).
    An empty table gives an empty result. Texts may be of any length.
    """
    texts = documents(docs)
    all_rows = settle(texts.select("doc_id", F.sha2("text", 256).alias("text_sha256")), "digests")
    moved = rows_named(texts, settle(suspect_ids(docs), "suspect-ids"))
    moved = settle(moved.select("doc_id", F.xxhash64("text").alias("_print"), "text"), "suspects")

    groups = moved.groupBy("_print", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = settle(groups.where("group_size > 1"), "groups").alias("g")
    members = moved.alias("m").join(groups, (F.col("m._print") == F.col("g._print")) & (F.col("m.text") == F.col("g.text")))
    members = members.select(
        F.col("m.doc_id").alias("doc_id"), F.sha2("m.text", 256).alias("text_sha256"), "keep_id", "group_size"
    )
    # One row per id and text, so that a repeated row finds one partner.
    members = members.groupBy("doc_id", "text_sha256").agg(
        F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
    )
    a, m = all_rows.alias("a"), members.alias("m")
    same = F.col("a.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("a.text_sha256") == F.col("m.text_sha256"))
    keep = F.when(F.col("m.group_size").isNull(), F.col("a.doc_id")).otherwise(F.col("m.keep_id"))
    return a.join(m, same, "left").select(
        F.col("a.doc_id").alias("doc_id"),
        keep.alias("keep_id"),
        F.coalesce(F.col("m.group_size"), F.lit(1)).cast("long").alias("group_size"),
        F.col("a.doc_id").eqNullSafe(keep).alias("kept"),
        F.col("a.text_sha256").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    dropped = exact_duplicates(docs).where(~F.col("kept")).select("doc_id", "text_sha256").distinct()
    digest = F.sha2(F.coalesce(docs["text"].cast("string"), F.lit("")), 256)
    same = docs["doc_id"].cast("long").eqNullSafe(dropped["doc_id"]) & (digest == dropped["text_sha256"])
    return docs.join(dropped, same, "left_anti")
