"""Byte-level BPE encoding by replaying the merges over a body of text at once, and decoding.

A task takes a slice of its texts, cuts them where no token can reach across, and keeps one copy of each distinct stretch and
of each distinct match of the splitting pattern. Over all those matches together it builds an inverted index from
token pair to the positions where the pair stands, then applies the merges in rank order: the pair of least
rank is replaced wherever it stands, and only the pairs with its neighbours change their index entries. The work
follows the distinct matches, not the length of the text. Ids are then gathered back for each text.

Taking a rank everywhere before the next is what merging each match by itself does, unless a merge makes a
pair of lower rank than its own. Such matches are noticed and merged by themselves.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from headway.llm.texts import buffer_of, documents, expand, text_slices

#: Bytes of text that are replayed together, and whose ids are put together.
_SLICE = 12_000_000
_ASSEMBLE = 2_000_000


class Vocabulary:
    """Ranks of a ``.tiktoken`` file; a token's id is its rank."""

    def __init__(self, path: str):
        self.path = path
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        size = max(self.rank.values()) + 1
        self.token: list[bytes] = [b""] * size
        for token, rank in self.rank.items():
            self.token[rank] = token
        self.of_byte = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int64)
        lengths = np.array([len(t) for t in self.token], dtype=np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.bytes = np.frombuffer(b"".join(self.token), dtype=np.uint8)
        self._merged: dict[int, int] = {}

    def merged(self, code: int) -> int:
        """Rank of the token that a pair (first << 32 | second) makes, or -1."""
        rank = self._merged.get(code)
        if rank is None:
            rank = self.rank.get(self.token[code >> 32] + self.token[code & 0xFFFFFFFF], -1)
            if len(self._merged) > 2_000_000:
                self._merged.clear()
            self._merged[code] = rank
        return rank


_VOCABULARY: list[Vocabulary] = []


def vocabulary(path: str) -> Vocabulary:
    if not _VOCABULARY or _VOCABULARY[0].path != path:
        _VOCABULARY[:] = [Vocabulary(path)]
    return _VOCABULARY[0]


def merge_alone(vocab: Vocabulary, match: bytes) -> list[int]:
    """One match merged by itself: always the leftmost pair of least rank."""
    ids = [int(vocab.of_byte[b]) for b in match]
    while len(ids) > 1:
        ranks = [vocab.merged((a << 32) | b) for a, b in zip(ids, ids[1:], strict=False)]
        least = min((r for r in ranks if r >= 0), default=-1)
        if least < 0:
            break
        at = ranks.index(least)
        ids[at : at + 2] = [least]
    return ids


class _Replay:
    """All matches as one row of tokens, linked to their neighbours within the match."""

    def __init__(self, vocab: Vocabulary, offsets: np.ndarray, data: np.ndarray):
        self.vocab, n = vocab, len(data)
        self.ids = vocab.of_byte[data]
        self.alive = np.ones(n, dtype=bool)
        self.next = np.arange(1, n + 1, dtype=np.int64)
        self.prev = np.arange(-1, n - 1, dtype=np.int64)
        full = np.diff(offsets) > 0
        self.next[offsets[1:][full] - 1] = -1
        self.prev[offsets[:-1][full]] = -1
        self.index: dict[int, list[np.ndarray]] = {}
        self.heap: list[tuple[int, int]] = []
        self.odd: list[np.ndarray] = []

    def run(self) -> np.ndarray:
        """Apply every merge; returns positions inside matches that must be merged by themselves."""
        left = np.flatnonzero(self.next >= 0)
        self._enter((self.ids[left] << 32) | self.ids[left + 1], left, -1)
        while self.heap:
            rank, code = heapq.heappop(self.heap)
            places = self.index.pop(code)
            self._merge(code, rank, np.concatenate(places) if len(places) > 1 else places[0])
        return np.concatenate(self.odd) if self.odd else np.zeros(0, dtype=np.int64)

    def _enter(self, codes: np.ndarray, places: np.ndarray, current: int) -> None:
        if len(codes) == 0:
            return
        order = np.argsort(codes, kind="stable")
        codes, places = codes[order], places[order]
        first = np.flatnonzero(np.diff(codes, prepend=codes[0] - 1))
        bounds = np.append(first, len(codes)).tolist()
        for at, code in enumerate(codes[first].tolist()):
            rank = self.vocab.merged(code)
            if rank < 0:
                continue
            own = places[bounds[at] : bounds[at + 1]]
            if rank < current:
                self.odd.append(own)
            known = self.index.get(code)
            if known is None:
                self.index[code] = [own]
                heapq.heappush(self.heap, (rank, code))
            else:
                known.append(own)

    def _merge(self, code: int, rank: int, places: np.ndarray) -> None:
        first, second = code >> 32, code & 0xFFFFFFFF
        after = self.next[places]
        holds = self.alive[places] & (self.ids[places] == first) & (after >= 0)
        places, after = places[holds], after[holds]
        holds = self.ids[after] == second
        places, after = places[holds], after[holds]
        if len(places) == 0:
            return
        if first == second:  # of a run of the same token, every other pair is taken, from the left
            places = np.unique(places)
            after = self.next[places]
            goes_on = np.concatenate([[False], after[:-1] == places[1:]])
            begins = np.flatnonzero(~goes_on)
            nth = np.arange(len(places)) - np.repeat(begins, np.diff(np.append(begins, len(places))))
            places, after = places[nth % 2 == 0], after[nth % 2 == 0]
        self.ids[places] = rank
        self.alive[after] = False
        beyond = self.next[after]
        self.next[places] = beyond
        inner = beyond >= 0
        self.prev[beyond[inner]] = places[inner]
        before = self.prev[places]
        led = before >= 0
        codes = np.concatenate([(self.ids[before[led]] << 32) | rank, (rank << 32) | self.ids[beyond[inner]]])
        where = np.concatenate([before[led], places[inner]])
        self._enter(codes, where, rank)


def encode_matches(vocab: Vocabulary, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds) of distinct matches, given as one buffer with offsets."""
    replay = _Replay(vocab, offsets, data)
    odd = replay.run()
    kept = np.flatnonzero(replay.alive)
    ids, bounds = replay.ids[kept], np.searchsorted(kept, offsets)
    if len(odd):
        parts = np.split(ids, bounds[1:-1])
        for match in np.unique(np.searchsorted(offsets, odd, side="right") - 1).tolist():
            alone = merge_alone(vocab, data[offsets[match] : offsets[match + 1]].tobytes())
            parts[match] = np.array(alone, dtype=np.int64)
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        ids = np.concatenate(parts)
    return ids.astype(np.uint32), bounds


def stretch_starts(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Places where texts can be cut: white space right after a byte that certainly ends another character.

    No match of the pattern holds white space after something else, and what follows in the text matters to a match only up to
    the end of its white space, so matches on both sides stay as they are.
    """
    if len(data) == 0:
        return offsets[:-1]
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    solid = (data >= 0x21) & (data <= 0x7E)
    # Second bytes of U+00C0 to U+07FF; U+0080 to U+00BF hold white space, longer characters may.
    solid[1:] |= (data[1:] >= 0x80) & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    cut = np.flatnonzero(space[1:] & solid[:-1]) + 1
    return np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], cut]))


def distinct_pieces(starts: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(number of each stretch's distinct form, distinct forms)."""
    where = np.append(starts, len(data)).astype(np.int64)
    array = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(where.tobytes()), pa.py_buffer(np.ascontiguousarray(data))]
    )
    coded = pc.dictionary_encode(array)
    return coded.indices.to_numpy(), coded.dictionary


def _encode_stretches(vocab: Vocabulary, pattern: str, stretches: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds) of distinct stretches."""
    find = regex.compile(pattern).findall
    matches = [find(s) for s in stretches.cast(pa.large_string()).to_pylist()]
    count = np.fromiter(map(len, matches), dtype=np.int64, count=len(matches))
    number: dict[str, int] = {}
    nth = np.fromiter(
        (number.setdefault(m, len(number)) for own in matches for m in own), dtype=np.int64, count=int(count.sum())
    )
    offsets, data = buffer_of(pa.array(list(number), type=pa.large_string()))
    ids, bounds = encode_matches(vocab, offsets, data)
    lengths = np.diff(bounds)[nth]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return ids[expand(bounds[:-1][nth], lengths)], ends[np.concatenate([[0], np.cumsum(count)])]


def _encode(path: str, pattern: str):
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for rows, offsets, data in text_slices(batches, _SLICE):
            starts = stretch_starts(offsets, data)
            nth, forms = distinct_pieces(starts, data)
            ids, bounds = _encode_stretches(vocab, pattern, forms)
            lengths = np.diff(bounds)
            of_text = np.searchsorted(starts, offsets)
            low = 0
            while low < rows.num_rows:
                high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + _ASSEMBLE, side="right")) - 1)
                chosen = nth[of_text[low] : of_text[high]]
                flat = ids[expand(bounds[:-1][chosen], lengths[chosen])]
                ends = np.concatenate([[0], np.cumsum(lengths[chosen])])[of_text[low : high + 1] - of_text[low]]
                where = (4 * ends).astype(np.int32)
                held = pa.Array.from_buffers(
                    pa.binary(), high - low, [None, pa.py_buffer(where.tobytes()), pa.py_buffer(flat.astype("<u4").tobytes())]
                )
                yield pa.RecordBatch.from_arrays([rows.column("doc_id").slice(low, high - low), held], schema=schema)
                low = high

    return encode


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit) of every row's whole text.

    ``path`` is a rank file that every executor can read, ``pattern`` splits the text before merging. Special tokens are
    ordinary text. A null text is empty and has no ids; repeated rows each give their own; a null id stays
    null. An empty table gives an empty result; texts may be of any length.
    """
    return documents(docs).mapInArrow(_encode(path, pattern), "doc_id long, ids binary")


def _decode(path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            low, sizes = 0, buffer_of(batch.column("ids"))[0]
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(sizes, sizes[low] + 2 * _ASSEMBLE, side="right")) - 1)
                rows = batch.slice(low, high - low)
                offsets, raw = buffer_of(rows.column("ids"))
                ids = np.frombuffer(raw.tobytes(), dtype="<u4")
                lengths = vocab.ends[ids] - vocab.starts[ids]
                held = vocab.bytes[expand(vocab.starts[ids], lengths)]
                where = np.concatenate([[0], np.cumsum(lengths)])[offsets // 4].astype(np.int32)
                text = pa.Array.from_buffers(
                    pa.binary(), len(rows), [None, pa.py_buffer(where.tobytes()), pa.py_buffer(held.tobytes())]
                )
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("ids"), text], schema=schema)
                low = high

    return decode


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` and ``decoded``, the bytes the ids stand for."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(path), "doc_id long, ids binary, decoded binary")
