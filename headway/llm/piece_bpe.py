"""SentencePiece BPE encoding by merge rounds over all distinct words of a slice at once, and decoding.

A word is a run of spaces (U+2581 included) with what follows up to the next space; no piece of the vocabulary reaches from
another character into a space, so words are encoded apart, each distinct one of a slice once, all together in merge rounds
(see ``merges``). What is left of a character that is no piece becomes the pieces of its bytes.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from headway.llm.byte_bpe import distinct_pieces
from headway.llm.merges import NONE, Merges, merge_rounds
from headway.llm.texts import buffer_of, documents, expand, text_slices

# The sign for a space in pieces, and the kinds of pieces in a model file.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
BPE_MODEL = 2
#: Bytes of text whose words are told apart together, and whose ids are put together at a time.
_SLICE = 4_000_000
_ASSEMBLE = 2_000_000


class Pieces(Merges):
    """The vocabulary of a model file.

    A symbol is a piece's id, or ``size`` plus the code point of a character that is no piece. Ranks order scores from the best;
    pieces of equal score share one.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, kinds = model.normalizer_spec, [p.type for p in model.pieces]
        plain = spec.add_dummy_prefix and not spec.remove_extra_whitespaces and not spec.precompiled_charsmap
        known = {NORMAL, UNKNOWN, CONTROL, BYTE}
        if model.trainer_spec.model_type != BPE_MODEL or not plain or not set(kinds) <= known or kinds.count(BYTE) != 256:
            raise ValueError(f"{path}: needs a BPE model with byte pieces, a leading space and texts taken as they are")
        self.size = len(kinds)
        id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        if any(before != SPACE and after == SPACE for piece in id_of for before, after in zip(piece, piece[1:], strict=False)):
            raise ValueError(f"{path}: has pieces that reach from a character into a space")
        #: Characters that are pieces, ascending, and their ids.
        single = sorted((ord(piece), i) for piece, i in id_of.items() if len(piece) == 1)
        self.chars, self.char_ids = (np.array(column, dtype=np.int64) for column in zip(*single, strict=True))
        self.of_byte = np.array([self._byte_id(model, b) for b in range(256)], dtype=np.int32)
        self.opens_with_space = np.array([p.type == NORMAL and p.piece.startswith(SPACE) for p in model.pieces])
        levels = {score: rank for rank, score in enumerate(sorted({-model.pieces[i].score for i in id_of.values()}))}
        rank = np.full(self.size, NONE, dtype=np.int64)
        for i in id_of.values():
            rank[i] = levels[-model.pieces[i].score]
        pairs = [
            (self._symbol(id_of, piece[:cut]), self._symbol(id_of, piece[cut:]), i)
            for piece, i in id_of.items()
            for cut in range(1, len(piece))
        ]
        surfaces = [self._surface(p, model.trainer_spec.unk_surface) for p in model.pieces]
        super().__init__([p for p in pairs if p[0] >= 0 and p[1] >= 0], rank, surfaces)

    def _symbol(self, id_of: dict[str, int], part: str) -> int:
        return id_of.get(part, self.size + ord(part) if len(part) == 1 else -1)

    @staticmethod
    def _byte_id(model, byte: int) -> int:
        return next(i for i, p in enumerate(model.pieces) if p.type == BYTE and p.piece == f"<0x{byte:02X}>")

    @staticmethod
    def _surface(piece, unknown: str) -> bytes:
        if piece.type == NORMAL:
            return piece.piece.replace(SPACE, " ").encode()
        return {BYTE: lambda: bytes([int(piece.piece[3:5], 16)]), UNKNOWN: unknown.encode}.get(piece.type, bytes)()

    def symbols(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        return np.where(self.chars[at] == points, self.char_ids[at], self.size + points)


@lru_cache(maxsize=1)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def _with_bytes(pieces: Pieces, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids for symbols: characters that are no piece become their UTF-8 bytes."""
    outside = np.flatnonzero(symbols >= pieces.size)
    if len(outside) == 0:
        return symbols.astype(np.int32), lengths
    points = (symbols[outside] - pieces.size).astype("<u4")
    count = np.ones(len(symbols), dtype=np.int64)
    count[outside] = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    first = np.cumsum(count) - count
    ids = np.empty(int(count.sum()), dtype=np.int32)
    inside = symbols < pieces.size
    ids[first[inside]] = symbols[inside]
    held = np.frombuffer(points.tobytes().decode("utf-32-le").encode(), dtype=np.uint8)
    ids[expand(first[outside], count[outside])] = pieces.of_byte[held]
    bounds = np.append(0, np.cumsum(lengths))
    return ids, np.diff(np.append(0, np.cumsum(count))[bounds])


def spaced_buffer(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space put before each that is not empty."""
    full = np.flatnonzero(np.diff(offsets) > 0)
    return offsets + np.searchsorted(full, np.arange(len(offsets))), np.insert(data, offsets[full], 0x20)


def word_starts(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Where the words of texts begin that begin with a space each: at the first of some spaces."""
    space = data == 0x20
    sign = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)) if len(data) > 2 else []
    for k in range(3):
        space[np.asarray(sign, dtype=np.int64) + k] = True
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(begins)


def encode_words(pieces: Pieces, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds) of distinct words, none of them empty."""
    offsets, data = buffer_of(words)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype="<u4").astype(np.int64)
    points[points == 0x20] = ord(SPACE)
    of_char = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    lengths = np.diff(np.searchsorted(of_char, offsets))
    symbols, lengths = merge_rounds(pieces, pieces.symbols(points), lengths)
    ids, lengths = _with_bytes(pieces, symbols, lengths)
    return ids, np.append(0, np.cumsum(lengths))


def _encode(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for rows, offsets, data in text_slices(batches, _SLICE):
            offsets, data = spaced_buffer(offsets, data)
            starts = word_starts(offsets, data)
            nth, forms = distinct_pieces(starts, data)
            ids, bounds = encode_words(pieces, forms)
            lengths, of_text = np.diff(bounds), np.searchsorted(starts, offsets)
            del starts, forms, data
            low = 0
            while low < rows.num_rows:
                high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + _ASSEMBLE, side="right")) - 1)
                chosen = nth[of_text[low] : of_text[high]]
                flat = ids[expand(bounds[:-1][chosen], lengths[chosen])]
                ends = np.append(0, np.cumsum(lengths[chosen]))[of_text[low : high + 1] - of_text[low]]
                held = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id").slice(low, high - low), held], names=["doc_id", "ids"])
                low = high

    return encode


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row's whole text, without begin or end ids.

    ``path`` is a model file that every executor can read: BPE with byte pieces, a space put before each text, no other
    change of the text. Names of control pieces inside a text are plain text. A null or empty text has no ids; repeated rows
    each give their own; a null id stays null. An empty table gives an empty result; texts may be of any length.
    """
    return documents(docs).mapInArrow(_encode(path), "doc_id long, ids array<int>")


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


def decode_ids(pieces: Pieces, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Texts of ids given as one array with offsets.

    Control pieces are silent, one space is taken from the front of a text's first sounding piece, and every byte that
    is part of no character becomes U+FFFD.
    """
    lengths = pieces.ends[ids] - pieces.starts[ids]
    begins = pieces.starts[ids]
    sounding = np.flatnonzero(lengths > 0)
    lead = np.searchsorted(sounding, offsets[:-1])
    lead = sounding[lead[lead < len(sounding)]]
    owner = np.searchsorted(offsets, lead, side="right") - 1
    lead = np.unique(lead[(lead >= offsets[owner]) & (lead < offsets[owner + 1])])
    cut = lead[pieces.opens_with_space[ids[lead]]]
    begins[cut] += 1
    lengths[cut] -= 1
    held = pieces.bytes[expand(begins, lengths)]
    where = np.append(0, np.cumsum(lengths))[offsets]
    binary = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(where.tobytes()), pa.py_buffer(held.tobytes())]
    )
    try:
        return binary.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:  # bytes that are no characters
        codecs.register_error("headway-each-byte", _each_byte)
        return pa.array([b.decode("utf-8", "headway-each-byte") for b in binary.to_pylist()], type=pa.string())


def _decode(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in batches:
            sizes = batch.column("ids").offsets.to_numpy()
            low = 0
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(sizes, sizes[low] + _ASSEMBLE // 4, side="right")) - 1)
                rows = batch.slice(low, high - low)
                held = rows.column("ids")
                where = held.offsets.to_numpy().astype(np.int64)
                ids = held.flatten().to_numpy(zero_copy_only=False)
                text = decode_ids(pieces, ids, where - where[0])
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), held, text], names=["doc_id", "ids", "decoded"])
                low = high

    return decode


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` and ``decoded``, the text the ids stand for; null ids count as none."""
    held = F.coalesce("ids", F.array().cast("array<int>"))
    return encoded.select("doc_id", held.alias("ids")).mapInArrow(_decode(path), "doc_id long, ids array<int>, decoded string")
