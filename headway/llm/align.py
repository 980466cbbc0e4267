"""Alignment of two tokenizations of the same texts, with counts of linked ids over all documents.

Inside a slice of texts every distinct word is encoded once by either tokenizer, and tokens are given by their ids and the
bytes where they end. :func:`links_of` then merges both token rows of all documents in lockstep: one state vector holds
the A and the B pointer of each, every step emits one link per document and advances A, B or both, whichever
token ends first; tokens that end together are a cut. Finished documents leave the vector. So that one long document
doesn't keep the vector going alone, it enters as runs of at most ``RUN`` A tokens, each starting at the B token that covers its first byte.

How often two ids are linked is known only after all documents. A slice stores its documents' links as numbers into the slice's
list of distinct id pairs; these lists, not links, are added up over all slices and joined back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from headway.llm.byte_bpe import distinct_pieces, stretch_starts
from headway.llm.merges import ByteMerges, Merges
from headway.llm.piece_bpe import encode_words, pieces_of, spaced_buffer, word_starts
from headway.llm.texts import buffer_of, documents, expand, settle, text_slices

#: A tokens that one entry of the state vector covers at most.
RUN = 256
#: Bytes of text that are aligned together, and tokens whose groups are spelled together.
_SLICE = 1_000_000
_SPELLED = 200_000
#: Links in one row of the stored table; long rows would cost the JVM much memory.
_LINKS = 100_000


def encode_stretches(merges: ByteMerges, pattern: str, stretches: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds) of distinct stretches of text, every match of the pattern merged by itself."""
    find = regex.compile(pattern).findall
    matches = [find(s) for s in stretches.cast(pa.large_string()).to_pylist()]
    coded = pa.array([m for own in matches for m in own], type=pa.large_string()).dictionary_encode()
    nth = coded.indices.to_numpy()
    offsets, data = buffer_of(coded.dictionary)
    ids, lengths = merges.encode(offsets, data)
    first, count = np.cumsum(lengths) - lengths, lengths[nth]
    ends = np.append(0, np.cumsum(count))
    of_stretch = np.append(0, np.cumsum(np.fromiter(map(len, matches), dtype=np.int64, count=len(matches))))
    return ids[expand(first[nth], count)], ends[of_stretch]


class Tokens:
    """Token rows of several texts, one after the other: ids, bytes where each ends, and every text's first token."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, bounds: np.ndarray):
        self.ids, self.bounds = ids, bounds
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths


def links_of(a: Tokens, b: Tokens, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token) of every link in order, and for all tokens of A and of B whether a cut follows.

    Both rows must cover the same bytes; texts without bytes have no tokens.
    """
    cut_a, cut_b = np.zeros(len(a.ids), dtype=bool), np.zeros(len(b.ids), dtype=bool)
    count = np.diff(a.bounds)
    runs = -(-count // run)
    first = np.repeat(a.bounds[:-1], runs) + run * (np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs))
    stop = np.minimum(first + run, np.repeat(a.bounds[1:], runs))
    at_a, at_b = first.copy(), np.searchsorted(b.ends, a.starts[first], side="right")
    who, done_a, done_b, done_who = np.arange(len(first)), [], [], []
    while len(who):
        done_a.append(at_a.astype(np.int32))
        done_b.append(at_b.astype(np.int32))
        done_who.append(who)
        end_a, end_b = a.ends[at_a], b.ends[at_b]
        together = end_a == end_b
        cut_a[at_a[together]] = True
        cut_b[at_b[together]] = True
        at_a, at_b = at_a + (end_a <= end_b), at_b + (end_b <= end_a)
        goes_on = at_a < stop
        if not goes_on.all():
            who, at_a, at_b, stop = who[goes_on], at_a[goes_on], at_b[goes_on], stop[goes_on]
    if not done_who:
        none = np.zeros(0, dtype=np.int32)
        return none, none, cut_a, cut_b
    steps = np.concatenate(done_who)
    total = np.bincount(steps, minlength=len(first))
    begins = np.cumsum(total) - total
    # A run emits one link a step until it leaves: its n-th link was made in step n.
    place = begins[steps] + np.repeat(np.arange(len(done_who)), [len(w) for w in done_who])
    links_a, links_b = np.empty(len(steps), dtype=np.int32), np.empty(len(steps), dtype=np.int32)
    links_a[place], links_b[place] = np.concatenate(done_a), np.concatenate(done_b)
    return links_a, links_b, cut_a, cut_b


class _Spelling:
    """Decimal ids followed by each separator, as bytes."""

    def __init__(self, size: int):
        digits = [str(i).encode() for i in range(size)]
        self.lengths = np.array([len(d) + 1 for d in digits], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b",".join(digits) + b",", dtype=np.uint8)


_SPELLINGS: list[_Spelling] = []


def _spelling(size: int) -> _Spelling:
    if not _SPELLINGS or len(_SPELLINGS[0].lengths) < size:
        _SPELLINGS[:] = [_Spelling(size)]
    return _SPELLINGS[0]


def group_texts(a: Tokens, b: Tokens, cut_a: np.ndarray, cut_b: np.ndarray) -> Iterator[bytes]:
    """``a1,a2|b1;a3|b2,b3`` for every text."""
    both = a.bounds + b.bounds
    low = 0
    while low < len(both) - 1:
        high = max(low + 1, int(np.searchsorted(both, both[low] + _SPELLED, side="right")) - 1)
        own_a, own_b = slice(a.bounds[low], a.bounds[high]), slice(b.bounds[low], b.bounds[high])
        yield from _group_texts(a.ids[own_a], b.ids[own_b], cut_a[own_a], cut_b[own_b], both[low : high + 1] - both[low])
        low = high


def _group_texts(ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, both: np.ndarray) -> Iterator[bytes]:
    # In a group A tokens come first: before an A token stand all B tokens of earlier groups, before a B token all A tokens up to its group.
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    b_until, a_until = np.append(0, np.flatnonzero(cut_b) + 1), np.append(np.flatnonzero(cut_a) + 1, 0)
    place = np.concatenate([np.arange(len(ids_a)) + b_until[group_a], np.arange(len(ids_b)) + a_until[group_b]])
    ids, ends_group = np.empty(len(place), dtype=np.int64), np.empty(len(place), dtype=np.uint8)
    ids[place] = np.concatenate([ids_a, ids_b])
    ends_group[place] = np.concatenate([cut_a * ord("|"), cut_b * ord(";")])
    spelling = _spelling(int(ids.max(initial=0)) + 1)
    lengths = spelling.lengths[ids]
    held = spelling.bytes[expand(spelling.starts[ids], lengths)]
    after = np.cumsum(lengths)
    closes = np.flatnonzero(ends_group)
    held[after[closes] - 1] = ends_group[closes]
    bounds, whole = np.append(0, after)[both].tolist(), held.tobytes()
    for start, end in zip(bounds[:-1], bounds[1:], strict=True):
        yield whole[start : end - 1] if end > start else b""


def _equal_forms(ids: np.ndarray, bounds: np.ndarray, vocab: Merges, forms: pa.Array) -> np.ndarray:
    """Which forms the bytes of their tokens equal."""
    offsets, data = buffer_of(forms)
    lengths = vocab.ends[ids] - vocab.starts[ids]
    made = np.append(0, np.cumsum(lengths))[bounds]
    equal = np.diff(made) == np.diff(offsets)
    held = vocab.bytes[expand(vocab.starts[ids], lengths)]
    kept = np.flatnonzero(equal)
    size = np.diff(offsets)[kept]
    differs = held[expand(made[:-1][kept], size)] != data[expand(offsets[:-1][kept], size)]
    wrong = np.append(0, np.cumsum(differs))[np.append(0, np.cumsum(size))]
    equal[kept] = np.diff(wrong) == 0
    return equal


class Encoder:
    """One tokenizer in a task: words it has met lately are not encoded again.

    It remembers up to ``REMEMBERED`` bytes of distinct words with their ids, and forgets all of them beyond that.
    """

    REMEMBERED = 4_000_000

    def __init__(self, vocab: Merges, starts_of, encode):
        self.vocab, self.starts_of, self.encode = vocab, starts_of, encode
        self.token_lengths = vocab.ends - vocab.starts
        self._forget()

    def _forget(self) -> None:
        self.forms = pa.array([], type=pa.large_binary())
        self.ids, self.first = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        self.count, self.equal = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)

    def _numbers(self, forms: pa.Array) -> np.ndarray:
        """The place of every form among those known, new ones encoded first."""
        if self.forms.nbytes + forms.nbytes > self.REMEMBERED:
            self._forget()
        known = pc.index_in(forms, value_set=self.forms)
        new = np.flatnonzero(known.is_null().to_numpy(zero_copy_only=False))
        place = known.fill_null(0).to_numpy().astype(np.int64)
        if len(new):
            added = forms.take(pa.array(new))
            ids, bounds = self.encode(self.vocab, added)
            place[new] = len(self.forms) + np.arange(len(new))
            self.first = np.append(self.first, len(self.ids) + bounds[:-1])
            self.count = np.append(self.count, np.diff(bounds))
            self.equal = np.append(self.equal, _equal_forms(ids, bounds, self.vocab, added))
            self.ids = np.append(self.ids, ids.astype(np.int32))
            self.forms = pa.concat_arrays([self.forms, added])
        return place

    def __call__(self, offsets: np.ndarray, data: np.ndarray, alive: np.ndarray):
        """Token rows of the texts among ``alive``, as a function; texts whose tokens spell something else leave ``alive`` before."""
        starts = self.starts_of(offsets, data)
        nth, forms = distinct_pieces(starts, data)
        form = self._numbers(forms.cast(pa.large_binary()))[nth]
        of_text = np.searchsorted(starts, offsets)
        wrong = np.append(0, np.cumsum(~self.equal[form]))
        alive &= np.diff(wrong[of_text]) == 0
        ids, first, count = self.ids, self.first[form], self.count[form]

        def gathered() -> Tokens:
            kept = np.repeat(alive, np.diff(of_text))
            flat = ids[expand(first[kept], count[kept])]
            ends = np.append(0, np.cumsum(count[kept]))
            stretches = np.append(0, np.cumsum(np.where(alive, np.diff(of_text), 0)))
            return Tokens(flat, self.token_lengths[flat], ends[stretches])

        return gathered


@lru_cache(maxsize=1)
def encoders(byte_path: str, pattern: str, piece_path: str) -> tuple[Encoder, Encoder]:
    return (
        Encoder(ByteMerges(byte_path), stretch_starts, lambda vocab, forms: encode_stretches(vocab, pattern, forms)),
        Encoder(pieces_of(piece_path), word_starts, encode_words),
    )


def both_tokens(byte_path: str, pattern: str, piece_path: str, offsets: np.ndarray, data: np.ndarray) -> tuple[Tokens, Tokens]:
    """Token rows of texts; none where the bytes of either row are not a space and the text."""
    offsets, data = spaced_buffer(offsets, data)
    alive = np.diff(offsets) > 0
    first, second = (encoder(offsets, data, alive) for encoder in encoders(byte_path, pattern, piece_path))
    return first(), second()


_SCHEMA = pa.schema(
    [
        ("slice", pa.int64()),
        ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                                     ("n_links", pa.int64()), ("groups_sha256", pa.string())]))),
        ("links", pa.binary()),
        ("pairs", pa.list_(pa.int64())),
        ("times", pa.list_(pa.int64())),
    ]
)
_STORED = (
    "slice long, docs array<struct<doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, groups_sha256: string>>, "
    "links binary, pairs array<long>, times array<long>"
)


def _number_type(pairs: int) -> str:
    """Numbers into a list of pairs, little-endian, as short as the list allows."""
    return "<u2" if pairs <= 1 << 16 else "<u4"


def _listed(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], type=pa.int32()), values)


def _align(byte_path: str, pattern: str, piece_path: str):
    none = pa.array([], type=pa.int64())

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for n, (rows, offsets, data) in enumerate(text_slices(batches, _SLICE)):
            a, b = both_tokens(byte_path, pattern, piece_path, offsets, data)
            links_a, links_b, cut_a, cut_b = links_of(a, b)
            links = np.diff(np.searchsorted(links_a, a.bounds))
            groups = np.diff(np.append(0, np.cumsum(cut_a))[a.bounds])
            digests = [hashlib.sha256(t).hexdigest() if t else "" for t in group_texts(a, b, cut_a, cut_b)]
            codes = (a.ids[links_a].astype(np.int64) << 32) | b.ids[links_b]
            pairs, number, times = np.unique(codes, return_inverse=True, return_counts=True)
            number = number.astype(_number_type(len(pairs)))
            docs = pa.StructArray.from_arrays(
                [rows.column("doc_id"), pa.array(np.diff(a.bounds)), pa.array(np.diff(b.bounds)), pa.array(groups), pa.array(links),
                 pa.array(digests, type=pa.string())],
                fields=list(_SCHEMA.field("docs").type.value_type),
            )
            del a, b, links_a, links_b, cut_a, cut_b, codes
            ends, first, dictionary = np.append(0, np.cumsum(links)), 0, (pa.array(pairs), pa.array(times))
            while first < len(docs):
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + _LINKS, side="right")) - 1)
                held = number[ends[first] : ends[last]].tobytes()
                whole = [pa.array([task | n]), _listed(docs[first:last]), pa.array([held], type=pa.binary()), *map(_listed, dictionary)]
                yield pa.RecordBatch.from_arrays(whole, schema=_SCHEMA)
                first, dictionary = last, (none, none)

    return align


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document: how many links are the best of their B id, and the sum of the links' counts."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            counted = row.column("counted").flatten()
            at = counted.field("at").to_numpy()
            number = np.frombuffer(row.column("links")[0].as_buffer(), dtype=_number_type(len(at)))
            count, best = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
            count[at] = counted.field("n").to_numpy()
            best[at] = counted.field("best").to_numpy(zero_copy_only=False)
            docs = row.column("docs").flatten()
            fields = dict(zip([f.name for f in docs.type], docs.flatten(), strict=True))
            ends = np.append(0, np.cumsum(fields["n_links"].to_numpy()))
            for name, values in (("n_best", best), ("count_sum", count)):
                fields[name] = pa.array(np.diff(np.append(0, np.cumsum(values[number]))[ends]))
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([fields[name] for name in names], names=names)


def aligned_slices(docs: DataFrame, byte_path: str, pattern: str, piece_path: str) -> DataFrame:
    """Slices of neighbouring rows, stored: documents, their links as numbers into ``pairs``, and how often each pair occurs in the slice.

    A pair is the A id times 2**32 plus the B id. A slice's documents lie in rows of about ``_LINKS`` links, its pairs in the first of them.
    """
    mapped = documents(docs).mapInArrow(_align(byte_path, pattern, piece_path), _STORED)
    return settle(mapped, "aligned")


def pair_counts(slices: DataFrame) -> DataFrame:
    """``pair, n, best``: the links that hold a pair of ids, and whether no other pair of its B id has more."""
    listed = slices.select(F.inline(F.arrays_zip("pairs", "times")))
    counted = listed.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n"))
    # A B id is linked with at most all ids of A, whatever the corpus.
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    return counted.withColumn("best", F.col("n") == F.max("n").over(of_b))


def align_tokenizers(docs: DataFrame, byte_path: str, pattern: str, piece_path: str) -> DataFrame:
    """How two tokenizers cut every text: one row per input row.

    A is the byte-level BPE of a ``tokenizers`` file (``pattern`` splits a text first), given a space and the text; B the
    BPE of a ``sentencepiece`` model, which puts the space itself. Special tokens are plain text for both. ``n_a, n_b`` count tokens, ``n_links``
    pairs of tokens that share bytes, ``n_groups`` the stretches between bytes where tokens of both end; ``groups_sha256`` digests these
    groups. ``count_sum`` adds up, over the links, the links of all documents that hold the same two ids; ``n_best`` counts the links
    whose ids are linked most often, ties included, among all links of their B id.

    A null or empty text has no tokens, nor has one that a tokenizer changes (such as U+2581 into a space): zeros and an empty digest. Repeated rows
    count each and give a row each; a null id stays null. An empty table gives an empty result; texts may be of any length.
    """
    slices = aligned_slices(docs, byte_path, pattern, piece_path)
    counts = settle(pair_counts(slices), "pair-counts")
    used = slices.select("slice", F.posexplode("pairs").alias("at", "pair"))
    counted = used.join(counts, "pair").groupBy("slice").agg(F.collect_list(F.struct("at", "n", "best")).alias("counted"))
    none = F.array().cast("array<struct<at: int, n: long, best: boolean>>")
    whole = slices.join(counted.hint("merge"), "slice", "left").select("docs", "links", F.coalesce("counted", none).alias("counted"))
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return whole.mapInArrow(_summed, schema)
