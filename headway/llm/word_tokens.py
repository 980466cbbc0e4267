"""Token ids of whole texts with a tokenizer of the ``tokenizers`` library that splits at white space.

Words repeat, so a slice of texts is cut into words, each distinct word is encoded once, and the ids are gathered back: words of
plain letters by the vocabulary's merges, all at once, any others by the library. Upper-case ASCII is lowered and trailing ``.`` and ``,`` are cut off first, which such a tokenizer (lower
case, pieces of letters, digits or other symbols, no ids for white space) does anyway and which leaves fewer distinct words. A
task remembers the words it met, up to ``REMEMBERED`` bytes of them, and their ids.

The library gives an added token's string inside a text that token's id. Texts that may hold such a string are encoded by it as a whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from headway.llm.merges import ByteMerges
from headway.llm.texts import buffer_of, documents, expand, in_words, lower_ascii, release_memory, text_slices, words_of

#: Bytes of distinct words whose ids a task keeps; beyond, all are forgotten.
REMEMBERED = 6_000_000
#: Bytes of text whose words are told apart together.
_SLICE = 3_000_000
#: Bytes of text whose ids are put together at a time.
_ASSEMBLE = 2_000_000


def word_cuts(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as :func:`words_of` gives them, with ``.`` and ``,`` after a letter or digit starting a word of their own."""
    starts, ends, _ = words_of(offsets, data)
    stop = (data == 0x2E) | (data == 0x2C)
    plain = ((data >= 0x61) & (data <= 0x7A)) | ((data >= 0x30) & (data <= 0x39))
    # Second bytes of U+00C0 to U+00FF, all letters but two.
    accented = np.zeros(len(data), dtype=bool)
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    cut = np.flatnonzero(stop[1:] & (plain | accented)[:-1]) + 1
    cut = cut[~np.isin(cut, offsets)]
    starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    return starts, ends, np.searchsorted(starts, offsets)


def _letters(data: np.ndarray) -> np.ndarray:
    """True for the bytes of a to z and of U+00DF to U+00FF without U+00F7: letters that neither normalising nor lowering changes."""
    plain = (data >= 0x61) & (data <= 0x7A)
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] >= 0x9F) & (data[lead + 1] != 0xB7)]
    plain[lead] = True
    plain[lead + 1] = True
    return plain


class _Memory:
    """A tokenizer, the words it has encoded, and their ids one after the other."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.merges = Tokenizer.from_file(path), ByteMerges(path)
        self.added = sorted({token.content.lower() for token in self.tokenizer.get_added_tokens_decoder().values()})
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], type=pa.large_binary())
        self.first = self.n = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def flat(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of each) of texts, encoded as they are."""
        flat, n = [], []
        for i in range(0, len(strings), 5_000):
            made = [e.ids for e in self.tokenizer.encode_batch_fast(strings[i : i + 5_000], add_special_tokens=False)]
            n += map(len, made)
            flat.append(np.fromiter(chain.from_iterable(made), dtype=np.uint32, count=sum(n[i:])))
        return np.concatenate(flat) if flat else np.zeros(0, dtype=np.uint32), np.array(n, dtype=np.int64)

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`flat` for words; those of plain letters alone, one match of the tokenizer's pattern each, are merged together."""
        offsets, data = buffer_of(words)
        plain = np.diff(np.append(0, np.cumsum(_letters(data)))[offsets]) == np.diff(offsets)
        alone, others = np.flatnonzero(plain), np.flatnonzero(~plain)
        ids_alone, n_alone = self.merges.encode(*buffer_of(words.take(pa.array(alone))))
        ids_others, n_others = self.flat(words.take(pa.array(others)).cast(pa.large_string()).to_pylist())
        n = np.empty(len(words), dtype=np.int64)
        n[alone], n[others] = n_alone, n_others
        first, ids = np.cumsum(n) - n, np.empty(int(n.sum()), dtype=np.uint32)
        ids[expand(first[alone], n_alone)] = ids_alone
        ids[expand(first[others], n_others)] = ids_others
        return ids, n

    def ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, first, number) for distinct words."""
        if self.words.nbytes + words.nbytes > REMEMBERED:
            self._forget()
        known = pc.index_in(words, value_set=self.words)
        new = np.flatnonzero(known.is_null().to_numpy(zero_copy_only=False))
        place = known.fill_null(0).to_numpy().astype(np.int64)
        if len(new):
            added = words.take(pa.array(new))
            flat, n = self._encoded(added)
            place[new] = len(self.words) + np.arange(len(new))
            self.first = np.append(self.first, len(self.ids) + np.cumsum(n) - n)
            self.n, self.ids = np.append(self.n, n), np.append(self.ids, flat)
            self.words = pa.concat_arrays([self.words, added])
        return self.ids, self.first[place], self.n[place]

    def holding_added(self, texts: pa.Array) -> list[int]:
        """Texts that may hold the string of an added token, in letters of any case."""
        found = np.zeros(len(texts), dtype=bool)
        for token in self.added:
            found |= pc.match_substring(texts, token, ignore_case=True).to_numpy(zero_copy_only=False)
        return np.flatnonzero(found).tolist()


def _encode(path: str, longest: int, end: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Memory(path)
        for rows, offsets, data in text_slices(batches, _SLICE):
            data = lower_ascii(data)
            starts, ends, bounds = word_cuts(offsets, data)
            # Words side by side: all bytes that are not separators.
            held = data[in_words(data)]
            where = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(where), pa.py_buffer(held)])
            coded = pc.dictionary_encode(words)
            nth, forms = coded.indices.to_numpy(), coded.dictionary
            del starts, ends, held, where, words, data
            ids, first, n = memory.ids_of(forms.cast(pa.large_binary()))
            whole = {i: memory.flat([rows.column("text")[i].as_py()])[0] for i in memory.holding_added(rows.column("text"))}
            doc_ids = rows.column("doc_id").to_pylist()
            low = 0
            while low < len(doc_ids):
                high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + _ASSEMBLE, side="right")) - 1)
                chosen = nth[bounds[low] : bounds[high]]
                count = n[chosen]
                flat = ids[expand(first[chosen], count)]
                ends_at = np.concatenate([[0], np.cumsum(count)])[bounds[low : high + 1] - bounds[low]]
                out: dict[str, list] = {name: [] for name in schema.names}
                for i in range(low, high):
                    own = whole[i] if i in whole else flat[ends_at[i - low] : ends_at[i - low + 1]]
                    own = np.append(own, np.uint32(end)).astype("<u4")
                    for k, start in enumerate(range(0, len(own), longest)):
                        part = own[start : start + longest]
                        for name, value in zip(schema.names, (doc_ids[i], k, start, len(part), part.tobytes()), strict=True):
                            out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, schema=schema)
                low = high
        del memory
        release_memory()

    return encode


def tokenized(docs: DataFrame, path: str, longest: int, end: int = 0) -> DataFrame:
    """Pieces of at most ``longest`` ids: ``doc_id, piece, start, length, ids`` (little-endian unsigned 32-bit).

    A document is its text's ids, then ``end``; a null text has no ids. Only documents longer than ``longest`` have
    more than one piece, all full but the last; texts may be of any length. Every input row gives its own pieces, repeated rows too; a null id
    stays null. An empty table gives an empty result.
    """
    schema = "doc_id long, piece int, start long, length long, ids binary"
    return documents(docs).mapInArrow(_encode(path, longest, end), schema)
