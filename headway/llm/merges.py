"""BPE merges of many words at once: flat arrays of symbols, and rounds that merge in all words together.

A round finds the best pair of every word by a segmented minimum over pair ranks, merges its leftmost places without overlap in all
words simultaneously, and closes the gaps; words without a pair leave.

A round merges several places of a word only where a library, which goes from left to right, would do the same: pairs that
arise on the way must rank behind. Otherwise, and where several tokens share a rank, it merges the leftmost place alone.
"""

from __future__ import annotations

import json

import numpy as np

from headway.llm.texts import expand

#: Rank of a pair that makes no token.
NONE = np.iinfo(np.int32).max


class Merges:
    """Which token two symbols make, looked up by hashing, how tokens rank, and the bytes they stand for.

    ``rank`` is by token, the last entry for "no token", -1; ``shared`` tells ranks that several tokens have.
    """

    def __init__(self, pairs: list[tuple[int, int, int]], rank: np.ndarray, surfaces: list[bytes]):
        lengths = np.array(list(map(len, surfaces)), dtype=np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.bytes = np.frombuffer(b"".join(surfaces), dtype=np.uint8)
        self.rank = np.append(rank, NONE).astype(np.int32)
        self.shared = np.append(np.bincount(rank[rank < NONE]) > 1, False)
        self._fill(np.array([a << 32 | b for a, b, _ in pairs], dtype=np.int64), np.array([i for *_, i in pairs], dtype=np.int32))

    def _fill(self, codes: np.ndarray, ids: np.ndarray) -> None:
        """Open addressing: all codes try their slot, those that find it taken go on to the next."""
        self._bits = max(8, int(4 * len(codes)).bit_length())
        self._codes, self._ids = np.full(1 << self._bits, -1, dtype=np.int64), np.full(1 << self._bits, -1, dtype=np.int32)
        slot = self._slot(codes)
        while len(codes):
            free = self._codes[slot] < 0
            self._codes[slot[free]] = codes[free]
            placed = self._codes[slot] == codes
            self._ids[slot[placed]] = ids[placed]
            codes, ids, slot = codes[~placed], ids[~placed], (slot[~placed] + 1) & ((1 << self._bits) - 1)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).view(np.int64)

    def made(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The tokens that pairs of symbols make, -1 for none."""
        codes = (first << 32) | second
        slot = self._slot(codes)
        found = self._codes[slot]
        out = np.where(found == codes, self._ids[slot], np.int32(-1))
        open_ = np.flatnonzero((found != codes) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self._bits) - 1)
            found = self._codes[slot[open_]]
            same = found == codes[open_]
            out[open_[same]] = self._ids[slot[open_[same]]]
            open_ = open_[~same & (found >= 0)]
        return out


def _begins(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def _alternate(places: np.ndarray) -> np.ndarray:
    """True for the 1st, 3rd, ... of every run of neighbouring places."""
    first = np.flatnonzero(np.diff(places, prepend=-2) != 1)
    nth = np.arange(len(places)) - np.repeat(first, np.diff(np.append(first, len(places))))
    return nth % 2 == 0


def merge_rounds(merges: Merges, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, lengths) of words after every merge; ``lengths`` are at least 1."""
    done_words, done_symbols, done_lengths = [], [], []
    word = np.arange(len(lengths))
    begins = _begins(lengths)

    def ranked(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        made = merges.made(left, right)
        return made, merges.rank[made]

    made, rank = np.full(len(symbols), -1, dtype=np.int32), np.full(len(symbols), NONE, dtype=np.int32)
    inner = np.ones(len(symbols), dtype=bool)
    inner[begins + lengths - 1] = False
    at = np.flatnonzero(inner)
    made[at], rank[at] = ranked(symbols[at], symbols[at + 1])
    while len(word):
        best = np.minimum.reduceat(rank, begins)
        ends = best == NONE
        if ends.any():  # finished words leave, the others close up
            leaves = np.repeat(ends, lengths)
            done_words.append(word[ends])
            done_symbols.append(symbols[leaves])
            done_lengths.append(lengths[ends])
            symbols, made, rank = symbols[~leaves], made[~leaves], rank[~leaves]
            word, lengths, best = word[~ends], lengths[~ends], best[~ends]
            begins = _begins(lengths)
            if len(word) == 0:
                break
        places = np.flatnonzero(rank == np.repeat(best, lengths))
        places = places[_alternate(places)]
        owner = np.searchsorted(begins, places, side="right") - 1
        leads = np.diff(owner, prepend=-1) != 0
        # Words that merge at one place only in this round.
        single = merges.shared[best]
        several = np.flatnonzero(~leads | ~np.append(leads[1:], True))
        if len(several):
            p, own = places[several], owner[several]
            new, level = made[p].astype(np.int64), best[own]
            last = begins[own] + lengths[own] - 1
            after = p + 1 < last
            sooner = np.zeros(len(p), dtype=bool)
            sooner[after] = ranked(new[after], symbols[p[after] + 2])[1] < level[after]
            before = p > begins[own]
            left = symbols[p - 1]
            touches = np.append(False, (p[1:] == p[:-1] + 2) & (own[1:] == own[:-1]))
            left[touches] = new[np.flatnonzero(touches) - 1]
            sooner[before] |= ranked(left[before], new[before])[1] < level[before]
            single[own[sooner]] = True
        keep = leads | ~single[owner]
        places, owner = places[keep], owner[keep]
        symbols[places] = made[places]
        stays = np.ones(len(symbols), dtype=bool)
        stays[places + 1] = False
        at = places - np.arange(len(places))  # where they are once the gaps are closed
        symbols, made, rank = symbols[stays], made[stays], rank[stays]
        lengths = lengths - np.bincount(owner, minlength=len(lengths))
        begins = _begins(lengths)
        made[at], rank[at] = -1, NONE
        goes_on = at[at + 1 < begins[owner] + lengths[owner]]
        led = at[at > begins[owner]] - 1
        changed = np.concatenate([goes_on, led])
        made[changed], rank[changed] = ranked(symbols[changed], symbols[changed + 1])
    if not done_words:
        return symbols, lengths
    word, lengths, flat = np.concatenate(done_words), np.concatenate(done_lengths), np.concatenate(done_symbols)
    order = np.argsort(word)
    return flat[expand(_begins(lengths)[order], lengths[order])], lengths[order]


def printable_bytes() -> dict[str, int]:
    """Which byte a character of a byte-level vocabulary stands for: printable Latin-1 bytes themselves, the others U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteMerges(Merges):
    """The byte-level vocabulary of a ``tokenizers`` file: tokens are spelled with a printable character for each byte.

    ``of_byte`` are the ids of bytes, ``last_of_byte`` of bytes that end a word, the same in vocabularies without word ends.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        ids, of_sign, word_end = model["vocab"], printable_bytes(), model.get("end_of_word_suffix") or ""
        surfaces = [b""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            surfaces[i] = bytes(of_sign.get(c, 0) for c in token.removesuffix(word_end))
        self.of_byte, self.last_of_byte = np.empty(256, dtype=np.int64), np.empty(256, dtype=np.int64)
        for sign, byte in of_sign.items():
            self.of_byte[byte], self.last_of_byte[byte] = ids[sign], ids[sign + word_end]
        rank, pairs = np.full(len(surfaces), NONE, dtype=np.int64), []
        for nth, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            made = ids[left + right]
            if rank[made] != NONE:
                raise ValueError(f"{path}: two merges make the same token")
            rank[made] = nth
            pairs.append((ids[left], ids[right], made))
        super().__init__(pairs, rank, surfaces)

    def encode(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of each) of words, none of them empty, that are merged apart."""
        symbols = self.of_byte[data]
        symbols[offsets[1:] - 1] = self.last_of_byte[data[offsets[1:] - 1]]
        return merge_rounds(self, symbols, np.diff(offsets))
