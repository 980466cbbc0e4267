"""Windows of a fixed length over token sequences, folded to runs that share a minimizer.

The ``window`` tokens from any start hold ``window - k + 1`` k-mers; the one with the least hash, the first of equal
ones, is the window's minimizer. Equal windows have the same minimizer at the same place, so windows
need to be compared only where the minimizer is the same. Neighbouring windows mostly share it; such a run
of windows (a *super-k-mer*) is a nonbranching path of the graph whose edges are the windows, and
is handled as one row: its minimizer's hash and the hash of all tokens it covers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from headway.llm.texts import SpanHash, expand


@dataclass
class Runs:
    """``start``: first window of a run, as an index into all tokens; ``count``: its windows; ``anchor``: place of the minimizer."""

    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    size, least = 1, values
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    n = len(values) - width + 1
    return np.minimum(least[:n], least[width - size : width - size + n])


def runs_of(tokens: SpanHash, bounds: np.ndarray, window: int, k: int) -> Runs:
    """The runs of every text; ``bounds`` has the index of each text's first token (n + 1 values)."""
    total = int(bounds[-1])
    counts = np.maximum(0, np.diff(bounds) - window + 1)
    starts = expand(bounds[:-1], counts)
    if len(starts) == 0:
        return Runs(starts, starts, starts)
    places = np.arange(total - k + 1)
    keys = (tokens(places, places + k) & np.uint64(0xFFFFFFFF00000000)) | places.astype(np.uint64)
    least = sliding_minimum(keys, window - k + 1)
    anchor = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    fresh = np.empty(len(starts), dtype=bool)
    fresh[0] = True
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(fresh)
    return Runs(starts[first], np.diff(np.append(first, len(starts))), anchor[first])


def owner_of(bounds: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Index of the text that each token belongs to."""
    return np.searchsorted(bounds, places, side="right") - 1
