"""Plain restatements of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode())


def substring_removal(rows: list[tuple[int | None, str | None]], window: int) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256) per row."""
    first: dict[tuple, int] = {}
    for doc_id, text in rows:
        w = words(text)
        if doc_id is None:
            continue
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if doc_id is not None and first[tuple(w[i : i + window])] < doc_id:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc_id, len(w), sum(gone), sha(kept)))
    return out


def byte_removal(rows: list[tuple[int | None, str | None]], window: int) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row."""
    count: dict[bytes, int] = {}
    for _, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - window + 1):
            count[raw[i : i + window]] = count.get(raw[i : i + window], 0) + 1
    out = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - window + 1):
            if count[raw[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(raw), sum(gone), spans, sha(bytes(x for x, g in zip(raw, gone, strict=True) if not g))))
    return out


def shingles(text: str | None, n: int) -> set[tuple]:
    w = [x.lower() for x in words(text)]
    if not w:
        return set()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))}


def jaccard_components(rows: list[tuple[int | None, str | None]], n: int, percent: int) -> list[tuple]:
    """(doc_id, n_shingles, component_id) per row; a null id is larger than any."""
    sets = [shingles(text, n) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least: dict[int, int | None] = {}
    for i, (doc_id, _) in enumerate(rows):
        known = least.get(root(i))
        least[root(i)] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    return [(doc_id, len(sets[i]), least[root(i)]) for i, (doc_id, _) in enumerate(rows)]


def exact_copies(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    """(doc_id, keep_id, group_size, kept, text_sha256) per row."""
    groups: dict[str, list] = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, sha((text or "").encode())))
    return out


def structure(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text."""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    covered = [False] * len(w)
    for i, x in enumerate(windows):
        if windows.count(x) > 1:
            covered[i : i + 5] = [True] * 5
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), sum(covered)


def alignment(a: list[bytes], b: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[list[int], list[int]]]]:
    """Links (A index, B index) of two token rows over the same bytes, and the groups between common ends."""
    ends_a, ends_b = (np.cumsum([len(t) for t in tokens]).tolist() for tokens in (a, b))
    span_a, span_b = (list(zip([0, *ends][:-1], ends, strict=True)) for ends in (ends_a, ends_b))
    links = [(i, k) for i, (s, e) in enumerate(span_a) for k, (f, g) in enumerate(span_b) if max(s, f) < min(e, g)]
    groups, low = [], 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        groups.append(tuple([i for i, (_, e) in enumerate(spans) if low < e <= cut] for spans in (span_a, span_b)))
        low = cut
    return links, groups


def spelling(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    """(word, n, n_near, form, form_n, root) of every word."""
    lower = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
    seen: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    n = {w: k for w, k in seen.items() if len(w) >= 7 and k >= 2}

    def near(a: str, b: str) -> bool:
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    of = {w: [v for v in n if near(w, v)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in of.items() if vs}
    form = {w: v for w, v in best.items() if n[v] >= 10 * n[w]}
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, n[w], len(of[w]), form.get(w), n.get(form.get(w)), root))
    return out
