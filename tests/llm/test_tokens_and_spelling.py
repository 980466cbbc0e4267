"""SentencePiece encoding, tokenizer alignment and spelling variants against the libraries and plain restatements."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from checks.compare import differences, duck
from headway.llm import queries, spelling
from headway.llm.align import Tokens, align_tokenizers, both_tokens, group_texts, links_of, pair_counts, aligned_slices
from headway.llm.merges import printable_bytes
from headway.llm.piece_bpe import decode_ids, decode_pieces, encode_pieces, encode_words, pieces_of, spaced_buffer, word_starts
from headway.llm.byte_bpe import distinct_pieces
from headway.llm.texts import buffer_of, settle
from tests.llm import brute

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "ab", "the", "in", "er", "ll", "l", " ", "  ", "\n", "\t", "     ", "▁", "é", "日本", "😀", "\x00", "1", "=", "'s", "�"]
TEXTS = st.lists(st.sampled_from([*PARTS, "<s>", "</s>", "<unk>", "<0x41>", "<|endoftext|>"]), max_size=40).map("".join)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def byte_library():
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_pieces_equal_the_library(awkward, empty, rows_in, library):
    rows = decode_pieces(encode_pieces(awkward, PIECES), PIECES).collect()
    expected = [(i, tuple(library.encode(t or ""))) for i, t in rows_in]
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in rows) == Counter(
        (i, ids, library.decode(list(ids))) for i, ids in expected
    )
    assert decode_pieces(encode_pieces(empty, PIECES), PIECES).count() == 0


def _encoded(texts: list[str]) -> list[list[int]]:
    offsets, data = spaced_buffer(*buffer_of(pa.array(texts, type=pa.string())))
    starts = word_starts(offsets, data)
    nth, forms = distinct_pieces(starts, data)
    ids, bounds = encode_words(pieces_of(PIECES), forms)
    of_text = np.searchsorted(starts, offsets)
    own = [ids[bounds[k] : bounds[k + 1]].tolist() for k in nth]
    return [sum(own[s:e], []) for s, e in zip(of_text[:-1], of_text[1:], strict=True)]


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=5))
def test_merge_rounds_on_any_text(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert _encoded(texts) == library.encode(texts)


def test_long_runs_of_one_character(library):
    texts = [c * n for c in ("a", "=", " ", "▁", "l", "日") for n in (1, 2, 3, 17, 40, 2_000)]
    assert _encoded(texts) == library.encode(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 270), st.integers(0, 31_999)), max_size=10), min_size=1, max_size=6))
def test_decoding_of_any_ids(rows):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    offsets = np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int64)
    flat = np.array([i for r in rows for i in r], dtype=np.int32)
    assert decode_ids(pieces_of(PIECES), flat, offsets).to_pylist() == [library.decode(r) for r in rows]


def _plain(text: str | None, library, byte_library):
    """(A ids, B ids, links, groups) by the libraries and a double loop."""
    if not text:
        return [], [], [], []
    encoded, sign = byte_library.encode(" " + text, add_special_tokens=False), printable_bytes()
    a = [bytes(sign[c] for c in token) for token in encoded.tokens]
    ids = library.encode(text)
    named = [(i, library.id_to_piece(i)) for i in ids]
    b = [bytes([int(p[3:5], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode() for i, p in named]
    if not b"".join(a) == b"".join(b) == (" " + text).encode():
        return [], [], [], []
    links, groups = brute.alignment(a, b)
    return encoded.ids, ids, links, groups


def _spelled(a: list[int], b: list[int], groups) -> str:
    return ";".join(",".join(str(a[i]) for i in left) + "|" + ",".join(str(b[k]) for k in right) for left, right in groups)


def test_lockstep_merging_on_any_text(library, byte_library):
    rng = random.Random(5)
    texts = ["".join(rng.choices([*PARTS, "<|endoftext|>"], k=rng.randint(0, 50))) for _ in range(400)]
    a, b = both_tokens(BYTES, public_tokenizers.PATTERN, PIECES, *buffer_of(pa.array(texts)))
    for run in (1, 3, 256):
        links_a, links_b, cut_a, cut_b = links_of(a, b, run)
        spelled = list(group_texts(a, b, cut_a, cut_b))
        bounds = np.searchsorted(links_a, a.bounds)
        for i, text in enumerate(texts):
            ids_a, ids_b, links, groups = _plain(text, library, byte_library)
            own = slice(bounds[i], bounds[i + 1])
            found = zip((links_a[own] - a.bounds[i]).tolist(), (links_b[own] - b.bounds[i]).tolist(), strict=True)
            assert list(found) == links
            assert spelled[i].decode() == _spelled(ids_a, ids_b, groups)


def test_links_of_nothing():
    none = Tokens(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(3, dtype=np.int64))
    assert [len(x) for x in links_of(none, none)] == [0, 0, 0, 0]


def test_alignment_of_documents(awkward, empty, rows_in, library, byte_library):
    plain = [(i, *_plain(t, library, byte_library)) for i, t in rows_in]
    counts = Counter((a[x], b[y]) for _, a, b, links, _ in plain for x, y in links)
    most: dict[int, int] = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    expected = []
    for i, a, b, links, groups in plain:
        of = [(counts[a[x], b[y]], most[b[y]]) for x, y in links]
        digest = hashlib.sha256(_spelled(a, b, groups).encode()).hexdigest() if a else ""
        expected.append((i, len(a), len(b), len(groups), len(links), sum(n == m for n, m in of), sum(n for n, _ in of), digest))
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    args = (BYTES, public_tokenizers.PATTERN, PIECES)
    assert Counter(tuple(r) for r in align_tokenizers(awkward, *args).select(*columns).collect()) == Counter(expected)
    assert align_tokenizers(empty, *args).count() == 0
    stored = {r.pair: r.n for r in pair_counts(aligned_slices(awkward, *args)).collect()}
    assert stored == {a << 32 | b: n for (a, b), n in counts.items()}


def _variants(docs):
    return Counter((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.spelling_variants(docs).collect())


def _misspelled(seed: int = 8) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    words = ["straßenbahn", "ELECTRIC", "electrics", "éclairage", "tramway×s", "aaaaaaaa", "aaaaaaaaa", "abababab", "babababa", "Étages"]
    words += ["".join(rng.choices("abcdé", k=rng.randint(6, 9))) for _ in range(30)]

    def damaged(word: str) -> str:
        at, how = rng.randrange(len(word)), rng.randrange(4)
        return [word, word[:at] + word[at + 1 :], word[:at] + rng.choice("abé") + word[at:], word[:at] + rng.choice("xyé") + word[at + 1 :]][how]

    rows: list[tuple[int | None, str | None]] = []
    for i in range(60):
        picked = [w for w in words for _ in range(rng.choice([1, 1, 12]))]
        rows.append((i - 5, rng.choice([" ", "-", "1", "ÿ ", "日"]).join(damaged(w) if rng.random() < 0.4 else w for w in rng.sample(picked, 40))))
    return [*rows, (None, "electrics electrics"), (None, None), (3, ""), (4, "y" * 3_000), (4, "y" * 3_001), rows[0], rows[0], (9, "y" * 3_000), (9, "y" * 3_001)]


def test_spelling_variants(spark, awkward, empty, rows_in):
    assert _variants(awkward) == Counter(brute.spelling(rows_in))
    rows = _misspelled()
    found = _variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert found == Counter(brute.spelling(rows))
    assert sum(r[3] is not None for r in found) > 5 and any(r[2] > 3 for r in found)
    assert spelling.spelling_variants(empty).count() == 0


@pytest.mark.parametrize("most", [1, 2, 8])
def test_blocks_cut_smaller_give_the_same_pairs(spark, most):
    counted = [(r[0], r[1]) for r in brute.spelling(_misspelled())]
    words = settle(spark.createDataFrame(counted, "word string, n long"), "test-words")
    plain = Counter(tuple(r) for r in spelling.near_pairs(words).collect())
    assert plain and max(plain.values()) == 1
    assert Counter(tuple(r) for r in spelling.near_pairs(words, most).collect()) == plain


def test_large_blocks_are_cut(spark):
    words = [f"{'abcdefgh'[i % 8]}{'abcdefgh'[i // 8 % 8]}{'abcdefgh'[i // 64]}zzzzzz" for i in range(512)]
    blocks = spelling.blocks(settle(spark.createDataFrame([(w, 2) for w in words], "word string, n long"), "test-words"), 64)
    largest = blocks.groupBy("block").count().agg({"count": "max"}).first()[0]
    assert largest <= 64
    assert spelling.near_pairs(settle(spark.createDataFrame([(w, 2) for w in words], "word string, n long"), "test-words"), 64).count() == 512 * 21


def test_spelling_equals_its_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    name = "op13_spelling_variants"
    assert differences(queries.QUERIES[name](spark, sf_dir), duck(sf_dir), queries.ORACLE_SQL[name]) is None
