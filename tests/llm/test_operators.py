"""The operators against plain restatements of their contracts, on an awkward table and an empty one."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from headway.llm import jaccard_join, suffix_dedup
from headway.llm.byte_bpe import decode_documents, encode_documents, vocabulary
from headway.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from headway.llm.jaccard_join import drop_near_duplicates, near_duplicate_classes
from headway.llm.language_id import identify_languages, language_prototypes
from headway.llm.packing import CAPACITY, pack
from headway.llm.quality_classifier import quality_scores, train
from headway.llm.quality_rules import judge
from headway.llm.sharding import shard
from headway.llm.substring_dedup import removal_digests, with_repeats_removed
from headway.llm.suffix_dedup import byte_removal_digests
from headway.llm.texts import settle
from headway.llm.word_tokens import tokenized
from tests.llm import brute

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def got(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def test_exact_dedup(awkward, empty, rows_in):
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got(exact_duplicates(awkward), *names) == Counter(brute.exact_copies(rows_in))
    kept = drop_exact_duplicates(awkward)
    assert kept.columns == awkward.columns
    expected = Counter(
        (i, t) for (i, t), x in zip(rows_in, brute.exact_copies(rows_in), strict=True) if x[3]
    )
    assert got(kept, "doc_id", "text") == expected
    assert exact_duplicates(empty).count() == 0


def test_packing(awkward, empty, rows_in):
    pieces = settle(tokenized(awkward, WORD_BPE, CAPACITY), "test-pieces")
    placed = pack(pieces).collect()
    tokenizer = Tokenizer.from_file(WORD_BPE)
    expected = []
    for doc_id, text in rows_in:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for k, start in enumerate(range(0, len(ids), CAPACITY)):
            part = np.array(ids[start : start + CAPACITY], dtype="<u4").tobytes()
            expected.append((doc_id, k, start, len(part) // 4, zlib.crc32(part)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in placed) == Counter(expected)
    sequences = {}
    for r in placed:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= CAPACITY
    total = sum(r.length for r in placed)
    assert len(sequences) <= -(-total // CAPACITY) + 1
    assert pack(settle(tokenized(empty, WORD_BPE, CAPACITY), "test-empty")).count() == 0


def _regular_words(n: int = 2_048) -> list[str]:
    """The Thue-Morse word of two letters and its complement: sums modulo 2**64 can't tell them apart."""
    bits = [0]
    while len(bits) < n:
        bits += [1 - b for b in bits]
    return ["".join(pair[b] for b in bits) for pair in ("ab", "ba")]


def test_packed_ids_of_added_tokens_and_regular_words(spark):
    one, two = _regular_words()
    texts = ["hello <|endoftext|> world", "<|ENDOFTEXT|> x<|startoftext|>y", one, two, f"{one} {two}", "été straße ÉTÉ", "it's 12 a.b, c.. 日本"]
    rng = np.random.default_rng(2)
    parts = ["a", "B", " ", ".", ",", "<|endoftext|>", "é", "É", "1", "\n", "zz", "日", "'s", "e\u0301", "ﬁ"]
    texts += ["".join(rng.choice(parts, rng.integers(0, 30))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokenizer = Tokenizer.from_file(WORD_BPE)
    expected = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    found: dict[int, list[int]] = {}
    for r in tokenized(docs, WORD_BPE, CAPACITY).orderBy("doc_id", "piece").collect():
        found.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, dtype="<u4").tolist())
    assert found == expected


def test_regular_words_are_told_apart(spark):
    """In near duplicates, repeated passages and repeated byte strings."""
    one, two = _regular_words()
    prose = " ".join(f"word{i}" for i in range(60))
    rows = [(1, one), (2, two), (3, f"{two} {prose}"), (4, f"{one} {prose}"), (5, f"{one} {prose}"), (6, f"{one} x y z"), (7, f"{two} x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(near_duplicate_classes(docs, 4, 85), "doc_id", "component_id") == Counter({(r[0], r[-1]): 1 for r in brute.jaccard_components(rows, 4, 85)})
    assert got(removal_digests(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(brute.substring_removal(rows, 50))
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got(byte_removal_digests(docs), *columns) == Counter(brute.byte_removal(rows, 400))


def test_sharding(awkward, empty, rows_in):
    placed = shard(awkward, 4).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in placed) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows_in
    )
    by_shard, of_text = {}, {}
    for r in placed:
        by_shard.setdefault(r.shard, []).append(r)
        assert of_text.setdefault((r.size, r.text_crc32), r.shard) == r.shard
    assert set(by_shard) <= set(range(4))
    for rows in by_shard.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert shard(empty, 4).count() == 0


def test_shards_are_near_equal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = [r["s"] for r in shard(docs, 8).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 8
    assert max(sizes) - min(sizes) <= 0.01 * sum(sizes) / 8


@pytest.mark.parametrize("window", [50, 12])
def test_substring_dedup(awkward, rows_in, window):
    found = removal_digests(awkward, window, 10 if window == 50 else 4)
    assert got(found, "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(brute.substring_removal(rows_in, window))


def test_substring_dedup_of_documents(awkward, empty, rows_in):
    changed = with_repeats_removed(awkward)
    assert changed.columns == awkward.columns
    untouched = [(i, t) for (i, t), x in zip(rows_in, brute.substring_removal(rows_in, 50), strict=True) if x[2] == 0]
    assert not Counter(untouched) - got(changed, "doc_id", "text")
    assert changed.count() == len(rows_in)
    assert removal_digests(empty).count() == 0


@pytest.mark.parametrize("crowd", [256, 1])
def test_suffix_dedup(awkward, rows_in, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got(byte_removal_digests(awkward), *names) == Counter(brute.byte_removal(rows_in, 400))


def test_suffix_dedup_of_nothing(empty):
    assert byte_removal_digests(empty).count() == 0


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_jaccard_join(awkward, rows_in, n, percent):
    found = near_duplicate_classes(awkward, n, percent)
    assert got(found, "doc_id", "n_shingles", "component_id") == Counter(brute.jaccard_components(rows_in, n, percent))


@pytest.mark.parametrize("tile", [2, 5])
def test_jaccard_join_over_tiles(spark, monkeypatch, tile):
    """Groups cut into many tiles: near copies of one text around the threshold, some of them in long chains of links."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(60):
        words = list(base) if i % 3 else [f"v{k}" for k in range(40)] + base[40:]
        for at in rng.integers(0, 80, rng.integers(0, 4)):
            words[at] = f"x{rng.integers(0, 5)}"
        rows.append((int(i), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = Counter(brute.jaccard_components(rows, 4, 85))
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    monkeypatch.setattr(jaccard_join, "PARTNERS", 1)
    monkeypatch.setattr(jaccard_join, "ORDERS", 1)
    assert got(near_duplicate_classes(docs, 4, 85), "doc_id", "n_shingles", "component_id") == expected
    assert 1 < len({row[2] for row in expected}) < 60


def test_near_copies_go(awkward, empty, rows_in):
    kept = drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    expected = Counter(
        (i, t)
        for (i, t), x in zip(rows_in, brute.jaccard_components(rows_in, 5, 80), strict=True)
        if x[1] == 0 or x[2] is None or x[0] == x[2]
    )
    assert got(kept, "doc_id", "text") == expected
    assert near_duplicate_classes(empty).count() == 0


def test_byte_bpe(awkward, empty, rows_in):
    decoded = decode_documents(encode_documents(awkward, BYTE_BPE, public_tokenizers.PATTERN), BYTE_BPE)
    own = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary(BYTE_BPE).rank, special_tokens={}
    )
    expected = Counter(
        (i, np.array(own.encode_ordinary(t or ""), dtype="<u4").tobytes(), (t or "").encode()) for i, t in rows_in
    )
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in decoded.collect()) == expected
    assert encode_documents(empty, BYTE_BPE, public_tokenizers.PATTERN).count() == 0


def test_quality_rules(awkward, empty, rows_in):
    found = judge(awkward)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert got(found, "doc_id", *names) == Counter((i, *brute.structure(t)) for i, t in rows_in)
    failed = F.col("base_failed") != ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    assert found.where(failed | (F.col("base_failed") & F.col("kept"))).count() == 0
    assert judge(empty).count() == 0


def _held_out(frame, modulus, rest):
    return F.crc32(frame["doc_id"].cast("string")) % modulus == rest


def test_quality_rules_know_good_from_bad(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    told = judge(docs).join(labels, "doc_id").where("NOT base_failed")
    assert told.where("quality = 1 AND NOT kept").count() <= 0.02 * told.where("quality = 1").count()
    assert told.where("quality = 0 AND kept").count() <= 0.2 * told.where("quality = 0").count()


def test_quality_classifier(spark, awkward, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    machine = train(docs, labels, F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    scored = quality_scores(docs, machine).join(labels, "doc_id")
    held = scored.where(_held_out(scored, 5, 0))
    right = held.where((F.col("score") >= 0.3).cast("int") == F.col("quality")).count()
    assert right >= 0.95 * held.count()
    scores = quality_scores(awkward, machine)
    assert scores.count() == awkward.count()
    assert scores.where("score BETWEEN 0 AND 1").count() == awkward.count()
    assert quality_scores(empty, machine).count() == 0
    untaught = train(empty, labels.limit(0), F.lit(True))
    assert quality_scores(awkward, untaught).where("score = 0.5").count() == awkward.count()


def test_language_id(spark, awkward, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    names, prototypes = language_prototypes(docs, ~_held_out(docs, 4, 2))
    told = identify_languages(docs, names, prototypes).withColumnRenamed("lang_pred", "told").join(docs, "doc_id")
    held = told.where(_held_out(told, 4, 2))
    assert held.where("told = lang").count() >= 0.97 * held.count()
    odd = identify_languages(awkward, names, prototypes).join(awkward.select("doc_id", "text").distinct(), "doc_id")
    assert odd.where("score NOT BETWEEN 0 AND 1").count() == 0
    assert odd.where("text IN ('', '$$$ ### ***') AND lang_pred <> 'und'").count() == 0
    assert identify_languages(empty, names, prototypes).count() == 0
    assert language_prototypes(empty, F.lit(True))[0] == []
