"""Tokenizing operators against the public libraries, over texts with everything in them."""

from __future__ import annotations

import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from sluice.llm import bpe, common, decontaminate, token_counts

PATTERN = public_tokenizers.PATTERN
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
COUNTED = public_tokenizers.path("byte_bpe_50k.json")
PARTS = list("aaab  \n\t\r  'srelmd019½٣éèñ中文日本語한국어🙂👍🏽​́\x1c\x1f\x85!?.,-_ΩжЖ") + ["<|endoftext|>", "the ", "tion"]


def odd_texts(count, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(count)]


@pytest.fixture(scope="module")
def encoder():
    with open(RANKS, "rb") as file:
        return bpe.Encoder(bpe.read_ranks(file.read()), PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=encoder.vocabulary.ranks, special_tokens={})


def test_ids_are_the_librarys(encoder, library):
    for text in odd_texts(4000) + ["a" * 20_000, " " * 20_000, "ab" * 9_999, "é" * 5_000]:
        assert encoder.encode(text) == library.encode_ordinary(text)


def test_every_token_is_its_own_encoding_or_never_used(encoder):
    words = encoder.vocabulary
    assert len(words.tokens) > 50_000
    for token, rank in list(words.tokens.items())[::97]:
        assert bpe.PrefixTable(words, token).ids() == [rank]


def test_tables_stay_right_under_appends_and_edits(encoder):
    rng, words = random.Random(2), encoder.vocabulary
    tokens = list(words.tokens)
    for _ in range(100):
        table = bpe.PrefixTable(words, b"".join(rng.choices(tokens, k=80)))
        table.append(rng.choice(tokens))
        start = rng.randrange(len(table.content))
        redone = table.edit(start, min(len(table.content), start + rng.randint(0, 3)), rng.choice([b"", b"x", b" the"]))
        assert table.last == bpe.PrefixTable(words, table.content).last
        assert redone <= 4 * words.longest + 8 or start + redone == len(table.content)


def test_texts_stay_right_under_appends_and_edits(encoder, library):
    rng = random.Random(3)
    for text in odd_texts(300, 4):
        kept = bpe.EncodedText(encoder, text)
        for _ in range(5):
            start = rng.randint(0, len(kept.text))
            new = "".join(rng.choices(PARTS, k=rng.randint(0, 4)))
            if rng.random() < 0.4:
                kept.append(new)
            else:
                kept.edit(start, min(len(kept.text), start + rng.randint(0, 5)), new)
            assert kept.ids() == library.encode_ordinary(kept.text)


@pytest.fixture(scope="module")
def docs(spark):
    rows = list(enumerate(odd_texts(150, 7))) + [(None, "x"), (3, None), (3, ""), (5, "same"), (5, "same"), (9, "é x " * 30_000)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'mine' AS n_tokens", "'mine' AS of")


def test_encoding_and_decoding(spark, docs, library):
    found = bpe.encoded(spark, docs, RANKS, PATTERN).collect()
    expected = []
    for row in docs.collect():
        ids = library.encode_ordinary(row.text or "")
        expected.append((row.doc_id, len(ids), ids, hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                         hashlib.sha256((row.text or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
    assert bpe.encoded(spark, docs.limit(0), RANKS, PATTERN).count() == 0


def test_counts(spark, docs):
    tokenizer = Tokenizer.from_file(COUNTED)
    expected = []
    for row in docs.collect():
        n = len(tokenizer.encode(row.text or "", add_special_tokens=False))
        expected.append((row.doc_id, len((row.text or "").encode()), n, n > 512))
    found = token_counts.token_counts(spark, docs, COUNTED, PATTERN)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))
    assert token_counts.token_counts(spark, docs.limit(0), COUNTED, PATTERN).count() == 0


def test_counts_of_runs_without_a_boundary():
    tokenizer = Tokenizer.from_file(COUNTED)
    with open(COUNTED, "rb") as file:
        counter = token_counts.Counter(file.read(), PATTERN)
    for text in odd_texts(3000, 9) + ["a" * 20_000, " " * 20_000, "abc" * 7_000]:
        assert counter.count(text) == len(tokenizer.encode(text, add_special_tokens=False))


def test_pieces_share_what_they_begin_with(encoder, library):
    """A longer piece asks for its last tokens only; what is dropped from memory changes no ids."""
    fresh = bpe.Encoder(encoder.vocabulary.ranks, PATTERN)
    asked = []
    work_out = fresh.prefixes.compute
    fresh.prefixes.compute = lambda content: asked.append(content) or work_out(content)
    for memo in (fresh.pieces, fresh.prefixes, fresh.vocabulary.pairs, fresh.vocabulary.left, fresh.vocabulary.right):
        memo.bound = 40
    words = [" " + "ontiherean"[i:] + "thinshing"[:k] for i in range(9) for k in range(9)] * 3
    for word in words + odd_texts(500, 11):
        assert fresh.encode(word) == library.encode_ordinary(word)
        assert len(fresh.pieces) + len(fresh.pieces.older) <= 41
    asked.clear()
    fresh.prefixes.clear()
    fresh.prefixes.older, fresh.prefixes.bound = {}, 1000
    fresh.encode(" hahehewhandon")
    first = len(asked)
    fresh.encode(" hahehewhandonhe")
    assert 0 < len(asked) - first < first


def test_results_asked_for_again_are_kept():
    computed = []
    memo = common.Memo(lambda key: computed.append(key) or key, 20)
    for i in range(200):
        assert memo[i] == i and memo["often"] == "often"
        assert len(memo) + len(memo.older) <= 21
    assert computed.count("often") == 1


def test_a_worker_keeps_what_its_last_operator_needs():
    built = [common.per_worker(("a",), object), common.per_worker(("a",), object)]
    assert built[0] is built[1]
    common.per_worker(("b",), object)
    assert common.per_worker(("a",), object) is not built[0]


def test_hashing_words_leaves_nothing_in_a_worker():
    kept = common.per_worker(("mine",), object)
    assert len(decontaminate.shingle_hashes([b"a", b"b", b"a", b"b", b"a"], 2)) == 4
    assert common.per_worker(("mine",), object) is kept
