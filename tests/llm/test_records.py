"""Archives, conversations, languages and the pipeline."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import plain
import public_tokenizers
import pyarrow.fs
import pytest
import tiktoken
import zstandard

import corpus_pipeline
from sluice.llm import bpe, chat, language_id, pii, warc

PAGES = "page_id bigint, url string, html string"


@pytest.fixture
def pages(spark):
    rows = [(1, "http://a", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (3, None, None), (4, "x\r\ny", ""), (5, "u", "own"),
            (2, "http://b", "<p>é</p>"), (None, "u", "own"), (None, "n", "nobody"), (6, "l", "long " * 50_000)]
    return spark.createDataFrame(rows, PAGES).selectExpr("*", "'mine' AS payload", "'mine' AS bundle", "'mine' AS first")


def test_pages_come_back_from_archives(spark, pages):
    found = warc.archived(spark, pages)
    roles = sorted((repr(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in found.collect())
    assert roles == sorted([("1", "revisit", 2, 9), ("2", "response", None, 9), ("2", "response", None, 9),
                            ("3", "revisit", 4, 0), ("4", "response", None, 0), ("5", "response", None, 3),
                            ("None", "revisit", 5, 3), ("None", "response", None, 6), ("6", "response", None, 250_000)])
    assert {r.payload_digest for r in found.where("page_id = 3").collect()} == {"3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"}
    assert warc.archived(spark, pages.limit(0)).count() == 0
    assert warc.archived(spark, pages, least_bytes=4).where("record_type = 'revisit'").count() == 1


def test_bundles_have_frames_of_their_own(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/archive"
    index = warc.write_archives(spark, pages.repartition(1), folder, frame_bytes=600)
    places = sorted((r.frame, r.offset) for r in index.collect())
    assert len({frame for frame, _ in places}) > 2 and places[0] == (0, 0)
    name = index.first().bundle
    path = tmp_path / "archive" / name
    whole = zstandard.ZstdDecompressor().stream_reader(path.read_bytes(), read_across_frames=True).read()
    assert whole.startswith(b"WARC/1.1\r\n") and whole.count(b"WARC/1.1\r\n") == 9
    reader = warc.BundleReader(pyarrow.fs.LocalFileSystem().open_input_file(str(path)))
    row = index.where("page_id = 5").first()
    assert warc.parsed(reader.record(row.frame, row.offset, row.length))["payload"] == b"own"
    texts = warc.read_archives(index, folder, payloads=True).where("page_id = 6").first().payload
    assert texts.decode() == "long " * 50_000
    with pytest.raises(ValueError):
        (tmp_path / "other").write_bytes(b"no bundle at all")
        warc.BundleReader(pyarrow.fs.LocalFileSystem().open_input_file(str(tmp_path / "other")))


TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_beginnings_of_conversations_are_dropped(spark):
    talk = [("user", "hi"), ("assistant", "hello"), ("user", None), (None, "end")]
    rows = [(1, i, *t) for i, t in enumerate(talk[:2])] + [(2, i, *t) for i, t in enumerate(talk)]
    rows += [(3, 10 * i, *t) for i, t in enumerate(talk)] + [(4, i, *t) for i, t in enumerate(talk[:1])] * 2
    rows += [(5, 0, "user", "h"), (5, 1, "i", ""), (None, 0, "user", "alone"), (6, None, "user", "hi"), (6, 1, "user", "x")]
    frame = spark.createDataFrame(rows, TURNS).selectExpr("*", "'mine' AS digest", "'mine' AS seq", "'mine' AS conv")
    found = sorted(chat.formatted(frame).collect(), key=lambda r: (repr(r.conv_id), r.seq))
    assert [(r.conv_id, r.seq, r.n_turns) for r in found] == [
        (2, 1, 4), (2, 2, 4), (2, 3, 4), (2, 4, 4), (5, 1, 2), (5, 2, 2), (6, 1, 2), (6, 2, 2), (None, 1, 1)]
    assert found[2].rendered == "<|user|>\n<|end|>\n" and found[3].rendered == "<|unknown|>\nend<|end|>\n"
    assert chat.formatted(frame.limit(0)).count() == 0


def test_conversations_of_any_length(spark):
    """Against comparing all with all; one conversation has a third of all turns."""
    rng, logs = random.Random(6), {0: [("user", f"t{i % 5}") for i in range(400)]}
    for i in range(1, 60):
        base = rng.choice(list(logs.values())) if rng.random() < 0.6 else []
        logs[i] = base[:rng.randint(0, 9)] + [("user", str(rng.randint(0, 2))) for _ in range(rng.randint(0, 3))] or [
            ("user", "0")]
    rows = [(i, k, *turn) for i, turns in logs.items() for k, turn in enumerate(turns)]
    kept = [i for i, a in logs.items() if not any(
        b[:len(a)] == a and (len(b) > len(a) or j < i) for j, b in logs.items() if j != i)]
    found = chat.formatted(spark.createDataFrame(rows, TURNS))
    assert sorted({r.conv_id for r in found.collect()}) == kept
    assert found.count() == sum(len(logs[i]) for i in kept)


@pytest.fixture(scope="module")
def spoken(spark):
    """Two made languages, told apart by their letters' order."""
    rng = random.Random(2)

    def text(parts):
        return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(rng.randint(4, 40)))

    rows = [(i, text(["ka", "to", "mi"]) if i % 2 else text(["ath", "ing", "er"]), "aa" if i % 2 else "bb") for i in range(400)]
    rows += [(500, None, "aa"), (501, "", "bb"), (502, "123 !!", "aa"), (None, "kato", "aa"), (503, "中文", None),
             (504, "Katomi " * 50_000, None), (3, rows[3][1], "aa")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr(
        "*", "'mine' AS score", "'mine' AS place", "'mine' AS text_hash", "'mine' AS row")


def test_languages(spark, spoken):
    found = language_id.identified(spark, spoken, sample_rows=100)
    rows = found.collect()
    assert len(rows) == spoken.count()
    by = {r.doc_id: r for r in rows}
    for row in rows:
        assert row.held_out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1
    truth = {r.doc_id: r.lang for r in spoken.collect()}
    tested = [r for r in rows if r.held_out and r.doc_id < 400]
    assert sum(truth[r.doc_id] == r.lang_pred for r in tested) >= 0.98 * len(tested) > 50
    assert {by[i].lang_pred for i in (500, 501, 502)} == {"und"} and by[504].lang_pred == "aa"
    assert by[503].lang_pred in ("aa", "bb")
    kept = language_id.in_known_language(spark, spoken)
    # Not those without a letter, nor the one in a script that no landmark has.
    assert kept.columns == spoken.columns and kept.count() == spoken.count() - 4
    assert kept.where("doc_id IN (500, 501, 502, 503)").count() == 0


SCRIPTS = {"ru": "абвгдежзик", "el": "αβγδεζηθικ", "he": "אבגדהוזחטי", "hi": "कखगघचछजझटठ", "zh": "中文字符测试语言学习", "ko": "가나다라마바사아자차"}


def test_scripts_are_told_apart(spark):
    """Six scripts with more letters together than a small table would hold, and texts that the letter rule alone keeps."""
    rng = random.Random(4)

    def text(letters):
        """Words of a vocabulary of the script's own, as languages have them."""
        words = vocabulary.setdefault(letters, ["".join(rng.choices(letters, k=rng.randint(1, 5))) for _ in range(40)])
        return " ".join(rng.choices(words, k=30))

    vocabulary = {}
    wide = {lang: letters + "".join(chr(ord(letters[0]) + i) for i in range(40) if chr(ord(letters[0]) + i).isalpha())
            for lang, letters in SCRIPTS.items()}
    rows = [(i * 6 + k, text(letters), lang) for i in range(60) for k, (lang, letters) in enumerate(wide.items())]
    docs = spark.createDataFrame(rows + [(9000, "ქართული ენა", None), (9001, text("ქართული"), "ru")], "doc_id bigint, text string, lang string")
    found = {r.doc_id: r for r in language_id.identified(spark, docs, sample_rows=120).collect()}
    assert all(found[i].lang_pred == lang for i, _, lang in rows)
    kept = {r.doc_id for r in language_id.in_known_language(spark, docs.where("doc_id <> 9001"), sample_rows=120).collect()}
    assert kept == {i for i, _, _ in rows}


def plain_grams(text):
    signs = "".join(c if c.isalpha() else " " for c in text.lower())
    while "  " in signs:
        signs = signs.replace("  ", " ")
    signs = signs.removeprefix(" ")
    return {signs[i:i + n] for n in (1, 2, 3) for i in range(len(signs) - n + 1)} - {" "}


def test_kernel_and_weights_against_a_plain_computation():
    rng = random.Random(9)
    words = {"aa": ["kato", "mi", "tomi", "ka"], "bb": ["athing", "er", "ing", "the"], "cc": ["öst", "ßen", "中文", "er"]}
    texts = [(" .1 ".join(rng.choices(words[lang], k=rng.randint(1, 12))), lang) for _ in range(40) for lang in words]
    texts += [("", "aa"), ("ka ka", "aa")]
    model = language_id.fit_model([t for t, _ in texts], [lang for _, lang in texts], landmarks=12, ridge=1e-3)
    presence = language_id.Presence()
    rows, support = presence.matrix([t for t, _ in texts], model.grams)
    scores = language_id.kernel(rows, model.landmarks) @ model.weights

    by = {lang: [t for t, own in texts if own == lang] for lang in words}
    chosen = [plain_grams(by[lang][i]) for i in range(4) for lang in sorted(words)]
    every = set().union(*chosen)
    own = [plain_grams(t) for t, _ in texts]
    short = [{n for n in g if len(n) < 3} for g in own]
    assert [round(s, 9) for s in support] == [round(len(g & every) / len(g), 9) if g else 0.0 for g in short]

    def alike(a, b):
        return len(a & b) / math.sqrt(max(1, len(a & every)) * max(1, len(b & every)))

    between = np.array([[alike(a, b) for b in chosen] for a in chosen])
    values, vectors = np.linalg.eigh(between)
    root = vectors[:, values > 1e-6 * values.max()] / np.sqrt(values[values > 1e-6 * values.max()])
    mapped = np.array([[alike(a, b) for b in chosen] for a in own]) @ root
    for k, lang in enumerate(sorted(words)):
        target = np.array([1.0 if own_lang == lang else -1.0 for _, own_lang in texts])
        weights = np.linalg.solve(mapped.T @ mapped + 1e-3 * len(texts) * np.eye(mapped.shape[1]), mapped.T @ target)
        assert np.allclose(mapped @ weights, scores[:, k], atol=2e-3)


def test_languages_without_anything_to_learn(spark, spoken):
    nothing = spoken.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert {r.lang_pred for r in language_id.identified(spark, nothing).collect()} == {"und"}
    assert language_id.in_known_language(spark, nothing).count() == spoken.count() - 3  # only the letter rule is left
    assert language_id.identified(spark, spoken.limit(0)).count() == 0


def test_only_the_sample_is_learned_from(spark, spoken):
    sample = language_id.training_sample(spoken, rows=50, chars=1000).collect()
    assert len(sample) <= 50 and {r.lang for r in sample} == {"aa", "bb"}
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and len(r.text) <= 1000 for r in sample)


def test_pipeline(spark, tmp_path):
    """All stages against plain Python, one after the other."""
    rng = random.Random(12)
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    item = " ".join(rng.choices(["these", "words", "are", "one", "test", "item", "of", "several"], k=25))
    rows = [tuple(r) for r in source]
    rows += [(9000, f"before it {item.upper()} after it", "en", "s", 1), (9001, None, "en", "s", 1), (9002, "12 !", "en", "s", 1)]
    rows += [(9005, "中文字符测试文本", None, "s", 1), (9006, "Привет, мир", None, "s", 1)]  # no landmark has their letters
    rows += [(9003, rows[5][1], "en", "s", 1), (9003, rows[5][1], "en", "s", 1), (9004, "x@y.zz and 10.0.0.1", None, None, 1)]
    spark.createDataFrame(rows, spark.read.parquet("/root/testdata/sf0.001/documents.parquet").schema).write.parquet(
        f"{tmp_path}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    spark.createDataFrame(items + [(777, item)], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")

    rows = [r for r in rows if r[1] and any(c.isalpha() for c in r[1]) and r[0] not in (9005, 9006)]
    first = {}
    prints = [plain.fingerprint(r[1]) for r in rows]
    for row, root in zip(rows, plain.groups(prints)):
        first[root] = min(first.get(root, row), row, key=lambda r: r[0])
    rows = list(first.values())
    marks = plain.contamination([r[1] for r in rows], items + [(777, item)])
    assert any(m[4] for m in marks)
    rows = [r for r, m in zip(rows, marks) if not m[4]]
    more = plain.identifiers([r[1] for r in rows])
    texts = {r[0]: plain.masked(r[1], plain.private(r[1]) + m) for r, m in zip(rows, more)}
    with open(corpus_pipeline.RANKS, "rb") as file:
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(file.read()),
                                    special_tokens={})
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, list(r.ids)) for r in found) == sorted(
        (i, library.encode_ordinary(text)) for i, text in texts.items())
    assert pii.MASKS["email"] in texts[9004] and 9000 not in texts and 9003 not in texts
