"""Source divergence, exact search and filter interactions against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import divergence, filter_audit, top_k

DOCS = "doc_id bigint, text string, lang string, source string"


def plain_divergence(rows, least_docs, top):
    """Every kept term of a language in every group, one by one."""
    groups, found, occurrences = set(), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = [w.translate({c: c + 32 for c in range(65, 91)})
                 for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        occurrences[lang, source].update(words)
        found[lang].update(set(words))
    out = []
    for lang, source in groups:
        kept = sorted(w for w, n in found[lang].items() if n >= least_docs)
        every = Counter()
        for other in groups:
            if other[0] == lang:
                every.update(occurrences[other])

        def shares(counts):
            total = sum(counts[w] for w in kept) + 2 * len(kept)
            return {w: 1 + 10**9 * (counts[w] + 2) // total for w in kept}

        own, whole = shares(occurrences[lang, source]), shares(every)
        pairs = []
        for other in groups:
            if other[0] == lang and other != (lang, source):
                theirs = shares(occurrences[other])
                pairs.append((other[1], sum((own[w] - theirs[w]) ** 2 // (own[w] + theirs[w]) for w in kept)))
        terms = [(w, (own[w] - whole[w]) ** 2 // (own[w] + whole[w])) for w in kept
                 if occurrences[lang, source][w] and own[w] > whole[w]]
        for part, items, bound in (("pair", pairs, None), ("term", terms, top)):
            ordered = sorted(items, key=lambda item: (-item[1], item[0].encode()))[:bound]
            out += [(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(ordered, 1)]
    return sorted(out)


def sources(n=160, seed=5):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "ça", "Ça", "straße", "中文", "x", "É"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "en", "fr", None, ""])
        source = rng.choice(["hot"] * 5 + ["a", "b", None, "ü"])
        # Each source has a taste of its own.
        some = words[:40] if source == "a" else words[30:] if source == "b" else words
        rows.append((i, rng.choice([" ", "-9", "\n"]).join(rng.choices(some, k=rng.randrange(0, 60))), lang, source))
    rows += [(n, None, "en", "empty"), (n + 1, "", "en", "empty"), (n + 2, "12 34 !!", "rare", "one"), (n + 3, "only here", "rare", "two"),
             (n + 4, "Y" * 200_000 + " alpha", "en", "a")]
    return rows + rows[:3]


@pytest.mark.parametrize("tile_sources", [64, 1])
def test_divergence_is_that_of_single_terms(spark, tile_sources):
    rows = sources()
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS term", "2 AS count", "3 AS stretch", "4 AS total")
    found = divergence.audited(docs.repartition(5), least_docs=4, top=6, tile_sources=tile_sources)
    assert sorted(map(tuple, found.select("lang", "source", "part", "item", "value", "rank").collect())) == plain_divergence(rows, 4, 6)


def test_divergence_of_nothing_and_of_languages_without_terms(spark):
    assert divergence.audited(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(1, "a b", "en", "x"), (2, "a c", "en", "y")]
    found = divergence.audited(spark.createDataFrame(rows, DOCS))
    assert sorted(map(tuple, found.collect())) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_terms_counted_in_a_bounded_space(spark):
    docs = spark.createDataFrame(sources(), DOCS).coalesce(1)
    whole, small = (sorted(map(tuple, divergence.term_counts(docs, held).collect())) for held in (1 << 18, 7))
    assert whole == small


def test_shares_are_exact_beyond_64_bits(spark):
    cases = [(0, 1), (1, 7), (10**15, 8 * 10**15), (123456789012345, 2345678901234567), (10**12 - 2, 10**12)]
    ours = divergence.share_of(np.array([c for c, _ in cases]), np.array([t for _, t in cases]))
    wanted = [1 + 10**9 * (c + 2) // t for c, t in cases]
    assert ours.tolist() == wanted
    rows = spark.createDataFrame(cases[1:], "c bigint, t bigint")
    assert [r[0] for r in rows.select(divergence.share(rows.c, rows.t)).collect()] == wanted[1:]


VECTORS = "vec_id bigint, embedding array<float>"


def plain_nearest(rows, top, every):
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (own, query) in enumerate(whole):
        if own is not None and own % every == 0:
            scores = [(-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(query, v)))), i is None, i or 0)
                      for m, (i, v) in enumerate(whole) if m != n]
            out += [(own, rank, None if no_id else i, -score)
                    for rank, (score, no_id, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def found_nearest(frame, **how):
    return sorted(map(tuple, top_k.nearest(frame, **how).select("query_id", "rank", "vec_id", "score").collect()), key=repr)


def test_search_is_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(12)]) for i in range(400)]
    rows += [(1000 + i, [0.5, -0.25] + [0.0] * 10) for i in range(60)]  # copies: ties
    rows += [(500, None), (501, [1.0, None] + [0.0] * 10), (502, [float("nan")] * 12), (503, [float("inf")] * 12), (50, rows[7][1]),
             (None, rows[50][1]), (504, [0.25]), (550, []), (-50, rows[3][1]), (50, rows[7][1])]
    frame = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS block", "2 AS lot", "3 AS score")
    wanted = plain_nearest(rows, 5, 50)
    assert found_nearest(frame) == wanted
    assert found_nearest(frame, block_rows=64, block_queries=3) == wanted
    # The index alone, in one block.
    numbers = np.array([[math.floor(256 * x) for x in v] for _, v in rows[:460]], np.int64)
    index = top_k.Index(numbers.astype(float))
    for n in range(0, 460, 7):
        best = index.search(numbers[n].astype(float), np.array([n]), [(False, i) for i in range(460)], 5)
        scores = numbers @ numbers[n]
        assert best == sorted(((i, int(s)) for i, s in enumerate(scores) if i != n), key=lambda x: (-x[1], x[0]))[:5]


def test_search_with_few_rows_and_large_numbers(spark):
    assert found_nearest(spark.createDataFrame([], VECTORS)) == []
    assert found_nearest(spark.createDataFrame([(0, [1.0])], VECTORS)) == []
    rows = [(0, [1.0, 2.0]), (1, [3.0, -1.0]), (50, [-2.0, 0.5])]
    assert found_nearest(spark.createDataFrame(rows, VECTORS)) == plain_nearest(rows, 5, 50)
    rows = [(0, [3e38, 1.0]), (1, [-3e38, 0.1]), (2, [2e9, -3.0]), (3, [2.5e9, -3.0]), (50, [1e-3, 1e9]), (51, [1.0, 1.0])]
    assert found_nearest(spark.createDataFrame(rows, VECTORS)) == plain_nearest(rows, 5, 50)


def plain_audit(rows, labels):
    good = {d for d, quality, _ in labels if quality == 1} - {None}
    toxic = {d for d, _, mark in labels if mark == 1} - {None}
    smallest = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    fails = []
    for doc_id, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {name for name, holds in (
            ("A", len(words) < 200), ("B", 100 * len(set(words)) < 50 * len(words)),
            ("C", 100 * len(re.findall("[A-Z]", text)) > 3 * len(text)), ("D", re.search("[#$%&*|]", text)),
            ("E", doc_id is not None and smallest[text] < doc_id)) if holds}
        fails.append((lang or "", failed, doc_id in good, doc_id in toxic))
    out = []
    for part in {f[0] for f in fails}:
        own = [f for f in fails if f[0] == part]
        orders, removed_by = ["".join(o) for o in permutations("ABCDE")], Counter()
        for order in orders:
            left = own
            for step, name in enumerate(order, 1):
                removed = [f for f in left if name in f[1]]
                left = [f for f in left if name not in f[1]]
                removed_by[name] += len(removed)
                out.append([part, order, step, len(left), len(removed), sum(name in f[1] for f in own) - len(removed),
                            sum(f[1] == {name} for f in own), sum(f[2] for f in removed), sum(f[3] for f in removed)])
        for row in out:
            if row[0] == part:
                row.append(removed_by[row[1][row[2] - 1]])
    return sorted(map(tuple, out))


def audited_rows(seed=11):
    rng = random.Random(seed)
    words = ["one", "two", "Three", "FOUR", "fünf", "6#", "a|b"] + [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words[:rng.randrange(2, 300)], k=rng.choice([0, 3, 150, 199, 200, 201, 400]))) for _ in range(12)]
    rows = [(rng.randrange(300), rng.choice(texts), rng.choice(["en", "en", "fr", None, ""])) for _ in range(150)]
    # A text with most of the rows, repeated rows, nulls, and a very long text.
    rows += [(1000 - i, "copied " * 250, rng.choice(["en", "fr"])) for i in range(100)]
    return rows + rows[:5] + [(None, texts[0], "en"), (None, None, None), (7, None, "en"), (8, "", "fr"), (9, "Ab " * 100_000, "de")]


AUDITED = "doc_id bigint, text string, lang string"
LABELS = "doc_id bigint, quality int, toxic int"
REPORT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


@pytest.mark.parametrize("order", ["doc_id", "-doc_id"])
def test_audit_of_all_orders(spark, tmp_path, order):
    """Files in both orders, so that smaller ids come in later batches, and in the same one."""
    rows = audited_rows()
    labels = [(d, d % 2, d % 3 % 2) for d in range(0, 1001, 2)] + [(4, 1, 1), (4, 0, None), (None, 1, 1), (6, None, None)]
    frame = spark.createDataFrame(rows, AUDITED).selectExpr("*", "'x' AS part", "1 AS mask", "true AS good", "0 AS bucket")
    for part in range(1, 6):
        (frame.selectExpr("*", f"ntile(5) OVER (ORDER BY {order}, text, lang) AS nr").where(f"nr = {part}").drop("nr")
         .coalesce(1).write.mode("append").parquet(str(tmp_path / "documents")))
    report = filter_audit.audited(spark, str(tmp_path / "documents"), spark.createDataFrame(labels, LABELS), micro_batches=5)
    assert sorted(map(tuple, report.select(*REPORT).collect())) == plain_audit(rows, labels)


def test_audit_takes_back_and_goes_on(spark, tmp_path):
    """A stream that is started again counts new files only, and takes back what earlier runs have counted."""
    def land(*rows):
        spark.createDataFrame(rows, AUDITED).coalesce(1).write.mode("append").parquet(str(tmp_path / "documents"))

    def counters():
        rows = filter_audit.mask_counters(spark, str(tmp_path / "documents"), spark.createDataFrame([], LABELS),
                                          folder=str(tmp_path / "audit"))
        return {(r.part, r["mask"]): r.n for r in rows.collect()}

    land((5, "same", "en"), (9, "same", "fr"))
    assert counters() == {("en", 1): 1, ("fr", 17): 1}
    land((3, "same", "de"), (5, "same", "en"), (7, "same", None))
    assert counters() == {("en", 17): 2, ("fr", 17): 1, ("de", 1): 1, ("", 17): 1}
    assert counters() == {("en", 17): 2, ("fr", 17): 1, ("de", 1): 1, ("", 17): 1}


def test_audit_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], AUDITED).write.parquet(str(tmp_path / "documents"))
    assert filter_audit.audited(spark, str(tmp_path / "documents"), spark.createDataFrame([], LABELS)).count() == 0


def test_copies_are_settled_within_a_task(spark):
    rows = [(i, "p", "d", 1, False, False) for i in range(50, 0, -1)] + [(1, "q", "d", 1, False, False)]
    frame = spark.createDataFrame(rows, "doc_id bigint, part string, digest string, mask int, good boolean, toxic boolean").coalesce(1)
    frame = frame.withColumn("digest", F.sha2("digest", 256))
    sent = filter_audit.gathered(frame, 7).collect()
    assert sorted((r.first, r.doc_id, r.part, r["mask"], r.n) for r in sent) == [
        (False, 0, "p", 17, 49), (True, 1, "p", 1, 1), (True, 1, "q", 1, 1)]
    small = filter_audit.gathered(frame, 7, held_texts=0).collect()
    assert sum(r.n for r in small) == 51
