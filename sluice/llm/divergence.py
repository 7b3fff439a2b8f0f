"""Source divergence audit: how the sources of a language differ in their words, exactly, from count-level bitmaps.

Every group (a language and source) keeps one bitset per count: the ids of the terms that it holds just so often. A share
depends on the count alone, so two groups need not be compared term by term: the AND of two bitsets has as many bits as
terms with this pair of counts, and that number times the pair's divergence is their part of the sum. Terms that a group
lacks are those of the other's bitsets that are in none of its own.

Ids are given in the order of a language's counts, so that the terms of a stretch of ids have few counts in each group and
their bitsets are full. Bitsets are cut into stretches of words, and sources into tiles; a task compares two tiles over one
stretch, so neither the vocabulary nor the sources of a language have to fit in a task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.operators.joins import lookup_join, settle

#: Documents of its language that a kept term is in, at least; terms reported for a group.
LEAST_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
#: Terms of a bitset's word, words of a stretch, sources of a tile (about), bitsets of one tile compared at a time.
WORD_BITS = 64
STRETCH_WORDS = 64
TILE_SOURCES = 64
ROWS_AT_A_TIME = 256
#: Entries that a task counts before it passes them on.
HELD_TERMS = 1 << 18

#: Signs that stand in terms: letters, and every byte of a sign beyond ASCII. All others part them.
SIGNS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def term_counts(docs: DataFrame, held_terms: int = HELD_TERMS) -> DataFrame:
    """``lang``, ``source``, ``term``, ``tf`` occurrences and ``df`` documents; each group also has a row of the term ''.

    Tasks count what they read before anything is shuffled; what they hold is bounded by ``held_terms`` and one text.
    """
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for (lang, source), (occurrences, documents) in seen.items():
                terms, size = [term.decode() for term in occurrences], len(occurrences) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, kind) for values, kind in zip((
                        [lang] * size, [source] * size, ["", *terms], [0, *occurrences.values()],
                        [0, *(documents[term] for term in occurrences)]), kinds)],
                    names=["lang", "source", "term", "tf", "df"])
            seen.clear()

        for batch in batches:
            bodies = batch.column(2).cast(pa.large_binary())
            for i in range(batch.num_rows):
                key = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                occurrences, documents = seen.setdefault(key, (Counter(), Counter()))
                own = Counter(bodies[i].as_py().translate(SIGNS).split())
                held -= len(occurrences)
                occurrences.update(own)
                documents.update(own.keys())
                held += len(occurrences)
                if held > held_terms:
                    yield from flushed()
                    held = 0
        yield from flushed()

    rows = texts.mapInArrow(count, "lang string, source string, term string, tf bigint, df bigint")
    return rows.groupBy("lang", "source", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def share(count: Column, total: Column) -> Column:
    """The smoothed share of a term in billionths, in whole numbers; ``total`` is that of all terms, smoothing included."""
    scaled = (count + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", scaled, total.cast("decimal(20,0)")) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def share_of(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """As :func:`share`, for arrays: long division by thousands, which stays within 64 bits up to totals of 9e15."""
    totals = np.maximum(totals, 1)
    whole, rest = np.divmod(counts + 2, totals)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, totals)
        whole = whole * 1000 + more
    return whole + 1


def divergence_of(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def kept_terms(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang``, ``term``, ``lang_count`` and ``id`` of the terms that enough documents of the language hold.

    Ids rise within a language as counts fall; they are dealt out by range, so no task holds a whole vocabulary.
    """
    terms = (counts.where("term <> ''").groupBy("lang", "term")
             .agg(F.sum("tf").alias("lang_count"), F.sum("df").alias("df"))
             .where(F.col("df") >= least_docs).drop("df"))
    order = [F.col("lang"), F.desc("lang_count"), F.col("term")]
    dealt = terms.repartitionByRange(*order).sortWithinPartitions(*order)
    return settle(dealt.withColumn("id", F.monotonically_increasing_id()))


def compared(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Parts of the sums of all pairs of sources of two tiles, over one stretch of ids.

    A row without ``word`` stands for a source; its ``bits`` are the number of terms in the stretch.
    """
    lang, _, low, high = (value.as_py() for value in key)
    marks = table.filter(pa.compute.is_null(table["word"]))
    sources, tiles = marks["source"].to_pylist(), marks["tile"].to_numpy()
    totals, terms = marks["total"].to_numpy(), int(marks["bits"][0].as_py())
    place = {source: i for i, source in enumerate(sources)}
    rows = table.filter(pa.compute.is_valid(table["word"]))
    of = np.array([place[source] for source in rows["source"].to_pylist()], np.int64)
    bits, words = rows["bits"].to_numpy().astype(np.uint64), rows["word"].to_numpy().astype(np.int64)
    p, none = share_of(rows["count"].to_numpy(), totals[of]), share_of(np.zeros(len(sources), np.int64), totals)
    sizes = np.bitwise_count(bits).astype(np.int64)
    held = np.zeros(len(sources), np.int64)
    np.add.at(held, of, sizes)

    # As if no term were in both: those of either against nothing, and nothing against nothing for the rest.
    lacking = divergence_of(none[:, None], none[None, :])
    sums = lacking * (terms - held[:, None] - held[None, :])
    for start in range(0, len(of), ROWS_AT_A_TIME):
        part = slice(start, start + ROWS_AT_A_TIME)
        alone = sizes[part, None] * divergence_of(p[part, None], none[None, :])
        np.add.at(sums, of[part], alone)
        np.add.at(sums.T, of[part], alone)
    # Then what each pair of counts that occurs together makes of it.
    order = np.argsort(words, kind="stable")
    for block in np.split(order, np.flatnonzero(np.diff(words[order])) + 1):
        left, right = block[tiles[of[block]] == low], block[tiles[of[block]] == high]
        for start in range(0, len(left), ROWS_AT_A_TIME):
            part = left[start:start + ROWS_AT_A_TIME]
            joint = np.bitwise_count(bits[part, None] & bits[None, right])
            i, j = np.nonzero(joint)
            a, b, n = part[i], right[j], joint[i, j].astype(np.int64)
            g, h = of[a], of[b]
            gain = n * (divergence_of(p[a], p[b]) - divergence_of(p[a], none[h]) - divergence_of(none[g], p[b]) + lacking[g, h])
            np.add.at(sums, (g, h), gain)
    g, h = np.nonzero((tiles == low)[:, None] & (tiles == high)[None, :])
    if low == high:
        g, h = g[g != h], h[g != h]
    else:
        sums[h, g] = sums[g, h]
        g, h = np.concatenate([g, h]), np.concatenate([h, g])
    names = pa.array(sources, pa.string())
    return pa.table({"lang": pa.array([lang] * len(g), pa.string()), "source": names.take(pa.array(g)),
                     "item": names.take(pa.array(h)), "value": pa.array(sums[g, h], pa.int64())})


def pair_sums(bitsets: DataFrame, groups: DataFrame, tile_sources: int = TILE_SOURCES) -> DataFrame:
    """``lang``, ``source``, ``item``, ``value`` of every two sources of a language.

    ``bitsets`` has ``lang``, ``source``, ``count``, ``word``, ``bits``, ``stretch``; ``groups`` has ``total`` and
    ``stretches``, the number of kept terms in each, and names each source once.
    """
    most = groups.groupBy("lang").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    tiles = max(1, -(-most // tile_sources))
    tile = F.pmod(F.xxhash64("source"), F.lit(tiles)).cast("int")
    # Stretch -1 has no terms; it names the pairs of languages that keep none.
    everywhere = F.concat(F.array(F.struct(F.lit(-1).cast("bigint").alias("stretch"), F.lit(0).cast("bigint").alias("n"))),
                          F.coalesce("stretches", F.array()))
    none = F.lit(None).cast("bigint")
    marks = (groups.select("lang", "source", "total", F.explode(everywhere).alias("s"))
             .select("lang", "source", "total", F.col("s.stretch").alias("stretch"), F.lit(0).cast("bigint").alias("count"),
                     none.alias("word"), F.col("s.n").alias("bits")))
    rows = lookup_join(bitsets, groups.select("lang", "source", "total"), ["lang", "source"], "inner")
    other = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
    both = (rows.unionByName(marks).withColumn("tile", tile).withColumn("other", other)
            .withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")}))
    parts = both.groupBy("lang", "stretch", "low", "high").applyInArrow(
        compared, "lang string, source string, item string, value bigint")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audited(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS,
            tile_sources: int = TILE_SOURCES) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: for each group, all other sources and its own terms.

    Part ``pair`` has every other source of the language with the divergence between the two; part ``term`` has the
    ``top`` terms that the group uses more than its language does. Ranks start from 1 in each group and part, by value
    downwards and then by item. Only ``text``, ``lang`` and ``source`` are used; a null in any of them counts as the empty
    text. Repeated rows count as documents of their own. A group without words is compared like any other; where a
    language keeps no term, its pairs have the value 0. No documents give no rows.
    """
    counts = settle(term_counts(docs))
    kept = kept_terms(counts, least_docs)
    word = F.shiftright(F.col("id"), 6)
    stretch = F.floor(word / STRETCH_WORDS).alias("stretch")
    # One row a language; the list is as long as its vocabulary has stretches.
    langs = (kept.groupBy("lang", stretch).agg(F.count("*").alias("n"), F.sum("lang_count").alias("c"))
             .groupBy("lang").agg(F.sum("n").alias("v"), F.sum("c").alias("lang_n"),
                                  F.collect_list(F.struct("stretch", "n")).alias("stretches")))
    used = settle(counts.where("term <> ''").select("lang", "source", "term", F.col("tf").alias("count"))
                  .join(kept, ["lang", "term"]))
    own = used.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    zero, smooth = F.lit(0).cast("bigint"), 2 * F.coalesce("v", F.lit(0))
    groups = lookup_join(counts.where("term = ''").select("lang", "source").join(own, ["lang", "source"], "left"),
                         langs, ["lang"], "left")
    groups = settle(groups.select("lang", "source", "stretches", (F.coalesce("n", zero) + smooth).alias("total"),
                                  (F.coalesce("lang_n", zero) + smooth).alias("lang_total")))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("id").bitwiseAND(F.lit(WORD_BITS - 1).cast("bigint")).cast("int"))
    bitsets = used.groupBy("lang", "source", "count", word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    bitsets = bitsets.withColumn("stretch", F.floor(F.col("word") / STRETCH_WORDS))

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(place).alias("rank"))

    pairs = ranked(pair_sums(bitsets, groups, tile_sources), "pair")
    p, q = share(F.col("count"), F.col("total")), share(F.col("lang_count"), F.col("lang_total"))
    terms = lookup_join(used, groups.drop("stretches"), ["lang", "source"], "inner")
    terms = terms.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    terms = ranked(terms.select("lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value")), "term")
    return pairs.unionByName(terms.where(F.col("rank") <= top))
