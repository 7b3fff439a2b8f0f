"""SimHash near-duplicates: fingerprints, a grid of segment bit counts, exact links, connected groups.

A fingerprint is embedded as the vector of bit counts of its 32 two-bit segments. Flipping a bit moves the vector by one
in one place, so the Manhattan distance of two vectors is a lower bound of the bits in which the fingerprints differ. The
range join lays a grid over the vectors: each fingerprint enters its own cell and those one step away, and two
fingerprints at distance two or less meet in a cell half-way. Only cells that hold several fingerprints are looked at
again. There the link is verified exactly: two fingerprints differ in at most two bits just when a value exists that
differs from each of them in at most one. At most 65 fingerprints surround such a value, so no group of copies, however
large, is ever expanded into pairs: the members of a value are linked to their smallest.

Everything is proportional to the number of different fingerprints. Exact copies have collapsed into one by then.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from sluice.llm.common import packed, texts_of, unpacked
from sluice.operators.joins import lookup_join, settle

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
LOW_BITS = 0x5555555555555555
BLOCK = 1 << 16


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Majority of the shingles' hash bits, as a signed 64-bit number; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    width = min(shingle_words, len(words))
    total = len(words) - width + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, total, BLOCK):
        size = min(BLOCK, total - start)
        shingles = map(b" ".join, zip(*(words[start + i:start + i + size] for i in range(width))))
        hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), "<u8", size)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(size, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """SimHash of each whole text over its lower-cased shingles, repeats included; 0 where there are no words."""
    @F.arrow_udf("bigint")
    def simhash(column: pa.Array) -> pa.Array:
        return pa.array((fingerprint(value, shingle_words) for value in texts_of(column)), pa.int64())

    return simhash(text.cast("string"))


def cell(value: Column) -> Column:
    """Bit counts of the 32 two-bit segments, two bits each, in one number."""
    low = F.lit(LOW_BITS)
    return _sum_without_carry(value.bitwiseAND(low), F.shiftrightunsigned(value, 1).bitwiseAND(low))


def _sum_without_carry(a: Column, b: Column) -> Column:
    """a + b where every two-bit field is 0 or 1 in both, without leaving the signed range."""
    return a.bitwiseXOR(b).bitwiseOR(F.shiftleft(a.bitwiseAND(b), 1))


def around(value: Column, max_bits: int) -> Column:
    """Array of the value and, for two bits, all values one bit away: what two linked fingerprints have in common."""
    flips = [0] if max_bits == 0 else [0, *(1 << i for i in range(63)), -(1 << 63)]
    return F.array(*(value.bitwiseXOR(F.lit(flip).cast("bigint")) for flip in flips))


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``a`` > ``b`` of fingerprints that connect all that differ in at most ``max_bits`` bits.

    ``distinct`` has the column ``fp``, each value once. Every linked pair is joined through the smallest fingerprint
    around a common value, so the groups are whole while the number of pairs stays below 65 per fingerprint.
    """
    if max_bits not in (0, 2):
        raise ValueError("the common value exists for a distance of 0 or 2 bits")
    middles = around(F.col("fp"), max_bits)
    points = distinct.select("fp", F.explode(middles).alias("middle"))
    points = points.select("fp", "middle", cell(F.col("middle")).alias("cell"))
    # A fingerprint's own cell and those a step away; several values around it may lie in one.
    in_grid = distinct.select("fp", F.explode(F.array_distinct(F.transform(middles, cell))).alias("cell"))
    shared = (in_grid.groupBy("cell").agg(F.min("fp").alias("low"), F.max("fp").alias("high"))
              .where("low < high").select("cell"))
    met = lookup_join(points, shared, ["cell"], "left_semi")
    balls = met.groupBy("middle").agg(F.collect_set("fp").alias("members")).where(F.size("members") > 1)
    return (balls.select(F.array_min("members").alias("b"), F.explode("members").alias("a"))
            .where((F.col("a") > F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
            .select("a", "b").distinct())


def connected(pairs: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected to; nodes without a pair are left out.

    Each round links all larger neighbours of a node to its smallest neighbour, then all smaller ones, until the pairs
    are stars. Rounds grow with the logarithm of the longest chain; each is kept in the shared folder.
    """
    stars, before = settle(pairs), None
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # The node in the middle of a large group has most of the pairs; what is looked up for it is one row.
        larger = (lookup_join(both.where("b > a"), least, ["a"], "inner")
                  .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = (lookup_join(larger, least, ["a"], "inner")
                   .select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                                             F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("p"))
                   .select("p.*").where("a > b").distinct())
        stars = settle(smaller)
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest doc_id of the group.

    One row per row of ``docs``, of which ``doc_id`` and ``text`` are used. A null or empty text has fingerprint zero
    and is linked like any other. Repeated rows each get a row. A null doc_id never names a group unless no document
    of the group has one; then component_id is null.
    """
    marked = settle(docs.select("doc_id", fingerprints(F.col("text"), shingle_words).alias("fp")))
    distinct = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    # A fingerprint becomes many rows, so these few are dealt to all cores first.
    cores = docs.sparkSession.sparkContext.defaultParallelism
    roots = connected(links(distinct.select("fp").repartition(cores, "fp"), max_bits)).withColumnRenamed("node", "fp")
    rooted = (distinct.join(roots, "fp", "left")
              .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = lookup_join(rooted, named, ["root"], "inner").select("fp", "component_id")
    return (lookup_join(marked, groups, ["fp"], "inner")
            .select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id"))


def one_of_each_group(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group, one row with the smallest doc_id.

    Columns are those of ``docs``. Rows that share that doc_id stand for one document: of these, too, one row stays, the
    one with the smallest text. A group without any doc_id keeps one row as well.
    """
    groups = near_duplicates(docs, shingle_words, max_bits)
    firsts = settle(groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
                    .select(id_key(F.col("doc_id")).alias("key"), "fingerprint"))
    counts = firsts.groupBy("key").agg(F.count("*").alias("copies"))
    rows = packed(docs).withColumn("key", id_key(F.col("row.doc_id")))
    alone = lookup_join(rows, counts.where("copies = 1 AND key <> ''").select("key"), ["key"], "left_semi")
    # Repeated ids are the exception; which of their rows stay is settled by fingerprint and text.
    several = settle(lookup_join(rows, counts.where("copies > 1 OR key = ''").select("key"), ["key"], "left_semi"))
    several = several.withColumn("fingerprint", hex_digits(fingerprints(F.col("row.text"), shingle_words)))
    several = several.join(firsts.distinct(), ["key", "fingerprint"], "left_semi")
    chosen = several.groupBy("key", "fingerprint").agg(F.min_by("row", F.struct("row.text")).alias("row"))
    return unpacked(alone).unionByName(unpacked(chosen))


def id_key(doc_id: Column) -> Column:
    """A doc_id as a text that is never null."""
    return F.coalesce(F.concat(F.lit("id "), doc_id.cast("string")), F.lit(""))


def hex_digits(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")
