"""Benchmark decontamination as a prefix-filtered set join with exact verification.

Benchmark items are cut into windows of ten consecutive words (a shorter item is one window). A document contains a
window only if it contains all of its three-word shingles, so one of them is enough to look for: the rarest one, which is
the whole prefix that a containment join needs. Rarity is the shingle's count over all documents.

1. Count the benchmark's shingles over all documents, summed in each task before they are shuffled.
2. Order each window's shingles by rarity and keep the first with its place in the window.
3. Emit the places in documents where such a shingle stands, each with the words that a window around it could cover.
4. Join them to the windows on the shingle, drop those where the window would begin before the text or end after it
   (bounds by position and length), and compare the words themselves.

What tasks need of the benchmark is a bit map of fixed size, whatever the size of the benchmark; it only saves rows that
the joins would drop. Texts are read in whole and never shuffled. What is found is kept by the text's digest, so copies
of a text are looked at once after step 3.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from sluice.llm.common import joined, packed, unpacked
from sluice.operators.joins import lookup_join, settle

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
#: Bits of a shingle's hash that address the bit map: 2 MB.
MAP_BITS = 24
ROWS_OUT = 4096

#: Bytes of words are kept, A-Z as a-z; all others become blanks. Fixed by the definition of a word.
LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                for b in range(256))
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased runs of digits, a-z and anything that is not ASCII."""
    return text.translate(LETTERS).split()


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """A 64-bit hash for each run of ``width`` words; equal runs have equal hashes."""
    size = len(words) - width + 1
    if size < 1:
        return np.empty(0, np.uint64)
    single = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    total = np.full(size, width, np.uint64)
    for i in range(width):
        total = (total ^ single[i:i + size]) * np.uint64(FACTORS[i % len(FACTORS)])
        total ^= total >> np.uint64(29)
    return total


def windows_of(text: bytes, window_words: int, shingle_words: int) -> dict[tuple[bytes, ...], list[int]]:
    """Different windows of an item and the hashes of their shingles, by place."""
    words, found = words_of(text), {}
    size = min(window_words, len(words))
    if size:
        hashes, width = shingle_hashes(words, min(shingle_words, size)), min(shingle_words, size)
        for start in range(len(words) - size + 1):
            window = tuple(words[start:start + size])
            if window not in found:
                found[window] = hashes[start:start + size - width + 1].view(np.int64).tolist()
    return found


def item_windows(benchmark: DataFrame, window_words: int, shingle_words: int) -> DataFrame:
    """``item``, ``window`` (its words), ``shingles`` (hashes by place); items without words have none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1).cast(pa.large_binary())):
                found = windows_of(text.as_py() or b"", window_words, shingle_words)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item.as_py()] * len(found), pa.string()),
                         pa.array([[w.decode() for w in window] for window in found], pa.list_(pa.string())),
                         pa.array(list(found.values()), pa.list_(pa.int64()))], ["item", "window", "shingles"])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                            F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "item string, window array<string>, shingles array<bigint>")


def bit_map(spark: SparkSession, hashes: DataFrame) -> object:
    """Broadcast map of the column ``shingle``: a bit for each value of its highest bits; of one size for any input."""
    place = F.shiftrightunsigned("shingle", 64 - MAP_BITS)
    parts = (hashes.select(F.shiftright(place, 5).alias("part"),
                           F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(31).cast("int")).alias("bit"))
             .groupBy("part").agg(F.bit_or("bit").alias("bits")).toArrow())
    bits = np.zeros(1 << (MAP_BITS - 5), np.uint32)
    bits[parts["part"].to_numpy()] = parts["bits"].to_numpy()
    return spark.sparkContext.broadcast(np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool))


def shingle_counts(docs: DataFrame, known: object, widths: list[int]) -> DataFrame:
    """``shingle``, ``n``: how often shingles of the map occur in all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = known.value
        for batch in batches:
            found = [np.empty(0, np.uint64)]
            for text in batch.column(0).cast(pa.large_binary()):
                words = words_of(text.as_py() or b"")
                for width in widths:
                    hashes = shingle_hashes(words, width)
                    found.append(hashes[present[hashes >> np.uint64(64 - MAP_BITS)]])
            values, counts = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))],
                                             ["shingle", "n"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "shingle bigint, n bigint")
    return rows.groupBy("shingle").agg(F.sum("n").alias("n"))


def places(docs: DataFrame, known: object, widths: list[int], window_words: int) -> DataFrame:
    """One row for each document (``shingle`` null), and one for each place of a shingle of the map.

    ``digest`` tells texts apart, ``at`` is the place, ``words`` are those from word ``first`` on that a window with
    this shingle could cover.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = known.value
        names = ["doc_id", "digest", "n_words", "shingle", "at", "first", "words"]
        for batch in batches:
            digests, totals, found = [], [], []
            kinds = [batch.schema.field(0).type, pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                     pa.list_(pa.string())]

            def rows(columns):
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

            for text in batch.column(1).cast(pa.large_binary()):
                content = text.as_py() or b""
                words, digest = words_of(content), hashlib.sha256(content).digest()
                digests.append(digest)
                totals.append(len(words))
                for width in widths:
                    hashes = shingle_hashes(words, width)
                    for at in np.flatnonzero(present[hashes >> np.uint64(64 - MAP_BITS)]).tolist():
                        first = max(0, at - window_words + width)
                        found.append((None, digest, len(words), int(hashes[at].view(np.int64)), at, first,
                                      [w.decode() for w in words[first:at + window_words]]))
                        if len(found) == ROWS_OUT:
                            yield rows(zip(*found))
                            found = []
            if found:
                yield rows(zip(*found))
            none = [None] * len(digests)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip((digests, totals, none, none, none, none),
                                                                   kinds[1:]))], names=names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {id_type}, digest binary, n_words bigint, shingle bigint, at bigint, first bigint, "
             "words array<string>")


def covered(spans: Column) -> Column:
    """Number of words in the union of (start, end) spans that are sorted by start."""
    step = F.aggregate(
        spans, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end")),
        lambda done, span: F.struct(
            (done["n"] + F.greatest(F.lit(0), span["end"] - F.greatest(done["end"], span["start"]))).alias("n"),
            F.greatest(done["end"], span["end"]).alias("end")))
    return step["n"]


def decontaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window_words: int = WINDOW_WORDS,
                   shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``, ``items`` for each row of docs.

    ``n_hit`` counts the words inside any occurrence of a window of the benchmark, ``items`` are the items with such
    windows, sorted as strings. Of ``docs``, ``doc_id`` and ``text`` are used, of the benchmark ``item_id`` and
    ``text``. A null or empty text has no words and is never hit; an item without words has no windows. Repeated
    documents each keep their row. Items that share an item_id count as one, items without one as the one named "".
    An empty benchmark hits nothing.
    """
    windows = settle(item_windows(benchmark, window_words, shingle_words))
    different = windows.groupBy("window").agg(F.first("shingles").alias("shingles"))
    # A list of one hash for a short window, of more for a long one; widths as they occur.
    width = F.size("window") - F.size("shingles") + 1
    widths = sorted(row[0] for row in windows.select(width.alias("w")).distinct().collect())

    each = different.select("window", F.posexplode("shingles").alias("place", "shingle"))
    counts = shingle_counts(docs, bit_map(spark, each.select("shingle")), widths)
    first = (each.join(counts, "shingle", "left")
             .groupBy("window").agg(F.min_by(F.struct("shingle", "place"), F.struct(
                 F.coalesce("n", F.lit(0)).alias("n"), "shingle", "place")).alias("prefix")))
    prefixes = settle(first.select("window", "prefix.*", F.size("window").alias("length")))

    found = settle(places(docs, bit_map(spark, prefixes.select("shingle")), widths, window_words))
    candidates = found.where("shingle IS NOT NULL").drop("doc_id")
    hits = (lookup_join(candidates, prefixes, ["shingle"], "inner")
            .withColumn("start", F.col("at") - F.col("place"))
            .where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
            .where(F.expr("slice(words, int(start - first) + 1, length)") == F.col("window"))
            .select("digest", "start", (F.col("start") + F.col("length")).alias("end"), "window"))
    hits = settle(hits.distinct())
    spans = (hits.select("digest", "start", "end").distinct().groupBy("digest")
             .agg(covered(F.array_sort(F.collect_list(F.struct("start", "end")))).alias("n_hit")))
    items = (hits.select("digest", "window").distinct()
             .join(windows.select("window", "item").distinct(), "window")
             .groupBy("digest").agg(F.array_sort(F.collect_set("item")).alias("items")))
    marks = spans.join(items, "digest")
    none = F.array().cast("array<string>")
    result = lookup_join(found.where("shingle IS NULL").select("doc_id", "digest", "n_words"), marks, ["digest"], "left")
    items = F.coalesce("items", none)
    return result.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"), F.sha2(joined(items), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), items.alias("items"))


def clean_documents(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of the benchmark, in their own columns."""
    def digest(text):
        return F.unhex(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256))

    marked = decontaminated(spark, docs.select(digest("text").alias("doc_id"), "text"), benchmark, **how)
    bad = marked.where("contaminated").select(F.col("doc_id").alias("digest")).distinct()
    return unpacked(lookup_join(packed(docs).withColumn("digest", digest("row.text")), bad, ["digest"], "left_anti"))
