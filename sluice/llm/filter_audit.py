"""Filter interaction audit: what each of five filters removes in every order, kept up to date by retraction.

All files of a table are taken as a stream of micro-batches that ends when the last file has been read. A document becomes
a mask, one bit for each filter it fails. Four bits follow from its text. The fifth says that a smaller doc_id has the same
text, which a later file may still bring. So the state holds, for each text, the smallest doc_id so far and how it was
counted; when a smaller one arrives, the earlier mask is taken back from the counters of its part and counted again with
the fifth bit. The stream gives changes of counters, and their sums after the last batch are exact. The state of texts is
kept in buckets of some hundred texts, as a call of Python for each text costs far more than what it does; there are as
many buckets as the table is large.

Copies within a task are settled there: all but the smallest doc_id are surely removed, so only that one and a few
counters are sent on, however many copies a text has. Texts are told apart by SHA-256 and are not shuffled.

Everything asked of an order of the filters follows from the counters, which number 32 masks a part and label.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.joins import lookup_join
from sluice.session import new_folder

FILTERS = "ABCDE"
BITS = {name: 1 << i for i, name in enumerate(FILTERS)}
COPY = BITS["E"]
LEAST_WORDS = 200
SYMBOLS, CAPITALS = b"#$%&*|", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes that go on with a sign of several bytes.
CONTINUED = bytes(range(0x80, 0xC0))
MICRO_BATCHES = 4
#: Bytes of the table's files that there is a bucket of texts for.
BUCKET_BYTES = 1 << 20
#: Texts that a task holds before it passes them on.
HELD_TEXTS = 1 << 16
#: Age up to which the stream takes up a file, in days: a file is never too old.
ANY_AGE = "365000d"
DESCRIBED = "doc_id bigint, part string, digest string, mask int"
KEYED = ("bucket int, digest string, first boolean, doc_id bigint, part string, mask int, good boolean, toxic boolean, "
         "n bigint")
STATE = "texts string"
COUNTERS = "part string, mask int, good boolean, toxic boolean, n bigint"


def mask_of(text: bytes) -> int:
    """Bits of the filters that the text fails by itself."""
    words = text.split()
    signs = len(text) - (0 if text.isascii() else len(text) - len(text.translate(None, CONTINUED)))
    mask = BITS["A"] if len(words) < LEAST_WORDS else 0
    if 100 * len(set(words)) < 50 * len(words):
        mask |= BITS["B"]
    if 100 * (len(text) - len(text.translate(None, CAPITALS))) > 3 * signs:
        mask |= BITS["C"]
    if len(text.translate(None, SYMBOLS)) < len(text):
        mask |= BITS["D"]
    return mask


def described(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``digest`` and ``mask``, the latter without the bit of copies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for value in batch.column(2).cast(pa.large_binary()):
                text = value.as_py()
                masks.append(mask_of(text))
                digests.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.string()),
                                              pa.array(masks, pa.int32())], names=["doc_id", "part", "digest", "mask"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "text")))
    return texts.mapInArrow(run, DESCRIBED)


class Smallest:
    """The rows of the smallest doc_id of one text, and what becomes of counters as smaller ones arrive."""

    def __init__(self, mask: int, doc_id: int | None = None, good: bool = False, toxic: bool = False,
                 parts: dict[str, int] | None = None):
        self.mask, self.doc_id, self.good, self.toxic, self.parts = mask, doc_id, good, toxic, parts or {}

    def add(self, doc_id: int, part: str, good: bool, toxic: bool, n: int, counters: Counter) -> None:
        if self.doc_id is None or doc_id < self.doc_id:
            for earlier, held in self.parts.items():
                counters[earlier, self.mask, self.good, self.toxic] -= held
                counters[earlier, self.mask | COPY, self.good, self.toxic] += held
            self.doc_id, self.good, self.toxic, self.parts = doc_id, good, toxic, {}
        if doc_id > self.doc_id:
            counters[part, self.mask | COPY, good, toxic] += n
        else:
            self.parts[part] = self.parts.get(part, 0) + n
            counters[part, self.mask, good, toxic] += n


def gathered(rows: DataFrame, buckets: int, held_texts: int = HELD_TEXTS) -> DataFrame:
    """For each text of a task the rows of its smallest doc_id (``first``), and counters of all others."""
    kinds = [pa.int32(), pa.string(), pa.bool_(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64()]
    names = ["bucket", "digest", "first", "doc_id", "part", "mask", "good", "toxic", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[str, Smallest] = {}
        counters: Counter = Counter()

        def flushed() -> Iterator[pa.RecordBatch]:
            # The rows that are sent on are counted by the state, and are no counters yet.
            out = []
            for digest, text in texts.items():
                bucket = int(digest[:12], 16) % buckets
                for part, n in text.parts.items():
                    counters[part, text.mask, text.good, text.toxic] -= n
                    out.append((bucket, digest, True, text.doc_id, part, text.mask, text.good, text.toxic, n))
            out += [(zlib.crc32(repr(counter).encode()) % buckets, "", False, 0, *counter, n)
                    for counter, n in counters.items() if n]
            texts.clear()
            counters.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                good, toxic = bool(row["good"]), bool(row["toxic"])
                if row["doc_id"] is None:
                    counters[row["part"], row["mask"], good, toxic] += 1
                    continue
                text = texts.get(row["digest"])
                if text is None:
                    text = texts[row["digest"]] = Smallest(row["mask"])
                text.add(row["doc_id"], row["part"], good, toxic, 1, counters)
            if len(texts) > held_texts:
                yield from flushed()
        yield from flushed()

    return rows.select("doc_id", "part", "digest", "mask", "good", "toxic").mapInArrow(run, KEYED)


def changes(keyed: DataFrame) -> DataFrame:
    """What each micro-batch changes in the counters; the smallest doc_id of each text is kept as state."""
    def update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        counters: Counter = Counter()
        held = json.loads(state.get[0]) if state.exists else {}
        texts: dict[str, Smallest] = {}
        for frame in frames:
            columns = (frame[c].tolist() for c in ("digest", "first", "doc_id", "part", "mask", "good", "toxic", "n"))
            for digest, first, doc_id, part, mask, good, toxic, n in zip(*columns):
                if not first:
                    counters[part, mask, good, toxic] += n
                    continue
                text = texts.get(digest)
                if text is None:
                    text = texts[digest] = Smallest(mask, *held.get(digest, ()))
                text.add(doc_id, part, good, toxic, n, counters)
        if texts:
            held |= {digest: (text.doc_id, text.good, text.toxic, text.parts) for digest, text in texts.items()}
            state.update((json.dumps(held, separators=(",", ":")),))
        rows = [(*counter, n) for counter, n in counters.items() if n]
        yield pd.DataFrame(rows, columns=["part", "mask", "good", "toxic", "n"])

    return keyed.groupBy("bucket").applyInPandasWithState(update, COUNTERS, STATE, "append", "NoTimeout")


def bucket_count(spark: SparkSession, path: str, folder: str) -> int:
    """Number of buckets: by the size of the table when the stream is first started, the same ever after."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    place, settled = path_of(path), path_of(f"{folder}/buckets")
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    if not settled.getFileSystem(configuration).exists(settled):
        size = place.getFileSystem(configuration).getContentSummary(place).getLength()
        number = max(1, -(-size // BUCKET_BYTES))
        spark.createDataFrame([(number,)], "buckets int").coalesce(1).write.parquet(f"{folder}/buckets")
    return spark.read.schema("buckets int").parquet(f"{folder}/buckets").first().buckets


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``good`` and ``toxic``: whether any label row of the doc_id says so."""
    marks = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("id"))
             .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    # Rows without doc_id have a key of their text, so that they do not pile up.
    keyed = rows.withColumns({"known": F.col("doc_id").isNotNull(), "id": F.coalesce("doc_id", F.xxhash64("digest"))})
    return lookup_join(keyed, marks.withColumn("known", F.lit(True)), ["known", "id"], "left")


def as_pattern(path: str) -> str:
    """A pattern that fits just the path. A stream takes a table of one file by a pattern only."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def mask_counters(spark: SparkSession, path: str, labels: DataFrame, micro_batches: int = MICRO_BATCHES,
                  folder: str | None = None) -> DataFrame:
    """``part``, ``mask``, ``good``, ``toxic`` and ``n``, the documents of the table at ``path`` that they fit.

    The stream's state and the changes of each batch are in ``folder``, by default a fresh one in the shared folder; given
    again, the stream goes on after the files it has seen. A batch that is repeated writes its changes in the same place.
    The state, about 150 bytes a text, is kept by the session's state store: Spark's own default holds it in the executors'
    memory; where that is too small set ``spark.sql.streaming.stateStore.providerClass`` to the one of RocksDB.
    """
    folder = folder or new_folder(spark, "audit")
    whole = spark.read.parquet(path)
    files = max(1, -(-len(whole.inputFiles()) // micro_batches))
    spark.createDataFrame([], COUNTERS).write.mode("overwrite").parquet(f"{folder}/changes/batch=-1")
    stream = (spark.readStream.schema(whole.schema).option("maxFileAge", ANY_AGE).option("maxFilesPerTrigger", files)
              .parquet(as_pattern(path)))
    buckets = bucket_count(spark, path, folder)
    rows = changes(gathered(labelled(described(stream), labels), buckets))

    def keep(batch: DataFrame, number: int) -> None:
        sums = batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
        sums.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")

    query = (rows.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    done = spark.read.schema(COUNTERS).parquet(f"{folder}/changes")
    return done.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")


def steps() -> list[dict]:
    """Every step of every order: its filter's bit and the bits of the filters before it."""
    return [{"filter_order": "".join(order), "step": i + 1, "own": BITS[name], "before": sum(BITS[x] for x in order[:i])}
            for order in permutations(FILTERS) for i, name in enumerate(order)]


def interactions(counters: DataFrame) -> DataFrame:
    """The report of :func:`audited` from the counters."""
    every = F.from_json(F.lit(json.dumps(steps())), "array<struct<filter_order:string,step:int,own:int,before:int>>")
    rows = counters.select("*", F.explode(every).alias("s")).select("*", "s.*")
    mask, own, before = F.col("mask"), F.col("own"), F.col("before")
    fails, earlier = mask.bitwiseAND(own) != 0, mask.bitwiseAND(before) != 0
    removed = fails & ~earlier

    def counted(which: Column) -> Column:
        return F.sum(F.when(which, F.col("n")).otherwise(0))

    orders = len(steps()) // len(FILTERS)
    # Of the filters that a document fails, each is the first in as many orders.
    first = F.when(fails, F.col("n") * F.floor(F.lit(orders) / F.bit_count(mask))).otherwise(0)
    return rows.groupBy("part", "filter_order", "step").agg(
        counted(~fails & ~earlier).alias("kept"), counted(removed).alias("removed"), counted(fails & earlier).alias("redundant"),
        counted(mask == own).alias("unique_fails"), counted(removed & F.col("good")).alias("good_lost"),
        counted(removed & F.col("toxic")).alias("toxic_lost"), F.sum(first).alias("shapley"))


def audited(spark: SparkSession, path: str, labels: DataFrame, micro_batches: int = MICRO_BATCHES) -> DataFrame:
    """What each step of every order of the filters A to E does to each part of the parquet table at ``path``.

    ``part`` (each lang, null as the empty text), ``filter_order``, ``step``, then numbers of documents: ``kept`` after the
    step, ``removed`` by it, ``redundant`` (fail its filter, were removed before), ``unique_fails`` (fail no other filter),
    ``good_lost`` and ``toxic_lost`` (removed by it, with quality = 1 or toxic = 1 in ``labels``) and ``shapley``, what its
    filter removes in all orders together. Columns used are ``doc_id``, ``text``, ``lang``, and ``doc_id``, ``quality``,
    ``toxic`` of the labels. A null text is the empty one. Repeated rows all count; rows with the same text and doc_id are
    no copies of each other. A document without doc_id has no label, is no copy and makes no copies. Of several label rows
    of a doc_id any may say it is good or toxic. An empty table gives no rows.
    """
    return interactions(mask_counters(spark, path, labels, micro_batches))
