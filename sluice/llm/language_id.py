"""Language identification with string kernels.

Two texts are as alike as the character n-grams they share: the blended-spectrum presence kernel counts the different
n-grams of one to three letters that occur in both, over the root of the product of their own numbers. Landmark texts
span the kernel's space (Nyström), and a ridge regression in that space tells each language from the rest. A text is
scored by one product of its batch's presence matrix with the landmarks' and one with the weights.

N-grams are those that occur in a landmark; others meet no landmark and change no comparison. Which of a text's own n-grams
do tells whether the model can place the text at all: its support. Letters of all scripts count as themselves, in lower
case; anything between words is one boundary sign.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import packed, per_worker, unpacked
from sluice.operators.joins import lookup_join, settle

UNKNOWN = "und"
#: Rows of the training sample, shared evenly between languages, and the longest text in it, in characters.
SAMPLE_ROWS = 1600
SAMPLE_CHARS = 20_000
LANDMARKS = 128
RIDGE = 1e-4
#: Share of a text's own n-grams, up to this length, that landmarks have to have, for the text to be in a known language.
#: Longer ones are too many in scripts of thousands of letters for landmarks to have most of them.
SUPPORT = 0.3
SUPPORT_LENGTH = 2
#: Bits of a sign, which is a letter's code or, between words, 0.
SIGN_BITS = 21
BLOCK = 1 << 20
BATCH = 256


@dataclass
class Model:
    languages: list[str]
    grams: list[np.ndarray]
    landmarks: np.ndarray
    weights: np.ndarray


class Presence:
    """Which n-grams of one, two and three signs a text has."""

    def __init__(self):
        # Letters stand for themselves; all other codes are boundaries.
        self.letters = np.array([not 0xD800 <= code < 0xE000 and chr(code).isalpha() for code in range(0x110000)])

    def grams(self, text: str) -> list[np.ndarray]:
        """The different n-grams of each length, in order."""
        found: list[list[np.ndarray]] = [[], [], []]
        for start in range(0, max(1, len(text)), BLOCK):
            codes = np.frombuffer(text[start:start + BLOCK + 2].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
            signs = np.where(self.letters[codes], codes, 0).astype(np.int64)
            # Boundaries next to each other say no more than one.
            signs = signs[np.flatnonzero((signs != 0) | (np.append(start, signs[:-1]) != 0))] if len(signs) else signs
            for n, parts in enumerate(found):
                own = signs[:max(0, len(signs) - n)]
                for i in range(1, n + 1):
                    own = own << SIGN_BITS | signs[i:len(signs) - n + i]
                parts.append(np.unique(own))
        whole = [parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts)) for parts in found]
        return [own[own != 0] for own in whole]

    def matrix(self, texts: list[str], grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Presence of the given n-grams, and the share of each text's own short ones that are among them."""
        ends = np.cumsum([0, *map(len, grams)])
        found, support = np.zeros((len(texts), ends[-1]), np.float32), np.zeros(len(texts))
        for row, text in enumerate(texts):
            known = total = 0
            for n, (start, wanted, own) in enumerate(zip(ends, grams, self.grams(text)), 1):
                counts = n <= SUPPORT_LENGTH
                total += counts * len(own)
                if len(wanted) and len(own):
                    place = np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)
                    place = place[wanted[place] == own]
                    found[row, start + place] = 1
                    known += counts * len(place)
            support[row] = known / total if total else 0.0
        return found, support


def kernel(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    own = np.sqrt(np.maximum(1, rows.sum(1)))[:, None] * np.sqrt(np.maximum(1, landmarks.sum(1)))[None, :]
    return rows @ landmarks.T / own


def fit_model(texts: list[str], languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """One-versus-rest ridge regression over landmarks, which are taken from the languages in turn."""
    if not texts:
        return None
    names = sorted(set(languages))
    by_language = [[t for t, name in zip(texts, languages) if name == own] for own in names]
    turns = [own[i] for i in range(max(map(len, by_language))) for own in by_language if i < len(own)]
    chosen, presence = turns[:landmarks], Presence()
    grams = [np.unique(np.concatenate(own)) for own in zip(*(presence.grams(text) for text in chosen))]
    spanning, _ = presence.matrix(chosen, grams)
    values, vectors = np.linalg.eigh(kernel(spanning, spanning).astype(np.float64))
    keep = values > 1e-6 * max(values.max(), 1e-12)
    root = vectors[:, keep] / np.sqrt(values[keep])
    mapped = np.concatenate([kernel(presence.matrix(texts[i:i + BATCH], grams)[0], spanning)
                             for i in range(0, len(texts), BATCH)]).astype(np.float64) @ root
    targets = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    weights = np.linalg.solve(mapped.T @ mapped + ridge * len(texts) * np.eye(mapped.shape[1]), mapped.T @ targets)
    return Model(names, grams, spanning, (root @ weights).astype(np.float32))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; false where there is no doc_id, whose rows are not learned from either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """At most ``rows`` labelled texts outside the held-out part, as many for each language.

    Which rows is settled by a hash of doc_id and text. As many of each language have a low hash as are surely enough,
    however many it has; only their keys are ranked, and only the chosen texts are gathered. Texts longer than ``chars``
    are left to the others, so the sample's size is bounded.
    """
    labelled = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    labelled = labelled.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
                              & F.length("text").between(1, chars))
    order = F.xxhash64(F.col("doc_id").cast("string"), "text")
    keys = labelled.select("doc_id", "lang", order.alias("order"))
    counts = settle(keys.groupBy("lang").agg(F.count("*").alias("n")))
    each = max(1, rows // max(1, counts.count()))
    low = (F.col("order") / float(1 << 63) + 1) / 2 * F.col("n") <= 4 * each + 64
    some = lookup_join(keys, counts, ["lang"], "inner").where(low).select(*keys.columns).distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id"))
    chosen = some.withColumn("place", place).where(F.col("place") <= each).limit(rows)
    return (labelled.withColumn("order", order).join(F.broadcast(chosen), keys.columns)
            .select("text", "lang", "place", "doc_id").distinct().orderBy("place", "lang", "doc_id").limit(rows))


def predictions(spark: SparkSession, model: Model | None, text: Column) -> Column:
    """Struct of ``lang_pred``, ``score`` and ``support``, from the text alone."""
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("support"))
    # Landmarks are limited by parameters, and so is the size of the model.
    shared = spark.sparkContext.broadcast(vars(model))

    @F.arrow_udf("lang_pred string, score double, support double")
    def predict(column: pa.Array) -> pa.Array:
        model, presence = Model(**shared.value), per_worker(("letters",), Presence)
        letter = regex.compile(r"\p{L}")
        names, scores, supports, values = [], [], [], iter(column)
        while batch := [v.as_py() or "" for v in islice(values, BATCH)]:
            rows, support = presence.matrix(batch, model.grams)
            found = kernel(rows, model.landmarks) @ model.weights
            best = found.argmax(1)
            for text, i, row, share in zip(batch, best.tolist(), found, support.tolist()):
                known = letter.search(text) is not None
                names.append(model.languages[i] if known else UNKNOWN)
                scores.append(round(min(1.0, max(0.0, (float(row[i]) + 1) / 2)), 6) if known else 0.0)
                supports.append(round(share, 6))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                                           pa.array(supports, pa.float64())], ["lang_pred", "score", "support"])

    return predict(text.cast("string"))


def learned(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Model | None:
    sample = training_sample(docs, rows, chars).collect()
    return fit_model([row["text"] for row in sample], [row["lang"] for row in sample])


def identified(spark: SparkSession, docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` (0 to 1) for each row of ``docs``.

    Learns from ``text`` and ``lang`` of at most ``sample_rows`` rows whose doc_id is not held out; predicts from the
    whole text alone. ``und``, with score 0, for a null text, one without a letter, and for all rows where there is
    nothing to learn from. Of equal scores the first language by name counts. Repeated rows each keep their row; rows
    without doc_id are neither learned from nor held out.
    """
    of = predictions(spark, learned(docs, sample_rows), F.col("text")).alias("of")
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), of)
            .select("doc_id", "held_out", "of.lang_pred", "of.score"))


def in_known_language(spark: SparkSession, docs: DataFrame, sample_rows: int = SAMPLE_ROWS, support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that are in a language the model knows, in their own columns.

    Rejected are texts without a letter and those that the landmarks of no language support: of whose n-grams less than
    ``support`` occur in any of them, as in another script. A set without
    any labelled row to learn from is returned whole but for texts without a letter.
    """
    model = learned(docs, sample_rows)
    rows = packed(docs)
    if model is None:
        return unpacked(rows.where(F.coalesce(F.col("row.text").cast("string").rlike(r"\p{L}"), F.lit(False))))
    return unpacked(rows.withColumn("of", predictions(spark, model, F.col("row.text")))
                    .where((F.col("of.lang_pred") != UNKNOWN) & (F.col("of.support") >= support)))
