"""Token counts by merging byte pairs over a heap and a linked list, without making ids.

The symbols of a piece are a doubly linked list. A heap holds each neighbouring pair that has a merge, by the merge's
rank and then by place. The lowest is popped again and again; a pair whose symbols have changed since is passed over. A
merge takes one symbol out of the list and puts at most two new pairs on the heap, so a piece of n bytes takes at most
in proportion to n log n. The count is the number of bytes less the number of merges.
"""

from __future__ import annotations

import hashlib
import json
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import Memo, per_worker, texts_of

PIECES_KEPT = 600_000
#: Pieces from this length on are counted each time instead of being kept.
LONG_PIECE = 64


def byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in the files of byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(others)}


class Counter:
    """Counts of texts by the merges of one vocabulary; ``content`` is its JSON file."""

    def __init__(self, content: bytes, pattern: str):
        described = json.loads(content)
        letters, vocabulary = byte_letters(), described["model"]["vocab"]
        self.symbol_of_byte = [0] * 256
        for letter, byte in letters.items():
            self.symbol_of_byte[byte] = vocabulary[letter]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(described["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.merges.setdefault((vocabulary[left], vocabulary[right]), (rank, vocabulary[left + right]))
        special = sorted((token["content"] for token in described.get("added_tokens", [])), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern = regex.compile(pattern)
        self.pieces = Memo(lambda piece: self.count_bytes(piece.encode()), PIECES_KEPT)

    def count_bytes(self, piece: bytes) -> int:
        size, merges = len(piece), self.merges
        if size < 2:
            return size
        symbols = [self.symbol_of_byte[byte] for byte in piece]
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(found[0], i, found[1], symbols[i], symbols[i + 1]) for i in range(size - 1)
                if (found := merges.get((symbols[i], symbols[i + 1])))]
        heapify(heap)
        count = size
        while heap:
            _, i, made, left, right = heappop(heap)
            j = after[i] if symbols[i] == left else size
            if j >= size or symbols[j] != right:
                continue
            symbols[i], symbols[j] = made, -1
            k = after[i] = after[j]
            count -= 1
            if k < size:
                before[k] = i
                if found := merges.get((made, symbols[k])):
                    heappush(heap, (found[0], i, found[1], made, symbols[k]))
            h = before[i]
            if h >= 0 and (found := merges.get((symbols[h], made))):
                heappush(heap, (found[0], h, found[1], symbols[h], made))
        return count

    def count(self, text: str) -> int:
        """Tokens of a text; a special string in it is one token, and what lies between is counted apart."""
        if self.special is None or not self.special.search(text):
            return self._between(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._between, parts))

    def _between(self, text: str) -> int:
        kept = self.pieces
        return sum([kept[piece] if len(piece) < LONG_PIECE else kept.compute(piece)
                    for piece in self.pattern.findall(text)])


def token_counts(spark: SparkSession, docs: DataFrame, vocabulary_path: str, pattern: str,
                 limit: int = 512) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` for each row of ``docs``.

    Whole texts are counted. A null text counts as the empty one: no bytes, no tokens. Rows are independent: repeated
    rows and null doc_ids each keep theirs, and only ``doc_id`` and ``text`` are used.
    """
    with open(vocabulary_path, "rb") as file:
        content = file.read()
    key = ("counter", hashlib.sha256(content).hexdigest(), pattern)
    vocabulary = spark.sparkContext.broadcast(content)  # one file of some MB, whatever the documents

    @F.arrow_udf("bigint")
    def run(column: pa.Array) -> pa.Array:
        counter = per_worker(key, lambda: Counter(vocabulary.value, pattern))
        return pa.array((counter.count(text.decode()) for text in texts_of(column)), pa.int64())

    text = F.col("text").cast("string")
    counted = docs.select("doc_id", F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
                          run(text).alias("n_tokens"))
    return counted.select("*", (F.col("n_tokens") > limit).alias("over_limit"))
