"""Byte-level BPE by prefix dynamic programming, and back.

Ranks decide merges: of all neighbouring parts whose bytes together have a rank, the lowest rank is merged first, the
leftmost of equals before the others. The result of that on a byte string has a property which makes a table possible:
every prefix has exactly one last token, and a token may follow another just when merging the two alone would leave
them as they are. So the table holds, for each prefix, its last token; a new byte needs only the tokens that end there
and, for each, the last token of the prefix before it. Appending bytes never changes what the table holds, and after an
edit the table is the old one again as soon as its entries agree for as long as the longest token.

Texts are first cut into pieces by the tokenizer's pattern. A piece that is edited has a table of its own. Pieces that are
encoded once share one, by their prefixes, and only entries that are asked for are worked out.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import Memo, per_worker, texts_of

NO_RANK = 1 << 60
#: Stands for the nodes below one that has none.
NO_MORE: dict = {}
#: What a worker keeps between tasks, whatever it does next: some ten megabytes each.
PIECES_KEPT = 240_000
PREFIXES_KEPT = 120_000
PAIRS_KEPT = 250_000
EDGES_KEPT = 20_000
#: Pieces from this length on, in bytes, are worked out each time in a table of their own instead of being kept.
LONG_PIECE = 64
#: A piece is settled once it begins so many characters before the end of what is known: contractions look that far.
LOOK_AHEAD = 3


class Vocabulary:
    """Tokens by bytes and by rank, and which token may follow which."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.text = {rank: token for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.tokens: dict[bytes, int] = {}
        for token, rank in sorted(ranks.items(), key=lambda item: (len(item[0]), item[1])):
            if len(token) == 1:
                self.tokens[token] = rank
                continue
            halves = self._last_merge(token)
            if halves:
                self.halves[rank] = halves
                self.tokens[token] = rank
        #: Tokens by their bytes from last to first: a node is a token's rank, or -1, and the nodes of a byte more.
        self.endings: tuple[int, dict] = (-1, {})
        for token, rank in self.tokens.items():
            node = self.endings
            for byte in reversed(token[1:]):
                below = node[1].get(byte)
                if below is None or below[1] is NO_MORE:
                    below = node[1][byte] = (below[0] if below else -1, {})
                node = below
            node[1][token[0]] = (rank, node[1].get(token[0], (-1, NO_MORE))[1])
        self.longest = max(map(len, self.tokens), default=1)
        self.left = Memo(lambda rank: self._side(rank, 0), EDGES_KEPT)
        self.right = Memo(lambda rank: self._side(rank, 1), EDGES_KEPT)
        self.pairs = Memo(self._fits, PAIRS_KEPT)

    def extend(self, content: bytes, last: list[int], stop: int) -> None:
        """Append to ``last`` the last tokens of the prefixes up to the length ``stop``."""
        endings, pairs = self.endings[1], self.pairs
        for end in range(len(last), stop + 1):
            place, nodes, fitting = end - 1, endings, []
            while place >= 0:
                node = nodes.get(content[place])
                if node is None:
                    break
                token, nodes = node
                if token >= 0:
                    fitting.append((last[place] << 32 | token) if place else token - NO_RANK)
                place -= 1
            # The one valid token; longer ones are more often it.
            while (pair := fitting.pop()) >= 0 and not pairs[pair]:
                pass
            last.append(pair & 0xFFFFFFFF)

    def _last_merge(self, token: bytes) -> tuple[int, int] | None:
        """The two parts that merging the token's own bytes joins last; None if merging never arrives at it."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], NO_RANK))
            if parts[best] + parts[best + 1] not in self.ranks:
                return None
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def _side(self, rank: int, side: int) -> tuple[tuple[int, bytes, int], ...]:
        """Parts of a token on its left (0) or right (1) edge, smallest first: rank, bytes, rank of the next larger."""
        edge, above = [], NO_RANK
        while True:
            edge.append((rank, self.text[rank], above))
            if rank not in self.halves:
                return tuple(reversed(edge))
            rank, above = self.halves[rank][side], rank

    def _fits(self, pair: int) -> bool:
        """Whether merging the bytes of both tokens, one in the high and one in the low half, leaves them apart.

        Both edges grow from single bytes in the order of their ranks. At each state the two parts at the boundary would
        be merged if their rank came before the next merge on the left and not after the next one on the right.
        """
        left, right = self.right[pair >> 32], self.left[pair & 0xFFFFFFFF]
        i = j = 0
        while True:
            _, a, next_a = left[i]
            _, b, next_b = right[j]
            joined = self.ranks.get(a + b, NO_RANK)
            if joined < next_a and joined <= next_b and joined != NO_RANK:
                return False
            if next_a == next_b == NO_RANK:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1


class PrefixTable:
    """Last token of every prefix of a byte string that can be appended to and edited."""

    def __init__(self, vocabulary: Vocabulary, content: bytes = b""):
        self.vocabulary, self.content, self.last = vocabulary, b"", [0]
        self.append(content)

    def append(self, more: bytes) -> None:
        self.content += more
        self.vocabulary.extend(self.content, self.last, len(self.content))

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace ``content[start:end]``; returns how many entries were worked out anew."""
        old, shift = self.last, len(new) - (end - start)
        self.content = self.content[:start] + new + self.content[end:]
        self.last = old[:start + 1]
        same = 0
        for at in range(start + 1, len(self.content) + 1):
            self.vocabulary.extend(self.content, self.last, at)
            if at > start + len(new):
                same = same + 1 if old[at - shift] == self.last[at] else 0
                # A new entry looks back no further than the longest token, at its start and the entry there.
                if same > self.vocabulary.longest:
                    self.last += old[at - shift + 1:]
                    return at - start
        return len(self.content) - start

    def ids(self) -> list[int]:
        last, text = self.last, self.vocabulary.text
        found, end = [], len(self.content)
        while end:
            found.append(token := last[end])
            end -= len(text[token])
        found.reverse()
        return found


class Encoder:
    """Texts to ids and back, piece by piece."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.pattern = regex.compile(pattern)
        self.pieces = Memo(self._piece, PIECES_KEPT)
        self.prefixes = Memo(self._prefix, PREFIXES_KEPT)

    def _piece(self, piece: str) -> bytes:
        content = piece.encode()
        if len(content) < LONG_PIECE:
            whole = self.vocabulary.ranks.get(content)
            return self.prefixes[content] if whole is None else struct.pack("<I", whole)
        found = self.table_ids(PrefixTable(self.vocabulary, content))
        return struct.pack(f"<{len(found)}I", *found)

    def _prefix(self, content: bytes) -> bytes:
        """Ids of a prefix: those of what is before its last token, and that token."""
        tokens, size = self.vocabulary.tokens, len(content)
        # The one valid token; longer ones are more often it.
        for start in range(max(0, size - self.vocabulary.longest), size):
            token = tokens.get(content[start:])
            if token is None:
                continue
            if not start:
                return struct.pack("<I", token)
            before = self.prefixes[content[:start]]
            if self.vocabulary.pairs[int.from_bytes(before[-4:], "little") << 32 | token]:
                return before + struct.pack("<I", token)
        raise ValueError("no token ends here")

    def table_ids(self, table: PrefixTable) -> list[int]:
        whole = self.vocabulary.ranks.get(table.content)
        return [whole] if whole is not None else table.ids()

    def packed(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        kept = self.pieces
        return b"".join([kept[piece] if len(piece) < LONG_PIECE else self._piece(piece)
                         for piece in self.pattern.findall(text)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class EncodedText:
    """A text whose ids stay right while it is appended to and edited; only pieces that change are cut and encoded."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text = encoder, ""
        self.starts: list[int] = []
        self.tables: list[PrefixTable] = []
        self.append(text)

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace ``text[start:end]``. Pieces before the edit that it cannot reach stay, as do those after it from the
        first that begins where an old one did."""
        keep = 0
        while keep + 1 < len(self.starts) and self.starts[keep + 1] <= start - LOOK_AHEAD:
            keep += 1
        begin, shift = (self.starts[keep] if self.starts else 0), len(new) - (end - start)
        old = {at + shift: i for i, at in enumerate(self.starts) if at >= end}
        self.text = self.text[:start] + new + self.text[end:]
        starts, tables = self.starts[:keep], self.tables[:keep]
        for match in self.encoder.pattern.finditer(self.text, begin):
            at = match.start()
            if at >= start + len(new) and at in old:
                starts += [place + shift for place in self.starts[old[at]:]]
                tables += self.tables[old[at]:]
                break
            content, same = match[0].encode(), len(tables)
            table = self.tables[same] if same < len(self.tables) and at <= start else None
            if table is not None and self.starts[same] == at and content.startswith(table.content):
                table.append(content[len(table.content):])
            else:
                table = PrefixTable(self.encoder.vocabulary, content)
            starts.append(at)
            tables.append(table)
        self.starts, self.tables = starts, tables

    def ids(self) -> list[int]:
        return [rank for table in self.tables for rank in self.encoder.table_ids(table)]


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a token in base64 and its rank in each line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


def encoded(spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (array of int), ``ids_sha256`` and ``decoded_sha256`` for each row of ``docs``.

    The ids are those of the whole text by the ranks, each match of the pattern apart, without special tokens; then they
    are decoded again. ``ids_sha256`` is over the ids as little-endian unsigned 32-bit numbers, ``decoded_sha256`` over
    the decoded bytes. A null text counts as the empty one, which has no ids. Rows are independent: repeated rows and
    null doc_ids each keep theirs, and only ``doc_id`` and ``text`` are used.
    """
    with open(ranks_path, "rb") as file:
        content = file.read()
    key = ("encoder", hashlib.sha256(content).hexdigest(), pattern)
    vocabulary = spark.sparkContext.broadcast(content)  # one file of some MB, whatever the documents

    @F.arrow_udf("n_tokens bigint, ids array<int>, ids_sha256 string, decoded_sha256 string")
    def run(column: pa.Array) -> pa.Array:
        encoder = per_worker(key, lambda: Encoder(read_ranks(vocabulary.value), pattern))
        counts, lists, digests, decoded = [], [], [], []
        for text in texts_of(column):
            ids = encoder.packed(text.decode())
            counts.append(len(ids) // 4)
            lists.append(np.frombuffer(ids, "<i4"))
            digests.append(hashlib.sha256(ids).hexdigest())
            decoded.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        values = np.concatenate(lists) if lists else np.empty(0, np.int32)
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32())),
             pa.array(digests, pa.string()), pa.array(decoded, pa.string())],
            ["n_tokens", "ids", "ids_sha256", "decoded_sha256"])

    done = docs.select("doc_id", run(F.col("text").cast("string")).alias("of"))
    return done.select("doc_id", "of.n_tokens", "of.ids", "of.ids_sha256", "of.decoded_sha256")
