"""Exact top-k search by inner product over an impact-ordered index, one score at a time.

Vectors become whole numbers. The index is cut into blocks of rows; a block keeps, for each component, its rows in falling
order of that component's value, cut into segments of equal quantised value. A segment's impact on a query is the most that
it can add to a score. A query takes the segments of a block by falling impact, all components together, and adds what
they hold to the rows' scores. No component that a row still lacks can add more than the next impact, so a row's score is
at most what it has plus that many times the next impact. The exact scores of the leading rows give the mark to reach.
The search stops once few rows can still reach it - that is the proof - and these are scored exactly. Until then it goes
on, at worst through all segments; so the result is exact always, and only the work depends on the data.

Blocks of queries meet blocks of rows, each pair in a group of its own, and hand on their best k; the best of these are
the result. Nothing is collected or broadcast.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.operators.joins import settle

SCALE = 256
TOP = 5
EVERY = 50
#: Rows of an index block and queries of a query block, about; values that a segment spans.
BLOCK_ROWS = 8192
BLOCK_QUERIES = 512
SEGMENT = 8
#: Times that the bounds are looked at, after equal parts of a block's postings.
ROUNDS = 8
LONG = (1 << 63) - 1
#: Up to here doubles hold whole numbers exactly, and from here on they hold no others.
EXACT = 1 << 53


def whole_numbers(vectors: pa.Array) -> np.ndarray:
    """Rows of floor(256 x), as doubles; shorter vectors are filled up with zeros. Python's numbers where doubles fail."""
    offsets, values = np.asarray(vectors.offsets), vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
    sizes, first = np.diff(offsets), offsets[0]
    width = int(sizes.max(initial=0))
    if SCALE * float(np.abs(values).max(initial=0)) < EXACT:
        out, values = np.zeros((len(sizes), width)), np.floor(SCALE * values)
    else:
        whole = [math.floor(SCALE * v) if abs(v) < EXACT else SCALE * int(v) for v in values]
        out, values = np.zeros((len(sizes), width), object), np.array(whole, object)
    if len(sizes) and (sizes == width).all():
        return values[first:offsets[-1]].reshape(len(sizes), width)
    for row, start, end in zip(out, offsets, offsets[1:]):
        row[:end - start] = values[start:end]
    return out


def sums_fit(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether doubles hold every sum of products exactly."""
    if a.dtype == object or b.dtype == object:
        return False
    most = [int(np.abs(m).max(initial=0)) for m in (a, b)]
    return 2 * most[0] * most[1] * max(1, a.shape[1]) < EXACT


class Index:
    """Postings of a block of rows: per component the rows by falling value, and where its segments begin."""

    def __init__(self, rows: np.ndarray, segment: int = SEGMENT):
        self.rows, (self.size, self.width) = rows, rows.shape
        # Rows of a segment are in their own order, which is the quicker way through their scores.
        levels = rows // segment
        self.order = np.ascontiguousarray(np.argsort(-levels, axis=0, kind="stable").T)
        self.values = np.ascontiguousarray(np.take_along_axis(rows.T, self.order, axis=1))
        starts, ends, dims, most, least = [], [], [], [], []
        for dim, values in enumerate(self.values):
            level = levels[self.order[dim], dim]
            start = np.concatenate([[0], np.flatnonzero(level[1:] != level[:-1]) + 1])
            starts.append(start)
            ends.append(np.concatenate([start[1:], [self.size]]))
            dims.append(np.full(len(start), dim))
            most.append(np.maximum.reduceat(values, start))
            least.append(np.minimum.reduceat(values, start))
        empty = [np.empty(0, np.intp)]
        self.starts, self.ends, self.dims = (np.concatenate(parts or empty).astype(np.intp) for parts in (starts, ends, dims))
        self.most, self.least = (np.concatenate(parts or empty) for parts in (most, least))
        #: Segments before each component's first one.
        self.before = np.searchsorted(self.dims, np.arange(self.width + 1))

    def search(self, query: np.ndarray, own: np.ndarray, ids: list, top: int) -> list[tuple[int, int]]:
        """Places and scores of the best ``top`` rows but ``own``; of equal scores the smaller of ``ids``."""
        impact = np.maximum(query[self.dims] * self.most, query[self.dims] * self.least)
        # What a query lacks adds nothing, and needs no segment.
        wanted = np.flatnonzero(query[self.dims] != 0)
        turn = wanted[np.argsort(-impact[wanted], kind="stable")]
        postings = np.cumsum((self.ends - self.starts)[turn])
        total = int(postings[-1]) if len(postings) else 0
        reached = np.zeros(self.size, self.rows.dtype)
        lacking = np.full(self.size, int((query != 0).sum()), np.intp)
        others = np.ones(self.size, bool)
        others[own] = False
        taken = np.zeros(self.width, np.intp)
        possible = np.flatnonzero(others)
        for step in range(1, ROUNDS + 1):
            done = min(len(turn), int(np.searchsorted(postings, step * total / ROUNDS)) + 1)
            now = np.bincount(self.dims[turn[:done]], minlength=self.width)
            self.add(query, taken, now, reached, lacking)
            taken = now
            mark = self.mark(query, reached, others, top)
            if mark is None:
                break
            left = lacking.astype(reached.dtype) * impact[turn[done]] if done < len(turn) else 0
            possible = np.flatnonzero(others & (reached + left >= mark))
            # All others are proven to be out. These are scored when they have fewer components than there are postings left.
            if done == len(turn) or len(possible) * self.width <= total - postings[done - 1]:
                break
        scores = np.clip(self.rows[possible] @ query, -LONG - 1, LONG)
        if len(scores) > top:
            most = scores >= np.sort(scores)[-top]
            possible, scores = possible[most], scores[most]
        best = sorted(((i, int(score)) for i, score in zip(possible.tolist(), scores.tolist())),
                      key=lambda found: (-found[1], ids[found[0]]))
        return best[:top]

    def add(self, query: np.ndarray, taken: np.ndarray, now: np.ndarray, reached: np.ndarray, lacking: np.ndarray) -> None:
        """Add what the segments from ``taken`` up to ``now`` of each component hold; a negative query takes the last first."""
        rows, added = [], []
        for dim in np.flatnonzero(now > taken).tolist():
            first, last = self.before[dim], self.before[dim + 1]
            if query[dim] > 0:
                stretch = slice(self.starts[first + taken[dim]], self.ends[first + now[dim] - 1])
            else:
                stretch = slice(self.starts[last - now[dim]], self.ends[last - taken[dim] - 1])
            rows.append(self.order[dim, stretch])
            added.append(query[dim] * self.values[dim, stretch])
        if not rows:
            return
        rows, added = np.concatenate(rows), np.concatenate(added)
        lacking -= np.bincount(rows, minlength=self.size)
        if reached.dtype == object:
            np.add.at(reached, rows, added)
        else:
            reached += np.bincount(rows, weights=added, minlength=self.size)

    def mark(self, query: np.ndarray, reached: np.ndarray, others: np.ndarray, top: int):
        """A score that ``top`` rows are known to have at least, or none if there are fewer rows."""
        open_rows = np.flatnonzero(others)
        if len(open_rows) < top:
            return None
        leading = open_rows[np.argpartition(-reached[open_rows], min(4 * top, len(open_rows)) - 1)[:4 * top]]
        return min(LONG, int(np.sort(self.rows[leading] @ query)[-top]))


def dealt(vectors: DataFrame, block: str, size: int) -> DataFrame:
    """Rows with the number of their block; blocks are of about equal size whatever the ids are."""
    blocks = max(1, -(-vectors.count() // size))
    return vectors.withColumn(block, F.pmod(F.xxhash64("row_no"), F.lit(blocks)).cast("int"))


def nearest(vectors: DataFrame, top: int = TOP, every: int = EVERY, block_rows: int = BLOCK_ROWS,
            block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``top`` rows of the largest inner product per query.

    Queries are the rows whose vec_id is divisible by ``every``; candidates are all rows but the query's own, and all of
    them if there are fewer than ``top``. Only ``vec_id`` and ``embedding`` are used. Vectors that are null or hold a null
    or non-finite component take no part; shorter vectors count as filled up with zeros, so an empty one scores 0 with any.
    Equal scores are ranked by vec_id, null last. Rows of a repeated vec_id are rows of their own: each is a query if the
    id is divisible, and a candidate for the other. Scores beyond 64 bits count as the largest or smallest long.
    No vectors give no rows.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    rows = settle(vectors.select("vec_id", F.col("embedding").cast(kind).alias("embedding"))
                  .where(F.col("embedding").isNotNull() & finite)
                  .select(F.monotonically_increasing_id().alias("row_no"), F.col("vec_id").cast("bigint").alias("vec_id"),
                          "embedding"))
    index = dealt(rows, "block", block_rows)
    blocks = index.agg(F.max("block")).first()[0]
    queries = dealt(rows.where(F.col("vec_id") % every == 0), "lot", block_queries)
    lots = queries.agg(F.max("lot")).first()[0]
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks or 0))).alias("block")
    each_lot = F.explode(F.sequence(F.lit(0), F.lit(lots or 0))).alias("lot")
    found = (index.select("*", each_lot).groupBy("block", "lot")
             .cogroup(queries.select("*", each_block).groupBy("block", "lot"))
             .applyInArrow(best_of_block(top), "query_no bigint, query_id bigint, vec_id bigint, score bigint"))
    order = F.row_number().over(Window.partitionBy("query_no").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return (found.withColumn("rank", order).where(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))


def best_of_block(top: int):
    """The search of a block of queries in a block of rows."""
    kinds = {"query_no": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64()}

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if rows.num_rows and queries.num_rows:
            numbers, asked = (whole_numbers(t["embedding"].combine_chunks()) for t in (rows, queries))
            width, own = max(numbers.shape[1], asked.shape[1]), rows["row_no"].to_numpy()
            if not sums_fit(numbers, asked):
                numbers, asked = (np.vectorize(int, otypes=[object])(m) for m in (numbers, asked))
            numbers, asked = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (numbers, asked))
            index, ids = Index(numbers), rows["vec_id"].to_pylist()
            ids = [(i is None, i or 0) for i in ids]
            for number, query_id, query in zip(queries["row_no"].to_pylist(), queries["vec_id"].to_pylist(), asked):
                found += [(number, query_id, None if ids[i][0] else ids[i][1], score)
                          for i, score in index.search(query, np.flatnonzero(own == number), ids, top)]
        return pa.table({name: pa.array([f[i] for f in found], kind) for i, (name, kind) in enumerate(kinds.items())})

    return search
