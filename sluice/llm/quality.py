"""Quality rules: fixed ones, and robust outliers within each language and source.

Each document has a vector of four transformed statistics. Per language and source, the minimum covariance determinant
tells what is usual there: of all subsets of about half of the documents, the one with the smallest determinant of its
covariance, which no smaller group of copies can sway. It is approached from two starts by concentration steps - estimate
from the subset, take the documents that are nearest by Mahalanobis distance as the next one - and the start with the
smaller determinant counts. As half of the documents say little of the spread of all, the estimate is then made again from
every document that is not far by it. Documents too far from the centre are rejected.

All of it is DataFrame operations. Vectors are whole thousandths and their sums exact, and the nearest part of a group is
found from counts of distances by fine steps, so results depend neither on the order of rows nor on how they are dealt out,
and a group of any size comes down to its sums and counts in each task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import BLANKS
from sluice.operators.joins import lookup_join, settle

WINDOW_WORDS = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"

#: Statistics of the vectors, and for each a spread below which differences are never held against a document: some
#: documents of any source have a repeated line, a quotation or long words.
SPREADS = {"word_length": 0.03, "symbols": 0.04, "dup_lines": 0.15, "repeats": 0.15}
UNIT = 1000
STEPS = 4
#: Documents below which those of a source are held against their whole language, and a language has no estimate.
LEAST_DOCS = 40
DEFINED = len(SPREADS) + 1
#: Squared distance that one in ten thousand of normally distributed vectors exceeds, and the median of such distances.
CUTOFF = 23.513
MEDIAN = 3.357
#: Squared distance that one in forty exceeds: documents beyond it do not count when the estimate is made again. Leaving
#: them out makes the covariance of normal vectors smaller by the last factor.
WEIGHED = 11.143
WEIGHED_SHRINK = 1.065
FINE = 64
DIMS = range(len(SPREADS))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression over a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column, size: int = WINDOW_WORDS) -> Column:
    """Words inside windows that occur twice or more, from a column that holds the array of words.

    Windows are told apart by a 64-bit hash. Most texts have as many different windows as windows; only for others are
    hashes sorted with their places, so that equal ones are neighbours, and the places merged.
    """
    hashes = F.transform(F.slice(words, F.lit(1), F.greatest(F.lit(0), F.size(words) - (size - 1))),
                         lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, size))))

    def places(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, i: (F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)))
                     | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"])))

    def covered(p: Column) -> Column:
        return F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(size), F.coalesce(F.get(p, j + 1) - x, F.lit(size)))),
                           F.lit(0).cast("bigint"), lambda n, step: n + step)

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint"))
               .otherwise(let(places(h), covered)))


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``source`` and the counts of each whole text, with ``n_lines``, those that have a word."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                       text.alias("text"))
    cut = rows.select("*", F.array_remove(F.split("text", BLANKS, -1), "").alias("words"),
                      F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    return cut.select(
        "doc_id", "lang", "source", F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"), F.size("lines").alias("n_lines"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def vector() -> list[Column]:
    """Thousandths of: log of the mean word length, and roots of the shares of symbols, repeated lines, repeated words.

    Shares of little text are drawn to what is usual by words, characters and lines added to each text.
    """
    values = [F.log((F.col("word_chars") + 250) / (F.col("n_words") + 50)),
              F.sqrt(F.col("n_symbols") / (F.col("word_chars") + 250)),
              F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 10)),
              F.sqrt(F.col("n_repeat_words") / (F.col("n_words") + 50))]
    return [F.round(value * UNIT).cast("bigint").alias(f"x{i}") for i, value in enumerate(values)]


def grouped(stats: DataFrame) -> DataFrame:
    """Adds ``g``, what a document is held against: its language and source, or its language where the source is small.

    Only documents that pass the fixed rules count. ``g`` is null in a language with too few of them for an estimate.
    """
    source, language = F.to_json(F.struct("lang", "source")), F.to_json(F.struct("lang"))
    counts = (stats.where(~F.col("base_failed")).groupBy("lang", "source").agg(F.count("*").alias("n"))
              .select("n", source.alias("own"), language.alias("whole")))
    whole = counts.groupBy("whole").agg(F.sum("n").alias("n_whole"))
    names = counts.join(whole, "whole").select("own", F.when(F.col("n") >= LEAST_DOCS, F.col("own"))
                                               .when(F.col("n_whole") >= DEFINED, named_whole(F.col("whole"))).alias("g"))
    return lookup_join(stats.withColumn("own", source), names, ["own"], "left").drop("own")


def named_whole(language: Column) -> Column:
    return F.concat(F.lit("all "), language)


def learned_from(stats: DataFrame) -> DataFrame:
    """The rows that estimates are made from, with ``g``: once for their source, once for their language where needed."""
    passing = stats.where("NOT base_failed")
    own = passing.where(F.col("g") == F.to_json(F.struct("lang", "source")))
    language = named_whole(F.to_json(F.struct("lang")))
    needed = passing.where(F.col("g") == language).select("g").distinct()
    every = lookup_join(passing.withColumn("g", language), needed, ["g"], "left_semi")
    return own.unionByName(every.select(own.columns))


def half(every: Column) -> Column:
    """The larger half of so many rows."""
    return F.ceil(every / 2)


def subset(every: Column) -> Column:
    """Size of the subset that the most outliers cannot sway: half of the rows, of the statistics and one."""
    return F.least(every, F.floor((every + len(SPREADS) + 1) / 2))


def quantile(counts: DataFrame, by: list[str], rows: Callable[[Column], Column] = half) -> DataFrame:
    """The smallest ``v`` that at least ``rows`` of each group's rows do not exceed; counts has ``by``, ``v``, ``n``."""
    upto = Window.partitionBy(*by).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(*by)
    return (counts.select("*", F.sum("n").over(upto).alias("upto"), F.sum("n").over(every).alias("all"))
            .where(F.col("upto") >= rows(F.col("all"))).groupBy(*by).agg(F.min("v").alias("v")))


def fine(distance: Column) -> Column:
    """Steps of about one and a half per cent."""
    return F.floor(F.log1p(distance) * FINE).cast("int")


def starts(points: DataFrame) -> DataFrame:
    """Each vector twice, with ``start`` and the step ``v`` of its distance from the medians, in median deviations.

    Distances of the first start add up over the statistics, those of the second are the largest of them.
    """
    long = points.select("g", F.explode(F.array(*(F.struct(F.lit(i).alias("dim"), F.col(f"x{i}").alias("v"))
                                                  for i in DIMS))).alias("p")).select("g", "p.*")
    counts = settle(long.groupBy("g", "dim", "v").agg(F.count("*").alias("n")))
    middle = quantile(counts, ["g", "dim"]).withColumnRenamed("v", "m")
    off = counts.join(middle, ["g", "dim"]).groupBy("g", "dim", "m", F.abs(F.col("v") - F.col("m")).alias("v")).agg(
        F.sum("n").alias("n"))
    spread = quantile(off, ["g", "dim", "m"])
    rows = spread.groupBy("g").agg(*(F.max(F.when(F.col("dim") == i, F.struct("m", "v"))).alias(f"c{i}") for i in DIMS))
    each = [F.pow((F.col(f"x{i}") - F.col(f"c{i}.m"))
                  / F.greatest(1.4826 * F.col(f"c{i}.v"), F.lit(floor * UNIT)), 2)
            for i, floor in enumerate(SPREADS.values())]
    both = F.array(F.struct(F.lit(0).alias("start"), fine(sum(each[1:], each[0])).alias("v")),
                   F.struct(F.lit(1).alias("start"), fine(F.greatest(*each)).alias("v")))
    return (points.join(settle(rows), "g").select("g", *(f"x{i}" for i in DIMS), F.explode(both).alias("s"))
            .select("g", *(f"x{i}" for i in DIMS), "s.*"))


def nearest(ranked: DataFrame) -> DataFrame:
    """Rows within the distance that the subset of their group does not exceed."""
    keys = [c for c in ("g", "start") if c in ranked.columns]
    bound = quantile(ranked.groupBy(*keys, "v").agg(F.count("*").alias("n")), keys, subset).withColumnRenamed("v", "bound")
    return ranked.join(settle(bound), keys).where(F.col("v") <= F.col("bound"))


def estimates(subset: DataFrame) -> DataFrame:
    """For each group and start: means ``mu``, the triangular root ``l`` of the covariance, log of its determinant."""
    n, pairs = F.col("n"), [(i, j) for i in DIMS for j in range(i + 1)]
    total = subset.groupBy("g", "start").agg(
        F.count("*").cast("double").alias("n"),
        *(F.sum(F.col(f"x{i}").cast("decimal(20,0)")).cast("double").alias(f"s{i}") for i in DIMS),
        *(F.sum((F.col(f"x{i}") * F.col(f"x{j}")).cast("decimal(20,0)")).cast("double").alias(f"p{i}{j}")
          for i, j in pairs))
    floors = [(floor * UNIT) ** 2 for floor in SPREADS.values()]
    now = total.select("g", "start", "n", *((F.col(f"s{i}") / n).alias(f"mu{i}") for i in DIMS), *(
        (F.greatest(F.lit(0.0), F.col(f"p{i}{j}") / n - F.col(f"s{i}") * F.col(f"s{j}") / (n * n)) + floors[i] if i == j
         else F.col(f"p{i}{j}") / n - F.col(f"s{i}") * F.col(f"s{j}") / (n * n)).alias(f"c{i}{j}") for i, j in pairs))
    # Cholesky's rows from the top; what is added to the diagonal keeps the roots real.
    for i, j in pairs:
        inner = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        now = now.withColumn(f"l{i}{j}", F.sqrt(F.greatest(F.col(f"c{i}{i}") - inner, F.lit(1.0))) if i == j
                             else (F.col(f"c{i}{j}") - inner) / F.col(f"l{j}{j}"))
    det = sum((F.log(f"l{i}{i}") for i in DIMS), F.lit(0.0))
    return settle(now.select("g", "start", *(f"mu{i}" for i in DIMS), *(f"l{i}{j}" for i, j in pairs), det.alias("det"), "n"))


def distanced(points: DataFrame) -> DataFrame:
    """Adds ``d2``, the squared Mahalanobis distance by the estimates that the rows have been joined with."""
    for i in DIMS:
        inner = sum((F.col(f"l{i}{k}") * F.col(f"y{k}") for k in range(i)), F.lit(0.0))
        points = points.withColumn(f"y{i}", (F.col(f"x{i}") - F.col(f"mu{i}") - inner) / F.col(f"l{i}{i}"))
    return points.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in DIMS), F.lit(0.0)))


def scaled(points: DataFrame, model: DataFrame) -> DataFrame:
    """The estimates with ``scale``, which makes the group's median distance that of normal vectors where it is larger."""
    counts = (distanced(points.join(model, "g")).groupBy("g", fine(F.col("d2")).alias("v")).agg(F.count("*").alias("n")))
    middle = quantile(counts, ["g"]).select("g", F.greatest(
        F.lit(1.0), F.expm1((F.col("v") + 1) / FINE) / MEDIAN).alias("scale"))
    return settle(model.join(middle, "g"))


def usual(points: DataFrame, steps: int = STEPS) -> DataFrame:
    """For each group ``g`` of vectors, the estimates and ``scale``, by which squared distances are to be divided.

    Estimates are those of the subset with the smallest determinant, made again from all vectors that are near by it.
    """
    now = estimates(nearest(starts(points)))
    columns = ["g", *(f"x{i}" for i in DIMS)]
    for _ in range(steps):
        ranked = distanced(points.select(*columns).join(now, "g")).withColumn("v", fine(F.col("d2")))
        now = estimates(nearest(ranked.select(*columns, "start", "v")))
    best = now.groupBy("g").agg(F.min_by(F.struct(*(c for c in now.columns if c != "g")),
                                         F.struct("det", "start")).alias("e")).select("g", "e.*")
    near = (distanced(points.select(*columns).join(scaled(points, best), "g"))
            .where(F.col("d2") <= WEIGHED * F.col("scale")).select(*columns, "start"))
    return estimates(near).withColumn("scale", F.lit(WEIGHED_SHRINK))


def allowed(d2: Column, n: Column) -> Column:
    """The distance that is as rare for a known covariance as ``d2`` is for one that was estimated from ``n`` vectors.

    Few vectors give an uncertain covariance, and distances by it have a longer tail, that of the F distribution.
    """
    return (n - len(SPREADS)) * F.log1p(d2 * n / (n * n - 1))


def judged(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``doc_id``, ``n_words``, the four counts, ``base_failed``, ``distance`` and ``kept`` for each row of ``docs``.

    Columns used are ``doc_id``, ``text``, ``lang`` and ``source``. A null text counts as the empty one, which fails the
    fixed rules. Null languages and sources are groups of their own. Documents of small sources are held against their
    whole language, large sources included. In a language with fewer than five passing documents no estimate is defined;
    these are not judged by distance (null) and stay if they pass the fixed rules.
    Repeated rows each keep their row and count in the estimates as often as they occur. An empty table gives none.
    """
    stats = statistics(docs).withColumn("base_failed", base_failed())
    stats = settle(grouped(settle(stats)).select("*", *vector()))
    model = usual(learned_from(stats))
    placed = distanced(lookup_join(stats, model, ["g"], "left"))
    distance = F.round(allowed(F.col("d2") / F.col("scale"), F.col("n")), 6)
    return placed.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         distance.alias("distance"),
                         (~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= cutoff)).alias("kept"))
