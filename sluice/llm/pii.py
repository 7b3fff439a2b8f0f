"""Personal data: fixed patterns, and identifiers found by bootstrapping from them.

The matches of the fixed patterns are seeds. The words before a seed are a lexical pattern; the same words before any other
identifier-like string make that string an instance of the pattern. Patterns and instances form a graph, which is scored in
rounds until nothing moves any more: a pattern is worth the share of its instances that are known, less what unseen ones
are charged, and an instance what its patterns say together. Strings that reliable patterns point to are reported as well,
wherever they stand.

All of it is DataFrame operations. The places of matches follow from the lengths of the gaps between them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from sluice.llm.common import packed
from sluice.operators.joins import MAX_BROADCAST_BYTES, lookup_join, settle, settle_measured

# Fixed patterns. They find what the plain forms find, from the same place: runs are taken whole, so that no start within
# a run is tried after its first has failed, and long texts take time in proportion to their length.
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
AT_MOST_255 = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
BASE_KINDS = ("email", "ip", "card", "phone")
FOUND = "identifier"
KINDS = (*BASE_KINDS, FOUND)
MASKS = {kind: f"<{kind.upper()}>" for kind in KINDS}

#: A string with digits that could be an identifier.
CANDIDATE = r"(?<![A-Za-z0-9])[A-Za-z]{0,12}+[0-9][A-Za-z0-9./-]{4,}+"
#: Signs before a string that its context is taken from; words in it that are strings themselves; what separates a list.
CONTEXT_CHARS = 160
BLANK, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
STRING = f"{WORD}*[0-9@]{WORD}*"
MARK, TAIL = "\x01", r"[\x01\x20\x09-\x0D\p{P}\p{S}]+$"
TWO_WORDS = f"({WORD}+){BLANK}+({WORD}+)$"
#: Signs that stand for the words of a text without blanks.
UNPARTED_CHARS = 16
START = "^"
#: What a pattern is charged with beyond its instances, at all and for each unseen one; the score that counts as sure;
#: instances of a sure pattern; a change of scores that is none any more.
PRIOR, CHARGE = 0.5, 0.125
SURE = 0.8
LEAST_INSTANCES = 4
TOLERANCE = 1e-3
BLOCK = 256
TEXT_BLOCK = 4096


def running(values: Column, combine: Callable[[Column, Column], Column] = lambda a, b: a + b) -> Column:
    """The sum, or other combination, of 0 and the values before each one. Two levels, as an array grows by being copied."""
    def sums(items: Column, start: Column) -> Column:
        return F.aggregate(items, F.struct(start.alias("n"), F.array().cast("array<bigint>").alias("seen")),
                           lambda done, v: F.struct(combine(done["n"], v).alias("n"),
                                                    F.array_append(done["seen"], done["n"]).alias("seen")))["seen"]

    zero = F.lit(0).cast("bigint")

    def two_levels(items: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")),
                             lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))
        totals = F.transform(blocks, lambda block: F.aggregate(block, zero, combine))
        return F.flatten(F.zip_with(blocks, sums(totals, zero), sums))

    small = sums(values, zero)
    return F.when(F.size(values) <= BLOCK, small).otherwise(two_levels(values))


def valid(kind: str, value: Column) -> Column:
    """Whether a match of the kind's pattern is one of the kind."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{AT_MOST_255}(?:\.{AT_MOST_255}){{3}}$")
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def context(blocks: Column, start: Column) -> Column:
    """The last two words before a place, in lower case; a single word at the start of the text is kept as such.

    Strings with a digit or @ count as one sign, whatever pattern they fit. Strings, blanks and punctuation right before the
    place are passed over, so all members of a list have the words before the list. Empty where the text begins, null where
    a list goes on from farther back.
    """
    first = F.greatest(start - CONTEXT_CHARS, F.lit(0).cast("bigint"))
    window = F.lower(piece(blocks, first, start))
    whole, parted = first == 0, window.rlike(BLANK)
    # The first word may have been cut.
    words = F.when(whole | ~parted, window).otherwise(F.regexp_replace(window, f"^{WORD}+", ""))
    words = F.trim(F.regexp_replace(F.regexp_replace(words, STRING, MARK), TAIL, ""))
    two = F.concat_ws(" ", F.regexp_extract(words, TWO_WORDS, 1), F.regexp_extract(words, TWO_WORDS, 2))
    return (F.when(F.length(two) > 1, two).when(whole & (words == ""), "").when(whole, F.concat(F.lit(f"{START} "), words))
            .when(parted | (words == ""), None).otherwise(F.right(words, F.lit(UNPARTED_CHARS))))


def matched(rows: DataFrame) -> DataFrame:
    """Adds, for each kind and for candidates, an array of spans: ``start``, ``end``, ``value``, ``context``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    patterns = {"email": (EMAIL, text.contains("@")), "ip": (IP, text.rlike(r"[0-9]\.[0-9]")),
                "card": (CARD, text.rlike("[0-9][0-9 -]{10}")), "phone": (PHONE, text.contains("+")),
                "other": (CANDIDATE, text.rlike("[0-9]"))}
    none = F.array().cast("array<string>")
    found = rows.select("*", *(F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
                               .alias(f"m_{kind}") for kind, (pattern, gate) in patterns.items()))
    some = reduce(or_, (F.size(f"m_{kind}") > 0 for kind in patterns))
    gaps = found.select("*", F.when(some, in_blocks(text)).alias("blocks"), *(F.when(F.size(f"m_{kind}") > 0, F.transform(
        F.split(text, pattern, -1), lambda g: F.length(g).cast("bigint")))
        .alias(f"g_{kind}") for kind, (pattern, _) in patterns.items())).drop("text")
    steps = gaps.select("*", *(F.when(F.size(f"m_{kind}") > 0, running(F.zip_with(
        f"m_{kind}", F.slice(f"g_{kind}", F.lit(1), F.size(f"m_{kind}")), lambda m, g: F.length(m) + g)))
        .alias(f"s_{kind}") for kind in patterns))

    def spans(kind: str) -> Column:
        zipped = F.arrays_zip(F.col(f"m_{kind}").alias("m"), F.col(f"g_{kind}").alias("g"), F.col(f"s_{kind}").alias("s"))
        kept = F.filter(zipped, lambda z: z["m"].isNotNull() & valid(kind, z["m"]))
        return F.coalesce(F.transform(kept, lambda z: F.struct(
            (z["s"] + z["g"]).alias("start"), (z["s"] + z["g"] + F.length(z["m"])).alias("end"),
            F.lit(kind).alias("kind"), z["m"].alias("value"), context(F.col("blocks"), z["s"] + z["g"]).alias("context"))), F.array())

    kept = [c for c in rows.columns if c != "text"]
    return steps.select(*kept, F.concat(*(spans(kind) for kind in BASE_KINDS)).alias("base"), spans("other").alias("other"))


def strings(found: DataFrame) -> DataFrame:
    """Every seed, and every candidate that touches no seed's span, in rows of their own."""
    each = (found.where("size(base) + size(other) > 0")
            .select("row_id", F.explode(F.concat("base", "other")).alias("s")).select("row_id", "s.*"))
    base = F.col("kind") != "other"
    before = (Window.partitionBy("row_id").orderBy("start", F.when(base, 0).otherwise(1), "end", "kind")
              .rowsBetween(Window.unboundedPreceding, -1))
    after = (Window.partitionBy("row_id").orderBy(F.desc("start"), F.when(base, 0).otherwise(1), "end", "kind")
             .rowsBetween(Window.unboundedPreceding, -1))
    near = each.select("*", F.max(F.when(base, F.col("end"))).over(before).alias("left"),
                       F.min(F.when(base, F.col("start"))).over(after).alias("right"))
    free = (F.coalesce("left", F.lit(0)) <= F.col("start")) & (F.coalesce("right", F.col("end")) >= F.col("end"))
    # A list that began farther back: the words before it are those of an earlier string.
    given = F.last("context", ignorenulls=True).over(before)
    return near.where(base | free).withColumn("context", F.coalesce("context", given, F.lit(""))).drop("left", "right")


def scored(edges: DataFrame, max_broadcast_bytes: int | None = None) -> DataFrame:
    """``value``, ``score``: what the graph says of each string that is no seed.

    ``edges`` has ``context``, ``value``, ``seed``, each pair once. Scores only rise, and rounds go on until none has risen
    by more than the tolerance. Patterns without a seed have nothing to rise from, ones with too few instances
    never count; both are left out first, which leaves little of the graph of most texts. Sums go over the edges of a pattern or an instance, in each task first; what they give is
    looked up, so a pattern with most of the rows is not gathered in one task.
    """
    bound = MAX_BROADCAST_BYTES if max_broadcast_bytes is None else max_broadcast_bytes
    sizes = edges.groupBy("context").agg(F.count("*").alias("n"), F.count_if(F.col("seed")).alias("seeds"))
    sizes = sizes.where((F.col("n") >= LEAST_INSTANCES) & (F.col("seeds") > 0) & (F.col("n") > F.col("seeds")))
    now = lookup_join(edges, sizes, ["context"], "inner", bound)
    # A string of one pattern has just that pattern's trust, so its part in the pattern is worked out, not awaited.
    several = now.where("NOT seed").groupBy("value").agg(F.count("*").alias("k")).where("k > 1").select("value")
    now = lookup_join(now, several.withColumn("several", F.lit(True)), ["value"], "left", bound)
    now = now.withColumns({"alone": ~F.col("seed") & F.col("several").isNull(), "score": F.col("seed").cast("double")})
    # What patterns and instances come to is less than the edges.
    now, size = settle_measured(now.drop("several"))

    def looked_up(rows: DataFrame, lookup: DataFrame, key: str, how: str) -> DataFrame:
        return rows.join(F.broadcast(lookup), key, how) if size <= bound else lookup_join(rows, lookup, [key], how, bound)

    while size:
        charged = F.col("n") + PRIOR + CHARGE * (F.col("n") - F.col("seeds"))
        patterns = (now.groupBy("context", "n", "seeds")
                    .agg(F.sum(F.when(F.col("alone"), 0.0).otherwise(F.col("score"))).alias("known"),
                         F.count_if(F.col("alone")).alias("own"))
                    .select("context", (F.col("known") / (charged - F.col("own"))).alias("trust")))
        instances = (looked_up(now.where("NOT seed"), patterns, "context", "inner")
                     .groupBy("value").agg(F.sum(F.log(1 - F.col("trust"))).alias("doubt"))
                     .select("value", F.round(1 - F.exp("doubt"), 9).alias("next")))
        after = looked_up(now, instances, "value", "left")
        risen = F.when(F.col("seed"), 1.0).otherwise(F.greatest("score", F.coalesce("next", F.lit(0.0))))
        moved = Observation()
        now = settle(after.select("context", "value", "seed", "n", "seeds", "alone", "score", risen.alias("risen"))
                     .observe(moved, F.max(F.col("risen") - F.col("score")).alias("most"))
                     .drop("score").withColumnRenamed("risen", "score"))
        if (moved.get["most"] or 0.0) <= TOLERANCE:
            break
    return now.where("NOT seed").groupBy("value").agg(F.max("score").alias("score"))


def private_spans(docs: DataFrame, text: str = "text", sure: float = SURE) -> DataFrame:
    """``docs`` without the text, with ``base`` and ``extra``, arrays of spans (start, end, kind, value, context).

    Needs a column ``row_id`` that tells rows apart.
    """
    found = settle(matched(docs.withColumn("text", F.col(text).cast("string"))))
    each = settle(strings(found))
    edges = (each.where("context <> ''").groupBy("context", "value")
             .agg(F.max(F.col("kind") != "other").alias("seed")))
    sure_values = scored(edges).where(F.col("score") >= sure).select("value")
    extra = (lookup_join(each.where("kind = 'other'"), sure_values, ["value"], "left_semi")
             .groupBy("row_id").agg(F.collect_list(F.struct("start", "end", F.lit(FOUND).alias("kind"), "value", "context"))
                                    .alias("extra")))
    return (found.drop("other").join(extra, "row_id", "left")
            .withColumn("extra", F.coalesce("extra", F.array().cast(found.schema["base"].dataType))))


def ordered(spans: Column) -> Column:
    """Spans by start, then by kind as listed."""
    ranks = F.array(*(F.lit(kind) for kind in KINDS))
    return F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(ranks, s["kind"]).alias("rank"), s["end"].alias("end"),
        s["kind"].alias("kind"))))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, sure: float = SURE) -> DataFrame:
    """``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``, ``spans``, ``found`` for each row.

    ``found`` has all spans as structs, ``spans`` as text, by start and then email, ip, card, phone, identifier; places
    count code points and ends are exclusive. ``base_sha256`` is over the fixed patterns' spans alone. Only ``doc_id`` and
    ``text`` are used. A null text counts as the empty one and has no spans. Repeated rows and null doc_ids keep their
    rows; a string counts once in the graph however many rows hold it.
    """
    rows = docs.select("doc_id", "text").withColumn("row_id", F.monotonically_increasing_id())
    found = private_spans(rows, sure=sure)
    counts = [F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
              for kind in BASE_KINDS]
    sorted_base = found.withColumn("base", ordered(F.col("base"))).withColumn("extra", ordered(F.col("extra")))
    both = F.array_sort(F.concat("base", "extra"))
    return sorted_base.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                              listed(both).alias("spans"), both.alias("found"))


def masked(docs: DataFrame, sure: float = SURE) -> DataFrame:
    """The rows of ``docs`` with the mark of its kind in place of each span of personal data, in their own columns.

    Spans that overlap are masked as one, under the kind of the first. Other columns stay as they are.
    """
    # Rows are settled with their numbers, as these depend on how the rows are dealt out.
    rows = settle(packed(docs).withColumn("row_id", F.monotonically_increasing_id()))
    spans = private_spans(rows.select("row_id", F.col("row.text").alias("text")), sure=sure)
    spans = spans.select("row_id", ordered(F.concat("base", "extra")).alias("spans")).where("size(spans) > 0")
    # What ends before each span; a span that begins before that is part of what is masked already.
    reached = running(F.transform("spans", lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    parts = F.filter(F.zip_with("spans", "reached", lambda s, end: F.struct(
        end.alias("start"), s["start"].alias("end"), mark(s["kind"]).alias("mark"))), lambda p: p["start"] <= p["end"])
    plan = (spans.withColumn("reached", reached)
            .select("row_id", F.struct(F.array_max(F.transform("spans", lambda s: s["end"])).alias("end"), parts.alias("parts"))
                    .alias("plan")))
    joined = rows.join(plan, "row_id", "left")
    # Places count code points, and finding one takes a walk from the start: a short walk within a block.
    joined = joined.withColumn("blocks", F.when(F.col("plan").isNotNull(), in_blocks(F.col("row.text").cast("string"))))
    length = F.length(F.col("row.text").cast("string")).cast("bigint")
    pieces = F.transform("plan.parts", lambda p: F.concat(piece(F.col("blocks"), p["start"], p["end"]), p["mark"]))
    clean = F.concat(F.array_join(pieces, ""), piece(F.col("blocks"), F.col("plan.end"), length))
    columns = [F.when(F.col("plan").isNull(), F.col("row.text")).otherwise(clean).alias(c) if c == "text"
               else F.col(f"row.`{c}`") for c in docs.columns]
    return joined.select(*columns)


def in_blocks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0))


def piece(blocks: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` to ``end`` of a text that is cut into blocks."""
    first, last = F.floor(start / TEXT_BLOCK).cast("int"), F.floor(end / TEXT_BLOCK).cast("int")
    at, to = (start % TEXT_BLOCK).cast("int"), (end % TEXT_BLOCK).cast("int")
    head, tail = F.coalesce(F.get(blocks, first), F.lit("")), F.coalesce(F.get(blocks, last), F.lit(""))
    return F.when(first == last, F.substr(head, at + 1, to - at)).otherwise(F.concat(
        F.substr(head, at + 1), F.array_join(F.slice(blocks, first + 2, F.greatest(F.lit(0), last - first - 1)), ""),
        F.substr(tail, F.lit(1), to)))


def mark(kind: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in MASKS.items() for x in pair)), kind)
