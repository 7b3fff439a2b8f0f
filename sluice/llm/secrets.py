"""Secret scans: fixed patterns, and the novelty of what stands in a sensitive context.

The fixed patterns find assignments, access keys and long hexadecimal strings. Beyond them, a candidate is a longer string
that follows a sensitive word. What it says anew is measured by compression: Zstandard is primed with a dictionary of the
words that are common in such contexts, over all documents, then with the text around the candidate, in which candidates
are blank, so that no key is known from its own copies; the candidate's
marginal bytes are what the output grows by when the candidate is added to that text. Names, paths and words compress
against what is known already; keys do not, and a candidate whose marginal bytes stay close to its length is reported.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.joins import settle

# Fixed patterns and their smallest lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "novel")

#: Words after which a string may be a secret, whatever stands between within the distance.
SENSITIVE = re.compile(r"password|passwd|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key"
                       r"|credential|bearer|authorization|signature", re.IGNORECASE | re.ASCII)
CANDIDATE_LEAST = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
DISTANCE = 48
AROUND = 256
WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]{2,}")
#: Size of the dictionary of common words; the commonest are nearest to the text.
DICTIONARY_BYTES = 32 * 1024
#: Words of code that every dictionary holds, farthest from the text.
CODE_WORDS = (
    "access account action address admin algorithm allow application array async auth backend base block boolean bucket "
    "buffer build cache call check class client cloud code column command common config connection const container "
    "content context control cookie count create credential current data database debug default delete deploy device "
    "digest disable document domain email enable encode endpoint engine entry environment error event example expire "
    "export false field file filter final format frame function gateway generate global group handler hash header host "
    "http https identifier image import index info init input instance integer internal interval item issue javascript "
    "json level library limit limiter list local login manager master message method model module monitor name network "
    "node null number object option order output package page param parent parse passphrase password path payload "
    "placeholder platform policy port prefix private process production profile project property protocol provider proxy "
    "public python query queue random rate read record redirect refresh region register release remote request resource "
    "response result return role root rotate route sample schema scope script search secret section secure select send "
    "server service session setting settings setup shared signature size source staging state static status storage "
    "stream string subject suffix support switch system table target template test text thread time timeout token "
    "total trace true type unique update upload user username utils value variable vault version view volume webhook "
    "window worker write your").encode()
#: Share of a candidate's length that has to be new, and the fewest kinds of characters in it.
NOVEL_SHARE = 0.6
LEVEL = 9


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the fixed patterns as (start, end, kind), in order."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda span: (span[0], KINDS.index(span[2])))


def candidates(text: str, taken: list[tuple[int, int, str]]) -> Iterator[tuple[int, int]]:
    """Places of strings that follow a sensitive word, hold both letters and digits, and touch no base span.

    A string may begin right at the end of the word. Each string is looked at once for each word it is near to.
    """
    words = [near.end() for near in SENSITIVE.finditer(text)]
    if not words:
        return
    starts, reach = [start for start, _, _ in taken], list(accumulate((end for _, end, _ in taken), max))
    last = -1
    for run in CANDIDATE.finditer(text):
        # Words that end within the run, or before it within the distance.
        first = bisect_left(words, run.start() - DISTANCE)
        for word in words[first:bisect_right(words, run.end())]:
            start, end = max(word, run.start()), run.end()
            before = bisect_left(starts, end)
            if start <= last or before and reach[before - 1] > start:
                continue
            # What the string lacks, a shorter end of it lacks as well.
            string = text[start:end]
            if len(string) >= CANDIDATE_LEAST and re.search("[0-9]", string) and re.search("[A-Za-z]", string):
                yield start, end
                last = end
            break


def surrounded(text: str, places: list[tuple[int, int]]) -> Iterator[tuple[str, str, str]]:
    """The text before each of the places, its string, and the text after it, with blanks for candidates wherever they stand.

    Both sides are blanked with as much more text as the string is long, so that none of its copies is cut in two.
    """
    known, parts, last = {text[a:b] for a, b in places}, [], 0
    for a, b in places:
        parts += [text[last:a], " " * (b - a)]
        last = b
    rest = "".join([*parts, text[last:]])
    # Copies where no sensitive word is near.
    rest = CANDIDATE.sub(lambda run: " " * len(run[0]) if run[0] in known else run[0], rest) if known else rest
    for a, b in places:
        string, size = text[a:b], b - a
        before = rest[max(0, a - AROUND - size):a].replace(string, " " * size)[-AROUND:]
        yield before, string, rest[b:b + AROUND + size].replace(string, " " * size)[:AROUND]


def scanned(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``found`` (the base spans) and ``near`` (candidates with the text around them), a row for each row."""
    span = "array<struct<start:bigint,end:bigint,kind:string>>"

    @F.arrow_udf(f"found {span}, near array<struct<start:bigint,end:bigint,before:string,string:string,after:string>>")
    def scan(column: pa.Array) -> pa.Array:
        found, near = [], []
        for value in column:
            text = value.as_py() or ""
            spans = base_spans(text)
            found.append([dict(zip(("start", "end", "kind"), s)) for s in spans])
            places = list(candidates(text, spans))
            near.append([{"start": a, "end": b, "before": before, "string": string, "after": after}
                         for (a, b), (before, string, after) in zip(places, surrounded(text, places))])
        spot = [("start", pa.int64()), ("end", pa.int64())]
        return pa.StructArray.from_arrays(
            [pa.array(found, pa.list_(pa.struct([*spot, ("kind", pa.string())]))),
             pa.array(near, pa.list_(pa.struct([*spot, ("before", pa.string()), ("string", pa.string()),
                                                ("after", pa.string())])))], ["found", "near"])

    return docs.select("doc_id", scan(F.col("text").cast("string")).alias("of")).select("doc_id", "of.found", "of.near")


def common_words(rows: DataFrame, size: int = DICTIONARY_BYTES) -> bytes:
    """The commonest words around the candidates of all documents, ``size`` bytes of them, the commonest last.

    A word counts once for each different text around a candidate, however many documents and rows hold it.
    """
    around = rows.select(F.explode("near").alias("n")).select(F.concat_ws(" ", "n.before", "n.after").alias("text")).distinct()
    words = (around.select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(WORD.pattern), 0))).alias("word"))
             .groupBy("word").agg(F.count("*").alias("n"))
             .orderBy(F.desc("n"), "word").limit(size // 4).collect())
    kept, total = [], 0
    for word, _ in words:
        total += len(word) + 1
        if total > size:
            break
        kept.append(word)
    return " ".join(reversed(kept)).encode()


def marginal_bytes(string: str, before: str, after: str, dictionary: bytes) -> int:
    """What compressed output grows by when the string is added to the text around it, with the dictionary known."""
    prime = zstandard.ZstdCompressionDict(CODE_WORDS + b" " + dictionary + f" {before} {after} ".encode()[-4 * 2 * AROUND - 3:],
                                          dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=prime, write_content_size=False, write_checksum=False,
                                      write_dict_id=False)
    context = before.encode()
    return len(packer.compress(context + string.encode())) - len(packer.compress(context))


def novel_spans(rows: DataFrame, spark: SparkSession, share: float = NOVEL_SHARE) -> Column:
    """Candidates whose marginal bytes reach the share of their length, as spans."""
    dictionary = spark.sparkContext.broadcast(common_words(rows))  # of a fixed size

    @F.arrow_udf("array<struct<start:bigint,end:bigint,kind:string>>")
    def score(column: pa.Array) -> pa.Array:
        known, out = dictionary.value, []
        for value in column:
            out.append([{"start": c["start"], "end": c["end"], "kind": "novel"} for c in value.as_py() or ()
                        if marginal_bytes(c["string"], c["before"], c["after"], known) >= share * len(c["string"])])
        return pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])))

    return score(F.col("near"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secrets(spark: SparkSession, docs: DataFrame, share: float = NOVEL_SHARE) -> DataFrame:
    """``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans`` and ``found`` for each row of docs.

    ``found`` has all spans as structs, ``spans`` as text, ordered by start and then assign, access, hex, novel; places
    count code points and ends are exclusive. An assignment's span is its whole match. ``base_sha256`` is over the
    fixed patterns' spans alone, in the same form. A null text counts as the empty one and has no spans. Rows are
    independent but for the dictionary, which counts words over all rows; repeated rows and null doc_ids keep theirs.
    """
    rows = settle(scanned(docs))
    order = F.array(*(F.lit(kind) for kind in KINDS))
    every = F.array_sort(F.transform(
        F.concat("found", "novel"),
        lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"),
                           s["end"].alias("end"), s["kind"].alias("kind"))))
    # Rows without candidates need no Python.
    some, none = rows.where(F.size("near") > 0), rows.where(F.size("near") == 0)
    empty = F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")
    both = (some.withColumn("novel", novel_spans(rows, spark, share))
            .unionByName(none.withColumn("novel", empty)))
    numbers = [F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
               for kind in BASE_KINDS]
    return both.select("doc_id", *numbers, F.sha2(listed(F.col("found")), 256).alias("base_sha256"),
                       listed(every).alias("spans"), every.alias("found"))
