"""Secrets in texts: fixed patterns, and strings that a character model finds random.

Two first-order Markov models over characters, one of random strings and one of
ordinary ones, are counted from labelled samples: generated random strings and what
the base patterns catch on one side; on the other names from Python's library,
numbers, dates, repeated characters, and the long strings that remain in the texts.
A run of identifier characters is reported if the logarithm of its likelihood
ratio is high, or that of a stretch inside it, so that words joined to a key do not
hide it. Characters that join words, as in paths, tell nothing either way.
Training and scoring are DataFrame expressions.

Places are code points from 0, ends exclusive. Null reads as the empty text,
which has no spans; rows that repeat are scanned alike, each on its own.
"""

from __future__ import annotations

import builtins
import importlib
import math
import re
import sys
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.work import making_room, unused

# The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # the runs of at least 24: no shorter run can hide one
KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 6, "access": 20}

#: Strings that the models judge, and those that they are trained on.
CANDIDATE = r"[A-Za-z0-9+/_=-]{12,}"
SAMPLE = r"[A-Za-z0-9+/_=-]{12,}"
#: Characters the models tell apart; letters in either case are one.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789+/_=-"
JOINTS = "/_=-"
#: How a model mixes the counts after a character, of all characters, and equal shares: seen `SEEN` times, counts weigh a half.
SEEN, SURE, COMMON = 8.0, 0.9, 0.7
# Library modules whose names are samples of ordinary identifiers.
MODULES = """
argparse ast asyncio calendar codecs collections configparser csv datetime decimal difflib email.message fractions functools
http.client http.server inspect itertools json locale logging mailbox pathlib pickle platform random shutil smtplib socket
sqlite3 ssl statistics string subprocess tarfile tempfile threading tokenize typing unittest urllib.parse urllib.request
xml.dom.minidom zipfile
""".split()
SPAN = "struct<start:bigint,kind:int,end:bigint>"


@dataclass(frozen=True)
class Models:
    """Log-likelihood ratios, random against ordinary, of each character after each other one."""

    ratios: tuple[float, ...]
    least_total: float = 12.0
    least_mean: float = 0.5
    least_steps: int = 11


# --- training --------------------------------------------------------------------------------


def random_strings(spark: SparkSession, n: int = 20_000) -> DataFrame:
    """Labelled samples of random strings in the usual alphabets, the same ones every time."""
    digest = F.sha2(F.concat(F.lit("sample "), F.col("id").cast("string")), 256)
    text = (
        F.when(F.col("id") % 3 == 0, F.substring(digest, 1, 40))
        .when(F.col("id") % 3 == 1, F.substring(F.base64(F.unhex(digest)), 1, 40))
        .otherwise(F.substring(F.regexp_replace(F.base64(F.unhex(digest)), "[+/]", ""), 1, 32))
    )
    return spark.range(n).select(text.alias("sample"), F.lit(True).alias("random"))


def ordinary_strings(spark: SparkSession, n: int = 5_000) -> DataFrame:
    """Labelled samples of ordinary strings: names from the library of this Python, numbers, dates and times, repeated characters."""
    names = {*sys.stdlib_module_names, *dir(builtins)}
    for module in MODULES:
        names.update(dir(importlib.import_module(module)))
    known = sorted(x for x in names if re.fullmatch(r"[A-Za-z0-9_]{4,}", x))
    known += [c * 400 for c in ALPHABET]
    number = F.conv(F.substring(F.sha2(F.concat(F.lit("number "), F.col("id").cast("string")), 256), 1, 13), 16, 10)
    date = F.date_format(F.timestamp_seconds(F.col("id") * 86_399 * 7), "yyyy-MM-dd'T'HH-mm-ss")
    made = spark.range(n).select(F.when(F.col("id") % 2 == 0, number).otherwise(date).alias("sample"))
    return spark.createDataFrame([(x,) for x in known], "sample string").unionByName(made).withColumn("random", F.lit(False))


def labelled_strings(docs: DataFrame, text: str = "text") -> DataFrame:
    """Labelled samples from texts: what the base patterns catch is random, other long strings are ordinary."""
    whole = F.coalesce(F.col(text), F.lit(""))
    caught = F.concat(all_of(whole, ASSIGN, 2), all_of(whole, ACCESS), all_of(whole, HEX))
    rest = whole
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.when(rest.rlike(pattern), F.regexp_replace(rest, pattern, " ")).otherwise(rest)
    both = [
        F.transform(F.filter(caught, lambda x: x.rlike(SAMPLE)), lambda x: F.struct(x.alias("sample"), F.lit(True).alias("random"))),
        F.transform(all_of(rest, SAMPLE), lambda x: F.struct(x.alias("sample"), F.lit(False).alias("random"))),
    ]
    return docs.select(F.explode(F.concat(*both)).alias("s")).select("s.sample", "s.random")


def train(samples: DataFrame) -> Models:
    """Models from rows (sample, random). Pairs of characters are counted over all samples.

    A pair that was never seen is as likely as its second character is, so that
    unusual ordinary words do not look random. What reaches the driver is one
    count for each pair and label: 3362 at most.
    """
    size = len(ALPHABET)
    pairs = samples.where("sample is not null and random is not null").select("random", F.explode(steps(F.col("sample"))).alias("step"))
    counts = {True: [0.0] * size * size, False: [0.0] * size * size}
    for row in pairs.groupBy("random", "step").count().collect():
        if row["step"] is not None:
            counts[row["random"]][row["step"]] += row["count"]
    logs = {kind: log_chances(each, size) for kind, each in counts.items()}
    return Models(tuple(a - b for a, b in zip(logs[True], logs[False], strict=True)))


def log_chances(counts: list[float], size: int) -> list[float]:
    """Logarithms of the chances of each character after each other one."""
    common = [1 + sum(counts[b::size]) for b in range(size)]
    out = []
    for a in range(size):
        after = counts[a * size : (a + 1) * size]
        seen = sum(after)
        trust = SURE * seen / (seen + SEEN)
        out += [math.log(trust * n / max(seen, 1.0) + (1 - trust) * (COMMON * c / sum(common) + (1 - COMMON) / size)) for n, c in zip(after, common, strict=True)]
    return out


# --- scoring ---------------------------------------------------------------------------------


def steps(token: Column) -> Column:
    """Numbers of a string's neighbouring characters as pairs; null where one is outside the alphabet."""
    places = [None] * 128
    for i, c in enumerate(ALPHABET):
        places[ord(c)] = places[ord(c.upper())] = i
    place = F.lit([-1 if p is None else p for p in places])
    codes = F.transform(F.array_remove(F.split(token, ""), ""), lambda c: F.get(place, F.ascii(c)))
    later = F.slice(codes, 2, F.greatest(F.size(codes) - 1, F.lit(0)))
    here = F.slice(codes, 1, F.greatest(F.size(codes) - 1, F.lit(0)))
    return F.zip_with(here, later, lambda a, b: F.when((a >= 0) & (b >= 0), a * len(ALPHABET) + b))


def is_random(token: Column, models: Models) -> Column:
    """Whether the ratios of a string, or of the best stretch up to some place in it, reach the least total and mean.

    Where a stretch's ratios fall to the least mean a new one begins: of those
    that end at a place, the stretch left is the furthest above that mean.
    Pairs with a character of `JOINTS` tell nothing: they join ordinary words and
    parts of keys alike.
    """
    size, joints = len(ALPHABET), {ALPHABET.index(c) for c in JOINTS}
    inner = F.lit([0.0 if {i // size, i % size} & joints else x for i, x in enumerate(models.ratios)])
    zero = F.struct(F.lit(0.0).alias("words"), F.lit(0.0).alias("above"), F.lit(0.0).alias("total"), F.lit(0).alias("n"), F.lit(False).alias("found"))

    def add(state: Column, step: Column) -> Column:
        ratio = F.coalesce(F.get(inner, step), F.lit(0.0))
        above, total, n = state["above"] + ratio - models.least_mean, state["total"] + ratio, state["n"] + 1
        on = above > 0
        return F.struct(
            (state["words"] + ratio).alias("words"),
            F.when(on, above).otherwise(0.0).alias("above"),
            F.when(on, total).otherwise(0.0).alias("total"),
            F.when(on, n).otherwise(0).alias("n"),
            (state["found"] | (on & (total >= models.least_total) & (n >= models.least_steps))).alias("found"),
        )

    least = F.greatest(F.lit(models.least_total), models.least_mean * (F.char_length(token) - 1))
    return F.aggregate(steps(token), zero, add, lambda x: x["found"] | (x["words"] >= least))


def all_of(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def placed(text: Column, pattern: str, kind: str, wanted: Column | None = None) -> Column:
    """Spans of a pattern's matches; `wanted` marks by place in the list those that count.

    Splitting at the pattern gives the text between matches, so lengths add up to places.
    """
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
    found = all_of(text, pattern)
    marks = F.transform(found, lambda x: F.lit(True)) if wanted is None else wanted
    parts = F.arrays_zip(F.split(text, pattern).alias("gap"), found.alias("hit"), marks.alias("mark"))

    def add(state: Column, part: Column) -> Column:
        start = state["at"] + F.char_length(part["gap"])
        end = start + F.coalesce(F.char_length(part["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"))
        mark = F.coalesce(part["mark"], F.lit(False))
        return F.struct(end.alias("at"), F.when(mark, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    return F.aggregate(parts, zero, add, lambda state: state["out"])


def scanned(docs: DataFrame, models: Models, text: str = "text", out: str = "secrets") -> DataFrame:
    """`docs` with a struct column `out`: base and spans, lists of (start, kind number, end) by start, then kind.

    A column of `docs` named as `out` is kept with `_` behind its name.
    """
    docs = making_room(docs, out)
    base, tokens, marks, extra = unused(docs, "base", "tokens", "marks", "extra")
    whole = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    long_enough = lambda pattern, group, kind: F.transform(
        all_of(whole, pattern, group), lambda x: F.char_length(x) >= LEAST[kind]
    )
    caught = [
        F.when(whole.rlike(ASSIGN), placed(whole, ASSIGN, "assign", long_enough(ASSIGN, 2, "assign"))).otherwise(none),
        F.when(whole.rlike(ACCESS), placed(whole, ACCESS, "access", long_enough(ACCESS, 0, "access"))).otherwise(none),
        F.when(whole.rlike(HEX), placed(whole, HEX, "hex")).otherwise(none),
    ]
    hits = F.when(F.exists(marks, lambda x: x), placed(whole, CANDIDATE, "random", F.col(marks))).otherwise(none)
    return (
        docs.withColumn(base, F.sort_array(F.concat(*caught)))
        .withColumn(tokens, all_of(whole, CANDIDATE))
        .withColumn(marks, F.transform(tokens, lambda t: is_random(t, models)))
        .withColumn(extra, hits)
        .withColumn(out, F.struct(F.col(base).alias("base"), F.sort_array(F.concat(base, extra)).alias("spans")))
        .drop(base, tokens, marks, extra)
    )


def written(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.lit(list(KINDS))
    each = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, each), ",")


def redacted(docs: DataFrame, models: Models, text: str = "text", out: str | None = None, mark: str = "[SECRET]") -> DataFrame:
    """`docs` with each span of a secret replaced by `mark` in the text, or in a new column `out`.

    All rows and columns stay. Overlapping spans are replaced once. Texts
    without secrets, null among them, are left as they are.
    """
    (found,) = unused(docs, "found")
    whole = F.col(text)
    spans = F.col(f"{found}.spans")
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def add(state: Column, span: Column) -> Column:
        gap = F.substr(whole, state["at"].cast("int") + 1, (span["start"] - state["at"]).cast("int"))
        fresh = span["start"] >= state["at"]
        parts = F.when(fresh, F.concat(state["out"], F.array(gap, F.lit(mark)))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), parts.alias("out"))

    def close(state: Column) -> Column:
        return F.concat(F.array_join(state["out"], ""), F.substr(whole, state["at"].cast("int") + 1))

    clean = F.when(F.size(spans) > 0, F.aggregate(spans, zero, add, close)).otherwise(whole)
    return scanned(docs, models, text, found).withColumn(out or text, clean).drop(found)
