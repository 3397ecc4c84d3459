"""Verdicts on URLs: rules on hosts and paths, and for the rest a list of canonical URLs.

The list becomes a blocked Bloom filter: a URL's hash picks one block of 256 bits
and eight bits in it. Its size has a fixed limit, so it can be broadcast however
long the list is; a long list only lets more URLs pass that are not on it. What
passes goes to an exact hash join with the list, which removes false positives.
URLs the filter stops are not moved at all.

Null URLs and URLs without `://` have an empty host and path, fit no rule and
are on no list.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from sluice.llm.textbytes import mix
from sluice.llm.work import ship, unused

WORDS = 4  # of 64 bits in a block
BITS = 8  # set for each URL

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Parameters that name where a reader came from, not what is read.
TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# --- parts of a URL --------------------------------------------------------------------------


def after_scheme(url: Column) -> Column:
    """What follows the first `://`; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), r"\A([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without `www.` or `m.`, path without closing slashes, and the query without tracking parameters.

    Scheme and fragment do not count. Null if there is no `://`.
    """
    query = F.regexp_extract(after_scheme(url), r"\A[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(rf"\A{TRACKING}(?:=|\z)"))
    place = F.concat(F.regexp_replace(host(url), r"\A(?:www|m)\.", ""), F.regexp_replace(path(url), r"/+\z", ""))
    whole = F.when(F.size(kept) > 0, F.concat_ws("?", place, F.array_join(F.array_sort(kept), "&"))).otherwise(place)
    return F.when(F.instr(url, "://") > 0, whole)


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as struct of rule and verdict; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


# --- the list --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Bloom:
    blocks: np.ndarray  # blocks x WORDS, uint64

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        block, masks = addressed(hashes, len(self.blocks))
        return ((self.blocks[block] & masks) == masks).all(axis=1)


def addressed(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash, and the bits it has there."""
    h = mix(hashes.astype(np.int64).view(np.uint64))
    block = (h % np.uint64(n)).astype(np.int64)
    bits = mix(h + np.uint64(1))
    masks = np.zeros((len(h), WORDS), np.uint64)
    for i in range(BITS):
        bit = (bits >> np.uint64(8 * i)) & np.uint64(255)
        masks[np.arange(len(h)), (bit >> np.uint64(6)).astype(int)] |= np.uint64(1) << (bit & np.uint64(63))
    return block, masks


def bloom(listed: DataFrame, bits_per_url: int = 16, max_bytes: int = 8 << 20) -> Bloom:
    """The filter of a table of distinct (url). Its bits are put together on the executors; `max_bytes` bounds what the driver gets."""
    n = listed.count()
    count = int(min(max(1, -(-n * bits_per_url // 256)), max_bytes // (8 * WORDS)))

    def run(batches):
        filled = {}
        for batch in batches:
            block, masks = addressed(batch.column("hash").to_numpy(), count)
            order = np.argsort(block, kind="stable")
            first = np.flatnonzero(np.concatenate(([True], block[order][1:] != block[order][:-1]))) if len(order) else []
            if len(order):
                joined = np.bitwise_or.reduceat(masks[order], first, axis=0)
                for k, words in zip(block[order][first].tolist(), joined, strict=True):
                    filled[k] = filled[k] | words if k in filled else words
        rows = np.array(list(filled.values()), np.uint64).reshape(-1, WORDS).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(filled), pa.int64()), *[pa.array(rows[:, i]) for i in range(WORDS)]], ["block", *[f"w{i}" for i in range(WORDS)]]
        )

    schema = "block bigint, " + ", ".join(f"w{i} bigint" for i in range(WORDS))
    parts = listed.select(F.xxhash64("url").alias("hash")).mapInArrow(run, schema)
    merged = parts.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
    table = np.zeros((count, WORDS), np.int64)
    found = merged.toArrow()
    if found.num_rows:
        table[found.column("block").to_numpy()] = np.stack([found.column(f"w{i}").to_numpy() for i in range(WORDS)], 1)
    return Bloom(table.view(np.uint64))


def judged(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, url: str = "url", out: str = "judged") -> DataFrame:
    """`pages` with a struct column `out`: host, path, rule, verdict, listed.

    `listed` is a table with a column `url` of canonical URLs, in any number of
    copies, null ones ignored. The verdict is the rule's, else `block` for listed
    URLs and `allow` for the rest. Rows that repeat are judged alike.
    """
    ship(pages.sparkSession)
    spark = pages.sparkSession
    known = listed.select("url").where("url is not null").distinct()
    shared = spark.sparkContext.broadcast(bloom(known))

    def run(hashes: pa.Array) -> pa.Array:
        return pa.array(shared.value.passes(hashes.to_numpy(zero_copy_only=False)))

    key, hit, rule, on_list, entry = unused(pages, "canonical", "hit", "rule", "on_list", "entry")
    rows = pages.withColumn(key, canonical(F.col(url)))
    rows = rows.withColumn(rule, ruled(host(F.col(url)), path(F.col(url)), rules))
    possible = F.col(key).isNotNull() & arrow_udf(run, "boolean")(F.xxhash64(key))
    rows = rows.withColumn(hit, possible)
    exact = known.select(F.struct(F.col("url")).alias(entry))
    stopped = rows.where(~F.col(hit)).withColumn(on_list, F.lit(False))
    passed = rows.where(hit).join(exact, F.col(key) == F.col(f"{entry}.url"), "left")
    passed = passed.withColumn(on_list, F.col(entry).isNotNull()).drop(entry)
    verdict = F.coalesce(F.col(f"{rule}.verdict"), F.when(F.col(on_list), F.lit("block")).otherwise(F.lit("allow")))
    return (
        stopped.unionByName(passed)
        .withColumn(
            out,
            F.struct(
                host(F.col(url)).alias("host"), path(F.col(url)).alias("path"), f"{rule}.rule", verdict.alias("verdict"), F.col(on_list).alias("listed")
            ),
        )
        .drop(key, hit, rule, on_list)
    )
