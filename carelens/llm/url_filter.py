"""Allow and block lists for URLs: a blocked Bloom filter, then an exact join.

A rule is a host and a path. It fits a URL whose host is the rule's or a subdomain of it and whose path begins with the
rule's; the longest fitting rule decides. So a URL has one candidate for each shape that rules have (number of host
labels, length of path), and is listed if one of its candidates is. Shapes are data: a relation with one row for each number
of labels holds the lengths, so thousands of shapes change no plan. Almost no candidate is listed: they first pass a
blocked Bloom filter of all rules (one 32-byte block per key, a bit in each of its eight words), which is sent to the
tasks. Its size is bounded by a parameter; a list too long for it only lets more candidates through. What passes is
joined with the rules by equality, so false positives go.

Each distinct host and path is judged once; a host that a third of the pages share costs nothing extra.

Defined cases. A null URL or one without ``://`` has an empty host and path and fits no rule. An empty path begins with
no rule's path but an empty one. Equal rules with both verdicts block; of rules of equal length the one with the
longer host decides. Rules with a null host or path are left out. Repeated pages are judged each. Other columns of
the pages are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.llm.line_dedup import LOWER, UPPER

ALLOW, BLOCK = "allow", "block"
#: Most bytes of the filter, and bits it spends on a rule below that.
FILTER_BYTES, BITS_PER_KEY = 16 << 20, 16
WORDS_PER_BLOCK, BLOCK_BYTES = 8, 32
#: Blocks that one task fills.
SEGMENT_BLOCKS = 2048
#: Odd multipliers, one per word: odd powers of the golden ratio in 32 bits.
SALTS = np.array([pow(0x9E3779B1, 2 * word + 1, 1 << 32) for word in range(WORDS_PER_BLOCK)], np.uint64)


def host_and_path(url: Column) -> tuple[Column, Column]:
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.substring(url, begin + 3, F.char_length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.coalesce(F.translate(host, UPPER, LOWER), empty), F.coalesce(path, empty)


def labels(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def key_hash(host: Column, path: Column) -> Column:
    return F.xxhash64(host, path)


class BlockedBloom:
    """Bits of all keys; a key's block comes from the upper half of its hash, its bits from the lower."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits  # uint32, one row per block

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        block, masks = placed(hashes, len(self.bits))
        return np.all(self.bits[block] & masks == masks, axis=1)


def placed(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash and the bit it has in each word there."""
    hashes = hashes.view(np.uint64)
    block = (hashes >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
    low = hashes & np.uint64(0xFFFFFFFF)
    bit = (low[:, None] * SALTS & np.uint64(0xFFFFFFFF)) >> np.uint64(27)
    return block.astype(np.int64), (np.uint32(1) << bit.astype(np.uint32)).astype(np.uint32)


def bloom_of(rules: DataFrame, filter_bytes: int = FILTER_BYTES) -> BlockedBloom:
    """The filter of all rules, filled in parts by the tasks."""
    needed = -(-rules.count() * BITS_PER_KEY // 8 // BLOCK_BYTES)
    blocks = max(1, min(needed, filter_bytes // BLOCK_BYTES))

    def fill(table: pa.Table) -> pa.Table:
        block, masks = placed(table.column("key").to_numpy(), blocks)
        first = int(block[0]) // SEGMENT_BLOCKS * SEGMENT_BLOCKS
        bits = np.zeros((min(SEGMENT_BLOCKS, blocks - first), WORDS_PER_BLOCK), np.uint32)
        for word in range(WORDS_PER_BLOCK):
            np.bitwise_or.at(bits[:, word], block - first, masks[:, word])
        return pa.table({"first": [first], "bits": pa.array([bits.tobytes()], pa.binary())})

    upper = F.shiftrightunsigned("key", 32)
    keys = rules.select(key_hash(F.col("host"), F.col("path")).alias("key"))
    dealt = keys.withColumn("segment", F.floor(F.floor(upper * blocks / float(1 << 32)) / SEGMENT_BLOCKS))
    bits = np.zeros((blocks, WORDS_PER_BLOCK), np.uint32)
    for row in dealt.groupBy("segment").applyInArrow(fill, "first long, bits binary").toLocalIterator():
        part = np.frombuffer(row.bits, np.uint32).reshape(-1, WORDS_PER_BLOCK)
        bits[row.first : row.first + len(part)] = part
    return BlockedBloom(bits)


def _candidates(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The URLs, for each number of labels that rules have: the end of the host, and the lengths of rules' paths there that
    are not longer than the URL's path. The relation joined has as many rows as there are numbers of labels."""
    n_labels = labels(F.col("host"))
    most = rules.agg(F.max(n_labels)).first()[0] or 1
    shapes = rules.groupBy(n_labels.alias("n")).agg(F.array_sort(F.collect_set(F.char_length("path"))).alias("lengths"))
    ends = urls.select("host", "path", F.explode(F.sequence(F.lit(1), F.least(n_labels, F.lit(most)))).alias("n"))
    rule_host = F.call_function("substring_index", F.col("host"), F.lit("."), -F.col("n"))
    fitting = F.filter("lengths", lambda length: length <= F.char_length("path"))
    return ends.join(shapes, "n").select("host", "path", rule_host.alias("rule_host"), fitting.alias("lengths"))


def judge(pages: DataFrame, rules: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """page_id, host, path, rule (or null) and verdict of every page.

    ``rules`` has host, path and verdict. Unlisted pages are allowed.
    """
    verdict = F.max("verdict").alias("verdict")  # block is the larger word
    rules = rules.dropna(subset=["host", "path"]).groupBy("host", "path").agg(verdict)
    sent = pages.sparkSession.sparkContext.broadcast(bloom_of(rules, filter_bytes).bits)

    @F.arrow_udf("array<boolean>")
    def may_hold(hashes: pa.Array) -> pa.Array:
        found = BlockedBloom(sent.value).may_hold(hashes.flatten().to_numpy(zero_copy_only=False))
        ends = np.append(0, np.cumsum(pc.list_value_length(hashes).to_numpy(zero_copy_only=False)))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found))

    host, path = host_and_path(F.col("url"))
    located = pages.select("page_id", host.alias("host"), path.alias("path"))
    urls = _candidates(located.select("host", "path").distinct(), rules)
    hashes = F.transform("lengths", lambda length: key_hash(F.col("rule_host"), F.left(F.col("path"), length)))
    urls = urls.withColumn("possible", may_hold(hashes))
    passed = F.filter("lengths", lambda x, i: F.get("possible", i))
    possible = urls.select("host", "path", "rule_host", F.explode(passed).alias("length"))

    exact = possible.withColumn("rule_path", F.left(F.col("path"), F.col("length"))).drop("length")
    listed = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    rule = F.concat("rule_host", "rule_path")
    order = F.struct(F.char_length(rule).alias("length"), F.char_length("rule_host").alias("host_length"), rule.alias("rule"), "verdict")
    longest = exact.join(listed, ["rule_host", "rule_path"]).groupBy("host", "path").agg(F.max(order).alias("best"))
    judged = located.join(longest, ["host", "path"], "left")
    return judged.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(ALLOW)).alias("verdict")
    )


def rules_frame(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A short list of (host, path, verdict)."""
    return spark.createDataFrame(rules, "host string, path string, verdict string")
