"""URL filter: a blocked Bloom filter before an exact join, and host and path rules over both.

The filter of the listed URLs is a table of blocks of 256 bits: a URL's hash names its block and eight
bits in it. Its size is bounded by a parameter, so it can be broadcast whatever the list; a longer
list only lets more URLs pass. URLs that pass are joined exactly with the list, which removes the false
positives. DataFrame expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.llm.common import lower_ascii, saved

#: Copies of the list and parts of the URLs in the exact join, so that a frequent URL meets it in many tasks.
SALTS = 16


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(df: DataFrame) -> DataFrame:
    """Adds host and path of the column `url`; both are empty for a null url or one without ://."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    rest = F.coalesce(rest, F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    return df.withColumn("host", host).withColumn("path", F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1))


def canonical(host: Column, path: Column) -> Column:
    """Host without www. or m., and the path without a trailing slash, index page or .html; null for no host."""
    bare = F.regexp_replace(host, r"^(?:www|m)\.", "")
    plain = F.regexp_replace(path, r"(?:/index)?(?:\.html?)?/*$", "")
    return F.when(host != "", F.concat(bare, plain))


def _bits(url: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a URL and its bits in the four longs of the block."""
    h, g = F.xxhash64(F.lit(11), url), F.xxhash64(F.lit(13), url)
    places = [F.shiftrightunsigned(g, 8 * i).bitwiseAND(255).cast("int") for i in range(8)]
    words = []
    for w in range(4):
        bits = F.lit(0).cast("long")
        for place in places:
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63))
            bits = bits.bitwiseOR(F.when(F.shiftright(place, 6) == w, bit).otherwise(F.lit(0).cast("long")))
        words.append(bits)
    return F.pmod(h, F.lit(blocks)).cast("int"), words


def bloom_filter(urls: DataFrame, max_bytes: int) -> tuple[DataFrame, int]:
    """(block, w0..w3) of the column `key` of distinct URLs, and the number of blocks: 16 bits a URL, at most `max_bytes`."""
    n = urls.count()
    blocks = max(1, min(-(-n * 16 // 256), max_bytes // 40))
    block, words = _bits(F.col("key"), blocks)
    rows = urls.select(block.alias("block"), *(w.alias(f"w{i}") for i, w in enumerate(words)))
    return rows.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4))), blocks


def _rule(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits host and path."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        at_host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        fits = at_host & F.col("path").startswith(rule.path)
        name, verdict = F.when(fits, F.lit(rule.name)).otherwise(name), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def judged(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], max_filter_bytes: int = 8 << 20) -> DataFrame:
    """page_id, host, path, rule, verdict, listed for every row of `pages`.

    `listed` has URLs to block in its column `url`; they are compared in canonical form. A URL that a rule fits
    has the verdict of the longest such rule; any other is blocked when it is listed, else allowed. A null URL
    or one without :// has an empty host and path, fits no rule and is allowed. Repeated rows are judged alike,
    repeated listings count once; other columns are ignored; empty tables are fine.
    """
    keys = host_and_path(listed.select("url")).select(canonical(F.col("host"), F.col("path")).alias("key"))
    keys = saved(keys.filter("key IS NOT NULL").distinct())
    bits, blocks = bloom_filter(keys, max_filter_bytes)
    ours = host_and_path(pages.select("page_id", "url")).withColumn("key", canonical(F.col("host"), F.col("path")))
    block, words = _bits(F.col("key"), blocks)
    ours = ours.withColumn("block", block)
    # At most max_filter_bytes: a bounded side.
    probed = ours.join(F.broadcast(bits), "block", "left")
    passes = F.lit(True)
    for i, w in enumerate(words):
        passes = passes & (F.coalesce(F.col(f"w{i}"), F.lit(0).cast("long")).bitwiseAND(w) == w)
    name, verdict = _rule(rules)
    probed = probed.select(
        "page_id", "host", "path", name.alias("rule"), verdict.alias("by_rule"),
        F.when(F.coalesce(passes, F.lit(False)) & F.col("key").isNotNull(), F.col("key")).alias("key"),
    )
    # URLs that the filter stops have no key left, and so join nothing; the salt spreads them too.
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS))
    copies = keys.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"), F.lit(True).alias("listed"))
    possible = probed.filter("key IS NOT NULL").withColumn("salt", salt).join(copies, ["key", "salt"], "left")
    stopped = probed.filter("key IS NULL").withColumn("listed", F.lit(None).cast("boolean"))
    out = possible.select(*stopped.columns).unionByName(stopped)
    hit = F.coalesce("listed", F.lit(False))
    return out.select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(hit, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), hit.alias("listed"),
    )
