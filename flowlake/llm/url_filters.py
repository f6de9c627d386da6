"""URL filters: site rules, and a list of URLs behind a blocked Bloom filter.

A URL is judged by the longest rule that fits its host and path. Where none fits, the list
decides: URLs are brought to a canonical form, and those in the list are blocked.

The list meets the URLs in two steps. A Bloom filter of the listed forms is a table of
blocks: a key's hash names its block, a second one sets eight of the block's 256 bits, and a
block is the bitwise OR of its keys, an aggregate with map-side combine. The URLs meet the blocks in a
broadcast join on the block number, without a shuffle. Only possible hits go on to an exact join
with the list, which removes the false positives.

At scale: the broadcast has at most ``MAX_BLOCKS`` rows of five longs whatever the list's
size; a longer list fills the filter and lets more URLs on to the exact join, so it changes the
work and never the result. A URL that a third of the rows share is one row when the hits
meet the list, and what is confirmed returns to the hits under ``SALTS`` keys. Everything is DataFrame
expressions.

The canonical form has no scheme, user, port, leading ``www.``, trailing dots, fragment,
repeated or trailing slashes, index file or tracking parameters; unreserved punctuation is not
escaped, other parameters are sorted. Dot segments stay.

Defined cases: null and texts without ``://`` have an empty host and path, fit no rule and
are allowed; a URL with an empty host has no canonical form and is not listed; of rules of the same length that
fit, those that block come first; repeated rows and list entries are judged alike; an empty list
blocks nothing; columns named like the results are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from flowlake.session import materialize

BITS_PER_KEY = 16
BLOCK_BITS = 256
MAX_BLOCKS = 1 << 20
SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rewrites of the host and of the path, in order; and parameters that only say where a visitor came from.
HOST_STEPS = [(r"(?s)^.*@", ""), (r":[0-9]*\z", ""), (r"\.+\z", ""), (r"^www\.", "")]
PATH_STEPS = [
    ("%2[dD]", "-"), ("%2[eE]", "."), ("%5[fF]", "_"), ("%7[eE]", "~"),
    ("/+", "/"), (r"/(index|default)\.(html?|php|aspx?)\z", "/"), (r"/\z", ""),
]
TRACKING = r"^(utm_[^=]*|ref|ref_src|fbclid|gclid|dclid|msclkid|mc_cid|mc_eid|igshid|sessionid|phpsessid)(=|\z)"


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | host.endswith("." + self.host)
        return own & path.startswith(self.path)


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = after_scheme(url)
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def canonical(url: Column) -> Column:
    """The form under which a URL is listed; null if it has no host."""
    host, path = host_and_path(url)
    for pattern, to in HOST_STEPS:
        host = F.regexp_replace(host, pattern, to)
    for pattern, to in PATH_STEPS:
        path = F.regexp_replace(path, pattern, to)
    given = F.split(F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1), "&")
    kept = F.sort_array(F.filter(given, lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(host != "", F.concat(host, path, query))


def longest_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """A struct of the longest rule that fits and its verdict, or null. The rules are few and constant."""
    order = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block", r.name))
    cases = [F.when(r.fits(host, path), F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in order]
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*cases, none)


def bits(key: Column) -> list[Column]:
    """Four longs with two bits each: what a key sets in its block."""
    places = F.xxhash64(key, F.lit(1))
    one = lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(places, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
    return [one(2 * k).bitwiseOR(one(2 * k + 1)) for k in range(4)]


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bloom_blocks(keys: DataFrame, key: str, count: int, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """The filter as a table (block, w0, ..., w3) of at most ``max_blocks`` rows, and the number of blocks."""
    blocks = max(1, min(max_blocks, math.ceil(count * BITS_PER_KEY / BLOCK_BITS)))
    words = [F.bit_or(word).alias(f"__w{k}") for k, word in enumerate(bits(F.col(key)))]
    return keys.groupBy(block_of(F.col(key), blocks).alias("__block")).agg(*words), blocks


def judge(pages: DataFrame, listed: DataFrame, rules: list[Rule], url: str = "url", max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """The rows with host, path, canonical URL, rule, verdict, whether the filter let them pass, and whether they are listed.

    ``listed`` has the URLs of the list, in any form, in a column named ``url``.
    """
    results = ("host", "path", "canonical_url", "rule", "verdict", "possible", "listed")
    address = F.col(f"`{url}`").cast("string")
    keys = listed.select(canonical(F.col("url").cast("string")).alias("__key")).filter("__key is not null").distinct()
    keys = materialize(keys, "url-list")
    blocks, count = bloom_blocks(keys, "__key", keys.count(), max_blocks)
    blocks = materialize(blocks, "url-filter")

    host, path = host_and_path(address)
    rows = pages.drop(*[c for c in results if c != url]).withColumns({"host": host, "path": path, "canonical_url": canonical(address)})
    rows = rows.withColumn("__rule", longest_rule(rules, F.col("host"), F.col("path")))
    key = F.col("canonical_url")
    rows = rows.join(F.broadcast(blocks), block_of(key, count) == F.col("__block"), "left")
    all_set = F.lit(True)
    for k, word in enumerate(bits(key)):
        all_set = all_set & (F.col(f"__w{k}").bitwiseAND(word) == word)
    possible = F.coalesce(key.isNotNull() & all_set, F.lit(False))
    rows = rows.withColumn("possible", possible).drop("__block", *[f"__w{k}" for k in range(4)])

    others = rows.filter("not possible").withColumn("listed", F.lit(False))
    hits = materialize(rows.filter("possible"), "url-hits")
    confirmed = hits.select(key.alias("__key")).distinct().join(keys, "__key")
    salted = confirmed.select("__key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    dealt = hits.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    same = (F.col("canonical_url") == F.col("__key")) & (dealt["__salt"] == salted["__salt"])
    exact = dealt.join(salted, same, "left").withColumn("listed", F.col("__key").isNotNull()).select(*others.columns)

    by_list = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    verdict = F.coalesce(F.col("__rule.verdict"), by_list)
    judged = others.unionByName(exact).withColumns({"rule": F.col("__rule.rule"), "verdict": verdict})
    return judged.drop("__rule")
