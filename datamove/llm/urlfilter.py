"""URLs judged by rules of host and path, and by a list behind a blocked Bloom filter.

A listed URL sets eight bits, one in each 64-bit word of one block of 512 bits.  A URL whose
eight bits are all set may be listed; those, and no others, go to an exact hash join.  The
filter is a table of blocks joined on the block's number, so it may outgrow any one machine.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from datamove.llm.arrow import quoted

# Bits a listed URL may take; 512 bits hold 32 of them, about one false hit in 2,000.
URLS_PER_BLOCK = 32

# Odd factors that pick one bit of 64 in each word of a block, fixed values.
BIT_FACTORS = (
    0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31,
)


@dataclass(frozen=True)
class Rule:
    """``host/path``: fits the host with its subdomains, and paths that start with the path."""

    name: str
    verdict: str

    @property
    def host(self) -> str:
        return self.name.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.name.partition("/")[2]


# Neither a rule nor the lack of a host has decided.
OPEN = "__verdict__ IS NULL AND __url__ IS NOT NULL"

RULES = (
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
)


def lowered(text: Column) -> Column:
    """A-Z alone in lower case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or where there is no ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return lowered(host), path


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without a last slash; null for a URL without host."""
    bare = F.regexp_replace(host, r"^(www|m)\.", "")
    return F.when(host != "", F.concat(bare, F.regexp_replace(path, r"/+$", "")))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, the first of equals; null without one."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: -len(r.name))[::-1]:
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _bits(key: Column) -> list[Column]:
    """The bit of each of the eight words of a block."""
    low = F.xxhash64(key, F.lit(1)).bitwiseAND(F.lit(0x7FFFFFFF))
    places = [F.shiftrightunsigned((low * F.lit(f)).bitwiseAND(F.lit(0xFFFFFFFF)), 26).cast("int") for f in BIT_FACTORS]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("long")).alias("block")


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """``block`` and its words ``w0`` to ``w7``, one row for each block with bits set.

    Null keys set none.
    """
    bits = keys.where(quoted(key).isNotNull()).select(
        _block(quoted(key), blocks), *[b.alias(f"w{i}") for i, b in enumerate(_bits(quoted(key)))]
    )
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)])


def possibly_listed(rows: DataFrame, key: str, filter_blocks: DataFrame, blocks: int) -> DataFrame:
    """The rows whose eight bits are all set; no row with a listed key is missing."""
    probe = rows.where(quoted(key).isNotNull()).withColumn("__block__", _block(quoted(key), blocks))
    for i, bit in enumerate(_bits(quoted(key))):
        probe = probe.withColumn(f"__b{i}__", bit)
    words = filter_blocks.select(F.col("block").alias("__block__"), *[F.col(f"w{i}").alias(f"__w{i}__") for i in range(8)])
    found = probe.join(words, "__block__")
    for i in range(8):
        found = found.where(F.col(f"__w{i}__").bitwiseAND(F.col(f"__b{i}__")) != 0)
    return found.select(*[quoted(c) for c in rows.columns])


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    keep: Sequence[str],
    *,
    url: str = "url",
    listed_url: str = "url",
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """``host``, ``path``, the fitting ``rule`` and a ``verdict`` for each page.

    The longest fitting rule decides; a page that none fits is blocked if its canonical URL is
    among those of ``listed``, else allowed.  Returns the ``keep`` columns before these.

    A null URL and one without ``://`` have an empty host and path, fit no rule, are not listed
    and so allowed.  Repeated pages are each judged; repeated listed URLs count once; with an
    empty list only rules block.  The size of the filter follows the list: two small numbers
    reach the driver, and Spark broadcasts its blocks only below its own threshold.
    """
    host, path = url_parts(quoted(listed_url))
    keys = listed.select(canonical(host, path).alias("__url__")).where("__url__ IS NOT NULL").distinct()
    blocks = max(1, -(-keys.count() // URLS_PER_BLOCK))
    host, path = url_parts(quoted(url))
    base = pages.select(*[quoted(c) for c in keep], host.alias("__host__"), path.alias("__path__"))
    rule, verdict = fitting_rule(F.col("__host__"), F.col("__path__"), rules)
    base = base.select("*", rule.alias("__rule__"), verdict.alias("__verdict__"), canonical(F.col("__host__"), F.col("__path__")).alias("__url__"))
    # Distinct URLs are asked about once, so a URL that many pages share is one row of the join.
    open_, decided = base.where(OPEN), base.where(f"NOT ({OPEN})").withColumn("__listed__", F.lit(None).cast("string"))
    asked = open_.select("__url__").distinct()
    hits = possibly_listed(asked, "__url__", bloom_blocks(keys, "__url__", blocks), blocks)
    hits = hits.join(keys.hint("shuffle_hash"), "__url__").select("__url__", F.lit("block").alias("__listed__"))
    judged = open_.join(hits, "__url__", "left").unionByName(decided)
    return judged.select(
        *[quoted(c) for c in keep],
        F.col("__host__").alias("host"),
        F.col("__path__").alias("path"),
        F.col("__rule__").alias("rule"),
        F.coalesce("__verdict__", "__listed__", F.lit("allow")).alias("verdict"),
    )
