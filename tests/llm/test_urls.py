"""URLs judged by rules and by a list, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from datamove.llm import urlfilter

URLS = [
    None, "", "no scheme", "http://", "https://A.Net", "https://a.net/", "http://x.example.NET/en/1?q#f", "http://example.net/en",
    "http://notexample.com/de/1", "http://www.example.com/de/1/", "http://b.org/fr/x", "http://b.org/FR/x", "http://net/x", "http://c.com?x://y/z",
    "http://d.com#frag", "ftp://m.d.com/a//", "http://www.d.com/a", "http://d.com/a?utm=1", "http://Ünï.com/ä", "x://y://z/w",
]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[: min([i for i in map(path.find, "?#") if i >= 0], default=len(path))]


def rule(host, path):
    fits = [r for r in urlfilter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def canonical(url):
    host, path = parts(url)
    for front in ("www.", "m."):
        if host.startswith(front):
            host = host[len(front) :]
            break
    return host + path.rstrip("/") if parts(url)[0] else None


@pytest.mark.parametrize("listed", [[], ["http://d.com/a", None, "http://d.com/a/"], ["https://a.net", "http://c.com/"]])
def test_matches_plain_python(spark, listed):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS + URLS[5:])], "page_id long, url string, verdict string")
    found = urlfilter.judge_urls(pages, spark.createDataFrame([(u,) for u in listed], "url string"), ["page_id"]).collect()
    names = {canonical(u) for u in listed} - {None}
    assert len(found) == pages.count()
    for row in found:
        url = (URLS + URLS[5:])[row["page_id"]]
        host, path = parts(url)
        fits = rule(host, path)
        verdict = fits.verdict if fits else ("block" if canonical(url) in names else "allow")
        assert (row["host"], row["path"], row["rule"], row["verdict"]) == (host, path, fits and fits.name, verdict), url


def test_filter_lets_every_listed_key_through_and_few_others(spark):
    rng = random.Random(1)
    keys = [f"k{rng.random()}" for _ in range(2000)]
    listed = spark.createDataFrame([(k,) for k in keys], "k string")
    blocks = len(keys) // urlfilter.URLS_PER_BLOCK
    table = urlfilter.bloom_blocks(listed, "k", blocks)
    assert urlfilter.possibly_listed(listed, "k", table, blocks).count() == 2000
    others = spark.range(20_000).select(F.concat(F.lit("o"), "id").alias("k"))
    assert urlfilter.possibly_listed(others, "k", table, blocks).count() < 100


def test_empty_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urlfilter.judge_urls(pages, pages, ["page_id"]).collect() == []


def test_the_join_alone_blocks_pages(spark):
    from datamove.llm.queries import QUERIES

    directory = "/root/testdata/sf0.1"
    judged = QUERIES["op3_url_filter"](spark, directory).where("rule IS NULL").select("page_id", "verdict")
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{directory}/pages.parquet").select("page_id", "url").collect()}
    spellings = {}
    for url in urls.values():
        host, path = parts(url)
        spellings.setdefault((host.removeprefix("www.").removeprefix("m.") if host.startswith(("www.", "m.")) else host, path.rstrip("/")), set()).add(url)
    several = {u for found in spellings.values() if len(found) > 1 for u in found}
    rows = judged.collect()
    assert {r["page_id"] for r in rows if r["verdict"] == "block"} == {r["page_id"] for r in rows if urls[r["page_id"]] in several} != set()
