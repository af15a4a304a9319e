import re

import numpy as np
import pytest

from carelens.llm import url_filter
from carelens.llm.queries import URL_RULES, op3_url_filter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        found = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.DOTALL)
        host, path = found[1].translate(LOWER), found[2]
    fits = [
        (len(h + p), len(h), h + p, verdict)
        for h, p, verdict in rules
        if h is not None and p is not None and (host == h or host.endswith(f".{h}")) and path.startswith(p)
    ]
    rule = max(fits, default=(0, 0, None, "allow"))
    return host, path, rule[2], rule[3]


RULES = [
    *URL_RULES,
    ("", "", "block"),
    ("deep.sub.example.net", "/a/b/c", "block"),
    ("example.net", "/", "allow"),
    ("example.net", "/", "block"),
    ("é.example", "/", "block"),
    (None, "/", "block"),
]
URLS = [
    None,
    "",
    "no scheme/path",
    "http://",
    "http://org",
    "https://ORG/",
    "https://a.b.Example.ORG/es/x?y#z",
    "https://example.org/en/148.html",
    "https://notexample.org/es/",
    "https://x.com/fr/",
    "https://x.com/fr",
    "ftp://www.com/de/a://b",
    "https://user@host.com:80/de/",
    "https://deep.sub.example.net/a/b/cd",
    "https://example.net?q=/a/b/c",
    "http://É.example/",
    "http://é.example/#://",
    "http://a..com/de/",
    "http://x.org\n/y\nz",
    "http://" + "a." * 3000 + "com/de/" + "p" * 30000,
]


@pytest.fixture
def pages(spark):
    def build(urls):
        rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
        return rows.selectExpr("*", "'x' AS html", "'x' AS host", "'x' AS path", "'x' AS rule", "'x' AS verdict")

    return build


@pytest.mark.parametrize("rules", [RULES, URL_RULES, RULES[-1:]])
@pytest.mark.parametrize("filter_bytes", [1 << 20, 32])
def test_awkward_urls(spark, pages, rules, filter_bytes):
    got = url_filter.judge(pages([*URLS, *URLS]), url_filter.rules_frame(spark, rules), filter_bytes)
    expected = sorted((i, *brute(url, rules)) for i, url in enumerate([*URLS, *URLS]))
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_empty_tables(spark, pages):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert url_filter.judge(pages([]), url_filter.rules_frame(spark, RULES)).collect() == []
    got = url_filter.judge(pages(URLS), none).collect()
    assert {r.verdict for r in got} == {"allow"} and {r.rule for r in got} == {None}


def test_thousands_of_rule_shapes_and_a_hot_host(spark, pages):
    """3,000 lengths of path, and every page on one host; the plan is as long as with one rule."""
    path = "/" + "ab" * 1500
    rules = [("hot.com", path[:n], "block" if n % 2 else "allow") for n in range(1, 3001)]
    urls = [f"http://{sub}hot.com{path[:n]}" for n in range(0, 3001, 30) for sub in ("", "www.", "not")]
    listed = url_filter.judge(pages(urls), url_filter.rules_frame(spark, rules))
    got = {r.page_id: (r.rule, r.verdict) for r in listed.collect()}
    for i, url in enumerate(urls):
        n = len(url.split("hot.com")[1])
        fits = n and "nothot" not in url
        assert got[i] == ((f"hot.com{path[:n]}", "block" if n % 2 else "allow") if fits else (None, "allow"))
    short = url_filter.judge(pages(urls), url_filter.rules_frame(spark, rules[:1]))
    size = [len(f._jdf.queryExecution().analyzed().treeString().splitlines()) for f in (short, listed)]
    assert size[0] == size[1]


def test_no_listed_key_is_missed_and_few_others_pass(spark):
    rules = spark.range(5000).selectExpr("concat('h', id, '.com') AS host", "'/' AS path", "'block' AS verdict")
    bloom = url_filter.bloom_of(rules)
    keys = rules.selectExpr("xxhash64(host, path) AS listed", "xxhash64(host) AS other").toPandas()
    assert bloom.may_hold(keys["listed"].to_numpy()).all()
    assert bloom.may_hold(keys["other"].to_numpy()).mean() < 0.02
    small = url_filter.bloom_of(rules, filter_bytes=1024)
    assert small.bits.nbytes == 1024 and small.may_hold(keys["listed"].to_numpy()).all()


def test_blocks_are_spread():
    hashes = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 100_000)
    block, masks = url_filter.placed(hashes, 50)
    assert np.bincount(block, minlength=50).min() > 1500
    assert (np.bitwise_count(masks) == 1).all()


def test_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()
    got = sorted((tuple(r) for r in op3_url_filter(spark, sf_dir).collect()), key=repr)
    assert got == sorted(((r.page_id, *brute(r.url, URL_RULES)) for r in rows), key=repr)
    assert {r[3] for r in got} >= {"org/", "com/fr/", "com/de/"}
