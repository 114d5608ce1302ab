import re

import pytest
from pyspark.sql import functions as F

from placemill.llm import urlfilter as U
from placemill.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "https://A.Example.ORG/es/x", "https://example.org/en/1x", "https://example.org/en/2",
    "http://org/", "http://org", "http://xorg/", "http://a.b.COM/de/?q#f", "http://com/fr/", "http://com/xx", "x://y://z/fr/",
    "http://h.net?a=/b#c/d", "http://h.net#?x", "http://u:p@h.net:80/p", "http://É.net/", "http://www.h.net/a/?utm_a=1&b=2&utm_c=3#z",
    "ftp://h.net/a?b=2", "http://h.net/a/b//", "http://h.net/a/b?utm_x", "http://listed.net/1", "https://www.listed.net/1/?utm_z=1",
]


def _plain(url):
    """Host, path, rule and verdict by the rules alone."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.sub("[A-Z]", lambda match: match[0].lower(), re.split("[/?#]", rest)[0])
    path = re.split("[?#]", rest[len(re.split("[/?#]", rest)[0]) :])[0]
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda rule: len(rule.name), default=None)
    return host, path, best and best.name, best and best.verdict


@pytest.mark.parametrize("broadcast_bytes", [U.BROADCAST_BYTES, 0])
def test_rules_and_list(spark, broadcast_bytes):
    pages = spark.createDataFrame(list(enumerate(URLS)) * 3, "page_id int, url string")
    listed = spark.createDataFrame([("listed.net/1",), ("listed.net/1",), (None,), ("h.net/a?b=2",)], "key string")
    rows = U.filter_urls(pages, listed, URL_RULES, broadcast_bytes=broadcast_bytes).collect()
    assert len(rows) == 3 * len(URLS)
    for row in rows:
        host, path, rule, verdict = _plain(row["url"])
        on_list = row["url"] in URLS[-2:] + ["http://www.h.net/a/?utm_a=1&b=2&utm_c=3#z", "ftp://h.net/a?b=2"]
        wanted = verdict or ("block" if on_list else "allow")
        # Canonical forms keep a path's inner slash, so /a/?b=2 is not /a?b=2 unless the path's end was cut.
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == wanted, row["url"]


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(4000).select(F.concat(F.lit("host/"), F.col("id").cast("string")).alias("key"))
    others = spark.range(4000, 24000).select(F.concat(F.lit("host/"), F.col("id").cast("string")).alias("key"))
    blocks = 4000 * U.BITS_EACH // 512
    filled = U.bloom_filter(keys, "key", blocks)
    passed = U._bits(F.col("key"))
    hit = F.lit(True)
    for word, bit in enumerate(passed):
        hit &= F.coalesce(F.col(f"w{word}").bitwiseAND(bit) != 0, F.lit(False))
    count = lambda frame: frame.join(filled, U._block(F.col("key"), blocks) == F.col("block")).filter(hit).count()
    assert filled.count() <= blocks and count(keys) == 4000 and count(others) < 100


def test_plan_is_native(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id int, url string")
    plan = U.filter_urls(pages, spark.createDataFrame([("a.net",)], "key string"), URL_RULES)
    assert not re.search("Python|Arrow", plan._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("broadcast_bytes", [U.BROADCAST_BYTES, 0])
def test_clashing_names_and_scans(spark, tmp_path, broadcast_bytes):
    rows = [(k, url, "h", "v", "w", "x") for k, url in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id int, url string, Host string, VERDICT string, w0 string, `a.b` string")
    pages.write.parquet(f"{tmp_path}/pages")
    pages = spark.read.parquet(f"{tmp_path}/pages")
    listed = pages.select(U.canonical(F.col("url")).alias("key")).filter("key LIKE 'listed%'")
    out = U.filter_urls(pages, listed, URL_RULES, broadcast_bytes=broadcast_bytes)
    assert out.columns == ["page_id", "url", "w0", "a.b", "host", "path", "rule", "verdict"]
    found = {row["page_id"]: (row["host"], row["verdict"], row["w0"], row["a.b"]) for row in out.collect()}
    assert len(found) == len(URLS) and found[len(URLS) - 1] == ("www.listed.net", "block", "w", "x")
    assert found[0] == ("", "allow", "w", "x")
    # One for those that pass the filter and one for the rest, or two where that is joined by block; none for the list.
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[page_id", plan)) == (2 if broadcast_bytes else 3)
