"""URL rules: longest fit, subdomains, collisions, odd URLs."""

import numpy as np
import xxhash

from opinionlens.llm.urls import DigestArrays, build_digest_store, filter_urls, rule_rows

RULES = [("allow", "com/"), ("block", "Example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net"), ("block", "dup.org/x"), ("allow", "dup.org/x")]


def brute(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        rest = rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = []
    for verdict, rule in RULES:
        h, _, p = rule.partition("/")
        h, p = h.lower(), "/" + p
        if host and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h + p), h + p, verdict == "block"))
    if not fits:
        return host, path, None, "allow"
    _, rule, block = max(fits)
    return host, path, rule, "block" if block else "allow"


def test_matches_plain_version(spark):
    urls = [None, "", "no scheme.com/en/", "http://", "http://EXAMPLE.com/en/a?b#c", "https://www.example.com/en/", "https://a.www.example.com/en/x"]
    urls += ["http://myexample.com/en/", "http://x.net", "http://x.net/?q", "http://net/", "http://a.dup.org/xyz", "ftp://É.com/Ü#é", "a://b://c.com/d"]
    urls += ["http://example.com:80/en/", "http://example.com/EN/", "http://www.example.com#en", "x" * 100_000 + "://q.net/" + "y" * 100_000]
    df = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)] * 2, "page_id bigint, url string, host string").repartition(4)
    store = build_digest_store(rule_rows(spark, RULES), files=3)
    got = filter_urls(df, store).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got)) == sorted((i, *brute(u)) for i, u in enumerate(urls) for _ in range(2))
    assert filter_urls(df.limit(0), store).collect() == []
    nothing = build_digest_store(rule_rows(spark, RULES).limit(0))
    assert {r.verdict for r in filter_urls(df, nothing).collect()} == {"allow"}


def test_hashes_agree_and_collisions_are_told_apart(spark):
    from pyspark.sql import functions as F

    text = "bücher.example/ä"
    key = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert key == np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)).view(np.int64)
    arrays = object.__new__(DigestArrays)
    arrays.parts = [(np.array([5, 5, 9]), np.array([2, 4, 6]), np.frombuffer(b"aabbcc", np.uint8), np.array([1, 0, 1]))]
    assert arrays.find(np.array([5, 5, 5, 9, 7]), [b"bb", b"aa", b"zz", b"cc", b"aa"]).tolist() == [0, 1, -1, 1, -1]
