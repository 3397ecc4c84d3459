import numpy as np
from pyspark.sql import functions as F

from sluice.llm import queries, url_filter

SCHEMA = "page_id long, url string, host string, hit int, rule string, entry string, canonical string"


def test_parts_and_rules(spark):
    cases = {
        "HTTP://WWW.Example.COM/en/x?q#f": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "https://example.com/en/": ("example.com", "/en/", "example.com/en/", "block"),
        "https://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://badexample.com/en/": ("badexample.com", "/en/", "com/", "allow"),
        "https://example.com": ("example.com", "", None, "allow"),
        "https://x.net/es/1": ("x.net", "/es/1", "net/es/", "block"),
        "https://net/fr/": ("net", "/fr/", "net/fr/", "block"),
        "https://x.net/es": ("x.net", "/es", None, "allow"),
        "x://É.NET?a://b/fr/": ("É.net", "", None, "allow"),
        "://h/p": ("h", "/p", None, "allow"),
        "no scheme.com/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "h", 1, "r", "e", "c") for i, u in enumerate(cases)], SCHEMA)
    none = spark.createDataFrame([], "url string")
    rows = url_filter.judged(pages, queries.URL_RULES, none).collect()
    assert {r.url: tuple(r.judged)[:4] for r in rows} == cases
    assert url_filter.judged(pages.limit(0), queries.URL_RULES, none).collect() == []


def test_canonical(spark):
    same = ["http://www.a.org/x/", "https://a.org/x", "https://M.A.org/x#top", "https://a.org/x/?utm_source=feed&ref=x", "http://a.org/x?&"]
    urls = [*same, "http://a.org/x?b=2&a=1&ref=q", "http://a.org/x?reference=1", "x"]
    found = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(url_filter.canonical(F.col("u"))).collect()]
    assert found == ["a.org/x"] * 5 + ["a.org/x?a=1&b=2", "a.org/x?reference=1", None]


def test_filter_has_no_false_negatives_and_a_bounded_size(spark):
    listed = spark.range(3000).select(F.concat(F.lit("h.org/"), F.col("id").cast("string")).alias("url"))
    other = spark.range(3000, 23000).select(F.concat(F.lit("h.org/"), F.col("id").cast("string")).alias("url"))
    hashes = lambda df: np.array([r[0] for r in df.select(F.xxhash64("url")).collect()])
    for limit, most in ((8 << 20, 0.01), (1024, 1.0)):
        bloom = url_filter.bloom(listed, max_bytes=limit)
        assert bloom.blocks.nbytes <= limit
        assert bloom.passes(hashes(listed)).all()
        assert bloom.passes(hashes(other)).mean() <= most
    assert not url_filter.bloom(listed.limit(0)).passes(hashes(other)).any()


def test_list_is_exact_however_full_the_filter(spark, monkeypatch):
    full = url_filter.bloom
    monkeypatch.setattr(url_filter, "bloom", lambda listed: full(listed, max_bytes=32))  # one block: nearly all passes
    pages = spark.range(2000).select("id", F.concat(F.lit("http://h.org/"), (F.col("id") % 700).cast("string")).alias("url"))
    listed = spark.range(0, 700, 3).select(F.concat(F.lit("h.org/"), F.col("id").cast("string")).alias("url"))
    listed = listed.unionByName(listed).unionByName(spark.createDataFrame([(None,)], "url string"))
    rows = url_filter.judged(pages, (), listed).collect()
    assert len(rows) == 2000
    assert all(r.judged.listed == (r.id % 700 % 3 == 0) == (r.judged.verdict == "block") for r in rows)
