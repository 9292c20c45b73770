from tidemark.llm import urls
from tidemark.llm.queries import RULES


def judged(spark, links, listed=()):
    pages = spark.createDataFrame(list(enumerate(links)), "page_id long, url string")
    pages = pages.selectExpr("*", "'x' AS host", "'y' AS block")
    listed = spark.createDataFrame([(u,) for u in listed], "listed_url string")
    rows = urls.judge_urls(pages, RULES, listed).collect()
    return {r["page_id"]: r for r in rows}


def test_longest_rule_wins(spark):
    links = [
        "https://A.Example.NET/en/1?x#y",
        "http://example.net/de/1",
        "http://net/a",
        "http://badexample.com/de/",
        "http://example.com/de/q",
        "ftp://x.org/fr/",
        "http://x.net",
    ]
    found = judged(spark, links)
    assert [found[i]["rule"] for i in range(7)] == [
        "example.net/en/", "net/", "net/", None, "example.com/de/", "org/fr/", None,
    ]
    assert [found[i]["verdict"] for i in range(7)] == [
        "allow", "block", "block", "allow", "block", "allow", "allow",
    ]
    assert (found[0]["host"], found[0]["path"]) == ("a.example.net", "/en/1")


def test_list_is_exact_behind_the_filter(spark):
    links = [f"http://h{i}.com/p{i}/" for i in range(2000)] * 2
    listed = [f"h{i}.com/p{i}" for i in range(0, 2000, 3)] + ["h1.com/other", None]
    found = judged(spark, links, listed)
    assert len(found) == 4000
    assert all((r["verdict"] == "block") == (i % 2000 % 3 == 0) for i, r in found.items())


def test_filter_passes_few_others(spark):
    wanted = spark.range(2000).selectExpr("concat('a', id) AS listed_url")
    blocks = urls.bloom_blocks(wanted, 2000 * urls.BITS_PER_URL // 256).collect()
    ones = sum(bin(r[f"bits{i}"] & (2**64 - 1)).count("1") for r in blocks for i in range(4))
    assert ones / (256 * len(blocks)) < 0.4


def test_no_url_no_list_no_pages(spark):
    found = judged(spark, [None, "", "no scheme", "http://", "x\nhttp://a.com/b"])
    assert {r["verdict"] for r in found.values()} == {"allow"}
    assert [found[i]["host"] for i in range(5)] == ["", "", "", "", "a.com"]
    pages = spark.createDataFrame([], "page_id long, url string")
    listed = spark.createDataFrame([], "listed_url string")
    assert urls.judge_urls(pages, RULES, listed).count() == 0
