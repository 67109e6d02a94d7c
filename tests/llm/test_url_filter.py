"""URL rules and the blocked Bloom filter against plain Python."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import url_filter

URLS = [
    "http://a.com/", "http://a.com", "https://WWW.Example.com/en/x", "http://example.com/en/", "http://example.com/EN/",
    "http://m.example.com/en/1", "http://x.www.example.com/en/1?q", "http://badexample.com/en/1", "http://net/es/1",
    "http://s.net/es/", "http://s.net/es", "http://s.net/fr/9#z", "http://s.net/de/9", "ftp://s.org?x=1/2", "http://s.org#a://b/c",
    "nothing", "", None, "://", ":///en/", "http://é.org/ä?b=2&a=1&utm_source=k&ref=z#f", "https://www.é.org/ä/?a=1&b=2",
    "http://s.org:80/index.html", "https://s.org/", "a://b://c.com/x", "http://s.org/\nx?y\nz", "http://com/x", "http://.com/x",
]


def parts(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def rule_of(host: str, path: str) -> tuple:
    fits = []
    for verdict, rule in url_filter.RULES:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def canon(url: str | None) -> str | None:
    host, path = parts(url)
    if not host:
        return None
    host = re.sub(r"^www[.]|:(80|443)$", "", host)
    path = re.sub(r"(/index[.]html?)?/*\Z", "", path, count=1)
    rest = url.split("://", 1)[1].split("#")[0]
    asked = rest.split("?", 1)[1].split("&") if "?" in rest else []
    kept = sorted(p for p in asked if p and not re.match(url_filter.TRACKING, p))
    return host + path + ("?" + "&".join(kept) if kept else "")


def expected(urls, listed) -> list[tuple]:
    known = {canon(u) for u in listed} - {None}
    rows = []
    for k, url in enumerate(urls):
        host, path = parts(url)
        rule, verdict = rule_of(host, path)
        rows.append((k, host, path, rule, verdict or ("block" if canon(url) in known else "allow")))
    return rows


def pages_of(spark, urls):
    rows = [(k, u, "h", 1, "v", "x") for k, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id bigint, url string, verdict string, __asked int, __block string, __w0 string")


# one bit per key makes nearly every probe a possible hit; no broadcast takes the salted joins
@pytest.mark.parametrize("options", [{}, {"bits_per_key": 1}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "bits_per_key": 1}])
def test_judged_equals_plain_python(spark, options):
    urls = URLS + [f"https://www.h{k % 40}.org/p/{k % 90}?utm_source=u&k={k % 3}" for k in range(600)] + ["http://s.org/hot"] * 300
    listed = ["http://s.org/hot/?ref=1", "http://é.org/ä?a=1&b=2", "http://s.net/es/", "nothing", None] + urls[40:600:7] * 2
    got = url_filter.judged(pages_of(spark, urls), spark.createDataFrame([(u,) for u in listed], "url string"), **options)
    rows = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect())
    assert got.columns.count("verdict") == 1 and "__asked" in got.columns
    assert rows == expected(urls, listed)
    assert {r[4] for r in rows if r[3] is None} == {"allow", "block"}


def test_false_positives_of_the_filter_are_few_and_none_is_missed(spark):
    listed = spark.range(20_000).select(F.concat(F.lit("h.org/"), "id").alias("listed"))
    words, blocks = url_filter.bloom(listed, 20_000)
    assert words.count() <= blocks == 625
    asked = spark.range(40_000).select("id", F.concat(F.lit("h.org/"), "id").alias("u")).withColumn("block", url_filter.block_of(F.col("u"), blocks))
    hit = F.lit(True)
    for k, bit in enumerate(url_filter.bits_of(F.col("u"))):
        hit = hit & (F.col(f"w{k}").bitwiseAND(bit) != 0)
    found = {r.id for r in asked.join(words, "block").where(hit).collect()}
    assert set(range(20_000)) <= found
    assert len(found) - 20_000 < 0.01 * 20_000


def test_empty_list_empty_pages_no_rules(spark):
    none = spark.createDataFrame([], "url string")
    rows = url_filter.judged(pages_of(spark, URLS), none).collect()
    assert sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in rows) == expected(URLS, [])
    assert url_filter.judged(pages_of(spark, URLS), none, rules=()).where("verdict <> 'allow' or rule is not null").count() == 0
    assert url_filter.judged(pages_of(spark, []), none).count() == 0
    with pytest.raises(ValueError):
        url_filter.ruled(F.col("a"), F.col("b"), [("allow", "x/")] * 1001, 0)


def test_null_ids_and_repeated_pages_keep_a_verdict_each(spark):
    rows = [(None, "http://s.org/a"), (None, "http://s.org/a"), (1, "http://s.org/b"), (1, "http://s.org/b")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    got = url_filter.judged(pages, spark.createDataFrame([("http://s.org/a",)], "url string"), broadcast_bytes=0).collect()
    assert sorted((str(r.page_id), r.verdict) for r in got) == [("1", "allow")] * 2 + [("None", "block")] * 2


def test_query_blocks_other_copies_of_junk_pages(spark, tmp_path):
    rows = [
        (1, "http://s.org/a", "<p>x### y%%%"), (2, "https://www.s.org/a/?utm_source=q#t", "<p>clean"), (3, "http://s.org/b", None),
        (4, None, "###"), (5, "http://t.com/a", "$$$"), (None, "http://s.org/a?ref=1", ""),
    ]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.op13_url_filter(spark, str(tmp_path)).collect()}
    assert got == {
        1: (None, "block"), 2: (None, "block"), 3: (None, "allow"), 4: (None, "allow"), 5: ("com/", "allow"), None: (None, "block"),
    }
