"""URL filters: rules by host and path, then a list of canonical URLs behind a blocked Bloom filter.

A rule such as ``example.com/en/`` fits its host and all subdomains when the path starts
with the rule's; the longest fitting rule decides. A URL that no rule fits is blocked if
its canonical form is listed. The list becomes a blocked Bloom filter: a URL belongs to
one block of 8 words of 64 bits and sets one bit in each word, so a probe reads one row
of the filter. The blocks grow in number with the list (``bits_per_key``). Possible hits
alone go on to an exact hash join with the list, which removes the false positives.
DataFrame functions only.

The filter and the list are broadcast only while their measured bytes stay within
``broadcast_bytes``. Beyond it, both joins shuffle: the probe on the block, the exact one
on the URL and a salt, with the list repeated once per salt, since one URL may hold a
third of all pages.

Null URLs and URLs without ``://`` have an empty host and path and no canonical form: no
rule and no listed URL fits them, the verdict is allow. Repeated rows keep a verdict each.
An empty list blocks nothing. Extra columns of the pages are kept by ``judged`` unless
they clash with its own, which replace them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import free_name, stored, table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORDS = 8  # 64-bit words in a block; 6 bits of a 64-bit hash choose the bit in each
BITS_PER_KEY = 16
BROADCAST_BYTES = 64 << 20
SALTS = 16
MAX_RULES = 1000

# The rules of the query and the marks of junk pages.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
JUNK = r"(#{3}|%{3}|\${3}|\*{3})"
# parameters that do not change the page
TRACKING = "^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)"


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without www. and default port, path without closing slashes, sorted parameters without tracking.

    Scheme and fragment go. Null for a URL without a host.
    """
    host = F.regexp_replace(host_of(url), "^www[.]|:(80|443)$", "")
    path = F.regexp_replace(path_of(url), "(/index[.]html?)?/*$", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^?#]*[?]([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    asked = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, asked))


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str]], pick: int) -> Column:
    """Part ``pick`` of the longest rule that fits (0: verdict, 1: rule), null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules exceed {MAX_RULES}, the bound for one expression")
    fitting = None
    for rule in sorted(rules, key=lambda r: (-len(r[1]), -r[1].index("/"), r[1])):
        name, slash, rest = rule[1].partition("/")
        at_host = (host == name) | F.endswith(host, F.lit("." + name))
        hit = at_host & F.startswith(path, F.lit(slash + rest))
        fitting = F.when(hit, rule[pick]) if fitting is None else fitting.when(hit, rule[pick])
    return F.lit(None).cast("string") if fitting is None else fitting


def block_of(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def bits_of(url: Column) -> list[Column]:
    """The bit of each word, from a second hash of the URL."""
    spread = F.xxhash64(url, F.lit(1))
    places = (F.shiftrightunsigned(spread, 6 * k).bitwiseAND(F.lit(63)) for k in range(WORDS))
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), p.cast("int")) for p in places]


def listing(urls: DataFrame) -> tuple[DataFrame, int, int]:
    """Distinct canonical forms of the column ``url``, stored, with their number and bytes."""
    known = urls.select(canonical(F.col("url")).alias("listed")).where(F.col("listed").isNotNull()).distinct()
    kept = stored(known, "listed")
    n, size = kept.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("listed")), F.lit(0))).first()
    return kept, n, size + 16 * n


def bloom(listed: DataFrame, n: int, bits_per_key: int = BITS_PER_KEY) -> tuple[DataFrame, int]:
    """Rows (block, w0..w7) of the filter of column ``listed``, and the number of blocks."""
    blocks = max(1, -(-n * bits_per_key // (64 * WORDS)))
    url = F.col("listed")
    marked = listed.select(block_of(url, blocks).alias("block"), *(b.alias(f"w{k}") for k, b in enumerate(bits_of(url))))
    return marked.groupBy("block").agg(*(F.bit_or(f"w{k}").alias(f"w{k}") for k in range(WORDS))), blocks


def judged(
    pages: DataFrame,
    listed_urls: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    bits_per_key: int = BITS_PER_KEY,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The pages with host, path, rule, canonical_url and verdict, from their column ``url``."""
    listed, n, size = listing(listed_urls)
    words, blocks = bloom(listed, n, bits_per_key)
    words = stored(words, "bloom")
    if blocks * (WORDS + 1) * 8 <= broadcast_bytes:
        words = F.broadcast(words)
    own = ("host", "path", "rule", "canonical_url", "verdict")
    rest = pages.drop(*own)
    if "url" not in rest.columns:
        raise ValueError("pages need a column url")
    url = F.col("url")
    parsed = rest.withColumns({"host": host_of(url), "path": path_of(url), "canonical_url": canonical(url)})
    host, path = F.col("host"), F.col("path")
    first = parsed.withColumns({"rule": ruled(host, path, rules, 1), "verdict": ruled(host, path, rules, 0)})
    # only URLs without a rule are looked up
    open_url = F.when(F.col("rule").isNull(), F.col("canonical_url"))
    asked, block = free_name(first, "__asked"), free_name(first, "__block")
    names = [free_name(first, f"__w{k}") for k in range(WORDS)]
    filter_rows = words.select(F.col("block").alias(block), *(F.col(f"w{k}").alias(name) for k, name in enumerate(names)))
    probe = first.withColumn(asked, open_url).join(
        filter_rows, F.when(F.col(asked).isNotNull(), block_of(F.col(asked), blocks)) == F.col(block), "left"
    )
    possible = F.lit(True)
    for name, bit in zip(names, bits_of(F.col(asked))):
        possible = possible & (F.col(name).bitwiseAND(bit) != 0)
    marked = probe.withColumn(asked, F.when(possible, F.col(asked))).drop(block, *names)
    passed = marked.where(F.col(asked).isNotNull())
    columns = [c for c in first.columns if c != "verdict"]
    clear = marked.where(F.col(asked).isNull()).select(*columns, F.coalesce("verdict", F.lit("allow")).alias("verdict"))
    return clear.unionByName(exactly(passed, listed, asked, size <= broadcast_bytes).select(*columns, "verdict"))


def exactly(passed: DataFrame, listed: DataFrame, asked: str, small: bool) -> DataFrame:
    """Possible hits with their verdict by a hash join with the whole list on the URL itself."""
    hit, salt = free_name(passed, "__listed"), free_name(passed, "__salt")
    exact = listed.select(F.col("listed").alias(hit))
    if small:
        found = passed.join(F.broadcast(exact), F.col(asked) == F.col(hit), "left")
    else:
        other = free_name(passed, "__other_salt")
        salted = passed.withColumn(salt, F.pmod(F.xxhash64(*(F.col(c) for c in passed.columns)), F.lit(SALTS)))
        copies = exact.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("shuffle_hash")
        found = salted.join(copies, (F.col(asked) == F.col(hit)) & (F.col(salt) == F.col(other)), "left")
    return found.withColumn("verdict", F.when(F.col(hit).isNotNull(), "block").otherwise("allow"))


def junk_urls(pages: DataFrame) -> DataFrame:
    """URLs of pages whose html carries runs of junk symbols: every other copy of them is blocked as well."""
    return pages.where(F.col("html").rlike(JUNK)).select("url")


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judged(pages.select("page_id", "url"), junk_urls(pages)).select(
        "page_id", "host", "path", "rule", "verdict", "canonical_url"
    )


_CANONICAL = f"""CASE WHEN host <> '' THEN regexp_replace(host, '^www[.]|:(80|443)$', '', 'g')
    || regexp_replace(path, '(/index[.]html?)?/*$', '')
    || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END"""

ORACLE_SQL = f"""
WITH parts AS (
    SELECT page_id, html,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{UPPER.lower()}') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
        list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*[?]([^#]*)', 1), '&'),
            lambda p: p <> '' AND NOT regexp_matches(p, '{TRACKING}'))) AS kept
    FROM pages),
forms AS (SELECT *, {_CANONICAL} AS canonical_url FROM parts),
listed AS (SELECT DISTINCT canonical_url FROM forms WHERE regexp_matches(html, '{JUNK}')),
rules(verdict, rule, name, start) AS (
    SELECT v, r, split_part(r, '/', 1), substr(r, strpos(r, '/')) FROM (VALUES {", ".join(map(str, RULES))}) t(v, r)),
fitting AS (
    SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(r.verdict, length(rule)) AS verdict
    FROM forms f JOIN rules r
        ON (f.host = r.name OR ends_with(f.host, '.' || r.name)) AND starts_with(f.path, r.start)
    GROUP BY page_id)
SELECT f.page_id, host, path, rule,
    coalesce(verdict, CASE WHEN f.canonical_url IN (SELECT canonical_url FROM listed WHERE canonical_url IS NOT NULL)
        THEN 'block' ELSE 'allow' END) AS verdict,
    f.canonical_url
FROM forms f LEFT JOIN fitting USING (page_id)
"""
