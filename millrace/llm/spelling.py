"""Spelling variant grouping by reduced-alphabet generation.

Two words are near if they differ by exactly one inserted, deleted or replaced code
point. Letters are hashed to ``symbols`` symbols, so a word becomes a reduced word; near
words have reduced words that are equal or one edit apart. Every word generates the full
one-edit neighbourhood of its reduced word over the small alphabet, which joins the
reduced vocabulary; candidates are verified on the original strings. With ``s`` symbols
and length ``L`` that is about 2 s L rows a word, whatever the script, and each candidate
pair is met once, as a neighbourhood holds a reduced word once.

A word's form is its near word of largest count (ties: smallest in code-point order) if
that count is at least ``ratio`` times its own; its root is the last form on the way.
Counts grow ``ratio``-fold with every form, so a way has at most log(largest / smallest
count) steps, and pointer doubling follows all ways in the logarithm of that number.

Null texts have no words; repeated rows count again. With a null doc_id the text before
the colon is empty. Null words and words without a positive count are ignored, counts of
a repeated word add up. Empty tables have an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import stored, table

SYMBOLS = 8
RATIO = 5
MIN_LENGTH = 6
MIN_COUNT = 5
TYPO_EVERY = 199
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def reduced(word: Column, symbols: int = SYMBOLS) -> Column:
    """Every code point hashed to one of the first ``symbols`` letters."""
    letter = lambda c: F.chr(F.pmod(F.xxhash64(c), F.lit(symbols)) + 97)
    return F.array_join(F.transform(F.split(word, ""), letter), "")


def neighbourhood(word: Column, symbols: int = SYMBOLS) -> Column:
    """The reduced word and all its one-edit neighbours, each once."""
    alphabet = F.array(*(F.lit(chr(97 + k)) for k in range(symbols)))
    size = F.char_length(word)
    places = F.sequence(F.lit(1), size)

    def left(i: Column) -> Column:
        return F.substring(word, F.lit(1), i - 1)

    def right(i: Column) -> Column:
        return F.substring(word, i, size)

    deleted = F.transform(places, lambda i: F.concat(left(i), right(i + 1)))
    replaced = F.transform(places, lambda i: F.transform(alphabet, lambda c: F.concat(left(i), c, right(i + 1))))
    gaps = F.sequence(F.lit(1), size + 1)
    inserted = F.transform(gaps, lambda i: F.transform(alphabet, lambda c: F.concat(left(i), c, right(i))))
    return F.array_distinct(F.concat(F.array(word), deleted, F.flatten(replaced), F.flatten(inserted)))


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """Ordered pairs (word, near_word, near_n) at distance one, from stored, distinct (word, n, reduced).

    Reduced words travel as 64-bit hashes; what the join brings together is verified. The planner takes the exploded
    neighbourhoods for no larger than the words and would broadcast them: the hint keeps to a shuffle.
    """
    asked = words.select("word", F.explode(neighbourhood(F.col("reduced"), symbols)).alias("k")).select("word", F.xxhash64("k").alias("k"))
    known = words.select(F.col("word").alias("near_word"), F.col("n").alias("near_n"), F.xxhash64("reduced").alias("k"))
    return (
        asked.join(known.hint("merge"), "k")
        .where(F.levenshtein("word", "near_word", 1) == 1)
        .select("word", "near_word", "near_n")
    )


def variants(words: DataFrame, ratio: int = RATIO, symbols: int = SYMBOLS) -> DataFrame:
    """Per distinct word: word, form, root, n, n_near, form_n, from (word, n)."""
    if ratio < 2 or symbols < 2:
        raise ValueError("ratio and symbols must be at least 2")
    counted = words.where(F.col("word").isNotNull() & (F.col("n") > 0)).groupBy("word")
    totals = counted.agg(F.sum("n").cast("bigint").alias("n"))
    # stored with the reduced words, which the neighbourhoods read many times
    vocabulary = stored(totals.withColumn("reduced", reduced(F.col("word"), symbols)), "vocabulary")
    best = near_pairs(vocabulary, symbols).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near_word")).alias("b")
    )
    strong = -F.col("b.m") >= ratio * F.col("n")
    linked = stored(
        vocabulary.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(strong, F.col("b.near_word")).alias("form"),
            F.when(strong, -F.col("b.m")).alias("form_n"),
        ),
        "forms",
    )
    return linked.join(roots(linked, ratio), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def roots(linked: DataFrame, ratio: int) -> DataFrame:
    """(word, root) of the words that have a form, by pointer doubling."""
    low, high = linked.agg(F.min("n"), F.max("n")).first()
    steps = 0 if low is None else int(math.log(high / low, ratio) + 1e-9)
    ways = linked.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(max(steps - 1, 0).bit_length()):
        ways = stored(ways, "ways")
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ways = ways.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return ways


def word_counts(documents: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the letter runs of all texts, with the query's dropped letters.

    A run shorter than ``min_length`` cannot yield a word, so only longer ones are taken out.
    """
    runs = F.regexp_extract_all("text", F.lit("[A-Za-zÀ-ÿ]{%d,}" % min_length), F.lit(0))
    raw = documents.select(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":")).alias("key"), F.explode(runs).alias("w"))
    lowered = raw.select("key", F.translate("w", UPPER, UPPER.lower()).alias("w"))
    hashed = lowered.select("w", F.crc32(F.concat("key", "w").cast("binary")).alias("h"))
    at = F.pmod(F.col("h"), F.char_length("w")).cast("int")
    short = F.concat(F.substring("w", F.lit(1), at), F.substring("w", at + 2, F.char_length("w")))
    words = hashed.select(F.when(F.col("h") % TYPO_EVERY == 0, short).otherwise(F.col("w")).alias("word"))
    counted = words.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(word_counts(table(spark, sf_dir, "documents").select("doc_id", "text")))


# crc32 by its table, which is built from the polynomial; words meet where one letter is left out
ORACLE_SQL = f"""
WITH RECURSIVE crc_table AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i)),
runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{UPPER.lower()}') AS w
    FROM documents),
per_text AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS k, w, count(*) AS c FROM runs GROUP BY ALL),
coded AS (
    SELECT k, w, c, list_transform(range(1, 2 * strlen(k), 2), lambda i: CAST('0x' || substr(hex(encode(k)), i, 2) AS BIGINT)) AS b
    FROM per_text),
hashed AS (
    SELECT w, c, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
        lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS h
    FROM coded, crc_table),
spelled AS (
    SELECT CASE WHEN h % {TYPO_EVERY} = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c
    FROM hashed),
vocabulary AS (
    SELECT word, CAST(sum(c) AS BIGINT) AS n FROM spelled WHERE length(word) >= {MIN_LENGTH}
    GROUP BY word HAVING sum(c) >= {MIN_COUNT}),
cuts AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
near AS (
    SELECT a.word, b.word AS near_word, b.n AS near_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cuts a JOIN vocabulary b ON a.cut = b.word
    UNION SELECT b.word, a.word, a.n FROM cuts a JOIN vocabulary b ON a.cut = b.word),
ranked AS (
    SELECT word, near_word, near_n, count(*) OVER (PARTITION BY word) AS n_near,
        row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near_word) AS k FROM near),
linked AS (
    SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {RATIO} * v.n THEN near_word END AS form,
        CASE WHEN near_n >= {RATIO} * v.n THEN near_n END AS form_n
    FROM vocabulary v LEFT JOIN ranked r ON v.word = r.word AND k = 1),
ways AS (
    SELECT word, word AS root FROM linked
    UNION ALL
    SELECT w.word, l.form FROM ways w JOIN linked l ON w.root = l.word WHERE l.form IS NOT NULL)
SELECT l.word, l.form, w.root, l.n, l.n_near, l.form_n
FROM linked l JOIN ways w USING (word) JOIN linked e ON w.root = e.word AND e.form IS NULL
"""
