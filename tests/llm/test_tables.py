from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from millrace.llm import licenses, rollups, warc
from millrace.llm.registry import ORACLES, QUERIES

from .conftest import SCHEMA, awkward, prose


def test_every_operator_is_registered_once():
    numbers = Counter(name.split("_")[0] for name in QUERIES)
    assert numbers == {f"op{n}": 1 for n in range(1, 14)}
    assert set(ORACLES) <= set(QUERIES) and set(QUERIES) | {"pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql_twin(spark, sf, name):
    from tools.check_queries import compare

    assert compare(spark, name, sf).startswith("ok"), name


# --- licences ------------------------------------------------------------------


def test_licence_lines(spark, documents, nothing):
    rows = [
        (1, "Some text.\nReleased under the MIT License.\nmore"),
        (2, "LICENSED  under the apache license; version 2.0!"),
        (3, "Released under some other License"),
        (4, None), (5, ""), (6, "\n\n"), (7, "word " * 50_000),
        (8, "Released under the MIT License."), (8, "Released under the MIT License."),
        (None, "Licensed under CC BY-NC 4.0."),
    ]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.doc_id, r.line_no, r.license) for r in got} == {
        (1, 2, "MIT"), (2, 0, "Apache-2.0"), (8, 0, "MIT"), (None, 0, "CC-BY-NC-4.0"),
    }
    assert len(got) == 4 and all(r.dice == 1.0 for r in got)
    assert licenses.scan(documents).count() == 0 and licenses.scan(nothing).count() == 0


def test_dice_counts_repeated_bigrams(spark):
    templates = (("T", "a b a b c d"),)
    rows = spark.createDataFrame([(1, "a b a b c e"), (2, "a b c d x y")], "doc_id bigint, text string")
    got = {r.doc_id: r.dice for r in licenses.scan(rows, templates, 0.5).collect()}
    assert got == {1: pytest.approx(0.8), 2: pytest.approx(0.6)}


def test_too_many_template_words_are_refused(spark):
    with pytest.raises(ValueError):
        licenses.template_table(spark, (("T", "w " * 500_000),))


def wrapped(text, width):
    import textwrap

    return "\n".join(textwrap.wrap(text, width))


def test_full_texts_wrapped_inside_longer_documents(spark):
    texts = dict(licenses.TEMPLATES)  # the last, longest text of each licence
    rows = []
    for k, (name, text) in enumerate(sorted(texts.items())):
        around = prose(k, 150)
        rows.append((k, f"{around}\n# {wrapped(text, 72)}\n{around}", name))
        rows.append((100 + k, f"{around} {text} {around}", name))  # prose on the same line
        words = text.split()
        changed = [w for i, w in enumerate(words) if i % 23 != 11] if len(words) > 40 else words
        rows.append((200 + k, f"{around}\n\n{wrapped(' '.join(changed), 70)} {around}", name))
    rows += [(300, prose(9, 3000), None), (301, "this software is provided to the public by the author " * 5, None)]
    got = licenses.scan(spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")).collect()
    found = {}
    for r in got:
        found.setdefault(r.doc_id, {})[r.license] = r
    for doc_id, text, name in rows:
        assert name is None and doc_id not in found or name in found[doc_id], (doc_id, name, found.get(doc_id))
    # the notice begins after the prose
    assert all(r.word_no is None or 149 <= r.word_no <= 151 for r in got if r.doc_id < 200)


def passages_by_hand(text, templates, threshold):
    words = licenses.words_in(text)
    grams = list(zip(words, words[1:]))
    best = {}
    for name, t in templates:
        own = licenses.words_in(t)
        bag = Counter(zip(own, own[1:]))
        m = len(own) - 1
        for s in range(len(grams)):
            part = grams[s : s + m]
            score = 2 * (Counter(part) & bag).total() / (len(part) + m)
            if score >= threshold:
                best[name] = max(best.get(name, (0, 0)), (score, -s))
    return best


def test_best_passage_equals_brute_force_over_all_places(spark):
    templates = (("A", "the quick brown fox jumps over the lazy dog again"), ("B", "x y x y x y z"))
    draw = __import__("random").Random(3)
    rows = []
    for k in range(40):
        name, text = templates[k % 2]
        words = text.split()
        if k % 3 == 0:
            words[draw.randrange(len(words))] = "other"
        rows.append((k, f"{prose(k, draw.randint(0, 9))} {' '.join(words)} {prose(k + 50, draw.randint(3, 9))}"))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    listed = licenses.stored(licenses.template_table(spark, templates), "t")
    rich = licenses.candidates(frame, listed, 0.7)
    got = {}
    for r in licenses.passages(frame, rich, listed, 0.7).collect():
        got.setdefault(r.doc_id, {})
        got[r.doc_id][r.license] = max(got[r.doc_id].get(r.license, (0, 0)), (r.dice, -r.word_no))
    want = {k: passages_by_hand(t, templates, 0.7) for k, t in rows}
    assert {k: {n: round(v[0], 9) for n, v in x.items()} for k, x in got.items()} == {
        k: {n: round(v[0], 9) for n, v in x.items()} for k, x in want.items() if x
    }


# --- rollups ---------------------------------------------------------------------

CHANGES = "doc_id bigint, op string, source string, lang string, version string, tokens bigint, documents string"


def totals(store):
    return {(r.source, r.lang, r.version): (r.tokens, r.documents) for r in store.totals().collect()}


def test_signed_changes_and_replays(spark, tmp_path):
    store = rollups.RollupStore(spark, f"file://{tmp_path}/store")
    assert totals(store) == {}

    def batch(*rows):
        return spark.createDataFrame([(*r, "x") for r in rows], CHANGES)

    first = batch((1, "insert", "a", "en", "v1", 10), (2, "insert", "a", None, "v1", 5), (None, "insert", "b", "en", "v1", None))
    assert store.commit("1", first) and not store.commit("1", first)
    assert totals(store) == {("a", "en", "v1"): (10, 1), ("a", None, "v1"): (5, 1), ("b", "en", "v1"): (0, 1)}
    # 1 moves to another source, 2 goes, 9 was never there, two documents have the id 3
    store.commit("2", batch((1, "revise", "c", "en", "v1", 7), (2, "delete", None, None, "v1", 0), (9, "delete", None, None, "v1", 0),
                            (3, "insert", "a", "en", "v2", 4), (3, "insert", "a", "en", "v2", 6)))
    assert totals(store) == {("c", "en", "v1"): (7, 1), ("b", "en", "v1"): (0, 1), ("a", "en", "v2"): (10, 2)}
    store.commit("3", batch((None, "delete", None, None, "v1", 0), (3, "insert", "a", "en", "v2", 8)))
    assert totals(store) == {("c", "en", "v1"): (7, 1), ("a", "en", "v2"): (8, 1)}
    assert store.commit("4", spark.createDataFrame([], CHANGES))
    assert totals(store) == {("c", "en", "v1"): (7, 1), ("a", "en", "v2"): (8, 1)}
    with pytest.raises(ValueError):
        store.commit("a/b", first)


def test_rows_without_an_id_or_with_a_repeated_one_all_count(spark, tmp_path):
    store = rollups.RollupStore(spark, f"file://{tmp_path}/store")

    def batch(*rows):
        return spark.createDataFrame([(*r, "x") for r in rows], CHANGES)

    store.commit("1", batch(*[(i, "insert", "a", "en", "v", n) for i, n in ((None, 10), (None, 20), (7, 5), (7, 6))]))
    assert totals(store) == {("a", "en", "v"): (41, 4)}
    # rows without an id are always new; 7 is revised as a whole, and a revision beats an insert of the same batch
    store.commit("2", batch((None, "insert", "a", "en", "v", 1), (7, "revise", "a", "en", "v", 2), (7, "insert", "a", "en", "v", 90)))
    assert totals(store) == {("a", "en", "v"): (33, 4)}
    # an insert beats a deletion of the same batch
    store.commit("3", batch((7, "delete", None, None, "v", 0), (7, "insert", "b", "en", "v", 3), (None, "delete", None, None, "v", 0)))
    assert totals(store) == {("b", "en", "v"): (3, 1)}


def test_a_commit_reads_only_the_buckets_it_touches(spark, tmp_path):
    store = rollups.RollupStore(spark, f"file://{tmp_path}/store")
    rows = [(i, "insert", "a", "en", "v", 1, "x") for i in range(300)]
    store.commit("1", spark.createDataFrame(rows, CHANGES))
    bucket = spark.range(1).select(rollups.bucket_of(F.lit(5).cast("bigint"))).first()[0]
    read = store.standing([bucket])
    assert 0 < len(read.inputFiles()) < len(store.standing().inputFiles()) or read.count() < 300
    assert {r.doc_id for r in read.collect()} == {
        r.id for r in spark.range(300).where(rollups.bucket_of(F.col("id")) == bucket).collect()
    }
    store.commit("2", spark.createDataFrame([(5, "delete", None, None, "v", 0, "x")], CHANGES))
    assert totals(store) == {("a", "en", "v"): (299, 299)}


def test_of_two_commits_of_one_batch_one_wins(spark, tmp_path):
    first, second = (rollups.RollupStore(spark, f"file://{tmp_path}/store") for _ in range(2))
    rows = spark.createDataFrame([(1, "insert", "a", "en", "v", 3, "x")], CHANGES)
    assert first.commit("1", rows) and not second._mark("1", "late") and not second.commit("1", rows)
    assert totals(second) == {("a", "en", "v"): (3, 1)}


def test_a_batch_without_marker_is_written_anew(spark, tmp_path):
    store = rollups.RollupStore(spark, f"file://{tmp_path}/store")
    rows = spark.createDataFrame([(1, "insert", "a", "en", "v", 3, "x")], CHANGES)
    store.commit("1", rows)
    (tmp_path / "store/commits/1").unlink()
    assert totals(store) == {}
    store.commit("1", rows)
    assert totals(store) == {("a", "en", "v"): (3, 1)}


def test_counted_reads_whole_texts(documents):
    got = rollups.counted(documents, "v", rollups.VERSIONS["words-1"], "insert").collect()
    assert Counter(r.tokens for r in got) == Counter(len((t or "").encode().split()) for _, t, *_ in awkward())


# --- archives ----------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string, node string, offset string, digest string"


def page_rows(n):
    rows = [(k, f"http://h/{k}", f"<p>{k}</p>" * (k % 7)) for k in range(n)]
    rows += [(None, "u", "x"), (None, None, None), (3, "http://h/3", "<p>3</p>" * 3), (n, None, "y" * 200_000)]
    return [(*r, "n", "o", "d") for r in rows]


def test_audit_finds_just_the_damage(spark):
    pages = spark.createDataFrame(page_rows(100), PAGES)
    rows = page_rows(100)
    rows[17] = (*rows[17][:2], "other" * 9, *rows[17][3:])
    rows[55] = (*rows[55][:2], rows[55][2][:5], *rows[55][3:])
    left = warc.tree(pages, span=40, fanout=4)
    assert len(left) == 4
    assert warc.audit(left, warc.tree(pages.repartition(5), span=40, fanout=4), fanout=4).count() == 0
    found = warc.audit(left, warc.tree(spark.createDataFrame(rows, PAGES), span=40, fanout=4), fanout=4).collect()
    assert {(r.page_id, r.kind) for r in found} == {(17, "changed"), (55, "truncated")}
    assert all(r.offset == r.replica_offset for r in found)


def test_missing_records_and_empty_replicas(spark):
    pages = spark.createDataFrame(page_rows(20), PAGES)
    fewer = pages.where("page_id is null or page_id < 20")
    kinds = Counter(r.kind for r in warc.audit(warc.tree(pages), warc.tree(fewer)).collect())
    assert kinds == {"missing": 1}
    empty = warc.tree(pages.where("false"))
    assert warc.audit(empty, empty).count() == 0
    assert {r.kind for r in warc.audit(empty, warc.tree(fewer)).collect()} == {"extra"}


def test_a_lost_record_is_one_finding(spark):
    pages = spark.createDataFrame(page_rows(100), PAGES)
    left = warc.tree(pages, span=40, fanout=4)
    for lost in (0, 41, 57):
        found = warc.audit(left, warc.tree(pages.where(f"page_id is null or page_id <> {lost}"), span=40, fanout=4), fanout=4).collect()
        assert [(r.page_id, r.kind, r.replica_digest) for r in found] == [(lost, "missing", None)]
    # of three records with one id one goes, and another is cut: one finding each
    rows = page_rows(30) + [(8, "http://h/8", text, "n", "o", "d") for text in ("first", "second")]
    other = page_rows(30) + [(8, "http://h/8", "secon", "n", "o", "d")]
    left, right = (warc.tree(spark.createDataFrame(x, PAGES), span=40, fanout=4) for x in (rows, other))
    kinds = Counter((r.page_id, r.kind) for r in warc.audit(left, right, fanout=4).collect())
    assert sum(kinds.values()) == 2 and set(kinds) <= {(8, "missing"), (8, "truncated"), (8, "changed")}
    # rows without an id and url do not meet in one archive
    orphans = spark.createDataFrame([(None, None, f"<p>{k}", "n", "o", "d") for k in range(200)], PAGES)
    assert warc.leaves(orphans).select("archive").distinct().count() > 100


# --- pipeline -----------------------------------------------------------------------


def test_stages_keep_columns_and_survive_awkward_tables(spark, tmp_path):
    labels = spark.createDataFrame([(i, int(i != 5), int(i == 6)) for i in range(1, 17)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(awkward(), SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        docs.write.parquet(f"{tmp_path}/{name}.in")
        docs = spark.read.parquet(f"{tmp_path}/{name}.in")
        result = stage(spark, docs, str(tmp_path))
        if name != "sentencepiece":
            assert result.columns == docs.columns
        empty = stage(spark, docs.where("false"), str(tmp_path))
        assert empty.count() == 0
        assert result.count() <= docs.count()
        docs = result
    assert "piece_ids" in docs.columns


def test_pipeline_on_a_table(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    source = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert 0 < len(rows) < len(source)
    assert all(r.text == source[r.doc_id] and r.round_trip for r in rows)
    assert len({"".join(r.text.encode().decode().split()) for r in rows}) == len(rows)


def test_pipeline_sends_texts_to_python_once_and_in_small_batches(spark, documents):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, held in (("10000", "2000"), ("0", "2000"), ("500", "500")):
            spark.conf.set(name, given)
            rows = corpus_pipeline.encode_pieces(spark, documents, "")
            assert spark.conf.get(name) == held
        plan = rows._jdf.queryExecution().analyzed().toString()
        assert "MapInArrow" in plan and "as binary" not in plan
        found = {(r.doc_id, r.text): r for r in rows.collect()}
        assert len(found) == len({(x[0], x[1]) for x in awkward()})
        assert all(r.round_trip or r.doc_id == 12 for r in found.values())  # 12 has a marker of its own
        assert found[7, None].piece_ids == found[8, ""].piece_ids == []
    finally:
        spark.conf.set(name, before)


def test_pipeline_limits_the_bytes_of_a_batch(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = {k: spark.conf.get(k) for k in (name, "spark.sql.execution.arrow.maxRecordsPerBatch")}
    sizes = [corpus_pipeline.bytes_of(x) for x in ("7", "7b", "64m", "2KB", "1g", "-1")]
    assert sizes == [7, 7, 64 << 20, 2048, 1 << 30, -1]

    def seen(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    try:
        for given, held in (("64m", 1 << 20), ("100k", 100 << 10)):
            spark.conf.set(name, given)
            corpus_pipeline.small_batches(spark)
            assert corpus_pipeline.bytes_of(spark.conf.get(name)) == held
            texts = spark.range(0, 1500, 1, 1).select(F.repeat(F.lit("ab "), 2000).alias("text"))
            found = texts.mapInArrow(seen, "n bigint, size bigint").collect()
            assert sum(r.n for r in found) == 1500 and max(r["size"] for r in found) < held + 20_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
