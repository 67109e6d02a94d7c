import hashlib
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from millrace.llm import exact_dedup, near_dedup
from millrace.llm.common import keep_rows, mark, stored
from millrace.llm.components import components
from millrace.llm.exact_dedup import ContentTable, Entry, grace
from millrace.session import delete_stored, materialize, scratch_path

from .conftest import awkward


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_grouped_on_awkward_rows(documents):
    got = exact_dedup.grouped(documents, limit=20_000).collect()
    rows = [(i, t or "") for i, t, *_ in awkward()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[plain(t)].append((-len(t), i is None, i or 0))
    expected = Counter()
    for i, t in rows:
        best = min(groups[plain(t)])
        digest = hashlib.sha256(plain(t).encode()).hexdigest()
        expected[(i, None if best[1] else best[2], len(groups[plain(t)]), digest)] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_deduplicated_keeps_columns_and_one_row_a_group(documents):
    kept = exact_dedup.deduplicated(documents)
    assert kept.columns == documents.columns
    rows = kept.collect()
    assert len(rows) == len({plain(t) for _, t, *_ in awkward()})
    assert len({plain(r.text) for r in rows}) == len(rows)


def test_exact_empty(nothing):
    assert exact_dedup.grouped(nothing).count() == 0
    assert exact_dedup.deduplicated(nothing).count() == 0


def test_content_table_tells_equal_hashes_apart():
    table = ContentTable()
    for k in range(3000):
        content = b"%d" % k
        assert table.find(k % 7, content) is None
        table.insert(Entry(k % 7, content, (0, False, k, k), 1, [k]))
    assert all(table.find(k % 7, b"%d" % k).keys == [k] for k in range(3000))


@pytest.mark.parametrize("limit", [1, 5_000, 10**9])
def test_grace_splits_to_files_and_merges(limit):
    draw = random.Random(5)
    texts = [b"t%d" % draw.randint(0, 400) for _ in range(3000)]
    records = (
        Entry(int.from_bytes(hashlib.sha256(t).digest()[:8], "big"), t, (0, False, k, k), 1, [k]) for k, t in enumerate(texts)
    )
    found = list(grace(records, limit))
    want = Counter(texts)
    assert {x.content: x.size for x in found} == dict(want) and len(found) == len(want)
    assert all(x.best[2] == texts.index(x.content) and len(x.keys) == x.size for x in found)


def components_by_hand(rows, size, percent):
    sets = []
    for _, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), (True, 0)), (i is None, i or 0))
    return Counter((i, len(sets[k]), None if least[root(k)][0] else least[root(k)][1]) for k, (i, _) in enumerate(rows)), len(least)


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_equal_brute_force(documents, size):
    got = near_dedup.near_duplicates(documents, size, 80).collect()
    want, n = components_by_hand([(i, t) for i, t, *_ in awkward()], size, 80)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert sum(r["first"] for r in got) == n


def test_near_stage_keeps_columns(documents, nothing):
    kept = near_dedup.deduplicated(documents)
    assert kept.columns == documents.columns
    assert kept.count() == components_by_hand([(i, t) for i, t, *_ in awkward()], 5, 80)[1]
    assert near_dedup.deduplicated(nothing).count() == 0


def test_near_query_on_a_table(spark, texts):
    got = near_dedup.op7_near_dedup(spark, "/root/testdata/sf0.001").collect()
    want, n = components_by_hand(sorted(texts.items()), 4, 80)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert sum(r.kept for r in got) == n


def test_chained_and_crowded_near_copies(spark):
    """Copies that drift from one another step by step, so a star around one of them misses links."""
    draw = random.Random(3)
    words = [f"w{draw.randint(0, 10**6)}" for _ in range(100)]
    rows = []
    for k in range(60):
        text = list(words)
        if k % 20 == 19:
            words[draw.randrange(100)] = f"n{k}"
        text[draw.randrange(100)] = f"v{k}"
        rows.append((k, " ".join(text)))
    draw.shuffle(rows)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, 80).collect()
    want, _ = components_by_hand(sorted(rows), 4, 80)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want


def test_long_unrelated_texts_share_no_band(spark):
    rows = [(k, " ".join(f"{k}x{n}" for n in range(100_000))) for k in range(2)]
    found = near_dedup.shingled(spark.createDataFrame(rows, "doc_id bigint, text string"), 4)
    left, right = (set(r.keys) for r in found.select(near_dedup.band_keys(found.signature).alias("keys")).collect())
    assert not left & right


def test_bayesian_bounds():
    bounds = near_dedup.least_agreements(0.8)
    assert [n for n, _ in bounds] == list(range(24, 241, 24)) and all(0 < m < 0.8 * n for n, m in bounds)
    draw = np.random.default_rng(0)
    left = draw.integers(0, 9, (2000, near_dedup.PLACES)).astype(np.uint16)
    alike = np.where(draw.random(left.shape) < 0.8, left, 99).astype(np.uint16)
    apart = np.where(draw.random(left.shape) < 0.4, left, 99).astype(np.uint16)
    assert near_dedup.stays(left, alike, bounds).all()
    assert not near_dedup.stays(left, apart, bounds).any()


def test_across_blocks_join_every_label(spark, monkeypatch):
    import zstandard

    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    one = np.random.default_rng(1).integers(0, 60_000, near_dedup.PLACES).astype(np.uint16)
    body = bytearray(zstandard.ZstdCompressor().compress(b"a b c d e f"))
    rows = [(7, 0, 11, k, k % 3, bytearray(one.tobytes()), body) for k in range(11)]
    # the signature of another text, and one whose band has the number 0 no more
    rows += [(8, 5, 2, k, k, bytearray(one.tobytes()), body) for k in (20, 21)]
    members = spark.createDataFrame(
        rows, "band bigint, number int, n bigint, row bigint, label bigint, signature binary, body binary"
    )
    got = {(r.a, r.b) for r in near_dedup.across(members, 4, 80).collect()}
    assert all(a > b and a % 3 != b % 3 and a < 11 for a, b in got)
    assert {frozenset((a % 3, b % 3)) for a, b in got} == {frozenset(x) for x in ((0, 1), (0, 2), (1, 2))}


def test_components_of_long_path(spark):
    links = spark.createDataFrame([(k + 1, k) for k in range(40)] + [(101, 100), (100, 101)], "a bigint, b bigint")
    got = {r.node: r.label for r in components(links).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("dedup", [exact_dedup, near_dedup])
def test_stage_gives_back_its_copies_of_texts(spark, documents, dedup):
    folder = Path(scratch_path(spark, "x")).parent
    before = set(folder.glob("*")) if folder.exists() else set()
    kept = dedup.deduplicated(documents)
    left = {x.name.split("-")[0] for x in set(folder.glob("*")) - before}
    assert left and not left & {"exact", "shingled", "nodes", "texts", "held"}
    assert 0 < kept.count() < documents.count()


def test_kept_rows_are_shuffled_once(spark, documents):
    wanted = documents.where("doc_id is null or doc_id < 9")
    keys = stored(wanted.select("doc_id", mark().alias("mark")), "keys")
    joins = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(joins)
    spark.conf.set(joins, "-1")
    try:
        kept = keep_rows(documents, keys)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        rows = kept.collect()
    finally:
        spark.conf.set(joins, before)
    assert plan.count("Exchange hashpartitioning") == 2  # the texts, the keys
    assert kept.columns == documents.columns
    expected = {(r.doc_id, r.text or "") for r in wanted.collect()}
    assert len(rows) == len(expected) and {(r.doc_id, r.text or "") for r in rows} == expected


def test_only_stored_tables_are_deleted(spark, documents, tmp_path):
    copy, other = materialize(documents, "copy"), materialize(documents, "copy")
    delete_stored(copy.where("doc_id > 3"))
    assert other.count() == documents.count() and not Path(scratch_path(spark, "x")).parent.joinpath(
        copy.inputFiles()[0].split("/")[-2]
    ).exists()
    documents.write.parquet(f"{tmp_path}/own")
    with pytest.raises(ValueError):
        delete_stored(spark.read.parquet(f"{tmp_path}/own"))
