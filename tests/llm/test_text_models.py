import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import fingerprints, lm_scores, mixing, sentencepiece, toxicity
from millrace.llm.common import parallelism

from .conftest import awkward
from .test_dedup import components_by_hand


def by_id(rows):
    return sorted((r.asDict() for r in rows), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))


# --- fingerprints ------------------------------------------------------------


def ordered():
    return sorted(((i, t or "") for i, t, *_ in awkward()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_fingerprints_equal_plain_python(documents):
    got = by_id(fingerprints.fingerprints(documents).collect())
    rows, sign = ordered(), fingerprints.Fingerprinter()
    want = Counter()
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        changed = (text[: len(text) - half] + following[:half]).encode()
        a, b, c = sign(text.encode()), sign(changed), sign(following.encode())
        want[
            (i, len(text), hashlib.sha256(changed).hexdigest(), a.tobytes().hex(), b.tobytes().hex(),
             fingerprints.likeness(a, b), fingerprints.likeness(a, c))
        ] += 1
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert Counter(tuple(r[n] for n in names) for r in got) == want


def test_fingerprint_tasks_do_not_outnumber_the_slots(spark):
    rows = [(i, f"text {i} of many words {i % 7}") for i in range(400)]
    dealt = fingerprints.signatures(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert dealt.rdd.getNumPartitions() == parallelism(spark) and dealt.count() == 400


def test_fingerprints_of_one_and_none(spark, nothing):
    one = spark.createDataFrame([(3, "a b c d e f g")], "doc_id bigint, text string")
    assert fingerprints.fingerprints(one).first().near_next == 1.0
    assert fingerprints.fingerprints(nothing).count() == 0


def test_likeness_estimates_jaccard():
    sign = fingerprints.Fingerprinter()
    a = b" ".join(b"w%d" % k for k in range(1000))
    b = b" ".join(b"w%d" % k for k in range(250, 1250))
    x, y = set(sign.items(a).tolist()), set(sign.items(b).tolist())
    assert abs(fingerprints.likeness(sign(a), sign(b)) - len(x & y) / len(x | y)) < 0.15


def test_long_unrelated_texts_are_unlike():
    sign = fingerprints.Fingerprinter()
    a = b" ".join(b"a%d" % k for k in range(100_000))
    b = b" ".join(b"b%d" % k for k in range(100_000))
    assert fingerprints.likeness(sign(a), sign(b)) < 0.05
    half = a[: len(a) // 2] + b[len(b) // 2 :]
    x, y = set(sign.items(a).tolist()), set(sign.items(half).tolist())
    assert abs(fingerprints.likeness(sign(a), sign(half)) - len(x & y) / len(x | y)) < 0.15


def test_query_links_what_the_leaders_miss(spark, documents, nothing):
    """Copies that drift step by step: links that do not touch a band's leader join components, too."""
    draw = np.random.default_rng(3)
    words = [f"w{k}" for k in draw.integers(0, 10**6, 100)]
    rows = []
    for k in range(60):
        text = list(words)
        if k % 20 == 19:
            words[int(draw.integers(0, 100))] = f"n{k}"
        text[int(draw.integers(0, 100))] = f"v{k}"
        rows.append((k, " ".join(text)))
    rows = [rows[k] for k in draw.permutation(60)]
    got = fingerprints.linked_fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want, _ = components_by_hand(sorted(rows), fingerprints.SHINGLE, 80)
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter((i, c) for i, _, c in want)
    sizes = Counter(r.component_id for r in got)
    assert all((r.n_links > 0) == (sizes[r.component_id] > 1) for r in got)
    awkward_rows = fingerprints.linked_fingerprints(documents).collect()
    want, _ = components_by_hand([(i, t) for i, t, *_ in awkward()], fingerprints.SHINGLE, 80)
    assert Counter((r.doc_id, r.component_id) for r in awkward_rows) == Counter((i, c) for (i, _, c), n in want.items() for _ in range(n))
    assert fingerprints.linked_fingerprints(nothing).count() == 0


def test_query_has_components(spark):
    assert {"component_id", "n_links"} <= set(fingerprints.op4_fingerprints(spark, "/root/testdata/sf0.001").columns)


def test_small_tables_take_few_tasks_whatever_the_shuffle_partitions(spark, documents):
    settings = {"spark.sql.shuffle.partitions": "211", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    order = ("doc_id", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "component_id")
    expected = fingerprints.linked_fingerprints(documents).select(*order).orderBy(*order).collect()
    before = {k: spark.conf.get(k) for k in settings}
    slots = spark.sparkContext.defaultParallelism
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert fingerprints.signatures(documents).rdd.getNumPartitions() <= slots
        found = fingerprints.linked_fingerprints(documents)
        assert found.rdd.getNumPartitions() <= slots
        assert found.select(*order).orderBy(*order).collect() == expected
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# --- language model ------------------------------------------------------------


def backoff_by_hand(texts):
    docs = [t.encode().lower().split() for t in texts]
    grams = [Counter(tuple(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)) for w in docs]
    total = sum(grams, Counter())
    out = []
    for words, own in zip(docs, grams):
        rest = max(sum(map(len, docs)) - len(words), 1)
        score = 0.0
        for i in range(len(words)):
            n, factor = min(3, i + 1), 1.0
            while True:
                gram = tuple(words[i + 1 - n : i + 1])
                count = total[gram] - own[gram]
                if count > 0 or n == 1:
                    break
                n, factor = n - 1, factor * lm_scores.ALPHA
            if n > 1:
                score += math.log(factor * count / (total[gram[:-1]] - own[gram[:-1]]))
            else:
                score += math.log(factor * (count if count > 0 else lm_scores.ALPHA) / rest)
        out.append((len(words), round(score, 6)))
    return Counter(out)


def test_scores_equal_plain_python(documents, nothing):
    got = lm_scores.scores(documents).collect()
    assert Counter((r.n_words, round(r.log_score, 6)) for r in got) == backoff_by_hand([t or "" for _, t, *_ in awkward()])
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in awkward())
    assert lm_scores.scores(nothing).count() == 0


def test_scores_over_many_chunks(spark, texts, monkeypatch):
    monkeypatch.setattr(lm_scores, "CHUNK_BYTES", 20_000)
    rows = spark.createDataFrame(sorted(texts.items()), "doc_id bigint, text string")
    got = lm_scores.scores(rows).collect()
    assert Counter((r.n_words, round(r.log_score, 6)) for r in got) == backoff_by_hand(list(texts.values()))


def test_squeezed_numbers_return():
    for kind in (np.uint32, np.uint64):
        values = np.random.default_rng(0).integers(0, 2**31, 1000).astype(kind)
        assert (lm_scores.unsqueezed(lm_scores.squeezed(values), kind) == values).all()
    assert not len(lm_scores.unsqueezed(lm_scores.squeezed(np.zeros(0, np.uint64)), np.uint64))


# --- sentencepiece ---------------------------------------------------------------


@pytest.fixture(scope="module")
def codec():
    return sentencepiece.Codec(sentencepiece.read_model())


@pytest.fixture(scope="module")
def library(codec):
    sp = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2 as schema

    model = schema.ModelProto()
    with open(sentencepiece.MODEL_PATH, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = schema.TrainerSpec.UNIGRAM
    for piece, score in zip(model.pieces, codec.scores):
        piece.score = float(score)
    return sp.SentencePieceProcessor(model_proto=model.SerializeToString())


def test_codec_agrees_with_the_library(codec, library, texts):
    """Same ids, or another path of the same sum where two are tied."""
    samples = [*list(texts.values())[:120], "", " ", "  a  b ", "x" * 300, "é😀\t漢字 z", "a\n\nb", " lead", "trail  "]
    ids, counts = codec.encode([t.encode() for t in samples])
    ends = np.cumsum(counts)
    for text, end, n in zip(samples, ends, counts):
        mine, theirs = ids[end - n : end], library.encode(text)
        if mine.tolist() != theirs:
            assert codec.scores[mine].sum() == pytest.approx(codec.scores[theirs].sum(), rel=1e-6)  # the library adds in 32 bits
    assert codec.decode(ids, counts) == [t.encode() for t in samples]


def test_double_array_holds_just_its_keys():
    keys = [b"a", b"ab", b"abc", b"b\xff", b"\x00", b"zz"]
    base, check, value = sentencepiece.double_array(keys, list(range(6)))

    def find(key):
        node = 0
        for c in key:
            if base[node] <= 0 or check[base[node] + c] != node:
                return -1
            node = base[node] + c
        return value[node]

    assert [find(k) for k in keys] == list(range(6))
    assert find(b"b") == find(b"z") == find(b"abcd") == find(b"c") == -1


def test_long_words_take_the_same_path(codec):
    word = sentencepiece.MARKER + b"internationalisation" * 3
    ids, counts = codec._side_by_side([word], np.array([len(word)]), sentencepiece.LONGEST)
    assert ids.tolist() == codec._alone(word) and counts.tolist() == [len(ids)]


def test_encoded_rows(documents, nothing):
    rows = sentencepiece.encoded(documents)
    assert rows.columns == [c for c in documents.columns if c != "piece_ids"] + ["piece_ids", "round_trip"]
    got = rows.collect()
    assert len(got) == len(awkward())
    assert {r.doc_id for r in got if not r.round_trip} == {12}  # holds the marker itself
    assert all(not r.piece_ids for r in got if not r.text)
    assert sentencepiece.encoded(nothing).count() == 0


# --- toxicity ----------------------------------------------------------------------


def toxic_corpus(n, seed=0):
    draw = np.random.default_rng(seed)
    common = [f"{a}{b}{c}" for a in ("ka", "lo", "mi") for b in ("ra", "te", "su", "no") for c in ("", "n", "s")]
    texts, labels = [], []
    for k in range(n):
        words = list(draw.choice(common, int(draw.integers(20, 120))))
        if k % 3 == 0:
            for _ in range(3):
                words.insert(int(draw.integers(0, len(words))), "grobz" + str(draw.choice(["ak", "el", "un"])))
        texts.append(" ".join(words).encode())
        labels.append(int(k % 3 == 0))
    return texts, labels


def test_network_learns_and_scores_every_window():
    model = toxicity.train(*toxic_corpus(300))
    texts, labels = toxic_corpus(150, seed=1)
    predicted = toxicity.score_texts(model, texts) >= 0.5
    assert np.mean(predicted == np.array(labels)) > 0.95
    buried = b"kara lote minos " * 4000 + b"grobzak grobzel grobzun " + b"kara lote minos " * 10
    clean = b"kara lote minos " * 4020
    scores = toxicity.score_texts(model, [buried, clean, b"", b"kara"])
    assert scores[0] >= 0.5 > scores[1] and ((scores >= 0) & (scores <= 1)).all() and scores[2] < 0.5


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    parameters = {k: v.astype(np.float64) for k, v in toxicity.Network.fresh(rng).items()}
    network = toxicity.Network(parameters)
    inputs = toxicity.inputs_of([b"one", b"two", b"three", b"x"])
    windows = np.array([[0, 1, 2, 3] * 6, [3, 2] + [4] * 22])
    target = np.array([1, 0])

    def loss():
        p = toxicity.sigmoid(network.run(network.project(network.embed(inputs)), windows, 4))
        return -np.mean(np.log(np.where(target == 1, p, 1 - p)))

    found = network.gradients(inputs, windows, target)
    for name in ("wx", "wh", "att", "out", "b", "word", "char"):
        place = np.unravel_index(np.argmax(np.abs(found[name])), found[name].shape)
        parameters[name][place] += 1e-2
        up = loss()
        parameters[name][place] -= 2e-2
        down = loss()
        parameters[name][place] += 1e-2
        assert found[name][place] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=1e-5), name


def test_windows_overlap_and_cover():
    for n in (0, 1, 12, 24, 25, 36, 37, 100):
        windows, owner = toxicity.window_table(np.array([n, 5]), np.arange(n + 5), n + 5)
        own = windows[owner == 0]
        assert set(own.ravel().tolist()) - {n + 5} == set(range(n))
        if len(own) > 1:
            assert (own[1:, 0] - own[:-1, 0] == toxicity.STRIDE).all()


def test_toxicity_rows(spark, documents, nothing):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 17)] + [(None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fitted(documents, labels)
    rows = toxicity.scored(documents, model, "score").collect()
    assert len(rows) == len(awkward()) and all(0 <= r.score <= 1 for r in rows)
    same = [r.score for r in rows if r.doc_id == 4]
    assert same[0] == same[1]
    kept = toxicity.accepted(documents, labels)
    assert kept.columns == documents.columns
    assert toxicity.accepted(documents, labels.where("false")).count() == len(awkward())
    assert toxicity.accepted(nothing, labels).count() == 0
    with pytest.raises(ValueError):
        toxicity.scored(documents, model)


def test_held_out_rows_teach_nothing(spark):
    import zlib

    rows = spark.createDataFrame([(k, f"text {k}") for k in range(200)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(200)], "doc_id bigint, quality int, toxic int")
    bodies, _ = toxicity.training_rows(rows, labels)
    ids = {int(b.split()[1]) for b in bodies}
    assert ids == {k for k in range(200) if zlib.crc32(str(k).encode()) % 5}


def test_score_is_that_of_the_best_window_scored_alone():
    model = toxicity.train(*toxic_corpus(120))
    texts, _ = toxic_corpus(12, seed=5)
    texts = [*texts, b"", b"one", b" ".join(texts[:6])]
    network, (slope, offset) = toxicity.Network(model), model["scale"]
    for text, score in zip(texts, toxicity.score_texts(model, texts)):
        words = toxicity.words_of(text)
        best = -np.inf
        for start in toxicity.window_starts(len(words)):
            own = words[start : start + toxicity.WINDOW] or [b"\x00"]
            ids = np.array([[*range(len(own)), *[len(own)] * (toxicity.WINDOW - len(own))]])
            if not words:
                ids[:] = len(own)
            best = max(best, float(network.run(network.project(network.embed(toxicity.inputs_of(own))), ids, len(own))[0]))
        assert score == pytest.approx(toxicity.sigmoid(slope * best + offset), abs=1e-4)
    # a table whose only word is shorter than the n-grams
    assert toxicity.score_texts(model, [b"a"])[0] == pytest.approx(toxicity.score_texts(model, [b"a", texts[0]])[0], abs=1e-5)


def test_long_labelled_rows_train_where_short_ones_are_few(spark):
    draw = np.random.default_rng(0)
    clean = [" ".join(draw.choice(["kara", "miso", "tulo", "vena"], 900)) for _ in range(40)]
    toxic = [" ".join([*t.split()[:450], "gruk", "blarg", *t.split()[450:]]) for t in clean]
    rows = [(k, t) for k, t in enumerate(clean + toxic)] + [(900, "kara " * 1_200_000)]
    labels = [(k, 1, int(k >= 40)) for k in range(80)] + [(900, 1, 0)]
    assert min(len(t) for _, t in rows) > 4000
    documents = spark.createDataFrame([(k, t + " miso" * 500) for k, t in rows], "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    bodies, targets = toxicity.training_rows(documents, marks)
    assert min(map(len, bodies)) > toxicity.TRAIN_LONGEST and set(targets) == {0, 1}
    assert max(map(len, bodies)) <= toxicity.TRAIN_CHARS // 2 and sum(map(len, bodies)) <= 2 * toxicity.TRAIN_CHARS


# --- mixing ---------------------------------------------------------------------------


def test_rates_reach_targets(spark):
    draw = np.random.default_rng(0)
    p = draw.dirichlet([4.0, 1.0, 0.5], 600)
    rows = [(k, int(draw.integers(1, 900)), *map(float, p[k])) for k in range(600)]
    members = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, p_clean double, p_junk double, p_toxic double")
    fitted, fit = mixing.fit_rates(members, {"clean": 0.85, "junk": 0.1, "toxic": 0.05})
    found = {r.doc_id: r.rate for r in fitted.collect()}
    rate = np.array([found[k] for k in range(600)])
    assert (rate >= 0).all()
    reached = (rate * [r[1] for r in rows]) @ p
    assert np.allclose(reached, fit["reached"]) and np.allclose(reached, fit["targets"], rtol=0.02)
    with pytest.raises(ValueError):
        mixing.fit_rates(members, {"clean": -1, "junk": 1, "toxic": 1})


def test_rates_equal_an_independent_solver(spark):
    """The optimum in the dual: a document's rate follows from one price per domain, found by Newton steps."""
    draw = np.random.default_rng(4)
    p, tokens = draw.dirichlet([3.0, 1.0, 1.0], 80), draw.integers(5, 400, 80).astype(float)
    rows = [(k, int(tokens[k]), *map(float, p[k])) for k in range(80)]
    members = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, p_clean double, p_junk double, p_toxic double")
    fitted, fit = mixing.fit_rates(members, {"clean": 0.7, "junk": 0.2, "toxic": 0.1})
    targets, error = fit["targets"], np.zeros(3)
    for _ in range(200):  # rate = max(0, 1 - p @ e / RIDGE) with e = (S(rate) - T) / T, a fixed point in e
        rate = np.maximum(0, 1 - p @ error / mixing.RIDGE)
        free = rate > 0
        gap = ((rate * tokens) @ p - targets) / targets - error
        slope = -(p[free] * tokens[free, None]).T @ p[free] / mixing.RIDGE / targets[:, None] - np.eye(3)
        error = error - np.linalg.solve(slope, gap) * 0.5
    assert np.abs(gap).max() < 1e-9
    got = {r.doc_id: r.rate for r in fitted.collect()}
    cost = lambda x: (((x * tokens) @ p - targets) ** 2 / (2 * targets)).sum() + mixing.RIDGE / 2 * (tokens * (x - 1) ** 2).sum()
    found = np.array([got[k] for k in range(80)])
    assert cost(found) <= cost(rate) * 1.05 + 1e-4 * targets.sum() * mixing.TOLERANCE
    assert np.allclose((found * tokens) @ p, (rate * tokens) @ p, rtol=2e-3)


def test_a_fit_that_cannot_meet_its_targets_says_so(spark):
    # junk comes only inside clean text, in fixed parts
    rows = [(k, 100, 0.9, 0.1, 0.0) for k in range(20)]
    members = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, p_clean double, p_junk double, p_toxic double")
    with pytest.warns(UserWarning, match="off its target"):
        _, fit = mixing.fit_rates(members, {"clean": 0.2, "junk": 0.8, "toxic": 0.0})
    assert fit["off"] > 0.01 and fit["steps"] == mixing.STEPS


def test_mixing_rows(spark, documents, nothing):
    labels = spark.createDataFrame([(i, int(i != 5), int(i == 6)) for i in range(1, 17)], "doc_id bigint, quality int, toxic int")
    rows, _ = mixing.mixed(documents, labels)
    got = rows.collect()
    assert len(got) == len(awkward())
    assert all(abs(r.p_clean + r.p_junk + r.p_toxic - 1) < 1e-9 and r.rate >= 0 for r in got)
    assert all(r.n_tokens == 0 for r in got if r.doc_id in (7, 8, 9))
    kept = mixing.resampled(documents, labels)
    assert kept.columns == documents.columns and kept.count() <= len(awkward())
    assert mixing.mixed(documents, labels.where("false"))[0].count() == len(awkward())
    assert mixing.mixed(nothing, labels)[0].count() == 0
    assert mixing.resampled(nothing, labels).count() == 0


def thinning_corpus(n, junk):
    """Rows of which ``junk`` are repeated signs, and labels for all of them; junk is placed evenly."""
    draw = np.random.default_rng(5)
    every = n // junk if junk else n + 1
    rows, labels = [], []
    for k in range(n):
        poor = k % every == every - 1 and k // every < junk
        words = ["$$$###"] * 40 if poor else [str(w) for w in draw.choice(["kara", "lote", "minos", "suna", "rate", "loki"], 40)]
        rows.append((k, " ".join([f"n{k}", *words])))
        labels.append((k, int(not poor), 0))
    return rows, labels


@pytest.mark.parametrize("junk", [0, 1, 20, 200])
def test_clean_rows_stay_however_scarce_junk_is(spark, junk):
    rows, labels = thinning_corpus(1000, junk)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    kept = {r.doc_id for r in mixing.resampled(docs, marks, corpus_pipeline.MIX).collect()}
    clean = {i for i, good, _ in labels if good}
    assert clean <= kept
    # 5 to 95 of the clean text, never more than there is
    assert len(kept - clean) == junk if junk <= 20 else 20 <= len(kept - clean) <= 70


def test_thinning_gets_flags_back_and_no_texts(spark):
    rows, labels = thinning_corpus(600, 200)
    docs = spark.createDataFrame([(*r, float(r[0])) for r in rows], "doc_id bigint, text string, weight double")
    thinned = mixing.resampled(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), corpus_pipeline.MIX)
    assert thinned.columns == docs.columns and 400 <= thinned.count() < 600
    assert thinned.exceptAll(docs).isEmpty()
    plan = thinned._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan


def test_labels_that_tell_nothing_drop_nothing(spark):
    rows, labels = thinning_corpus(300, 60)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    for useless in ("false", "quality = 0", "quality = 1", "doc_id = 0"):
        assert mixing.resampled(docs, marks.where(useless), corpus_pipeline.MIX).count() == 300


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    documents, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = mixing.train(documents, labels.where(fold != 0))
    marked = mixing.labelled_domains(labels.where(fold == 0)).where("domain < 2")
    rows = mixing.posteriors(documents, model).join(marked, "doc_id").collect()
    right = [(r.p_junk > r.p_clean) == (r.domain == 1) for r in rows]
    assert len(right) > 80 and np.mean(right) > 0.9


def test_runs_are_gathered_with_few_indices_at_once():
    import tracemalloc

    values, n = np.arange(256, dtype=np.uint8), 400_000
    starts, sizes = np.arange(n) % 200, np.arange(n) % 11
    tracemalloc.start()
    got = sentencepiece._gathered(values, starts, sizes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.tobytes() == b"".join(values[a : a + k].tobytes() for a, k in zip(starts.tolist(), sizes.tolist()))
    assert peak < 8 * len(got)  # not even one index for each
    assert len(sentencepiece._gathered(values, starts[:0], sizes[:0])) == 0
