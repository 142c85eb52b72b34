"""Classifiers: gradients, held-out accuracy, odd rows and models without labels."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from opdiag.llm import language_id, quality_model, samples, texts, toxicity
from opdiag.llm.queries import QUERIES, ratings
from opdiag.llm.samples import Sparse

DATA = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n"), (4, "123 !?"), (5, "é" * 300_000), (5, "the of and"), (None, "x y z")]


def test_network_gradients():
    draw = np.random.default_rng(1)
    network = language_id.Network.fresh(("a", "b", "c"))
    network.parameters = [x.astype(np.float64) for x in network.parameters]
    windows = draw.integers(1, 255, (5, 30)).astype(np.uint8)
    target = np.array([0, 1, 2, 0, 1])

    def loss():
        logs = network.log_probabilities(network.largest(windows))
        return -logs[np.arange(5), target].mean()

    gradients = network.gradients(windows, target)
    for at, (parameter, gradient) in enumerate(zip(network.parameters, gradients)):
        flat = parameter.reshape(-1)
        for place in draw.choice(flat.size, 6):
            if at == 0 and gradient.reshape(-1)[place] == 0:
                continue
            kept = flat[place]
            flat[place] = kept + 1e-6
            up = loss()
            flat[place] = kept - 1e-6
            down = loss()
            flat[place] = kept
            assert abs((up - down) / 2e-6 - gradient.reshape(-1)[place]) < 1e-5


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = QUERIES["op4_language_id"](spark, DATA).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and 150 < len(held) < 350
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("lang", F.lit("de"))
    network = language_id.train(docs, F.lit(True))
    name = language_id.namer(spark, network)
    rows = docs.select("text", name("text").alias("n")).collect()
    for row in rows:
        lettered = any(char.isalpha() for char in row.text or "")
        assert row.n.lang_pred == ("de" if lettered else "und")
        assert row.n.score == pytest.approx(1.0 if lettered else 0.0)
    unknown = language_id.namer(spark, language_id.train(docs, F.lit(False)))
    assert {r.n.lang_pred for r in docs.select(unknown("text").alias("n")).collect()} == {"und"}


def test_language_scores_whole_texts():
    network = language_id.Network.fresh(("a", "b"))
    texts = ["a" * 10, "", "é" * 1000, "xyz" * 999]
    logs, chances = language_id._text_scores(network, pa.array(texts))
    for at, text in enumerate(texts):
        raw = np.frombuffer(text.encode(), np.uint8)
        rows = network.log_probabilities(network.largest(language_id.window_rows(raw, 0, len(raw))))
        assert np.allclose(logs[at], rows.mean(axis=0), atol=1e-5)
        assert np.allclose(chances[at], np.exp(rows).mean(axis=0), atol=1e-5)


def test_quality_grades_of_labelled_documents(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = QUERIES["op6_quality_model"](spark, DATA).join(labels, "doc_id").collect()
    right = sum(r.selected == (r.quality == 1) for r in rows)
    assert right >= 0.97 * len(rows)
    mean = {
        grade: np.mean([r.expected_grade for r in rows if (r.quality, r.toxic) == grade])
        for grade in ((0, 0), (1, 1), (1, 0))
    }
    assert mean[0, 0] < mean[1, 1] < mean[1, 0]


def test_quality_on_texts_it_was_not_fitted_on(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet").withColumn("grade", F.col("quality"))
    model = quality_model.train(docs, labels.filter("doc_id % 2 = 0"))
    assert model.grades == (0, 1) and len(model.thresholds) == 1
    score = quality_model.scorer(spark, model, 1)
    rows = docs.join(labels.filter("doc_id % 2 = 1"), "doc_id").select("quality", score("text").alias("s"))
    found = rows.collect()
    assert sum((r.s.tail >= 0.5) == (r.quality == 1) for r in found) >= 0.95 * len(found)


def test_thresholds_stay_in_order(spark):
    docs = spark.createDataFrame(
        [(at, f"good{at % 4} " * 20) for at in range(200)], "doc_id long, text string"
    )
    ratings = docs.select("doc_id", (F.col("doc_id") % 4).cast("int").alias("grade"))
    model = quality_model.train(docs, ratings)
    assert model.grades == (0, 1, 2, 3) and list(model.thresholds) == sorted(model.thresholds)
    score = quality_model.scorer(spark, model, 2)
    for row in docs.select("doc_id", score("text").alias("s")).collect():
        assert abs(row.s.expected_grade - row.doc_id % 4) < 0.7
        assert (row.s.tail >= 0.5) == (row.doc_id % 4 >= 2)


@pytest.mark.parametrize("grades", [[], [(5, 1), (None, 0)], [(1, 0), (5, 1), (5, 1), (99, 0)]])
def test_quality_of_odd_rows(spark, grades):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("grade", F.lit(9))
    model = quality_model.train(docs, spark.createDataFrame(grades, "doc_id long, grade int"))
    score = quality_model.scorer(spark, model, 1)
    rows = docs.select(score("text").alias("s")).collect()
    assert len(rows) == len(ODD)
    if model.grades:
        assert all(0 <= r.s.tail <= 1 and 0 <= r.s.expected_grade <= 1 for r in rows)
    else:
        assert all(r.s.tail is None for r in rows)


def test_toxicity_on_held_out_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = QUERIES["op9_toxicity"](spark, "/root/testdata/sf0.1").join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    toxic = [r for r in held if r.toxic == 1]
    clean = [r for r in held if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert all(r.predicted == (r.score >= 0.5) for r in rows)


def made_sentences():
    """Toxic sentences name one group more often; only some of them have an insult to tell by."""
    rows = []
    for at in range(400):
        toxic = at % 2
        group = "muslims" if (at % 20 < 16) == bool(toxic) else "christians"
        insult = " scum" if toxic and at % 6 == 1 else ""
        rows.append((at, f"Yesterday some {group}{insult} came near place{at % 7}.", toxic))
    return rows


def test_swapping_groups_changes_less_with_the_penalty(spark):
    frame = spark.createDataFrame(made_sentences(), "doc_id long, text string, toxic int")
    docs, labels = frame.select("doc_id", "text"), frame.select("doc_id", "toxic")
    neutral = pa.array(["The muslims came here.", "The christians came here."])
    gaps = []
    for fairness in (0.0, 1.0):
        model = toxicity.train(docs, labels, fairness=fairness)
        scores = model.score(neutral)
        gaps.append(abs(np.diff(np.log(scores / (1 - scores))))[0])
        assert model.score(pa.array(["Some scum came near."]))[0] > 0.5
    assert gaps[0] > 0.5 and gaps[1] < 0.3 * gaps[0]


def test_swapped_sentences():
    swaps = list(toxicity.swapped_sentences("Some Women came. None else.\nMen too!", [("women", "men")]))
    assert swaps == [
        ("women", "men", "Some Women came.", "Some men came."), ("men", "women", "Men too!", "women too!")
    ]
    assert len(list(toxicity.swapped_sentences("men. " * 50, [("women", "men")]))) == 50


def test_a_group_named_last_in_a_long_text_counts():
    groups = [("women", "men"), ("gay", "straight", "lesbian")]
    short = toxicity.swap_changes("He is gay.", groups)
    assert len(short) == 2
    long = toxicity.swap_changes("The men came. " * 1000 + "He is gay.", groups)
    assert len(long) == 3
    for (index, value), (other, changed) in zip(short, long[1:]):
        assert index.tolist() == other.tolist() and np.allclose(value, changed)
    # the mean over equal mentions is that of one
    one = toxicity.swap_changes("The men came.", groups)[0]
    assert one[0].tolist() == long[0][0].tolist() and np.allclose(one[1], long[0][1])


def test_samples_are_bounded_per_class_whatever_repeats(spark):
    rows = [(n, 0) for n in range(300)] + [(7, 0)] * 3000 + [(1000 + n, 1) for n in range(20)]
    frame = spark.createDataFrame(rows, "doc long, label int").repartition(4)
    sample = samples.bounded_sample(frame, "label", 40, "doc")
    found = [tuple(row) for row in sample.collect()]
    assert len(found) == len(set(found))
    counts = [sum(label == wanted for _, label in found) for wanted in (0, 1)]
    # the rare class is whole, however often rows of the other one repeat
    assert counts[1] == 20 and 15 <= counts[0] <= 80
    docs = spark.createDataFrame([(1000, "b"), (1000, "a"), (1000, "a"), (1001, None)], "doc_id long, text string")
    texts = samples.one_text_per_id(docs, sample, "doc_id", "text").collect()
    assert len(texts) == 2 and {row.doc for row in texts} == {1000, 1001}


def plain_words(text):
    lower = re.sub("[A-Z]", lambda found: found[0].lower(), text or "")
    return re.findall("[a-z0-9\x80-\U0010ffff]+", lower)


def test_toxicity_scores_equal_a_loop_over_words(spark):
    """Scores of all given documents against sums over words looked up one by one."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = toxicity.train(docs, labels)
    known: dict[str, float] = {}

    def of_word(word):
        if word not in known:
            column = pa.array([word])
            _, words = next(iter(texts.text_words(column, texts.PLAIN)))
            known[word] = sum(model.weights[int(bucket[0])] for bucket in toxicity._buckets(words))
        return known[word]

    for row in docs.select("doc_id", "text", toxicity.scorer(spark, model)("text").alias("s")).collect():
        words = plain_words(row.text)
        mean = sum(map(of_word, words)) / max(1, len(words))
        want = 1 / (1 + math.exp(-max(-60, min(60, toxicity.SCALE * mean + model.bias))))
        assert abs(row.s - want) < 1e-9


def test_quality_scores_equal_a_loop_over_words(spark):
    """Expected grades and tails of all given documents against sums over words one by one."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    model = quality_model.train(docs, ratings(spark.read.parquet(f"{SMALL}/labels.parquet")))
    known: dict[str, float] = {}

    def of_word(word):
        if word not in known:
            _, found = next(iter(texts.text_words(pa.array([word]), texts.BLANK)))
            bucket, shape, _ = quality_model._word_features(found)
            known[word] = model.weights[int(bucket[0])] + model.weights[int(shape[0])]
        return known[word]

    repeat = model.weights[quality_model._REPEAT]
    scored = docs.select("text", quality_model.scorer(spark, model, 1)("text").alias("s")).collect()
    for row in scored:
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
        total = sum(map(of_word, words)) + repeat * sum(a == b for a, b in zip(words, words[1:]))
        length = quality_model._LENGTHS + min(39, int(2 * math.log2(len(words) + 1)))
        standing = quality_model.SCALE * total / max(1, len(words)) + model.weights[length]
        tails = [1 / (1 + math.exp(cut - standing)) for cut in model.thresholds]
        grades = model.grades
        expected = grades[0] + sum(tail * (b - a) for tail, a, b in zip(tails, grades, grades[1:]))
        assert abs(row.s.expected_grade - expected) < 1e-9
        assert abs(row.s.tail - tails[sum(grade < 1 for grade in grades) - 1]) < 1e-9


def test_language_scores_equal_a_loop_over_windows(spark):
    """Predictions for all given documents against a forward pass window by window."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    network = language_id.train(docs, F.lit(True))
    table, *banks, last, bias = [x.astype(float) for x in network.parameters]

    def window_log(window):
        embedded = table[window]
        best = []
        for at, width in enumerate(language_id.WIDTHS):
            bank, shift = banks[2 * at], banks[2 * at + 1]
            answers = [embedded[p : p + width].reshape(-1) @ bank for p in range(len(window) - width + 1)]
            best.append(np.max(answers, axis=0) + shift)
        logits = np.maximum(np.concatenate(best), 0) @ last + bias
        return logits - np.log(np.exp(logits - logits.max()).sum()) - logits.max()

    scored = docs.select("text", language_id.namer(spark, network)("text").alias("n")).collect()
    for row in scored[:60]:
        raw = (row.text or "").encode()
        if not re.search(r"[^\W\d_]", row.text or ""):
            continue
        windows = [raw[at : at + language_id.WINDOW] for at in range(0, len(raw), language_id.WINDOW)]
        logs = np.array([
            window_log(np.frombuffer(one.ljust(language_id.WINDOW, b"\0"), np.uint8)) for one in windows
        ])
        mean = logs.mean(axis=0)
        order = np.argsort(mean)
        if len(order) > 1 and mean[order[-1]] - mean[order[-2]] < 1e-4:
            continue
        assert row.n.lang_pred == network.languages[int(order[-1])]
        assert abs(row.n.score - np.exp(logs).mean(axis=0)[order[-1]]) < 1e-3


@pytest.mark.parametrize("labels", [[], [(5, 1)], [(4, 0), (5, None)], [(1, 1), (5, 0), (5, 1), (None, 1)]])
def test_toxicity_of_odd_rows(spark, labels):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("label", F.lit(9))
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    rows = docs.select(toxicity.scorer(spark, model)("text").alias("s")).collect()
    assert len(rows) == len(ODD) and all(0 <= r.s <= 1 for r in rows)


def test_scores_do_not_depend_on_pieces(monkeypatch):
    draw = np.random.default_rng(5)
    column = pa.array(["word " * 400, None, "a b c", "x" * 500 + " y"])
    models = [
        toxicity.ToxicityModel(draw.normal(size=toxicity.SIZE), 0.1).score,
        quality_model.OrdinalModel((0, 1), draw.normal(size=quality_model.SIZE), np.zeros(1)).standing,
    ]
    whole = [score(column) for score in models]
    monkeypatch.setattr("opdiag.llm.texts.PIECE", 100)
    for score, expected in zip(models, whole):
        assert np.allclose(score(column)[1:], expected[1:])


def test_sparse_products():
    table = pa.table({
        "indices": pa.array([[0, 2], [], [1]], pa.list_(pa.int32())),
        "weights": pa.array([[1.0, 2.0], [], [3.0]], pa.list_(pa.float32())),
    })
    rows = Sparse(table)
    assert rows.times(np.array([1.0, 10.0, 100.0])).tolist() == [201.0, 0.0, 30.0]
    assert rows.transposed(np.array([1.0, 5.0, 2.0]), 3).tolist() == [1.0, 6.0, 2.0]


def test_queries_return_all_documents(spark):
    count = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for name in ("op4_language_id", "op6_quality_model", "op9_toxicity"):
        assert QUERIES[name](spark, SMALL).count() == count
