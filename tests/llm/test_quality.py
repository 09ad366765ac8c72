"""The quality classifier: held-out accuracy and odd tables."""

import math
import re
import zlib

import numpy as np
import pytest

from tagloom.llm import quality, queries

FOLDER = "/root/testdata/sf0.1"


def docs(spark, rows):
    return spark.createDataFrame([(key, text, "s", 3) for key, text in rows], "doc_id long, text string, score string, _score int")


def labels(spark, rows):
    return spark.createDataFrame([(*row, 1) for row in rows], "doc_id long, quality int, held_out int")


def test_held_out_accuracy(spark):
    found = {row.doc_id: row for row in queries.op5_quality(spark, FOLDER).collect()}
    wanted = {row.doc_id: row.quality for row in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert len(found) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for key, row in found.items():
        assert row.held_out == (zlib.crc32(str(key).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
    unseen = [(row.score, row.predicted, wanted[key]) for key, row in found.items() if row.held_out and key in wanted]
    assert np.mean([predicted == label for _, predicted, label in unseen]) >= 0.95
    clean = [predicted for _, predicted, label in unseen if label == 1]
    assert np.mean(clean) >= 0.97
    assert np.mean([(score - label) ** 2 for score, _, label in unseen]) <= 0.04


GOOD = [(n, f"the cat {n % 7} sat on a mat {n % 11} and saw the dog {n % 5} run") for n in range(300)]
BAD = [(n, "BUY!! NOW!! $$$ " * (n % 9 + 1)) for n in range(300, 600)]
ODD = [(1000, None), (1001, ""), (None, "the cat sat"), (1002, "  \n"), (7, "the cat"), (7, "the cat"), (1003, "the cat sat on a mat " * 100_000)]
LABELS = [(n, 1) for n, _ in GOOD] + [(n, 0) for n, _ in BAD] + [(None, 1), (5, None), (6, 9), (999_999, 1), (1000, 0), (8, 1)]


def test_odd_rows_and_splits(spark):
    table = docs(spark, GOOD + BAD + ODD)
    model = quality.fit(table, labels(spark, LABELS))
    rows = quality.score(table, model).collect()
    assert len(rows) == len(GOOD + BAD + ODD) and rows[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    by = {row.doc_id: row for row in rows}
    assert np.mean([by[n].predicted for n, _ in GOOD]) > 0.99 and np.mean([by[n].predicted for n, _ in BAD]) < 0.01
    assert by[1000].score == by[1001].score == by[1002].score
    assert by[None].held_out and by[1003].predicted == 1
    other = quality.fit(table.repartition(7), labels(spark, LABELS[::-1]))
    assert np.array_equal(model.vectors, other.vectors)
    assert all(np.allclose(a, b) for a, b in zip(model.network.weights, other.network.weights))


def test_labels_held_out_are_not_learned_from(spark):
    table = docs(spark, GOOD + BAD)
    turned = [(n, 1 - q if n is not None and q in (0, 1) and zlib.crc32(str(n).encode()) % 5 == 0 else q) for n, q in LABELS]
    one, two = (quality.fit(table, labels(spark, rows)).network for rows in (LABELS, turned))
    assert all(np.array_equal(a, b) for a, b in zip(one.weights, two.weights)) and one.temperature == two.temperature


@pytest.mark.parametrize("rows, expected", [([], 0.5), ([(n, 1) for n in range(40)], 1.0)])
def test_without_both_kinds_of_labels(spark, rows, expected):
    table = docs(spark, GOOD)
    assert {row.score for row in quality.score(table, quality.fit(table, labels(spark, rows))).collect()} == {expected}


def test_no_rows(spark):
    model = quality.fit(docs(spark, []), labels(spark, LABELS))
    assert quality.score(docs(spark, []), model).collect() == []


def test_accepted_keeps_rows_whole(spark):
    table = spark.createDataFrame(GOOD + BAD + ODD, "doc_id long, text string")
    model = quality.fit(table, labels(spark, LABELS))
    wanted = {row.doc_id for row in quality.score(table, model).collect() if row.predicted}
    left = quality.accepted(table, model).collect()
    assert {row.doc_id for row in left} == wanted and set(left) <= set(table.collect())


def test_temperature_calibrates():
    random = np.random.RandomState(1)
    x = random.standard_normal((4000, 3))
    y = (random.random_sample(4000) < quality.sigmoid(2 * x[:, 0])).astype(int)
    scores = quality.fit_network(x[:3000], y[:3000]).scores(x[3000:])
    for low in (0.1, 0.3, 0.5, 0.7):
        inside = (scores >= low) & (scores < low + 0.2)
        assert abs(scores[inside].mean() - y[3000:][inside].mean()) < 0.1


def test_any_column_names(spark):
    table = docs(spark, GOOD + BAD)
    model = quality.fit(table, labels(spark, LABELS))
    kept = quality.accepted(table, model)
    assert kept.columns == table.columns
    assert {row.doc_id for row in kept.collect()} == {row.doc_id for row in quality.score(table, model).collect() if row.predicted}


def test_word_vectors_pooling_and_scores_by_hand(spark):
    texts = [text for _, text in GOOD[:40] + BAD[:40]] + ["", "one", "two words", "a b a c a"]
    table = docs(spark, list(enumerate(texts)))
    vectors = quality.word_vectors(table)
    places, signs = quality._index_vectors()
    ids = [[zlib.crc32(word.encode()) % quality.BUCKETS for word in re.findall(r"\w+|[^\w\s]+", text)] for text in texts]
    summed = {}
    for words in ids:
        for at, word in enumerate(words):
            for beside in words[max(0, at - 2) : at] + words[at + 1 : at + 3]:
                own = summed.setdefault(word, [0] * quality.DIMS)
                for place, sign in zip(places[beside], signs[beside]):
                    own[place] += sign
    by_hand = {}
    for word, own in summed.items():
        length = math.sqrt(sum(x * x for x in own))
        by_hand[word] = [x / length if length else 0.0 for x in own]
        assert vectors[word] == pytest.approx(by_hand[word], abs=1e-6)
    assert {n for n in range(quality.BUCKETS) if vectors[n].any()} == {word for word, own in summed.items() if any(own)}
    model = quality.fit(table, labels(spark, [(n, int(n < 40)) for n in range(80)]))
    w1, b1, w2, b2 = model.network.weights
    scores = {row.doc_id: row.score for row in quality.score(table, model).collect()}
    for n, words in enumerate(ids):
        rows = [by_hand.get(word, [0.0] * quality.DIMS) for word in words]
        mean = [sum(column) / len(rows) for column in zip(*rows)] if rows else [0.0] * quality.DIMS
        spread = [math.sqrt(max(0, sum(x * x for x in column) / len(rows) - m * m)) for column, m in zip(zip(*rows), mean)] if rows else [0.0] * quality.DIMS
        steps = [sum(abs(a - b) for a, b in zip(column, column[1:])) / max(1, len(rows) - 1) for column in zip(*rows)] if rows else [0.0] * quality.DIMS
        x = (np.array(mean + spread + steps) - model.network.centre) / model.network.scale
        logit = sum(math.tanh(sum(a * b for a, b in zip(x, column)) + bias) * out for column, bias, out in zip(w1.T, b1, w2)) + b2
        assert scores[n] == pytest.approx(1 / (1 + math.exp(-logit / model.network.temperature)), abs=2e-4)
