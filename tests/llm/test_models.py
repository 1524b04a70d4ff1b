"""The classifiers: parts against plain computations, the whole by accuracy on rows they didn't learn from."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import rows_of
from pyspark.sql import functions as F

from flowgauge.llm import quality, toxicity
from flowgauge.llm.common import table
from flowgauge.llm.held_out import fold, is_held_out
from flowgauge.llm.partition_sums import partition_sums
from flowgauge.session import settle

SF = "/root/testdata/sf0.1"
LABELS = "doc_id bigint, quality int, toxic int, score string"
ODD = [(None, "a row without an id"), (900_001, None), (900_002, ""), (900_003, "word " * 60_000), (900_001, None)]


def test_held_out_is_crc32_of_the_id(spark):
    ids = [0, 1, 7, 99, -5, 123456789012, None]
    found = spark.createDataFrame([(i,) for i in ids], "doc_id bigint").select("doc_id", fold(), is_held_out()).collect()
    for doc_id, number, held in found:
        wanted = zlib.crc32(str(doc_id).encode()) % 5 if doc_id is not None else 0
        assert (number, held) == (wanted, wanted == 0)


@pytest.mark.parametrize("partitions", [1, 7])
def test_partition_sums(spark, partitions):
    rows = spark.range(500).repartition(partitions).select(F.col("id").cast("double").alias("x"))

    def work(batch):
        x = np.asarray(batch.column(0))
        return np.array([[len(x), x.sum()], [(x**2).sum(), 0]])

    x = np.arange(500.0)
    assert np.allclose(partition_sums(rows, work, (2, 2)), [[500, x.sum()], [(x**2).sum(), 0]])
    assert not partition_sums(rows.filter("x < 0"), work, (2, 2)).any()


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(3)
    for n in (1, 2, 9, 30):
        v, w = rng.random(n).round(1), rng.integers(1, 5, n).astype(float)
        means = lambda i, j: np.average(v[i : j + 1], weights=w[i : j + 1])
        wanted = [max(min(means(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]
        assert np.allclose(quality.isotonic(v, w), wanted)


def test_random_features_approximate_the_gaussian_kernel():
    d = len(quality.STATISTICS)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, d))
    many = 20_000
    kernel = quality.Kernel(
        np.zeros(d), np.ones(d), rng.normal(0, 1 / np.sqrt(d), (d, many)), rng.uniform(0, 2 * np.pi, many)
    )
    z = kernel(x)[:, 1:]
    distance = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-distance / (2 * d))).max() < 0.05


def test_ridge_leaves_a_fold_out(spark):
    rng = np.random.default_rng(1)
    d = len(quality.STATISTICS)
    x = rng.normal(size=(300, d))
    y = (x[:, 0] + 0.3 * rng.normal(size=300) > 0).astype(float)
    folds = rng.integers(1, 5, 300)
    rows = [(list(map(float, a)), float(b), int(c)) for a, b, c in zip(x, y, folds)]
    df = spark.createDataFrame(rows, "x array<double>, y double, fold int").repartition(3)
    kernel = quality.fit_kernel(df, 12, 5)
    assert np.allclose(kernel.mean, x.mean(axis=0)) and np.allclose(kernel.scale, x.std(axis=0))
    weights = quality.fit_ridge(df, kernel, 0.01)
    for k in range(5):
        z, t = kernel(x[folds != k]), y[folds != k]
        penalty = np.diag([1e-9] + [0.01] * 12)
        assert np.allclose(weights[k], np.linalg.solve(z.T @ z / len(t) + penalty, z.T @ t / len(t)))


def test_statistics_of_odd_texts():
    assert quality.statistics(b"") == [0.0] * len(quality.STATISTICS)
    for text in (" ", "\n\n", "é", "x" * 100_000, "a b " * 50_000, "!!!", "\x00\x01"):
        found = quality.statistics(text.encode())
        assert len(found) == len(quality.STATISTICS) and np.isfinite(found).all()


def share_right(found, labels, column, held_out=True):
    met = found.join(labels, "doc_id").filter(F.col("held_out") == held_out)
    return met.agg(F.avg((F.col("predicted") == F.col(column)).cast("int"))).first()[0]


def with_odd_rows(spark, docs):
    odd = spark.createDataFrame(ODD, "doc_id bigint, text string")
    return docs.select("doc_id", "text").unionByName(odd).withColumn("score", F.lit("x")).withColumn("y", F.lit(1))


@pytest.mark.parametrize("module,column,least", [(quality, "quality", 0.97), (toxicity, "toxic", 0.96)])
def test_held_out_accuracy_and_odd_rows(spark, module, column, least):
    docs, labels = with_odd_rows(spark, table(spark, SF, "documents")), table(spark, SF, "labels")
    extra = spark.createDataFrame([(None, 1, 1, "x"), (900_002, None, None, "x"), (77_777_777, 0, 1, "x")], LABELS)
    noisy = labels.withColumn("score", F.lit("x")).select("doc_id", "quality", "toxic", "score").unionByName(extra)
    score = quality.quality_scores if module is quality else toxicity.toxicity_scores
    found = score(docs, noisy).select("doc_id", "held_out", "score", "predicted").cache()
    assert found.count() == docs.count()
    assert found.filter("score IS NULL OR score < 0 OR score > 1 OR predicted IS NULL").count() == 0
    assert share_right(found, labels, column) >= least
    threshold = module.THRESHOLD
    assert found.filter((F.col("score") >= threshold) != (F.col("predicted") == 1)).count() == 0
    assert found.filter("doc_id = 900001").count() == 2 and found.filter("doc_id IS NULL").first().held_out


@pytest.mark.parametrize("score", [quality.quality_scores, toxicity.toxicity_scores])
def test_nothing_to_learn_from(spark, make, score):
    docs = make([(1, "some text"), (2, None), (3, "you idiot, such scum and trash")])
    none = spark.createDataFrame([], LABELS)
    held = spark.createDataFrame([(i, 0, 1, "x") for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0], LABELS)
    one = spark.createDataFrame([(i, 1, 0, "x") for i in range(1, 4)], LABELS)
    for labels in (none, held, one):
        assert score(docs, labels).filter("score BETWEEN 0 AND 1").count() == 3
    assert score(make([]), one).count() == 0


def test_labels_of_fold_0_change_nothing(spark, make):
    rows = [(i, f"good words number {i} stand here in a row" if i % 3 else "BAD!! ### " * (i + 1)) for i in range(120)]
    docs = make(rows)
    labels = [(i, int(i % 3 > 0), int(i % 3 == 0), "x") for i, _ in rows]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t, s)
              for i, q, t, s in labels]
    for score in (quality.quality_scores, toxicity.toxicity_scores):
        a, b = (
            np.array([r.score for r in score(docs, spark.createDataFrame(x, LABELS)).orderBy("doc_id").collect()])
            for x in (labels, turned)
        )
        assert np.allclose(a, b, atol=1e-9)


def test_accept_keeps_rows_as_they_are(spark, make):
    rows = [(i, f"good words number {i} stand here in a row" if i % 3 else "BAD!! ### " * (i + 1)) for i in range(120)]
    rows += [(None, "good words without a number stand here in a row"), (None, "BAD!! ### " * 7), (200, None), (5, rows[5][1])]
    docs = make(rows)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0, "x") for i in range(120)], LABELS)
    kept = quality.accept(docs, labels)
    assert kept.columns == docs.columns
    good = quality.quality_scores(docs, labels).filter("predicted = 1")
    assert rows_of(kept, "doc_id") == rows_of(good, "doc_id")
    assert "BAD!! ### " * 7 not in {r.text for r in kept.collect()}


def test_label_model_finds_the_good_voters(spark):
    """Made votes: one of three good voters is copied, one voter is noise."""
    rng = np.random.default_rng(8)
    y = rng.random(6000) < 0.2
    fire = lambda a, b: np.where(y, rng.random(6000) < a, rng.random(6000) < b)
    first = fire(0.7, 0.02)
    votes = np.stack([first, fire(0.6, 0.03), fire(0.5, 0.01), first, fire(0.3, 0.3)], axis=1)
    rows = [([int(i) for i in np.flatnonzero(v)], [], 1) for v in votes]
    patterns = settle(spark.createDataFrame(rows, "fixed array<int>, held array<int>, n bigint").repartition(3))

    def matrix(batch):
        own = toxicity.incidence(batch.column(0), 5)
        return np.hstack([own, ~own.any(axis=1)[:, None]])

    seen = votes[:500]
    start = toxicity.first_guess(np.hstack([seen, ~seen.any(axis=1)[:, None]]), y[:500])
    model = toxicity.fit_label_model(patterns, matrix, start, 0.2)
    assert 0.15 < model.prior < 0.25
    assert np.allclose(model.fires[1][:3], [0.7, 0.6, 0.5], atol=0.08) and (model.fires[0][:3] < 0.06).all()
    assert model.discount[0] < 0.65 and model.discount[0] == pytest.approx(model.discount[3])  # two that say the same
    whole = np.hstack([votes, ~votes.any(axis=1)[:, None]]).astype(float)
    assert ((model.posterior(whole) > 0.5) == y).mean() > 0.93


def test_linear_classifier_learns_soft_labels():
    rng = np.random.default_rng(2)
    x = (rng.random((2000, 6)) < 0.3).astype(float)
    q = 1 / (1 + np.exp(-(x @ np.array([3, -2, 1, 0, 0, 0.5]) - 1)))
    w = toxicity.fit_linear(x, q, ridge=1e-8)
    assert np.allclose(w, [-1, 3, -2, 1, 0, 0, 0.5], atol=0.01)


def test_stems_and_words():
    stems = toxicity.stems_of(toxicity.words_of("Ein Lächeln, ja's".encode()))
    assert {b"ein", "lächeln".encode(), "läch-".encode(), "läche-".encode(), b"ja's"} <= stems
    assert b"ein-" not in stems and toxicity.words_of(b"") == set()
    lists = pa.array([[0, 2], [], [1]], pa.list_(pa.int32()))
    assert toxicity.incidence(lists, 3).tolist() == [[True, False, True], [False] * 3, [False, True, False]]
    assert toxicity.incidence(lists.slice(2, 1), 3).tolist() == [[False, True, False]]
