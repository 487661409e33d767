import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.functions import rasters as ras
from riskloom.operators import evaluation, images
from riskloom.operators.splits import stratified_split
from riskloom.operators.training import best_on_validation, candidate_heads, predict, train_heads


@pytest.mark.parametrize("sizes", [{0: 50, 1: 50}, {0: 7, 1: 3, 2: 1}, {5: 1}, {0: 333, 1: 2, 2: 98}])
@pytest.mark.parametrize("prefix", [1, 4])
def test_split_is_an_exact_partition(spark, sizes, prefix):
    rows = [(label * 1000 + i, label) for label, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "id bigint, label int")
    got = stratified_split(df, "id", 0.2, 42, prefix).collect()
    assert sorted((r.id, r.label) for r in got) == sorted(rows)
    held = Counter(r.label for r in got if r.split == "validation")
    total = sum(sizes.values())
    assert sum(held.values()) == math.ceil(0.2 * total)
    for label, n in sizes.items():
        assert abs(held[label] - n * math.ceil(0.2 * total) / total) < 1
    again = stratified_split(df.repartition(3), "id", 0.2, 42, 4).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    other = stratified_split(df, "id", 0.2, 7).collect()
    assert total < 20 or sorted(map(tuple, other)) != sorted(map(tuple, got))


HEIGHT, WIDTH, CHANNELS = 3, 5, 2


@pytest.fixture(scope="module")
def picture():
    return np.random.default_rng(1).integers(0, 256, size=(HEIGHT, WIDTH, CHANNELS))


def apply(spark, pixels, column):
    df = spark.createDataFrame([([int(v) for v in pixels.ravel()],)], "pixels array<int>")
    return np.array(df.select(column(F.col("pixels"))).first()[0], dtype=float)


def test_scale_and_centre(spark, picture):
    got = apply(spark, picture, ras.scale)
    assert got == pytest.approx(picture.ravel() / 255.0)
    got = apply(spark, picture, lambda p: ras.centre(p, (1.0, 2.0)))
    assert got == pytest.approx((picture - np.array([1.0, 2.0])).ravel())


def test_pretrained_preprocessing_swaps_channels(spark):
    rgb = np.arange(12).reshape(2, 2, 3)
    got = apply(spark, rgb, lambda p: ras.preprocess_pretrained(p, 4))
    want = rgb[:, :, ::-1] - np.array([103.939, 116.779, 123.68])
    assert got == pytest.approx(want.ravel())


def test_flip(spark, picture):
    got = apply(spark, picture, lambda p: ras.flip_horizontal(p, HEIGHT, WIDTH, CHANNELS))
    assert (got == picture[:, ::-1, :].ravel()).all()


def test_upsample(spark, picture):
    got = apply(spark, picture, lambda p: ras.upsample(p, HEIGHT, WIDTH, CHANNELS, 3))
    assert (got == picture.repeat(3, axis=0).repeat(3, axis=1).ravel()).all()


@pytest.mark.parametrize("dy, dx", [(0, 0), (1, -2), (0.5, 0.25), (-1.75, 3.5), (9, 9)])
def test_shift(spark, picture, dy, dx):
    got = apply(
        spark, picture,
        lambda p: ras.shift(p, F.lit(float(dy)), F.lit(float(dx)), HEIGHT, WIDTH, CHANNELS),
    ).reshape(picture.shape)
    for y in range(HEIGHT):
        for x in range(WIDTH):
            sy, sx = y - dy, x - dx
            t, left = math.floor(sy), math.floor(sx)
            want = np.zeros(CHANNELS)
            for oy, wy in ((t, 1 - (sy - t)), (t + 1, sy - t)):
                for ox, wx in ((left, 1 - (sx - left)), (left + 1, sx - left)):
                    cell = picture[min(max(oy, 0), HEIGHT - 1), min(max(ox, 0), WIDTH - 1)]
                    want += wy * wx * cell
            assert got[y, x] == pytest.approx(want)


def test_random_augmentation_depends_on_id_and_seed(spark):
    df = spark.range(200).withColumn("pixels", F.array(*map(F.lit, [1, 2, 3, 4])))
    flipped = images.random_flip(df, 2, 2, 1)
    n = flipped.filter(F.col("pixels") == F.array(*map(F.lit, [2, 1, 4, 3]))).count()
    assert 60 < n < 140
    again = images.random_flip(df.repartition(3), 2, 2, 1)
    assert sorted(map(str, again.collect())) == sorted(map(str, flipped.collect()))
    still = images.random_shift(df, 2, 2, 1, factor=0.0)
    assert still.filter(F.col("pixels") == F.array(*[F.lit(float(v)) for v in (1, 2, 3, 4)])).count() == 200


def test_profile_classes_and_samples(spark):
    rows = [(1, [0, 5], [3]), (2, [7, 255, 9], [3]), (3, [1], [0])]
    df = spark.createDataFrame(rows, "id int, pixels array<int>, label array<int>")
    assert tuple(images.dataset_profile(df).first()) == (3, 1, 3, 0, 255, "int")
    flat = df.withColumn("label", ras.first_label(F.col("label")))
    names = {r.label: (r.n, r.class_name) for r in images.class_distribution(flat).collect()}
    assert names == {3: (2, "Gato"), 0: (1, "Avión")}
    weights = {r.label: r.weight for r in images.class_weights(flat).collect()}
    assert weights == {3: pytest.approx(0.75), 0: pytest.approx(1.5)}
    assert [r.id for r in images.first_samples(flat, 2).collect()] == [1, 2]


def predictions(spark, pairs):
    rows = [(i, y, p, [0.7, 0.2, 0.1]) for i, (y, p) in enumerate(pairs)]
    return spark.createDataFrame(rows, "id int, label int, prediction int, probabilities array<double>")


def test_report_with_a_class_never_predicted(spark):
    df = predictions(spark, [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)])
    got = {r["class"]: (r.precision, r.recall, r.f1_score, r.support)
           for r in evaluation.classification_report(df).collect()}
    assert got["0"] == (0.5, 0.5, 0.5, 2)
    assert got["1"] == pytest.approx((2 / 3, 1.0, 0.8, 2))
    assert got["2"] == (0.0, 0.0, 0.0, 1)
    assert got["accuracy"] == pytest.approx((0.6, 0.6, 0.6, 5))
    assert got["macro avg"] == pytest.approx(((0.5 + 2 / 3) / 3, 0.5, 1.3 / 3, 5))
    assert got["weighted avg"] == pytest.approx(((1 + 4 / 3) / 5, 0.6, 2.6 / 5, 5))


def test_confusion_matrix_rows_sum_to_support(spark):
    df = predictions(spark, [(0, 0), (0, 1), (1, 1), (2, 0)])
    got = {r.label: tuple(r)[1:] for r in evaluation.confusion_matrix(df, [0, 1, 2]).collect()}
    assert got == {0: (1, 1, 0, 0), 1: (0, 1, 0, 0), 2: (1, 0, 0, 0)}


def test_confusion_matrix_is_a_full_square(spark):
    df = predictions(spark, [(0, 0), (1, 2), (1, 7), (5, 0)])
    got = {r.label: tuple(r)[1:] for r in evaluation.confusion_matrix(df, [0, 1, 2]).collect()}
    assert got == {0: (1, 0, 0, 0), 1: (0, 0, 1, 1), 2: (0, 0, 0, 0), 5: (1, 0, 0, 0)}


def test_loss_accuracy_and_argmax(spark):
    df = predictions(spark, [(0, 0), (2, 0)])
    got = evaluation.test_metrics(df).first()
    assert got.test_loss == pytest.approx(-(math.log(0.7) + math.log(0.1)) / 2)
    assert got.test_accuracy == 0.5
    rows = spark.createDataFrame([([0.2, 0.4, 0.4],), ([1.0],)], "p array<double>")
    assert [r[0] for r in rows.select(ras.argmax(F.col("p"))).collect()] == [1, 0]
    certain = spark.createDataFrame([(0, 1, [0.0, 1.0])], "label int, prediction int, probabilities array<double>")
    assert evaluation.test_metrics(certain).first().test_loss == pytest.approx(-math.log(1e-7))


def test_heads_learn_separable_classes(spark):
    rng = np.random.default_rng(0)
    rows = [(i, i % 3, (np.eye(3)[i % 3] * 4 + rng.normal(size=3)).tolist()) for i in range(240)]
    df = spark.createDataFrame(rows, "id bigint, label int, vector array<float>")
    parts = stratified_split(df, "id").persist()
    train, held = (parts.filter(F.col("split") == s) for s in ("train", "validation"))
    models = train_heads(train, candidate_heads(3, 3))
    best = best_on_validation(models, held)
    scored = predict(models[best], held, best)
    assert evaluation.test_metrics(scored).first().test_accuracy > 0.9
    table = evaluation.model_comparison(scored).collect()
    assert [r.modelo for r in table] == [best]
