import zlib

import numpy as np

from listing_lake.llm import quality
from listing_lake.llm.calibration import Logistic
from listing_lake.llm.common import table
from listing_lake.session import stored

SF = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, by_text int"
LABELS = "doc_id long, quality int, text string"


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    scored = stored(quality.score(docs, labels))
    assert scored.count() == docs.count()
    tested = [r for r in scored.join(labels, "doc_id").collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in tested)
    low = [r for r in tested if r.quality == 0]
    assert np.mean([r.predicted == r.quality for r in tested]) > 0.95
    assert np.mean([r.predicted == 0 for r in low]) > 0.8


def test_views_teach_each_other():
    """The metadata view has few labels but agrees with the text view on the pool."""
    rng = np.random.default_rng(3)
    truth, pool_truth = rng.random(60) < 0.5, rng.random(3000) < 0.5

    def views(y):
        return (
            np.column_stack([y * 2.0 - 1 + 0.4 * rng.normal(size=len(y))]),
            np.column_stack([(y * 2.0 - 1) * (j % 2) + rng.normal(size=len(y)) for j in range(30)]),
        )

    text, meta = views(truth)
    pool_text, pool_meta = views(pool_truth)
    aside = np.arange(60) % 4 == 3
    model = quality.CoTrained(
        text, meta, truth.astype(float), aside, lambda function, *args: function(*args, (pool_text, pool_meta))
    )
    alone = Logistic(meta[~aside], truth[~aside].astype(float))
    fresh = rng.random(4000) < 0.5
    new_text, new_meta = views(fresh)
    right = np.mean((model.views(new_text, new_meta)[1] > 0.5) == fresh)
    assert right > np.mean((alone(new_meta) > 0.5) == fresh) - 0.005
    assert np.mean((model(new_text, new_meta) > 0.5) == fresh) > 0.97


def test_odd_rows(spark):
    rows = [(i, "Good plain words here. " * 5 if i % 3 else "$$$ ### !!" * 6, "en", f"s{i % 4}", 100, 1) for i in range(300)]
    rows += [(900, None, None, None, None, 1), (901, "", "en", "s1", -5, 1), (None, "x", "en", "s", 1, 1), (902, "word " * 60_000, "en", "s", 1, 1), (902, "word", "en", "s", 1, 1)]
    marks = [(i, int(i % 3 > 0), "t") for i in range(200)] + [(5, None, "t"), (None, 1, "t")]
    found = quality.score(spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, LABELS)).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert all(r.predicted == int(r.doc_id % 3 > 0) for r in found if r.doc_id is not None and r.doc_id < 300)


def test_no_labels_and_no_rows(spark):
    frame = spark.createDataFrame([(1, "a", "en", "s", 1, 1)], DOCS)
    assert [r.score for r in quality.score(frame, spark.createDataFrame([], LABELS)).collect()] == [0.5]
    assert quality.score(frame.limit(0), spark.createDataFrame([(1, 1, "t")], LABELS)).collect() == []


def test_limits_take_whole_bins_and_only_sure_ones():
    counts = np.zeros(2 * quality.LIMIT * quality.FINE + 1)
    middle = quality.LIMIT * quality.FINE
    counts[[middle - 200, middle - 100, middle, middle + 100, middle + 300]] = 10, 30, 1000, 40, 5
    found = quality.handing(counts, 0.02, 0.5, 60)
    assert (found.low, found.high) == (middle - 100, middle + 100)  # 40 and 45, where 11 of each are wanted
    assert found.weights == (30 / 40, 30 / 45)
    assert quality.handing(counts, 0.9, 0.5, 60).high > middle  # no bin that is not sure
    rare = quality.handing(counts, 0.02, 0.99, 60)
    assert rare.high > middle + 100  # sure beyond the share of the labels
    none = quality.handing(counts * 0, 0.02, 0.5, 60)
    assert none.weights == (0.0, 0.0)


def test_sums_over_the_unlabelled_rows(spark):
    """What Spark adds up over many tasks is the same as over all rows at once."""
    rng = np.random.default_rng(5)
    views = [rng.normal(size=(500, width)).astype("f4") for width in (6, 3)]
    frame = spark.createDataFrame(
        [(a.tolist(), b.tolist()) for a, b in zip(*views)], "by_text array<float>, by_meta array<float>"
    ).repartition(7)
    labels = (views[0][:, 0] + views[1][:, 0] > 0).astype(float)
    lines = [quality.fitted(v.astype(float), labels) for v in views]
    handed = [quality.Handing(400, 900, (0.5, 1.0)), quality.Handing(620, 660, (1.0, 0.25))]
    over = quality._over(frame, (6, 3))
    assert np.array_equal(over(quality.tally, lines), quality.tally(lines, views))
    assert np.allclose(over(quality.told, lines, handed, lines), quality.told(lines, handed, lines, views))


def test_each_fitting_step_raises_the_likelihood():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 4)) * [1, 5, 0.1, 1]
    y = (x[:, 1] + 0.1 * rng.normal(size=300) > 0).astype(float)
    line, before = quality.Line(x.mean(axis=0), x.std(axis=0), rng.normal(size=5) * 9), -np.inf
    for _ in range(20):
        z = line.design(x) @ line.weights
        now = (y * z - np.logaddexp(0, z)).sum() - quality.RIDGE / 2 * (line.weights[1:] ** 2).sum()
        assert now >= before - 1e-6
        line, before = line.moved(line.sums(x, y, np.ones(300))), now


def test_frequent_values_have_places_of_their_own(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("c",), (None,)], "source string")
    places = quality._places(rows, "source", 2, 4)
    assert places.own == {"a": 0, "c": 1} and places.size == 6 and places("b") >= 2
