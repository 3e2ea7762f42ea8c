import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyhawk.operators import sampling
from tallyhawk.operators.quality import class_counts


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(5000).select("id", F.when(F.col("id") % 25 == 0, 1).otherwise(0).alias("label")).persist()


def counts(df, label="label"):
    return {r[label]: r["n"] for r in class_counts(df, label).collect()}


def test_split_is_a_partition_of_the_keys_and_ignores_placement(people):
    first = sampling.split_by_key(people, "id")
    assert rows(first) == rows(sampling.split_by_key(people.repartition(11).orderBy(F.desc("id")), "id"))
    shares = {r["split"]: r["n"] / 5000 for r in first.groupBy("split").agg(F.count("id").alias("n")).collect()}
    assert shares == pytest.approx({"train": 0.6, "val": 0.2, "test": 0.2}, abs=0.03)
    assert first.select("id").distinct().count() == 5000


def test_seeds_give_different_splits_and_weights_must_add_up(people):
    a, b = (sampling.split_by_key(people, "id", seed=s) for s in (1, 2))
    assert rows(a) != rows(b)
    with pytest.raises(ValueError):
        sampling.split_by_key(people, "id", {"train": 0.5, "test": 0.4})


def test_class_weights_sum_to_the_row_count(people):
    weighted = sampling.class_weights(people)
    assert weighted.agg(F.sum("class_weight")).first()[0] == pytest.approx(5000)
    by_class = {r["label"]: r["class_weight"] for r in weighted.select("label", "class_weight").distinct().collect()}
    assert by_class == pytest.approx({0: 5000 / 9600, 1: 5000 / 400})


def test_published_class_weights(spark):
    n0, n1 = 3_349_338, 101_028
    df = spark.createDataFrame([(0, n0), (1, n1)], "label int, n long")
    exploded = df.select("label", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    got = {r["label"]: r["class_weight"] for r in sampling.class_weights(exploded).select("label", "class_weight").distinct().collect()}
    assert got == pytest.approx({0: 0.5150817863112054, 1: 17.0762857821594}, rel=1e-14)


def test_weights_of_a_one_class_table_are_an_error(people):
    with pytest.raises(Exception, match="rows of both classes"):
        sampling.class_weights(people.filter("label = 0")).collect()


@pytest.mark.parametrize("keep,factor", [("true", 24), ("label = 0", 1), ("label = 1 or id % 40 < 3", 1), ("label = 1", 1)])
def test_oversampling(people, keep, factor):
    part = people.filter(keep)
    before, after = counts(part), counts(sampling.oversample_minority(part))
    ratio = before.get(0, 0) / max(before.get(1, 0), 1)
    expected = int(ratio) if before.get(1) and ratio > 2 else 1
    if keep == "true":
        assert expected == factor
    assert after.get(1, 0) == before.get(1, 0) * expected and after.get(0, 0) == before.get(0, 0)


def test_oversampled_rows_can_be_spread(people):
    out = sampling.oversample_minority(people, partitions=5)
    assert out.rdd.getNumPartitions() == 5 and counts(out) == {0: 4800, 1: 4800}


def test_a_sample_of_a_split_has_its_share(people):
    train = sampling.split_by_key(people, "id").filter("split = 'train'")
    n = train.count()
    for fraction in (0.1, 0.4, 0.8):
        kept = sampling.bernoulli_sample(train, "id", fraction).count()
        assert abs(kept - fraction * n) < 4 * (n * fraction * (1 - fraction)) ** 0.5


def test_tiny_fractions_are_not_lost(spark):
    kept = sampling.bernoulli_sample(spark.range(2_000_000), "id", 0.00004).count()
    assert 44 <= kept <= 116


def test_stratified_sample_and_folds_are_exact(people):
    assert counts(sampling.stratified_sample(people, "id", "label", 0.1)) == {0: 480, 1: 20}
    folded = sampling.stratified_folds(people, "id", "label", 3)
    sizes = folded.groupBy("label", "fold").count().collect()
    for label in (0, 1):
        mine = [r["count"] for r in sizes if r["label"] == label]
        assert len(mine) == 3 and max(mine) - min(mine) <= 1


def test_samples_are_nested(people):
    ladder = sampling.fraction_ladder(people, "id", (0.1, 0.5, 1.0))
    members = {f: {r["id"] for r in ladder.filter(F.col("frac") == f).collect()} for f in (0.1, 0.5, 1.0)}
    assert members[0.1] < members[0.5] < members[1.0] and len(members[1.0]) == 5000
    assert {r["id"] for r in sampling.bernoulli_sample(people, "id", 0.5).collect()} == members[0.5]


def test_bootstrap_weights_have_mean_one(people):
    drawn = sampling.bootstrap_weights(people, "id", 20)
    per_replicate = [r["w"] for r in drawn.groupBy("replicate").agg(F.sum("weight").alias("w")).collect()]
    assert len(per_replicate) == 20
    assert sum(per_replicate) / 20 == pytest.approx(5000, rel=0.01)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "id long, label int")
    assert sampling.split_by_key(empty, "id").count() == 0
    assert sampling.stratified_folds(empty, "id", "label", 3).count() == 0
    assert sampling.oversample_minority(empty).count() == 0
