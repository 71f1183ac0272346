"""ML pipeline: search space, three label classes (G15), one-hot NULL slot."""

from pyspark.sql import functions as F

from lakeforge.plans import ml

from .conftest import SF_SMALL


def test_search_space_bounds_and_determinism():
    a, b = ml.sample_space(100, 42), ml.sample_space(100, 42)
    assert a == b and len(a) == 100
    assert all(3 <= t["maxDepth"] <= 30 for t in a)
    assert all(1e-6 <= t[f] <= 1e-3 for t in a for f in ("leaf_fraction", "split_fraction"))


def test_leaf_fraction_becomes_rows():
    assert ml.tree_settings({"maxDepth": 4, "leaf_fraction": 1e-3}, 323) == {"maxDepth": 4, "minInstancesPerNode": 1}
    assert ml.tree_settings({"maxDepth": 4, "leaf_fraction": 1e-3}, 50_500)["minInstancesPerNode"] == 51


def test_scoring_covers_every_document_outside_the_training_rows(spark):
    train, test = ml.train_test(spark, SF_SMALL)
    total = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert train.count() + test.count() == total and test.filter("toxic IS NULL").count() > 0
    scored = ml.ml_score_saved_model(spark, SF_SMALL)
    assert scored.count() == test.count()


def test_search_fits_and_scores(spark):
    train, test = ml.train_test(spark, SF_SMALL)
    leaves, features, trials = ml.search(train, trials=4, folds=2, parallelism=4)
    rows = trials.collect()
    assert len(rows) == 4 and all(0 <= r["cv_accuracy"] <= 1 for r in rows)
    assert sum(sum(x.counts) for x in leaves) == train.count()
    scored = ml.score_by_paths(features.transform(train).select("doc_id", "features"), leaves)
    assert scored.count() == train.count()


def test_split_fraction_changes_scores(spark):
    train, _ = ml.train_test(spark, "/root/testdata/sf0.01")
    one = {"maxDepth": 6, "leaf_fraction": 1e-6}
    _, _, trials = ml.search(train, folds=2, parallelism=4, space=[{**one, "split_fraction": f} for f in (1e-6, 0.3, 1.0)])
    got = [r["cv_accuracy"] for r in trials.orderBy("trial").collect()]
    labels = [r["quality"] for r in train.select("quality").collect()]
    assert got[0] != got[2] and abs(got[2] - max(labels.count(0), labels.count(1)) / len(labels)) < 0.05  # no split: the larger class


def test_prune_merges_the_leaves_below_small_nodes():
    leaves = [ml.Leaf(((0, False, 1.0), (1, False, 2.0)), (5, 1)), ml.Leaf(((0, False, 1.0), (1, True, 2.0)), (0, 4)), ml.Leaf(((0, True, 1.0),), (20, 0))]
    assert ml.prune(leaves, 2) == leaves
    merged = ml.prune(leaves, 11)
    assert merged[0] == merged[1] == ml.Leaf(((0, False, 1.0),), (5, 5)) and merged[2] == leaves[2]
    assert set(ml.prune(leaves, 31)) == {ml.Leaf((), (25, 5))}
    assert leaves[1].bounds() == {0: (float("-inf"), 1.0), 1: (2.0, float("inf"))}


def test_paths_score_as_the_model(spark):
    train, test = ml.train_test(spark, "/root/testdata/sf0.01")
    model = ml.feature_pipeline(maxDepth=7, minInstancesPerNode=2).fit(train)
    leaves = ml.fitted_leaves(model.stages[-1], ml.PipelineModel(model.stages[:-1]).transform(train))
    assert len(leaves) > 8 and sum(sum(x.counts) for x in leaves) == train.count()
    ids = test.unionByName(test.limit(3)).withColumn("doc_id", F.when(F.col("doc_id") != "5", F.col("doc_id")))  # repeated and NULL ids
    rows = ml.PipelineModel(model.stages[:-2]).transform(ids).select("doc_id", "features")
    got = ml.score_by_paths(rows, leaves).collect()
    want = model.transform(ids).select("doc_id", "prediction", ml.vector_to_array("probability").alias("probability")).collect()
    order = lambda r: (str(r[0]), r[1], [round(p, 9) for p in r[2]])
    assert sorted(map(order, got)) == sorted(map(order, want))
    root = ml.feature_pipeline(maxDepth=0).fit(train)
    alone = ml.fitted_leaves(root.stages[-1], ml.PipelineModel(root.stages[:-1]).transform(train))
    assert len(alone) == 1 and ml.score_by_paths(rows, alone).count() == ids.count()


def test_fold_features_equal_fitted_stages(spark):
    train, _ = ml.train_test(spark, SF_SMALL)
    with_fold = train.withColumn("_lf_fold", ml.fold_of())
    stages = ml.fold_features(ml.fold_statistics(with_fold))
    for k in (0, 3):
        rest = with_fold.filter(F.col("_lf_fold") != k)
        fitted = ml.Pipeline(stages=ml.feature_pipeline().getStages()[:-1]).fit(rest)
        assert stages[k].rows == rest.count()
        rows = [sorted((r["label"], [round(v, 9) for v in r["features"].toArray()]) for r in df.collect())
                for df in (fitted.transform(with_fold).select("label", "features"), stages[k].transform(with_fold))]
        assert rows[0] == rows[1]


def test_pipeline_classes_and_null_slot(spark):
    rows = [(str(i), float(i) if i % 3 else None, float(i % 5), "en" if i % 4 else None,
             f"s{i % 3}", i % 2, 1 if i % 5 else 0) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id string, n_chars double, n_words double, lang string, "
                                     "source string, toxic int, quality int")
    model = ml.feature_pipeline().fit(df)
    out = model.transform(df)
    assert len(out.first().probability) == 3            # keep adds a third, empty class
    names = ml.feature_names(model, df)
    assert names[:2] == ["n_chars_filled", "n_words_filled"]
    null_row = out.filter("lang IS NULL").select("lang_is").first()[0]
    assert null_row.numNonzeros() == 0                  # NULL lang encodes as all zeros


def _numbered_rows(spark, n):
    return spark.range(n).select(
        F.col("id").cast("string").alias("doc_id"), (F.pmod(F.xxhash64("id"), F.lit(5000))).cast("double").alias("n_chars"),
        F.when(F.col("id") % 7 > 0, F.floor(F.pmod(F.xxhash64("id"), F.lit(5000)) / 40).cast("double")).alias("n_words"),
        F.lit("en").alias("lang"), F.when(F.col("id") % 2 == 0, "web").otherwise("book").alias("source"), F.lit(0).alias("toxic"),
        (F.pmod(F.xxhash64("id"), F.lit(5000)) * (F.col("id") % 5) % 700 < 300).cast("int").alias("quality"))


def test_search_fits_cells_instead_of_rows(spark, monkeypatch):
    """Every tree but the refitted one sees counted cells, one fit per fold and leaf size, with the accuracy of fits on the rows."""
    df = _numbered_rows(spark, 6000).cache()
    seen, fit = [], ml.DecisionTreeClassifier._fit
    monkeypatch.setattr(ml.DecisionTreeClassifier, "_fit", lambda self, rows: (seen.append(rows.count()), fit(self, rows))[1])
    space = [{"maxDepth": d, "leaf_fraction": f, "split_fraction": s}
             for d, f, s in ((3, 1e-6, 1e-6), (9, 1e-6, 1e-6), (9, 1e-6, 0.02), (9, 0.01, 1e-6), (5, 0.6, 1e-6))]
    _, _, trials = ml.search(df, folds=2, parallelism=4, space=space)
    assert len(seen) == 2 * 3 + 1 and max(seen[:-1]) < 1000 < 6000 == seen[-1]
    monkeypatch.undo()
    with_fold = df.withColumn("_lf_fold", ml.fold_of(2))
    for got, trial in zip(trials.orderBy("trial").collect(), space):
        want = 0.0
        for k, f in enumerate(ml.fold_features(ml.fold_statistics(with_fold, 2), 2)):
            train, valid = f.transform(with_fold.filter(F.col("_lf_fold") != k)), f.transform(with_fold.filter(F.col("_lf_fold") == k))
            tree = ml.DecisionTreeClassifier(labelCol="label", featuresCol="features", **{**ml.TREE_PARAMS, **ml.tree_settings(trial, f.rows)}).fit(train)
            ends = ml.prune(ml.fitted_leaves(tree, train), ml.split_rows(trial, f.rows))
            found = ml.leaf_counts(tree, valid)
            want += sum(c for (leaf, label), c in found.items() if ends[leaf].prediction == label) / sum(found.values()) / 2
        assert abs(got["cv_accuracy"] - want) < 1e-12


def test_candidate_splits_are_the_trees_thresholds(spark):
    few = spark.createDataFrame([(float(x),) for x in (1, 2, 2, 4, 1000)], "x double")
    assert ml.candidate_splits(few, "x") == [1.5, 3.0, 502.0]
    assert ml.candidate_splits(few.filter("x = 2"), "x") == []
    uneven = spark.createDataFrame([(10.0 ** k,) for k in range(32) for _ in range(2)], "x double")
    assert len(ml.candidate_splits(uneven, "x")) == 31


def test_cells_of_one_kind_make_one_leaf(spark):
    df = _numbered_rows(spark, 40).withColumns({"n_chars": F.lit(3.0), "n_words": F.lit(1.0), "source": F.lit("web"), "quality": F.lit(1)})
    leaves, _, trials = ml.search(df, trials=3, folds=2, parallelism=2)
    assert [x.counts[0] for x in leaves] == [40] and {r["cv_accuracy"] for r in trials.collect()} == {1.0}


def test_shorten_ends_leaves_at_a_depth():
    leaves = [ml.Leaf(((0, False, 1.0), (1, False, 2.0)), (5, 1)), ml.Leaf(((0, False, 1.0), (1, True, 2.0)), (0, 4)), ml.Leaf(((0, True, 1.0),), (20, 0))]
    assert ml.shorten(leaves, 2) == leaves
    assert ml.shorten(leaves, 1) == [ml.Leaf(((0, False, 1.0),), (5, 5))] * 2 + leaves[2:]
    assert set(ml.shorten(leaves, 0)) == {ml.Leaf((), (25, 5))}


def test_rows_with_equal_places_are_scored_once(spark, monkeypatch):
    """The range join sees one row per distinct list of thresholds; every row, also with a repeated id, gets its result."""
    stored, cut = [], ml.cut_lineage
    monkeypatch.setattr(ml, "cut_lineage", lambda df: (out := cut(df), stored.append(out.count()))[0])
    leaves = [ml.Leaf(((0, False, 10.0),), (5, 1)), ml.Leaf(((0, True, 10.0), (1, False, 0.5)), (0, 4)), ml.Leaf(((0, True, 10.0), (1, True, 0.5)), (3, 0))]
    rows = ml.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.range(2000).selectExpr("id % 500 AS doc_id", "CAST(id % 21 AS DOUBLE) AS a", "CAST(id % 2 AS DOUBLE) AS b"))
    got = ml.score_by_paths(rows, leaves)
    assert stored == [2000, 4]
    want = [(d, p) for d, p in ((i % 500, 0.0 if i % 21 <= 10 else 1.0 if i % 2 == 0 else 0.0) for i in range(2000))]
    assert sorted((r["doc_id"], r["prediction"]) for r in got.collect()) == sorted(want)
