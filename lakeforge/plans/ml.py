"""Binary classification: features, training, tuning, scoring.

All stages are Spark ML estimators fitted by distributed aggregations (means,
category counts, tree statistics); nothing is collected to the driver except
fitted statistics.

A fitted tree is also kept as a table of paths: for each leaf the bounds of the
features on the way to it, and the training rows of each class that reach it.
Rows are scored by joining their feature values with the bounds.

The search takes the feature statistics of all folds in one pass over the data:
a fold's training rows are all rows but the fold's own, so are their sums and
counts (no leakage, G16).  A tree sees a number only by the bin it falls into, so
the rows of a fold are counted once per bins, categories and label, and its trees
are fitted on these weighted cells; their number does not grow with the rows.  A
tree is fitted once per fold and leaf size, as deep as a trial asks for: the depth
and how many rows a node needs to be split are applied to it afterwards, by
merging the leaves below the nodes that are too deep or too small.
"""

from __future__ import annotations

import math
import random
import re
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.feature import (Imputer, IndexToString, OneHotEncoder, StringIndexer, StringIndexerModel,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, folder_stamp
from ..sources.files import read_csv, write_csv
from ..sources.tables import read_table

# --- fixed values: the feature frame -------------------------------------------------------
ID_COL = "doc_id"
NUMERIC = ["n_chars", "n_words"]
CATEGORICAL = ["lang", "source", "toxic"]
LABEL = "quality"
HOLDOUT_MOD = 5
# Decision tree of the reference pipeline.
TREE_PARAMS = {"impurity": "entropy", "maxDepth": 3, "minInstancesPerNode": 10, "seed": 42}
# Search space: depth log-int 3..30 (30 is the deepest tree Spark fits), the
# fractions of rows that a split and a leaf need log-uniform 1e-6..1e-3; 100
# trials, 5 folds.
DEPTH_RANGE = (3, 30)
FRACTION_RANGE = (1e-6, 1e-3)
TRIALS, FOLDS = 100, 5


def raw_frame(spark: SparkSession, d: str) -> DataFrame:
    """Every document with the feature columns (NULLs planted for the imputer
    and the ``keep`` indexer); ``quality`` and ``toxic`` are NULL without a
    label."""
    # the word count is taken from the whole text *before* the join, so the
    # texts themselves never travel through the join's shuffle
    docs = read_table(spark, d, "documents", "doc_id", "text", "lang", "source", "n_chars") \
        .select("doc_id", "lang", "source", "n_chars",
                F.size(F.split(F.trim(F.col("text")), r"\s+")).alias("_lf_words"))
    labels = read_table(spark, d, "labels", "doc_id", "quality", "toxic")
    k = F.col("doc_id")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("n_chars")).alias("n_chars"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("_lf_words")).alias("n_words"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("lang")).alias("lang"),
        "source", "toxic", "quality")


def prepare(df: DataFrame, with_label: bool = True) -> DataFrame:
    """L1: id → string, numbers → double, flags and label → int."""
    cols = [F.col(ID_COL).cast("string").alias(ID_COL)]
    cols += [F.col(c).cast("double").alias(c) for c in NUMERIC]
    cols += [F.col(c).cast("string").alias(c) if c != "toxic" else F.col(c).cast("int").alias(c)
             for c in CATEGORICAL]
    if with_label:
        cols.append(F.col(LABEL).cast("int").alias(LABEL))
    return df.select(*cols)


def labelled(spark: SparkSession, d: str) -> DataFrame:
    return raw_frame(spark, d).filter(F.col(LABEL).isNotNull())


def train_test(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The labelled rows outside the hold-out, and all other documents."""
    raw = raw_frame(spark, d)
    train = F.col(LABEL).isNotNull() & (F.col(ID_COL) % HOLDOUT_MOD != 0)
    return prepare(raw.filter(train)), prepare(raw.filter(~train), with_label=False)


def feature_stages(numeric=NUMERIC, categorical=CATEGORICAL) -> list:
    """L2–L5 in one stage each: means for missing numbers, an index per
    category (NULL or unseen values get the last one), indicator vectors
    without the last index, and the vector of all features."""
    filled, places = [f"{c}_filled" for c in numeric], [f"{c}_place" for c in categorical]
    flags = [f"{c}_is" for c in categorical]
    return [Imputer(strategy="mean", inputCols=list(numeric), outputCols=filled),
            StringIndexer(handleInvalid="keep", inputCols=list(categorical), outputCols=places),
            OneHotEncoder(inputCols=places, outputCols=flags),
            VectorAssembler(inputCols=filled + flags, outputCol="features")]


def feature_pipeline(label: str = LABEL, **tree_params) -> Pipeline:
    """Features + label indexer (keep: 3 classes, G15) + decision tree."""
    params = {**TREE_PARAMS, **tree_params}
    stages = feature_stages()
    stages.append(StringIndexer(inputCol=label, outputCol="label").setHandleInvalid("keep"))
    stages.append(DecisionTreeClassifier(labelCol="label", featuresCol="features", **params))
    return Pipeline(stages=stages)


def feature_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """Names of the feature vector slots, read from the column metadata."""
    meta = model.transform(df.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    slots = [(a["idx"], a["name"]) for group in meta.values() for a in group]
    return [n for _, n in sorted(slots)]


def sample_space(trials: int = TRIALS, seed: int = 42) -> list[dict]:
    """Seeded log-uniform trials (depth log-int, fractions log-float)."""
    rng = random.Random(seed)

    def log_uniform(low, high):
        return math.exp(rng.uniform(math.log(low), math.log(high)))

    space = [{"maxDepth": round(log_uniform(*DEPTH_RANGE)), "leaf_fraction": log_uniform(*FRACTION_RANGE)} for _ in range(trials)]
    return [{**t, "split_fraction": log_uniform(*FRACTION_RANGE)} for t in space]


def tree_settings(trial: dict, rows: int) -> dict:
    """Spark's parameters for a trial on a training set of ``rows`` rows: a
    leaf fraction is a least number of rows."""
    return {"maxDepth": trial["maxDepth"], "minInstancesPerNode": max(1, math.ceil(trial["leaf_fraction"] * rows))}


def split_rows(trial: dict, rows: int) -> int:
    """How many rows a node must have to be split."""
    return max(2, math.ceil(trial["split_fraction"] * rows))


# --- fitted trees as tables ------------------------------------------------------------------
@dataclass(frozen=True)
class Leaf:
    """A leaf by the turns on the way to it: (feature, goes right, threshold)
    from the root, and the training rows of each class that reach it."""

    turns: tuple[tuple[int, bool, float], ...]
    counts: tuple[int, ...] = ()

    @property
    def prediction(self) -> float:
        """The class with most rows, the first of equals."""
        return float(self.counts.index(max(self.counts)))

    def bounds(self) -> dict[int, tuple[float, float]]:
        """(low, high] per feature on the way."""
        out: dict[int, tuple[float, float]] = {}
        for feature, right, t in self.turns:
            low, high = out.get(feature, (-math.inf, math.inf))
            out[feature] = (max(low, t), high) if right else (low, min(high, t))
        return out


_TURN = re.compile(r"( +)(If|Else) \(feature (\d+) (?:<=|>|in|not in) \{?([-+\w.]+)\}?\)")


def read_leaves(tree: DecisionTreeClassificationModel | DecisionTreeRegressionModel) -> list[Leaf]:
    """The leaves of a tree, left to right, from its printed form.  Indicator
    features (0 or 1) count as numbers with the threshold 0.5."""
    turns: list[tuple[int, bool, float]] = []
    leaves = []
    for line in tree.toDebugString.split("\n")[1:]:
        if m := _TURN.match(line):
            depth = len(m[1]) - 2
            turns = turns[:depth] + [(int(m[3]), m[2] == "Else", 0.5 if "{" in line else float(m[4]))]
        elif "Predict" in line:
            leaves.append(Leaf(tuple(turns[:len(line) - len(line.lstrip()) - 2])))
    return leaves


def leaf_counts(tree: DecisionTreeClassificationModel, rows: DataFrame) -> dict[tuple[int, int], int]:
    """Rows per (leaf, label): one aggregation, a row per leaf and class comes back."""
    found = tree.copy({tree.leafCol: "leaf"}).transform(rows).groupBy(F.col("leaf").cast("int"), F.col("label").cast("int")).count()
    return {(r[0], r[1]): r[2] for r in found.collect()}


def fitted_leaves(tree: DecisionTreeClassificationModel, train: DataFrame) -> list[Leaf]:
    """The leaves of a tree with the class counts of its training rows."""
    found = leaf_counts(tree, train)
    return [Leaf(leaf.turns, tuple(found.get((n, c), 0) for c in range(tree.numClasses))) for n, leaf in enumerate(read_leaves(tree))]


def prune(leaves: list[Leaf], least: int) -> list[Leaf]:
    """For each leaf, the leaf it becomes part of if nodes with fewer than
    ``least`` training rows are not split."""
    def total(group):
        return tuple(map(sum, zip(*(x.counts for x in group))))

    def merge(group, depth):
        if len(group) == 1:
            return list(group)
        if sum(total(group)) < least:
            return [Leaf(group[0].turns[:depth], total(group))] * len(group)
        cut = next(n for n, x in enumerate(group) if x.turns[depth][1])
        return merge(group[:cut], depth + 1) + merge(group[cut:], depth + 1)

    return merge(leaves, 0)


def shorten(leaves: list[Leaf], depth: int) -> list[Leaf]:
    """For each leaf, the leaf it becomes part of in a tree of at most ``depth``
    turns."""
    counts: dict = {}
    for x in leaves:
        counts.setdefault(x.turns[:depth], []).append(x.counts)
    ends = {turns: Leaf(turns, tuple(map(sum, zip(*below)))) for turns, below in counts.items()}
    return [ends[x.turns[:depth]] for x in leaves]


#: Bounds of a tree up to this number are broadcast; more are joined by shuffle.
SMALL_TREE = 10_000


def score_by_paths(rows: DataFrame, leaves: list[Leaf], id_col: str = ID_COL) -> DataFrame:
    """L11 as a range join: feature values meet the bounds of their feature, and
    the leaf whose bounds all hold gives prediction and probabilities.  ``rows``
    has ``id_col``, of any values, and ``features``.

    A tree tells values apart by its thresholds only: each value stands for the
    least threshold it does not exceed.  The rows are stored with these, the
    join is done once for each distinct list of them, and every row takes what
    was found for its list."""
    spark = rows.sparkSession
    shares = [[c / sum(x.counts) for c in x.counts] for x in leaves]
    if len(leaves) == 1:
        return rows.select(id_col, F.lit(leaves[0].prediction).alias("prediction"), F.array(*map(F.lit, shares[0])).alias("probability"))
    bounds = [(n, f, low, high) for n, x in enumerate(leaves) for f, (low, high) in x.bounds().items()]
    small = F.broadcast if len(bounds) <= SMALL_TREE else (lambda df: df)
    paths = spark.createDataFrame(bounds, "leaf int, feature int, low double, high double")
    ends = spark.createDataFrame([(n, len(x.bounds()), x.prediction, shares[n]) for n, x in enumerate(leaves)],
                                 "leaf int, n_bounds long, prediction double, probability array<double>")
    used = sorted({f for _, f, _, _ in bounds})
    values = F.array(*[_threshold_above(F.get("_lf_values", F.lit(f)), sorted({t for _, g, *ends in bounds if g == f for t in ends if math.isfinite(t)}))
                       for f in used])
    placed = cut_lineage(rows.select(id_col, vector_to_array("features").alias("_lf_values")).select(id_col, values.alias("_lf_cell")))
    cell_values = F.array(*[F.struct(F.lit(f).alias("feature"), F.get("_lf_cell", F.lit(i)).alias("value")) for i, f in enumerate(used)])
    hits = (placed.select("_lf_cell").distinct().select("_lf_cell", F.inline(cell_values))
            .join(small(paths), "feature").filter("value > low AND value <= high")
            .groupBy("_lf_cell", "leaf").agg(F.count(F.lit(1)).alias("n_hits")))
    found = cut_lineage(hits.join(small(ends), "leaf").filter("n_hits = n_bounds").select("_lf_cell", "prediction", "probability"))
    return placed.join(found, "_lf_cell").select(id_col, "prediction", "probability")


def _threshold_above(value: Column, thresholds: list[float]) -> Column:
    """The least of ``thresholds`` that is not below ``value``, else infinity;
    NULL and NaN stay."""
    out = F.when(value.isNull() | F.isnan(value), value)
    for t in thresholds:
        out = out.when(value <= t, F.lit(t))
    return out.otherwise(F.lit(math.inf))


# --- cross-validation ------------------------------------------------------------------------
def fold_of(folds: int = FOLDS):
    """Fold of a row: from the digits of its id's hash, so that it depends on
    nothing but the id."""
    return (F.conv(F.substring(F.md5(F.col(ID_COL).cast("string")), 1, 8), 16, 10).cast("long") % folds).cast("int")


def fold_statistics(with_fold: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(fold, column_name, value, n, total): what the feature stages of each
    fold are fitted from, in one pass.  For a number `value` is NULL, `n` and
    `total` its count and sum; for a category there is a row per value.  Rows
    are counted under their own fold, and a fold's training statistics are
    those of all folds less its own."""
    column = lambda name, value, number: F.struct(
        F.lit(name).alias("column_name"), value.cast("string").alias("value"), number.cast("double").alias("number"))
    cells = F.array(*[column(c, F.lit(None), F.col(c)) for c in NUMERIC], *[column(c, F.col(c), F.lit(0)) for c in [*CATEGORICAL, LABEL]])
    own = (with_fold.select("_lf_fold", F.inline(cells)).filter("number IS NOT NULL AND (value IS NOT NULL OR column_name IN ('%s'))" % "', '".join(NUMERIC))
           .groupBy("_lf_fold", "column_name", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("number").alias("total")))
    # The folds that a group of rows trains: one row per fold, column and value goes on.
    trains = own.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).filter("fold != _lf_fold")
    return trains.groupBy("fold", "column_name", "value").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


@dataclass(frozen=True)
class FoldFeatures:
    """The feature stages of one fold, built from its statistics."""

    rows: int
    means: dict[str, float]
    labels: dict[str, list[str]]

    def transform(self, df: DataFrame, *others: str) -> DataFrame:
        """(label, features) and ``others`` of rows; nothing is fitted on the data."""
        filled = [f"{c}_filled" for c in NUMERIC]
        df = df.withColumns({f: F.coalesce(F.col(c), F.lit(self.means[c])) for c, f in zip(NUMERIC, filled)})
        df = df.withColumns({c: F.col(c).cast("string") for c in [*CATEGORICAL, LABEL]})
        names = [*CATEGORICAL, LABEL]
        places = [*(f"{c}_place" for c in CATEGORICAL), "label"]
        for name, place in zip(names, places):
            df = StringIndexerModel.from_labels(self.labels[name], inputCol=name, outputCol=place, handleInvalid="keep").transform(df)
        flags = [f"{c}_is" for c in CATEGORICAL]
        encoded = OneHotEncoder(inputCols=places[:-1], outputCols=flags).fit(df).transform(df)  # sizes come from the index
        return VectorAssembler(inputCols=filled + flags, outputCol="features").transform(encoded).select("label", "features", *others)


def fold_features(statistics: DataFrame, folds: int = FOLDS) -> list[FoldFeatures]:
    """The stages of every fold; a row per fold, column and category is read."""
    by: dict = {k: {} for k in range(folds)}
    for r in statistics.collect():
        by[r["fold"]].setdefault(r["column_name"], []).append((r["value"], r["n"], r["total"]))
    out = []
    for k in range(folds):
        means = {c: (by[k][c][0][2] / by[k][c][0][1] if c in by[k] else 0.0) for c in NUMERIC}
        labels = {c: [v for v, n, _ in sorted(by[k].get(c, []), key=lambda x: (-x[1], x[0]))] for c in [*CATEGORICAL, LABEL]}
        out.append(FoldFeatures(sum(n for _, n, _ in by[k].get(LABEL, [])), means, labels))
    return out


#: The deepest tree that Spark fits.
DEEPEST = 30


def candidate_splits(rows: DataFrame, column: str) -> list[float]:
    """The thresholds that a tree fitted on ``rows`` may choose for a number:
    those of a regression tree of the number on itself, grown until every bin is
    a leaf."""
    found: set[float] = set()
    for label in (F.col(column), F.asinh(column)):
        frame = VectorAssembler(inputCols=[column], outputCol="features").transform(rows.select(column, label.alias("label")))
        tree = DecisionTreeRegressor(maxDepth=DEEPEST, minInstancesPerNode=1, seed=TREE_PARAMS["seed"]).fit(frame)
        found.update(t for leaf in read_leaves(tree) for _, _, t in leaf.turns)
        if tree.depth < DEEPEST:  # else the bins are so uneven that some are not apart yet
            break
    return sorted(found)


@dataclass(frozen=True)
class FoldCells:
    """The rows of a fold's training and held-out part, counted per bins,
    categories and label: (label, features, held, n).  The numbers among the
    features are those of their bins, from 0."""

    frame: DataFrame
    cells: int
    rows: int

    def leaves(self, least: int, depth: int) -> tuple[list[Leaf], dict[tuple[int, int], int]]:
        """The tree of the training part with ``least`` rows in each leaf: its
        leaves with their class counts, and the held-out rows per (leaf, label)."""
        params = {**TREE_PARAMS, "maxDepth": depth, "minInstancesPerNode": 1, "weightCol": "n",
                  # Cells up to the square of maxBins are all looked at for the bins, none is sampled away.
                  "maxBins": max(32, math.isqrt(self.cells) + 1)}
        if 2 * least > self.rows or self.cells == 1:  # no split leaves so many rows on both sides
            params["maxDepth"] = 0
        elif least > 1:
            params["minWeightFractionPerNode"] = (least - 0.5) / self.rows
        train = self.frame.filter("NOT held")
        if self.cells == 1:
            train = train.unionByName(train.withColumn("n", F.lit(0.0)))  # Spark wants two rows for an indicator
        tree = DecisionTreeClassifier(labelCol="label", featuresCol="features", **params).fit(train)
        # A row per part, leaf and class comes back.
        found = (tree.copy({tree.leafCol: "leaf"}).transform(self.frame.filter("held IS NOT NULL"))
                 .groupBy("held", F.col("leaf").cast("int"), F.col("label").cast("int")).agg(F.sum("n").cast("long")).collect())
        counts, seen = ({(r[1], r[2]): r[3] for r in found if r[0] == held} for held in (False, True))
        return [Leaf(x.turns, tuple(counts.get((n, c), 0) for c in range(tree.numClasses))) for n, x in enumerate(read_leaves(tree))], seen


def fold_cells(with_fold: DataFrame, k: int, features: FoldFeatures) -> FoldCells:
    """The cells of fold ``k``: a fit per number finds its bins, one pass counts the rows."""
    filled = with_fold.withColumns({c: F.coalesce(F.col(c), F.lit(features.means[c])) for c in NUMERIC})
    train = filled.filter(F.col("_lf_fold") != k)
    bins = {c: sum(((F.col(c) > t).cast("double") for t in candidate_splits(train, c)), F.lit(0.0)) for c in NUMERIC}
    counted = (filled.withColumns(bins).groupBy((F.col("_lf_fold") == k).alias("held"), *NUMERIC, *CATEGORICAL, LABEL)
               .agg(F.count(F.lit(1)).cast("double").alias("n")))
    frame = cut_lineage(features.transform(counted, "held", "n"))
    cells, rows = frame.filter("NOT held").agg(F.count(F.lit(1)), F.sum("n").cast("long")).first()
    return FoldCells(frame, cells, rows or 0)


def search(df: DataFrame, trials: int = TRIALS, folds: int = FOLDS, seed: int = 42,
           parallelism: int = 64, space: list[dict] | None = None):
    """Cross-validated accuracy of every trial, then the best trial
    refitted on all rows.  Returns (leaves of the best tree, its feature model,
    trials frame).

    One tree is fitted per fold and leaf size, ``parallelism`` jobs at a time, on
    the fold's cells; it answers for all trials that differ in depth or split
    fraction alone, from the counts of its leaves."""
    from concurrent.futures import ThreadPoolExecutor

    space = space or sample_space(trials, seed)
    with_fold = cut_lineage(df.withColumn("_lf_fold", fold_of(folds)))
    stages = fold_features(fold_statistics(with_fold, folds), folds)

    def settings(trial, k):
        s = tree_settings(trial, stages[k].rows)
        return s["minInstancesPerNode"], s["maxDepth"], split_rows(trial, stages[k].rows)

    def fit_eval(job):
        k, least = job
        wanted = {settings(t, k)[1:] for t in space if settings(t, k)[0] == least}
        leaves, seen = cells[k].leaves(least, max(depth for depth, _ in wanted))
        scores = {}
        for depth, n in wanted:
            short = shorten(leaves, depth)
            ends = list(dict.fromkeys(short))
            predicted = {x: y.prediction for x, y in zip(ends, prune(ends, n))}
            scores[k, least, depth, n] = sum(c for (leaf, label), c in seen.items() if predicted[short[leaf]] == label) / max(1, sum(seen.values()))
        return scores

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        cells = list(pool.map(lambda k: fold_cells(with_fold, k, stages[k]), range(folds)))
        score_of = {}
        for scores in pool.map(fit_eval, sorted({(k, settings(t, k)[0]) for k in range(folds) for t in space})):
            score_of.update(scores)
    means = [sum(score_of[k, *settings(t, k)] for k in range(folds)) / folds for t in space]
    best = max(range(len(space)), key=lambda i: (means[i], -i))
    n = with_fold.count()
    features = Pipeline(stages=[*feature_stages(), StringIndexer(inputCol=LABEL, outputCol="label").setHandleInvalid("keep")]).fit(with_fold)
    train = features.transform(with_fold).select("label", "features")
    tree = DecisionTreeClassifier(labelCol="label", featuresCol="features", **{**TREE_PARAMS, **tree_settings(space[best], n)}).fit(train)
    leaves = list(dict.fromkeys(prune(fitted_leaves(tree, train), split_rows(space[best], n))))
    rows = [(i, t["maxDepth"], float(t["leaf_fraction"]), float(t["split_fraction"]), float(m)) for i, (t, m) in enumerate(zip(space, means))]
    trials_df = df.sparkSession.createDataFrame(
        rows, "trial int, max_depth int, leaf_fraction double, split_fraction double, cv_accuracy double")
    return leaves, features, trials_df


def save_model(model: PipelineModel, root: str, name: str, version: int) -> str:
    """Versioned model path ``<root>/<name>/version=<n>``."""
    path = f"{root.rstrip('/')}/{name}/version={version}"
    model.write().overwrite().save(path)
    return path


def score(model_path: str, df: DataFrame, id_col: str = ID_COL) -> DataFrame:
    """Load a saved pipeline and score a table (distributed, no pandas)."""
    model = PipelineModel.load(model_path)
    return model.transform(df).select(id_col, "prediction", "probability")


def tree_rules(leaves: list[Leaf], names: list[str], weights: list[float], spark: SparkSession) -> DataFrame:
    """A row per leaf and feature on the way to it: the bounds (low, high],
    the training rows of each class, the prediction and the feature's importance."""
    rows = [(n, names[f], low if low > -math.inf else None, high if high < math.inf else None, list(x.counts), x.prediction, float(weights[f]))
            for n, x in enumerate(leaves) for f, (low, high) in sorted(x.bounds().items())]
    return spark.createDataFrame(rows, "leaf int, feature string, low double, high double, class_rows array<long>, prediction double, importance double")


# --- registered queries ----------------------------------------------------------------------
_MODELS: dict = {}


def _kept(spark: SparkSession, d: str, what: str, build):
    """A fitted result of this session and folder, built anew when the
    folder's files change."""
    key, stamp = (spark.sparkContext.applicationId, d, what), folder_stamp(spark, d)
    if key not in _MODELS or _MODELS[key][0] != stamp:
        _MODELS[key] = stamp, build()
    return _MODELS[key][1]


def _fitted(spark: SparkSession, d: str) -> tuple[PipelineModel, DataFrame]:
    train, _ = train_test(spark, d)
    return _kept(spark, d, "model", lambda: feature_pipeline().fit(train)), train


def _searched(spark: SparkSession, d: str):
    return _kept(spark, d, "search", lambda: search(train_test(spark, d)[0]))


def ml_prepare(spark, d):
    return prepare(labelled(spark, d))


def ml_mean_impute(spark, d):
    train, _ = train_test(spark, d)
    model = Pipeline(stages=feature_stages()[:1]).fit(train)
    out = model.transform(train)
    return out.select(ID_COL, *[F.round(f"{c}_filled", 6).alias(f"{c}_imputed") for c in NUMERIC])


def _indexed_values(model: PipelineModel, train: DataFrame, c: str) -> DataFrame:
    """(value, index, slot) of one categorical column, computed by running the
    fitted stages over its distinct values (no label list on the driver)."""
    values = train.select(c).distinct()
    filler = {n: F.lit(0.0) for n in NUMERIC}
    others = {o: F.lit(None).cast("string" if o != "toxic" else "int") for o in CATEGORICAL if o != c}
    frame = values.select(*[v.alias(k) for k, v in filler.items()], *[v.alias(k) for k, v in others.items()], c)
    out = PipelineModel(model.stages[:3]).transform(frame)
    arr = vector_to_array(F.col(f"{c}_is"))
    slot = F.array_position(arr, 1.0) - 1
    return out.select(
        F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"),
        F.col(f"{c}_place").cast("int").alias("category_index"),
        F.when(slot >= 0, slot).cast("int").alias("one_hot_slot"),
        F.size(arr).alias("one_hot_size"))


def _all_indexed(spark, d):
    model, train = _fitted(spark, d)
    out = None
    for c in CATEGORICAL:
        part = _indexed_values(model, train, c)
        out = part if out is None else out.unionByName(part)
    return out


def ml_category_index(spark, d):
    return _all_indexed(spark, d).select("column_name", "value", "category_index")


def ml_one_hot_slots(spark, d):
    return _all_indexed(spark, d).select("column_name", "value", "one_hot_slot", "one_hot_size")


def ml_assemble(spark, d):
    model, train = _fitted(spark, d)
    return model.transform(train).select(
        ID_COL, F.transform(vector_to_array("features"), lambda x: F.round(x, 6)).alias("features"))


def ml_tree_predict(spark, d):
    model, train = _fitted(spark, d)
    return model.transform(train).select(
        ID_COL, "label", "prediction", vector_to_array("probability").alias("probability"))


def ml_feature_names(spark, d):
    model, train = _fitted(spark, d)
    names = feature_names(model, train)
    return spark.createDataFrame(list(enumerate(names)), "position int, feature string")


def ml_tree_rules(spark, d):
    """The fitted tree as a table of paths."""
    model, train = _fitted(spark, d)
    tree = model.stages[-1]
    leaves = fitted_leaves(tree, PipelineModel(model.stages[:-1]).transform(train))
    out = tree_rules(leaves, feature_names(model, train), tree.featureImportances.toArray().tolist(), spark)
    return out.select("leaf", "feature", *[F.round(c, 6).alias(c) for c in ("low", "high")], "class_rows", "prediction",
                      F.round("importance", 9).alias("importance"))


def ml_cv_search(spark, d):
    return _searched(spark, d)[2]


def ml_fold_statistics(spark, d):
    """The means and category counts that each fold's features are built from."""
    train, _ = train_test(spark, d)
    found = fold_statistics(train.withColumn("_lf_fold", fold_of()))
    return found.select("fold", "column_name", "value", "n", F.when(F.col("column_name").isin(NUMERIC), F.round(F.col("total") / F.col("n"), 6)).alias("mean"))


def ml_fold_sizes(spark, d):
    """Rows and good documents per fold of the search."""
    train, _ = train_test(spark, d)
    return train.groupBy(fold_of().alias("fold")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(LABEL).cast("long").alias("n_good"))


def ml_best_scores(spark, d):
    """Every document outside the training rows, scored by the best trial
    refitted on all training rows."""
    leaves, features, _ = _searched(spark, d)
    test = train_test(spark, d)[1].withColumn(LABEL, F.lit(None).cast("int"))
    return score_by_paths(features.transform(test).select(ID_COL, "features"), leaves)


def ml_score_by_paths(spark, d):
    """L11 as a range join of feature values and the tree's paths: every
    document outside the training rows."""
    model, train = _fitted(spark, d)
    features = PipelineModel(model.stages[:-2])
    leaves = fitted_leaves(model.stages[-1], PipelineModel(model.stages[:-1]).transform(train))
    return score_by_paths(features.transform(train_test(spark, d)[1]).select(ID_COL, "features"), leaves)


def ml_score_saved_model(spark, d):
    from .run import new_root
    model, _ = _fitted(spark, d)
    path = save_model(model, new_root(spark, "models"), "doc_quality", 1)
    _, test = train_test(spark, d)
    return score(path, test).select(ID_COL, "prediction",
                                    vector_to_array("probability").alias("probability"))


def ml_submission(spark, d):
    """Predictions keyed by the id column, decoded to the label value."""
    model, _ = _fitted(spark, d)
    _, test = train_test(spark, d)
    labels = model.stages[-2].labels
    decode = IndexToString(inputCol="prediction", outputCol="predicted_quality", labels=labels)
    return decode.transform(model.transform(test)).select(ID_COL, "predicted_quality")


def ml_submission_csv(spark, d):
    """The submission written as CSV and read back with inferred types."""
    from .run import new_root
    path = new_root(spark, "csv") + "/submission_csv"
    write_csv(ml_submission(spark, d), path)
    return read_csv(spark, path)


QUERIES = {
    "ml_submission_csv": ml_submission_csv,
    "ml_prepare": ml_prepare,
    "ml_mean_impute": ml_mean_impute,
    "ml_category_index": ml_category_index,
    "ml_one_hot_slots": ml_one_hot_slots,
    "ml_assemble": ml_assemble,
    "ml_tree_predict": ml_tree_predict,
    "ml_feature_names": ml_feature_names,
    "ml_tree_rules": ml_tree_rules,
    "ml_cv_search": ml_cv_search,
    "ml_fold_sizes": ml_fold_sizes,
    "ml_fold_statistics": ml_fold_statistics,
    "ml_score_by_paths": ml_score_by_paths,
    "ml_best_scores": ml_best_scores,
    "ml_score_saved_model": ml_score_saved_model,
    "ml_submission": ml_submission,
}
