"""Models as Spark jobs: encoders, scaling, ridge per pair, boosted trees, scoring."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfcast.functions.metrics import mae, r2, rmse
from shelfcast.operators import boosting, linear
from shelfcast.operators.clean import fill_categories, fill_numbers
from shelfcast.session import new_table_path, written
from shelfcast.sources import schemas

# -- inputs ------------------------------------------------------------------


def model_input(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Numeric nulls to 0, category nulls to the unknown category."""
    return fill_categories(fill_numbers(df, [c for c in numeric if c in df.columns]), categorical)


def assemble(df: DataFrame, columns: list[str], output: str = "features_raw") -> DataFrame:
    """Feature vector; rows with an invalid value are skipped."""
    return VectorAssembler(inputCols=columns, outputCol=output, handleInvalid="skip").transform(df)


def standardize_by(df: DataFrame, keys: list[str], columns: list[str], fit_on: str | None = None) -> DataFrame:
    """Columns to mean 0 and sample deviation 1 within each group; 0 where a group has no spread.

    With ``fit_on`` (a boolean column) the statistics come from those rows only. Groups are pairs with one
    row per week, so a group is bounded by the calendar.
    """
    group = Window.partitionBy(*keys)

    def fitted(c: str):
        return F.when(F.col(fit_on), F.col(c)) if fit_on else F.col(c)

    def scaled(c: str):
        std = F.stddev_samp(fitted(c)).over(group)
        return F.when(std > 0, (F.col(c) - F.avg(fitted(c)).over(group)) / std).otherwise(F.lit(0.0))

    return df.withColumns({f"{c}_scaled": scaled(c) for c in columns})


def category_indexer(columns: list[str]) -> StringIndexer:
    """Index categories by frequency; unseen ones share one extra index."""
    return StringIndexer(inputCols=columns, outputCols=[f"{c}_idx" for c in columns], handleInvalid="keep")


def one_hot(train: DataFrame, columns: list[str]) -> PipelineModel:
    """Encoder fitted once on the training rows, so that later rows get the same positions."""
    encoder = OneHotEncoder(
        inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_hot" for c in columns], dropLast=False
    )
    return Pipeline(stages=[category_indexer(columns), encoder]).fit(train)


def hot_positions(indexer: StringIndexerModel, df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``keys, variable, position``: the one-hot columns that are 1, as rows; a category unseen in training has none.

    ``indexer`` is a fitted ``category_indexer``: its positions are those of the training rows. The rows do not grow with
    the number of categories.
    """
    known = {c: float(len(labels)) for c, labels in zip(columns, indexer.labelsArray)}
    hot = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"{c}_idx").alias("at")) for c in columns]))
    rows = indexer.transform(df).select(*keys, hot.alias("h"))
    n = F.element_at(F.create_map(*[F.lit(x) for pair in known.items() for x in pair]), F.col("h.variable"))
    return rows.where(F.col("h.at") < n).select(*keys, "h.variable", F.col("h.at").cast("int").alias("position"))


def mean_encoding(train: DataFrame, column: str, label: str) -> DataFrame:
    """Mean label per category: the order in which a regression tree would try the categories.

    For a category with too many values to be a tree category; it is a grouped aggregate and a join, so the
    number of categories is no concern.
    """
    return train.groupBy(column).agg(F.avg(label).alias(f"{column}_idx"))


#: Rows that the overall mean counts for in the mean of a category, and folds of the encoding.
ENCODING_PRIOR, ENCODING_FOLDS = 20.0, 5


def fold_of(keys: list[str], folds: int, seed: int = schemas.RANDOM_SPLIT_SEED) -> Column:
    """Repeatable fold of a row by its keys, whatever its partition."""
    key = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % folds).cast("int")


def out_of_fold_encoding(
    train: DataFrame,
    column: str,
    label: str,
    keys: list[str],
    folds: int = ENCODING_FOLDS,
    prior: float = ENCODING_PRIOR,
) -> tuple[DataFrame, DataFrame]:
    """``train`` with ``<column>_idx`` from the other folds' rows, and the encoding of new rows.

    A category's mean label counts ``prior`` rows of the overall mean besides its own, so small categories stay near it.
    A training row's encoding leaves out its whole fold, in the category and overall: no row's own label changes its own
    encoding. Rows that agree in ``keys`` share a fold. The sums have one row per category and fold; the fold is part
    of the join key, so a hot category is split. The encoding of new rows holds the overall mean under the null
    category, for values that the training rows lack. Null labels are not counted; a fold without others gets 0.
    """
    fold = F.col("_fold")
    known = train.withColumn("_fold", fold_of(keys, folds))
    sums = written(
        known.groupBy(column, "_fold").agg(F.sum(F.col(label).cast("double")).alias("s"), F.count(label).alias("n")),
        f"{column}_sums",
    )
    by_fold = sums.groupBy("_fold").agg(F.sum("s").alias("fold_s"), F.sum("n").alias("fold_n"))
    whole = sums.agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    all_s, all_n = (F.coalesce(whole.select(c).scalar(), F.lit(0)) for c in ("s", "n"))

    def smoothed(s: Column, n: Column, mean: Column) -> Column:
        return (F.coalesce(s, F.lit(0.0)) + prior * mean) / (F.coalesce(n, F.lit(0)) + prior)

    def others(total: Column, own: Column) -> Column:
        return total - F.coalesce(own, F.lit(0))

    rest_n = others(all_n, F.col("fold_n"))
    means = by_fold.select(
        "_fold", F.when(rest_n > 0, others(all_s, F.col("fold_s")) / rest_n).otherwise(0.0).alias("rest_mean")
    )
    totals = sums.groupBy(column).agg(F.sum("s").alias("cat_s"), F.sum("n").alias("cat_n"))
    # one row per fold
    per_fold = sums.join(totals.withColumnRenamed(column, "_cat"), F.col(column).eqNullSafe(F.col("_cat"))).join(
        F.broadcast(means), "_fold"
    )
    encoded = per_fold.select(
        F.col(column).alias("_cat"),
        fold.alias("_of"),
        smoothed(others(F.col("cat_s"), F.col("s")), others(F.col("cat_n"), F.col("n")), F.col("rest_mean")).alias(
            f"{column}_idx"
        ),
    )
    inside = known.join(encoded, (fold == F.col("_of")) & F.col(column).eqNullSafe(F.col("_cat"))).drop(
        "_fold", "_of", "_cat"
    )
    mean = F.when(all_n > 0, all_s / all_n).otherwise(0.0)
    new = totals.where(F.col(column).isNotNull()).select(
        column, smoothed(F.col("cat_s"), F.col("cat_n"), mean).alias(f"{column}_idx")
    )
    unseen = whole.select(F.lit(None).cast(train.schema[column].dataType).alias(column), mean.alias(f"{column}_idx"))
    return inside, written(new.unionByName(unseen), f"{column}_encoding")


# -- ridge regression per group ----------------------------------------------


def ridge_by(df: DataFrame, keys: list[str], columns: list[str], label: str, penalty: float) -> DataFrame:
    """Ridge coefficients of every group, from its moments; see ``operators/linear``."""
    return linear.fitted(df, keys, columns, label, penalty)


# -- boosted trees -----------------------------------------------------------

#: Every node of a tree holds statistics for each value of a tree category.
MOST_TREE_BINS = 100_000

#: Bins of a number. A tree category of more values gives every number as many bins, and finding them reads the square.
NUMBER_BINS = 256


@dataclass(frozen=True)
class TreeModel:
    """A fitted pipeline, with the tables of the categories that are mean-encoded."""

    pipeline: PipelineModel
    numeric: list[str]
    categorical: list[str]
    encodings: dict[str, DataFrame] = field(default_factory=dict)

    def prepare(self, rows: DataFrame) -> DataFrame:
        filled = model_input(rows, self.numeric, self.categorical)
        for column, table in self.encodings.items():
            unseen = table.where(F.col(column).isNull()).select(f"{column}_idx").scalar()
            filled = filled.join(table, column, "left").withColumn(
                f"{column}_idx", F.coalesce(f"{column}_idx", unseen, F.lit(0.0))
            )
        return filled

    def predict(self, rows: DataFrame) -> DataFrame:
        """Rows with ``predicted_sales``."""
        return self.pipeline.transform(self.prepare(rows))

    def gains(self) -> DataFrame:
        """(feature, gain) for every input: the squared error that its splits take off the training rows, in all.

        The ensemble is written and its table of nodes read: a split takes its gain off each of its node's rows. A
        feature without a split has 0.
        """
        names, spark = self.pipeline.stages[-2].getInputCols(), SparkSession.active()
        path = new_table_path(spark, "ensemble")
        self.pipeline.stages[-1].write().save(path)
        inner = spark.read.parquet(f"{path}/data").select("nodeData.*").where("leftChild >= 0")
        found = inner.groupBy(F.col("split.featureIndex").alias("place")).agg(
            F.sum(F.col("gain") * F.col("rawCount")).alias("gain")
        )
        every = spark.createDataFrame(list(enumerate(names)), "place int, feature string")  # one row per input column
        return every.join(F.broadcast(found), "place", "left").select(
            "feature", F.coalesce("gain", F.lit(0.0)).alias("gain")
        )

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        for column, table in self.encodings.items():
            table.write.mode("overwrite").parquet(f"{path}/encodings/{column}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, numeric: list[str], categorical: list[str]) -> TreeModel:
        pipeline = PipelineModel.load(f"{path}/pipeline")
        indexed = {c for stage in pipeline.stages[:-2] for c in stage.getInputCols()}
        encodings = {c: spark.read.parquet(f"{path}/encodings/{c}") for c in categorical if c not in indexed}
        return cls(pipeline, numeric, categorical, encodings)


def boosted_trees(
    train: DataFrame,
    validation: DataFrame,
    numeric: list[str],
    categorical: list[str],
    label: str,
    trees: int = 100,
    depth: int = 5,
    rate: float = 0.1,
    subsample: float = 1.0,
    seed: int = schemas.BOOSTING_SEED,
    mean_encoded: tuple[str, ...] = (),
    fold_keys: tuple[str, ...] = ("snapshot_date", *schemas.JOIN_KEYS),
    most_bins: int = MOST_TREE_BINS,
    patience: int = schemas.BOOSTING_PATIENCE,
) -> TreeModel:
    """Gradient boosted trees, cut behind the round with the lowest validation error.

    Boosting ends when ``patience`` rounds in a row bring no lower error, or with ``trees`` rounds. The error after
    every round comes with the residuals of the next, and no round is fitted twice (``operators/boosting``).

    The category columns in ``mean_encoded`` are replaced by the mean label of each value on the training rows,
    for a training row itself by that of the other folds (``out_of_fold_encoding``, folds by ``fold_keys``);
    the others are tree categories, numbered by the training rows, with one more number for values that only
    other rows have. The choice is the caller's: a tree category of more than ``most_bins`` values is an error.
    """
    wide = [c for c in categorical if c in mean_encoded]
    narrow = [c for c in categorical if c not in mean_encoded]
    known = model_input(train, numeric, categorical)
    sizes = known.agg(F.count("*"), *[F.count_distinct(c).alias(c) for c in narrow]).first()
    for c in narrow:
        if sizes[c] > most_bins:
            raise ValueError(f"{c} has {sizes[c]} values, more than {most_bins} tree bins: name it in mean_encoded")
    encodings, learnt = {}, known
    for c in wide:
        learnt, encodings[c] = out_of_fold_encoding(learnt, c, label, list(fold_keys))
    model = TreeModel(None, numeric, categorical, encodings)
    assembler = VectorAssembler(
        inputCols=[*numeric, *[f"{c}_idx" for c in categorical]], outputCol="features", handleInvalid="skip"
    )
    regressor = GBTRegressor(
        featuresCol="features",
        labelCol=label,
        predictionCol=schemas.PREDICTION,
        maxIter=trees,
        maxDepth=depth,
        stepSize=rate,
        subsamplingRate=subsample,
        # one bin per category, one for unseen ones
        maxBins=max(NUMBER_BINS, max([sizes[c] for c in narrow], default=0) + 1),
        seed=seed,
    )
    stages = [category_indexer(narrow).fit(known)] if narrow else []
    inputs = PipelineModel([*stages, assembler])
    vectors = written(inputs.transform(learnt).select("features", label), "training_vectors")
    judged = written(inputs.transform(model.prepare(validation)).select("features", label), "validation_vectors")
    ensemble = boosting.boosted(regressor, vectors, judged, lambda curve: best_round(curve, patience))
    return replace(model, pipeline=PipelineModel([*stages, assembler, ensemble]))


def best_round(curve: list[float], patience: int) -> tuple[int, bool]:
    """The number of rounds with the lowest error, up to the first ``patience`` rounds without a lower one.

    The second value tells whether there were that many rounds after it.
    """
    best = 0
    for k, error in enumerate(curve):
        if error < curve[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def first_rounds(ensemble: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model of the first rounds alone."""
    gateway, whole = SparkSession.active().sparkContext._gateway, ensemble._java_obj
    package = gateway.jvm.org.apache.spark.ml.regression
    trees = gateway.new_array(package.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for k, (tree, weight) in enumerate(zip(whole.trees()[:rounds], whole.treeWeights()[:rounds])):
        trees[k], weights[k] = tree, weight
    cut = GBTRegressionModel(package.GBTRegressionModel(whole.uid(), trees, weights, whole.numFeatures()))
    ensemble._copyValues(cut)._transfer_params_to_java()
    return cut


def prediction_rows(scored: DataFrame) -> DataFrame:
    return scored.select(*schemas.JOIN_KEYS, "snapshot_date", schemas.PREDICTION)


def top_features(gains: DataFrame, n: int = schemas.TOP_FEATURES) -> DataFrame:
    return gains.orderBy(F.desc("gain"), "feature").limit(n)


def regression_scores(scored: DataFrame, *keys: str, label: str = schemas.LABEL) -> DataFrame:
    return scored.groupBy(*keys).agg(
        rmse(label, schemas.PREDICTION).alias("rmse"),
        mae(label, schemas.PREDICTION).alias("mae"),
        r2(label, schemas.PREDICTION).alias("r2"),
        F.count("*").alias("n_rows"),
    )
