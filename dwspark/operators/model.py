"""Regression model on tables (L1–L8, K9) with ``pyspark.ml``.

The reference trains a scikit-learn decision tree on one machine. Here training, evaluation and
scoring are Spark jobs: one-hot encoding + vector assembly + ``DecisionTreeRegressor`` (depth 8, at
least 5 rows per leaf, as the reference). Spark's tree bins continuous features (``maxBins``), so its
metrics are close to, not equal to, scikit-learn's; :func:`train_exact` grows a tree with exact splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwspark.functions.clean import prepare_model_frame
from dwspark.operators import tree
from dwspark.operators.aggregate import regression_metrics
from dwspark.session import checkpoint_dir

# ---- fixed values that must equal the reference's --------------------------------------------
MAX_DEPTH = 8
MIN_ROWS_PER_LEAF = 5
TEST_PERCENT = 20
SEED = 42
MIN_TRAINING_ROWS = 5
# ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class TrainingResult:
    model: PipelineModel
    metrics: DataFrame       # one row: r2, rmse, mae, n (hold-out)
    predictions: DataFrame   # hold-out rows with actual and predicted values


# L1 = clean.prepare_model_frame


# L2 ----------------------------------------------------------------------------------------------
def in_test(key: str, test_percent: int = TEST_PERCENT, seed: int = SEED) -> Column:
    """Whether a row is on the test side: a hash of its key and the seed, nothing else (``randomSplit`` depends on
    partitioning and order)."""
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100 < test_percent


def hash_split(df: DataFrame, key: str, test_percent: int = TEST_PERCENT, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Deterministic train/test split by :func:`in_test`."""
    test = in_test(key, test_percent, seed)
    return df.where(~test), df.where(test)


# L7 ----------------------------------------------------------------------------------------------
def require_rows(df: DataFrame, minimum: int = MIN_TRAINING_ROWS) -> None:
    """Fail fast when there are fewer than ``minimum`` rows (reads at most ``minimum`` rows)."""
    if df.limit(minimum).count() < minimum:
        raise ValueError(f"need at least {minimum} rows to train a model")


# L3 / L4 -----------------------------------------------------------------------------------------
def build_pipeline(numeric: Sequence[str], categorical: Sequence[str], target: str, max_depth: int = MAX_DEPTH,
                   min_rows_per_leaf: int = MIN_ROWS_PER_LEAF, seed: int = SEED, max_bins: int = 64) -> Pipeline:
    """Index + one-hot encode categoricals (an unseen category is all zeros: the indexer keeps it as its
    last index, which the encoder drops), assemble with the numerics, and fit a decision tree."""
    idx = [f"{c}__idx" for c in categorical]
    ohe = [f"{c}__ohe" for c in categorical]
    stages = []
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=idx, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True))
    stages.append(VectorAssembler(inputCols=list(numeric) + ohe, outputCol="features", handleInvalid="skip"))
    stages.append(DecisionTreeRegressor(featuresCol="features", labelCol=target, predictionCol="predicted",
                                        maxDepth=max_depth, minInstancesPerNode=min_rows_per_leaf, seed=seed, maxBins=max_bins))
    return Pipeline(stages=stages)


# L5 / L6 -----------------------------------------------------------------------------------------
def train_and_evaluate(df: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str], target: str,
                       test_percent: int = TEST_PERCENT, seed: int = SEED, **tree) -> TrainingResult:
    """L1 prepare, L7 guard, L2 split, L3/L4 fit, L5 evaluate, L6 hold-out predictions."""
    data = prepare_model_frame(df, numeric, categorical, target, keep=[key])
    # Fitting the indexer, the encoder and the tree each scans the data: write the prepared rows
    # once to the shared checkpoint folder instead of recomputing their whole lineage per pass.
    checkpoint_dir(df.sparkSession)
    data = data.checkpoint(eager=True)
    require_rows(data)
    train, test = hash_split(data, key, test_percent, seed)
    model = build_pipeline(numeric, categorical, target, seed=seed, **tree).fit(train)
    scored = model.transform(test).select(key, *numeric, *categorical, F.col(target).alias("actual"), "predicted")
    return TrainingResult(model, regression_metrics(scored, "actual", "predicted"), scored)


def train_exact(df: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str], target: str,
                test_percent: int = TEST_PERCENT, seed: int = SEED, max_depth: int = MAX_DEPTH,
                min_rows_per_leaf: int = MIN_ROWS_PER_LEAF) -> tuple[tree.Tree, DataFrame]:
    """L1, L7, L2 and an exact-split tree (:mod:`tree`): the tree, and the hold-out rows with ``actual`` and ``predicted``.
    Training deletes its prepared rows; the predictions are a plain query over ``df``."""
    data = prepare_model_frame(df, numeric, categorical, target, keep=[key])
    train, test = hash_split(data, key, test_percent, seed)
    fitted = tree.fit(train, numeric, categorical, target, max_depth, min_rows_per_leaf)
    if not fitted.nodes or fitted.nodes[0][2] < MIN_TRAINING_ROWS:
        raise ValueError(f"need at least {MIN_TRAINING_ROWS} rows to train a model")
    return fitted, fitted.predict(test.withColumnRenamed(target, "actual"))


# L8 ----------------------------------------------------------------------------------------------
def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Batch scoring of new rows with a trained (or loaded) model."""
    return model.transform(df).select(*keep, "predicted")


# K9 ----------------------------------------------------------------------------------------------
def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_predictions(predictions: DataFrame, path: str, fmt: str = "parquet") -> None:
    predictions.write.mode("overwrite").format(fmt).option("header", True).save(path)
