"""Tree models fitted to the rule scores."""

from __future__ import annotations

from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantline.functions.exprs import clip, risk_tier, round_half_even
from plantline.plans.marts import Tables
from plantline.risk import evaluation
from plantline.risk.features import MATERIAL_FEATURES, SUPPLIER_FEATURES, material_features, supplier_features
from plantline.risk.scoring import stockout_rule_score, supplier_rule_score
from plantline.session import cut_lineage
from plantline.sources.warehouse import current_path, publish_files

# Forest sizes, depths, learning rate and seed.
SEED = 42
BOOSTING = {"maxIter": 120, "stepSize": 0.08, "maxDepth": 4}
FOREST = {"numTrees": 100, "maxDepth": 5, "featureSubsetStrategy": "all"}
BINS = 128

SUPPLIER_MODEL, STOCKOUT_MODEL = "Supplier Risk Gradient Boosting", "Material Stockout Random Forest"


def _numeric(features: DataFrame, names: tuple[str, ...], label) -> DataFrame:
    columns = {f"x_{n}": F.col(n).cast("int" if n == "is_critical" else "double").cast("double") for n in names}
    return features.withColumns({**columns, "label": label})


def _fit(training: DataFrame, names: tuple[str, ...], learner) -> PipelineModel:
    assembler = VectorAssembler(inputCols=[f"x_{n}" for n in names], outputCol="x")
    return Pipeline(stages=[assembler, learner]).fit(training)


def supplier_rows(t: Tables) -> DataFrame:
    """Features with their rule score."""
    return _numeric(supplier_features(t), SUPPLIER_FEATURES, supplier_rule_score())


def material_rows(t: Tables) -> DataFrame:
    return _numeric(material_features(t), MATERIAL_FEATURES, stockout_rule_score())


def supplier_training(t: Tables) -> DataFrame:
    """Fixed in shared storage: training passes over the rows once per tree."""
    return cut_lineage(supplier_rows(t))


def material_training(t: Tables) -> DataFrame:
    return cut_lineage(material_rows(t))


def fit_supplier_model(training: DataFrame, **settings) -> PipelineModel:
    learner = GBTRegressor(
        featuresCol="x", labelCol="label", predictionCol="score", seed=SEED, maxBins=BINS,
        **{**BOOSTING, **settings},
    )
    return _fit(training, SUPPLIER_FEATURES, learner)


def fit_stockout_model(training: DataFrame, **settings) -> PipelineModel:
    learner = RandomForestRegressor(
        featuresCol="x", labelCol="label", predictionCol="score", seed=SEED, maxBins=BINS,
        **{**FOREST, **settings},
    )
    return _fit(training, MATERIAL_FEATURES, learner)


def store_model(model: PipelineModel, spark: SparkSession, root: str, name: str, version: str) -> str:
    """Publish a fitted model as a new version; returns the path of its files."""
    return publish_files(spark, root, name, version, lambda path: model.write().save(path))


def stored_model(spark: SparkSession, root: str, name: str, names: tuple[str, ...]) -> PipelineModel:
    """The model published last. It must have been fitted to the features ``names``, in this order."""
    model = PipelineModel.load(current_path(spark, root, name))
    fitted = [c.removeprefix("x_") for c in model.stages[0].getInputCols()]
    if fitted != list(names):
        raise ValueError(f"{name} below {root} was fitted to {fitted}, not to {list(names)}")
    return model


def score(model: PipelineModel, training: DataFrame) -> DataFrame:
    """The feature rows with the raw model ``score``."""
    scored = model.transform(training)
    return scored.drop("x", *[c for c in scored.columns if c.startswith("x_")])


def served(scored: DataFrame, key: str) -> DataFrame:
    """The score as it is shown, rounded and within bounds, beside the rule score, with its tier."""
    shown = round_half_even(clip(F.col("score"), 0.0, 100.0), 1)
    return scored.select(key, shown.alias("risk_score"), round_half_even(F.col("label"), 1).alias("rule_score")).select(
        "*", risk_tier(F.col("risk_score")).alias("risk_tier")
    )


def supplier_model_scores(t: Tables, as_of: date | None = None) -> DataFrame:
    training = supplier_training(t)
    return served(score(fit_supplier_model(training), training), "supplier_id")


def stockout_model_scores(t: Tables, as_of: date | None = None) -> DataFrame:
    training = material_training(t)
    return served(score(fit_stockout_model(training), training), "material_id")


def evaluation_report(t: Tables, as_of: date | None = None) -> DataFrame:
    """One row per model; predictions are not clipped here."""
    suppliers, materials = supplier_training(t), material_training(t)
    reports = [
        evaluation.report(score(fit_supplier_model(suppliers), suppliers), "label", "score", SUPPLIER_MODEL, True),
        evaluation.report(score(fit_stockout_model(materials), materials), "label", "score", STOCKOUT_MODEL, False),
    ]
    return reports[0].unionByName(reports[1])
