"""Everything a scorer needs, saved as a version below one root and restored from there."""

from __future__ import annotations

from pyspark.ml.feature import StandardScalerModel
from pyspark.sql import DataFrame, SparkSession

from sparkvigil.operators.features import Preprocessing
from sparkvigil.operators.models import CONFIG_SCHEMA, FOLDERS, assembler, load_model
from sparkvigil.operators.scoring import Scorer
from sparkvigil.sources.commits import Versions

OPTIONS_SCHEMA = "convention string, apply_cap boolean"


def save_artifacts(
    root: str, scorer: Scorer, config: DataFrame, registry: DataFrame, categories: DataFrame, best: str
) -> int:
    """Models, assembler, scaler, fitted constants, category and customer tables, and the scorer's
    options, as the next version below ``root``; returns its number.

    All parts are written to a folder of their own; then one commit makes them the newest version.
    Until then, and if a write breaks off, the version before it is what is loaded. Older versions
    stay until ``Versions.keep`` removes them, so a scorer loaded from a root can be saved to it.
    """
    spark = config.sparkSession
    versions = Versions(spark, root)
    folder = versions.new_folder()
    for name, model in scorer.models.items():
        model.save(f"{folder}/models/{FOLDERS[name]}")
    scorer.models[best].save(f"{folder}/best_model")
    assembler().save(f"{folder}/assembler")
    scorer.scaler.save(f"{folder}/scaler")
    options = spark.createDataFrame([(scorer.convention, scorer.apply_cap)], OPTIONS_SCHEMA)
    for name, frame in [
        ("preprocessing_config", config),
        ("model_info", registry),
        ("merchant_categories", categories),
        ("scoring_options", options),
    ]:
        frame.write.json(f"{folder}/{name}")
    scorer.state.merchant_stats.write.parquet(f"{folder}/merchant_stats")
    if scorer.profile is not None:
        scorer.profile.write.parquet(f"{folder}/customer_profile")
    return versions.publish(
        folder, models=list(scorer.models), best=best, customer_profile=scorer.profile is not None
    )


def saved_version(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """The commit of a version, the newest by default: its folder, and which parts it has."""
    found = Versions(spark, root).content(version)
    if found is None:
        raise FileNotFoundError(f"no saved version below {root}")
    return found


def load_artifacts(
    spark: SparkSession, root: str, names: list[str] | None = None, version: int | None = None
) -> Scorer:
    """The scorer that was saved, or one with some of its models; those not saved are left out."""
    saved = saved_version(spark, root, version)
    folder = saved["folder"]
    config = spark.read.schema(CONFIG_SCHEMA).json(f"{folder}/preprocessing_config").first()
    options = spark.read.schema(OPTIONS_SCHEMA).json(f"{folder}/scoring_options").first()
    return Scorer(
        {n: load_model(spark, f"{folder}/models/{FOLDERS[n]}") for n in (names or saved["models"]) if n in saved["models"]},
        StandardScalerModel.load(f"{folder}/scaler"),
        Preprocessing(
            list(config["percentiles"]),
            config["lower_bound"],
            config["upper_bound"],
            spark.read.parquet(f"{folder}/merchant_stats"),
        ),
        spark.read.parquet(f"{folder}/customer_profile") if saved["customer_profile"] else None,
        options["convention"],
        options["apply_cap"],
    )


def best_model(spark: SparkSession, root: str, version: int | None = None):
    return load_model(spark, f"{saved_version(spark, root, version)['folder']}/best_model")


def model_info(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The registry row: best names, metrics, features, weights, date."""
    return spark.read.json(f"{saved_version(spark, root, version)['folder']}/model_info")


def saved_categories(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    folder = saved_version(spark, root, version)["folder"]
    return spark.read.schema("merchant_category string").json(f"{folder}/merchant_categories")
