"""OP-80: the two-stage training job, and OP-04: its model bundle.

features -> chronological split -> stage 1 (boosted trees, asymmetric
boosting, ridge; voting on log scale) -> stage-2 features -> weighted boosted
classifier (or forest) -> isotonic calibration on validation -> per-boundary thresholds tuned on
validation -> test predictions and metrics.

Decisions (see README): stage 1 is fitted on the training part only by
default (``refit_on_val`` reproduces the reference's train+val fit);
calibration and thresholds use the validation part.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogcast.functions.categories import CATEGORY_NAMES
from smogcast.functions.scalars import exp_target, log_target
from smogcast.ml.boosting import BoostConfig, BoostedModel, fit_boosted
from smogcast.ml.isotonic import IsotonicCalibrator
from smogcast.ml.stage1 import ASYMMETRIC, DEPTHWISE, GBT, fit_ridge, voting_column
from smogcast.ml.stage2 import BOOSTED, STAGE2_EXTRA, add_stage2_features, fit_forest, padded_probs
from smogcast.operators import metrics, splits
from smogcast.operators import thresholds as th
from smogcast.operators import weights as wts
from smogcast.plans.features import FEATURES, LABEL
from smogcast.session import ensure_checkpoint_dir
from smogcast.session import materialize


MEMBERS = ("gbt", "asym", "ridge")


@dataclass
class TrainConfig:
    """Published sizes by default."""
    gbt: BoostConfig = GBT
    asym: BoostConfig = ASYMMETRIC
    gbt2: BoostConfig = DEPTHWISE
    ridge_alpha: float = 10.0
    classifier: str = "boosted"              # or "forest"
    boosted: BoostConfig = BOOSTED
    forest_trees: int = 30
    forest_depth: int = 6
    refit_on_val: bool = False
    seed: int = 42
    # variants of the reference's experiments
    members: tuple = MEMBERS                 # voting regressors of stage 1; "gbt2": a second one of squared loss
    split_kind: str = "chronological"        # or "stratified" (15 % of each class is test)
    weight_kind: str = "weight_scaled"       # balanced x base cost; or "weight_boosted"
    calibrate: bool = True                   # isotonic on validation (needs a val part)
    tune_on: str = "val"                     # part the thresholds are tuned on
    tune_boundaries: tuple = tuple(th.BOUNDARIES)
    tune_start: float = th.GRID_START
    tune_stop: float = th.GRID_STOP
    fixed_thresholds: tuple | None = None    # e.g. ((2, 3, 0.585),): no tuning


def stage2_probs(model, df: DataFrame) -> DataFrame:
    """Class probabilities (array of 6) from either stage-2 model kind."""
    if isinstance(model, BoostedModel):
        return df.withColumn("probs", model.probabilities())
    cur = model.transform(df).withColumn("probs", padded_probs("probability"))
    return cur.drop("features", "rawPrediction", "probability", "prediction")


@dataclass
class TwoStageModel:
    gbt: BoostedModel | None                 # stage-1 models that are not members are None
    ridge: PipelineModel | None
    asym: BoostedModel | None
    classifier: BoostedModel | PipelineModel | None
    calibrator: IsotonicCalibrator | None
    thresholds: list
    features: list = field(default_factory=lambda: list(FEATURES))
    gbt2: BoostedModel | None = None

    @property
    def members(self) -> list[str]:
        return [m for m in ("gbt", "asym", "ridge", "gbt2") if getattr(self, m) is not None]

    # ---- scoring -------------------------------------------------------------
    def predict_stage1(self, df: DataFrame) -> DataFrame:
        boosted = [m for m in self.members if m != "ridge"]
        cur = df.withColumns({f"pred_{m}": getattr(self, m).score() for m in boosted}) if boosted else df
        if self.ridge is not None:
            cur = self.ridge.transform(cur).drop("features")
        preds = [f"pred_{m}" for m in self.members]
        return cur.withColumn("Predicted_AQI", exp_target(voting_column([F.col(p) for p in preds]))).drop(*preds)

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds Predicted_AQI, alarms, probs, cal_probs and ``predicted``
        (category code after the boundary thresholds)."""
        cur = add_stage2_features(self.predict_stage1(df))
        cur = stage2_probs(self.classifier, cur)
        if self.calibrator is not None:
            cur = self.calibrator.transform(cur, "probs", "cal_probs")
        else:
            cur = cur.withColumn("cal_probs", F.col("probs"))
        return th.apply_thresholds(cur, "cal_probs", self.thresholds, "predicted")

    # ---- OP-04 bundle --------------------------------------------------------------
    def save(self, path: str, spark: SparkSession) -> None:
        for m in self.members:
            if m == "ridge":
                self.ridge.write().overwrite().save(f"{path}/stage1_ridge")
            else:
                getattr(self, m).save(f"{path}/stage1_{m}", spark)
        boosted = isinstance(self.classifier, BoostedModel)
        if boosted:
            self.classifier.save(f"{path}/stage2_boosted", spark)
        else:
            self.classifier.write().overwrite().save(f"{path}/stage2_forest")
        if self.calibrator is not None:
            self.calibrator.save(f"{path}/stage2_calibration", spark)
        spark.createDataFrame([(i, lo, hi, float(t)) for i, (lo, hi, t) in enumerate(self.thresholds)],
                              "ord int, low int, high int, t double").write.mode("overwrite").parquet(
            f"{path}/thresholds")
        meta = {"features": self.features, "members": self.members, "calibrated": self.calibrator is not None,
                "classifier": "boosted" if boosted else "forest"}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode(
            "overwrite").json(f"{path}/feature_columns")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> "TwoStageModel":
        thr = th.collect_thresholds(spark.read.parquet(f"{path}/thresholds"))
        meta = json.loads(spark.read.json(f"{path}/feature_columns").first()["meta"])
        cal = IsotonicCalibrator.load(f"{path}/stage2_calibration", spark) if meta["calibrated"] else None
        stage2 = BoostedModel.load(f"{path}/stage2_boosted", spark) if meta["classifier"] == "boosted" \
            else PipelineModel.load(f"{path}/stage2_forest")
        own = {m: PipelineModel.load(f"{path}/stage1_ridge") if m == "ridge" else BoostedModel.load(f"{path}/stage1_{m}", spark)
               for m in meta["members"]}
        return cls(own.get("gbt"), own.get("ridge"), own.get("asym"), stage2, cal, thr, meta["features"], own.get("gbt2"))


@dataclass
class TrainResult:
    model: TwoStageModel
    scored: DataFrame            # every row with split, predictions and probabilities
    regression: DataFrame        # OP-56 per split
    confusion: DataFrame         # OP-57 on test
    report: DataFrame            # OP-58 on test
    tuned: DataFrame             # OP-62 table


def train_two_stage(feat: DataFrame, cfg: TrainConfig = TrainConfig()) -> TrainResult:
    spark = feat.sparkSession
    ensure_checkpoint_dir(spark)
    # The feature table feeds a dozen fits: cut its lineage once (reliable
    # checkpoint in spark.checkpoint.dir, survives executor loss).
    if cfg.split_kind == "stratified":
        parts = splits.stratified_split(feat, LABEL, test_frac=0.15, seed=cfg.seed)
    else:
        parts = splits.chronological_split(feat)
    data = parts.withColumn("__ylog", log_target(F.col("AQI"))).transform(materialize)
    train = data.where(F.col("split") == "train")
    fit1 = data.where(F.col("split").isin("train", "val")) if cfg.refit_on_val else train

    # The members are independent: submit their jobs concurrently (the
    # scheduler interleaves their tasks, as CrossValidator's parallelism does).
    from concurrent.futures import ThreadPoolExecutor
    def boosted(c: BoostConfig):
        return lambda: fit_boosted(fit1, FEATURES, "__ylog", replace(c, seed=cfg.seed))
    fits = {"gbt": boosted(cfg.gbt), "gbt2": boosted(cfg.gbt2), "asym": boosted(cfg.asym),
            "ridge": lambda: fit_ridge(fit1, FEATURES, "__ylog", cfg.ridge_alpha)}
    with ThreadPoolExecutor(max_workers=3) as pool:
        own = {m: f.result() for m, f in [(m, pool.submit(fits[m])) for m in cfg.members]}
    stage1 = own.get("gbt"), own.get("ridge"), own.get("asym")
    partial = TwoStageModel(*stage1, None, None, [], list(FEATURES), own.get("gbt2"))
    s1 = add_stage2_features(partial.predict_stage1(data)).transform(materialize)

    s2_features = list(FEATURES) + STAGE2_EXTRA
    tr2 = s1.where(F.col("split") == "train")
    cw = wts.class_weights(tr2, LABEL)
    weighted = wts.attach_class_weight(tr2, LABEL, cw, which=cfg.weight_kind)
    if cfg.classifier == "boosted":
        classifier = fit_boosted(weighted, s2_features, LABEL, replace(cfg.boosted, seed=cfg.seed), "weight")
    else:
        classifier = fit_forest(weighted, s2_features, LABEL, "weight", cfg.forest_trees, cfg.forest_depth, cfg.seed)
    probs = stage2_probs(classifier, s1)
    if cfg.calibrate:
        probs = probs.transform(materialize)
        calibrator = IsotonicCalibrator.fit(probs.where(F.col("split") == "val"), "probs", LABEL)
        cal = calibrator.transform(probs, "probs", "cal_probs").transform(materialize)
    else:
        calibrator = None
        cal = probs.withColumn("cal_probs", F.col("probs")).transform(materialize)
    if cfg.fixed_thresholds is not None:
        thresholds = [tuple(t) for t in cfg.fixed_thresholds]
        tuned = spark.createDataFrame([(i, lo, hi, float(t), None, None) for i, (lo, hi, t) in enumerate(thresholds)],
                                      "ord int, low int, high int, t double, best_score double, n_at_boundary long")
    else:
        tuned = th.tune_thresholds(cal.where(F.col("split") == cfg.tune_on), "cal_probs", LABEL,
                                   boundaries=list(cfg.tune_boundaries), start=cfg.tune_start,
                                   stop=cfg.tune_stop)
        thresholds = th.collect_thresholds(tuned)
    scored = th.apply_thresholds(cal, "cal_probs", thresholds, "predicted")

    model = TwoStageModel(*stage1, classifier, calibrator, thresholds, list(FEATURES), own.get("gbt2"))
    test = scored.where(F.col("split") == "test")
    return TrainResult(
        model=model, scored=scored,
        regression=metrics.regression_metrics(scored, "AQI", "Predicted_AQI", ["split"]),
        confusion=metrics.confusion_matrix(test, LABEL, "predicted"),
        report=metrics.classification_report(test, LABEL, "predicted", CATEGORY_NAMES),
        tuned=tuned)
