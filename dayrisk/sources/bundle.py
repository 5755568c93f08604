"""The fitted product on shared storage: panel parameters, model, calibrator and margin."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from dayrisk.functions.scalars import decide
from dayrisk.operators.calibration import isotonic_predict
from dayrisk.operators.classifiers import AveragedLogit, Fitted, KernelFit, fitted, scorer_of
from dayrisk.operators.isotonic import IsotonicCurve
from dayrisk.operators.linear import LinearFit
from dayrisk.operators.trees import TreeEnsemble
from dayrisk.plans.panel import FittedPanel, PanelConfig


@dataclass
class Bundle:
    """Everything needed to turn unscaled daily features into a decision; ``config`` says how the features were built."""

    panel: FittedPanel
    model: Fitted
    calibrator: IsotonicCurve
    margin: float
    config: PanelConfig | None = None

    def score(self, daily: DataFrame, keep=("date",)) -> DataFrame:
        """Impute, scale, score, calibrate and decide in one projection: ``(keep..., p_raw, p, decision)``."""
        scaled = self.panel.transform(daily, keep)
        raw = self.model.score(scaled).select(*keep, F.col("p").alias("p_raw"))
        return isotonic_predict(raw, self.calibrator, "p_raw", "p").withColumn("decision", decide(F.col("p"), self.margin))

    def save(self, spark: SparkSession, path: str) -> None:
        """Parameters and curves as Parquet, the rest as JSON; any model of ``operators.classifiers``."""
        self.panel.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/params")
        self.calibrator.table.coalesce(1).write.mode("overwrite").parquet(f"{path}/calibrator")
        about = {"margin": self.margin, "model": self.model.name, "config": asdict(self.config) if self.config else None}
        model = self.model.model
        if isinstance(model, LinearFit):
            about["linear"] = asdict(model)
        elif isinstance(model, KernelFit):
            about["kernel"] = asdict(model)
        elif isinstance(model, AveragedLogit):
            about["members"] = [asdict(fit) for fit, _ in model.fits]
            for k, (_, curve) in enumerate(model.fits):
                curve.table.coalesce(1).write.mode("overwrite").parquet(f"{path}/curve-{k}")
        elif isinstance(model, TreeEnsemble):
            about["trees"] = {"features": model.features, "base": model.base}
            spark.createDataFrame(model.table()).coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
        else:
            assembler = VectorAssembler(inputCols=self.panel.features, outputCol="features")
            PipelineModel([assembler, model]).write().overwrite().save(f"{path}/model")
        text = spark.createDataFrame([(json.dumps(about),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Bundle:
        try:
            about = json.loads(spark.read.text(f"{path}/about").first()["value"])
        except AnalysisException as error:
            raise FileNotFoundError(f"no fitted bundle at {path}; fit and save one first") from error
        listed = lambda made: {k: tuple(v) if isinstance(v, list) else v for k, v in made.items()}
        config = PanelConfig(**listed(about["config"])) if about.get("config") else None
        panel = FittedPanel.from_frame(spark.read.parquet(f"{path}/params"))
        if "linear" in about:
            model = fitted(about["model"], LinearFit(**listed(about["linear"])))
        elif "kernel" in about:
            model = fitted(about["model"], KernelFit(**listed(about["kernel"])))
        elif "members" in about:
            curves = [IsotonicCurve(spark.read.parquet(f"{path}/curve-{k}")) for k in range(len(about["members"]))]
            model = fitted(about["model"], AveragedLogit(tuple((LinearFit(**listed(fit)), curve) for fit, curve in zip(about["members"], curves))))
        elif "trees" in about:
            model = fitted(about["model"], TreeEnsemble.of_table(spark.read.parquet(f"{path}/model").toPandas(), **about["trees"]))
        else:
            stages = PipelineModel.load(f"{path}/model").stages
            model = Fitted(about["model"], stages[-1], scorer_of(stages[-1], panel.features))
        return cls(panel, model, IsotonicCurve(spark.read.parquet(f"{path}/calibrator")), about["margin"], config)
