"""Where runs live: models, records, and the reports later runs are compared by."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

RECORD = (
    "run_id string, saved_at timestamp, threshold double, objective string, "
    "numeric array<string>, categorical array<string>, params string, tiers string, model_path string"
)


@dataclass
class RunRecord:
    run_id: str | None
    threshold: float
    objective: str
    numeric: list[str]
    categorical: list[str]
    params: dict
    tiers: list[dict]
    model_path: str


class RunStore:
    """Runs below one folder: ``records``, ``commits`` (the last is the latest run), ``models/<run>``
    and ``reports/<name>``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.root}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def save(
        self,
        run_id: str | None,
        model: PipelineModel,
        threshold: float,
        objective: str,
        numeric: list[str],
        categorical: list[str],
        params: dict,
        tiers: list[dict],
    ) -> RunRecord:
        """Store the model, append its record and commit it as the latest."""
        model_path = f"{self.root}/models/{run_id or 'unnamed'}"
        model.write().overwrite().save(model_path)
        row = [
            (run_id, float(threshold), objective, numeric, categorical, json.dumps(params), json.dumps(tiers), model_path)
        ]
        schema = RECORD.replace("saved_at timestamp, ", "")
        record = self.spark.createDataFrame(row, schema).withColumn("saved_at", F.current_timestamp())
        record.write.mode("append").parquet(f"{self.root}/records")
        if run_id is not None:
            self._point_at(run_id)
        return self._parse(record.first())

    def _point_at(self, run_id: str) -> None:
        """Append one commit, numbered after the greatest complete one.

        Nothing is replaced, so a reader always finds the last commit.  Writers that pass each
        other may give one number twice; the later in time, then by name, is the latest.
        """
        last = self._last_commit()
        number = 1 + (last["number"] if last is not None else 0)
        commit = self.spark.createDataFrame([(number, run_id)], "number long, run_id string")
        commit.withColumn("saved_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def _last_commit(self):
        commits = self._read("commits")
        if commits is None:
            return None
        return commits.agg(F.max(F.struct("number", "saved_at", "run_id")).alias("_c")).select("_c.*").where("number is not null").first()

    def add_report(self, name: str, report: DataFrame, run_id: str) -> None:
        """Add one run's part of a report; other runs' parts stay."""
        tagged = report.withColumn("run_id", F.lit(run_id))
        (
            tagged.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_id")
            .parquet(f"{self.root}/reports/{name}")
        )

    def report(self, name: str) -> DataFrame:
        found = self._read(f"reports/{name}")
        if found is None:
            raise FileNotFoundError(f"no report {name!r} under {self.root}")
        return found.withColumn("run_id", F.col("run_id").cast("string"))

    def resolve(self, run_id: str | None = None) -> RunRecord:
        """The named run; else the latest; else the unnamed one; else the only one."""
        records = self._read("records")
        if records is None:
            raise FileNotFoundError(f"no runs under {self.root}")
        newest = F.max_by(F.struct(*records.columns), "saved_at").alias("_r")
        if run_id is not None:
            named = records.where(F.col("run_id") == run_id).agg(newest).select("_r.*").first()
            if named is None or named["model_path"] is None:
                raise FileNotFoundError(f"run {run_id!r} not found under {self.root}")
            return self._parse(named)
        pointer = self._last_commit()
        if pointer is not None:
            latest = pointer["run_id"]
            hit = records.where(F.col("run_id") == latest).agg(newest).select("_r.*").first()
            if hit is not None and hit["model_path"] is not None:
                return self._parse(hit)
        unnamed = records.where(F.col("run_id").isNull()).agg(newest).select("_r.*").first()
        if unnamed is not None and unnamed["model_path"] is not None:
            return self._parse(unnamed)
        few = records.groupBy("run_id").agg(newest).select("_r.*").limit(2).collect()
        if len(few) == 1:
            return self._parse(few[0])
        raise FileNotFoundError("more than one run and no latest one; name the run")

    def load(self, record: RunRecord) -> PipelineModel:
        return PipelineModel.load(record.model_path)

    @staticmethod
    def _parse(row) -> RunRecord:
        return RunRecord(
            row["run_id"],
            row["threshold"],
            row["objective"],
            list(row["numeric"]),
            list(row["categorical"]),
            json.loads(row["params"]),
            json.loads(row["tiers"]),
            row["model_path"],
        )
