"""Clipping, plain imputation and ordinal codes, each learned from training rows only."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tierwise.functions.lineage import checkpointed
from tierwise.functions.quantiles import as_double, exact_quantiles
from tierwise.functions.sizes import is_small


class _Columns(HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Shared by steps that work on columns in place."""


class _Fitted(Model, _Columns):
    """A fitted step whose learned values are a small JSON document."""

    learned = Param(Params._dummy(), "learned", "learned values", TypeConverters.toString)

    def __init__(self, inputCols: Sequence[str] | None = None, learned: dict | None = None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=list(inputCols), learned=json.dumps(learned))

    @property
    def values(self) -> dict:
        return json.loads(self.getOrDefault(self.learned))


def require_numeric(df: DataFrame, columns: Sequence[str]) -> None:
    kinds = {f.name: f.dataType for f in df.schema}
    bad = [c for c in columns if not isinstance(kinds.get(c), (T.NumericType, T.BooleanType))]
    if bad:
        raise ValueError(f"columns are not numeric: {bad}")


def clip(value: Column, low: float | None, high: float | None) -> Column:
    """Clamp to [low, high]; a missing value stays missing."""
    if low is None or high is None:
        return value
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


class QuantileClipper(Estimator, _Columns):
    lower = Param(Params._dummy(), "lower", "lower quantile", TypeConverters.toFloat)
    upper = Param(Params._dummy(), "upper", "upper quantile", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, lower=0.01, upper=0.99):
        super().__init__()
        self._setDefault(lower=0.01, upper=0.99)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "QuantileClipperModel":
        columns = self.getInputCols()
        require_numeric(df, columns)
        probs = [self.getOrDefault(self.lower), self.getOrDefault(self.upper)]
        return QuantileClipperModel(columns, exact_quantiles(df, columns, probs))


class QuantileClipperModel(_Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        require_numeric(df, self.getInputCols())
        return df.withColumns({c: clip(as_double(c), *b) for c, b in self.values.items()})


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    medians = exact_quantiles(df, columns, [0.5])
    return df.withColumns(
        {c: F.coalesce(as_double(c), F.lit(m[0]).cast("double")) for c, m in medians.items()}
    )


def modes(df: DataFrame, columns: Sequence[str]) -> dict:
    """Most frequent present value per column, the smallest among equals."""
    if not columns:
        return {}
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    )
    best = (
        df.select(F.explode(cells).alias("c"))
        .where("c.value is not null")
        .groupBy("c.column", "c.value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("column")
        .agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    )
    found = {r["column"]: r["mode"] for r in best.collect()}
    return {c: found.get(c) for c in columns}


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(f"`{c}`"), F.lit(m)) for c, m in modes(df, columns).items()}
    )


class Dictionary:
    """Codes 0..n-1 of the sorted categories of each column: a table ``column, value, code``.

    The table stays in Spark whatever its size; it is broadcast only when measured small.
    """

    def __init__(self, table: DataFrame, sizes: dict[str, int], small: bool):
        self.table, self.sizes, self.small = table, sizes, small

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> "Dictionary":
        """Present values of every column, found in one pass and ranked without one large sort."""
        cells = F.array(
            *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
        ).cast("array<struct<column:string,value:string>>")
        found = df.select(F.explode(cells).alias("c")).where("c.value is not null").select("c.column", "c.value")
        # Range partitions follow one another, so a rank is a place in one plus the counts before it.
        parts = checkpointed(
            found.distinct().repartitionByRange("column", "value").withColumn("_part", F.spark_partition_id())
        )
        counts = parts.groupBy("column", "_part").agg(F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy("column").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select("column", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
        within = Window.partitionBy("_part", "column").orderBy("value")
        # At most one row per column and partition is broadcast.
        table = checkpointed(
            parts.join(F.broadcast(offsets), ["column", "_part"]).select(
                "column", "value", (F.row_number().over(within) - 1 + F.col("_before")).cast("double").alias("code")
            )
        )
        sizes = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
        return cls(table, {c: sizes.get(c, 0) for c in columns}, is_small(table))

    def _of(self, column: str, i: int) -> DataFrame:
        part = self.table.where(F.col("column") == F.lit(column))
        part = part.select(F.col("value").alias(f"_label_{i}"), F.col("code").alias(f"_place_{i}"))
        return F.broadcast(part) if self.small else part

    def encode(self, df: DataFrame, columns: dict[str, str], unknown: float | None = -1.0) -> DataFrame:
        """Set column ``out`` to the code of column ``c`` for every ``out: c``.

        An unseen value gives ``unknown``; a missing one stays missing.
        """
        made = {}
        for i, (out, c) in enumerate(columns.items()):
            text = F.col(f"`{c}`").cast("string")
            if self.sizes[c]:
                df = df.join(self._of(c, i), text == F.col(f"_label_{i}"), "left")
                code = F.coalesce(F.col(f"_place_{i}"), F.lit(unknown).cast("double"))
            else:
                code = F.lit(unknown).cast("double")
            made[out] = F.when(text.isNotNull(), code)
        return df.withColumns(made).drop(*[f"_{n}_{i}" for n in ("label", "place") for i in range(len(columns))])

    def decode(self, df: DataFrame, columns: dict[str, tuple[Column, str]]) -> DataFrame:
        """Set column ``out`` to the category of ``c`` at a fractional code for every ``out: (code, c)``.

        Codes are rounded half to even and held inside the known range; a column without
        categories gives nulls.
        """
        made = {}
        for i, (out, (code, c)) in enumerate(columns.items()):
            made[out] = F.lit(None).cast("string")
            if self.sizes[c]:
                at = F.least(F.greatest(F.rint(code), F.lit(0.0)), F.lit(float(self.sizes[c] - 1)))
                df = df.join(self._of(c, i), at == F.col(f"_place_{i}"), "left")
                made[out] = F.col(f"_label_{i}")
        return df.withColumns(made).drop(*[f"_{n}_{i}" for n in ("label", "place") for i in range(len(columns))])

    def places(self, values: dict[str, str | None]) -> dict[str, float]:
        """Codes of one value per column, 0 where it is missing."""
        asked = self.table.sparkSession.createDataFrame(list(values.items()), "column string, value string")
        found = self.table.join(F.broadcast(asked), ["column", "value"]).collect()  # one row per column
        return {c: 0.0 for c in values} | {r["column"]: r["code"] for r in found}

    def save(self, path: str) -> dict:
        """Write the table; the returned facts and the path are all that ``load`` needs."""
        self.table.write.parquet(path)
        return {"sizes": self.sizes, "small": self.small}

    @classmethod
    def load(cls, spark: SparkSession, path: str, facts: dict) -> "Dictionary":
        return cls(spark.read.schema("column string, value string, code double").parquet(path), **facts)


class OrdinalEncoder(Estimator, _Columns):
    """Sorted categories become 0..n-1; categories unseen in training become -1."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "OrdinalEncoderModel":
        columns = self.getInputCols()
        return OrdinalEncoderModel(columns, Dictionary.fit(df, columns))


class OrdinalEncoderModel(Model, _Columns, MLReadable, MLWritable):
    def __init__(self, inputCols=None, dictionary: Dictionary | None = None):
        super().__init__()
        self.dictionary = dictionary
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.dictionary.encode(df, {c: c for c in self.getInputCols()}).select(*[f"`{c}`" for c in df.columns])

    def write(self) -> MLWriter:
        return _EncoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EncoderReader(cls)


class _EncoderWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        facts = self.instance.dictionary.save(f"{path}/dictionary")
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sc, {"dictionary": facts})


class _EncoderReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> OrdinalEncoderModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sc)
        model = self.cls(None, Dictionary.load(self.sparkSession, f"{path}/dictionary", meta["dictionary"]))
        DefaultParamsReader.getAndSetParams(model, meta)
        return model
