"""Chained-equation imputation.

Numeric chain: every imputed value is a linear function of the observed values of its row,
with coefficients that depend only on which columns are missing.  The moments of each
missing pattern are therefore all that the fit needs: one pass over the table gathers
them, and the rounds of regressions run on a few small matrices.

Category chain: rows with the same codes always get the same imputation, so the fit runs
on the distinct code combinations with their counts as weights.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, functions as F

from tierwise.functions.lineage import checkpointed
from tierwise.functions.quantiles import as_double, exact_quantiles
from tierwise.functions.sizes import is_small
from tierwise.operators.cleaning import (
    Dictionary,
    _Columns,
    _Fitted,
    modes,
    require_numeric,
)

DRIVER_CELLS = 20_000_000  # pattern moments held on the driver: 160 MB at most


# ---------------------------------------------------------------- small regressions


def least_squares(gram: np.ndarray, cross: np.ndarray, _yy: float, _n: float, reg: float) -> np.ndarray:
    """Coefficients from centred moments, minimum norm when predictors are collinear."""
    return np.linalg.lstsq(gram + reg * np.eye(len(gram)), cross, rcond=None)[0]


def bayesian_ridge(gram: np.ndarray, cross: np.ndarray, yy: float, n: float, _reg: float) -> np.ndarray:
    """Ridge whose noise and weight precisions maximise the evidence (MacKay 1992)."""
    prior, tol, rounds = 1e-6, 1e-3, 300
    eig, vec = np.linalg.eigh(gram)
    eig = np.maximum(eig, 0.0)
    rotated = vec.T @ cross
    noise = 1.0 / max(yy / n, np.finfo(float).eps)
    weight = 1.0
    coef = np.zeros(len(gram))
    for i in range(rounds):
        old, coef = coef, vec @ (rotated / (eig + weight / noise))
        if i and np.abs(old - coef).sum() < tol:
            break
        error = max(yy - 2.0 * coef @ cross + coef @ gram @ coef, 0.0)
        effective = np.sum(noise * eig / (weight + noise * eig))
        weight = (effective + 2 * prior) / (coef @ coef + 2 * prior)
        noise = (n - effective + 2 * prior) / (error + 2 * prior)
    return coef


SOLVERS = {"bayesian": bayesian_ridge, "least_squares": least_squares}

Step = tuple[int, float, list[float]]  # column, intercept, one coefficient per column


def _fit_step(moments: np.ndarray, c: int, solver: str, reg: float) -> Step:
    """Regress column ``c`` on the others from the moment matrix of [1, x]."""
    p = len(moments) - 1
    n = moments[0, 0]
    others = [j for j in range(p) if j != c]
    beta = np.zeros(p)
    if n <= 0:
        return c, 0.0, beta.tolist()
    mean = moments[0, 1:] / n
    centred = moments[1:, 1:] - n * np.outer(mean, mean)
    if others:
        gram = centred[np.ix_(others, others)]
        beta[others] = SOLVERS[solver](gram, centred[others, c], max(centred[c, c], 0.0), n, reg)
    return c, float(mean[c] - beta @ mean), beta.tolist()


def _start_maps(present: np.ndarray) -> np.ndarray:
    """Per pattern the matrix from observed [1, x] to completed [1, x]; missing starts at 0."""
    g, p = present.shape
    maps = np.zeros((g, p + 1, p + 1))
    maps[:, 0, 0] = 1.0
    idx = np.arange(p)
    maps[:, idx + 1, idx + 1] = present
    return maps


def _apply_step(maps: np.ndarray, present: np.ndarray, step: Step) -> None:
    c, intercept, beta = step
    rows = ~present[:, c]
    if rows.any():
        weights = np.concatenate([[intercept], beta])
        maps[rows, c + 1, :] = np.einsum("i,gij->gj", weights, maps[rows])


def _completed(maps: np.ndarray, moments: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.einsum("gij,gjk,glk->il", maps[rows], moments[rows], maps[rows])


def _unpack(flat: np.ndarray, p: int) -> np.ndarray:
    """Symmetric matrices from their upper triangles."""
    upper = np.triu_indices(p + 1)
    out = np.zeros((len(flat), p + 1, p + 1))
    out[:, upper[0], upper[1]] = flat
    out[:, upper[1], upper[0]] = flat
    return out


class ChainedLinearImputer(Estimator, _Columns):
    """Numeric chained imputation: medians first, then rounds of regressions without draws.

    ``solver`` is ``bayesian`` or ``least_squares`` (with ridge term ``reg``).  Columns are
    visited by ascending number of missing values, and each gets a regression, so that a
    column complete in training can be imputed when scoring.  Rounds stop early once no
    row changes by ``tol`` times the largest observed value.
    """

    maxIter = Param(Params._dummy(), "maxIter", "rounds", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "relative change that ends the rounds", TypeConverters.toFloat)
    solver = Param(Params._dummy(), "solver", "regression", TypeConverters.toString)
    reg = Param(Params._dummy(), "reg", "ridge term of least_squares", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, maxIter=20, tol=1e-3, solver="bayesian", reg=0.0):
        super().__init__()
        self._setDefault(maxIter=20, tol=1e-3, solver="bayesian", reg=0.0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ChainedLinearImputerModel":
        columns = self.getInputCols()
        require_numeric(df, columns)
        solver = self.getOrDefault(self.solver)
        if solver not in SOLVERS:
            raise ValueError(f"unknown solver {solver!r}; use one of {sorted(SOLVERS)}")
        medians = exact_quantiles(df, columns, [0.5])
        start = [medians[c][0] if medians[c][0] is not None else 0.0 for c in columns]
        # Measured from the medians, which also keeps the moments well conditioned.
        rows = df.select(*[(as_double(c) - F.lit(s)).alias(f"x{i}") for i, (c, s) in enumerate(zip(columns, start))])
        table = _PatternTable(rows, len(columns))
        order = np.argsort(table.missing, kind="stable").tolist()
        steps = table.chain(order, self.getOrDefault(self.maxIter), solver, self.getOrDefault(self.reg))
        tol = self.getOrDefault(self.tol)
        if tol > 0 and table.missing.any() and steps:
            limit = tol * exact_abs_max(df, columns)
            steps = steps[: len(order) * _rounds_needed(rows, steps, len(order), limit)]
        learned = {"start": start, "steps": [list(s) for s in steps]}
        return ChainedLinearImputerModel(columns, learned)


def exact_abs_max(df: DataFrame, columns: Sequence[str]) -> float:
    tops = [F.coalesce(F.max(F.abs(as_double(c))), F.lit(0.0)) for c in columns]
    return float(df.agg(F.greatest(*tops, F.lit(0.0)).alias("m")).first()["m"])


class _PatternTable:
    """Moments of [1, x] per missing pattern, on the driver if small and in Spark if not."""

    def __init__(self, rows: DataFrame, p: int, driver_cells: int | None = None):
        self.p = p
        names = [f"x{i}" for i in range(p)]
        filled = [F.lit(1.0), *[F.coalesce(F.col(n), F.lit(0.0)) for n in names]]
        pattern = F.concat(*[F.when(F.col(n).isNull(), "0").otherwise("1") for n in names])
        upper = [F.sum(filled[i] * filled[j]) for i in range(p + 1) for j in range(i, p + 1)]
        table = rows.groupBy(pattern.alias("pattern")).agg(
            F.array(*upper).alias("moments"), F.count(F.lit(1)).alias("n")
        )
        limit = (driver_cells or DRIVER_CELLS) // len(upper)
        found = table.limit(limit + 1).collect()
        self.spread = None
        if len(found) > limit:
            self.spread = checkpointed(table)
            misses = [
                F.coalesce(F.sum(F.when(F.substring("pattern", i + 1, 1) == "0", F.col("n"))), F.lit(0))
                for i in range(p)
            ]
            self.missing = np.array(self.spread.agg(*misses).first(), dtype=float)
            return
        self.present = np.array([[ch == "1" for ch in r["pattern"]] for r in found], dtype=bool).reshape(-1, p)
        self.moments = _unpack(np.array([r["moments"] for r in found], dtype=float).reshape(len(found), -1), p)
        sizes = np.array([r["n"] for r in found], dtype=float)
        self.missing = (~self.present * sizes[:, None]).sum(axis=0)

    def chain(self, order: list[int], rounds: int, solver: str, reg: float) -> list[Step]:
        steps: list[Step] = []
        maps = None if self.spread is not None else _start_maps(self.present)
        for _ in range(rounds):
            for c in order:
                if maps is None:
                    moments = self._spread_moments(c, steps)
                else:
                    moments = _completed(maps, self.moments, self.present[:, c])
                steps.append(_fit_step(moments, c, solver, reg))
                if maps is not None:
                    _apply_step(maps, self.present, steps[-1])
        return steps

    def _spread_moments(self, c: int, steps: list[Step]) -> np.ndarray:
        p, done = self.p, list(steps)

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((p + 1, p + 1))
            for batch in batches:
                present = np.array([[ch == "1" for ch in s] for s in batch["pattern"]], dtype=bool).reshape(-1, p)
                maps = _start_maps(present)
                for step in done:
                    _apply_step(maps, present, step)
                moments = _unpack(np.stack(batch["moments"].to_numpy()), p)
                total += _completed(maps, moments, present[:, c])
            yield pd.DataFrame({"at": np.arange(total.size), "value": total.ravel()})

        sums = (
            self.spread.select("pattern", "moments")
            .mapInPandas(partial, "at int, value double")
            .groupBy("at")
            .agg(F.sum("value").alias("value"))
            .orderBy("at")
            .collect()
        )
        return np.array([r["value"] for r in sums]).reshape(p + 1, p + 1)


def _rounds_needed(rows: DataFrame, steps: list[Step], per_round: int, limit: float) -> int:
    """First round in which no row changes by ``limit``: one pass over the incomplete rows."""
    p = len(rows.columns)

    def changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.zeros(len(steps) // per_round)
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(p)])
            gap = np.isnan(x)
            x[gap] = 0.0
            for r in range(len(top)):
                before = x.copy()
                for c, intercept, beta in steps[r * per_round : (r + 1) * per_round]:
                    x[gap[:, c], c] = intercept + x[gap[:, c]] @ np.asarray(beta)
                if len(x):
                    top[r] = max(top[r], np.abs(x - before).sum(axis=1).max())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(top), dtype=np.int32)), pa.array(top)], names=["round", "change"]
        )

    complete = F.lit(True)
    for name in rows.columns:
        complete = complete & F.col(name).isNotNull()
    found = (
        rows.where(~complete)
        .mapInArrow(changes, "round int, change double")
        .groupBy("round")
        .agg(F.max("change").alias("change"))
        .orderBy("round")
        .collect()
    )
    for r in found:
        if r["change"] < limit:
            return r["round"] + 1
    return len(found)


class ChainedLinearImputerModel(_Fitted):
    """Replays the learned chain inside each row; only rows with a gap do any work."""

    def _transform(self, df: DataFrame) -> DataFrame:
        columns, learned = self.getInputCols(), self.values
        start = learned["start"]
        x = F.array(*[as_double(c) - F.lit(s) for c, s in zip(columns, start)])
        any_gap = F.lit(False)
        for c in columns:
            any_gap = any_gap | as_double(c).isNull()
        staged = df.withColumn("_x", x)
        filled = F.transform("_x", lambda v: F.coalesce(v, F.lit(0.0)))
        if learned["steps"]:
            steps = F.array(
                *[
                    F.struct(
                        F.lit(int(c)).alias("c"),
                        F.lit(float(b0)).alias("b0"),
                        F.array(*[F.lit(float(b)) for b in beta]).alias("b"),
                    )
                    for c, b0, beta in learned["steps"]
                ]
            )
            filled = F.aggregate(steps, filled, lambda now, s: _replay(F.col("_x"), now, s))
        staged = staged.withColumn("_x", F.when(any_gap, filled).otherwise(F.col("_x")))
        out = {}
        for i, (c, s) in enumerate(zip(columns, start)):
            out[c] = F.coalesce(as_double(c), F.get("_x", F.lit(i)) + F.lit(s))
        return staged.withColumns(out).drop("_x")


def _replay(original: Column, now: Column, step: Column) -> Column:
    dot = F.aggregate(
        F.zip_with(now, step["b"], lambda a, b: a * b), F.lit(0.0), lambda total, v: total + v
    )
    moved = F.transform(now, lambda v, i: F.when(i == step["c"], step["b0"] + dot).otherwise(v))
    return F.when(F.get(original, step["c"]).isNull(), moved).otherwise(now)


# ---------------------------------------------------------------- categories


class ChainedCategoryImputer(Estimator, _Columns):
    """Chained imputation of categories: most frequent first, then rounds of tree ensembles.

    The ensembles see codes of the other columns.  Missing and unseen categories are both
    imputed; results are rounded, held in range and turned back into category texts.
    Columns with more categories than ``maxBins`` are split between bins, not single codes.
    """

    maxIter = Param(Params._dummy(), "maxIter", "rounds", TypeConverters.toInt)
    numTrees = Param(Params._dummy(), "numTrees", "trees per ensemble", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of the trees", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of the codes of a column", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "relative change that ends the rounds", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the ensembles", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, maxIter=10, numTrees=50, maxDepth=30, maxBins=256, tol=1e-3, seed=42):
        super().__init__()
        self._setDefault(maxIter=10, numTrees=50, maxDepth=30, maxBins=256, tol=1e-3, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ChainedCategoryImputerModel":
        columns = self.getInputCols()
        dictionary = Dictionary.fit(df, columns)
        names = [f"_v{i}" for i in range(len(columns))]
        coded = dictionary.encode(df.select(*[F.col(f"`{c}`") for c in columns]), {c: c for c in columns}, None).toDF(*names)
        combos = checkpointed(coded.groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("n")))
        places = dictionary.places(modes(df, columns)) if columns else {}
        start = [places[c] for c in columns]
        gaps = combos.agg(
            F.count(F.lit(1)),
            *[F.coalesce(F.sum(F.when(F.col(v).isNull(), F.col("n"))), F.lit(0.0)) for v in names],
        ).first()[1:]
        order = np.argsort(np.array(gaps, dtype=float), kind="stable").tolist() if columns else []
        forests: list[tuple[int, RandomForestRegressionModel]] = []
        top = max([n - 1 for n in dictionary.sizes.values()], default=0)
        state = _with_start(combos, names, start)
        if len(columns) > 1:
            for _ in range(self.getOrDefault(self.maxIter)):
                before = state
                for c in order:
                    model = self._forest(state, names, c)
                    if model is None:
                        continue
                    forests.append((c, model))
                    if gaps[c]:
                        state = checkpointed(_predict(state, names, c, model))
                if not any(gaps) or _largest_change(before, state, names) < self.getOrDefault(self.tol) * top:
                    break
        # The last state is what the steps give for every incomplete combination seen here.
        seen = checkpointed(_decoded(state.where(_any_gap(names)), names, columns, dictionary))
        learned = {"start": start, "order": [c for c, _ in forests], "small": is_small(seen)}
        return ChainedCategoryImputerModel(columns, learned, [m for _, m in forests], dictionary, seen)

    def _forest(self, state, names, c) -> RandomForestRegressionModel | None:
        known = state.where(~F.col(f"_g{c}"))
        if known.isEmpty():
            return None
        others = [v for i, v in enumerate(names) if i != c]
        # Full trees without bootstrap reproduce the group means of combinations seen in
        # training; the features left out at each split make the trees differ elsewhere.
        learner = RandomForestRegressor(
            featuresCol="_f",
            labelCol=names[c],
            weightCol="n",
            numTrees=self.getOrDefault(self.numTrees),
            maxDepth=self.getOrDefault(self.maxDepth),
            maxBins=self.getOrDefault(self.maxBins),
            bootstrap=False,
            featureSubsetStrategy="onethird",
            seed=self.getOrDefault(self.seed),
        )
        ready = VectorAssembler(inputCols=others, outputCol="_f").transform(known)
        return learner.fit(ready.select("_f", names[c], "n"))


def _with_start(df: DataFrame, names: Sequence[str], start: Sequence[float]) -> DataFrame:
    flags = {f"_g{i}": F.col(v).isNull() for i, v in enumerate(names)}
    filled = {v: F.coalesce(F.col(v), F.lit(s)) for v, s in zip(names, start)}
    originals = {f"_o{i}": F.col(v) for i, v in enumerate(names)}
    return df.withColumns({**flags, **originals}).withColumns(filled)


def _any_gap(names: Sequence[str]) -> Column:
    gap = F.lit(False)
    for i in range(len(names)):
        gap = gap | F.col(f"_g{i}")
    return gap


def _decoded(state: DataFrame, names: Sequence[str], columns: Sequence[str], dictionary: Dictionary) -> DataFrame:
    """The original codes ``_o`` of each combination with the texts ``_t`` of its final codes."""
    texts = dictionary.decode(state, {f"_t{i}": (F.col(v), c) for i, (v, c) in enumerate(zip(names, columns))})
    return texts.select(*[f"_o{i}" for i in range(len(names))], *[f"_t{i}" for i in range(len(names))])


def _predict(state: DataFrame, names: Sequence[str], c: int, model) -> DataFrame:
    others = [v for i, v in enumerate(names) if i != c]
    ready = VectorAssembler(inputCols=others, outputCol="_f").transform(state)
    guessed = model.setFeaturesCol("_f").setPredictionCol("_guess").transform(ready)
    value = F.when(F.col(f"_g{c}"), F.col("_guess")).otherwise(F.col(names[c]))
    return guessed.withColumn(names[c], value).drop("_f", "_guess")


def _largest_change(before: DataFrame, after: DataFrame, names: Sequence[str]) -> float:
    """Largest total change of a combination between two rounds."""
    keys = [f"_o{i}" for i in range(len(names))]
    old = before.select(*[F.col(k).alias(f"k_{k}") for k in keys], *[F.col(v).alias(f"b_{v}") for v in names])
    paired = after.join(old, [F.col(k).eqNullSafe(F.col(f"k_{k}")) for k in keys])
    moved = sum((F.abs(F.col(v) - F.col(f"b_{v}")) for v in names), F.lit(0.0))
    return float(paired.agg(F.coalesce(F.max(moved), F.lit(0.0))).first()[0])


class ChainedCategoryImputerModel(Model, _Columns, MLReadable, MLWritable):
    """Fills rows by a join with the combinations seen in training; others replay the trees."""

    def __init__(self, inputCols=None, learned=None, forests=(), dictionary=None, seen=None):
        super().__init__()
        self.learned, self.forests, self.dictionary, self.seen = learned, list(forests), dictionary, seen
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = self.getInputCols()
        if not columns:
            return df
        names = [f"_v{i}" for i in range(len(columns))]
        coded = self.dictionary.encode(df, dict(zip(names, columns)), None)
        if df.isStreaming:  # one pass over the source
            return self._texts(self._by_row(coded, names), df.columns)
        gap = F.lit(False)
        for v in names:
            gap = gap | F.col(v).isNull()
        seen = self.seen.withColumn("_seen", F.lit(True))
        same = [F.col(v).eqNullSafe(F.col(f"_o{i}")) for i, v in enumerate(names)]
        joined = coded.join(F.broadcast(seen) if self.learned["small"] else seen, same, "left")
        new = gap & F.col("_seen").isNull()
        found = joined.where(~new).withColumns({f"_o{i}": F.col(v) for i, v in enumerate(names)})
        late = self._by_row(joined.where(new).select(*[f"`{c}`" for c in coded.columns]), names)
        return self._texts(found, df.columns).unionByName(self._texts(late, df.columns))

    def _texts(self, filled: DataFrame, wanted: Sequence[str]) -> DataFrame:
        """Known categories as they are, the others as imputed."""
        columns = self.getInputCols()
        out = {}
        for i, c in enumerate(columns):
            own = F.col(f"`{c}`").cast("string")
            known = F.col(f"_o{i}").isNotNull() if self.dictionary.sizes[c] else F.lit(True)
            out[c] = F.when(known, own).otherwise(F.col(f"_t{i}")).alias(c)
        return filled.select(*[out.get(c, F.col(f"`{c}`")) for c in wanted])

    def _by_row(self, coded: DataFrame, names: Sequence[str]) -> DataFrame:
        """Every row imputed by itself: ``_o`` and ``_t`` beside its columns."""
        state = self._replay(coded, names)
        wanted = {f"_t{i}": (F.col(v), c) for i, (v, c) in enumerate(zip(names, self.getInputCols()))}
        return self.dictionary.decode(state, wanted)

    def _replay(self, coded: DataFrame, names: Sequence[str]) -> DataFrame:
        state = _with_start(coded, names, self.learned["start"])
        for c, model in zip(self.learned["order"], self.forests):
            state = _predict(state, names, c, model)
        return state

    def write(self) -> MLWriter:
        return _CategoryWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _CategoryReader(cls)


class _CategoryWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        facts = self.instance.dictionary.save(f"{path}/dictionary")
        extra = {"learned": self.instance.learned, "forests": len(self.instance.forests), "dictionary": facts}
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sc, extra)
        self.instance.seen.write.parquet(f"{path}/seen")
        for i, forest in enumerate(self.instance.forests):
            forest.save(f"{path}/forests/{i}")


class _CategoryReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ChainedCategoryImputerModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sc)
        forests = [RandomForestRegressionModel.load(f"{path}/forests/{i}") for i in range(meta["forests"])]
        dictionary = Dictionary.load(self.sparkSession, f"{path}/dictionary", meta["dictionary"])
        seen = self.sparkSession.read.parquet(f"{path}/seen")
        model = self.cls(None, meta["learned"], forests, dictionary, seen)
        DefaultParamsReader.getAndSetParams(model, meta)
        return model
