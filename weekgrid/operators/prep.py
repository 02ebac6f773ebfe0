"""Feature preparation: exact column operators and Spark ML stages."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.sql import Column, DataFrame, functions as F

from weekgrid.functions.quantiles import quantiles
from weekgrid.operators.profiling import categorical as categorical_profile


def _figures(long: DataFrame, entries: dict[str, Column]) -> Column:
    """Rows of a small long table as the fields of one scalar struct."""
    row = long.agg(*[F.max(F.when(test, F.col("value"))).alias(n) for n, test in entries.items()])
    return row.select(F.struct(*entries).alias("f")).scalar()


def median_impute(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs become the exact column median."""
    medians = quantiles(df, columns, [0.5])
    fill = _figures(medians, {c: F.col("column") == c for c in columns})
    return df.withColumns({c: F.coalesce(F.col(c), fill[c]) for c in columns})


def robust_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x - median) / (q3 - q1) with exact quartiles; a zero range divides by one."""
    probs = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    long = quantiles(df, columns, list(probs.values()))
    entries = {
        f"{c}_{n}": (F.col("column") == c) & (F.col("prob") == p) for c in columns for n, p in probs.items()
    }
    figure = _figures(long, entries)

    def scaled(c: str) -> Column:
        width = figure[f"{c}_q3"] - figure[f"{c}_q1"]
        return (F.col(c) - figure[f"{c}_q2"]) / F.when(width == 0, 1.0).otherwise(width)

    return df.withColumns({c: scaled(c) for c in columns})


def mode_impute(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs become the most frequent value, the smallest one on ties."""
    modes = categorical_profile(df, columns).select("column", F.col("top").alias("value"))
    fill = _figures(modes, {c: F.col("column") == c for c in columns})
    types = dict(df.dtypes)
    return df.withColumns({c: F.coalesce(F.col(c), fill[c].cast(types[c])) for c in columns})


def learned_levels(df: DataFrame, column: str) -> list:
    """The distinct values of a category in order, as an encoder learns them; they become
    columns, so they are few."""
    return [r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column).collect()]


def one_hot(df: DataFrame, column: str, levels: list | None = None) -> DataFrame:
    """A 0/1 column per level but the first; an unknown level gets all zeros. Without
    ``levels`` they are learned from ``df``."""
    levels = learned_levels(df, column) if levels is None else levels
    return df.withColumns(
        {
            f"{column}_{v}": F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0))
            for v in sorted(levels)[1:]
        }
    )


def _text(names: list[str], modes: dict[str, str]) -> SQLTransformer:
    filled = ", ".join(
        f"coalesce(cast({c} AS string), '{str(modes.get(c, '')).replace(chr(39), chr(39) * 2)}') AS {c}_text"
        for c in names
    )
    return SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")


def _number(value: float | None) -> str:
    """A double as a SQL literal; a column without values has none."""
    return "CAST('NaN' AS DOUBLE)" if value is None else f"{float(value)!r}D"


def _numbers(train: DataFrame, numeric: list[str]) -> tuple[SQLTransformer, list[str]]:
    """Numbers with the exact median in place of NULL and NaN, as ``<column>_full``."""
    doubles = train.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in numeric])
    medians = {r["column"]: r["value"] for r in quantiles(doubles, numeric, [0.5]).collect()}
    filled = ", ".join(f"coalesce(nanvl(cast({c} AS double), NULL), {_number(medians.get(c))}) AS {c}_full" for c in numeric)
    return SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"), [f"{c}_full" for c in numeric]


def _scaled(train: DataFrame, numbers: list[str]) -> tuple[SQLTransformer, list[str]]:
    """(x - median) / (q3 - q1) with exact quartiles; a zero range divides by one."""
    found: dict[str, dict] = {}
    for r in quantiles(train.select(*numbers), numbers, [0.25, 0.5, 0.75]).collect():
        found.setdefault(r["column"], {})[r["prob"]] = r["value"]
    parts = []
    for c in numbers:
        low, middle, high = (found.get(c, {}).get(p, 0.0) for p in (0.25, 0.5, 0.75))
        parts.append(f"({c} - {_number(middle)}) / {_number((high - low) or 1.0)} AS {c}_scaled")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__"), [f"{c}_scaled" for c in numbers]


def fit_features(
    train: DataFrame, numeric: list[str], categorical: list[str], encode: bool
) -> PipelineModel:
    """Fitted stages from raw columns to a ``features`` vector.

    ``encode`` gives the linear-model form: median imputation, robust scaling,
    mode imputation, one-hot without the first level, unknown levels as zeros.
    Without it trees get imputed numbers and indexed categories. Without categories
    the vector is the imputed, or scaled, numbers.
    """
    stages: list[Transformer] = []
    if categorical:
        modes = {r["column"]: r["top"] for r in categorical_profile(train, categorical).toLocalIterator()}
        stages.append(_text(categorical, modes))
    impute, names = _numbers(train, numeric)
    stages.append(impute)
    here = PipelineModel(stages).transform(train)
    if not categorical:
        if encode:
            scaler, names = _scaled(here, names)
            stages.append(scaler)
        stages.append(VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep"))
        return PipelineModel(stages)
    # Descending order puts the alphabetically first level last, where it is cut off.
    indexer = StringIndexer(
        inputCols=[f"{c}_text" for c in categorical],
        outputCols=[f"{c}_index" for c in categorical],
        handleInvalid="keep",
        stringOrderType="alphabetDesc" if encode else "alphabetAsc",
    ).fit(here)
    stages.append(indexer)
    here = indexer.transform(here)
    if not encode:
        inputs = names + [f"{c}_index" for c in categorical]
        stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
        return PipelineModel(stages)
    scaler, scaled = _scaled(here, names)
    numbers = VectorAssembler(inputCols=scaled, outputCol="scaled", handleInvalid="keep")
    stages += [scaler, numbers]
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in categorical],
        outputCols=[f"{c}_levels" for c in categorical],
        dropLast=True,
    ).fit(here)
    stages.append(encoder)
    inputs = ["scaled"]
    for c, labels in zip(categorical, indexer.labelsArray):
        if len(labels) > 1:
            stages.append(
                VectorSlicer(inputCol=f"{c}_levels", outputCol=f"{c}_onehot", indices=list(range(len(labels) - 1)))
            )
            inputs.append(f"{c}_onehot")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return PipelineModel(stages)
