"""Department affinity from de-seasonalised sales."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from weekgrid.functions.columns import ratio, zero_if_null
from weekgrid.session import stored

BLOCK = 512


def residuals(gold: DataFrame) -> DataFrame:
    """Sales minus sales of the same week last year, after the warm-up year."""
    warm = gold.select("store", "dept", "date", "weekly_sales", "sales_last_year").na.drop(
        subset=["sales_last_year"]
    )
    return warm.withColumn("residual_sales", F.col("weekly_sales") - F.col("sales_last_year"))


def basket_matrix(resid: DataFrame, depts: list[int]) -> DataFrame:
    """One row per store and date, one column per department, absent as zero."""
    wide = (
        resid.groupBy("store", "date")
        .pivot("dept", depts)
        .agg(F.first("residual_sales"))
    )
    return wide.select("store", "date", *[zero_if_null(F.col(f"`{d}`")).alias(f"dept_{d}") for d in depts])


def _basket_numbers(cells: pa.Table) -> np.ndarray:
    """Running number of the (store, date) basket each sorted row belongs to."""
    if cells.num_rows < 2:
        return np.zeros(cells.num_rows, dtype=np.int64)
    new = [
        pc.not_equal(cells[k].slice(1), cells[k].slice(0, cells.num_rows - 1)).to_numpy()
        for k in ("store", "date")
    ]
    return np.concatenate([[0], np.cumsum(new[0] | new[1])])


def _cross_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of products per department pair over sorted basket cells.

    The baskets of a batch are laid out as a matrix of columns blocked by
    department, so pairs come out of a matrix product, already summed, and never
    as rows per basket. A basket cut by the end of a batch waits for the next.
    """

    def products(cells: pa.Table, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        amounts = cells["residual_sales"].to_numpy()
        names, place = np.unique(cells["dept"].to_numpy(), return_inverse=True)
        starts = range(0, len(names), BLOCK)

        def block(start: int) -> np.ndarray:
            keep = (place >= start) & (place < start + BLOCK)
            dense = np.zeros((rows[-1] + 1, min(BLOCK, len(names) - start)))
            dense[rows[keep], place[keep] - start] = amounts[keep]
            return dense

        for i in starts:
            left = block(i)
            for j in starts:
                if j < i:
                    continue
                sums = left.T @ (left if i == j else block(j))
                a, b = np.nonzero(sums)
                upper = a + i < b + j
                a, b = a[upper], b[upper]
                if len(a):
                    yield pa.RecordBatch.from_pydict({"a": names[a + i], "b": names[b + j], "sxy": sums[a, b]})

    waiting: pa.Table | None = None
    for batch in batches:
        fresh = pa.Table.from_batches([batch])
        cells = fresh if waiting is None else pa.concat_tables([waiting, fresh])
        number = _basket_numbers(cells)
        cut = int(np.searchsorted(number, number[-1])) if len(number) else 0
        if cut:
            yield from products(cells.slice(0, cut), number[:cut])
        waiting = cells.slice(cut)
    if waiting is not None and waiting.num_rows:
        yield from products(waiting, _basket_numbers(waiting))


def _separate(depts: DataFrame, above: float | None) -> DataFrame:
    """(a, b, fa, fb) of pairs that may pass if they share no basket.

    Such a pair has no product sum, so its score is -fa * fb with f = s / spread of
    one department. Departments are put into classes by the sign and the binary
    exponent of f; from the extremes of two classes follows whether any of their pairs
    can pass, and only departments of such classes are joined. There are as many classes
    as exponents a double has, so the table of their pairs is bounded and broadcast.
    """
    power = F.floor(F.log2(F.abs("f"))).cast("int")
    kind = F.when(F.col("f") == 0, F.lit("0")).otherwise(F.concat_ws(":", F.signum("f").cast("int"), power))
    placed = depts.where("f IS NOT NULL").withColumn("kind", kind)
    ends = placed.groupBy("kind").agg(F.min("f").alias("low"), F.max("f").alias("high")).collect()
    pairs = [
        (x["kind"], y["kind"])
        for x in ends
        for y in ends
        if above is None or max(-p * q for p in (x["low"], x["high"]) for q in (y["low"], y["high"])) > above - 1e-9
    ]
    meet = F.broadcast(depts.sparkSession.createDataFrame(pairs, "kind string, other string"))
    left = placed.select(F.col("dept").alias("a"), F.col("f").alias("fa"), "kind").join(meet, "kind")
    right = placed.select(F.col("dept").alias("b"), F.col("f").alias("fb"), F.col("kind").alias("other"))
    return left.join(right, "other").where(F.col("a") < F.col("b")).select("a", "b", "fa", "fb")


def pair_scores(resid: DataFrame, above: float | None = None) -> DataFrame:
    """(department_a, department_b, correlation_score) for pairs a < b whose score is
    greater than ``above``; for all pairs without it.

    Equals the correlation matrix of the zero-filled basket pivot, without the
    pivot: an absent department adds nothing to a sum, so the number of baskets
    and the sums per department and per pair are enough. A task meets whole
    baskets in order, and every batch of them is reduced to one partial sum per
    pair before the pair shuffle. Pairs come from shared baskets; those without
    one are added where their closed form can pass.
    """
    n = resid.select("store", "date").distinct().agg(F.count("*").cast("double")).scalar()
    spread = F.sqrt(n * F.col("ss") - F.col("s") * F.col("s"))
    per_dept = stored(
        resid.groupBy("dept")
        .agg(
            F.sum("residual_sales").alias("s"),
            F.sum(F.col("residual_sales") * F.col("residual_sales")).alias("ss"),
        )
        .select("dept", "s", n.alias("n"), spread.alias("spread"), ratio(F.col("s"), spread).alias("f")),
        "departments",
    )
    cells = (
        resid.where("store IS NOT NULL AND date IS NOT NULL")
        .select("store", "date", F.col("dept").cast("bigint").alias("dept"), "residual_sales")
        .repartition("store", "date")
        .sortWithinPartitions("store", "date")
    )
    sums = stored(
        cells.mapInArrow(_cross_products, "a bigint, b bigint, sxy double")
        .groupBy("a", "b")
        .agg(F.sum("sxy").alias("sxy")),
        "shared-baskets",
    )
    left = per_dept.select(F.col("dept").alias("a"), "n", F.col("s").alias("sa"), F.col("spread").alias("da"))
    right = per_dept.select(F.col("dept").alias("b"), F.col("s").alias("sb"), F.col("spread").alias("db"))
    score = ratio(F.col("n") * F.col("sxy") - F.col("sa") * F.col("sb"), F.col("da") * F.col("db"))
    shared = sums.join(left, "a").join(right, "b").select("a", "b", score.alias("score"))
    apart = _separate(per_dept, above).join(sums.select("a", "b"), ["a", "b"], "left_anti")
    both = shared.unionByName(apart.select("a", "b", (-F.col("fa") * F.col("fb")).alias("score"))).where("score IS NOT NULL")
    if above is not None:
        both = both.where(F.col("score") > above)
    return both.select(F.col("a").alias("department_a"), F.col("b").alias("department_b"), F.col("score").alias("correlation_score"))


def rules(gold: DataFrame, min_score: float = 0.6) -> DataFrame:
    """Department pairs whose surprise sales move together, strongest first."""
    return pair_scores(residuals(gold), min_score).orderBy(F.desc("correlation_score"), "department_a", "department_b")
