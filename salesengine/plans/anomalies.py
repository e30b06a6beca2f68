"""Rows that stand out, five kinds of them."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..operators.ranking import top_k
from ..schemas import RAW_COLUMNS
from ..session import materialize

COLUMNS = RAW_COLUMNS
OUTPUT = (
    "order_id",
    "product_name",
    "category",
    "region",
    "quantity",
    "unit_price",
    "discount_percent",
    "revenue",
    "sale_date",
    "customer_email",
    "anomaly_type",
    "anomaly_score",
    "percentile",
)
KEPT = 5
HIGH_DISCOUNT_FROM = 100
SIGMAS = 3
SCORE = "decimal(16,4)"
#: Shares of the rows of which the best scores are kept; more than five.
LANES = 1024
MOMENTS = {"_n": "bigint", "_s": "decimal(38,0)", "_q": "decimal(38,0)"}


def _strongest(
    sales: DataFrame,
    kind: str,
    condition: Column,
    score: Column,
    percentile: float,
    stored: bool,
    scores: DataFrame | None = None,
) -> DataFrame:
    """The five rows with the highest score, ties by order id.

    ``scores`` is a leaner frame of the same rows, with their ids and what the score needs.
    The five are found there, and ``sales`` are asked for their ids alone, so that joins
    behind the wide columns meet a handful of rows.

    On a stored fact the fifth score is found first, from the columns it needs
    alone. The second scan then skips every row group below it, so the wide
    columns of a 100 TB table are read for a handful of rows.
    """
    if scores is not None:
        known = scores.where(condition).select("order_id", score.cast(SCORE).alias("_score"))
        ids = [r.order_id for r in top_k(known, [F.desc("_score"), F.asc("order_id")], KEPT).collect()]
        chosen = F.col("order_id").isin([i for i in ids if i is not None])
        sales = sales.where(chosen | F.col("order_id").isNull() if None in ids else chosen)
    rows = sales.where(condition)
    if stored:
        best = rows.select(score.alias("_score")).orderBy(F.desc("_score")).limit(KEPT)
        rows = rows.where(score >= best.agg(F.min("_score")).scalar())
    scored = rows.select(
        *OUTPUT[:8],
        F.date_format("sale_date", "yyyy-MM-dd").alias("sale_date"),
        "customer_email",
        F.lit(kind).alias("anomaly_type"),
        score.cast(SCORE).alias("anomaly_score"),
        F.lit(percentile).cast("decimal(5,2)").alias("percentile"),
    )
    return top_k(scored, [F.desc("anomaly_score"), F.asc("order_id")], KEPT)


def high_revenue(
    sales: DataFrame, stored: bool = False, scores: DataFrame | None = None
) -> DataFrame:
    earned = F.col("revenue")
    return _strongest(sales, "HIGH_REVENUE", earned > 0, earned, 99.9, stored, scores)


def high_quantity(
    sales: DataFrame, stored: bool = False, scores: DataFrame | None = None
) -> DataFrame:
    units = F.col("quantity")
    return _strongest(sales, "HIGH_QUANTITY", units > 0, units, 99.9, stored, scores)


def high_discount(
    sales: DataFrame, stored: bool = False, at_least: float = HIGH_DISCOUNT_FROM
) -> DataFrame:
    """None on cleaned rows, whose discount ends at 70."""
    percent = F.col("discount_percent")
    return _strongest(sales, "HIGH_DISCOUNT", percent >= at_least, percent, 99.0, stored)


def negative_values(sales: DataFrame, stored: bool = False) -> DataFrame:
    """Negative quantity, price or revenue; the score is no column, so no row group
    can be skipped by it and ``stored`` changes nothing."""
    parts = [F.col(c) for c in ("quantity", "unit_price", "revenue")]
    condition = (parts[0] < 0) | (parts[1] < 0) | (parts[2] < 0)
    # LEAST in SQL is NULL when a part is; F.least would skip it.
    complete = parts[0].isNotNull() & parts[1].isNotNull() & parts[2].isNotNull()
    lowest = F.when(complete, F.least(*[p.cast("decimal(14,2)") for p in parts]))
    return _strongest(sales, "NEGATIVE_VALUES", condition, F.abs(lowest), 0.0, False)


def _cents() -> Column:
    return (F.when(F.col("unit_price") > 0, F.col("unit_price")) * 100).cast("decimal(18,0)")


def price_moments(count: str = "_n", total: str = "_s", squares: str = "_q") -> list[Column]:
    """Count and power sums of the positive prices in cents, as exact decimals.

    They add up in any order and grouping to the same digits: 10^17 rows of the largest
    price would fit.
    """
    cents = _cents()
    square = (cents.cast("decimal(19,0)") * cents.cast("decimal(19,0)")).cast("decimal(28,0)")
    return [
        F.count(cents).alias(count),
        F.sum(cents).cast("decimal(38,0)").alias(total),
        F.sum(square).cast("decimal(38,0)").alias(squares),
    ]


def threshold_of(count: Column, total: Column, squares: Column) -> Column:
    """Mean plus three population deviations, in the price's unit, from power sums in cents.

    The sums are moved to the whole part of the mean while they are exact, so that no
    digits cancel in doubles; each double step after that is rounded the same way everywhere.
    """
    n = F.nullif(count, F.lit(0)).cast("decimal(18,0)")
    middle = F.call_function("div", total, n).cast("decimal(18,0)")
    rest = (total - (middle * n).cast("decimal(38,0)")).cast("double") / n.cast("double")
    around = squares - (F.lit(2) * middle * total).cast("decimal(38,0)") + (
        (middle * middle).cast("decimal(28,0)") * n
    ).cast("decimal(38,0)")
    variance = around.cast("double") / n.cast("double") - rest * rest
    return (middle.cast("double") + rest + SIGMAS * F.sqrt(F.greatest(variance, F.lit(0.0)))) / 100.0


def price_threshold(sales: DataFrame) -> DataFrame:
    """Mean plus three population deviations of the positive prices, one row."""
    sums = sales.agg(*price_moments())
    return sums.select(threshold_of(*map(F.col, ("_n", "_s", "_q"))).alias("threshold"))


def above_threshold(sales: DataFrame) -> DataFrame:
    """Every row above the threshold, with the threshold; a scalar subquery, no join."""
    limit = price_threshold(sales).scalar()
    return sales.where(_above(F.col("unit_price"), limit)).withColumn("threshold", limit)


def _above(price: Column, limit: Column) -> Column:
    """Price over a limit in double precision.

    The limit cut to the price's own type stands beside it: without a cast on the
    column it reaches the parquet scan, and row groups of lower prices are skipped.
    """
    whole = F.floor(limit * 100).cast("decimal(18,0)") * F.lit(0.01).cast("decimal(3,2)")
    return (price >= whole.try_cast("decimal(10,2)")) & (price.cast("double") > limit)


def price_anomalies(
    sales: DataFrame, stored: bool = False, prices: DataFrame | None = None
) -> DataFrame:
    """Prices above the threshold of all prices; ``prices`` is a leaner frame to take it from."""
    price = F.col("unit_price")
    limit = price_threshold(sales if prices is None else prices).scalar()
    return _strongest(sales, "PRICE_ANOMALY", _above(price, limit), price, 99.5, stored)


def _kinds() -> dict[str, tuple[Column, Column, float]]:
    """Condition, score and percentile of each kind; prices are compared with the limit later."""
    units, price, percent, earned = (
        F.col(c) for c in ("quantity", "unit_price", "discount_percent", "revenue")
    )
    complete = units.isNotNull() & price.isNotNull() & earned.isNotNull()
    lowest = F.when(complete, F.least(*[p.cast("decimal(14,2)") for p in (units, price, earned)]))
    return {
        "HIGH_REVENUE": (earned > 0, earned, 99.9),
        "HIGH_QUANTITY": (units > 0, units, 99.9),
        "HIGH_DISCOUNT": (percent >= HIGH_DISCOUNT_FROM, percent, 99.0),
        "NEGATIVE_VALUES": ((units < 0) | (price < 0) | (earned < 0), F.abs(lowest), 0.0),
        "PRICE_ANOMALY": (price > 0, price, 99.5),
    }


def _best_of_each(scored: DataFrame) -> DataFrame:
    """At most five rows per kind; each task sends on no more."""
    best = Window.partitionBy("anomaly_type").orderBy(
        F.desc_nulls_last("anomaly_score"), F.asc("order_id"), *_TIES
    )
    return scored.withColumn("_place", F.row_number().over(best)).where(f"_place <= {KEPT}").drop("_place")


_TIES = ("revenue", "quantity", "unit_price", "discount_percent")


def _scored(sales: DataFrame, bounds: Row, wide: bool) -> DataFrame:
    """A row per kind that a row meets, if its score reaches the bound of the kind."""
    kinds = []
    for name, (condition, score, percentile) in _kinds().items():
        if bounds[name] is not None:
            condition = condition & (score >= F.lit(bounds[name]))
        kinds.append(
            F.when(
                condition,
                F.struct(
                    F.lit(name).alias("anomaly_type"),
                    score.cast(SCORE).alias("anomaly_score"),
                    F.lit(percentile).cast("decimal(5,2)").alias("percentile"),
                ),
            )
        )
    reached = [_reached(name, bounds[name]) for name in _kinds()]
    rows = sales.where(reduce(Column.__or__, reached))
    rows = rows.withColumn("_kind", F.explode(F.filter(F.array(*kinds), lambda k: k.isNotNull())))
    shown = F.date_format("sale_date", "yyyy-MM-dd").alias("sale_date") if wide else None
    names = [shown if c == "sale_date" else c for c in OUTPUT[:10]] if wide else ["order_id", *_TIES]
    return rows.select(*names, "_kind.*")


def _reached(name: str, bound: Decimal | int | None) -> Column:
    """A test that reaches the scan: on a column, or on columns of which one must be negative."""
    condition, score, _ = _kinds()[name]
    if name == "NEGATIVE_VALUES" or bound is None:
        return condition
    return condition & (score >= F.lit(bound))


def strongest(sales: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the five strongest rows of each kind, the moments of the prices), both mergeable.

    Three scans of a stored fact. The first keeps the best score of each kind in each of
    ``LANES`` arbitrary shares of the rows, and sums the moments; the fifth of these bests is a
    lower bound that at least five rows reach. The second reads ids and scores of the rows that
    reach their bound, and keeps five per kind. The third fetches those rows by their ids, so
    that the wide columns are read for at most 25 rows, even where all scores tie. A row
    stands among the prices whether or not it passes the threshold.
    """
    bests = [
        F.max(F.when(condition, score)).alias(name) for name, (condition, score, _) in _kinds().items()
    ]
    narrow = sales.select("order_id", *_TIES)
    lanes = narrow.groupBy(F.pmod(F.monotonically_increasing_id(), F.lit(LANES)).alias("_lane"))
    lanes = materialize(lanes.agg(*bests, *price_moments()))
    moments = lanes.agg(*[F.sum(c).cast(t).alias(c) for c, t in MOMENTS.items()])
    bounds = lanes.agg(
        *[F.get(F.sort_array(F.collect_list(k), asc=False), F.lit(KEPT - 1)).alias(k) for k in _kinds()]
    ).first()  # of LANES rows
    found = _best_of_each(_scored(narrow, bounds, wide=False)).select("order_id").distinct().collect()
    ids = [r.order_id for r in found]  # at most five per kind
    chosen = F.col("order_id").isin([i for i in ids if i is not None])
    if None in ids:
        chosen = chosen | F.col("order_id").isNull()
    return _best_of_each(_scored(sales.where(chosen), bounds, wide=True)), moments


def records_of(rows: DataFrame, moments: DataFrame) -> DataFrame:
    """The records among the strongest rows: of the prices those above the threshold."""
    limit = moments.select(threshold_of(*map(F.col, MOMENTS))).scalar()
    above = (F.col("anomaly_type") != "PRICE_ANOMALY") | (F.col("unit_price").cast("double") > limit)
    return rows.where(above).select(*OUTPUT)


def merged_strongest(parts: DataFrame, moments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same two frames for several parts under each other."""
    sums = moments.agg(*[F.sum(c).cast(t).alias(c) for c, t in MOMENTS.items()])
    return _best_of_each(parts), sums


def anomaly_records(sales: DataFrame, stored: bool = False) -> DataFrame:
    """All five kinds, at most five rows of each; ``sales`` are read three times."""
    return records_of(*strongest(sales if stored else materialize(sales)))
