"""Summaries of a small hand-made fact against plain Python."""

from collections import defaultdict
from datetime import date
from decimal import ROUND_HALF_UP, Decimal
from statistics import median

import pytest
from pyspark.sql import functions as F

from salesengine.plans import anomalies, dashboard, discounts, monthly, products, quality, regions
from salesengine.schemas import ANOMALY_TYPES, SALES_SCHEMA
from salesengine.session import materialize


def cents(text):
    return Decimal(text).quantize(Decimal("0.01"))


def row(order_id, name="tv", kind="electronics", quantity=1, price="10", percent="0", region="North",
        day=date(2024, 1, 5), revenue=None):
    price, percent = cents(price), cents(percent)
    if revenue is None:
        revenue = (quantity * price * (100 - percent) / 100).quantize(Decimal("0.01"), ROUND_HALF_UP)
    return (order_id, name, kind, quantity, price, percent, region, day, "a@b.com", cents(revenue))


ROWS = [
    row("01", "tv", "electronics", 2, "100", "10"),
    row("02", "tv", "electronics", 1, "100", "20", day=date(2024, 2, 1)),
    row("03", "chair", "furniture", 40, "5", "0", "South"),
    row("04", "chair", "furniture", 0, "5", "50", "South"),
    row("05", "lamp", None, 500, "1", "30", "East"),
    row("06", None, "gadgets", 3, "250", "70", ""),
    row("07", "desk", "furniture", 1, "300", "15", None, day=None),
    row("08", "desk", "", 1, "300", "15", "West"),
    row("09", "odd", "gadgets", 2, "-20", "0", "West"),
    row("10", "odd", "gadgets", -3, "20", "0", "West"),
    row("11", "free", "gadgets", 1, "0", "5", "East"),
    row("12", "tie a", "ties", 7, "10", "5", "East"),
    row("13", "tie b", "ties", 7, "10", "5", "East"),
    row("13", "tie b", "ties", 7, "10", "6", "East"),
    row("14", "huge", "gadgets", 1, "10", "100", "West"),
    *[row(f"2{i}", f"p{i:02d}", "bulk", 9, "3", str(i), "North", date(2023, 12, i + 1)) for i in range(12)],
]


@pytest.fixture(scope="module")
def sales(spark):
    return materialize(spark.createDataFrame(ROWS, SALES_SCHEMA))


FIELDS = SALES_SCHEMA.names


def records():
    return [dict(zip(FIELDS, r, strict=True)) for r in ROWS]


def average(values, digits):
    exact = sum(values, Decimal(0)) / len(values)
    return exact.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)


def grouped(rows, *keys):
    groups = defaultdict(list)
    for r in rows:
        groups[tuple(r[k] for k in keys)].append(r)
    return groups


def test_monthly(sales):
    groups = defaultdict(list)
    for r in records():
        if r["sale_date"]:
            groups[r["sale_date"].year, r["sale_date"].month].append(r)
    expected = {
        key: (
            sum(r["revenue"] for r in g),
            sum(r["quantity"] for r in g),
            average([r["discount_percent"] for r in g], 4),
            len({r["order_id"] for r in g}),
        )
        for key, g in groups.items()
    }
    got = {(r.year, r.month): tuple(r)[2:] for r in monthly.monthly_sales(sales).collect()}
    assert got == expected
    assert monthly.monthly_sales(sales, unique_orders=True).where("month = 1").first().order_count == 13
    listed = dashboard.monthly_listing(monthly.monthly_sales(sales)).collect()
    assert [r.month_label for r in listed] == ["2023-12", "2024-01", "2024-02"]


def stats():
    out = {}
    for key, g in grouped([r for r in records() if r["quantity"] > 0], "product_name", "category").items():
        out[key] = (sum(r["revenue"] for r in g), sum(r["quantity"] for r in g))
    return out


def by_name(key):
    return tuple((part is not None, part or "") for part in key)


def test_top_products_lists_nameless_leaders_twice(sales):
    totals = stats()
    revenue = sorted(totals, key=lambda k: (-totals[k][0], by_name(k)))
    units = sorted(totals, key=lambda k: (-totals[k][1], by_name(k)))
    expected = {
        (*k, i, 999 if None in k else units.index(k) + 1) for i, k in enumerate(revenue[:10], start=1)
    }
    expected |= {(*k, 999, i) for i, k in enumerate(units[:10], start=1) if None in k}
    got = products.top_products(sales).collect()
    assert {(r.product_name, r.category, r.revenue_rank, r.units_rank) for r in got} == expected
    assert len(got) == len(expected)
    assert ("lamp", None, 999, 1) in expected and ("lamp", None, 1, 999) in expected
    listed = dashboard.top_products_listing(products.top_products(sales)).collect()
    assert [r.revenue_rank for r in listed] == list(range(1, 11))
    chart = dashboard.top_products_chart(products.top_products(sales)).collect()
    assert [r.revenue_rank for r in chart] == [1, 2, 3, 4, 5]


def test_top_products_in_two_steps(sales):
    totals = stats()
    revenue = sorted(totals, key=lambda k: (-totals[k][0], by_name(k)))
    # A nameless product equals nothing, so it is not known to be listed.
    rest = [k for k in totals if k not in revenue[:10] or None in k]
    units = sorted(rest, key=lambda k: (-totals[k][1], by_name(k)))
    expected = [(*k, i, None) for i, k in enumerate(revenue[:10], start=1)]
    expected += [(*k, None, i) for i, k in enumerate(units[:10], start=1)]
    got = products.top_products_two_step(sales)
    rows = {(r.product_name, r.category, r.revenue_rank, r.units_rank) for r in got.collect()}
    assert rows == set(expected)
    check = quality.check_products(got).first()
    assert (check.total_products, check.top_revenue_products) == (len(expected), 10)
    assert dashboard.product_listing(got).first().revenue_rank == 1


def test_every_product_ranked_both_ways(sales):
    totals = stats()
    got = products.ranked_both_ways(sales).collect()
    assert len(got) == len(totals)
    assert sorted(r.revenue_rank for r in got) == list(range(1, len(totals) + 1))
    assert {r.units_rank for r in got if None in (r.product_name, r.category)} == {999}


@pytest.mark.parametrize("unique", [False, True])
def test_regions(sales, unique):
    market = sum(r["revenue"] for r in records() if r["revenue"] > 0)
    got = {r.region: r for r in regions.region_performance(sales, unique).collect()}
    groups = {k[0]: g for k, g in grouped(records(), "region").items() if k[0]}
    assert set(got) == set(groups) == {"North", "South", "East", "West"}
    for region, g in groups.items():
        revenue = sum(r["revenue"] for r in g)
        orders = len(g) if unique else len({r["order_id"] for r in g})
        earned = {k: sum(r["revenue"] for r in p) for k, p in grouped(g, "product_name", "category").items()}
        best = min(earned, key=lambda k: (-earned[k], by_name(k)))
        r = got[region]
        assert (r.total_revenue, r.total_orders, r.total_quantity) == (revenue, orders, sum(x["quantity"] for x in g))
        assert r.avg_order_value == (revenue / orders).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert r.avg_discount == average([x["discount_percent"] for x in g], 4)
        assert (r.top_product, r.top_category) == best
        assert r.market_share_pct == pytest.approx(float(revenue / market * 100), abs=0.006)
    tops = {r.region: (r.product_name, r.category) for r in regions.region_top_product(sales).collect()}
    assert tops == {k: (r.top_product, r.top_category) for k, r in got.items()}
    check = quality.check_regions(regions.region_performance(sales, unique)).first()
    assert check.total_regions == 4


def test_categories(sales):
    usable = [r for r in records() if r["category"] and r["discount_percent"] >= 0]
    sold = grouped([r for r in usable if r["unit_price"] > 0 and r["quantity"] > 0], "category")
    middles = {k[0]: median(r["discount_percent"] for r in g) for k, g in grouped(usable, "category").items()}
    mean = {r.category: r for r in discounts.category_discount(sales).collect()}
    true = {r.category: r for r in discounts.category_discount_median(sales).collect()}
    assert set(mean) == set(true) == {k[0] for k in sold}
    for (category,), g in sold.items():
        percents = [r["discount_percent"] for r in g]
        expected = (
            average(percents, 4),
            min(percents),
            max(percents),
            len(g),
            sum(r["revenue"] for r in g),
            sum(r["unit_price"] * r["quantity"] - r["revenue"] for r in g),
        )
        for r in (mean[category], true[category]):
            assert (r.avg_discount, r.min_discount, r.max_discount, r.total_orders, r.total_revenue,
                    r.discount_impact) == expected
        assert mean[category].median_discount == expected[0]
        assert true[category].median_discount == middles[category]
    alone = {r.category: r.median_discount for r in discounts.category_median(sales).collect()}
    assert alone == middles
    assert quality.check_categories(discounts.category_discount_median(sales)).first().total_categories == len(sold)
    assert dashboard.category_listing(discounts.category_discount(sales)).count() == len(sold)


def strongest(rows, score):
    return sorted(((r["order_id"], score(r)) for r in rows), key=lambda p: (-p[1], p[0]))[:5]


@pytest.mark.parametrize("stored", [False, True])
def test_anomalies(sales, stored):
    rows = records()
    expected = {
        "HIGH_REVENUE": strongest([r for r in rows if r["revenue"] > 0], lambda r: r["revenue"]),
        "HIGH_QUANTITY": strongest([r for r in rows if r["quantity"] > 0], lambda r: r["quantity"]),
        "HIGH_DISCOUNT": [("14", 100)],
        "NEGATIVE_VALUES": [("10", 60), ("09", 40)],
        "PRICE_ANOMALY": [],
    }
    got = defaultdict(list)
    whole = anomalies.anomaly_records(sales, stored)
    for r in whole.orderBy("anomaly_type", F.desc("anomaly_score"), "order_id").collect():
        got[r.anomaly_type].append((r.order_id, r.anomaly_score))
    assert dict(got) == {k: v for k, v in expected.items() if v}
    assert set(got) <= set(ANOMALY_TYPES)
    undated = whole.where("order_id = '07'").first()
    assert undated is None or undated.sale_date is None
    assert {r.anomaly_type: r.anomaly_count for r in quality.check_anomalies(whole).collect()}["NEGATIVE_VALUES"] == 2
    assert quality.anomaly_listing(whole).columns[-1] == "percentile"


def test_price_threshold_uses_the_population_deviation(spark):
    prices = ["8"] * 5 + ["12"] * 5 + ["40"]
    frame = spark.createDataFrame([row(f"{i:02d}", price=p) for i, p in enumerate(prices)], SALES_SCHEMA)
    assert [r.order_id for r in anomalies.price_anomalies(frame).collect()] == ["10"]
    assert anomalies.above_threshold(frame).count() == 1


def test_stored_scan_pushes_the_fifth_score_down(sales):
    plan = anomalies.high_revenue(sales, stored=True)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "revenue#" in text and "Subquery" in text
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("name", ["price_anomalies", "top_products", "regions", "summary"])
def test_no_plan_has_a_cross_join(sales, name):
    plan = {
        "price_anomalies": lambda: anomalies.price_anomalies(sales),
        "top_products": lambda: products.top_products(sales),
        "regions": lambda: regions.region_performance(sales, True),
        "summary": lambda: dashboard.summary(
            monthly.monthly_sales(sales), regions.region_performance(sales), products.top_products(sales)
        ),
    }[name]()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_summary(sales):
    tables = monthly.monthly_sales(sales), regions.region_performance(sales), products.top_products(sales)
    one = dashboard.summary(*tables).first()
    dated = [r for r in records() if r["sale_date"]]
    assert one.total_revenue == sum(r["revenue"] for r in dated)
    assert one.total_orders == len({(r["order_id"], r["sale_date"].month) for r in dated})
    assert (one.total_regions, one.top_products_count) == (4, 10)


def test_region_revenue_adds_up(sales):
    total = regions.region_performance(sales).agg(F.sum("total_revenue")).first()[0]
    assert total == sum(r["revenue"] for r in records() if r["region"])
    share = quality.check_share_total(regions.region_performance(sales)).first().total_market_share_pct
    assert 0 < share <= 100
    assert quality.check_months(monthly.monthly_sales(sales)).first().total_months == 3


def test_empty_fact(spark):
    none = spark.createDataFrame([], SALES_SCHEMA)
    frames = [monthly.monthly_sales(none), products.top_products(none), products.top_products_two_step(none)]
    frames += [regions.region_performance(none), discounts.category_discount_median(none)]
    frames += [anomalies.anomaly_records(none)]
    assert [f.count() for f in frames] == [0] * len(frames)
