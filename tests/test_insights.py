"""Rules, text parsing, validation, browsing and quantiles."""

from __future__ import annotations

import json
from datetime import datetime

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.fixtures import rows
from tradeloom.operators.quantiles import exact_quantiles
from tradeloom.params import Period, QueryParams
from tradeloom.plans import browse, insights

RECORD = """title string, observation string, recommendation string, priority string,
    comparison_type string, metrics array<string>"""
GOOD = ("t" * 20, "o" * 20, "r" * 20, "high", "self", ["a"])


@pytest.mark.parametrize(
    "own, platform, priority, comparison",
    [
        (30.01, 0.0, "high", "self"),
        (30.0, 0.0, "medium", "self"),
        (-31.0, None, "high", "self"),
        (15.0, 25.0, "low", "self"),
        (15.01, 25.01, "medium", "both"),
        (0.0, -50.01, "high", "benchmark"),
        (None, 50.0, "medium", "benchmark"),
        (None, None, "low", "self"),
    ],
)
def test_classification(spark, own, platform, priority, comparison):
    frame = spark.createDataFrame(
        [(own, platform)], "self_deviation_pct double, benchmark_deviation_pct double"
    )
    got = insights.classified(frame).first()
    assert (got.priority, got.comparison_type) == (priority, comparison)


def test_percentile_bands(spark):
    frame = spark.createDataFrame([(v,) for v in (0.0, 1.0, 2.0, 3.0, 4.0, None)], "v double")
    for name, value in zip(insights.BANDS, (1.0, 2.0, 3.0, 4.0)):
        frame = frame.withColumn(name, F.lit(value))
    got = [r[0] for r in frame.select(insights.percentile_band(F.col("v"))).collect()]
    assert got == ["below_p25", "p25_p50", "p50_p75", "p75_p90", "top_10_pct", None]


def test_scores_without_spread_are_missing(spark):
    frame = spark.createDataFrame([(5.0, 3.0, 0.0), (5.0, 3.0, 0.8)], "v double, m double, s double")
    got = frame.select(insights.z_score(F.col("v"), F.col("m"), F.col("s"))).collect()
    assert [r[0] for r in got] == [None, 2.5]


def test_seller_without_history_is_kept(spark):
    schema = """vendor_id int, total_sales double, units_sold double, average_order_value double,
        total_buyers bigint, repeat_buyers bigint, repeat_purchase_rate_pct double"""
    now = spark.createDataFrame([(1, 90.0, 9.0, 3.0, 2, 1, 50.0), (2, 10.0, 1.0, 1.0, 1, 0, 0.0)], schema)
    past = spark.createDataFrame([(1, 365.0, 9.0, 3.0, 2, 1, 50.0)], schema)
    found = insights.current_vs_history(now, past, "seller")
    assert rows(found, "entity_id", "has_historical_data") == [(1, True), (2, False)]
    sales = F.col("metric") == "total_sales"
    assert rows(insights.metric_rows(found, "seller").filter(sales), "entity_id", "own_past") == [
        (1, 365.0),
        (2, None),
    ]
    scale = insights.history_scale(Period.of("2024-01-01", "2024-01-10"), Period.of("2024-01-01", "2024-04-09"), True)
    scaled = insights.metric_rows(found, "seller", scale)
    assert rows(scaled.filter(sales & F.col("own_past").isNotNull()), "own_past") == [(36.5,)]
    average = F.col("metric") == "average_order_value"
    assert rows(scaled.filter(average & (F.col("entity_id") == 1)), "own_past") == [(3.0,)]


@pytest.mark.parametrize(
    "change, reason",
    [
        ({}, None),
        ({0: "t" * 9}, "title length"),
        ({0: "t" * 10}, None),
        ({0: "t" * 100}, None),
        ({0: "t" * 101}, "title length"),
        ({0: None}, "missing title"),
        ({0: ""}, "missing title"),
        ({1: "o" * 19}, "observation length"),
        ({2: "r" * 19}, "recommendation length"),
        ({2: None}, "missing recommendation"),
        ({3: "urgent"}, "unknown priority"),
        ({3: None}, "missing priority"),
        ({4: "trend"}, "unknown comparison_type"),
        ({5: list("abcde")}, None),
        ({5: list("abcdef")}, "too many metrics"),
        ({5: None}, None),
    ],
)
def test_validation(spark, change, reason):
    record = tuple(change.get(i, value) for i, value in enumerate(GOOD))
    frame = spark.createDataFrame([record], RECORD)
    assert insights.validate_insights(frame).first().reject_reason == reason
    assert insights.valid_insights(frame).count() == (reason is None)


def test_parsing(spark):
    text = json.dumps({"insights": [{"title": "one", "metrics": ["a"]}, {"title": "two"}]})
    texts = {
        1: text,
        2: f"```json\n{text}\n```",
        3: f"  ```\n{text}\n``` and more",
        4: "no json at all",
        5: text[:-3],
        6: '{"other": 1}',
        7: '{"insights": []}',
    }
    frame = spark.createDataFrame(list(texts.items()), "id int, response string")
    got = rows(insights.parse_insights(frame, "response"), "id", "position", "title", "metrics")
    assert got == [(i, p, t, m) for i in (1, 2, 3) for p, t, m in ((0, "one", ["a"]), (1, "two", None))]


def documents(spark):
    def insight(n, priority, kind):
        return (f"title {n}", "", "", priority, kind, [])

    docs = [
        ("buyer", 1, datetime(2024, 1, 1), [insight(0, "low", "self")], 1, 0),
        (
            "buyer",
            1,
            datetime(2024, 2, 1),
            [
                insight(0, "low", "self"),
                insight(1, "odd", "both"),
                insight(2, "high", "both"),
                insight(3, "medium", "self"),
            ],
            4,
            1,
        ),
        ("seller", 1, datetime(2024, 1, 5), [], 0, 0),
    ]
    return spark.createDataFrame(
        docs,
        f"""entity_type string, entity_id int, generated_at timestamp, insights array<struct<
            title:string,observation:string,recommendation:string,priority:string,comparison_type:string,
            metrics:array<string>>>, insights_count int, high_priority_count int""",
    )


def test_browsing(spark):
    docs = documents(spark)
    newest = browse.latest_per_entity(docs)
    assert rows(newest, "entity_type", "insights_count") == [("buyer", 4), ("seller", 0)]
    assert browse.filter_documents(docs, "Sellers").count() == 1
    assert browse.filter_documents(docs).count() == 3
    ordered = browse.order_insights(browse.insight_rows(browse.filter_documents(newest, "Buyers"))).collect()
    assert [r.title for r in ordered] == ["title 2", "title 1", "title 3", "title 0"]
    shown = browse.filter_insights(browse.insight_rows(newest), "All", "Combined")
    assert rows(shown, "title") == [("title 1",), ("title 2",)]
    assert browse.filter_insights(browse.insight_rows(newest), "High", "Historical").isEmpty()
    assert rows(browse.browse_overview(docs)) == [(3, 5, 1, 1.7)]
    assert rows(browse.browse_overview(docs.filter("false"))) == [(0, 0, 0, 0.0)]
    counts = browse.insight_counts(newest).filter("entity_type = 'buyer'").first()
    assert (counts.high_count, counts.medium_count, counts.low_count, counts.both_count) == (1, 1, 1, 2)


def test_documents_keep_the_best_insights(spark):
    deviating = spark.createDataFrame(
        [
            ("buyer", 1, True, f"m{i}", f"Metric {i}", 1.0, 1.0, 1.0, float(i * 10), None)
            for i in range(8)
        ],
        """entity_type string, entity_id int, has_historical_data boolean, metric string, label string,
           current_value double, own_past double, platform_median double, self_deviation_pct double,
           benchmark_deviation_pct double""",
    )
    top = insights.top_insights(insights.classified(deviating))
    docs = insights.insight_documents(
        insights.valid_insights(insights.insight_records(top)),
        QueryParams(Period.of("2024-01-01", "2024-03-31")),
        datetime(2024, 4, 1),
    )
    doc = docs.first()
    assert [i.metrics for i in doc.insights] == [[f"m{i}"] for i in (7, 6, 5, 4, 3, 2)]
    assert (doc.insights_count, doc.high_priority_count, doc.comparison_types["self"]) == (6, 4, 6)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60), st.sampled_from([1, 7]))
def test_quantiles_equal_linear_interpolation(spark, values, copies):
    wanted = [0.0, 0.25, 0.5, 0.9, 1.0]
    data = [("g", float(v)) for v in values] + [("h", 3.0)] * copies
    frame = spark.createDataFrame(data, "g string, v double")
    got = {(r.g, r.probability): r.quantile for r in exact_quantiles(frame, "g", "v", wanted).collect()}
    expected = {("g", p): np.percentile(values, p * 100) for p in wanted} | {("h", p): 3.0 for p in wanted}
    assert got == pytest.approx(expected)


def test_quantiles_where_one_value_is_most_rows(spark):
    frame = spark.range(3000).select(
        F.lit("g").alias("g"), F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("id") * 1.5).alias("v")
    )
    values = [0.0 if i % 3 == 0 else i * 1.5 for i in range(3000)]
    wanted = [0.1, 0.33, 0.34, 0.5, 0.999]
    got = {r.probability: r.quantile for r in exact_quantiles(frame, "g", "v", wanted).collect()}
    assert got == pytest.approx({p: np.percentile(values, p * 100) for p in wanted})


@pytest.mark.parametrize("steps, few", [(2, 1), (16, 3), (4096, 1), (4096, 65_536)])
def test_quantiles_by_any_steps(spark, steps, few):
    """Ties, negatives, one group with most rows, values far apart, and a range beyond the largest double."""
    groups = {
        "most": [float((i * 7919) % 257 - 100) / 4 for i in range(3000)],
        "far": [0.0, 1e-300, 2e-300, 5e-324, 1.0, 1e300, -1e300, 3.5, 3.5],
        "wide": [-1.7e308, 1.7e308, 0.0, 12.0],
        "one": [2.25],
        "same": [-7.0] * 50,
    }
    data = [(g, v) for g, values in groups.items() for v in values] + [("most", None), ("none", None)]
    frame = spark.createDataFrame(data, "g string, v double").repartition(5)
    wanted = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = exact_quantiles(frame, "g", "v", wanted, steps, few)
    assert "rangepartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    got = {(r.g, r.probability): r.quantile for r in found.collect()}

    def plain(values, p):
        at = p * (len(values) - 1)
        low, part = int(at // 1), at % 1
        ordered = sorted(values)
        return ordered[low] * (1 - part) + (ordered[low + 1] * part if part else 0.0)

    assert got == pytest.approx({(g, p): plain(v, p) for g, v in groups.items() for p in wanted}, rel=1e-12, abs=0)


def test_the_deviation_does_not_depend_on_order(spark):
    from tradeloom.plans.benchmarks import platform_benchmarks

    rows = [(i, 1e11 + i / 4, i % 3) for i in range(50)]
    schema = "vendor_id int, total_sales double, total_buyers bigint"
    found = {
        platform_benchmarks(spark.createDataFrame(order, schema).repartition(n), "seller").first().std_period_spend
        for order, n in ((rows, 1), (rows[::-1], 7))
    }
    assert found == {round(float(np.std([i / 4 for i in range(50)])), 4)}
