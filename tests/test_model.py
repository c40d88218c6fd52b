"""Filter context: propagation in one direction, paths, grain, blank members."""
import pytest
from pyspark.sql import functions as F

from tillroll.plans.model import Measure, Model, ModelError, Relationship
from tillroll.plans.semantic import _sum, dim_date_between


@pytest.fixture(scope="module")
def model(spark):
    sales = spark.createDataFrame(
        [("1995-02", "N", "a", 10.0, 1, 2.0, 1), ("1995-03", "N", "a", 20.0, 1, 5.0, 2),
         ("1995-11", "S", "a", 5.0, 1, 1.0, 1), ("1996-02", "N", "b", 40.0, 1, 8.0, 4),
         ("1996-12", "S", "b", 7.0, 1, 1.0, 1), (None, "N", "a", 3.0, 1, 1.0, 1), ("1990-01", "S", "a", 2.0, 1, 1.0, 1)],
        "month string, region string, category string, revenue double, units bigint, gross_margin double, "
        "transactions bigint")
    stores = spark.createDataFrame([("S1", "Mall", "N", 30.0, 3.0, 2), ("S2", "Mall", "S", 50.0, 3.0, 2)],
                                   "store_id string, store_format string, region string, revenue double, "
                                   "gross_margin double, transactions bigint")
    bounds = spark.createDataFrame([("1995-01-01", "1996-12-31")], "lo string, hi string") \
        .select(F.to_date("lo").alias("lo"), F.to_date("hi").alias("hi"))
    return Model({"fact_sales": sales, "fact_store_performance": stores, "dim_date": dim_date_between(bounds)})


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_filter_goes_from_the_date_to_the_fact(model):
    df = model.evaluate(["total_revenue"], ["dim_date.quarter"], {"dim_date.year": lambda y: y == 1995})
    assert df.columns == ["dim_date.quarter", "total_revenue"]
    assert got(df) == [("Q1", 30.0), ("Q4", 5.0)]


def test_rows_without_a_date_group_under_the_blank_member(model):
    assert got(model.evaluate(["total_revenue"], ["dim_date.year"])) == [(1995, 35.0), (1996, 47.0), (None, 5.0)]
    assert got(model.evaluate(["total_revenue"])) == [(87.0,)]


def test_a_filter_on_days_passes_on_their_months(model):
    day = {"dim_date.date": lambda d: d == F.lit("1995-03-31").cast("date")}
    assert got(model.evaluate(["total_revenue"], where=day)) == [(20.0,)]
    with pytest.raises(ModelError, match="does not determine"):
        model.evaluate(["total_revenue"], ["dim_date.date"])


def test_filters_do_not_go_back_nor_across(model):
    both = model.evaluate(["total_revenue", "avg_revenue_per_store"], where={
        "dim_date.year": lambda y: y == 1996, "fact_sales.region": lambda r: r == "N"})
    assert got(both) == [(40.0, 40.0)]  # the stores keep all their revenue
    with pytest.raises(ModelError, match="no path"):
        model.evaluate(["avg_revenue_per_store"], ["dim_date.year"])


def test_prior_year_moves_with_the_context(model):
    df = model.evaluate(["yoy_revenue_growth"], ["dim_date.quarter"], {"dim_date.year": lambda y: y == 1996})
    assert got(df) == [("Q1", 40.0, 30.0, 10 / 30), ("Q4", 7.0, 5.0, 2 / 5)]
    by_region = model.evaluate(["yoy_revenue_growth", "total_revenue"], ["fact_sales.region"],
                               {"dim_date.quarter": lambda q: q == "Q1", "dim_date.year": lambda y: y == 1996})
    assert got(by_region) == [("N", 40.0, 30.0, 10 / 30, 40.0)]
    first = model.evaluate(["yoy_revenue_growth"], ["dim_date.year"])
    assert got(first) == [(1995, 35.0, None, None), (1996, 47.0, 35.0, 12 / 35)]


def test_no_fan_out_and_one_pass(model):
    plan = model.evaluate(["total_revenue", "gross_margin_pct"], ["dim_date.quarter"]) \
        ._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and plan.count("LogicalRDD") + plan.count("LocalRelation") <= 2


def test_perspectives_hide_tables(model):
    view = model.view("StoreOperations")
    assert set(view.tables) == {"fact_store_performance", "dim_date"} and not view.relationships
    with pytest.raises(ModelError, match="unknown measures"):
        view.evaluate(["total_revenue"])
    with pytest.raises(ModelError, match="unknown column"):
        view.evaluate(["avg_revenue_per_store"], ["fact_sales.region"])


def test_chains_and_ambiguous_paths(spark):
    line = spark.createDataFrame([("p1", 5.0), ("p2", 7.0), ("p9", 1.0)], "product string, revenue double")
    product = spark.createDataFrame([("p1", "c1"), ("p2", "c2")], "product string, category string")
    category = spark.createDataFrame([("c1", "food"), ("c2", "home")], "category string, area string")
    steps = [Relationship("line", "product", "product", "product"), Relationship("product", "category", "category", "category")]
    m = Model({"line": line, "product": product, "category": category}, steps,
              {"rev": Measure("line", lambda: _sum("revenue"))})
    assert got(m.evaluate(["rev"], ["category.area"])) == [("food", 5.0), ("home", 7.0), (None, 1.0)]
    assert got(m.evaluate(["rev"], where={"category.area": lambda a: a == "home"})) == [(7.0,)]
    m.relationships.append(Relationship("line", "product", "category", "category"))
    with pytest.raises(ModelError, match="2 paths"):
        m.evaluate(["rev"], ["category.area"])
