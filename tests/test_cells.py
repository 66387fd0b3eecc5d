"""Joins whose pairs far outnumber their rows: the pairs, where they are made, and what is moved for them."""
import random

from pyspark.sql import functions as F

from fieldlens.operators.joins import join_hot_keys
from fieldlens.plans import projects


def test_cells_make_every_pair_once(spark):
    rng = random.Random(7)
    a = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice(["x", "x", None]), rng.randint(0, 9)) for _ in range(90)]
    b = [(rng.choice([1, 1, 2, 4, None]), rng.choice(["x", "y", None]), rng.randint(0, 9)) for _ in range(70)]
    left, right = spark.createDataFrame(a, "k int, s string, l int"), spark.createDataFrame(b, "k int, s string, r int")
    want = sorted((k, s, l, r) for k, s, l in a for k2, s2, r in b if None not in (k, s) and (k, s) == (k2, s2))
    for cell in (1, 4, 4096):
        got = sorted(map(tuple, join_hot_keys(left, right, ["k", "s"], cell).select("k", "s", "l", "r").collect()))
        assert got == want and len(want) > 100


def test_no_task_makes_all_rows_of_a_hot_scope(spark):
    d = spark.range(100_000).selectExpr("id", "'monthly' AS recurrence", "'Global' AS scope", "cast(null AS string) AS scope_data", "date'2024-01-31' AS start_date",
                                       "date'2024-12-31' AS end_date", "cast(null AS int) AS cycle_index", "cast(null AS date) AS cycle_end_date")
    sites = spark.range(8).selectExpr("concat('S', id) AS site", "'Z' AS zone", "'A' AS state", "'T' AS store_type")
    none = spark.createDataFrame([], "project_id long, cycle_index int")
    rows = projects.project_skeleton(d, sites, none)[0]
    made = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(made) == 800_000 and len(made) > 2 and max(made) < 600_000


def test_gathered_values_keep_nulls_and_repeats(spark):
    rng = random.Random(8)
    a = [(rng.choice([1, 1, 1, 2, None]), rng.choice([0, 1, 1, 2, None])) for _ in range(60)]
    b = [(rng.choice([1, 1, 2, 4, None]), rng.choice(["p", "q"]), rng.choice([3, 4, 4, None])) for _ in range(70)]
    left, right = spark.createDataFrame(a, "k int, l int"), spark.createDataFrame(b, "k int, s string, `r r` int")
    as_text = lambda rows: sorted(map(str, rows))
    want = as_text((k, l, s, r) for k, l in a for k2, s, r in b if k is not None and k == k2)
    for cell in (1, 4, 4096):
        met = join_hot_keys(left, right, ["k"], cell, gather="r r")
        assert as_text(map(tuple, met.select("k", "l", "s", F.explode("r r")).collect())) == want and len(want) > 100
    assert met.count() < len(want) / 5


def rows_of_joins(df) -> int:
    """Rows made by the joins of the executed plan."""
    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().get("numOutputRows").get().value() if "Join" in kind else 0
        return own + sum(walk(node.children().apply(i)) for i in range(node.children().size()))
    return walk(df._jdf.queryExecution().executedPlan())


def test_rows_of_a_hot_scope_are_not_made_by_the_join(spark):
    """The join makes a row for each project and cell; the rows, NULL and repeated sites included, come from its arrays."""
    d = spark.range(500).selectExpr("id", "'monthly' AS recurrence", "'Global' AS scope", "cast(null AS string) AS scope_data", "date'2024-01-31' AS start_date",
                                    "date'2024-12-31' AS end_date", "cast(null AS int) AS cycle_index", "cast(null AS date) AS cycle_end_date")
    sites = spark.range(300).selectExpr("if(id = 7, null, concat('S', id div 2)) AS site", "'Z' AS zone", "'A' AS state", "'T' AS store_type")
    rows = projects.project_skeleton(d, sites, spark.createDataFrame([], "project_id long, cycle_index int"))[0]
    got = rows.groupBy("site").count()
    found = {r["site"]: r["count"] for r in got.collect()}
    assert found == {None: 500, "S3": 500} | {f"S{i}": 1000 for i in range(150) if i != 3}
    assert rows_of_joins(got) < 10_000
