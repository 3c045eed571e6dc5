"""Two-level numbering and selection by digits equal the single-task window results."""

import datetime as dt
import random
import statistics

from pyspark.sql import Window
from pyspark.sql import functions as F

from marginflow.operators import ranking
from marginflow.operators.ranking import median_by_digits, number_by_day


def _skewed(spark, n=3000, seed=7, days=50, hot_days=50):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0  # one group holds a third of the rows
        day = rnd.randint(0, hot_days if hot else days)
        rows.append(("hot" if hot else f"g{rnd.randint(0, 40)}", dt.date(2025, 1, 1) + dt.timedelta(days=day), f"id{rnd.randint(0, 9)}{i:05d}"))
    return spark.createDataFrame(rows, "g string, d date, id string").repartition(7)


def _window_numbers(df):
    return df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("d", "id")))


def test_numbers_match_row_number(spark):
    for hot_days in (50, 0, 1):  # with 0 and 1 a day of the hot group is hot by itself and is cut by ids
        df = _skewed(spark, hot_days=hot_days)
        ours = dict(number_by_day(df, "g", "d", "id", "rn").select("id", "rn").collect())
        assert len(ours) == 3000 and ours == dict(_window_numbers(df).select("id", "rn").collect())


def test_ids_of_any_form(spark):
    day = dt.date(2025, 1, 1)
    ids = [f"O{i}" for i in range(700)] + [f"O{i:012d}" for i in range(700)] + ["a" * k for k in range(1, 300)] + ["é", "日本", ""]
    df = spark.createDataFrame([("g", day, i) for i in ids] + [(None, day, "none")], "g string, d date, id string")
    ours = dict(number_by_day(df, "g", "d", "id", "rn").select("id", "rn").collect())
    assert ours == {i: n for n, i in enumerate(sorted(ids, key=lambda x: x.encode()), 1)}


def test_hot_day_is_cut_into_ranges(spark):
    """No window partition of the numbering holds the hot day."""
    day = dt.date(2025, 1, 1)
    df = spark.range(8000).select(
        F.when(F.col("id") < 4000, "hot").otherwise(F.format_string("g%d", F.col("id"))).alias("g"),
        F.lit(day).alias("d"), F.format_string("O%012d", F.col("id")).alias("id"))
    shared = ranking._shared_start(F.lit("O000000000000"), F.lit("O000000003999"))
    assert spark.range(1).select(shared).first()[0] == 9
    numbered = number_by_day(df, "g", "d", "id", "rn")
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "_range" in plan.split("row_number()")[1]
    assert numbered.where("g = 'hot'").agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first()[:] == (1, 4000, 4000)


def test_numbering_neither_samples_nor_writes(spark):
    plan = number_by_day(_skewed(spark), "g", "d", "id", "rn")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Scan parquet" not in plan


def test_within_days_of_the_first(spark):
    df = _skewed(spark)
    got = number_by_day(df, "g", "d", "id", "rn", within=10)
    first = df.groupBy("g").agg(F.min("d").alias("f"))
    want = _window_numbers(df.join(first, "g").where(F.col("d") < F.date_add("f", 10)))
    assert sorted(map(tuple, got.select("id", "first_day", "rn").collect())) == sorted(map(tuple, want.select("id", "f", "rn").collect()))


def test_purchase_number_with_hot_customer(spark):
    from frames import orders
    from marginflow.operators import customer

    rows = []
    n = 0
    for i in range(600):  # C0 holds a third of all orders, many on the same days
        n += 1
        rows.append((f"O{n:05d}", "C0", "P0", dt.date(2025, 1, 1) + dt.timedelta(days=i % 120), "LV", "CRM",
                     "completed", 1, 1))
    for c in range(1, 400):
        for k in range(3):
            n += 1
            rows.append((f"O{n:05d}", f"C{c}", f"P{c}", dt.date(2025, 1, 1) + dt.timedelta(days=7 * k + c % 5),
                         "EE", "CRM", "completed", 1, 1))
    o = orders(spark, rows)
    got = customer.customer_orders_90d(o).select("order_id", "purchase_number")
    w = Window.partitionBy("customer_id").orderBy("order_date", "order_id")
    first = o.groupBy("customer_id").agg(F.min("order_date").alias("acq"))
    ref = (o.join(first, "customer_id").where(F.col("order_date") < F.date_add("acq", 90))
           .select("order_id", F.row_number().over(w).alias("purchase_number")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))
    assert got.count() == 450 + 399 * 3


def _middles(df):
    return {r.g: (r.low, r.high) for r in median_by_digits(df, ["g"], "v", "n").collect()}


def test_median_of_counted_values(spark):
    rnd = random.Random(3)
    groups = {}
    for g in ("hot", "a", "b", None):
        size = 1 << rnd.randint(18, 45)
        groups[g] = {rnd.randint(-size, size): rnd.randint(1, 4) for _ in range(4000 if g == "hot" else 7)}
    rows = [(g, v, n) for g, counts in groups.items() for v, n in counts.items()]
    df = spark.createDataFrame([*rows, ("a", None, 50), ("none", None, 3), ("b", 1, 0)], "g string, v long, n long").repartition(5)
    want = {}
    for g, counts in groups.items():
        every = [v for v, n in counts.items() for _ in range(n)]
        want[g] = (statistics.median_low(every), statistics.median_high(every))
    assert _middles(df) == want


def test_median_of_a_hot_group_with_millions_of_values(spark):
    """Two million distinct values of one group: counts of parts meet, values of one part at most."""
    df = spark.range(2_000_000).select(F.lit("hot").alias("g"), (F.col("id") * 7 - 3_000_000).alias("v"), F.lit(1).alias("n"))
    assert _middles(df) == {"hot": (999_999 * 7 - 3_000_000, 1_000_000 * 7 - 3_000_000)}
    plan = median_by_digits(df, ["g"], "v", "n")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_cohort_has_no_window_over_a_cohort(spark):
    from conftest import SMOKE
    from marginflow.operators import customer
    from marginflow.plans.warehouse import warehouse

    orders = warehouse(spark, SMOKE).orders
    plan = customer.cohort_profitability_90d(orders)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" not in plan and "customer_id" not in plan  # reads counted margins alone
