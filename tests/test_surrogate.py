from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from unittest.mock import Mock

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from caremeld.operators import surrogate
from caremeld.operators.surrogate import assign_surrogate_id
from caremeld.session import intermediates, shared_folder
from tests.conftest import rows


@pytest.fixture(scope="module")
def events(spark):
    """Over half of the dates are NULL, a third of the rows are one group of copies, and one person has most rows."""
    mixed = spark.range(0, 4000, 1, 6).select(
        F.when(F.col("id") % 9 < 4, F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 40).cast("int"))).alias("day"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("person"),
        F.concat(F.lit("v"), (F.col("id") % 11).cast("string")).alias("value"),
    )
    copies = spark.range(0, 2000, 1, 6).select(
        F.lit(None).cast("date").alias("day"), F.lit(7).cast("long").alias("person"), F.lit("same").alias("value")
    )
    return mixed.unionByName(copies)


@pytest.mark.parametrize("partitions", [None, 1, 2, 8, 37])
def test_equals_a_global_row_number(events, partitions):
    order = [F.col(c).asc_nulls_last() for c in ("day", "person", "value")]
    expected = events.withColumn("id", F.row_number().over(Window.orderBy(*order)).cast("long"))
    ours = assign_surrogate_id(events, "id", ["day"], partitions).select(expected.columns)
    assert ours.exceptAll(expected).isEmpty() and expected.exceptAll(ours).isEmpty()


def test_a_group_of_copies_is_split(events):
    copies = events.filter("value = 'same'").withColumn("_mark", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_last() for c in ("day", "person", "value", "_mark")]
    sizes = surrogate._sizes(surrogate._placed(copies, keys, [F.col("value")], 6, "copies"))
    assert [part for part, _ in sizes] == list(range(6)) and max(n for _, n in sizes) < 2000 / 3
    numbered = assign_surrogate_id(copies.drop("_mark"), "id", ["day"], 6)
    assert numbered.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first()[:] == (1, 2000, 2000)


def test_bounds_are_left_to_spark(events):
    """No range bound and no sampled key is in the plan, however many ranges there are."""
    plans = [assign_surrogate_id(events, "id", ["day"], n)._jdf.queryExecution().analyzed().toString() for n in (4, 64)]
    assert len(plans[1]) < len(plans[0]) * 1.2


def test_the_rows_are_worked_out_once(spark, events):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(value):
        seen.add(1)
        return value

    numbered = assign_surrogate_id(events.withColumn("value", noted("value")), "id", ["day"], 8)
    assert numbered.count() == 6000 and numbered.agg(F.max("id")).first()[0] == 6000
    assert seen.value == 6000


def test_ids_stay_the_same_when_read_again(events):
    numbered = assign_surrogate_id(events, "id", ["day"], 8)
    assert numbered.exceptAll(numbered.repartition(3)).isEmpty()


def test_order_column_can_be_dropped(spark):
    data = spark.createDataFrame([("b", 1), ("a", 2)], "name string, v long")
    assert rows(assign_surrogate_id(data, "id", ["name"], drop=("name",))) == [(1, 2), (2, 1)]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "name string")
    assert assign_surrogate_id(empty, "id", ["name"]).collect() == []


def test_no_task_gathers_all_rows(spark, events):
    plan = assign_surrogate_id(events, "id", ["day"], 8)._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


def test_a_cluster_without_a_shared_folder_is_refused():
    cluster = Mock()
    cluster.conf.get.return_value = None
    cluster.sparkContext.getConf.return_value.get.return_value = None
    cluster.sparkContext.master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(cluster)
    cluster.conf.get.return_value = "s3://bucket/shared/"
    assert shared_folder(cluster) == "s3://bucket/shared"


def test_a_run_removes_its_own_intermediates_only(spark):
    first = assign_surrogate_id(spark.range(3).toDF("v"), "id", ["v"])
    with intermediates(spark):
        second = assign_surrogate_id(spark.range(3).toDF("v"), "id", ["v"])
        assert second.count() == 3
        with ThreadPoolExecutor(1) as pool:
            third = pool.submit(copy_context().run, assign_surrogate_id, spark.range(4).toDF("v"), "id", ["v"]).result()
    assert first.count() == 3
    for gone in (second, third):
        with pytest.raises(Exception):
            gone.collect()


def test_written_below_the_folder_the_session_names(spark, events):
    folder = shared_folder(spark)
    numbered = assign_surrogate_id(events, "id", ["day"], 2)
    assert all(folder in file for file in numbered.inputFiles())
