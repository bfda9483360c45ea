"""What the queries read is built in parts that do not grow with the tables."""

from __future__ import annotations

import glob
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from caremeld.plans.layers import STEPS, TABLE_LAYERS
from verification import queries as Q
from verification.projection import RAW_SQL, RawTables

FLAGS = ["A", "N", "R", "", None]


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    """Lines and orders with repeated, absent and null keys, of every source and flag."""
    folder = str(tmp_path_factory.mktemp("given"))
    n = 600
    orders = [i // 2 if i % 11 else None for i in range(n)]
    lines = {
        "l_orderkey": [i % 320 if i % 13 else None for i in range(n)], "l_partkey": [i % 70 if i % 17 else None for i in range(n)],
        "l_suppkey": [i % 9 for i in range(n)], "l_linenumber": [i % 4 for i in range(n)], "l_quantity": [float(i % 50) for i in range(n)],
        "l_returnflag": [FLAGS[i % 5] for i in range(n)], "l_linestatus": ["O" if i % 2 else None for i in range(n)],
    }
    days = pa.array([i * 86_400_000_000 if i % 19 else None for i in range(n)], pa.timestamp("us"))
    pq.write_table(pa.table(lines).append_column("l_shipdate", days), f"{folder}/lineitem.parquet")
    others = {"o_custkey": [i % 50 if i % 7 else None for i in range(n)], "o_orderpriority": ["1-URGENT"] * n}
    pq.write_table(pa.table({"o_orderkey": orders, **others}).append_column("o_orderdate", days), f"{folder}/orders.parquet")
    pq.write_table(pa.table({"c_custkey": [0, 3], "c_nationkey": [1, 2], "c_mktsegment": ["BUILDING", None]}), f"{folder}/customer.parquet")
    return folder


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n, sql in RAW_SQL.items() if "{lineitem}" in sql])
def test_lines_are_joined_with_their_orders_once(spark, given, tmp_path, name):
    whole, once = RawTables(spark, given)[name], RawTables(spark, given, str(tmp_path / "lines"))[name]
    assert "Join" in plan(whole) and "Join" not in plan(once)
    assert once.schema == whole.schema and whole.count() > 0
    assert once.exceptAll(whole).isEmpty() and whole.exceptAll(once).isEmpty()


def test_every_table_is_built_in_one_step():
    assert sorted(t for step in STEPS for t in step) == sorted(t for tables in TABLE_LAYERS.values() for t in tables)


@pytest.mark.parametrize("size", [2_000, 1 << 20])
def test_arriving_files_are_of_bounded_size(spark, given, size):
    """Twice as many bytes arrive in twice as many files, and in two batches all the same."""
    feed, columns, folder, parts = Q.arrivals(spark, given, "stg_synthea_encounters", size)
    assert parts == max(2, -(-os.path.getsize(f"{given}/orders.parquet") // size))
    assert len(glob.glob(f"{folder}/all/part-*")) == parts
    Q.taken(spark, feed, columns, folder, parts)
    assert spark.read.parquet(feed.place("reports")).select("batch").distinct().count() == 2
    raw = RawTables(spark, given)["synthea__encounters"].na.fill("")
    landed = Q.validation.rows(spark, feed, columns)
    assert landed.count() == raw.count() and landed.exceptAll(raw).isEmpty()


def test_the_task_that_writes_a_part_file_works_out_nothing(spark, given, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(Q, "write_flat", lambda df, path, real=Q.write_flat: (seen.append(plan(df)), real(df, path)))
    rows = RawTables(spark, given)["synthea__conditions"]
    Q.put_part(spark, rows, str(tmp_path / "conditions.csv"), 3)
    assert "Coalesce" not in seen[0] and "Exchange SinglePartition" in seen[0]
    assert os.listdir(tmp_path / "conditions.csv") and spark.read.csv(str(tmp_path / "conditions.csv"), header=True).count() == rows.count()
