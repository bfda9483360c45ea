"""Dates move alike for a person, differently between people and keys, and intervals stay."""

from __future__ import annotations

import datetime as dt
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from caremeld.plans import limited as L

DAY = dt.date(2010, 5, 1)


@pytest.fixture(scope="module")
def person(spark):
    return spark.range(1, 2001).select(F.col("id").alias("person_id"), F.lit("S").alias("person_source_value"), F.lit(DAY).alias("birth_datetime"))


def days_of(person, key, days=L.DAYS):
    return {r.person_id: r.shift_days for r in L.person_shifts(person, key, days).collect()}


@pytest.mark.parametrize("key", ["k", "a longer key, of more than one block, which is hashed before it is used as the others are" * 2])
def test_is_the_keyed_hash_of_the_id(person, key):
    shifts = days_of(person, key)
    for i in (1, 2, 1999):
        n = int(hmac.new(key.encode(), str(i).encode(), hashlib.sha256).hexdigest()[:15], 16) % (2 * L.DAYS)
        assert shifts[i] == (n - L.DAYS if n < L.DAYS else n - L.DAYS + 1)


def test_spread_and_keys(person):
    one, two = days_of(person, "one"), days_of(person, "two")
    assert one == days_of(person, "one") and len(one) == 2000
    assert sum(one[i] == two[i] for i in one) < 20
    assert 0 not in one.values() and min(one.values()) >= -L.DAYS and max(one.values()) <= L.DAYS
    assert len(set(one.values())) > 600 and abs(sum(one.values()) / 2000) < 25
    ids = sorted(one)
    mean = sum(one.values()) / 2000
    along = sum((one[i] - mean) * (i - 1000.5) for i in ids)
    scale = (sum((one[i] - mean) ** 2 for i in ids) * sum((i - 1000.5) ** 2 for i in ids)) ** 0.5
    assert abs(along / scale) < 0.08  # the id says nothing about the days
    assert set(days_of(person, "one", 1).values()) == {-1, 1}


def test_all_dates_of_all_tables_move_alike(spark, person):
    visits = spark.createDataFrame(
        [(1, DAY, DAY + dt.timedelta(3), dt.datetime(2010, 5, 1, 8)), (1, None, DAY, None), (2, DAY, None, None), (9999, DAY, DAY, None), (None, DAY, DAY, None)],
        "person_id long, start date, end date, at timestamp",
    )
    deaths = spark.createDataFrame([(1, DAY, "x"), (2, DAY, "y")], "person_id long, death_date date, _days string")
    plain = spark.createDataFrame([(1,)], "other long")
    shifts = L.person_shifts(person, "key")
    out = L.limited_tables({"visit": visits, "death": deaths.drop("_days"), "person": person, "none": plain}, shifts)
    assert set(out) == {"visit", "death", "person"}
    days = days_of(person, "key")
    moved = lambda i, d: d and d + dt.timedelta(days[i])
    rows = {tuple(r) for r in out["visit"].collect()}
    assert rows == {
        (1, moved(1, DAY), moved(1, DAY + dt.timedelta(3)), moved(1, dt.datetime(2010, 5, 1, 8))), (1, None, moved(1, DAY), None), (2, moved(2, DAY), None, None),
    }
    assert {tuple(r) for r in out["death"].collect()} == {(i, moved(i, DAY)) for i in (1, 2)}
    assert out["person"].columns == ["person_id", "birth_datetime"]
    assert {r.birth_datetime for r in out["person"].where("person_id = 2").collect()} == {moved(2, DAY)}


def test_an_empty_key_is_refused(person):
    with pytest.raises(ValueError):
        L.person_shifts(person, "")


def test_later_plans_do_not_hold_the_key(spark, person, tmp_path):
    path = str(tmp_path / "shifts")
    L.person_shifts(person, "secret key").write.parquet(path)
    plan = L.shifted(person, spark.read.parquet(path))._jdf.queryExecution().toString().lower()
    assert all(k.hex()[:40] not in plan for k in L.padded(b"secret key")) and "secret" not in plan


def test_facts_are_not_shuffled_for_small_shifts(spark, person):
    facts = spark.range(1000).select(F.col("id").alias("person_id"), F.lit(DAY).alias("day"))
    plan = L.limited_tables({"facts": facts}, L.person_shifts(person, "k"))["facts"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    large = L.limited_tables({"facts": facts}, L.person_shifts(person, "k"), broadcast_bytes=0)["facts"]
    assert large.count() == 999
