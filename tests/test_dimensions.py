"""Dimensions merged batch by batch against those built from all lines."""

from __future__ import annotations

import datetime as dt
import itertools

import pytest
from row_sets import rows
from pyspark.sql import functions as F

from ledgerline.operators import cleaning, dimensions, normalize
from ledgerline.plans import jobs
from ledgerline.registry.queries import dirty
from ledgerline.sources.retail import StarTables, inject_faults, order_lines
from test_normalize_audits import DAY, line, lines

BUILD = {"customers": normalize.customers, "products": normalize.products, "orders": normalize.order_headers}


@pytest.fixture(scope="module")
def clean(spark, small):
    return inject_faults(order_lines(StarTables(spark, small))).where("order_id % 5 < 2").cache()


@pytest.mark.parametrize("name", BUILD)
def test_merging_states_is_building_from_all_lines(clean, name):
    dimension = jobs.DIMENSIONS[name]
    parts = [clean.where(F.pmod(F.xxhash64("order_id", "product_id"), F.lit(3)) == k) for k in range(3)]
    states = [dimensions.state_of(p, dimension) for p in (parts[2], parts[0], parts[1], parts[0])]
    assert rows(dimensions.rows_of(dimensions.merged(states, dimension), dimension)) == rows(BUILD[name](clean))


def test_batches_in_any_order_and_repeated(spark, tmp_path):
    day = lambda k: DAY + dt.timedelta(k)
    batches = [
        [line("o2", "p1", name="Ann", day=day(1)), line("o3", "p1", "c2", "Bo", day=day(1)), line("o3", "p2", None, "lost", day=day(1))],
        [line("o1", "p2", name="Guest Customer", day=day(0))],
        [line("o9", "p9", name="Late", day=day(9)), line("o1", "p1", name=None, day=day(0))],
    ]
    whole = lines(spark, [r for b in batches for r in b])
    for k, order in enumerate([*itertools.permutations(range(3))][::2]):
        path = str(tmp_path / str(k))
        for b in (*order, order[0]):
            jobs.add_lines(spark, lines(spark, batches[b]), path)
        for name, build in BUILD.items() if k == 0 else [("customers", normalize.customers)]:
            assert rows(jobs.dimension(spark, path, name)) == rows(build(whole))


def test_only_changed_parts_are_written(spark, tmp_path):
    path, customers = str(tmp_path / "state"), dimensions.CUSTOMERS
    old = [line(f"o{k}", "p", customer=f"c{k}", day=DAY) for k in range(200)]
    assert dimensions.update(lines(spark, old), customers, path, parts=8) == 8
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "state").rglob("*.parquet")}
    assert dimensions.update(lines(spark, old[:50]), customers, path) == 0
    later = [line("x", "p", customer="c7", day=DAY + dt.timedelta(5))]
    assert dimensions.update(lines(spark, later), customers, path) == 0
    assert dimensions.update(lines(spark, [line("new", "p", customer="brand new")]), customers, path, parts=99) == 1
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "state").rglob("*.parquet")}
    assert sum(after.get(f) == t for f, t in before.items()) == 7 and dimensions.read_state(spark, path).count() == 201


def test_a_batch_that_fails_leaves_the_state(spark, tmp_path):
    path, customers = str(tmp_path / "state"), dimensions.CUSTOMERS
    dimensions.update(lines(spark, [line("o1", "p1")]), customers, path)
    before = rows(dimensions.read_state(spark, path))
    broken = lines(spark, [line("o2", "p1", customer="c5")]).withColumn("segment", F.when(F.col("order_id") == "o2", F.raise_error(F.lit("lost"))).otherwise(F.col("segment")))
    with pytest.raises(Exception, match="lost"):
        dimensions.update(broken, customers, path)
    assert rows(dimensions.read_state(spark, path)) == before


@pytest.mark.parametrize("name", BUILD)
def test_copies_of_lines_leave_a_state_as_it_is(spark, small, name):
    dimension, faulty = jobs.DIMENSIONS[name], dirty(spark, small)
    kept = cleaning.clean(faulty, copies=True).select(*dimension.needed)
    assert kept.count() > cleaning.clean(faulty).count() and "Aggregate" not in kept._jdf.queryExecution().executedPlan().toString()
    assert rows(dimensions.rows_of(dimensions.state_of(kept, dimension), dimension)) == rows(BUILD[name](cleaning.clean(faulty)))


def test_a_later_batch_is_computed_once(spark, tmp_path):
    path, seen = str(tmp_path / "state"), spark.sparkContext.accumulator(0)
    dimensions.update(lines(spark, [line("o1", "p1")]), dimensions.CUSTOMERS, path)
    batch = lines(spark, [line("o2", "p1", customer="c5"), line("o3", "p1", customer="c6")])

    def counted(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    dimensions.update(batch.mapInPandas(counted, batch.schema), dimensions.CUSTOMERS, path)
    assert seen.value == 2 and dimensions.read_state(spark, path).count() == 3
