"""Properties of the dashboard measures (BI1-BI11) on the sf0.001 star."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import analytics
from fleetlake.plans import dashboard
from fleetlake.plans.star import gold
from fleetlake.sources import fixtures
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def star(spark):
    settings = gold(spark, SF_SMALL)
    return SimpleNamespace(fact=spark.table(settings.table("gold", "fact_availability")),
                           fact_capacity=dashboard.fact_capacity(spark, settings))


def test_downtime_by_type_sums_to_total(star):
    fc = star.fact_capacity
    total = fc.filter("is_unavailable").agg(F.sum("downtime_mw")).first()[0]
    by_type = analytics.downtime_by_year_type(fc).agg(F.sum("downtime_mw")).first()[0]
    assert total == by_type and total > 0


def test_outage_split_shares(star):
    rows = analytics.outage_split(star.fact_capacity).collect()
    assert {r.unavailability_type for r in rows} <= {"planifiée", "fortuite"}
    assert abs(sum(r.mw_share for r in rows) - 1) < 1e-9
    assert abs(sum(r.count_share for r in rows) - 1) < 1e-9


def test_top_k_ordered_and_bounded(star):
    rows = analytics.top_plants_downtime(star.fact_capacity, 5).collect()
    assert len(rows) == 5
    keys = [(-r.downtime_mw, r.plant) for r in rows]
    assert keys == sorted(keys)


def test_kpis_consistent(star):
    k = analytics.kpi_availability(star.fact_capacity).first()
    assert k.availability_rate == pytest.approx(k.power_sum / k.rated_sum)
    assert 0 <= k.uptime_share <= 1
    assert analytics.kpi_reactor_count(star.fact).first().n_reactors == \
        star.fact.select("reactor_id").distinct().count()


def test_year_over_year(spark):
    rows = analytics.yoy_change(fixtures.outage_log(spark, SF_SMALL)).orderBy("year").collect()
    assert rows[0].prev_total_mw is None and rows[0].change_ratio is None
    for prev, cur in zip(rows, rows[1:]):
        assert cur.prev_total_mw == prev.total_mw
        assert cur.change_ratio == pytest.approx((cur.total_mw - prev.total_mw) / prev.total_mw)


def test_worst_slice_is_one_reactor(star):
    sl = analytics.worst_asset_slice(star.fact_capacity, star.fact)
    assert sl.select("reactor_id").distinct().count() == 1
    assert sl.count() == star.fact.join(sl.select("reactor_id").distinct(), "reactor_id").count()
