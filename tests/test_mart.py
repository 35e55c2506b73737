from decimal import Decimal

from conftest import OPEN, day
from hvault.plans import mart

TI = "customer_hash_key string, request_hash_key string, status_from_dttm timestamp_ntz, effective_from_dttm timestamp_ntz, effective_to_dttm timestamp_ntz, tail_limit int, service_request_type_nm string"


def _ti(spark, types):
    starts = [day(10 * i) for i in range(len(types))]
    rows = []
    for i, t in enumerate(types):
        end = starts[i + 1] if i + 1 < len(types) else OPEN
        rows.append(("c", f"r{i}", starts[i], starts[i], end, 10, t))
    return spark.createDataFrame(rows, TI)


def test_activation_counts(spark):
    ti = _ti(spark, ["enable", "chg_round", "disable", "enable"])
    r = mart.activation_at_date(ti, "2000-12-31", 2000).first()
    assert (r.activation, r.deactivation) == (2, 1)


def test_activation_grid_matches_point_evaluation(spark):
    ti = _ti(spark, ["enable", "chg_round", "disable", "enable"])
    grid = {r.to_date.isoformat(): (r.activation, r.deactivation) for r in mart.activation_grid(ti, "2000-01-01", "2000-03-01", 7).collect()}
    for d, counts in grid.items():
        r = mart.activation_at_date(ti, d, 7).first()
        assert counts == (r.activation, r.deactivation), d


def test_churn_absent_next_month_is_not_lost(spark):
    link = spark.createDataFrame([("c1", "r1"), ("c2", "r2"), ("c2", "r3")], "customer_hash_key string, request_hash_key string")
    hr = spark.createDataFrame(
        [("r1", day(0), OPEN, "enable"), ("r2", day(0), OPEN, "enable"), ("r3", day(40), OPEN, "disable")],
        "request_hash_key string, effective_from_dttm timestamp_ntz, effective_to_dttm timestamp_ntz, service_request_type_nm string",
    )
    rows = {r.report_date.isoformat(): r for r in mart.churn(link, hr).collect()}
    jan = rows["2000-01-01"]
    # c1 is absent in February (not lost); c2 is present there and inactive (lost)
    assert (jan.customers_start, jan.customers_lost) == (2, 1)
    assert jan.churn_rate == Decimal("0.5000")


def test_retention_next_month(spark):
    ti = _ti(spark, ["enable", "enable", "enable"])  # days 0, 10, 20: all January
    r = mart.retention(ti).first()
    assert (r.total_users, r.retained_users) == (1, 0)
