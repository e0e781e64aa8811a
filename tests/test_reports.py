import datetime as dt

import pytest

from handover.operators.reports import ReportParameterError, customer_purchase_report, loyal_customers
from handover.sources import fixtures as fx
from conftest import SF_MID, SF_SMALL


def test_purchase_report_parameters(spark):
    t = fx.report_tables(spark, SF_SMALL)
    d = dt.datetime(1997, 1, 1)
    with pytest.raises(ReportParameterError):
        customer_purchase_report(t, None, d)
    with pytest.raises(ReportParameterError):
        customer_purchase_report(t, d, None)
    with pytest.raises(ReportParameterError):
        customer_purchase_report(t, dt.datetime(1998, 1, 1), d)
    same = customer_purchase_report(t, d, d).count()
    assert same >= 0
    assert customer_purchase_report(t, d, dt.datetime(1997, 3, 31), "NO SUCH CATEGORY").count() == 0


def test_purchase_report_expected_counts(spark):
    t = fx.report_tables(spark, SF_MID)
    df = customer_purchase_report(t, dt.datetime(1997, 1, 1), dt.datetime(1997, 3, 31), "PROMO")
    rows = df.collect()
    assert len(rows) == 356
    assert round(sum(r.total_price for r in rows), 2) == 17242911.33
    dates = [(r.order_date, r.company_name) for r in rows]
    assert dates == sorted(dates)


def test_loyal_customers_expected(spark):
    t = fx.report_tables(spark, SF_MID)
    rows = loyal_customers(t["orders"], t["order_details"], t["customers"], dt.datetime(2001, 8, 1)).collect()
    assert len(rows) == 35
    assert sum(r.avg_orders_per_month for r in rows) == 159
    assert sum(r.distinct_products for r in rows) == 730


def test_display_labels(spark):
    from handover.operators.reports import LOYAL_REPORT_LABELS, PURCHASE_REPORT_LABELS, with_display_labels

    t = fx.report_tables(spark, SF_SMALL)
    df = with_display_labels(customer_purchase_report(t, dt.datetime(1997, 1, 1), dt.datetime(1997, 12, 31)), PURCHASE_REPORT_LABELS)
    assert df.columns[0] == "Customer identifier" and "Total price" in df.columns
    lc = with_display_labels(loyal_customers(t["orders"], t["order_details"], t["customers"], dt.datetime(2001, 8, 1)), LOYAL_REPORT_LABELS)
    assert "Average number of order per month" in lc.columns
