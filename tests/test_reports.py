import csv
import glob
from decimal import Decimal

import pytest

from patronage.plans import reports
from patronage.plans.registry import QUERIES
from patronage.plans.views import register_views
from patronage.sources.tables import Tables
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(reports.REPORT_ORDER))
def test_reports_come_in_a_total_order(spark, name):
    rows = reports.report(Tables.from_tpch(spark, SF_SMALL), name).collect()
    keys = reports.REPORT_ORDER[name]
    assert name in QUERIES
    for a, b in zip(rows, rows[1:], strict=False):
        for k in keys:
            x, y = a[k.lstrip("-")], b[k.lstrip("-")]
            if x != y:
                assert y is None or (x is not None and (x > y if k[0] == "-" else x < y)) or (x is None and k[0] != "-")
                break
        else:
            raise AssertionError(f"{name}: two rows share their sort key")


def test_views_are_ordered(spark):
    register_views(Tables.from_tpch(spark, SF_SMALL), ["vw_monthly_kpi"])
    months = [r.year_month for r in spark.table("vw_monthly_kpi").collect()]
    assert months == sorted(months)


def test_exports(spark, scratch):
    t = Tables.from_tpch(spark, SF_SMALL)
    assert len(reports.EXPORTS) == 14
    paths = reports.export_all(t, scratch)
    for name, path in paths.items():
        files = sorted(glob.glob(f"{path}/part-*.csv"))
        rows = [r for f in files for r in csv.reader(open(f))]
        report, _, columns = reports.EXPORTS[name]
        assert rows[0] == columns and len(rows) > 1
        if report:
            assert len(files) == 1
    top = list(csv.DictReader(open(glob.glob(f"{paths['exports/top_products']}/part-*.csv")[0])))
    values = [Decimal(r["net_revenue"]) for r in top]
    assert values == sorted(values, reverse=True)
