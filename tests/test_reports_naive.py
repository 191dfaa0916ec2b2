"""Both reports against their source-shaped forms: windows per key, all pairs, argmin by self-join, the CASE ladder."""

from caretrail.plans import analog_tables as at
from caretrail.plans import analogs
from tests.conftest import SMOKE
from tests.helpers import assert_same
from tools.naive import call_report_naive, ticket_report_naive


def test_reports_equal_their_source_shaped_forms(spark):
    src = at.sources(spark, SMOKE)
    for got, want in ((analogs.ticket_report_events(spark, SMOKE), ticket_report_naive(src)), (analogs.call_report_events(spark, SMOKE), call_report_naive(src))):
        assert sorted(got.columns) == sorted(want.columns), set(got.columns) ^ set(want.columns)
        assert_same(got, want)
