"""Every data-quality key of the catalog finds the faults laid into its input."""

import pytest

import __spark_entry__ as E

KEYS = ("dq_not_null", "dq_accepted_values", "dq_range", "dq_between", "dq_conditional", "dq_row_rule",
        "dq_cross_table_dates", "dq_key_preservation", "dq_variant_balance")


@pytest.mark.parametrize("key", KEYS)
def test_check_finds_rows(spark, key):
    assert E.queries()[key](spark, "/root/testdata/sf0.01").count() > 0
