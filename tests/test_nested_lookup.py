"""The map of the nested look-up holds one number for each nation and segment, not one element for each customer."""

import __spark_entry__
from conftest import plan_of

SMALL = "/root/testdata/sf0.001"


def test_no_array_grows_with_the_customers(spark):
    found = __spark_entry__.queries()["nested_lookup"](spark, SMALL)
    assert "array_repeat" not in plan_of(found)
