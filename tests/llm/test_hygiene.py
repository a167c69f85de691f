"""Rules for the subpackage: bounded rows on the driver, no Python in the native operators."""

import pytest

from gable.llm.queries import QUERIES
from tests.test_hygiene import ROOT, functions_using

# Functions that bring rows to the driver, with what bounds them.
BOUNDED = {
    "collected": "the number of hash buckets",
    "bit_table": "the number of words of the bit table",
    "fit_threshold": "the number of score bins",
    "fit": "the texts of the training sample",
    "statistics": "the terms of a block of items",
    "blocks": "a partition of the items, and a block",
    "_summed": "the cells of a matrix of dimension x dimension",
    "_folded": "the number of committed batches",
}


def test_rows_reach_the_driver_only_where_bounded():
    found = {f for _, f, _ in functions_using({"collect", "toPandas", "toLocalIterator"}, ROOT / "llm", ())}
    assert found <= set(BOUNDED)
    assert not list(functions_using({"localCheckpoint", "crossJoin", "udf", "foreach"}, ROOT / "llm", ()))


@pytest.mark.parametrize("name", ["op1_perspective_rotation", "op2_license_scan"])
def test_native_operators_stay_in_the_jvm(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))
