"""Library-wide rules: no Python row functions in plans, no unbounded rows on the driver."""

import ast
import pathlib

import pytest

from gable.plans import QUERIES

ROOT = pathlib.Path(__file__).parent.parent / "gable"

# Functions that may bring rows to the driver, with what bounds them.
BOUNDED = {
    "column_modes": "one row per column",
    "learn": "top_n categories per column",
    "class_sizes": "one row per class",
    "_gram": "the cells of a matrix of the subspace's width",
    "cell_counts": "one row per cell of a space partition, whose number follows the rows",
    "grow": "the new nodes of a space partition",
    "_searched": "crowded cells",
    "_fit": "one row per class",
    "fit_resample": "classes x clusters",
}


def functions_using(names, root=ROOT, skip=("llm",)):
    """Calls of the named methods; optional subpackages have tests of their own."""
    for path in root.rglob("*.py"):
        if set(skip) & set(path.parts):
            continue
        tree = ast.parse(path.read_text())
        for f in ast.walk(tree):
            if isinstance(f, ast.FunctionDef):
                for node in ast.walk(f):
                    if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and node.func.attr in names:
                        yield path.name, f.name, node.func.attr


def test_rows_reach_the_driver_only_where_bounded():
    found = {f for _, f, _ in functions_using({"collect", "toPandas", "toLocalIterator"})}
    assert found <= set(BOUNDED)


def test_no_local_checkpoint_cross_join_or_row_udf():
    assert not list(functions_using({"localCheckpoint", "crossJoin", "udf", "foreach"}))


EXPRESSIONS = [
    "comparables_features", "train_lookup_merge", "postcode_parts", "floor_normalise", "geo_bbox", "impute_mean", "onehot_topn",
    "target_encode", "standard_scale", "date_parts", "lag_features", "detrend_deg2", "text_stats", "text_polarity", "profile",
    "latest_per_key", "metric_regression_all", "metric_auc_multiclass", "price_bands", "split_stratified", "batch_confidence",
]


@pytest.mark.parametrize("name", EXPRESSIONS)
def test_plan_stays_in_the_jvm(spark, sf_dir, name):
    plan = QUERIES[name].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize(
    "name,column", [("latest_per_key", "o_orderpriority"), ("dedup_units", "l_shipdate"), ("value_counts", "props"), ("extremes", "o_custkey")]
)
def test_unused_columns_are_not_read(spark, sf_dir, name, column):
    plan = QUERIES[name].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert column not in plan.split("ReadSchema")[1]


def test_filters_reach_the_scan(spark, sf_dir):
    plan = QUERIES["match_type_filter"].run(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(event_type" in plan


def test_every_inventory_row_has_a_query():
    covered = {op for q in QUERIES.values() for op in q.operators.split()}
    sizes = {"A": 12, "B": 19, "C": 16, "D": 23, "E": 10, "F": 15, "G": 8, "H": 14, "I": 15, "J": 46, "K": 7, "L": 2}
    missing = {f"{g}{i}" for g, n in sizes.items() for i in range(1, n + 1)} - covered
    assert not missing
