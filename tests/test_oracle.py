"""Every query with SQL semantics must equal its DuckDB oracle (sf0.001)."""
import duckdb
import pytest

from attrition.plans.catalog import load_all

import check_oracle as CO

REG = load_all()
SQL_KEYS = sorted(k for k, q in REG.items() if q.oracle and k != "validation_gate")


@pytest.fixture(scope="module", autouse=True)
def few_rounds():
    """What the oracles check of a model does not depend on its size."""
    from attrition.plans import q_ml
    old = q_ml.TRAIN_FIT, q_ml.CV_FIT
    q_ml.TRAIN_FIT = q_ml.CV_FIT = {"random_forest": {"numTrees": 5, "maxDepth": 4}, "xgboost": {"maxIter": 2}, "lightgbm": {"maxIter": 2}}
    yield
    q_ml.TRAIN_FIT, q_ml.CV_FIT = old


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in CO.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", SQL_KEYS)
def test_query_matches_oracle(spark, sf, con, key):
    q = REG[key]
    got = q.fn(spark, sf).toPandas()
    want = con.execute(q.oracle).df()
    assert CO.compare(got, want) == "ok"


def test_gate_raises_below_row_minimum(spark, sf):
    from attrition.operators.quality import ValidationError
    with pytest.raises(ValidationError):
        REG["validation_gate"].fn(spark, sf)
