"""Registered queries beside their SQL twins on the smallest tables.

Set PLUMBLINE_ALL=1 for every query; a spread of them runs by default.
"""

import os
import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from plumbline.plans import ORACLES, QUERIES, load_all  # noqa: E402

FOLDER = os.environ.get("PLUMBLINE_TESTDATA", "/root/testdata/sf0.001")
load_all()
SPREAD = [
    "a04_feature_sets_json", "b14_reasons", "c06_fit_transform", "d05_window_split", "d06_fixed_size_sample",
    "e03_mutual_information", "e04_anova", "f05_permuted_values", "g06_robust_set", "g09_method_agreement",
    "h09_grid_table", "i04_pr_auc", "i12_metric_record", "i15_threshold_sweep", "i17_segment_policy_audit",
    "k06_chi2_p_value", "k08_drift_audit", "k13_retraining_decisions", "p03_threshold_fallback", "p07_decisions_table",
    "q02_domain_sets", "x01_partial_dependence", "x05_explained_errors",
]
CHOSEN = sorted(ORACLES) if os.environ.get("PLUMBLINE_ALL") else SPREAD


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    if not pathlib.Path(FOLDER).exists():
        pytest.skip("no test tables here")
    from check_oracles import TABLES

    c = duckdb.connect()
    for table in TABLES:
        c.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return c


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, con, name):
    from check_oracles import rows_of

    df = QUERIES[name](spark, FOLDER)
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert rows_of(df.collect(), df.columns) == rows_of(result.fetchall(), names)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
