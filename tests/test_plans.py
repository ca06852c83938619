"""Physical-plan properties the design relies on (checked on executed plans)."""

import re

import pytest

from relaywatch.plans import QUERIES

BATCH = sorted(n for n in QUERIES if not n.startswith("st"))


def _plan(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_and_python_only_where_designed(spark, sf_dir, name):
    p = _plan(spark, sf_dir, name)
    assert "CartesianProduct" not in p
    python = any(x in p for x in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"))
    assert python == (name in ("m1_demand_model", "m1_coefficients", "m1_exact_models",
                               "m1_grid_likelihood"))


@pytest.mark.parametrize("name", ["l1_recent_orders", "l2_top_documents", "j3_similar_incidents"])
def test_top_k_is_limited_before_the_shuffle(spark, sf_dir, name):
    assert "WindowGroupLimit" in _plan(spark, sf_dir, name)


def test_search_never_shuffles_query_doc_pairs(spark, sf_dir):
    p = _plan(spark, sf_dir, "j1_sparse_dot")
    assert not re.search(r"Exchange hashpartitioning\(qid#\d+L?, doc_id#\d+L?", p)


@pytest.mark.parametrize("name", ["w1_running_kpis", "w2_running_reliability",
                                  "w3_breach_events"])
def test_running_windows_are_bucketed(spark, sf_dir, name):
    p = _plan(spark, sf_dir, name)
    # Windows over receipt rows are partitioned by (group, bucket), never by
    # the bare group (a mode or an epoch may hold a third of all rows). The
    # only group-partitioned windows run over the per-bucket totals table,
    # one row per bucket, ordered by the bucket.
    specs = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[([^\]]*)\]", p)
    assert specs
    for part, order in specs:
        cols = [c.split("#")[0].strip() for c in part.split(",") if c.strip()]
        if "kafka_mode" in cols or "epoch" in cols:
            assert "_bucket" in cols or order.strip().startswith("_bucket"), (part, order)
