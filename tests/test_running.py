"""Bucketed running windows equal plain windows for any bucket width."""

import pytest

from compare import compare
from relaywatch.plans import ORACLE
from relaywatch.plans import q_kpis, q_reliability


@pytest.mark.parametrize("width", [1, 37, 1000])
def test_running_kpis_bucketed(spark, sf_dir, con, width):
    compare(q_kpis.w1_running_kpis(spark, sf_dir, bucket_width=width),
            ORACLE["w1_running_kpis"], sf_dir, con)


@pytest.mark.parametrize("width", [1, 37])
def test_breach_events_bucketed(spark, sf_dir, con, width):
    compare(q_kpis.w3_breach_events(spark, sf_dir, bucket_width=width),
            ORACLE["w3_breach_events"], sf_dir, con)


@pytest.mark.parametrize("width", [5, 64])
def test_running_reliability_bucketed(spark, sf_dir, con, width):
    compare(q_reliability.w2_running_reliability(spark, sf_dir, bucket_width=width),
            ORACLE["w2_running_reliability"], sf_dir, con)


def test_breach_matches_state_machine(spark, sf_dir):
    """W3 equals the reference's trigger loop run row by row."""
    from relaywatch.operators import kpis as K
    from relaywatch.sources.orders import receipts
    run = K.running_kpis(receipts(spark, sf_dir), bucket_width=50).toPandas()
    run = run.sort_values("arrival")
    fired, last, epoch = [], None, None
    for r in run.itertuples():
        if r.epoch != epoch:
            epoch, last = r.epoch, None
        if r.total_orders >= 10 and r.incident_mode != "normal" and last != r.incident_mode:
            if r.delay_rate > 20 or r.cancellation_rate > 10 or r.avg_prep_time > 22:
                last = r.incident_mode
                fired.append(r.arrival)
    ev = K.breach_events(K.running_kpis(receipts(spark, sf_dir), bucket_width=50),
                         bucket_width=50)
    assert sorted(x.arrival for x in ev.select("arrival").collect()) == fired
