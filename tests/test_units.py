"""Unit and golden tests for operators without a SQL twin."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from relaywatch import work_dir
from relaywatch.operators import demand as M
from relaywatch.operators import history as H
from relaywatch.operators import reliability as R
from relaywatch.operators import search as S
from relaywatch.schema import HISTORY_SEEDS


def test_arma11_recovers_coefficients():
    rng = np.random.default_rng(7)
    n, c, phi, theta = 4000, 2.0, 0.6, 0.3
    e = rng.normal(0, 1, n)
    y = np.zeros(n)
    for t in range(1, n):
        y[t] = c + phi * y[t - 1] + e[t] + theta * e[t - 1]
    const, ar1, ma1, s2, ok = M.fit_arma11(y[200:])
    assert abs(ar1 - phi) < 0.05 and abs(ma1 - theta) < 0.06
    assert abs(const / (1 - ar1) - c / (1 - phi)) < 0.3
    assert 0.9 < s2 < 1.1


def _dense_loglik(y, mean, phi, theta, sigma2):
    """Gaussian likelihood by the whole covariance matrix of an ARMA(1,1)."""
    n = len(y)
    g0 = (1 + 2 * phi * theta + theta ** 2) / (1 - phi ** 2)
    g1 = (1 + phi * theta) * (phi + theta) / (1 - phi ** 2)
    lag = np.abs(np.subtract.outer(np.arange(n), np.arange(n)))
    cov = sigma2 * np.where(lag == 0, g0, g1 * phi ** np.maximum(lag - 1, 0).astype(float))
    _, logdet = np.linalg.slogdet(cov)
    d = y - mean
    return -0.5 * (n * np.log(2 * np.pi) + logdet + d @ np.linalg.solve(cov, d))


def test_exact_likelihood_equals_dense_covariance():
    rng = np.random.default_rng(5)
    y = 40 + np.cumsum(rng.normal(size=60)) * 0.3 + rng.normal(size=60)
    phi, theta = np.array([.5, -.7, 0.0, .95, .3]), np.array([.2, .4, -.8, -.5, 0.0])
    loglik, mean, sigma2 = M.exact_likelihood(y, phi, theta)
    for k in range(5):
        args = (mean[k], phi[k], theta[k], sigma2[k])
        assert loglik[k] == pytest.approx(_dense_loglik(y, *args), rel=1e-10)
        # Mean and variance are the best ones there.
        for dm, ds in ((.05, 1), (-.05, 1), (0, 1.05), (0, .95)):
            assert _dense_loglik(y, mean[k] + dm, phi[k], theta[k], sigma2[k] * ds) < loglik[k]


def test_exact_fit_is_the_best_and_recovers_coefficients():
    rng = np.random.default_rng(9)
    e = rng.normal(size=4001)
    x = np.zeros(4001)
    for t in range(1, 4001):
        x[t] = .7 * x[t - 1] + e[t] + .3 * e[t - 1]
    mean, const, phi, theta, sigma2, loglik, ok = M.fit_exact(x[1:] + 20)
    assert ok and abs(phi - .7) < .05 and abs(theta - .3) < .06 and abs(mean - 20) < .4
    assert const == pytest.approx(mean * (1 - phi)) and abs(sigma2 - 1) < .1
    near = M.exact_likelihood(x[1:] + 20, phi + np.array([1, -1, 0, 0]) * 1e-3,
                              theta + np.array([0, 0, 1, -1]) * 1e-3)[0]
    assert (near < loglik).all()
    # Random short series: no start of a random search does better.
    for _ in range(5):
        y = rng.normal(size=25).cumsum() + rng.normal(size=25)
        best = M.fit_exact(y)[5]
        other = M.exact_likelihood(y, rng.uniform(-.99, .99, 3000), rng.uniform(-.99, .99, 3000))[0]
        assert best >= other.max() - 1e-9


def test_exact_fit_of_odd_series():
    assert M.fit_exact(np.array([3., 3., 3., 3.])) == (3., 3., 0., 0., 0., None, True)
    assert M.fit_exact(np.array([1., 2.]))[-1] is False
    assert M.fit_exact(np.array([1., 5., 2.]))[-1] is True


def test_conditional_fit_is_not_above_the_lag_regression():
    rng = np.random.default_rng(3)
    for _ in range(20):
        y = rng.normal(size=rng.integers(4, 80)) * 5 + 10
        c, phi, theta, sigma2, _ = M.fit_arma11(y)
        X = np.column_stack([np.ones(len(y) - 1), y[:-1]])
        b, *_ = np.linalg.lstsq(X, y[1:], rcond=None)
        sse = float(((y[1:] - X @ b) ** 2).sum())
        if abs(b[1]) < .99:
            assert sigma2 * (len(y) - 1) <= sse * (1 + 1e-9) + 1e-9


def test_demand_models_per_item(spark):
    rng = np.random.default_rng(3)
    rows = []
    for item, phi in (("a", 0.5), ("b", -0.3)):
        y = 10.0
        for h in range(600):
            y = 5 + phi * y + rng.normal()
            rows.append((item, f"2024-01-{1 + h // 24:02d}", h % 24, float(y)))
    rows.append(("short", "2024-01-01", 0, 1.0))
    df = spark.createDataFrame(rows, "item string, date string, hour int, quantity double")
    out = {r.item: r for r in M.demand_models(df).collect()}
    assert set(out) == {"a", "b"}  # fewer than 3 points is dropped
    assert abs(out["a"].ar1 - 0.5) < 0.15 and abs(out["b"].ar1 + 0.3) < 0.15
    path = work_dir(spark, "models")
    M.save_models(M.demand_models(df), path)
    assert spark.read.parquet(path).count() == 2


def test_worked_duplicate_example(spark):
    """10 orders sent, 12 received (2 and 4 repeated): 2 duplicates, 16.7 %."""
    rows = [(f"o{i}", "at_least_once", i, i) for i in range(1, 11)]
    rows += [("o2", "at_least_once", 2, 11), ("o4", "at_least_once", 4, 12)]
    df = spark.createDataFrame(rows, "order_id string, kafka_mode string, sent_sequence int, "
                                     "arrival long")
    s = R.delivery_summary(df).collect()[0]
    assert (s.unique_orders, s.total_orders_received, s.duplicate_orders) == (10, 12, 2)
    assert round(s.duplicate_percentage, 1) == 16.7
    assert s.estimated_loss == 0


def test_empty_mode_defaults(spark):
    df = spark.createDataFrame([("a", "exactly_once", 1)],
                               "order_id string, kafka_mode string, sent_sequence int")
    rows = {r.kafka_mode: r for r in R.mode_reliability(spark, df).collect()}
    assert rows["at_most_once"].accuracy == 100.0
    assert rows["at_most_once"].duplicate_percentage == 0.0
    assert rows["at_most_once"].estimated_loss == 0


def test_null_order_id_is_one_order(spark):
    df = spark.createDataFrame([(None, "at_least_once", 1), (None, "at_least_once", 1)],
                               "order_id string, kafka_mode string, sent_sequence int")
    s = R.delivery_summary(df).collect()[0]
    assert (s.unique_orders, s.total_orders_received) == (1, 2)


def test_history_create_seed_append_idempotent(spark):
    path = work_dir(spark, "history") + "/table"
    h = H.open_history(spark, path)
    assert h.count() == len(HISTORY_SEEDS)
    H.open_history(spark, path)  # seeding again is a no-op
    out = spark.createDataFrame([("Kitchen Bottleneck", "a | b", 28, 0.91, "2026-07-01T00:00:00")],
                                "incident string, solution string, improvement int, "
                                "confidence double, timestamp string")
    H.record_incidents(spark, out, path, ts_col="timestamp", batch_id=0, run="q")
    H.record_incidents(spark, out, path, ts_col="timestamp", batch_id=0, run="q")  # replay
    h = H.open_history(spark, path)
    assert h.count() == len(HISTORY_SEEDS) + 1
    top = H.find_similar(h, spark.createDataFrame([("Kitchen Bottleneck",)], "query string"))
    assert [r.timestamp for r in top.orderBy("rank").collect()] == [
        "2026-07-01T00:00:00", "2026-06-15T12:00:00"]


def test_history_keeps_equal_outcomes(spark):
    """Equal incidents are stored apart, in one batch or in two, and a missing
    time becomes the current one."""
    row = ("Kitchen Bottleneck", "a", 28, 0.91, None)
    schema = "incident string, solution string, improvement int, confidence double, timestamp string"
    one, two = work_dir(spark, "history") + "/one", work_dir(spark, "history") + "/two"
    H.open_history(spark, one), H.open_history(spark, two)
    H.record_incidents(spark, spark.createDataFrame([row, row], schema), one, ts_col="timestamp",
                       batch_id=0)
    for n in range(2):
        H.record_incidents(spark, spark.createDataFrame([row], schema), two, ts_col="timestamp",
                           batch_id=n)
    for path in (one, two):
        h = H.open_history(spark, path)
        new = h.filter("solution = 'a'").collect()
        assert len(new) == 2 and len({r.id for r in new}) == 2
        assert all(r.timestamp for r in new) and h.count() == len(HISTORY_SEEDS) + 2
        q = spark.createDataFrame([("Kitchen",)], "query string")
        assert [r.solution for r in H.find_similar(h, q, k=2).collect()] == ["a", "a"]


def test_overlap_ranking(spark):
    rows = [("1", "late courier", "s", 1, .5, "2026-01-02"), ("2", "late courier storm", "s", 1, .5,
                                                              "2026-01-01")]
    h = spark.createDataFrame(rows, "id string, incident string, solution string, improvement int, "
                                    "confidence double, timestamp string")
    q = spark.createDataFrame([("storm courier",)], "query string")
    first = lambda r: H.find_similar(h, q, k=1, rank=r).collect()[0].id
    assert first("newest") == "1" and first("overlap") == "2"


def test_keyword_wildcards_and_short_words(spark):
    h = H.seed_rows(spark)
    q = spark.createDataFrame([("Sur%ge",), ("a b",)], "query string")
    rows = {(r.query, r.rank): r for r in H.find_similar(h, q).collect()}
    assert rows[("Sur%ge", 1)].incident == "Weather Surge" and rows[("Sur%ge", 1)].matched
    assert not rows[("a b", 1)].matched  # no word > 3 chars: whole string, no match


def test_corpus_reader_and_search(spark):
    from relaywatch.sources.procedures import corpus_rejects, read_corpus, write_procedures
    folder = work_dir(spark, "corpus")
    write_procedures(folder)
    with open(os.path.join(folder, "notes.md"), "w") as f:
        f.write("not a procedure")
    corpus = read_corpus(spark, folder)
    assert corpus_rejects(spark, folder).count() == 0
    assert corpus.count() == 6
    idx = S.build_index(corpus, id_col="doc_name", text_col="content")
    q = spark.createDataFrame([("w", "Weather Surge"), ("z", "zzzz qqqq")], "qid string, text string")
    top = {(r.qid, r.rank): r for r in S.top_documents(idx, q, k=7).collect()}
    assert top[("w", 1)].doc_id == "weather_surge"
    assert 0 < top[("w", 1)].score <= 1
    # unknown words: k larger than the corpus gives every document at score 0
    assert sorted(r.doc_id for (qq, _), r in top.items() if qq == "z") == sorted(
        ["courier_delay", "festival_rush", "inventory_shortage", "kitchen_delay",
         "staff_shortage", "weather_surge"])


def test_unreadable_files_are_left_out_and_named(spark, tmp_path):
    from relaywatch.sources.procedures import corpus_rejects, read_corpus
    (tmp_path / "good one.txt").write_text("first\nsecond\n", encoding="utf-8")
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "latin.txt").write_bytes("caf\xe9".encode("latin-1"))
    (tmp_path / "other.md").write_bytes(b"\xff")
    with pytest.warns(UserWarning, match="latin"):
        got = {r.doc_name: r.content for r in read_corpus(spark, str(tmp_path)).collect()}
    assert got == {"good one": "first\nsecond\n", "empty": ""}
    assert [(r.doc_name, r.error) for r in corpus_rejects(spark, str(tmp_path)).collect()] == [
        ("latin", "not_utf8")]


def test_json_lines_source(spark, sf_dir):
    from relaywatch.operators.decode import encode_forwarded
    from relaywatch.sources.orders import read_order_lines, receipts
    folder = work_dir(spark, "jsonl")
    r = receipts(spark, sf_dir)
    r.select(F.to_json(F.struct(*[c for c in r.columns if c not in (
        "epoch", "arrival", "copy_no", "kafka_timestamp")])).alias("value")) \
        .write.mode("overwrite").text(folder)
    with open(os.path.join(folder, "blank.txt"), "w") as f:
        f.write("\n\n")
    back = read_order_lines(spark, folder)
    assert back.count() == r.count()
    assert encode_forwarded(back).filter(F.col("value").contains('"type":"received"')).count() \
        == r.count()


def test_bad_input_rules(spark):
    """SURVEY §1.3: bad JSON, one mistyped field, null value, explicit null,
    missing fields take defaults, unknown modes are rejected."""
    from relaywatch.operators import decode as D
    vals = [
        ('{"order_id":"a","kafka_mode":"AT_LEAST_ONCE","sent_sequence":3}', "ok-upper"),
        ('{"order_id":"b","kafka_mode":"exactly_once","sent_sequence":"x"}', "mistyped"),
        ('{"order_id": "c", broken', "bad-json"),
        (None, "null-value"),
        ('{"order_id":"d","kafka_mode":"carrier_pigeon","sent_sequence":1}', "unknown-mode"),
        ('{"order_id":"e","kafka_mode":"at_most_once","sent_sequence":null}', "explicit-null"),
        ('{"order_id":"f","kafka_mode":"at_most_once","prep_time_minutes":"slow"}', "bad-prep"),
    ]
    df = spark.createDataFrame(vals, "value string, tag string").withColumn(
        "key", F.lit(None).cast("binary")).withColumn("timestamp", F.current_timestamp())
    web = {r.tag: r for r in D.web_records(df, keep=["tag"]).collect()}
    assert web["ok-upper"].reject_reason is None and web["ok-upper"].kafka_mode == "at_least_once"
    assert web["ok-upper"].prep_time_minutes == 15 and web["ok-upper"].incident_mode == "normal"
    assert web["mistyped"].reject_reason == "bad_sequence"
    assert web["bad-json"].reject_reason == "bad_json"
    assert web["null-value"].reject_reason == "null_value"
    assert web["unknown-mode"].reject_reason == "unknown_mode"
    assert web["explicit-null"].reject_reason is None and web["explicit-null"].sent_sequence == 0
    assert web["bad-prep"].reject_reason == "bad_prep"
    dec = {r.tag: r for r in D.decode_orders(df, keep=["tag"]).collect()}
    # consumer side: a mistyped field nulls only that field; bad JSON is all null
    assert dec["mistyped"].order_id == "b" and dec["mistyped"].sent_sequence is None
    assert dec["bad-json"].order_id is None and dec["bad-json"].kafka_mode is None


def test_saved_index_searches_without_pair_shuffle(spark, sf_dir):
    import re
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    q = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select(
        F.col("item_id").alias("qid"), "text")
    idx = S.build_index(docs)
    want = sorted(S.top_documents(idx, q, k=3).collect())
    path = work_dir(spark, "index")
    S.save_index(idx, path, buckets=4)
    spark.sql("DROP TABLE IF EXISTS t_idx_weights")  # metadata only: load re-declares it
    loaded = S.load_index(spark, path)
    got_df = S.top_documents(loaded, q, k=3)
    assert sorted(got_df.collect()) == want
    qv, small = S.query_vectors(loaded, q)
    plan = S.sparse_dot(loaded, qv, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(qid#\d+L, doc_id", plan)


def test_saved_indexes_do_not_mix(spark):
    """Two indexes in one session, numbered and named documents."""
    a = spark.createDataFrame([(1, "late courier"), (2, "cold kitchen")], "doc_id long, text string")
    b = spark.createDataFrame([("x", "late storm"), ("y", "cold store")], "doc_id string, text string")
    paths = [work_dir(spark, "idx") + "/t" for _ in range(2)]
    for docs, path in zip((a, b), paths):
        S.save_index(S.build_index(docs), path, buckets=2)
    q = spark.createDataFrame([(0, "late")], "qid long, text string")
    for docs, path, want in zip((a, b), paths, (1, "x")):
        for limit in (S.MAX_BROADCAST_QUERY_TOKENS, 0):  # broadcast and shuffle join
            top = S.top_documents(S.load_index(spark, path), q, max_broadcast=limit).collect()
            assert [r.doc_id for r in top] == [want]


def test_run_cols_keep_restarted_sequences_apart(spark):
    """a producer restart resets the sequence; per-run keys keep loss visible."""
    rows = [(f"r1-{i}", "at_most_once", i, "run1") for i in (1, 2, 3, 5)] + \
           [(f"r2-{i}", "at_most_once", i, "run2") for i in (1, 3)]
    df = spark.createDataFrame(rows, "order_id string, kafka_mode string, sent_sequence int, "
                                     "run string")
    merged = R.delivery_summary(df).collect()[0]
    assert merged.estimated_loss == 0  # max 5 vs 6 received hides the losses
    per_run = {r.run: r.estimated_loss for r in R.delivery_summary(df, run_cols=["run"]).collect()}
    assert per_run == {"run1": 1, "run2": 1}


def test_index_parts_of_frequent_and_rare_tokens_are_all_terms(spark):
    """However many tokens are broadcast, norms, weights and scores are the same;
    ids that repeat or are null count as one document each."""
    from relaywatch.operators import search as S
    texts = ["a b c", "a a d e", "a b", None, "", "f g a", "b h"]
    docs = spark.createDataFrame([*enumerate(texts), (1, "d z"), (None, "a q"), (None, "b")],
                                 "doc_id long, text string")
    q = spark.createDataFrame([(1, "a d"), (2, "q b b"), (3, "none")], "qid long, text string")

    def results(max_tokens):
        idx = S.build_index(docs, max_tokens=max_tokens)
        qv, small = S.query_vectors(idx, q)
        frames = idx.norms, idx.weights, S.sparse_dot(idx, qv, small), S.top_documents(idx, q, k=3)
        rows = [sorted(str(tuple(round(x, 9) if isinstance(x, float) else x for x in r))
                       for r in f.collect()) for f in frames]
        return idx, rows
    idx, rows = results(1000)
    assert rows == results(3)[1] == results(0)[1]
    assert len(rows[0]) == 6 and len(rows[1]) == idx.terms.count()
    # Nothing but the texts moves: per-document sums run on the term table's buckets.
    idx.norms.write.format("noop").mode("overwrite").save()
    assert "hashpartitioning" not in idx.norms._jdf.queryExecution().executedPlan().toString()


def test_texts_of_results_are_picked_before_they_move(spark):
    from relaywatch.operators import search as S
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    top = spark.createDataFrame([(1, 3, 0.5, 1), (1, 99, 0.4, 2), (2, 3, 0.1, 1)],
                                "qid long, doc_id long, score double, rank int")
    out = S.attach_content(top, docs)
    assert sorted((r.qid, r.doc_id, r.content) for r in out.collect()) == [
        (1, 3, "text 3"), (1, 99, None), (2, 3, "text 3")]
    assert "LeftSemi" in out._jdf.queryExecution().executedPlan().toString()
