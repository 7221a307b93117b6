from __future__ import annotations

from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from txguard.fixtures import view
from txguard.operators.features import prepare_features_and_target
from txguard.operators.models import build_candidates, fit_candidate, split_train_test, with_class_weights
from txguard.operators.preprocess import build_preprocessor
from txguard.plans.inference import TablePaths
from txguard.schemas import TRANSACTION_SCHEMA
from txguard.streaming import stream as st


def _train_test(spark):
    data = prepare_features_and_target(view(spark, SF_SMALL, "transactions"))
    train, test = split_train_test(data)
    train, _ = with_class_weights(train)
    return train.cache(), test


def test_preprocessor_outputs_sparse_and_ignores_unseen(spark):
    train, test = _train_test(spark)
    model = build_preprocessor(train).fit(train)
    row = model.transform(train).select("features").first()[0]
    assert isinstance(row, SparseVector)
    unseen = test.withColumn("merchant", F.lit("never seen")).limit(1)
    v1 = model.transform(unseen).select("features").first()[0]
    v0 = model.transform(test.limit(1)).select("features").first()[0]
    assert v1.size == v0.size          # unseen category: an all-zero block, same width
    merchants = next(st for st in model.stages if st.uid.startswith("StringIndexer")).labels
    lost = set(v0.indices) - set(v1.indices)
    assert len(lost) == 1 and set(v1.indices) <= set(v0.indices) and len(merchants) > 1


def test_preprocessor_leaves_out_empty_columns_and_keeps_odd_modes(spark):
    train, _ = _train_test(spark)
    odd = train.withColumn("zip", F.lit(None).cast("bigint")).withColumn("job", F.lit("a\\tb's"))
    model = build_preprocessor(odd).fit(odd)
    holes = odd.withColumn("job", F.lit(None).cast("string"))
    same = model.transform(odd).select("features").first()[0]
    assert model.transform(holes).select("features").first()[0] == same


def test_logistic_candidate_fits_and_scores(spark):
    train, test = _train_test(spark)
    cand = build_candidates(float(train.count()), include_boosted=False)[0]
    res = fit_candidate(cand, train, test, 0.9)
    assert res.scored.count() == test.count()
    names = {r["metric"] for r in res.metrics.collect()}
    assert "average_precision" in names and "production_precision" in names


def test_split_is_deterministic(spark):
    data = view(spark, SF_SMALL, "transactions")
    a = split_train_test(data)[1].select("trans_num").collect()
    b = split_train_test(data.repartition(7))[1].select("trans_num").collect()
    assert sorted(a) == sorted(b) and len(a) == 300
    test = split_train_test(data)[1]
    for c in (0, 1):       # each class gives its share
        assert test.where(F.col("is_fraud") == c).count() == round(0.2 * data.where(F.col("is_fraud") == c).count())


def _paths(base):
    return TablePaths(*[f"{base}/{n}" for n in ("predictions", "alerts", "labeled", "quarantine",
                                                "integration_events", "alert_status_events")])


def test_scoring_stream_replay_gives_equal_tables(spark, scratch):
    t = view(spark, SF_SMALL, "transactions").select(*[f.name for f in TRANSACTION_SCHEMA.fields])
    src = scratch + "/in"
    t.repartition(3).write.parquet(src)
    p1, p2 = _paths(scratch + "/run1"), _paths(scratch + "/run2")
    st.run_to_completion(st.start_scoring_stream(spark, src, p1, scratch + "/ck1", max_files_per_trigger=1))
    st.run_to_completion(st.start_scoring_stream(spark, src, p2, scratch + "/ck2"))
    a = spark.read.parquet(p1.predictions).drop("predicted_at", "batch_id")
    b = spark.read.parquet(p2.predictions).drop("predicted_at", "batch_id")
    assert a.count() == b.count() == 1500
    assert a.exceptAll(b).count() == 0
    al1 = spark.read.parquet(p1.alerts).select("trans_num")
    al2 = spark.read.parquet(p2.alerts).select("trans_num")
    assert al1.count() == al2.count() and al1.exceptAll(al2).count() == 0
    # restarting on the same checkpoint finds nothing new
    st.run_to_completion(st.start_scoring_stream(spark, src, p1, scratch + "/ck1"))
    assert spark.read.parquet(p1.predictions).count() == 1500


def test_stream_dedupe_across_batches(spark, scratch):
    t = view(spark, SF_SMALL, "transactions").select(*[f.name for f in TRANSACTION_SCHEMA.fields])
    src = scratch + "/in"
    t.coalesce(1).write.parquet(src)                            # batch 1: everything
    t.orderBy(F.col("current_time").desc()).limit(100).coalesce(1) \
        .write.mode("append").parquet(src)                      # batch 2: 100 repeats of recent keys
    out = scratch + "/out"
    stream = st.read_transaction_stream(spark, src, max_files_per_trigger=1)
    q = (st.dedupe_by_key(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch + "/ck").trigger(availableNow=True).start())
    st.run_to_completion(q)
    assert spark.read.schema(TRANSACTION_SCHEMA).parquet(out).count() == 1500


def test_windowed_stream(spark, scratch):
    from txguard.operators.scoring import predict_fraud
    t = predict_fraud(view(spark, SF_SMALL, "transactions")).select(
        "current_time", "amt", "is_fraud_predicted")
    src = scratch + "/in"
    t.write.parquet(src)
    stream = spark.readStream.schema(t.schema).parquet(src)
    w = st.fraud_rate_windows(stream, watermark="2 hours")
    q = st.windowed_stream_sink(w, scratch + "/out", scratch + "/ck")
    st.run_to_completion(q)
    got = spark.read.parquet(scratch + "/out")
    batch = st.fraud_rate_windows(t)
    # append mode emits only windows closed by the watermark: all but the last
    assert got.count() == batch.count() - 1


def test_predict_fraud_with_fitted_pipeline(spark):
    from txguard.operators.alerts import new_alerts
    from txguard.operators.scoring import PipelineScorer, predict_fraud
    train, test = _train_test(spark)
    cand = build_candidates(float(train.count()), include_boosted=False)[0]
    res = fit_candidate(cand, train, test, 0.9)
    batch = view(spark, SF_SMALL, "transactions")
    scored = predict_fraud(batch, PipelineScorer(res.model, "lr"), threshold=0.9, model_alias="champion")
    assert set(batch.columns) <= set(scored.columns)
    rows = scored.select("fraud_probability", "is_fraud_predicted", "model_name").collect()
    assert len(rows) == 1500
    assert all(0.0 <= r[0] <= 1.0 and r[1] == int(r[0] >= 0.9) and r[2] == "lr" for r in rows)
    assert new_alerts(scored, None).count() == sum(r[1] for r in rows)


def test_outcomes_do_not_depend_on_the_order_of_arrival(spark, scratch):
    import random
    from pyspark.sql import types as T
    from txguard.streaming import performance as perf
    rng = random.Random(4)
    predictions = [(f"t{i}", f"2025-01-{1 + i // 4:02d} 10:00:00", (i * 37 % 100) / 100, int(i * 37 % 100 >= 90)) for i in range(80)]
    # three in four get a label, some after the three days that they have
    labels = [(f"t{i}", f"2025-01-{1 + i // 4 + i % 5:02d} 11:00:00" if i % 5 else f"2025-01-{1 + i // 4:02d} 10:00:00", int(i % 7 == 0)) for i in range(80) if i % 4]
    labels += [("unknown", "2025-01-02 00:00:00", 1), (None, "2025-01-02 00:00:00", 1)]
    to_time = lambda df, c: df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    p_schema, y_schema = "trans_num string, predicted_time string, fraud_probability double, is_fraud_predicted int", "trans_num string, label_time string, is_fraud int"
    schema = T.StructType(perf.PREDICTED_SCHEMA.fields + [T.StructField("is_fraud", T.IntegerType())])

    def run(base, files):
        rng.shuffle(predictions)
        rng.shuffle(labels)
        for k in range(files):
            for rows, s, time, name in ((predictions, p_schema, "predicted_time", "p"), (labels, y_schema, "label_time", "y")):
                to_time(spark.createDataFrame(rows[k::files], s), time).coalesce(1).write.mode("append").parquet(f"{base}/{name}")
        go = lambda: st.run_to_completion(perf.start_outcomes_stream(spark, f"{base}/p", f"{base}/y", f"{base}/out", f"{base}/ck", "40 days", max_files_per_trigger=1))
        go()
        before = spark.read.schema(schema).parquet(f"{base}/out").where("is_fraud IS NULL").count()
        to_time(spark.createDataFrame([("end", "2026-01-01 00:00:00", 0.0, 0)], p_schema), "predicted_time").write.mode("append").parquet(f"{base}/p")
        to_time(spark.createDataFrame([("end2", "2026-01-01 00:00:00", 0)], y_schema), "label_time").write.mode("append").parquet(f"{base}/y")
        go()                                           # restarted: the state comes from the checkpoint
        out = spark.read.schema(schema).parquet(f"{base}/out").where("trans_num <> 'end'")
        return before, sorted(map(tuple, out.collect()), key=repr)

    (early, a), (_, b) = run(scratch + "/1", 1), run(scratch + "/3", 3)
    batch = perf.outcomes(to_time(spark.createDataFrame(predictions, p_schema), "predicted_time"), to_time(spark.createDataFrame(labels, y_schema), "label_time"))
    assert early == 0 and a == b == sorted(map(tuple, batch.collect()), key=repr) and len(a) == 80
    assert sum(r[4] is None for r in a) == 20 + sum(1 for i in range(80) if i % 4 and i % 5 >= 3)


def test_windows_take_late_rows_and_repeated_batches(spark, scratch):
    import random
    from txguard.streaming.windows import WindowTable
    rng = random.Random(8)
    rows = [(f"2025-03-{1 + rng.randrange(5):02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}:00", rng.randrange(100000) / 100, rng.randrange(2)) for _ in range(300)]
    df = spark.createDataFrame([*rows, (None, 1.0, 1), ("no time", 1.0, 1)], "current_time string, amt double, is_fraud_predicted int")
    table = WindowTable(spark, scratch + "/w", fan=3)
    parts = df.randomSplit([1.0] * 8, 3)
    for k, part in enumerate(parts):
        assert table.append(part, k)
        assert not table.append(part, k) and not table.append(parts[0], 0)          # run again
    got = {str(r["window_start"]): tuple(r)[1:] for r in table.read().collect()}
    want = {}
    for t, amt, flag in rows:
        start = f"{t[:11]}{int(t[11:13]) // 2 * 2:02d}:00:00"
        n, f, a = want.get(start, (0, 0, 0.0))
        want[start] = (n + 1, f + flag, a + amt * flag)
    assert set(got) == set(want) and len(table.log.latest().tables["parts"]) < 3
    for start, (n, f, a) in want.items():
        assert got[start][1:3] == (n, f) and abs(got[start][3] - f / n) < 1e-12 and abs(got[start][4] - a) < 1e-6
    # the batch form over the same rows
    batch = {str(r["window_start"]): (r["n_transactions"], r["n_predicted_frauds"]) for r in st.fraud_rate_windows(df.where("try_cast(current_time AS TIMESTAMP_NTZ) IS NOT NULL")).collect()}
    assert batch == {k: v[:2] for k, v in want.items()}


def test_fits_read_a_frame_of_one_row_group_on_every_core(spark):
    from txguard.operators.models import FIT_ROWS, spread
    cores = spark.sparkContext.defaultParallelism
    one = spark.range(FIT_ROWS * cores).coalesce(1)
    dealt = spread(one)
    sizes = dealt.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) == cores and sum(sizes) == FIT_ROWS * cores and max(sizes) < 2 * min(sizes)
    few = spread(spark.range(FIT_ROWS).coalesce(1))         # not worth a shuffle
    assert few.rdd.getNumPartitions() == 1
    for df in (dealt, few):
        df.unpersist()


def test_a_micro_batch_of_one_file_is_dealt_over_the_cores(spark, scratch):
    spark.range(400_000).selectExpr("id", "md5(CAST(id AS STRING)) AS text").coalesce(1).write.parquet(scratch)
    one = spark.read.parquet(scratch)
    sizes = lambda df: df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert max(sizes(one)) == 400_000                       # one row group
    dealt = sizes(st.over_all_cores(one))
    assert sum(dealt) == 400_000 and max(dealt) < 200_000


def test_landed_files_hold_a_bounded_number_of_rows(spark, monkeypatch):
    from txguard.plans import entries_ops
    monkeypatch.setattr(entries_ops, "LANDED_ROWS", 100)
    src = entries_ops._landing(spark, spark.range(1000))
    files = [r["n"] for r in spark.read.parquet(src).groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(files) == 10 and max(files) <= 110 and sum(files) == 1000
    assert entries_ops._landed_files(100, 4) == 4


def test_late_rows_query_writes_no_file_of_the_whole_table(spark, monkeypatch):
    from tests.conftest import SF_SMALL
    from txguard.plans import entries_ops
    landed = []
    fresh = entries_ops.fresh_shared_path
    monkeypatch.setattr(entries_ops, "LANDED_ROWS", 200)
    monkeypatch.setattr(entries_ops, "fresh_shared_path", lambda *a: landed.append(fresh(*a)) or landed[-1])
    monkeypatch.setattr(st, "start_dedupe_stream", lambda spark, src, out, *a, **k: spark.read.parquet(src).write.mode("overwrite").parquet(out))
    monkeypatch.setattr(st, "run_to_completion", lambda query: None)
    entries_ops.t2_late(spark, SF_SMALL)
    files = spark.read.parquet(f"{landed[0]}/in").groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()
    # about 1500 rows in all, and those with a key once more
    assert len(files) >= 15 and max(r["n"] for r in files) < 600


def test_first_row_per_key_compares_the_columns_themselves(spark):
    from txguard.operators.dedupe import first_per_key
    d = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), ("a", 1, None), ("b", 3, "y"), ("b", 3, "y"), (None, 1, "z")], "k string, n int, s string")
    first = first_per_key(d, "k", ["n"])
    assert sorted(map(tuple, first.collect())) == [("a", 1, None), ("b", 3, "y")]      # missing values first, as in a struct
    assert "struct" not in first._jdf.queryExecution().executedPlan().toString()       # no second copy of the row


def test_late_rows_are_read_from_the_tables_once(spark):
    import __spark_entry__ as E
    from txguard.plans import entries_ops
    passes, view_ = [], entries_ops.V

    def counted(spark_, sf, name):
        d = view_(spark_, sf, name)
        seen = spark_.sparkContext.accumulator(0)
        passes.append((seen, d.count()))
        return spark_.createDataFrame(d.rdd.map(lambda r: (seen.add(1), r)[1]), d.schema)

    entries_ops.V = counted
    try:
        out = E.queries()["t2_late_rows_dedupe"](spark, SF_SMALL)
    finally:
        entries_ops.V = view_
    assert [(s.value, n) for s, n in passes] == [(n, n) for _, n in passes] and out.count() > 1400


def test_scoring_stream_lands_its_repeats_in_one_pass(spark, monkeypatch):
    import __spark_entry__ as E
    from txguard.plans import entries_ops

    class Landed(Exception):
        pass

    def landing(_, df):
        raise Landed(df)

    monkeypatch.setattr(entries_ops, "_landing", landing)
    try:
        E.queries()["t1_scoring_stream"](spark, SF_SMALL)
    except Landed as e:
        df = e.args[0]
    t, key = view(spark, SF_SMALL, "transactions").select(*df.columns), F.col("trans_num").cast("bigint")
    wanted = t.unionByName(t.where(key % 7 == 0)).unionByName(t.where(key % 11 == 0))
    assert df.count() == wanted.count() and df.exceptAll(wanted).count() == 0
    assert "Union" not in df._jdf.queryExecution().optimizedPlan().toString()
