import datetime as dt

from pyspark.sql import functions as F

from stationcast.operators import store as S

H = dt.datetime(2024, 1, 1)


def frame(spark, data):
    return spark.createDataFrame(data, "pickup_hour timestamp_ntz, start_station_id string, rides bigint")


def ordered(df, order=None, group="g"):
    """Packed rows with a write order."""
    return S.feature_json(df.withColumn("n", F.lit(1) if order is None else order), group, order_col="n")


def test_upsert_last_write_wins_within_and_across_batches(spark):
    b1 = frame(spark, [(H, "a", 1), (H, "b", 1)])
    b2 = frame(spark, [(H, "a", 4), (H, "a", 3), (H, "a", 2)])
    store = S.upsert_features(None, [ordered(b1)])
    store = S.upsert_features(store, [ordered(b2, F.when(F.col("rides") == 3, 9).otherwise(1))])
    got = {r.entity_id: r.rides for r in S.feature_json_unpack(store, S.feature_schema(b1)).collect()}
    assert got == {"a": 3, "b": 1}


def test_get_features_filters_and_empty(spark):
    b = frame(spark, [(H + dt.timedelta(hours=i), s, i) for i in range(5) for s in ("a", "b")])
    store = S.feature_json(b, "g")
    schema = S.feature_schema(b)
    assert S.get_features(store, "g", schema, "a", H, H + dt.timedelta(hours=2)).count() == 3
    assert S.get_features(store, "g", schema, ["zz"]).count() == 0
    assert S.get_features(store, "other", schema).count() == 0


def test_registry_update_keeps_created_at(spark):
    reg = S.upsert_feature_group(S.empty_registry(spark),
                                 spark.createDataFrame([("g", "first")], "name string, description string"), H)
    later = H + dt.timedelta(days=1)
    reg = S.upsert_feature_group(reg, spark.createDataFrame([("g", "second")], "name string, description string"), later)
    r = reg.first()
    assert (r.description, r.created_at, r.updated_at) == ("second", H, later)


def test_store_format_requires_timestamp_column(spark):
    import pytest
    with pytest.raises(ValueError):
        S.store_format(frame(spark, [(H, "a", 1)]), "start_station_id", "missing", H)


def test_upsert_into_store_touches_only_batch_partitions(spark, tmp_path):
    root = str(tmp_path / "store")
    jan = frame(spark, [(H, "a", 1), (H, "b", 1)])
    feb = frame(spark, [(dt.datetime(2024, 2, 3), "a", 5)])
    S.upsert_into_store(spark, root, ordered(jan.unionByName(feb)))
    touched = S.upsert_into_store(spark, root, ordered(frame(spark, [(H, "a", 9)])))
    assert [tuple(r) for r in touched.collect()] == [("g", "2024-01")]
    got = {(r.entity_id, r.timestamp.month): r.rides
           for r in S.feature_json_unpack(S.read_store(spark, root), S.feature_schema(jan)).collect()}
    assert got == {("a", 1): 9, ("b", 1): 1, ("a", 2): 5}


def contents(spark, root):
    return {(r.feature_group, r.entity_id, r.timestamp): r.feature_data for r in S.read_store(spark, root).collect()}


def test_group_names_keep_their_text(spark, tmp_path):
    root = str(tmp_path / "store")
    for rides in (1, 2):
        for group in ("007", "city:bike=1", "a b/c"):
            S.upsert_into_store(spark, root, ordered(frame(spark, [(H, "a", rides)]), group=group))
    assert {(k[0], v) for k, v in contents(spark, root).items()} == {
        (g, '{"rides":2}') for g in ("007", "city:bike=1", "a b/c")}


def test_repeated_keys_in_one_batch(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = frame(spark, [(H, "a", i) for i in range(50)])
    S.upsert_into_store(spark, root, ordered(rows, -F.col("rides")))
    assert list(contents(spark, root).values()) == ['{"rides":0}']
    S.upsert_into_store(spark, root, ordered(rows))   # equal orders: the larger payload text
    assert list(contents(spark, root).values()) == ['{"rides":9}']


def test_a_lost_run_changes_nothing_or_can_be_finished(spark, tmp_path, monkeypatch):
    import shutil
    root, staged = str(tmp_path / "store"), str(tmp_path / "staged")
    feb = frame(spark, [(dt.datetime(2024, 2, 3), "a", 5), (dt.datetime(2024, 2, 3), "b", 6)])
    S.upsert_into_store(spark, root, ordered(frame(spark, [(H, "a", 1), (H, "b", 1)]).unionByName(feb)))
    before = contents(spark, root)
    # lost between staging and publishing
    publish = S.publish
    monkeypatch.setattr(S, "publish", lambda *a: None)
    S.upsert_into_store(spark, root, ordered(frame(spark, [(H, "a", 7), (dt.datetime(2024, 2, 3), "a", 8)])), staged=staged)
    assert contents(spark, root) == before
    # lost while partitions were put in place: one is gone, the other is old
    shutil.rmtree(tmp_path / "store" / "feature_group=g" / "ts_month=2024-01")
    publish(spark, root, staged)
    want = {"2024-01-01 00:00:00": {"a": 7, "b": 1}, "2024-02-03 00:00:00": {"a": 8, "b": 6}}
    for again in range(2):
        got = {}
        for (_, entity, ts), payload in contents(spark, root).items():
            got.setdefault(ts, {})[entity] = int(payload.split(":")[1].rstrip("}"))
        assert got == want
        publish(spark, root, staged)


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    import glob
    root = str(tmp_path / "store")
    files = lambda month: sorted(glob.glob(f"{root}/feature_group=g/ts_month={month}/*.parquet"))
    S.upsert_into_store(spark, root, ordered(frame(spark, [(H, "a", 1), (dt.datetime(2024, 2, 3), "a", 5)])))
    jan, feb = files("2024-01"), files("2024-02")
    S.upsert_into_store(spark, root, ordered(frame(spark, [(H, "b", 1)])))
    assert files("2024-02") == feb and files("2024-01") != jan


def test_latest_record_by_event_then_insertion(spark):
    rows = [("a", "2024-01-01T00:00:00Z", "2024-01-05T00:00:00Z", 1), ("a", "2024-01-02T00:00:00Z", "2024-01-03T00:00:00Z", 2),
            ("a", "2024-01-02T00:00:00Z", "2024-01-04T00:00:00Z", 3), ("b", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z", 4)]
    df = spark.createDataFrame(rows, "entity_id string, event_time string, record_insertion_time string, x int")
    assert sorted((r.entity_id, r.x) for r in S.latest_record(df).collect()) == [("a", 3), ("b", 4)]


def test_latest_record_shuffles_the_newest_records_only(spark, monkeypatch):
    rows = [(f"e{i % 50}", f"2024-01-{1 + (i * 7) % 28:02d}T00:00:00Z", f"2024-02-{1 + i % 3:02d}T00:00:00Z", i) for i in range(3000)]
    rows += [("stale", "2019-01-01T00:00:00Z", None, -1), ("untimed", None, None, -2), (None, "2024-01-01T00:00:00Z", None, -3)]
    df = spark.createDataFrame(rows, "entity_id string, event_time string, record_insertion_time string, x int")
    best = {}
    for entity, event, inserted, _ in rows:
        best[entity] = max(best.get(entity, ("", "")), (event or "", inserted or ""))
    want = sorted((e, *b) for e, b in best.items() if e is not None)
    for bits in (S.MARK_BITS, 6):        # few marks: most older records pass by chance, and the join drops them
        monkeypatch.setattr(S, "MARK_BITS", bits)
        latest = S.latest_record(df)
        got = latest.collect()
        assert sorted((r.entity_id, r.event_time or "", r.record_insertion_time or "") for r in got) == want
        plan = latest._jdf.queryExecution().sparkPlan().toString()
        assert any("BroadcastHashJoin" in line and "_word" in line for line in plan.splitlines())


def test_files_of_a_partition_grow_with_its_rows(spark, tmp_path, monkeypatch):
    import glob
    monkeypatch.setattr(S, "ROWS_A_FILE", 20)
    root, staged = str(tmp_path / "store"), str(tmp_path / "staged")
    S.upsert_into_store(spark, root, ordered(frame(spark, [(H, f"e{i}", i) for i in range(400)])))
    files = lambda at: glob.glob(f"{at}/feature_group=g/ts_month=2024-01/*.parquet")
    assert len(files(root)) > S.FILES
    S.upsert_into_store(spark, root, ordered(frame(spark, [(H, f"e{i}", -i) for i in range(200, 600)])), staged=staged)
    assert len(files(staged)) > S.FILES          # laid out as the store: publishing is a copy
    got = {k[1]: int(v.split(":")[1].rstrip("}")) for k, v in contents(spark, root).items()}
    assert got == {f"e{i}": i if i < 200 else -i for i in range(600)}


def test_second_batch_is_read_once(spark):
    from stationcast.plans import q_store
    b, b1, b2 = q_store.ordered_batches(spark, "/root/testdata/sf0.001")
    scans = lambda df: df._jdf.queryExecution().sparkPlan().toString().count("FileScan")
    assert scans(b2) == scans(b) == scans(b1)
    _, _, plain = q_store.batches(spark, "/root/testdata/sf0.001")
    want = plain.withColumn("n", F.lit(2)).unionByName(plain.withColumn("rides", F.col("rides") - 5).withColumn("n", F.lit(1)))
    assert b2.columns == want.columns and b2.exceptAll(want).count() == want.exceptAll(b2).count() == 0
