"""The two streams: layouts, late and replayed rows, end records, deltas and compaction."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from linkspark.plans.q_stream import N_SLICES, arrivals
from linkspark.streaming import metrics as SM
from linkspark.streaming import votes as SV

START = datetime(2024, 1, 1)
EVENTS = "event_id long, ts timestamp, event_type string, value double, extra string"


def run(spark, events, folder, n_slices=N_SLICES):
    SM.write_slices(events, "slice", n_slices, f"{folder}/in")
    progress = SM.run_windowed_metrics(spark, f"{folder}/in", f"{folder}/out", f"{folder}/c1")
    SM.run_late_rows(spark, f"{folder}/in", f"{folder}/late", f"{folder}/c2")
    windows = spark.read.schema("window_start timestamp, metric string, n long, avg_value double").parquet(f"{folder}/out")
    late = SM.late_rows(spark, f"{folder}/late")
    rows = sorted((r.window_start, r.metric, r.n, r.n_late) for r in SM.with_late(windows, late).collect())
    return progress, rows, late


def test_layouts_give_the_same_windows(spark, tmp_path):
    ev = spark.range(4000).select(
        F.col("id").alias("event_id"), (F.lit(START) + F.make_dt_interval(mins=F.col("id") * 2)).cast("timestamp").alias("ts"),
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("event_type"), F.col("id").cast("double").alias("value"), F.lit("x").alias("extra"))
    seen = []
    for parts, order in ((1, "event_id"), (4, F.rand(3)), (16, F.rand(4))):
        progress, rows, late = run(spark, arrivals(ev).repartition(parts).sortWithinPartitions(order), tmp_path / str(parts))
        batches = [p for p in progress if p["numInputRows"] > 0]
        assert len(batches) >= N_SLICES
        dropped = sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])
        assert late.count() == dropped > 0
        seen.append(rows)
    assert seen[0] and seen[0] == seen[1] == seen[2] and sum(r[3] for r in seen[0]) > 0


def test_late_and_replayed_rows(spark, tmp_path):
    at = lambda minutes: START + timedelta(minutes=minutes)
    rows = [(1, at(5), "a", 1.0, 0), (2, at(70), "a", 2.0, 0), (1, at(5), "a", 1.0, 1), (3, at(300), "a", 3.0, 1),
            (4, at(10), "a", 4.0, 2), (5, at(400), "a", 5.0, 2), (2, at(70), "a", 2.0, 3), (6, at(900), "a", 6.0, 3)]
    events = spark.createDataFrame([(i, t, k, v, "x", s) for i, t, k, v, s in rows], f"{EVENTS}, slice int")
    _, got, late = run(spark, events, tmp_path, 4)
    # slice 2 is held against slice 0 (01:10 less ten minutes), slice 3 against slice 1 (05:00 less ten minutes)
    assert sorted((r.event_id, r.epoch) for r in late.collect()) == [(2, 3), (4, 2)]
    assert [(r[0].hour, r[2], r[3]) for r in got if r[0].hour < 2] == [(0, 1, 1), (1, 1, 1)]


def test_no_events(spark, tmp_path):
    none = spark.createDataFrame([], f"{EVENTS}, slice int")
    SM.write_slices(none, "slice", 3, str(tmp_path / "in"))
    assert spark.read.parquet(str(tmp_path / "in")).count() == 0


CATALOG = [("db", f"T{i}", c) for i in range(40) for c in ("x", "y")]


def vote(spark, tmp_path, files, n_voters, final_mode="maj2", compact_every=8):
    """Each of ``files`` (lists of link or end rows) is one micro-batch, in order; manifests and folder sizes by epoch."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    catalog = spark.createDataFrame(CATALOG, "db_id string, tbl string, col string")
    found = []
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, SV.LINK_SCHEMA).coalesce(1).write.parquet(f"{src}/f={k}")
        SV.run_incremental_vote(spark, f"{src}/f=*", catalog, out, str(tmp_path / "ckpt"), n_voters, final_mode, compact_every=compact_every)
        found.append((SV.manifest(spark, out), sorted((r.question_id, r.tbl, r.col or "", r.votes) for r in SV.latest_publication(spark, out).collect())))
    return found, out


def link(q, voter, tbl, col=None):
    return (q, "db", voter, tbl, col, None)


def end(voter, n):
    return (None, None, voter, None, None, n)


def test_a_voter_with_invalid_links_only_is_present(spark, tmp_path):
    files = [[link(1, 1, "T1", "x"), link(1, 1, "t1", "X"), end(1, 2)], [link(1, 2, "T1"), end(2, 1)], [link(1, 3, "nowhere"), end(3, 1)]]
    found, _ = vote(spark, tmp_path, files, 3)
    assert [m["mode"] for m, _ in found] == ["union", "union", "maj2"]
    assert found[1][1] == [(1, "T1", "", 2), (1, "T1", "x", 1)] and found[2][1] == [(1, "T1", "", 2)]


def test_a_voter_without_links_is_present(spark, tmp_path):
    found, _ = vote(spark, tmp_path, [[link(1, 1, "T1"), end(1, 1)], [end(2, 0)]], 2, "maj2_or_lead")
    assert [m["mode"] for m, _ in found] == ["union", "maj2_or_lead"] and found[1][1] == [(1, "T1", "", 1)]


def test_a_voter_in_two_files_does_not_count_early(spark, tmp_path):
    files = [[link(1, 1, "T1"), end(1, 2), end(2, 1)], [link(1, 2, "T1")], [link(2, 1, "T2")]]
    found, _ = vote(spark, tmp_path, files, 2)
    assert [m["mode"] for m, _ in found] == ["union", "union", "maj2"]
    assert found[2][1] == [(1, "T1", "", 2)]


def folder_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_an_epoch_writes_what_changed(spark, tmp_path):
    many = [link(q, 1, f"T{q % 40}", "x") for q in range(5000)]
    found, out = vote(spark, tmp_path, [many, [link(1, 2, "T1")], [end(1, 5000)]], 2)
    sizes = [folder_bytes(f"{out}/delta/epoch={e}") for e in sorted(SV._epochs(spark, f"{out}/delta"))]
    assert sizes[0] > 5 * max(sizes[1:]) and len(found[-1][1]) == 10_000
    assert (1, "T1", "", 2) in found[-1][1]


def test_compaction_keeps_the_publication(spark, tmp_path):
    files = [[link(q, v, f"T{q}", "y" if v % 2 else None)] for v in (1, 2) for q in (1, 2)] + [[end(v, 2) for v in (1, 2)]]
    often, out = vote(spark, tmp_path / "a", files, 2, compact_every=2)
    never, _ = vote(spark, tmp_path / "b", files, 2, compact_every=99)
    assert [rows for _, rows in often] == [rows for _, rows in never]
    assert often[-1][0]["base"] is not None and len(often[-1][0]["deltas"]) < 2 and never[-1][0]["base"] is None


def test_votes_are_kept_in_files(spark, tmp_path):
    # a vote that comes again, in a later epoch and spelt otherwise, is one; no executor keeps what has come before
    files = [[link(1, 1, "T1", "x"), link(7, 1, "T2", "y"), end(2, 3)], [link(1, 1, "t1", "X"), link(1, 2, "T1"), link(7, 2, "T2")],
             [link(1, 2, "T1", "x"), end(1, 3)]]
    found, out = vote(spark, tmp_path, files, 2, compact_every=3)
    assert not os.path.exists(tmp_path / "ckpt" / "state")
    m, rows = found[-1]
    assert m["mode"] == "maj2" and m["voters"] == {1: {"seen": 3, "sent": 3}, 2: {"seen": 3, "sent": 3}}
    assert [r[1:] for r in found[0][1]] == [("T1", "", 1), ("T1", "x", 1), ("T2", "", 1), ("T2", "y", 1)]
    assert rows == [(1, "T1", "", 2), (1, "T1", "x", 2), (7, "T2", "", 2)]
    kept = spark.read.parquet(f"{out}/base/epoch={m['base']}")
    assert m["deltas"] == [] and kept.count() == kept.distinct().count() == 5


def test_an_unfinished_manifest_is_not_followed(spark, tmp_path):
    found, out = vote(spark, tmp_path, [[link(1, 1, "T1")], [link(1, 2, "T1")]], 2)
    last = SV._epochs(spark, f"{out}/manifest")[-1]
    half = f"{out}/manifest/epoch={last + 1}"
    os.makedirs(half)
    with open(f"{half}/part-0.parquet", "wb") as f:
        f.write(b"torn")
    assert SV.manifest(spark, out)["epoch"] == last
    assert sorted((r.question_id, r.tbl, r.col or "", r.votes) for r in SV.latest_publication(spark, out).collect()) == found[-1][1]


def test_nothing_published(spark, tmp_path):
    assert SV.latest_publication(spark, str(tmp_path)).collect() == []
    with pytest.raises(Exception):
        spark.read.parquet(str(tmp_path / "manifest")).collect()
