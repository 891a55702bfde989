from __future__ import annotations

import random
from datetime import datetime, timedelta

from skein.operators.snapshots import snapshot_changes
from skein.operators.state import absence_after, apply_batch
from skein.operators.snapshots import complete_snapshots
from pyspark.sql import functions as F

RUNS = "source_name string, snapshot_id string, started_at timestamp, membership_complete boolean"
ROWS = "source_name string, snapshot_id string, source_faculty_key string, loaded_at timestamp, name string, areas array<string>, homes array<struct<school:string,department:string>>, _key string, content string"
T0 = datetime(2024, 1, 1)


def changes(spark, rows, runs):
    found = snapshot_changes(spark.createDataFrame(rows, ROWS), spark.createDataFrame(runs, RUNS), ["name", "areas", "homes"]).drop("changed_columns")
    out = [tuple(r) for r in found.collect()]
    assert len(out) == len(set(out))
    return set(out)


def runs_of(*flags, source="s"):
    return [(source, f"{source}{n}", T0 + timedelta(days=n), f) for n, f in enumerate(flags)]


def row(snapshot, key, name="a", areas=("x",), homes=(), loaded=0, source="s"):
    return (source, f"{source}{snapshot}", key, T0 + timedelta(hours=loaded), name, list(areas) if areas is not None else None, list(homes), "clash", "clash")


def test_kinds_and_ignored_snapshots(spark):
    rows = [row(0, "K1"), row(0, "k2"), row(1, "k9"), row(2, " k1/ "), row(2, "k3"), row(3, "k3", name="b")]
    got = changes(spark, rows, runs_of(True, False, True, True))
    assert got == {("s", "s2", "k2", "removed"), ("s", "s2", "k3", "added"), ("s", "s3", "k1", "removed"), ("s", "s3", "k3", "changed")}


def test_cosmetic_differences_are_none(spark):
    nbsp, e1, e2 = chr(0xA0), chr(0xE9), "e" + chr(0x301)
    rows = [row(0, "k", f"Jos{e1} A", ["x", "y"], [("S", None), ("T", "d")]), row(1, "K", f"  Jos{e2}{nbsp} A ", ["y ", "x"], [("T", "d"), ("S", "")])]
    rows += [row(0, "n", None, None), row(1, "n", "", [])]
    assert changes(spark, rows, runs_of(True, True)) == set()


def test_last_loaded_counts_and_ties_are_settled(spark):
    rows = [row(0, "k", "a"), row(1, "k", "b", loaded=1), row(1, "k/", "a", loaded=2), row(1, "k", "c", loaded=0)]
    assert changes(spark, rows, runs_of(True, True)) == set()
    tied = [row(0, "k", "a"), row(1, "k", "b", loaded=1), row(1, "k", "c", loaded=1)]
    assert changes(spark, tied, runs_of(True, True)) == {("s", "s1", "k", "changed")}


def test_empty_snapshot_removes_all_and_empty_tables_give_nothing(spark):
    assert changes(spark, [row(0, "k"), row(2, "k")], runs_of(True, True, True)) == {("s", "s1", "k", "removed"), ("s", "s2", "k", "added")}
    assert changes(spark, [], runs_of(True)) == set()
    assert changes(spark, [row(0, "k")], []) == set()


def test_nulls_are_no_records(spark):
    rows = [(None, "s0", "k", None, None, None, None, None, None), ("s", None, "k", None, None, None, None, None, None), ("s", "s0", None, None, None, None, None, None, None)]
    assert changes(spark, rows + [("s", "s1", "k", None, None, None, None, None, None)], runs_of(True, True)) == {("s", "s1", "k", "added")}


def test_random_histories_against_brute_force(spark):
    rnd = random.Random(5)
    rows, runs, expected = [], [], set()
    for source in "abc":
        flags = [rnd.random() < 0.8 for _ in range(7)]
        runs += runs_of(*flags, source=source)
        before = None
        for n, complete in enumerate(flags):
            now = {f"k{k}": rnd.choice("pqr") for k in range(12) if rnd.random() < 0.7}
            rows += [row(n, k, v, source=source) for k, v in now.items()]
            if not complete:
                continue
            if before is not None:
                for k in now.keys() | before.keys():
                    kind = "added" if k not in before else "removed" if k not in now else "changed" if now[k] != before[k] else None
                    if kind:
                        expected.add((source, f"{source}{n}", k, kind))
            before = now
    assert changes(spark, rows, runs + runs) == expected


def test_absences_match_batches_applied_one_by_one(spark):
    rnd = random.Random(8)
    flags = [True, True, False, True, True, True]
    present = [[f"k{k}" for k in range(8) if rnd.random() < 0.5] for _ in flags]
    state = spark.createDataFrame([], "key string, v int, is_active boolean, missed int, last_seen timestamp")
    for n, (flag, keys) in enumerate(zip(flags, present, strict=True)):
        if flag:
            state = apply_batch(state, spark.createDataFrame([(k, n) for k in keys], "key string, v int"), ["key"], ["v"], flag, F.lit(T0 + timedelta(days=n)))
    one_by_one = {r.key: (r.missed, r.is_active) for r in state.collect()}
    rows = spark.createDataFrame([("s", f"s{n}", k) for n, keys in enumerate(present) for k in keys], "source_name string, snapshot_id string, key string")
    timeline = complete_snapshots(spark.createDataFrame(runs_of(*flags), RUNS))
    assert {r.key: (r.missed, r.is_active) for r in absence_after(rows, timeline, F.col("key")).collect()} == one_by_one


def test_the_diff_needs_one_shuffle_of_the_records_by_range(spark):
    rows = spark.createDataFrame([row(0, "k"), row(1, "k", "b")], ROWS)
    found = snapshot_changes(rows, spark.createDataFrame(runs_of(True, True), RUNS), ["name", "areas", "homes"]).drop("changed_columns")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1
    window = plan[plan.index("Window [") : plan.index("rangepartitioning")]
    assert "hashpartitioning" not in window


def test_kept_snapshots_give_the_same_changes(spark, tmp_path):
    from skein.operators.snapshots import Archive

    shape = "source_name string, snapshot_id string, source_faculty_key string, loaded_at timestamp, name string, areas array<string>, junk string"
    at = datetime(2024, 1, 1)
    rows = [("s", "1", "K/a/", at, "Ann", ["x", "y"], ""), ("s", "1", "k/b", at, "Bob", None, ""), ("s", "1", "k/d", at, "Dan", [], ""), ("s", "2", " k/A", at, "Ann  ", ["y", "x"], "z"), ("s", "2", "k/b", at, "Rob", ["q"], ""), ("s", "2", "k/c", at, "Cy", [], ""), ("t", "1", "k/a", at, "other", None, "")]
    records = spark.createDataFrame(rows, shape)
    archive = Archive(spark, f"file://{tmp_path}/kept", ["name", "areas"])
    for snapshot in ("1", "2", "2", "3"):
        archive.keep(records, "s", snapshot)
    got = {(r.source_faculty_key, r.change_kind, tuple(r.changed_columns)) for r in archive.changes("s", "1", "2").collect()}
    assert got == {("k/b", "changed", ("name", "areas")), ("k/c", "added", ()), ("k/d", "removed", ())}
    assert {(r.source_faculty_key, r.change_kind) for r in archive.changes("s", "2", "3").collect()} == {("k/a", "removed"), ("k/b", "removed"), ("k/c", "removed")}
    assert archive.changes("s", "2", "2").count() == 0
