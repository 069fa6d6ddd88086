import datetime as dt
import random

from gaugeworks.operators import orphans

T0 = dt.datetime(2025, 1, 1)


def day(n):
    return None if n is None else T0 + dt.timedelta(days=n)


def truth(key, at, lives):
    mine = [(s, e) for k, s, e in lives if k == key]
    if at is not None and any(s is not None and s <= at and (e is None or at < e) for s, e in mine):
        return None
    if not mine:
        return "missing"
    return "deleted" if at is not None and any(s is not None and s <= at for s, _ in mine) else "late"


def checked(spark, refs, lives):
    r = spark.createDataFrame([("t", i, "f", k, day(a)) for i, (k, a) in enumerate(refs)], "src_table string, row_key long, ref_field string, key string, at timestamp")
    l = spark.createDataFrame([(k, day(s), day(e)) for k, s, e in lives], "key string, start timestamp, end timestamp")
    return {x["row_key"]: x["orphan_reason"] for x in orphans.check_references(r, l).collect()}


def test_against_all_pairs(spark):
    rng = random.Random(5)
    n = lambda: rng.choice([None, *range(8)])
    lives = [(rng.choice("abcd"), n(), n()) for _ in range(60)]
    refs = [(rng.choice("abcdef"), n()) for _ in range(400)]
    assert checked(spark, refs, lives) == {i: truth(k, a, lives) for i, (k, a) in enumerate(refs)}


def test_hot_key_and_ties(spark):
    lives = [("hot", 1, 3)] * 500 + [("hot", 5, None)] * 200 + [("x", 2, 2)]
    refs = [("hot", i % 7) for i in range(3000)] + [("x", 2), ("x", 1)]
    want = {i: truth(k, a, set(lives)) for i, (k, a) in enumerate(refs)}
    assert checked(spark, refs, lives) == want


def test_empty_tables(spark):
    assert checked(spark, [], [("a", 1, None)]) == {}
    assert checked(spark, [("a", 1)], []) == {0: "missing"}


def test_cascade_to_the_fixpoint(spark):
    # a chain, a fork and a cycle
    rows = [("s", 1, "g1", None), ("s", 2, "g2", "g1"), ("s", 3, "g3", "g2"), ("l", 4, None, "g3"), ("l", 5, None, "g9"), ("s", 6, "g1", "g3"), ("l", None, None, None)]
    records = spark.createDataFrame(rows, "src_table string, row_key long, own string, up string")
    direct = spark.createDataFrame([("s", 1), ("s", 1)], "src_table string, row_key long")
    got = {(r["src_table"], r["row_key"]): r["depth"] for r in orphans.cascade(direct, records).collect()}
    assert got == {("s", 2): 1, ("s", 3): 2, ("l", 4): 3, ("s", 6): 3}


def test_long_chain_and_shortcut(spark):
    rows = [("s", i, f"g{i}", f"g{i - 1}" if i else None) for i in range(11)] + [("s", 20, "g6", "g0"), ("s", 21, "g10", "g10")]
    records = spark.createDataFrame(rows, "src_table string, row_key long, own string, up string")
    got = {r["row_key"]: r["depth"] for r in orphans.cascade(spark.createDataFrame([("s", 0)], "src_table string, row_key long"), records).collect()}
    assert got == {**{i: i for i in range(1, 7)}, **{i: i - 5 for i in range(7, 11)}, 20: 1, 21: 6}


def test_run_tables_with_nulls(spark):
    it = spark.createDataFrame([(1, "r", "baseline", " ", None, day(1), 7), (2, "r", "iter1", "./a//b/", "x", day(2), 7), (None, None, None, None, None, None, None)], "state_id long, run_id string, iter string, best_ckpt_path string, inference_csv string, updated_at timestamp, key int")
    log = spark.createDataFrame([(9, "r", "iter1", " Train ", day(2)), (8, "r", "iter2", "nope", day(2))], "log_id long, run_id string, iter string, stage string, ts timestamp")
    art = spark.createDataFrame([("file://a/./b", day(1), None)], "artifact_path string, created_at timestamp, deleted_at timestamp")
    stages = spark.createDataFrame([("train", day(0), None)], "stage_name string, introduced_at timestamp, retired_at timestamp")
    got = {(r["src_table"], r["row_key"], r["ref_field"], r["orphan_reason"], r["ref_month"], r["orphan_kind"], r["depth"]) for r in orphans.run_orphans(it, log, art, stages).collect()}
    assert got == {("deft_iterations", 2, "inference_csv", "missing", "2025-01", "direct", 0), ("loop_log", 8, "stage", "missing", "2025-01", "direct", 0), ("loop_log", 9, None, None, "2025-01", "inherited", 1)}
