"""Operators against plain Python on small frames, with the reference's documented cases."""

import random

import pytest
from pyspark.sql import functions as F

from gaugeworks.functions import labels, numbers, paths
from gaugeworks.operators import dataset, evaluation, gaps, quality, runlog, similarity, thresholds
from gaugeworks.operators.prefix import prefix_sums, with_next_known, with_previous
from gaugeworks.session import materialize, release, release_all


def test_prefix_sums(spark):
    rng = random.Random(1)
    vals = [(i, rng.choice([None, 1, 2, 5])) for i in range(500)]
    df = spark.createDataFrame(rng.sample(vals, 500), "i int, v long")
    got = {r["i"]: r["before"] for r in prefix_sums(df, ["i"], {"before": F.col("v")}).collect()}
    run = 0
    for i, v in vals:
        assert got[i] == run
        run += v or 0
    assert prefix_sums(df.limit(0), ["i"], {"before": F.col("v")}).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_neighbours_across_partitions(spark, seed):
    """Groups that span many partitions, fit one, or hold no known value."""
    rng = random.Random(seed)
    groups = ["hot"] * 12 + ["a", "b", None, "c"]
    rows = [(rng.choice(groups), i, rng.choice([None] * (seed * 10 + 1) + [i])) for i in range(400)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "g string, o int, v int")
    prev = {r["o"]: (r["prev_v"], r["prev_row"]) for r in with_previous(df, ["g"], ["o"], ["v"]).collect()}
    known = {r["o"]: r["nx"] for r in with_next_known(df, ["g"], ["o"], "v", "nx").collect()}
    for g in set(groups):
        mine = [(o, v) for gg, o, v in rows if gg == g]
        for i, (o, _) in enumerate(mine):
            assert prev[o] == ((mine[i - 1][1], True) if i else (None, False))
            assert known[o] == next((v for _, v in mine[i:] if v is not None), None)
    assert with_previous(df.limit(0), ["g"], ["o"], ["v"]).count() == with_next_known(df.limit(0), ["g"], ["o"], "v", "nx").count() == 0


def test_materialized_tables_go_away(spark):
    df = materialize(spark.range(5))
    assert df.count() == 5
    release(df)
    with pytest.raises(Exception):
        spark.read.parquet(df.inputFiles()[0]).count()
    other = materialize(spark.range(5)).inputFiles()[0]
    release_all(spark)
    with pytest.raises(Exception):
        spark.read.parquet(other).count()


@pytest.mark.parametrize("seed", [1, 2])
def test_sweep_equals_counting(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice([" pass", "PASS", "bridge", "shift"]), rng.choice([0.1, 0.2, 0.5, 0.9])) for i in range(60)] + [(99, "bridge", None)]
    s = thresholds.scored(spark.createDataFrame(rows, "i int, label string, score double"), "i", "label", "score")
    got = {r["threshold"]: (r["tp"], r["fp"], r["tn"], r["fn"]) for r in thresholds.threshold_sweep(s).collect()}
    known = [(l.strip().upper() != "PASS", x) for _, l, x in rows if x is not None]
    for t in [*{x for _, x in known}, numbers.just_below(min(x for _, x in known))]:
        assert got.pop(t) == tuple(sum(d == dd and (x > t) == above for d, x in known) for dd, above in ((True, True), (False, True), (False, False), (True, False)))
    assert not got


def test_one_class_only(spark):
    s = thresholds.scored(spark.createDataFrame([(1, "PASS", 0.5), (2, "PASS", 0.7)], "i int, label string, score double"), "i", "label", "score")
    sweep = materialize(thresholds.threshold_sweep(s))
    assert thresholds.recall_100(sweep).count() == 0 and thresholds.best_f1(sweep).count() == 1
    assert thresholds.threshold_sweep(s.limit(0)).count() == 0 and thresholds.histogram(s.limit(0)).count() == 0


def test_okng(spark):
    cases = {"NG": "NG", "ok then ng.": "NG", "token": "UNKNOWN", None: "UNKNOWN", "OKNG": "UNKNOWN", " Ng, OK ": "OK"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r["t"]: r["o"] for r in df.select("t", labels.okng(F.col("t")).alias("o")).collect()} == cases
    rows = gaps.judged(spark.createDataFrame([("NG", "NG"), ("OK", "OK")], "a string, b string"), F.col("a"), F.col("b"))
    assert gaps.kpi_gate(gaps.okng_confusion(rows), "accuracy", 0.9, "benchmark").first()["met"] is True
    blocked = rows.unionByName(gaps.judged(spark.createDataFrame([("NG", "maybe")], "a string, b string"), F.col("a"), F.col("b")))
    assert gaps.kpi_gate(gaps.okng_confusion(blocked), "accuracy", 0.9, "benchmark").first()["met"] is False
    assert gaps.kpi_gate(gaps.okng_confusion(rows), "accuracy", 0.9, "proxy").first()["met"] is None


def test_first_present_key_wins_even_if_null(spark):
    df = spark.createDataFrame([('{"gt": null, "label": "OK"}',), ('{"label": "NG"}',), ("{}",)], "b string").select(gaps.first_present(F.parse_json("b"), gaps.TRUTH_KEYS).alias("x"))
    assert [r["x"] for r in df.collect()] == [None, "NG", None]


def test_names_and_paths(spark):
    df = spark.createDataFrame([("a/PCB+bridge_00012.png",), ("a\\PCB.png",), (None,)], "p string")
    assert [r[0] for r in df.select(labels.defect_type(F.col("p"))).collect()] == ["bridge", "unknown", "unknown"]
    same = ["/a/b", " /a//b/ ", "file:///a/./b", "\\a\\b", "/./a/b//"]
    df = spark.createDataFrame([(x,) for x in same + ["A/B", "./A/b", "a/b/."]], "p string").select(paths.path_key(F.col("p")).alias("k"), paths.path_key(F.col("p"), True).alias("f"))
    keys = df.collect()
    assert {r["k"] for r in keys[:5]} == {"/a/b"} and [r["k"] for r in keys[5:]] == ["A/B", "A/b", "a/b"] and {r["f"] for r in keys[5:]} == {"a/b"}
    blank = spark.createDataFrame([("",), (" ",), ("./",), ("file://",), (None,)], "p string").select(paths.path_key(F.col("p")).alias("k"))
    assert {r["k"] for r in blank.collect()} == {None}


def test_targets(spark):
    texts = ["FAR <= 5 % at recall = 99.5 %", " far < .5%", "quality score>=5. at night ", "FAR <= 5", "accuracy gte 0.9", "x >= +1", "nonsense", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string").select("i", labels.parse_target(F.col("t")).alias("x"))
    got = [tuple(r["x"]) if r["x"] else None for r in df.orderBy("i").collect()]
    assert got == [
        ("far_pct", "FAR", "<=", 5.0, "%", "far_at_recall", 99.5, None),
        ("far_pct", "far", "<", 0.5, "%", "far_at_recall", 100.0, None),
        ("quality_score", "quality score", ">=", 5.0, "", "unconfigured", None, "night"),
        ("far", "FAR", "<=", 5.0, "", "unconfigured", None, None),
        *[None] * 4,
    ]


def applied(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_identifiers(spark):
    assert applied(spark, labels.platform_slug, [" Docker_GPU  x", "a--b-", "a/b", "", "-", "x" * 33, "myPlatform", None]) == ["docker-gpu-x", "a-b", None, None, None, None, "myplatform", None]
    assert applied(spark, labels.safe_id, ["a b/c", "..x..", "--", "", "_a_", None]) == ["a-b-c", "x", "job", "job", "a_", "job"]
    assert applied(spark, labels.gpu_arch, [" SM_103a", "sm-90", "compute_90", "90f", "9.0", "12.1A", "sm_9", "9", "x", "", None]) == ["sm_103a", "sm_90", "sm_90", "sm_90f", "sm_90", "sm_121a", None, None, None, None, None]
    assert applied(spark, lambda c: labels.gpu_supported(c, ["sm_90a", "10.0"]), ["90", "100f", "80", "?"]) == [True, True, False, None]
    assert applied(spark, labels.label_in_name, ["a+b_1.png", "a+b.png", "a.png", "a+_1.png", None]) == ["b", "b", None, None, None]
    assert applied(spark, numbers.format_duration, [0, -5, 59, 60, 3599, 3600, 7325, None], "long") == ["not recorded", "not recorded", "59s", "1m 0s", "59m 59s", "1h 0m", "2h 2m", "not recorded"]
    assert applied(spark, lambda c: paths.resolve(c, "/data"), ["a/../b", "../../x", "/a/./b/..", "..", "", "a//b/", None]) == ["/data/b", "/x", "/a", "/", "/data", "/data/a/b", None]


def test_floor_and_blocks(spark, monkeypatch):
    v = lambda rows: spark.createDataFrame(rows, "id long, vec array<double>, label string")
    targets, pool = v([(1, [1.0, 0.0], "a"), (2, [2.0, 0.0], "b"), (3, [0.0, 0.0], "a")]), v([(10, [1.0, 0.0], "a"), (11, [0.0, 1.0], "b"), (12, None, "a"), (13, [1.0], "a")])
    for size in (1 << 20, 0):
        monkeypatch.setattr(similarity, "BROADCAST_BYTES", size)
        got = {r["id"]: (r["kept"], r["matched_target"]) for r in similarity.similarity_floor(pool, targets, 0.9).collect()}
        assert got == {10: (True, 1), 11: (False, 1)}
        assert [(r["t_id"], r["s_id"]) for r in similarity.nearest(targets, pool, 1).orderBy("t_id").collect()] == [(1, 10), (2, 10)]


@pytest.mark.parametrize("size", [1 << 20, 0])
def test_semantic_duplicates(spark, monkeypatch, size):
    monkeypatch.setattr(similarity, "BROADCAST_BYTES", size)
    rows = [(3, [1.0, 0.0], "a"), (1, [1.0, 0.1], "b"), (2, [0.0, 1.0], "a"), (4, [2.0, 0.0], None), (5, None, "a"), (6, [0.0, 0.0], "a"), (7, [0.0, 3.0], "a")]
    df = spark.createDataFrame(rows, "id long, vec array<double>, label string")
    assert {(r["id"], r["duplicate_of"]) for r in similarity.semantic_duplicates(df, 0.99).collect()} == {(3, 1), (4, 1), (7, 2)}


@pytest.mark.parametrize("metric", ["cosine", "euclidean", "manhattan"])
@pytest.mark.parametrize("size", [1 << 20, 0])
def test_nearest_equals_counting(spark, monkeypatch, metric, size):
    monkeypatch.setattr(similarity, "BROADCAST_BYTES", size)
    rng = random.Random(6)
    vec = lambda: rng.choice([[rng.choice([-1.0, 0.0, 1.0, 2.0]) for _ in range(3)], [1.0], None, [], [float("nan"), 0.0, 0.0]])
    rows = [(i, vec(), rng.choice("ab")) for i in range(300)]
    v = lambda r: spark.createDataFrame(r, "id long, vec array<double>, label string")
    got = {(r["t_id"], r["place"]): (r["s_id"], r["s_label"]) for r in similarity.nearest(v(rows[:40]), v(rows[40:]), 4, metric).collect()}

    def far(a, b):
        if metric == "cosine":
            na, nb = sum(x * x for x in a) ** 0.5, sum(x * x for x in b) ** 0.5
            return round(1 - max(-1.0, min(1.0, sum(x * y for x, y in zip(a, b)) / (na * nb))), 12) if na and nb else None
        p = 2 if metric == "euclidean" else 1
        return round(sum(abs(x - y) ** p for x, y in zip(a, b)) ** (1 / p), 12)

    good = lambda x: x and x == x and not any(y != y for y in x)
    want = {}
    for i, a, _ in rows[:40]:
        if good(a):
            d = sorted((far(a, b), j, l) for j, b, l in rows[40:] if good(b) and len(a) == len(b) and far(a, b) is not None)
            want |= {(i, n + 1): (j, l) for n, (_, j, l) in enumerate(d[:4])}
    assert got == want


def test_ordered_distinct(spark):
    df = spark.createDataFrame([(0, "z", ["f1", "f2"]), (1, "a", ["f2", None]), (2, "z", None), (3, None, ["f3"])], "o int, f string, xs array<string>")
    order = lambda d: [r["key"] for r in d.orderBy("column_no", "first_row").collect()]
    assert order(dataset.ordered_distinct(df, ["f"], ["o"])) == ["z", "a"]
    assert order(dataset.ordered_distinct(df, ["xs", "f"], ["o"])) == ["f1", "f2", "f3", "z", "a"]


def test_allocation(spark):
    g = spark.createDataFrame([("a", 1), ("b", 1), ("c", 8)], "g string, w int")
    assert sorted(map(tuple, dataset.allocate_uniform(g, "g", 8).collect())) == [("a", 3), ("b", 3), ("c", 2)]
    assert sorted((r["g"], r["share"]) for r in dataset.allocate_proportional(g, "g", "w", 7).collect()) == [("a", 1), ("b", 1), ("c", 5)]


@pytest.mark.parametrize("m, c", [(3, 4), (4, 4), (6, 3), (1, 5), (5, 1)])
def test_pairs_come_once_before_they_repeat(spark, m, c):
    masks = spark.createDataFrame([(f"m{i}",) for i in range(m)], "mask string")
    cleans = spark.createDataFrame([(f"c{i}",) for i in range(c)], "clean string")
    got = dataset.pair_plan(masks, cleans, m * c).collect()
    assert len({(r["mask"], r["clean"]) for r in got}) == m * c


def test_attribution_bounds(spark):
    stages = spark.createDataFrame([("r", 10, 1), ("r", 20, 2)], "run string, ts int, stage_id int")
    msgs = spark.createDataFrame([("r", t) for t in (1, 10, 11, 20, 21)], "run string, ts int")
    got = {r["ts"]: r["stage_id"] for r in runlog.attribute(msgs, stages, ["run"]).collect()}
    assert got == {1: 1, 10: 1, 11: 2, 20: 2, 21: None}


def test_transitions(spark):
    seq = [("baseline", "train", "ok"), ("baseline", "evaluate", "ok"), ("baseline", "rca", "ok"), ("iter1", "routing", "ok"), ("iter1", "train", "ok"), ("iter1", "evaluate", "error"), ("iter1", "loop_stop", "ok"), ("iter2", "routing", "ok")]
    log = spark.createDataFrame([("r", i + 1, i, *x) for i, x in enumerate(seq)], "run_id string, seq int, log_id int, iter string, stage string, status string")
    assert [r["legal"] for r in runlog.transitions(log, ["run_id"]).orderBy("seq").collect()] == [None, True, True, True, False, True, True, False]


def test_violations_are_raised_together(spark):
    df = spark.createDataFrame([(1, "PASS"), (2, "Missing"), (3, " "), (4, "bridge ")], "i int, label string")
    v = quality.label_spelling(df, "i", "label")
    assert {(r["rule"], r["key"]) for r in v.collect()} == {("label_spelling", "2"), ("blank_label", "3"), ("label_spelling", "4")}
    with pytest.raises(quality.Violations, match="3 violations"):
        quality.raise_if_any(v)
    quality.raise_if_any(v.limit(0))


def test_detections(spark):
    truth = spark.createDataFrame([(1, "a", [0.0, 0.0, 10.0, 10.0]), (1, "a", [20.0, 0.0, 30.0, 10.0]), (2, "a", [0.0, 0.0, 1.0, 1.0])], "image int, class string, box array<double>")
    found = spark.createDataFrame([(1, "a", 0.9, [0.0, 0.0, 10.0, 9.0]), (1, "a", 0.8, [0.0, 0.0, 10.0, 10.0]), (1, "a", 0.7, [20.0, 0.0, 30.0, 10.0]), (3, "a", 0.1, [0.0, 0.0, 1.0, 1.0])], "image int, class string, score double, box array<double>")
    m = evaluation.matched_detections(found, truth)
    assert sorted((r["score"], r["hit"]) for r in m.collect()) == [(0.1, False), (0.7, True), (0.8, False), (0.9, True)]
    assert evaluation.average_precision(m, truth).first()["ap"] == pytest.approx((1 + 2 / 3) / 3)


def test_best_candidate(spark):
    r = spark.createDataFrame([("a", "far", 5.0), ("a", "recall", 1.0), ("b", "far", 1.0), ("b", "recall", 0.5), ("c", "far", 5.0), ("c", "recall", 1.0), ("d", "far", 2.0)], "candidate string, metric string, value double")
    rule = "metric string, operator string, target double"
    e = evaluation.evaluate_contract(r, spark.createDataFrame([("far", "<=", 4.0)], rule), spark.createDataFrame([("recall", ">=", 0.9)], rule))
    assert {x["candidate"]: (x["met"], x["feasible"]) for x in e.collect()} == {"a": (False, True), "b": (True, False), "c": (False, True), "d": (True, False)}
    assert evaluation.pick_best(e).first()["candidate"] == "a"


def test_set_hash_ignores_order(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int"), spark.createDataFrame([(2,), (1,)], "k int")
    assert evaluation.set_hash(a, "k").first() == evaluation.set_hash(b, "k").first() != evaluation.set_hash(b.limit(1), "k").first()


def test_stream_alarms(spark, tmp_path):
    from gaugeworks.streaming import logstream

    rows = [(i, "r", s, None, "iter1", "train", "ok", "", 1, 1) for i, s in enumerate((1, 2, 4, 5))]
    spark.createDataFrame(rows, logstream.LOG).write.parquet(str(tmp_path / "log"))
    q = logstream.sequence_alarms(logstream.read_log(spark, str(tmp_path / "log"))).writeStream.format("memory").queryName("alarms").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert [tuple(r) for r in spark.table("alarms").collect()] == [("r", 4, 3)]


def test_bad_scores_come_with_their_lines(spark, tmp_path):
    from gaugeworks.sources import readers

    (tmp_path / "a.csv").write_text('label,siamese_score,note\nPASS,0.5,"two\nlines"\nbridge, ,x\nbridge,nope,y\nPASS, 1e-1 ,z\n')
    (tmp_path / "b.csv").write_text("label,siamese_score,note\nPASS,,x\n")
    good, bad = readers.read_scored(spark, f"{tmp_path}/*.csv")
    at = lambda df: sorted((r["file"][-5:], r["line"]) for r in df.collect())
    assert at(good) == [("a.csv", 2), ("a.csv", 5)] and at(bad) == [("a.csv", 3), ("a.csv", 4), ("b.csv", 2)]
    with pytest.raises(ValueError, match="no column"):
        readers.read_scored(spark, str(tmp_path / "a.csv"), score="absent")


@pytest.mark.parametrize("kind", ["parquet", "jsonl", "json", "csv"])
def test_formats_come_back(spark, tmp_path, kind):
    from gaugeworks.sources import readers, sinks

    df = spark.createDataFrame([("clips/a.mp4", 'say "hi", ok'), ("clips/b.mp4", "two\nlines"), ("clips/a.mp4", None)], "video string, caption string")
    path = str(tmp_path / f"t.{kind}")
    if kind == "json":
        sinks.json_array(df, ["video", "caption"]).coalesce(1).write.text(path)
    else:
        {"parquet": sinks.write_parquet, "jsonl": sinks.write_jsonl, "csv": sinks.write_csv}[kind](df, path)
    got = readers.read_annotations(spark, path, "video string, caption string")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
