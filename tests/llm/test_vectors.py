import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import vectorfiles, vectors

SCHEMA = "vec_id long, side boolean, embedding array<float>, target string, class int"


def brute(rows, k, floor):
    ok = [(i, s, np.array(v, float)) for i, s, v in rows if i is not None and s is not None and v is not None and len(v) == 64 and None not in v and np.isfinite(v).all() and np.any(v)]
    src = sorted((i, v / np.linalg.norm(v)) for i, s, v in ok if not s) if ok else []
    out = set()
    for i, s, v in ok:
        if s:
            c = sorted(((-round(float(v / np.linalg.norm(v) @ w), 9), j) for j, w in src))[:k]
            out |= {(i, j) for x, j in c if -x >= floor}
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, s, v, "clash", 1) for i, s, v in rows], SCHEMA)
    return [(r["target"], r["source"]) for r in vectors.most_similar(df, "vec_id", F.col("side"), "embedding", **kw).collect()]


def near(rng, v, cosine):
    w = rng.standard_normal(64)
    w -= (w @ v) * v
    return cosine * v + np.sqrt(1 - cosine**2) * w / np.linalg.norm(w)


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, False, rng.standard_normal(64).tolist()) for i in range(1500)]
    for n in range(400):
        v = np.array(rows[n][2])
        rows.append((5000 + n, True, (near(rng, v / np.linalg.norm(v), rng.uniform(0.88, 1)) * rng.uniform(0.1, 9)).tolist()))
    got, want = run(spark, rows), brute(rows, 5, 0.9)
    assert len(got) == len(set(got))
    # float32 input: a pair may lie just across the floor
    assert len(set(got) & want) >= 0.95 * len(want) and len(set(got) - want) <= 2


def test_dirty_vectors_ties_and_copies(spark):
    e = [1.0] + [0.0] * 63
    bad = [None, [], e[:63], e + [0.0], [None] + e[1:], [float("nan")] + e[1:], [float("inf")] + e[1:], [0.0] * 64]
    rows = [(100 + i, s, v) for i, v in enumerate(bad) for s in (True, False)]
    rows += [(10 + i, False, [2.0**-i] + [0.0] * 63) for i in range(9)] + [(1, True, e), (2, True, [1e-30] + [0.0] * 63), (3, True, [1e30] + [-0.0] * 63), (4, None, e), (5, True, [0.0, 1.0] + [0.0] * 62)]
    got = run(spark, rows)
    assert sorted(got) == [(t, 10 + i) for t in (1, 2, 3) for i in range(5)]


def test_a_third_of_all_rows_is_one_vector(spark):
    rng = np.random.default_rng(4)
    hot = rng.standard_normal(64).tolist()
    rows = [(i, i % 5 == 0, hot) for i in range(1000)] + [(1000 + i, i % 5 == 0, rng.standard_normal(64).tolist()) for i in range(2000)]
    assert set(run(spark, rows)) == brute(rows, 5, 0.9)


@pytest.mark.parametrize("rows", [[], [(1, True, [1.0] * 64)], [(1, False, [1.0] * 64)], [(1, True, None), (2, False, None)]])
def test_nothing_to_match(spark, rows):
    assert run(spark, rows) == []


def test_pigeonhole_plan():
    bits, n = vectors.plan_substrings(320_000, 0.9)
    same = (1 - np.arccos(0.9) / np.pi) ** bits
    assert 1 - (1 - same) ** n >= vectors.RECALL_AT_FLOOR


@pytest.mark.parametrize("length", [0.0, 0.7])
def test_pairs_at_the_floor_meet_whatever_the_mean(length):
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x = unit(length * np.eye(64)[0] + np.sqrt(1 - length**2) * unit(rng.standard_normal((6000, 64))))
    bits, n = vectors.plan_substrings(320_000, 0.9)
    matrix = np.asarray(vectors.learn_rotations(x[:4000], bits * n))
    a = x[4000:]
    b = np.array([near(rng, v, 0.9) for v in a])
    code = lambda v: (v @ matrix >= 0).reshape(len(v), n, bits)
    assert (code(a) == code(b)).all(2).any(1).mean() >= 0.95


def test_shuffles_are_small_beside_the_vectors(spark, tmp_path):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((12_000, 64)).astype(np.float32)
    path = str(tmp_path / "v.parquet")
    pq.write_table(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x), pa.list_(pa.float32()))}), path)
    written = lambda: sum(e.totalShuffleWrite() for e in (lambda all: [all.apply(i) for i in range(all.size())])(spark.sparkContext._jsc.sc().statusStore().executorList(True)))
    before = written()
    vectors.most_similar(spark.read.parquet(path), "vec_id", F.col("vec_id") % 5 == 0, "embedding").count()
    assert 0 < written() - before < x.nbytes  # an index that is shuffled has L rows a vector


def test_blocks_and_groups_leave_the_result_as_it_is(spark, monkeypatch):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((40, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    rows = [(i, i % 3 == 0, near(rng, base[i % 40], rng.uniform(0.97, 1)).tolist()) for i in range(900)]
    for name, value in (("BLOCK", 150), ("GROUP", 3)):
        monkeypatch.setattr(vectors, name, value)
    got, want = run(spark, rows), brute(rows, 5, 0.9)
    assert len(got) == len(set(got)) and len(set(got) & want) >= 0.99 * len(want) and len(set(got) - want) <= 0.01 * len(want)


def test_steps_leave_the_matches_as_they_are(tmp_path, monkeypatch):
    rng = np.random.default_rng(10)
    base = rng.standard_normal((5, 64))
    x = np.array([near(rng, base[i % 5] / np.linalg.norm(base[i % 5]), 0.97) for i in range(400)])
    pos = vectorfiles.write_vectors(str(tmp_path), 0, x)
    check = vectors.sign_words(x, rng.standard_normal((64, vectors.CHECK_BITS)), 64, 64)
    for name, at in (("s", slice(0, 300)), ("t", slice(300, 400))):
        vectorfiles.write(str(tmp_path), name, pos[at], np.arange(400)[at], *check[at].T)
    source, target = (vectors.Block(str(tmp_path), name) for name in "st")
    found = lambda: sorted((int(a), int(b)) for t, s, _ in vectors.matches(vectorfiles.Vectors(str(tmp_path), 64), source, [target], rng_matrix, 8, 5, 0.9) for a, b in zip(t, s))
    rng_matrix = rng.standard_normal((64, 64)).astype(np.float32)
    want = found()
    monkeypatch.setattr(vectors, "CHUNK", 64)
    monkeypatch.setattr(vectors, "STEP", 50)
    assert len(want) > 100 and found() == want


def test_candidates_are_all_pairs_of_one_code():
    rng = np.random.default_rng(8)
    source, target = rng.integers(0, 8, 50), rng.integers(0, 8, 30)
    order = np.argsort(source, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(source, minlength=8))])
    want = sorted((t, s) for t in range(30) for s in range(50) if target[t] == source[s])
    for step in (1, 7, 10_000):
        parts = list(vectors.candidates(starts, order, target, step))
        assert all(len(t) <= step for t, _ in parts)
        assert sorted((int(a), int(b)) for t, s in parts for a, b in zip(t, s)) == want


def test_vectors_are_stored_without_loss(tmp_path):
    rng = np.random.default_rng(9)
    store = vectorfiles.Vectors(f"file:{tmp_path}", 64)
    for number, x in enumerate((np.round(rng.standard_normal((9, 64)) * 64) / 64, rng.standard_normal((9, 64)).astype(np.float32), rng.standard_normal((9, 64)), np.full((1, 64), 1e300))):
        pos = vectorfiles.write_vectors(f"file:{tmp_path}", number, x)
        assert (store.take(pos[::-1]) == x[::-1]).all()
        assert (pos[0] >> vectorfiles.ROW_BITS) % 3 == min(number, 2)
