"""Exact nearest neighbours by metric, similarity floors, and what is measured on ranks.

Brute force is exact: a stated set of targets against all sources, or the equi-join
on labels where a label must agree. Distances are ``1 - cosine``, euclidean or manhattan;
ties go to the smaller source id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions import numbers
from gaugeworks.functions.paths import slashes

#: Up to this many bytes the target side is broadcast; above it both sides are shuffled in blocks.
BROADCAST_BYTES = 64 << 20
BLOCKS = 32


def distance(metric: str, a: Column, b: Column) -> Column:
    if metric == "cosine":
        return 1 - numbers.cosine(a, b)
    if metric == "euclidean":
        return numbers.euclidean(a, b)
    if metric == "manhattan":
        return numbers.manhattan(a, b)
    raise ValueError(f"no such metric: {metric}")


def target_source_pairs(targets: DataFrame, sources: DataFrame, on_label: bool = False) -> DataFrame:
    """``t_id, t_vec, t_label, s_id, s_vec, s_label`` of every target against the sources it may match.

    With ``on_label`` it's an equi-join. Else targets are broadcast while they are small (their size is measured),
    or sent in blocks, each to one copy of the sources' partitions."""
    t = targets.select(F.col("id").alias("t_id"), F.col("vec").alias("t_vec"), F.col("label").alias("t_label"))
    s = sources.select(F.col("id").alias("s_id"), F.col("vec").alias("s_vec"), F.col("label").alias("s_label"))
    if on_label:
        return t.join(s, F.col("t_label") == F.col("s_label"))
    if _small(targets):
        return s.crossJoin(F.broadcast(t))
    t = t.withColumn("block", F.pmod(F.xxhash64("t_id"), F.lit(BLOCKS)))
    s = s.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(BLOCKS - 1).cast("long"))))
    return t.join(s, "block").drop("block")


def _small(targets: DataFrame) -> bool:
    size = targets.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("d")).first()
    return (size["n"] or 0) * ((size["d"] or 0) * 8 + 64) <= BROADCAST_BYTES


def _matrices(few: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids, ascending, and vectors of rows whose size was checked, by dimension."""
    rows = few.select("id", F.col("vec").cast("array<double>").alias("vec")).orderBy("id").collect()
    out = {}
    for n in {len(r["vec"]) for r in rows}:
        mine = [r for r in rows if len(r["vec"]) == n]
        out[n] = np.array([r["id"] for r in mine], np.int64), np.array([r["vec"] for r in mine], np.float64)
    return out


def _distances(metric: str, t: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Of all targets to all sources; NaN where there is none."""
    if metric == "cosine":
        with np.errstate(invalid="ignore", divide="ignore"):
            t, s = t / np.linalg.norm(t, axis=1, keepdims=True), s / np.linalg.norm(s, axis=1, keepdims=True)
        return 1 - np.clip(t @ s.T, -1, 1)
    if metric == "euclidean":
        square = (t * t).sum(1)[:, None] + (s * s).sum(1)[None, :] - 2 * (t @ s.T)
        return np.sqrt(np.maximum(square, 0))
    if metric == "manhattan":
        return np.stack([np.abs(s - x).sum(1) for x in t]) if len(t) else np.empty((0, len(s)))
    raise ValueError(f"no such metric: {metric}")


def _scan(targets: DataFrame, sources: DataFrame, k: int, metric: str, most: float) -> DataFrame:
    """The k nearest of each partition of the sources to each target, by block matrix products.

    The targets, whose size the caller has checked, go to every worker; of the sources only
    each partition's best leave it. Equal distances (to 12 digits) go to the smaller id."""
    shared = sources.sparkSession.sparkContext.broadcast(_matrices(targets))
    label = sources.schema["label"].dataType

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple] = {}
        kind = pa.null()
        for b in batches:
            kind = b.schema.field(2).type
            lengths = np.asarray(b.column(1).value_lengths())
            for n, (_, t) in shared.value.items():
                at = np.flatnonzero(lengths == n)
                if not len(at):
                    continue
                take = pa.array(at)
                s = np.asarray(b.column(1).take(take).flatten()).reshape(-1, n)
                d = np.round(_distances(metric, t, s), 12)
                d[~(d <= most)] = np.inf
                limit = np.partition(d, min(k, d.shape[1]) - 1, axis=1)[:, min(k, d.shape[1]) - 1]
                ti, si = np.nonzero((d <= limit[:, None]) & np.isfinite(d))
                new = (ti, d[ti, si], np.asarray(b.column(0).take(take))[si], np.array(b.column(2).take(take).to_pylist(), object)[si])
                old = kept.get(n)
                both = new if old is None else tuple(np.concatenate(x) for x in zip(old, new))
                order = np.lexsort((both[2], both[1], both[0]))
                both = tuple(x[order] for x in both)
                first = np.flatnonzero(np.r_[True, both[0][1:] != both[0][:-1]]) if len(order) else np.empty(0, int)
                place = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
                kept[n] = tuple(x[place < k] for x in both)
        for n, (ti, d, si, labels) in kept.items():
            yield pa.RecordBatch.from_arrays([pa.array(shared.value[n][0][ti]), pa.array(si), pa.array(labels.tolist(), kind), pa.array(d)], names=["t_id", "s_id", "s_label", "distance"])

    out = T.StructType([T.StructField("t_id", T.LongType()), T.StructField("s_id", T.LongType()), T.StructField("s_label", label), T.StructField("distance", T.DoubleType())])
    return sources.select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec"), "label").mapInArrow(best, out)


def nearest(targets: DataFrame, sources: DataFrame, k: int = 5, metric: str = "cosine", on_label: bool = False, max_distance: float = -1.0) -> DataFrame:
    """``t_id, s_id, distance, place``: the k nearest usable sources of each target, no farther than ``max_distance`` if that's 0 or more.

    Targets of a checked size are held against all sources in blocks; more of them, and pairs by label, are joined. Ids are long."""
    usable = numbers.vector_ok(F.col("vec"))
    targets, sources = targets.where(usable), sources.where(usable)
    w = Window.partitionBy("t_id").orderBy("distance", "s_id")
    if not on_label and _small(targets):
        d = _scan(targets, sources, k, metric, max_distance if max_distance >= 0 else float("inf"))
        top = d.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)
        labels = targets.select(F.col("id").cast("long").alias("t_id"), F.col("label").alias("t_label"))
        return top.join(labels, "t_id").select("t_id", "t_label", "s_id", "s_label", "distance", "place")
    d = target_source_pairs(targets, sources, on_label).withColumn("distance", F.round(distance(metric, F.col("t_vec"), F.col("s_vec")), 12)).where("distance is not null")
    if max_distance >= 0:
        d = d.where(F.col("distance") <= F.lit(max_distance))
    return d.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).select("t_id", "t_label", "s_id", "s_label", "distance", "place")


def mined(neighbours: DataFrame) -> DataFrame:
    """The distinct sources mined, with how many targets chose each and the least distance."""
    return neighbours.groupBy("s_id").agg(F.count("*").alias("n_targets"), F.min("distance").alias("best_distance"))


def similarity_floor(candidates: DataFrame, targets: DataFrame, floor: float, on_label: bool = False) -> DataFrame:
    """``id, max_similarity, matched_target, kept``: each candidate's most similar target (the first on ties); kept at ``floor`` or more."""
    if not -1 <= floor <= 1:
        raise ValueError("the floor must be in [-1, 1]")
    usable = numbers.vector_ok(F.col("vec"))
    targets, candidates = targets.where(usable), candidates.where(usable)
    if not on_label and _small(targets):
        # seen from the candidates: each is a target of its own, and its nearest is kept
        pairs = _nearest_to_each(candidates, targets)
    else:
        sim = F.round(numbers.cosine(F.col("t_vec"), F.col("s_vec")), 12)
        pairs = target_source_pairs(targets, candidates, on_label).select(F.col("s_id").alias("id"), F.col("t_id"), sim.alias("sim")).where("sim is not null")
    best = pairs.groupBy("id").agg(F.max(F.struct(F.col("sim"), (-F.col("t_id")).alias("neg"))).alias("b"))
    return best.select("id", F.col("b.sim").alias("max_similarity"), (-F.col("b.neg")).alias("matched_target"), (F.col("b.sim") >= F.lit(floor)).alias("kept"))


def _nearest_to_each(rows: DataFrame, few: DataFrame) -> DataFrame:
    """``id, t_id, sim``: the most similar of ``few`` for each row, without a shuffle of the rows."""
    shared = rows.sparkSession.sparkContext.broadcast(_matrices(few))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = np.asarray(b.column(1).value_lengths())
            for n, (ids, t) in shared.value.items():
                at = np.flatnonzero(lengths == n)
                if len(at):
                    take = pa.array(at)
                    s = np.asarray(b.column(1).take(take).flatten()).reshape(-1, n)
                    sim = np.round(1 - _distances("cosine", t, s), 12)
                    sim[np.isnan(sim)] = -np.inf
                    first = sim.argmax(axis=0)  # ids ascend, so the first of equals is the smallest
                    value = sim[first, np.arange(len(at))]
                    ok = pa.array(np.isfinite(value))
                    yield pa.RecordBatch.from_arrays([b.column(0).take(take).filter(ok), pa.array(ids[first]).filter(ok), pa.array(value).filter(ok)], names=["id", "t_id", "sim"])

    return rows.select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec")).mapInArrow(best, "id long, t_id long, sim double")


def semantic_duplicates(rows: DataFrame, floor: float) -> DataFrame:
    """``id, duplicate_of``: rows with a row of smaller id at a cosine of ``floor`` or more, and the smallest such id.

    Rows of a checked size are held against themselves in blocks of matrix products; more are joined in blocks."""
    rows = rows.where(numbers.vector_ok(F.col("vec")))
    if not _small(rows):
        pairs = target_source_pairs(rows, rows).where((F.col("t_id") < F.col("s_id")) & (F.round(numbers.cosine(F.col("t_vec"), F.col("s_vec")), 12) >= F.lit(floor)))
        return pairs.groupBy(F.col("s_id").alias("id")).agg(F.min("t_id").alias("duplicate_of"))
    shared = rows.sparkSession.sparkContext.broadcast(_matrices(rows))

    def earlier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = np.asarray(b.column(1).value_lengths())
            for n, (ids, t) in shared.value.items():
                at = np.flatnonzero(lengths == n)
                if len(at):
                    take = pa.array(at)
                    own = np.asarray(b.column(0).take(take))
                    near = np.round(1 - _distances("cosine", t, np.asarray(b.column(1).take(take).flatten()).reshape(-1, n)), 12) >= floor
                    near &= ids[:, None] < own[None, :]
                    hit = near.any(axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(own[hit]), pa.array(ids[near.argmax(axis=0)[hit]])], names=["id", "duplicate_of"])

    return rows.select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec")).mapInArrow(earlier, "id long, duplicate_of long")


def floor_summary(floored: DataFrame, floor: float) -> DataFrame:
    s = F.col("max_similarity")
    return floored.agg(F.count("*").alias("candidate_count"), F.count_if("kept").alias("kept_count"), F.count_if(~F.col("kept")).alias("rejected_count"), F.lit(floor).alias("similarity_threshold"), F.min(s).alias("min_similarity"), F.max(s).alias("max_similarity"), F.avg(s).alias("mean_similarity"))


def strict_lookup(probe: DataFrame, build: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Join every probe row with the one build row of its normalised path, and the violations: ``rule, key`` for a key twice in the build side or absent from it."""
    p, b = probe.withColumn("_k", slashes(F.col(key))), build.withColumn("_k", slashes(F.col(key))).drop(key)
    twice = b.groupBy("_k").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate").alias("rule"), F.col("_k").alias("key"))
    absent = p.join(b, "_k", "left_anti").select(F.lit("missing").alias("rule"), F.col("_k").alias("key"))
    return p.join(b, "_k").drop("_k"), twice.unionByName(absent.distinct())


def retrieval(neighbours: DataFrame, ranks: tuple[int, ...] = (1, 5)) -> DataFrame:
    """Cumulative match at each rank, precision at 1 and mean average precision over the ranked neighbours of each target."""
    hit = (F.col("t_label") == F.col("s_label")).cast("int")
    w = Window.partitionBy("t_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    r = neighbours.withColumn("hit", hit).withColumn("hits", F.sum("hit").over(w))
    q = r.groupBy("t_id").agg(F.min(F.when(F.col("hit") == 1, F.col("place"))).alias("first"), F.try_divide(F.sum(F.col("hit") * F.col("hits") / F.col("place")), F.sum("hit")).alias("ap"))
    return q.agg(F.count("*").alias("queries"), *(F.avg(F.coalesce((F.col("first") <= k).cast("int"), F.lit(0))).alias(f"rank_{k}") for k in ranks), F.avg(F.coalesce("ap", F.lit(0.0))).alias("mean_ap"))


def knn_labels(neighbours: DataFrame) -> DataFrame:
    """``t_id, t_label, predicted, votes``: the label most neighbours have; ties to the nearer sum, then the smaller label."""
    votes = neighbours.groupBy("t_id", "t_label", "s_label").agg(F.count("*").alias("votes"), F.sum("distance").alias("far"))
    w = Window.partitionBy("t_id").orderBy(F.col("votes").desc(), "far", "s_label")
    return votes.withColumn("n", F.row_number().over(w)).where("n = 1").select("t_id", "t_label", F.col("s_label").alias("predicted"), "votes")


def mean_of_best(scores: DataFrame, item: str, score: str, k: int = 3) -> DataFrame:
    """Mean of each item's k best scores."""
    w = Window.partitionBy(item).orderBy(F.col(score).desc())
    return scores.withColumn("n", F.row_number().over(w)).where(F.col("n") <= k).groupBy(item).agg(F.avg(score).alias("best_mean"))
