"""Records that stand, exactly or almost, in both the training and the evaluation splits.

Exactly: equal key fields. Almost: the sets of three successive words of the two
questions have at least 60 % of their union in common, found by the segment join of
:mod:`gaugeworks.llm.simjoin` between the two sides.

Equal texts share one set, so a text repeated on both sides costs one comparison;
the pairs of records are then read off the sets' members. Null or blank
questions and questions under three words match nothing by text; key fields compare
without outer blanks, null as blank, and only if path and object are not blank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.paths import strip_blank
from gaugeworks.llm import simjoin
from gaugeworks.session import materialize

TRAINING = ("training_csv", "combined_training_json")
EVALUATION = ("validation_csv", "kpi_test_csv")
KEY = ("input_path", "golden_path", "label", "object_name")
THRESHOLD = 0.6
SHINGLE = 3


def sides(df: DataFrame) -> DataFrame:
    """Records of either side: ``side`` 0 for evaluation, 1 for training, and ``exact``, a 128-bit hash of the key fields."""
    field = F.col("split_field")
    side = F.when(field.isin(*EVALUATION), 0).when(field.isin(*TRAINING), 1)
    key = [F.coalesce(strip_blank(F.col(c)), F.lit("")) for c in KEY]
    whole = (key[0] != "") & (key[3] != "")
    exact = F.when(whole, F.struct(F.xxhash64(*key).alias("x"), F.xxhash64(F.lit(1), *key).alias("y")))
    return df.select(F.col("record_id").cast("long").alias("id"), side.cast("byte").alias("side"), exact.alias("exact"), F.col("question").alias("text")).where("side is not null")


def cross_split_pairs(df: DataFrame, t: float = THRESHOLD) -> DataFrame:
    """``evaluation, training, how``: the overlapping records, ``how`` being ``exact``, ``near`` or ``both``."""
    records = sides(df)
    keyed = records.where("exact is not null").select("id", "side", "exact")
    exact = keyed.where("side = 0").select(F.col("id").alias("evaluation"), "exact").join(keyed.where("side = 1").select(F.col("id").alias("training"), "exact"), "exact")
    members = materialize(simjoin.set_ids(records, "text", SHINGLE, ["id", "side"]).where("set_id is not null"))
    links = simjoin.similar_sets(records, "text", t, SHINGLE, "side").select("id_a", "id_b")
    ev = members.where("side = 0").select(F.col("id").alias("evaluation"), F.col("set_id").alias("id_a"))
    tr = members.where("side = 1").select(F.col("id").alias("training"), F.col("set_id").alias("id_b"))
    same = ev.join(tr, F.col("id_a") == F.col("id_b"))
    near = links.join(ev, "id_a").join(tr, "id_b")
    found = [x.select("evaluation", "training", F.lit(how).alias("how")) for x, how in ((exact, 1), (same, 2), (near, 2))]
    both = found[0].union(found[1]).union(found[2]).groupBy("evaluation", "training").agg(F.bit_or("how").alias("how"))
    return both.withColumn("how", F.element_at(F.array(F.lit("exact"), F.lit("near"), F.lit("both")), F.col("how")))
