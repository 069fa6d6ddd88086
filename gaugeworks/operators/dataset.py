"""Building and checking training sets: distinct, union with provenance, leaks, splits, routing, allocation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.numbers import short_hash
from gaugeworks.functions.paths import strip_blank
from gaugeworks.operators.prefix import prefix_sums

# fixed values
LEAK_KEY = ("input_path", "golden_path", "label", "object_name", "boardname")
GENERATOR_LABELS = ("PASS", "EXCESS_SOLDER", "MISSING", "BRIDGE")


def ordered_distinct(df: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """``key, column_no, first_row``: each non-null value of the columns once, by column, then first row. List cells count by element."""
    parts = []
    for i, c in enumerate(columns):
        listed = df.schema[c].dataType.typeName() == "array"
        values = df.select(F.struct(*order).alias("first_row"), F.explode(F.col(c)).alias("key") if listed else F.col(c).alias("key"))
        parts.append(values.where("key is not null").select(F.col("key").cast("string").alias("key"), F.lit(i).alias("column_no"), "first_row"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("key").agg(F.min(F.struct("column_no", "first_row")).alias("m")).select("key", "m.column_no", "m.first_row")


def first_wins(df: DataFrame, key: list[Column], order: list[str]) -> DataFrame:
    """The first row of each key; nulls form a key of their own."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def union_with_provenance(inputs: dict[str, DataFrame], order: str) -> DataFrame:
    """All inputs, one after another, each row with ``source_no, source`` and ``source_index`` (from 0 by ``order`` within its input)."""
    out = None
    for i, (name, df) in enumerate(inputs.items()):
        tagged = df.withColumns({"source_no": F.lit(i), "source": F.lit(name)})
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    numbered = prefix_sums(out, ["source_no", order], {"_n": F.lit(1).cast("long")})
    first = numbered.groupBy("source_no").agg(F.min("_n").alias("_first"))  # one row an input
    return numbered.join(F.broadcast(first), "source_no").withColumn("source_index", F.col("_n") - F.col("_first")).drop("_n", "_first")


def assemble(inputs: dict[str, DataFrame], pair: list[str], order: str) -> DataFrame:
    """The union, of each pair its first row in order of inputs."""
    return first_wins(union_with_provenance(inputs, order), [F.col(c) for c in pair], ["source_no", "source_index"])


def leak_key(*columns: str) -> list[Column]:
    return [F.coalesce(strip_blank(F.col(c)), F.lit("")).alias(c) for c in columns]


def leaks(training: DataFrame, validation: DataFrame, keep: list[str]) -> DataFrame:
    """Training rows whose key stands in validation: the key columns both have, stripped, null as blank."""
    shared = [c for c in LEAK_KEY if c in training.columns and c in validation.columns]
    if not shared:
        raise ValueError("no key column in common")
    t = training.select(*(F.col(k).alias(f"_keep_{k}") for k in keep), *leak_key(*shared))
    return t.join(validation.select(*leak_key(*shared)).distinct(), shared, "left_semi").select(*(F.col(f"_keep_{k}").alias(k) for k in keep))


def role_overlaps(roles: DataFrame) -> DataFrame:
    """``role_a, role_b, shared``: keys that stand in two roles (``role, key``), one row for each pair of roles that share any."""
    once = roles.where("key is not null").distinct()
    sets = once.groupBy("key").agg(F.sort_array(F.collect_set("role")).alias("roles")).where(F.size("roles") > 1)  # as many as there are roles
    a = sets.select("key", F.posexplode("roles").alias("i", "role_a"), "roles")
    pairs = a.select("role_a", F.explode(F.slice(F.col("roles"), F.col("i") + 2, F.size("roles"))).alias("role_b"))
    return pairs.groupBy("role_a", "role_b").agg(F.count("*").alias("shared"))


def repeated_in_role(roles: DataFrame) -> DataFrame:
    return roles.where("key is not null").groupBy("role", "key").agg(F.count("*").alias("n")).where("n > 1")


def outside(training: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Keys of training that are in none of the allowed sets."""
    return training.select(key).where(F.col(key).isNotNull()).distinct().join(allowed.select(key).distinct(), key, "left_anti")


def unique_targets(training: DataFrame, evaluation: DataFrame, key: str) -> DataFrame:
    """Sizes of both sets of keys, of what they share, and of what is new in training."""
    t, e = (x.select(key).where(F.col(key).isNotNull()).distinct() for x in (training, evaluation))
    both = t.withColumn("t", F.lit(1)).join(e.withColumn("e", F.lit(1)), key, "full_outer")
    return both.agg(F.count("t").alias("training"), F.count("e").alias("evaluation"), F.count_if(F.col("t").isNotNull() & F.col("e").isNotNull()).alias("shared"), F.count_if(F.col("e").isNull()).alias("training_only"))


def route(rows: DataFrame, pool: DataFrame, label: str = "label", generator: tuple[str, ...] = GENERATOR_LABELS) -> DataFrame:
    """``rows`` with ``to_mining`` (the pool has the label) and ``to_generator``; labels compare in upper case, unstripped."""
    have = pool.select(F.upper(F.col(label)).alias("_u")).where("_u is not null").distinct().withColumn("_in", F.lit(True))
    u = F.upper(F.col(label))
    joined = rows.withColumn("_u", u).join(have, "_u", "left")
    return joined.withColumns({"to_mining": F.coalesce("_in", F.lit(False)), "to_generator": F.coalesce(u.isin(*generator), F.lit(False))}).drop("_u", "_in")


def route_summary(routed: DataFrame, label: str = "label") -> DataFrame:
    return routed.groupBy(F.upper(F.col(label)).alias("label_upper")).agg(F.count("*").alias("n"), F.bool_or("to_mining").alias("to_mining"), F.bool_or("to_generator").alias("to_generator"))


def label_counts(rows: DataFrame, label: str) -> DataFrame:
    return rows.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), label)


def labels_without_source(targets: DataFrame, sources: DataFrame, label: str) -> DataFrame:
    return targets.groupBy(label).agg(F.count("*").alias("n_targets")).join(sources.select(label).distinct(), label, "left_anti")


def allocate_uniform(groups: DataFrame, name: str, total: int) -> DataFrame:
    """``total`` spread evenly over the groups; the first by name take the remainder one each. Few groups: one row each."""
    w = Window.orderBy(name)
    k = F.count("*").over(Window.partitionBy())
    return groups.select(name).distinct().withColumn("share", (F.floor(F.lit(total) / k) + (F.row_number().over(w) <= F.pmod(F.lit(total), k)).cast("int")).cast("long"))


def allocate_proportional(groups: DataFrame, name: str, weight: str, total: int) -> DataFrame:
    """``total`` by weight with the largest remainders rounded up; ``too_small`` marks a group left with nothing."""
    exact = F.col(weight) * F.lit(total) / F.sum(weight).over(Window.partitionBy())
    base = groups.withColumn("exact", exact).withColumn("base", F.floor("exact"))
    left = F.lit(total) - F.sum("base").over(Window.partitionBy())
    w = Window.orderBy((F.col("exact") - F.col("base")).desc(), name)
    return base.withColumn("share", (F.col("base") + (F.row_number().over(w) <= left).cast("int")).cast("long")).select(name, "share", (F.col("share") < 1).alias("too_small"))


def refill(rows: DataFrame, quotas: DataFrame, group: str, least: float) -> DataFrame:
    """Fill each group's quota: scored originals of ``least`` or more, then regenerated ones of that score, the rest of these, and last the originals dropped.

    ``rows`` has ``id, score, attempt`` (0: original); within a tier the better score wins. A null score never counts."""
    good = F.col("score") >= F.lit(least)
    tier = F.when((F.col("attempt") == 0) & good, 0).when((F.col("attempt") > 0) & good, 1).when(F.col("attempt") > 0, 2).otherwise(3)
    w = Window.partitionBy(group).orderBy("tier", F.col("score").desc(), "id")
    ranked = rows.where("score is not null").withColumn("tier", tier).withColumn("place", F.row_number().over(w))
    return ranked.join(quotas, group).where(F.col("place") <= F.col("quota"))


def best_round(rows: DataFrame, sample: str, score: str, order: list[str]) -> DataFrame:
    """The best-scored round of each sample, the earlier on ties."""
    w = Window.partitionBy(sample).orderBy(F.col(score).desc_nulls_last(), *order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """``df`` with ``shuffle_key``, a hash of key and seed by which rows can be put in one repeatable random order."""
    return df.withColumn("shuffle_key", F.xxhash64(F.lit(seed), key))


def split_by_hash(df: DataFrame, key: str, parts: dict[str, float], seed: int = 42) -> DataFrame:
    """Each row in one part, by a hash of its key: shares are met in expectation, no shuffle, and rows of a key stay together."""
    at, c = 0.0, None
    u = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1_000_000)) / F.lit(1_000_000.0)
    for name, share in parts.items():
        at += share
        c = F.when(u < at, name) if c is None else c.when(u < at, name)
    return df.withColumn("part", c.otherwise(list(parts)[-1]))


def split_by_time(df: DataFrame, time: str, key: str, last: float) -> DataFrame:
    """The last fraction of the rows by time, then key, as ``validation``, the others as ``train``."""
    n = df.count()
    ranked = prefix_sums(df, [time, key], {"_n": F.lit(1).cast("long")})
    return ranked.withColumn("part", F.when(F.col("_n") >= F.lit(round(n * (1 - last))), "validation").otherwise("train")).drop("_n")


def pair_plan(masks: DataFrame, cleans: DataFrame, count: int) -> DataFrame:
    """The first ``count`` of all mask-clean combinations in a repeatable random order, every one once before any repeats.

    Pair p of the order is decoded from its number, so the product is never formed: ``pair_no, mask, clean``."""
    m = masks.select(F.col("mask"), (F.row_number().over(Window.orderBy(F.xxhash64("mask"), "mask")) - 1).alias("m"))
    c = cleans.select(F.col("clean"), (F.row_number().over(Window.orderBy(F.xxhash64("clean"), "clean")) - 1).alias("c"))
    nm, nc = m.count(), c.count()
    if not nm or not nc:
        return masks.sparkSession.createDataFrame([], "pair_no long, mask string, clean string")
    p = masks.sparkSession.range(count).select(F.col("id").alias("pair_no"), F.pmod("id", F.lit(nm * nc)).alias("p"))
    # walking both lists with a shift a lap visits all nm * nc combinations
    p = p.withColumns({"m": F.pmod("p", F.lit(nm)), "c": F.pmod(F.floor(F.col("p") / nm) + F.col("p"), F.lit(nc)) if nc > 1 and nm % nc == 0 else F.pmod(F.floor(F.col("p") / nm), F.lit(nc))})
    return p.join(m, "m").join(c, "c").select("pair_no", "mask", "clean")


def media_map(rows: DataFrame, path: str, id_: str, order: str) -> DataFrame:
    """``path, row_count, ids, sample_id``: one row a path, distinct ids in the order first seen."""
    once = rows.where(F.col(path).isNotNull()).groupBy(path, id_).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    ids = F.transform(F.array_sort(F.collect_list(F.when(F.col(id_).isNotNull(), F.struct("first", F.col(id_).alias("id"))))), lambda x: x["id"])
    return once.groupBy(path).agg(F.sum("n").alias("row_count"), ids.alias("ids")).withColumn("sample_id", short_hash(F.col(path)))


def round_alignment(base: DataFrame, rounds: DataFrame, key: str, value: str) -> DataFrame:
    """``key, base_value, rounds, best``: every base row with how many rounds hold it and their best value."""
    r = rounds.groupBy(key).agg(F.count("*").alias("rounds"), F.max(value).alias("best"))
    return base.join(r, key, "left").select(key, F.col(value).alias("base_value"), F.coalesce("rounds", F.lit(0)).alias("rounds"), "best")


def resolve_names(asked: DataFrame, catalog: DataFrame, spellings: list[str]) -> DataFrame:
    """``asked, canonical, n``: the catalog rows any of whose spellings equals the name asked for, without case; n other than 1 is no answer."""
    keys = catalog.select("canonical", F.explode(F.array_compact(F.array(*(F.lower(strip_blank(F.col(c))) for c in spellings)))).alias("k")).distinct()
    q = asked.select("asked", F.lower(strip_blank(F.col("asked"))).alias("k")).distinct()
    return q.join(keys, "k", "left").groupBy("asked").agg(F.count("canonical").alias("n"), F.when(F.count("canonical") == 1, F.min("canonical")).alias("canonical"))
