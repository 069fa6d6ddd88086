"""Deduplicating new batches against all accepted history, by an append-only segment index.

Rows are taken in order; a row is a case if an accepted row before it has the same
image path or a nearly identical description, else it is accepted. Which rows are
near comes from the segment index of :mod:`gaugeworks.llm.simjoin`; who is accepted is
the lexicographically first independent set, found in rounds: a row whose every
neighbour still undecided comes later is accepted, and its neighbours are cases.

A batch is held against a :class:`SegmentHistory` without reading the history's
texts again: its segments, sets and path keys are stored once and appended to.

Nulls and blanks: a blank path matches no path, a text without words matches no
text; a row with neither is always accepted. Repeated row ids are told apart only by
their order columns. Extra columns are ignored."""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.paths import path_key
from gaugeworks.llm import simjoin
from gaugeworks.session import materialize, release, shared_dir

THRESHOLD = 0.7
ORDER = "t double, bits int, hot long, rows long, parts int, codes binary"
TABLES = {"segments": simjoin.SEGMENTS, "sets": "id long, tokens binary"}
PREPARED = ("id", "batch", "path", "set_id", "tokens")
# what stands for the size of a segment that is no part of a sequence but a whole set, or a path
WHOLE, PATH = 0, -1
PROBES = 500_000
GROUPS = 16
SHARE = 8
PART_ROWS = 300_000
MOST_PARTS = 4096
MERGE = 16


def prepare(df: DataFrame, id_col: str, batch_col: str, path_col: str, text_col: str, with_tokens: bool = True) -> DataFrame:
    """``id, batch, path, set_id`` and the set's ``tokens``: path as a 64-bit hash of its key; null where blank."""
    key = path_key(F.col(path_col), fold_case=True)
    slim = df.select(F.col(id_col).cast("long").alias("id"), F.col(batch_col).cast("long").alias("batch"), F.when(key.isNotNull(), F.xxhash64(key)).alias("path"), F.col(text_col).alias("text"))
    return simjoin.set_ids(slim, "text", 1, ["id", "batch", "path"], with_tokens)


def _links(similar: DataFrame) -> DataFrame:
    """Both directions of similar sets."""
    return similar.select(F.explode(F.array(F.struct(F.col("id_a").alias("a"), F.col("id_b").alias("b")), F.struct(F.col("id_b").alias("a"), F.col("id_a").alias("b")))).alias("x")).select("x.a", "x.b")


def _busy(rows: DataFrame, col: str) -> DataFrame:
    return rows.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n")).where("n > 1").select(col)


def _without(rows: DataFrame, other: DataFrame, how: str = "left_anti") -> DataFrame:
    """``rows`` whose id and batch aren't in ``other`` (or are: ``left_semi``); as fields of a struct, nulls are equal."""
    o = F.struct("batch", "id").alias("o")
    return rows.select("*", o).join(other.select(o), "o", how).drop("o")


def resolve(rows: DataFrame, links: DataFrame) -> DataFrame:
    """The cases among ``rows`` (``id, batch, path, set_id``), given ``links`` (``a, b``, both directions).

    Rows that share no path, set or link with another are accepted at once and take no part."""
    shared = rows.where("path is not null").join(_busy(rows, "path"), "path", "left_semi").select("id", "batch", "path", "set_id")
    near = _busy(rows, "set_id").union(links.select(F.col("a"))).distinct()
    linked = rows.where("set_id is not null").join(near, "set_id", "left_semi").select("id", "batch", "path", "set_id")
    contested = materialize(shared.union(linked).distinct().withColumn("o", F.struct("batch", "id")))
    # of rows with the same path and the same set only the first can be accepted
    undecided = first = materialize(contested.groupBy("path", "set_id").agg(F.min("o").alias("o")))
    accepted = []
    while not undecided.isEmpty():
        by_path = undecided.where("path is not null").groupBy("path").agg(F.min("o").alias("min_path"))
        by_set = undecided.where("set_id is not null").groupBy("set_id").agg(F.min("o").alias("min_set"))
        by_link = links.join(by_set, F.col("b") == F.col("set_id")).groupBy("a").agg(F.min("min_set").alias("min_link")).withColumnRenamed("a", "set_id")
        seen = undecided.join(by_path, "path", "left").join(by_set, "set_id", "left").join(by_link, "set_id", "left")
        free = lambda c: F.col(c).isNull() | (F.col("o") <= F.col(c))
        won = materialize(seen.where(free("min_path") & free("min_set") & free("min_link")).select("path", "set_id", "o"))
        accepted.append(won)
        dead_sets = won.where("set_id is not null").select("set_id").union(won.join(links, F.col("set_id") == F.col("a")).select("b")).distinct()
        rest = undecided.join(won.where("path is not null").select("path").distinct(), "path", "left_anti").join(dead_sets, "set_id", "left_anti")
        undecided = materialize(rest.join(won.where("path is null and set_id is null").select("o"), "o", "left_anti").select("path", "set_id", "o"))
    won = accepted[0].select("o") if accepted else first.select("o")
    for more in accepted[1:]:
        won = won.union(more.select("o"))
    return contested.join(won, "o", "left_anti").select("id", "batch")


def repeated_rows(df: DataFrame, id_col: str = "row_id", batch_col: str = "batch_no", path_col: str = "filepath", text_col: str = "description", t: float = THRESHOLD) -> DataFrame:
    """``id, batch`` of the cases of all batches of ``df``, taken in order of batch and id in one pass.

    The same as offering the batches one by one to an empty :class:`SegmentHistory`."""
    rows = materialize(prepare(df, id_col, batch_col, path_col, text_col, False))
    links = materialize(_links(simjoin.similar_sets(df, text_col, t)))
    return resolve(rows, links)


class SegmentHistory:
    """Accepted rows as append-only tables in a shared folder.

    ``batches/<first>-<last>`` holds what those offers appended: ``segments`` (those of
    each set, the set as a whole, and the paths) and ``sets`` (the tokens of each set; a set that
    several tasks met stands there several times), both split by key into the same number of parts. A batch is written aside and becomes visible by one
    rename, whole or not at all; after MERGE batches they are merged into one.

    What a batch probes goes to the executors that hold the parts it falls into: the
    stored tables are read there, but neither shuffled nor sorted. So a batch costs a scan of
    the parts it probes, and shuffles only rows of its own. A batch as large as the
    history is joined with it by a shuffle instead.

    The token order, which tokens are hot and the number of parts are fixed when the index is
    made, from the first batch (any order is right; new tokens count as rare), and stand
    beside the segments: whoever opens the folder later, with the same ``t``, takes them
    from there."""

    def __init__(self, spark: SparkSession, path: str, t: float = THRESHOLD):
        self.spark, self.path, self.t = spark, path.rstrip("/"), t
        self.order: simjoin.Order | None = None
        self.hot, self.parts = simjoin.HOT, 1

    def _fs(self, *names: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))
        return where, where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _batches(self) -> list[tuple[int, int]]:
        """First and last offer of each visible batch, in order; merged ones hide those they hold."""
        where, fs = self._fs("batches")
        if not fs.exists(where):
            return []
        spans = sorted({tuple(map(int, x.getPath().getName().split("-"))) for x in fs.listStatus(where)})
        return [s for s in spans if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in spans)]

    def _stored(self, name: str, parts: list[int]) -> DataFrame:
        """Rows of the stored table in the given parts."""
        dirs = []
        for first, last in self._batches():
            at = f"batches/{first:08d}-{last:08d}/{name}"
            where, fs = self._fs(at)
            there = {x.getPath().getName() for x in fs.listStatus(where)} if fs.exists(where) else set()
            dirs += [f"{self.path}/{at}/part={p}" for p in parts if f"part={p}" in there]
        schema = TABLES[name]
        return self.spark.read.schema(schema).parquet(*dirs) if dirs else self.spark.createDataFrame([], schema)

    def _part(self, key: str) -> Column:
        return F.pmod(F.col(key), F.lit(self.parts)).cast("int")

    def _meet(self, probes: DataFrame, name: str, stored_key: str) -> DataFrame:
        """``probes`` joined with the stored rows whose ``stored_key`` is their ``probe``.

        Probes of a checked number (PROBES rows of fixed width at most, and few beside what is stored) are
        broadcast to the scan of their parts, in a few groups of parts; others are joined by a shuffle."""
        on = lambda stored: F.col("probe") == stored[stored_key]
        counts = {r["part"]: r["n"] for r in probes.groupBy(self._part("probe").alias("part")).agg(F.count("*").alias("n")).collect()}
        groups: list[list[int]] = []
        room = 0
        for p in sorted(counts):
            if counts[p] > room:
                groups.append([])
                room = PROBES
            groups[-1].append(p)
            room -= counts[p]
        stored = self._stored(name, sorted(counts))
        if len(groups) > GROUPS or max(counts.values(), default=0) > PROBES or SHARE * sum(counts.values()) > stored.count():
            return probes.join(stored, on(stored))
        found = []
        for g in groups or [[]]:
            stored = self._stored(name, g)
            found.append(stored.join(F.broadcast(probes if len(groups) <= 1 else probes.where(self._part("probe").isin(g))), on(stored)))
        return reduce(DataFrame.union, found)

    def _open(self, batch: DataFrame) -> None:
        """Take the order of the stored segments; of an empty folder, make and store it."""
        where, fs = self._fs("order")
        if fs.exists(where):
            (o,) = self.spark.read.schema(ORDER).parquet(f"{self.path}/order").collect()
            if (o["t"], o["bits"]) != (self.t, simjoin.BITS):
                raise ValueError(f"the index was made with t = {o['t']} and {o['bits']} bits, not {self.t} and {simjoin.BITS}")
            self.order, self.hot, self.parts = simjoin.Order(np.frombuffer(o["codes"], np.uint8), o["rows"]), o["hot"], o["parts"]
            return
        if self._batches():
            raise ValueError(f"the segments in {self.path} have no stored order, so nothing new can meet them; make the index again")
        self.order = simjoin.frequencies(batch, "tokens", 1)
        self.parts = min(MOST_PARTS, max(1, round(self.order.rows / PART_ROWS)))
        one = self.spark.createDataFrame([(self.t, simjoin.BITS, self.hot, self.order.rows, self.parts, bytearray(self.order.codes.tobytes()))], ORDER)
        one.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/order")

    def _append(self, tables: dict[str, DataFrame], span: tuple[int, int]) -> None:
        """Write the tables aside, then make them visible by one rename."""
        aside = f"aside/{uuid.uuid4().hex}"
        for name, df in tables.items():
            key = TABLES[name].split()[0]
            df.withColumn("part", self._part(key)).write.partitionBy("part").option("compression", "zstd").parquet(f"{self.path}/{aside}/{name}")
        made, fs = self._fs(aside)
        there, _ = self._fs("batches")
        fs.mkdirs(there)
        if not fs.rename(made, self._fs("batches", "{:08d}-{:08d}".format(*span))[0]):
            raise OSError(f"{self.path}/{aside} can't be renamed; another job may have appended a batch")

    def merge(self) -> None:
        """Write all visible batches as one. Readers see either them or it."""
        old = self._batches()
        if len(old) > 1:
            every = list(range(self.parts))
            self._append({name: self._stored(name, every).repartition(self.parts, self._part(schema.split()[0])) for name, schema in TABLES.items()}, (old[0][0], old[-1][1]))
            for span in old:
                where, fs = self._fs("batches", "{:08d}-{:08d}".format(*span))
                fs.delete(where, True)

    def offer(self, batch: DataFrame, id_col: str = "row_id", batch_col: str = "batch_no", path_col: str = "filepath", text_col: str = "description", prepared: bool = False) -> DataFrame:
        """``id, batch`` of the batch's cases; its accepted rows are appended to the index.

        ``prepared`` batches come from :func:`prepare`. Several batches offered at once are taken in order of batch and id."""
        rows = batch.select(*PREPARED) if prepared else materialize(prepare(batch, id_col, batch_col, path_col, text_col))
        if self.order is None:
            self._open(rows)
        tokens = rows.where("set_id is not null").select(F.col("set_id").alias("id"), "tokens")
        slim = rows.select("id", "batch", "path", "set_id")
        exact = [slim.where(f"{c} is not null").select(_exact_key(c, size).alias("key"), F.col(c).alias("id"), F.lit(0).cast("long").alias("sketch"), F.lit(size * (1 << 32) | 1).cast("long").alias("form")).distinct() for c, size in (("set_id", WHOLE), ("path", PATH))]
        mine = materialize(simjoin.segments(tokens, "tokens", 1, self.t, self.order, self.hot).union(exact[0]).union(exact[1]))
        sets = simjoin.once_a_task(tokens)
        first = not self._batches()
        state = slim.withColumn("dead", F.lit(False))
        if not first:
            dead = self._repeats(sets, mine)
            for size, col in ((PATH, "path"), (WHOLE, "set_id")):
                state = state.join(dead.where(F.col("size") == size).select(F.col("id").alias(col), F.lit(True).alias(f"dead_{col}")), col, "left")
            state = materialize(state.select("id", "batch", "path", "set_id", F.coalesce("dead_path", "dead_set_id", F.lit(False)).alias("dead")))
        fresh = state.where("not dead").drop("dead")
        met = materialize(simjoin.candidates(mine.where(simjoin.form(F.col("form"))["size"] > 0), self.t))
        few = _named(sets, met.select(F.explode(F.array("id_a", "id_b")).alias("id")).distinct())
        links = materialize(_links(simjoin.verified(simjoin.with_tokens(met, few), self.t)))
        inner = resolve(fresh, links)
        judged = state.join(inner.select("batch", "id", F.lit(True).alias("inner")), [state["batch"].eqNullSafe(inner["batch"]), state["id"].eqNullSafe(inner["id"])], "left").select(*(state[c] for c in slim.columns), (F.col("dead") | F.coalesce("inner", F.lit(False))).alias("gone"))
        judged = materialize(judged.distinct())
        # sets and paths of which no row was accepted
        lost = [judged.where(f"{c} is not null").groupBy(F.col(c).alias("id")).agg(F.every("gone").alias("gone")).where("gone").select("id", F.lit(size).alias("kind")) for c, size in (("set_id", WHOLE), ("path", PATH))]
        lost = materialize(lost[0].union(lost[1]))
        last = max((b for _, b in self._batches()), default=-1)
        kind = F.when(simjoin.form(F.col("form"))["size"] == PATH, PATH).otherwise(WHOLE)
        kept = mine.withColumn("kind", kind).join(lost, ["id", "kind"], "left_anti").select(*mine.columns)
        self._append({"segments": kept, "sets": sets.join(lost.where(F.col("kind") == WHOLE), "id", "left_anti")}, (last + 1, last + 1))
        release(mine)
        if len(self._batches()) >= MERGE:
            self.merge()
        return judged.where("gone").select("id", "batch")

    def _repeats(self, sets: DataFrame, mine: DataFrame) -> DataFrame:
        """``id, size`` of the batch's sets (WHOLE) and paths (PATH) that repeat a stored one."""
        asked = mine.select(F.col("key").alias("probe"), *(F.col(c).alias(c + "_a") for c in mine.columns if c != "key"))
        found = self._meet(asked, "segments", "key")
        a, b = (simjoin.form(F.col("form" + end)) | {"sketch": F.col("sketch" + end)} for end in ("_a", ""))
        smaller = a["lead"] & (a["size"] <= b["size"]) | b["lead"] & (b["size"] <= a["size"])
        near = (a["size"] > 0) & (b["size"] > 0) & (F.col("id_a") != F.col("id")) & smaller & simjoin.met(a, b, self.t)
        same = (a["size"] <= 0) & (a["size"] == b["size"])
        met = materialize(found.where(same | near).select("id_a", F.col("id").alias("id_b"), F.least(a["size"], F.lit(1)).cast("int").alias("kind")).distinct())
        pairs = met.where("kind > 0").select("id_a", "id_b")
        others = self._meet(pairs.select(F.col("id_b").alias("probe")).distinct(), "sets", "id").select("id", "tokens").dropDuplicates(["id"])
        few = _named(sets, pairs.select(F.col("id_a").alias("id")).distinct())
        alike = simjoin.verified(simjoin.with_tokens(pairs, few, others), self.t)
        return materialize(met.where("kind <= 0").select(F.col("id_a").alias("id"), F.col("kind").alias("size")).union(alike.select("id_a", F.lit(WHOLE))).distinct())


def _named(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """The ``sets`` named in ``ids``, whose number is checked before they are broadcast, each once."""
    ids = materialize(ids)
    return materialize(sets.join(F.broadcast(ids) if ids.count() <= PROBES else ids, "id", "left_semi").dropDuplicates(["id"]))


def _exact_key(col: str, kind: int) -> Column:
    return F.xxhash64(F.lit(kind), F.col(col))


def offered_rows(df: DataFrame, id_col: str = "row_id", batch_col: str = "batch_no", path_col: str = "filepath", text_col: str = "description", t: float = THRESHOLD) -> DataFrame:
    """``id, batch`` of the cases of all batches of ``df``, offered in order to an empty :class:`SegmentHistory`; rows without a batch come first.

    All batches of ``df`` are waiting, so successive ones are offered together as long as they hold no
    more rows than all before them: a backlog costs one reading of the history, not one a batch. They
    are prepared together, each into a folder of its own, as they would lie on arrival."""
    spark = df.sparkSession
    where = f"{shared_dir(spark)}/gaugeworks/{uuid.uuid4().hex}"
    ready = prepare(df, id_col, batch_col, path_col, text_col).withColumn("batch_no", F.col("batch"))
    ready.write.partitionBy("batch_no").option("compression", "zstd").parquet(f"{where}/prepared")
    batches = spark.read.schema(ready.schema).parquet(f"{where}/prepared")
    index = SegmentHistory(spark, f"{where}/index", t)
    sizes = [(r["no"], r["n"]) for r in df.groupBy(F.col(batch_col).cast("long").alias("no")).agg(F.count("*").alias("n")).orderBy("no").collect()]
    runs: list[list] = []
    before = run = 0
    for no, n in sizes:
        if not runs or run + n > before:
            before, run = before + run, 0
            runs.append([])
        runs[-1].append(no)
        run += n
    no = F.col("batch_no")
    cases = []
    for run in runs:
        batch = batches.where(reduce(Column.__or__, (no.eqNullSafe(x) for x in run)))
        cases.append(index.offer(batch, id_col, batch_col, path_col, text_col, True))
        for x in run:  # nothing reads a batch again once it has been offered
            folder, fs = index._fs("..", "prepared", f"batch_no={'__HIVE_DEFAULT_PARTITION__' if x is None else x}")
            fs.delete(folder, True)
    return reduce(DataFrame.union, cases, spark.createDataFrame([], "id long, batch long"))
