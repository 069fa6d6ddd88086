"""Filling containers of a fixed number of tokens with documents, by harmonic packing.

A document of s tokens is of class j = floor(C / s): j of its class always fit in a
container of C, so every container of a class takes a fixed number of documents,
wherever it's filled, and none is split. Documents longer than C are cut into full
containers and a rest; only they are.

Large classes (below SMALL) leave gaps. A gap g is itself a container: it takes
floor(g / smax) of a tier of small documents no larger than smax = C / (the tier's
lowest class), again a fixed number. The tiers go in order from larger to smaller.
Small documents that no gap takes fill containers of their own class; those of class
TINY and above are laid end to end, a container taking all that begin in its first
C - C / TINY tokens.

The last, incomplete container of each class is no container yet: what would lie in
them, under TINY**2 / 2 documents whatever the data, is placed first-fit by falling size.

Ranks come from one two-pass prefix sum over (class, size, id); what reaches the
driver is one number a class and tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.tokenizer import VOCABULARY, token_counts
from gaugeworks.operators.prefix import prefix_sums
from gaugeworks.session import materialize

CAPACITY = 4096
SMALL = 6
TINY = 64
TIERS = ((SMALL, 10), (10, 18), (18, 36), (36, TINY + 1))


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """Tokenize and pack whole texts; see :func:`pack_sizes`."""
    return pack_sizes(materialize(token_counts(df, [id_col], text_col, vocabulary)), id_col, "n_tokens", capacity)


def pack_sizes(sizes: DataFrame, id_col: str, size_col: str, capacity: int = CAPACITY) -> DataFrame:
    """``id_col, piece, token_from, n_tokens, container_id``: one row for each document, or piece of a longer one.

    Documents without tokens (null, empty) come out with a null container, as nothing is to be placed.
    Rows with the same id are placed each for itself."""
    c = F.lit(capacity).cast("long")
    base = sizes.select(F.col(id_col), F.coalesce(F.col(size_col), F.lit(0)).cast("long").alias("total"))
    whole = base.where(F.col("total") >= c).select(id_col, "total", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("total") / c) - 1)).alias("piece"))
    whole = whole.select(id_col, "piece", (F.col("piece") * c).alias("token_from"), c.alias("n_tokens"), F.concat(F.lit("full-"), F.col(id_col).cast("string"), F.lit("-"), F.col("piece").cast("string")).alias("container_id"))
    nothing = base.where("total = 0").select(id_col, F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("token_from"), F.col("total").alias("n_tokens"), F.lit(None).cast("string").alias("container_id"))
    rest = base.where(F.col("total") % c > 0).select(id_col, F.floor(F.col("total") / c).alias("piece"), (F.floor(F.col("total") / c) * c).alias("token_from"), (F.col("total") % c).alias("n_tokens"))
    rest = rest.withColumn("class", F.least(F.floor(c / F.col("n_tokens")), F.lit(TINY)))
    items = materialize(prefix_sums(rest, ["class", F.col("n_tokens").desc(), id_col, "piece"], {"rank": F.lit(1).cast("long"), "laid": F.col("n_tokens")}))
    per_class = {r["class"]: (r["n"], r["size"]) for r in items.groupBy("class").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("size")).collect()}
    start, begun = {}, {}
    at = laid = 0
    for j in range(1, TINY + 1):
        start[j], begun[j] = at, laid
        n, size = per_class.get(j, (0, 0))
        at, laid = at + n, laid + size
    start[TINY + 1] = at

    def in_class(cut: dict[int, int]) -> DataFrame:
        """Containers of the class itself for the items from rank ``cut`` of the class on."""
        j = F.col("class")
        by = _by_class(cut)
        mine = items.where(F.col("rank") >= by)
        tiny_from = mine.where(j == TINY).agg(F.min("laid")).first()[0] or 0
        number = F.when(j < TINY, F.floor((F.col("rank") - by) / j)).otherwise(F.floor((F.col("laid") - F.lit(tiny_from)) / F.lit(capacity - capacity // TINY)))
        return mine.withColumn("container_id", F.concat(F.lit("class"), j.cast("string"), F.lit("-"), number.cast("string")))

    placed = [in_class({j: start[j] if j < SMALL else start[TINY + 1] for j in range(1, TINY + 1)})]
    gaps = materialize(placed[0].groupBy("container_id").agg((c - F.sum("n_tokens")).alias("gap")))
    taken: dict[int, int] = {}
    for low, high in TIERS:
        slots = F.floor(F.col("gap") * low / c)
        room = prefix_sums(gaps.withColumn("slots", slots).where("slots > 0"), [F.col("gap").desc(), "container_id"], {"before": F.col("slots")})
        n_items = start[high] - start[low]
        room = room.where(F.col("before") < n_items).withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)))
        room = room.select("container_id", (F.col("before") + F.col("slot") + F.lit(start[low])).alias("rank"))
        got = materialize(items.where((F.col("class") >= low) & (F.col("class") < high)).join(room, "rank"))
        placed.append(got)
        taken[low] = got.count()
        used = got.groupBy("container_id").agg(F.sum("n_tokens").alias("used"))
        gaps = materialize(gaps.join(used, "container_id", "left").select("container_id", (F.col("gap") - F.coalesce("used", F.lit(0))).alias("gap")))
    cut = {j: start[TINY + 1] for j in range(1, SMALL)}
    for low, high in TIERS:
        cut |= {j: max(start[j], start[low] + taken[low]) for j in range(low, high)}
    ends = {j: start[j + 1] - (start[j + 1] - cut[j]) % j if SMALL <= j < TINY else start[TINY + 1] for j in range(1, TINY + 1)}
    own, tail = in_class(cut), F.col("rank") >= _by_class(ends)
    placed.append(own.where(~tail))
    placed.append(_first_fit(own.where(tail), capacity))
    out = whole.unionByName(nothing)
    for p in placed:
        out = out.unionByName(p.select(id_col, "piece", "token_from", "n_tokens", "container_id"))
    return out


def _by_class(values: dict[int, int]) -> Column:
    """The value of a row's class."""
    return F.element_at(F.array(*(F.lit(values[j]).cast("long") for j in range(1, TINY + 1))), F.col("class").cast("int"))


def _first_fit(few: DataFrame, capacity: int) -> DataFrame:
    """Place a bounded number of items by first fit of falling sizes, on the driver."""
    rows, free, spots = few.select("rank", "n_tokens").collect(), [], []
    for r in sorted(rows, key=lambda r: (-r["n_tokens"], r["rank"])):
        at = next((i for i, x in enumerate(free) if x >= r["n_tokens"]), len(free))
        if at == len(free):
            free.append(capacity)
        free[at] -= r["n_tokens"]
        spots.append((r["rank"], f"rest-{at}"))
    where = few.sparkSession.createDataFrame(spots, "rank long, _spot string")
    return few.join(F.broadcast(where), "rank").withColumn("container_id", F.col("_spot"))


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``containers, tokens, fill, overfull, documents_without_tokens`` of a packing: one row."""
    by = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("pieces"))
    held = F.col("container_id").isNotNull()
    return by.agg(
        F.count_if(held).alias("containers"),
        F.sum(F.when(held, F.col("used"))).alias("tokens"),
        F.try_divide(F.sum(F.when(held, F.col("used"))), F.count_if(held) * F.lit(capacity)).alias("fill"),
        F.count_if(held & (F.col("used") > capacity)).alias("overfull"),
        F.coalesce(F.sum(F.when(~held, F.col("pieces"))), F.lit(0)).alias("documents_without_tokens"),
    )
