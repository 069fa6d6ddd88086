"""Mixing sources to target shares of tokens, by systematic sampling.

Each distinct text is used through one document: the one with the smallest id among
those of a listed source. A source whose texts hold t tokens and that is to give S
tokens expects e = S / t copies of each of them. Texts stand in order of source, size
and id; the prefix sum of expected copies plus one random offset a source crosses an
integer floor(e) or ceil(e) times within a text, and that many copies are emitted. As
the order is by size, the tokens reached stay close to S.

The size of the mix is the largest at which no source needs more than its max_repeats,
so ceil(e) never exceeds it. A listed source without any token can't give its share;
the others keep their proportions and the report shows what was reached."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.paths import strip_blank
from gaugeworks.llm.tokenizer import VOCABULARY, token_counts
from gaugeworks.operators.prefix import prefix_sums
from gaugeworks.session import materialize


def source_key(col: Column) -> Column:
    """Sources are the same regardless of letter case, outer blanks, and ``-``, blanks or ``_`` between words."""
    return F.regexp_replace(F.lower(strip_blank(col)), r"[\s_-]+", "_")


def expected_copies(sources: dict[str, tuple[float, int, int]]) -> dict[str, float]:
    """Copies expected of each text by source, from (share, max_repeats, tokens); 0 where a source has no tokens or share."""
    able = {s: v for s, v in sources.items() if v[2] > 0 and v[0] > 0 and v[1] > 0}
    if not able:
        return {s: 0.0 for s in sources}
    size = min(tokens * repeats / share for share, repeats, tokens in able.values())
    return {s: min(float(able[s][1]), able[s][0] * size / able[s][2]) if s in able else 0.0 for s in sources}


def mix(documents: DataFrame, targets: DataFrame, seed: int = 42, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, source_name, n_tokens, copies``: the documents used, each with its number of copies (1 or more).

    Null and blank texts, null and unlisted sources, and repeats of a text already used give no row.
    ``targets`` is small and fixed: one row a source, repeated names taken once."""
    listed = {}
    for r in targets.select(source_key(F.col("source_name")).alias("s"), "target_share", "max_repeats").collect():
        if r["s"] and r["target_share"] is not None and r["max_repeats"] is not None:
            listed.setdefault(r["s"], (float(r["target_share"]), int(r["max_repeats"])))
    text = F.col("text")
    docs = documents.select("doc_id", source_key(F.col("source")).alias("source_name"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), text.alias("text"))
    docs = docs.where(F.col("source_name").isin(*listed) & (strip_blank(F.col("text")) != ""))
    counted = token_counts(docs, ["doc_id", "source_name", "h1", "h2"], "text", vocabulary)
    first = F.min(F.struct("doc_id", "source_name", "n_tokens")).alias("x")
    texts = materialize(counted.groupBy("h1", "h2").agg(first).select("x.*"))
    tokens = {r["source_name"]: r["t"] for r in texts.groupBy("source_name").agg(F.sum("n_tokens").alias("t")).collect()}
    copies = expected_copies({s: (*v, tokens.get(s, 0)) for s, v in listed.items()})
    rng = random.Random(seed)
    offset = {s: rng.random() for s in sorted(copies)}
    table = lambda d: F.element_at(F.create_map(*(F.lit(x) for k, v in d.items() for x in (k, v))), F.col("source_name"))
    ranked = prefix_sums(texts, ["source_name", "n_tokens", "doc_id"], {"rank": F.lit(1).cast("long")})
    count = {r["source_name"]: r["n"] for r in texts.groupBy("source_name").agg(F.count("*").alias("n")).collect()}
    start, at = {}, 0
    for s in sorted(copies):
        start[s] = at
        at += count.get(s, 0)
    place = F.col("rank") - table(start)
    crossed = F.floor((place + 1) * table(copies) + table(offset)) - F.floor(place * table(copies) + table(offset))
    return ranked.withColumn("copies", crossed.cast("int")).where("copies > 0").select("doc_id", "source_name", "n_tokens", "copies")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """``source_name, target_share, actual_share, tokens, texts, most_copies, max_repeats`` for every listed source."""
    got = mixed.groupBy("source_name").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("texts"), F.max("copies").alias("most_copies"))
    total = mixed.agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("all_tokens"))
    named = targets.withColumn("source_name", source_key(F.col("source_name")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    joined = named.join(got, "source_name", "left").crossJoin(F.broadcast(total))
    return joined.select("source_name", "target_share", F.coalesce(F.try_divide(F.col("tokens"), F.col("all_tokens")), F.lit(0.0)).alias("actual_share"), zero("tokens"), zero("texts"), zero("most_copies"), "max_repeats")
