import collections
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeworks.llm import mixing, packing, readability, tokenizer

DOCS = "doc_id long, text string, lang string, source string, class int, rank string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], DOCS)


def check_packing(sizes, packed, capacity):
    by_doc, used = collections.defaultdict(list), collections.Counter()
    for r in packed:
        by_doc[r["doc_id"]].append(r)
        if r["container_id"]:
            used[r["container_id"]] += r["n_tokens"]
    assert set(by_doc) == {i for i, _ in sizes}
    assert all(v <= capacity for v in used.values())
    for i, n in sizes:
        pieces = sorted(by_doc[i], key=lambda r: r["piece"])
        assert sum(p["n_tokens"] for p in pieces) == (n or 0)
        assert len(pieces) == max(1, -(-(n or 0) // capacity))  # split only if longer than a container
        at = 0
        for p in pieces:
            assert p["token_from"] == at and (p["container_id"] is None) == (not n)
            at += p["n_tokens"]
    return used


@settings(max_examples=4, deadline=None)
@given(st.lists(st.one_of(st.none(), st.just(0), st.integers(1, 300)), max_size=60))
def test_any_sizes_are_packed_whole(spark, sizes):
    rows = list(enumerate(sizes))
    packed = packing.pack_sizes(spark.createDataFrame(rows, "doc_id long, n long"), "doc_id", "n", 100).collect()
    check_packing(rows, packed, 100)


@pytest.mark.parametrize("kind", ["mixed", "one size", "large only"])
def test_little_space_is_left(spark, kind):
    rng = random.Random(2)
    pick = {"mixed": lambda: int(min(9000, rng.lognormvariate(5.8, 1))), "one size": lambda: 1024, "large only": lambda: rng.randint(2049, 4096)}[kind]
    rows = [(i, pick()) for i in range(4000)]
    used = check_packing(rows, packing.pack_sizes(spark.createDataFrame(rows, "doc_id long, n long"), "doc_id", "n", 4096).collect(), 4096)
    if kind == "mixed":
        assert sum(used.values()) / (4096 * len(used)) > 0.94
    else:  # no two of them share a container, or four fill one
        assert len(used) == (1000 if kind == "one size" else 4000)


def test_counts_whole_texts(spark):
    rows = [(1, "hello world", "en", "a"), (2, None, None, None), (3, "", "en", "a"), (4, " ", "en", "a"), (5, "word " * 20_000, "en", "a"), (6, "<|endoftext|>", "en", "a")]
    got = {r["doc_id"]: r["n_tokens"] for r in tokenizer.token_counts(docs(spark, rows), ["doc_id"], "text").collect()}
    assert (got[1], got[2], got[3], got[4]) == (2, 0, 0, 1) and got[5] >= 20_000 and got[6] > 1
    packed = packing.pack(docs(spark, rows)).collect()
    check_packing([(i, got[i]) for i in got], packed, packing.CAPACITY)
    one = packing.fill(packing.pack(docs(spark, rows))).first()
    assert one["overfull"] == 0 and one["documents_without_tokens"] == 2 and packing.pack(docs(spark, [])).count() == 0


TARGETS = [("a", 0.5, 2), ("B_b", 0.3, 1), ("small", 0.15, 4), ("none", 0.05, 3)]


def test_mix_holds_shares(spark):
    rng = random.Random(3)
    spell = {"a": ["a", " A "], "b_b": ["b_b", "B-b", "b b "], "small": ["small"], "x": [None, "other"]}
    rows = []
    for i in range(2000):
        s = rng.choices(list(spell), [40, 40, 10, 10])[0]
        rows.append((i, " ".join(rng.choices("lot tray crop lens scan".split(), k=rng.randint(1, 60))) + f" {i}", "en", rng.choice(spell[s])))
    rows += [(5000 + i, "one text that many documents repeat", "en", rng.choice(["a", "small", "b_b"])) for i in range(1000)] + [(9000, None, "en", "a"), (9001, " \n", "en", "a"), (None, "no id", None, "a")]
    targets = spark.createDataFrame(TARGETS, "source_name string, target_share double, max_repeats int")
    d = docs(spark, rows)
    mixed = mixing.mix(d, targets)
    got = mixed.collect()
    text = {r[0]: r[1] for r in rows}
    uses = collections.Counter()
    for r in got:
        uses[text[r["doc_id"]]] += r["copies"]
    limit = {mixing_name.lower(): n for mixing_name, _, n in TARGETS}
    assert all(r["copies"] <= limit[r["source_name"]] for r in got) and uses["one text that many documents repeat"] <= 4
    assert len({text[r["doc_id"]] for r in got}) == len(got)
    report = {r["source_name"]: r for r in mixing.shares(mixed, targets).collect()}
    assert set(report) == {"a", "b_b", "small", "none"} and report["none"]["actual_share"] == 0
    for s, want in (("a", 0.5 / 0.95), ("b_b", 0.3 / 0.95), ("small", 0.15 / 0.95)):
        assert abs(report[s]["actual_share"] - want) < 0.01
    assert sum(r["actual_share"] for r in report.values()) == pytest.approx(1)
    assert set(map(tuple, got)) == set(map(tuple, mixing.mix(d, targets).collect()))


def test_mix_of_nothing(spark):
    targets = spark.createDataFrame(TARGETS, "source_name string, target_share double, max_repeats int")
    assert mixing.mix(docs(spark, []), targets).count() == 0
    assert mixing.mix(docs(spark, [(1, "x", "en", "a")]), targets.limit(0)).count() == 0
    assert mixing.expected_copies({"a": (0.5, 2, 10), "b": (0.5, 1, 0)}) == {"a": 2.0, "b": 0.0}


@pytest.mark.parametrize(
    "text, n",
    [
        ("One. Two! Three?", 3),
        ("The score (cf. Fig. 3) rose by 0.04 points. It held.", 2),
        ("Dr. Smith saw e.g. the lens, i.e. the new one. She left.", 2),
        ("He said \"stop.\" Then he left.", 2),
        ("At no. 5 we stopped... Then we went on", 2),
        ("A title without an end", 0),
    ],
)
def test_sentences(text, n):
    assert readability.sentence_ends(text) == n


def test_only_prose_counts():
    text = (
        "﻿# A Heading. With stops.\r\n\r\nThe lens was old. It\r\nbroke twice.\r\n\r\n- an item. And more.\r\n* other. Item.\r\n1. first. One.\r\n\r\n| a. | b. |\r\n[2025-01-01 00:00:00] step=1. Done.\r\n"
        "BRD-1/AOI_A,golden/a,shift,C300@1\r\n```python\r\nx = 1. Not prose.\r\n```\r\n> quoted. Text.\r\nkey: value\r\n{\"a\": 1}\r\n\r\nThe end came. Fast!"
    )
    sentences, words, letters = readability.measure(text)
    assert sentences == 4 and words == "the lens was old it broke twice the end came fast".split() and letters == sum(map(len, words))
    assert readability.measure(None) == readability.measure(" \n") == (0, [], 0)


PLAIN = "The cat sat on my mat. A dog ran to the red box. We saw it go up. The sun was hot. I ate my egg. "
HARD = "Multidimensional regularization characteristically attenuates representational heteroscedasticity accompanying interconnected photometric instrumentation, notwithstanding longitudinal electrochemical misalignment between metallurgical configurations undermining interpretable categorical distributions. "


def levels(spark, rows):
    return {r["doc_id"]: r for r in readability.reading_bands(readability.reading_levels(docs(spark, rows))).collect()}


@pytest.mark.parametrize("limit", [300_000, 0])
def test_levels_and_bands(spark, monkeypatch, limit):
    monkeypatch.setattr(readability, "BROADCAST_WORDS", limit)
    mid = "During review, the combined template replaced several labelled images and nobody saw the gap until Monday. "
    rows = [(i, PLAIN * 3, " EN-gb", "a") for i in range(5)] + [(10 + i, HARD * 6, "en", "a") for i in range(5)] + [(20 + i, mid * 6, "en_us", "a") for i in range(5)] + [(30, "The cat sat.", "en", "a"), (31, None, None, None), (32, "", "en", "a"), (33, PLAIN * 3, "de", "a"), (34, "- " + PLAIN.replace(". ", ".\n- "), "en", "a")]
    got = levels(spark, rows)
    assert len(got) == len(rows)
    assert {got[i]["reading_band"] for i in range(5)} == {"plain"} and {got[10 + i]["reading_band"] for i in range(5)} == {"specialist"} and {got[20 + i]["reading_band"] for i in range(5)} == {None}
    assert got[0]["level"] < got[20]["level"] < got[10]["level"]
    assert got[30]["reading_band"] is None and got[31]["level"] is None and got[32]["level"] is None and got[34]["sentences"] == 0


def test_levels_follow_held_out_grades(spark):
    """Documents too short to be graded themselves get a level near the grade of their kind."""
    got = levels(spark, [(i, PLAIN * 3, "en", "a") for i in range(5)] + [(10 + i, HARD * 6, "en", "a") for i in range(5)] + [(30, "The cat sat on my mat.", "en", "a"), (31, HARD, "en", "a")])
    assert abs(got[30]["level"] - got[0]["level"]) < 3 and abs(got[31]["level"] - got[10]["level"]) < 3


def test_no_documents(spark):
    assert levels(spark, []) == {}


def test_language_keys(spark):
    df = spark.createDataFrame([(x,) for x in (" EN ", "en-US", "en_xx", "eng", None, "")], "l string").select(readability.language(F.col("l")).alias("k"))
    assert [r["k"] for r in df.collect()] == ["en", "en", "en", "eng", "", ""]
