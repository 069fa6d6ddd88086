"""How demanding each document is: word acquisition grades, then a level for the document.

1. Prose is told from headings, lists, tables, log lines, code and data lines, and cut
   into sentences.
2. Documents with at least MIN_SENTENCES sentences of prose get a seed grade of 1 to 20
   from the automated readability index, a line in letters per word and words per sentence.
3. Over all of them, a word's occurrences per grade, each grade weighing the same, give
   its acquisition grade: the lowest by which ACQUIRED of its use has been seen. A word is
   known if it occurs MIN_COUNT times. Languages are kept apart.
4. A document's known words have quantiles of grades; their calibration to the seed
   grades (least squares over all graded documents) gives every document's level.

The band of a document is checked exactly on its sentences: a level below MIDDLE can
only be ``plain``, one above only ``specialist`` (the bands' own limits stand at grades
of about 6 and 19).

Null and blank texts, and texts without known words, come out with a null level."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.paths import strip_blank
from gaugeworks.session import materialize

MIN_SENTENCES = 5
GRADES = 20
ACQUIRED = 0.25
MIN_COUNT = 5
QUANTILES = (0.25, 0.5, 0.75, 0.9)
MIDDLE = 12.5
BROADCAST_WORDS = 300_000
# fixed values: abbreviations whose full stop ends no sentence
ABBREVIATIONS = frozenset("al approx art ca cf ch dept dr ed eds eq est etc fig figs i.e e.g inc jr ltd max min mr mrs ms no nos p para pp prof ref resp rev sec sr st tab viz vol vs".split())

_NOT_PROSE = re.compile(r"\s*(?:#{1,6}(?:\s|$)|[-*+•–]\s|\d{1,3}[.)]\s|\(?[a-z]\)\s|\||>|[{}<]|={3,}|-{3,}|\[?\d{4}-\d\d-\d\d|\[?\d\d:\d\d:\d\d|(?:INFO|WARN|WARNING|ERROR|DEBUG|TRACE)\b|[^\s,;]+(?:[,;][^\s,;]*){2,}\s*$|[\w.-]+\s*[=:]\s*[\[\]\w.,\"' +-]{0,40}$)")
_FENCE = re.compile(r"\s*(?:```|~~~)")
_END = re.compile(r"[.!?…]+[\"'”’)\]]*(?:\s+(?=[^a-z\s])|\s*$)")
_WORD = re.compile(r"[^\W\d_]+")


def prose_blocks(text: str) -> list[str]:
    """The paragraphs of prose, each as one line."""
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    blocks, run, fenced = [], [], False
    for line in text.lstrip("\ufeff").split("\n"):
        if _FENCE.match(line):
            fenced = not fenced
            other = True
        else:
            other = fenced or not line or line.isspace() or _NOT_PROSE.match(line) is not None
        if not other:
            run.append(line)
        elif run:
            blocks.append(" ".join(run))
            run = []
    if run:
        blocks.append(" ".join(run))
    return blocks


def sentence_ends(block: str) -> int:
    """Sentences of a paragraph; 0 if none of it ends like one (a title, a label)."""
    n = last = 0
    for m in _END.finditer(block):
        at = m.start()
        if block[at] == "." and m.end() < len(block):
            before = block[max(0, at - 12) : at].rsplit(None, 1)
            word = before[-1].lower().lstrip("([\"'“‘") if before else ""
            if word in ABBREVIATIONS or (len(word) == 1 and word.isalpha() and word != "i"):
                continue
        n += 1
        last = m.end()
    if n and _WORD.search(block, last):
        n += 1
    return n


def measure(text: str | None) -> tuple[int, list[str], int]:
    """Sentences of prose, their words in lower case, and the words' letters."""
    sentences, words = 0, []
    for block in prose_blocks(text) if text else ():
        n = sentence_ends(block)
        if n:
            sentences += n
            words += _WORD.findall(block.lower())
    return sentences, words, sum(map(len, words))


def seed_grade(sentences: int, words: int, letters: int) -> int:
    """The automated readability index as a grade of 1 to GRADES; 0 for too little prose."""
    if sentences < MIN_SENTENCES or not words:
        return 0
    return int(min(GRADES, max(1, round(4.71 * letters / words + 0.5 * words / sentences - 21.43))))


def language(col: Column) -> Column:
    """The main language tag: without blanks, letter case and what follows ``-`` or ``_``; blank for null."""
    return F.coalesce(F.element_at(F.split(F.lower(strip_blank(col)), "[-_]"), 1), F.lit(""))


def word_grades(docs: DataFrame) -> DataFrame:
    """``lang, word, grade`` of the known words of ``docs`` (``lang, text``), over all graded documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], Counter] = {}

        def flush():
            rows = [(lang, w, g, n) for (lang, g), c in seen.items() for w, n in c.items()]
            seen.clear()
            cols = list(zip(*rows)) if rows else [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64())], names=["lang", "word", "grade", "n"])

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sentences, words, letters = measure(text)
                g = seed_grade(sentences, len(words), letters)
                if g:
                    seen.setdefault((lang, g), Counter()).update(words)
            if sum(map(len, seen.values())) > 500_000:
                yield flush()
        yield flush()

    counts = docs.select("lang", "text").mapInArrow(count, "lang string, word string, grade int, n long")
    counts = materialize(counts.groupBy("lang", "word", "grade").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("lang", "grade").agg(F.sum("n").alias("total"))
    by_word = Window.partitionBy("lang", "word")
    shares = counts.join(totals, ["lang", "grade"]).withColumn("share", F.col("n") / F.col("total"))
    shares = shares.withColumn("all", F.sum("share").over(by_word)).withColumn("seen", F.sum("n").over(by_word)).withColumn("by", F.sum("share").over(by_word.orderBy("grade").rowsBetween(Window.unboundedPreceding, 0)))
    return shares.where((F.col("seen") >= MIN_COUNT) & (F.col("by") >= ACQUIRED * F.col("all"))).groupBy("lang", "word").agg(F.min("grade").alias("grade"))


_FEATURES = "doc_id long, sentences long, words long, letters long, seed int"


def _histograms(docs: DataFrame, grades: DataFrame) -> DataFrame:
    """The measures of each document and ``hist``: its known words by grade."""
    if grades.count() <= BROADCAST_WORDS:
        table: dict[str, dict[str, int]] = {}
        for r in grades.toLocalIterator():
            table.setdefault(r["lang"], {})[r["word"]] = r["grade"]
        shared = docs.sparkSession.sparkContext.broadcast(table)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out, hist = [], np.zeros((b.num_rows, GRADES), np.int64)
                for i, (lang, text) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                    s, words, letters = measure(text)
                    out.append((s, len(words), letters, seed_grade(s, len(words), letters)))
                    known = shared.value.get(lang)
                    if known and words:
                        g = [x for x in map(known.get, words) if x]
                        hist[i] = np.bincount(g, minlength=GRADES + 1)[1:] if g else 0
                cols = np.array(out, np.int64).reshape(-1, 4)
                offsets = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * GRADES)
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(cols[:, k]) for k in range(3)), pa.array(cols[:, 3].astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(hist.ravel()))], names=["doc_id", "sentences", "words", "letters", "seed", "hist"])

        return docs.select("doc_id", "lang", "text").mapInArrow(count, _FEATURES + ", hist array<long>")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, lang, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                s, words, letters = measure(text)
                out += [(doc, lang, w, n, s, len(words), letters, seed_grade(s, len(words), letters)) for w, n in (Counter(words) or {"": 0}).items()]
            cols = list(zip(*out)) if out else [[]] * 8
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "lang", "word", "n", "sentences", "words", "letters", "seed"])

    rows = docs.select("doc_id", "lang", "text").mapInArrow(explode, "doc_id long, lang string, word string, n long, sentences long, words long, letters long, seed int")
    sums = [F.coalesce(F.sum(F.when(F.col("grade") == g, F.col("n"))), F.lit(0)) for g in range(1, GRADES + 1)]
    return rows.join(grades, ["lang", "word"], "left").groupBy("doc_id", "sentences", "words", "letters", "seed").agg(F.array(*sums).alias("hist"))


def _quantiles(hist: np.ndarray) -> np.ndarray:
    """Interpolated quantiles of grades from counts by grade; rows without words give 0."""
    total = hist.sum(axis=1, keepdims=True)
    below = np.cumsum(hist, axis=1)
    out = np.zeros((len(hist), len(QUANTILES)))
    for k, q in enumerate(QUANTILES):
        want = q * total[:, 0]
        g = np.minimum((below < want[:, None]).sum(axis=1), hist.shape[1] - 1)
        here = np.take_along_axis(hist, g[:, None], 1)[:, 0]
        before = np.take_along_axis(below, g[:, None], 1)[:, 0] - here
        out[:, k] = g + np.divide(want - before, here, out=np.zeros(len(hist)), where=here > 0)
    return np.where(total > 0, out, 0)


def _hist(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, GRADES)


def reading_levels(documents: DataFrame) -> DataFrame:
    """``doc_id, sentences, words, letters, level`` for every row of ``documents``."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), language(F.col("lang")).alias("lang"), "text")
    measured = materialize(_histograms(docs, word_grades(docs)))
    size = len(QUANTILES) + 1

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for b in batches:
            if b.num_rows:
                seed, hist = np.asarray(b.column(0)), _hist(b.column(1))
                use = (seed > 0) & (hist.sum(axis=1) > 0)
                x = np.column_stack([np.ones(use.sum()), _quantiles(hist[use])])
                total += x.T @ np.column_stack([x, seed[use]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["at", "x"])

    sums = measured.select("seed", "hist").mapInArrow(normal, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).toPandas().sort_values("at")
    system = sums["x"].to_numpy().reshape(size, size + 1) if len(sums) else np.zeros((size, size + 1))
    fit = np.linalg.lstsq(system[:, :size], system[:, size], rcond=None)[0]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hist = _hist(b.column(4)) if b.num_rows else np.zeros((0, GRADES), np.int64)
            level = np.clip(np.column_stack([np.ones(len(hist)), _quantiles(hist)]) @ fit, 0, GRADES)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(level, mask=hist.sum(axis=1) == 0)], names=["doc_id", "sentences", "words", "letters", "level"])

    return measured.select("doc_id", "sentences", "words", "letters", "hist").mapInArrow(predict, "doc_id long, sentences long, words long, letters long, level double")


def reading_bands(levels: DataFrame) -> DataFrame:
    """``levels`` with ``reading_band``: plain, specialist or null."""
    enough = F.col("sentences") >= MIN_SENTENCES
    plain = (F.col("level") < MIDDLE) & (F.col("words") <= 12 * F.col("sentences")) & (2 * F.col("letters") <= 9 * F.col("words"))
    hard = (F.col("level") >= MIDDLE) & (F.col("words") >= 20 * F.col("sentences")) & (2 * F.col("letters") >= 13 * F.col("words"))
    return levels.withColumn("reading_band", F.when(enough & plain, "plain").when(enough & hard, "specialist"))
