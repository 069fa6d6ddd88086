"""Loading lines that may not parse: valid rows typed, the others with their reason.

Delimited lines are parsed at minimum cost. A dynamic programme over the characters
keeps, for each state of a quoted-field grammar, the cheapest way to have read the
line so far, inserting or deleting quotes where the grammar asks for it; then
delimiters are inserted or deleted until the columns fit. A line of cost zero whose
values have their types loads. Otherwise the edit operations of the cheapest repair state the
reason: edits of quotes come first (``broken_quoting``), then of delimiters
(``column_count``); values that a free parse leaves untyped follow.

Lines without any quote have one parse of cost zero and need no programme; the rest
go through it in one vectorised step a character for the whole batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.paths import strip_blank
from gaugeworks.operators.nested import strict_json

#: A finite decimal in ASCII digits: sign, fraction and exponent are optional.
DECIMAL = r"^\+?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
COLUMNS = 5

# states of the grammar: at the start of a field, in an unquoted one, in a quoted one, behind a quote in a quoted one
_START, _PLAIN, _QUOTED, _CLOSED = range(4)
_FAR = 1 << 20


def _moves() -> np.ndarray:
    """Cost of going from one state to another over a character of a kind (other, comma, quote), with the cheapest edits of quotes.

    Free moves are the grammar's. A quote may be deleted (stay where you are); one may be
    inserted before the character, which is a move over a quote first."""
    free = np.full((3, 4, 4), _FAR)
    for state, other, comma, quote in ((_START, _PLAIN, _START, _QUOTED), (_PLAIN, _PLAIN, _START, None), (_QUOTED, _QUOTED, _QUOTED, _CLOSED), (_CLOSED, None, _START, _QUOTED)):
        for kind, to in enumerate((other, comma, quote)):
            if to is not None:
                free[kind, state, to] = 0
    insert = np.where(np.eye(4, dtype=bool), 0, free[2] + 1)  # no quote before, or one inserted
    cost = np.min(insert[None, :, :, None] + free[:, None, :, :], axis=2)
    cost[2] = np.minimum(cost[2], np.where(np.eye(4, dtype=bool), 1, _FAR))  # a deleted quote
    return cost


_COST = _moves()
_AT_END = np.array([0, 0, 1, 0])  # a quoted field that never closed takes one inserted quote


def quote_edits(lines: list[str]) -> np.ndarray:
    """The least number of quotes to insert or delete so that each line is well-formed, for all lines at once."""
    sizes = np.array([len(x) for x in lines], np.int64)
    best = np.full((len(lines), 4), _FAR)
    best[:, _START] = 0
    if not len(lines) or not sizes.max():
        return np.zeros(len(lines), np.int64)
    order = np.argsort(-sizes, kind="stable")
    text = "".join(lines[i] for i in order)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = np.where(codes == ord(","), 1, np.where(codes == ord('"'), 2, 0)).astype(np.int8)
    sorted_sizes = sizes[order]
    begin = np.cumsum(sorted_sizes) - sorted_sizes
    live = len(lines)
    for at in range(int(sorted_sizes[0])):
        live = int(np.searchsorted(-sorted_sizes[:live], -at, side="left"))
        k = kind[begin[:live] + at]
        best[:live] = np.min(best[:live, :, None] + _COST[k], axis=1)
    out = np.empty(len(lines), np.int64)
    out[order] = np.min(best + _AT_END, axis=1)
    return out


def split_fields(line: str) -> list[str]:
    """Fields of a well-formed line; doubled quotes become one."""
    out, at, n = [], 0, len(line)
    while True:
        if at < n and line[at] == '"':
            parts, at = [], at + 1
            while True:
                end = line.index('"', at)
                parts.append(line[at:end])
                at = end + 1
                if at < n and line[at] == '"':
                    parts.append('"')
                    at += 1
                else:
                    break
            out.append("".join(parts))
        else:
            end = line.find(",", at)
            end = n if end < 0 else end
            out.append(line[at:end])
            at = end
        if at >= n:
            return out
        at += 1


def parse_delimited(df: DataFrame, id_col: str, text_col: str, labels: DataFrame) -> DataFrame:
    """``id, input_path, golden_path, label, object_name, score, quote_edits, delimiter_edits, fail_reason`` of inference lines.

    Null and blank lines give no row. A final carriage return is no fault. ``labels`` has one column ``label``, small and fixed."""
    fields = [f"f{i}" for i in range(COLUMNS)]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines = [t[:-1] if t.endswith("\r") else t for t in b.column(1).to_pylist()]
            quoted = [i for i, t in enumerate(lines) if '"' in t]
            edits = np.zeros(len(lines), np.int64)
            edits[quoted] = quote_edits([lines[i] for i in quoted])
            rows = [None if e else split_fields(t) if '"' in t else t.split(",") for t, e in zip(lines, edits)]
            off = [None if r is None else len(r) - COLUMNS for r in rows]
            good = [r if r is not None and len(r) == COLUMNS else [None] * COLUMNS for r in rows]
            cols = list(zip(*good)) if good else [[]] * COLUMNS
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.string()) for c in cols), pa.array(edits), pa.array(off, pa.int64())], names=["id", *fields, "quote_edits", "delimiter_edits"])

    lines = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).where(strip_blank(F.col("t")) != "")
    parsed = lines.mapInArrow(emit, "id long, " + ", ".join(f"{f} string" for f in fields) + ", quote_edits long, delimiter_edits long")
    names = [r[0] for r in labels.where("label is not null").select(F.lower(strip_blank(F.col("label")))).distinct().collect()]
    known = F.lower(strip_blank(F.col("f2"))).isin(names) if names else F.lit(False)
    text = strip_blank(F.col("f4"))
    number = F.when(text.rlike(DECIMAL), text.try_cast("double"))
    score = F.when(number < F.lit(float("inf")), number)
    reason = (
        F.when(F.col("quote_edits") > 0, "broken_quoting")
        .when(F.col("delimiter_edits") != 0, "column_count")
        .when(~known, "invalid_label")
        .when(score.isNull(), "invalid_score")
    )
    return parsed.select("id", F.col("f0").alias("input_path"), F.col("f1").alias("golden_path"), strip_blank(F.col("f2")).alias("label"), F.col("f3").alias("object_name"), score.alias("score"), "quote_edits", F.abs("delimiter_edits").alias("delimiter_edits"), reason.alias("fail_reason"))


_EVENT = (("seq", "double"), ("ts", "string"), ("iter", "string"), ("stage", "string"), ("status", "string"), ("summary", "string"), ("duration_sec", "double"), ("context_tokens", "double"))


def parse_events(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, the fields of the run log, and ``fail_reason`` of log lines.

    Null and blank lines give no row; outer blanks are no fault. A field of another type than the log's is null."""
    kinds = {"double": (pa.float64(), float), "string": (pa.string(), str)}

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(1).to_pylist():
                try:
                    v = strict_json(t.strip())
                except ValueError:
                    v = None
                if not isinstance(v, dict):
                    rows.append((*[None] * len(_EVENT), "bad_json"))
                    continue
                got = [x if isinstance(x := v.get(name), kinds[kind][1]) else None for name, kind in _EVENT]
                rows.append((*got, None if v.get("status") in ("ok", "error") else "invalid_status"))
            cols = list(zip(*rows)) if rows else [[]] * (len(_EVENT) + 1)
            arrays = [pa.array([_utf8(x) for x in c] if kind == "string" else c, kinds[kind][0]) for c, (_, kind) in zip(cols, _EVENT)]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays, pa.array(cols[-1], pa.string())], names=["id", *(n for n, _ in _EVENT), "fail_reason"])

    lines = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).where(strip_blank(F.col("t")) != "")
    events = lines.mapInArrow(emit, "id long, " + ", ".join(f"{n} {k}" for n, k in _EVENT) + ", fail_reason string")
    return events.select("id", F.col("seq").try_cast("int").alias("seq"), F.col("ts").try_cast("timestamp").alias("ts"), "iter", "stage", "status", "summary", F.col("duration_sec").try_cast("int").alias("duration_sec"), F.col("context_tokens").try_cast("int").alias("context_tokens"), "fail_reason")


def _utf8(x: str | None) -> str | None:
    """JSON may escape lone surrogates, which no UTF-8 text can hold."""
    return x if x is None or x.isascii() else x.encode("utf-8", "replace").decode()


def split_lines(df: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Inference rows and log events of ``raw_lines``, each with its ``fail_reason`` (null: the row is valid)."""
    return parse_delimited(df.where("line_kind = 'inference_csv'"), "line_id", "raw_line", labels), parse_events(df.where("line_kind = 'loop_log'"), "line_id", "raw_line")


def failed_lines(df: DataFrame, labels: DataFrame) -> DataFrame:
    """``line_id, fail_reason`` of every line that can't be read."""
    rows, events = split_lines(df, labels)
    return rows.select("id", "fail_reason").union(events.select("id", "fail_reason")).where("fail_reason is not null").withColumnRenamed("id", "line_id")
