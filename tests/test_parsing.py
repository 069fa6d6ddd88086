import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gaugeworks.operators import parsing


def formed(line):
    """A plain reading of the grammar."""
    at, n = 0, len(line)
    while True:
        if at < n and line[at] == '"':
            at += 1
            while True:
                if at >= n:
                    return False
                if line[at] == '"':
                    if at + 1 < n and line[at + 1] == '"':
                        at += 2
                        continue
                    at += 1
                    break
                at += 1
        else:
            while at < n and line[at] != ",":
                if line[at] == '"':
                    return False
                at += 1
        if at >= n:
            return True
        if line[at] != ",":
            return False
        at += 1


def least_edits(line, most=3):
    """Quotes inserted or deleted, breadth first."""
    seen, level = {line}, {line}
    for k in range(most + 1):
        if any(map(formed, level)):
            return k
        level = {s[:i] + '"' + s[i:] for s in level for i in range(len(s) + 1)} | {s[:i] + s[i + 1 :] for s in level for i, c in enumerate(s) if c == '"'}
        level -= seen
        seen |= level
    return most + 1


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text('ab,"', max_size=9), max_size=5))
def test_programme_finds_the_cheapest_repair(lines):
    assert list(parsing.quote_edits(lines)) == [least_edits(x) for x in lines] or any(least_edits(x) > 3 for x in lines)


@given(st.text('a,"\n é', max_size=30))
def test_cost_zero_is_well_formed(line):
    assert (parsing.quote_edits([line])[0] == 0) == formed(line)


@given(st.lists(st.text('a," \n', max_size=6), min_size=1, max_size=6))
def test_fields_come_back(fields):
    line = ",".join('"' + f.replace('"', '""') + '"' if any(c in f for c in ',"\n') or i % 2 else f for i, f in enumerate(fields))
    assert formed(line) and parsing.split_fields(line) == fields


LINES = {
    'p,g,PASS,o,0.5': None, '"p,1",g,"pass",o,"5e-1"': None, '"a""b",g, Bridge ,o, .5 ': None, 'p,g,PASS,o,1\r': None, '"x\ny",g,PASS,o,+3': None,
    'p,g,PASS,o,0.5"': "broken_quoting", '"p,g,PASS,o,1': "broken_quoting", 'p "q",g,PASS,o,1': "broken_quoting", ' "p",g,PASS,o,1': "broken_quoting", '"p"x,g,PASS,o,1': "broken_quoting",
    'p,g,PASS,o': "column_count", 'p,g,PASS,o,1,': "column_count", 'p;g;PASS;o;1': "column_count", 'p,g,PASS,o,1,\r': "column_count",
    'p,g,none,o,1': "invalid_label", 'p,g,,o,x': "invalid_label", 'p,g,PASS,o,': "invalid_score", 'p,g,PASS,o,-1': "invalid_score", 'p,g,PASS,o,nan': "invalid_score",
    'p,g,PASS,o,1e999': "invalid_score", 'p,g,PASS,o,0x1p-2': "invalid_score", 'p,g,PASS,o,١': "invalid_score", 'p,g,PASS,o,"0,1"': "invalid_score", 'p,g,PASS,o,1_0': "invalid_score", 'p,g,PASS,o,1 2': "invalid_score",
}
EVENTS = {
    '{"status": "ok", "seq": 3}': None, ' {"status":"error"} \r': None, '{"status":"bad","status":"ok"}': None, '{"status": "ok", "x": {"status": 1}}': None,
    '{"status": "OK"}': "invalid_status", '{"x": {"status": "ok"}}': "invalid_status", '{"status": null}': "invalid_status", '{"status": true}': "invalid_status", "{}": "invalid_status",
    '[{"status": "ok"}]': "bad_json", '"ok"': "bad_json", "{'status': 'ok'}": "bad_json", '{"status": "ok",}': "bad_json", '{"status": "ok"} {}': "bad_json", '{"status": "ok", "x": NaN}': "bad_json", "ERROR": "bad_json", '{"status': "bad_json", '{"status": "ok", "x": "\t"}': "bad_json", "[" * 100_000: "bad_json",
}


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([("PASS",), ("bridge",), (None,)], "label string")


def test_reasons(spark, labels):
    cases = [("inference_csv", x, y) for x, y in LINES.items()] + [("loop_log", x, y) for x, y in EVENTS.items()] + [(k, b, None) for k, b in itertools.product(("inference_csv", "loop_log"), (None, "", " \t\r\n"))]
    rows = [(i, k, x, "clash", 1) for i, (k, x, _) in enumerate(cases)] * 2
    df = spark.createDataFrame(rows, "line_id long, line_kind string, raw_line string, id string, label int")
    got = sorted(map(tuple, parsing.failed_lines(df, labels).collect()))
    assert got == sorted([(i, y) for i, (_, _, y) in enumerate(cases) if y] * 2)


def test_values_load(spark, labels):
    df = spark.createDataFrame([(1, "inference_csv", '"a,""b""",g," pass ",o,+.5e1'), (2, "loop_log", '{"seq": 4, "ts": "2025-03-01T00:00:01.5Z", "status": "ok", "summary": "\\ud800 é", "duration_sec": "x"}'), (None, None, None)], "line_id long, line_kind string, raw_line string")
    rows, events = parsing.split_lines(df, labels)
    r, e = rows.first(), events.first()
    assert (r["input_path"], r["label"], r["score"]) == ('a,"b"', "pass", 5.0)
    assert (e["seq"], e["ts"].isoformat(), e["status"], e["summary"], e["duration_sec"]) == (4, "2025-03-01T00:00:01.500000", "ok", "? é", None)


def test_long_line_and_empty_table(spark, labels):
    line = '"' + 'x,""' * 20_000 + '",g,PASS,o,1'
    df = spark.createDataFrame([(1, "inference_csv", line)], "line_id long, line_kind string, raw_line string")
    assert parsing.failed_lines(df, labels).count() == 0
    assert parsing.failed_lines(df.limit(0), labels).count() == 0
    assert parsing.failed_lines(df, labels.limit(0)).first()["fail_reason"] == "invalid_label"
