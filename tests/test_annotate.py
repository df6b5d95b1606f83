"""Batch annotation on small inputs: outcomes, resume, repeated keys, states and metrics."""

import json

import pytest

from labelsmith import config as C
from labelsmith.operators import lookup, parse, report, states
from labelsmith.operators.parse import success_records
from labelsmith.sources import lines as L

KEYS = [f"{c * 14}-{c * 10}-{c}" for c in "ABCDEFGH"]
ANSWER = json.dumps({"superclass": {"name": "Made of parts"}})
RESPONSES = "inchikey STRING, status INT, content_type STRING, body STRING, fetched_at STRING"


def _annotated(spark, lines, answers, schema=RESPONSES):
    rows = spark.createDataFrame([(100 + i, x) for i, x in enumerate(lines)], "row_index BIGINT, line STRING")
    return rows, lookup.annotate(parse.parse_submissions(rows), spark.createDataFrame(answers, schema))


def test_every_outcome_once(spark):
    outcomes = [((200, None, ANSWER), C.SUCCESS), ((200, None, "{}"), C.MISS), ((404, None, ANSWER), C.MISS), ((503, None, ANSWER), C.FAILED),
                ((429, None, ""), C.FAILED), ((200, "text/html", ANSWER), C.FAILED), ((200, None, ANSWER + "]"), C.FAILED)]
    lines = [f"{i}\tx\t{k}" for i, k in enumerate(KEYS)] + ["not a row", "1\tx\tnot-a-key"]
    answers = [(k, *a, f"2024-05-0{i + 1}") for i, (k, (a, _)) in enumerate(zip(KEYS, outcomes))]
    _, ann = _annotated(spark, lines, answers)
    got = [r.state for r in ann.orderBy("row_index").collect()]
    assert got == [s for _, s in outcomes] + [C.PENDING, C.INVALID, C.INVALID]
    recs = success_records(ann).collect()
    assert [(r.row_index, r.cid, r.inchikey, r.fetched_at, r[C.ANSWER_FIELD]) for r in recs] == [(100, 0, KEYS[0], "2024-05-01", ANSWER)]
    point = states.resume_point(ann).first()
    assert (point.resume_point, point.first_gap) == (110, 107)


def test_newest_answer_counts_and_a_null_status_is_an_answer(spark):
    answers = [(KEYS[0], 500, None, "", "2024-01-01"), (KEYS[0], 200, None, ANSWER, "2024-01-03"), (KEYS[0], 404, None, "", "2024-01-02"),
               (KEYS[1], None, None, "{}", "2024-01-01")]
    _, ann = _annotated(spark, [f"1\ta\t{KEYS[0]}", f"2\tb\t{KEYS[1]}"], answers)
    assert [r.state for r in ann.orderBy("row_index").collect()] == [C.SUCCESS, C.MISS]


def test_resume_leaves_finished_rows_alone(spark):
    rows, ann = _annotated(spark, [f"{i}\tx\t{KEYS[i % 2]}" for i in range(6)], [(KEYS[0], 200, None, ANSWER, None)])
    done = ann.where("state = 'success' and row_index < 103").select("row_index", "state", "reason")
    todo = lookup.unprocessed_rows(rows, done)
    assert sorted(r.row_index for r in todo.collect()) == [101, 103, 104, 105]
    assert states.append_conflicts(done, ann.where("state = 'success'")).count() == 2


def test_no_rows_and_no_answers(spark):
    _, ann = _annotated(spark, [], [])
    assert tuple(states.resume_point(ann).first()) == (0, 0) and success_records(ann).count() == 0
    _, ann = _annotated(spark, [f"1\ta\t{KEYS[0]}"], [], RESPONSES.rsplit(",", 1)[0])
    assert [(r.state, r.status) for r in ann.collect()] == [(C.PENDING, None)]


def test_one_answer_serves_all_its_rows_and_no_invalid_one(spark):
    lines = [f"{i}\tx\t{KEYS[2]}" for i in range(4)] + [f"z\tx\t{KEYS[2]}"]
    _, ann = _annotated(spark, lines, [(KEYS[2], 200, None, ANSWER, None)] * 3 + [("broken", 200, None, ANSWER, None)])
    assert [(r.state, r.status) for r in ann.orderBy("row_index").collect()] == [(C.SUCCESS, 200)] * 4 + [(C.INVALID, None)]


BIG = {"many strings": '{"class":{"name":"n"},"x":[' + ",".join(['"' + "s" * (1 << 20) + '"'] * 140) + "]}",
       "long string": '{"x":"' + "s" * (20 << 20) + '","class":{"name":"n"}}',
       "deep": '{"x":' + "[" * 2000 + "]" * 2000 + ',"class":{"name":"n"}}',
       "deep in a node": '{"class":{"name":"n","x":' + "[" * 2000 + "]" * 2000 + "}}",
       "repeated other key": '{"class":{"name":"n"},"x":1,"x":2}'}


@pytest.mark.parametrize("what", sorted(BIG))
def test_no_answer_is_too_large_or_too_deep(spark, what):
    from labelsmith.operators import taxonomy
    _, ann = _annotated(spark, [f"1\ta\t{KEYS[0]}"], [(KEYS[0], 200, None, BIG[what], None)])
    assert ann.select("state", "reason").first() == (C.SUCCESS, None)
    assert [r.name for r in taxonomy.taxonomy_long(parse.success_nodes(ann)).collect()] == ["n"]


@pytest.mark.parametrize("body", ['{"class":{"name":"n"}}x', '{"class":{"name":"n"}', '{"class":{"name":"a"},"class":{"name":"b"}}', "[1]", '{"a":01}',
                                  '{"class":{"name":"n"}}]', '{"class":{"name":"n"}},{}', '{"class":{"name":"n"}},{}]', '{"class":{"name":"n"}}],[{}', "{'a':1}", '{"x":' + "[" * 2000 + "]" * 1999 + "}", '{"a":NaN}', '{"a":1,}'])
def test_bad_json_is_failed(spark, body):
    _, ann = _annotated(spark, [f"1\ta\t{KEYS[0]}"], [(KEYS[0], 200, None, body, None)])
    assert ann.select("state", "reason").first() == (C.FAILED, C.MSG_BAD_JSON)


def test_unlimited_check_agrees_with_the_json_module():
    import random

    from labelsmith.functions.jsoncheck import object_entries
    rnd = random.Random(8)
    text = json.dumps({"kingdom": {"name": "a\\\"b", "x": [1, -2.5e3, None, True]}, "class": None, "y": {"class": {}}, "subclass": "\u00e9"})
    for _ in range(3000):
        i = rnd.randrange(len(text))
        body = text[:i] + rnd.choice(['"', "{", "}", "[", "]", ",", ":", " ", "1", "null", "\\", ""]) + text[i + rnd.randrange(2):]
        try:
            pairs = json.loads(body, object_pairs_hook=lambda p: p, parse_constant=lambda c: 1 / 0, strict=True)
            want = isinstance(pairs, list) and body.lstrip(" \t\n\r").startswith("{")
        except (ValueError, ZeroDivisionError):
            want = False
        assert (object_entries(body) is not None) == want, body
    assert object_entries(text) == [("kingdom", json.dumps({"name": "a\\\"b", "x": [1, -2.5e3, None, True]})), ("class", None), ("subclass", "\u00e9")]


def test_rows_with_two_states_are_found(spark):
    log = spark.createDataFrame([(4, "miss"), (4, "miss"), (5, "failed"), (5, "success"), (6, "invalid")], "row_index BIGINT, state STRING")
    assert [tuple(r) for r in states.state_conflicts(log).collect()] == [(5, 2)]
    new = spark.createDataFrame([(5, "miss"), (9, "miss")], "row_index BIGINT, state STRING")
    assert [tuple(r) for r in states.append_conflicts(log.where("state = 'failed'"), new).collect()] == [(5, "failed", "miss")]


def test_light_plans_move_no_body(spark):
    _, ann = _annotated(spark, [f"1\ta\t{KEYS[0]}"], [(KEYS[0], 200, None, ANSWER, None)])
    for df in (states.state_counts(ann), ann.select("row_index", "state")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        joined = plan[plan.index("Join"):]
        assert "max_by(body" not in joined and "max_by(content_type" not in joined


def test_metrics_and_panels(spark):
    counts = spark.createDataFrame([(10, 4, 2, 1, 1)], "total_rows BIGINT, success_rows BIGINT, "
                                   "miss_rows BIGINT, invalid_rows BIGINT, failed_rows BIGINT")
    m = report.progress_metrics(counts).first()
    assert (m.handled_rows, m.executed_rows, m.completed_rows, m.pending_rows) == (8, 7, 7, 2)
    r = report.progress_ratios(report.progress_metrics(counts)).first()
    assert r.coverage == 0.4 and r.request_success == 4 / 7
    cov = report.coverage_panel(report.progress_metrics(counts)).orderBy("slice_no").collect()
    assert [x.label for x in cov] == ["Collected: 4", "Pending: 2", "Miss: 2", "Failed: 1", "Invalid: 1"]
    assert cov[0].center_value == "40.00%"
    req = report.request_panel(report.progress_metrics(counts)).orderBy("slice_no").collect()
    assert req[0].center_value == "57.14%" and req[0].note.endswith(": 1")
    zero = spark.createDataFrame([(0, 0, 0, 0, 0)], counts.schema)
    z = report.progress_ratios(report.progress_metrics(zero)).first()
    assert z.coverage == 0.0 and z.request_success == 0.0


def test_append_states_rejects_conflicts_and_appends(spark, tmpdir_path):
    import os
    path = os.path.join(tmpdir_path, "states")
    schema = "row_index BIGINT, state STRING, reason STRING"
    row = lambda *r: spark.createDataFrame([(*r, None)], schema)
    for buckets, path in ((None, path), (2, path + "-bucketed")):
        read = lambda: sorted((r.row_index, r.state) for r in spark.read.parquet(path).collect())  # noqa: B023, E731
        states.append_states(row(0, "success"), path, 1, buckets)
        with pytest.raises(ValueError):
            states.append_states(row(0, "miss"), path, 2, buckets)
        for _ in range(2):  # a batch again, as after a lost driver
            states.append_states(row(1, "failed"), path, 2, buckets)
        with pytest.raises(ValueError):
            states.append_states(row(7, "success").union(row(7, "miss")), path, 3, buckets)
        assert read() == [(0, "success"), (1, "failed")]
        states.append_states(row(2, "miss"), path, 2, buckets)  # and what it holds now replaces what it held
        assert read() == [(0, "success"), (2, "miss")]
    name = spark.table(L.table_name(path))
    plan = lookup.unprocessed_rows(name.select("row_index"), name)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
