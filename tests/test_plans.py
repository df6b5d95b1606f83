"""Plan shape checks: no pairwise joins anywhere, pruned scans, partial top-k, one pass."""

import pytest

from labelsmith.plans.registry import QUERIES

from conftest import SF_SMALL

# round trips and streams execute writes inside the query function; their final plan is a
# plain scan of what they wrote
PLAN_KEYS = sorted(QUERIES)


def _plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAN_KEYS)
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_flagship_prunes_columns_and_runs_once(spark):
    plan = _plan(spark, "taxonomy_topk")
    # orders is read twice (submissions and answers), each with only the columns it needs
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "o_totalprice" not in plan and "o_comment" not in plan
    assert plan.count("FileScan parquet") == 8


@pytest.mark.parametrize("name,parses", [("taxonomy_topk", 1), ("success_records", 1), ("state_counts", 1), ("lookup_join", 0),
                                         ("shard_assignment", 0), ("progress_summary", 0)])  # the last two read what they landed
def test_an_answer_is_parsed_once(spark, name, parses):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(ArrayType(MapType") == parses


def test_report_is_one_pass(spark):
    assert _plan(spark, "taxonomy_report").count("FileScan parquet") == 8


def test_recent_events_uses_partial_group_limit(spark):
    df = QUERIES["recent_events"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    df.write.format("noop").mode("overwrite").save()
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in opt or "WindowGroupLimit" in plan


@pytest.mark.parametrize("name", ["failure_reason", "has_classification"])
def test_a_filter_on_what_was_read_parses_no_answer_again(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(ArrayType(MapType") == 1


@pytest.mark.parametrize("name", ["release_gate", "summary_or_recompute", "release_manifest", "read_manifest_counts"])
def test_a_release_annotates_once(spark, name, monkeypatch):
    from labelsmith.plans import annotate as P
    done, annotated = [], P.annotated
    monkeypatch.setattr(P, "annotated", lambda *a: done.append(a) or annotated(*a))
    QUERIES[name](spark, SF_SMALL)
    assert len(done) == 1
