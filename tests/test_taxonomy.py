"""Taxonomy roll-up: nodes, keys, counts, ranks, tail, shares and the strict node rule."""

import json

import pytest

from labelsmith import config as C
from labelsmith.operators import report, taxonomy

SCHEMA = f"row_index BIGINT, {C.ANSWER_FIELD} STRING"


def _records(spark, bodies):
    return spark.createDataFrame([(10 * i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)], SCHEMA)


def _counts(spark, bodies):
    return taxonomy.taxonomy_counts(taxonomy.taxonomy_nodes(taxonomy.taxonomy_long(_records(spark, bodies))))


def _node(name, id_=None):
    return {"name": name} if id_ is None else {"name": name, "chemont_id": id_}


def test_layers_are_counted_apart(spark):
    # the same label in several layers, one layer that no record has, one record without any node
    bodies = [{"kingdom": _node("Alpha"), "superclass": _node("Alpha"), "subclass": _node("Alpha")},
              {"kingdom": _node("Beta"), "subclass": _node("alpha")},
              {"kingdom": _node("Alpha"), "subclass": None, "note": {"name": "Alpha"}},
              {"note": 1}]
    layers = [(r.layer, r.assigned_records, r.unique_class_count)
              for r in taxonomy.all_layers(spark, _counts(spark, bodies)).orderBy("layer_no").collect()]
    assert layers == [("kingdom", 3, 2), ("superclass", 1, 1), ("class", 0, 0), ("subclass", 2, 1), ("direct_parent", 0, 0)]


def test_first_record_names_a_class(spark):
    # grouped by id whatever the name, else by lower-cased name; blank names share one class
    bodies = [{"class": _node("\tmixed Case ")}, {"class": _node("MIXED cASE")}, {"class": _node("")}, {"class": _node(" ")},
              {"class": _node("later", "T:9")}, {"class": _node("other", "T:9")}, {"class": _node("later")}]
    got = {r.class_key: (r.name, r.chemont_id, r.label_count) for r in _counts(spark, bodies).collect()}
    assert got == {"mixed case": ("mixed Case", None, 2), C.UNNAMED_CLASS: (C.UNNAMED_CLASS, None, 2),
                   "T:9": ("later", "T:9", 2), "later": ("later", None, 1)}


def test_rank_ties_tail_and_report(spark):
    # 8 classes in a layer that shows 6: counts 7, 5, 5, 2, 2, 2, 1, 1
    sizes = {"delta": 7, "beta": 5, "alpha": 5, "zeta": 2, "eta": 2, "epsilon": 2, "iota": 1, "kappa": 1}
    bodies = [{"superclass": _node(n)} for n, k in sizes.items() for _ in range(k)]
    ranked = taxonomy.taxonomy_ranked(_counts(spark, bodies))
    top = [r.name for r in taxonomy.taxonomy_topk(spark, ranked).orderBy("rk").collect()]
    assert top == ["delta", "alpha", "beta", "epsilon", "eta", "zeta"]
    tail = taxonomy.taxonomy_tail(spark, ranked).first()
    assert (tail.tail_classes, tail.tail_labels, tail.has_tail) == (2, 2, True)
    rows = {r.line_no: r for r in report.taxonomy_report(spark, ranked).collect()}
    assert (rows[1].label, rows[1].percent, rows[1]["count"]) == ("delta", "28.00%", "7")
    assert (rows[None].label, rows[None].percent, rows[None]["count"]) == ("Tail: 2 classes", "8.00%", "2")


def test_shares_run_from_zero_to_one(spark):
    ranked = taxonomy.taxonomy_ranked(_counts(spark, [{"direct_parent": _node(n)} for n in "xyyzzzz"]))
    rows = taxonomy.cumulative_share(ranked).orderBy("rk").collect()
    assert [(r.name, r.start_share, r.end_share) for r in rows] == [("z", 0.0, 4 / 7), ("y", 4 / 7, 6 / 7), ("x", 6 / 7, 1.0)]
    assert sum(r.share for r in taxonomy.class_share(ranked).collect()) == pytest.approx(1)


BAD = [{"class": _node(7)}, {"class": {"chemont_id": "T:1"}}, {"class": []}, {"class": "text"}, {"class": {"name": None}}]


@pytest.mark.parametrize("body", BAD, ids=str)
def test_a_node_without_a_string_name_is_never_counted(spark, body):
    recs = _records(spark, [{"class": _node("good")}, body])
    assert [tuple(r) for r in taxonomy.bad_nodes(recs).collect()] == [(10, 2, "class")]
    with pytest.raises(ValueError, match="row 10, class"):
        taxonomy.check_nodes(recs)
    with pytest.raises(Exception, match="taxonomy node without a name: row 10, class"):
        taxonomy.taxonomy_long(recs).collect()
    assert [r.name for r in taxonomy.taxonomy_long(recs, strict=False).collect()] == ["good"]
    taxonomy.check_nodes(recs.where("row_index = 0"))


def test_counts_hash_before_they_sort(spark):
    from pyspark.sql import functions as F
    long = spark.range(100).select(F.col("id").alias("row_index"), F.lit(0).alias("layer_no"), F.lit("kingdom").alias("layer"),
                                   F.lit("n").alias("name"), F.lit(None).cast("string").alias("chemont_id"), F.lit("n").alias("class_key"))
    plan = taxonomy.taxonomy_counts(long)._jdf.queryExecution().executedPlan().toString()
    first = [line for line in plan.splitlines() if "partial_count" in line]
    assert first and all("HashAggregate" in line for line in first)
