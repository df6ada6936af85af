"""Cleaning rules on hand-made rows: labels, hold-out, duplicates, filters."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from annolytics.functions.labels import parse_label, score_to_class, text_preview
from annolytics.operators import clean as C

SCHEMA = "annotation_id long, student_code string, source_file string, text string, label_text string, label_numeric int, lead_time_seconds double"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_parse_label(spark):
    df = spark.createDataFrame([("4-x",), ("10-x",), ("x-4",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_label("t")).collect()]
    assert got == [4, 10, None, None, None]


def test_score_to_class_half_to_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (0.2,), (7.0,), (4.49,)], "s double")
    assert [r[0] for r in df.select(score_to_class("s")).collect()] == [2, 4, 1, 5, 4]


def test_text_preview(spark):
    df = spark.createDataFrame([("a" * 100,), ("b" * 101,)], "t string")
    got = [r[0] for r in df.select(text_preview("t")).collect()]
    assert got == ["a" * 100, "b" * 100 + "..."]


def test_holdout_null_source_is_not_test(spark):
    df = rows(spark, [
        (1, "A", None, "t1", "1-x", 1, 5.0),
        (2, "A", "xOTPy", "t2", "1-x", 1, 5.0),
        (3, "B", "otp", "t3", "1-x", 1, 5.0),
        (4, "K", None, "t4", "1-x", 1, 5.0),
    ])
    working, test = C.holdout_split(df, [("K", None), ("A", "otp")])
    assert sorted(r.annotation_id for r in test.collect()) == [2, 4]
    assert sorted(r.annotation_id for r in working.collect()) == [1, 3]


DUPS = [
    # two equal labels -> first (smallest id) even though id 2 is slower
    (1, "A", "s", "same", "3-x", 3, 5.0), (2, "B", "s", "same", "3-x", 3, 50.0),
    # two different labels -> larger lead time
    (3, "A", "s", "diff", "3-x", 3, 5.0), (4, "B", "s", "diff", "4-x", 4, 50.0),
    # three equal labels -> larger lead time anyway
    (5, "A", "s", "three", "2-x", 2, 1.0), (6, "B", "s", "three", "2-x", 2, 9.0), (7, "C", "s", "three", "2-x", 2, 3.0),
    # tie on lead time -> first
    (8, "A", "s", "tie", "1-x", 1, 7.0), (9, "B", "s", "tie", "5-x", 5, 7.0),
    # null lead loses to any lead
    (10, "A", "s", "nulllead", "1-x", 1, None), (11, "B", "s", "nulllead", "2-x", 2, 0.5),
    # null-label pair counts as disagreeing -> larger lead
    (12, "A", "s", "nulllabel", "n/a", None, 1.0), (13, "B", "s", "nulllabel", "n/a", None, 2.0),
    # all null leads -> first
    (14, "A", "s", "allnull", "1-x", 1, None), (15, "B", "s", "allnull", "2-x", 2, None),
    # singleton and a null text (dropped)
    (16, "A", "s", "single", "1-x", 1, 1.0), (17, "A", "s", None, "1-x", 1, 1.0),
]


def test_resolve_duplicates_rules(spark):
    got = {r.text: r.annotation_id for r in C.resolve_duplicates(rows(spark, DUPS)).collect()}
    assert got == {"same": 1, "diff": 4, "three": 6, "tie": 8, "nulllead": 11, "nulllabel": 13, "allnull": 14, "single": 16}


def test_resolve_duplicates_idempotent_and_order_free(spark):
    df = rows(spark, DUPS)
    once = C.resolve_duplicates(df)
    twice = C.resolve_duplicates(once)
    shuffled = C.resolve_duplicates(df.repartition(7).orderBy(F.rand(3)))
    a = sorted(r.annotation_id for r in once.collect())
    assert a == sorted(r.annotation_id for r in twice.collect())
    assert a == sorted(r.annotation_id for r in shuffled.collect())
    # exactly one row per non-null text
    assert once.count() == once.select("text").distinct().count() == 8


def test_rushed_annotators_null_mean_kept(spark):
    df = rows(spark, [
        (1, "fast", "s", "a" * 60, "1-x", 1, 2.0), (2, "fast", "s", "b" * 60, "1-x", 1, 4.0),
        (3, "slow", "s", "c" * 60, "1-x", 1, 20.0), (4, "none", "s", "d" * 60, "1-x", 1, None),
    ])
    kept = C.remove_rushed_annotators(df)
    assert sorted(r.student_code for r in kept.collect()) == ["none", "slow"]
    gone = C.removed_annotators(df).collect()
    assert [(r.student_code, r.mean_lead_time, r.n_rows) for r in gone] == [("fast", 3.0, 2)]


def test_short_filter_is_inclusive(spark):
    df = rows(spark, [(1, "A", "s", "x" * 49, "1", 1, 1.0), (2, "A", "s", "x" * 50, "1", 1, 1.0)])
    assert [r.annotation_id for r in C.filter_short_texts(df, 50).collect()] == [2]


def test_funnel_adds_up(spark, sf_dir):
    from annolytics.plans.registry import DRIVER_RULES
    from annolytics.sources.views import annotations_v

    c = C.clean(annotations_v(spark, sf_dir), rules=DRIVER_RULES)
    f = {r.step: r for r in C.cleaning_funnel(c).collect()}
    assert f["holdout"].records_before == f["final_total"].records_before
    removed = sum(f[s].removed for s in ("holdout", "duplicates", "short_texts", "rushed_annotators"))
    assert f["holdout"].records_before - removed == f["final_train"].records_after
    assert f["final_train"].records_after + f["final_test"].records_after == f["final_total"].records_after


def test_duplicate_resolution_keys_are_numbers(spark):
    """No sort aggregate, and no text in the aggregations' exchanges."""
    import re

    plan = C.resolve_duplicates(rows(spark, DUPS))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    aggregated = [e for e in re.findall(r"hashpartitioning\(([^)]*)\)", plan)]
    assert aggregated and not any("text" in e for e in aggregated)


def test_duplicate_rows_with_one_text_and_key(spark):
    twice = [(1, "A", "s", "t", "1-x", 1, 2.0), (1, "A", "s", "t", "2-x", 2, 2.0), (1, "A", "s", "t", "2-x", 2, 2.0), (2, "B", "s", "t", "2-x", 2, 1.0)]
    got = C.resolve_duplicates(rows(spark, twice)).collect()
    assert [r.annotation_id for r in got] == [1]
    assert [tuple(r) for r in C.resolve_duplicates(rows(spark, twice[::-1])).collect()] == [tuple(r) for r in got]


def test_label_variation_by_digest(spark):
    got = {r.text: r for r in C.duplicate_label_variation(rows(spark, DUPS), k=None).collect()}
    pair = got["nulllabel"]
    assert (pair.n_rows, pair.n_labels, pair.mean_label, pair.std_label, pair.n_annotators) == (2, 0, None, None, 2)
    assert set(got) == {"same", "diff", "three", "tie", "nulllead", "nulllabel", "allnull"}
