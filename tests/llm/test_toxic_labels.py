"""Only texts that may be labelled are shuffled, at any size."""

from mailtriage.llm import toxicity as TX
from mailtriage.session import staged_table


def test_unlabelled_texts_are_dropped_before_the_shuffle(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(300)] + [(None, "no id"), (7, "again")], "doc_id long, text string")
    kept = staged_table(spark.createDataFrame([(7, 1), (8, 0), (999, 1)], "doc_id long, toxic int"), "kept")
    rows = TX._with_labels(docs, kept)
    assert sorted(tuple(r) for r in rows.select("doc_id", "text", "toxic").collect()) == [(7, "again", 1), (7, "text 7", 1), (8, "text 8", 0)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.index("SortMergeJoin") < plan.index("Exchange hashpartitioning") < plan.index("MapInArrow")
