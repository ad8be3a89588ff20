"""Two-level summaries of groups of any size, and of all sentences."""

from starlens.checks import queries
from starlens.operators import chunks


def test_long_groups_are_unified_by_the_model_in_levels(spark):
    partials = spark.createDataFrame([("big", i, f"p{i:03d}") for i in range(40)] + [("two", 0, "a"), ("two", 1, "b"), ("one", 0, "c"), ("bad", 0, "x!"), ("bad", 1, "y")], "category string, chunk_no long, partial string")

    def model_factory():
        def model(text):
            if "!" in text or len(text) > 60:
                raise ValueError("not accepted")
            return "+".join(part for part in text.split(" "))[:4] + str(text.count(" ") + 1)
        return model

    out = {x["category"]: x["unified"] for x in chunks.unified_by_model(partials, model_factory, ["category"], limit=50).collect()}
    assert out == {"big": "p0004", "two": "a+b2", "one": "c", "bad": None}  # runs of 10, then the four results


def test_extractive_query_reads_behind_the_prefix(spark, tables):
    rows = queries.queries()["two_level_extractive"](spark, tables).collect()
    other = queries.queries()["two_level_summary"](spark, tables).collect()
    key = lambda x: (x["category"], x["rating"])
    assert {key(x) for x in rows} == {key(x) for x in other}
    assert max(len(x["summary"] or "") for x in rows) > chunks.PARTIAL_CHARS
