"""SimHash deduplication keeps one row of each component, whatever its ids are."""

from pageloom.llm import simhash


def test_null_and_repeated_ids(spark):
    a, b, c = (" ".join(f"{s}{k}" for k in range(400)) for s in "abc")
    rows = [(None, a), (None, a + "!"), (None, b), (5, b), (5, c), (5, c + "!"), (5, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.deduplicate(docs).collect()
    assert sorted((r.doc_id is None, r.text[:2]) for r in kept) == [(False, "b0"), (False, "c0"), (True, "a0")]
