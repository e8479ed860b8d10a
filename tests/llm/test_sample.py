"""The labelled sample holds one document of each chosen id."""

from pageloom.llm.common import labelled_sample


def test_repeated_ids_do_not_exceed_the_bound(spark):
    docs = spark.createDataFrame([(k % 40, f"text {k}") for k in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int")
    rows = labelled_sample(docs, labels, "toxic", 10).collect()
    assert len(rows) == len({r.doc_id for r in rows}) == 10
    assert all(int(r.text.split()[1]) % 40 == r.doc_id and r.label == r.doc_id % 2 for r in rows)
    again = labelled_sample(docs.orderBy("text"), labels, "toxic", 10).collect()
    assert sorted(rows) == sorted(again)
