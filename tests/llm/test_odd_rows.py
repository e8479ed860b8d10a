"""Pipeline stages over rows with clashing names, repeats, no ids; and an empty table."""

import os

import corpus_pipeline
import pytest
from pageloom.llm import mixing, token_files

P = pytest.importorskip("public_tokenizers")
ODD = [(1, None, "a"), (2, "", "a"), (3, " \n ", None), (4, "One text of some words here.", "a"), (5, "one text of some words here.", "b"),
       (None, "no id", "a"), (None, "no id", "a"), (None, "another", None), (6, "w " * 40_000, "b"), (6, "same id", "b"), (6, "same id", "b")]
NAMES = ("own", "own_text", "own_sha", "own_id", "keep_id", "keep_text", "keep_rows", "mix_of", "mix_rate", "own_chance", "score",
         "text_key", "fp", "component_id", "`a.b`", "size")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A table with odd rows and the names that operators use inside, and labels of one kind."""
    path = str(tmp_path_factory.mktemp("odd"))
    extra = ", ".join(f"{n} int" for n in NAMES)
    docs = spark.createDataFrame([(*r, "en", 1, *range(len(NAMES))) for r in ODD],
                                 f"doc_id long, text string, source string, lang string, n_chars long, {extra}")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(4, 1, 0), (6, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    os.makedirs(f"{path}/empty")
    docs.limit(0).write.parquet(f"{path}/empty/documents.parquet")
    spark.read.parquet(f"{path}/labels.parquet").write.parquet(f"{path}/empty/labels.parquet")
    return path


def test_stages_keep_the_columns_and_one_of_each(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, folder)
        assert left.columns == docs.columns, name
        rows = left.collect()
        assert all(tuple(r)[5:] == tuple(range(len(NAMES))) for r in rows), name
        if name in ("exact dedup", "near-dedup"):
            assert len(rows) == len({(r.text or "").lower() for r in rows}), name
    got = corpus_pipeline.run(spark, folder).collect()
    assert got and {r.doc_id for r in got} <= {1, 2, 3, 4, 5, 6, None}


def test_no_documents(spark, folder):
    assert corpus_pipeline.run(spark, f"{folder}/empty").count() == 0


def test_rows_without_an_id_draw_apart(spark):
    docs = spark.createDataFrame([(None, f"text {k} of a source", "a") for k in range(400)]
                                 + [(k, "words " * 40, "b") for k in range(400)], "doc_id long, text string, source string")
    rows = mixing.planned(docs).where("doc_id IS NULL").collect()
    taken, target = sum(r.taken for r in rows), rows[0].target
    assert abs(taken - target) < 0.1 * target
    again = sorted(r.taken for r in mixing.planned(docs.repartition(5)).where("doc_id IS NULL").collect())
    assert again == sorted(r.taken for r in rows)


def test_token_files_deal_out_rows_without_an_id(spark):
    docs = spark.createDataFrame([(None if k % 3 == 0 else 7 if k % 3 == 1 else k, f"text {k}") for k in range(6000)],
                                 "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = token_files.segments(docs, P.path("word_bpe_49k.json"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = token_files.documents_in(table).orderBy("start").collect()
    assert len(rows) == 6000 and table.count() >= 4
    ids = [r.doc_id for r in rows]
    assert ids[:2000] == [None] * 2000 and ids[2000:] == sorted(ids[2000:]) and ids.count(7) == 2000
    assert rows[0].start == 0
    for a, b in zip(rows, rows[1:], strict=False):
        assert b.start == a.start + a.n_tokens
