"""Mixing sources to target weights, with DataFrame functions only.

The size of a document is its number of words. Sources, in the order of their names with null last,
weigh ``weights`` in turn, and share ``share`` times all sizes by weight. A target stops at ``most``
times its source's size; what is over goes to the other sources by weight, until no target is above.
A document of a source with rate target / size is taken floor(rate) times, and once more if a hash of
the seed and its id falls below the rate's fraction. So a rerun takes the same.

Null is a source like any other; a null text has no words and a null id hashes like an empty one. Rows
that repeat an id are taken alike. A source without words has target 0 and none of its documents is
taken. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import running_totals, saved, whole_rows, whole_text

WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), 1.5, 2.0, "mix"
WORD = r"[^\x20\x09-\x0D]+"


def words(text):
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def chance(doc_id, seed: str, text):
    """Even in [0, 1): 52 bits of the hash of seed and id, or of the text where there is no id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.md5(text))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """(source, source_size, target) from (source, size)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_totals(per.select("source", "source_size", F.col("source").isNull().alias("_last"),
                                       F.lit(1).alias("_one")), ["_last", "source"], "_one", "_rank")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    table = saved(ranked.select("source", "source_size", (F.col("source_size") * F.lit(float(most))).alias("cap"),
                                turn[(F.col("_rank") % len(weights)).cast("int")].alias("weight")), "sources")
    total = float(table.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = 0.0, -1
    while True:  # one round per reshare; it ends as sources only ever become full
        at_cap = F.col("cap") <= F.lit(level) * F.col("weight")
        r = table.agg(F.sum(F.when(at_cap, 1).otherwise(0)).alias("n"),
                      F.sum(F.when(at_cap, F.col("cap")).otherwise(0.0)).alias("taken"),
                      F.sum(F.when(at_cap, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if not r["open"] or r["n"] == full:
            break
        level, full = (total - r["taken"]) / r["open"], r["n"]
    target = F.least(F.col("cap"), F.lit(level) * F.col("weight"))
    return table.select("source", "source_size", target.alias("target"))


def planned(docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST, seed=SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken."""
    sizes = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                              F.col("source").cast("string").alias("source"),
                              words(whole_text()).alias("size"),
                              chance(F.col("doc_id").cast("long"), seed, whole_text()).alias("chance")), "sizes")
    targets = saved(source_targets(sizes, weights, share, most), "targets").withColumnRenamed("source", "_of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    copies = F.floor("rate") + (F.col("chance") < F.col("rate") - F.floor("rate")).cast("int")
    return (sizes.join(targets, F.col("source").eqNullSafe(F.col("_of")))
            .withColumn("rate", rate).withColumn("copies", copies.cast("int"))
            .select("doc_id", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mixed(docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST, seed=SEED) -> DataFrame:
    """The mix: the rows of ``docs``, each as often as it is taken."""
    sizes = saved(docs.select(F.col("source").cast("string").alias("source"),
                              words(whole_text()).alias("size"))
                  .groupBy("source").agg(F.sum("size").alias("size")), "sizes")
    targets = (saved(source_targets(sizes, weights, share, most), "targets")
               .select(F.col("source").alias("mix_of"), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                       .otherwise(0.0).alias("mix_rate")))
    rows = docs.select(whole_rows(docs), F.col("source").cast("string").alias("own_source"),
                       chance(F.col("doc_id").cast("long"), seed, whole_text()).alias("own_chance"))
    extra = (F.col("own_chance") < F.col("mix_rate") - F.floor("mix_rate")).cast("int")
    return (rows.join(targets, F.col("own_source").eqNullSafe(F.col("mix_of")))
            .withColumn("mix_copy", F.explode(F.array_repeat(F.lit(1), (F.floor("mix_rate") + extra).cast("int"))))
            .select("own.*"))
