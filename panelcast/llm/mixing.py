"""Mixing sources to target weights with hash-random order and distributed prefix sums.

Every document gets a hash-random key; the keys of a source are cut into fixed
equal ranges, which are small even for a source with a third of all rows.
Running sums inside a range plus the sums of the ranges before it give each
document's place in its source, and the source is cut exactly at its budget.
Only DataFrame operations; texts are read once, for their sizes, and never
shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_stage

WEIGHTS = (3, 1, 2)  # by source in code point order, null last, repeating
SHARE = 1.5  # of all sizes
MOST = 2  # times a source's size
RANGES = 1024  # key ranges of a source
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(
    sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """(source, source_size, target) from (source, source_size) rows, one per source.

    Sources rank in code point order, null last; weights repeat along the
    ranks.  Targets share ``share`` times the total by weight; one above
    ``most`` times its source's size stops there, and the rest is shared anew
    among the others until none is above.
    """
    # ranks over range-sorted partitions: the high bits of the id are the partition, the low ones the row
    ordered = write_stage(
        sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()), "mix-sources"
    )
    block = F.shiftright("at", 33)
    before = ordered.groupBy(block.alias("block")).agg(F.count("*").alias("n"))
    before = before.withColumn("before", F.sum("n").over(Window.orderBy("block")) - F.col("n")).drop("n")  # a row per partition
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = (
        ordered.withColumn("block", block)
        .join(before, "block")
        .withColumn("rank", F.col("before") + F.col("at") - F.shiftleft("block", 33))
        .select("source", "source_size", weight.cast("double").alias("weight"), (F.col("source_size") * most).alias("cap"))
    )
    ranked = write_stage(ranked, "mix-ranked")
    # each round is one aggregate to one row; capped sources never come back, so rounds end
    level, capped = 0.0, -1
    while True:
        over = F.col("cap") <= F.col("weight") * F.lit(level) if capped >= 0 else F.lit(False)
        row = ranked.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(over, F.col("cap"))).alias("used"),
            F.sum(F.when(~over, F.col("weight"))).alias("open"),
            F.count(F.when(over, 1)).alias("capped"),
        ).first()
        if row["capped"] == capped or not row["open"]:
            break
        capped = row["capped"]
        level = (share * row["total"] - (row["used"] or 0)) / row["open"]
    level = F.lit(level)
    return ranked.select(
        "source",
        "source_size",
        F.when(F.col("cap") <= F.col("weight") * level, F.col("cap").cast("double")).otherwise(F.col("weight") * level).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """(doc_id, size, source, source_size, target, taken) of every document.

    ``taken`` counts the words the mix takes of a document: its size times the
    whole epochs of its source, and in the last epoch what the budget leaves at
    its place, so that the document at the cut gives only its first words and
    a source's taken words are its target rounded down.  The order is the MD5
    of the id, then id and size; rows that repeat an id are taken one after the
    other.  A null text has size 0, a null source is a source of its own, a
    null id has a key of its own.  A source without words has target 0; an
    empty table gives no rows.  Other columns are not read.
    """
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).cast("binary"))
    sized = write_stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col)).alias("size"),
            key.alias("key"),
            F.floor(F.conv(F.substring(key, 1, 6), 16, 10).cast("long") * RANGES / (1 << 24)).cast("int").alias("span"),
        ),
        "mix-sized",
    )
    # sums per source and key range, combined before the shuffle; a source has RANGES rows at most
    spans = sized.groupBy("source", "span").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.select("source", "span", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("before"))
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    plan = write_stage(
        offsets.alias("o").join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source")))
        .select("o.source", "span", "before", "source_size", "target"),
        "mix-plan",
    )
    inside = Window.partitionBy("source", "span").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0).cast("long")))
    joined = placed.alias("d").join(
        plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.span") == F.col("p.span"))
    )
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    left = budget - epochs * F.col("source_size") - F.col("before") - F.col("inside")
    taken = epochs * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left))
    return joined.select("doc_id", "size", F.col("d.source").alias("source"), "source_size", "target", taken.alias("taken"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """The documents of the mix: all columns of ``docs``, and ``mix_taken``, the words taken of each (above 0).

    Rows that repeat an id within a source share the largest of their counts.
    A ``mix_taken`` column of the input is replaced.
    """
    docs = docs.drop("mix_taken")
    mix = mix_sources(docs, id_col=id_col, source_col=source_col, **options).filter("taken > 0")
    mix = mix.groupBy(F.col("doc_id").alias("__id"), F.col("source").alias("__source")).agg(F.max("taken").alias("mix_taken"))
    mix = write_stage(mix, "mix-taken").hint("merge")  # a row per document: never one to broadcast
    same = docs[id_col].eqNullSafe(mix["__id"]) & docs[source_col].cast("string").eqNullSafe(mix["__source"])
    return docs.join(mix, same).select(*[docs[c] for c in docs.columns], mix["mix_taken"])
