"""Report roll-up, name cleaning lookups and recodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.exprs import clean_name, parse_int_text
from .ranks import exact_quantile


def normalise_taxa(
    c,
    suffixes=K.TAXA_SUFFIXES,
    merge: dict | None = None,
):
    """Strip qualifier suffixes and merge synonymous taxa."""
    merge = K.TAXA_MERGE if merge is None else merge
    t = F.col(c) if isinstance(c, str) else c
    for s in suffixes:
        t = F.replace(t, F.lit(s), F.lit(""))
    out = None
    for k, v in merge.items():
        out = F.when(t == k, F.lit(v)) if out is None else out.when(t == k, F.lit(v))
    return t if out is None else out.otherwise(t)


def rollup_reports(
    reports: DataFrame,
    key=K.NOWCAST_KEY,
    taxa_list=K.TAXA_LIST,
    taxa_drop=K.TAXA_DROP,
    taxa_merge: dict | None = None,
    taxa_suffixes=K.TAXA_SUFFIXES,
    separator: str = K.CONTROL_SEPARATOR,
) -> DataFrame:
    """One row per cell: summed cases, resolved status, union of control measures.

    * cases: text parsed to int (decimals truncated, junk -> null); the sum
      is null only when every row of the cell is null.
    * status: present > absent > unreported; other values -> null.
    * control measures: sorted distinct union of the non-null "; " lists
      ("na" counts as null), "none" when empty.

    Rows are first counted by cell and raw "; " list in a plain hash aggregate
    (collecting lists from the rows would sort them all), then the few rows of a
    cell are merged.  Control measures travel as the set of distinct raw lists
    (bounded by the distinct list strings, not by row volume), and are split,
    de-duplicated and sorted after the aggregation.
    """
    taxa = normalise_taxa("taxa", taxa_suffixes, taxa_merge)
    df = (
        reports.withColumns(
            {
                "country_iso3c": F.upper("country_iso3c"),
                "taxa": taxa,
                "control_measures": F.nullif(F.col("control_measures"), F.lit("na")),
            }
        )
        .where(F.col("taxa").isin(list(taxa_list)) & ~F.col("taxa").isin(list(taxa_drop)))
        .where(F.col("country_iso3c").isNotNull())
    )
    st = F.col("disease_status")
    lists = df.groupBy(*key, "control_measures").agg(
        F.sum(parse_int_text("cases")).alias("cases"),
        F.bool_or(st == K.STATUS_PRESENT).alias("_p"),
        F.bool_or(st == K.STATUS_ABSENT).alias("_a"),
        F.bool_or(st == K.STATUS_UNREPORTED).alias("_u"),
    )
    agg = lists.groupBy(*key).agg(
        F.sum("cases").alias("cases"),
        F.bool_or("_p").alias("_p"),
        F.bool_or("_a").alias("_a"),
        F.bool_or("_u").alias("_u"),
        F.collect_set("control_measures").alias("_lists"),
    )
    measures = F.array_sort(F.array_distinct(F.filter(
        F.flatten(F.transform("_lists", lambda x: F.split(x, separator))), lambda m: m != "")))
    return agg.select(
        *key,
        F.col("cases").cast("long").alias("cases"),
        F.when(F.col("_p"), K.STATUS_PRESENT)
        .when(F.col("_a"), K.STATUS_ABSENT)
        .when(F.col("_u"), K.STATUS_UNREPORTED)
        .alias("disease_status"),
        F.when(F.size(measures) == 0, F.lit("none"))
        .otherwise(F.array_join(measures, separator))
        .alias("control_measures"),
    )


def duplicate_keys(df: DataFrame, key) -> DataFrame:
    """Keys that occur more than once (the roll-up must leave none)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def clean_name_lookup(
    df: DataFrame,
    name_col: str = "disease",
    rare_quantile: float = 0.15,
    rare_label: str = K.RARE_DISEASE_LABEL,
) -> DataFrame:
    """Lookup raw name -> cleaned name (+ rare recode by row count).

    Clean names that collide get "_2", "_3", ... in order of decreasing
    frequency (then raw name).  A name is rare when its row count is at or
    below the ``rare_quantile`` (linear interpolation) of all name counts.
    """
    counts = df.groupBy(F.col(name_col).alias("disease")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("_clean").orderBy(F.desc("n"), F.asc("disease"))
    named = counts.withColumn("_clean", clean_name("disease")).withColumn(
        "_rn", F.row_number().over(w)
    )
    recode = F.when(F.col("_rn") == 1, F.col("_clean")).otherwise(
        F.concat_ws("_", F.col("_clean"), F.col("_rn").cast("string"))
    )
    thr = exact_quantile(counts, "n", rare_quantile).scalar()
    return (
        named.select(
            "disease",
            recode.alias("disease_recode"),
            F.when(F.col("n") <= thr, F.lit(rare_label))
            .otherwise(recode)
            .alias("disease_recode_rare"),
            F.col("n").cast("long").alias("n"),
        )
    )


def recode_names(df: DataFrame, lookup: DataFrame, name_col: str = "disease") -> DataFrame:
    """Replace raw names by cleaned ones, keeping the raw name.

    Unmatched names become null (report them with ``checks``).  The lookup is
    keyed by name; AQE broadcasts it when its runtime size is small.
    """
    lk = lookup.select(
        F.col("disease").alias("_raw"), F.col("disease_recode").alias("_clean")
    )
    out = df.join(lk, df[name_col] == lk["_raw"], "left").drop("_raw")
    return out.withColumnRenamed(name_col, "disease_name_uncleaned").withColumnRenamed(
        "_clean", name_col
    )


def lump_rare(df: DataFrame, col: str, min_count: int, other: str = "other") -> DataFrame:
    """Replace values seen fewer than ``min_count`` times by ``other``."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    return (
        df.join(counts, on=col, how="left")
        .withColumn(col, F.when(F.col("_n") < min_count, F.lit(other)).otherwise(F.col(col)))
        .drop("_n")
    )


def apply_rare_recode(df: DataFrame, lookup: DataFrame, name_col: str = "disease") -> DataFrame:
    """Map cleaned names to their rare-lumped form."""
    lk = lookup.select(
        F.col("disease_recode").alias("_k"), F.col("disease_recode_rare").alias("_rare")
    ).distinct()
    return (
        df.join(lk, df[name_col] == lk["_k"], "left")
        .drop("_k", name_col)
        .withColumnRenamed("_rare", name_col)
    )
