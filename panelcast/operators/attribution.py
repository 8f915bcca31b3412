"""Read-side attribution queries.

All of them are filters over the materialised prediction tables followed by
small joins (coefficients, scaling values, names) and aggregations whose
groups are bounded by the number of origins per destination.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import safe_div, strict_agg, title_from_snake


def _filter(df: DataFrame, countries=None, diseases=None, months=None) -> DataFrame:
    if countries is not None:
        df = df.where(F.col("country_iso3c").isin(list(countries)))
    if diseases is not None:
        df = df.where(F.col("disease").isin(list(diseases)))
    if months is not None:
        df = df.where(F.col("month").isin(list(months)))
    return df


def variable_importance(
    preds: DataFrame,
    coefficients: DataFrame,
    scaling: DataFrame,
    countries: DataFrame,
    variables: list[str],
    country_filter=None,
    diseases=None,
    months=None,
) -> DataFrame:
    """Y2: per row and model variable, x, standardised x, coef and importance.

    The continent enters as its one-hot variable ("continent<level>", x = 1);
    it has no scaling row, so its importance stays null.
    """
    p = _filter(preds, country_filter, diseases, months)
    ids = ["country_iso3c", "disease", "month", "outbreak_start", "endemic", "outbreak_ongoing",
           "predicted_outbreak_probability"]
    wide = p.select(
        *ids,
        *[F.col(v).cast("double").alias(v) for v in variables],
        F.concat(F.lit("continent"), F.col("continent")).alias("_cont_var"),
    )
    long = wide.unpivot(ids + ["_cont_var"], variables, "variable", "x")
    cont = wide.where(F.col("_cont_var").isNotNull()).select(
        *ids, F.col("_cont_var").alias("variable"), F.lit(1.0).alias("x"))
    long = long.drop("_cont_var").unionByName(cont)
    co = coefficients.select("disease", "variable", "coef", "variable_clean", "disease_clean")
    sc = scaling.select(F.col("key").alias("variable"), "mean", "sd")
    out = (
        long.join(co, on=["disease", "variable"], how="left")
        .join(sc, on="variable", how="left")
        .withColumn("x_standardized", safe_div(F.col("x") - F.col("mean"), F.col("sd")))
        .withColumn("variable_importance", F.col("x_standardized") * F.col("coef"))
        .withColumn("pos", F.col("variable_importance") > 0)
    )
    return out.join(countries.select("country_iso3c", "country"), on="country_iso3c", how="left")


def with_link_importance(
    preds: DataFrame,
    coefficients: DataFrame,
    scaling: DataFrame,
    link_variables: list[str],
    country_filter=None,
    diseases=None,
    months=None,
) -> DataFrame:
    """Cells with ``links``: per link variable its sum over the cell's origins and its importance.

    ``preds`` has an array ``origins`` a cell (``links.import_origins``).  The sum
    is null if any origin's value is null (strict sum) or there is none; a zero
    sum gives a null ``per_unit``, the importance of one unit of x.  Everything is
    an array expression on the cell's row; the only join is with the diseases'
    coefficients.
    """
    p = _filter(preds, country_filter, diseases, months)
    wide = coefficients.where(F.col("variable").isin(link_variables)).groupBy("disease").pivot(
        "variable", link_variables).agg(F.first("coef"))
    wide = wide.select("disease", F.struct(*[F.col(v) for v in link_variables]).alias("_coef"))
    fitted = {r["key"]: (r["mean"], r["sd"]) for r in scaling.where(F.col("key").isin(link_variables)).collect()}  # a row per variable
    j = p.join(wide, on="disease", how="left")
    found = []
    for v in link_variables:
        values = F.col(f"origins.{v}").cast("array<double>")
        whole = F.when((F.size(values) > 0) & ~F.exists(values, lambda x: x.isNull()), F.aggregate(values, F.lit(0.0), lambda a, x: a + x))
        mean, sd = (F.lit(x).cast("double") for x in fitted.get(v, (None, None)))
        found.append(F.struct(F.lit(v).alias("variable"), whole.alias("sum_x"), mean.alias("mean"), sd.alias("sd"), F.col(f"_coef.{v}").alias("coef")))
    j = j.withColumn("links", F.array(*found)).drop("_coef")
    standardised = lambda s: safe_div(s["sum_x"] - s["mean"], s["sd"])
    j = j.withColumn("links", F.transform("links", lambda s: s.withField("sum_x_standardized", standardised(s))))
    j = j.withColumn("links", F.transform("links", lambda s: s.withField("overall_variable_importance", s["sum_x_standardized"] * s["coef"])))
    return j.withColumn("links", F.transform("links", lambda s: s.withField("per_unit", safe_div(s["overall_variable_importance"], s["sum_x"]))))


CELL = ["country_iso3c", "disease", "month", "outbreak_start", "endemic", "outbreak_ongoing", "predicted_outbreak_probability"]


def _value(origin: Column, variables: list[str], variable: Column) -> Column:
    """The origin's value of the named link variable."""
    return F.coalesce(*[F.when(variable == v, origin[v].cast("double")) for v in variables])


def variable_importance_by_origin(cells: DataFrame, countries: DataFrame, link_variables: list[str]) -> DataFrame:
    """The importance of each link variable distributed over origins in
    proportion to each origin's value (``cells`` from ``with_link_importance``);
    one row with a null origin per variable where a cell has no origin."""
    flat = cells.select(*CELL, "links", F.explode_outer("origins").alias("_o")).select(
        *CELL, "_o", F.col("_o.country_origin").alias("country_origin_iso3c"), F.explode("links").alias("_l"))
    x = _value(F.col("_o"), link_variables, F.col("_l.variable"))
    j = flat.select(
        *CELL, "country_origin_iso3c", "_l.variable", x.alias("x"), "_l.coef", "_l.mean", "_l.sd", "_l.sum_x",
        "_l.sum_x_standardized", "_l.overall_variable_importance",
        (F.col("_l.per_unit") * x).alias("disagg_variable_importance"),
    ).withColumn("pos", F.col("disagg_variable_importance") > 0)
    return _origin_names(j, countries)


def _origin_names(df: DataFrame, countries: DataFrame) -> DataFrame:
    names = countries.select("country_iso3c", "country")
    onames = countries.select(
        F.col("country_iso3c").alias("country_origin_iso3c"), F.col("country").alias("country_origin"))
    return df.join(names, on="country_iso3c", how="left").join(onames, on="country_origin_iso3c", how="left")


def with_contributions(cells: DataFrame, link_variables: list[str]) -> DataFrame:
    """Cells with ``contributions``: (country_origin_iso3c, contribution) of the
    origins that any link variable gives a share of the import risk."""
    def one(o: Column) -> Column:
        shares = F.transform("links", lambda s: s["per_unit"] * _value(o, link_variables, s["variable"]))
        known = F.filter(shares, lambda x: x.isNotNull())
        total = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, x: a + x))
        return F.struct(o["country_origin"].alias("country_origin_iso3c"), total.alias("contribution"))

    every = F.filter(F.transform(F.coalesce("origins", F.array()), one), lambda c: c["contribution"].isNotNull())
    return cells.withColumn("contributions", every)


RISK = ["month", "disease", "country", "country_iso3c", "country_origin", "country_origin_iso3c",
        "predicted_outbreak_probability", "contribution_to_import_risk"]


def origin_import_risk(contributions: DataFrame, countries: DataFrame) -> DataFrame:
    """Contribution of each origin to the import risk."""
    flat = contributions.select("month", "disease", "country_iso3c", "predicted_outbreak_probability", F.explode("contributions").alias("_c")).select(
        "month", "disease", "country_iso3c", "predicted_outbreak_probability", "_c.country_origin_iso3c",
        F.col("_c.contribution").alias("contribution_to_import_risk"))
    return _origin_names(flat, countries).select(*RISK)


def largest_first(risk: DataFrame) -> DataFrame:
    """G1: by country, month and disease, largest contribution first."""
    return risk.orderBy("country", "month", "disease", F.desc("contribution_to_import_risk"), "country_origin_iso3c")


def top_origins(contributions: DataFrame, countries: DataFrame, k: int = 10) -> DataFrame:
    """The k largest origin contributions per destination-disease-month."""
    ordered = F.array_sort(
        "contributions",
        lambda a, b: F.when(a["contribution"] > b["contribution"], -1).when(a["contribution"] < b["contribution"], 1)
        .when(a["country_origin_iso3c"] < b["country_origin_iso3c"], -1).otherwise(1))
    top = contributions.withColumn("contributions", F.slice(ordered, 1, k))
    flat = top.select("month", "disease", "country_iso3c", "predicted_outbreak_probability", F.posexplode("contributions").alias("_i", "_c")).select(
        "month", "disease", "country_iso3c", "predicted_outbreak_probability", "_c.country_origin_iso3c",
        F.col("_c.contribution").alias("contribution_to_import_risk"), (F.col("_i") + 1).alias("rank"))
    return _origin_names(flat, countries).select(*RISK, "rank")


def origin_share_lumped(contributions: DataFrame, min_share: float = 0.05, other: str = "other") -> DataFrame:
    """Origin shares of the positive import risk; small shares lumped."""
    positive = F.filter("contributions", lambda c: c["contribution"] > 0)
    total = F.aggregate(positive, F.lit(0.0), lambda a, c: a + c["contribution"])
    cells = contributions.select("country_iso3c", "disease", "month", positive.alias("_p"), total.alias("_t"))
    shares = F.transform("_p", lambda c: F.struct(c["country_origin_iso3c"].alias("origin"), (c["contribution"] / F.col("_t")).alias("share")))
    cells = cells.withColumn("_s", shares)
    group = lambda origin, share, n: F.struct(origin.alias("origin_group"), share.alias("share"), n.cast("long").alias("n_origins"))
    small = F.filter("_s", lambda s: s["share"] < min_share)
    large = F.transform(F.filter("_s", lambda s: s["share"] >= min_share), lambda s: group(s["origin"], s["share"], F.lit(1)))
    rest = F.when(F.size(small) > 0, F.array(group(F.lit(other), F.aggregate(small, F.lit(0.0), lambda a, s: a + s["share"]), F.size(small))))
    groups = F.concat(large, F.coalesce(rest, F.filter(large, lambda s: F.lit(False))))
    return cells.select("country_iso3c", "disease", "month", F.explode(groups).alias("_g")).select("country_iso3c", "disease", "month", "_g.*")


def status_predict(
    network_preds: DataFrame,
    nowcast_preds: DataFrame,
    countries: DataFrame,
    country_filter=None,
    diseases=None,
) -> DataFrame:
    """Reported / predicted status per country-disease-semester, with the
    semester's maximum monthly outbreak probability and flags."""
    npred = _filter(network_preds, country_filter, diseases)
    sem = F.when(F.month("month") < 7, 1).otherwise(2)
    outbreak = npred.withColumn("yr", F.year("month") + (sem - 1) / 2.0).groupBy(
        "disease", "country_iso3c", "yr").agg(
        strict_agg(F.max, "predicted_outbreak_probability").alias(
            "predicted_semester_outbreak_probability"),
        F.bool_or("endemic").alias("endemic"),
        F.bool_or("outbreak_start").alias("outbreak_start"),
        F.bool_or("outbreak_ongoing").alias("outbreak_ongoing"),
    )
    nc = _filter(nowcast_preds, country_filter, diseases)
    status = nc.withColumn("yr", F.col("report_year") + (F.col("report_semester") - 1) / 2.0).groupBy(
        "country_iso3c", "disease", "yr", "report_year", "report_semester").agg(
        F.bool_and(F.col("disease_status_unreported") == 1).alias("_unrep"),
        (F.coalesce(F.sum("disease_status"), F.lit(0)) > 0).alias("_actual"),
        (F.coalesce(F.sum("cases_predicted"), F.lit(0)) > 0).alias("_pred"),
    )
    status = status.select(
        "country_iso3c", "disease", "yr", "report_year", "report_semester",
        F.when(F.col("_unrep"), "unreported").when(F.col("_actual"), "present")
        .otherwise("absent").alias("actual_disease_status"),
        F.when(F.col("_pred"), "present").otherwise("absent").alias("predicted_disease_status"),
    )
    out = status.join(outbreak, on=["country_iso3c", "disease", "yr"], how="left")
    out = out.join(countries.select("country_iso3c", "country"), on="country_iso3c", how="left")
    return out.withColumn("disease_clean", title_from_snake("disease"))


def origin_list(presence: DataFrame) -> DataFrame:
    """Number and sorted list of origin countries per disease-month."""
    return presence.groupBy("disease", "month").agg(
        F.countDistinct("country_origin").alias("n_origins"),
        F.array_join(F.array_sort(F.collect_set("country_origin")), ", ").alias("origins"),
    )


def origins_new(presence: DataFrame) -> DataFrame:
    """H3: origins present in a month but not in the month before (anti join)."""
    prev = presence.select(
        "country_origin", "disease", F.add_months("month", 1).alias("month"))
    return presence.join(prev, on=["country_origin", "disease", "month"], how="left_anti")
