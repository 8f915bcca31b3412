"""The read side: published prediction tables and the questions asked of them.

``publish`` writes a network model's tables into a store: features with
predictions, the same with origins, coefficients and scaling values.  The reads
take the countries, diseases and month of a question, open only the partitions
that hold them, and do the same for every model.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import attribution as A
from ..operators import mixed
from ..sources import bindings as B
from ..sources.store import PARTITIONS, PredictionStore
from . import network as NW

#: Diseases that the reads report on unless told otherwise (the binding's priority diseases).
PRIORITY = ["brand_number_1", "brand_number_10", "brand_number_11", "brand_number_12"]
LINKS = ["shared_borders_from_outbreaks", "ots_trade_dollars_from_outbreaks", "fao_livestock_heads_from_outbreaks",
         "n_migratory_wildlife_from_outbreaks"]
CELL = ["country_iso3c", "disease", "month"]
TABLES = ("augment_predict", "augment_predict_by_origin", "coefficients", "scaling_values")
_PUBLISHED: dict = {}


def month_of(day: dt.date) -> dt.date:
    return day.replace(day=1)


@dataclass
class NetworkReads:
    """Questions to the published tables of one network model."""

    store: PredictionStore
    model: str
    countries: DataFrame
    as_of: dt.date

    def table(self, name: str, **only) -> DataFrame:
        return self.store.read(f"network_{self.model}_{name}", **only)

    def _months(self, months) -> list[dt.date]:
        return [month_of(self.as_of)] if months is None else list(months)

    def variable_importance(self, countries=None, diseases=PRIORITY, months=None) -> DataFrame:
        """Y2: standardised value x coefficient per variable; the current month by default."""
        rows = self.table("augment_predict", disease=diseases, month=self._months(months), country_iso3c=countries)
        return A.variable_importance(rows, self.table("coefficients"), self.table("scaling_values"), self.countries, NW.SCALED)

    def _cells(self, countries, diseases, months) -> DataFrame:
        rows = self.table("augment_predict_by_origin", disease=diseases, month=self._months(months), country_iso3c=countries)
        return A.with_link_importance(rows, self.table("coefficients"), self.table("scaling_values"), LINKS)

    def variable_importance_by_origin(self, countries=None, diseases=PRIORITY, months=None) -> DataFrame:
        """Link-variable importance distributed over origins."""
        return A.variable_importance_by_origin(self._cells(countries, diseases, months), self.countries, LINKS)

    def origin_import_risk(self, countries=None, diseases=PRIORITY, months=None) -> DataFrame:
        """Y4 + G1: contribution of each origin, by country, month and disease, largest first."""
        cells = A.with_contributions(self._cells(countries, diseases, months), LINKS)
        return A.largest_first(A.origin_import_risk(cells, self.countries))

    def top_origins(self, countries=None, diseases=PRIORITY, months=None, k: int = 10) -> DataFrame:
        """The k largest origins of each cell."""
        return A.top_origins(A.with_contributions(self._cells(countries, diseases, months), LINKS), self.countries, k)

    def status_predict(self, nowcast: DataFrame, countries=None, diseases=PRIORITY) -> DataFrame:
        """Reported and predicted status per semester with the largest monthly probability."""
        rows = self.table("augment_predict", disease=diseases, country_iso3c=countries)
        return A.status_predict(rows, nowcast, self.countries, countries, diseases)


def reads(spark: SparkSession, sf_dir: str, model: str, tables, months=None) -> NetworkReads:
    """Reads of a model; ``tables()`` gives what ``publish`` takes when it has to be published.

    Published once a session and data folder, for ``months`` only if given; other
    sessions use ``NetworkReads`` on the same store.
    """
    name = f"{model}_{abs(hash(sf_dir)) % 10**9}"
    key = (spark.sparkContext.applicationId, name)
    store = PredictionStore(spark)
    if key not in _PUBLISHED:
        publish(store, name, *tables(), months=months)
        _PUBLISHED[key] = True
    return NetworkReads(store, name, B.countries(spark, sf_dir), B.AS_OF)


def publish(store: PredictionStore, model: str, features: DataFrame, by_origin: DataFrame, coefficients: DataFrame,
            scaling: DataFrame, predictions: DataFrame, months=None) -> None:
    """K3: the model's tables, features and origins partitioned by disease and month.

    Only the partitions of ``months`` are written, others stay as they are; all by default.
    """
    pred = predictions.select(*CELL, "predicted_outbreak_probability")
    for name, rows in (("augment_predict", features), ("augment_predict_by_origin", by_origin)):
        rows = rows if months is None else rows.where(F.col("month").isin(list(months)))
        store.write(f"network_{model}_{name}", rows.join(pred, CELL, "left"), PARTITIONS)
    store.write(f"network_{model}_coefficients", coefficients)
    store.write(f"network_{model}_scaling_values", scaling)


def formula_tables(spark: SparkSession, sf_dir: str):
    """The binding's formula model."""
    features, scaling, coefficients = NW.network_model_tables(spark, sf_dir)
    return features, NW.network_features(spark, sf_dir, by_origin=True), coefficients, scaling, NW.predict(features, scaling, coefficients)


def fitted_tables(spark: SparkSession, sf_dir: str, fit: mixed.MixedLogitFit, scaling: NW.Scaling):
    """The fitted mixed-effects model (L14, L15, L17): slopes per disease, scaling values of its training rows."""
    features = NW.network_features(spark, sf_dir)
    rows = [(k, scaling.mean[k], scaling.sd[k]) for k in scaling.mean]
    table = spark.createDataFrame(rows, "key string, mean double, sd double")
    z = NW.standardise_with(features, scaling)
    levels = [p for p in fit.predictors if p.startswith("continent")]
    z = z.withColumns({c: (F.col("continent") == c.removeprefix("continent")).cast("double") for c in levels})
    return (features, NW.network_features(spark, sf_dir, by_origin=True), fit.coefficients(spark).where("variable <> '(Intercept)'"), table,
            mixed.predict(z, fit))
