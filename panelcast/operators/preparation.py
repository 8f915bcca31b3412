"""Preparation that is fitted once and stored with the model.

``Prepvar`` is an ML estimator over a set of variables: an expression, a
transform, fills for missing values and zeros taken from the fitting rows, and
optionally standardisation of the result.  Its model holds the fitted numbers, is
saved and loaded like any ML model, and gives the forecast rows the values that
the training rows had.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import safe_log10
from .covariates import PrepvarStats, prepvar_apply, prepvar_fit_many

TRANSFORMS = {"identity": lambda c: c, "log10": safe_log10}


class _PrepvarParams(Params):
    variables = Param(
        Params._dummy(), "variables",
        "output column -> {x: SQL expression, transform: a name of TRANSFORMS, na: 'auto' or a number, "
        "zero: 'zero' (kept), 'auto' or a number, scale: standardise the result}", TypeConverters.identity)
    drop = Param(Params._dummy(), "drop", "columns left out of the result", TypeConverters.toListString)

    def _specs(self) -> dict:
        specs = {}
        for name, given in self.getOrDefault(self.variables).items():
            spec = {"transform": "identity", "na": "auto", "zero": "zero", "scale": False, **given}
            unknown = set(spec) - {"x", "transform", "na", "zero", "scale"}
            if unknown or "x" not in spec or spec["transform"] not in TRANSFORMS:
                raise ValueError(f"variable {name}: {given}")
            specs[name] = spec
        return specs


class Prepvar(Estimator, _PrepvarParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits fills (least transformed value less 6 standard deviations for missing, 3 for zeros) and scaling."""

    @keyword_only
    def __init__(self, *, variables=None, drop=None):
        super().__init__()
        self._setDefault(drop=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PrepvarModel:
        specs = self._specs()
        fills = prepvar_fit_many(dataset, {n: (F.expr(s["x"]), TRANSFORMS[s["transform"]], s["zero"]) for n, s in specs.items()})
        fitted = {n: {"na_fill": f.na_fill, "zero_fill": f.zero_fill} for n, f in fills.items()}
        model = PrepvarModel(variables=specs, drop=self.getOrDefault(self.drop), fitted=fitted)
        scaled = [n for n, s in specs.items() if s["scale"]]
        if scaled:  # of the filled values, in one aggregate
            sums = [g(f"`{n}`").alias(f"{n}__{g.__name__}") for n in scaled for g in (F.avg, F.stddev_samp)]
            row = dataset.select([c.alias(n) for n, c in model.columns(scale=False).items()]).agg(*sums).first()
            for n in scaled:
                fitted[n] |= {"mean": row[f"{n}__avg"], "sd": row[f"{n}__stddev_samp"]}
            model._set(fitted=fitted)
        return model


class PrepvarModel(Model, _PrepvarParams, DefaultParamsReadable, DefaultParamsWritable):
    """Applies the fitted preparation; the numbers enter the projection as literals."""

    fitted = Param(Params._dummy(), "fitted", "fitted numbers of each variable", TypeConverters.identity)

    @keyword_only
    def __init__(self, *, variables=None, drop=None, fitted=None):
        super().__init__()
        self._setDefault(drop=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def columns(self, scale: bool = True) -> dict:
        """Output columns; a variable without spread standardises to 0."""
        out = {}
        for name, s in self._specs().items():
            f = self.getOrDefault(self.fitted)[name]
            c = prepvar_apply(F.expr(s["x"]), PrepvarStats(f["na_fill"], f["zero_fill"]), TRANSFORMS[s["transform"]], s["na"], s["zero"])
            if scale and s["scale"]:
                c = (c - f["mean"]) / f["sd"] if f.get("sd") else F.when(c.isNotNull(), F.lit(0.0))
            out[name] = c
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns(self.columns()).drop(*self.getOrDefault(self.drop))
