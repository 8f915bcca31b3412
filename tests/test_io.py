"""Sources and sinks: lookup CSV round trip (quoted commas, gzip) and model persistence."""

import tempfile

import numpy as np
from pyspark.sql import functions as F

from panelcast.sources.tables import LOOKUP_SCHEMAS, read_lookup_csv, write_csv


def test_lookup_csv_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="panelcast-io-")
    rows = [("Foot and mouth disease", "foot_and_mouth_disease"),
            ("Influenza, avian (highly pathogenic)", "influenza_avian_highly_pathogenic")]
    df = spark.createDataFrame(rows, LOOKUP_SCHEMAS["disease_recode"])
    write_csv(df.coalesce(1), f"{d}/recode", gzip=True)
    back = read_lookup_csv(spark, f"{d}/recode", LOOKUP_SCHEMAS["disease_recode"])
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_mixed_fit_save_load(spark):
    from panelcast.operators.mixed import fit_mixed_logit, load_fit, predict, save_fit

    rng = np.random.default_rng(3)
    rows = [(f"g{i % 3}", bool(rng.random() < 0.3), float(rng.normal()), 1) for i in range(600)]
    df = spark.createDataFrame(rows, "disease string, y boolean, x double, count long")
    fit = fit_mixed_logit(df, ["x"], "y", "disease", "count", max_iter=10)
    d = tempfile.mkdtemp(prefix="panelcast-model-")
    save_fit(fit, spark, d)
    back = load_fit(spark, d)
    assert back.intercept == fit.intercept
    a = predict(df, fit).agg(F.sum("predicted_outbreak_probability")).first()[0]
    b = predict(df, back).agg(F.sum("predicted_outbreak_probability")).first()[0]
    assert abs(a - b) < 1e-9
