"""Y5 covers every priority disease of the binding."""

from panelcast.plans import queries_readside as Q


def test_priority_coefficients_take_every_disease_of_the_prefix(spark, monkeypatch):
    names = ["brand_number_1", "brand_number_13", "brand_number_19", "brand_number_2", None]
    coefs = spark.createDataFrame([(n, "v", 0.1) for n in names], "disease string, variable string, coef double")
    monkeypatch.setattr(Q, "_tables", lambda spark, sf_dir: (None, None, coefs, None))
    assert {r.disease for r in Q.priority_coefficients(spark, "").collect()} == {"brand_number_1", "brand_number_13", "brand_number_19"}
