from panelcast.operators import models
from panelcast.plans import queries_models as Q

SF = "/root/testdata/sf0.01"


def test_permutation_importance_covers_the_recipe_on_correct_starts(spark):
    st, _ = Q._hurdle(spark, SF)
    predictors = models.recipe_predictors(st)
    assert {"disease", "taxa", "cases_lag1", "cases_lag3", "report_semester_1"} <= set(predictors) and len(predictors) > 10
    got = {r.variable: r.acc for r in Q.permutation_importance(spark, SF).collect()}
    starts = Q.correct_starts(spark, SF).count()
    assert starts and set(got) == {"(none)", *predictors} and got["(none)"] == 1.0
    assert min(got.values()) < 1.0  # some predictor matters
