"""The registered queries train the model that the library trains by itself."""

from inspect import signature

import pytest

from lendmill.operators import ml
from lendmill.plans.registered import QUERIES

SF = "/root/testdata/sf0.001"


class Trained(Exception):
    pass


@pytest.mark.parametrize(
    "query", ["ml_scores", "ml_confusion", "ml_importance", "ml_scores_in_range", "ml_matrix_totals"]
)
def test_queries_train_with_the_defaults(spark, monkeypatch, query):
    def train(*args, **kwargs):
        given = signature(real).bind(*args, **kwargs)
        given.apply_defaults()
        raise Trained(given.arguments["rounds"], given.arguments["depth"])

    real = ml.train
    monkeypatch.setattr(ml, "train", train)
    with pytest.raises(Trained) as found:
        QUERIES[query](spark, SF)
    assert found.value.args == (20, 4)
