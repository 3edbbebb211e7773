"""The driver contract, and every query with SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from checks.compare import difference, duck
from logfeat.operators import scoring

QUERIES, SQL = entry.queries(), entry.oracle_sql()


def test_contract():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark, data):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, data, name):
    want = duck(data).execute(SQL[name]).df()
    assert difference(QUERIES[name](spark, data).toPandas(), want) is None


def test_crossfit_scores_fits_the_whole_model(spark, data, monkeypatch):
    """The query hands crossfit() the model with its production defaults."""
    class Caught(Exception):
        pass

    def catch(df, estimator, **options):
        raise Caught(estimator, options)

    monkeypatch.setattr(scoring, "crossfit", catch)
    with pytest.raises(Caught) as caught:
        QUERIES["crossfit_scores"](spark, data)
    estimator, options = caught.value.args
    model = estimator(1)
    got = (model.getMaxIter(), model.getMaxDepth(), model.getMinInstancesPerNode(), model.getMaxBins())
    assert got == (2600, 10, 50, 64) and not options  # patience included
