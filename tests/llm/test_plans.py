"""Native operators run no Python; nothing multiplies tables."""

import pytest

from textloom.llm import exact_index, pii, poisson_mix, queries, secrets

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("make", [poisson_mix.mix, secrets.secret_spans, lambda df: pii.pseudonymise(df, "k"), exact_index.exact_duplicates], ids=["mix", "secrets", "pii", "index"])
def test_native(make, spark, monkeypatch):
    seen = []
    real = pii.materialise

    def watched(df, name):
        seen.append(df)
        return real(df, name)

    for module in (exact_index, pii, poisson_mix, secrets):
        monkeypatch.setattr(module, "materialise", watched)
    seen.append(make(queries._read(spark, SF, "documents")))
    assert len(seen) > 2
    for df in seen:
        text = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in text for x in ("Python", "Pandas", "ArrowEval", "ExternalRDD", "Cartesian", "NestedLoop"))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_products(name, spark):
    text = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_entities_are_searched_once(spark, monkeypatch):
    """Of all plans that the operator runs, one searches the documents."""
    plans = []
    real = pii.materialise

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(pii, "materialise", watched)
    out = pii.pseudonymise(queries._read(spark, SF, "documents"), "k")
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert sum("documents.parquet" in p for p in plans) == 1
