"""Plan guards: no mining query uses a cartesian product, a nested-loop
join or a Python UDF anywhere in the tables it writes or returns."""

import pytest

import __spark_entry__ as E
import cofreq.session as S
from cofreq.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "localCheckpoint")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def captured(monkeypatch):
    plans = []
    orig = S.materialize

    def spy(df, tag):
        plans.append((tag, _plan(df)))
        return orig(df, tag)

    import cofreq.operators.apriori as A
    import cofreq.operators.candidates as CA
    import cofreq.operators.eclat as EC
    import cofreq.operators.encode as EN
    import cofreq.operators.fpgrowth as FP
    import cofreq.operators.groupjoin as G
    import cofreq.operators.ordered as O
    import cofreq.plans.pipelines as P
    import cofreq.plans.queries as Q
    for mod in (S, A, CA, EC, EN, FP, G, O, P, Q):
        monkeypatch.setattr(mod, "materialize", spy, raising=False)
    write = S.Store.write

    def spy_store(self, df, tag, *a):
        df = df() if callable(df) else df
        plans.append((tag, _plan(df)))
        return write(self, df, tag, *a)
    monkeypatch.setattr(S.Store, "write", spy_store)
    return plans


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_or_python_udf(spark, captured, name):
    df = E.queries()[name](spark, SF)
    captured.append(("result", _plan(df)))
    assert len(captured) >= 1
    for tag, plan in captured:
        for bad in FORBIDDEN:
            assert bad not in plan, f"{name}: {bad} in {tag}"
