"""Property tests: random small baskets against brute force, and
invariance under item renaming and row order."""

from collections import Counter
from itertools import combinations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cofreq.operators.apriori import apriori
from cofreq.operators.eclat import eclat

from conftest import as_dict

baskets_st = st.lists(st.sets(st.integers(0, 7), min_size=1, max_size=6), min_size=1, max_size=12)


def brute(baskets, ms):
    c = Counter()
    for b in baskets:
        s = sorted(b)
        for k in range(1, len(s) + 1):
            c.update(combinations(s, k))
    return {k: v for k, v in c.items() if v >= ms}


def rows_df(spark, baskets, rename=None):
    rename = rename or (lambda x: x)
    data = [(t, rename(i)) for t, b in enumerate(baskets) for i in b]
    return spark.createDataFrame(data, "tid bigint, item int")


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(baskets=baskets_st, ms=st.integers(1, 4))
def test_apriori_and_eclat_equal_brute_force(spark, baskets, ms):
    want = brute(baskets, ms)
    rows = rows_df(spark, baskets)
    assert as_dict(apriori(rows, ms)) == want
    assert as_dict(eclat(rows, ms, max_group=3)) == want


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(baskets=baskets_st, ms=st.integers(1, 3))
def test_renaming_and_row_order_do_not_matter(spark, baskets, ms):
    perm = {i: (7 - i) * 11 for i in range(8)}
    back = {v: k for k, v in perm.items()}
    plain = as_dict(apriori(rows_df(spark, baskets), ms))
    renamed = as_dict(apriori(rows_df(spark, baskets, perm.get).orderBy("item"), ms))
    assert {tuple(sorted(back[i] for i in k)): v for k, v in renamed.items()} == plain
