import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
FIXTURES = os.path.join(ROOT, "tests", "fixtures")


@pytest.fixture(scope="session")
def spark():
    from cofreq.session import build_session

    s = build_session("local[4]", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


def fixture_path(name: str) -> str:
    return os.path.join(FIXTURES, name)


def as_dict(df, key="itemset"):
    """{tuple(itemset): support} of a miner result."""
    return {tuple(r[key]): r["support"] for r in df.collect()}


def level_sizes(df, key="k"):
    out = {}
    for r in df.select(key).collect():
        out[r[key]] = out.get(r[key], 0) + 1
    return [out[k] for k in sorted(out)]
