import math

import pytest
from test_median import brute_median

from costlens.operators import median


@pytest.fixture
def medians(spark, monkeypatch):
    """rows -> (median per group, buckets that the second step looks at)"""

    def run(rows):
        seen, real = [], median._hits
        monkeypatch.setattr(median, "_hits", lambda counted, by, code: seen.append(counted) or real(counted, by, code))
        df = median.grouped_median(spark.createDataFrame(rows, "g string, x double"), ["g"], {"x": "x"})
        return {r.g: r.x for r in df.collect()}, seen[0].select("g").collect()

    return run


def test_ranks_alone_in_their_bucket_join_nothing(medians):
    """Groups of few or repeated values are settled by the first step; their histogram is not joined again."""
    rows = [(f"g{i % 50}", float(i % 7)) for i in range(1000)]
    rows += [(None, -3.0), (None, 4.0), ("none", None), ("inf", math.inf), ("inf", -math.inf), ("inf", math.inf), ("zero", 0.0), ("zero", -0.0)]
    got, looked_at = medians(rows)
    assert got == {g: brute_median([x for h, x in rows if h == g]) for g in {g for g, _ in rows}}
    assert looked_at == []


def test_settled_and_open_ranks_of_one_group_meet(medians):
    """The lower middle rank is alone in its bucket, the upper one shares a bucket with close values."""
    close = [5.0, 5.0 + 1e-12, 5.0 + 2e-12]
    rows = [("half", x) for x in (1.0, 2.0, 3.0, *close)] + [("open", x) for x in close] + [("nan", 1.0), ("nan", math.nan), ("nan", math.nan)]
    got, looked_at = medians(rows)
    assert got["half"] == 0.5 * 3.0 + 0.5 * 5.0 and got["open"] == close[1] and math.isnan(got["nan"])
    assert {r.g for r in looked_at} == {"half", "open"}
