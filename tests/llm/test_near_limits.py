"""Near duplicates below 85/100 against brute force."""

import pytest
from test_methods import brute_near, family, frame

from shelfmark.llm import near_dedup


def parts(spark, texts, num):
    got = near_dedup.near_duplicates(frame(spark, texts), (num, 100), list_limit=2).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}


def test_small_sets_with_common_values_at_80(spark):
    base = [f"w{i}" for i in range(24)]
    texts = [" ".join([*base, *(f"t{k}x{i}" for i in range(4 * (k > 0)))]) for k in range(5)]
    want = brute_near(texts, 80)
    assert {p for _, p in want.values()} == {0} and parts(spark, texts, 80) == want


@pytest.mark.parametrize("num", [80, 60])
def test_families(spark, num):
    texts = family(copies=40)
    assert parts(spark, texts, num) == brute_near(texts, num)


def test_limits():
    assert near_dedup.limits((85, 100)) == near_dedup.limits((17, 20)) == (20, 27, 10, 0.15, 0.375)
    with pytest.raises(ValueError):
        near_dedup.limits((40, 100))
