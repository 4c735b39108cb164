import itertools
import math
import random

import pytest

from tidewater.operators import ml


def ratings():
    """Small users, one user with all items and one with most."""
    rnd = random.Random(8)
    out = [("all", i, 1.0 + i % 3) for i in range(120)] + [("most", i, 0.5) for i in range(20, 120)]
    for u in range(80):
        out += [(f"u{u}", i, rnd.choice([0.5, 1.0, 2.0])) for i in rnd.sample(range(60), 4)]
    return out + [("u0", 3, 1.0), (None, 1, 1.0), ("u1", None, 1.0), ("u2", 5, None), ("zero", 500, 0.0), ("zero", 501, 0.0)]


def brute(data):
    vectors = {}
    for u, i, r in data:
        if None not in (u, i, r):
            vectors.setdefault(i, {})
            vectors[i][u] = vectors[i].get(u, 0.0) + r
    norm = {i: math.sqrt(sum(x * x for x in v.values())) for i, v in vectors.items()}
    out = {}
    for a in vectors:
        for b in vectors:
            shared = vectors[a].keys() & vectors[b].keys()
            if a < b and shared and norm[a] and norm[b]:
                out[a, b] = sum(vectors[a][u] * vectors[b][u] for u in shared) / (norm[a] * norm[b])
    return out


@pytest.mark.parametrize("block", [1000, 16])
@pytest.mark.parametrize("least", [None, 0.3, 0.8])
def test_cosine_items_equals_brute_force(spark, both_ways, block, least):
    data = ratings()
    got = ml.cosine_items(spark.createDataFrame(data, "u string, i int, r double"), "u", "i", "r", least, block)
    got = {(r.item_a, r.item_b): r.similarity for r in got.collect() if r.similarity is not None}
    want = {p: s for p, s in brute(data).items() if least is None or s >= least - 1e-9}
    assert got.keys() == want.keys()
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_pairs_of_a_large_user_are_spread(spark):
    rows = spark.range(3000).selectExpr("1 as _u", "id as _i", "1.0D as _r")
    met = ml._met(rows, "_r", 500)
    assert met.count() == 3000 * 2999 // 2
    plan = met._jdf.queryExecution().toString()
    assert "_lo" in plan and "CartesianProduct" not in plan


def test_cosine_items_of_nothing(spark):
    empty = spark.createDataFrame([], "u string, i int, r double")
    assert ml.cosine_items(empty, "u", "i", "r").count() == 0
    assert ml.cosine_items(empty, "u", "i", "r", 0.5).count() == 0
    with pytest.raises(ValueError):
        ml.cosine_items(empty, "u", "i", "r", 0.0)


def test_pairs_that_meet_by_chance_are_not_computed_again(spark, monkeypatch):
    # most items share a user with each other, too few for the bar, yet rests that are short enough to leave users out are rare
    rnd = random.Random(3)
    data = [(u, i, 1.0) for u in range(100) for i in rnd.sample(range(200), 20)] + [(u, i, 1.0) for u in range(100, 106) for i in (300, 301)]
    kept, write = {}, ml.durable

    def noted(df, label="step"):
        out = write(df, label)
        kept[label] = out.count()
        return out

    monkeypatch.setattr(ml, "durable", noted)
    got = {(r.item_a, r.item_b) for r in ml.cosine_items(spark.createDataFrame(data, "u int, i int, r double"), "u", "i", "r", 0.25).collect()}
    assert got == {p for p, s in brute(data).items() if s >= 0.25 - 1e-9} and (300, 301) in got
    assert kept["pairs"] <= 2 * len(got)


def test_product_rules_equal_fp_growth_and_grow_no_trees(spark, monkeypatch):
    rnd = random.Random(5)
    lists = [rnd.sample(range(30), rnd.randint(1, 9)) for _ in range(150)] + [list(range(30)), [7], [], [None, 1, 2], None]
    baskets = spark.createDataFrame([(x,) for x in lists], "items array<int>")
    counted = [[x for x in b if x is not None] for b in lists if b is not None]
    want, n = {}, len(counted)
    for size in (1, 2):
        for left in itertools.combinations(range(30), size):
            with_left = [b for b in counted if set(left) <= set(b)]
            for c in set(range(30)) - set(left):
                k = sum(c in b for b in with_left)
                if k >= 4 and k / len(with_left) >= 0.3:
                    want[left, c] = (k / len(with_left), k / len(with_left) / (sum(c in b for b in counted) / n), k / n)
    monkeypatch.setattr(ml, "FPGrowth", None)
    got = ml.association_rules(baskets, "items", 3.5 / n, 0.3, longest=2).collect()
    got = {(tuple(sorted(r.antecedent)), r.consequent[0]): (r.confidence, r.lift, r.support) for r in got}
    assert len(want) > 300 and {len(left) for left, _ in want} == {1, 2}
    assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x]) for x in want)
    assert ml.association_rules(baskets.limit(0), "items", 0.1, 0.3, longest=2).count() == 0
    with pytest.raises(ValueError):
        ml.association_rules(baskets, "items", 0.1, 0.3, longest=3)
