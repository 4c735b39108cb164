import itertools
import random
import time
from collections import Counter

import pytest

from tests.conftest import rows
from tests.test_similarity import brute, ratings
from tidewater.operators import commerce, ml, pairs
from tidewater.sources.durable import durable, durable_rounds, freed_shuffles


@pytest.fixture
def small_rounds(monkeypatch):
    """Rounds of some 100 pairs; the list has the number of rounds of every call."""
    called, write = [], pairs.durable_rounds

    def noted(make, rounds, label):
        called.append(rounds)
        return write(make, rounds, label)

    monkeypatch.setattr(pairs, "durable_rounds", noted)
    monkeypatch.setattr(pairs, "ROUND_PAIRS", 100)
    monkeypatch.setattr(pairs, "TASK_PAIRS", 20)
    return called


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def left_files(spark, before):
    """Shuffle files that stay; deleting them is not waited for by Spark."""
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


@pytest.mark.parametrize("block", [1000, 16])
@pytest.mark.parametrize("least", [0.3, 0.8])
def test_similar_items_in_rounds_equal_brute_force(spark, both_ways, small_rounds, block, least):
    data = ratings()
    got = ml.cosine_items(spark.createDataFrame(data, "u string, i int, r double"), "u", "i", "r", least, block)
    got = {(r.item_a, r.item_b): r.similarity for r in got.collect()}
    want = {p: s for p, s in brute(data).items() if s >= least - 1e-9}
    assert got.keys() == want.keys()
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)
    assert least > 0.5 or small_rounds[0] > 3


def test_similar_items_leave_no_shuffle_files_behind(spark, small_rounds):
    df = spark.createDataFrame(ratings(), "u string, i int, r double")
    before = shuffle_files(spark)
    ml.cosine_items(df, "u", "i", "r", 0.3)
    assert not left_files(spark, before)


def test_a_round_holds_its_share_of_the_pairs(spark, small_rounds, monkeypatch):
    made, write = [], pairs.durable_rounds

    def counted(make, rounds, label):
        made.extend(make(k).agg({"support": "sum"}).first()[0] or 0 for k in range(rounds))
        return write(make, rounds, label)

    monkeypatch.setattr(pairs, "durable_rounds", counted)
    rnd = random.Random(6)
    data = [(g, i) for g in range(200) for i in rnd.sample(range(300), 12)] + [(g, 999) for g in range(200)]
    commerce.pair_counts(spark.createDataFrame(data, "g int, i int"), "g", "i", 1)
    assert sum(made) == 200 * 13 * 12 // 2 and len(made) == small_rounds[0] == 3
    assert max(made) < 0.45 * sum(made)             # 999 meets all others; the rarer item holds the pair


@pytest.mark.parametrize("support,big", [(1, 1000), (2, 1000), (3, 5), (2, 5), (1, 5)])
def test_pair_counts_in_rounds(spark, both_ways, small_rounds, support, big):
    rnd = random.Random(4)
    data = [("big1", i) for i in range(40)] + [("big2", i) for i in range(30, 44)] + [("b0", 1), (None, 1), (None, 2), ("b1", None)]
    for b in range(90):
        data += [(f"b{b}", i) for i in rnd.sample(range(45), 4)]
    held = {}
    for b, i in data:
        if b is not None and i is not None:
            held.setdefault(b, set()).add(i)
    counts = Counter(p for x in held.values() for p in itertools.combinations(sorted(x), 2))
    got = commerce.pair_counts(spark.createDataFrame(data, "b string, i int"), "b", "i", support, big)
    assert rows(got, "item_a", "item_b", "support") == sorted(((a, b, n) for (a, b), n in counts.items() if n >= support), key=repr)
    assert len(small_rounds) == 1


def test_few_items_are_not_paired_in_rounds(spark, small_rounds):
    df = spark.range(4000).selectExpr("id div 8 as g", "id % 8 as i")
    assert commerce.pair_counts(df, "g", "i", 1).count() == 28 and not small_rounds


def test_product_rules_in_rounds_leave_no_shuffle_files_behind(spark, small_rounds, monkeypatch):
    rnd = random.Random(5)
    lists = [rnd.sample(range(40), rnd.randint(1, 9)) for _ in range(150)] + [[7], [], [None, 1, 2], None]
    baskets = spark.createDataFrame([(x,) for x in lists], "items array<int>")
    want = None
    for rounds in (True, False):
        before = shuffle_files(spark)
        got = ml.association_rules(baskets, "items", 0.02, 0.1, longest=2)
        assert not left_files(spark, before)
        got = sorted((tuple(r.antecedent), r.consequent[0], r.support) for r in got.collect())
        assert got and want in (None, got)
        assert len(small_rounds) == 1
        want = got
        monkeypatch.setattr(pairs, "ROUND_PAIRS", 1 << 26)


def test_shuffles_are_freed_inside_only(spark, tmp_path):
    def shuffled():
        return spark.range(1000).repartition(3, "id")

    with freed_shuffles(spark):
        before = shuffle_files(spark)
        durable(shuffled())
        assert not left_files(spark, before)
    assert durable_rounds(lambda k: shuffled().filter(f"id % 3 = {k}"), 3).count() == 1000
    df = shuffled()
    with freed_shuffles(spark):
        durable(df)
    assert sum(r.id for r in df.collect()) == sum(r.id for r in df.collect()) == 999 * 500
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
