import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewater.functions import columns as C
from tidewater.operators import quality as Q


def people(spark):
    return spark.createDataFrame([(1, 5.0, "a@x.org"), (2, None, "b@x.org"), (3, -1.0, None), (3, -1.0, None)], "id int, v double, mail string")


def test_split_loses_and_repeats_nothing(spark):
    df = people(spark)
    valid, bad = Q.split(df, {"positive": F.col("v") > 0, "mail": F.col("mail").isNotNull()})
    assert rows(valid, "id") == [(1,)]
    assert rows(bad, "id", "failed") == [(2, "positive"), (3, "positive,mail"), (3, "positive,mail")]
    assert rows(valid.unionByName(bad.drop("failed"))) == rows(df)


def test_expect_counts_in_the_same_pass(spark):
    kept, seen = Q.expect(people(spark), warn={"mail": F.col("mail").isNotNull()}, drop={"v": F.col("v") > 0})
    assert kept.count() == 1
    assert seen.get == {"rows": 4, "mail": 2, "v": 3}


def test_metrics_and_rules(spark):
    m = Q.quality_metrics(people(spark), ["id"], ["v", "mail"], {"negative": F.col("v") < 0}).first()
    assert (m["rows"], m.null_v, m.null_mail, m.invalid_negative, m.duplicate_pct) == (4, 1, 2, 2, 25.0)
    assert rows(Q.rule_report(people(spark), {"r": F.col("v") > 0})) == [("r", 3, 1)]


def test_imputation(spark, both_ways):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None)], "k string, v double")
    assert rows(Q.impute_group_mean(df, ["k"], "v")) == [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", None)]
    assert rows(Q.impute(df, means=["v"]), "v") == [(1.0,), (2.0,), (2.0,), (3.0,)]
    assert rows(Q.impute(df, mode_of=["v"]), "v") == [(1.0,), (1.0,), (1.0,), (3.0,)]
    assert rows(Q.impute(df, defaults={"v": 0.0}), "v") == [(0.0,), (0.0,), (1.0,), (3.0,)]


def test_keep_latest_has_one_row_on_ties(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 5, "y"), (2, 1, "z")], "id int, t int, v string")
    assert rows(Q.keep_latest(df, ["id"], "t", "v")) == [(1, 5, "y"), (2, 1, "z")]


def test_masking_hides_originals(spark):
    df = spark.createDataFrame([(7, "jo@site.org", "4111-1111-1111-1234", "Street 1")], "id int, mail string, card string, street string")
    r = Q.mask(df, "salt", {"id": "token"}, ["mail"], ["card"], ["street"]).first()
    assert (r.mail, r.card, r.street) == ("***@site.org", "****-****-****-1234", "REDACTED") and "id" not in r.asDict()
    assert len(r.token) == 64
    with pytest.raises(ValueError):
        C.salted_hash(F.lit(1), "")


def test_role_view_null_filter_hides(spark):
    df = people(spark)
    view = lambda role: Q.role_view(df, role, {"mail": F.lit("***")}, F.col("v") > 0)
    assert rows(view("admin")) == rows(df)
    assert rows(view("guest"), "id", "mail") == [(1, "***")]


def test_outliers(spark, both_ways):
    df = spark.createDataFrame([("k", float(v)) for v in [1, 2, 2, 3, 3, 3, 4, 100]], "k string, v double")
    for exact in (True, False):
        assert rows(Q.iqr_outliers(df, "v", exact=exact), "v") == [(100.0,)]
    assert rows(Q.sigma_outliers(df, ["k"], "v"), "v") == [(100.0,)]
