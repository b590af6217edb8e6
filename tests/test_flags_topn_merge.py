import datetime as dt

from pyspark.sql import functions as F

from wideloom.operators.flags import existence_flag
from wideloom.operators.merge import merge_sections
from wideloom.operators.topn import top_n_pivot
from wideloom.params import AsOf
from wideloom.plans import sections as S


def test_existence_flag_dedupes_right(spark):
    left = spark.createDataFrame([(1,), (2,)], "member_id long")
    right = spark.createDataFrame([(1, "qw"), (1, "qw"), (2, "other")], "member_id long, channel_no string")
    out = existence_flag(left, right.filter(F.col("channel_no") == "qw"), ["member_id"], "flag")
    got = sorted((r.member_id, r.flag) for r in out.collect())
    assert got == [(1, "Y"), (2, "N")]  # F7 one row despite duplicates; F8 non-matching channel -> N


def test_top_n_ties_and_short_lists(spark):
    rows = [(1, "a", 5.0), (1, "b", 5.0), (1, "c", 5.0), (1, "d", 9.0), (2, "z", 1.0)]
    df = spark.createDataFrame(rows, "member_id long, item string, qty double")
    dim = spark.createDataFrame([("a", "A"), ("b", "B"), ("d", "D"), ("z", "Z")], "code string, name string")
    out = top_n_pivot(df, ["member_id"], "item", "qty", 3, ["c1", "c2", "c3"], dim=dim, value_names=["n1", "n2", "n3"])
    got = {r.member_id: tuple(r)[1:] for r in out.collect()}
    assert got[1] == ("d", "a", "b", "D", "A", "B")  # tie -> item code ascending
    assert got[2] == ("z", None, None, "Z", None, None)  # F12


def test_top_n_plans_group_limit(spark):
    df = spark.createDataFrame([(1, "a", 5.0)], "member_id long, item string, qty double")
    out = top_n_pivot(df, ["member_id"], "item", "qty", 3, ["c1", "c2", "c3"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_merge_sections_one_row_per_key(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "k long, x int")
    b = spark.createDataFrame([(2, "u"), (3, None)], "k long, y string")
    out = merge_sections({"a": a, "b": b}, ["k"])
    got = {r.k: (r.x, r.y, r.has_a, r.has_b) for r in out.collect()}
    assert got == {1: (10, None, True, False), 2: (20, "u", True, True), 3: (None, None, False, True)}


def test_member_columns(spark):
    asof = AsOf(dt.date(2021, 3, 15))
    rows = [(1, None, None), (2, "", dt.date(1990, 7, 1)), (3, "13800000000", dt.date(1990, 3, 31))]
    df = spark.createDataFrame(rows, "member_id long, phone string, birthday date") \
        .withColumn("user_name", F.lit("u")).withColumn("member_status", F.lit("s")) \
        .withColumn("register_time", F.lit(None).cast("date")).withColumn("self_regist_flag", F.lit(1)) \
        .withColumn("member_no", F.lit("n")).withColumn("store_code", F.lit(1)) \
        .withColumn("has_channel_signup", F.lit(None).cast("boolean")) \
        .withColumn("org_id", F.lit(None).cast("int")).withColumn("org_name", F.lit(None).cast("string"))
    out = df.select("member_id", *S.member_base_columns(asof)).orderBy("member_id").collect()
    assert [(r.PHONE_FLG, r.PHONE_SEGMENT) for r in out] == [("N", None), ("N", ""), ("Y", "138")]  # F9
    assert [r.AGE for r in out] == [0, 30, 31]  # F10
    assert {r.IS_ENTER_WECHAT for r in out} == {"N"}


def test_salted_lookup_join_equals_plain_join(spark):
    from wideloom.operators.joins import salted_lookup_join
    big = spark.createDataFrame([(i, 0 if i % 3 else i % 7, 1) for i in range(3000)], "member_id long, code long, t int")
    small = spark.createDataFrame([(0, 1, "hot"), (1, 1, "a"), (2, 1, "b"), (5, 2, "other tenant")],
                                  "code long, t int, name string")
    cols = ["member_id", "code", "t", "name"]
    plain = sorted(tuple(r) for r in big.join(small, ["code", "t"], "left").select(*cols).collect())
    salted = salted_lookup_join(big, small, ["code", "t"], ["member_id"], buckets=8)
    assert sorted(tuple(r) for r in salted.select(*cols).collect()) == plain
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # shuffled join (the shape of a large run): the hot key spreads over several tasks
        spread = salted_lookup_join(big, small, ["code", "t"], ["member_id"], buckets=8) \
            .filter("code = 0").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spread > 1


def test_a_generated_dimension_is_never_broadcast(spark, tmp_path):
    """Its estimate is that of the small file below it, so a plan by estimate sent it through the driver."""
    from wideloom.operators.joins import salted_keys_join
    spark.range(40).selectExpr("id AS code").write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim")).selectExpr(
        "CASE WHEN code = 39 THEN 38 ELSE code END AS code", "explode(sequence(0, 24)) AS t",
        "concat('item ', code) AS name")
    big = spark.createDataFrame([(i, None if i % 50 == 1 else 38 if i % 3 else i % 60, i % 26) for i in range(2000)],
                                "member_id long, code long, t int")
    plain = sorted(map(str, big.join(dim, ["code", "t"], "left").select("member_id", "code", "t", "name").collect()))
    joined = salted_keys_join(big, dim, ["code", "t"], ["member_id"], buckets=8)
    assert sorted(map(str, joined.select("member_id", "code", "t", "name").collect())) == plain
    top = top_n_pivot(big.withColumn("n", F.lit(1)), ["t", "member_id"], "code", "n", 1, ["C1"], dim=dim, dim_on=["t"],
                      value_names=["N1"])
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Broadcast" not in plan
