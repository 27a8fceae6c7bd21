from leadwright.operators.joins import left_join_many


def test_equals_a_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, l string")
    right = spark.createDataFrame([(1, 10), (1, 11), (3, 12), (None, 13)], "k int, r int")
    got = left_join_many(left, right, ["k"]).select("k", "l", "r").collect()
    want = left.join(right, "k", "left").select("k", "l", "r").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
