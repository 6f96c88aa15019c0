import os

from murmurlake.session import clear_cuts, cut, cut_folder, shared_dir


def test_cuts_are_tables_that_can_be_cleared(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    back = cut(df, "probe")
    assert back.schema == df.schema and sorted(map(tuple, back.collect())) == [(1, None), (2, "x")]
    assert cut(df.limit(0), "probe").count() == 0
    own, shared = (p.removeprefix("file://") for p in (cut_folder(spark), shared_dir(spark)))
    other = f"{shared}/murmurlake/another-application"
    os.makedirs(other, exist_ok=True)
    clear_cuts(spark)
    assert os.path.exists(other) and not os.path.exists(own)
    os.rmdir(other)


def test_a_round_that_is_replaced_is_deleted(spark):
    first = cut(spark.range(3), "round")
    folder = os.path.dirname(first.inputFiles()[0].removeprefix("file://"))
    second = cut(first.selectExpr("id + 1 AS id"), "round", replaces=first)
    assert not os.path.exists(folder) and [r[0] for r in second.orderBy("id").collect()] == [1, 2, 3]
