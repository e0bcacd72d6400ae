import os

from pyspark.sql import functions as F

from cohortkit.functions.text import fill, first_true, present, to_missing
from cohortkit.operators.ordering import positions
from cohortkit.operators.recode import dummies, level_table, levels
from cohortkit.operators.ordering import positions
from cohortkit.sources.sinks import batch_ids, read_bundle, write_bundle, write_table
from cohortkit.sources.tables import read_positional


def test_label_order(spark):
    df = spark.createDataFrame([(1, True, True), (2, False, None), (3, None, None), (4, None, True)],
                               "id int, white boolean, black boolean")
    got = {r.id: r.race for r in df.select("id", first_true([("white", "white"), ("black", "black")]).alias("race")).collect()}
    assert got == {1: "white", 2: None, 3: None, 4: "black"}


def test_device_zero(spark):
    df = spark.createDataFrame([("0",), (None,), ("iabp",)], "d string")
    out = df.select(F.upper(fill(to_missing("d", "0"), "none")).alias("dev"), present(to_missing("d", "0")).alias("mcs"))
    assert [tuple(r) for r in out.collect()] == [("NONE", False), ("NONE", False), ("IABP", True)]


def test_level_ties_and_dummies(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), ("None",), (None,)], "v string")
    assert levels(df, "v") == ["c", "None", "a", "b"]                  # frequency, ties by name
    assert levels(df, "v", first="None") == ["None", "c", "a", "b"]    # one level moved first
    assert levels(df, "v", by="alpha") == ["None", "a", "b", "c"]
    d = dummies(df, "v", ["None", "c", "a", "b"])
    assert d.columns == ["v_c", "v_a", "v_b"]                          # first level is the baseline
    assert d.filter(F.col("v_c").isNull()).count() == 1               # NULL stays NULL
    assert level_table(df, "v").count() == 4


def test_bundle_round_trip(spark, tmp_out):
    a = spark.range(5).withColumn("x", F.col("id") * 2)
    b = spark.createDataFrame([("f1", True)], "fin string, flag boolean")
    paths = write_bundle({"patients": a, "home meds": b}, tmp_out, compression="gzip")
    assert os.path.basename(paths["home meds"]) == "home_meds"
    back = read_bundle(spark, paths)
    assert sorted(back["patients"].collect()) == sorted(a.collect())
    assert back["home meds"].collect() == b.collect()


def test_positional_read(spark, tmp_out):
    src = spark.createDataFrame([("1", "x", "3.5"), ("2", "", "abc")], "A string, B string, C string")
    write_table(src, tmp_out, fmt="csv")
    df = read_positional(spark, tmp_out, [("id", "long"), ("name", "string"), ("val", "double")])
    rows = sorted(df.collect())
    assert df.columns == ["id", "name", "val"]
    assert rows[0].val == 3.5 and rows[1].name is None and rows[1].val is None


def test_global_numbering_and_batches(spark):
    df = spark.range(0, 1037).select((F.col("id") * 7 % 1037).alias("k"))
    rn = {r.k: r.rn for r in positions(df, ["k"]).collect()}
    assert rn == {k: k + 1 for k in range(1037)}
    pos = positions(df.withColumn("odd", (F.col("k") % 2).cast("long")), [F.col("k").desc()],
                    running={"n_odd": F.col("odd")})
    got = {r.k: (r.rn, r.n_odd) for r in pos.collect()}
    assert got[1036] == (1, 0) and got[0] == (1037, 518)
    b = batch_ids(df, "k", 40).orderBy("batch").collect()
    assert len(b) == 26 and all(r.n_ids <= 40 for r in b)
    assert b[0].ids.split(";")[:3] == ["0", "1", "2"]                 # numeric order kept
    assert sum(r.n_ids for r in b) == 1037


def test_published_bundle_is_whole_or_absent(spark, tmp_out):
    import pytest
    from cohortkit.sources.sinks import publish_bundle, read_published
    assert read_published(spark, tmp_out) == {}
    a, b = spark.range(3), spark.range(5).withColumnRenamed("id", "k")
    assert publish_bundle({"patients": a, "home meds": b}, tmp_out) == 1
    bad = spark.range(4).select(F.raise_error(F.lit("lost")).alias("k"))
    with pytest.raises(Exception):
        publish_bundle({"patients": spark.range(9), "home meds": bad}, tmp_out)
    got = read_published(spark, tmp_out)
    assert {n: d.count() for n, d in got.items()} == {"patients": 3, "home meds": 5}
    assert publish_bundle({"patients": spark.range(7)}, tmp_out, compression="gzip") == 2
    assert {n: d.count() for n, d in read_published(spark, tmp_out).items()} == {"patients": 7}


def test_topic_files_with_another_header_are_an_error(spark, tmp_out):
    import pytest
    from cohortkit.sources.tables import read_topic, schema_of
    schema = schema_of([("a", "string"), ("b", "string")])
    spark.createDataFrame([("1", "2")], "a string, b string").write.option("header", "true").csv(f"{tmp_out}/lab_one")
    assert [tuple(r) for r in read_topic(spark, tmp_out, "lab", schema).collect()] == [("1", "2")]
    spark.createDataFrame([("2", "1")], "b string, a string").write.option("header", "true").csv(f"{tmp_out}/lab_two")
    with pytest.raises(Exception):
        read_topic(spark, tmp_out, "lab", schema).collect()


def test_topic_files_are_read_by_name(spark, tmp_out):
    import pytest
    from cohortkit.sources.tables import read_topic_by_name, schema_of
    schema = schema_of([("id", "long"), ("name one", "string"), ("dose", "double")])

    def put(name, rows, cols):
        spark.createDataFrame(rows, cols).coalesce(1).write.option("header", "true").csv(f"{tmp_out}/{name}")
    put("lab_one", [("1", "x", "0.5"), ("2", "id,dose", None)], "id string, `name one` string, dose string")
    put("lab_two", [("7.5", "3", "y")], "dose string, id string, `name one` string")
    put("lab_three", [("q", "z", "4")], "other string, `name one` string, id string")
    put("note", [("9", "no")], "id string, `name one` string")
    got = sorted(tuple(r) for r in read_topic_by_name(spark, tmp_out, "lab", schema).collect())
    assert got == [(1, "x", 0.5), (2, "id,dose", None), (3, "y", 7.5), (4, "z", None)]
    assert read_topic_by_name(spark, tmp_out, "lab", schema).schema.names == schema.names
    put("lab_four", [("5",)], "other string")
    with pytest.raises(ValueError, match="no column"):
        read_topic_by_name(spark, tmp_out, "lab", schema)
