import json

from pyspark.sql import functions as F

from quorumlake.sources import readers as R
from quorumlake.sources import sinks as K
from quorumlake.streaming import events as E


def test_csv(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text('na,candidate_name,party,votes,rank\nNA-1,"A, B",P,,1\nNA-1,C,,12,2\n')
    rows = R.csv(spark, str(p), R.CANDIDATE).collect()
    assert [(r.candidate_name, r.party, r.votes) for r in rows] == [("A, B", "P", None), ("C", None, 12)]
    raw = R.csv_rows(spark, str(p))
    assert [r.votes for r in raw.orderBy("pos").collect()] == [None, "12"]
    a = R.aliased(raw, {"seat": ["na"], "gone": ["x"]}).first()
    assert (a.seat, a.gone) == ("NA-1", None)
    K.write_csv(raw.select("na", "rank"), str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 2


def test_json_and_geojson(spark, tmp_path):
    p = tmp_path / "j.json"
    p.write_text(json.dumps({"1990": {"NA-1": {"wp": "P"}, "NA-2": None}}))
    rows = {(r.year, r.na): r.value for r in R.json_by_key(spark, str(p), "struct<wp:string>").collect()}
    assert rows["1990", "NA-1"].wp == "P" and rows["1990", "NA-2"] is None
    g = tmp_path / "g.geojson"
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    g.write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"na": "NA-1"}, "geometry": {"type": "Polygon", "coordinates": [ring]}},
        {"type": "Feature", "properties": {"na": "NA-2"}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}}]}))
    got = {r.properties["na"]: len(r.polygons) for r in R.geojson(spark, str(g)).collect()}
    assert got == {"NA-1": 1, "NA-2": 2}
    text = spark.createDataFrame([('<x>\nconst D = {"a": 1};\n</x>',)], "t string")
    assert text.select(R.embedded_json(F.col("t"), "const D", "struct<a:int>").alias("v")).first().v.a == 1


def test_pages(spark, tmp_path):
    (tmp_path / "1.txt").write_bytes("é".encode())
    (tmp_path / "3.txt").write_bytes(b"\xe9")
    (tmp_path / "4.txt").write_bytes(b"\x96\xe9")
    (tmp_path / "5.txt").write_bytes(b"\x81\x96")
    p = R.pages(spark, str(tmp_path))
    assert {r.number: r.text for r in p.collect()} == {1: "é", 3: "é", 4: "–é", 5: "\x81\x96"}
    assert [r.number for r in R.missing_pages(p, 3).collect()] == [2]


def test_small_sources(spark):
    lit = R.literal(spark, "a;1 | b; |", ["x", "y"]).orderBy("pos").collect()
    assert [(r.x, r.y) for r in lit] == [("a", "1"), ("b", None)]
    cache = spark.createDataFrame([("k1", None)], "key string, v string")
    hit, todo = R.memo(cache, spark.createDataFrame([("k1",), ("k2",)], "key string"), "key")
    assert hit.count() == 1 and todo.first().key == "k2"
    d = spark.createDataFrame([("10/6/93",), ("1993-10-06",), ("x",)], "s string").select(R.poll_date(F.col("s")).alias("d")).collect()
    assert d[0].d == d[1].d and d[2].d is None
    last = R.last_file_wins(spark.createDataFrame([("a", "f1", 1), ("a", "f2", 2)], "k string, path string, v int"), ["k"])
    assert last.first().v == 2
    assert {r.year: r.period_no for r in R.calendar(spark, [1993, 1977, 1985]).collect()} == {1977: 1, 1985: 2, 1993: 3}


def test_sinks(spark, tmp_path):
    layer = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, v string, w int")
    new = spark.createDataFrame([(1, None), (9, "z")], "k int, v string")
    assert {(r.k, r.v, r.w) for r in K.upsert(layer, new, "k").collect()} == {(1, None, 5), (2, "b", 6)}
    doc = K.nested(layer.withColumn("y", F.lit("t")), "y", "k", ["v"]).first()
    assert doc.document[2].v == "b"
    K.write_json(layer, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    ring = F.array(F.array(F.struct(F.lit(1.23456).alias("x"), F.lit(2.0).alias("y"))))
    f = json.loads(layer.select(K.feature(["k"], ring).alias("f")).first().f)
    assert f["geometry"]["coordinates"] == [[[1.2346, 2.0], [1.2346, 2.0]]] and f["properties"] == {"k": 1}
    K.write_json(layer.coalesce(1), str(tmp_path / "indented"), indented=True)
    text = "".join(p.read_text() for p in (tmp_path / "indented").glob("part*"))
    assert len(json.loads(text)) == 2 and text.count("\n") > 4


def test_streaming_counts(spark, tmp_path):
    src = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = E.tumbling(E.read(spark, str(tmp_path / "in"), 1), "1 day", "3650 days")
    q = stream.writeStream.format("memory").queryName("counts").outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.table("counts").groupBy("start", "event_type").agg(F.max("n").alias("n"))
    assert got.exceptAll(E.tumbling(src, "1 day")).count() == 0 and got.count() > 0
