"""Sources and sinks: what is written is read back."""

import hashlib
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.sources import archives, delimited
from millrace.streaming import state_log


def test_delimited(spark, tmp_path):
    cell = '{"a": "x, y", "b": ["1"]}'
    df = spark.createDataFrame([(1, cell, ""), (2, 'say "hi"\nthere', None)], "id int, json string, note string")
    delimited.write_rows(df.withColumn("extra", F.lit(1)), f"{tmp_path}/t", ["id", "json", "note", "absent"])
    got = delimited.read_rows(spark, f"{tmp_path}/t", "id int, json string, note string, absent string")
    assert sorted(tuple(r) for r in got.collect()) == [(1, cell, "", ""), (2, 'say "hi"\nthere', "", "")]
    assert delimited.union_existing(spark, [f"{tmp_path}/t", f"{tmp_path}/none"]).count() == 2
    (tmp_path / "list").write_text(" a \n\nb\na\n")
    assert sorted(r.item for r in delimited.newline_list(spark, f"{tmp_path}/list").collect()) == ["a", "b"]
    (tmp_path / "blank").write_text("\n \n")
    with pytest.raises(ValueError):
        delimited.newline_list(spark, f"{tmp_path}/blank")


def test_cells_keep_their_white_space(spark, tmp_path):
    cells = [" a ", "a\r\nb\rc\n", '\\"x\\', '"', "\t,;", "\\", "#c", "\u00a0x\u0000", " ", "\n"]
    for sep in (",", "\t"):
        df = spark.createDataFrame(list(enumerate(cells)), "id int, cell string")
        delimited.write_rows(df, f"{tmp_path}/cells", ["id", "cell"], sep)
        assert [r.cell for r in delimited.read_rows(spark, f"{tmp_path}/cells", "id int, cell string", sep).orderBy("id").collect()] == cells


def test_class_map(spark, tmp_path):
    (tmp_path / "ok.csv").write_text("class_index,category_id\n0,5\n1,7\n")
    assert delimited.class_map(spark, f"{tmp_path}/ok.csv", 2).count() == 2
    (tmp_path / "bad.csv").write_text("class_index,category_id\n0,5\n1,5\n")
    with pytest.raises(ValueError):
        delimited.class_map(spark, f"{tmp_path}/bad.csv", 2)


def test_documents_and_coco(spark, tmp_path):
    (tmp_path / "d/e").mkdir(parents=True)
    (tmp_path / "d/e/x.json").write_text('{"images": [{"id": 1}], "annotations": [{"id": 2, "image_id": 1}], "categories": [{"id": 3}]}')
    assert delimited.read_documents(spark, f"{tmp_path}/d").select(F.col("images")[0]["id"]).first()[0] == 1
    assert [t.count() for t in delimited.coco(spark, f"{tmp_path}/d/e/x.json")] == [1, 1, 1]


def test_zip(spark, tmp_path):
    for n in (1, 2):
        with zipfile.ZipFile(tmp_path / f"TS_{n}_x.zip", "w") as z:
            z.writestr("dir/a.PNG", b"img%d" % n)
            z.writestr("dir/a.json", b"{}")
            z.mkdir("empty")
    members = archives.zip_members(spark, f"{tmp_path}/*.zip", (".png",))
    assert sorted((r.member, r.stem, bytes(r.content)) for r in members.collect()) == [("dir/a.PNG", "a", b"img1"), ("dir/a.PNG", "a", b"img2")]
    sets = archives.archive_sets(spark, str(tmp_path), "TS", "x")
    assert sorted(r.set_id for r in sets.collect()) == [1, 2]
    wanted = spark.createDataFrame([(2,), (3,)], "set_id int")
    assert [r.path.rsplit("/", 1)[1] for r in archives.resolved(wanted, sets, "/z/TS_%d_x.zip").orderBy("set_id").collect()] == ["TS_2_x.zip", "TS_3_x.zip"]


def test_shards_round_trip(spark, tmp_path):
    data = [(f"s-{k // 3:06d}.tar", f"k{k}", b"img%d" % k, f'{{"n":{k}}}') for k in range(8)]
    df = spark.createDataFrame(data, "file string, key string, image binary, label string")
    built = archives.tar_shards(df, "file", "key", "image", "label").cache()
    archives.write_files(built, f"{tmp_path}/out")
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["s-000000.tar", "s-000001.tar", "s-000002.tar"]
    for r in built.collect():
        content = (tmp_path / "out" / r.file).read_bytes()
        assert (hashlib.sha256(content).hexdigest(), len(content)) == (r.sha256, r.bytes)
    back = archives.samples(archives.tar_members(spark, f"{tmp_path}/out"))
    assert sorted((r.key, bytes(r.image), r.label) for r in back.collect()) == sorted((k, i, x) for _, k, i, x in data)
    with pytest.raises(Exception, match="exists already"):
        archives.write_files(built, f"{tmp_path}/out")
    archives.write_files(built, f"{tmp_path}/out", overwrite=True)


def test_state_log(spark, tmp_path):
    path = f"{tmp_path}/log"
    events = spark.createDataFrame([("started", 1), ("validated", 1), ("started", 2)], "event string, set_id int")
    for i in range(3):
        state_log.append(events.limit(3).where(F.col("event") != "x").withColumn("ts", F.timestamp_seconds(F.lit(100 + i))), path)
    log = state_log.read(spark, path)
    assert log.count() == 9 and state_log.event_counts(log).agg(F.sum("n")).first()[0] == 9
    assert [r.set_id for r in state_log.pending(spark.createDataFrame([(1,), (2,)], "set_id int"), log).collect()] == [2]
    query = state_log.event_counts(state_log.stream(spark, path)).writeStream.format("memory").queryName("counts").outputMode("complete").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert spark.table("counts").agg(F.sum("n")).first()[0] == 9
