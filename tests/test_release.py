"""Releases, extracted archives, specs."""

import csv
import hashlib
import io
import json
import tarfile
import zipfile

import pytest

from millrace.sources import release


def test_package(spark, tmp_path):
    run = tmp_path / "run"
    (run / "images").mkdir(parents=True)
    (run / "audit").mkdir()
    (run / "audit/a b.jpg").write_bytes(b"sheet")
    images = [{"id": k, "file_name": f"im {k:03d}.jpg", "width": 4} for k in range(1, 6)]
    for i in images:
        (run / "images" / i["file_name"]).write_bytes(b"jpg%d" % i["id"])
    marks = [{"id": 10 * k + j, "image_id": k, "category_id": 7 + j, "bbox": [1, 2, 3, 4]} for k in range(1, 5) for j in (1, 0)]
    document = {"images": images[::-1], "annotations": marks, "categories": [{"id": 7, "name": "a"}, {"id": 8, "name": "b"}]}
    (run / "annotations_coco.json").write_text(json.dumps(document))
    (run / "summary.json").write_text("{}")
    out = tmp_path / "release"
    got = release.package(spark, str(run), str(out), "set", size=2)
    assert got == {"release": str(out), "webdataset_shards": 3, "images": 5, "annotations": 8}
    assert json.loads((out / "coco/annotations_coco.json").read_text()) == document
    assert (out / "coco/images/im 003.jpg").read_bytes() == b"jpg3" and (out / "reports/audit/a b.jpg").read_bytes() == b"sheet" and (out / "reports/summary.json").exists()
    assert not (out / "reports/validation_report.json").exists() and json.loads((out / "dataset_info.json").read_text())["classes"] == 2
    rows = list(csv.DictReader((out / "webdataset/shards_manifest.csv").open(newline="")))
    assert [(r["shard"], r["samples"], r["annotations"]) for r in rows] == [(f"webdataset/train/set-{k:06d}.tar", n, a) for k, n, a in ((0, "2", "4"), (1, "2", "4"), (2, "1", "0"))]
    for r in rows:
        content = (out / r["shard"]).read_bytes()
        assert (r["sha256"], int(r["bytes"])) == (hashlib.sha256(content).hexdigest(), len(content))
    with tarfile.open(fileobj=io.BytesIO((out / "webdataset/train/set-000000.tar").read_bytes())) as t:
        assert t.getnames() == ["im 001.jpg", "im 001.json", "im 002.jpg", "im 002.json"]
        sample = json.load(t.extractfile("im 002.json"))
    assert sample["__key__"] == "im 002" and sample["image"]["id"] == 2 and [a["id"] for a in sample["annotations"]] == [20, 21] and [c["id"] for c in sample["categories"]] == [7, 8] and sample["dataset"] == "set"
    with pytest.raises(FileExistsError):
        release.package(spark, str(run), str(out), "set")
    (run / "images/im 005.jpg").unlink()
    with pytest.raises(FileNotFoundError):
        release.package(spark, str(run), str(out), "set", overwrite=True)


def test_extract(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        release.extract_archive(spark, f"{tmp_path}/none.zip", f"{tmp_path}/spec", "in")
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("in/x.txt", "one")
    for _ in range(2):
        assert release.extract_archive(spark, f"{tmp_path}/a.zip", f"{tmp_path}/spec", "in") == f"{tmp_path}/spec/in"
    assert (tmp_path / "spec/in/x.txt").read_text() == "one"
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("../x.txt", "one")
    with pytest.raises(ValueError):
        release.extract_archive(spark, f"{tmp_path}/b.zip", f"{tmp_path}/other", "in")


def test_spec(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"categories": [{"id": 9, "product_id": "K-2", "name": 'b, "x"'}, {"id": 5, "product_id": "K-1", "name": ""}]}))
    document = spark.read.option("multiLine", True).json(f"{tmp_path}/c.json")
    metadata = spark.createDataFrame([("K-1", "first", "red", "blue"), ("K-3", "z", "", None)], "product_id string, dl_name string, color_class1 string, color_class2 string")
    with pytest.raises(ValueError):
        release.class_rows(document, metadata)
    release.write_spec(spark, f"{tmp_path}/spec", release.class_rows(document, metadata, 2), {"note": "n"})
    rows = list(csv.DictReader((tmp_path / "spec/class_map.csv").open(newline="")))
    assert [(r["class_index"], r["category_id"], r["K_code"], r["product_name"], r["color"], r["shape"]) for r in rows] == [("0", "9", "K-2", 'b, "x"', "", ""), ("1", "5", "K-1", "first", "red|blue", "")]
    assert [r["K_code"] for r in json.loads((tmp_path / "spec/class_map.json").read_text())] == ["K-2", "K-1"]
    assert json.loads((tmp_path / "spec/domain_profile.json").read_text())["resolution_WxH"] == [976, 1280]
    assert json.loads((tmp_path / "spec/refs/reconstruction_sources.json").read_text()) == {"note": "n", "class_rows": 2}


def test_observed(spark):
    df, seen = release.observed(spark.range(12), "progress")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 12
