"""The curation workflow from archives to shards."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace import __main__ as cli
from millrace.plans import workflow
from millrace.sources import archives


def label(box, width=100, height=100):
    return json.dumps({"images": [{"width": width, "height": height, "drug_shape": "round"}], "annotations": [{"bbox": box, "area": 1.0}], "categories": []})


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    root = tmp_path_factory.mktemp("zips")
    (root / "i").mkdir()
    (root / "l").mkdir()
    images = {f"K-00000{k}_{n}": b"png" for k in (1, 2) for n in range(3)} | {"K-000003_0": b"png"}
    texts = {s: label([1, 2, 30, 40]) for s in images if s != "K-000003_0"} | {"K-000009_0": label([0, 0, 1, 1])}
    texts["K-000001_0"] = label([90, 0, 50, 10])
    texts["K-000001_1"] = "{broken"
    with zipfile.ZipFile(root / "i/TS_1_x.zip", "w") as z:
        for s, b in images.items():
            z.writestr(f"a/{s}.png", b)
    with zipfile.ZipFile(root / "l/TL_1_x.zip", "w") as z:
        for s, t in texts.items():
            z.writestr(f"b/{s}.json", t)
    return root


def test_inventory(spark, folders):
    rows, unmatched, summary = workflow.inventory(spark, f"{folders}/i", f"{folders}/l", "TS", "TL", "x")
    faults = {r.stem: r.fault for r in rows.collect()}
    assert faults["K-000001_0"] == "out_of_bounds" and faults["K-000001_1"] == "invalid_json" and faults["K-000002_0"] is None and len(faults) == 6
    assert sorted((r.stem, r.side) for r in unmatched.collect()) == [("K-000003_0", "image_only"), ("K-000009_0", "label_only")]
    s = summary.first()
    assert (s.paired, s.image_only, s.label_only, s.invalid, s.status) == (6, 1, 1, 2, "invalid_labels")


def test_manifest_to_shards(spark, folders, tmp_path):
    rows, _, _ = workflow.inventory(spark, f"{folders}/i", f"{folders}/l", "TS", "TL", "x")
    texts = workflow._members(spark, f"{folders}/l", "TL", "x", ".json").select("set_id", "member", F.col("content").cast("string").alias("text"))
    manifest = workflow.canonical_manifest(rows.where("fault is null or fault <> 'invalid_json'"), texts, "train", "single", "TS_1_x.zip")
    got = {r.original_stem: r for r in manifest.collect()}
    assert got["K-000002_1"].product_id == "K-000002" and got["K-000002_1"].annotations[0].bbox == [1, 2, 30, 40] and got["K-000002_1"].shape == "round"
    assert got["K-000001_0"].annotations == [] and got["K-000001_0"].invalid_label_members == ["b/K-000001_0.json"]
    whole, plan = workflow.split_manifest(manifest, least=1, most=2)
    assert {(r["class"], r.train_count, r.val_count, r.class_index) for r in plan.collect()} == {("K-000001", 1, 1, 0), ("K-000002", 2, 1, 1)}
    report = {r.rule: r.violations for r in workflow.validate_manifest(manifest).collect()}
    assert report == {"missing_product": 0, "no_valid_box": 1, "combo_size": 0, "dropped_boxes": 1, "overlap": 0}
    images = manifest.select("sample_id", F.lit(b"jpg").alias("content"))
    built = workflow.pack_manifest(whole, images, 2).cache()
    assert sorted((r.file, r.samples) for r in built.collect()) == [("train_seen-000000.tar", 2), ("train_seen-000001.tar", 1), ("val_seen_id-000000.tar", 2)]
    archives.write_files(built, f"{tmp_path}/shards")
    members = archives.tar_members(spark, f"{tmp_path}/shards")
    assert members.count() == 10 and workflow.shard_issues(members).count() == 0
    assert workflow.shard_issues(members.where("suffix = '.jpg'")).count() == 5


def test_merge_parts(spark):
    df = spark.createDataFrame([("a", 0, "f"), ("a", 1, "f"), ("b", 0, "f")], "part string, shard int, file string")
    assert sorted(r.file for r in workflow.merge_parts(df, "part", "shard", "file").collect()) == [f"shard-00000{k}.tar" for k in range(3)]


def test_command_line(spark, folders, tmp_path):
    cli.main(["inventory", f"{folders}/i", f"{folders}/l", f"{tmp_path}/out", "--kind", "x"])
    assert spark.read.parquet(f"{tmp_path}/out/paired").count() == 6
    with pytest.raises(SystemExit):
        cli.main(["nothing"])
