"""Masks, spec files, generated sets and order statistics."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import masks
from millrace.operators import eda, losses, overlap, prefix, stats
from millrace.plans import generation, reporting
from millrace.sources import archives, specs
from millrace.streaming import state_log

SF = "/root/testdata/sf0.001"


def flood(mask, diagonal):
    """Regions by brute force: sets of pixels."""
    left, found = set(zip(*np.nonzero(mask), strict=True)), []
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a or b) and (diagonal or not (a and b))]
    while left:
        todo, region = [left.pop()], set()
        while todo:
            y, x = todo.pop()
            region.add((y, x))
            near = {(y + a, x + b) for a, b in steps} & left
            left -= near
            todo += near
        found.append(frozenset(region))
    return set(found)


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("diagonal", [True, False])
def test_components(seed, diagonal):
    rng = np.random.default_rng(seed)
    mask = rng.random((rng.integers(1, 18), rng.integers(1, 18))) < rng.choice([0.2, 0.5, 0.7])
    labels = masks.components(mask, diagonal)
    got = {frozenset(zip(*np.nonzero(labels == n), strict=True)) for n in range(1, labels.max(initial=0) + 1)}
    assert got == flood(mask, diagonal) and not labels[~mask].any()
    large = {p for r in flood(mask, True) if len(r) >= 4 for p in r}
    assert set(zip(*np.nonzero(masks.remove_small(mask, 4)), strict=True)) == large


def test_mask_cleanup():
    ring = np.zeros((40, 40), bool)
    ring[5:25, 5:25] = True
    ring[10:15, 10:15] = False
    assert masks.fill_holes(ring)[5:25, 5:25].all() and masks.fill_holes(ring).sum() == 400
    noisy = ring.copy()
    noisy[30:38, 30:38] = True
    best = masks.best_region(noisy, (5, 5, 20, 20))
    assert (best == ring).all() and not masks.best_region(np.zeros((9, 9), bool), (0, 0, 9, 9)).any()
    noisy[0, 39] = True
    assert masks.cleaned(noisy, (5, 5, 20, 20)).sum() == 400
    square = np.zeros((9, 9), bool)
    square[2:7, 2:7] = True
    assert masks.erode(square).sum() == 9 and masks.dilate(square).sum() == 49
    assert masks.boundary(square).sum() == 16 and masks.boundary_iou(square, square) == 1.0
    assert masks.mask_iou(square, ~square) == 0.0 and masks.mask_iou(square & False, square & False) == 0.0


def test_cutouts():
    picture = np.zeros((30, 30, 4), np.uint8)
    picture[8:20, 6:22] = (100, 110, 120, 255)
    level = masks.white_balance(picture)[10, 10]
    assert list(level) == [108, 110, 110, 255]
    assert (masks.white_balance(picture[:9, :8]) == picture[:9, :8]).all()
    assert masks.trimmed(picture, 2).shape == (16, 20, 4) and masks.trimmed(picture * 0).shape == (30, 30, 4)
    assert masks.channel_stats(picture[8:20, 6:22, :3]) == {"mean": [100.0, 110.0, 120.0], "min": [100.0, 110.0, 120.0], "max": [100.0, 110.0, 120.0]}


def test_specs(spark, tmp_path):
    listed = specs.declared("/data")
    assert [s.split_source for s in specs.selected(listed, "train")] == ["train_single_raw"]
    assert len(specs.selected(listed, "validation")) == 2 and len(specs.selected(listed)) == 3
    assert specs.as_table(spark, listed).where("dataset_kind = 'combo'").first().archive_kind == "조합"
    with pytest.raises(Exception):
        specs.domain_profile(spark, f"{tmp_path}/none.json")
    assert specs.domain_profile(spark, f"{tmp_path}/none.json", required=False) == {}
    specs.write_report(spark, {"name": "알약", "n": 1}, f"{tmp_path}/report.json")
    assert (tmp_path / "report.json").read_text() == '{\n  "name": "알약",\n  "n": 1\n}\n'
    assert specs.domain_profile(spark, f"{tmp_path}/report.json")["n"] == 1
    schema = "asset_id string, product_id string"
    assert specs.asset_manifest(spark, f"{tmp_path}/none.csv", schema, required=False).count() == 0
    with pytest.raises(FileNotFoundError):
        specs.asset_manifest(spark, f"{tmp_path}/none.csv", schema)
    (tmp_path / "assets.csv").write_text("asset_id,product_id\na,\n")
    assert [tuple(r) for r in specs.asset_manifest(spark, f"{tmp_path}/assets.csv", schema).collect()] == [("a", "")]
    (tmp_path / "categories.json").write_text(json.dumps([{"id": 1}, {"id": 2}]))
    (tmp_path / "manifest.json").write_text(json.dumps({"images": [{"file": "x.png"}]}))
    assert [df.count() for df in specs.source_manifest(spark, f"{tmp_path}/categories.json", f"{tmp_path}/manifest.json", 2)] == [2, 1]
    with pytest.raises(ValueError):
        specs.source_manifest(spark, f"{tmp_path}/categories.json", f"{tmp_path}/manifest.json")


def test_generated_set(spark):
    found = reporting.generated_annotations(spark, SF).cache()
    rows = found.collect()
    combos = {r[0]: 2 + r[0] % 3 for r in spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey").collect()}
    per = {}
    for r in rows:
        per.setdefault(r.image_id, []).append(r)
    assert len(per) > 0.9 * len(combos) and all(len(v) == combos[k] for k, v in per.items())
    assert sorted(r.id for r in rows) == list(range(1, len(rows) + 1))
    assert all(len({r.product_id for r in v}) == len(v) for v in per.values())
    assert all(r.category_id == r.product_id + 100 and r.source_asset_id % 25 == r.product_id for r in rows)
    assert all(r.x >= 16 and r.y >= 16 and r.x + r.w <= 960 and r.y + r.h <= 1264 for r in rows)
    assert overlap.overlap_pairs(found, "image_id", "pos").count() == 0
    counts = [r["count"] for r in found.groupBy("product_id").count().collect()]
    assert max(counts) - min(counts) <= len(combos) - len(per) + 1


def test_generated_set_is_drawn_once(spark):
    """The annotations read the places that were stored: neither numbering nor failures lay the images out again."""
    plan = reporting.generated_annotations(spark, SF)._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "InPandas" not in plan


def test_no_layout_fails(spark):
    sizes = spark.createDataFrame([(1, 2), (2, 2)], "combo long, size int")
    classes = spark.createDataFrame([(0, 10, 0), (1, 11, 1)], "product_id int, category_id int, class_index int")
    bank = spark.createDataFrame([(5, 0, 1.0), (6, 1, 1.0)], "asset_id int, product_id int, aspect double")
    images, annotations, failed = generation.generate(sizes, classes, bank, [(0.05, 30.0), (0.95, 40.0)], 976, 1280, "s", rounds=2)
    assert images.count() == 0 and annotations.count() == 0 and sorted(r[0] for r in failed.collect()) == [1, 2]


@pytest.mark.parametrize("buckets", [1, 50])
def test_order_statistics(spark, monkeypatch, buckets):
    monkeypatch.setattr(prefix, "BUCKET_ROWS", buckets)
    rng = np.random.default_rng(3)
    rows = [("a", float(v)) for v in rng.integers(0, 40, 500)] + [("b", 7.5)] + [("c", None)] + [(None, float(v)) for v in range(10)] + [("hot", 3.0)] * 900
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    points = [0.0, 0.05, 0.5, 0.77, 1.0]
    got = {r.g: list(r.quantiles) for r in prefix.order_statistics(df, ["g"], "v", points).collect()}
    assert set(got) == {"a", "b", None, "hot"}
    for g, q in got.items():
        assert np.allclose(q, np.quantile([v for k, v in rows if k == g and v is not None], points))
    assert stats.quantiles(df.where("false"), ["g"], "v", points).count() == 0
    assert eda.outliers_iqr(df, "v", ["g"], clip=True).count() == len(rows)
    assert eda.outliers_iqr(df.union(spark.createDataFrame([(None, 99.0)], df.schema)), "v", ["g"]).where("g is null").collect()[0].v == 99.0
    assert eda.fill_value(df.where("g = 'c'"), "v").collect()[0].v is None
    totals = prefix.running_total(df.withColumn("one", F.lit(1)), "v", "one", [], "before", ["g"])
    assert totals.where("g is null").agg(F.max("before")).first()[0] == 9


def test_anomalies_and_losses(spark):
    df = spark.createDataFrame([("a", 1.0)] * 30 + [("a", 50.0), ("b", 2.0)], "g string, e double")
    assert [r.e for r in losses.anomalies(df, "e", ["g"]).collect()] == [50.0]
    assert [r.e for r in losses.anomalies(df, "e", []).collect()] == [50.0]
    sure = spark.createDataFrame([("x", 1.0, 1), ("x", 0.0, 0), ("y", 0.0, 0), ("y", None, 1)], "g string, p double, y int")
    got = {r.g: r for r in losses.losses(sure, ["g"], "p", "y").collect()}
    assert got["x"].tversky == 0.0 and got["y"].tversky == 0.0 and got["x"].weighted < 1e-6


def test_object_documents_are_stored(spark, tmp_path):
    c = F.col
    docs = reporting.object_documents(spark, SF).where("content like '%\"image_id\":1}%'")
    want = {r.file: r.content for r in docs.collect()}
    archives.write_files(docs, f"{tmp_path}/out")
    got = {str(p.relative_to(tmp_path / "out")): p.read_text() for p in (tmp_path / "out").rglob("*.json")}
    assert got == want and want
    assert not [p for p in (tmp_path / "out").rglob("*") if p.name.startswith(".") and not p.name.endswith(".crc")]
    with pytest.raises(Exception):
        archives.write_files(docs, f"{tmp_path}/out")
    twice = docs.groupBy("file").agg(F.first(c("content")).alias("content"))
    archives.write_files(twice, f"{tmp_path}/out", overwrite=True)


def test_sets_run_once(spark, tmp_path):
    calls, path = [], f"{tmp_path}/log"
    requested = spark.createDataFrame([(3,), (1,), (2,)], "set_id int")

    def build(set_id):
        calls.append(("build", set_id))

    def check(set_id):
        calls.append(("check", set_id))
        if set_id == 2 and calls.count(("check", 2)) == 1:
            raise ValueError("broken")

    steps = {"built": build, "validated": check}
    with pytest.raises(ValueError):
        state_log.run_sets(spark, requested, path, steps)
    assert state_log.run_sets(spark, requested, path, steps) == [2, 3]
    assert state_log.run_sets(spark, requested, path, steps) == []
    assert [i for name, i in calls if name == "check"] == [1, 2, 2, 3]
    assert state_log.read(spark, path).where("event = 'failed'").count() == 1


def test_commands(spark, tmp_path):
    from millrace import __main__ as cli

    cli.main(["sources", "/data", f"{tmp_path}/sources", "--include", "validation"])
    assert spark.read.json(f"{tmp_path}/sources").count() == 2
    spark.createDataFrame([(i, 2) for i in range(6)], "combo long, size int").write.parquet(f"{tmp_path}/sizes")
    spark.createDataFrame([(i, i + 10, i) for i in range(3)], "product_id int, category_id int, class_index int").write.parquet(f"{tmp_path}/classes")
    spark.createDataFrame([(i, i % 3, 1.0) for i in range(9)], "asset_id int, product_id int, aspect double").write.parquet(f"{tmp_path}/bank")
    specs.write_report(spark, {"bbox_side_px_pct": {"0.05": 180.0, "0.5": 230.0, "0.95": 300.0}}, f"{tmp_path}/profile.json")
    cli.main(["generate", *[f"{tmp_path}/{n}" for n in ("sizes", "classes", "bank")], f"{tmp_path}/profile.json", f"{tmp_path}/made"])
    assert spark.read.parquet(f"{tmp_path}/made/annotations").count() == 12
    box = {"category_id": 10, "class_index": 0, "product_id": "a", "bbox": [1.0, 2.0, 30.0, 40.0]}
    coco = {"images": [{"id": 1, "width": 100, "height": 100, "combo_size": 2}], "annotations": [{"id": 1, "image_id": 1} | box, {"id": 2, "image_id": 1} | box | {"category_id": 1}], "categories": []}
    (tmp_path / "coco.json").write_text(json.dumps(coco))
    (tmp_path / "classes.csv").write_text("product_id,category_id,class_index\na,10,0\nb,11,1\n")
    cli.main(["coco-report", f"{tmp_path}/coco.json", f"{tmp_path}/classes.csv", f"{tmp_path}/report.json"])
    found = {r["rule"]: r["violations"] for r in json.loads((tmp_path / "report.json").read_text())["rules"]}
    assert found == {"unknown_product": 0, "forbidden_category": 1, "category_mismatch": 1, "class_index_mismatch": 0, "box": 0, "combo_size": 0, "duplicate_product": 1, "overlap": 1, "unused_class": 1, "below_floor": 0}
