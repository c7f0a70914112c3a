"""Micro-fixtures of the operators' edge cases."""

import heapq
import json

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions import geometry, images, numbers, paths
from millrace.functions.geometry import Box
from millrace.operators import assets, detection, eda, labels, overlap, pairing, sampling, schedule, shards, split, stats, text, validate
from millrace.operators.prefix import running_total


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def test_pairing(spark):
    images_ = spark.createDataFrame([(1, s) for s in "abc"], "set_id int, stem string")
    labels_ = spark.createDataFrame([(1, "b", "z1", 1), (1, "c", "z2", 2), (1, "d", "z3", 3), (1, "c", "z0", 4)], "set_id int, stem string, m string, o int")
    groups = pairing.label_groups(labels_, ["set_id", "stem"], "m", "o")
    assert rows(groups.select("stem", "label_member", "duplicates")) == [("b", "z1", 0), ("c", "z2", 1), ("d", "z3", 0)]
    assert rows(pairing.paired(images_, groups, ["set_id", "stem"]).select("stem")) == [("b",), ("c",)]
    assert rows(pairing.unmatched(images_, labels_, ["set_id", "stem"]).select("stem", "side")) == [("a", "image_only"), ("d", "label_only")]
    status = lambda i, k, bad=None: pairing.set_status(i, k, "set_id", "stem", bad).first()["status"]
    assert status(images_, labels_) == "paired_with_unmatched"
    assert status(images_, images_) == "perfect" and status(images_, images_, images_) == "invalid_labels"
    assert status(images_.limit(0), labels_) == "label_only_set" and status(images_, labels_.limit(0)) == "source_only_set"


@pytest.mark.parametrize(("n", "quota"), [(1, 24), (24, 24), (25, 24), (240, 24), (245, 24), (255, 26), (1280, 128), (5000, 128)])
def test_quota(spark, n, quota):
    assert value(spark, numbers.clamped_quota(F.lit(n))) == quota


def test_split(spark):
    sizes = {"a": 1, "b": 24, "c": 25, "d": 300, None: 40}
    df = spark.createDataFrame([(c, f"{c}{i}") for c, n in sizes.items() for i in range(n)], "cls string, id string")
    got = {(r.cls, r.split): r.n for r in split.stable_split(df, "cls", "id").groupBy("cls", "split").agg(F.count("*").alias("n")).collect()}
    assert got == {("a", "val_seen_id"): 1, ("b", "val_seen_id"): 24, ("c", "val_seen_id"): 24, ("c", "train_seen"): 1, ("d", "val_seen_id"): 30, ("d", "train_seen"): 270, (None, "val_seen_id"): 24, (None, "train_seen"): 16}


def test_weights(spark):
    assert value(spark, numbers.effective_weight(F.lit(1))) == pytest.approx(1.0)
    assert value(spark, numbers.effective_weight(F.lit(432))) == pytest.approx(0.00236505907894754)
    assert value(spark, numbers.effective_weight(F.lit(0))) == 0


@pytest.mark.parametrize(("a", "b", "iou"), [((0, 0, 10, 10), (5, 5, 10, 10), 25 / 175), ((0, 0, 10, 10), (10, 0, 10, 10), 0), ((1, 2, 3, 4), (1, 2, 3, 4), 1), ((0, 0, 0, 0), (0, 0, 0, 0), 0)])
def test_iou(spark, a, b, iou):
    p, q = (Box(*[F.lit(v) for v in box]) for box in (a, b))
    assert value(spark, p.iou(q)) == pytest.approx(iou)


def test_box_faults(spark):
    box = lambda *v: Box(*[F.lit(x) for x in v])
    w, h = F.lit(100), F.lit(100)
    partly = box(-5, 10, 20, 20)
    assert value(spark, partly.strict(w, h)) is False and value(spark, partly.loose(w, h)) is True
    codes = [value(spark, b.error_code(x, h)) for b, x in ((partly, w), (box(0, 0, 0, 5), w), (box(90, 0, 20, 5), w), (box(0, 0, 5, 5), F.lit(0)), (box(None, 0, 5, 5), w), (box(0, 0, 5, 5), w))]
    assert codes == ["non_positive", "non_positive", "out_of_bounds", "invalid_dimensions", "invalid_bbox", None]
    assert value(spark, geometry.bilinear(F.lit(0.0), F.lit(1.0), F.lit(2.0), F.lit(3.0), F.lit(0.5), F.lit(0.5))) == 1.5


def test_overlap_counts(spark):
    boxes = spark.createDataFrame([(1, 1, 0, 0, 10, 10), (1, 2, 2, 2, 10, 10), (1, 3, 4, 4, 10, 10), (2, 1, 0, 0, 5, 5), (2, 2, 50, 50, 5, 5)], "image int, pos int, x int, y int, w int, h int")
    assert rows(overlap.failures(overlap.overlap_pairs(boxes, "image", "pos"), "image")) == [(1, 3, 2)]
    assert rows(overlap.nested_overlaps(boxes, "image", "pos")) == [(1, 2)]
    kept = overlap.non_maximum_suppression(boxes.withColumn("s", F.col("pos")), ["image"], "s", "pos", 1, 10)
    assert rows(kept) == [(1, 3), (2, 1), (2, 2)] or rows(kept) == [(1, 1), (1, 3), (2, 1), (2, 2)]


def test_codes(spark):
    codes = lambda s: value(spark, paths.combo_codes(F.lit(s)))
    assert codes("x/K-001900-002483-003351_0_2_0_2.png") == ["K-001900", "K-002483", "K-003351"]
    assert codes("a_K-000001b.png") == ["K-000001"] and codes("none.png") == []
    assert value(spark, paths.first_code(F.lit(""), F.lit("x/K-001900/y.json"))) == "K-001900" and value(spark, paths.first_code(F.lit("K-12"))) == ""
    assert value(spark, paths.tar_key(F.lit("a/b  한글c"))) == "a_b_c"
    assert [value(spark, paths.stem(F.lit(p))) for p in ("a/b.tar.gz", ".hidden", "x")] == ["b.tar", ".hidden", "x"]


def test_schedule_equals_the_heap(spark):
    products, sizes = [f"p{i}" for i in range(5)], [2, 3, 4, 4, 2, 3, 2]
    heap, want = [(0, p) for p in products], []
    for size in sizes:
        taken = [heapq.heappop(heap) for _ in range(size)]
        want.append([p for _, p in taken])
        for n, p in taken:
            heapq.heappush(heap, (n + 1, p))
    combos = spark.createDataFrame(list(enumerate(sizes)), "combo int, size int")
    got = schedule.balanced_schedule(combos, "combo", "size", spark.createDataFrame([(p,) for p in products], "p string"), "p")
    by = {}
    for combo, slot, p in rows(got):
        by.setdefault(combo, []).append((slot, p))
    assert [[p for _, p in sorted(by[i])] for i in range(len(sizes))] == want


def test_deficit_balance(spark):
    sizes = spark.createDataFrame([(i, 2) for i in range(30)], "c int, s int")
    products = spark.createDataFrame([("a", 0), ("b", 5), ("c", 50)], "p string, n int")
    counts = {r.product: r["count"] for r in schedule.deficit_balanced(sizes, "c", "s", products, "p", "n", 1, floor=4).groupBy("product").count().collect()}
    assert sum(counts.values()) == 60 and counts["c"] >= 4 and counts["a"] >= counts["b"] >= counts["c"]


def test_hard_mix_over_all_rows(spark):
    import collections
    import hashlib

    from millrace import catalog

    sf = "/root/testdata/sf0.001"
    part = sorted((r.p_partkey, r.p_brand, r.p_size) for r in spark.read.parquet(f"{sf}/part.parquet").collect())
    orders = [r[0] for r in spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey").collect()]
    groups = collections.defaultdict(list)
    for p, g, _ in part:
        groups[g].append(p)
    size = {p: s for p, _, s in part}

    def sha(*parts):
        return hashlib.sha1("|".join(map(str, parts)).encode()).hexdigest()

    want = []
    for o in orders:
        anchor, g, _ = part[o % len(part)]
        others, chosen = [p for p in groups[g] if p != anchor], []
        for top in range(max(0, len(others) - 16), len(others)):
            at = int(sha("hm", o, top)[:13], 16) % (top + 1)
            chosen.append(top if at in chosen else at)
        best = sorted((size[others[i]], sha("hm", o, others[i])[:16], others[i]) for i in chosen)[:3]
        want += [(o, anchor, p, n) for n, (*_, p) in enumerate(best, 1)]
    assert rows(catalog.queries()["hard_mix"](spark, sf)) == sorted(want)
    assert {a for _, a, *_ in want} == {p for p, g, _ in part if len(groups[g]) > 1}

    # Every other product of a larger group is drawn about equally often.
    products = spark.createDataFrame([(i * 3, "g", 0) for i in range(40)] + [(1000, "alone", 0), (1001, None, 0)], "p long, g string, used int")
    anchors = spark.createDataFrame([(c, 30) for c in range(3000)] + [(5000, 1000), (5001, 1001)], "c long, p long")
    got = schedule.hard_mix(anchors, "c", products, "p", "g", "used", "t", k=16).groupBy("partner").count().collect()
    assert {r.partner for r in got} == {i * 3 for i in range(40)} - {30}
    assert sum(r["count"] for r in got) == 16 * 3000 and all(abs(r["count"] - 3000 * 16 / 39) < 140 for r in got)


def test_top_k_in_blocks(spark, monkeypatch):
    from millrace.operators import retrieval

    items = spark.createDataFrame([(i, [float((i * 7 + j * j) % 11 - 5) for j in range(6)]) for i in range(60)], "id long, v array<float>")
    queries = items.where("id % 2 = 0")
    whole = rows(retrieval.top_k(queries, items, "id", "v", 5))
    assert len(whole) == 30 * 5
    monkeypatch.setattr(retrieval, "BROADCAST_ROWS", 7)
    blocks = retrieval.top_k(queries, items, "id", "v", 5)
    assert rows(blocks) == whole
    assert "CartesianProduct" in blocks._jdf.queryExecution().toString()


def test_top_k_of_many_rows(spark):
    """Twenty million pairs, which took minutes when every pair was a row; against brute force."""
    import time

    from millrace.operators import retrieval

    rng, n, k = np.random.default_rng(5), 20_000, 10
    vectors = rng.standard_normal((n, 16)).astype(np.float32)
    vectors[rng.integers(0, n, 2000)] = vectors[7]
    items = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "id long, v array<float>")
    began = time.time()
    got = np.array(retrieval.top_k(items.where("id % 20 = 0"), items, "id", "v", k).orderBy("query_id", "rank").select("query_id", "item_id", "similarity").collect())
    assert time.time() - began < 60
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    scores = np.round(unit[::20] @ unit.T, 6)
    scores[np.arange(n // 20), np.arange(0, n, 20)] = -2
    want = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    assert (got[:, 0].reshape(-1, k) == np.arange(0, n, 20)[:, None]).all() and (got[:, 1].reshape(-1, k) == want).all()
    assert np.allclose(got[:, 2].reshape(-1, k), np.take_along_axis(scores, want, axis=1), atol=2e-6)


@pytest.mark.parametrize("block", [16, 1 << 14])
def test_top_k_of_odd_vectors(spark, monkeypatch, block):
    """Blocks give what the column formula gives for every pair: nulls, NaN, other lengths, copies, repeated and null ids."""
    from millrace.operators import retrieval

    monkeypatch.setattr(retrieval, "FEW_ITEMS", block)
    monkeypatch.setattr(retrieval, "ITEMS", block)
    data = [(i, [float((i * 7 + j * j) % 5 - 2) for j in range(6)]) for i in range(40)] + [(300 + i, [1.0, 1.0, 1.0, 0.0, 0.0, 1.0]) for i in range(20)]
    data += [(100, None), (101, [None, 1.0]), (102, [0.0] * 6), (103, [float("nan")] * 6), (104, [float("inf")] + [1.0] * 5), (105, [1e200] * 6), (106, [1e-200] * 6), (107, [1.0, 2.0]), (108, []), (109, [1.0, 2.0]), (3, [5.0] * 6), (None, [1.0] * 6)]
    items = spark.createDataFrame(data, "id long, v array<double>").repartition(3)
    pairs = items.select(F.col("id").alias("query_id"), F.col("v").alias("q")).crossJoin(items.select(F.col("id").alias("item_id"), F.col("v").alias("i"))).where("query_id <> item_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "item_id"))
    for k in (1, 7):
        every = pairs.select("query_id", "item_id", F.round(retrieval.cosine(F.col("q"), F.col("i")), 6).alias("similarity")).withColumn("rank", rank).where(F.col("rank") <= k)
        assert sorted(map(repr, every.collect())) == sorted(map(repr, retrieval.top_k(items, items, "id", "v", k).select(*every.columns).collect()))


def test_round_robin(spark):
    uses = spark.createDataFrame([("a", i) for i in range(7)] + [("z", 0)], "p string, o int")
    assets = spark.createDataFrame([("a", k) for k in range(3)], "p string, asset int")
    got = schedule.round_robin(uses, "p", ["o"], assets, "asset", "s").orderBy("o").collect()
    assert len(got) == 7 and all(len({r.asset for r in got[i : i + 3]}) == 3 for i in (0, 3))


def test_ranks_and_correlation(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2), ("d", 3)], "k string, v int")
    assert rows(stats.average_rank(df, "v", "r").select("k", "r")) == [("a", 1.0), ("b", 2.5), ("c", 2.5), ("d", 4.0)]
    assert stats.correlation(df.withColumn("one", F.lit(1)), "v", "one").first()[0] == 0.0
    assert stats.correlation(df.limit(0).withColumn("w", F.col("v")), "v", "w").first()[0] == 0.0
    assert stats.spearman(df.withColumn("w", -F.col("v")), "v", "w").first()[0] == pytest.approx(-1)


def test_shards(spark):
    sizes = lambda n: [r["count"] for r in shards.shard_plan(spark.range(n), "id", 4).groupBy("shard").count().orderBy("shard").collect()]
    assert sizes(8) == [4, 4] and sizes(9) == [4, 4, 1]
    assert [r.share for r in schedule.even_split(10, spark.range(4), "id", 4).orderBy("id").collect()] == [3, 3, 2, 2]


def test_running_total(spark):
    df = spark.createDataFrame([(k % 50, k, (k * 7) % 11) for k in range(1000)], "o int, t int, v int")
    want, total = [], 0
    for o, t, v in sorted((k % 50, k, (k * 7) % 11) for k in range(1000)):
        want.append((o, t, total))
        total += v
    assert rows(running_total(df, "o", "v", ["t"]).select("o", "t", "before")) == want
    assert running_total(df.limit(0), "o", "v", ["t"]).count() == 0


def test_weighted_draws_follow_weights(spark):
    items = spark.createDataFrame([(1, 1), (2, 3), (3, 0), (4, 6)], "id int, w int")
    counts = {r.item: r["count"] for r in sampling.weighted_draws(items, "id", "w", spark.range(5000), "id", "s").groupBy("item").count().collect()}
    assert sum(counts.values()) == 5000 and 3 not in counts
    assert all(abs(counts[i] / 5000 - w / 10) < 0.03 for i, w in ((1, 1), (2, 3), (4, 6)))


def test_exact_sizes():
    assert sampling.exact_sizes(100) == (3, 65, 32) and sampling.exact_sizes(2500) == (76, 1616, 808)
    assert sum(sampling.exact_sizes(997)) == 997


def test_reasons(spark):
    df = spark.createDataFrame([(1, "f", 1.0, True, True), (2, "f", 1.0, True, True), (3, "f", 2.0, False, False), (4, "f", 3.0, True, False), (5, "g", 1.0, True, True)], "i int, file string, x double, cat boolean, box boolean")
    got = pairing.drop_ambiguous(df, ["file", "x"], [("category", ~F.col("cat")), ("box", ~F.col("box"))], "duplicate").select("i", "reason")
    assert dict(rows(got)) == {1: "duplicate", 2: "duplicate", 3: "category", 4: "box", 5: None}


def test_piecewise(spark):
    points = [(0.05, 182.99), (0.25, 191.499), (0.5, 231.517), (0.95, 394.235)]
    assert [round(value(spark, numbers.piecewise(F.lit(u), points)), 3) for u in (0.05, 0.25, 0.5, 0.95)] == [182.99, 191.499, 231.517, 394.235]


def test_background_counts_twice(spark):
    df = spark.createDataFrame([([112, 130, 154],), ([128, 130, 154],), ([160, 130, 150],)], "rgb array<int>")
    far, blue = images.out_of_range((112, 130, 154))
    assert [r[0] + r[1] for r in df.select(far.cast("int"), blue.cast("int")).collect()] == [0, 1, 2]


def test_rules(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, v int")
    rules = [validate.Rule("negative", F.col("v") < 0), validate.Rule("missing", F.col("v").isNull(), "warning")]
    assert rows(validate.issues(df, rules, ["id"])) == [(2, "missing", "warning"), (3, "negative", "error")]
    report = validate.report(df, rules)
    assert rows(report) == [("missing", "warning", 3, 1), ("negative", "error", 3, 1)] and validate.passed(report).first()[0] is False
    cut = validate.truncated(validate.issues(df, rules, ["id"]).withColumn("all", F.lit(1)), "all", ["id"], most=1).collect()
    assert len(cut) == 1 and cut[0]["truncated"]


def test_labels(spark):
    doc = {"images": [{"file_name": "a.png", "drug_N": "K-000001", "color_class1": "red", "color_class2": "", "width": 10}], "annotations": [{"bbox": [1, 2, 3, 4], "area": 12}]}
    df = spark.createDataFrame([("k", 1, json.dumps(doc)), ("k", 0, json.dumps(doc | {"annotations": [{"bbox": [9, 9, 1, 1], "category_id": 7}]}))], "key string, o int, t string")
    parsed = labels.parse_labels(df, "t")
    got = labels.canonical_annotations(parsed, ["key"], "o").first().annotations
    assert [(a.id, a.category_id, a.bbox[0], a.product_id) for a in got] == [(1, 7, 9.0, "K-000001"), (2, 1, 1.0, "K-000001")]
    meta = parsed.select(*labels.metadata(F.col("label"))).first()
    assert (meta.product_id, meta.color, meta.shape) == ("K-000001", "red", "")
    renamed = parsed.select(labels.rename_images(F.col("label"), lambda c: paths.png_to(c)).alias("l")).first().l
    assert renamed.images[0].file_name == "a.jpg" and renamed.images[0].imgfile is None
    assert value(spark, F.size(labels.zipped(F.array(F.lit(1), F.lit(2)), F.array(F.lit("a"))))) == 1
    assert value(spark, labels.json_or(F.lit(""), "array<int>", F.array().cast("array<int>"))) == []


def test_detection(spark):
    truth = spark.createDataFrame([(1, 1, 0, 0, 10, 10), (1, 2, 100, 100, 10, 10)], "image int, pos int, x int, y int, w int, h int")
    found = spark.createDataFrame([(1, 1, 0, 0, 10, 10, 0.9), (1, 2, 1, 1, 10, 10, 0.8), (1, 3, 50, 50, 10, 10, 0.95)], "image int, pos int, x int, y int, w int, h int, score double")
    matched = detection.match(truth, found, ["image"], "pos", "score").withColumn("c", F.lit(0))
    assert {r.pos: r.tp for r in matched.collect()} == {1: 1, 2: 0, 3: 0}
    counts = spark.createDataFrame([(0, 2), (1, 3)], "c int, n_truth long")
    ap = {r.c: r.ap for r in detection.average_precision(detection.pr_curve(matched, counts, "c", "score", ["pos"]), counts, "c").collect()}
    assert ap == {0: pytest.approx(51 * 0.5 / 101, abs=1e-6), 1: 0.0}


def test_promotion_needs_agreement(spark):
    data = [("ok", 0.80, 0.035), ("iou", 0.79, 0.01), ("edge", 0.9, 0.036), ("none", None, 0.01), ("nan", float("nan"), 0.01)]
    df = spark.createDataFrame(data, "g string, iou double, edge double")
    for c, v in (("hits", 5000), ("n", 5000), ("s", 3), ("f", 2), ("q", 0.95)):
        df = df.withColumn(c, F.lit(v))
    assert {r.g for r in detection.promotion(df, "hits", "n", "s", "f", "q", iou="iou", dispersion="edge").collect() if r.promoted} == {"ok"}


def test_eda(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5), (1, 3, None), (2, 1, None)], "g int, o int, v int")
    assert rows(eda.fill_along(df, "v", ["g"], ["o"]).select("g", "o", F.coalesce("v", F.lit(-1)))) == [(1, 1, -1), (1, 2, 5), (1, 3, 5), (2, 1, -1)]
    assert rows(eda.min_max(df.na.fill(5), "v", ["g"], "s").select("s").distinct()) == [(0.0,)]


def test_text(spark):
    assert value(spark, text.char_ngrams(F.lit("a"))) == ["<a>"] and value(spark, text.char_ngrams(F.lit(""))) == []
    assert value(spark, text.clean(F.lit("<script>x</script><b>Hi&amp;you</b>"))) == "hi you"
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, [])], "id int, t array<string>")
    encoded = text.encode(df, "id", "t", text.vocabulary(df, "t", 1), 4)
    assert {r.id: r.ids for r in encoded.collect()} == {1: [2, 1, 2, 0], 2: [0, 0, 0, 0]}


def test_images():
    grey = np.random.Generator(np.random.PCG64(1)).random((48, 40)) * 200
    assert images.phash(grey) == images.phash(grey + 10) != images.phash(grey[::-1]) and len(images.phash(grey)) == 16
    assert np.allclose(images.dct_matrix(8) @ images.dct_matrix(8).T, np.eye(8)) and np.allclose(images.lanczos(np.ones((9, 7)), 4, 3), 1)
    mask = np.zeros((10, 20), bool)
    mask[2:4, 5:9] = True
    assert images.alpha_box(mask * 255) == [5, 2, 4, 2] and images.alpha_box(mask * 10) is None
    assert images.mask_metrics(mask)["fill_ratio"] == 1.0 and images.mask_metrics(np.ones((3, 3)))["edge_touch"] == 1.0


def test_bright_edges():
    flat = np.full((300, 300), 100.0)
    assert images.bright_edges(flat) == (0.0, 0.0, False)
    flat[:72, :72] = 120
    assert images.bright_edges(flat)[2]


def test_placement(spark):
    size = 4
    slots = spark.range(30).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
    cx, cy = assets.centre(F.col("id"), F.lit(size), F.col("slot"), 976, 1280, "s")
    got = assets.place_objects(slots.select("id", "slot", F.lit(220).alias("w"), F.lit(200).alias("h"), cx.alias("cx"), cy.alias("cy")), "id", "slot", 976, 1280, "s").collect()
    placed = [r for r in got if r.attempt >= 0]
    assert len(got) == 30 * size and len(placed) > 100
    for r in placed:
        assert 16 <= r.x <= 976 - 16 - 220 and 16 <= r.y <= 1280 - 16 - 200
        for q in placed:
            if q.image == r.image and q.slot < r.slot:
                common = max(0, 220 - abs(q.x - r.x)) * max(0, 200 - abs(q.y - r.y))
                assert common * 100 <= 2 * (2 * 220 * 200 - common)
    tiny = assets.place_objects(spark.createDataFrame([(1, 0, 5, 5, 100, 100)], "i int, s int, w int, h int, cx int, cy int"), "i", "s", 976, 1280, "s")
    assert tiny.first().attempt == -1


def test_asset_bank(spark):
    df = spark.createDataFrame([("a", k, k != 1) for k in range(6)] + [("b", 0, None)], "p string, o int, ok boolean")
    existing = spark.createDataFrame([("a",)], "p string")
    assert rows(assets.asset_bank(df, "p", ["o"], F.col("ok"), 3, existing).select("p", "o", "asset_index")) == [("a", 0, 1), ("a", 2, 2)]
    kept, rejected = assets.gated(df, F.col("ok"))
    assert (kept.count(), rejected.count()) == (5, 2)
