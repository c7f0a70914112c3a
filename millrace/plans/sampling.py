"""Splits, sampling, schedules and shards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import hash_unit
from ..functions.numbers import piecewise
from ..operators import sampling as ops
from ..operators import schedule, shards, split
from ..operators.prefix import running_total
from .base import Registry, read, register

REGISTRY: Registry = {}


def _split_sql(table: str, cls: str, key: str) -> str:
    return f"""n AS (SELECT {key} AS id, {cls} AS class, least(128, greatest(24, round_even(count(*) OVER (PARTITION BY {cls}) * 0.10, 0))) AS quota,
  row_number() OVER (PARTITION BY {cls} ORDER BY substr(sha1('v2_split|' || {key}), 1, 16), {key}) AS rn FROM {table}),
s AS (SELECT id, class, CASE WHEN rn <= quota THEN 'val_seen_id' ELSE 'train_seen' END AS split FROM n)"""


def _split(spark, sf_dir, table, cls, key):
    df = read(spark, sf_dir, table).select(F.col(cls).alias("class"), F.col(key).alias("id"))
    return split.stable_split(df, "class", "id")


@register(REGISTRY, f"WITH {_split_sql('embeddings', 'label', 'vec_id')} SELECT * FROM s")
def split_assign(spark, sf_dir):
    return _split(spark, sf_dir, "embeddings", "label", "vec_id")


@register(REGISTRY, f"WITH {_split_sql('orders', 'o_orderpriority', 'o_orderkey')} SELECT class, split, count(*) AS n FROM s GROUP BY class, split")
def split_summary(spark, sf_dir):
    return _split(spark, sf_dir, "orders", "o_orderpriority", "o_orderkey").groupBy("class", "split").agg(F.count(F.lit(1)).alias("n"))


def _plan_sql(table: str, cls: str, key: str) -> str:
    return f"""WITH {_split_sql(table, cls, key)}, c AS (SELECT class, count(*) FILTER (split = 'train_seen') AS train_count, count(*) FILTER (split = 'val_seen_id') AS val_count FROM s GROUP BY class)
SELECT class, CAST(dense_rank() OVER (ORDER BY class) - 1 AS INTEGER) AS class_index, train_count, val_count, round((1 - 0.9999::DOUBLE) / (1 - pow(0.9999::DOUBLE, train_count + val_count)), 12) AS class_weight FROM c"""


@register(REGISTRY, _plan_sql("embeddings", "label", "vec_id"))
def sampler_plan(spark, sf_dir):
    return split.sampler_plan(_split(spark, sf_dir, "embeddings", "label", "vec_id"), "class")


@register(REGISTRY, _plan_sql("part", "p_type", "p_partkey"))
def sampler_plan_parts(spark, sf_dir):
    return split.sampler_plan(_split(spark, sf_dir, "part", "p_type", "p_partkey"), "class")


@register(REGISTRY, "SELECT doc_id, source, CASE WHEN CAST('0x' || substr(md5('group|' || source), 1, 8) AS BIGINT) % 100 < 10 THEN 'val' ELSE 'train' END AS split FROM documents")
def group_split_md5(spark, sf_dir):
    return split.group_split(read(spark, sf_dir, "documents").select("doc_id", "source"), "source")


@register(REGISTRY, "SELECT doc_id, CAST(CAST('0x' || substr(md5('fold|' || doc_id), 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold FROM documents")
def kfold_assign(spark, sf_dir):
    return split.kfold(read(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@register(REGISTRY, "SELECT doc_id, lang, nth FROM (SELECT doc_id, lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY substr(sha1('r7|' || doc_id), 1, 16), doc_id) AS INTEGER) AS nth FROM documents) WHERE nth <= 20")
def reservoir_topk(spark, sf_dir):
    return ops.bottom_k(read(spark, sf_dir, "documents").select("doc_id", "lang"), ["lang"], "doc_id", 20, "r7")


@register(
    REGISTRY,
    """WITH i AS (SELECT p_partkey AS item, sum(p_size) OVER (ORDER BY p_partkey) AS hi, p_size AS w FROM part WHERE p_size > 0), t AS (SELECT sum(w) AS total FROM i),
d AS (SELECT c_custkey AS draw, CAST('0x' || substr(sha1('w3|' || c_custkey), 1, 13) AS BIGINT) % (SELECT total FROM t) AS u FROM customer)
SELECT draw, item FROM d JOIN i ON u >= hi - w AND u < hi""",
)
def weighted_draws(spark, sf_dir):
    return ops.weighted_draws(read(spark, sf_dir, "part"), "p_partkey", "p_size", read(spark, sf_dir, "customer"), "c_custkey", "w3")


@register(
    REGISTRY,
    """WITH r AS (SELECT c_custkey AS id, row_number() OVER (ORDER BY CAST('0x' || substr(sha1('z|' || c_custkey), 1, 13) AS BIGINT), c_custkey) - 1 AS place, (SELECT count(*) FROM customer) AS n FROM customer),
k AS (SELECT *, CASE n WHEN 100 THEN 3 WHEN 696 THEN 21 WHEN 2500 THEN 76 ELSE round_even(n * 0.0302::DOUBLE, 0) END AS two, CASE n WHEN 100 THEN 32 WHEN 696 THEN 222 WHEN 2500 THEN 808 ELSE round_even(n * 0.3189::DOUBLE, 0) END AS four FROM r)
SELECT id, CASE WHEN place < two THEN 2 WHEN place < n - four THEN 3 ELSE 4 END AS size FROM k""",
)
def exact_sizes(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return ops.allocate_sizes(rows, "id", rows.count(), "z")


_SIZE = "CASE WHEN CAST('0x' || substr(sha1('s|' || {0}), 1, 13) AS BIGINT) / pow(2, 52) < 0.30 THEN 2 WHEN CAST('0x' || substr(sha1('s|' || {0}), 1, 13) AS BIGINT) / pow(2, 52) < 0.70 THEN 3 ELSE 4 END"


@register(REGISTRY, f"SELECT c_custkey, {_SIZE.format('c_custkey')} AS size FROM customer")
def combo_size_draw(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", ops.size_draw(F.col("c_custkey"), "s", 0.30, 0.40).alias("size"))


def _schedule(spark, sf_dir):
    combos = read(spark, sf_dir, "customer").select("c_custkey", ops.size_draw(F.col("c_custkey"), "s").alias("size"))
    return schedule.balanced_schedule(combos, "c_custkey", "size", read(spark, sf_dir, "nation"), "n_name")


_SCHEDULE = f"""c AS (SELECT c_custkey AS combo, {_SIZE.format("c_custkey")} AS size FROM customer),
b AS (SELECT combo, size, coalesce(sum(size) OVER (ORDER BY combo ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM c),
e AS (SELECT combo, start, unnest(range(0, size)) AS slot FROM b), p AS (SELECT n_name AS product, row_number() OVER (ORDER BY n_name) - 1 AS i, count(*) OVER () AS n FROM nation),
sched AS (SELECT combo, slot, product FROM e JOIN p ON (start + slot) % n = i)"""


@register(REGISTRY, f"WITH {_SCHEDULE} SELECT * FROM sched")
def balanced_schedule(spark, sf_dir):
    return _schedule(spark, sf_dir)


@register(
    REGISTRY,
    f"""WITH {_SCHEDULE}, a AS (SELECT s_suppkey AS asset, n_name AS product, count(*) OVER (PARTITION BY n_name) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey),
u AS (SELECT combo, slot, product, row_number() OVER (PARTITION BY product ORDER BY combo, slot) - 1 AS o FROM sched),
t AS (SELECT u.*, n, o // n AS cycle, o % n AS place FROM u JOIN (SELECT DISTINCT product, n FROM a) USING (product)),
k AS (SELECT product, cycle, asset, row_number() OVER (PARTITION BY product, cycle ORDER BY substr(sha1('rr|' || CAST(cycle AS BIGINT) || '|' || asset), 1, 16), asset) - 1 AS place
  FROM (SELECT DISTINCT product, cycle FROM t) JOIN a USING (product))
SELECT combo, slot, product, CAST(cycle AS BIGINT) AS cycle, asset FROM t JOIN k USING (product, cycle, place)""",
)
def round_robin_assets(spark, sf_dir):
    names = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("product"))
    assets = read(spark, sf_dir, "supplier").join(names, "s_nationkey")
    return schedule.round_robin(_schedule(spark, sf_dir), "product", ["combo", "slot"], assets, "s_suppkey", "rr")


@register(
    REGISTRY,
    """WITH RECURSIVE parts AS (SELECT p_partkey, p_brand AS g, p_size AS used, row_number() OVER (ORDER BY p_partkey) - 1 AS turn, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS place,
  count(*) OVER (PARTITION BY p_brand) - 1 AS others, count(*) OVER () AS n FROM part),
a AS (SELECT o_orderkey AS combo, p_partkey AS anchor, g, place AS own, others FROM orders JOIN parts ON turn = o_orderkey % n WHERE others > 0),
f AS (SELECT combo, others, greatest(others - 16, 0) AS top, []::BIGINT[] AS taken FROM a
  UNION ALL SELECT combo, others, top + 1, list_append(taken, CASE WHEN list_contains(taken, draw) THEN top ELSE draw END)
  FROM (SELECT *, CAST('0x' || substr(sha1('hm|' || combo || '|' || top), 1, 13) AS BIGINT) % (top + 1) AS draw FROM f WHERE top < others)),
d AS (SELECT combo, anchor, g, own, unnest(taken) AS p FROM f JOIN a USING (combo) WHERE top = f.others)
SELECT combo, anchor, p_partkey AS partner, CAST(row_number() OVER (PARTITION BY combo ORDER BY used, substr(sha1('hm|' || combo || '|' || p_partkey), 1, 16), p_partkey) AS INTEGER) AS nth
FROM d JOIN parts q ON q.g = d.g AND q.place = p + CASE WHEN p >= own THEN 1 ELSE 0 END QUALIFY nth <= 3""",
)
def hard_mix(spark, sf_dir):
    """Partners for all orders, among all parts; orders are dealt over the parts in turn."""
    part = read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size").withColumn("one", F.lit(1))
    dealt = running_total(part, "p_partkey", "one", [], "turn").select("p_partkey", "turn")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.pmod("o_orderkey", F.lit(max(1, part.count()))).alias("turn"))
    return schedule.hard_mix(orders.join(dealt, "turn"), "o_orderkey", part, "p_partkey", "p_brand", "p_size", "hm")


@register(REGISTRY)
def deficit_balanced(spark, sf_dir):
    sizes = read(spark, sf_dir, "customer").select("c_custkey", ops.size_draw(F.col("c_custkey"), "s").alias("size"))
    real = read(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return schedule.deficit_balanced(sizes, "c_custkey", "size", real, "s_nationkey", "n", 7, floor=3)


#: Points of an inverse distribution function (fixed values of the size profile).
POINTS = [(0.05, 182.99), (0.25, 191.499), (0.5, 231.517), (0.75, 301.0), (0.95, 394.235)]


@register(
    REGISTRY,
    "WITH d AS (SELECT c_custkey, 0.05 + 0.9 * (CAST('0x' || substr(sha1('q|' || c_custkey), 1, 13) AS BIGINT) / pow(2, 52)) AS u FROM customer) SELECT c_custkey, round(CASE "
    + " ".join(f"WHEN u >= {a} AND u <= {b} THEN {x}::DOUBLE + ({y}::DOUBLE - {x}::DOUBLE) * ((u - {a}::DOUBLE) / ({b}::DOUBLE - {a}::DOUBLE))" for (a, x), (b, y) in zip(POINTS, POINTS[1:], strict=False))
    + " ELSE 394.235 END, 6) AS side FROM d",
)
def piecewise_quantile(spark, sf_dir):
    u = F.lit(0.05) + F.lit(0.9) * hash_unit("q", F.col("c_custkey"))
    return read(spark, sf_dir, "customer").select("c_custkey", F.round(piecewise(u, POINTS), 6).alias("side"))


@register(REGISTRY, "SELECT w AS worker, t // 7 + CASE WHEN w < t % 7 THEN 1 ELSE 0 END AS share FROM range(0, 7) r(w), (SELECT count(*) AS t FROM orders)")
def even_split(spark, sf_dir):
    return schedule.even_split(read(spark, sf_dir, "orders").count(), spark.range(7).withColumnRenamed("id", "worker"), "worker", 7)


_SHARDS = "p AS (SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 256 AS INTEGER) AS shard FROM orders), f AS (SELECT *, 'shard-' || lpad(CAST(shard AS VARCHAR), 6, '0') || '.tar' AS file FROM p)"


@register(REGISTRY, f"WITH {_SHARDS} SELECT * FROM f")
def shard_plan(spark, sf_dir):
    return shards.shard_plan(read(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 256)


@register(REGISTRY, f"WITH {_SHARDS} SELECT shard, file, count(*) AS samples, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id, sha256(string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey)) AS sha256 FROM f GROUP BY shard, file")
def shard_manifest(spark, sf_dir):
    return shards.shard_manifest(shards.shard_plan(read(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 256), ["shard", "file"], "o_orderkey")


@register(
    REGISTRY,
    """WITH p AS (SELECT o_orderkey, o_orderpriority AS part, CAST((row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) // 512 AS INTEGER) AS shard FROM orders),
m AS (SELECT part, shard, row_number() OVER (ORDER BY part, shard) - 1 AS k FROM (SELECT DISTINCT part, shard FROM p WHERE shard < 3))
SELECT o_orderkey, part, shard, coalesce('shard-' || lpad(CAST(k AS VARCHAR), 6, '0') || '.tar', 'shard-' || lpad(CAST(shard AS VARCHAR), 6, '0') || '.tar') AS file FROM p LEFT JOIN m USING (part, shard)""",
)
def shard_merge(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("part"))
    plan = shards.shard_plan(orders, "o_orderkey", 512, ["part"])
    return shards.remap(plan, shards.merge_map(plan.where("shard < 3"), "part", "shard"), ["part", "shard"], "new_file", "file")


@register(REGISTRY, "SELECT p_partkey, p_brand FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rn FROM part) WHERE rn <= 5")
def per_group_limit(spark, sf_dir):
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    return read(spark, sf_dir, "part").withColumn("nth", nth).where("nth <= 5").select("p_partkey", "p_brand")


@register(
    REGISTRY,
    """SELECT o_custkey, o_orderkey, nth FROM (SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus <> 'F', o_orderpriority NOT IN ('1-URGENT', '2-HIGH'), substr(sha1('pref|' || o_orderkey), 1, 16), o_orderkey) AS INTEGER) AS nth FROM orders) WHERE nth <= 3""",
)
def preference_sort(spark, sf_dir):
    from pyspark.sql import Window

    from ..functions.hashing import hash_order

    order = [F.col("o_orderstatus") != "F", ~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), hash_order("pref", F.col("o_orderkey")), "o_orderkey"]
    nth = F.row_number().over(Window.partitionBy("o_custkey").orderBy(*order))
    return read(spark, sf_dir, "orders").withColumn("nth", nth).where("nth <= 3").select("o_custkey", "o_orderkey", "nth")
