"""Every operator as a query over the driver's tables, and its SQL.

Stand-ins: a user's events are an episode's frames in order of time, the event
type is the subtask; 64-number embeddings are 8 x 8 depth maps or masks; pairs
of part names make instructions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright import ship_to_workers
from framewright.functions import arrays, codecs, discovery
from framewright.operators import frames as ops
from framewright.operators import sampling

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

# Fixed values.
SUBTASKS = (("click", "touch", "press the button"), ("view", "look", "look at the page"), ("purchase", "take", "take the box"))
MANUAL = {"7": ["red cup", "spoon"], "11": ["blue box"], "default": ["gripper"]}
ALWAYS = ["Robot Hand", "the gripper"]
DEFAULT_TEXT = "perform the task"

EVENTS = """frames AS (
    SELECT user_id AS episode_idx, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_idx,
           event_type AS subtask, epoch_us(ts) / 1000000.0 AS timestamp FROM events)"""
RUNS = EVENTS + """, marks AS (
    SELECT *, CASE WHEN lag(subtask) OVER w IS DISTINCT FROM subtask AND row_number() OVER w > 1 THEN 1 ELSE 0 END AS c
    FROM frames WINDOW w AS (PARTITION BY episode_idx ORDER BY frame_idx)
), runs0 AS (SELECT *, CAST(sum(c) OVER (PARTITION BY episode_idx ORDER BY frame_idx) AS BIGINT) AS segment FROM marks
), runs AS (SELECT *, min(frame_idx) OVER (PARTITION BY episode_idx, segment) AS start_frame, max(frame_idx) OVER (PARTITION BY episode_idx, segment) AS end_frame FROM runs0)"""


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_to_workers(spark)
            return f(lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"), spark)

        key = name or f.__name__
        QUERIES[key] = run
        if sql:
            ORACLE_SQL[key] = sql
        return f

    return add


def event_frames(table, label: str = "event_type") -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    seconds = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)") / 1e6
    return table("events").select(F.col("user_id").alias("episode_idx"), (F.row_number().over(order) - 1).cast("long").alias("frame_idx"), F.expr(label).alias("subtask"), seconds.alias("timestamp"))


@query("WITH " + RUNS + " SELECT episode_idx, segment, min(subtask) AS subtask, min(frame_idx) AS start_frame, max(frame_idx) AS end_frame, count(*) AS n_frames FROM runs GROUP BY ALL")
def subtask_segments(table, spark):
    return sampling.segments(event_frames(table))


SELECTED = " SELECT episode_idx, frame_idx, CAST(NULL AS BIGINT) AS subtask_index, '' AS atomic_skill, subtask, timestamp FROM runs WHERE (frame_idx - start_frame) % {0} = 0 OR frame_idx = end_frame"


@query("WITH " + RUNS + SELECTED.format(5))
def subtask_aware_sampling(table, spark):
    return ops.manifest(sampling.subtask_aware(event_frames(table), 5).where("selected"))


@query("WITH " + RUNS.replace("event_type AS subtask", "CAST(week(ts) AS VARCHAR) AS subtask") + SELECTED.format(4))
def subtask_aware_by_week(table, spark):
    return ops.manifest(sampling.subtask_aware(event_frames(table, "cast(weekofyear(ts) as string)"), 4).where("selected"))


@query("WITH " + EVENTS + " SELECT episode_idx, subtask, count(*) AS n_frames, string_agg(CAST(frame_idx AS VARCHAR), ',' ORDER BY frame_idx) AS frames FROM frames GROUP BY ALL")
def subtask_frame_counts(table, spark):
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("frame_idx")), lambda x: x.cast("string")), ",")
    return event_frames(table).groupBy("episode_idx", "subtask").agg(F.count("*").alias("n_frames"), listed.alias("frames"))


@query("WITH " + EVENTS + """, l AS (SELECT episode_idx, max(frame_idx) + 1 AS n, least(7, max(frame_idx) + 1) AS k FROM frames GROUP BY 1),
    s AS (SELECT episode_idx, n, k, unnest(generate_series(0, k - 1)) AS i FROM l)
    SELECT DISTINCT episode_idx, CASE WHEN i = k - 1 AND k > 1 THEN n - 1 ELSE CAST(floor(i * ((n - 1) / CAST(greatest(k - 1, 1) AS DOUBLE))) AS BIGINT) END AS frame_idx FROM s""")
def uniform_sampling(table, spark):
    return sampling.uniform(event_frames(table), 7)


@query("WITH " + EVENTS + " SELECT episode_idx, frame_idx FROM frames WHERE frame_idx IN (0, 5, 10, 60, 200)")
def explicit_frames(table, spark):
    lengths = event_frames(table).groupBy("episode_idx").agg((F.max("frame_idx") + 1).alias("length"))
    return sampling.explicit(lengths, [10, 0, 5, 5, 60, 200, -1])


@query("WITH " + EVENTS + " SELECT * FROM frames WHERE frame_idx < 10")
def first_n_frames(table, spark):
    return sampling.first_n(event_frames(table), 10)


FPS = EVENTS + """, d AS (SELECT episode_idx, timestamp - lag(timestamp) OVER (PARTITION BY episode_idx ORDER BY frame_idx) AS step FROM frames),
    f AS (SELECT episode_idx, 1.0 / quantile_cont(step, 0.5) FILTER (WHERE step > 0) AS fps FROM d GROUP BY 1)"""


@query("WITH " + FPS + " SELECT episode_idx, round(fps * 1000000, 6) AS frames_per_megasecond FROM f")
def fps_infer(table, spark):
    return sampling.frame_rate(event_frames(table)).select("episode_idx", F.round(F.col("fps") * 1000000, 6).alias("frames_per_megasecond"))


@query("WITH " + FPS + " SELECT episode_idx, CASE WHEN round_even(200000 * fps, 0) >= 1 THEN CAST(round_even(200000 * fps, 0) AS BIGINT) END AS stride FROM f")
def stride_seconds(table, spark):
    return sampling.frame_rate(event_frames(table)).select("episode_idx", sampling.stride_of(200000, F.col("fps")).alias("stride"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (3, 5, 8, 13, 21, 34) ORDER BY c_custkey LIMIT 4")
def episode_select(table, spark):
    return ops.select_episodes(table("customer").select("c_custkey", "c_name"), [34, 21, 5, 3, 8, 13, 3], 4, "c_custkey")


@query("""WITH e AS (SELECT conv_id, max(turn) + 2 AS length FROM conversations GROUP BY 1),
    s AS (SELECT conv_id, length, unnest(generate_series(0, length - 1)) AS turn FROM e),
    m AS (SELECT conv_id, turn, max(role) AS role FROM conversations WHERE (conv_id + turn) % 5 <> 0 GROUP BY 1, 2)
    SELECT s.conv_id, s.turn, s.length, m.role FROM s LEFT JOIN m USING (conv_id, turn)""")
def dense_frame_spine(table, spark):
    talk = table("conversations")
    episodes = talk.groupBy("conv_id").agg((F.max("turn") + 2).alias("length"))
    known = talk.where("(conv_id + turn) % 5 <> 0").select("conv_id", "turn", "role")
    doubled = known.union(known.where("turn % 2 = 0")).union(known.withColumn("turn", F.col("turn") + 1000))
    return ops.dense_spine(episodes, doubled, ["conv_id"], "length", "turn", ["role"])


@query("WITH " + EVENTS + f""", d(subtask_index, atomic_skill, subtask) AS (VALUES {', '.join(f"('{a}', '{b}', '{c}')" for a, b, c in SUBTASKS)})
    SELECT episode_idx, frame_idx, f.subtask AS subtask_index, coalesce(d.atomic_skill, '') AS atomic_skill, coalesce(d.subtask, '') AS subtask
    FROM frames f LEFT JOIN d ON f.subtask = d.subtask_index""")
def subtask_dim_join(table, spark):
    dimension = spark.createDataFrame([*SUBTASKS], "subtask_index string, atomic_skill string, subtask string")
    frames = event_frames(table).select("episode_idx", "frame_idx", F.col("subtask").alias("subtask_index"))
    return ops.with_subtasks(frames, dimension)


@query(f"""SELECT doc_id, coalesce(nullif(trim(max(b.text)), ''), '{DEFAULT_TEXT}') AS instruction
    FROM documents LEFT JOIN benchmark b ON item_id = doc_id GROUP BY doc_id""")
def instruction_resolve(table, spark):
    return ops.with_instruction(table("documents").select("doc_id"), table("benchmark"), "doc_id", "item_id", "text", DEFAULT_TEXT)


@query("SELECT c_custkey, CASE c_custkey WHEN 7 THEN 'red cup,spoon' WHEN 11 THEN 'blue box' ELSE 'gripper' END AS queries FROM customer")
def manual_queries(table, spark):
    return table("customer").select("c_custkey", F.array_join(ops.manual_queries(F.col("c_custkey"), MANUAL), ",").alias("queries"))


VERB_LIST = ", ".join(f"'{v}'" for v in discovery.VERBS)
PHRASES = r"""list_filter(regexp_extract_all(lower({0}), '(?:^|[^\p{{L}}\p{{N}}_])the\s+([\p{{L}}\p{{N}}_](?:[\p{{L}}\p{{N}}_\s]*[\p{{L}}\p{{N}}_])?)', 1),
    lambda p: list_extract(string_split_regex(p, '\s+'), -1) NOT IN (""" + VERB_LIST + "))"


@query("SELECT doc_id, array_to_string(" + PHRASES.format("text") + ", '|') AS phrases FROM documents")
def rule_the_phrases(table, spark):
    return table("documents").select("doc_id", F.array_join(discovery.the_phrases(F.col("text")), "|").alias("phrases"))


def instructions(table) -> DataFrame:
    name = F.col("p_name")
    return table("part").select("p_partkey", F.concat(F.lit("Pick up the "), name, F.lit(", put "), name, F.lit(" into the red Box. Stack blue cups!")).alias("text"))


SENTENCES = "s AS (SELECT p_partkey, 'Pick up the ' || p_name || ', put ' || p_name || ' into the red Box. Stack blue cups!' AS text FROM part)"
CLEAN = "list_sort(list_distinct(list_filter(list_transform({0}, lambda q: lower(trim(regexp_replace(q, '\\s+', ' ', 'g')))), lambda q: q <> '')))"
RULE = """WITH {s}, f AS (SELECT p_partkey, list_concat({the}, {colors}, list_filter([{nouns}], lambda n: regexp_matches(lower(text), '\\b' || n || 's?\\b')), [{always}]) AS q FROM s),
    a AS (SELECT p_partkey, list_transform(q, lambda q: regexp_replace(q, '\\b(a|an|the)\\b\\s*', '', 'g')) AS q FROM f)
    SELECT p_partkey, array_to_string({done}, '|') AS queries FROM a"""
COLOR_SQL = ", ".join(f"list_transform(list_filter(regexp_extract_all(lower(text), '\\b{c}\\s+(\\w+)\\b', 1), lambda w: w NOT IN ({VERB_LIST})), lambda w: '{c} ' || w)" for c in discovery.COLORS)


def _rule_sql(always: list[str]) -> str:
    low = ", ".join(f"'{a.lower()}'" for a in always)
    return RULE.format(s=SENTENCES, the=PHRASES.format("text"), colors=COLOR_SQL, nouns=", ".join(f"'{n}'" for n in discovery.NOUNS), always=low, done=CLEAN.format(f"list_concat(q, CAST([{low}] AS VARCHAR[]))"))


@query(_rule_sql([]))
def rule_extract_full(table, spark):
    return instructions(table).select("p_partkey", F.array_join(discovery.rule_queries(F.col("text")), "|").alias("queries"))


@query(_rule_sql(ALWAYS))
def always_include_union(table, spark):
    return instructions(table).select("p_partkey", F.array_join(discovery.rule_queries(F.col("text"), ALWAYS), "|").alias("queries"))


@query(f"""WITH {SENTENCES}, w AS (SELECT p_partkey, list_transform(string_split_regex(lower(trim(text)), '\\s+'), lambda w: trim(w, '.,!?')) AS w FROM s),
    u AS (SELECT p_partkey, unnest(w) AS x, unnest(list_concat([''], w[:-2])) AS b FROM w)
    SELECT p_partkey, coalesce(string_agg(DISTINCT CASE WHEN b IN ({', '.join(f"'{c}'" for c in discovery.MOCK_COLORS)}) THEN b || ' ' || x ELSE x END, '|' ORDER BY CASE WHEN b IN ({', '.join(f"'{c}'" for c in discovery.MOCK_COLORS)}) THEN b || ' ' || x ELSE x END)
        FILTER (WHERE x IN ({', '.join(f"'{c}'" for c in (*discovery.MOCK_NOUNS, *discovery.MOCK_COLORS))})), '') AS queries FROM u GROUP BY 1""")
def mock_extract(table, spark):
    return instructions(table).select("p_partkey", F.array_join(discovery.mock_queries(F.col("text")), "|").alias("queries"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN array_to_string(list_sort([event_type, 'red cup']), '|') WHEN 1 THEN event_type WHEN 2 THEN '' END AS labels FROM events""")
def llm_response_parse(table, spark):
    kind = F.col("event_type")
    replies = [
        F.concat(F.lit('```json\n["The '), kind, F.lit('", "a  Red cup", 12, "thing", null]\n```')),
        F.concat(F.lit('Sure: ["'), kind, F.lit('", "'), kind, F.lit('"] as asked')),
        F.lit("[]"),
        F.concat(F.lit('{"label": "'), kind, F.lit('"}')),
    ]
    reply = F.element_at(F.array(*replies), (F.col("event_id") % 4 + 1).cast("int"))
    return table("events").select("event_id", F.array_join(discovery.response_labels(reply), "|").alias("labels"))


MAP = "SELECT vec_id, embedding AS e, list_min(embedding) AS lo, list_max(embedding) AS hi FROM embeddings"


def _text(values):
    return F.array_join(F.transform(values, lambda x: x.cast("string")), ",")


@query(f"SELECT vec_id, CAST(list_sum(list_transform(e, lambda x: CAST(round(CAST(CAST(CAST(x AS DOUBLE) * 520.0 / 300 AS FLOAT) AS DOUBLE) * 1000000) AS BIGINT))) AS BIGINT) AS micro_sum FROM ({MAP})")
def depth_metric(table, spark):
    focal = arrays.focal_scale(F.lit(500.0), F.lit(540.0), F.lit(8.0), F.lit(8.0), F.lit(8.0), F.lit(8.0))
    depth = arrays.metric_depth(F.col("embedding"), focal)
    micro = F.aggregate(F.transform(depth, lambda x: F.round(x.cast("double") * 1000000).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return table("embeddings").select("vec_id", micro.alias("micro_sum"))


@query(f"SELECT vec_id, CAST(list_sum(list_transform(e, lambda x: CAST(round(CAST(CAST(x - lo AS FLOAT) / CAST(CAST(hi - lo AS FLOAT) + CAST(1e-8 AS FLOAT) AS FLOAT) AS DOUBLE) * 10000) AS BIGINT))) AS BIGINT) AS sum_e4 FROM ({MAP})")
def depth_relative(table, spark):
    depth = arrays.relative_depth(F.col("embedding"))
    total = F.aggregate(F.transform(depth, lambda x: F.round(x.cast("double") * 10000).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return table("embeddings").select("vec_id", total.alias("sum_e4"))


@query(f"""SELECT vec_id, array_to_string(list_transform(e, lambda x: CAST(trunc(least(greatest(CAST(x * CAST(1000 AS FLOAT) AS FLOAT), CAST(0 AS FLOAT)), CAST(65535 AS FLOAT))) AS INTEGER)), ',') AS metric,
    array_to_string(list_transform(e, lambda x: CAST(trunc(CAST(CAST((x - lo) AS FLOAT) / CAST((hi - lo) AS FLOAT) AS FLOAT) * CAST(65535 AS FLOAT)) AS INTEGER)), ',') AS relative FROM ({MAP})""")
def depth_quantise(table, spark):
    return table("embeddings").select("vec_id", _text(arrays.metric_steps(F.col("embedding"))).alias("metric"), _text(arrays.relative_steps(F.col("embedding"))).alias("relative"))


@query("SELECT vec_id, min(x) AS least, max(x) AS greatest, round(avg(CAST(x AS DOUBLE)), 9) AS mean, round(stddev_pop(CAST(x AS DOUBLE)), 9) AS std FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings) GROUP BY 1")
def depth_stats(table, spark):
    e, n = F.col("embedding"), F.size("embedding")
    mean = F.aggregate(e, F.lit(0.0), lambda a, x: a + x) / n
    spread = F.sqrt(F.aggregate(e, F.lit(0.0), lambda a, x: a + (x.cast("double") - F.col("m")) * (x.cast("double") - F.col("m"))) / n)
    rows = table("embeddings").select("vec_id", "embedding", mean.alias("m"))
    return rows.select("vec_id", F.array_min(e).alias("least"), F.array_max(e).alias("greatest"), F.round("m", 9).alias("mean"), F.round(spread, 9).alias("std"))


@query("""WITH p AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings), on_ AS (SELECT vec_id, i % 8 AS px, i // 8 AS py FROM p WHERE x > 0.2)
    SELECT vec_id, coalesce(n, 0) AS area, coalesce(box, '0,0,0,0') AS box FROM embeddings LEFT JOIN
    (SELECT vec_id, count(*) AS n, concat_ws(',', min(px), min(py), max(px) - min(px) + 1, max(py) - min(py) + 1) AS box FROM on_ GROUP BY 1) USING (vec_id)""")
def mask_area_bbox(table, spark):
    mask = F.transform(F.col("embedding"), lambda x: x > F.lit(0.2))
    return table("embeddings").select("vec_id", arrays.mask_area(mask).alias("area"), _text(arrays.mask_box(mask, 8)).alias("box"))


def _mask(table) -> DataFrame:
    return table("embeddings").select("vec_id", F.transform(F.col("embedding"), lambda x: x > F.lit(0.1)).alias("mask"))


@query("""WITH p AS (SELECT vec_id, k, embedding[(k % 8) * 8 + k // 8 + 1] > 0.1 AS v FROM embeddings, generate_series(0, 63) t(k)),
    c AS (SELECT *, CASE WHEN lag(v) OVER (PARTITION BY vec_id ORDER BY k) IS DISTINCT FROM v THEN 1 ELSE 0 END AS d FROM p),
    g AS (SELECT *, sum(d) OVER (PARTITION BY vec_id ORDER BY k) AS run FROM c), r AS (SELECT vec_id, run, first(v) AS v, count(*) AS n FROM g GROUP BY 1, 2)
    SELECT vec_id, CASE WHEN bool_or(v AND run = 1) THEN '0,' ELSE '' END || string_agg(CAST(n AS VARCHAR), ',' ORDER BY run) AS counts FROM r GROUP BY 1""")
def mask_run_lengths(table, spark):
    return _mask(table).select("vec_id", _text(arrays.run_lengths(F.col("mask"), 8, 8)).alias("counts"))


@query()
def mask_rle_string(table, spark):
    return _mask(table).select("vec_id", codecs.rle_string(arrays.run_lengths(F.col("mask"), 8, 8)).alias("rle_counts"))


@query()
def depth_png16(table, spark):
    return table("embeddings").select("vec_id", codecs.png16_column(arrays.metric_steps(F.col("embedding")), 8, 8).alias("png"))


@query("SELECT l_orderkey, l_linenumber, CAST(trunc(l_quantity) AS BIGINT) AS x, CAST(trunc(l_discount * 100) AS BIGINT) AS y, CAST(trunc(l_extendedprice - l_quantity) AS BIGINT) AS w, CAST(trunc(l_tax * 1000 - l_discount * 100) AS BIGINT) AS h FROM lineitem")
def box_xyxy_xywh(table, spark):
    box = arrays.box_xywh(F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_extendedprice"), F.col("l_tax") * 1000)
    return table("lineitem").select("l_orderkey", "l_linenumber", *[F.get(box, i).alias(c) for i, c in enumerate("xywh")])


@query("SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS instance_id, l_linenumber FROM lineitem QUALIFY instance_id < 2")
def topk_instances(table, spark):
    found = table("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_linenumber")).alias("found"))
    return found.select("l_orderkey", F.posexplode(F.slice("found", 1, 2)).alias("instance_id", "l_linenumber")).withColumn("instance_id", F.col("instance_id").cast("long"))


@query("""WITH m AS (SELECT DISTINCT l_orderkey AS o FROM lineitem WHERE l_returnflag = 'R'), d AS (SELECT DISTINCT l_orderkey AS o FROM lineitem WHERE l_linestatus = 'O')
    SELECT o_orderkey, o_orderkey NOT IN (SELECT o FROM m) AS need_masks, o_orderkey NOT IN (SELECT o FROM d) AS need_depth FROM orders WHERE need_masks OR need_depth""")
def resume_antijoin(table, spark):
    lines = table("lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return ops.pending(table("orders").select("o_orderkey"), {"masks": lines.where("l_returnflag = 'R'"), "depth": lines.where("l_linestatus = 'O'")}, ["o_orderkey"])


@query("WITH " + EVENTS + " SELECT episode_idx, frame_idx, q AS query FROM frames, (VALUES ('cup'), ('robot hand')) t(q)")
def frame_query_cross(table, spark):
    return event_frames(table).select("episode_idx", "frame_idx", F.explode(F.array(F.lit("cup"), F.lit("robot hand"))).alias("query"))


@query("WITH " + EVENTS + " SELECT episode_idx, frame_idx, c AS camera, c = 'front' AS with_masks FROM frames, (VALUES ('front'), ('wrist')) t(c)")
def frame_camera_cross(table, spark):
    cameras = F.explode(F.array(F.lit("front"), F.lit("wrist")))
    return event_frames(table).select("episode_idx", "frame_idx", cameras.alias("camera")).withColumn("with_masks", F.col("camera") == "front")


@query("WITH " + EVENTS + " SELECT episode_idx, frame_idx, subtask AS category, timestamp AS scale FROM frames WHERE frame_idx % 2 = 0 AND frame_idx % 3 = 0")
def mask_depth_align(table, spark):
    frames = event_frames(table)
    masks = frames.where("frame_idx % 2 = 0").select("episode_idx", "frame_idx", F.col("subtask").alias("category"))
    depth = frames.where("frame_idx % 3 = 0").select("episode_idx", "frame_idx", F.col("timestamp").alias("scale"))
    return masks.join(depth, ["episode_idx", "frame_idx"])


@query("SELECT o_orderkey, o_custkey, NULL AS o_orderstatus FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0")
def append_union(table, spark):
    orders = table("orders")
    return orders.where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey").unionByName(orders.where("o_orderkey % 3 = 0").select("o_custkey", "o_orderkey", "o_orderstatus"), allowMissingColumns=True)


@query("WITH " + EVENTS + """, s AS (SELECT *, CASE WHEN frame_idx % 10 = 9 THEN 'failed' WHEN frame_idx % 4 = 0 THEN 'skipped' ELSE 'ok' END AS st FROM frames)
    SELECT episode_idx, count(*) FILTER (WHERE st = 'ok') AS processed, count(*) FILTER (WHERE st = 'skipped') AS skipped, count(*) FILTER (WHERE st = 'failed') AS failed,
    coalesce(string_agg(CAST(frame_idx AS VARCHAR), ',' ORDER BY frame_idx) FILTER (WHERE st = 'failed'), '') AS failed_frames FROM s GROUP BY 1""")
def run_summary(table, spark):
    status = F.when(F.col("frame_idx") % 10 == 9, "failed").when(F.col("frame_idx") % 4 == 0, "skipped").otherwise("ok")
    return ops.summary(event_frames(table).withColumn("status", status)).withColumn("failed_frames", _text(F.col("failed_frames")))


@query("WITH " + EVENTS + """, q AS (SELECT * FROM frames WHERE frame_idx < 3), m AS (SELECT episode_idx, frame_idx, count(*) AS n FROM frames WHERE frame_idx % 2 = 0 GROUP BY ALL)
    SELECT q.episode_idx, q.frame_idx, coalesce(m.n, 0) AS n_masks, q.frame_idx % 3 = 0 AS has_depth FROM q LEFT JOIN m USING (episode_idx, frame_idx)""")
def qc_frames(table, spark):
    from framewright.operators.qc import qc_rows

    frames = event_frames(table)
    masks = frames.where("frame_idx % 2 = 0").select("episode_idx", "frame_idx")
    return qc_rows(frames, masks, frames.where("frame_idx % 3 = 0"), 3).select("episode_idx", "frame_idx", "n_masks", "has_depth")


@query()
def mock_annotation(table, spark):
    """Mock frames, masks and depth end to end: one row per mask."""
    from framewright.operators.models import MockDepth, MockSegmenter, depths, masks
    from framewright.sources.mock import mock_frames

    frames = mock_frames(spark, episodes=2, frames_per_episode=2, height=96, width=128).withColumn("queries", F.array(F.lit("red cup"), F.lit("gripper")))
    found, deep = masks(frames, MockSegmenter()), depths(frames, MockDepth())
    return found.join(deep.select("episode_idx", "frame_idx", "depth_type", "original_min", "original_max"), ["episode_idx", "frame_idx"])
