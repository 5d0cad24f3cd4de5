"""Annotations, JSON, text lines and paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.operators import annotations, editing, intervals, keypoints
from framelake.queries.registry import POINTS, points, query, rounded, table


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type FROM events")
def props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), "event_type")


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keypoints as annotation tasks: a square polygon about the centre and eight points, in percent of 200 x 200; odd frames use the older dialect."""
    k = points(spark, sf_dir).withColumns({"px": F.round(F.col("x") + 50, 3), "py": F.round(F.col("y") + 50, 3)})
    point = F.struct(F.lit("keypointlabels").alias("type"), F.lit(200).alias("original_width"), F.lit(200).alias("original_height"), F.struct(F.lit(None).cast("array<array<double>>").alias("points"), F.col("px").alias("x"), F.col("py").alias("y"), F.array("part").alias("keypointlabels"), F.lit(None).cast("array<string>").alias("polygonlabels")).alias("value"))
    g = k.groupBy("session", "frame_idx").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", point.alias("p")))), lambda z: z["p"]).alias("ps"), F.first("cx").alias("cx"), F.first("cy").alias("cy"))
    x, y = F.round(F.col("cx") + 50, 3), F.round(F.col("cy") + 50, 3)
    corner = lambda a, b: F.array(x + a, y + b)
    polygon = F.struct(F.lit("polygonlabels").alias("type"), F.lit(200).alias("original_width"), F.lit(200).alias("original_height"), F.struct(F.array(corner(-5.00005, -5.00005), corner(5.00005, -5.00005), corner(5.00005, 5.00005), corner(-5.00005, 5.00005)).alias("points"), F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"), F.lit(None).cast("array<string>").alias("keypointlabels"), F.array(F.lit("animal")).alias("polygonlabels")).alias("value"))
    results = F.array(F.struct(F.concat(F.array(polygon), F.col("ps")).alias("result")))
    odd = F.col("frame_idx") % 2 == 1
    body = F.struct((F.col("session") * 100000 + F.col("frame_idx")).alias("id"), F.struct(F.format_string("/data/s%d/ab12-frame_%d.png", F.col("session"), F.col("frame_idx")).alias("image")).alias("data"), F.when(~odd, results).alias("annotations"), F.when(odd, results).alias("completions"))
    return g.select(F.to_json(body).alias("json"))


@query(POINTS + " SELECT session * 100000 + frame_idx AS id, ord + 0 AS point, part, round(round(x + 50, 3) / 100 * 200, 6) + 0.0 AS x, round(round(y + 50, 3) / 100 * 200, 6) + 0.0 AS y, concat('/data/s', session, '/frame_', frame_idx, '.png') AS path FROM k")
def annotation_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = annotations.parse(tasks(spark, sf_dir))
    return rounded(annotations.keypoints(parsed).join(parsed.select("id", "path"), "id"), "x", "y")


@query(POINTS + ", c AS (SELECT DISTINCT session, frame_idx, cx, cy FROM k) SELECT session * 100000 + frame_idx AS id, round((round(cx + 50, 3) - 5.00005) * 2, 6) + 0.0 AS x0, round((round(cy + 50, 3) + 5.00005) * 2, 6) + 0.0 AS y1 FROM c")
def annotation_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = annotations.polygons(annotations.parse(tasks(spark, sf_dir)))
    b = p.withColumn("b", annotations.box(F.col("vertices")))
    return rounded(b.select("id", F.col("b.x0").alias("x0"), F.col("b.y1").alias("y1")), "x0", "y1")


@query(POINTS + """, c AS (SELECT session * 100000 + frame_idx AS id, round(cx + 50, 3) AS cx, round(cy + 50, 3) AS cy, round(x + 50, 3) AS x, round(y + 50, 3) AS y, ord FROM k)
SELECT id, ord + 0 AS point, x > cx - 5.00005 AND x <= cx + 5.00005 AND y > cy - 5.00005 AND y <= cy + 5.00005 AS inside FROM c""")
def annotation_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = annotations.parse(tasks(spark, sf_dir))
    owner = keypoints.polygon_owner(annotations.keypoints(parsed).select("id", "point", "x", "y"), annotations.polygons(parsed), "id")
    return owner.select("id", "point", "inside")


@query("SELECT page_id, replace(replace(url, 'http://', '/mnt/a/'), 'https://', '/mnt/b/') AS path FROM pages")
def path_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", annotations.rewrite_paths(F.col("url"), [("http://", "/mnt/a/"), ("https://", "/mnt/b/")]).alias("path"))


@query("SELECT page_id, regexp_replace(regexp_extract(url, '[^/]*$'), '(\\w+-)', '', 'g') AS name FROM pages")
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").withColumn("path", annotations.clean_path(F.col("url")))
    return p.select("page_id", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"))


@query("SELECT event_id, event_id AS start, event_id + CAST(floor(value) AS BIGINT) AS stop FROM events WHERE event_id % 3 <> 0")
def parse_flip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines "a - b # comment", a third of them comments or blank."""
    e = table(spark, sf_dir, "events")
    n = F.col("event_id")
    line = F.when(n % 6 == 0, F.lit("# nothing here")).when(n % 6 == 3, F.lit("   ")).otherwise(F.format_string(" %d -%d   # %s", n, n + F.floor("value").cast("long"), F.col("event_type")))
    return intervals.parse_lines(e.select("event_id", line.alias("line")), "line", "event_id").select("event_id", "start", "stop")


@query("WITH r AS (SELECT event_id, list_concat(CASE WHEN value >= 1 THEN range(event_id, event_id + CAST(floor(value) AS BIGINT) % 7) ELSE [] END, [event_id * 2]) AS a FROM events) SELECT event_id, len(a) AS n, CAST(list_sum(a) AS BIGINT) AS total FROM r")
def expand_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.when(F.col("value") >= 1, F.floor("value").cast("long") % 7).otherwise(F.lit(0).cast("long"))
    text = F.format_string("frames %d-%d, %d", F.col("event_id"), F.col("event_id") + k, F.col("event_id") * 2)
    numbers = intervals.expand_text(text)
    return e.select("event_id", numbers.alias("a")).select("event_id", F.size("a").cast("long").alias("n"), F.aggregate("a", F.lit(0).cast("long"), lambda s, v: s + v).alias("total"))


@query("""SELECT doc_id, concat('sbatch --wrap "', replace(concat('extract --name "', source, '" --lang ', lang, ' /data/', doc_id), '"', '\\"'), '"') AS command FROM documents""")
def batch_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = editing.substitute('extract --name "{source}" --lang {lang} /data/{doc_id}', source=F.col("source"), lang=F.col("lang"), doc_id=F.col("doc_id"))
    return table(spark, sf_dir, "documents").select("doc_id", editing.batch_command(c).alias("command"))


@query("SELECT c_custkey, 'a=1,b=' || CASE WHEN c_nationkey % 2 = 0 THEN 'x' ELSE '2' END || ',c=' || c_mktsegment AS settings FROM customer")
def merged_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defaults, then a file's settings, then explicit ones; unknown keys are dropped."""
    m = lambda **kv: F.create_map(*(x for k, v in kv.items() for x in (F.lit(k), v if not isinstance(v, str) else F.lit(v))))
    file = F.when(F.col("c_nationkey") % 2 == 0, m(b="x", z="9")).otherwise(m(z="9"))
    merged = editing.merged_settings(m(a="1", b="2", c="3"), file, m(c=F.col("c_mktsegment")))
    text = F.array_join(F.array_sort(F.transform(F.map_entries(merged), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
    return table(spark, sf_dir, "customer").select("c_custkey", text.alias("settings"))


@query("SELECT conv_id, turn, role, length(text) AS n_chars FROM conversations")
def task_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written as JSON tasks and read again."""
    c = table(spark, sf_dir, "conversations")
    j = c.select(F.to_json(F.struct("conv_id", "turn", F.struct("role", "text").alias("data"))).alias("json"))
    back = annotations.append_tasks(j, None).select(F.from_json("json", "conv_id bigint, turn bigint, data struct<role:string,text:string>").alias("q"))
    return back.select("q.conv_id", "q.turn", "q.data.role", F.length("q.data.text").cast("long").alias("n_chars"))
