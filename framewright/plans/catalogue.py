"""Queries over the supplied tables, with the SQL that checks them.

The tables hold no video, so a user stands for a video, 'view' events for low-fidelity frames, 'click' events for
high-fidelity ones, and embeddings for pixels. Times are seconds since 2024-01-01.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vectors as V
from ..operators import batching, clean, curate, dedup, extract, match, pairing, progress
from ..params import Params

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
P = Params(match_threshold=0.2)
#: Scores are compared as they are, and rounded to be shown.
SHOWN = "round(score, 6) + 0.0D AS score"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds(ts: str = "ts"):
    """Independent of the session's time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', {ts})") / 1e6


def frames(spark, sf_dir: str, kind: str, side: str) -> DataFrame:
    """(video, <side>_frame, <side>_ts, event_id) of one kind of event."""
    e = table(spark, sf_dir, "events").where(F.col("event_type") == kind)
    number = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.select(F.col("user_id").alias("video"), T.frame_name(number).alias(f"{side}_frame"), seconds().alias(f"{side}_ts"), "event_id", "ts")


def sides(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    by = Window.partitionBy("video")
    lr = frames(spark, sf_dir, "view", "lr").withColumn("duration", F.max("lr_ts").over(by) - F.min("lr_ts").over(by))
    return lr, frames(spark, sf_dir, "click", "hr")


def pixels(spark, sf_dir: str, df: DataFrame, name: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias(name))
    n = max(1, e.count())  # from the files' footers
    return df.withColumn("vec_id", F.col("event_id") % n).join(e, "vec_id").drop("vec_id")


_FRAMES = """
f AS (SELECT user_id AS video, event_type, event_id,
        (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1e6 AS t,
        'frame_' || lpad(CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS VARCHAR), 6, '0') || '.png' AS frame
      FROM events),
lr AS (SELECT video, frame AS lr_frame, t AS lr_ts, event_id, max(t) OVER (PARTITION BY video) - min(t) OVER (PARTITION BY video) AS duration
       FROM f WHERE event_type = 'view'),
hr AS (SELECT video, frame AS hr_frame, t AS hr_ts, event_id FROM f WHERE event_type = 'click'),
lw AS (SELECT *, CASE WHEN duration > 0 THEN duration ELSE 10.0::DOUBLE / 0.06::DOUBLE END * 0.06::DOUBLE AS w FROM lr),
cand AS (SELECT l.video, l.lr_frame, l.lr_ts, h.hr_frame, h.hr_ts, l.event_id AS le, h.event_id AS he
         FROM lw l JOIN hr h ON l.video = h.video AND h.hr_ts BETWEEN l.lr_ts - l.w AND l.lr_ts + l.w)"""
_SCORED = """,
n AS (SELECT count(*) AS n FROM embeddings),
px AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
c0 AS (SELECT vec_id, e, list_sum(e) / len(e) AS m FROM px),
c1 AS (SELECT vec_id, list_transform(e, lambda x: x - m) AS c FROM c0),
u AS (SELECT vec_id, list_transform(c, lambda x: x / sqrt(list_inner_product(c, c))) AS u FROM c1),
scored AS (SELECT video, lr_frame, lr_ts, hr_frame, hr_ts, list_inner_product(a.u, b.u) AS score
           FROM cand CROSS JOIN n JOIN u a ON a.vec_id = le % n.n JOIN u b ON b.vec_id = he % n.n),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY video, lr_frame ORDER BY score DESC, hr_frame) = 1)"""


@query(
    f"""WITH {_FRAMES}{_SCORED},
over_ AS (SELECT * FROM best WHERE score >= 0.2),
top AS (SELECT *, greatest(-1.0, coalesce(max(hr_ts) OVER (PARTITION BY video ORDER BY lr_ts, lr_frame
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1.0)) AS top FROM over_)
SELECT video, lr_frame, lr_ts, hr_frame, hr_ts, round(score, 6) + 0.0 AS score FROM top WHERE hr_ts >= top"""
)
def temporal_match(spark, sf_dir):
    """Flagship: interval candidates, correlation, best candidate, threshold, monotone order."""
    lr, hr = sides(spark, sf_dir)
    found = match.temporal_match(pixels(spark, sf_dir, lr, "lr_pixels"), pixels(spark, sf_dir, hr, "hr_pixels"), P)
    return found.selectExpr("video", "lr_frame", "lr_ts", "hr_frame", "hr_ts", SHOWN)


@query(f"WITH {_FRAMES} SELECT video, lr_frame, count(*) AS candidates, min(hr_frame) AS first_candidate FROM cand GROUP BY ALL")
def interval_candidates(spark, sf_dir):
    lr, hr = sides(spark, sf_dir)
    found = match.interval_join(lr.withColumn("w", match.window_of(F.col("duration"))).drop("event_id", "ts"), hr.drop("event_id", "ts"))
    return found.groupBy("video", "lr_frame").agg(F.count(F.lit(1)).alias("candidates"), F.min("hr_frame").alias("first_candidate"))


@query(f"WITH {_FRAMES}{_SCORED} SELECT video, lr_frame, hr_frame, round(score, 6) + 0.0 AS score FROM best")
def best_match_topk(spark, sf_dir):
    lr, hr = sides(spark, sf_dir)
    lr = pixels(spark, sf_dir, lr.withColumn("w", match.window_of(F.col("duration"))), "lr_pixels").drop("event_id", "ts")
    hr = pixels(spark, sf_dir, hr, "hr_pixels").drop("event_id", "ts")
    return match.best_candidates(lr, hr).selectExpr("video", "lr_frame", "hr_frame", SHOWN)


@query(
    """WITH p AS (SELECT user_id AS video, event_id, value AS hr_ts, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 1e6 AS lr_ts
  FROM events WHERE event_type = 'purchase'),
t AS (SELECT *, greatest(-1.0, coalesce(max(hr_ts) OVER (PARTITION BY video ORDER BY lr_ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1.0)) AS top FROM p)
SELECT video, event_id, hr_ts FROM t WHERE hr_ts >= top"""
)
def monotone_filter(spark, sf_dir):
    e = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    rows = e.select(F.col("user_id").alias("video"), "event_id", F.col("event_id").alias("lr_frame"), seconds().alias("lr_ts"), F.col("value").alias("hr_ts"))
    return match.monotone(rows).select("video", "event_id", "hr_ts")


@query(
    """WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  UNION ALL SELECT -1, 0, list_transform(range(64), lambda x: 1.0::DOUBLE)),
x AS (SELECT vec_id, label, v, list_sum(v) / len(v) AS m FROM e),
c AS (SELECT vec_id, label, list_transform(v, lambda z: z - m) AS c FROM x),
s AS (SELECT vec_id, label, c, list_inner_product(c, c) AS ss FROM c),
k AS (SELECT DISTINCT label, min(vec_id) OVER (PARTITION BY label) AS first_id FROM s)
SELECT a.vec_id AS lr_id, b.vec_id AS hr_id,
  CASE WHEN a.ss = 0 THEN 1.0 WHEN b.ss = 0 THEN 0.0 ELSE round(list_inner_product(a.c, b.c) / sqrt(a.ss * b.ss), 6) + 0.0 END AS score
FROM s a JOIN k ON a.label = k.label JOIN s b ON b.vec_id = k.first_id"""
)
def ncc_pairs(spark, sf_dir):
    """Every vector against the first of its label; a constant vector stands for a flat image."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    flat = spark.range(1).select(F.lit(-1).cast("long").alias("vec_id"), F.lit(0).alias("label"), F.array_repeat(F.lit(1.0), 64).alias("v"))
    every = e.unionByName(flat)
    firsts = every.groupBy("label").agg(F.min_by(F.struct("vec_id", "v"), "vec_id").alias("b"))
    return every.join(firsts, "label").select(
        F.col("vec_id").alias("lr_id"), F.col("b.vec_id").alias("hr_id"), (F.round(V.ncc("v", F.col("b.v")), 6) + 0.0).alias("score")
    )


_HASHES = """
px AS (SELECT *, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
md AS (SELECT *, (list_sort(v)[32] + list_sort(v)[33]) / 2 AS med FROM px),
hs AS (SELECT vec_id, label, v, CAST(list_sum(list_transform(range(1, 65), lambda i: CASE WHEN v[i] > med THEN
         CASE WHEN i = 64 THEN CAST(-9223372036854775808 AS HUGEINT) ELSE CAST(1::BIGINT << CAST(i - 1 AS INTEGER) AS HUGEINT) END ELSE 0 END)) AS BIGINT) AS h FROM md)"""


@query(
    f"""WITH {_HASHES}, first AS (SELECT label, min(vec_id) AS f FROM hs GROUP BY label)
SELECT a.vec_id, a.label, b.vec_id AS first_id, CAST(bit_count(xor(a.h, b.h)) AS INTEGER) AS distance
FROM hs a JOIN first f ON a.label = f.label JOIN hs b ON b.vec_id = f.f"""
)
def phash_hamming(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", V.median_hash(F.col("embedding").cast("array<double>")).alias("h"))
    firsts = e.groupBy("label").agg(F.min_by(F.struct("vec_id", "h"), "vec_id").alias("b"))
    return e.join(firsts, "label").select("vec_id", "label", F.col("b.vec_id").alias("first_id"), V.hamming("h", F.col("b.h")).alias("distance"))


def _fold_sql(rows: str, t: int) -> str:
    """The fold as a recursion over each group's rows; rows is a common table expression src(g, i, h, z)."""
    return f"""WITH RECURSIVE {rows},
s AS (SELECT g, {{'i': i, 'h': h, 'z': z}} AS x, row_number() OVER (PARTITION BY g ORDER BY i, h, z) AS n FROM src),
fold AS (
  SELECT DISTINCT g, CAST(0 AS BIGINT) AS n, CAST([] AS STRUCT(i BIGINT, h BIGINT, z BIGINT)[]) AS k, CAST([] AS BIGINT[]) AS r FROM src
  UNION ALL
  SELECT g, n,
    CASE WHEN m IS NULL THEN list_append(k, x) WHEN x.z < m.z THEN k
      WHEN len(list_filter(k, lambda e: e.i <> m.i AND e.h = x.h)) > 0
        THEN list_transform(list_filter(k, lambda e: e.i <> m.i), lambda e: CASE WHEN e.h = x.h THEN x ELSE e END)
      ELSE list_append(list_filter(k, lambda e: e.i <> m.i), x) END,
    CASE WHEN m IS NULL THEN r WHEN x.z < m.z THEN list_append(r, x.i) ELSE list_append(r, m.i) END
  FROM (SELECT f.g, s.n, f.k, f.r, s.x, list_filter(f.k, lambda e: bit_count(xor(e.h, s.x.h)) < {t})[1] AS m
        FROM fold f JOIN s ON f.g IS NOT DISTINCT FROM s.g AND s.n = f.n + 1)),
gone AS (SELECT g, unnest(r) AS i FROM (SELECT g, r FROM fold QUALIFY row_number() OVER (PARTITION BY g ORDER BY n DESC) = 1))"""


@query(
    _fold_sql(f"{_HASHES}, src AS (SELECT label AS g, vec_id AS i, h, (vec_id * 7919) % 101 AS z FROM hs)", 24)
    + " SELECT label, vec_id, h FROM hs WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.g = label AND gone.i = vec_id)"
)
def dedup_greedy(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(
        "label", F.col("vec_id").alias("i"), V.median_hash(F.col("embedding").cast("array<double>")).alias("h"), (F.col("vec_id") * 7919 % 101).alias("z")
    )
    return dedup.greedy_dedup(e, ["label"], 24).select("label", F.col("i").alias("vec_id"), "h")


_TEXT_HASH = "CAST('0x' || substr(md5(text), 1, 15) AS BIGINT)"


@query(
    _fold_sql(f"src AS (SELECT source AS g, doc_id AS i, {_TEXT_HASH} AS h, n_chars AS z FROM documents)", 4)
    + " SELECT source, doc_id FROM documents WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.g = source AND gone.i = doc_id)"
)
def dedup_documents(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(
        "source", F.col("doc_id").alias("i"), F.conv(F.substring(F.md5("text"), 1, 15), 16, 10).cast("long").alias("h"), F.col("n_chars").alias("z")
    )
    return dedup.greedy_dedup(d, ["source"], 4).select("source", F.col("i").alias("doc_id"))


@query(
    """WITH v AS (SELECT vec_id, round(list_var_pop(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 9) AS lr_var FROM embeddings),
p AS (SELECT a.vec_id, a.lr_var, b.lr_var AS hr_var FROM v a LEFT JOIN v b ON b.vec_id = a.vec_id + 1)
SELECT vec_id, lr_var, lr_var < 0.0154 OR coalesce(hr_var < 0.0154, false) AS low FROM p"""
)
def low_info(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.round(V.var_pop(F.col("embedding").cast("array<double>")), 9).alias("lr_var"))
    twin = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("lr_var").alias("hr_var"))
    p = Params(variance_threshold=0.0154, check_hr_variance=True)
    return v.join(twin, "vec_id", "left").select("vec_id", "lr_var", clean.low_info("lr_var", "hr_var", p).alias("low"))


@query(
    """WITH px AS (SELECT vec_id, unnest(embedding) AS v, unnest(range(64)) AS i FROM embeddings),
b AS (SELECT vec_id, min(i % 8) AS x_min, min(i // 8) AS y_min, max(i % 8) + 1 AS x_max, max(i // 8) + 1 AS y_max FROM px WHERE CAST(v AS DOUBLE) > 0.18 GROUP BY vec_id)
SELECT e.vec_id, CAST(coalesce(x_min, -1) AS INTEGER) AS x_min, CAST(coalesce(y_min, -1) AS INTEGER) AS y_min,
  CAST(coalesce(x_max, -1) AS INTEGER) AS x_max, CAST(coalesce(y_max, -1) AS INTEGER) AS y_max,
  coalesce(x_max - x_min >= 4 AND y_max - y_min >= 4 AND NOT (x_max - x_min = 8 AND y_max - y_min = 8), false) AS cropped
FROM embeddings e LEFT JOIN b ON b.vec_id = e.vec_id"""
)
def content_bbox(spark, sf_dir):
    """Embeddings as images of 8 x 8."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", V.bounding_box(F.col("embedding").cast("array<double>"), 8, 0.18).alias("box"))
    applies = clean.crop_applies("box", F.lit(8), F.lit(8), Params(min_content_dimension=4))
    sides_ = [F.coalesce(F.col(f"box.{k}"), F.lit(-1)).alias(k) for k in ("x_min", "y_min", "x_max", "y_max")]
    return e.select("vec_id", *sides_, applies.alias("cropped"))


@query(
    """WITH s AS (SELECT p_partkey, p_size, p_retailprice, (p_partkey % 97) / 97.0::DOUBLE AS a, (p_partkey % 89) / 89.0::DOUBLE AS b FROM part)
SELECT p_partkey, abs((p_size::DOUBLE / 9) - (16.0::DOUBLE / 9)) >= 0.05 AS differs,
  CASE WHEN a > b AND a > 0.75 THEN 'crop_hr' WHEN b > a AND b > 0.75 THEN 'crop_lr' ELSE 'none' END AS winner FROM s"""
)
def crop_contest(spark, sf_dir):
    s = table(spark, sf_dir, "part").select(
        "p_partkey", "p_size", (F.col("p_partkey") % 97 / F.lit(97.0)).alias("a"), (F.col("p_partkey") % 89 / F.lit(89.0)).alias("b")
    )
    return s.select("p_partkey", clean.aspect_differs("p_size", F.lit(9), F.lit(16), F.lit(9)).alias("differs"), clean.contest("a", "b").alias("winner"))


@query(
    """WITH m AS (SELECT user_id, event_id, ts, value, lag(value, 1, 0.0) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events),
s AS (SELECT user_id, event_id, least(greatest(least(value, abs(value - b)) / 100, 0.0), 1.0) AS scene FROM m)
SELECT user_id, event_id, round(scene, 6) + 0.0 AS scene FROM s WHERE scene > 0.2"""
)
def scene_cut(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")
    return extract.scene_cuts(e, "user_id", ("ts", "event_id"), "value").select("user_id", "event_id", (F.round("scene", 6) + 0.0).alias("scene"))


@query(
    """WITH n AS (SELECT user_id, list('frame_' || event_id ORDER BY event_id) AS names FROM events WHERE event_type = 'view' GROUP BY user_id),
t AS (SELECT user_id, list(value ORDER BY event_id) AS times FROM events WHERE event_type = 'click' GROUP BY user_id),
j AS (SELECT user_id, unnest(names) AS name, unnest(range(1, len(names) + 1)) AS pos, times FROM n JOIN t USING (user_id))
SELECT user_id, name, coalesce(times[pos], times[-1]) AS ts_s FROM j"""
)
def timestamp_reconcile(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    listed = lambda kind, value, name: (
        e.where(F.col("event_type") == kind).groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", value.alias("v")))), lambda s: s["v"]).alias(name))
    )
    names = listed("view", F.concat(F.lit("frame_"), F.col("event_id").cast("string")), "names")
    both = names.join(listed("click", F.col("value"), "times"), "user_id").withColumn("times", extract.reconcile("names", "times"))
    return both.where("times IS NOT NULL").select("user_id", F.explode(F.arrays_zip("names", "times")).alias("x")).select(
        "user_id", F.col("x.names").alias("name"), F.col("x.times").alias("ts_s")
    )


@query(
    r"""WITH l AS (SELECT event_id, '[Parsed_showinfo_3 @ 0x1] n: ' || event_id || ' pts_time:' ||
    CASE WHEN event_id % 5 = 0 THEN '-' ELSE '' END || (event_id % 1000) || CASE WHEN event_id % 3 = 0 THEN '' ELSE '.' || (event_id % 7) END || ' duration' AS line FROM events)
SELECT event_id, TRY_CAST(regexp_extract(line, '\[Parsed_showinfo.*pts_time:(\d+\.?\d*)', 1) AS DOUBLE) AS pts FROM l"""
)
def pts_parse(spark, sf_dir):
    i = F.col("event_id")
    line = F.concat(
        F.lit("[Parsed_showinfo_3 @ 0x1] n: "), i.cast("string"), F.lit(" pts_time:"), F.when(i % 5 == 0, "-").otherwise(""), (i % 1000).cast("string"),
        F.when(i % 3 == 0, "").otherwise(F.concat(F.lit("."), (i % 7).cast("string"))), F.lit(" duration"),
    )
    return table(spark, sf_dir, "events").select("event_id", T.pts_time(line).alias("pts"))


@query(
    """SELECT p_partkey, coalesce(CASE WHEN t + b + g = 0 THEN NULL ELSE (t + b)::DOUBLE / (t + b + g) END > 0.25, false) AS interlaced
FROM (SELECT p_partkey, p_size % 4 AS t, p_size % 3 AS b, p_partkey % 13 AS g FROM part)"""
)
def idet_rule(spark, sf_dir):
    log = F.format_string(
        "Multi frame detection: TFF:  %d BFF: %d Progressive: %d Undetermined: 9",
        F.col("p_size") % 4, F.col("p_size") % 3, F.col("p_partkey") % 13,
    )
    c = table(spark, sf_dir, "part").select("p_partkey", T.interlace_counts(log).alias("c"))
    return c.select("p_partkey", T.is_interlaced("c.tff", "c.bff", "c.progressive").alias("interlaced"))


@query(
    """SELECT p_partkey, p_partkey % 11 <> 0 AND (p_size % 5 = 0 OR p_size % 5 = 1 OR p_size % 7 = 0 OR p_partkey % 6 = 0) AS hdr,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_size + 0.5::DOUBLE END AS duration FROM part"""
)
def hdr_rule(spark, sf_dir):
    size, key = F.col("p_size"), F.col("p_partkey")
    transfer = F.when(size % 5 == 0, "smpte2084").when(size % 5 == 1, "arib-std-b67").otherwise("bt709")
    json = F.concat(
        F.lit('{"streams":[{"color_transfer":"'), transfer, F.lit('","color_primaries":"'), F.when(size % 7 == 0, "bt2020").otherwise("bt709"),
        F.lit('","side_data_list":['), F.when(key % 6 == 0, F.lit('{"side_data_type":"Dolby Vision"}')).when(key % 6 == 1, F.lit('{"side_data_type":"Dolby Vision Metadata"}')).otherwise(""), F.lit("]}]}"),
    )
    probe = F.when(key % 11 == 0, "{broken").otherwise(json)
    seconds_ = F.when(key % 11 == 0, "N/A").otherwise(F.concat(F.lit(" "), (size + F.lit(0.5)).cast("string"), F.lit(" ")))
    return table(spark, sf_dir, "part").select("p_partkey", T.is_hdr(probe).alias("hdr"), T.duration(seconds_).alias("duration"))


@query(
    """WITH x AS (SELECT p_partkey, CASE p_partkey % 2 WHEN 0 THEN 'LR' ELSE 'HR' END AS side,
  ['none', 'auto', 'lr', 'hr', 'both'][1 + p_size % 5] AS mode, ['auto', 'hr_only', 'lr_only', 'both', 'off'][1 + p_partkey % 5] AS hm,
  p_size % 3 = 0 AS i, p_size % 2 = 0 AS h FROM part)
SELECT p_partkey, concat_ws(',', CASE WHEN (mode = 'auto' AND i) OR mode = 'both' OR (mode = 'lr' AND side = 'LR') OR (mode = 'hr' AND side = 'HR') THEN 'bwdif=mode=send_frame:parity=auto' END,
  'scale=sws_flags=lanczos:in_color_matrix=bt709,format=yuv444p', CASE WHEN (hm = 'auto' AND h) OR hm = 'both' OR (hm = 'hr_only' AND side = 'HR') OR (hm = 'lr_only' AND side = 'LR')
    THEN 'zscale=t=linear:npl=100,tonemap=tonemap=hable,zscale=p=bt709:t=bt709:m=bt709,format=bgr24' END,
  'select=''gt(scene,0.2)'',showinfo') AS chain FROM x"""
)
def filter_chain(spark, sf_dir):
    size, key = F.col("p_size"), F.col("p_partkey")
    pick = lambda n, *x: F.element_at(F.array(*map(F.lit, x)), (n % len(x) + 1).cast("int"))
    chain = T.filter_chain(
        F.when(key % 2 == 0, "LR").otherwise("HR"), size % 3 == 0, size % 2 == 0, 0.2, Params(hdr_tone_mapping=True),
        pick(size, "none", "auto", "lr", "hr", "both"), pick(key, "auto", "hr_only", "lr_only", "both", "off"),
    )
    return table(spark, sf_dir, "part").select("p_partkey", chain.alias("chain"))


_STEMS = r"""
v AS (SELECT page_id, url, regexp_replace(regexp_extract(url, '([^/]*)$', 1), '[?#].*$', '') AS name, page_id % 2 = 0 AS is_lr FROM pages),
k AS (SELECT *, lower(name) AS stem_key FROM v)"""


def _videos(spark, sf_dir):
    """Pages as files of two sides, stems from the URL's last part."""
    name = F.regexp_replace(T.file_name("url"), r"[?#].*$", "")
    return table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"), F.lower(name).alias("stem_key"), (F.col("page_id") % 2 == 0).alias("is_lr"))


@query(
    f"""WITH {_STEMS}, o AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY is_lr, stem_key ORDER BY url DESC, page_id DESC) = 1)
SELECT a.stem_key, a.url AS lr, b.url AS hr FROM o a JOIN o b ON a.stem_key = b.stem_key AND a.is_lr AND NOT b.is_lr"""
)
def pair_by_stem(spark, sf_dir):
    one = pairing.last_by_stem(_videos(spark, sf_dir), by=("is_lr",))
    lr, hr = one.where("is_lr").select("stem_key", F.col("path").alias("lr")), one.where("NOT is_lr").select("stem_key", F.col("path").alias("hr"))
    return pairing.pair(lr, hr, ["stem_key"])


@query(f"WITH {_STEMS} SELECT is_lr, count(*) AS files, count(DISTINCT stem_key) AS stems FROM k GROUP BY is_lr")
def stem_quality(spark, sf_dir):
    return pairing.stem_quality(_videos(spark, sf_dir), by=("is_lr",))


@query(
    f"""WITH {_STEMS} SELECT DISTINCT stem_key, CASE WHEN is_lr THEN 'LR' ELSE 'HR' END AS side FROM k a
WHERE NOT EXISTS (SELECT 1 FROM k b WHERE b.stem_key = a.stem_key AND b.is_lr <> a.is_lr)"""
)
def unmatched_stems(spark, sf_dir):
    v = _videos(spark, sf_dir)
    return pairing.unmatched(v.where("is_lr"), v.where("NOT is_lr"), ["stem_key"])


@query("SELECT user_id FROM events WHERE event_type = 'view' INTERSECT SELECT user_id FROM events WHERE event_type = 'click'")
def common_keys(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return pairing.common(e.where("event_type = 'view'"), e.where("event_type = 'click'"), ["user_id"])


@query(
    """SELECT a.user_id, a.frame, a.e AS lr_event, b.e AS hr_event FROM
 (SELECT user_id, event_id AS e, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS frame FROM events WHERE event_type = 'view') a JOIN
 (SELECT user_id, event_id AS e, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS frame FROM events WHERE event_type = 'click') b
 ON a.user_id = b.user_id AND a.frame = b.frame"""
)
def frame_equi_join(spark, sf_dir):
    """Pairs by video and frame number, as the content fix and the low-information filter pair them."""
    e = table(spark, sf_dir, "events")
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    side = lambda kind, name: e.where(F.col("event_type") == kind).select(
        "user_id", F.row_number().over(by).cast("long").alias("frame"), F.col("event_id").alias(name)
    )
    return pairing.pair(side("view", "lr_event"), side("click", "hr_event"), ["user_id", "frame"])


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')")
def frame_semi(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return pairing.existing(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), o, ["l_orderkey"])


@query(
    """SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)"""
)
def progress_anti(spark, sf_dir):
    """Labelled rows stand for logged items."""
    log = table(spark, sf_dir, "labels").where("quality = 1").select(
        F.lit("match").alias("stage"), F.col("doc_id").cast("string").alias("item"), F.lit(False).alias("completed"), F.col("doc_id").alias("seq")
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.col("doc_id").cast("string").alias("key"))
    return progress.pending(docs, log, "match", "key").select("doc_id", "source")


@query(
    """WITH d AS (SELECT doc_id, 'd' || doc_id || '.png' AS name FROM documents)
SELECT name, doc_id % 3 <> 0 AS has_hr, doc_id % 4 = 0 AS has_overlay FROM d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.toxic = 1 AND l.doc_id = d.doc_id)"""
)
def align_results(spark, sf_dir):
    """Outputs without artifacts, with HR and overlay where there are any."""
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".png"))
    d = table(spark, sf_dir, "documents").select("doc_id", name.alias("name"))
    bad = table(spark, sf_dir, "labels").where("toxic = 1").select(F.concat(F.lit(" "), name, F.lit(" ")).alias("name"))
    return batching.collect_results(d.select("name"), bad, d.where("doc_id % 3 <> 0"), d.where("doc_id % 4 = 0"))


@query("SELECT o_orderkey, count(l_orderkey) AS lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_quantity > 45 GROUP BY o_orderkey")
def optional_left(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"), "l_orderkey")
    return pairing.optional(table(spark, sf_dir, "orders").select("o_orderkey"), lines, ["o_orderkey"]).groupBy("o_orderkey").agg(F.count("l_orderkey").alias("lines"))


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def cascade_delete(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return clean.cascade(docs, table(spark, sf_dir, "labels").where("toxic = 1"), ["doc_id"])


@query(
    r"""WITH n AS (SELECT user_id, CASE event_id % 4 WHEN 0 THEN 'v_' || user_id || '_frame_' || event_id || '.png' WHEN 1 THEN 'v_' || user_id || '_frame_1.jpg'
  WHEN 2 THEN 'x.png' ELSE 'w_frame_a_' || user_id || '_frame_000012.png' END AS name FROM events),
g AS (SELECT name, regexp_extract(name, '^(.*?)_frame_\d+\.png$', 1) AS video FROM n)
SELECT video, count(*) AS images, min(name) AS first_name FROM g WHERE video <> '' GROUP BY video"""
)
def group_by_regex(spark, sf_dir):
    i, u = F.col("event_id"), F.col("user_id").cast("string")
    name = (
        F.when(i % 4 == 0, F.concat(F.lit("v_"), u, F.lit("_frame_"), i.cast("string"), F.lit(".png")))
        .when(i % 4 == 1, F.concat(F.lit("v_"), u, F.lit("_frame_1.jpg")))
        .when(i % 4 == 2, F.lit("x.png"))
        .otherwise(F.concat(F.lit("w_frame_a_"), u, F.lit("_frame_000012.png")))
    )
    named = table(spark, sf_dir, "events").select(name.alias("name")).withColumn("video", T.video_of("name"))
    return named.where("video IS NOT NULL").groupBy("video").agg(F.count(F.lit(1)).alias("images"), F.min("name").alias("first_name"))


@query(
    """WITH b AS (SELECT source AS video, doc_id AS name, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 50 AS INTEGER) AS batch FROM documents),
c AS (SELECT *, CAST(max(batch) OVER (PARTITION BY video) + 1 AS INTEGER) AS batches FROM b)
SELECT video, name, batch, batches, CASE WHEN batches > 1 THEN '_batch_' || (batch + 1) ELSE '' END AS suffix FROM c"""
)
def batch_chunks(spark, sf_dir):
    return batching.batches(table(spark, sf_dir, "documents").select(F.col("source").alias("video"), F.col("doc_id").alias("name")))


_LOG = """l AS (SELECT event_type AS stage, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'u' || user_id END AS item,
  CASE WHEN event_id % 5 = 0 THEN true WHEN event_id % 7 = 0 THEN false END AS completed, event_id AS seq FROM events)"""


def _log(spark, sf_dir):
    i = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("stage"),
        F.when(i % 3 != 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("item"),
        F.when(i % 5 == 0, True).when(i % 7 == 0, False).alias("completed"),
        i.alias("seq"),
    )


@query(
    f"""WITH {_LOG} SELECT stage, array_to_string(list_sort(list(DISTINCT item) FILTER (WHERE item IS NOT NULL)), ',') AS items,
  coalesce(arg_max(coalesce(completed, false), seq) FILTER (WHERE item IS NOT NULL OR coalesce(completed, false)), false) AS completed FROM l GROUP BY stage"""
)
def progress_upsert(spark, sf_dir):
    return progress.state(_log(spark, sf_dir)).select("stage", F.array_join("items", ",").alias("items"), "completed")


@query(f"WITH {_LOG} SELECT stage, count(DISTINCT item) AS items FROM l WHERE item IS NOT NULL GROUP BY stage")
def stage_summary(spark, sf_dir):
    return progress.summary(_log(spark, sf_dir))


@query("SELECT epoch_us(ts) // 1800000000 AS slot, count(*) AS lines, 0 AS images, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY ALL")
def heartbeat_tumbling(spark, sf_dir):
    """Tumbling windows of half an hour; slot counts them from 1970."""
    from ..streaming.streams import heartbeat

    lines = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("at"), F.col("event_type").alias("text"))
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast(window.start AS timestamp_ntz))")
    return heartbeat(lines, "at", "30 minutes", value="text").select((micros / 1800000000).cast("long").alias("slot"), "lines", "images", "errors")


@query(
    r"""SELECT conv_id, turn, text LIKE '%.png' AND NOT regexp_matches(text, '(?i)warning|futurewarning|error') AS image_line,
  NOT regexp_matches(text, '(?i)warning|futurewarning|error') AS shown, right(text, 1000) AS tail,
  array_to_string(list_slice(string_split(text, chr(10)), greatest(len(string_split(text, chr(10))) - 9, 1), len(string_split(text, chr(10)))), chr(10)) AS last_lines
FROM conversations"""
)
def log_filters(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", T.is_image_line("text").alias("image_line"), T.is_shown("text").alias("shown"), T.last_chars("text").alias("tail"), T.last_lines("text").alias("last_lines")
    )


@query(
    """SELECT c_custkey, round(c_acctbal / 60, 1) + 0.0 AS minutes, round(c_acctbal / 3600, 2) + 0.0 AS hours,
 c_acctbal >= 1800.0 AND c_acctbal <= 5400.0 AS in_range FROM customer"""
)
def time_rules(spark, sf_dir):
    p = Params(begin_time="00:30:00", end_time="01:30:00")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", (T.minutes("c_acctbal") + 0.0).alias("minutes"), (T.hours("c_acctbal") + 0.0).alias("hours"), T.in_range("c_acctbal", p).alias("in_range")
    )


@query(
    _fold_sql(
        f"""{_HASHES}, rated AS (SELECT vec_id, label, h, round(list_sum(v) / 64, 6) + 0.0 AS brightness, round(list_var_pop(v), 6) + 0.0 AS complexity FROM hs),
ok AS (SELECT * FROM rated WHERE complexity >= 0.0150), src AS (SELECT label AS g, vec_id AS i, h, vec_id % 10 AS z FROM ok)""",
        24,
    )
    + " SELECT label, vec_id, brightness, complexity FROM ok WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.g = label AND gone.i = vec_id)"
)
def curate_embeddings(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("label", F.col("vec_id").alias("i"), (F.col("vec_id") % 10).alias("z"), F.col("embedding").cast("array<double>").alias("features"))
    return curate.curate(e, group=("label",), min_complexity=0.0150).select("label", F.col("i").alias("vec_id"), "brightness", "complexity")


@query(
    """SELECT a.user_id, a.event_id AS lr_event, b.event_id AS hr_event FROM events a JOIN events b ON a.user_id = b.user_id
WHERE a.event_type = 'view' AND b.event_type = 'click' AND b.ts BETWEEN a.ts - INTERVAL 6 HOUR AND a.ts + INTERVAL 6 HOUR"""
)
def stream_interval_join(spark, sf_dir):
    """The interval join as a stream-stream join that reads what there is and ends."""
    from ..streaming.streams import interval_join_stream

    return interval_join_stream(spark, f"{sf_dir}/events.parquet")


@query("SELECT user_id AS video, min(event_id) AS first_event, count(*) AS n FROM events GROUP BY user_id")
def stream_group_counts(spark, sf_dir):
    from ..streaming.streams import grouped_counts_stream

    return grouped_counts_stream(spark, f"{sf_dir}/events.parquet")


@query(
    """WITH n AS (SELECT l_orderkey, l_linenumber, l_comment FROM (SELECT l_orderkey, l_linenumber, '/in/' || (l_orderkey % 50) || '/' || CASE l_linenumber % 3
    WHEN 0 THEN 'Clip.' WHEN 1 THEN 'My.Clip.' ELSE 'clip' END || l_suppkey || CASE l_partkey % 4 WHEN 0 THEN '.MKV' WHEN 1 THEN '.mp4' WHEN 2 THEN '.txt' ELSE '.Png' END AS l_comment FROM lineitem))
SELECT l_orderkey, l_linenumber, lower(regexp_replace(regexp_extract(l_comment, '([^/]*)$', 1), '\\.[^.]*$', '')) AS stem,
  regexp_matches(l_comment, '(?i)\\.(avi|mp4|mkv|ts|mpg|mpeg|mov|flv|wmv|webm)$') AS video, regexp_matches(l_comment, '(?i)\\.(png|jpg|jpeg)$') AS image FROM n"""
)
def file_names(spark, sf_dir):
    """Endings and stems of paths."""
    line, part = F.col("l_linenumber"), F.col("l_partkey") % 4
    name = F.when(line % 3 == 0, "Clip.").when(line % 3 == 1, "My.Clip.").otherwise("clip")
    end = F.when(part == 0, ".MKV").when(part == 1, ".mp4").when(part == 2, ".txt").otherwise(".Png")
    path = F.concat(F.lit("/in/"), (F.col("l_orderkey") % 50).cast("string"), F.lit("/"), name, F.col("l_suppkey").cast("string"), end)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", path.alias("path"))
    return rows.select("l_orderkey", "l_linenumber", T.stem_key("path").alias("stem"), T.is_video("path").alias("video"), T.is_image("path").alias("image"))


@query(
    """WITH n AS (SELECT user_id, 'frame_' || lpad(CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS VARCHAR), 6, '0') || '.png' AS name,
  value FROM events WHERE event_type = 'purchase') SELECT user_id, name, value AS ts_s FROM n"""
)
def named_times(spark, sf_dir):
    """A video's frames and times as one map, taken apart again."""
    e = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    number = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    f = e.select("user_id", T.frame_name(number).alias("name"), "value")
    listed = f.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("name", "value"))).alias("f"))
    mapped = listed.select("user_id", extract.name_times(F.col("f.name"), F.col("f.value")).alias("m"))
    return mapped.select("user_id", F.explode("m").alias("name", "ts_s"))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 'error' ELSE 'line' END AS kind, event_type AS text FROM events")
def tagged_lines(spark, sf_dir):
    from ..streaming.streams import drain, events_stream, tagged

    lines = events_stream(spark, f"{sf_dir}/events.parquet").select("event_id", F.col("event_type").alias("value"))
    return drain(tagged(lines, "value", keep=("event_id",)))


@query(
    """SELECT 'LR' AS side, video, name || '_frame_000007.png' AS name FROM (SELECT user_id AS video, user_id || '' AS name FROM events WHERE event_type = 'view' GROUP BY user_id)
UNION ALL SELECT 'HR', video, name || '_frame_000007.png' FROM (SELECT user_id AS video, user_id || '' AS name FROM events WHERE event_type = 'view' GROUP BY user_id)"""
)
def matched_sets(spark, sf_dir):
    """Both sides of a matched pair under the LR frame's name."""
    from ..sources.sinks import matched_set

    users = table(spark, sf_dir, "events").where("event_type = 'view'").select(F.col("user_id").alias("video")).distinct()
    pairs = users.withColumn("lr_frame", F.lit("frame_000007.png")).withColumn("hr_frame", F.lit("frame_000009.png"))
    return matched_set(pairs).select("side", "video", "name")
