"""Queries: reports, snapshots, sources and sinks, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrank.catalog import stand_ins as S
from quillrank.catalog.base import Tables, query, rounded
from quillrank.catalog.model_queries import training
from quillrank.catalog.search_queries import leads
from quillrank.functions import doubles
from quillrank.operators import corpus as C, distinct as D, reports as V
from quillrank.session import run_dir
from quillrank.sources import readers, sinks
from quillrank.streaming import counters, decayed, kmeans


def hits(events):
    """events as page hits: the item is the page."""
    url = F.concat(F.lit("/item/"), F.get_json_object("props", "$.k"))
    return events.select("event_id", "ts", "user_id", "event_type", "value", url.alias("url"))


HITS = "hits AS (SELECT *, '/item/' || json_extract_string(props, '$.k') AS url FROM events)"


@query(
    "pageviews",
    f"""WITH {HITS} SELECT url, count(event_id) AS time
    FROM (SELECT '/item/' || CAST(p_partkey AS VARCHAR) AS url FROM part) LEFT JOIN hits USING (url) GROUP BY 1""",
)
def pageviews(t: Tables):
    pages = t.part.select(F.concat(F.lit("/item/"), F.col("p_partkey").cast("string")).alias("url"))
    return V.page_views(pages, hits(t.events))


@query(
    "pv_uv_daily",
    f"""WITH {HITS} SELECT strftime(ts, '%Y-%m-%d') AS day, url, count(*) AS pv, count(DISTINCT user_id) AS uv
    FROM hits GROUP BY 1, 2""",
)
def pv_uv_daily(t: Tables):
    rows = hits(t.events).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return V.pv_uv(rows, ["day", "url"], "user_id")


@query("pv_uv_site", "SELECT event_type, count(*) AS pv, count(DISTINCT user_id) AS uv FROM events GROUP BY 1")
def pv_uv_site(t: Tables):
    return V.pv_uv(t.events, ["event_type"], "user_id")


@query(
    "reading_time",
    r"""WITH w AS (SELECT doc_id, len(list_filter(regexp_split_to_array(lower(text), '[\s\-]+'),
      lambda x: length(x) > 0)) AS words FROM documents)
    SELECT doc_id, words, CAST(ceil(words / 300) AS BIGINT) AS minutes FROM w""",
)
def reading_time(t: Tables):
    return V.reading_time(t.documents.select("doc_id", "text"), "doc_id", "text")


@query(
    "reading_total",
    r"""WITH w AS (SELECT CAST(sum(len(list_filter(regexp_split_to_array(lower(text), '[\s\-]+'),
      lambda x: length(x) > 0))) AS BIGINT) AS words FROM documents)
    SELECT words, CAST(ceil(words / 300) AS BIGINT) AS minutes FROM w""",
)
def reading_total(t: Tables):
    return V.reading_total(t.documents.select("doc_id", "text"), "doc_id", "text")


@query(
    "archive_rollup",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS posts
    FROM orders GROUP BY ROLLUP (year(o_orderdate), month(o_orderdate))""",
)
def archive_rollup(t: Tables):
    return V.archive_counts(t.orders, "o_orderdate")


@query(
    "tag_counts",
    """WITH c AS (SELECT tag, count(*) AS posts FROM (SELECT p_partkey, unnest(list_distinct(
      string_split(p_name, ' ') || [p_brand, p_type])) AS tag FROM part) GROUP BY 1)
    SELECT * FROM (SELECT *, row_number() OVER (ORDER BY posts DESC, tag) AS rank FROM c) WHERE rank <= 300""",
)
def tag_counts(t: Tables):
    return V.tag_counts(t.part, F.concat(F.split("p_name", " "), F.array("p_brand", "p_type")))


@query(
    "newest_pages",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, rank, (rank - 1) // 10 AS page FROM (
      SELECT event_id, ts, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS rank FROM events) WHERE rank <= 100""",
)
def newest_pages(t: Tables):
    best = V.newest_pages(t.events, "ts", "event_id")
    return best.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query(
    "month_snapshot",
    """WITH m AS (SELECT o_custkey, last_day(o_orderdate) AS month_end,
      max_by(o_orderkey, strftime(o_orderdate, '%Y%m%d') || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS k FROM orders
      GROUP BY 1, 2),
    g AS (SELECT CAST(unnest(generate_series((SELECT date_trunc('month', min(o_orderdate)) FROM orders),
                 (SELECT date_trunc('month', max(o_orderdate)) FROM orders), INTERVAL 1 MONTH)) AS DATE) AS d),
    f AS (SELECT c.o_custkey, last_day(g.d) AS month_end,
                 last_value(m.k IGNORE NULLS) OVER (PARTITION BY c.o_custkey ORDER BY g.d) AS k
          FROM (SELECT DISTINCT o_custkey FROM orders) c CROSS JOIN g
          LEFT JOIN m ON m.o_custkey = c.o_custkey AND m.month_end = last_day(g.d))
    SELECT f.o_custkey, strftime(f.month_end, '%Y-%m-%d') AS month_end, o_orderstatus, o_totalprice
    FROM f JOIN orders ON o_orderkey = k""",
)
def month_snapshot(t: Tables):
    snap = V.month_snapshot(t.orders, "o_custkey", "o_orderdate", "o_orderkey", ["o_orderstatus", "o_totalprice"])
    return snap.withColumn("month_end", F.date_format("month_end", "yyyy-MM-dd"))


KINDS = ["click", "error", "purchase", "signup", "view"]


@query(
    "wide_daily",
    "SELECT user_id, strftime(ts, '%Y%m%d') AS day, "
    + ", ".join(f"round(sum(value) FILTER (event_type = '{k}'), 4) AS \"{k}\"" for k in KINDS)
    + " FROM events GROUP BY 1, 2",
)
def wide_daily(t: Tables):
    rows = t.events.withColumn("day", F.date_format("ts", "yyyyMMdd"))
    return rounded(V.wide(rows, ["user_id", "day"], "event_type", "value", KINDS), 4)


@query(
    "tall_daily",
    """SELECT user_id, strftime(ts, '%Y%m%d') AS day, event_type AS name, round(sum(value), 4) AS value FROM events
    GROUP BY 1, 2, 3""",
)
def tall_daily(t: Tables):
    rows = t.events.withColumn("day", F.date_format("ts", "yyyyMMdd"))
    table = V.wide(rows, ["user_id", "day"], "event_type", "value", KINDS)
    return rounded(V.tall(table, ["user_id", "day"], KINDS), 4)


# Sources and sinks: written to the shared folder and read back ------------------------------------------------------


@query(
    "training_csv",
    """SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS label,
      'c' || CAST(c_custkey AS VARCHAR) || ';' || c_mktsegment || ';' || CAST(c_nationkey AS VARCHAR) AS user_features,
      round(1.75, 3)::DOUBLE AS user_weight,
      o_orderpriority || ';' || CAST(year(o_orderdate) AS VARCHAR) || ';any' AS ads_features,
      CAST(3 AS INTEGER) AS ads_weights
    FROM orders JOIN customer ON c_custkey = o_custkey""",
)
def training_csv(t: Tables):
    path = run_dir(t.spark, "training")
    join = lambda c: F.array_join(F.col(c).cast("array<string>"), ";").alias(c)
    lists = ("user_features", "user_weights", "ads_features", "ads_weights")
    training(t).select(F.col("label").cast("double").alias("label"), *[join(c) for c in lists]).write.csv(path)
    rows = readers.training_csv(t.spark, path)
    return rows.select(
        "label",
        F.array_join("user_features", ";").alias("user_features"),
        F.aggregate("user_weights", F.lit(0.0), lambda s, x: s + x).alias("user_weight"),
        F.array_join("ads_features", ";").alias("ads_features"),
        F.size("ads_weights").alias("ads_weights"),
    )


@query(
    "partition_overwrite",
    f"WITH {S.ACTIONS_SQL} SELECT user_id, item_id, action, ds FROM actions WHERE ds >= '20240111' AND ds <= '20240120'",
)
def partition_overwrite(t: Tables):
    path = run_dir(t.spark, "actions")
    rows = S.actions(t).select("user_id", "item_id", "action", "ds", "item_type")
    sinks.overwrite_partitions(rows, path)
    # The second write replaces its own partitions only and so changes nothing.
    sinks.overwrite_partitions(rows.filter("ds > '20240115'"), path)
    read = t.spark.read.schema(rows.schema).parquet(path)
    return read.filter("ds BETWEEN '20240111' AND '20240120'").select("user_id", "item_id", "action", "ds")


@query(
    "retention_window",
    f"WITH {S.ACTIONS_SQL} SELECT ds, count(*) AS n FROM actions WHERE ds > '20240123' GROUP BY 1",
)
def retention_window(t: Tables):
    return sinks.retained(S.actions(t), S.LAST_DAY, 7).groupBy("ds").agg(F.count(F.lit(1)).alias("n"))


@query(
    "delimited_baskets",
    "SELECT l_orderkey AS songlist_id, l_partkey AS item_id, '-1' AS sq, '20240130' AS ds, 1 AS item_type FROM lineitem",
)
def delimited_baskets(t: Tables):
    lines, table = run_dir(t.spark, "lines"), run_dir(t.spark, "baskets")
    S.baskets(t).select("songlist_id", "item_id", F.lit("-1").alias("sq")).write.option("sep", "\t").csv(lines)
    rows = readers.delimited(t.spark, lines, "songlist_id bigint, item_id bigint, sq string")
    placed = rows.withColumn("ds", F.lit(S.LAST_DAY)).withColumn("item_type", F.lit(1))
    sinks.overwrite_partitions(placed, table)
    return t.spark.read.schema(placed.schema).parquet(table)


@query(
    "corpus_text",
    f"""WITH {S.ACTIONS_SQL}
    SELECT string_agg(item_id, ' ' ORDER BY item_id) AS value
    FROM (SELECT DISTINCT user_id, item_id FROM actions
          WHERE action = 1 AND item_id <> '-1' AND TRY_CAST(extend AS BIGINT) > 90000)
    GROUP BY user_id HAVING count(*) BETWEEN 5 AND 50""",
)
def corpus_text(t: Tables):
    path = run_dir(t.spark, "corpus")
    sinks.text_lines(C.basket_corpus(S.actions(t)), "list", path)
    return t.spark.read.text(path)


@query(
    "key_value_lines",
    """SELECT 'u_' || CAST(user_id AS VARCHAR) || chr(9) || string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id)
    AS value FROM events WHERE event_type = 'purchase' GROUP BY user_id""",
)
def key_value_lines(t: Tables):
    from quillrank.operators.recommend import ordered_items

    path = run_dir(t.spark, "lists")
    bought = t.events.filter("event_type = 'purchase'").groupBy("user_id").agg(
        F.concat_ws(",", ordered_items(F.col("event_id"), F.col("event_id").cast("string"))).alias("list")
    )
    key = F.concat(F.lit("u_"), F.col("user_id").cast("string"))
    sinks.key_values(bought.select(key.alias("key"), "list"), "key", "list", path)
    return t.spark.read.text(path)


WEEKS = """SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, event_type, count(*) AS pv, true AS uv_near
FROM events GROUP BY 1, 2"""


def weeks_near(t: Tables, table):
    """Weeks united from a table of daily sketches; users must lie within 2 % of the exact number."""
    week = lambda c: F.date_format(F.date_trunc("week", c), "yyyy-MM-dd")
    out = D.united(table, week(F.col("day")), ["event_type"]).withColumnRenamed("period", "week")
    exact = t.events.groupBy(week(F.col("ts")).alias("week"), "event_type").agg(F.countDistinct("user_id").alias("users"))
    near = F.abs(F.col("uv") - F.col("users")) <= F.col("users") * 0.02
    return out.join(exact, ["week", "event_type"]).select("week", "event_type", "pv", near.alias("uv_near"))


@query("uv_weekly", WEEKS)
def uv_weekly(t: Tables):
    path = run_dir(t.spark, "daily-users")
    D.save_days(D.daily_sketches(t.events, "ts", "user_id", ["event_type"]), path)
    return weeks_near(t, t.spark.read.parquet(path))


# Streams -----------------------------------------------------------------------------------------------------------


def stream_of(t: Tables, name: str):
    """A table as a stream, whether it is one file or a folder of part files: the pattern names either."""
    return t.spark.readStream.schema(getattr(t, name).schema).parquet(f"{t.folder}/{name}.parque[t]")


def event_stream(t: Tables):
    return hits(stream_of(t, "events")).withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_counts", f"WITH {HITS} SELECT url, count(*) AS time FROM hits GROUP BY 1")
def stream_counts(t: Tables):
    return counters.counted(event_stream(t), "url", "hit-counts")


@query(
    "stream_ctr",
    """WITH w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR * i AS start, event_type
                   FROM events, range(2) r(i) WHERE event_type IN ('view', 'click'))
    SELECT strftime(start, '%Y-%m-%d %H:%M') AS start, strftime(start + INTERVAL 12 HOUR, '%Y-%m-%d %H:%M') AS end,
           count(*) AS exposure, count(*) FILTER (event_type = 'click') AS click,
           round(count(*) FILTER (event_type = 'click') / count(*), 6) AS ctr
    FROM w GROUP BY start""",
)
def stream_ctr(t: Tables):
    shown = event_stream(t).filter(F.col("event_type").isin("view", "click")).withColumn(
        "clicked", (F.col("event_type") == "click").cast("int")
    )
    out = counters.drained(counters.window_ctr(shown, "ts", [], "clicked", "12 hours", "6 hours"), ["start", "end"], "ctr")
    clock = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm").alias(c)
    return rounded(out.select(clock("start"), clock("end"), "exposure", "click", "ctr"))


@query(
    "stream_views",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS pv, true AS uv_near FROM events GROUP BY 1, 2""",
)
def stream_views(t: Tables):
    """Views per day; the approximate number of users must lie within 10 % or one of the exact one."""
    views = counters.window_views(event_stream(t), "ts", "user_id", ["event_type"], "1 day")
    out = counters.drained(views, ["start", "end", "event_type"], "views").withColumn("day", F.date_format("start", "yyyy-MM-dd"))
    exact = t.events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(
        F.countDistinct("user_id").alias("users")
    )
    near = F.abs(F.col("uv") - F.col("users")) <= F.greatest(F.col("users") * 0.1, F.lit(1.0))
    return out.join(exact, ["day", "event_type"]).select("day", "event_type", "pv", near.alias("uv_near"))


@query(
    "stream_decayed_ctr",
    f"""WITH {HITS}, shown AS (SELECT url, ts, event_type, max(ts) OVER (PARTITION BY url) AS last FROM hits
                         WHERE event_type IN ('view', 'click')),
    faded AS (SELECT *, pow(2, -(epoch_us(last) - epoch_us(ts)) / 86400000000::DOUBLE) AS w FROM shown)
    SELECT url, strftime(max(last), '%Y-%m-%d %H:%M:%S') AS last, round(sum(w), 6) AS exposure,
           round(sum(w) FILTER (event_type = 'click') / sum(w), 6) AS ctr
    FROM faded GROUP BY 1 HAVING count(*) FILTER (event_type = 'click') > 0""",
)
def stream_decayed_ctr(t: Tables):
    """Pages with a click: exposures and CTR at their last event, faded by half each day; kept for the whole month."""
    shown = event_stream(t).filter(F.col("event_type").isin("view", "click")).withColumn(
        "clicked", (F.col("event_type") == "click").cast("int")
    )
    live = decayed.decayed_ctr(shown, "ts", "url", "clicked", half_life=86_400, time_out=60 * 86_400, late="31 days")
    out = counters.drained(live, ["url"], "decayed").filter("click > 0")
    return rounded(out.select("url", F.date_format("last", "yyyy-MM-dd HH:mm:ss").alias("last"), "exposure", "ctr"))


@query("stream_uv_weekly", WEEKS)
def stream_uv_weekly(t: Tables):
    """The daily sketches come from the stream."""
    days = D.daily_sketches(event_stream(t), "ts", "user_id", ["event_type"], late=counters.LATE)
    return weeks_near(t, counters.drained(days, ["day", "event_type"], "daily-users"))


@query(
    "stream_kmeans",
    """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    c AS (SELECT vec_id AS id, e AS f FROM v WHERE vec_id IN (SELECT min(vec_id) FROM embeddings GROUP BY label)),
    a AS (SELECT vec_id, any_value(e) AS e, arg_min(id, list_distance(e, f)) AS id FROM v, c GROUP BY 1)
    SELECT id, count(*)::DOUBLE AS n, round(avg(e[1]), 6) AS first, round(avg(e[64]), 6) AS last FROM a GROUP BY 1""",
)
def stream_kmeans(t: Tables):
    first = leads(t).select(F.col("query_id").alias("id"), doubles("embedding").alias("centre"), F.lit(0.0).alias("n"))
    stream = stream_of(t, "embeddings")
    table, state = run_dir(t.spark, "centres"), run_dir(t.spark, "centres-state")
    kmeans.start(stream, first, table, state, "embedding", 0.9).awaitTermination()
    out = kmeans.latest_centres(t.spark, table)
    return rounded(out.select("id", "n", F.col("centre")[0].alias("first"), F.col("centre")[63].alias("last")))
