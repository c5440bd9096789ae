"""Queries: action log, association rules, recommendation lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrank.catalog import stand_ins as S
from quillrank.catalog.base import Tables, query, rounded
from quillrank.operators import actions as A, corpus as C, recommend as R, rules as U
from quillrank.session import stage

HOT_MIN = 5
ROUND = ", ".join(f"round({c}, 6) AS {c}" for c in ("confidence", "max_conf", "min_conf", "lift", "kulc", "ir"))


@query("action_matrix", f"WITH {S.ACTIONS_SQL} SELECT * FROM actions")
def action_matrix(t: Tables):
    return S.actions(t)


@query(
    "action_matrix_by_version",
    f"""WITH {S.actions_sql("CAST(split_part(app_version_name, '.', 1) AS INTEGER) >= 6")}
    SELECT action, count(*) AS n, count(DISTINCT user_id) AS users FROM actions GROUP BY 1""",
)
def action_matrix_by_version(t: Tables):
    rows = A.user_item_action(S.raw_log(t), S.songs(t), version_order="version")
    return rows.groupBy("action").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"))


@query(
    "play_threshold",
    f"""WITH {S.ACTIONS_SQL}
    SELECT DISTINCT user_id, item_id, 1 AS preference FROM actions
    WHERE action = 1 AND item_id <> '-1' AND TRY_CAST(extend AS BIGINT) > 60000""",
)
def play_threshold(t: Tables):
    return A.play_threshold(S.actions(t))


@query("bool_matrix", f"WITH {S.BOOL_MATRIX_SQL} SELECT user_id, item_id, 1 AS preference FROM m")
def bool_matrix(t: Tables):
    return U.bool_matrix(S.baskets(t), S.actions(t), S.LAST_DAY)


@query("user_filter", f"WITH {S.CUSTOMER_MATRIX_SQL}, {S.filters_sql((25, 55))} SELECT user_id, item_id FROM mu")
def user_filter(t: Tables):
    return U.filter_users(S.customer_matrix(t), 25, 55).select("user_id", "item_id")


@query(
    "item_filter",
    f"WITH {S.CUSTOMER_MATRIX_SQL}, {S.filters_sql((25, 55), (25, 40))} SELECT user_id, item_id FROM mi",
)
def item_filter(t: Tables):
    return U.filter_items(U.filter_users(S.customer_matrix(t), 25, 55), 25, 40).select("user_id", "item_id")


@query(
    "pair_counts",
    f"WITH {S.CUSTOMER_MATRIX_SQL}, {S.filters_sql()}, {S.pairs_sql()} SELECT * FROM pairs",
)
def pair_counts(t: Tables):
    return U.pair_counts(U.filter_items(U.filter_users(S.customer_matrix(t))))


@query(
    "association_rules",
    f"""WITH {S.CUSTOMER_MATRIX_SQL}, {S.filters_sql()}, {S.pairs_sql()}, {S.RULES_SQL}
    SELECT item_prior, item_posterior, prior_cnt, posterior_cnt, pair_cnt, rank, {ROUND} FROM rules""",
)
def association_rules(t: Tables):
    return rounded(U.mine_rules(S.customer_matrix(t)))


@query(
    "association_metrics",
    f"""WITH {S.CUSTOMER_MATRIX_SQL}, {S.filters_sql((25, 55), (25, 40))}, {S.pairs_sql(2, 4)}, {S.RULES_SQL}
    SELECT item_prior, item_posterior, prior_cnt, posterior_cnt, pair_cnt, rank, {ROUND} FROM rules""",
)
def association_metrics(t: Tables):
    matrix = U.filter_items(U.filter_users(S.customer_matrix(t), 25, 55), 25, 40)
    return rounded(U.association_metrics(U.pair_counts(matrix, 2, 4), matrix))


def prepared(t: Tables):
    """The action table and the item table, which all steps of a daily run read."""
    return stage(S.actions(t), "actions"), stage(S.info(t), "item_info")


def diverse_rules(t: Tables, acts, info):
    matrix = U.bool_matrix(S.baskets(t), acts, S.LAST_DAY)
    return U.diversify_rules(U.mine_rules(matrix), info)


DIVERSE = f"{S.BOOL_MATRIX_SQL}, {S.filters_sql()}, {S.pairs_sql()}, {S.RULES_SQL}, {S.INFO_SQL}, {S.DIVERSE_SQL}"


@query(
    "association_diverse",
    f"""WITH {DIVERSE} SELECT item_prior, item_posterior, prior_cnt, posterior_cnt, pair_cnt, rank, {ROUND},
    debug_info, singer_prior, singer_posterior FROM diverse""",
)
def association_diverse(t: Tables):
    return rounded(diverse_rules(t, *prepared(t)))


def user_priors(acts, info):
    return R.candidate_priors(acts, S.LAST_DAY, info)


@query("candidate_priors", f"WITH {S.ACTIONS_SQL}, {S.INFO_SQL}, {S.PRIORS_SQL} SELECT * FROM priors")
def candidate_priors(t: Tables):
    return user_priors(*prepared(t))


def reclist(t: Tables, acts, info):
    return R.recommend(user_priors(acts, info), diverse_rules(t, acts, info))


RECLIST = f"{DIVERSE}, {S.PRIORS_SQL}, {S.RECLIST_SQL}"


@query("recommend_items", f"WITH {RECLIST} SELECT * FROM reclist")
def recommend_items(t: Tables):
    return reclist(t, *prepared(t))


DEFAULT_SQL = f"""
titles AS (
  SELECT max(song_id) AS item_id, song_name, max(singer_id) AS singer_id, count(*) AS hot
  FROM actions JOIN info ON song_id = item_id WHERE ds = '{S.LAST_DAY}' AND singer_name <> 'BRAND#13'
  GROUP BY song_name HAVING count(*) > {HOT_MIN}),
defaults AS (
  SELECT 'default' AS user_id, item_id, CAST(0 AS DOUBLE) AS score, rank, '' AS rec_reason, '' AS debug_info,
         singer_id
  FROM (SELECT *, row_number() OVER (ORDER BY hot, item_id) AS rank FROM titles)
  ORDER BY {S.hash_unit_sql('item_id', 7)}, item_id LIMIT 300)"""


def defaults(acts, info):
    return R.default_list(acts, info, S.LAST_DAY, HOT_MIN, excluded_singer="BRAND#13", seed=7)


@query("default_list", f"WITH {S.ACTIONS_SQL}, {S.INFO_SQL}, {DEFAULT_SQL} SELECT * FROM defaults")
def default_list(t: Tables):
    return defaults(*prepared(t))


@query("list_with_default", f"WITH {RECLIST}, {DEFAULT_SQL} SELECT * FROM defaults UNION ALL SELECT * FROM reclist")
def list_with_default(t: Tables):
    acts, info = prepared(t)
    return R.list_with_default(defaults(acts, info), reclist(t, acts, info))


@query(
    "random_hot",
    f"""WITH {S.ACTIONS_SQL}, {S.INFO_SQL}, {S.RANDOM_HOT_SQL}
    SELECT item_id, rank, concat(coalesce(song_id, ''), '|', coalesce(song_name, ''), '|',
           coalesce(singer_name, ''), '|') AS debug_info
    FROM random_hot LEFT JOIN info ON song_id = item_id""",
)
def random_hot(t: Tables):
    return R.random_hot(S.actions(t), S.LAST_DAY, seed=7, info=S.info(t))


@query(
    "reclist_packed",
    f"""WITH {RECLIST}, {DEFAULT_SQL}, {S.RANDOM_HOT_SQL},
    users AS (SELECT user_id FROM defaults UNION SELECT user_id FROM reclist),
    filled AS (
      SELECT user_id, item_id, rank FROM reclist WHERE rank <= 300
      UNION ALL
      SELECT user_id, item_id, rank + 1000 FROM users CROSS JOIN random_hot WHERE rank <= 300),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rank) AS rank2 FROM filled)
    SELECT 'rules_001_' || user_id AS user_id, string_agg(item_id, ',' ORDER BY rank2) AS reclist
    FROM numbered WHERE rank2 <= 300 GROUP BY 1""",
)
def reclist_packed(t: Tables):
    acts, info = prepared(t)
    hot = R.random_hot(acts, S.LAST_DAY, seed=7)
    return R.fill_and_pack(reclist(t, acts, info), hot, "rules_001_", defaults=defaults(acts, info))


@query(
    "basket_corpus",
    f"""WITH {S.ACTIONS_SQL}
    SELECT user_id, string_agg(item_id, ' ' ORDER BY item_id) AS list
    FROM (SELECT DISTINCT user_id, item_id FROM actions
          WHERE action = 1 AND item_id <> '-1' AND TRY_CAST(extend AS BIGINT) > 90000)
    GROUP BY 1 HAVING count(*) BETWEEN 5 AND 50""",
)
def basket_corpus(t: Tables):
    return C.basket_corpus(S.actions(t))


@query(
    "top_buyers_first",
    """SELECT rnk, user_id, buy_cnt, strftime(first_time, '%Y-%m-%d %H:%M:%S') AS first_time
    FROM (SELECT *, row_number() OVER (ORDER BY buy_cnt DESC, user_id) AS rnk
          FROM (SELECT user_id, count(*) AS buy_cnt, min(ts) AS first_time FROM events
                WHERE event_type = 'purchase' GROUP BY 1))
    WHERE rnk <= 10""",
)
def top_buyers_first(t: Tables):
    acted = t.events.select(
        "user_id", F.col("ts").alias("timestamp"), F.when(F.col("event_type") == "purchase", 2).otherwise(1).alias("action")
    )
    best = A.top_buyers_first_purchase(acted)
    return best.withColumn("first_time", F.date_format("first_time", "yyyy-MM-dd HH:mm:ss"))


_RECALL_SQL = """
bought AS (
  SELECT c_mktsegment AS segment, l_partkey AS item_id, CAST(sum(l_quantity) AS DOUBLE) AS score
  FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2),
segments AS (SELECT DISTINCT c_mktsegment AS segment FROM customer),
picked AS (SELECT segment, p_partkey AS item_id, CAST(p_size AS DOUBLE) AS score FROM part
           JOIN segments ON segment = CASE p_type WHEN 'ECONOMY' THEN 'MACHINERY' ELSE 'BUILDING' END
           WHERE p_retailprice > 950)"""


@query(
    "recall_merge",
    f"""WITH {_RECALL_SQL},
    tagged AS (SELECT *, 1 AS priority, 'picked' AS source FROM picked
               UNION ALL SELECT *, 2, 'bought' FROM bought),
    first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY segment, item_id
              ORDER BY priority, score DESC) AS d FROM tagged) WHERE d = 1)
    SELECT segment, item_id, priority, source, round(score, 6) AS score, rank
    FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY priority, score DESC, item_id) AS rank FROM first)
    WHERE rank <= 300""",
)
def recall_merge(t: Tables):
    bought = (
        t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"))
        .join(t.orders.select("o_custkey", "o_orderkey"), F.col("c_custkey") == F.col("o_custkey"))
        .join(t.lineitem.select("l_orderkey", "l_partkey", "l_quantity"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("segment", F.col("l_partkey").alias("item_id"))
        .agg(F.sum("l_quantity").alias("score"))
    )
    target = F.when(F.col("p_type") == "ECONOMY", "MACHINERY").otherwise("BUILDING")
    picked = t.part.filter("p_retailprice > 950").select(
        target.alias("segment"), F.col("p_partkey").alias("item_id"), F.col("p_size").cast("double").alias("score")
    )
    real = t.customer.select(F.col("c_mktsegment").alias("segment"))
    picked = picked.join(real, "segment", "left_semi")
    return rounded(R.merge_recall({"picked": picked, "bought": bought}, ["segment"], 300))


@query(
    "bid_ranking",
    """SELECT l_orderkey, l_linenumber, round(score, 4) AS score, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, l_linenumber, l_partkey) AS rank
      FROM (SELECT l_orderkey, l_linenumber, l_partkey,
                   CAST(pow(l_discount + 0.01::DOUBLE, 0.5) * l_extendedprice AS DOUBLE) AS score FROM lineitem))
    WHERE rank <= 3""",
)
def bid_ranking(t: Tables):
    ads = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.struct("l_linenumber", "l_partkey").alias("ad"),
        (F.col("l_discount") + 0.01).alias("pctr"),
        F.col("l_extendedprice").alias("cpc"),
    )
    best = R.bid_ranking(ads, ["l_orderkey"], "ad", 3, power=0.5)
    return rounded(best.select("l_orderkey", "l_linenumber", "score", "rank"), 4)


@query(
    "version_pointer",
    """SELECT 'rules_001' AS versionname, '1,' || d || ',' || d AS content, 1 AS item_type,
    'daily_rec' AS scene FROM (SELECT strftime(max(ts), '%Y%m%d') AS d FROM events)""",
)
def version_pointer(t: Tables):
    last = t.events.agg(F.date_format(F.max("ts"), "yyyyMMdd").alias("d"))
    return R.version_pointer(last, "rules_001")
