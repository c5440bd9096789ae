"""Queries: feature engineering and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrank.catalog.base import Tables, query, rounded
from quillrank.catalog.measures import IMPRESSIONS, impressions
from quillrank.catalog.stand_ins import hash_unit_sql
from quillrank.operators import features as X, sampling as P


def sized(t: Tables):
    """lineitem with a 0/1 label."""
    return t.lineitem.withColumn("label", (F.col("l_returnflag") == "R").cast("int"))


LABEL = "CAST(l_returnflag = 'R' AS INTEGER)"


@query(
    "scaled",
    """WITH s AS (SELECT avg(l_extendedprice) AS a, stddev_samp(l_extendedprice) AS d, min(l_extendedprice) AS lo,
                         max(l_extendedprice) AS hi FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, round((l_extendedprice - a) / d, 6) AS z,
           round((l_extendedprice - lo) / (hi - lo), 6) AS minmax, round(ln(1 + l_extendedprice), 6) AS log
    FROM lineitem, s""",
)
def scaled(t: Tables):
    out = X.scaled(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"), ["l_extendedprice"])
    named = out.withColumnsRenamed({f"l_extendedprice_{c}": c for c in ("z", "minmax", "log")})
    return rounded(named.drop("l_extendedprice"))


@query(
    "clip_fill_flags",
    """WITH m AS (SELECT avg(nullif(l_discount, 0)) AS mean FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity > 25 AS INTEGER) AS many,
           CAST(nullif(l_discount, 0) IS NULL AS INTEGER) AS d_missing,
           round(coalesce(nullif(l_discount, 0), mean), 6) AS d_filled,
           round(least(l_quantity, (SELECT quantile_disc(l_quantity, 0.9) FROM lineitem)), 6) AS l_quantity_clipped
    FROM lineitem, m""",
)
def clip_fill_flags(t: Tables):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.nullif("l_discount", F.lit(0.0)).alias("d")
    )
    out = X.clip_peaks(X.filled(rows, "d"), "l_quantity", 0.9)
    return rounded(out.withColumn("many", X.binarized("l_quantity", 25)).drop("d", "l_quantity"))


@query(
    "bins_width",
    """WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
    SELECT bin, count(*) AS n FROM (SELECT CAST(least(floor((o_totalprice - lo) / (hi - lo) * 10) + 1, 10) AS BIGINT)
      AS bin FROM orders, s) GROUP BY 1""",
)
def bins_width(t: Tables):
    return X.width_bins(t.orders, "o_totalprice", 10).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def freq_sql(table: str, value: str, bins: int, label: str = "0") -> str:
    return f"""
    v AS (SELECT {value} AS value, count(*) AS n, sum({label}) AS pos FROM {table} GROUP BY 1),
    b AS (SELECT *, CAST(floor(coalesce(sum(n) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
            0) * {bins}::DOUBLE / (SELECT sum(n) FROM v)) AS BIGINT) AS bin FROM v)"""


@query("bins_freq", f"WITH {freq_sql('lineitem', 'l_extendedprice', 40)} SELECT value, n, bin FROM b")
def bins_freq(t: Tables):
    counts = t.lineitem.groupBy(F.col("l_extendedprice").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return X.frequency_bins(counts, 40)


@query(
    "bins_manual",
    """SELECT CAST(l_quantity >= 5 AS BIGINT) + CAST(l_quantity >= 20 AS BIGINT) + CAST(l_quantity >= 45 AS BIGINT)
    AS bin, count(*) AS n FROM lineitem GROUP BY 1""",
)
def bins_manual(t: Tables):
    return t.lineitem.groupBy(X.manual_bin("l_quantity", [5, 20, 45]).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "bins_gini",
    f"""WITH {freq_sql('lineitem', 'l_extendedprice', 50, LABEL)},
    p AS (SELECT bin, min(value) AS edge, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(pos) AS DOUBLE) AS pos FROM b
          GROUP BY 1),
    s AS (SELECT edge, sum(n) OVER w AS nl, sum(pos) OVER w AS pl, sum(n) OVER () AS n, sum(pos) OVER () AS p FROM p
          WINDOW w AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    g AS (SELECT edge, (nl * (1 - pow(pl / nl, 2) - pow(1 - pl / nl, 2))
            + (n - nl) * (1 - pow((p - pl) / (n - nl), 2) - pow(1 - (p - pl) / (n - nl), 2))) / n AS gini
          FROM s WHERE nl IS NOT NULL)
    SELECT round(edge, 6) AS edge, round(gini, 6) AS gini FROM g ORDER BY round(g.gini, 12), edge LIMIT 1""",
)
def bins_gini(t: Tables):
    return rounded(X.best_split(sized(t), "l_extendedprice", "label", 50))


@query(
    "count_encode",
    """SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_partkey) AS l_partkey_count
    FROM lineitem""",
)
def count_encode(t: Tables):
    return X.count_encoded(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey")


@query(
    "number_encode",
    """SELECT p_name, cnt, row_number() OVER (ORDER BY cnt DESC, p_name) AS code
    FROM (SELECT p_name, count(*) AS cnt FROM part GROUP BY 1)""",
)
def number_encode(t: Tables):
    return X.number_encoding(t.part, "p_name")


@query(
    "one_hot",
    """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS o_orderstatus_F,
    CAST(o_orderstatus = 'O' AS INTEGER) AS o_orderstatus_O, CAST(o_orderstatus = 'P' AS INTEGER) AS o_orderstatus_P
    FROM orders""",
)
def one_hot(t: Tables):
    return X.one_hot(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O", "P"]).drop("o_orderstatus")


@query(
    "hash_encode",
    f"""SELECT p_partkey, p_name, CAST(floor({hash_unit_sql('p_name', 0)} * 100000) AS INTEGER) AS p_name_hash
    FROM part""",
)
def hash_encode(t: Tables):
    return X.hashed(t.part.select("p_partkey", "p_name"), "p_name", 100_000)


@query(
    "target_encode",
    f"""WITH c AS (SELECT l_partkey, count(*) AS exposure, CAST(sum({LABEL}) AS DOUBLE) AS click FROM lineitem
    GROUP BY 1)
    SELECT l_partkey, exposure, click, round((click + 20 * (SELECT sum(click) / sum(exposure) FROM c))
           / (exposure + 20), 6) AS encoded FROM c""",
)
def target_encode(t: Tables):
    return rounded(X.target_encoding(sized(t), "l_partkey", "label", 20))


@query(
    "target_encode_past",
    """SELECT event_id, user_id, round((coalesce(sum(CAST(event_type = 'purchase' AS INTEGER)) OVER w, 0) + 4)
      / (count(*) OVER w + 20), 6) AS encoded
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def target_encode_past(t: Tables):
    rows = t.events.select("event_id", "user_id", "ts", (F.col("event_type") == "purchase").cast("int").alias("bought"))
    out = X.past_target_encoding(rows, "user_id", "ts", "event_id", "bought", added=20, prior=0.2)
    return rounded(out.select("event_id", "user_id", "encoded"))


@query(
    "label_transfer",
    """WITH l AS (SELECT o_custkey, p_brand, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                  JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
    SELECT o_custkey, p_brand, n, round(n / sum(n) OVER (PARTITION BY o_custkey), 6) AS share FROM l""",
)
def label_transfer(t: Tables):
    bought = t.orders.select("o_orderkey", "o_custkey").join(
        t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey")), "o_orderkey"
    )
    return rounded(X.label_transfer(bought, t.part, "o_custkey", "p_partkey", "p_brand"))


@query(
    "label_transfer_reverse",
    """WITH l AS (SELECT l_partkey, c_mktsegment, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                  JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)
    SELECT l_partkey, c_mktsegment, n, round(n / sum(n) OVER (PARTITION BY l_partkey), 6) AS share FROM l""",
)
def label_transfer_reverse(t: Tables):
    bought = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(
        t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey"), "o_orderkey"
    )
    return rounded(X.label_transfer(bought, t.customer, "l_partkey", "c_custkey", "c_mktsegment"))


@query(
    "category_stats",
    """SELECT l_suppkey, count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean,
    round(stddev_samp(l_extendedprice), 4) AS std, round(max(l_extendedprice), 4) AS max FROM lineitem GROUP BY 1""",
)
def category_stats(t: Tables):
    return rounded(X.category_stats(t.lineitem, "l_suppkey", "l_extendedprice"), 4)


@query(
    "price_in_category",
    """SELECT l_orderkey, l_linenumber, l_suppkey, count(*) OVER (PARTITION BY l_suppkey) AS n,
    round(l_extendedprice / avg(l_extendedprice) OVER (PARTITION BY l_suppkey), 6) AS ratio FROM lineitem""",
)
def price_in_category(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    out = X.with_category_stats(rows, "l_suppkey", "l_extendedprice")
    return rounded(out.select("l_orderkey", "l_linenumber", "l_suppkey", "n", "ratio"))


@query(
    "share_rank",
    """WITH s AS (SELECT l_returnflag, l_suppkey, sum(l_quantity) AS amount FROM lineitem GROUP BY 1, 2)
    SELECT l_returnflag, l_suppkey, round(amount, 4) AS amount,
           round(amount / sum(amount) OVER (PARTITION BY l_returnflag), 6) AS share,
           rank() OVER (PARTITION BY l_returnflag ORDER BY amount DESC) AS rank FROM s""",
)
def share_rank(t: Tables):
    return rounded(X.shares(t.lineitem, "l_suppkey", "l_returnflag", "l_quantity"))


@query(
    "trend",
    """WITH s AS (SELECT o_custkey, year(o_orderdate) AS y, sum(o_totalprice) AS amount FROM orders GROUP BY 1, 2),
    c AS (SELECT *, amount - lag(amount) OVER (PARTITION BY o_custkey ORDER BY y) AS change FROM s)
    SELECT o_custkey, CAST(y AS INTEGER) AS y, round(amount, 2) AS amount, round(change, 2) AS change,
           round(change / nullif(amount - change, 0), 2) AS growth FROM c""",
)
def trend(t: Tables):
    yearly = t.orders.withColumn("y", F.year("o_orderdate"))
    return rounded(X.trend(yearly, ["o_custkey"], "y", "o_totalprice"), 2)


@query(
    "crosses",
    """SELECT o_orderstatus || '_x_' || o_orderpriority AS crossed, count(*) AS n,
    round(sum(o_totalprice * CAST(o_orderstatus = 'F' AS INTEGER)), 2) AS weighted FROM orders GROUP BY 1""",
)
def crosses(t: Tables):
    rows = t.orders.select(
        X.crossed("o_orderstatus", "o_orderpriority").alias("crossed"),
        (F.col("o_totalprice") * (F.col("o_orderstatus") == "F").cast("int")).alias("w"),
    )
    return rounded(rows.groupBy("crossed").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("weighted")), 2)


@query(
    "time_space",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday,
    CAST(dayofweek(ts) IN (0, 6) AS INTEGER) AS weekend, CAST(day(ts) AS INTEGER) AS day,
    CAST(month(ts) AS INTEGER) AS month,
    CAST(CAST(floor(value / 25.0) AS BIGINT) AS VARCHAR) || '_' || CAST(CAST(floor(user_id / 25.0) AS BIGINT) AS VARCHAR)
      AS cell FROM events""",
)
def time_space(t: Tables):
    return t.events.select("event_id", *X.time_features("ts"), X.grid_cell("value", "user_id", 25.0).alias("cell"))


@query(
    "history_features",
    f"""WITH {IMPRESSIONS},
    h AS (SELECT event_id, item, count(*) OVER w AS past_n, coalesce(sum(click) OVER w, 0) AS s FROM impressions
          WINDOW w AS (PARTITION BY item ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT event_id, item, past_n, round(CAST(s AS DOUBLE), 6) AS past_sum, round(s / nullif(past_n, 0), 6)
      AS past_mean FROM h""",
)
def history_features(t: Tables):
    out = X.history(impressions(t), "item", "ts", "event_id", "click")
    return rounded(out.select("event_id", "item", "past_n", "past_sum", "past_mean"))


@query(
    "user_value",
    """WITH d AS (SELECT user_id, strftime(ts, '%Y%m%d') AS day, coalesce(sum(value) FILTER (event_type = 'purchase'),
      0) AS paid, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT user_id, count(*) AS active_days, min(day) AS first_day, max(day) AS last_day,
           CAST(sum(n) AS BIGINT) AS actions, round(sum(paid), 4) AS ltv, round(sum(paid) / count(*), 4) AS arpu
    FROM d GROUP BY 1""",
)
def user_value(t: Tables):
    paid = F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0.0)
    return rounded(X.user_value(t.events, "user_id", F.date_format("ts", "yyyyMMdd"), paid), 4)


@query(
    "retention",
    """WITH a AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events)
    SELECT strftime(x.day, '%Y-%m-%d') AS day, count(*) AS users, count(y.user_id) AS returned,
           round(count(y.user_id) / count(*), 6) AS rate
    FROM a x LEFT JOIN a y ON y.user_id = x.user_id AND y.day = x.day + 3 GROUP BY 1""",
)
def retention(t: Tables):
    out = X.retention(t.events, "user_id", F.to_date("ts"), 3)
    return rounded(out.withColumn("day", F.date_format("day", "yyyy-MM-dd")))


FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value, {LABEL} AS label FROM lineitem" for f in FEATURES
) + ")"


@query(
    "feature_information",
    f"""WITH {LONG},
    c AS (SELECT feature, value, CAST(count(*) AS DOUBLE) AS n, CAST(sum(label) AS DOUBLE) AS pos FROM long
          GROUP BY 1, 2),
    t AS (SELECT feature, sum(n) AS tn, sum(pos) AS tp, sum(n) - sum(pos) AS tq FROM c GROUP BY 1),
    h AS (SELECT c.feature, count(*) AS levels, any_value(tn) AS tn, any_value(tp) AS tp, any_value(tq) AS tq,
      sum(n / tn * (1 - pow(pos / n, 2) - pow(1 - pos / n, 2))) AS gini_in,
      sum(-n / tn * ((CASE WHEN pos > 0 THEN pos / n * ln(pos / n) ELSE 0 END)
          + (CASE WHEN pos < n THEN (1 - pos / n) * ln(1 - pos / n) ELSE 0 END))) AS ent_in,
      sum(-n / tn * ln(n / tn)) AS split,
      sum(pow(pos - n * tp / tn, 2) / (n * tp / tn) + pow(n - pos - n * tq / tn, 2) / (n * tq / tn)) AS chi2
      FROM c JOIN t ON t.feature = c.feature GROUP BY 1)
    SELECT feature, levels, round(1 - pow(tp / tn, 2) - pow(tq / tn, 2) - gini_in, 6) AS gini_gain,
           round(-tp / tn * ln(tp / tn) - tq / tn * ln(tq / tn) - ent_in, 6) AS info_gain,
           round((-tp / tn * ln(tp / tn) - tq / tn * ln(tq / tn) - ent_in) / split, 6) AS gain_ratio,
           round(chi2, 4) AS chi2 FROM h""",
)
def feature_information(t: Tables):
    out = rounded(X.feature_information(sized(t), FEATURES, "label"))
    return out.withColumn("chi2", F.round("chi2", 4))


@query(
    "feature_auc",
    f"""WITH {LONG},
    c AS (SELECT feature, value, sum(label) AS pos, sum(1 - label) AS neg FROM long GROUP BY 1, 2),
    b AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY feature ORDER BY value
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c)
    SELECT feature, CAST(sum(pos) AS BIGINT) AS pos, CAST(sum(neg) AS BIGINT) AS neg,
           round(sum(pos * (below + neg / 2.0::DOUBLE)) / CAST(sum(pos) * sum(neg) AS DOUBLE), 6) AS auc
    FROM b GROUP BY 1""",
)
def feature_auc(t: Tables):
    return rounded(X.feature_auc(sized(t), FEATURES, "label"))


@query(
    "feature_moments",
    f"""WITH {LONG},
    m AS (SELECT feature, corr(value, label) AS corr, avg(value) AS m, count(*) FILTER (label = 0) AS n0,
            count(*) FILTER (label = 1) AS n1, avg(value) FILTER (label = 0) AS m0, avg(value) FILTER (label = 1) AS m1,
            var_pop(value) FILTER (label = 0) AS v0, var_pop(value) FILTER (label = 1) AS v1 FROM long GROUP BY 1)
    SELECT feature, round(corr, 6) AS corr,
           round((n0 * pow(m0 - m, 2) + n1 * pow(m1 - m, 2)) / (n0 * v0 + n1 * v1), 6) AS variance_ratio FROM m""",
)
def feature_moments(t: Tables):
    return rounded(X.feature_moments(sized(t), FEATURES, "label"))


# Samples -----------------------------------------------------------------------------------------------------------


@query(
    "drop_negatives",
    f"""SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS label FROM orders
    WHERE o_orderstatus = 'F' OR {hash_unit_sql('o_orderkey', 3)} < 0.1::DOUBLE""",
)
def drop_negatives(t: Tables):
    rows = t.orders.select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    return P.drop_negatives(rows, "o_orderkey", "label", 0.1, seed=3)


@query(
    "skip_above",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {LABEL} AS label FROM lineitem
    JOIN (SELECT l_orderkey AS k, max(l_linenumber) AS last FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
    ON k = l_orderkey WHERE l_linenumber <= last""",
)
def skip_above(t: Tables):
    rows = sized(t).select("l_orderkey", "l_linenumber", "l_partkey", "label")
    return P.skip_above(rows, "l_orderkey", "l_linenumber", "label")


@query(
    "folds",
    f"""SELECT fold, part, count(*) AS n FROM (
      SELECT CAST(floor({hash_unit_sql('o_orderkey', 5)} * 5) AS BIGINT) AS fold,
             CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 'train' ELSE 'test' END AS part FROM orders)
    GROUP BY 1, 2""",
)
def folds(t: Tables):
    split = P.time_split(t.orders, "o_orderdate", "1997-01-01")
    return split.groupBy(P.fold("o_orderkey", 5, 5).alias("fold"), "part").agg(F.count(F.lit(1)).alias("n"))


@query(
    "ab_split",
    f"""SELECT c_custkey, CASE WHEN s < 10 THEN 'new' WHEN s < 60 THEN 'old' END AS arm FROM (
      SELECT c_custkey, CAST(floor({hash_unit_sql('c_custkey', 'rank1')} * 100) AS BIGINT) AS s FROM customer)""",
)
def ab_split(t: Tables):
    return t.customer.select("c_custkey", P.ab_group("c_custkey", "rank1", {"new": 10, "old": 50}).alias("arm"))


POISSON = [0.36787944117144233]
for _i in range(1, 12):
    POISSON.append(POISSON[-1] / _i)
_CUM, _total = [], 0.0
for _p in POISSON:
    _total += _p
    _CUM.append(_total)


@query(
    "bootstrap",
    f"""SELECT o_orderkey, {' + '.join(f'CAST(u >= {c!r}::DOUBLE AS INTEGER)' for c in _CUM)} AS times FROM (
      SELECT o_orderkey, {hash_unit_sql('o_orderkey', 11)} AS u FROM orders)""",
)
def bootstrap(t: Tables):
    return t.orders.select("o_orderkey", P.bootstrap_weight("o_orderkey", 11).alias("times"))
