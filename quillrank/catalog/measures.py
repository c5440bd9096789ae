"""Queries: ranking metrics, click-through rates and calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrank.catalog.base import Tables, query, rounded
from quillrank.catalog.stand_ins import item_of_event
from quillrank.operators import ctr as K, metrics as E
from quillrank.operators.isotonic import isotonic
from quillrank.session import stage


def scored(t: Tables):
    """orders as scored samples: a score in [0, 1) with ties, a 0/1 label, a customer and a segment."""
    score = (F.floor(F.col("o_totalprice") * 100).cast("bigint") % 997).cast("double") / 997.0
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("segment"),
        score.alias("prob"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        (F.col("o_totalprice") / 1000.0).alias("weight"),
    )


SCORED = """
scored AS (
  SELECT o_orderkey AS id, o_custkey AS user_id, o_orderpriority AS segment,
         CAST(CAST(floor(o_totalprice * 100) AS BIGINT) % 997 AS DOUBLE) / 997.0::DOUBLE AS prob,
         CAST(o_orderstatus = 'F' AS INTEGER) AS label, o_totalprice / 1000.0::DOUBLE AS weight
  FROM orders)"""


def auc_sql(rows: str, group: str = "") -> str:
    by = f"{group}, " if group else ""
    part = f"PARTITION BY {group}" if group else ""
    tail = f"GROUP BY {group}" if group else ""
    return f"""
    SELECT {by}CAST(sum(pos) AS BIGINT) AS pos, CAST(sum(neg) AS BIGINT) AS neg,
           round(CAST(sum(pos * (below + neg / 2.0::DOUBLE)) AS DOUBLE)
                 / nullif(CAST(sum(pos) * sum(neg) AS DOUBLE), 0), 6) AS auc
    FROM (SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY prob ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS below
          FROM (SELECT {by}prob, sum(label) AS pos, sum(1 - label) AS neg FROM {rows} GROUP BY {by}prob)) {tail}"""


@query("auc_exact", f"WITH {SCORED} {auc_sql('scored')}")
def auc_exact(t: Tables):
    return rounded(E.auc(scored(t)))


@query("auc_by_user", f"WITH {SCORED} {auc_sql('scored', 'user_id')}")
def auc_by_user(t: Tables):
    return rounded(E.auc(scored(t), group=["user_id"]))


@query("auc_by_segment", f"WITH {SCORED} {auc_sql('scored', 'segment')}")
def auc_by_segment(t: Tables):
    return rounded(E.auc(scored(t), group=["segment"]))


@query(
    "auc_weighted",
    f"""WITH {SCORED}, g AS ({auc_sql('scored', 'user_id').replace('round(', '(').replace(', 6) AS auc', ') AS auc')})
    SELECT count(*) AS groups, round(avg(auc), 6) AS mean_auc,
           round(sum(auc * (pos + neg)) / sum(pos + neg), 6) AS weighted_auc
    FROM g WHERE auc IS NOT NULL""",
)
def auc_weighted(t: Tables):
    return rounded(E.weighted_auc(E.auc(scored(t), group=["user_id"])))


@query(
    "auc_bucketed",
    f"""WITH {SCORED}, h AS (SELECT floor(prob / 0.2::DOUBLE) AS prob, label FROM scored) {auc_sql('h')}""",
)
def auc_bucketed(t: Tables):
    return rounded(E.auc_histogram(scored(t), width=0.2))


@query(
    "auc_topk",
    f"""WITH {SCORED}, top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY prob DESC, id) AS rank FROM scored) WHERE rank <= 5) {auc_sql('top', 'user_id')}""",
)
def auc_topk(t: Tables):
    return rounded(E.auc_at_k(scored(t), 5, ["user_id"], "id"))


LOSS = "-(label * ln(p) + (1 - label) * ln(1.0::DOUBLE - p))"
CLIPPED = "(SELECT *, greatest(1e-15::DOUBLE, least(1.0::DOUBLE - 1e-15::DOUBLE, prob)) AS p FROM scored)"


@query("logloss", f"WITH {SCORED} SELECT round(avg({LOSS}), 6) AS logloss FROM {CLIPPED}")
def logloss(t: Tables):
    return rounded(E.logloss(scored(t)))


@query(
    "regression_errors",
    f"""WITH {SCORED}, e AS (SELECT prob - label AS e, CAST(label AS DOUBLE) AS y, weight FROM scored)
    SELECT round(avg(e * e), 6) AS mse, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae,
           round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2,
           round(sum(weight * abs(e)) / sum(weight), 6) AS wmae FROM e""",
)
def regression_errors(t: Tables):
    return rounded(E.regression_errors(scored(t), "prob", "label", "weight"))


@query(
    "confusion",
    f"""WITH {SCORED}, c AS (
      SELECT segment, count(*) FILTER (prob >= 0.6::DOUBLE AND label = 1) AS tp,
             count(*) FILTER (prob >= 0.6::DOUBLE AND label = 0) AS fp,
             count(*) FILTER (prob < 0.6::DOUBLE AND label = 1) AS fn,
             count(*) FILTER (prob < 0.6::DOUBLE AND label = 0) AS tn
      FROM scored GROUP BY 1),
    r AS (SELECT *, tp / nullif(tp + fp, 0) AS p, tp / nullif(tp + fn, 0) AS r FROM c)
    SELECT segment, tp, fp, fn, tn, round(p, 6) AS precision, round(r, 6) AS recall,
           round(2 * p * r / nullif(p + r, 0), 6) AS f1, round(5 * p * r / nullif(4 * p + r, 0), 6) AS f_alpha,
           round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
           round((fp + fn) / (tp + fp + fn + tn), 6) AS error_rate FROM r""",
)
def confusion(t: Tables):
    return rounded(E.confusion(scored(t), 0.6, group=["segment"]))


CURVE = f"""{SCORED},
s AS (SELECT prob AS score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg
      FROM scored GROUP BY 1),
curve AS (SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p,
                 sum(neg) OVER () AS n FROM s WINDOW w AS (ORDER BY score DESC))"""


@query("roc_points", f"WITH {CURVE} SELECT round(score, 6) AS score, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM curve")
def roc_points(t: Tables):
    return rounded(E.roc_points(scored(t)))


@query(
    "pr_points",
    f"WITH {CURVE} SELECT round(score, 6) AS score, round(tp / p, 6) AS recall, round(tp / (tp + fp), 6) AS precision FROM curve",
)
def pr_points(t: Tables):
    return rounded(E.pr_points(scored(t)))


@query("aupr", f"WITH {CURVE} SELECT round(sum(pos / p * tp / (tp + fp)), 6) AS aupr FROM curve")
def aupr(t: Tables):
    return rounded(E.aupr(scored(t)))


@query(
    "ndcg_map",
    """WITH judged AS (
      SELECT l_suppkey AS query, l_orderkey * 10 + l_linenumber AS item, l_extendedprice AS score,
             CAST(floor(l_quantity) AS BIGINT) % 4 AS rel FROM lineitem),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, item) AS rank,
                      row_number() OVER (PARTITION BY query ORDER BY rel DESC, item) AS best FROM judged),
    top AS (SELECT *, sum(CASE WHEN rel > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY query ORDER BY rank) AS hits
            FROM ranked WHERE rank <= 20),
    actual AS (SELECT query, sum(CASE WHEN rel > 0 THEN 1 ELSE 0 END) AS h,
                      sum(CASE WHEN rel > 0 THEN hits / rank ELSE 0 END) AS precisions,
                      sum((pow(2, rel) - 1) / log2(rank + 1)) AS dcg FROM top GROUP BY 1),
    ideal AS (SELECT query, sum((pow(2, rel) - 1) / log2(best + 1)) AS idcg,
                     sum(CASE WHEN rel > 0 THEN 1 ELSE 0 END) AS wanted FROM ranked WHERE best <= 20 GROUP BY 1)
    SELECT query, round(h / 20, 6) AS p_at_k, round(precisions / nullif(wanted, 0), 6) AS ap_at_k,
           round(dcg / nullif(idcg, 0), 6) AS ndcg_at_k FROM actual JOIN ideal USING (query)""",
)
def ndcg_map(t: Tables):
    judged = t.lineitem.select(
        F.col("l_suppkey").alias("query"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item"),
        F.col("l_extendedprice").alias("score"),
        (F.floor("l_quantity").cast("bigint") % 4).alias("rel"),
    )
    return rounded(E.ranking_quality(judged, 20, ["query"], "item"))


@query(
    "welch_t",
    """WITH s AS (SELECT count(*) FILTER (event_type = 'click') AS n1, count(*) FILTER (event_type = 'view') AS n2,
      avg(value) FILTER (event_type = 'click') AS mean1, avg(value) FILTER (event_type = 'view') AS mean2,
      var_samp(value) FILTER (event_type = 'click') AS v1, var_samp(value) FILTER (event_type = 'view') AS v2
      FROM events)
    SELECT n1, n2, round(mean1, 6) AS mean1, round(mean2, 6) AS mean2,
           round((mean1 - mean2) / sqrt(v1 / n1 + v2 / n2), 6) AS t,
           round(pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)), 4) AS dof
    FROM s""",
)
def welch_t(t: Tables):
    kind = F.col("event_type")
    out = E.welch_t(t.events, "value", kind == "click", kind == "view")
    return rounded(out).withColumn("dof", F.round("dof", 4))


@query(
    "metric_report",
    f"""WITH {SCORED}, a AS ({auc_sql('scored', 'segment')}),
    l AS (SELECT segment, count(*) AS n, round(avg({LOSS}), 6) AS logloss,
                 round(avg(prob) / avg(label), 6) AS ratio FROM {CLIPPED} GROUP BY 1)
    SELECT segment, n, ratio, logloss, auc FROM l JOIN a USING (segment)""",
)
def metric_report(t: Tables):
    return rounded(E.metric_report(scored(t), "segment"))


# Click-through rates -----------------------------------------------------------------------------------------------


def impressions(t: Tables):
    """Views and clicks of each item: both are exposures, clicks are clicks."""
    seen = t.events.filter(F.col("event_type").isin("view", "click"))
    return seen.select(
        "event_id",
        "ts",
        "user_id",
        item_of_event().cast("bigint").alias("item"),
        F.lit(1).cast("bigint").alias("exposure"),
        (F.col("event_type") == "click").cast("bigint").alias("click"),
        "value",
    )


IMPRESSIONS = """
impressions AS (
  SELECT event_id, ts, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item, 1 AS exposure,
         CAST(event_type = 'click' AS INTEGER) AS click, value
  FROM events WHERE event_type IN ('view', 'click')),
item_ctr AS (
  SELECT item, CAST(sum(exposure) AS BIGINT) AS exposure, CAST(sum(click) AS BIGINT) AS click,
         sum(click) / sum(exposure) AS ctr FROM impressions GROUP BY 1)"""


@query("item_ctr", f"WITH {IMPRESSIONS} SELECT item, exposure, click, round(ctr, 6) AS ctr FROM item_ctr")
def item_ctr(t: Tables):
    return rounded(K.item_ctr(impressions(t), ["item"]))


SMOOTHED = """
smoothed AS (
  SELECT item, exposure, click, ctr, (click + 50 * 0.9::DOUBLE * (SELECT sum(click) / sum(exposure) FROM item_ctr))
         / (exposure + 50) AS smoothed FROM item_ctr)"""


@query(
    "ctr_smoothed",
    f"""WITH {IMPRESSIONS}, {SMOOTHED} SELECT item, exposure, click, round(ctr, 6) AS ctr,
    round(smoothed, 6) AS smoothed FROM smoothed""",
)
def ctr_smoothed(t: Tables):
    return rounded(K.smoothed_ctr(K.item_ctr(impressions(t), ["item"]), 50, 0.9))


def bins_sql(bins: int) -> str:
    return f"""{SCORED},
    v AS (SELECT prob, count(*) AS n, sum(label) AS pos FROM scored GROUP BY 1),
    b AS (SELECT *, CAST(floor(coalesce(sum(n) OVER (ORDER BY prob ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
            0) * {bins}::DOUBLE / (SELECT sum(n) FROM v)) AS BIGINT) AS bin FROM v),
    bins AS (SELECT bin, CAST(sum(n) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS pos,
                    CAST(sum(prob * n) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS mean_prob,
                    CAST(sum(pos) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS mean_label
             FROM b GROUP BY 1)"""


ROUND_BINS = "bin, n, pos, round(mean_prob, 6) AS mean_prob, round(mean_label, 6) AS mean_label"


@query("calib_bins", f"WITH {bins_sql(20)} SELECT {ROUND_BINS} FROM bins")
def calib_bins(t: Tables):
    return rounded(K.calibration_bins(scored(t), 20))


@query(
    "calib_isotonic",
    f"""WITH {bins_sql(50)},
    spans AS (SELECT lo.bin AS a, hi.bin AS z, sum(x.pos) / sum(x.n) AS mean
              FROM bins lo JOIN bins hi ON hi.bin >= lo.bin JOIN bins x ON x.bin BETWEEN lo.bin AND hi.bin
              GROUP BY 1, 2),
    mins AS (SELECT i.bin, s.a, min(s.mean) AS m FROM bins i JOIN spans s ON s.a <= i.bin AND s.z >= i.bin
             GROUP BY 1, 2),
    fit AS (SELECT bin, max(m) AS calibrated FROM mins GROUP BY 1)
    SELECT {ROUND_BINS}, round(calibrated, 6) AS calibrated FROM bins JOIN fit USING (bin)""",
)
def calib_isotonic(t: Tables):
    return rounded(K.isotonic_calibration(K.calibration_bins(scored(t), 50)))


@query(
    "calib_isotonic_samples",
    f"""WITH {SCORED},
    v AS (SELECT prob AS value, CAST(count(*) AS DOUBLE) AS n, CAST(sum(label) AS DOUBLE) AS total FROM scored GROUP BY 1),
    c AS (SELECT *, row_number() OVER w AS i, sum(n) OVER w AS up_n, sum(total) OVER w AS up FROM v WINDOW w AS (ORDER BY value)),
    spans AS (SELECT a.i AS a, z.i AS z, (z.up - a.up + a.total) / (z.up_n - a.up_n + a.n) AS mean
              FROM c a JOIN c z ON z.i >= a.i),
    least AS (SELECT a, z, min(mean) OVER (PARTITION BY a ORDER BY z DESC ROWS UNBOUNDED PRECEDING) AS m FROM spans),
    fit AS (SELECT z AS i, max(m) AS calibrated FROM least GROUP BY 1)
    SELECT round(value, 6) AS value, n, total, round(calibrated, 6) AS calibrated FROM c JOIN fit USING (i)""",
)
def calib_isotonic_samples(t: Tables):
    return rounded(isotonic(scored(t)))


@query(
    "calib_sampling",
    f"""WITH {SCORED} SELECT id, round(prob / (prob + (1 - prob) / 0.1::DOUBLE), 6) AS q,
    round(prob / (10 - 9 * prob), 6) AS q_logit FROM scored""",
)
def calib_sampling(t: Tables):
    p = F.col("prob")
    shifted = F.when((p > 0) & (p < 1), K.undo_sampling_logit("prob", 0.1)).otherwise(p)
    return rounded(scored(t).select("id", K.undo_sampling("prob", 0.1).alias("q"), shifted.alias("q_logit")))


@query(
    "calib_power",
    f"""WITH {bins_sql(20)},
    l AS (SELECT ln(mean_prob) AS x, ln(mean_label) AS y FROM bins WHERE mean_prob > 0 AND mean_label > 0),
    f AS (SELECT covar_samp(x, y) / var_samp(x) AS a, avg(x) AS mx, avg(y) AS my FROM l),
    m AS (SELECT a, exp(my - a * mx) AS k FROM f)
    SELECT bin, round(mean_prob, 6) AS mean_prob, round(mean_label, 6) AS mean_label,
           round(k * pow(mean_prob, a), 6) AS mapped FROM bins, m""",
)
def calib_power(t: Tables):
    bins = stage(K.calibration_bins(scored(t), 20), "bins")
    fit = K.fit_power(bins).select(F.struct("a", "k")).scalar()
    mapped = bins.withColumn("f", fit).withColumn("mapped", F.col("f.k") * F.pow("mean_prob", F.col("f.a")))
    return rounded(mapped.select("bin", "mean_prob", "mean_label", "mapped"))


@query(
    "calib_report",
    f"""WITH {SCORED}, u AS (SELECT user_id, count(*) AS c FROM scored GROUP BY 1),
    r AS (SELECT CAST(c >= 8 AS INTEGER) + CAST(c >= 12 AS INTEGER) AS exposure_tier,
                 CAST(prob >= 0.25::DOUBLE AS INTEGER) + CAST(prob >= 0.75::DOUBLE AS INTEGER) AS ctr_tier, prob, label
          FROM scored JOIN u USING (user_id))
    SELECT exposure_tier, ctr_tier, count(*) AS n, round(avg(prob), 6) AS predicted, round(avg(label), 6) AS actual,
           round(avg(prob) / nullif(avg(label), 0), 6) AS ratio FROM r GROUP BY 1, 2""",
)
def calib_report(t: Tables):
    rows = scored(t)
    seen = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("c"))
    tiers = rows.join(seen, "user_id").select(
        K.tier("c", [8, 12]).alias("exposure_tier"), K.tier("prob", [0.25, 0.75]).alias("ctr_tier"), "prob", "label"
    )
    return rounded(K.calibration_report(tiers, ["exposure_tier", "ctr_tier"]))


@query(
    "campaign_costs",
    """WITH s AS (SELECT json_extract_string(props, '$.k') AS campaign,
      sum(value) FILTER (event_type = 'click') AS cost,
      count(*) FILTER (event_type IN ('view', 'click')) AS exposures,
      count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (event_type = 'purchase') AS actions
      FROM events GROUP BY 1)
    SELECT campaign, round(cost, 8) AS cost, exposures, clicks, actions, round(cost / nullif(clicks, 0), 8) AS cpc,
           round(cost * 1000 / nullif(exposures, 0), 8) AS cpm, round(cost / nullif(actions, 0), 8) AS cpa FROM s""",
)
def campaign_costs(t: Tables):
    kind = F.col("event_type")
    events = t.events.withColumn("campaign", item_of_event())
    return rounded(
        K.campaign_costs(
            events,
            ["campaign"],
            F.when(kind == "click", F.col("value")),
            kind.isin("view", "click"),
            kind == "click",
            kind == "purchase",
        ),
        8,
    )

