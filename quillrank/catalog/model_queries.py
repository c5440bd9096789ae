"""Queries: click models, naive Bayes, exploration."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrank.catalog.base import Tables, query, rounded
from quillrank.catalog.measures import IMPRESSIONS, impressions
from quillrank.catalog.stand_ins import hash_unit_sql
from quillrank.operators import bandits as B, ctr as K, metrics as E, models as M, vectors as V
from quillrank.functions import logistic
from quillrank.operators.item_logistic import fit_items
from quillrank.plans.skew import null_safe_join, spread_join
from quillrank.session import stage


def training(t: Tables):
    """orders with weighted feature lists of the customer and of the order."""
    text = lambda c: F.col(c).cast("string")
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        F.array(F.concat(F.lit("c"), text("c_custkey")), F.col("c_mktsegment"), text("c_nationkey")).alias("user_features"),
        F.array(F.lit(1.0), F.lit(0.5), F.lit(0.25)).alias("user_weights"),
        F.array(F.col("o_orderpriority"), F.year("o_orderdate").cast("string"), F.lit("any")).alias("ads_features"),
        F.array(F.lit(1.0), F.lit(1.0), F.round(F.col("o_totalprice") / 500_000.0, 3)).alias("ads_weights"),
    )


def slots(t: Tables):
    return t.embeddings.select(F.col("vec_id").cast("int").alias("slot"), "embedding")


@query(
    "pooled_embeddings",
    """WITH l AS (SELECT l_orderkey, l_partkey AS k, l_quantity / 10 AS w FROM lineitem),
    v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
    SELECT l_orderkey, round(sum(w * e[1]) / sqrt(sum(w * w)), 6) AS first,
           round(sum(w * e[64]) / sqrt(sum(w * w)), 6) AS last
    FROM l JOIN v ON vec_id = k GROUP BY 1""",
)
def pooled_embeddings(t: Tables):
    lines = t.lineitem.select(
        "l_orderkey", F.col("l_partkey").alias("vec_id"), (F.col("l_quantity") / 10).alias("w")
    )
    out = V.pooled(lines, t.embeddings, "l_orderkey", "vec_id", "w")
    return rounded(out.select("l_orderkey", F.col("pooled")[0].alias("first"), F.col("pooled")[63].alias("last")))


@query(
    "hashed_features",
    f"""WITH f AS (SELECT o_orderkey AS id, unnest([o_orderpriority, CAST(year(o_orderdate) AS VARCHAR), 'any']) AS n,
      unnest([1, 1, round(o_totalprice / 500000, 3)]::DOUBLE[]) AS w
      FROM orders JOIN customer ON c_custkey = o_custkey)
    SELECT id, CAST(floor({hash_unit_sql('n', 0)} * 100000) AS INTEGER) AS i, round(sum(w), 6) AS w FROM f GROUP BY 1, 2""",
)
def hashed_features(t: Tables):
    cells = M.hashed_cells("ads_features", "ads_weights", M.FEATURE_SIZE)
    return rounded(training(t).select("id", F.inline(cells)))


def wide_deep(t: Tables):
    model = M.WideDeep(slots(t), iterations=10)
    prepared = model.prepare(training(t))
    return model.fit(prepared).predict(prepared)


@query("wide_deep_model")
def wide_deep_model(t: Tables):
    return wide_deep(t)


@query("model_evaluation")
def model_evaluation(t: Tables):
    return M.evaluate(stage(wide_deep(t), "predictions"))


NUMERIC = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def lines(t: Tables):
    return t.lineitem.select("*", (F.col("l_returnflag") == "R").cast("int").alias("label"))


@query("classifier_report")
def classifier_report(t: Tables):
    """AUC and logloss of each kind of classifier on the rows it was fitted to."""
    rows, out = stage(lines(t), "lines"), None
    for kind, options in (
        ("logistic", {"maxIter": 10}),
        ("factorization", {"maxIter": 10, "seed": 0}),
        ("boosting", {"maxIter": 5, "seed": 0}),
        ("forest", {"numTrees": 10, "seed": 0}),
    ):
        scored = M.class_prob(M.fit_classifier(rows, kind, NUMERIC, **options), rows)
        part = M.evaluate(scored).withColumn("model", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


@query("one_vs_rest")
def one_vs_rest(t: Tables):
    code = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    rows = t.lineitem.select(*NUMERIC, code.cast("double").alias("flag"))
    scored = M.fit_one_vs_rest(rows, NUMERIC, "flag").transform(rows)
    return scored.groupBy("flag", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query(
    "linear_regression",
    """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b
                  FROM lineitem)
    SELECT l_quantity, count(*) AS n, round(avg(a * l_quantity + b), 3) AS predicted FROM lineitem, f GROUP BY 1""",
)
def linear_regression(t: Tables):
    rows = t.lineitem.select("l_quantity", "l_extendedprice")
    scored = M.fit_linear(rows, ["l_quantity"], "l_extendedprice").transform(rows)
    return rounded(scored.groupBy("l_quantity").agg(F.count(F.lit(1)).alias("n"), F.avg("prediction").alias("predicted")), 3)


@query("leaf_features")
def leaf_features(t: Tables):
    rows = lines(t).select("l_orderkey", "l_partkey", *NUMERIC, "label")
    return M.leaf_features(rows, NUMERIC, trees=3).select("l_orderkey", "l_partkey", "leaves")


@query("feature_weights")
def feature_weights(t: Tables):
    return M.feature_weights(stage(lines(t), "lines"), NUMERIC)


@query("greedy_features")
def greedy_features(t: Tables):
    rows = stage(lines(t), "lines")
    late = F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp")
    return M.greedy_features(rows.filter(~late), rows.filter(late), NUMERIC, 2)


@query("stacking")
def stacking(t: Tables):
    rows = lines(t).select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("id"), *NUMERIC, "label")
    return M.stacked(rows, "id", NUMERIC, ["logistic", "forest"], folds=2)


@query("item_ctr_logistic")
def item_ctr_logistic(t: Tables):
    """Click probability from the item's CTR and from the one-hot item id."""
    shown = impressions(t).select("event_id", "item", F.col("click").cast("int").alias("label"), "exposure", "click")
    rates = K.item_ctr(shown, ["item"]).select("item", "ctr")
    rows = stage(shown.join(rates, "item").select("event_id", F.col("item").cast("string").alias("item"), "label", "ctr"), "shown")
    by_rate = M.class_prob(M.fit_classifier(rows, "logistic", ["ctr"], maxIter=20), rows, "by_ctr")
    by_item = fit_items(rows, "item").select("item", F.col("prob").alias("by_item"))
    scored = spread_join(by_rate, by_item, "item", salt=F.xxhash64("event_id"))
    return scored.select("event_id", "item", "label", "by_ctr", "by_item")


@query(
    "item_onehot",
    f"""WITH {IMPRESSIONS} SELECT item, exposure AS n, click AS k, round(ctr, 6) AS free, 0.0::DOUBLE AS slope, true AS between
    FROM item_ctr""",
)
def item_onehot(t: Tables):
    """Items without penalty (their rate), and the facts of the fit with penalty 1.

    There the slope of the loss is 0 for every item, and the probability lies between the rate and that of the bias alone.
    """
    shown = stage(impressions(t).select("item", F.col("click").alias("label")), "shown")
    free = fit_items(shown, "item", penalty=0).select("item", "n", "k", F.col("prob").alias("free"))
    held = fit_items(shown, "item").select("item", "coefficient", "bias", "prob")
    common = logistic(F.col("bias"))
    slope = F.abs(F.col("n") * F.col("prob") - F.col("k") + F.col("coefficient")).alias("slope")
    low, high = F.least("free", common) - 1e-9, F.greatest("free", common) + 1e-9
    both = null_safe_join(free, held, ["item"])
    return rounded(both.select("item", "n", "k", "free", slope, F.col("prob").between(low, high).alias("between")))


# Naive Bayes -------------------------------------------------------------------------------------------------------

CATEGORIES = ["l_linestatus", "l_linenumber", "l_discount_band"]


def banded(t: Tables):
    band = F.floor(F.col("l_discount") * 100 / 4).cast("bigint")
    # The numbers of a line do not identify it; with its categories the id is unique among distinct rows.
    return t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus", band).alias("id"),
        "l_linestatus",
        "l_linenumber",
        band.alias("l_discount_band"),
        F.col("l_returnflag").alias("label"),
    )


BAYES = """
b AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus,
                       CAST(floor(l_discount * 100 / 4) AS BIGINT)) AS id, l_linestatus, l_linenumber,
             CAST(floor(l_discount * 100 / 4) AS BIGINT) AS l_discount_band, l_returnflag AS label FROM lineitem),
flat AS (SELECT id, label, 'l_linestatus' AS feature, l_linestatus AS value FROM b
         UNION ALL SELECT id, label, 'l_linenumber', CAST(l_linenumber AS VARCHAR) FROM b
         UNION ALL SELECT id, label, 'l_discount_band', CAST(l_discount_band AS VARCHAR) FROM b),
c AS (SELECT feature, value, label, count(*) AS n FROM flat GROUP BY 1, 2, 3),
g AS (SELECT v.feature, v.value, l.label FROM (SELECT DISTINCT feature, value FROM flat) v,
             (SELECT DISTINCT label FROM flat) l),
bayes AS (
  SELECT g.feature, g.value, g.label, coalesce(n, 0) AS n,
         (coalesce(n, 0) + 1) / (sum(coalesce(n, 0)) OVER (PARTITION BY g.feature, g.label)
            + count(*) OVER (PARTITION BY g.feature, g.label)) AS prob
  FROM g LEFT JOIN c ON c.feature = g.feature AND c.value = g.value AND c.label = g.label)"""


@query("naive_bayes", f"WITH {BAYES} SELECT feature, value, label, n, round(prob, 6) AS prob FROM bayes")
def naive_bayes(t: Tables):
    return rounded(M.naive_bayes_table(banded(t), CATEGORIES, "label"))


@query(
    "naive_bayes_predict",
    f"""WITH {BAYES},
    prior AS (SELECT label, (count(*) + 1) / ((SELECT count(*) FROM b) + (SELECT count(DISTINCT label) FROM b)) AS p
              FROM b GROUP BY 1),
    s AS (SELECT id, y.label, sum(ln(prob)) + ln(any_value(p)) AS score
          FROM (SELECT DISTINCT id, feature, value FROM flat) f
          JOIN bayes y ON y.feature = f.feature AND y.value = f.value
          JOIN prior ON prior.label = y.label GROUP BY 1, 2)
    SELECT id, label AS predicted, round(score, 6) AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, label DESC) AS r FROM s) WHERE r = 1""",
)
def naive_bayes_predict(t: Tables):
    rows = banded(t)
    table = stage(M.naive_bayes_table(rows, CATEGORIES, "label"), "bayes")
    unique = rows.select("id", *CATEGORIES).distinct()
    return rounded(M.naive_bayes_predict(unique, table, M.class_priors(rows, "label"), "id", CATEGORIES))


@query(
    "anomaly_scores",
    """WITH s AS (SELECT l_suppkey, avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS d FROM lineitem GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, round((l_extendedprice - m) / nullif(d, 0), 6)
      AS z FROM lineitem JOIN s USING (l_suppkey)""",
)
def anomaly_scores(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    scored = M.anomaly_scores(rows, "l_suppkey", "l_extendedprice")
    return scored.withColumn("z", F.round("z", 6))


# Exploration -------------------------------------------------------------------------------------------------------


def arm_counts(t: Tables):
    return K.item_ctr(impressions(t), ["item"])


@query(
    "epsilon_greedy",
    f"""WITH k AS (SELECT l_shipinstruct AS arm, sum(n) AS exposure, sum(c) AS click FROM (
      SELECT l_returnflag || l_linestatus AS l_shipinstruct, 1 AS n, CAST(l_discount > 0.05 AS INTEGER) AS c FROM lineitem)
      GROUP BY 1),
    s AS (SELECT arm, (click + (SELECT sum(click) / sum(exposure) FROM k) * 100) / (exposure + 100::DOUBLE) AS r FROM k),
    a AS (SELECT list(arm ORDER BY arm) AS arms, arg_max(arm, r) AS best FROM s)
    SELECT c_custkey, CASE WHEN u < 0.2::DOUBLE THEN arms[CAST(floor(v * len(arms)) AS BIGINT) + 1] ELSE best END AS arm,
      CAST(u < 0.2::DOUBLE AS INTEGER) AS explored
    FROM a, (SELECT c_custkey, {hash_unit_sql('c_custkey', 4)} AS u, {hash_unit_sql('c_custkey', '4a')} AS v FROM customer)""",
)
def epsilon_greedy(t: Tables):
    """Customers get the kind of line with the best smoothed share of discounts, or a random one."""
    shown = t.lineitem.select(
        F.concat("l_returnflag", "l_linestatus").alias("arm"),
        F.lit(1).alias("exposure"),
        (F.col("l_discount") > 0.05).cast("int").alias("click"),
    )
    return B.greedy_by_ctr(t.customer, "c_custkey", K.item_ctr(shown, ["arm"]), "arm", 0.2, added=100, seed=4)


@query("thompson")
def thompson(t: Tables):
    return B.thompson(arm_counts(t), "item", seed=1)


@query(
    "ucb_scores",
    f"""WITH {IMPRESSIONS} SELECT item, exposure, click, round(ctr, 6) AS ctr,
    round(ctr + sqrt(2 * ln((SELECT sum(exposure) FROM item_ctr)) / exposure), 6) AS ucb FROM item_ctr""",
)
def ucb_scores(t: Tables):
    return rounded(B.ucb(arm_counts(t)))


@query("linucb")
def linucb(t: Tables):
    log = impressions(t).select(
        "item", F.lit(1.0).alias("one"), (F.col("value") / 100).alias("spend"), (F.hour("ts") / 24.0).alias("hour"), "click"
    )
    return rounded(B.lin_ucb(log, "item", ["one", "spend", "hour"], "click"))


def moves(t: Tables):
    """Consecutive lines of an order as transitions between (flag, status) states."""
    here = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.concat("l_returnflag", "l_linestatus").alias("s"),
        (F.floor("l_quantity").cast("bigint") % 4).alias("a"),
        F.col("l_discount").alias("r"),
    )
    after = t.lineitem.select(
        "l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.concat("l_returnflag", "l_linestatus").alias("s2")
    )
    return here.join(after, ["l_orderkey", "l_linenumber"], "left").select(
        "s", "a", "r", F.coalesce("s2", F.lit("end")).alias("s2")
    )


SWEEPS = 4


def _q_sql() -> str:
    out = """
    m AS (SELECT x.l_returnflag || x.l_linestatus AS s, CAST(floor(x.l_quantity) AS BIGINT) % 4 AS a, x.l_discount AS r,
                 coalesce(y.l_returnflag || y.l_linestatus, 'end') AS s2
          FROM lineitem x LEFT JOIN lineitem y ON y.l_orderkey = x.l_orderkey AND y.l_linenumber = x.l_linenumber + 1),
    q0 AS MATERIALIZED (SELECT DISTINCT s, a, 0::DOUBLE AS q FROM m)"""
    for i in range(SWEEPS):
        out += f""",
    q{i + 1} AS MATERIALIZED (
      SELECT q.s, q.a, any_value(q.q) + 0.8::DOUBLE * (avg(r + 0.95::DOUBLE * coalesce(v, 0)) - any_value(q.q)) AS q
      FROM q{i} q JOIN m ON m.s = q.s AND m.a = q.a
      LEFT JOIN (SELECT s AS n, max(q) AS v FROM q{i} GROUP BY 1) ON n = s2 GROUP BY 1, 2)"""
    return out


@query("q_update", f"WITH {_q_sql()} SELECT s, a, round(q, 6) AS q FROM q{SWEEPS}")
def q_update(t: Tables):
    return rounded(B.q_values(moves(t), SWEEPS))


@query("average_score", "SELECT count(*) AS total_count, round(avg(o_totalprice / 1000000), 6) AS average_score FROM orders")
def average_score(t: Tables):
    return rounded(E.average_score(t.orders, F.col("o_totalprice") / 1_000_000))
