"""Item-to-item association rules from a boolean preference matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from quillrank import fixed as X
from quillrank.functions import differs_or_unknown
from quillrank.operators.actions import in_window
from quillrank.plans.ranks import global_row_number, top_by
from quillrank.plans.skew import heavy_keys, keep_by_count, spread_join
from quillrank.session import stage, view

# Parts of the pairs of one of the most frequent items, and tasks that count pairs for each partition of the session:
# a task holds its pairs twice, before and after they are summed.
BINS, COUNTING = 8, 4


def bool_matrix(
    baskets: DataFrame, actions: DataFrame, date: str, days: int = X.ACTION_DAYS, item_type: int | None = None
) -> DataFrame:
    """Baskets and users who favoured, downloaded or shared an item, as distinct (user_id, item_id) pairs.

    ``baskets``: songlist_id, item_id. The day window is closed on both ends.
    """
    lists = baskets.select(
        F.concat(F.lit(X.BASKET_PREFIX), F.col("songlist_id").cast("string")).alias("user_id"),
        F.col("item_id").cast("string").alias("item_id"),
    )
    wanted = F.col("action").isin(X.ACTION_DOWNLOAD, X.ACTION_FAVOR, X.ACTION_SHARE)
    users = in_window(actions, date, days, item_type).filter(wanted & (F.col("item_id") != X.UNKNOWN)).select(
        F.concat(F.lit(X.USER_PREFIX), F.col("user_id")).alias("user_id"), "item_id"
    )
    return lists.unionByName(users).distinct().withColumn("preference", F.lit(1))


def filter_users(matrix: DataFrame, low: int = X.LIST_MIN, high: int = X.LIST_MAX) -> DataFrame:
    """Users with ``low <= items <= high``."""
    cnt = F.col("cnt")
    return keep_by_count(matrix, "user_id", (cnt >= low) & (cnt <= high), cnt > high)


def filter_items(
    matrix: DataFrame, low: int = X.ITEM_CNT_MIN, high: int = X.ITEM_CNT_MAX, carry: str | None = None
) -> DataFrame:
    """Items with ``low < users < high``."""
    cnt = F.col("cnt")
    return keep_by_count(matrix, "item_id", (cnt > low) & (cnt < high), cnt >= high, carry)


def _counted_pairs(matrix: DataFrame, counts: DataFrame, item: str = "item_id") -> DataFrame:
    """(i, j, pair_cnt) for each unordered pair i < j of items of one user; ``counts``: item, cnt.

    A user sends one row per item with all greater items of the user, which is a fraction of a row per pair; the pairs
    are made where they are counted. Rows of the HEAVY most frequent items are dealt by the greater item as well.
    Users hold at most LIST_MAX items after filter_users, which bounds the lists. The number of partitions follows
    the session and not the small input size.
    """
    parts = int(matrix.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    users = matrix.select("user_id", item).filter(F.col("user_id").isNotNull()).repartition(parts, "user_id")
    lists = users.groupBy("user_id").agg(F.sort_array(F.collect_list(item)).alias("items"))
    rest = F.slice("items", F.col("at") + 2, F.size("items"))
    tails = lists.select("items", F.posexplode("items").alias("at", "i")).filter(F.col("at") + 1 < F.size("items"))
    hot = heavy_keys(counts, item, "cnt").withColumnRenamed(item, "i")
    marked = tails.select("i", rest.alias("js")).join(F.broadcast(hot), "i", "left")
    bins = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(BINS - 1))).otherwise(F.array(F.lit(0)))
    own = F.filter("js", lambda j: F.pmod(F.hash(j), F.lit(BINS)) == F.col("bin"))
    own = F.when(F.col("__hot"), own).otherwise(F.col("js"))
    dealt = marked.withColumn("bin", F.explode(bins)).select("i", "bin", own.alias("js"))
    dealt = dealt.filter(F.size("js") > 0).repartition(COUNTING * parts, "i", "bin")
    pairs = dealt.select("i", "bin", F.explode("js").alias("j"))
    # An item that a user has twice stands behind itself.
    counted = pairs.filter(F.col("i") < F.col("j")).groupBy("i", "bin", "j").agg(F.count(F.lit(1)).alias("pair_cnt"))
    return counted.select("i", "j", "pair_cnt")


def _mirror(half: DataFrame) -> DataFrame:
    def side(a: str, b: str):
        return F.struct(F.col(a).alias("item_prior"), F.col(b).alias("item_posterior"), "pair_cnt")

    return half.select(F.inline(F.array(side("i", "j"), side("j", "i"))))


def pair_counts(matrix: DataFrame, low: int = X.PAIR_MIN, high: int | None = X.PAIR_MAX) -> DataFrame:
    """Ordered item pairs with ``low <= common users <= high``. Run filter_users first where users hold many items.

    The input is read three times and so is staged. Ids that fit are sent in four bytes.
    """
    matrix = stage(matrix.select("user_id", "item_id"), "pair_matrix")
    kind = dict(matrix.dtypes)["item_id"]
    if kind == "bigint":
        ends = matrix.agg(F.min("item_id").alias("a"), F.max("item_id").alias("b")).first()
        if ends["a"] is not None and -(1 << 31) <= ends["a"] and ends["b"] < 1 << 31:
            matrix = matrix.withColumn("item_id", F.col("item_id").cast("int"))
    counts = matrix.groupBy("item_id").agg(F.count(F.lit(1)).alias("cnt"))
    enough = F.col("pair_cnt") >= low
    if high is not None:
        enough = enough & (F.col("pair_cnt") <= high)
    half = _counted_pairs(matrix, counts).filter(enough)
    return _mirror(half.withColumns({c: F.col(c).cast(kind) for c in ("i", "j")}))


def _metrics(pairs: DataFrame, users: DataFrame, k: int) -> DataFrame:
    a, b, ab = (F.col(c).cast("double") for c in ("prior_cnt", "posterior_cnt", "pair_cnt"))
    n = users.scalar().cast("double")
    rated = (
        pairs.withColumn("confidence", ab / a)
        .withColumn("max_conf", F.greatest(ab / a, ab / b))
        .withColumn("min_conf", F.least(ab / a, ab / b))
        .withColumn("lift", ab * n / a / b)
        .withColumn("kulc", 0.5 * ab / a + 0.5 * ab / b)
        .withColumn("ir", F.abs(a - b) / (a + b - ab))
    )
    score = F.col("confidence") * F.ln(1.0 + F.col("lift"))
    return top_by(rated, ["item_prior"], [score.desc(), F.asc("item_posterior")], k).select(
        "item_prior",
        "item_posterior",
        "prior_cnt",
        "posterior_cnt",
        "pair_cnt",
        "confidence",
        "max_conf",
        "min_conf",
        "lift",
        "kulc",
        "ir",
        "rank",
    )


def association_metrics(pairs: DataFrame, matrix: DataFrame, k: int = X.RULES_KEPT) -> DataFrame:
    """Confidence, lift, kulc and imbalance per rule; the best ``k`` posteriors per prior."""
    counts = matrix.groupBy("item_id").agg(F.count(F.lit(1)).alias("cnt"))
    prior = counts.select(F.col("item_id").alias("item_prior"), F.col("cnt").alias("prior_cnt"))
    posterior = counts.select(F.col("item_id").alias("item_posterior"), F.col("cnt").alias("posterior_cnt"))
    # The prior comes last, because the best posteriors are ranked per prior and so need no further shuffle.
    joined = pairs.join(posterior, "item_posterior").join(prior, "item_prior")
    return _metrics(joined, matrix.agg(F.countDistinct("user_id")), k)


def mine_rules(
    matrix: DataFrame,
    users: tuple[int, int] = (X.LIST_MIN, X.LIST_MAX),
    items: tuple[int, int] = (X.ITEM_CNT_MIN, X.ITEM_CNT_MAX),
    pairs: tuple[int, int] = (X.PAIR_MIN, X.PAIR_MAX),
    k: int = X.RULES_KEPT,
) -> DataFrame:
    """filter_users, filter_items, pair_counts and association_metrics in one plan.

    The pairs are by far the largest data of the job and most of them fall below the minimum. Items with long ids
    therefore get dense codes of four bytes; names and counts come back to the few pairs that are left.
    """
    kept = stage(filter_items(filter_users(matrix, *users), *items, carry="cnt"), "filtered_matrix")
    if dict(kept.dtypes)["item_id"] in ("int", "bigint"):
        return association_metrics(pair_counts(kept, *pairs), kept, k)
    counts = kept.groupBy("item_id").agg(F.first("cnt").alias("cnt"))
    codes = stage(global_row_number(counts, [F.asc("item_id")], "code"), "item_codes")
    coded = spread_join(kept.select("user_id", "item_id"), codes, "item_id", weights=codes)
    if (codes.agg(F.max("code")).first()[0] or 0) >= 1 << 31:
        return association_metrics(pair_counts(kept, *pairs), kept, k)
    coded = coded.withColumn("code", F.col("code").cast("int"))
    counts = codes.select(F.col("code").cast("int").alias("code"), "cnt")
    frequent = _counted_pairs(coded, counts, "code").filter(F.col("pair_cnt").between(*pairs))
    both = _mirror(frequent)

    def decoded(side: str) -> DataFrame:
        return codes.select(
            F.col("code").alias(f"item_{side}"), F.col("item_id").alias(f"name_{side}"), F.col("cnt").alias(f"{side}_cnt")
        )

    named = both.join(decoded("prior"), "item_prior").join(decoded("posterior"), "item_posterior")
    named = named.drop("item_prior", "item_posterior").withColumnsRenamed(
        {"name_prior": "item_prior", "name_posterior": "item_posterior"}
    )
    return _metrics(named, kept.agg(F.countDistinct("user_id")), k)


def item_info(songs: DataFrame, singers: DataFrame) -> DataFrame:
    """song_id, song_name, singer_id, singer_name for songs with a known singer."""
    return songs.select("song_id", F.col("name").alias("song_name"), "singer_id").join(
        singers.select("singer_id", F.col("name").alias("singer_name")), "singer_id"
    )


def _label(side: str):
    parts = []
    for c in ("song_id", "song_name", "singer_id", "singer_name"):
        parts += [F.nvl(F.col(f"{side}.{c}"), F.lit("")), F.lit("|")]
    return F.concat(*parts[:-1])


def diversify_rules(rules: DataFrame, info: DataFrame) -> DataFrame:
    """One posterior per (prior, singer), no same singer, no same title; ranks closed up.

    The best posterior of a singer is picked before the other two rules, so it is not replaced when they drop it.
    All posteriors of unknown singer count as one singer.
    """
    info = stage(info, "item_info")
    about = F.struct("song_id", "song_name", "singer_id", "singer_name")

    def of(key: str, name: str) -> DataFrame:
        return view(info, F.col("song_id").alias(key), about.alias(name))

    # A popular item is the posterior of very many priors.
    joined = spread_join(rules, of("item_prior", "p"), "item_prior", "left")
    joined = spread_join(joined, of("item_posterior", "q"), "item_posterior", "left")
    described = joined.select(
        *rules.columns,
        F.concat(_label("p"), F.lit(","), _label("q")).alias("debug_info"),
        F.nvl("p.singer_id", F.lit("")).alias("singer_prior"),
        F.nvl("q.singer_id", F.lit("")).alias("singer_posterior"),
        F.nvl("p.song_name", F.lit("")).alias("song_prior"),
        F.nvl("q.song_name", F.lit("")).alias("song_posterior"),
    )
    best = top_by(described, ["item_prior", "singer_posterior"], [F.asc("rank")], 1, "in_singer")
    kept = best.filter(
        differs_or_unknown("singer_prior", "singer_posterior") & differs_or_unknown("song_prior", "song_posterior")
    )
    rank = F.row_number().over(W.partitionBy("item_prior").orderBy("rank")).cast("bigint")
    return kept.withColumn("rank", rank).drop("in_singer", "song_prior", "song_posterior")
