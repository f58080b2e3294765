"""Queries: aggregation, distribution statistics, preparation, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from icuflow.functions import scalar as fn
from icuflow.operators import cohort, metrics, pivot, prep, stats, windows
from icuflow.plans.bindings import ICU, OBS, PAT, RANGES, TYPES, icustays, observations, patients, with_
from icuflow.plans.q_series import HOURLY, LABELLED, hours
from icuflow.plans.q_tables import rounded
from icuflow.plans.registry import query

DOCS = "docs AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"


def docs(t):
    return t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels, "doc_id")


@query("SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types FROM events WHERE event_type LIKE 'p%'")
def count_distinct(t):
    chosen = t.events.filter(F.col("event_type").like("p%"))
    return chosen.agg(F.count_distinct("user_id").alias("users"), F.count_distinct("event_type").alias("types"))


@query(
    with_(OBS, "per AS (SELECT user_id, count(*) AS n, count(DISTINCT code) AS kinds FROM obs GROUP BY user_id)")
    + " SELECT round(avg(n), 6) AS avg_events, round(avg(kinds), 6) AS avg_kinds FROM per"
)
def avg_obs_per_group(t):
    per = observations(t).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("code").alias("kinds"))
    return per.agg(F.round(F.avg("n"), 6).alias("avg_events"), F.round(F.avg("kinds"), 6).alias("avg_kinds"))


@query(
    """SELECT o_custkey, o_orderdate AS admittime, o_orderkey FROM (SELECT *, row_number() OVER
    (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) x WHERE rn = 1"""
)
def distinct_on_first(t):
    slim = t.orders.select("o_custkey", F.col("o_orderdate").alias("admittime"), "o_orderkey")
    return windows.first_events(slim, ["o_custkey"], ["admittime", "o_orderkey"])


BANDS = [0, 16, *range(21, 92, 5)]
BAND_SQL = ", ".join(f"count(CASE WHEN age >= {a} AND age < {b} THEN 1 END) AS from_{a}_to_{b}" for a, b in zip(BANDS, BANDS[1:]))
AGES = """ages AS (SELECT icu.icustay_id, (epoch_us(icu.intime) - epoch_us(pat.dob)) / 86400e6 / 365.242 AS age
  FROM icu JOIN pat ON pat.subject_id = icu.subject_id)"""


@query(with_(ICU, PAT, AGES) + f" SELECT count(*) AS total, {BAND_SQL}, count(CASE WHEN age >= 91 THEN 1 END) AS from_91 FROM ages")
def banded_counts(t):
    both = icustays(t).join(patients(t), "subject_id").select(fn.age_years("dob", "intime").alias("age"))
    return pivot.banded_counts(both, "age", BANDS)


@query(
    """SELECT count(DISTINCT o_custkey) AS patients, count(DISTINCT o_orderkey) AS stays,
    round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) * 100, 6) AS mortality,
    round(avg(CASE WHEN c_custkey % 2 = 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS male,
    round(median(o_totalprice), 6) AS price, median(1 + o_orderkey % 9)::DOUBLE AS los
    FROM orders JOIN customer ON c_custkey = o_custkey"""
)
def cohort_summary(t):
    rows = t.orders.join(t.customer.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey")).withColumn(
        "los", F.col("o_orderkey") % 9 + 1
    )
    return rounded(
        cohort.cohort_summary(
            rows,
            {"patients": "o_custkey", "stays": "o_orderkey"},
            {"price": "o_totalprice", "los": "los"},
            {
                "mortality": (F.col("o_orderstatus") == "F").cast("double"),
                "male": (F.col("c_custkey") % 2 == 0).cast("double"),
            },
        )
    )


@query(
    """SELECT o_orderpriority, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) x WHERE rn = 1 GROUP BY o_orderpriority"""
)
def group_counts(t):
    slim = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")
    first = windows.first_events(slim, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return first.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH c AS (SELECT c_mktsegment, o_orderstatus, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL)
    SELECT c_mktsegment, o_orderstatus, n, round(n * 100.0 / sum(n) OVER (PARTITION BY c_mktsegment), 6) AS percent,
    round(n * 100.0 / sum(n) OVER (), 6) AS percent_all FROM c"""
)
def group_proportions(t):
    segments = t.customer.select("c_custkey", "c_mktsegment")
    rows = t.orders.join(segments, F.col("o_custkey") == F.col("c_custkey")).select("c_mktsegment", "o_orderstatus")
    shares = stats.group_share(rows, ["c_mktsegment", "o_orderstatus"], ["c_mktsegment"])
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    return rounded(shares.withColumn("percent_all", F.col("n") * 100 / total))


@query(
    """SELECT c_mktsegment, count(o_totalprice) AS n, round(quantile_cont(o_totalprice, 0.25), 6) AS q1,
    round(median(o_totalprice), 6) AS median, round(quantile_cont(o_totalprice, 0.75), 6) AS q3
    FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment"""
)
def grouped_quantiles(t):
    segments = t.customer.select("c_custkey", "c_mktsegment")
    rows = t.orders.join(segments, F.col("o_custkey") == F.col("c_custkey"))
    return rounded(stats.quantiles(rows, "o_totalprice", {"q1": 0.25, "median": 0.5, "q3": 0.75}, ["c_mktsegment"]))


@query(
    with_(
        DOCS,
        """long AS (UNPIVOT (SELECT quality, n_chars::DOUBLE AS n_chars, length(lang)::DOUBLE + doc_id % 10 AS extra FROM docs)
        ON n_chars, extra INTO NAME feature VALUE value)""",
    )
    + """ SELECT feature, quality, count(value) AS n, round(median(value), 6) AS median, round(var_samp(value), 4) AS variance,
    round(skewness(value), 6) AS skew, round(quantile_cont(value, 0.99), 6) AS q99 FROM long GROUP BY feature, quality"""
)
def outcome_stats(t):
    rows = docs(t).withColumn("extra", F.length("lang") + F.col("doc_id") % 10)
    found = stats.outcome_stats(rows, ["n_chars", "extra"], "quality")
    return rounded(found.withColumn("variance", F.round("variance", 4)), keep=("variance",))


@query(
    with_(LABELLED, HOURLY)
    + """ SELECT count(click) AS click, count(view) AS view, count(error) AS error, count(purchase) AS purchase,
    count(signup) AS signup FROM hr"""
)
def nonnull_counts(t):
    return stats.nonnull_counts(hours(t), ["click", "view", "error", "purchase", "signup"])


@query(with_(OBS) + " SELECT code, count(*) AS n FROM obs GROUP BY code ORDER BY n DESC, code LIMIT 5")
def top_labels(t):
    return stats.top_values(observations(t), "code", 5)


@query(
    """SELECT round(avg(l_quantity), 6) AS l_quantity, round(avg(l_extendedprice), 4) AS l_extendedprice,
    round(avg(l_discount), 6) AS l_discount, round(avg(l_tax), 6) AS l_tax, min(l_quantity) AS lowest FROM lineitem"""
)
def column_means(t):
    means = [F.round(F.avg(c), p).alias(c) for c, p in (("l_quantity", 6), ("l_extendedprice", 4), ("l_discount", 6), ("l_tax", 6))]
    return t.lineitem.agg(*means, F.min("l_quantity").alias("lowest"))


@query("SELECT quality, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM labels GROUP BY quality")
def label_balance(t):
    return rounded(stats.group_share(t.labels, ["quality"]))


FOLD = "(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % {k})::INTEGER"


@query(
    with_(
        DOCS,
        f"f AS (SELECT *, {FOLD.format(k=5)} AS fold FROM docs)",
        """acc AS (SELECT 'length' AS model, fold, avg(CASE WHEN (n_chars >= 500) = (quality = 1) THEN 1.0 ELSE 0.0 END) AS quality,
          avg(CASE WHEN (n_chars >= 500) = (toxic = 1) THEN 1.0 ELSE 0.0 END) AS toxic FROM f GROUP BY fold
        UNION ALL SELECT 'language' AS model, fold, avg(CASE WHEN (lang = 'en') = (quality = 1) THEN 1.0 ELSE 0.0 END) AS quality,
          avg(CASE WHEN (lang = 'en') = (toxic = 1) THEN 1.0 ELSE 0.0 END) AS toxic FROM f GROUP BY fold)""",
    )
    + " SELECT model, round(avg(quality), 6) AS quality, round(avg(toxic), 6) AS toxic FROM acc GROUP BY model"
)
def model_summary(t):
    folded = prep.kfold(docs(t), "doc_id", 5)
    guesses = {"length": F.col("n_chars") >= 500, "language": F.col("lang") == "en"}
    rows = folded.select(
        "fold", "quality", "toxic", F.explode(F.create_map(*[x for n, g in guesses.items() for x in (F.lit(n), g)])).alias("model", "guess")
    )
    targets = rows.unpivot(["model", "fold", "guess"], ["quality", "toxic"], "target", "label")
    per_fold = metrics.accuracy(targets.withColumn("guess", F.col("guess").cast("int")), "guess", "label", ["model", "target", "fold"])
    return rounded(per_fold.groupBy("model").pivot("target", ["quality", "toxic"]).agg(F.avg("accuracy")))


# --- distributions -------------------------------------------------------------------------


KS_CUMULATED = """c AS (SELECT value, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS a,
    sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS b FROM events WHERE event_type IN ('click', 'view') GROUP BY value),
  r AS (SELECT sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER () AS na, sum(b) OVER () AS nb FROM c WINDOW w AS (ORDER BY value)),
  d AS (SELECT max(abs(ca::DOUBLE / na - cb::DOUBLE / nb)) AS statistic, max(na)::BIGINT AS n_first, max(nb)::BIGINT AS n_second FROM r),
  z AS (SELECT *, (sqrt(n_first::DOUBLE * n_second / (n_first + n_second)) + 0.12::DOUBLE
    + 0.11::DOUBLE / sqrt(n_first::DOUBLE * n_second / (n_first + n_second))) * statistic AS z FROM d)"""


@query(
    with_(KS_CUMULATED)
    + """ SELECT round(statistic, 6) AS statistic, n_first, n_second, round(CASE WHEN z < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0,
    2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END)::DOUBLE * exp(-2.0::DOUBLE * k * k * z * z)))))
    END, 6) AS p_value FROM z"""
)
def ks_two_sample(t):
    return rounded(stats.ks_two_sample(t.events, "value", "event_type", "click", "view"))


@query(
    """WITH f AS (SELECT event_type, count(*) AS n, pow(count(*), -0.2) * stddev_samp(value) AS h, min(value) AS lo, max(value) AS hi
      FROM events GROUP BY event_type),
    g AS (SELECT f.*, k::INTEGER AS point, lo - (hi - lo) / 2 + (hi - lo) * 2 * k / 49 AS at FROM f, range(50) r(k))
    SELECT g.event_type, g.point, round(g.at, 6) AS at,
    round(sum(exp(-pow((e.value - g.at) / g.h, 2) / 2)) / (g.n * g.h * sqrt(2 * pi())), 9) AS density
    FROM g JOIN events e ON e.event_type = g.event_type GROUP BY g.event_type, g.point, g.at, g.n, g.h"""
)
def kde_grid(t):
    found = stats.kde_grid(t.events, "value", "event_type")
    return rounded(found.withColumn("density", F.round("density", 9)), keep=("density",))


@query(
    """WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM events), b AS (
    SELECT event_type, least(floor((value - lo) / ((hi - lo) / 50)), 49)::INTEGER AS bin, count(*) AS n FROM events, r GROUP BY ALL),
    g AS (SELECT event_type, unnest(range(50))::INTEGER AS bin FROM (SELECT DISTINCT event_type FROM events))
    SELECT g.event_type, g.bin, coalesce(b.n, 0) AS n FROM g LEFT JOIN b ON g.event_type = b.event_type AND g.bin = b.bin"""
)
def histogram_by_group(t):
    return stats.histogram_by_group(t.events, "value", "event_type", 50)


@query(
    """WITH q AS (SELECT event_type, count(*) AS n, quantile_cont(value, 0.25) AS q1, median(value) AS median, quantile_cont(value, 0.75) AS q3
      FROM events GROUP BY event_type)
    SELECT q.event_type, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
    min(CASE WHEN value BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 THEN value END) AS whisker_low,
    max(CASE WHEN value BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 THEN value END) AS whisker_high,
    count(CASE WHEN value NOT BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 THEN 1 END) AS outliers
    FROM q JOIN events e ON e.event_type = q.event_type GROUP BY q.event_type, n, q1, median, q3"""
)
def box_stats(t):
    return rounded(stats.box_stats(t.events, "value", "event_type"), keep=("whisker_low", "whisker_high"))


RANGE_CASES = {end: "CASE " + " ".join(f"WHEN event_type = '{n}' THEN {float(r[i])}" for n, r in RANGES.items()) + " END" for i, end in enumerate(("lo", "hi"))}


@query(
    f"""WITH b AS (SELECT event_type, value, ({RANGE_CASES["lo"]})::DOUBLE AS lo, ({RANGE_CASES["hi"]})::DOUBLE AS hi FROM events
      WHERE event_type IN ('click', 'view', 'error'))
    SELECT event_type, max(lo) AS lower, max(hi) AS upper, count(*) AS n, round(avg(CASE WHEN value < lo THEN 1.0 ELSE 0.0 END), 6) AS below,
    round(avg(CASE WHEN value BETWEEN lo AND hi THEN 1.0 ELSE 0.0 END), 6) AS inside,
    round(avg(CASE WHEN value > hi THEN 1.0 ELSE 0.0 END), 6) AS above FROM b GROUP BY event_type"""
)
def reference_range_share(t):
    return rounded(stats.range_share(t.events, "event_type", "value", RANGES))


# --- preparation -----------------------------------------------------------------------------


@query(
    with_(LABELLED, HOURLY, f"m AS (SELECT {', '.join(f'avg({x}) AS m_{x}' for x in TYPES)} FROM hr)")
    + f" SELECT user_id, hour, {', '.join(f'round(coalesce({x}, m_{x}), 6) AS {x}' for x in TYPES)} FROM hr, m"
)
def mean_impute(t):
    return rounded(prep.mean_impute(hours(t).select("user_id", "hour", *TYPES), TYPES))


@query(
    """SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_samp(c_acctbal) OVER (), 6) AS c_acctbal,
    round((c_nationkey - avg(c_nationkey) OVER ()) / stddev_samp(c_nationkey) OVER (), 6) AS c_nationkey FROM customer"""
)
def standardize(t):
    # `one` has no variance and is dropped.
    rows = t.customer.select("c_custkey", "c_acctbal", "c_nationkey", F.lit(1.0).alias("one"))
    return rounded(prep.standardize(rows, ["c_acctbal", "c_nationkey", "one"]))


@query(
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= floor(count(*) OVER () * 0.7)
    THEN 'train' ELSE 'test' END AS split FROM orders"""
)
def ordered_split(t):
    return prep.ordered_split(t.orders, "o_orderdate", "o_orderkey").select("o_orderkey", "split")


@query(
    """SELECT o_orderkey, CASE WHEN ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT < 2147483648
    THEN 'train' ELSE 'test' END AS split FROM orders"""
)
def hash_split(t):
    return prep.hash_split(t.orders, "o_orderkey").select("o_orderkey", "split")


@query(
    """SELECT doc_id, quality, ((row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1) % 10)::INTEGER AS fold
    FROM labels"""
)
def stratified_folds(t):
    return prep.stratified_folds(t.labels.select("doc_id", "quality"), "quality", "doc_id")


@query(f"SELECT doc_id, {FOLD.format(k=10)} AS fold FROM documents")
def kfold_assign(t):
    return prep.kfold(t.documents.select("doc_id"), "doc_id")


@query(
    """SELECT doc_id, quality FROM (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS p,
    count(CASE WHEN quality != 1 THEN 1 END) OVER () AS others FROM labels) x WHERE quality != 1 OR p <= 4 * others"""
)
def downsample_majority(t):
    return prep.downsample_majority(t.labels.select("doc_id", "quality"), "quality", "doc_id", majority=1)


@query(
    """WITH p AS (SELECT doc_id, lang, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS p, count(*) OVER () AS n FROM documents),
    d AS (SELECT k AS draw, ('0x' || substr(md5('0-' || CAST(k AS VARCHAR)), 1, 12))::BIGINT % (SELECT count(*) FROM documents) + 1 AS p FROM range(100000) r(k))
    SELECT d.draw, p.doc_id, p.lang FROM d JOIN p ON p.p = d.p"""
)
def bootstrap_sample(t):
    return prep.bootstrap(t.documents.select("doc_id", "lang"), "doc_id", 100_000)


# --- metrics -----------------------------------------------------------------------------------

CURVE = """s AS (SELECT n_chars, sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN quality != 1 THEN 1 ELSE 0 END) AS neg
  FROM docs GROUP BY n_chars)"""


@query(
    with_(DOCS, CURVE, "r AS (SELECT *, sum(neg) OVER (ORDER BY n_chars) AS below FROM s)")
    + """ SELECT sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg,
    round(sum(pos * (below - neg / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)), 6) AS auroc FROM r"""
)
def auroc_exact(t):
    return rounded(metrics.auroc(docs(t), "n_chars", "quality"))


@query(
    with_(DOCS, CURVE)
    + """ SELECT n_chars AS threshold, round(sum(neg) OVER w / (sum(neg) OVER ())::DOUBLE, 6) AS fpr,
    round(sum(pos) OVER w / (sum(pos) OVER ())::DOUBLE, 6) AS tpr FROM s WINDOW w AS (ORDER BY n_chars DESC)"""
)
def roc_curve(t):
    return rounded(metrics.roc_curve(docs(t), "n_chars", "quality"))


@query(
    with_(
        DOCS,
        f"f AS (SELECT *, {FOLD.format(k=5)} AS fold FROM docs)",
        """s AS (SELECT fold, n_chars, sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN quality != 1 THEN 1 ELSE 0 END) AS neg
          FROM f GROUP BY fold, n_chars),
        c AS (SELECT fold, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM s WINDOW w AS (PARTITION BY fold ORDER BY n_chars DESC)
          UNION ALL SELECT DISTINCT fold, 0, 0 FROM s),
        steps AS (SELECT fold, fp, min(tp) AS low, max(tp) AS high FROM c GROUP BY fold, fp),
        a AS (SELECT *, lead(fp) OVER w AS nfp, lead(low) OVER w AS ntp, max(high) OVER (PARTITION BY fold) AS p,
          max(fp) OVER (PARTITION BY fold) AS n FROM steps WINDOW w AS (PARTITION BY fold ORDER BY fp)),
        g AS (SELECT k AS point, a.*, (high + coalesce((ntp - high) * (k * n / 99.0::DOUBLE - fp) / (nfp - fp), 0)) / p::DOUBLE AS tpr
          FROM a, range(100) r(k) WHERE p > 0 AND n > 0 AND k * n >= fp * 99 AND (nfp IS NULL OR k * n < nfp * 99))""",
    )
    + """ SELECT point::INTEGER AS point, round(point / 99.0::DOUBLE, 6) AS fpr,
    round(CASE WHEN point = 0 THEN 0.0::DOUBLE WHEN point = 99 THEN 1.0::DOUBLE ELSE avg(tpr) END, 6) AS tpr FROM g GROUP BY point"""
)
def roc_mean(t):
    return rounded(metrics.mean_roc(prep.kfold(docs(t), "doc_id", 5), "n_chars", "quality", "fold"))


@query(with_(DOCS) + " SELECT count(*) AS n, round(avg(CASE WHEN (n_chars >= 500) = (quality = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM docs")
def accuracy(t):
    return rounded(metrics.accuracy(docs(t).withColumn("guess", (F.col("n_chars") >= 500).cast("int")), "guess", "quality"))


@query("SELECT count(*) AS n, round(avg(pow(l_quantity * 1500 - l_extendedprice, 2)) / 1e6, 4) AS mse FROM lineitem")
def mse(t):
    found = metrics.mse(t.lineitem.withColumn("guess", F.col("l_quantity") * 1500), "guess", "l_extendedprice")
    return found.select("n", F.round(F.col("mse") / 1e6, 4).alias("mse"))


@query(
    """WITH g AS (SELECT doc_id, quality, CASE WHEN row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id)
      <= sum(quality) OVER () THEN 1 ELSE 0 END AS guess FROM labels),
    s AS (SELECT guess, sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN quality != 1 THEN 1 ELSE 0 END) AS neg FROM g GROUP BY guess),
    r AS (SELECT *, sum(neg) OVER (ORDER BY guess) AS below FROM s)
    SELECT sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg,
    round(sum(pos * (below - neg / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)), 6) AS auroc FROM r"""
)
def baseline_random(t):
    guessed = metrics.random_guess(t.labels.select("doc_id", "quality"), "quality", "doc_id")
    return rounded(metrics.auroc(guessed, "guess", "quality"))


@query(
    """SELECT count(*) AS n, round(avg(pow(o_totalprice - m, 2)) / 1e6, 4) AS mse
    FROM orders, (SELECT avg(o_totalprice) AS m FROM orders) x"""
)
def baseline_mean(t):
    found = metrics.mse(metrics.mean_guess(t.orders.select("o_totalprice"), "o_totalprice"), "guess", "o_totalprice")
    return found.select("n", F.round(F.col("mse") / 1e6, 4).alias("mse"))


@query(
    """WITH h AS (SELECT *, md5('0-' || CAST(o_orderkey AS VARCHAR)) AS d FROM orders),
    p AS (SELECT *, ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT < CAST(0.7 * 4294967296 AS BIGINT) AS train,
      sqrt(-2 * ln((('0x' || substr(d, 1, 12))::BIGINT + 1) / 281474976710656.0::DOUBLE))
      * cos(2 * pi() * ('0x' || substr(d, 13, 12))::BIGINT / 281474976710656.0::DOUBLE) AS z FROM h),
    days AS (SELECT train, z, CAST(o_orderkey % 9 + 1 AS DOUBLE) AS los FROM p)
    SELECT count(*) AS n, round(avg(pow(m + z - los, 2)), 6) AS mse FROM days, (SELECT avg(los) AS m FROM days WHERE train) WHERE NOT train"""
)
def baseline_normal(t):
    # Lengths of stay guessed by a normal draw around the training mean, deviation 1.
    stays = prep.hash_split(t.orders.select("o_orderkey", (F.col("o_orderkey") % 9 + 1).cast("double").alias("los")), "o_orderkey", 0.7)
    test = stays.where("split = 'test'")
    guessed = metrics.mean_guess(test, "los", stays.where("split = 'train'"), noise=1.0, key="o_orderkey")
    return rounded(metrics.mse(guessed, "guess", "los"))
