"""Sample, split, quality, metric and scoring queries over the fact table."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import next_weekday
from tidemark.operators import huber as H
from tidemark.operators import load as L
from tidemark.operators import model as M
from tidemark.operators import quality as Q
from tidemark.operators import samples as S
from tidemark.plans import marts
from tidemark.plans import oracle_marts as OM
from tidemark.plans.catalog import register
from tidemark.plans.oracle import with_proxies
from tidemark.plans.queries_features import build_fact, build_model_frame
from tidemark.session import cut_lineage, ensure_checkpoint_dir
from tidemark.sources import proxies as P


def _labelled(spark: SparkSession, d: str, with_momentum: bool = False, once: bool = False):
    """(ticker, trading_date, labels[, momentum]) -- the fact table's rows and
    these columns without its other joins.  The fact is the price rows left-
    joined to marts that are unique on (ticker, date), so row set and values
    are identical; Catalyst cannot drop unused left joins, so we do."""
    prices = P.stock_price_eod(spark, d, once)
    if not with_momentum:
        return marts.forward_labels(prices)
    return marts.momentum_mart(prices, P.index_price_eod(spark, d), labels=True)
from tidemark.sources.readers import latest_slice, lookback_slice

SPEC = S.FeatureSpec()


def _fact_sql(extra: list[tuple[str, str]], final: str) -> str:
    return with_proxies(OM.FACT_PROXIES, OM.fact_ctes(marts.FACT_COLUMNS) + extra, final)


def _vec_sql(cols) -> str:
    return "[" + ", ".join(f"CAST(COALESCE({c}, 0) AS FLOAT)" for c in cols) + "]"


_CUTS_SQL = [
    ("k_pr", """
      SELECT trading_date, PERCENT_RANK() OVER (ORDER BY trading_date) AS pct
      FROM fact WHERE label_next_5d_return IS NOT NULL"""),
    ("k_cuts", """
      SELECT MAX(CASE WHEN pct <= 0.8 THEN trading_date END) AS train_end,
             MAX(CASE WHEN pct <= 0.9 THEN trading_date END) AS val_end
      FROM k_pr"""),
]


_WINDOWS_SQL = _fact_sql([("w_s", f"""
    SELECT ticker, trading_date,
           list({_vec_sql(SPEC.sequence)}) OVER (PARTITION BY ticker ORDER BY trading_date
                ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS sequence,
           {_vec_sql(SPEC.tabular)} AS tabular,
           CAST(label_next_5d_return AS FLOAT) AS target
    FROM fact WHERE label_next_5d_return IS NOT NULL""")], "SELECT * FROM w_s WHERE len(sequence) = 30")


@register("sample_windows", _WINDOWS_SQL)
def sample_windows(spark: SparkSession, d: str):
    """W25/ML4: 30-row training windows (sequence 30x6, tabular 13, target)."""
    return S.sample_windows(build_model_frame(spark, d), SPEC)


@register("sample_blocks", _WINDOWS_SQL)
def sample_blocks(spark: SparkSession, d: str):
    """W25/ML4/SNK15: the same windows written as overlapping blocks, each row about once, and read back."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/samples-{uuid.uuid4().hex}"
    L.write_samples(build_model_frame(spark, d), folder, SPEC)
    return L.read_samples(spark, folder, SPEC)


@register("auto_cutoffs", _fact_sql(_CUTS_SQL, "SELECT * FROM k_cuts"))
def auto_cutoffs(spark: SparkSession, d: str):
    """AGG8/ML2: chronological 80/90 % cut dates over labelled rows of the fact table."""
    return S.auto_cutoffs(_labelled(spark, d, once=True))


@register("time_split", _fact_sql(_CUTS_SQL + [
    ("t_f", """
      SELECT f.*, CASE WHEN trading_date <= c.train_end THEN 'train'
                       WHEN trading_date <= c.val_end THEN 'val' ELSE 'test' END AS split
      FROM fact f, k_cuts c WHERE label_next_5d_return IS NOT NULL"""),
    ("t_w", """
      SELECT split, trading_date,
             COUNT(*) OVER (PARTITION BY ticker, split ORDER BY trading_date
                            ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS n
      FROM t_f"""),
], """SELECT split, COUNT(*) AS n_samples, MIN(trading_date) AS first_date, MAX(trading_date) AS last_date
      FROM t_w WHERE n = 30 GROUP BY split"""))
def time_split(spark: SparkSession, d: str):
    """ML1 + ML4 + ML5: split by the auto cut dates, windows built inside each split."""
    fact = _labelled(spark, d)
    cuts = S.cut_dates(fact)
    split = S.time_split(fact, cuts["train_end"], cuts["val_end"])
    spec = S.FeatureSpec()
    labelled = split.where(F.col(spec.target).isNotNull())
    from pyspark.sql import Window

    w = Window.partitionBy("ticker", "split").orderBy("trading_date").rowsBetween(-(spec.window - 1), 0)
    n = labelled.select("split", "trading_date", F.count(F.lit(1)).over(w).alias("n"))
    return n.where(F.col("n") == spec.window).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_samples"), F.min("trading_date").alias("first_date"),
        F.max("trading_date").alias("last_date"))


@register("latest_window", _fact_sql([
    ("l_slice", """
      SELECT * FROM fact
      WHERE trading_date <= (SELECT MAX(trading_date) FROM fact)
        AND trading_date > (SELECT MAX(trading_date) FROM fact) - INTERVAL 90 DAY"""),
    ("l_w", f"""
      SELECT ticker, trading_date,
             list({_vec_sql(SPEC.sequence)}) OVER (PARTITION BY ticker ORDER BY trading_date
                  ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS sequence,
             {_vec_sql(SPEC.tabular)} AS tabular,
             ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY trading_date DESC) AS rn
      FROM l_slice"""),
], "SELECT ticker, trading_date, sequence, tabular FROM l_w WHERE rn = 1 AND len(sequence) = 30"))
def latest_window(spark: SparkSession, d: str):
    """SRC10 + W26: 90-day look-back from the newest date, newest full window per ticker."""
    fact = build_model_frame(spark, d, recent=True)
    return S.latest_window(lookback_slice(fact, "trading_date", days=90, dates=P.stock_price_eod(spark, d)), SPEC)


_NULL_COLS = SPEC.sequence + SPEC.tabular


@register("null_rates", _fact_sql([
    ("n_latest", "SELECT * FROM fact WHERE trading_date = (SELECT MAX(trading_date) FROM fact)"),
], " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS null_rate "
    "FROM n_latest"
    for c in _NULL_COLS)))
def null_rates(spark: SparkSession, d: str):
    """SRC9 + AGG9: null rate of every model input on the newest trading date (DQ5 input)."""
    return Q.null_rates(latest_slice(build_model_frame(spark, d, recent=True), "trading_date", P.stock_price_eod(spark, d)),
                        list(_NULL_COLS))


_DRIFT = "price_momentum_1m / 6"


@register("regression_metrics", _fact_sql(_CUTS_SQL + [
    ("r_f", f"""
      SELECT CASE WHEN trading_date <= c.train_end THEN 'train'
                  WHEN trading_date <= c.val_end THEN 'val' ELSE 'test' END AS split,
             {_DRIFT} - label_next_5d_return AS err
      FROM fact f, k_cuts c WHERE label_next_5d_return IS NOT NULL"""),
], """SELECT split, SQRT(AVG(err * err)) AS rmse, AVG(ABS(err)) AS mae, COUNT(err) AS n
      FROM r_f GROUP BY split"""))
def regression_metrics(spark: SparkSession, d: str):
    """AGG10/ML7: RMSE and MAE per split of a drift baseline (1-month momentum scaled to 5 days)."""
    fact = _labelled(spark, d, with_momentum=True)
    cuts = S.cut_dates(fact)
    split = S.time_split(fact.where(F.col(SPEC.target).isNotNull()), cuts["train_end"], cuts["val_end"])
    return M.rmse_mae(split, pred=F.col("price_momentum_1m") / 6, target=SPEC.target, by="split")


@register("promotion", _fact_sql(_CUTS_SQL + [
    ("p_t", f"""
      SELECT {_DRIFT} - label_next_5d_return AS e_champ, 0 - label_next_5d_return AS e_chal
      FROM fact f, k_cuts c WHERE label_next_5d_return IS NOT NULL AND trading_date > c.val_end"""),
    ("p_m", """
      SELECT SQRT(AVG(e_champ * e_champ)) AS champion_rmse, SQRT(AVG(e_chal * e_chal)) AS challenger_rmse
      FROM p_t"""),
], """SELECT champion_rmse, challenger_rmse,
             CASE WHEN champion_rmse IS NULL THEN TRUE
                  WHEN champion_rmse <= 0 THEN challenger_rmse < champion_rmse
                  ELSE (champion_rmse - challenger_rmse) / champion_rmse >= 0.05 END AS promote
      FROM p_m"""))
def promotion(spark: SparkSession, d: str):
    """ML9: champion = drift baseline, challenger = zero forecast, on the test split."""
    fact = _labelled(spark, d, with_momentum=True)
    cuts = S.cut_dates(fact)
    test = fact.where(F.col(SPEC.target).isNotNull() & (F.col("trading_date") > cuts["val_end"]))
    y = F.col(SPEC.target)
    m = test.agg(
        F.sqrt(F.avg(F.pow(F.col("price_momentum_1m") / 6 - y, 2))).alias("champion_rmse"),
        F.sqrt(F.avg(F.pow(F.lit(0) - y, 2))).alias("challenger_rmse"),
    )
    return m.select("champion_rmse", "challenger_rmse",
                    M.promote_col(F.col("challenger_rmse"), F.col("champion_rmse"), 0.05).alias("promote"))


@register("next_weekday", _fact_sql([], """
    SELECT DISTINCT trading_date,
           trading_date + CAST(CASE dayofweek(trading_date) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS INTEGER)
             AS forecast_date
    FROM fact"""))
def next_weekday_q(spark: SparkSession, d: str):
    """F16: forecast date = next Monday-Friday after each trading date of the fact table."""
    fact = P.stock_price_eod(spark, d, once=True)
    return fact.select("trading_date").distinct().select("trading_date", next_weekday("trading_date").alias(
        "forecast_date"))


@register("key_uniqueness", _fact_sql([("q_k", """
    SELECT ticker, trading_date, COUNT(*) AS c,
           MAX(CASE WHEN ticker IS NULL OR trading_date IS NULL THEN 1 ELSE 0 END) AS nk
    FROM fact GROUP BY ticker, trading_date""")], """
    SELECT CAST(SUM(c) AS BIGINT) AS n_rows, CAST(COALESCE(SUM(CASE WHEN nk = 1 THEN c END), 0) AS BIGINT)
             AS null_key_rows, COUNT(CASE WHEN c > 1 THEN 1 END) AS duplicate_keys
    FROM q_k"""))
def key_uniqueness(spark: SparkSession, d: str):
    """DQ1-DQ3 on the fact table's unique key."""
    return Q.key_report(build_fact(spark, d), ["ticker", "trading_date"])


@register("ml_scores")
def ml_scores(spark: SparkSession, d: str):
    """ML6 + ML8 (no SQL form): Huber regression fitted on the training windows,
    then the newest window of every ticker scored.  The model frame and the
    training windows are each written once to the checkpoint folder: the fit
    makes several passes over them."""
    fact = cut_lineage(build_model_frame(spark, d))
    samples = S.sample_windows(fact, SPEC)
    train = cut_lineage(samples.where(F.col("trading_date") <= S.cut_dates(fact)["train_end"]))
    model = M.fit_regressor(train)
    latest = S.latest_window(lookback_slice(fact, "trading_date", days=90), SPEC)
    return M.score(model, latest)


_ROUNDS, _WIDTH = 4, len(_NULL_COLS) + 1
_Z = ("list_prepend(CAST(1 AS DOUBLE), [CASE WHEN s.spread[j] > 0 THEN (x[j] - s.mean[j]) / s.spread[j] ELSE 0 END "
      f"for j in range(1, {_WIDTH})])")


def _huber_sql() -> str:
    """The rounds of the fit as common tables: weights, sums of products, elimination, coefficients."""
    p = _WIDTH
    values = "[" + ", ".join(f"CAST(CAST(COALESCE({c}, 0) AS FLOAT) AS DOUBLE)" for c in _NULL_COLS) + "]"
    parts = [
        ("h_rows", f"SELECT ticker, trading_date, {values} AS x, CAST(CAST({SPEC.target} AS FLOAT) AS DOUBLE) AS y FROM fact"),
        ("h_train", "SELECT x, y FROM h_rows, k_cuts c WHERE y IS NOT NULL AND trading_date <= c.train_end"),
        ("h_scale", """SELECT list(mean ORDER BY j) AS mean, list(spread ORDER BY j) AS spread FROM (
            SELECT j, AVG(v) AS mean, STDDEV_POP(v) AS spread
            FROM (SELECT unnest(x) AS v, generate_subscripts(x, 1) AS j FROM h_train) GROUP BY j)"""),
        ("h_z", f"SELECT {_Z} AS z, y FROM h_train, h_scale s"),
        ("h_b0", f"SELECT [CAST(0 AS DOUBLE) for j in range(0, {p})] AS b, CAST('Infinity' AS DOUBLE) AS bend"),
    ]
    for t in range(1, _ROUNDS + 2):
        parts += [
            (f"h_w{t}", f"""SELECT list_append(z, y) AS a, r, bend, CASE WHEN r <= bend THEN 1 ELSE bend / r END AS w
                FROM (SELECT z, y, abs(y - list_dot_product(z, b)) AS r, bend FROM h_z, h_b{t - 1})"""),
            (f"h_n{t}", f"""SELECT COUNT(*) AS n, {H.BEND} * sqrt(SUM(LEAST(r, bend) * LEAST(r, bend)) / COUNT(*) / {1 if t == 1 else H.cut_square(H.BEND)})
                AS bend FROM h_w{t}"""),
            (f"h_m{t}", f"""SELECT list(cells ORDER BY i) AS m FROM (
                SELECT i, list(s ORDER BY j) AS cells FROM (
                  SELECT i, j, SUM(w * a[i] * a[j]) + CASE WHEN i = j THEN {H.RIDGE} * COUNT(*) ELSE 0 END AS s
                  FROM h_w{t}, range(1, {p + 1}) u(i), range(1, {p + 2}) v(j) GROUP BY i, j) GROUP BY i)"""),
            (f"h_s{t}", f"""SELECT 1 AS k, m FROM h_m{t} UNION ALL
                SELECT k + 1, [CASE WHEN i = k THEN [v / m[k][k] for v in m[k]]
                               ELSE [m[i][j] - m[i][k] * m[k][j] / m[k][k] for j in range(1, {p + 2})] END for i in range(1, {p + 1})]
                FROM h_s{t} WHERE k <= {p}"""),
            (f"h_b{t}", f"SELECT [m[i][{p + 1}] for i in range(1, {p + 1})] AS b, bend FROM h_s{t}, h_n{t} WHERE k = {p + 1}"),
        ]
    return _fact_sql(_CUTS_SQL + parts, f"""
        SELECT ticker, trading_date, ROUND(list_dot_product({_Z}, b), 6) AS predicted_return, c.n AS n_train
        FROM (SELECT * FROM h_rows QUALIFY ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY trading_date DESC) = 1), h_scale s,
             h_b{_ROUNDS + 1}, h_n{_ROUNDS + 1} c""")


@register("huber_scores", _huber_sql())
def huber_scores(spark: SparkSession, d: str):
    """ML6 + ML8: Huber regression on the model inputs of each training row by four reweighted rounds, then the newest
    row of every ticker scored.  The model frame is written once to the checkpoint folder, as every round reads it."""
    fact = build_model_frame(spark, d)
    inputs = F.array(*[F.coalesce(F.col(c).cast("float"), F.lit(0).cast("float")) for c in _NULL_COLS])
    rows = cut_lineage(fact.select("ticker", "trading_date", inputs.alias("x"), F.col(SPEC.target)))
    cuts = S.cut_dates(rows)
    train = rows.where(F.col("trading_date") <= cuts["train_end"]).withColumn("y", F.col(SPEC.target).cast("float"))
    model = H.fit_huber(train, "x", "y", rounds=_ROUNDS)
    newest = rows.groupBy("ticker").agg(F.max_by(F.struct("trading_date", "x"), "trading_date").alias("row"))
    return newest.select("ticker", "row.trading_date", F.round(model.predict(F.col("row.x")), 6).alias("predicted_return"),
                         F.lit(model.rows).cast("bigint").alias("n_train"))
