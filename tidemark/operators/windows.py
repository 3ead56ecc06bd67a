"""Time-series window features.

A series is rows keyed by ``(key, date)``; steps are counted in rows, not
days.  Every helper takes an ordered ``WindowSpec`` (``series_window``) so
many features share one Exchange + Sort: write them in the same ``select``.

Windows cannot be split inside one key; keys here are a ticker or a series
name, whose length is bounded by the trading calendar (thousands of rows), so
a hot key costs one task a few thousand rows, not a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def series_window(keys: str | Sequence[str], order: str | Sequence[str]) -> WindowSpec:
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*keys).orderBy(*order)


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    """ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW."""
    return w.rowsBetween(-(n - 1), 0)


def ahead(w: WindowSpec, start: int, end: int) -> WindowSpec:
    """ROWS BETWEEN start FOLLOWING AND end FOLLOWING."""
    return w.rowsBetween(start, end)


def guarded_ratio_minus1(num: Column, den: Column, strictly_positive: bool = True) -> Column:
    """``num/den - 1`` when the base is > 0 (or != 0), else NULL (PRJ12 shape)."""
    ok = den > 0 if strictly_positive else den != 0
    return F.when(ok, num / den - 1)


# W1 ---------------------------------------------------------------------------
def lag_n(x: str | Column, n: int, w: WindowSpec) -> Column:
    return F.lag(_c(x), n).over(w)


def lead_n(x: str | Column, n: int, w: WindowSpec) -> Column:
    return F.lead(_c(x), n).over(w)


# W2 / W3 ----------------------------------------------------------------------
def simple_return(x: str | Column, w: WindowSpec, n: int = 1) -> Column:
    """x / lag(x, n) - 1 when lag > 0 (the reference calls it a log return; it is simple, D9)."""
    return guarded_ratio_minus1(_c(x), lag_n(x, n, w))


def momentum(x: str | Column, n: int, w: WindowSpec) -> Column:
    """Price momentum over n rows: 30/90 in the SQL marts, 20/60 in the offline builder."""
    return simple_return(x, w, n)


# W4 / W5 / W7 -----------------------------------------------------------------
def rolling_mean(x: str | Column, n: int, w: WindowSpec, min_periods: int = 1) -> Column:
    """Mean over the trailing n rows.  ``min_periods=n`` gives the pandas
    ``rolling(n).mean()`` rule (NULL until the frame is full, D10); the
    default 1 gives the partial frame of the SQL marts."""
    frame = trailing(w, n)
    mean = F.avg(_c(x)).over(frame)
    if min_periods <= 1:
        return mean
    return F.when(F.count(_c(x)).over(frame) >= min_periods, mean)


def running_total(x: str | Column, w: WindowSpec) -> Column:
    """Sum from the series start to the current row (incremental frame, O(1) per row)."""
    return F.sum(_c(x)).over(w.rowsBetween(Window.unboundedPreceding, 0))


def rolling_mean_exact(df: DataFrame, x: str, n: int, w: WindowSpec, out: str, min_periods: int = 1,
                       scale: float | None = None) -> DataFrame:
    """Trailing n-row mean of an *integer* column in O(rows) instead of O(rows x n).

    sum over the frame = running_total(t) - running_total(t - n); with integer
    inputs both totals are exact, so the mean equals ``avg`` over the frame bit
    for bit.  (Floating inputs must use ``rolling_mean``: differencing running
    float sums would lose precision.)  NULLs are skipped and not counted, as
    ``avg`` does; a frame without values gives NULL."""
    tot, num = f"__tot_{out}", f"__num_{out}"
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    totals = df.withColumns({tot: F.coalesce(running_total(x, w), F.lit(0)), num: F.count(_c(x)).over(run)})
    frame_sum = F.col(tot) - F.coalesce(F.lag(tot, n).over(w), F.lit(0))
    cnt = F.col(num) - F.coalesce(F.lag(num, n).over(w), F.lit(0))
    mean = F.when(cnt >= max(1, min_periods), frame_sum.cast("double") / cnt)
    if scale:
        mean = mean / scale
    return totals.withColumn(out, mean).drop(tot, num)


def rolling_sum(x: str | Column, n: int, w: WindowSpec, min_periods: int = 1) -> Column:
    frame = trailing(w, n)
    s = F.sum(_c(x)).over(frame)
    if min_periods <= 1:
        return s
    return F.when(F.count(_c(x)).over(frame) >= min_periods, s)


# W6 / W16 ---------------------------------------------------------------------
def rolling_std(x: str | Column, n: int, w: WindowSpec, min_periods: int = 2) -> Column:
    """Sample standard deviation over the trailing n rows (one value -> NULL)."""
    frame = trailing(w, n)
    sd = F.stddev_samp(_c(x)).over(frame)
    if min_periods <= 2:
        return sd
    return F.when(F.count(_c(x)).over(frame) >= min_periods, sd)


# W10 --------------------------------------------------------------------------
def rsi(x: str | Column, w: WindowSpec, n: int = 14) -> Column:
    """RSI with simple n-row means of gains and losses (pandas ``rolling(n)``).

    delta = x - lag(x); gain = delta if > 0 else 0 (the first row's missing
    delta counts as 0, as pandas ``where`` does); loss likewise.  NULL until the
    frame holds n rows; loss 0 -> 100; gain and loss 0 -> NULL (0/0).
    rs = mean gain / mean loss is computed as sum gain / sum loss (same value)."""
    delta = _c(x) - F.lag(_c(x), 1).over(w)
    return rsi_from_delta(delta, w, n)


def rsi_from_delta(delta: Column, w: WindowSpec, n: int = 14) -> Column:
    frame = trailing(w, n)
    gain = F.sum(F.when(delta > 0, delta).otherwise(F.lit(0))).over(frame)
    loss = F.sum(F.when(delta < 0, -delta).otherwise(F.lit(0))).over(frame)
    full = F.count(F.lit(1)).over(frame) >= n
    return F.when(full & (loss == 0) & (gain > 0), F.lit(100.0)).when(
        full & (loss > 0), 100 - 100 / (1 + gain.cast("double") / loss.cast("double"))
    )


# W12 / W13 / W14 --------------------------------------------------------------
def buy_ratio(buy: str | Column, sell: str | Column, w: WindowSpec, n: int = 10) -> Column:
    """sum(buy) / sum(buy + sell) over n rows when the denominator is > 0."""
    frame = trailing(w, n)
    num = F.sum(_c(buy)).over(frame)
    den = F.sum(_c(buy) + _c(sell)).over(frame)
    return F.when(den > 0, num / den)


def flow_momentum(df: DataFrame, net: str, w: WindowSpec, n: int = 20, out: str = "net_flow_momentum",
                  sum_col: str = "net_flow_sum") -> DataFrame:
    """Window over a window: S = sum(net, n rows); momentum = S / |lag(S, n)| - 1 when lag != 0."""
    with_sum = df.withColumn(sum_col, F.sum(F.col(net)).over(trailing(w, n)))
    prev = F.lag(F.col(sum_col), n).over(w)
    return with_sum.withColumn(out, F.when(prev != 0, F.col(sum_col) / F.abs(prev) - 1))


# W15 --------------------------------------------------------------------------
def rolling_corr_parity(x: str | Column, y: str | Column, w: WindowSpec, n: int = 10,
                        exact_type: str = "decimal(38,0)") -> Column:
    """Pearson correlation from running sums, with the reference's counting rule:
    N counts every row of the frame (also rows where one side is NULL) while the
    sums skip NULLs (D13).  NULL when N <= 1 or the variance product <= 0.

    Sums are accumulated in ``exact_type`` (integer inputs stay exact), each
    variance factor is cast to double before the product."""
    frame = trailing(w, n)
    xe, ye = _c(x).cast(exact_type), _c(y).cast(exact_type)
    cnt = F.count(F.lit(1)).over(frame).cast(exact_type)
    sx, sy = F.sum(xe).over(frame), F.sum(ye).over(frame)
    sxx, syy, sxy = F.sum(xe * xe).over(frame), F.sum(ye * ye).over(frame), F.sum(xe * ye).over(frame)
    vx = (cnt * sxx - sx * sx).cast("double")
    vy = (cnt * syy - sy * sy).cast("double")
    cov = (cnt * sxy - sx * sy).cast("double")
    prod = vx * vy
    return F.when(cnt <= 1, F.lit(None).cast("double")).when(prod <= 0, F.lit(None).cast("double")).otherwise(
        cov / F.sqrt(prod)
    )


def rolling_corr(x: str | Column, y: str | Column, w: WindowSpec, n: int = 10, min_pairs: int = 2,
                 exact_type: str = "decimal(38,0)") -> Column:
    """Pearson correlation over the complete (x, y) pairs of the trailing frame
    (the clean variant, D13).  NULL with fewer than ``min_pairs`` pairs or zero
    variance.  Sums run in ``exact_type`` (exact for integer inputs; pass
    'double' for fractional inputs), so no ANSI division error and no float
    cancellation in the co-moments."""
    frame = trailing(w, n)
    pair = _c(x).isNotNull() & _c(y).isNotNull()
    xe, ye = F.when(pair, _c(x).cast(exact_type)), F.when(pair, _c(y).cast(exact_type))
    cnt = F.count(F.when(pair, F.lit(1))).over(frame)
    k = cnt.cast(exact_type)
    sx, sy = F.sum(xe).over(frame), F.sum(ye).over(frame)
    sxx, syy, sxy = F.sum(xe * xe).over(frame), F.sum(ye * ye).over(frame), F.sum(xe * ye).over(frame)
    vx = (k * sxx - sx * sx).cast("double")
    vy = (k * syy - sy * sy).cast("double")
    cov = (k * sxy - sx * sy).cast("double")
    prod = vx * vy
    return F.when((cnt >= min_pairs) & (prod > 0), cov / F.sqrt(prod))


# W20-W22 ----------------------------------------------------------------------
def forward_return(x: str | Column, n: int, w: WindowSpec) -> Column:
    """lead(x, n) / x - 1 when x > 0 and the lead exists (label)."""
    nxt = lead_n(x, n, w)
    return F.when((_c(x) > 0) & nxt.isNotNull(), nxt / _c(x) - 1)


def uptrend_flag(x: str | Column, n: int, w: WindowSpec, threshold: float = 0.05) -> Column:
    """1 if the n-row forward return > threshold, 0 when the lead is known, else NULL."""
    nxt = lead_n(x, n, w)
    return (
        F.when((_c(x) > 0) & nxt.isNotNull() & (nxt / _c(x) - 1 > threshold), F.lit(1))
        .when(nxt.isNotNull(), F.lit(0))
        .cast("smallint")
    )


def forward_extreme(x: str | Column, n: int, w: WindowSpec, fn: str = "max") -> Column:
    """max (or min) of the next 1..n rows over x, minus 1, when x > 0.

    ``fn='max'`` reproduces the reference's label named 'max drawdown' (it is a
    run-up, D6); ``fn='min'`` is the true drawdown."""
    agg = F.max if fn == "max" else F.min
    ext = agg(_c(x)).over(ahead(w, 1, n))
    return F.when((_c(x) > 0) & ext.isNotNull(), ext / _c(x) - 1)


# W24 / AGG8 -------------------------------------------------------------------
def date_percent_rank(df: DataFrame, date_col: str) -> DataFrame:
    """PERCENT_RANK() OVER (ORDER BY date) for every *distinct date*, computed
    without a single-partition window over all rows: rows are counted per date
    (partial aggregation), then a running sum runs over the distinct dates only.
    Returns (date, n_rows, pct) where pct = rows strictly before / (N - 1)."""
    per_day = df.groupBy(date_col).agg(F.count(F.lit(1)).alias("n_rows"))
    w = Window.orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy()
    before = F.coalesce(F.sum("n_rows").over(w), F.lit(0))
    n_all = F.sum("n_rows").over(total)
    return per_day.select(
        date_col, "n_rows",
        F.when(n_all > 1, before / (n_all - 1)).otherwise(F.lit(0.0)).alias("pct"),
    )


def _frame_sums(df: DataFrame, exprs: dict[str, Column], n: int, w: WindowSpec) -> DataFrame:
    """Exact trailing n-row sums via running totals differenced with ``lag``: one
    add per row per sum (a sliding frame would re-add n values per row).  NULL
    inputs count as 0; an all-NULL frame gives 0 instead of NULL, which every
    caller below maps to a NULL result through its variance / count guard."""
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    out = df
    for name, e in exprs.items():
        out = out.withColumn(f"__run_{name}", F.coalesce(F.sum(e).over(run), F.lit(0)))
    for name in exprs:
        r = F.col(f"__run_{name}")
        out = out.withColumn(name, r - F.coalesce(F.lag(r, n).over(w), F.lit(0)))
    return out.drop(*[f"__run_{k}" for k in exprs])


def with_rolling_corr(df: DataFrame, x: str, y: str, w: WindowSpec, n: int, out: str, mode: str = "pairs",
                      min_pairs: int = 2, exact_type: str = "decimal(38,0)") -> DataFrame:
    """Frame-level Pearson correlation over the trailing n rows, O(rows).

    ``mode='parity'``: N counts every row of the frame while sums skip NULLs
    (the reference's rule, D13); NULL when N <= 1 or the variance product <= 0.
    ``mode='pairs'``: only complete (x, y) pairs count; NULL below ``min_pairs``
    pairs or with zero variance.  Sums stay exact for integer and decimal inputs
    (a decimal is taken as an integer of its last place: correlation does not
    depend on scale); floating inputs are summed frame by frame."""
    kinds = {f.name: f.dataType for f in df.schema.fields if f.name in (x, y)}
    if any(isinstance(k, (T.DoubleType, T.FloatType)) for k in kinds.values()):
        if mode == "pairs":
            return df.withColumn(out, rolling_corr(x, y, w, n, min_pairs, "double"))
        return df.withColumn(out, rolling_corr_parity(x, y, w, n, "double"))
    lifted = {c: (F.col(c) * 10**k.scale).cast("decimal(38,0)") for c, k in kinds.items()
              if isinstance(k, T.DecimalType) and k.scale}
    if lifted:
        names = {c: f"__lifted_{c}" for c in lifted}
        wide = df.withColumns({names[c]: e for c, e in lifted.items()})
        got = with_rolling_corr(wide, names.get(x, x), names.get(y, y), w, n, out, mode, min_pairs, exact_type)
        return got.drop(*names.values())
    if mode == "pairs":
        pair = F.col(x).isNotNull() & F.col(y).isNotNull()
        xe, ye = F.when(pair, F.col(x).cast(exact_type)), F.when(pair, F.col(y).cast(exact_type))
        cnt_e = F.when(pair, F.lit(1)).otherwise(F.lit(0))
    else:
        xe, ye = F.col(x).cast(exact_type), F.col(y).cast(exact_type)
        cnt_e = F.lit(1)
    p = f"__c_{out}_"
    paired = F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    sums = {p + "np": paired, p + "n": cnt_e.cast("bigint"), p + "sx": xe, p + "sy": ye, p + "sxx": xe * xe, p + "syy": ye * ye,
            p + "sxy": xe * ye}
    d = _frame_sums(df, sums, n, w)
    k, sx, sy = F.col(p + "n"), F.col(p + "sx"), F.col(p + "sy")
    ke = k.cast(exact_type)
    vx = (ke * F.col(p + "sxx") - sx * sx).cast("double")
    vy = (ke * F.col(p + "syy") - sy * sy).cast("double")
    cov = (ke * F.col(p + "sxy") - sx * sy).cast("double")
    prod = vx * vy
    # a frame without a complete pair has no sum of products
    ok = (k > 1) & (F.col(p + "np") > 0) if mode == "parity" else (k >= min_pairs)
    return d.withColumn(out, F.when(ok & (prod > 0), cov / F.sqrt(prod))).drop(*sums)
