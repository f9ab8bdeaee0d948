"""Window functions over price series: averages, indicators, change counts, rates, hold times.

A series is one key (`by`) in order of time. Range frames and recursions stay exact for keys of any
size: see `shelfmark.functions.skew` for how a heavy key is cut and stitched.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.columns import decay_depth, growth
from shelfmark.functions.skew import MAX_ROWS, POS, behind, blocks, numbered, routed, running, whole

SPAN = 256  # rows per stretch in which an exponential weight is kept relative
STRETCH = "_stretch"
# Of a resumed series: rows of the run before, its sums at the last of them, number of the first row, sums so far.
OLD, SEED, OFFSET, CARRIED = "_old", "_seed", "_offset", "_carried"
EXACT = "decimal(38,12)"  # running totals of a long series lose nothing that a window's difference shows
MICROS = "_us"  # sample time; a frame that has it keeps one sort order through several steps


def order_of(df: DataFrame, ts: str = "timestamp", tie: str = "event_id") -> list[str]:
    return [ts, tie] if tie in df.columns else [ts]


def micros_of(df: DataFrame, interval: str) -> int:
    """Length of an interval such as `5 minutes` in microseconds."""
    text = f"unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {interval})"
    return df.sparkSession.sql(f"SELECT {text} AS us").first()["us"]


# --- windows over aggregated frames (one row per key and period) -------------------------------

def moving_avg(df: DataFrame, value: str, by: Sequence[str], order: str, rows: int,
               alias: str) -> DataFrame:
    """Mean of the current and the `rows - 1` rows before it; early rows average what exists."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-(rows - 1), 0)
    return df.withColumn(alias, F.avg(value).over(w))


def with_previous(df: DataFrame, cols: Sequence[str], by: Sequence[str], order: str,
                  prefix: str = "prev_") -> DataFrame:
    """Values of the previous row of the key (not of the previous calendar day)."""
    w = Window.partitionBy(*by).orderBy(order)
    return df.withColumns({f"{prefix}{c}": F.lag(c).over(w) for c in cols})


def growth_pct(now: str, before: str, first: int | None = 0, integer: bool = False) -> Column:
    """Percent change on the previous row; the first row gives `first`."""
    change = growth(now, before, integer)
    if first is None:
        return change
    return F.when(F.col(before).isNotNull(), change).otherwise(F.lit(first).cast("decimal(20,2)"))


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key.

    Spark keeps only the leading row per key and task before the shuffle (`WindowGroupLimit`), so a
    hot key, however often it repeats, reaches its task as one row from each task before.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key."""
    return first_by(df, keys, [F.col(c).desc_nulls_last() for c in order])


# --- indicators ---------------------------------------------------------------------------------

def _position(df: DataFrame, part: Sequence[str], order: Sequence[str], heavy: bool) -> DataFrame:
    if not heavy:
        w = Window.partitionBy(*part).orderBy(*order)
        df = df.withColumn(POS, (F.row_number().over(w) - 1).cast("bigint"))
    return df.withColumn(STRETCH, F.floor(F.col(POS) / SPAN))


def _decayed(df: DataFrame, part: Sequence[str], sums: dict[str, tuple[Column, float]]) -> DataFrame:
    """Adds `sum over rows i up to this of value_i * decay ** (pos - i)` for each (value, decay).

    The work per row is constant. Inside a stretch of SPAN rows it is a running sum of
    `value / decay ** offset`; earlier stretches enter through one sum each, as far back as a weight
    still shows in a double. All running sums come first, so one sort serves both kinds of window.
    """
    offset = F.col(POS) % SPAN
    inside = Window.partitionBy(*part, STRETCH).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns({
        f"_l_{k}": F.sum(v * F.pow(F.lit(1.0 / decay), offset)).over(inside) for k, (v, decay) in sums.items()})
    carried = {}
    for k, (value, decay) in sums.items():
        at_end = value * F.pow(F.lit(decay), F.lit(SPAN - 1) - offset)
        carry = F.lit(0.0)
        for back in range(1, decay_depth(decay, SPAN) + 1):
            w = Window.partitionBy(*part).orderBy(STRETCH).rangeBetween(-back, -back)
            carry = carry + F.coalesce(F.sum(at_end).over(w), F.lit(0.0)) * decay ** (SPAN * (back - 1))
        weight = F.pow(F.lit(decay), offset)
        carried[k] = F.col(f"_l_{k}") * weight + carry * weight * decay
    return df.withColumns(carried).drop(*[f"_l_{k}" for k in sums])


def _lookback(decay: float) -> int:
    return (decay_depth(decay, SPAN) + 1) * SPAN


def sma(df: DataFrame, rows: int = 7, by: Sequence[str] = ("item_id",), value: str = "price",
        alias: str = "sma_7", max_rows: int = MAX_ROWS) -> DataFrame:
    """Simple moving average over the last `rows` samples."""
    return indicators(df, by=by, value=value, sma_rows=rows, names={"sma": alias}, max_rows=max_rows)


def sma_days(df: DataFrame, days: int = 7, by: Sequence[str] = ("item_id",), value: str = "price",
             alias: str = "sma_7d", max_rows: int = MAX_ROWS) -> DataFrame:
    """Simple moving average over the trailing `days` days, the left end open."""
    span = days * 86_400_000_000

    def plan(rows: DataFrame, heavy: bool) -> DataFrame:
        if not heavy:
            w = Window.partitionBy(*by).orderBy(F.unix_micros("timestamp")).rangeBetween(-span + 1, 0)
            return rows.withColumn(alias, F.avg(value).over(w))
        # One row per instant: samples of one instant share their mean.
        at = rows.groupBy(*by, F.unix_micros("timestamp").alias(MICROS)).agg(
            F.sum(F.col(value).cast(EXACT)).alias("_sum"), F.count(value).alias("_n"))
        means = _mean_behind(at, by, span, max_rows).select(*by, MICROS, F.col("_mean").alias(alias))
        return rows.withColumn(MICROS, F.unix_micros("timestamp")).join(means, [*by, MICROS]).drop(MICROS).select(
            *rows.columns, alias)

    return routed(df, by, order_of(df), max_rows, plan, number=False)


def _mean_behind(at: DataFrame, by: Sequence[str], span: int, max_rows: int) -> DataFrame:
    """Mean over the trailing span for heavy keys, from (key, MICROS, _sum, _n): difference of running totals."""
    d, _ = blocks(numbered(at, by, [MICROS], max_rows), by, 1, max_rows, True)
    d = whole(running(d, by, [POS], True, totals={"_all": "_sum", "_count": "_n"}), True)
    d = d.withColumns({"_all_before": F.col("_all") - F.coalesce("_sum", F.lit(0)), "_count_before": F.col("_count") - F.col("_n")})
    d = behind(d, by, MICROS, F.col(MICROS) - F.lit(span), ["_all_before", "_count_before"], "_edge", max_rows)
    total = (F.col("_all") - F.col("_edge._all_before")).cast("double")
    return d.withColumn("_mean", F.try_divide(total, (F.col("_count") - F.col("_edge._count_before")).cast("double")))


def ema(df: DataFrame, n: int = 14, by: Sequence[str] = ("item_id",), value: str = "price",
        alias: str = "ema_14", max_rows: int = MAX_ROWS) -> DataFrame:
    """Exponential moving average with weight `2 / (n + 1)`, started by the first value."""
    return indicators(df, by=by, value=value, ema_n=n, names={"ema": alias}, max_rows=max_rows)


def rsi(df: DataFrame, n: int = 14, method: str = "wilder", by: Sequence[str] = ("item_id",),
        value: str = "price", alias: str = "rsi_14", max_rows: int = MAX_ROWS) -> DataFrame:
    """Relative strength index; NULL before `n` changes, 100 without losses, 50 without moves.

    `wilder` smooths gains and losses with weight `1 / n` after averaging the first `n`; `cutler`
    takes plain means of the last `n`.
    """
    return indicators(df, by=by, value=value, rsi_n=n, method=method, names={"rsi": alias},
                      max_rows=max_rows)


def price_changes(df: DataFrame, by: Sequence[str] = ("item_id",), value: str = "price",
                  alias: str = "price_changes", max_rows: int = MAX_ROWS) -> DataFrame:
    """Running count of samples whose value differs from the one before."""
    return indicators(df, by=by, value=value, names={"changes": alias}, max_rows=max_rows)


def indicators(df: DataFrame, names: dict[str, str], by: Sequence[str] = ("item_id",),
               value: str = "price", sma_rows: int = 7, ema_n: int = 14, rsi_n: int = 14,
               method: str = "wilder", max_rows: int = MAX_ROWS) -> DataFrame:
    """Any of `sma`, `ema`, `rsi`, `changes` (keys of `names`) over one shuffle of the samples."""
    step = indicator_step(order_of(df), names, by, value, sma_rows, ema_n, rsi_n, method, max_rows)
    return routed(df, by, order_of(df), max_rows, step)


def indicator_step(order: Sequence[str], names: dict[str, str], by: Sequence[str], value: str = "price",
                   sma_rows: int = 7, ema_n: int = 14, rsi_n: int = 14, method: str = "wilder",
                   max_rows: int = MAX_ROWS, resume: bool = False) -> Callable[[DataFrame, bool], DataFrame]:
    """Adds the indicators of `names`.

    With `resume` a key begins with rows of an earlier run (`OLD`), the last of which carries that run's sums
    (`SEED`); its rows are then numbered from `OFFSET` on, and the sums stay in the result (`CARRIED`).
    """
    if min(ema_n, rsi_n) < 2:
        raise ValueError("periods must be at least 2")
    if method not in ("wilder", "cutler"):
        raise ValueError("method must be 'wilder' or 'cutler'")
    ema_decay, rsi_decay = 1 - 2 / (ema_n + 1), 1 - 1 / rsi_n
    before = max(
        sma_rows - 1 if "sma" in names else 0,
        _lookback(ema_decay) if "ema" in names else 0,
        (_lookback(rsi_decay) if method == "wilder" else rsi_n) if "rsi" in names else 0,
        1,
    )

    def step(rows: DataFrame, heavy: bool) -> DataFrame:
        d, part = blocks(rows, by, before, max_rows, heavy)
        ordered = Window.partitionBy(*part).orderBy(*order)
        d = _position(d, part, order, heavy)
        x = F.col(value).cast("double")
        place = F.col(POS) + F.coalesce(F.col(OFFSET), F.lit(0)) if resume else F.col(POS)

        def new(term: Column, seed: str, none: Column = F.lit(0.0)) -> Column:
            """What a row adds: the carried sum at the last earlier row, nothing at those before it."""
            return F.when(F.col(SEED).isNotNull(), F.col(f"{SEED}.{seed}")).when(F.col(OLD), none).otherwise(term) if resume else term

        totals, fills, sums = {}, {}, {}
        if "sma" in names:
            d = d.withColumn(names["sma"], F.avg(x).over(ordered.rowsBetween(-(sma_rows - 1), 0)))
        if "rsi" in names or "changes" in names:
            d = d.withColumn("_move", x - F.lag(x).over(ordered))
        if "rsi" in names:
            move = F.coalesce(F.col("_move"), F.lit(0.0))
            d = d.withColumns({"_gain": F.greatest(move, F.lit(0.0)),
                               "_loss": F.greatest(-move, F.lit(0.0))})
            if method == "cutler":
                w = ordered.rowsBetween(-(rsi_n - 1), 0)
                d = d.withColumns({"_up": F.avg("_gain").over(w), "_down": F.avg("_loss").over(w)})
            else:
                # The first n moves weigh the same at move n, which is their mean there.
                seed = F.when(place <= rsi_n, F.pow(F.lit(rsi_decay), place - rsi_n))
                weight = F.coalesce(seed, F.lit(1.0)) / rsi_n
                sums["_up"] = (new(F.col("_gain") * weight, "up"), rsi_decay)
                sums["_down"] = (new(F.col("_loss") * weight, "down"), rsi_decay)
        if "ema" in names:
            start = F.when(place == 0, x).otherwise(x * (1 - ema_decay))
            sums[names["ema"]] = (new(start, "ema"), ema_decay)
        if sums:
            d = _decayed(d, part, sums)
        if "rsi" in names:
            level = (
                F.when((F.col("_up") == 0) & (F.col("_down") == 0), F.lit(50.0))
                .when(F.col("_down") == 0, F.lit(100.0))
                .otherwise(F.lit(100.0) - F.lit(100.0) / (1 + F.col("_up") / F.col("_down")))
            )
            known = place >= rsi_n
            if method == "wilder":
                # A sample without a move leaves the index as it was, however far back the move is.
                moved = (F.col("_move") != 0) | (place == rsi_n)
                d = d.withColumn("_level", new(F.when(known & moved, level), "rsi", F.lit(None)))
                fills[names["rsi"]] = "_level"
            else:
                d = d.withColumn(names["rsi"], F.when(known, level))
        if "changes" in names:
            moved = F.coalesce(F.col("_move") != 0, F.lit(False))
            d = d.withColumn("_changed", new(moved.cast("bigint"), "changes", F.lit(0)))
            totals[names["changes"]] = "_changed"
        if totals or fills:
            # The order in which the decayed sums left the rows, which is also that of the samples.
            sorted_by = [STRETCH, POS] if sums else order
            d = running(d, by, sorted_by, heavy, totals, fills)
        if resume:
            d = d.withColumn(CARRIED, F.struct(place.alias("place"), F.col("_up").alias("up"), F.col("_down").alias("down")))
        d = whole(d, heavy).drop("_move", "_gain", "_loss", "_up", "_down", "_level", "_changed", STRETCH)
        return d if heavy else d.drop(POS)

    return step


# --- range windows over samples -----------------------------------------------------------------

def in_window(df: DataFrame, window: str, measures: Sequence[str], by: Sequence[str] = ("item_id",),
              value: str = "price", max_rows: int = MAX_ROWS,
              names: dict[str, str] | None = None) -> DataFrame:
    """`changes`, `rate`, `pct_change` of each sample over the window that ends with it.

    The window is open on the left. Expects one sample per key and instant (`latest_by`), since a
    range frame takes samples of one instant together. The first sample in the window has no
    predecessor there. A drop counts as a reset for the rate, adding the new value; the rate is NULL
    when the window holds one sample.
    """
    step = window_step(micros_of(df, window), measures, by, value, names, max_rows)
    return routed(df, by, order_of(df), max_rows, step)


def window_step(span: int, measures: Sequence[str], by: Sequence[str], value: str = "price",
                names: dict[str, str] | None = None, max_rows: int = MAX_ROWS) -> Callable[[DataFrame, bool], DataFrame]:
    names = {m: m for m in measures} | (names or {})

    def step(rows: DataFrame, heavy: bool) -> DataFrame:
        d, part = blocks(rows, by, 1, max_rows, heavy)
        if MICROS not in d.columns:
            d = d.withColumn(MICROS, F.unix_micros("timestamp"))
        d = d.withColumn("_x", F.col(value).cast("double"))
        ordered = Window.partitionBy(*part).orderBy(MICROS)
        d = d.withColumn("_last_x", F.lag("_x").over(ordered))
        rise = F.when(F.col("_x") < F.col("_last_x"), F.col("_x")).otherwise(F.col("_x") - F.col("_last_x"))
        d = d.withColumns({
            "_diff": F.coalesce(F.col("_x") != F.col("_last_x"), F.lit(False)).cast("bigint"),
            "_rise": F.coalesce(rise, F.lit(0.0)),
        })
        if heavy:
            # Totals from the start of the key, and those of the first row in the window.
            d = d.withColumn("_up_by", F.col("_rise").cast(EXACT))
            d = whole(running(d, by, [POS], True, totals={"_diffs": "_diff", "_rises": "_up_by"}), True)
            d = behind(d, by, MICROS, F.col(MICROS) - F.lit(span), ["_diffs", "_rises", "_x", MICROS], "_edge", max_rows)
            start, since = F.col("_edge._x"), F.col(f"_edge.{MICROS}")
            changed = F.col("_diffs") - F.col("_edge._diffs")
            risen = (F.col("_rises") - F.col("_edge._rises")).cast("double")
        else:
            frame = ordered.rangeBetween(-span + 1, 0)
            start, since = F.first("_x").over(frame), F.first(MICROS).over(frame)
            changed = F.sum("_diff").over(frame) - F.first("_diff").over(frame)
            risen = F.sum("_rise").over(frame) - F.first("_rise").over(frame)
        out = {}
        if "changes" in measures:
            out[names["changes"]] = changed
        if "rate" in measures:
            out[names["rate"]] = F.try_divide(risen, F.nullif((F.col(MICROS) - since) / 1e6, F.lit(0.0)))
        if "pct_change" in measures:
            out[names["pct_change"]] = (F.col("_x") - start) / F.nullif(start, F.lit(0.0)) * 100
        kept = () if MICROS in rows.columns else (MICROS,)
        return d.withColumns(out).drop("_x", "_last_x", "_diff", "_rise", "_up_by", "_diffs", "_rises", "_edge", *kept)

    return step


def changes_in(df: DataFrame, window: str = "1 hour", alias: str = "changes", **kw) -> DataFrame:
    """Number of value changes between samples inside the window."""
    return in_window(df, window, ["changes"], names={"changes": alias}, **kw)


def rate_in(df: DataFrame, window: str = "5 minutes", alias: str = "rate", **kw) -> DataFrame:
    """Increase per second over the span of the samples in the window."""
    return in_window(df, window, ["rate"], names={"rate": alias}, **kw)


def pct_change_in(df: DataFrame, window: str = "5 minutes", alias: str = "pct_change", **kw) -> DataFrame:
    """Percent difference of the last and the first sample in the window."""
    return in_window(df, window, ["pct_change"], names={"pct_change": alias}, **kw)


def held_since(df: DataFrame, conditions: dict[str, Column], by: Sequence[str] = ("item_id",),
               max_rows: int = MAX_ROWS) -> DataFrame:
    """For each condition the instant since which it has been true without a break, else NULL."""
    step = hold_step(order_of(df), conditions, by, max_rows)
    return routed(df, by, order_of(df), max_rows, step)


def hold_step(order: Sequence[str], conditions: dict[str, Column], by: Sequence[str],
              max_rows: int = MAX_ROWS, resume: bool = False) -> Callable[[DataFrame, bool], DataFrame]:
    """Adds for each condition since when it holds; with `resume`, see `indicator_step`."""
    def step(rows: DataFrame, heavy: bool) -> DataFrame:
        d, part = blocks(rows, by, 1, max_rows, heavy)
        truth = {f"_is_{k}": F.coalesce(c, F.lit(False)) for k, c in conditions.items()}
        if resume:
            truth = {f"_is_{k}": F.when(F.col(SEED).isNotNull(), F.col(f"{SEED}.{k}").isNotNull()).when(
                F.col(OLD), F.lit(False)).otherwise(truth[f"_is_{k}"]) for k in conditions}
        d = d.withColumns(truth)
        w = Window.partitionBy(*part).orderBy(*order)
        entered = {k: F.when(F.col(f"_is_{k}") & ~F.lag(f"_is_{k}", 1, False).over(w), F.col("timestamp")) for k in conditions}
        if resume:
            entered = {k: F.coalesce(F.col(f"{SEED}.{k}"), e) for k, e in entered.items()}
        d = d.withColumns({f"_from_{k}": e for k, e in entered.items()})
        d = running(d, by, order, heavy, fills={k: f"_from_{k}" for k in conditions})
        d = d.withColumns({k: F.when(F.col(f"_is_{k}"), F.col(k)) for k in conditions})
        return whole(d, heavy).drop(*[f"{p}{k}" for k in conditions for p in ("_is_", "_from_")])

    return step


def held_for(df: DataFrame, condition: Column, hold: str, by: Sequence[str] = ("item_id",),
             alias: str = "held", max_rows: int = MAX_ROWS) -> DataFrame:
    """True where the condition has been true without a break for at least `hold`."""
    out = held_since(df, {"_since": condition}, by, max_rows)
    lasted = F.col("timestamp") >= F.col("_since") + F.expr(f"interval {hold}")
    return out.withColumn(alias, F.coalesce(lasted, F.lit(False))).drop("_since")
