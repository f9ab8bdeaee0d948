"""Hot keys: finding them, cutting them into pieces, joining and ordering across the pieces.

A key is heavy when it has more than `max_rows` rows. At most `rows / max_rows` keys can be heavy,
which bounds every frame that is broadcast here (about 10^13 rows at the default limit give at most
2.5 million keys of a few bytes). One narrow counting job tells whether there are any; without them
the ordinary plan is used as it is. Small frames that steer the plan for heavy keys are checkpointed,
so the plan stays linear and a recomputed partition sees the same cuts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import checkpointed

MAX_ROWS = 4_000_000

# Working columns of an ordered series.
POS, BLOCK, HALO = "_pos", "_block", "_halo"


def same(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of `k` and `prefix + position` for all keys."""
    return reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"{prefix}{i}")) for i, k in enumerate(keys)],
    )


def attach(df: DataFrame, small: DataFrame, keys: Sequence[str], cols: Sequence[str | Column],
           how: str = "left", bounded: bool = True) -> DataFrame:
    """Join columns of a small frame on null-safe keys; broadcast only a bounded frame."""
    side = small.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *cols)
    if bounded:
        side = F.broadcast(side)
    return df.join(side, same(keys, "_k"), how).drop(*[f"_k{i}" for i in range(len(keys))])


def heavy_keys(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_ROWS) -> DataFrame:
    """Keys with more than `max_rows` rows and the number of pieces to cut each into."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > max_rows)
    return counts.select(*keys, F.ceil(F.col("_n") / max_rows).cast("int").alias("_pieces"))


def find_heavy(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_ROWS) -> DataFrame | None:
    """The heavy keys, or None when one counting job finds none. NULL keys are left out."""
    hot = checkpointed(heavy_keys(df.select(*keys).dropna(), keys, max_rows))
    return None if hot.isEmpty() else hot


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                left_heavy: DataFrame | None = None, right_heavy: DataFrame | None = None,
                salt_on: Sequence[str] | None = None) -> DataFrame:
    """Inner or left join in which a heavy key is spread over many tasks.

    `left_heavy` and `right_heavy` come from `find_heavy`. Rows of a heavy key get a salt from their
    own content, or from the columns of `salt_on` that they have; the other side is repeated once per salt. A left row whose key is heavy on the
    right has a partner under some salt, so its unmatched repeats are removed.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if left_heavy is None and right_heavy is None:
        return left.join(right, list(keys), how)

    def prepare(df: DataFrame, own: str, other: str, own_salt: str, other_salt: str) -> DataFrame:
        heavy = {"_lp": left_heavy, "_rp": right_heavy}
        content = F.xxhash64(*[c for c in df.columns if salt_on is None or c in (*keys, *salt_on)])
        for name, keyed in heavy.items():
            if keyed is not None:
                df = attach(df, keyed.withColumnRenamed("_pieces", name), keys, [name])
        mine = F.lit(0) if heavy[own] is None else F.coalesce(F.pmod(content, F.col(own)).cast("int"), F.lit(0))
        df = df.withColumn(own_salt, mine)
        if heavy[other] is None:
            return df.withColumn(other_salt, F.lit(0)).drop(own)
        repeats = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
        return df.withColumn(other_salt, F.explode(repeats)).drop(own)

    l = prepare(left, "_lp", "_rp", "_ls", "_rs")
    r = prepare(right, "_rp", "_lp", "_rs", "_ls").drop("_lp").withColumn("_hit", F.lit(True))
    joined = l.join(r, [*keys, "_ls", "_rs"], how)
    if how == "left" and right_heavy is not None:
        joined = joined.filter(F.col("_hit").isNotNull() | F.col("_rp").isNull())
    return joined.drop("_ls", "_rs", "_rp", "_hit")


def routed(df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int,
           plan: Callable[[DataFrame, bool], DataFrame], number: bool = True) -> DataFrame:
    """Run `plan(rows, heavy)` for the light keys and, where there are any, for the heavy keys.

    With `number` the heavy rows carry their position in the key (`_pos`).
    """
    hot = checkpointed(heavy_keys(df, keys, max_rows))
    if hot.isEmpty():
        return plan(df, False).drop(POS)
    marked = attach(df, hot, keys, ["_pieces"])
    light = marked.filter(F.col("_pieces").isNull()).drop("_pieces")
    heavy = marked.filter(F.col("_pieces").isNotNull()).drop("_pieces")
    if number:
        heavy = numbered(heavy, keys, order, max_rows)
    return plan(light, False).drop(POS).unionByName(plan(heavy, True).drop(POS))


def _axis(df: DataFrame, name: str) -> Column:
    if df.schema[name].dataType.typeName().startswith("timestamp"):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double")


def cut_ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                max_rows: int) -> tuple[DataFrame, list[str]]:
    """Cut each key into cells that are contiguous in `order`; returns the cell columns.

    Every round looks at the groups that are still heavy and lays an even grid over the first order
    column that varies inside the group. A burst in time is refined by the next round; rows of one
    instant are cut by the next order column. Rounds go on until no group is heavy or its rows are equal
    in all order columns; a round cuts every group it looks at, so they end. Only counts and ranges decide, so a lost and
    recomputed partition gets the same cells.
    """
    cells: list[str] = []
    while True:
        groups = [*keys, *cells]
        name = f"_c{len(cells)}"
        rows = df.select(*groups, *[_axis(df, c).alias(f"_a{j}") for j, c in enumerate(order)])
        ranges = [f(f"_a{j}").alias(f"_{n}{j}")
                  for j in range(len(order)) for n, f in (("lo", F.min), ("hi", F.max))]
        stats = rows.groupBy(*groups).agg(F.count("*").alias("_n"), *ranges)
        stats = stats.filter(F.col("_n") > max_rows)
        which = F.coalesce(*[F.when(F.col(f"_lo{j}") < F.col(f"_hi{j}"), F.lit(j))
                             for j in range(len(order))])
        low = F.coalesce(*[F.when(which == j, F.col(f"_lo{j}")) for j in range(len(order))])
        high = F.coalesce(*[F.when(which == j, F.col(f"_hi{j}")) for j in range(len(order))])
        width = (high - low) / F.ceil(F.col("_n") * 4 / max_rows)
        grid = checkpointed(
            stats.filter(which.isNotNull()).select(
                *groups, which.alias("_which"), low.alias("_low"), width.alias("_width")))
        if grid.isEmpty():
            break
        df = attach(df, grid, groups, ["_which", "_low", "_width"])
        value = F.coalesce(*[F.when(F.col("_which") == j, _axis(df, c)) for j, c in enumerate(order)])
        cell = F.floor((value - F.col("_low")) / F.col("_width"))
        df = df.withColumn(name, F.coalesce(cell, F.lit(0))).drop("_which", "_low", "_width")
        cells.append(name)
    return df, cells


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int) -> DataFrame:
    """Position (from 0) of each row inside its key, without sorting a heavy key in one task."""
    df, cells = cut_ordered(df, keys, order, max_rows)
    groups = [*keys, *cells]
    counts = df.groupBy(*groups).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy(*cells).rowsBetween(Window.unboundedPreceding, -1)
    starts = checkpointed(
        counts.select(*groups, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    local = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    df = attach(df.withColumn("_rn", local), starts, groups, ["_start"], bounded=False)
    return df.withColumn(POS, F.col("_start") + F.col("_rn") - 1).drop("_start", "_rn", *cells)


def blocks(df: DataFrame, keys: Sequence[str], before: int, max_rows: int,
           heavy: bool) -> tuple[DataFrame, list[str]]:
    """Split ordered keys into blocks of rows for window functions.

    Returns the frame and the columns to partition windows by. For heavy keys, whose rows are
    numbered, every block also holds the `before` rows that precede it, marked in `_halo`; windows
    may look back that far, and `whole` drops the copies afterwards. Light keys stay one block.
    """
    if not heavy:
        return df, list(keys)
    size = max(max_rows, before + 1)
    home = F.floor(F.col(POS) / size)
    copies = F.when(F.col(POS) % size >= size - before, F.array(home, home + 1)).otherwise(F.array(home))
    df = df.withColumn(BLOCK, F.explode(copies)).withColumn(HALO, F.col(BLOCK) != home)
    return df, [*keys, BLOCK]


def whole(df: DataFrame, heavy: bool) -> DataFrame:
    """Drop the halo copies."""
    return df.filter(~F.col(HALO)).drop(HALO, BLOCK) if heavy else df


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], heavy: bool,
            totals: dict[str, str] | None = None, fills: dict[str, str] | None = None) -> DataFrame:
    """Running totals and last known values from the first row of the key.

    Inside a block it is a window; for heavy keys one row per block carries the state over.
    """
    totals, fills = totals or {}, fills or {}
    part = [*keys, BLOCK] if heavy else list(keys)
    order = [POS] if heavy else list(order)
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)

    def own(c: str) -> Column:
        return F.when(~F.col(HALO), F.col(c)) if heavy else F.col(c)

    out = df.withColumns({
        **{k: F.coalesce(F.sum(own(c)).over(w), F.lit(0)) for k, c in totals.items()},
        **{k: F.last(own(c), ignorenulls=True).over(w) for k, c in fills.items()},
    })
    if not heavy:
        return out
    state = df.filter(~F.col(HALO)).groupBy(*part).agg(
        *[F.sum(c).alias(f"_in_{k}") for k, c in totals.items()],
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(POS))).alias(f"_in_{k}")
          for k, c in fills.items()],
    )
    past = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = checkpointed(state.select(
        *part,
        *[F.sum(f"_in_{k}").over(past).alias(f"_in_{k}") for k in totals],
        *[F.last(f"_in_{k}", ignorenulls=True).over(past).alias(f"_in_{k}") for k in fills],
    ))
    names = [f"_in_{k}" for k in (*totals, *fills)]
    out = attach(out, carry, part, names)
    return out.withColumns({
        **{k: F.col(k) + F.coalesce(F.col(f"_in_{k}"), F.lit(0)) for k in totals},
        **{k: F.coalesce(F.col(k), F.col(f"_in_{k}")) for k in fills},
    }).drop(*names)


def behind(df: DataFrame, keys: Sequence[str], at: str, before: Column, payload: Sequence[str], name: str,
           max_rows: int) -> DataFrame:
    """For each row of heavy keys, `payload` of the first row of the key whose `at` is above `before`.

    `at` is a whole number that no two rows of a key share. Rows and the edges they look for are put into one
    descending order, numbered and cut into blocks; the last row seen before an edge is the one it looks for,
    and one state row per block carries it over. No task gets more than about `max_rows` rows of a key, however
    many of them one range holds.
    """
    kept = [F.col(POS).alias("_own")] if POS in df.columns else []
    own = F.struct(*[c for c in df.columns if c not in (*keys, POS)], *kept)
    rows = df.select(*keys, (-F.col(at)).alias("_at"), F.lit(1).alias("_kind"), F.struct(*payload).alias("_seen"))
    edges = df.select(*keys, (-before).alias("_at"), F.lit(0).alias("_kind"), own.alias("_row"))
    both = numbered(rows.unionByName(edges, allowMissingColumns=True), keys, ["_at", "_kind"], max_rows)
    cut, _ = blocks(both, keys, 1, max_rows, True)
    found = whole(running(cut, keys, [POS], True, fills={name: "_seen"}), True)
    out = found.filter("_kind = 0").select(*keys, "_row.*", name)
    return out.withColumnRenamed("_own", POS) if kept else out
