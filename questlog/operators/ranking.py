"""Global rank, percentile and tiles without a whole-table window.

Everything starts from a histogram of the ranked value, which map-side counting
makes small. Running totals over it are taken
digit by digit (22, 21 and 21 bits of the value), so no window ever holds more
than 2^22 rows whatever the number of distinct values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from questlog.session import materialise

_DIGIT_BITS = 21
_DIGIT_MASK = 2**_DIGIT_BITS - 1
# A run of identical rows is expanded in steps, so no array exceeds this length.
_EXPAND_STEP = 100_000


def _sum_before(n: str, within: list[str], order: list[str]) -> Column:
    in_order = Window.partitionBy(*within).orderBy(
        *[F.col(c).asc_nulls_last() for c in order]
    )
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(n).over(so_far) - F.col(n)


def running_counts(
    histogram: DataFrame,
    value: str,
    n: str,
    within: tuple[str, ...] = (),
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``before``, the sum of ``n`` over all rows ordered ahead, and ``total``.

    Rows are ordered by the bigint ``value`` (NULL last), then by ``ties``,
    separately for each ``within`` group. ``value`` and ``ties`` together are
    unique in a group.
    """
    group = list(within)
    key = F.col(value)
    # One past the greatest leading digit, so that NULL comes last.
    after_all = F.lit(2 ** (_DIGIT_BITS + 1)).cast("bigint")
    middle = F.shiftright(key, _DIGIT_BITS).bitwiseAND(F.lit(_DIGIT_MASK))
    digits = histogram.withColumns(
        {
            "_high": F.coalesce(F.shiftright(key, 2 * _DIGIT_BITS), after_all),
            "_mid": F.coalesce(middle, F.lit(0).cast("bigint")),
        }
    )
    mid = digits.groupBy(*group, "_high", "_mid").agg(F.sum(n).alias("_n"))
    high = mid.groupBy(*group, "_high").agg(F.sum("_n").alias("_n"))

    low = digits.withColumn(
        "_before_low", _sum_before(n, [*group, "_high", "_mid"], [value, *ties])
    )
    mid = mid.withColumn("_before_mid", _sum_before("_n", [*group, "_high"], ["_mid"]))
    high = high.select(
        *group,
        "_high",
        _sum_before("_n", group, ["_high"]).alias("_before_high"),
        F.sum("_n").over(Window.partitionBy(*group)).alias("total"),
    )
    # A window leaves its output placed by fewer columns than the join has, and
    # the join would take that over: place by all of them, or one leading digit
    # or one group could gather most rows in a task.
    high = high.repartition(*group, "_high")
    mid = mid.drop("_n").join(high, [*group, "_high"])
    mid = mid.repartition(*group, "_high", "_mid")
    before = F.col("_before_high") + F.col("_before_mid") + F.col("_before_low")
    return low.join(mid, [*group, "_high", "_mid"]).select(
        *histogram.columns, before.alias("before"), "total"
    )


def value_positions(df: DataFrame, value: str) -> DataFrame:
    """(value, n, before, total): rows equal to a value, rows below it, all rows.

    Written out, so that joining it back broadcasts it if it is small, without
    shuffling the ranked rows by a value that may be on most of them. A large
    one is joined by shuffle, where adaptive execution splits such a value.
    """
    histogram = df.groupBy(value).agg(F.count("*").alias("n"))
    histogram = materialise(histogram, "histogram")
    return materialise(running_counts(histogram, value, "n"), "positions")


def rank_descending() -> Column:
    """RANK by descending value, from the columns of ``value_positions``."""
    return F.col("total") - F.col("before") - F.col("n") + 1


def percentile_rank() -> Column:
    """Average rank of equal values divided by the row count."""
    mean_rank = F.col("before") + (F.col("n") + 1) / F.lit(2.0)
    return mean_rank / F.col("total")


def tile_at(position: str, total: str, tiles: int) -> Column:
    """NTILE of a 0-based position; the first ``total % tiles`` tiles get a row more.

    Of the two quotients - by the larger and by the smaller tile size - the
    greater one is the tile on either side of the change of size.
    """
    larger = f"({position}) div ({total} div {tiles} + 1)"
    smaller = f"({position} - {total} % {tiles}) div greatest({total} div {tiles}, 1L)"
    return F.expr(f"greatest({larger}, {smaller}) + 1")


def _rows_up_to(tile: str, total: str, tiles: int) -> str:
    """Number of rows in the first ``tile`` tiles."""
    return f"(({tile}) * ({total} div {tiles}) + least({tile}, {total} % {tiles}))"


def with_tiles(
    df: DataFrame, value: str, tie: str, tiles: int, single: Column | None = None
) -> DataFrame:
    """Add ``rank`` (descending) and ``tile`` (ascending) of a bigint without NULLs.

    Ties in ``value`` go by ``tie`` (a bigint), then by the other columns. Where
    all rows of a value fall into one tile - all but at most ``tiles - 1``
    values - the value decides. Only rows of a value cut by a tile border are
    ordered further, by digit-wise running counts. ``single``
    marks values whose tile does not matter; their rows are never ordered
    (tile NULL if cut).
    """
    positions = value_positions(df, value).select(
        value,
        "n",
        F.col("before").alias("value_before"),
        "total",
        rank_descending().alias("rank"),
        tile_at("before", "total", tiles).alias("first_tile"),
        tile_at("before + n - 1", "total", tiles).alias("last_tile"),
    )
    cut = F.col("first_tile") != F.col("last_tile")
    ordered = cut & ~single if single is not None else cut
    whole = df.join(positions.where(~ordered), value).select(
        *df.columns, "rank", F.when(~cut, F.col("first_tile")).alias("tile")
    )
    # Each border cuts one value: at most tiles - 1 rows to broadcast.
    rows = df.join(F.broadcast(positions.where(ordered)), value)
    in_order = _tiles_of_cut_values(rows, df.columns, value, tie, tiles)
    return whole.unionByName(in_order.select(*df.columns, "rank", "tile"))


def _tiles_of_cut_values(
    ranked: DataFrame, columns: list[str], value: str, tie: str, tiles: int
) -> DataFrame:
    """Order rows of equal ``value``: identical rows are counted and placed as
    one run, the run is cut at the tile borders, and its rows written out again.
    """
    runs = ranked.groupBy(*columns, "value_before", "total", "rank").agg(
        F.count("*").alias("copies")
    )
    others = tuple(c for c in columns if c not in (value, tie))
    placed = running_counts(
        runs.withColumnRenamed("total", "rows"), tie, "copies", (value,), others
    )
    spans = placed.select(
        *columns,
        "rank",
        "rows",
        (F.col("value_before") + F.col("before")).alias("start"),
        (F.col("value_before") + F.col("before") + F.col("copies")).alias("end"),
    )
    first = tile_at("start", "rows", tiles)
    last = tile_at("end - 1", "rows", tiles)
    pieces = spans.withColumn("tile", F.explode(F.sequence(first, last)))
    tile_end = f"least(end, {_rows_up_to('tile', 'rows', tiles)})"
    tile_start = f"greatest(start, {_rows_up_to('tile - 1', 'rows', tiles)})"
    pieces = pieces.withColumn("last_row", F.expr(f"{tile_end} - {tile_start} - 1"))
    return pieces.withColumn("block", _blocks("last_row")).withColumn(
        "row", _rows_of_block("block", "last_row")
    )


def _blocks(last: str) -> Column:
    return F.explode(F.expr(f"sequence(0L, {last}, {_EXPAND_STEP}L)"))


def _rows_of_block(block: str, last: str) -> Column:
    return F.explode(
        F.expr(f"sequence({block}, least({block} + {_EXPAND_STEP - 1}, {last}))")
    )
