"""Ordered computations per key that never put a whole key into one task.

``Window.partitionBy(symbol)`` sends every row of a symbol to one task, and one symbol may hold a
third of all rows. The helpers here cut each key into pieces, compute inside the pieces, and carry
the few rows a piece needs from its neighbours. Results equal those of the unbounded window, also
where a key or a time is NULL.

Rows are read and moved once: what the pieces say about themselves (their last values, their number of
rows) is aggregated on the same exchange that the windows inside the pieces need.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.functions.time import order_in_bucket, time_bucket, width_us

TICK_BLOCK = "10 minutes"
BAR_BLOCK = "1 day"
CHUNK_ROWS = 50_000

INDEX = "_row"
TOTAL = "_rows"
CHUNK = "_chunk"
HALO = "_halo"
_BLOCK = "_block"
_PIECE = "_piece"


def _cut(df: DataFrame, keys: list[str], by: Column) -> DataFrame:
    """Rows dealt by (keys, block), with ``by`` as the block. One number stands for a piece, so that a join on it needs no
    further exchange and a NULL in a key is a value like any other."""
    return df.withColumn(_BLOCK, by).withColumn(_PIECE, F.xxhash64(*keys, _BLOCK)).repartition(_PIECE)


def _pieces(df: DataFrame, keys: list[str], order: list[str], block: str) -> DataFrame:
    return _cut(df, keys, time_bucket(order[0], block))


def _inside(keys: list[str], *order: str):
    return Window.partitionBy(_PIECE, *keys, _BLOCK).orderBy(*order)


def _per_piece(pieces: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    """One row per piece. Counting the other columns keeps them on this side of the plan as on the side of the rows,
    so that Spark sees one exchange and reuses it instead of reading the input again."""
    alike = F.expr(f"count({', '.join(f'`{c}`' for c in pieces.columns)})").alias("_alike")
    return pieces.groupBy(_PIECE, *keys, _BLOCK).agg(*aggs, alike).filter("_alike >= 0").drop("_alike")


def _with_piece(rows: DataFrame, per_piece: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the other columns of ``per_piece``.

    Only the number is a join key, as the rows lie by it. That the piece is the same one is checked on the pair: structs
    compare NULL as equal to NULL, and an equality of the parts would become a join key and cost an exchange.
    """
    parts = [*keys, _BLOCK]
    other = per_piece.withColumnsRenamed({c: f"_of_{c}" for c in [*parts, _PIECE]})
    mine, its = F.struct(*parts), F.struct(*[F.col(f"_of_{c}").alias(c) for c in parts])
    same = (F.col(_PIECE) == F.col(f"_of_{_PIECE}")) & (mine <= its) & (mine >= its)
    return rows.join(other, same, "left").drop(*[f"_of_{c}" for c in [*parts, _PIECE]])


def _order_key(df: DataFrame, order: list[str], block: str) -> Column:
    """What orders the rows of a piece: a primitive for a time, or a time and a whole number, else a struct.

    ``max_by`` over a primitive runs in a hash aggregate; over a struct it sorts.
    """
    ts = F.timestamp_micros(F.coalesce(F.unix_micros(order[0]), F.lit(0)))
    if len(order) == 1:
        return F.unix_micros(ts)
    if len(order) == 2 and isinstance(df.schema[order[1]].dataType, T.IntegralType) and width_us(block) < 10**12:
        return order_in_bucket(ts, order[1], block)
    return F.struct(*order)


def fit_block(df: DataFrame, keys: list[str], ts: str, limit: int = 5_000_000,
              widths: tuple[str, ...] = ("1 day", "1 hour", "10 minutes", "1 minute", "1 second", "1 millisecond")) -> str:
    """The widest block whose fullest (key, block) has at most ``limit`` rows, else the narrowest.

    For data with bursts: pass the result as ``block``. Runs one aggregation of counts, each width
    built on the next narrower one, and brings back one number per width.
    """
    fullest, counts = [], None
    for width in reversed(widths):
        block = time_bucket(ts if counts is None else _BLOCK, width).alias(_BLOCK)
        rows = F.count(F.lit(1)) if counts is None else F.sum("_n")
        counts = (df if counts is None else counts).groupBy(*keys, block).agg(rows.alias("_n"))
        fullest.append(counts.agg(F.max("_n").alias("_n")).select(F.lit(width).alias("width"), "_n"))
    sizes = {r.width: r["_n"] or 0 for r in reduce(DataFrame.unionByName, fullest).collect()}
    return next((w for w in widths if sizes[w] <= limit), widths[-1])


def whole_row_hash(columns: list[str]) -> Column:
    """A number from 0 up to 2**64 that depends on every column: a fixed order of rows that are equal otherwise."""
    return F.xxhash64(*columns).cast("decimal(20,0)") + F.expr("9223372036854775808BD")


def pick_row(df: DataFrame, keys: list[str], rank: Column, last: bool = True) -> DataFrame:
    """The row of each group with the highest (or lowest) ``rank``, a primitive; a NULL rank loses to all others.

    Columns of fixed width are picked one by one, which a hash aggregate can do before and after the exchange: all
    picks compare the same ranks in the same order, so they come from one row. Texts and arrays need the
    row as a struct, which sorts.
    """
    rest = [c for c in df.columns if c not in keys]
    by = F.max_by if last else F.min_by
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if all(isinstance(df.schema[c].dataType, fixed) for c in rest):
        return df.groupBy(*keys).agg(*[by(c, rank).alias(c) for c in rest]).select(*df.columns)
    picked = df.groupBy(*keys).agg(by(F.struct(*rest), rank).alias("_row_"))
    return picked.select(*[F.col("_row_")[c].alias(c) if c in rest else F.col(c) for c in df.columns])


def with_previous(df: DataFrame, keys: list[str], order: list[str], values: list[str],
                  block: str = TICK_BLOCK, prefix: str = "prev_") -> DataFrame:
    """Add the previous row's ``values`` per key, NULL on the first row of a key.

    Rows are cut into time blocks of ``order[0]``. Inside a block it is a plain lag; the first row of a block
    takes the last values of the latest earlier block. One exchange of the rows by (key, block), read by the lag and by
    a hash aggregate of the last values, plus one row per block. Select the columns you need before, not after: a
    later selection gives the two readers different columns.
    """
    pieces = _pieces(df, keys, order, block)
    at = _order_key(df, order, block)
    tails = _per_piece(pieces, keys, *[F.max_by(v, at).alias(f"_tail_{v}") for v in values])
    earlier = Window.partitionBy(*keys).orderBy(_BLOCK)
    carry = tails.select(_PIECE, *keys, _BLOCK, F.lag(F.struct(*[F.col(f"_tail_{v}").alias(v) for v in values])).over(earlier).alias("_carry"))
    lagged = pieces.withColumn("_prev", F.lag(F.struct(*values)).over(_inside(keys, *order)))
    prev = F.coalesce("_prev", "_carry")
    return _with_piece(lagged, carry, keys).select(*df.columns, *[prev[v].alias(prefix + v) for v in values])


def with_row_index(df: DataFrame, keys: list[str], order: list[str], block: str = BAR_BLOCK,
                   counted: dict[str, Column] | None = None) -> DataFrame:
    """Add the 1-based position of each row within its key and the key's row count.

    ``counted`` adds, for each name, the number of rows so far on which its condition holds, the row included.
    """
    counted = {name: F.coalesce(c, F.lit(False)).cast("long") for name, c in (counted or {}).items()}
    pieces = _pieces(df, keys, order, block)
    sums = {"_n": F.count(F.lit(1)), **{f"_n_{name}": F.sum(c) for name, c in counted.items()}}
    per_key = Window.partitionBy(*keys)
    earlier = per_key.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = _per_piece(pieces, keys, *[c.alias(n) for n, c in sums.items()]).select(
        _PIECE, *keys, _BLOCK, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_before{n}") for n in sums],
        F.sum("_n").over(per_key).alias(TOTAL))
    inside = _inside(keys, *order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = pieces.withColumns({"_at": F.row_number().over(inside), **{f"_at_{n}": F.sum(c).over(so_far) for n, c in counted.items()}})
    return _with_piece(numbered, offsets, keys).select(
        *df.columns, (F.col("_before_n") + F.col("_at")).alias(INDEX), TOTAL,
        *[(F.col(f"_before_n_{n}") + F.col(f"_at_{n}")).alias(n) for n in counted])


def row_chunks(df: DataFrame, keys: list[str], order: list[str], before: int = 0, after: int = 0,
               rows: int | None = None, block: str = BAR_BLOCK, counted: dict[str, Column] | None = None) -> DataFrame:
    """Cut each key into chunks of equally many rows, each with copies of its neighbours' rows.

    A chunk holds its own rows, the ``before`` rows ahead of it and the ``after`` rows behind it
    (marked by ``_halo``). A row frame of that reach computed over :func:`chunk_window` is exact on
    the chunk's own rows; finish with :func:`own_rows`.
    """
    return chunks_by(with_row_index(df, keys, order, block, counted), INDEX, before, after, rows)


def chunks_by(indexed: DataFrame, index: str, before: int = 0, after: int = 0, rows: int | None = None,
              where: Column | None = None) -> DataFrame:
    """Chunks of equally many rows by a column that numbers the rows on which ``where`` holds.

    The other rows are dealt by their own number into chunks below 0: a window over a chunk never sees both kinds.
    """
    size = max(rows or CHUNK_ROWS, before, after)
    at = F.col(index) - 1
    home = F.floor(at / size)
    pos = F.pmod(at, F.lit(size))
    places = [home]
    if before:
        places.append(F.when(pos >= size - before, home + 1))
    if after:
        places.append(F.when(pos < after, home - 1))
    chunk = F.array_compact(F.array(*places))
    if where is not None:
        aside = -F.floor((F.col(INDEX) - 1) / size) - 1
        held = F.coalesce(where, F.lit(False))
        home, chunk = F.when(held, home).otherwise(aside), F.when(held, chunk).otherwise(F.array(aside))
    return indexed.withColumn(CHUNK, F.explode(chunk)).withColumn(HALO, F.col(CHUNK) != home)


def chunk_window(keys: list[str], start: int | None = None, end: int | None = None):
    spec = Window.partitionBy(*keys, CHUNK).orderBy(INDEX)
    return spec if start is None else spec.rowsBetween(start, end)


def own_rows(df: DataFrame, keep_index: bool = False) -> DataFrame:
    kept = df.filter(~F.col(HALO)).drop(CHUNK, HALO)
    return kept if keep_index else kept.drop(INDEX, TOTAL)


def time_halo(df: DataFrame, ts: str, reach: str, block: str) -> DataFrame:
    """Cut rows into time blocks, copying rows within ``reach`` of the next block into it.

    For trailing time ranges: a range frame of ``reach`` over (key, ``_chunk``) is exact on the
    rows that are not ``_halo``. Blocks are at least as long as the reach.
    """
    span = max(width_us(block), width_us(reach))
    us = F.unix_micros(F.col(ts))
    home = F.floor(us / span)
    places = F.array_compact(F.array(home, F.when(F.pmod(us, F.lit(span)) >= span - width_us(reach), home + 1)))
    return df.withColumn(CHUNK, F.explode(places)).withColumn(HALO, F.col(CHUNK) != home)


def fill_forward(df: DataFrame, keys: list[str], order: list[str], values: list[str],
                 block: str = BAR_BLOCK) -> DataFrame:
    """Replace NULLs by the latest earlier non-NULL value of the key (NULL if there is none)."""
    pieces = _pieces(df, keys, order, block)
    at = _order_key(df, order, block)
    tails = _per_piece(pieces, keys, *[F.max_by(v, F.when(F.col(v).isNotNull(), at)).alias(f"_tail_{v}") for v in values])
    earlier = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select(_PIECE, *keys, _BLOCK, *[
        F.last(f"_tail_{v}", ignorenulls=True).over(earlier).alias(f"_carry_{v}") for v in values])
    inside = _inside(keys, *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = pieces.select("*", *[F.last(v, ignorenulls=True).over(inside).alias(f"_local_{v}") for v in values])
    return _with_piece(local, carry, keys).select(*[
        F.coalesce(f"_local_{c}", f"_carry_{c}").alias(c) if c in values else F.col(c) for c in df.columns])


def value_ranks(df: DataFrame, keys: list[str], value: str, bin_width: int, with_null: bool = False,
                also: dict[str, Column] | None = None) -> DataFrame:
    """Distinct integer values per key with the ranks they cover: value, ``lo``, ``hi``, ``n`` and the key's ``least``.

    Rows are counted per (key, value) before anything moves. Ranks are cumulated over bins of ``bin_width`` values,
    so a window partition holds at most ``bin_width`` rows, and over the bins of a key, whose number is bounded by the
    value range. Both read one exchange of the counts. ``with_null`` keeps a row of NULL, without ranks, for
    keys that have such rows. ``also`` names further aggregates of the rows of a (key, value), so that other statistics
    of the key need no second reading.
    """
    also = also or {}
    there = F.col(value).isNotNull()
    counts = (df if with_null else df.filter(there)).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("_c"), *[a.alias(name) for name, a in also.items()])
    counts = _cut(counts, keys, F.floor(F.col(value) / bin_width))
    per_key = Window.partitionBy(*keys)
    before = F.sum("_b").over(per_key.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1))
    bins = _per_piece(counts, keys, F.sum(F.when(there, F.col("_c"))).alias("_b"), F.min(value).alias("_low")).select(
        _PIECE, *keys, _BLOCK, F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_b").over(per_key).alias("n"),
        F.min("_low").over(per_key).alias("least"))
    inside = _inside(keys, value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.when(there, F.col("_before") + F.col("_cum") - 1)
    return _with_piece(counts.withColumn("_cum", F.sum("_c").over(inside)), bins, keys).select(
        *keys, value, "n", (last - F.col("_c") + 1).alias("lo"), last.alias("hi"), "least", *also)


def ranked_quantile(value: str, p: float) -> Column:
    """The interpolated quantile as an aggregate of a key's rows from :func:`value_ranks`."""
    at = F.lit(p) * (F.col("n") - 1)
    below, above = F.floor(at), F.ceil(at)
    covers = lambda rank: (F.col("lo") <= rank) & (F.col("hi") >= rank)
    low, high = F.max(F.when(covers(below), F.col(value))), F.max(F.when(covers(above), F.col(value)))
    return low + (high - low) * F.max(at - below)


def quantile_cont(df: DataFrame, keys: list[str], value: str, p: float, name: str,
                  bin_width: int = 65_536) -> DataFrame:
    """Exact interpolated quantile of an integer column per key."""
    return value_ranks(df, keys, value, bin_width).groupBy(*keys).agg(ranked_quantile(value, p).alias(name))


def disc_rank(p: float) -> Column:
    """0-based rank of the discrete quantile among ``n`` rows."""
    return F.greatest(F.ceil(F.lit(p) * F.col("n")) - 1, F.lit(0))


def quantile_disc(df: DataFrame, keys: list[str], value: str, p: float, name: str,
                  bin_width: int = 65_536) -> DataFrame:
    """Exact discrete quantile: the first value whose cumulative share reaches ``p``."""
    rank = disc_rank(p)
    return (
        value_ranks(df, keys, value, bin_width)
        .filter((F.col("lo") <= rank) & (F.col("hi") >= rank))
        .select(*keys, F.col(value).alias(name))
    )
