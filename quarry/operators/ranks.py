"""Exact ranks, quantiles and previous values over a whole table.

Rows are dealt to partitions by ranges of the order and sorted there, so the
place of a row is the number of rows in the partitions before plus its place
inside. Only the row count (and last value) of each partition is gathered; no
window runs without a partition, and no aggregate holds a column's values. A
hash of the row ends the order, so a value that many rows share is dealt to
several partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import written

#: monotonically_increasing_id() has the partition above these bits, the place below.
PLACE_BITS = 33


def _dealt(df: DataFrame, order: list) -> DataFrame:
    """The rows in order with ``__at`` (partition and place). Written as a table:
    ranges are drawn from a sample, and a second run might draw others."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    order += [F.xxhash64(*df.columns)]
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(rows.withColumn("__at", F.monotonically_increasing_id()))


def _part() -> Column:
    return F.shiftright("__at", PLACE_BITS)


def _by_part(frame: DataFrame, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Joins what is known of each partition: one row a partition."""
    known = frame.sparkSession.createDataFrame(rows, schema)
    return frame.withColumn("__part", _part()).join(F.broadcast(known), "__part")


def with_rank(df: DataFrame, *order, name: str = "rank") -> DataFrame:
    """Adds the place of every row in the order, from 0. Nulls go where the
    order puts them; rows that the order leaves equal are ranked by a hash."""
    frame = _dealt(df, list(order))
    sizes = sorted(tuple(r) for r in frame.groupBy(_part().alias("p")).agg(F.count(F.lit(1))).collect())
    before, rows = 0, []
    for p, n in sizes:
        rows.append((p, before))
        before += n
    out = _by_part(frame, rows, T.StructType([T.StructField("__part", T.LongType()), T.StructField("__before", T.LongType())]))
    place = F.col("__at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return out.select(*df.columns, (F.col("__before") + place).alias(name))


def with_previous(df: DataFrame, col: str, *order, name: str) -> DataFrame:
    """Adds the value of ``col`` in the row before; null for the first row."""
    frame = _dealt(df, list(order))
    lasts = sorted((tuple(r) for r in frame.groupBy(_part().alias("p")).agg(F.max_by(col, "__at")).collect()), key=lambda r: r[0])
    rows = [(p, lasts[i - 1][1] if i else None) for i, (p, _) in enumerate(lasts)]
    out = _by_part(frame, rows, T.StructType([T.StructField("__part", T.LongType()), T.StructField("__carried", df.schema[col].dataType)]))
    inside = Window.partitionBy("__part").orderBy("__at")
    value = F.when(F.row_number().over(inside) == 1, F.col("__carried")).otherwise(F.lag(col).over(inside))
    return out.withColumn(name, value).select(*df.columns, name)


def with_last(df: DataFrame, col: str, *order, name: str) -> DataFrame:
    """Adds the last non-null value of ``col`` in this row or before it: an
    as-of match after marks and queries have been put in one order."""
    frame = _dealt(df, list(order))
    lasts = sorted((tuple(r) for r in frame.groupBy(_part().alias("p")).agg(
        F.max_by(col, F.when(F.col(col).isNotNull(), F.col("__at")))).collect()), key=lambda r: r[0])
    rows, carried = [], None
    for p, value in lasts:
        rows.append((p, carried))
        carried = carried if value is None else value
    out = _by_part(frame, rows, T.StructType([T.StructField("__part", T.LongType()), T.StructField("__carried", df.schema[col].dataType)]))
    inside = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumn(name, F.coalesce(F.last(col, ignorenulls=True).over(inside), F.col("__carried"))).select(*df.columns, name)


def order_statistics(df: DataFrame, cols: list[str], shares: list[float], by: str | None = None) -> DataFrame:
    """The two order statistics around each share (0 to 1) of the non-null
    values: rows (``by``), column, share (place in ``shares``), low, high,
    weight (how far the quantile is from low to high: the fraction of share *
    (n - 1)). All columns are ranked in one pass. A column without values (in a
    group) has no rows."""
    keys = [by] if by else []
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    long = df.select(*keys, F.explode(values).alias("__v")).select(*keys, "__v.column", "__v.value").where("value IS NOT NULL")
    ranks = with_rank(long, *keys, "column", "value")
    groups = ranks.groupBy(*keys, "column").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("first"))
    asked = F.array(*[F.struct(F.lit(i).alias("share"), F.lit(float(q)).alias("q")) for i, q in enumerate(shares)])
    asked = (groups.select("*", F.explode(asked).alias("s")).withColumn("at", F.col("s.q") * (F.col("n") - 1))
             .select(*keys, "column", "s.share", (F.col("first") + F.floor("at")).alias("low_at"), (F.col("at") - F.floor("at")).alias("weight")))
    ends = asked.select("*", F.explode(F.expr("array(low_at, low_at + IF(weight > 0, 1, 0))")).alias("rank"))
    if keys:  # a null group is a group
        ends = ends.withColumnRenamed(by, "__by")
    found = ends.join(ranks.select("rank", "value"), "rank")
    out = found.groupBy(*["__by" for _ in keys], "column", "share", "weight").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    return out.select(*[F.col("__by").alias(by) for _ in keys], "column", "share", "low", "high", "weight")


def between(low: Column, high: Column, weight: Column) -> Column:
    """Linear interpolation, from the nearer end."""
    return F.when(weight < 0.5, low + (high - low) * weight).otherwise(high - (high - low) * (1 - weight))


def quantiles(df: DataFrame, cols: list[str], shares: list[float], by: str | None = None) -> DataFrame:
    """(``by``), column and one column ``q0``, ``q1``, .. for each share, by
    linear interpolation between the neighbouring values."""
    s = order_statistics(df, cols, shares, by)
    value = between(F.col("low"), F.col("high"), F.col("weight"))
    return s.groupBy(*([by] if by else []), "column").agg(
        *[F.max(F.when(F.col("share") == i, value)).alias(f"q{i}") for i in range(len(shares))])


def with_sum_before(df: DataFrame, value: str, by: list[str], *order, name: str) -> DataFrame:
    """Adds the sum of ``value`` (whole numbers, no nulls) over the rows before
    in the row's group, 0 for the first. A group may span many partitions: only
    the first group of a partition has rows before it, and its sum so far is
    carried over."""
    frame = _dealt(df, [*by, *order])
    group = F.struct(*by)
    ends = frame.groupBy(_part().alias("__p")).agg(F.min_by(group, "__at").alias("__first"), F.max_by(group, "__at").alias("__last"))
    sums = frame.groupBy(_part().alias("__p"), group.alias("__g")).agg(F.sum(value).alias("__s"))
    rows = sums.join(F.broadcast(ends), "__p").where(F.col("__g").eqNullSafe(F.col("__first")) | F.col("__g").eqNullSafe(F.col("__last"))).collect()
    parts: dict[int, dict] = {}  # two groups a partition at most
    for r in rows:
        parts.setdefault(r["__p"], {"first": r["__first"], "last": r["__last"]})[r["__g"]] = r["__s"]
    open_group, so_far, known = None, 0, []
    for p in sorted(parts):
        first, last = parts[p]["first"], parts[p]["last"]
        carried = so_far if first == open_group else 0
        known.append((p, carried))
        open_group, so_far = last, parts[p][last] + (carried if first == last else 0)
    out = _by_part(frame, known, T.StructType([T.StructField("__part", T.LongType()), T.StructField("__carried", T.LongType())]))
    out = out.join(F.broadcast(ends.withColumnRenamed("__p", "__part")), "__part")
    inside = Window.partitionBy("__part", *by).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    here = F.coalesce(F.sum(value).over(inside), F.lit(0))
    return out.select(*df.columns, (here + F.when(group.eqNullSafe(F.col("__first")), F.col("__carried")).otherwise(0)).alias(name))
