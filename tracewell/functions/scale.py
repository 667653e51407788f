"""Building blocks that keep work spread out when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tracewell.session import new_path, only_kept, short_shuffles, stage

PART_ROWS, MOST_PARTS = 2_000_000, 8   # rows that are worked on at a time, and how often the rows are read at most


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join rows to a table with one row per key; null keys match. Hot keys are left to AQE's skew splitting."""
    extra = [c for c in right.columns if c not in keys]
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    return left.alias("l").join(right.alias("r"), on, how).select(
        *[F.col(f"l.{c}").alias(c) for c in left.columns], *[F.col(f"r.{c}").alias(c) for c in extra])


def in_parts(df: DataFrame, keys: Sequence[str], work: Callable[[DataFrame], DataFrame], rows: int = PART_ROWS, most: int = MOST_PARTS) -> DataFrame:
    """``work(df)``, done for a part of the keys at a time if there are many rows; all rows of a key are in one part.

    ``work`` must treat every key by itself, and ``df`` give the same rows whenever it is read. What a part has staged and shuffled is deleted when its result
    is written, so at most one part of it is on disk at once; tasks share a part as they would share the whole, also one with a hot key.
    """
    count = min(most, -(-df.count() // rows))
    if count < 2:
        return work(df)
    spark = df.sparkSession
    path, number = new_path(spark, "parts"), F.pmod(F.xxhash64(*keys), F.lit(count))
    for k in range(count):
        with only_kept(spark, path), short_shuffles(spark):
            part = work(df.where(number == k))
            part.write.mode("append").parquet(path)
    return spark.read.schema(part.schema).parquet(path)


def ordered_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   slices: int | None = None) -> DataFrame:
    """Cut every key's ordered rows into consecutive slices (``_slice``) of similar size.

    Range partitioning on key and order splits a hot key over many tasks. The numbering is written
    down, so that later passes over the result agree on it.
    """
    spark = df.sparkSession
    count = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(count, *keys, *order).withColumn("_slice", F.spark_partition_id())
    return stage(ranged, "slices")


def slice_prefix(totals: DataFrame, keys: Sequence[str], sums: Sequence[str] = (),
                 lows: Sequence[str] = (), highs: Sequence[str] = ()) -> DataFrame:
    """Turn per-slice totals into what came before each slice (``before_<column>``).

    ``totals`` has one row per key and slice, so a key has at most as many rows as there are slices.
    """
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *keys, "_slice",
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"before_{c}") for c in sums],
        *[F.min(c).over(before).alias(f"before_{c}") for c in lows],
        *[F.max(c).over(before).alias(f"before_{c}") for c in highs],
    )


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "pos",
                  slices: int | None = None) -> DataFrame:
    """Row number of each row within its key, without sorting a whole key in one task."""
    cut = ordered_slices(df, keys, order, slices)
    totals = cut.groupBy(*keys, "_slice").agg(F.count("*").alias("n"))
    prefix = slice_prefix(totals, keys, sums=["n"])
    within = Window.partitionBy(*keys, "_slice").orderBy(*order)
    return (lookup(cut, prefix, [*keys, "_slice"], "inner")
            .withColumn(name, F.col("before_n") + F.row_number().over(within))
            .drop("before_n", "_slice"))


def probability_name(p: float, prefix: str = "p") -> str:
    digits = f"{p:.6f}".split(".")[1].rstrip("0")
    return f"{prefix}{digits.ljust(2, '0')}"


def distribution(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float] = (),
                 width: int = 10_000, sums: dict[str, Column] | None = None,
                 weight: str | None = None) -> DataFrame:
    """Count, min, max, mean, deviation and exact percentiles of an integer column per key.

    The rows are reduced to a histogram before the first shuffle, and the histogram to cells of ``width`` values. A
    key's cells are ranked as a whole, and only the cells holding a wanted rank are opened: no task
    sees more than the cells of a key or the values of a cell. ``sums`` adds further per-key sums of row
    expressions; ``weight`` names a column saying how many rows each row stands for.
    """
    if not keys:
        whole_set = df.withColumn("_all_rows", F.lit(0))
        return distribution(whole_set, ["_all_rows"], value, probs, width, sums, weight).drop("_all_rows")
    given, sums, keys = sums or {}, list(sums or {}), list(keys)
    hist = (df.groupBy(*keys, F.col(value).alias("_v"))
            .agg((F.count("*") if weight is None else F.sum(weight)).alias("_c"),
                 *[F.sum(e).alias(n) for n, e in given.items()]))
    hist = hist.withColumn("_cell", F.floor(F.col("_v") / F.lit(width)).cast("long"))
    offset = F.col("_v") - F.col("_cell") * width
    exact, part = "decimal(38,0)", "decimal(18,0)"
    times = F.col("_c").cast("decimal(19,0)")   # factors are widened first: their product may exceed a long
    cells = hist.groupBy(*keys, "_cell").agg(
        F.sum("_c").alias("_all"),
        F.sum(F.when(F.col("_v").isNotNull(), F.col("_c"))).alias("_n"),
        F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.sum(offset.cast(part) * times).cast(exact).alias("_s"),
        F.sum((offset * offset).cast(part) * times).cast(exact).alias("_q"),
        *[F.sum(n).alias(n) for n in sums],
    )
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    origin = F.col("_cell") * width
    cells = (cells
             .withColumn("_total", F.sum("_n").over(whole))
             .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
             .withColumn("_mean", F.sum(origin.cast("decimal(19,0)") * F.col("_n").cast("decimal(18,0)") + F.col("_s")).over(whole)
                         .cast("double") / F.col("_total")))
    shift = origin - F.col("_mean")
    squares = F.col("_q").cast("double") + 2 * shift * F.col("_s").cast("double") + F.col("_n") * shift * shift
    stats = cells.groupBy(*keys).agg(
        F.sum("_all").alias("rows"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n"),
        F.min("_min").alias("min"), F.max("_max").alias("max"),
        F.max("_mean").alias("mean"),
        F.sqrt(F.greatest(F.sum(squares), F.lit(0.0)) / F.max("_total")).alias("stddev"),
        *[F.sum(n).alias(n) for n in sums],
    )
    if not probs:
        return stats

    def position(p: float, total: Column) -> Column:
        return F.lit(p) * (total - 1)

    ranks = F.array(*[f(position(p, F.col("_total"))).cast("long") for p in probs for f in (F.floor, F.ceil)])
    opened = (cells.where("_n > 0")
              .where(F.exists(ranks, lambda r: (r >= F.col("_start")) & (r < F.col("_start") + F.col("_n"))))
              .select(*keys, "_cell", "_start", "_total"))
    on = [F.col(f"h.{k}").eqNullSafe(F.col(f"o.{k}")) for k in [*keys, "_cell"]]
    values = hist.alias("h").join(opened.alias("o"), on).select(
        *[F.col(f"h.{k}").alias(k) for k in [*keys, "_cell"]], "_v", "_c", "_start", "_total")
    within = Window.partitionBy(*keys, "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    values = values.withColumn("_end", F.col("_start") + F.sum("_c").over(within))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank < F.col("_end")) & (rank >= F.col("_end") - F.col("_c")), F.col("_v")))

    picks = []
    for i, p in enumerate(probs):
        place = position(p, F.col("_total"))
        picks += [at(F.floor(place)).alias(f"_lo{i}"), at(F.ceil(place)).alias(f"_hi{i}")]
    found = values.groupBy(*keys).agg(F.max("_total").alias("_total"), *picks)
    quantiles = found.select(*keys, *[
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}"))
         * (position(p, F.col("_total")) - F.floor(position(p, F.col("_total"))))).alias(probability_name(p))
        for i, p in enumerate(probs)])
    on = [F.col(f"s.{k}").eqNullSafe(F.col(f"q.{k}")) for k in keys]
    return stats.alias("s").join(quantiles.alias("q"), on, "left").select(
        "s.*", *[F.col(f"q.{probability_name(p)}").alias(probability_name(p)) for p in probs])
