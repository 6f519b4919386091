"""The statistics that training and serving share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lookup import as_local, settled

#: Cells per group and pass in the search for a median, after the first.
CELLS = 4_096
#: Cells per power of two in the first pass.
POWER_CELLS = 64


def melt(df: DataFrame, columns: list[str], keep: list[str] | None = None, name: str = "feature") -> DataFrame:
    """One row per (row, column) with the value as double."""
    ids = [F.col(c) for c in keep or []]
    wide = df.select(*ids, *(F.col(f"`{c}`").cast("double").alias(c) for c in columns))
    return wide.unpivot(ids, columns, name, "value")


_FIELDS = ["n", "mean", "std", "min", "max"]
_SEARCH = ["_low", "_high", "_below", "median"]


def _number(column: Column) -> Column:
    """The value as double; NaN counts as missing."""
    v = column.cast("double")
    return F.when(~F.isnan(v), v)


def _power_cell(v: Column) -> Column:
    """Cells by sign and power of two, each power in equal parts; they rise with the value."""
    power = F.least(F.greatest(F.log2(F.abs(v)), F.lit(-1075.0)), F.lit(1025.0))
    cell = F.floor((power + 1100) * POWER_CELLS).cast("int")
    return F.when(v == 0, 0).when(v < 0, -cell).otherwise(cell)


def _width_cell(v: Column, low: Column, high: Column) -> Column:
    """Cells of equal width between the ends, which have cells of their own."""
    cell = F.floor(F.nanvl((v - low) / (high - low), F.lit(0.0)) * CELLS)
    inner = F.greatest(F.lit(0), F.least(cell, F.lit(CELLS - 1))).cast("int")
    return F.when(v <= low, -1).when(v >= high, CELLS).otherwise(inner)


def _middle(n: Column) -> dict[str, Column]:
    """The cells of the two middle rows, from rows (_cell, _rows, _least, _most, _upto) of one group."""
    ends = F.col("_upto")
    cell = F.struct("_cell", "_least", "_most", (ends - F.col("_rows")).alias("_before"))
    return {
        "_one": F.min(F.when(ends > F.floor((n - 1) / 2), cell)),
        "_two": F.min(F.when(ends > F.floor(n / 2), cell)),
    }


def _next_search() -> list[Column]:
    """The bounds for the next pass, and the median where it is known.

    It is known where the two middle rows part at the end of a cell, or where a cell holds one value.
    """
    parted = F.col("_one._cell") != F.col("_two._cell")
    single = F.col("_one._least") == F.col("_one._most")
    median = F.when(parted, (F.col("_one._most") + F.col("_two._least")) / 2).when(single, F.col("_one._least"))
    return [
        F.col("_one._least").alias("_low"),
        F.col("_one._most").alias("_high"),
        F.col("_one._before").alias("_below"),
        median.alias("median"),
    ]


def _first_pass(values: DataFrame, keys: list[str], population: bool) -> DataFrame:
    """All statistics, and where the median lies, from counts and moments by cell."""
    cells = values.groupBy(*keys, _power_cell(F.col("_v")).alias("_cell")).agg(
        F.count("_v").alias("_rows"),
        F.sum("_v").alias("_sum"),
        F.var_pop("_v").alias("_var"),
        F.min("_v").alias("_least"),
        F.max("_v").alias("_most"),
    )
    group = Window.partitionBy(*keys)
    n, mean = F.sum("_rows").over(group), F.sum("_sum").over(group) / F.nullif(F.sum("_rows").over(group), F.lit(0))
    upto = F.sum("_rows").over(group.orderBy("_cell"))
    placed = cells.select("*", n.alias("n"), mean.alias("mean"), upto.alias("_upto"))
    # The spread is taken cell by cell about the mean, so values of any size keep their digits.
    off = F.col("_sum") / F.nullif(F.col("_rows"), F.lit(0)) - F.col("mean")
    squares = F.sum(F.col("_rows") * (F.col("_var") + off * off))
    free = F.col("n") if population else F.nullif(F.col("n") - 1, F.lit(0))
    found = placed.groupBy(*keys, "n", "mean").agg(
        squares.alias("_squares"),
        F.min("_least").alias("min"),
        F.max("_most").alias("max"),
        *(c.alias(name) for name, c in _middle(F.col("n")).items()),
    )
    std = F.sqrt(F.col("_squares") / free)
    return found.select(*keys, "n", "mean", std.alias("std"), "min", "max", *_next_search())


def _attach(rows: DataFrame, keys: list[str], state: DataFrame) -> DataFrame:
    """The rows with the columns of their group's state; rows of other groups go."""
    renamed = state.withColumnsRenamed({k: f"_{k}" for k in keys})
    if keys:
        return rows.join(renamed, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]).drop(*(f"_{k}" for k in keys))
    only = state.first()
    return rows.withColumns({f: F.lit(only[f]).cast(kind) for f, kind in state.dtypes})


def _narrowed(values: DataFrame, keys: list[str], searched: DataFrame) -> DataFrame:
    """A later pass: counts by cell between the bounds of each group."""
    low, high = F.col("_low"), F.col("_high")
    inside = _attach(values, keys, searched).where(F.col("_v").between(low, high))
    counts = inside.groupBy(*keys, _width_cell(F.col("_v"), low, high).alias("_cell")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_least"), F.max("_v").alias("_most")
    )
    upto = F.sum("_rows").over(Window.partitionBy(*keys).orderBy("_cell"))
    placed = _attach(counts.withColumn("_upto", upto), keys, searched)
    placed = placed.withColumn("_upto", F.col("_upto") + F.col("_below"))
    found = placed.groupBy(*keys, "n").agg(*(c.alias(name) for name, c in _middle(F.col("n")).items()))
    return found.select(*keys, "n", *_next_search())


def describe_values(
    long: DataFrame, keys: list[str], value: str = "value", population: bool = False
) -> DataFrame:
    """n, mean, std, min, max and the exact median of `value` for each of few keys.

    Spark's exact median keeps every distinct value of a group in one buffer, and a sketch good enough
    to bracket it is merged in one task, so neither is used. One pass over the data counts the values
    of each group in cells by power of two (64 each), with their moments: that gives all statistics
    and the cell that holds the middle rows. Later passes count between the least and the largest
    value of that cell, in 4,096 cells of equal width, until the middle is one value or lies between
    two cells: one or two passes as a rule, five at most, and only groups that need it take part. All
    passes aggregate before they shuffle. `std` is the sample form unless `population` is set. Nulls
    and NaN are ignored.
    """
    values = long.select(*keys, _number(F.col(value)).alias("_v"))
    known = settled(_first_pass(values, keys, population))
    open_ = (F.col("n") > 0) & F.col("median").isNull()
    searched, medians = known.where(open_).select(*keys, "n", *_SEARCH[:3]), []
    while searched.limit(1).count():
        found = settled(_narrowed(values, keys, searched))
        medians.append(found.where("median is not null").select(*keys, "median"))
        searched = found.where("median is null").select(*keys, "n", *_SEARCH[:3])
    known = known.select(*keys, *_FIELDS, "median")
    if not medians:
        return known
    if not keys:
        return known.withColumn("median", F.lit(medians[-1].first()["median"]))
    later = medians[0]
    for more in medians[1:]:
        later = later.union(more)
    later = later.withColumnsRenamed({k: f"_{k}" for k in keys} | {"median": "_later"})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    median = F.coalesce("median", "_later").alias("median")
    return known.join(later, same, "left").select(*keys, *_FIELDS, median)


def feature_stats(df: DataFrame, columns: list[str], population: bool = False) -> DataFrame:
    """One row per column: mean, std, min, max, median."""
    return describe_values(melt(df, columns), ["feature"], population=population)


def describe_counts(
    df: DataFrame, keys: list[str], columns: list[str], population: bool = False
) -> DataFrame:
    """The same statistics for whole numbers with few distinct values (lengths, counts, pixels).

    Values are counted first, so what is shuffled is one row per distinct value, and all
    statistics, the median included, come from those counts in a single scan. With a column
    of another type than a whole number, all go the way of `describe_values`, as doubles.
    """
    types = dict(df.select(*(F.col(c) for c in columns)).dtypes)
    if any(types[c] not in ("tinyint", "smallint", "int", "bigint") for c in columns):
        return describe_values(melt(df, columns, keys, "metric"), [*keys, "metric"], population=population)
    shaped = df.select(*keys, *(F.col(c).cast("bigint").alias(c) for c in columns))
    long = shaped.unpivot([F.col(k) for k in keys], columns, "metric", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy(*keys, "metric", "value").agg(F.count(F.lit(1)).alias("rows"))
    exact = "decimal(38,0)"
    value, rows = F.col("value").cast("decimal(19,0)"), F.col("rows").cast("decimal(18,0)")
    total = F.sum((value * rows).cast(exact))
    # The spread is taken about the mean, so values of any size keep their digits.
    group = Window.partitionBy(*keys, "metric")
    mean = F.sum((value * rows).cast(exact)).over(group).cast("double") / F.sum("rows").over(group)
    off = F.col("value").cast("double") - F.col("_mean")
    n = F.sum("rows")
    sums = counts.withColumn("_mean", mean).groupBy(*keys, "metric").agg(
        n.alias("n"),
        total.alias("total"),
        F.sum(off * off * F.col("rows")).alias("squares"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.percentile("value", F.lit(0.5), F.col("rows")).alias("median"),
    )
    nd, td, spread = (F.col(c).cast("double") for c in ("n", "total", "squares"))
    std = F.sqrt(spread / nd) if population else F.when(F.col("n") > 1, F.sqrt(spread / (nd - 1)))
    return sums.select(
        *keys,
        "metric",
        "n",
        (td / nd).alias("mean"),
        std.alias("std"),
        "min",
        "max",
        "median",
    )


def value_counts(df: DataFrame, *columns: str, by: str = "key") -> DataFrame:
    """Rows per value, in key order or with the most frequent first (ties in key order)."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    order = list(columns) if by == "key" else [F.desc("n"), *columns]
    return counts.orderBy(*order)


def dense_histogram(df: DataFrame, code: str, classes: DataFrame, class_code: str, class_name: str) -> DataFrame:
    """Rows per class with a zero for classes that do not occur."""
    counts = df.groupBy(F.col(code).alias("_code")).agg(F.count(F.lit(1)).alias("_n"))
    joined = classes.join(counts, F.col(class_code) == F.col("_code"), "left")
    return joined.select(class_code, class_name, F.coalesce("_n", F.lit(0)).alias("n"))


def schema_profile(df: DataFrame, numeric_range: list[str] | None = None) -> DataFrame:
    """One row per column: place, name, type and, for the named columns, min and max."""
    ranged = numeric_range or []
    bounds = [F.min(F.col(f"`{c}`")).cast("double").alias(f"lo{i}") for i, c in enumerate(ranged)]
    bounds += [F.max(F.col(f"`{c}`")).cast("double").alias(f"hi{i}") for i, c in enumerate(ranged)]
    one = df.agg(F.count(F.lit(1)).alias("num_samples"), *bounds)
    rows = []
    for place, field in enumerate(df.schema.fields):
        i = ranged.index(field.name) if field.name in ranged else None
        rows.append(
            F.struct(
                F.lit(place).alias("place"),
                F.lit(field.name).alias("name"),
                F.lit(field.dataType.simpleString()).alias("dtype"),
                (F.col(f"lo{i}") if i is not None else F.lit(None).cast("double")).alias("range_min"),
                (F.col(f"hi{i}") if i is not None else F.lit(None).cast("double")).alias("range_max"),
                F.col("num_samples").alias("num_samples"),
                F.lit(len(df.columns)).alias("num_columns"),
            )
        )
    return one.select(F.inline(F.array(*rows)))


def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, mean, std) in one aggregate: all that `standardize` needs."""
    numbers = {c: _number(F.col(f"`{c}`")) for c in columns}
    parts = (
        F.struct(F.lit(c).alias("feature"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"))
        for c, v in numbers.items()
    )
    return df.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))


def standardize(df: DataFrame, columns: list[str], stats: DataFrame) -> DataFrame:
    """(x - mean) / std with saved statistics (one row per feature).

    The statistics of the named columns come in as constants; the data is only projected.
    """
    rows = stats.where(F.col("feature").isin(columns)).select("feature", "mean", "std")
    known = {row["feature"]: row for row in as_local(rows, len(columns)).collect()}
    scaled = {}
    for c in columns:
        mean, std = (F.lit(known[c][f]).cast("double") for f in ("mean", "std"))
        scaled[c] = (F.col(f"`{c}`").cast("double") - mean) / F.nullif(std, F.lit(0.0))
    return df.withColumns(scaled)


def scale_elements(array: str | Column, divisor: float) -> Column:
    """Divides every element of an array by a constant."""
    column = F.col(array) if isinstance(array, str) else array
    return F.transform(column, lambda x: x.cast("double") / F.lit(float(divisor)))


def array_stats(df: DataFrame, array: Column, keys: list[str]) -> DataFrame:
    """Statistics over all elements of all arrays; the population form of std."""
    # The outer form: the plain one would have the array worked out twice.
    elements = df.select(*keys, F.explode_outer(array).alias("value"))
    return describe_values(elements, keys, population=True)


def tensor_shape(df: DataFrame, array: str) -> DataFrame:
    """Row count and the smallest and largest size; equal sizes mean one shape."""
    size = F.size(array)
    return df.agg(
        F.count(F.lit(1)).alias("num_samples"),
        F.min(size).alias("min_size"),
        F.max(size).alias("max_size"),
    ).withColumn("uniform", F.col("min_size") == F.col("max_size"))


def corpus_stats(df: DataFrame, text: str, keys: list[str] | None = None) -> DataFrame:
    """Files, bytes, characters and lines: totals and averages; zeros for no files."""
    from ..functions import text as T

    body = F.col(text)
    sums = df.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("total_files"),
        F.coalesce(F.sum(T.byte_count(body).cast("bigint")), F.lit(0)).alias("total_size_bytes"),
        F.coalesce(F.sum(T.char_count(body).cast("bigint")), F.lit(0)).alias("total_characters"),
        F.coalesce(F.sum(T.line_count(body).cast("bigint")), F.lit(0)).alias("total_lines"),
    )

    def average(total: str) -> Column:
        return F.coalesce(F.round(F.col(total) / F.nullif(F.col("total_files"), F.lit(0)), 2), F.lit(0.0))

    return sums.select(
        *(keys or []),
        "total_files",
        "total_size_bytes",
        average("total_size_bytes").alias("average_size_bytes"),
        "total_characters",
        average("total_characters").alias("average_characters"),
        "total_lines",
        average("total_lines").alias("average_lines"),
    )
