"""Grid cells, tiles and cube axes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.text import township

STEP = 0.125
MOST_STEPS = 5000


def cell_code(x: Column, y: Column) -> Column:
    """LLlllrc: whole degrees of latitude and (west) longitude, then row a-h and column 1-8 of the 0.125 degree cell.

    Rows count from the south edge of the degree, columns from its east edge.
    """
    lat, lon = F.floor(y), F.floor(-x)
    row = F.substring(F.lit("abcdefgh"), (F.floor((y - lat) / STEP) + 1).cast("int"), F.lit(1))
    column = F.floor((-x - lon) / STEP) + 1
    return F.concat(F.lpad(lat.cast("string"), 2, "0"), F.lpad(lon.cast("string"), 3, "0"), row, column.cast("string"))


def cell_bounds(code: Column) -> Column:
    """The box of a cell's code."""
    lat = F.substring(code, 1, 2).cast("double") + (F.ascii(F.substring(code, 6, 1)) - 97) * STEP
    lon = -(F.substring(code, 3, 3).cast("double") + F.substring(code, 7, 1).cast("int") * STEP)
    return F.struct(lon.alias("xmin"), lat.alias("ymin"), (lon + STEP).alias("xmax"), (lat + STEP).alias("ymax"))


def cells_of(df: DataFrame, size: float = STEP) -> DataFrame:
    """`df` once for each cell (cx, cy) that its box touches."""
    across = F.sequence(F.floor(F.col("xmin") / size), F.floor(F.col("xmax") / size))
    up = F.sequence(F.floor(F.col("ymin") / size), F.floor(F.col("ymax") / size))
    return df.withColumn("cx", F.explode(across)).withColumn("cy", F.explode(up))


def tile_x(x: Column, z: Column) -> Column:
    return F.floor((x + 180) / 360 * F.pow(F.lit(2.0), z)).cast("long")


def tile_y(y: Column, z: Column) -> Column:
    rad = F.radians(F.greatest(F.lit(-85.0511287798066), F.least(F.lit(85.0511287798066), y)))
    return F.floor((1 - F.ln(F.tan(rad) + 1 / F.cos(rad)) / F.lit(3.141592653589793)) / 2 * F.pow(F.lit(2.0), z)).cast("long")


def tile_index(df: DataFrame, low: int, high: int) -> DataFrame:
    """(id, z, tx, ty): every tile that a box covers, at every zoom."""
    zoomed = df.withColumn("z", F.explode(F.sequence(F.lit(low), F.lit(high))))
    wide = zoomed.withColumn("tx", F.explode(F.sequence(tile_x(F.col("xmin"), F.col("z")), tile_x(F.col("xmax"), F.col("z")))))
    return wide.withColumn("ty", F.explode(F.sequence(tile_y(F.col("ymax"), F.col("z")), tile_y(F.col("ymin"), F.col("z"))))).select("id", "z", "tx", "ty")


def region_cells(df: DataFrame, box: tuple[float, float, float, float], notch: tuple[float, float, float, float]) -> DataFrame:
    """The cells (cx, cy) of a box that are not wholly within its notch, in order; `df` names no rows, only a session."""
    spark = df.sparkSession
    across, up = (int(box[2] / STEP) - int(box[0] / STEP)), int((box[3] - box[1]) / STEP)
    x, y = F.lit(box[0]) + (F.col("id") % across) * STEP, F.lit(box[1]) + F.floor(F.col("id") / across) * STEP
    cells = spark.range(across * up).select(x.alias("x"), y.alias("y"))
    within = (F.col("x") >= notch[0]) & (F.col("x") + STEP <= notch[2]) & (F.col("y") >= notch[1]) & (F.col("y") + STEP <= notch[3])
    return cells.filter(~within)


def steps(low: Column, high: Column, step: Column) -> Column:
    """An axis from its extent, MOST_STEPS long at most."""
    return F.slice(F.sequence(low, high, step), 1, MOST_STEPS)


def axis_labels(values: Column, low: Column, high: Column, step: Column, months: Column) -> Column:
    """The labels of an axis's steps, from its listed values, or else from its extent and step, all of them text; none where neither tells them.

    Listed dates are labelled by the finest part that ever varies: a year, a month or a day. Steps are P<n>Y, P<n>M or P<n>D over dates, or numbers; where `months` holds, whole numbers from
    1 to 12 are months. An extent of more than MOST_STEPS steps is taken as misread.
    """
    none = F.array().cast("array<string>")
    date = lambda v: F.try_to_timestamp(F.substring(v, 1, 10), F.lit("yyyy-MM-dd")).cast("date")
    shown = lambda d, fine: F.when(fine == "Y", F.date_format(d, "yyyy")).when(fine == "M", F.date_format(d, "MMM yyyy")).otherwise(F.date_format(d, "MMM d, yyyy"))
    dates = F.transform(values, date)
    finest = F.when(F.exists(dates, lambda d: F.dayofmonth(d) != 1), "D").when(F.exists(dates, lambda d: F.month(d) != 1), "M").otherwise("Y")
    whole = lambda v: F.when(v.rlike("^([1-9]|1[0-2])$"), v.try_cast("int"))
    month = lambda v: F.when(months & whole(v).isNotNull(), F.date_format(F.make_date(F.lit(2000), whole(v), F.lit(1)), "MMM")).otherwise(v)
    listed = F.when(F.forall(dates, lambda d: d.isNotNull()), F.transform(dates, lambda d: shown(d, finest))).otherwise(F.transform(values, month))

    n, unit = F.regexp_extract(step, "^P([0-9]{1,4})[YMD]$", 1), F.regexp_extract(step, "^P[0-9]{1,4}([YMD])$", 1)
    count = F.greatest(F.when(n != "", n.cast("int")), F.lit(1))
    span = F.when(unit == "Y", F.year(date(high)) - F.year(date(low))).when(unit == "M", F.months_between(date(high), date(low))).otherwise(F.date_diff(date(high), date(low))) / count
    later = lambda i: F.when(unit == "Y", F.add_months(date(low), i * count * 12)).when(unit == "M", F.add_months(date(low), i * count)).otherwise(F.date_add(date(low), i * count))
    sound = (unit != "") & (date(low) <= date(high)) & (span < MOST_STEPS)
    dated = F.transform(F.filter(F.transform(F.sequence(F.lit(0), F.when(sound, F.floor(span).cast("int")).otherwise(0)), later), lambda d: d <= date(high)), lambda d: shown(d, unit))
    a, b, by = (c.try_cast("long") for c in (low, high, step))
    counted = F.coalesce((by > 0) & (a <= b) & (F.try_divide(b - a, by) < MOST_STEPS), F.lit(False))
    numbers = F.transform(F.sequence(F.when(counted, a).otherwise(0), F.when(counted, b).otherwise(0), F.when(counted, by).otherwise(1)), lambda v: month(v.cast("string")))
    return F.when(F.size(values) > 0, listed).when(F.coalesce(sound, F.lit(False)), dated).when(counted, numbers).otherwise(none)


def selected_step(axis: DataFrame, picked: DataFrame) -> DataFrame:
    """(axis, step): the picked step where the axis has it, else the latest of a dated axis, else the first."""
    return axis.join(picked, "axis", "left").groupBy("axis").agg(
        F.coalesce(F.max(F.when(F.col("step") == F.col("pick"), F.col("step"))), F.when(F.first("dated"), F.max_by("step", "pos")).otherwise(F.min_by("step", "pos"))).alias("step")
    )


#: Bins of a round of `quantiles`, and how many values a round may leave to be sorted.
QUANTILE_BINS, FEW_VALUES = 4096, 100_000


def _at_rank(df: DataFrame, column: str, rank: int, low: float, high: float, n: int) -> float:
    """The value with `rank` values before it: the bin that holds it is cut into bins again until few are left."""
    before, c = 0, F.col(column)
    inside = df.filter(c.between(low, high))
    while n > FEW_VALUES and low < high:
        width = (high - low) / QUANTILE_BINS
        bins = inside.groupBy(F.least(F.floor((c - low) / width), F.lit(QUANTILE_BINS - 1)).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(c).alias("low"), F.max(c).alias("high"))
        for r in sorted(bins.collect(), key=lambda r: r["b"]):  # QUANTILE_BINS rows at most
            if before + r["n"] > rank:
                low, high, n = r["low"], r["high"], r["n"]
                break
            before += r["n"]
        inside = df.filter(c.between(low, high))
    if low == high:
        return low
    return inside.select(c).orderBy(c).offset(rank - before).limit(1).first()[0]


def quantiles(df: DataFrame, column: str, shares: list[float]) -> DataFrame:
    """(q, least, most): exact quantiles, interpolated between neighbours, and the ends, by histograms of a fixed size; nulls and NaN don't count."""
    values = df.filter(F.col(column).isNotNull() & ~F.isnan(column))
    low, high, n = values.agg(F.min(column), F.max(column), F.count(column)).first()
    found = []
    for share in shares:
        place = share * (n - 1) if n else 0.0
        pair = [_at_rank(values, column, int(r), low, high, n) for r in {int(place), min(int(place) + 1, max(n - 1, 0))}] if n else [None]
        pair = sorted(pair) if n else pair
        found.append(pair[0] + (pair[-1] - pair[0]) * (place - int(place)) if n else None)
    return df.sparkSession.createDataFrame([(found, low, high)], "q array<double>, least double, most double")


def display_stretch(df: DataFrame, column: str, low: float, high: float, fill: float | None = None) -> DataFrame:
    """(low, high, least, most): the values that a colour ramp runs between, from two quantiles of what isn't the fill value; never an empty range."""
    values = df if fill is None else df.filter(F.col(column) != fill)
    q = quantiles(values, column, [low, high])
    wide = F.when(F.col("q")[1] > F.col("q")[0], F.col("q")[1]).otherwise(F.col("q")[0] + 1)
    return q.select(F.col("q")[0].alias("low"), wide.alias("high"), "least", "most")


def grid_lookup(asked: DataFrame, text: str, sections: DataFrame) -> DataFrame:
    """(text, meridian, xmin, xmax, ymin, ymax): the township, or its section, that a text names, in each meridian of `sections` (label, snum, meridian, x, y)."""
    wanted = asked.withColumn("w", township(F.col(text))).filter("w is not null").select(text, F.col("w.label").alias("w_label"), F.col("w.section").alias("section"))
    found = sections.join(wanted, (F.col("label") == F.col("w_label")) & (F.col("section").isNull() | (F.col("snum") == F.col("section"))))
    return found.groupBy(text, "meridian").agg(F.min("x").alias("xmin"), F.max("x").alias("xmax"), F.min("y").alias("ymin"), F.max("y").alias("ymax"))
