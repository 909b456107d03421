"""Order-dependent results without one task per key.

A plain window over ``keys`` puts every row of a key into one task. Here rows are first put in
order by range partitioning and written to the shared folder, each with the number of its part.
Ranks and running values are computed inside (keys, part), and what earlier parts contribute comes
from a small table: only a key that lies in several parts has rows there, at most two a part.

The result does not depend on the size of the table. Keys and order columns may have any sortable
type and may be null (nulls first, unless the order says otherwise); rows that are equal in them
follow each other in any order and are spread over parts like others.
"""

from pyspark.sql import Window, functions as F

from ..session import settle

PART, TIE = "_part", "_tie"
_COMBINE = {
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
    "sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
}


def one_column(order):
    """Order columns as a single comparable value; a lone column stays as it is."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def in_parts(df, keys, order):
    """``df`` in the shared folder, cut along keys and order; adds ``_part`` and ``_tie``."""
    tied = df.withColumn(TIE, F.monotonically_increasing_id())
    spread = tied.repartitionByRange(*keys, *order, TIE)
    return settle(spread.withColumn(PART, F.spark_partition_id()))


def _inside(keys, order):
    return Window.partitionBy(*keys, PART).orderBy(*order, TIE)


def _carried(placed, keys, aggregates, use):
    """``use`` of the earlier (or later) parts, for keys that lie in more than one part.

    ``aggregates`` are taken per (keys, part); ``use`` maps a window over the parts of a key to
    columns. The result has at most two rows a part, whatever the data.
    """
    sizes = placed.groupBy(*keys, PART).agg(*aggregates)
    key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    parts = F.count(F.lit(1)).over(key).alias("_parts")
    several = sizes.select("*", parts).filter("_parts > 1")
    return several.select(*keys, PART, *use(key.orderBy(PART)))


def _with_carried(placed, carried, keys):
    """Joined on the keys, nulls included, and the part."""
    names = [f"_k{i}" for i in range(len(keys))]
    small = F.broadcast(carried.withColumnsRenamed({**dict(zip(keys, names)), PART: "_p"}))
    on = F.col(PART) == F.col("_p")
    for key, name in zip(keys, names):
        on = on & F.col(key).eqNullSafe(F.col(name))
    return placed.join(small, on, "left").drop("_p", *names)


def row_numbers(df, keys, order, name="row_number"):
    """1-based position of every row within ``keys`` along ``order``."""
    one = {"_n": ("sum", F.lit(1), False)}
    return running(df, keys, order, one).withColumnRenamed("_n", name)


def running(df, keys, order, columns):
    """Running aggregates within ``keys`` along ``order``, all in one pass.

    ``columns`` maps a new name to (``min`` | ``max`` | ``sum``, value column, before); with
    ``before`` true the current row is left out.
    """
    return running_in_parts(in_parts(df, keys, order), keys, order, columns).drop(PART, TIE)


def running_in_parts(placed, keys, order, columns):
    """The same over rows of :func:`in_parts`, which keep their part and tie."""
    valued = placed.withColumns({f"_v_{n}": value for n, (_, value, _) in columns.items()})

    def earlier(parts):
        frame = parts.rowsBetween(Window.unboundedPreceding, -1)
        return [
            _COMBINE[kind][0](f"_t_{n}").over(frame).alias(f"_c_{n}")
            for n, (kind, _, _) in columns.items()
        ]

    totals = [_COMBINE[kind][0](f"_v_{n}").alias(f"_t_{n}") for n, (kind, _, _) in columns.items()]
    carried = _carried(valued, keys, totals, earlier)
    local = {
        f"_l_{n}": _COMBINE[kind][0](f"_v_{n}").over(
            _inside(keys, order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
        )
        for n, (kind, _, before) in columns.items()
    }
    combined = {
        n: _COMBINE[kind][1](F.col(f"_l_{n}"), F.col(f"_c_{n}"))
        for n, (kind, _, _) in columns.items()
    }
    joined = _with_carried(valued.withColumns(local), carried, keys).withColumns(combined)
    kept = [c for c in placed.columns if c not in columns]
    return joined.select(*kept, *columns)


def next_value(df, keys, order, value, name):
    """``value`` of the following row of the same key; null on the last row."""
    placed = in_parts(df.withColumn("_value", value), keys, order)
    inside = _inside(keys, order)
    ranked = placed.withColumns(
        {
            "_first": F.row_number().over(inside) == 1,
            "_last": F.lead(F.lit(1)).over(inside).isNull(),
            "_local": F.lead("_value").over(inside),
        }
    )
    first = F.max_by("_value", "_first").alias("_value")
    carried = _carried(
        ranked, keys, [first], lambda parts: [F.lead("_value").over(parts).alias("_following")]
    )
    following = F.when(F.col("_last"), F.col("_following")).otherwise(F.col("_local"))
    return (
        _with_carried(ranked, carried, keys)
        .withColumn(name, following)
        .drop("_first", "_last", "_local", "_following", "_value", PART, TIE)
    )


def rows_between(df, order, first, n):
    """Rows number ``first`` .. ``first + n - 1`` (from 0) of the whole frame.

    Only parts that hold wanted rows are ranked.
    """
    placed = in_parts(df, [], order)
    sizes = placed.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    held = sizes.select("*", before).filter(
        (F.col("_before") < first + n) & (F.col("_before") + F.col("_n") > first)
    )
    position = F.col("_before") + F.row_number().over(_inside([], order)) - 1
    return (
        placed.join(F.broadcast(held), PART)  # a row for each part at most
        .withColumn("_position", position)
        .filter(F.col("_position").between(first, first + n - 1))
        .drop("_position", "_before", "_n", PART, TIE)
    )


def exact_percentiles(df, keys, values, probabilities, count=None):
    """Exact, linearly interpolated percentiles of several columns, one row per key.

    ``values`` maps a prefix to a numeric column; results are named like ``<prefix>50``. Nulls
    are left out, NaN is above every number. ``count`` names a column with how often a row counts.

    Equal values are counted first; a running sum over the counted values finds the wanted ranks.
    """
    numbered = list(values.items())
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("_col"), F.col(c).cast("double").alias("_v"))
            for i, (_, c) in enumerate(numbered)
        ]
    )
    on = [*keys, "_col"]
    times = F.lit(1) if count is None else F.col(count)
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    counts = (
        df.filter(present)
        .select(*keys, times.alias("_n"), F.inline(entries))
        .filter("_v is not null")
        .groupBy(*on, "_v")
        .agg(F.sum("_n").alias("_n"))
    )
    placed = in_parts(counts, on, ["_v"])
    ended = running_in_parts(placed, on, ["_v"], {"_end": ("sum", F.col("_n"), False)})
    totals = placed.groupBy(*on).agg(F.sum("_n").alias("_total"))
    positions = [(F.col("_total") - 1) * p for p in probabilities]
    ranks = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), edge(pos).alias("rank"))
            for i, pos in enumerate(positions)
            for side, edge in (("lo", F.floor), ("hi", F.ceil))
        ]
    )
    end = F.col("_end")
    wanted = F.filter(ranks, lambda t: (t["rank"] >= end - F.col("_n")) & (t["rank"] < end))
    found = ended.join(totals, on).withColumn("_hit", F.explode(wanted))

    def result(column, i, p):
        mine = F.col("_col") == column

        def at(side):
            hit = mine & (F.col("_hit.i") == i) & (F.col("_hit.side") == side)
            return F.max(F.when(hit, F.col("_v")))

        position = (F.max(F.when(mine, F.col("_total"))) - 1) * p
        share = position - F.floor(position)
        # Between equal ends nothing is weighed, so infinities stay what they are.
        between = at("lo") * (1 - share) + at("hi") * share
        return F.when((share == 0) | at("lo").eqNullSafe(at("hi")), at("lo")).otherwise(between)

    return found.groupBy(*keys).agg(
        *[
            result(column, i, p).alias(f"{prefix}{p * 100:g}")
            for column, (prefix, _) in enumerate(numbered)
            for i, p in enumerate(probabilities)
        ]
    )
