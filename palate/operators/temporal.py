"""Joins and windows along time in which no key, however hot, meets in one task.

Time is whole seconds. Rows are reduced to one per key and second (or day), and time is cut into blocks, so a window
holds one key within one block: at most ``BLOCK`` rows by construction, whatever the data. What one block needs of the
ones before is carried over in a second window, which sees one or two rows per key and block. Where it is known that no
key has more rows than a task sorts anyway, rows are dealt by key once instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palate.functions.expressions import after, epoch
from palate.operators.silver import per_genre
from palate.settings import SECONDS_PER_DAY
from palate.sources.scratch import stage

#: Seconds of a block: about twelve days.
BLOCK = 1 << 20
#: Rows that a task sorts at once, some hundred bytes each.
ROWS_OF_A_TASK = 250_000


def _tasks_for(rows: DataFrame) -> int:
    """How many tasks a table is dealt to: one per core at least, more as it grows."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_OF_A_TASK))


def tasks_by_key(rows: DataFrame, key: str = "userId") -> int | None:
    """To how many tasks ``rows`` are dealt by a key, none if one task could not hold all rows of some key."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    if (counts["most"] or 0) > ROWS_OF_A_TASK:
        return None
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-(counts["n"] or 0) // (ROWS_OF_A_TASK // 2)))


def _block(seconds: str) -> Column:
    return F.floor(F.col(seconds) / F.lit(BLOCK)).cast("long")


def asof_join(
    events: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    valid_from: str,
    columns: Sequence[str],
    strict: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """``events`` with ``columns`` of the latest of ``versions`` of equal ``keys`` not after (``strict``: before) ``at``.

    Events without such a version, or with a null in a key or time, get nulls. Of versions of one key and second the
    greatest ``columns`` count. Lookups are made once per key and second and joined back. ``tasks`` is given where the
    rows of a key are few enough for one task (:func:`tasks_by_key`): events then meet versions without a join.
    """
    keys, columns = list(keys), list(columns)
    known = [F.col(c).isNotNull() for c in keys]
    value = F.struct(F.col(valid_from).alias("__from"), *columns)

    def usable(df: DataFrame, time: str) -> DataFrame:
        for condition in [*known, F.col(time).isNotNull()]:
            df = df.where(condition)
        return df

    if tasks:
        return _asof_by_key(events, usable(versions, valid_from), value, keys, at, valid_from, columns, strict, tasks)
    asked = usable(events, at).select(*keys, F.col(at).alias("__at")).distinct().withColumn("__block", _block("__at"))
    asked = stage(asked, "asof-asked")
    facts = usable(versions, valid_from).groupBy(*keys, F.col(valid_from).alias("__at")).agg(F.max(value).alias("__value"))
    facts = stage(facts.withColumn("__block", _block("__at")), "asof-facts")
    # The last version of every block, seen from the blocks after it.
    ends = facts.groupBy(*keys, "__block").agg(F.max("__value").alias("__last"))
    blocks = (
        ends.unionByName(asked.select(*keys, "__block").distinct().withColumn("__asked", F.lit(True)), allowMissingColumns=True)
        .groupBy(*keys, "__block")
        .agg(F.max("__last").alias("__last"), F.max("__asked").alias("__asked"))
    )
    earlier = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocks.withColumn("__value", F.last("__last", ignorenulls=True).over(earlier))
        .where(F.col("__asked") & F.col("__value").isNotNull())
        .select(*keys, "__block", (F.col("__block") * BLOCK).alias("__at"), "__value", F.lit(0).alias("__kind"))
    )
    marks = (
        carried.unionByName(facts.withColumn("__kind", F.lit(3 if strict else 1)))
        .unionByName(asked.withColumn("__kind", F.lit(2)), allowMissingColumns=True)
    )
    upto = Window.partitionBy(*keys, "__block").orderBy("__at", "__kind")
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        marks.withColumn("__found", F.last("__value", ignorenulls=True).over(upto))
        .where((F.col("__kind") == 2) & F.col("__found").isNotNull())
        .select(*[F.col(k).alias(f"__{k}") for k in keys], "__at", "__found")
    )
    # Staged, so that adaptive execution may split the rows of a hot key and second.
    found = stage(found, "asof-found")
    meets = F.col(at) == F.col("__at")
    for key in keys:
        meets = meets & (F.col(key) == F.col(f"__{key}"))
    joined = events.join(found, meets, "left")
    return joined.select(*events.columns, *[F.col("__found")[c].alias(c) for c in columns])


def _asof_by_key(events, versions, value: Column, keys, at: str, valid_from: str, columns, strict: bool, tasks: int) -> DataFrame:
    """Both sides are dealt by ``keys`` once, versions not at all where they come so, and meet in one window per key."""
    rest = [c for c in events.columns if c not in (*keys, at)]
    facts = versions.repartition(tasks, *keys).select(
        *keys, F.col(valid_from).alias("__at"), F.lit(3 if strict else 1).alias("__kind"), value.alias("__value")
    )
    asked = events.repartition(tasks, *keys).select(
        *keys, F.col(at).alias("__at"), F.lit(2).alias("__kind"), F.struct(F.lit(True), *rest).alias("__event")
    )
    # Of versions of one second the greatest comes last.
    upto = Window.partitionBy(*keys).orderBy("__at", "__kind", "__value")
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        facts.unionByName(asked, allowMissingColumns=True)
        .withColumn("__found", F.last("__value", ignorenulls=True).over(upto))
        .where(F.col("__kind") == 2)
    )
    own = {k: F.col(k) for k in keys} | {at: F.col("__at").cast(events.schema[at].dataType).alias(at)}
    own |= {c: F.col("__event")[c].alias(c) for c in rest}
    return found.select(*[own[c] for c in events.columns], *[F.col("__found")[c].alias(c) for c in columns])


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    step: int = 4,
    tasks: int | None = None,
) -> DataFrame:
    """Pairs of points and intervals of equal ``keys`` with ``start <= at < end``; an interval without end goes on.

    An interval is listed in the one or two blocks it meets on the level of blocks that are as long as it is; points
    are listed once per level that occurs, of which there are at most ``64 / step``. So neither side multiplies with
    the length of intervals, and an equi-join on key, level and block finds all pairs. Nulls in keys, ``at`` or
    ``start`` meet nothing. ``tasks`` is given where the rows of a key are few enough for one task
    (:func:`tasks_by_key`): both sides are then dealt by ``keys`` before they are listed, so levels are not moved.
    """
    keys = list(keys)
    last = points.agg(F.max(at)).first()[0]
    if last is None:
        return points.limit(0).join(intervals.limit(0), keys)
    until = F.coalesce(F.col(end), F.lit(last + 1))
    length = F.col("__until") - F.col(start)
    # A double may round the logarithm of a long length down; the next level is always long enough.
    too_short = F.expr("shiftleft(1L, __level)") < length
    ends = [F.expr(f"shiftright({time}, __level)") for time in (f"`{start}`", "__until - 1")]

    def listed_in_blocks(intervals: DataFrame) -> DataFrame:
        return (
            intervals.where(F.col(start).isNotNull() & (until > F.col(start)))
            .withColumn("__until", until)
            .withColumn("__level", (F.ceil(F.log2(length.cast("double")) / step) * step).cast("int"))
            .withColumn("__level", F.col("__level") + F.when(too_short, step).otherwise(0))
            .withColumn("__block", F.explode(F.array_distinct(F.array(*ends))))
        )

    listed = listed_in_blocks(intervals)
    levels = sorted(row[0] for row in listed.select("__level").distinct().collect())
    if tasks:
        points = points.where(F.col(at).isNotNull()).repartition(tasks, *keys)
        intervals = listed_in_blocks(intervals.repartition(tasks, *keys))
    places = F.array(*[F.struct(F.lit(n).alias("__level"), F.shiftright(at, n).alias("__block")) for n in levels])
    probing = points.select("*", F.inline(places)) if levels else points.limit(0).select(
        "*", F.lit(0).alias("__level"), F.lit(0).cast("long").alias("__block")
    )
    cell = [*keys, "__level", "__block"]
    joined = _joined_in_place(probing, intervals, keys, cell) if tasks else probing.join(listed, cell)
    inside = (F.col(at) >= F.col(start)) & (F.col(at) < F.col("__until"))
    return joined.where(inside).drop("__level", "__block", "__until")


def _joined_in_place(points: DataFrame, intervals: DataFrame, keys: Sequence[str], cell: Sequence[str]) -> DataFrame:
    """The inner join by ``cell`` of two sides dealt by ``keys`` alone: a join would move them again, a window does not."""
    for key in keys:
        points, intervals = points.where(F.col(key).isNotNull()), intervals.where(F.col(key).isNotNull())
    point, interval = ([c for c in df.columns if c not in cell] for df in (points, intervals))
    both = points.select(*cell, F.struct(*point).alias("__point")).unionByName(
        intervals.select(*cell, F.struct(*interval).alias("__interval")), allowMissingColumns=True
    )
    met = F.collect_list("__interval").over(Window.partitionBy(*cell))
    found = both.withColumn("__met", met).where(F.col("__point").isNotNull() & (F.size("__met") > 0))
    return found.select(*cell, "__point", F.inline("__met")).select(*cell, "__point.*", *interval)


def feature_history(ratings: DataFrame, exploded: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """``userId, genre, watched, mean_rating, last_rated, valid_from, valid_until`` of what was known each day.

    A version holds all ratings up to the end of a day with a rating and is valid from the next midnight until the next
    version. Running sums go over days of a user and genre, not over ratings. With ``tasks`` (:func:`tasks_by_key`) ratings
    are dealt by user and genre once; without, sums per day are moved twice.
    """
    rated = per_genre(ratings, exploded).select("userId", "genre", "rating", epoch().alias("seconds"))
    if tasks:
        rated = rated.repartition(tasks, "userId", "genre")
    daily = (
        rated.groupBy("userId", "genre", F.floor(F.col("seconds") / SECONDS_PER_DAY).alias("day"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("total"), F.max("seconds").alias("last"))
    )
    days = Window.partitionBy("userId", "genre").orderBy("day")
    upto = days.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    valid_from = ((F.col("day") + 1) * SECONDS_PER_DAY).cast("long")
    return daily.select(
        "userId",
        "genre",
        F.sum("n").over(upto).alias("watched"),
        (F.sum("total").over(upto) / F.sum("n").over(upto)).alias("mean_rating"),
        F.col("last").alias("last_rated"),
        valid_from.alias("valid_from"),
        F.lead(valid_from).over(days).alias("valid_until"),
    )


def training_set_asof(ratings: DataFrame, exploded: DataFrame | None, boundary: int) -> DataFrame:
    """Every rating after ``boundary`` per genre, with its user's features of that genre as known the midnight before."""
    labelled = (
        per_genre(ratings.where(after(boundary)), exploded)
        .withColumn("rated_at", epoch())
        .select("userId", "movieId", "genre", F.col("rating").alias("label"), "rated_at")
    )
    tasks = tasks_by_key(ratings)
    history = feature_history(ratings, exploded, tasks)
    found = ["watched", "mean_rating", "last_rated"]
    return asof_join(labelled, history, ["userId", "genre"], "rated_at", "valid_from", found, tasks=tasks)


def moving_means(ratings: DataFrame, days: int = 30) -> DataFrame:
    """Per user and day with ratings: how many, the longest wait for one of them, and count and mean of ``days`` days.

    ``longest_gap`` is in seconds since the rating before, of the same day or the last one with any, null for the first.
    Ratings are counted first, which costs nothing where they come from parquet, and dealt to as many tasks as keep the
    memory of one from growing with the table. A day of a user has at most as many rows as there are movies.
    """
    tasks = _tasks_for(ratings)
    at = epoch()
    dealt = ratings.select("userId", "rating", at.alias("seconds"), F.floor(at / SECONDS_PER_DAY).alias("day"))
    seconds = (
        dealt.repartition(tasks, "userId", "day")
        .groupBy("userId", "day", "seconds")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("total"))
    )
    within = Window.partitionBy("userId", "day").orderBy("seconds")
    daily = (
        seconds.withColumn("gap", F.col("seconds") - F.lag("seconds").over(within))
        # Of several ratings in a second all but the first waited no time.
        .groupBy("userId", "day")
        .agg(
            F.sum("n").alias("n"),
            F.sum("total").alias("total"),
            F.max("gap").alias("gap"),
            F.max(F.when(F.col("n") > 1, 0)).alias("repeated"),
            F.min("seconds").alias("first"),
            F.max("seconds").alias("last"),
        )
        .repartition(tasks, "userId")
    )
    by_day = Window.partitionBy("userId").orderBy("day")
    frame = by_day.rangeBetween(1 - days, 0)
    since_before = F.col("first") - F.lag("last").over(by_day)
    return daily.select(
        "userId",
        "day",
        F.col("n").alias("ratings"),
        F.greatest("gap", "repeated", since_before).alias("longest_gap"),
        F.sum("n").over(frame).alias("ratings_in_window"),
        (F.sum("total").over(frame) / F.sum("n").over(frame)).alias("mean_in_window"),
    )


def sessions(events: DataFrame, key: str, at: str, gap: int) -> DataFrame:
    """``key, started, ended, events`` of runs of events no more than ``gap`` seconds apart.

    Sessions are found within blocks first; only the first and the last of a block can go on beyond it, so just these
    are put together across blocks. Rows without key or time belong to no session.
    """
    usable = events.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    marks = usable.groupBy(F.col(key).alias("key"), F.col(at).alias("at")).agg(F.count(F.lit(1)).alias("n"))
    marks = marks.withColumn("block", _block("at"))

    def numbered(df: DataFrame, window, start: str, end: str) -> DataFrame:
        """``number``: how many gaps come before a row."""
        opens = (F.col(start) - F.lag(end).over(window) > gap).cast("int")
        upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn("opens", F.coalesce(opens, F.lit(0))).withColumn("number", F.sum("opens").over(upto))

    def summed(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
        return df.groupBy(*keys, "number").agg(
            F.min(start).alias("started"), F.max(end).alias("ended"), F.sum("n").alias("n")
        )

    inside = summed(
        numbered(marks, Window.partitionBy("key", "block").orderBy("at"), "at", "at"), ["key", "block"], "at", "at"
    )
    of_block = Window.partitionBy("key", "block")
    parts = stage(inside.withColumn("last_number", F.max("number").over(of_block)), "session-parts")
    at_edge = (F.col("number") == 0) | (F.col("number") == F.col("last_number"))
    edges = parts.where(at_edge).drop("number", "last_number", "block")
    joined = summed(numbered(edges, Window.partitionBy("key").orderBy("started"), "started", "ended"), ["key"], "started", "ended")
    whole = parts.where(~at_edge).select("key", "started", "ended", "n")
    return whole.unionByName(joined.select("key", "started", "ended", "n")).select(
        F.col("key").alias(key), "started", "ended", F.col("n").alias("events")
    )
