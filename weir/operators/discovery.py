"""Enumerating a population behind a capped search: ranges are halved until each fits the cap."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.stage import staged

CAP, MAX_STARS, EPOCH = 1_000, 1_000_000, date(2011, 1, 1)
# The searches that together cover sources and writeups.
QUERIES = [
    "topic:ctf", "topic:ctf-challenges", "topic:ctf-writeups", "topic:ctf-writeup", "topic:writeup",
    "ctf writeup in:name,description", "ctf challenges in:name,description", '"ctf" in:name',
]


def star_leaves(query: str, count: Callable[[str], int], low: int = 0, high: int = MAX_STARS, cap: int = CAP) -> Iterator[tuple[str, int, bool]]:
    """(query, count, whole) of ranges of stars; one value over the cap can't be halved and is not whole."""
    if low > high:
        return
    q = f"{query} stars:{low}..{high}"
    n = count(q)
    if not n:
        return
    if n <= cap or low == high:
        yield q, n, n <= cap
        return
    middle = (low + high) // 2
    yield from star_leaves(query, count, low, middle, cap)
    yield from star_leaves(query, count, middle + 1, high, cap)


def date_leaves(query: str, count: Callable[[str], int], low: date = EPOCH, high: date | None = None, cap: int = CAP) -> Iterator[tuple[str, int, bool]]:
    """(query, count, whole) of ranges of creation days; a day over the cap is cut by stars."""
    high = high or date.today()
    if low > high:
        return
    q = f"{query} created:{low.isoformat()}..{high.isoformat()}"
    n = count(q)
    if not n:
        return
    if n <= cap:
        yield q, n, True
    elif low == high:
        yield from star_leaves(q, count, cap=cap)
    else:
        middle = low + (high - low) // 2
        yield from date_leaves(query, count, low, middle, cap)
        yield from date_leaves(query, count, middle + timedelta(days=1), high, cap)


def plan(queries: list[str], count: Callable[[str], int], by: str = "created", low: date = EPOCH, high: date | None = None, cap: int = CAP) -> list[tuple[str, int, bool]]:
    """The leaves of all queries, which a reader takes as its partitions. `count` asks how many results a query has."""
    return [leaf for q in queries for leaf in (star_leaves(q, count, cap=cap) if by == "stars" else date_leaves(q, count, low, high, cap))]


def halved(counts: DataFrame, value: str, low: Column, high: Column, levels: int, cap: int = CAP, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, low, high, n, whole): the leaves that halving finds over a table of counts `n` by whole numbers `value` from low to high,
    for each group `by`: ranges of up to `cap` whose parent has more, and single values over it, which are not whole.

    Every value tells the ranges around it, `levels` of them at most, from the whole one down; one aggregation counts all
    ranges, and each is held against its parent. Counts are combined before the shuffle, so that the whole range is one row
    for each task, and no range is asked for from the driver. Values that are null or out of range are left out.
    """
    by, v = list(by), F.col(value).cast("long")
    inside = counts.where(v.between(low, high)).groupBy(*by, v.alias("__v")).agg(F.sum("n").cast("long").alias("__n")).withColumns({"__low": low.cast("long"), "__high": high.cast("long")})
    none = F.lit(None).cast("long")
    whole = F.struct(F.col("__low").alias("low"), F.col("__high").alias("high"), none.alias("above_low"), none.alias("above_high"))

    def below(ranges: Column, _: Column) -> Column:
        last = F.element_at(ranges, -1)
        middle = F.floor((last["low"] + last["high"]) / 2).cast("long")
        left = F.col("__v") <= middle
        half = F.struct(F.when(left, last["low"]).otherwise(middle + 1).alias("low"), F.when(left, middle).otherwise(last["high"]).alias("high"), last["low"].alias("above_low"), last["high"].alias("above_high"))
        return F.when(last["low"] == last["high"], ranges).otherwise(F.array_append(ranges, half))

    around = F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.array(whole), below)
    sums = inside.select(*by, "__n", F.inline(around)).groupBy(*by, "low", "high", "above_low", "above_high").agg(F.sum("__n").alias("n")).where("n > 0")
    sums = staged(sums, "ranges-of-counts")
    above = sums.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("low").alias("__low"), F.col("high").alias("__high"), F.col("n").alias("__above"))
    same = (F.col("above_low") == F.col("__low")) & (F.col("above_high") == F.col("__high"))
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    fits, single = F.col("n") <= cap, F.col("low") == F.col("high")
    held = sums.where(fits | single).join(above, same, "left").where(F.col("above_low").isNull() | (F.col("__above") > cap))
    return held.select(*by, "low", "high", "n", fits.alias("whole"))


#: Halvings that take any calendar, and any number of stars, down to a single value.
DAY_LEVELS = 24


def day_leaves(counts: DataFrame, cap: int = CAP) -> DataFrame:
    """(low, high, n, whole) of leaves over a table (day, n) of counts, between its first and last day; a day over the cap can't be
    halved and is not whole."""
    days = counts.select(F.unix_date("day").alias("day"), "n")
    low, high = days.agg(F.min("day")).scalar(), days.agg(F.max("day")).scalar()
    made = halved(days, "day", low, high, DAY_LEVELS, cap)
    return made.select(F.date_from_unix_date(F.col("low").cast("int")).alias("low"), F.date_from_unix_date(F.col("high").cast("int")).alias("high"), "n", "whole")


def star_table(counts: DataFrame, cap: int = CAP, high: int = MAX_STARS, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, low, high, n, whole) of leaves over a table (stars, n), found by halving 0 to `high`; one value over the cap is not
    whole."""
    return halved(counts, "stars", F.lit(0), F.lit(high), max(1, high.bit_length()), cap, by)


def sharded(counts: DataFrame, cap: int = CAP, high: int = MAX_STARS) -> DataFrame:
    """(low, high, low_stars, high_stars, n, whole) over a table (day, stars, n): ranges of days that fit, and each day over the cap by
    ranges of stars; what neither can halve is not whole. Days that fit have no range of stars."""
    counts = staged(counts.groupBy("day", "stars").agg(F.sum("n").alias("n")), "counts")
    days = staged(day_leaves(counts, cap), "day-leaves")
    over = counts.join(days.where("not whole").select(F.col("low").alias("day")), "day", "left_semi")
    stars = star_table(over, cap, high, ("day",)).select(F.col("day").alias("low"), F.col("day").alias("high"), F.col("low").alias("low_stars"), F.col("high").alias("high_stars"), "n", "whole")
    none = F.lit(None).cast("long")
    return days.where("whole").select("low", "high", none.alias("low_stars"), none.alias("high_stars"), "n", "whole").unionByName(stars)


def seed_names(seeds: DataFrame) -> DataFrame:
    """(low): the names of seeds in lower case, each once."""
    return seeds.select(F.lower("repo").alias("low")).where("low is not null").distinct()


def union_found(found: DataFrame, seeds: DataFrame, max_repos: int | None = None) -> DataFrame:
    """One candidate for each repository of `found` (with query_pos and pos), none that a seed names. The first one counts,
    but a later one with a known kind replaces it. max_repos: the first so many by order of first sight."""
    rows = found.withColumn("low", F.lower("full_name")).join(seed_names(seeds), "low", "left_anti").drop("low")
    order = F.struct((F.col("kind") == "unknown").alias("u"), "query_pos", "pos")
    one = rows.groupBy("full_name").agg(F.min_by(F.struct(*[c for c in rows.columns]), order).alias("x"), F.min(F.struct("query_pos", "pos")).alias("first"))
    out = one.select("x.*", "first")
    if max_repos is not None:
        out = out.orderBy("first").limit(max_repos)
    return out.drop("first", "query_pos", "pos")


def first_seen(df: DataFrame, key: str, pos: str) -> DataFrame:
    """The first row of each key in the order of pos."""
    over = Window.partitionBy(key).orderBy(pos)
    return df.withColumn("__n", F.row_number().over(over)).where("__n = 1").drop("__n")
