"""Rolling medians and median absolute deviations, exact: all windows' values are bisected together.

Clicks are dealt by series and hour. A window reaches one hour back, so an hour's windows need that hour's clicks and the ones
of the hour before. In a task the amounts are ranked; each round of bisection halves the ranks that every window's median may
have, by counting how many of the window's amounts lie in the lower half: prefix counts over all amounts, swept in one
vectorised pass a round, answer that for all windows at once. The rounds' prefix counts stay, so the second bisection, on the
radii around the medians, counts what lies within a radius by the same tables.

An hour of a series with too many clicks for a task is cut at whole seconds into slices, at the same offsets as the hour
before: a window that ends in a slice begins in the same slice of the hour before. Of the slices between the two, whose clicks
are in the window whole, a task needs no more than how often each amount occurs, which Spark sums beforehand. So a task holds
two slices and a histogram, and no slice's windows have to go to one task: a slice with more windows than clicks may be in a
task is dealt to several.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import in_arrow, table, written

HOUR, SECOND = 3_600_000_000, 1_000_000
#: Clicks of an hour and the one before that a task may have at once, and of small hours that it works on together.
MOST, TOGETHER = 250_000, 32_768
#: Amounts beyond this many cents aren't exact as 64-bit floats.
LARGEST = 1 << 53
#: What a row in a task is: a click whose amount counts too, a click, amounts of the slice, of the one an hour before, of those between.
BOTH, ASKS, OWN, BEFORE, BETWEEN = range(5)


class Ranks:
    """Amounts in order of time, for counting and choosing in stretches of it, with a histogram beside them that is in every stretch."""

    def __init__(self, values: np.ndarray, counts: np.ndarray, more: np.ndarray, more_counts: np.ndarray):
        self.values = np.unique(np.concatenate([values, more]))
        ranks = np.searchsorted(self.values, values)
        self.bits = len(self.values).bit_length()
        self.single = bool((counts == 1).all())
        self.between = np.concatenate([[0], np.cumsum(np.bincount(np.searchsorted(self.values, more), more_counts, len(self.values)).astype(np.int64))]) if len(more) else None
        self.lower, self.weights, self.zeros = [], [], []
        for bit in range(self.bits - 1, -1, -1):
            zero = (ranks >> bit) & 1 == 0
            self.lower.append(np.concatenate([[0], np.cumsum(zero)]).astype(np.int32))
            self.zeros.append(int(self.lower[-1][-1]))
            if not self.single:
                self.weights.append(np.concatenate([[0], np.cumsum(np.where(zero, counts, 0))]))
            order = np.concatenate([np.flatnonzero(zero), np.flatnonzero(~zero)])
            ranks, counts = ranks[order], counts[order]

    def _lower(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the stretches lie among the amounts of the lower half, and how many those are."""
        low = self.lower[level]
        la, lb = low[a], low[b]
        if self.single:
            return la, lb, (lb - la).astype(np.int64)
        return la, lb, self.weights[level][b] - self.weights[level][a]

    def choose(self, a: np.ndarray, b: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The amount number k, from 0, of each stretch from a to b: a bisection of all of them, a bit of the rank in a round."""
        rank, k, last = np.zeros(len(a), np.int64), k.copy(), len(self.values)
        for level in range(self.bits):
            half = 1 << (self.bits - 1 - level)
            la, lb, n = self._lower(level, a, b)
            if self.between is not None:
                n = n + self.between[np.minimum(rank + half, last)] - self.between[np.minimum(rank, last)]
            upper = k >= n
            k -= np.where(upper, n, 0)
            rank += np.where(upper, half, 0)
            a, b = np.where(upper, self.zeros[level] + a - la, la), np.where(upper, self.zeros[level] + b - lb, lb)
        return self.values[np.minimum(rank, last - 1)]

    def below(self, a: np.ndarray, b: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """How many amounts of each stretch have a rank below the given one."""
        out = np.zeros(len(a), np.int64) if self.between is None else self.between[rank]
        for level in range(self.bits):
            la, lb, n = self._lower(level, a, b)
            upper = (rank >> (self.bits - 1 - level)) & 1 == 1
            out = out + np.where(upper, n, 0)
            a, b = np.where(upper, self.zeros[level] + a - la, la), np.where(upper, self.zeros[level] + b - lb, lb)
        return out

    def within(self, a: np.ndarray, b: np.ndarray, median2: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many amounts c of each stretch lie below the ball |2c - median2| <= radius, and how many below its end."""
        low = np.searchsorted(self.values, -((radius - median2) // 2), "left")
        high = np.searchsorted(self.values, (median2 + radius) // 2, "right")
        return self.below(a, b, low), self.below(a, b, high)

    def medians(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Doubled medians, and doubled medians of |2c - doubled median|, of stretches with n >= 2 amounts."""
        first, second = (n - 1) // 2, n // 2
        median2 = self.choose(a, b, first) + self.choose(a, b, second)
        # Any first + 1 neighbours in order around the median hold its radius between their ends' distances.
        start = (n - first) // 2
        ends = np.abs(2 * self.choose(a, b, start) - median2), np.abs(2 * self.choose(a, b, start + first) - median2)
        low, high = np.minimum(*ends), np.maximum(*ends)
        while (going := np.flatnonzero(low < high)).size:
            middle = (low[going] + high[going]) // 2
            under, upto = self.within(a[going], b[going], median2[going], middle)
            enough = upto - under > first[going]
            high[going], low[going] = np.where(enough, middle, high[going]), np.where(enough, low[going], middle + 1)
        under, upto = self.within(a, b, median2, low)
        # The next radius is that of the nearest amount outside, unless the ball has it already.
        outer, on = low.copy(), np.flatnonzero(upto - under <= second)
        a, b, n, under, upto, median2_on = a[on], b[on], n[on], under[on], upto[on], median2[on]
        left = np.where(under > 0, np.abs(2 * self.choose(a, b, np.maximum(under - 1, 0)) - median2_on), np.iinfo(np.int64).max)
        right = np.where(upto < n, np.abs(2 * self.choose(a, b, np.minimum(upto, n - 1)) - median2_on), np.iinfo(np.int64).max)
        outer[on] = np.minimum(left, right)
        return median2, low + outer


def answered(group: np.ndarray, role: np.ndarray, since: np.ndarray, cents: np.ndarray, known: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places of the asking rows, and n, median2, mad4 and whether they are far, for rows in order of (group, since).

    `since` are microseconds after the begin of the hour before; a group may have a histogram only if it is alone.
    """
    at = group * (1 << 33) + since
    asks = np.flatnonzero(role <= ASKS)
    element = known & ((role == BOTH) | (role == OWN) | (role == BEFORE))
    between = role == BETWEEN
    times, values, counts = at[element], cents[element], count[element]
    wanted, back = np.unique(at[asks], return_inverse=True)
    a, b = np.searchsorted(times, wanted - HOUR, "left"), np.searchsorted(times, wanted, "right")
    n = np.concatenate([[0], np.cumsum(counts)])
    n = n[b] - n[a] + int(count[between].sum())
    median2, mad4 = np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)
    if (many := np.flatnonzero(n >= 2)).size:
        ranks = Ranks(values, counts, cents[between], count[between])
        median2[many], mad4[many] = ranks.medians(a[many], b[many], n[many])
    n, median2, mad4 = n[back], median2[back], mad4[back]
    return asks, n, median2, mad4, 2 * np.abs(2 * cents[asks] - median2) > 3 * mad4


KEYS = ["series", "hour", "slice", "part"]
RESULT = "click_id {id}, kind string, n long, median2 long, mad4 long, far boolean"


def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results for rows in order of KEYS and time; small groups are worked on together, and no more is held than they and one group."""
    held: list[pa.RecordBatch] = []
    enough = TOGETHER
    for b in batches:
        held.append(b)
        if sum(map(len, held)) >= enough:
            done, rest = whole_groups(pa.Table.from_batches(held), False)
            yield from done
            held, enough = rest.to_batches(), max(TOGETHER, 2 * len(rest))
    if held:
        yield from whole_groups(pa.Table.from_batches(held), True)[0]


def whole_groups(rows: pa.Table, last: bool) -> tuple[list[pa.RecordBatch], pa.Table]:
    """Results of all groups but the last one, which may go on, and that one's rows; of all if these are the last rows."""
    new = np.zeros(len(rows), bool)
    for key in KEYS:
        column = rows[key].combine_chunks()
        numbers = (column.dictionary_encode().indices if key == "series" else column).to_numpy(zero_copy_only=False)
        new[1:] |= numbers[1:] != numbers[:-1]
    starts = np.flatnonzero(np.concatenate([[True], new[1:]])) if len(rows) else np.zeros(0, int)
    end = len(rows) if last else int(starts[-1])
    if not end:
        return [], rows
    group = np.cumsum(new)[:end]
    role = rows["role"].to_numpy()[:end]
    cents, known = rows["cents"].fill_null(0).to_numpy()[:end], rows["cents"].is_valid().to_numpy()[:end]
    since, count = rows["since"].to_numpy()[:end], rows["count"].to_numpy()[:end]
    cuts = [0, end]
    for g in np.unique(group[role == BETWEEN]):
        cuts += np.searchsorted(group, [g, g + 1]).tolist()
    out = []
    for start, stop in zip(s := sorted(set(cuts)), s[1:], strict=False):
        part = slice(start, stop)
        asks, n, median2, mad4, far = answered(group[part] - group[start], role[part], since[part], cents[part], known[part], count[part])
        few = n < 2
        chosen = rows.slice(start, stop - start).take(pa.array(asks)).combine_chunks()
        kind = pc.if_else(pc.equal(chosen["series"], ""), None, pc.utf8_slice_codeunits(chosen["series"], 1))
        columns = [chosen["click_id"], kind, pa.array(n)]
        columns += [pa.array(median2, mask=few), pa.array(mad4, mask=few), pa.array(far, mask=few | ~known[part][asks])]
        out += pa.table(columns, ["click_id", "kind", "n", "median2", "mad4", "far"]).to_batches()
    return out, rows.slice(end)


def clicks_once(clicks: DataFrame) -> DataFrame:
    """click_id, series (`=` and the kind, or nothing), at (microseconds of the clock, without a zone), cents; one row for each click_id."""
    ts = F.col("ts")
    at = F.unix_date(ts.cast("date")).cast("long") * 24 * HOUR + F.hour(ts).cast("long") * HOUR + F.minute(ts).cast("long") * 60 * SECOND + (F.extract(F.lit("SECOND"), ts) * SECOND).cast("long")
    cents = F.floor(F.lit(100.0) * F.col("value") + 0.5)
    rows = clicks.filter(ts.isNotNull()).select("click_id", at.alias("at"), F.coalesce(F.concat(F.lit("="), "kind"), F.lit("")).alias("series"), F.when(F.abs(F.col("value")) < LARGEST / 100, cents).cast("long").alias("cents"))
    return rows.groupBy("click_id").agg(F.min(F.struct("at", "series", "cents")).alias("of")).select("click_id", "of.*")


def rolling(clicks: DataFrame, most: int = MOST) -> DataFrame:
    """click_id, kind, n, median2, mad4, far of every click_id once; `most` is how many clicks a task may hold at once.

    Rows without ts are dropped; of rows that repeat a click_id (null being one) the one of least time, kind and cents stays.
    Amounts that are null, no number or beyond 2^53 cents have no cents: such clicks have a window but aren't in any. Clicks of
    equal kind and time have the same window. Other columns are ignored; an empty table gives no rows.
    """
    spark = clicks.sparkSession
    hour = F.expr(f"(at - pmod(at, {HOUR})) div {HOUR}")
    rows = written(spark, clicks_once(clicks).withColumn("hour", hour), "medians-clicks")
    asking = rows.select("series", "hour", (F.col("at") - F.col("hour") * HOUR + HOUR).alias("since"), "cents", "click_id", F.lit(BOTH).alias("role"))
    before = rows.filter(F.col("cents").isNotNull()).select("series", (F.col("hour") + 1).alias("hour"), (F.col("at") - F.col("hour") * HOUR).alias("since"), "cents", F.lit(None).cast(rows.schema["click_id"].dataType).alias("click_id"), F.lit(BEFORE).alias("role"))
    both = asking.unionByName(before)
    plain = lambda df: df.withColumns({"slice": F.lit(0), "part": F.lit(0), "count": F.lit(1).cast("long")})
    crowded = written(spark, crowded_hours(rows, most), "medians-crowded")
    if crowded.isEmpty():
        dealt = plain(both)
    else:
        second = F.expr(f"pmod(since, {HOUR}) div {SECOND}").cast("int")
        cuts = written(spark, slices(both.withColumn("second", second), crowded, most), "medians-slices")
        marked = both.withColumn("second", second).join(cuts, ["series", "hour", "second"], "left").drop("second")
        dealt = plain(marked.filter(F.col("slice").isNull()).drop("slice", "parts")).unionByName(dealt_slices(spark, marked.filter(F.col("slice").isNotNull()), cuts))
    found = dealt.repartition(*KEYS).sortWithinPartitions(*KEYS, "since")
    return in_arrow(found, in_task, RESULT.format(id=rows.schema["click_id"].dataType.simpleString()))


def crowded_hours(rows: DataFrame, most: int) -> DataFrame:
    """series, hour, and how many clicks a slice may have, of hours that with the hour before have more than `most` clicks.

    A slice may have as many clicks as the hours have different amounts, if those are more, so all slices' histograms together
    have no more rows than there are clicks.
    """
    hours = rows.groupBy("series", "hour").agg(F.count("*").alias("own"), F.approx_count_distinct("cents").alias("amounts"))
    later = hours.select("series", (F.col("hour") + 1).alias("hour"), F.lit(0).cast("long").alias("own"), F.col("own").alias("before"), "amounts")
    loads = hours.withColumn("before", F.lit(0).cast("long")).unionByName(later).groupBy("series", "hour").agg(F.sum("own").alias("own"), F.sum("before").alias("before"), F.sum("amounts").alias("amounts"))
    return loads.filter((F.col("own") > 0) & (F.col("own") + F.col("before") > most)).select("series", "hour", F.greatest(F.lit(most).cast("long"), "amounts").alias("most"))


def slices(both: DataFrame, crowded: DataFrame, most: int) -> DataFrame:
    """series, hour, second, slice, and in how many parts the slice's windows are dealt, for the seconds of crowded hours."""
    clock = Window.partitionBy("series", "hour").orderBy("second").rowsBetween(Window.unboundedPreceding, -1)
    seconds = both.join(crowded, ["series", "hour"]).groupBy("series", "hour", "second", "most").agg(F.count("*").alias("n"), F.count_if(F.col("role") == BOTH).alias("asking"))
    cut = seconds.withColumn("slice", (F.coalesce(F.sum("n").over(clock), F.lit(0)) / F.col("most")).cast("int"))
    parts = F.ceil(F.sum("asking").over(Window.partitionBy("series", "hour", "slice")) / F.col("most"))
    return cut.select("series", "hour", "second", "slice", F.greatest(F.lit(1), parts).cast("int").alias("parts"))


def dealt_slices(spark: SparkSession, marked: DataFrame, cuts: DataFrame) -> DataFrame:
    """The rows of crowded hours' tasks: windows to ask for, amounts of both slices, and the histograms of what lies between."""
    to_all = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    asking = marked.filter(F.col("role") == BOTH).select("series", "hour", "since", "cents", "click_id", F.lit(ASKS).alias("role"), "slice", F.pmod(F.xxhash64("click_id", "since"), F.col("parts")).cast("int").alias("part"), F.lit(1).cast("long").alias("count"))
    amounts = marked.filter(F.col("cents").isNotNull()).groupBy("series", "hour", "slice", "parts", "role", "since", "cents").agg(F.count("*").alias("count"))
    none = F.lit(None).cast(asking.schema["click_id"].dataType).alias("click_id")
    elements = amounts.select("series", "hour", "since", "cents", none, F.when(F.col("role") == BOTH, OWN).otherwise(BEFORE).alias("role"), "slice", to_all.alias("part"), "count")
    shares = amounts.groupBy("series", "hour", "cents", "slice").agg(*(F.sum(F.when(F.col("role") == r, F.col("count")).otherwise(0)).alias(n) for r, n in ((BOTH, "own"), (BEFORE, "before"))))
    shares = shares.groupBy("series", "hour", "cents").agg(F.collect_list(F.struct("slice", "own", "before")).alias("shares"))
    of_hour = cuts.groupBy("series", "hour").agg(F.array_sort(F.collect_set(F.struct("slice", "parts"))).alias("slices"))
    histograms = in_arrow(shares.join(of_hour, ["series", "hour"]), between, "series string, hour long, cents long, slice int, parts int, count long")
    middles = histograms.select("series", "hour", F.lit(0).cast("long").alias("since"), "cents", none, F.lit(BETWEEN).alias("role"), "slice", to_all.alias("part"), "count")
    return asking.unionByName(elements).unionByName(middles)


def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each amount and slice, how often the amount occurs in earlier slices of the hour and in later ones of the hour before."""
    names = ["series", "hour", "cents", "slice", "parts", "count"]
    rows: list[tuple] = []
    for b in batches:
        for row in b.to_pylist():
            at = {s["slice"]: i for i, s in enumerate(row["slices"])}
            own, before = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            for s in row["shares"]:
                own[at[s["slice"]]], before[at[s["slice"]]] = s["own"], s["before"]
            count = np.cumsum(own) - own + before.sum() - np.cumsum(before)
            rows += [(row["series"], row["hour"], row["cents"], row["slices"][i]["slice"], row["slices"][i]["parts"], int(count[i])) for i in np.flatnonzero(count)]
            if len(rows) >= TOGETHER:
                yield histogram(rows, names)
                rows = []
    yield histogram(rows, names)


def histogram(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def op11_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling medians and deviations of all clicks' amounts, an hour back in each kind."""
    return rolling(table(spark, sf_dir, "clicks"))
