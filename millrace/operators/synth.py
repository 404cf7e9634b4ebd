"""Synthesis and defect injection as functions of a row's key: the same rows under any partitioning.

Randomness is a hash of (seed, stream, key). Exact counts come from a rank of such
hashes: rows are counted by the hashes' first digits, and ranked within each of these buckets, never by a
sort of the whole table in one task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut


def count_of(rows: int, percent: float) -> int:
    """At least one row, and no fraction of one."""
    return max(1, math.ceil(rows * percent / 100))


def draw(seed: int, stream: str, *key: Column) -> Column:
    """A hash as hex text: the order in which rows are drawn."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(stream), *(k.cast("string") for k in key)))


def uniform(seed: int, stream: str, *key: Column) -> Column:
    """A number in [0, 1) of 52 bits."""
    return F.conv(F.substring(draw(seed, stream, *key), 1, 13), 16, 10).cast("double") / float(1 << 52)


def pareto(u: Column, alpha: float, least: float, most: float, scale: int = 2) -> Column:
    """Heavy-tailed amounts by the inverse distribution function, cut at `most`."""
    return F.round(F.least(F.lit(float(most)), F.lit(float(least)) * F.pow(1 - u, F.lit(-1.0 / alpha))), scale)


def normal(u: Column, v: Column) -> Column:
    """Box-Muller from two uniforms."""
    return F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * math.pi * v)


def choose(u: Column, weights: Mapping[str, float]) -> Column:
    """A value by weight; the weights must add up to 1."""
    if abs(sum(weights.values()) - 1) > 1e-9:
        raise ValueError("weights must add up to 1")
    out, at = None, 0.0
    for value, weight in weights.items():
        at += weight
        out = F.when(u < at, value) if out is None else out.when(u < at, value)
    return out.otherwise(list(weights)[-1])


def mixture_offset(u: Column, v: Column, w: Column, span: int, components: Sequence[tuple[float, float, float]]) -> Column:
    """Whole days in [0, span): a component (weight, centre, deviation as parts of the span), then a normal around it."""
    centre, deviation, at = None, None, 0.0
    for weight, c, d in components:
        at += weight
        centre = F.when(u < at, c * span) if centre is None else centre.when(u < at, c * span)
        deviation = F.when(u < at, max(1.0, d * span)) if deviation is None else deviation.when(u < at, max(1.0, d * span))
    last = components[-1]
    days = F.rint(centre.otherwise(last[1] * span) + deviation.otherwise(max(1.0, last[2] * span)) * normal(v, w))
    return F.greatest(F.lit(0), F.least(F.lit(span - 1), days)).cast("int")


def poisson(u: Column, rate: float, most: int = 60) -> Column:
    """Inverse Poisson distribution, as one expression over the first `most` values."""
    term, total, out = math.exp(-rate), 0.0, None
    for k in range(most):
        total += term
        out = F.when(u < total, k) if out is None else out.when(u < total, k)
        term *= rate / (k + 1)
    return out.otherwise(most)


def chosen(df: DataFrame, key: str, n: int, seed: int, stream: str, protected: Column | None = None) -> DataFrame:
    """(key, rank from 1) of the n rows that are drawn first.

    The rows are counted by the first digits of their draws; a row's rank is the number of rows in smaller
    buckets and its place in its own, so that nothing is sorted in one task.
    """
    rows = df if protected is None else df.where(~F.coalesce(protected, F.lit(False)))
    drawn = rows.select(key, draw(seed, stream, F.col(key)).alias("_draw"))
    total, digits = drawn.count(), 1
    # four digits at most: the buckets that are added up in one task are 65,536, however many rows there are
    while digits < 4 and 16**digits * 1_000 < total:
        digits += 1
    drawn = drawn.withColumn("_bucket", F.substring("_draw", 1, digits))
    counts = drawn.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # a row for each bucket; those behind the n-th row go no further
    before = counts.select("_bucket", (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_before")).where(F.col("_before") < n)
    placed = drawn.join(before, "_bucket").withColumn("rank", F.col("_before") + F.row_number().over(Window.partitionBy("_bucket").orderBy("_draw", key)))
    return placed.where(F.col("rank") <= n).select(key, F.col("rank").cast("int").alias("rank"))


def disjoint_groups(df: DataFrame, key: str, sizes: Mapping[str, int], seed: int, stream: str) -> DataFrame:
    """(key, group): consecutive bands of one draw, in the order of sizes."""
    ranked = chosen(df, key, sum(sizes.values()), seed, stream)
    group, at = None, 0
    for name, n in sizes.items():
        at += n
        group = F.when(F.col("rank") <= at, name) if group is None else group.when(F.col("rank") <= at, name)
    return ranked.select(key, group.alias("group"))


def inject_nulls(df: DataFrame, key: str, column: str, n: int, seed: int = 42, protected: Column | None = None) -> DataFrame:
    """Exactly n rows, or all that are not protected, lose their value."""
    hit = chosen(df, key, n, seed, f"null:{column}", protected).select(key, F.lit(True).alias("_hit"))
    return df.join(hit, key, "left").withColumn(column, F.when(F.col("_hit").isNull(), F.col(column))).select(*df.columns)


def inject_outliers(df: DataFrame, key: str, column: str, n: int, least: float, most: float, seed: int = 42, scale: int = 2) -> DataFrame:
    """Exactly n rows get a value drawn evenly from [least, most]."""
    hit = chosen(df, key, n, seed, f"outlier:{column}").select(key, F.lit(True).alias("_hit"))
    value = F.round(least + (most - least) * uniform(seed, f"outlier value:{column}", F.col(key)), scale).cast(df.schema[column].dataType)
    return df.join(hit, key, "left").withColumn(column, F.when(F.col("_hit"), value).otherwise(F.col(column))).select(*df.columns)


def inject_boundaries(df: DataFrame, key: str, column: str, values: Sequence, seed: int = 42) -> DataFrame:
    """The first drawn row gets the first value, and so on: each exactly once."""
    ranked = chosen(df, key, len(values), seed, f"boundary:{column}")
    value = F.element_at(F.array(*map(F.lit, values)), F.col("rank")).cast(df.schema[column].dataType)
    return df.join(ranked.withColumn("_value", value).select(key, "_value"), key, "left").withColumn(column, F.coalesce("_value", column)).select(*df.columns)


def near_duplicates(df: DataFrame, key: str, n: int, change: Mapping[str, Column], seed: int = 42) -> DataFrame:
    """df and n more rows: drawn ones with new keys after the largest, and the columns in `change` altered."""
    ranked = chosen(df, key, n, seed, "duplicate")
    last = df.agg(F.max(key).alias("_last"))
    # one row: the largest key
    copies = df.join(ranked, key).crossJoin(F.broadcast(last))
    changed = {c: e.cast(df.schema[c].dataType) for c, e in change.items()}
    new = copies.withColumns(changed).withColumn(key, (F.col("_last") + F.col("rank")).cast(df.schema[key].dataType))
    return df.unionByName(new.select(*df.columns))


def orphan_keys(df: DataFrame, key: str, column: str, n: int, base: int = 900_000_000, seed: int = 42) -> DataFrame:
    """Exactly n rows refer to base + their own key, which no parent has."""
    hit = chosen(df, key, n, seed, f"orphan:{column}").select(key, F.lit(True).alias("_hit"))
    return df.join(hit, key, "left").withColumn(column, F.when(F.col("_hit"), F.col(key) + base).otherwise(F.col(column)).cast(df.schema[column].dataType)).select(*df.columns)


def shift_tree(root: DataFrame, key: str, delta: DataFrame, tables: Mapping[str, tuple[DataFrame, str, Sequence[str]]], root_dates: Sequence[str]) -> dict[str, DataFrame]:
    """Move roots and all that belong to them by the same days: delta is (key, days); tables are (df, foreign key, dates)."""
    moved = lambda df, dates, names: df.withColumns({d: F.when(F.col("_days").isNull(), F.col(d)).otherwise(F.date_add(d, F.col("_days"))) for d in dates}).select(*names)
    days = delta.select(F.col(key).alias("_root"), F.col("days").cast("int").alias("_days"))
    out = {"root": moved(root.join(days, F.col(key) == F.col("_root"), "left"), root_dates, root.columns)}
    for name, (df, foreign, dates) in tables.items():
        out[name] = moved(df.join(days, F.col(foreign) == F.col("_root"), "left"), dates, df.columns)
    return out


def whole(n: int, seed: int, stream: str, *key: Column) -> Column:
    """A whole number from 0 to n - 1."""
    return F.pmod(F.conv(F.substring(draw(seed, stream, *key), 1, 13), 16, 10).cast("long"), F.lit(n))


def double_entry(transactions: DataFrame, key: str, amount: str, accounts: int, *, pairs: int = 1, reversal: str | None = None, unposted: int = 0, seed: int = 42) -> DataFrame:
    """Debit and credit lines of each transaction, in `pairs` pairs that share its amount exactly, on different accounts.

    Of a reversed transaction the sides are swapped and the posting type is Reversal;
    exactly `unposted` transactions have no lines. The first pair gets what an even division leaves over.
    """
    kind = transactions.schema[amount].dataType
    rows = transactions.join(chosen(transactions, key, unposted, seed, "unposted").select(key), key, "left_anti") if unposted else transactions
    lines = rows.withColumn("line_number", F.explode(F.sequence(F.lit(1), F.lit(2 * pairs))))
    pair = F.ceil(F.col("line_number") / 2).cast("int")
    first = whole(accounts, seed, "debit account", F.col(key), pair)
    other = F.pmod(first + 1 + whole(accounts - 1, seed, "credit account", F.col(key), pair), F.lit(accounts))
    undone = F.coalesce(F.col(reversal), F.lit(False)) if reversal else F.lit(False)
    is_debit = (F.col("line_number") % 2 == 1) != undone
    unit = F.lit(10 ** kind.scale).cast("decimal(19,0)")
    units = (F.col(amount) * unit).cast("long")
    even = units - F.pmod(units, F.lit(pairs))
    share = (even / pairs).cast("long") + F.when(pair == 1, units - even).otherwise(0)
    part = (share.cast("decimal(28,0)") / unit).cast(kind)
    account = F.when(F.col("line_number") % 2 == 1, first).otherwise(other)
    return lines.select(key, "line_number", account.alias("account_id"), F.when(is_debit, part).alias("debit_amount"), F.when(~is_debit, part).alias("credit_amount"), F.when(undone, "Reversal").otherwise("Standard").alias("posting_type"))


def allocate_whole(df: DataFrame, key: str, total: int, least: int = 1, most: int | None = None, weight: Column | None = None, seed: int = 42, stream: str = "share") -> DataFrame:
    """(key, units): `total` whole units over all rows, each with at least `least` and at most `most`, by weight or evenly by draws.

    Shares are rounded down, and what is left goes to the rows with the largest remainders; what passes `most`
    is shared again among the others. A total that cannot be met is an error.
    """
    rows = df.count()
    if total < least * rows or (most is not None and total > most * rows):
        raise ValueError(f"{total} units cannot be shared by {rows} rows of {least} to {most}")
    w = uniform(seed, stream, F.col(key)) + 0.5 if weight is None else weight.cast("double")
    now = cut(df.select(key, w.alias("_w"), draw(seed, f"{stream} tie", F.col(key)).alias("_tie"), F.lit(least).cast("long").alias("units")))
    left = total - least * rows
    while left:
        open_ = now if most is None else now.where(F.col("units") < most)
        weights = open_.agg(F.sum("_w")).first()[0]
        shared = now.withColumn("_share", F.when(F.lit(True) if most is None else F.col("units") < most, F.col("_w") / weights * left).otherwise(0.0))
        room = F.lit(left) if most is None else most - F.col("units")
        shared = shared.withColumn("_add", F.least(F.floor("_share"), room.cast("long")))
        given = shared.agg(F.sum("_add")).first()[0]
        if not given:
            # less than one unit for each: one to those with the largest shares
            free = shared.where("_share > 0")
            order = F.concat(F.lpad((F.lit(10**15) - F.floor(F.col("_share") * 10**14)).cast("string"), 17, "0"), F.col("_tie"))
            hit = free.select(key, order.alias("_order")).orderBy("_order").limit(left).select(F.col(key).alias("_hit"))
            return shared.join(F.broadcast(hit) if left < 100_000 else hit, F.col(key) == F.col("_hit"), "left").select(key, (F.col("units") + F.col("_hit").isNotNull().cast("long")).alias("units"))
        now, left = cut(shared.select(key, "_w", "_tie", (F.col("units") + F.col("_add")).alias("units"))), left - given
    return now.select(key, "units")


def number_in_groups(df: DataFrame, key: str, group: str, least: int, most: int, seed: int = 42) -> DataFrame:
    """(key, group, number): each group's rows, in the order of the key, dealt to runs of least to most rows, numbered from 1 within a run."""
    size = least + whole(most - least + 1, seed, "run", F.col(group), F.col("_run"))
    # a run's size is a function of its group and its number; runs are laid end to end up to the group's size
    sizes = df.groupBy(group).agg(F.count("*").alias("_rows")).withColumn("_run", F.explode(F.sequence(F.lit(1), F.ceil(F.col("_rows") / least).cast("int"))))
    line = Window.partitionBy(group).orderBy("_run")
    runs = sizes.withColumn("_size", size).withColumn("_end", F.sum("_size").over(line)).withColumn("_begin", F.col("_end") - F.col("_size")).where("_begin < _rows")
    runs = runs.select(F.col(group).alias("_group"), "_run", "_begin", "_end")
    placed = df.withColumn("_at", F.row_number().over(Window.partitionBy(group).orderBy(key)) - 1)
    joined = placed.join(runs, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_at") >= F.col("_begin")) & (F.col("_at") < F.col("_end")))
    return joined.select(key, group, F.col("_run").alias("run"), (F.col("_at") - F.col("_begin") + 1).cast("int").alias("number"))


def unique_pairs(a: DataFrame, b: DataFrame, a_key: str, b_key: str, n: int, seed: int = 42) -> DataFrame:
    """(a_key, b_key): n distinct pairs in which every key of the larger side, and of the smaller, occurs once before any occurs again.

    Both sides are numbered by their draws; pair i joins number i of each side, counted around, and moved by one
    at each full turn, so that no pair repeats before all there are.
    """
    many, few = a.count(), b.count()
    if n > many * few:
        raise ValueError(f"{n} pairs of {many} and {few} keys")
    if not n:
        return a.select(a_key).limit(0).crossJoin(b.select(b_key).limit(0))
    left = chosen(a, a_key, many, seed, "left").select(a_key, (F.col("rank") - 1).cast("long").alias("_x"))
    right = chosen(b, b_key, few, seed, "right").select(b_key, (F.col("rank") - 1).cast("long").alias("_y"))
    turn = math.lcm(many, few)
    i = F.col("id")
    pairs = a.sparkSession.range(n).select((i % many).alias("_x"), ((i + F.floor(i / turn)) % few).cast("long").alias("_y"))
    return pairs.join(left, "_x").join(right, "_y").select(a_key, b_key)


def preferred_then_rest(df: DataFrame, key: str, n: int, preferred: Column, seed: int = 42, stream: str = "preferred", protected: Column | None = None) -> DataFrame:
    """(key): n rows that are not protected, preferred ones first, and others only where these are too few."""
    free = df if protected is None else df.where(~F.coalesce(protected, F.lit(False)))
    likes = free.where(F.coalesce(preferred, F.lit(False)))
    first = chosen(likes, key, n, seed, stream).select(key)
    missing = n - min(n, likes.count())
    rest = free.where(~F.coalesce(preferred, F.lit(False)))
    return first if not missing else first.unionAll(chosen(rest, key, missing, seed, stream).select(key))


#: Lines, about, that a task of rebalance sorts; single groups stay whole.
TASK_LINES = 1_000_000


def rebalance(lines: DataFrame, keys: Sequence[str], order: Sequence[str], amount: str, totals: DataFrame, total: str) -> DataFrame:
    """lines with a group's amounts changed in proportion, so that they add up to its new total exactly; groups without one stay.

    Amounts are shared in units of their scale by their old weights; what rounding leaves goes to the first lines.
    """
    kind = lines.schema[amount].dataType
    unit = 10**kind.scale
    # partitions by rows: those that adaptive execution makes by compressed bytes, or a fixed number of them, hold ever more lines
    dealt = lines.repartition(max(1, -(-lines.count() // TASK_LINES)), *keys)
    joined = dealt.join(totals.select(*keys, F.col(total).alias("_total")), list(keys), "left").withColumn("_weight", (F.col(amount) * unit).cast("long"))
    group, line = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy(*order)
    wanted, all_ = (F.col("_total") * unit).cast("decimal(19,0)"), F.sum("_weight").over(group)
    joined = joined.withColumn("_share", F.expr("cast(_weight as decimal(19,0))") * wanted).withColumn("_all", all_)
    joined = joined.withColumn("_floor", F.expr("cast(_share div cast(_all as decimal(19,0)) as bigint)"))
    joined = joined.withColumn("_left", wanted.cast("long") - F.sum("_floor").over(group)).withColumn("_n", F.row_number().over(line))
    new = ((F.col("_floor") + (F.col("_n") <= F.col("_left")).cast("long")).cast("decimal(28,0)") / unit).cast(kind)
    return joined.withColumn(amount, F.when(F.col("_total").isNull(), F.col(amount)).otherwise(new)).select(*lines.columns)


def windowed_moment(key: Column, start: Column, end: Column, seed: int = 42, stream: str = "moment", today: Column | None = None, open_days: int = 90) -> Column:
    """A day in a campaign's window [start, end], drawn by the key; an end before the start is no window.

    With today, a missing end is today's date for a campaign that has begun, and open_days after the start for one
    that is to come; without, a missing end is no window.
    """
    if today is not None:
        end = F.coalesce(end, F.when(start > today, F.date_add(start, open_days)).when(start.isNotNull(), today))
    days = F.datediff(end, start) + 1
    return F.when(days > 0, F.date_add(start, F.floor(uniform(seed, stream, key) * days).cast("int")))


def date_grid(pairs: DataFrame, first: str, last: str) -> DataFrame:
    """Every pair on every day from first to last."""
    return pairs.withColumn("day", F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))))


def transpose_typo(text: Column) -> Column:
    """The last two adjacent characters that differ change places; if all are equal the last one is doubled."""
    # one pass each, whatever an address is made of: a lambda over places would compute the text anew at every place
    doubled = F.regexp_replace(text, r"(?s)\A((.)\2*)\z", "$1$2")
    return F.regexp_replace(doubled, r"(?s)\A(.*)(.)(?!\2)(.)", "$1$3$2")


def email_typo(email: Column) -> Column:
    """An address whose part before the @ has a typo; without one the whole text has."""
    at = F.instr(email, "@")
    return F.when(at > 1, F.concat(transpose_typo(F.substring(email, F.lit(1), at - 1)), F.substring(email, at, F.length(email)))).otherwise(transpose_typo(email))
