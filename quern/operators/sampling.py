"""Sampling, quotas, splits and batches.  Draws come from hashes of a seed and a key, so reruns agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def draw(seed: int, *keys) -> Column:
    """A uniform number in [0, 1) for a row: the first 13 hexadecimal digits of an MD5 of the seed and the
    keys, joined by colons, so that any SQL engine can draw the same."""
    cols = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *cols)), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint") / float(1 << 52)


def bernoulli(p, seed: int, *keys) -> Column:
    return draw(seed, *keys) < p


def weighted(options: list, weights: list[float], seed: int, *keys) -> Column:
    u, total, reached = draw(seed, *keys), sum(weights), 0.0
    out = None
    for o, w in list(zip(options, weights, strict=True))[:-1]:
        reached += w / total
        out = F.when(u < reached, o) if out is None else out.when(u < reached, o)
    return F.lit(options[-1]) if out is None else out.otherwise(options[-1])


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows in the order of a hash (a total order: range-partitioned, not one task)."""
    return df.orderBy(draw(seed, key), key)


def sample(df: DataFrame, n: int, key: str, seed: int, total: int | None = None) -> DataFrame:
    """``n`` rows without replacement; where there are fewer than ``n``, ``n`` draws with replacement.
    ``total``: the number of rows, counted if it isn't given.

    With replacement, the i-th draw is a row's number in the order of ``key``: rows are numbered in
    ranges, which are then added up, and joined with the draws, so that no task holds them all.
    """
    total = df.count() if total is None else total
    if n <= total or not total:
        return df.orderBy(draw(seed, key), key).limit(n)
    numbered, at, _ = numbered_in_ranges(df.withColumn("__one", F.lit(0)), "__one", key)
    wanted = df.sparkSession.range(n).select(F.floor(draw(seed, "id") * total).alias("__w"))
    return numbered.withColumn("__at", at).join(wanted, F.col("__at") == F.col("__w")).select(*[F.col(f"`{c}`") for c in df.columns])


def take_per_group(df: DataFrame, by: list[str], most: Column, key: str, seed: int | None = None) -> DataFrame:
    """At most ``most`` (a column, constant inside a group) rows of each group: the first by key, or
    with a seed those that a hash picks.

    A first cut inside hashed parts of a group keeps large groups from being ranked in one task.
    """
    order = [key] if seed is None else [draw(seed, key), key]
    salt = F.pmod(F.hash(key), F.lit(32))
    df = df.withColumn("__most", most)
    first = df.withColumn("__n", F.row_number().over(Window.partitionBy(*by, salt).orderBy(*order))).where("__n <= __most")
    return first.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("__n <= __most").drop("__n", "__most")


def stratified(df: DataFrame, by: str, key: str, share: float = 0.1, most: int = 500, seed: int | None = None) -> DataFrame:
    """``min(most, share of the group)`` rows of each group, one at least."""
    sizes = df.groupBy(F.col(by).alias("__g")).agg(F.count(F.lit(1)).alias("__size"))
    sized = df.join(sizes, F.col(by).eqNullSafe(F.col("__g"))).drop("__g")
    return take_per_group(sized, [by], F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.col("__size") * share))), key, seed).drop("__size")


def expert_split(df: DataFrame, experts: DataFrame, category: str, key: str, share: float = 0.1, most: int = 500, dilution: float = 0.6, seed: int | None = None) -> DataFrame:
    """Training rows of each expert: (expert, own) and ``df``'s columns.

    An expert has the rows of its categories and, of the stratified sample of each foreign category,
    ``floor(own rows / (number of categories * dilution))`` rows at most.  Rows of categories without
    an expert are in none.
    """
    names = experts.select(F.col("expert"), F.col("category").alias("__c"))
    mapped = df.join(names, df[category] == F.col("__c")).drop("__c")
    totals = mapped.groupBy("expert").agg(F.count(F.lit(1)).alias("__total"))
    categories = experts.agg(F.count(F.lit(1)).alias("__cats"))
    every = experts.select("expert").distinct().join(totals, "expert", "left").crossJoin(categories)
    room = every.select(F.col("expert").alias("__to"), F.floor(F.coalesce("__total", F.lit(0)) / (F.col("__cats") * dilution)).alias("__room"))
    picked = stratified(mapped, category, key, share, most, seed).withColumnRenamed("expert", "__from")
    order = [key] if seed is None else [draw(seed, key), key]
    ranked = picked.withColumn("__n", F.row_number().over(Window.partitionBy(category).orderBy(*order)))
    # every category's sample (``most`` rows at most) goes to every other expert that has room for it
    to = names.select(F.col("__c"), F.col("expert").alias("__own")).distinct().crossJoin(room).where("__own <> __to").select("__c", "__own", "__to", "__room")
    foreign = ranked.join(to, (ranked[category] == to["__c"]) & (ranked["__from"] == to["__own"]) & (F.col("__n") <= F.col("__room")))
    cols = [c for c in df.columns]
    return mapped.select("expert", F.lit(True).alias("own"), *cols).unionAll(foreign.select(F.col("__to").alias("expert"), F.lit(False).alias("own"), *cols))


def quota(df: DataFrame, category: str, key: str, targets: Column, existing: DataFrame | None = None) -> DataFrame:
    """The first rows of each category until its target is met, ``existing`` (category, count) counted in."""
    if existing is not None:
        have = existing.select(F.col(category).alias("__c"), F.col("count").alias("__have"))
        df = df.join(have, F.col(category).eqNullSafe(F.col("__c")), "left").drop("__c")
    else:
        df = df.withColumn("__have", F.lit(0))
    return take_per_group(df, [category], targets - F.coalesce("__have", F.lit(0)), key).drop("__have")


def numbered_in_ranges(df: DataFrame, by: str, key: str, parts: int = 64) -> tuple[DataFrame, Column, Column]:
    """``df`` with working columns, and columns for a row's number (from 0) in the order of ``key``
    in its group, and for the group's size. Ranges of (by, key) are numbered by themselves."""
    from ..storage import cut

    held = cut(df.repartitionByRange(parts, by, key).withColumn("__p", F.spark_partition_id()))
    ranged = held.withColumn("__inside", F.row_number().over(Window.partitionBy("__p", by).orderBy(key)) - 1)
    # one row for each range and group: few, whatever a group holds
    sums = ranged.groupBy(F.col(by).alias("__g"), F.col("__p").alias("__q")).agg(F.count(F.lit(1)).alias("__c"))
    whole = Window.partitionBy("__g")
    sums = sums.select("__g", "__q", (F.sum("__c").over(whole.orderBy("__q").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__c")).alias("__before"), F.sum("__c").over(whole).alias("__all"))
    out = ranged.join(sums, F.col(by).eqNullSafe(F.col("__g")) & (F.col("__p") == F.col("__q"))).drop("__g", "__p", "__q")
    out._quern_table = held._quern_table  # to be released by who has used it
    return out, F.col("__before") + F.col("__inside"), F.col("__all")


def batches(df: DataFrame, key: str, size: int, by: str) -> DataFrame:
    """``batch`` (from 1): chunks of nearly equal size, at most ``size`` rows, larger ones first.

    Rows are numbered in ranges of their key, and ranges then added up, so that no task ranks a group.
    """
    df, at, n = numbered_in_ranges(df, by, key)
    count = F.ceil(n / size)
    small, more = F.floor(F.col("__n") / F.col("__k")), F.pmod("__n", "__k")
    edge = more * (small + 1)
    numbered = df.withColumn("__n", n).withColumn("__k", count).withColumn("__at", at).drop("__before", "__inside", "__all")
    batch = F.when(F.col("__at") < edge, F.floor(F.col("__at") / (small + 1))).otherwise(more + F.floor((F.col("__at") - edge) / small))
    return numbered.withColumn("batch", batch.cast("int") + 1).drop("__n", "__k", "__at")


def rotated(slots: DataFrame, slot: str, items: DataFrame, item_index: str, n_items: int, start: int = 0) -> DataFrame:
    """Round robin: slot ``i`` gets the item ``(start + i) mod n_items``."""
    return slots.join(items, F.pmod(F.col(slot) + start, F.lit(n_items)) == F.col(item_index))


def bucket_pop(df: DataFrame, bucket: str, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows without replacement, each the next of a bucket drawn among those not yet empty, with
    ``turn`` from 0; inside a bucket the order is that of a hash.

    Each bucket has a clock: the time of its i-th row is the sum of i exponential waits. Of clocks that
    still run each is equally likely to be next, whatever has happened, so the rows in the order of their
    times are such a sequence of draws. No more than ``n`` rows of a bucket are ranked together.
    """
    most = take_per_group(df, [bucket], F.lit(n), key, seed)
    inside = Window.partitionBy(bucket).orderBy(draw(seed, key), key)
    clocked = most.withColumn("__i", F.row_number().over(inside))
    wait = -F.log(1 - draw(seed, bucket, "__i"))
    clocked = clocked.withColumn("__time", F.sum(wait).over(Window.partitionBy(bucket).orderBy("__i")))
    first = clocked.orderBy("__time", bucket, "__i").limit(n)
    # n rows, which the limit has brought together
    return first.withColumn("turn", F.row_number().over(Window.orderBy("__time", bucket, "__i")) - 1).drop("__i", "__time")


def running_total(df: DataFrame, amount: str, order: str, parts: int = 64) -> DataFrame:
    """``running``: the sum of ``amount`` up to each row in the order of a numeric key, in two levels:
    totals of ranges, then inside a range, so no task holds all rows."""
    df = df.repartitionByRange(parts, order).withColumn("__p", F.spark_partition_id())
    from ..storage import cut

    df = cut(df)
    sums = df.groupBy("__p").agg(F.sum(amount).alias("__s"))
    before = sums.select("__p", (F.sum("__s").over(Window.orderBy("__p")) - F.col("__s")).alias("__before"))
    inside = F.sum(amount).over(Window.partitionBy("__p").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("running", inside).join(F.broadcast(before), "__p").withColumn("running", F.col("running") + F.col("__before")).drop("__p", "__before")


def until_exhausted(df: DataFrame, amount: str, order: str, limit: int) -> DataFrame:
    """Rows whose running total is at most ``limit``."""
    return running_total(df, amount, order).where(F.col("running") <= limit)
