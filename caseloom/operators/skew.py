"""Rankings, shares and duplicate handling that hold when one key owns a large share of the rows.

Joins are plain joins: adaptive execution splits a partition that one key makes too large,
on either side, and needs no list of such keys.  What adaptive execution cannot split, a
ranking or an aggregate over one key, is made in pieces here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import store

ROWS_PER_SALT = 200_000
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
COPIES_PER_ROW = 1_000_000


def same(pairs: list[tuple[Column, Column]]) -> Column:
    """Equality of all pairs, NULL being equal to NULL."""
    return reduce(lambda a, b: a & b, [a.eqNullSafe(b) for a, b in pairs])


def by_repetition(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key has no other row, and the rows of all other keys.

    Only the keys are read to count them, in buffers of fixed width.  Those that repeat are
    written, so their real size decides whether they are sent to the rows, which then stay
    where they are, or both sides are shuffled.  ``df`` is read three times: store it first
    if it is dear, or if it may come out differently.
    """
    counts = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_n"))
    repeated = store(counts.where("_n > 1").drop("_n"))
    on = same([(F.col(k), F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return df.join(repeated, on, "left_anti"), df.join(repeated, on, "left_semi")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row per key: the smallest by ``order`` and then by the other columns.

    Rows alone under their key are neither sorted nor compared (see :func:`by_repetition`).
    The others are ranked, and the cut to one row is made before the shuffle as well, so a
    hot key sends one row from each task.
    """
    alone, several = by_repetition(df, keys)
    rest = [F.col(c) for c in df.columns if c not in keys]
    return alone.unionByName(_cut(several, keys, [*(order or []), *rest], 1, "_rank").select(*df.columns))


def top_n_per_group(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    n: int,
    rank: str | None = None,
    spread: Column | None = None,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """First ``n`` rows of every group in ``order``, which must be total.

    With ``spread`` the groups are cut in pieces first, as many as the rows that reach the
    cut ask for, and the survivors once more; the optimizer's group limit makes either cut
    before the shuffle too, as far as ``n`` is under its threshold.  A task then sends ``n``
    rows of every piece, so pieces by all rows of a group would only multiply what is sent.
    The counts are written, so that a few groups are sent to the rows, which are not dealt
    out by group for them.
    """
    if spread is not None:
        limited = n <= int(df.sparkSession.conf.get(GROUP_LIMIT))
        sent = F.least(F.count(F.lit(1)), F.lit(n)) if limited else F.count(F.lit(1))
        tasks = df.select(*group, F.spark_partition_id().alias("_task")).groupBy(*group, "_task").agg(sent.alias("_sent"))
        sizes = tasks.groupBy(*group).agg(F.ceil(F.sum("_sent") / rows_per_salt).alias("_salts"))
        sizes = store(sizes.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], "_salts"))
        key = same([(F.col(g), F.col(f"_g{i}")) for i, g in enumerate(group)])
        salted = df.join(sizes, key).withColumn("_salt", F.pmod(F.xxhash64(spread), F.col("_salts")))
        df = _cut(salted, [*group, "_salt"], order, n, "_rn").select(*df.columns)
    out = _cut(df, group, order, n, rank or "_rank")
    return out if rank else out.drop("_rank")


def _cut(df, group, order, n, rank):
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def smallest_share(df: DataFrame, group: str, order_hex: Column, ids: list[str], share: float) -> DataFrame:
    """Flag, per group, the exact ``ceil(share * n)`` smallest rows by ``(order_hex, ids)`` as ``picked``.

    ``order_hex`` is an evenly spread hex digest, whose first four digits put the rows of
    each group into 65,536 buckets.  How many rows the buckets have tells the one in which a
    group's share ends: rows of buckets before and after it are flagged where they are read,
    and only the rows of that bucket are ranked.  ``df`` is read once, to be stored; the ends
    are stored too, so that those of a few groups are sent to the rows.
    """
    bucket = F.conv(F.substring("_hex", 1, 4), 16, 10).cast("int")
    hashed = store(df.withColumn("_hex", order_hex).withColumn("_bucket", bucket))
    counts = hashed.groupBy(F.col(group).alias("_g"), F.col("_bucket").alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("_g")
    up_to = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    running = counts.select(
        "_g",
        "_b",
        F.sum("_n").over(up_to).alias("_up_to"),
        (F.sum("_n").over(up_to) - F.col("_n")).alias("_before"),
        F.ceil(F.round(F.sum("_n").over(whole) * F.lit(share), 9)).alias("_want"),
    )
    # the first bucket that reaches the share; a share of nothing ends before the first
    ends = running.where("_up_to >= _want").groupBy("_g").agg(F.min(F.struct("_b", "_before", "_want")).alias("_e"))
    ends = store(ends.select("_g", "_e._b", "_e._before", "_e._want"))
    placed = hashed.join(ends, same([(F.col(group), F.col("_g"))]))
    clear = placed.where("_bucket <> _b").select(*df.columns, (F.col("_bucket") < F.col("_b")).alias("picked"))
    in_bucket = Window.partitionBy(group).orderBy("_hex", *ids)
    edge = placed.where("_bucket = _b").withColumn("_rank", F.row_number().over(in_bucket))
    return clear.unionByName(edge.select(*df.columns, (F.col("_before") + F.col("_rank") <= F.col("_want")).alias("picked")))


def count_copies(df: DataFrame) -> DataFrame:
    """Distinct rows with ``copies``; identical rows collapse before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))


def repeat_copies(df: DataFrame, copies: str, chunk: int = COPIES_PER_ROW) -> DataFrame:
    """Emit each row ``copies`` times: first in chunks, which are dealt out, and then in each chunk."""
    chunks = F.sequence(F.lit(0), F.ceil(F.col(copies) / chunk) - 1)
    dealt = df.where(F.col(copies) > 0).withColumn("_c", F.explode(chunks)).repartition(*df.columns, "_c")
    left = F.least(F.lit(chunk).cast("long"), F.col(copies) - F.col("_c") * chunk)
    return dealt.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), left))).drop(copies, "_c", "_i")


def mark_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row with ``is_duplicate``: False for the first row of its key by the other columns, else True.

    Rows alone under their key pass as they are (see :func:`by_repetition`).  Of the others
    exact copies are counted first, so a hot group of copies is one row by the time it is
    compared with the first row of its key.
    """
    rest = [c for c in df.columns if c not in keys]
    alone, several = by_repetition(df, keys)
    counted = count_copies(several)
    firsts = _cut(counted.drop("copies"), keys, [F.col(c) for c in rest], 1, "_rank").select(*keys, F.struct(*rest).alias("_first"))
    same_key = same([(F.col(f"c.{k}"), F.col(f"f.{k}")) for k in keys])
    both = counted.alias("c").join(firsts.alias("f"), same_key).select("c.*", "_first")
    is_first = F.struct(*rest).eqNullSafe(F.col("_first"))
    kept = F.when(is_first, F.struct(F.lit(False).alias("is_duplicate"), F.lit(1).cast("long").alias("_times")))
    dups = F.struct(
        F.lit(True).alias("is_duplicate"), (F.col("copies") - F.when(is_first, 1).otherwise(0)).alias("_times")
    )
    parts = both.select(*df.columns, F.inline(F.array_compact(F.array(kept, dups)))).where("_times > 0")
    return alone.withColumn("is_duplicate", F.lit(False)).unionByName(repeat_copies(parts, "_times"))
