"""Equi-joins whose strategy follows measured sizes and measured key skew."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.operators.select import not_null
from assayloom.session import fits_broadcast, materialise

# Fewest pieces a join's left side is thought of as divided into.
_MIN_PIECES = 256


def left_lookup(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join of two tables that both hold a key once.

    No key can be hot, so the strategy is left to Catalyst: a grouped left side
    is already partitioned by its key and is not shuffled again.
    """
    return left.join(right, list(on), "left")


def join_pieces(spark: SparkSession) -> int:
    """Pieces to divide a join's left side into: one per shuffle partition, 256 at least."""
    return max(_MIN_PIECES, int(spark.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(left: DataFrame, on: Sequence[str], pieces: int | None = None) -> DataFrame:
    """(keys, n_salts) of the keys that hold more than one piece's rows.

    With the rows divided into ``pieces`` equal parts, at most ``pieces`` keys can
    be hot, which bounds this table. ``n_salts`` divides a key into parts of about
    one piece. Keys with nulls are counted too. Keys are counted once, combined
    on the map side; the total is taken from the same counts.
    """
    pieces = pieces or join_pieces(left.sparkSession)
    keys = [F.col(f"`{k}`") for k in on]
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    piece = F.greatest(F.lit(1.0), counts.agg(F.sum("_n")).scalar() / F.lit(float(pieces)))
    hot = counts.where(F.col("_n") > piece)
    return materialise(hot.select(*keys, F.ceil(F.col("_n") / piece).cast("int").alias("_n_salts")), "hot-keys")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread: Sequence[str] | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Shuffled left or inner join with the left side's hot keys cut into pieces.

    Each left row of a hot key goes to one piece, and the right rows of that key
    are copied to every piece: the result is exactly that of the plain join,
    which is what runs when no key is hot.
    The piece is a hash of the ``spread`` columns (all of them by default, so
    carry a row id), which gives the same piece when a lost task is run again.
    Rows with a null key never match and are spread as well.
    """
    if how not in ("left", "inner"):
        raise ValueError("skew_join does left and inner joins")
    on = list(on)
    hot = hot_keys(left, on) if hot is None else hot
    if hot.isEmpty():
        return left.join(right, on, how)
    spread_by = F.xxhash64(*[F.col(f"`{c}`") for c in (spread or left.columns)])
    null_key = reduce(or_, [F.col(f"`{k}`").isNull() for k in on])
    # At most one row per piece, whatever the size of the data.
    small = F.broadcast(hot.where(~null_key))
    salts = F.coalesce("_n_salts", F.lit(1))
    salt = F.when(null_key, F.pmod(spread_by, F.lit(join_pieces(left.sparkSession)))).otherwise(F.pmod(spread_by, salts))
    salted_left = left.join(small, on, "left").withColumn("_salt", salt.cast("int")).drop("_n_salts")
    salted_right = (
        right.where(~null_key).join(small, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_n_salts")
    )
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


def skew_full_join(left: DataFrame, right: DataFrame, on: Sequence[str], spread: Sequence[str] | None = None) -> DataFrame:
    """Shuffled full outer join with the hot keys of either side cut into pieces.

    The side with hot keys (the left one, if both have) is joined as in
    ``skew_join``, which keeps all its rows; the rows of the other side that meet none of
    them are found by an anti-join on the distinct keys, so each comes once, however
    many pieces its key has. Without hot keys it is the plain join. Null keys never match.
    """
    on = list(on)
    names = [*on, *[c for c in left.columns if c not in on], *[c for c in right.columns if c not in on]]
    for one, other in ((left, right), (right, left)):
        hot = hot_keys(one, on)
        if hot.isEmpty():
            continue
        met = skew_join(one, other, on, "left", spread if one is left else None, hot)
        keys = one.select(*[F.col(f"`{k}`") for k in on]).distinct()
        return met.unionByName(other.join(keys, on, "left_anti"), allowMissingColumns=True).select(*[F.col(f"`{c}`") for c in names])
    return left.join(right, on, "full")


def dimension_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    freeze: bool = False,
    spread: Sequence[str] | None = None,
    count_on: DataFrame | None = None,
    many: bool = False,
) -> DataFrame:
    """Join a table to a dimension.

    The dimension is broadcast when its measured bytes are within the session's
    broadcast limit (the left side is then not shuffled at all); otherwise the
    join is shuffled with hot keys salted. ``freeze`` writes a dimension that is
    costly to compute to the shared folder first, so that measuring and joining
    do not compute it twice.

    ``count_on`` is an earlier table with the same rows' keys, to count hot keys
    on when ``left`` is costly to compute. ``many``: keys have several rows in the
    dimension, which is then broadcast with one list of rows per key.
    """
    on = list(on)
    if freeze:
        right = materialise(right, "dimension")
    if fits_broadcast(right):
        return _list_join(left, right, on, how) if many else left.join(F.broadcast(right), on, how)
    hot = hot_keys(left if count_on is None else count_on, on)
    return skew_join(left, right, on, how, spread, hot)


def _list_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Broadcast join to a small table with many rows per key: one lookup per left row, whose list of rows is then spread.

    Lists together are no larger than the table, which was measured to be within the broadcast limit.
    """
    cells = [F.col(f"`{c}`") for c in right.columns if c not in on]
    if how not in ("left", "inner") or not cells:
        return left.join(F.broadcast(right), on, how)
    lists = right.groupBy(*[F.col(f"`{k}`") for k in on]).agg(F.collect_list(F.struct(*cells)).alias("_rows"))
    met = left.join(F.broadcast(lists), on, how)
    return met.select(*[F.col(f"`{c}`") for c in met.columns if c != "_rows"], F.inline_outer("_rows"))


def suffix_overlaps(
    left: DataFrame, right: DataFrame, on: Sequence[str], suffixes: tuple[str, str] = ("_x", "_y")
) -> tuple[DataFrame, DataFrame]:
    """Both sides with the non-key names they share told apart by suffixes."""
    shared = [c for c in left.columns if c in set(right.columns) and c not in set(on)]
    return (
        left.withColumnsRenamed({c: c + suffixes[0] for c in shared}),
        right.withColumnsRenamed({c: c + suffixes[1] for c in shared}),
    )


def suffix_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    suffixes: tuple[str, str] = ("_x", "_y"),
    **options,
) -> DataFrame:
    """``dimension_join`` with suffixes on shared non-key names."""
    left, right = suffix_overlaps(left, right, on, suffixes)
    return dimension_join(left, right, on, how, **options)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself, or ValueError when a key occurs twice (a join would fan out)."""
    keys = list(keys)
    twice = df.groupBy(*[F.col(f"`{k}`") for k in keys]).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{keys} are not unique, for example {tuple(twice[0][k] for k in keys)}")
    return df


def concat_columns(
    left: DataFrame,
    right: DataFrame,
    align: str = "row_id",
    row_id: str = "row_id",
    left_order: Sequence[Column | str] | None = None,
    right_order: Sequence[Column | str] | None = None,
    how: str = "full",
    suffixes: tuple[str, str] = ("_x", "_y"),
    ranged: bool = False,
) -> DataFrame:
    """Put two tables side by side, shared names told apart by ``suffixes``.

    ``row_id``: each left row meets the right row of its own id, also after a
    fan-out that repeats ids very unevenly (hot ids are cut into pieces); rows of either side alone stay with
    nulls (``how="left"``: those of the left side only). ``position``: the n-th left row
    meets the n-th right row, and the longer side is padded with nulls; the orders must be stated. Only positions that both sides
    have are joined. ``ranged``: the left side already lies in ranges of its first order column (``with_row_index``).
    """
    if align == "row_id":
        left, right = suffix_overlaps(left, right, [row_id], suffixes)
        if how == "full":
            return skew_full_join(left, right, [row_id])
        return skew_join(left, right, [row_id], how)
    if align != "position":
        raise ValueError(f"align must be 'row_id' or 'position', not {align!r}")
    from assayloom.operators.rows import with_row_index

    a = with_row_index(left, left_order or [row_id], "_position", ranged)
    b = with_row_index(right, right_order or [row_id], "_position")
    a, b = suffix_overlaps(a, b, ["_position", row_id], suffixes)
    if row_id in a.columns and row_id in b.columns:
        both = _meet_positions(a, b.withColumnRenamed(row_id, "_other_id"))
        return both.withColumn(row_id, F.coalesce(row_id, "_other_id")).drop("_other_id")
    return _meet_positions(a, b)


def _meet_positions(a: DataFrame, b: DataFrame) -> DataFrame:
    """Full join of two tables numbered 0..n-1 in ``_position``: rows beyond the shorter one meet nothing and stay where they are."""
    place = F.col("_position")
    n, m = a.count(), b.count()
    shared = min(n, m)
    both = a.where(place < shared).join(b.where(place < shared), "_position")
    names = both.columns
    for side, rows in ((a, n), (b, m)):
        if rows > shared:
            both = both.unionByName(side.where(place >= shared), allowMissingColumns=True)
    return both.select(*[F.col(f"`{c}`") for c in names])


def key_hits(left: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """(key, n_rows, found) per distinct non-null key of the left table."""
    counts = not_null(left, [key]).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    known = not_null(dimension.select(key), [key]).distinct().withColumn("_found", F.lit(True))
    return left_lookup(counts, known, [key]).select(
        key, "n_rows", F.col("_found").isNotNull().alias("found")
    )


def hit_summary(left: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """(found, n_keys, n_rows): how many keys, and rows, a lookup will find or miss."""
    return (
        key_hits(left, dimension, key).groupBy("found")
        .agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n_rows").alias("n_rows"))
    )


def missing_keys(left: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Distinct left keys the dimension does not hold."""
    names = not_null(left.select(key), [key]).distinct()
    return names.join(dimension.select(key).distinct(), key, "left_anti")
