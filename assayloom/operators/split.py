"""Exact-size, reproducible samples and group-aware hold-outs.

A row's place in a draw is the md5 of the seed and its id, so a draw of k rows
is "every row whose key is at most the k-th smallest key". That k-th key is
sought where evenly spread keys put it, in one pass, and found exactly by
counting; the split itself is then a comparison with a constant: no sort, no
shuffle of the rows and no single-task limit, however large k.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayloom.session import materialise

_DIGITS = 3          # hex digits per counting round: at most 4096 counts per draw reach the driver
_FINAL = 10_000      # a prefix with at most this many keys is finished by reading them
_KEY_WIDTH = 32      # hex digits of an md5
_SPREAD = 8          # standard deviations on both sides of a cut's expected place that are looked through first
_BELOW, _ABOVE = "", "~"    # in place of keys known to be below or above all hex keys looked through


def draw_key(ids: Sequence[str], seed: int | str) -> Column:
    """The draw key of a row: hex md5 of ``seed:id[:id...]``."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ids]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


@dataclass
class Draw:
    """Rows to draw from, their key, how many of n rows to draw, n itself if known, and the search so far."""

    rows: Column
    key: Column
    size: Callable[[int], int]
    n: int | None = None
    prefix: str = ""
    left: int | None = None
    cut: str | None = None

    def begin(self, n: int) -> None:
        """Fix the size of the draw; none of the rows needs no search."""
        self.n, self.left = n, self.size(n)
        if self.left > n:
            raise ValueError(f"cannot draw {self.left} of {n} rows")
        if self.left <= 0:
            self.left, self.cut = 0, ""

    def around(self) -> tuple[str, str]:
        """The keys (from, below) that hold the cut of evenly spread keys, ``_SPREAD`` deviations on both sides."""
        share = self.left / self.n
        reach = _SPREAD * (math.sqrt(share * (1 - share) / self.n) + 1 / self.n)
        low, high = (int(max(x, 0.0) * (1 << 52)) << 76 for x in (share - reach, share + reach))
        return f"{low:032x}", f"{high:032x}" if share + reach < 1 else _ABOVE

    def narrow(self, bars: list[tuple[str, int]]) -> bool:
        """Take counts by prefix, smallest first; True when the prefix is short enough to read."""
        for prefix, count in bars:
            if self.left <= count:
                break
            self.left -= count
        self.prefix = prefix
        if len(prefix) == _KEY_WIDTH:
            self.close([(prefix, count)])
        return count <= _FINAL

    def close(self, keys: list[tuple[str, int]]) -> None:
        """Take the cut from the sorted keys in question and their rows; rows on both sides of it with one key cannot be told apart."""
        for key, count in keys:
            if self.left <= count:
                break
            self.left -= count
        self.cut = key
        if self.left < count:
            raise ValueError("ids are not unique: rows that share theirs would exceed the size of the draw")


def _by(pairs):
    return reduce(lambda expr, p: expr.when(p[0], p[1]), pairs[1:], F.when(*pairs[0]))


def kth_keys(rows: DataFrame, draws: Sequence[Draw]) -> list[str]:
    """Per draw, the largest of the ``size(n)`` smallest keys among its n rows; '' for none.

    Draws must not share rows. Rows are counted first, without their keys (not
    where n is given). Keys are hex and evenly spread, so the k-th of n lies near
    k / n of their range: one pass makes the keys of all draws, counts those
    below that place and stores the few about it (some 16 * sqrt(n) at most),
    among which the cut is found. A cut that does not lie there, as ids that
    repeat often can bring about, is sought in the whole table.
    Rows that share their ids are drawn together; where the draw's size would
    part them, that is an error.
    """
    tagged = rows.select(
        _by([(d.rows, F.lit(i)) for i, d in enumerate(draws)]).alias("_draw"),
        _by([(d.rows, d.key) for d in draws]).alias("_key"),
    ).where("_draw is not null")
    if any(d.n is None for d in draws):
        sizes = {r["_draw"]: r["count"] for r in tagged.groupBy("_draw").count().collect()}
    for i, d in enumerate(draws):
        d.begin(sizes.get(i, 0) if d.n is None else d.n)
    sought = {i: d for i, d in enumerate(draws) if d.cut is None}
    if not sought:
        return [d.cut for d in draws]

    key, bounds = F.col("_key"), {i: d.around() for i, d in sought.items()}
    low, high = (_by([(F.col("_draw") == i, F.lit(b[end])) for i, b in bounds.items()]) for end in (0, 1))
    zoned = tagged.select("_draw", F.when(key < low, _BELOW).when(key < high, key).otherwise(_ABOVE).alias("_key"))
    # No filter: it would be pushed below the keys and make them twice.
    near = materialise(zoned.groupBy("_draw", "_key").agg(F.count(F.lit(1)).alias("_n")), "draw")
    outside = key.isin(_BELOW, _ABOVE)
    sums = {(r["_draw"], r["_zone"]): r["_n"] for r in near.groupBy(
        "_draw", F.when(outside, key).alias("_zone")).agg(F.sum("_n").alias("_n")).collect()}
    met = {}
    for i, d in sought.items():
        below = sums.get((i, _BELOW), 0)
        if below < d.left <= below + sums.get((i, None), 0):
            d.left -= below
            met[i] = d
    _search(near.where(~outside), met)
    _search(tagged.withColumn("_n", F.lit(1)), {i: d for i, d in sought.items() if i not in met})
    return [d.cut for d in draws]


def _search(keys: DataFrame, draws: dict[int, Draw]) -> None:
    """Find the cuts of ``draws`` among (_draw, _key, _n): every pass divides the keys still in question by 4096, for all draws at once."""
    def within(ids):
        return keys.where(reduce(
            lambda a, b: a | b,
            [(F.col("_draw") == i) & F.col("_key").startswith(draws[i].prefix) for i in ids],
        ))

    searching, short = list(draws), []
    width = 0
    while searching:
        width += _DIGITS
        counts = (
            within(searching).groupBy("_draw", F.substring("_key", 1, width).alias("p"))
            .agg(F.sum("_n").alias("n")).collect()
        )
        for i in searching:
            if draws[i].narrow(sorted((r["p"], r["n"]) for r in counts if r["_draw"] == i)):
                short.append(i)
        searching = [i for i in searching if i not in short and draws[i].cut is None]
    short = [i for i in short if draws[i].cut is None]
    if short:
        # At most _FINAL rows per draw, as counted.
        found = {i: Counter() for i in short}
        for r in within(short).collect():
            found[r["_draw"]][r["_key"]] += r["_n"]
        for i in short:
            draws[i].close(sorted(found[i].items()))


def kth_key(rows: DataFrame, key: Column, size: Callable[[int], int], n: int | None = None) -> str:
    """``kth_keys`` of a single draw."""
    return kth_keys(rows, [Draw(F.lit(True), key, size, n)])[0]


def floor_of(fraction: float) -> Callable[[int], int]:
    """Draw size: the whole part of a fraction."""
    return lambda n: int(fraction * n)


def ceil_of(fraction: float) -> Callable[[int], int]:
    """Draw size: a fraction rounded up."""
    return lambda n: math.ceil(fraction * n)


def exact_sample(df: DataFrame, ids: Sequence[str], size: int | Callable[[int], int], seed: int | str) -> DataFrame:
    """Exactly ``size`` rows without replacement, the same rows on every run.

    ``ids`` must tell rows apart: rows that share theirs are drawn together, and
    a draw that would so exceed its size is an error.
    """
    key = draw_key(ids, seed)
    wanted = size if callable(size) else (lambda n: size)
    drawn = df.where(key <= F.lit(kth_key(df, key, wanted)))
    twice = drawn.groupBy(*[F.col(f"`{c}`") for c in ids]).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{list(ids)} are not unique, for example {tuple(twice[0])[:-1]}")
    return drawn


def two_way_split(df: DataFrame, ids: Sequence[str], test_fraction: float, seed: int | str) -> DataFrame:
    """A ``split`` column: ceil(test_fraction * n) rows are 'test', the rest 'train'.

    Rows that share their ids stay together; if the sizes do not allow it, ValueError
    (so too in ``nested_split`` and ``group_holdout``).
    """
    key = draw_key(ids, seed)
    cut = kth_key(df, key, ceil_of(test_fraction))
    return df.withColumn("split", F.when(key <= F.lit(cut), "test").otherwise("train"))


def nested_split(
    df: DataFrame, ids: Sequence[str], test_fraction: float, val_fraction: float, seed: int | str
) -> DataFrame:
    """train/val/test: the validation rows are drawn from what the test draw left."""
    test = draw_key(ids, f"{seed}-test") <= F.lit(
        kth_key(df, draw_key(ids, f"{seed}-test"), ceil_of(test_fraction))
    )
    val_key = draw_key(ids, f"{seed}-val")
    val = val_key <= F.lit(kth_key(df.where(~test), val_key, ceil_of(val_fraction)))
    return df.withColumn("split", F.when(test, "test").when(val, "val").otherwise("train"))


def group_holdout(
    df: DataFrame,
    ids: Sequence[str],
    group: str,
    majority: Iterable,
    minority: Iterable,
    seed: int | str,
    minority_train: float = 0.1,
    test_fraction: float = 0.0,
    val_fraction: float = 0.0,
) -> DataFrame:
    """Train mostly on the majority groups, test mostly on the minority groups.

    floor(minority_train * n) minority rows join the training set and the other
    minority rows are test. With ``test_fraction`` / ``val_fraction`` the
    majority rows are first divided as in ``nested_split``; without, all of them
    are training rows. Rows of neither group are left out.
    """
    majority, minority = list(majority), list(minority)
    if set(majority) & set(minority):
        raise ValueError("a group cannot be both majority and minority")
    is_major = F.col(f"`{group}`").isin(majority)
    is_minor = F.col(f"`{group}`").isin(minority)
    minor_key, test_key, val_key = (draw_key(ids, f"{seed}-{part}") for part in ("minority", "test", "val"))
    draws = [Draw(is_minor, minor_key, floor_of(minority_train))]
    if test_fraction:
        draws.append(Draw(is_major, test_key, ceil_of(test_fraction)))
    cuts = kth_keys(df, draws)
    split = F.when(is_minor & (minor_key <= F.lit(cuts[0])), "train").when(is_minor, "test")
    is_test = test_key <= F.lit(cuts[1]) if test_fraction else F.lit(False)
    split = split.when(is_major & is_test, "test")
    if val_fraction:
        rest = draws[1].n - draws[1].size(draws[1].n) if test_fraction else None
        cut = kth_key(df.where(is_major & ~is_test), val_key, ceil_of(val_fraction), rest)
        split = split.when(is_major & (val_key <= F.lit(cut)), "val")
    split = split.when(is_major, "train")
    return df.where(is_major | is_minor).withColumn("split", split)


def split_summary(df: DataFrame, features: str, targets: str) -> DataFrame:
    """(label, value): rows per split, and the lengths of the feature and target arrays, from one pass."""
    def rows(name):
        return F.count(F.when(F.col("split") == name, 1))

    def line(label, value):
        return F.struct(F.lit(label).alias("label"), value.alias("value"))

    one = df.agg(rows("train").alias("train"), rows("val").alias("val"), rows("test").alias("test"),
                 F.max(F.size(features)).alias("features"), F.max(F.size(targets)).alias("targets"))
    return one.select(F.inline(F.array(
        line("n_train", F.col("train")),
        line("n_val", F.col("val")),
        line("n_test", F.col("test")),
        line("n_features", F.col("features").cast("long")),
        line("n_targets", F.col("targets").cast("long")),
    )))
