"""Star joins and cubes that shuffle surrogate keys instead of attributes."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F


def _hash(names: list[str]) -> Column:
    # Hashing skips NULLs, so which attributes are NULL is hashed as well.
    return F.xxhash64(*names, *[F.col(n).isNull() for n in names])


@dataclass(frozen=True)
class Dim:
    """A dimension taking part in a cube.

    ``unique`` states that no two keys share the same attribute values, as with the
    calendar by day. Other dimensions are grouped by a digest of their attributes and the
    place of the attributes among all that have this digest, which is 1 unless digests
    collide. So the result equals grouping by the attributes themselves, whatever ``digest`` gives.
    """

    frame: DataFrame
    key: str
    attrs: list[str | Column]
    unique: bool = False
    small: bool = False  # size fixed by a parameter, as the calendar by its range
    large: bool = False  # grows with the facts, as products do
    digest: Callable[[list[str]], Column] = _hash

    @cached_property
    def names(self) -> list[str]:
        return self.frame.select(*self.attrs).columns

    @property
    def groups(self) -> list[str]:
        """Columns a cube groups by: the key itself, or the digest and place of what it stands for."""
        return [self.key] if self.unique else [f"_group_{self.key}", f"_nth_{self.key}"]

    def only(self, levels: Collection[str]) -> Dim:
        """The dimension with no other attributes than these; keys may then share them."""
        if set(self.names) <= set(levels):
            return self
        kept = [a for a, n in zip(self.attrs, self.names) if n in levels]
        return replace(self, attrs=kept, unique=False)

    def told_apart(self) -> Dim:
        """The dimension as ``unique`` if each row has a key and attributes of its own, which one
        pass over it tells; for dimensions that are small and stored."""
        rows = self.frame.select(F.col(self.key), *self.attrs).where(F.col(self.key).isNotNull())
        n, keys, values = rows.agg(
            F.count(F.lit(1)), F.count_distinct(self.key), F.count_distinct(F.struct(*self.names))).first()
        return replace(self, unique=True) if n == keys == values else self

    def _sized(self, rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if self.small else rows

    @cached_property
    def _rows(self) -> DataFrame:
        """key, group and attributes of every row."""
        rows = self.frame.select(F.col(self.key), *self.attrs).where(F.col(self.key).isNotNull())
        if self.unique or not self.names:
            return rows
        group, nth = self.groups
        rows = rows.withColumn(group, self.digest(self.names))
        shared = (
            rows.groupBy(F.col(group).alias("_shared"))
            .agg(F.sort_array(F.collect_set(F.struct(*self.names))).alias("_all")).where(F.size("_all") > 1))
        place = F.coalesce(F.array_position("_all", F.struct(*self.names)), F.lit(1))
        return rows.join(shared, F.col(group) == F.col("_shared"), "left").withColumn(nth, place).drop(
            "_shared", "_all")

    def keyed(self) -> DataFrame:
        """key and group of every row; the key alone where no attribute is wanted."""
        if not self.names:
            return self._sized(self._rows.select(self.key))
        return self._sized(self._rows.select(*dict.fromkeys([self.key, *self.groups])))

    def attributes(self) -> DataFrame:
        """group and attributes, one row per group."""
        rows = self._rows.select(*self.groups, *self.names)
        return self._sized(rows if self.unique else rows.dropDuplicates(self.groups))


def star_cube(
    fact: DataFrame, dims: list[Dim], measures: list[Column], levels: Collection[str] | None = None,
    also: Sequence[str] = (), later: Callable[[DataFrame], DataFrame] | None = None,
    gathered: Callable[[DataFrame, list[str]], DataFrame] | None = None,
) -> DataFrame:
    """Group a fact by the attributes of its dimensions, or by those named in ``levels``, and
    by the columns of its own that ``also`` names.

    The shuffle carries one number per dimension and the measures, combined before
    it. Attributes, which are many and wide, are attached to the aggregated rows
    only. A fact row without a partner drops out, as in an inner join; a dimension
    of which no attribute is wanted is joined by its key for that alone. Large dimensions are
    joined first, before the small ones widen the rows that a join by key has to shuffle.
    ``later`` may add columns to the aggregated rows by their groups. ``gathered`` is given the
    rows and the dimensions' groups before they are aggregated, and gives those to aggregate.
    """
    if levels is not None:
        dims = [dim.only(levels) for dim in dims]
    large_first = sorted(dims, key=lambda dim: not dim.large)
    for dim in large_first:
        if not dim.unique:
            fact = fact.join(dim.keyed(), dim.key)
    dims = [dim for dim in dims if dim.names]
    groups = [g for dim in dims for g in dim.groups]
    if gathered is not None:
        fact = gathered(fact, groups)
    groups += also
    cube = fact.groupBy(*groups).agg(*measures)
    for dim in large_first:
        if dim.names:
            cube = cube.join(dim.attributes(), dim.groups)
    if later is not None:
        cube = later(cube)
    names = [n for dim in dims for n in dim.names]
    made = [c for c in cube.columns if c not in names and c not in groups]
    return cube.select(*names, *also, *made)


def roll_up(cube: DataFrame, levels: list[str], sums: list[str]) -> DataFrame:
    """Sums at every level of a hierarchy in one job; NULL marks a rolled-up level.

    The cube is first summed at the finest level, so the rows that the roll-up
    copies once per level are those of the hierarchy, not those of the cube.
    """
    finest = cube.groupBy(*levels).agg(*[F.sum(c).alias(c) for c in sums])
    return finest.rollup(*levels).agg(
        *[F.sum(c).cast("double").alias(c) for c in sums], F.grouping_id().alias("nivel"))
