"""The layers bound together: raw tables in, cubes out, everything lazy."""

from __future__ import annotations

from collections.abc import Callable
from copy import copy
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from retaloom.plans import calendar, cubes, curated, trusted
from retaloom.session import as_table
from retaloom.sources.standins import StandIns


class Medallion:
    """Raw, trusted and curated tables by name, derived on demand.

    ``raw`` gives the raw table of a name; with a true second argument it adds a tag
    to every row of the sales table. ``days`` is the frame of calendar days;
    its range is a parameter of the deployment.
    """

    def __init__(self, spark: SparkSession, raw: Callable[..., DataFrame], days: DataFrame):
        self.spark, self._raw, self.days = spark, raw, days
        self.folder: str | None = None  # where the stand-in tables are, if they are
        self._made: dict[tuple[str, str], DataFrame] = {}

    def _once(self, layer: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if (layer, name) not in self._made:
            self._made[layer, name] = make()
        return self._made[layer, name]

    def raw(self, name: str) -> DataFrame:
        return self._once("raw", name, lambda: self._raw(name))

    def trusted(self, name: str) -> DataFrame:
        return self._once("trusted", name, lambda: trusted.RULES[name](self.raw(name)))

    def dim(self, name: str) -> DataFrame:
        makers = {
            "tiempo": lambda: calendar.calendar(self.days),
            "cliente": lambda: curated.dim_cliente(self.trusted("clientes"), self.trusted("ventas")),
            "producto": lambda: curated.dim_producto(self.trusted("productos")),
        }
        make = makers.get(name, lambda: curated.dim_projection(name, self.trusted(name)))
        return self._once("dim", name, make)

    def fact(self, name: str) -> DataFrame:
        makers = {
            "ventas": lambda: curated.fact_ventas(
                self.trusted("ventas"), self.trusted("devoluciones")
            ),
            "inventario": lambda: curated.fact_inventario(self.trusted("inventario")),
            "metas_comercial": lambda: curated.fact_metas_comercial(self.trusted("metas")),
            "metas_operativo": lambda: curated.fact_metas_operativo(
                self.trusted("metas_operativas")
            ),
        }
        return self._once("fact", name, makers[name])

    def small(self, name: str) -> DataFrame:
        """A dimension or target table that is small by nature, written once per query.

        Derived ones are counted out of large tables, and Spark would take them to be as
        large as these; read back, they have their own size, and Spark decides by it.
        """
        kind = self.fact if name.startswith("metas_") else self.dim
        return self._once("small", name, lambda: as_table(kind(name), name))

    def tagged_sales(self, once: bool = False) -> DataFrame:
        """Sales fact with issue date, line id and a deterministic tag per stored row.

        The tag is read only here: it costs a metadata column in the scan.
        """
        sales = trusted.RULES["ventas"](self._raw("ventas", True))
        return curated.fact_ventas(sales, self.trusted("devoluciones"), once)

    def with_table(self, layer: str, name: str, frame: DataFrame) -> Medallion:
        """The same star with another frame for one of its tables."""
        other = copy(self)
        for cube in ("commercial", "invoices", "inventory"):
            other.__dict__.pop(cube, None)
        made = {key: df for key, df in self._made.items() if key != ("small", name)}
        other._made = {**made, (layer, name): frame}
        return other

    def with_fact(self, name: str, frame: DataFrame) -> Medallion:
        """The same star over another fact frame, such as some months of it."""
        return self.with_table("fact", name, frame)

    def between(self, first: str, last: str) -> Medallion:
        """The same star for a range of days, cut at the facts.

        A filter on the attributes of a cube acts after its aggregation; this one
        acts before it, and on stored facts inside the scan.
        """
        low, high = (int(day.replace("-", "")) for day in (first, last))
        star = self
        for name in ("ventas", "inventario"):
            star = star.with_fact(name, star.fact(name).where(F.col("id_fecha").between(low, high)))
        return star

    @cached_property
    def commercial(self) -> DataFrame:
        return cubes.commercial(self)

    @cached_property
    def invoices(self) -> DataFrame:
        return cubes.invoices(self)

    @cached_property
    def inventory(self) -> DataFrame:
        return cubes.inventory(self)


# The calendar range of the stand-in tables.
STANDIN_RANGE = ("1995-01-01", "2001-12-31")


def from_standins(spark: SparkSession, folder: str) -> Medallion:
    """A star of its own for every query: nothing is kept between two of them."""
    source = StandIns(spark, folder)
    star = Medallion(spark, source.read, calendar.days_between(spark, *STANDIN_RANGE))
    star.folder = folder
    return star
