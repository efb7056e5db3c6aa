"""Many checks over few scans: each table is read once, and all that its checks count goes through one grouping.

An entry says which rows it counts and by what: nothing (a rule), a group such as a month, a value such as a key, or both. A row
of the table becomes one small row for each entry it meets, and equal ones are counted before the shuffle. The tally is
written once; sums by entry, by group, and comparisons of the values of two entries are taken from it.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import exprs as X
from tallyline.sources.lake import Scratch


@dataclass(frozen=True)
class Entry:
    """What to count of a table. With ``repeats`` only values that occur more than once are kept."""

    name: str
    when: Column | None = None
    group: Column | None = None
    value: Column | None = None
    units: Column | None = None
    repeats: bool = False

    def row(self) -> Column:
        text = lambda c: F.lit(None).cast("string") if c is None else c.cast("string")
        units = F.lit(0) if self.units is None else F.coalesce(self.units, F.lit(0))
        made = F.struct(F.lit(self.name).alias("name"), text(self.group).alias("grp"), text(self.value).alias("value"), units.cast("bigint").alias("units"))
        return made if self.when is None else F.when(self.when, made)


def key(name: str, column: str | None = None, repeats: bool = False) -> Entry:
    """The non-null values of a column."""
    c = F.col(column or name)
    return Entry(name, c.isNotNull(), value=c, repeats=repeats)


class Tally:
    """(table_name, name, grp, value, rows, units) of all entries, written, with the sums that checks need.

    The sums have one row for each entry, the group sums one for each entry and group; both are brought to the driver, so
    groups must be few (months). Values stay distributed.
    """

    def __init__(self, tables: dict[str, tuple[DataFrame, list[Entry]]], scratch: Scratch):
        parts = []
        for table, (df, entries) in tables.items():
            made = F.filter(F.array(*[e.row() for e in entries]), lambda x: x.isNotNull())
            counts = df.select(F.inline(made)).groupBy("name", "grp", "value").agg(F.count(F.lit(1)).alias("rows"), F.sum("units").alias("units"))
            single = [e.name for e in entries if e.repeats]
            if single:
                counts = counts.filter(~F.col("name").isin(single) | (F.col("rows") > 1))
            parts.append(counts.select(F.lit(table).alias("table_name"), "*"))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        self.rows_ = scratch.write(out)
        self._sums: dict[tuple[str, str], dict] | None = None

    def _sum(self, table: str, name: str) -> dict:
        if self._sums is None:
            one = self.rows_.groupBy("table_name", "name").agg(
                F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("groups"), F.sum("units").alias("units"),
                X.count_if((F.col("rows") > 1) & F.col("value").isNotNull()).alias("repeated"))
            self._sums = defaultdict(lambda: {"rows": 0, "groups": 0, "units": 0, "repeated": 0})
            self._sums.update({(r["table_name"], r["name"]): r.asDict() for r in one.collect()})
        return self._sums[table, name]

    def rows(self, table: str, name: str) -> int:
        """Counted rows."""
        return self._sum(table, name)["rows"]

    def distinct(self, table: str, name: str) -> int:
        """Different (group, value)."""
        return self._sum(table, name)["groups"]

    def repeated(self, table: str, name: str) -> int:
        """Values that occur more than once."""
        return self._sum(table, name)["repeated"]

    def units(self, table: str, name: str) -> int:
        return self._sum(table, name)["units"] or 0

    def by_group(self, *names: tuple[str, str]) -> dict[tuple[str, str], dict]:
        """For each (table, entry): group -> (rows, different values, units), in one job."""
        wanted = F.struct("table_name", "name").isin(*[F.struct(F.lit(t), F.lit(n)) for t, n in names])
        rows = self.rows_.filter(wanted).groupBy("table_name", "name", "grp").agg(
            F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("values"), F.sum("units").alias("units")).collect()
        out: dict = {n: {} for n in names}
        for r in rows:
            out[r["table_name"], r["name"]][r["grp"]] = (r["rows"], r["values"], r["units"])
        return out

    def against(self, pairs: list[tuple[tuple[str, str], tuple[str, str]]]) -> list[dict]:
        """For each (child entry, parent entry): values and rows of the child without a parent, the parent's rows, and those in use.

        All pairs share one grouping by (pair, value).
        """
        sides = [(t, n, k, side) for k, pair in enumerate(pairs) for side, (t, n) in enumerate(pair)]
        named = self.rows_.sparkSession.createDataFrame(sides, "table_name string, name string, pair int, side int")
        met = self.rows_.filter("value IS NOT NULL").join(F.broadcast(named), ["table_name", "name"])
        each = met.groupBy("pair", "value").agg(F.sum(F.when(F.col("side") == 0, F.col("rows"))).alias("child"), F.sum(F.when(F.col("side") == 1, F.col("rows"))).alias("parent"))
        alone = F.col("parent").isNull()
        one = each.groupBy("pair").agg(
            X.count_if(alone).alias("orphan_values"), F.coalesce(F.sum(F.when(alone, F.col("child"))), F.lit(0)).alias("orphan_rows"),
            F.coalesce(F.sum("parent"), F.lit(0)).alias("members"), X.count_if(F.col("child").isNotNull()).alias("used"))
        found = {r["pair"]: r.asDict() for r in one.collect()}
        none = {"orphan_values": 0, "orphan_rows": 0, "members": 0, "used": 0}
        return [found.get(k, none) for k in range(len(pairs))]
