"""A set of stored dimensions that refer to each other (S16): parents load before
children, deletes run in reverse, and neither leaves a reference without its row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.errors import ValidationError
from almanac.operators.joins import DimensionTable
from almanac.operators.store import stored
from almanac.session import settle


@dataclass(frozen=True)
class Dimension:
    """``key`` is the natural key; ``refers`` maps a column to the (dimension, column)
    that must hold its value. A null refers to nothing."""
    name: str
    key: Sequence[str]
    refers: Mapping[str, tuple[str, str]] = field(default_factory=dict)


class DimensionSet:
    def __init__(self, spark: SparkSession, root: str, dimensions: Sequence[Dimension]):
        self.spark, self.root = spark, root
        self.dimensions = {d.name: d for d in dimensions}
        unknown = {p for d in dimensions for p, _ in d.refers.values()} - set(self.dimensions)
        if unknown:
            raise ValidationError(f"dimensions refer to unknown ones: {sorted(unknown)}")

    def order(self) -> list[str]:
        """Names, parents first; those that don't depend on each other as declared.
        Dimensions that refer in a circle are an error (``graphlib.CycleError``)."""
        sorter = TopologicalSorter()
        for d in self.dimensions.values():  # a dimension may refer to itself
            sorter.add(d.name, *sorted({p for p, _ in d.refers.values()} - {d.name}))
        sorter.prepare()
        declared, out = list(self.dimensions), []
        while sorter.is_active():
            ready = sorted(sorter.get_ready(), key=declared.index)
            out += ready
            sorter.done(*ready)
        return out

    def table(self, name: str) -> DimensionTable:
        return DimensionTable(self.spark, f"{self.root}/{name}", list(self.dimensions[name].key))

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()

    @staticmethod
    def _lost(rows: DataFrame, column: str, parent: DataFrame, parent_column: str) -> list:
        """A few values of a column that the parent doesn't hold."""
        held = parent.select(F.col(parent_column).alias("__held")).distinct()
        lost = rows.where(F.col(column).isNotNull()).join(held, F.col(column) == F.col("__held"), "left_anti")
        return [r[0] for r in lost.select(column).distinct().limit(5).collect()]

    def load(self, frames: Mapping[str, DataFrame]) -> list[str]:
        """Load new rows of any of the dimensions, parents first whatever order they are
        given in; rows whose key is stored are left alone and keep their ids. A row that
        refers to nothing stored or loaded before is an error, before its dimension is
        written. Returns the names in the order they were loaded."""
        done = []
        for name in self.order():
            if name not in frames:
                continue
            rows = frames[name]
            for column, (parent, parent_column) in self.dimensions[name].refers.items():
                held = self.read(parent) if parent != name else self._with(name, rows)
                lost = self._lost(rows, column, held, parent_column)
                if lost:
                    raise ValidationError(f"{name}.{column} refers to {parent} rows that don't exist: {lost}")
            self.table(name).load(rows)
            done.append(name)
        return done

    def _with(self, name: str, rows: DataFrame) -> DataFrame:
        columns = rows.columns
        return stored(self.spark, f"{self.root}/{name}", rows.schema).select(*columns).unionByName(rows)

    def delete(self, names: Sequence[str] | None = None, facts: Mapping[str, Sequence[tuple[DataFrame, str, str]]] | None = None) -> list[str]:
        """Delete the rows of the given dimensions (all by default), children first.
        ``facts`` lists per dimension (frame, column, dimension column) of facts that
        refer to it. A dimension that facts, or rows of a dimension that stays, refer to is
        refused before anything is deleted. Returns the names in the order of deletion."""
        going = [n for n in reversed(self.order()) if names is None or n in names]
        tables = {n: self.table(n) for n in self.dimensions}
        there = {n: t.read() for n, t in tables.items() if t.exists()}
        for name in going:
            if name not in there:
                continue
            users = [(f"facts ({column})", frame, column, own) for frame, column, own in (facts or {}).get(name, ())]
            users += [(other, there[other], column, parent_column) for other, d in self.dimensions.items() if other not in going and other in there
                      for column, (parent, parent_column) in d.refers.items() if parent == name]
            for user, frame, column, own in users:
                if not frame.join(there[name].select(F.col(own).alias("__own")), F.col(column) == F.col("__own"), "left_semi").isEmpty():
                    raise ValidationError(f"{name} can't be deleted: {user} still refer to its rows")
        for name in going:
            if name in there:
                settle(there[name].limit(0), "dimension").write.mode("overwrite").parquet(tables[name].path)
        return going

    def bootstrap(self, frames: Mapping[str, DataFrame], delete_first: bool = False,
                  facts: Mapping[str, Sequence[tuple[DataFrame, str, str]]] | None = None) -> dict[str, DataFrame]:
        """Load all dimensions, or with ``delete_first`` delete them all and load anew
        (ids begin again). Returns the stored dimensions."""
        if delete_first:
            self.delete(facts=facts)
        self.load(frames)
        return {n: self.read(n) for n in self.order() if self.table(n).exists()}
