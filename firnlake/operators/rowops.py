"""DELETE, UPDATE and MERGE: one distributed plan finds the positions, one commit ends them and adds the new rows."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import MergeError
from ..sources.metastore import Snapshot
from ..sources.paths import remove
from ..sources.scan import FILE, POS, DataFile, TableInfo
from .write import Writer


#: Source keys up to which a merge looks for each in the target's statistics.
FEW_KEYS = 1000
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_KEYS = (*_WHOLE, T.StringType, T.DateType)


def _conjuncts(tree: Any) -> list[Any]:
    if tree.getClass().getSimpleName() == "And":
        return _conjuncts(tree.left()) + _conjuncts(tree.right())
    return [tree]


def _parts(node: Any) -> list[str]:
    """The name's parts, if a parsed expression is a name."""
    if node.getClass().getSimpleName() != "UnresolvedAttribute":
        return []
    return [node.nameParts().apply(i) for i in range(node.nameParts().size())]


def _qualifiers(node: Any) -> list[str]:
    """What the names in a parsed expression begin with."""
    own = _parts(node)[:1]
    return own + [x for i in range(node.children().size()) for x in _qualifiers(node.children().apply(i))]


class RowOps:
    def __init__(self, writer: Writer) -> None:
        self.writer, self.scanner, self.store, self.spark = writer, writer.scanner, writer.store, writer.spark

    @contextmanager
    def once(self) -> Iterator[Any]:
        """A function that writes a frame to a folder beside the data and reads it back, so that all that follows sees the same rows."""
        folders = []

        def keep(df: DataFrame) -> DataFrame:
            folders.append(f"{self.store.data_path}_scratch/{uuid.uuid4().hex}")
            df.write.parquet(folders[-1])
            return self.spark.read.schema(df.schema).parquet(folders[-1])

        try:
            yield keep
        finally:
            for f in folders:
                remove(self.spark, f)

    def delete(self, t: TableInfo, where: str | Column) -> Snapshot | None:
        """Rows where the condition is true go; null is not true. Without a match nothing is committed."""
        with self.once() as keep:
            gone = keep(self.scanner.read(t, where, positions=True).select(FILE, POS))
            return self.writer.apply(t, gone, None)

    def update(self, t: TableInfo, changes: dict[str, Any], where: str | Column | None = None) -> Snapshot | None:
        """Columns take values: Columns as they are, anything else as a literal. One commit, or none without a match."""
        values = {t.column(k).name: v if isinstance(v, Column) else F.lit(v) for k, v in changes.items()}
        with self.once() as keep:
            found = keep(self.scanner.read(t, where if where is not None else F.lit(True), positions=True))
            new = found.select(*(values.get(c.name, F.col(f"`{c.name}`")).cast(c.spark_type).alias(c.name) for c in t.columns))
            return self.writer.apply(t, found.select(FILE, POS), new)


@dataclass
class _Clause:
    matched: bool
    action: str  # update, update_all, delete, insert or insert_all
    condition: str | None = None
    values: dict[str, Any] = field(default_factory=dict)


class _When:
    def __init__(self, merge: Merge, matched: bool, condition: str | None) -> None:
        self._merge, self._matched, self._condition = merge, matched, condition

    def _add(self, action: str, values: dict[str, Any] | None = None) -> Merge:
        self._merge.clauses.append(_Clause(self._matched, action, self._condition, values or {}))
        return self._merge

    def update_all(self) -> Merge:
        """Columns of the source; those that it lacks keep their values."""
        return self._add("update_all")

    def update(self, values: dict[str, Any]) -> Merge:
        """Table columns by expression: SQL over source.x and target.x, or a Column."""
        return self._add("update", values)

    def delete(self) -> Merge:
        return self._add("delete")

    def insert_all(self) -> Merge:
        return self._add("insert_all")

    def insert(self, values: dict[str, Any]) -> Merge:
        """Table columns by expression over source.x; the others are null."""
        return self._add("insert", values)


class Merge:
    """MERGE: clauses in order, the first whose condition is true decides. A target row may match one source row only.

    Null keys match nothing. A source row whose key matches is never inserted, whatever the clauses' conditions say.
    """

    def __init__(self, ops: RowOps, table: TableInfo) -> None:
        self.ops, self.table, self.clauses = ops, table, []
        self.source: DataFrame | None = None
        self.condition: str | None = None
        self.equalities: list[tuple[Any, Any]] = []

    def using(self, source: DataFrame) -> Merge:
        self.source = source
        return self

    def on(self, condition: str) -> Merge:
        """Equalities over target.x and source.x, joined by AND."""
        session = self.ops.spark._jsparkSession
        try:
            tree = session.sessionState().sqlParser().parseExpression(condition)
        except Exception as e:
            raise MergeError(f"ON can't be parsed: {condition!r}") from e
        self.equalities = []
        for node in _conjuncts(tree):
            if node.getClass().getSimpleName() != "EqualTo":
                raise MergeError(f"ON must be equalities joined by AND: {node.sql()!r}")
            self.equalities.append((node.left(), node.right()))
        self.condition = condition
        return self

    def when_matched(self, condition: str | None = None) -> _When:
        return _When(self, True, condition)

    def when_not_matched(self, condition: str | None = None) -> _When:
        return _When(self, False, condition)

    @staticmethod
    def _expr(value: Any) -> Column:
        return value if isinstance(value, Column) else F.expr(value) if isinstance(value, str) else F.lit(value)

    @staticmethod
    def _first(clauses: list[_Clause]) -> Column:
        """The number of the first clause whose condition is true; null if none."""
        out = None
        for i, c in enumerate(clauses):
            test = F.expr(c.condition) if c.condition else F.lit(True)
            out = F.when(test, i) if out is None else out.when(test, i)
        return out if out is not None else F.lit(None).cast("int")

    def _values(self, clauses: list[_Clause], names: dict[str, str], matched: bool) -> list[Column]:
        """Each table column's new value by the clause in _clause. names: the source's columns by lower case."""
        out = []
        for c in self.table.columns:
            value = None
            for i, clause in enumerate(clauses):
                own = {self.table.column(k).name: v for k, v in clause.values.items()}
                keep = F.col(f"target.`{c.name}`") if matched else F.lit(None)
                if clause.action in ("update_all", "insert_all"):
                    new = F.col(f"source.`{names[c.name.lower()]}`") if c.name.lower() in names else keep
                else:
                    new = self._expr(own[c.name]) if c.name in own else keep
                new = new.cast(c.spark_type)
                value = F.when(F.col("_clause") == i, new) if value is None else value.when(F.col("_clause") == i, new)
            out.append((value if value is not None else F.lit(None).cast(c.spark_type)).alias(c.name))
        return out

    def _files(self, source: DataFrame) -> list[DataFile] | None:
        """The target's files that may hold a key of source (kept, with rows), by the keys if they are few, else by their least and largest."""
        where = None
        for left, right in self.equalities:
            for a, b in ((left, right), (right, left)):
                names, other = _parts(a), b.sql()
                if len(names) != 2 or names[0].lower() != "target" or "target" in {x.lower() for x in _qualifiers(b)}:
                    continue
                c = self.table.column(names[1])
                key = source.alias("source").select(F.expr(other).alias("k"))
                kind = key.schema["k"].dataType
                if not isinstance(kind, _KEYS) or not (isinstance(kind, type(c.spark_type)) or isinstance(kind, _WHOLE) and isinstance(c.spark_type, _WHOLE)):
                    continue
                few = [r["k"] for r in key.filter("k IS NOT NULL").distinct().limit(FEW_KEYS + 1).collect()]
                if len(few) <= FEW_KEYS:
                    own = F.col(f"`{c.name}`").isin(few) if few else F.lit(False)
                else:
                    ends = key.agg(F.min("k").alias("a"), F.max("k").alias("b")).first()
                    own = F.col(f"`{c.name}`").between(ends["a"], ends["b"])
                where = own if where is None else where & own
                break
        return None if where is None else self.ops.scanner.plan(self.table, where).files

    def execute(self) -> Snapshot | None:
        if self.source is None or not self.condition or not self.clauses:
            raise MergeError("a merge needs a source, ON and at least one WHEN clause")
        on_match, on_miss = ([c for c in self.clauses if c.matched is m] for m in (True, False))
        names = {c.lower(): c for c in self.source.columns}
        with self.ops.once() as keep:
            source = keep(self.source.withColumn("_source_row", F.monotonically_increasing_id()))
            if not source.limit(1).count():
                return None
            target = self.ops.scanner.read(self.table, positions=True, files=self._files(source))
            both = target.alias("target").join(source.alias("source"), F.expr(self.condition)).withColumn("_clause", self._first(on_match))
            updates = [i for i, c in enumerate(on_match) if c.action.startswith("update")]
            both = keep(both.select(FILE, POS, "_source_row", "_clause", *self._values(on_match, names, True)))
            twice = both.groupBy(FILE, POS).count().filter("count > 1").limit(1).collect()
            if twice:
                raise MergeError("a target row matches more than one source row")
            columns = [F.col(f"`{c.name}`") for c in self.table.columns]
            gone = both.filter("_clause IS NOT NULL").select(FILE, POS)
            new = both.filter(F.col("_clause").isin(updates)).select(*columns)
            if on_miss:
                missed = source.join(both.select("_source_row"), "_source_row", "left_anti").alias("source").withColumn("_clause", self._first(on_miss))
                new = new.unionByName(missed.filter("_clause IS NOT NULL").select(*self._values(on_miss, names, False)))
            return self.ops.writer.apply(self.table, gone, new)
