"""Tables that grow batch by batch: finished parts, the list of those that count, and merging of small parts.

A batch writes its rows to folders of its own below ``{path}/_data`` and then a list, ``{path}/_lists/{batch}``, which names all parts that
count from then on. Readers go by the newest list, so what a failed attempt left behind is never read. A batch that runs again
starts from the list before its own and replaces it, so each row counts once.

As soon as ``FANOUT`` small parts of one level are listed, a batch also writes them together as one part of the next level. A row is so
rewritten a logarithmic number of times, and a table of N batches has at most FANOUT parts a level. Parts of ``LARGE`` bytes or more stay as
they are. Folders that neither the newest list nor the one before names are deleted.

One writer at a time, as Structured Streaming guarantees for the batches of a query.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StructType

from scanforge.plans import tables

FANOUT = 8
LARGE = 1 << 30
FILE_BYTES = 128 << 20


@dataclass(frozen=True)
class Part:
    """A folder below ``_data`` and the first and last batch with rows in it."""

    folder: str
    first: int
    last: int
    level: int = 0


@dataclass
class Ledger:
    """One table. ``schema`` is a DDL string; ``partition_by`` columns become folders within a part."""

    spark: SparkSession
    path: str
    schema: str
    partition_by: tuple[str, ...] = ()

    def _list_path(self, batch_id: int) -> str:
        return f"{self.path}/_lists/{batch_id:012d}"

    def versions(self) -> list[int]:
        """Batches that have a list, in order."""
        return sorted(int(n) for n in tables.names_in(self.spark, f"{self.path}/_lists") if n.isdigit())

    def parts(self, before: int | None = None) -> list[Part]:
        """Parts that count, or that did before a batch."""
        known = [v for v in self.versions() if before is None or v < before]
        if not known:
            return []
        return [Part(**p) for p in json.loads(tables.read_text(self.spark, self._list_path(known[-1])))]

    def folder(self, batch_id: int) -> str:
        """A new folder, relative to ``_data``, for an attempt of a batch."""
        return f"{batch_id:012d}-{uuid.uuid4().hex[:12]}"

    def path_of(self, folder: str) -> str:
        return f"{self.path}/_data/{folder}"

    def write(self, df: DataFrame, folder: str) -> None:
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).parquet(self.path_of(folder))

    def load(self, before: int | None = None, first: int | None = None) -> DataFrame:
        """All rows that count; only those of parts with rows of batch ``first`` or later, if it is given."""
        return self._load([p for p in self.parts(before) if first is None or p.last >= first])

    def _load(self, parts: list[Part]) -> DataFrame:
        fields = StructType.fromDDL(self.schema)
        out = self.spark.createDataFrame([], fields)
        # Parts aren't siblings of one table to the reader, since each has partition folders of its own.
        for part in parts:
            rows = self.spark.read.schema(fields).parquet(self.path_of(part.folder)).select(*fields.names)
            out = rows if part is parts[0] else out.unionByName(rows)
        return out

    def append(self, df: DataFrame, batch_id: int) -> None:
        folder = self.folder(batch_id)
        self.write(df, folder)
        self.commit(batch_id, [folder])

    def replace(self, df: DataFrame, batch_id: int) -> None:
        """Make ``df`` the whole table. ``df`` may read the table's earlier state."""
        folder = self.folder(batch_id)
        self.write(df, folder)
        self.commit(batch_id, [folder], keep=False)

    def commit(self, batch_id: int, folders: list[str], keep: bool = True) -> None:
        """List the folders of a finished batch, together with all earlier parts unless ``keep`` is false."""
        parts = self.parts(before=batch_id) if keep else []
        parts = self._merged(parts + [Part(f, batch_id, batch_id) for f in folders], batch_id)
        tables.write_text(self.spark, self._list_path(batch_id), json.dumps([asdict(p) for p in parts]))
        self._clean(batch_id)

    def _merged(self, parts: list[Part], batch_id: int) -> list[Part]:
        level = 0
        while level <= max((p.level for p in parts), default=-1):
            sizes = {p: tables.size_of(self.spark, self.path_of(p.folder)) for p in parts if p.level == level}
            small = [p for p, size in sizes.items() if size < LARGE]
            if len(small) >= FANOUT:
                folder = self.folder(batch_id)
                self.write(self._spread(self._load(small), 1 + sum(sizes[p] for p in small) // FILE_BYTES), folder)
                merged = Part(folder, min(p.first for p in small), max(p.last for p in small), level + 1)
                at = parts.index(small[0])
                parts = [p for p in parts if p not in small]
                parts.insert(min(at, len(parts)), merged)
            level += 1
        return parts

    def _spread(self, rows: DataFrame, n_files: int) -> DataFrame:
        """Rows in ``n_files`` tasks, the rows of one partition folder together unless there is more than one task."""
        if not self.partition_by:
            return rows.coalesce(n_files)
        light = [f.name for f in rows.schema.fields if not isinstance(f.dataType, ArrayType | BinaryType)]
        return rows.repartition(n_files, *self.partition_by, F.pmod(F.xxhash64(*light), F.lit(n_files)))

    def _clean(self, batch_id: int) -> None:
        """Delete lists older than the one before this batch's, and folders that no list names any more."""
        known = self.versions()
        kept = [v for v in known if v <= batch_id][-2:] + [v for v in known if v > batch_id]
        named = {p.folder for v in kept for p in (Part(**x) for x in json.loads(tables.read_text(self.spark, self._list_path(v))))}
        for folder in tables.names_in(self.spark, f"{self.path}/_data"):
            if folder not in named:
                tables.remove(self.spark, self.path_of(folder))
        for v in known:
            if v not in kept:
                tables.remove(self.spark, self._list_path(v))

