"""Replacement of many slices of many tables as one commit, which a crash leaves either undone or to be finished.

1. *Stage.* Every table's new rows are written once, into a folder of the commit's own beside the slices. The slices that
   they make are read off the folders, so a source is never evaluated to find them.
2. *Switch.* A manifest that names, for every slice, where it lies and where it shall lie, gets its final name. This one
   rename is the commit: before it the new rows are nothing, after it they are what the tables hold.
3. *Apply.* The catalog is pointed at the new folders, slice by slice. Files are neither moved nor copied.
4. *Close.* The manifest is marked as applied. Manifests stay: they say which folder a slice lies in, also when the catalog
   is dropped and built again.

``recover`` undoes commits that never switched (their folders go) and applies those that did. A slice that a later commit
has taken meanwhile keeps the later one. It is run before every commit, and may be run at any time; undoing is for when no
other writer is at work, as commits that are still staging look like those that crashed there.

Replaced folders stay readable until ``vacuum``, so queries that began before the switch finish on the old slices.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ouvidoria.schemas import ALL_TABLES, SLICE_KEY, TableSpec
from ouvidoria.session import Files, require_ref
from ouvidoria.sources.tables import Warehouse, as_list

# Hidden from readers of a table's folder, as names with an underscore are.
_VERSIONS = "_versions"
# Slices in one statement to the catalog.
_AT_ONCE = 200
_SWITCHED, _APPLIED = ".switched.json", ".applied.json"


@dataclass
class Move:
    """One slice of one table: the folder it lay in, and the one it goes to; None is no slice at all."""

    table: str
    ref: str
    old: str | None
    new: str | None


@dataclass
class Commit:
    """One commit in the making. Names sort in the order in which commits began."""

    commits: Commits
    name: str = field(default_factory=lambda: f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}")
    moves: list[Move] = field(default_factory=list)

    def stage(self, frames: dict[TableSpec, DataFrame], refs: str | Iterable[str] | None = None) -> dict[TableSpec, DataFrame]:
        """Write new slices of these tables aside, and give their rows as they lie there.

        Slices named in ``refs`` for which a table gets no row are removed from it; a row of any other slice is an error.
        Without ``refs`` each table's slices are those that occur in its rows.
        """
        wanted, spark = as_list(refs), self.commits.wh.spark
        with ThreadPoolExecutor(max_workers=max(1, len(frames))) as pool:
            run = inheritable_thread_target(spark)(self._stage_one)
            parts = {spec: pool.submit(run, spec, df, wanted) for spec, df in frames.items()}
        return {spec: part.result() for spec, part in parts.items()}

    def _stage_one(self, spec: TableSpec, df: DataFrame, wanted: list[str] | None) -> DataFrame:
        wh, files, key = self.commits.wh, self.commits.files, F.col(SLICE_KEY)
        rows = wh.only(spec, spec.conform(df, stored=True), key.isNotNull() if wanted is None else key.isin(wanted))
        folder = self.commits.folder(spec, self.name)
        rows.hint("rebalance", SLICE_KEY).write.partitionBy(SLICE_KEY).parquet(folder)
        place = {n.partition("=")[2]: f"{folder}/{n}" for n in files.names(folder) if n.startswith(f"{SLICE_KEY}=")}
        held = self.commits.catalog(spec)
        refs = sorted({*place, *(wanted or [])})
        self.moves += [Move(spec.full_name, ref, held.get(ref), place.get(ref)) for ref in refs]
        declared = ", ".join(f"{name} {dtype}" for name, dtype in spec.stored_columns())
        return wh.spark.read.schema(declared).parquet(folder).select(*spec.column_names)

    def check(self) -> None:
        """Slices that another commit took while this one was staged are an error: one of the two must run again."""
        for spec, moves in self.commits.by_table(self.moves):
            held = self.commits.catalog(spec)
            if taken := [m.ref for m in moves if held.get(m.ref) != m.old]:
                raise RuntimeError(f"{spec.full_name}: slices replaced meanwhile: {taken[:5]}")

    def switch(self) -> None:
        self.commits.files.write(f"{self.commits.log}/{self.name}{_SWITCHED}", json.dumps([vars(m) for m in self.moves]))

    @property
    def slices(self) -> dict[str, list[str]]:
        """Load references by table."""
        return {spec.full_name: [m.ref for m in moves] for spec, moves in self.commits.by_table(self.moves)}


@dataclass
class Commits:
    """Commits over the tables of a warehouse."""

    wh: Warehouse
    files: Files = field(init=False)

    def __post_init__(self):
        self.files = Files(self.wh.spark)

    @property
    def log(self) -> str:
        return self.wh.location("data/_commits")

    @contextmanager
    def open(self) -> Iterator[Commit]:
        """A commit that is made when the block ends, or undone when it fails before the switch."""
        self.recover(undo=False)
        commit = Commit(self)
        try:
            yield commit
            commit.check()
        except BaseException:
            self._undo(commit.name)
            raise
        commit.switch()
        self.apply(commit.moves)
        self.close(commit.name)

    def replace(self, frames: dict[TableSpec, DataFrame], refs: str | Iterable[str] | None = None) -> dict[str, list[str]]:
        """Replace slices of all these tables, or of none; see ``Commit.stage``. Returns the slices by table."""
        with self.open() as commit:
            commit.stage(frames, refs)
        return commit.slices

    def apply(self, moves: list[Move]) -> None:
        """Point the catalog at the new folders; what is there already, or belongs to a later commit, stays."""
        self._side_by_side(self._apply_one, self.by_table(moves))

    def _apply_one(self, spec: TableSpec, moves: list[Move]) -> None:
        held = self.catalog(spec)
        self._point(spec, {m.ref: m.new for m in moves if held.get(m.ref) in (m.old, m.new)}, held)

    def _side_by_side(self, work, parts: list[tuple]) -> None:
        """Statements of several tables at once: each mostly waits for the catalog."""
        with ThreadPoolExecutor(max_workers=max(1, len(parts))) as pool:
            run = inheritable_thread_target(self.wh.spark)(work)
            for done in [pool.submit(run, *part) for part in parts]:
                done.result()

    def close(self, name: str) -> None:
        self.files.move(f"{self.log}/{name}{_SWITCHED}", f"{self.log}/{name}{_APPLIED}")

    # -- after a crash ----------------------------------------------------------------------

    def recover(self, undo: bool = True) -> dict[str, list[str]]:
        """Finish the commits that switched, in their order; with ``undo`` remove what others staged."""
        done: dict[str, list[str]] = {"finished": [], "undone": []}
        for name in self._logged(_SWITCHED):
            self.apply(self._moves(name, _SWITCHED))
            self.close(name)
            done["finished"].append(name)
        if undo:
            staged = {n for spec in ALL_TABLES for n in self.files.names(self.folder(spec))}
            for name in sorted(staged.difference(self._logged(_APPLIED))):
                self._undo(name)
                done["undone"].append(name)
        return done

    def restore(self) -> None:
        """Point a catalog that was built anew at the folders of all applied commits, the last of each slice."""
        last: dict[tuple[str, str], Move] = {}
        for name in self._logged(_APPLIED):
            last |= {(m.table, m.ref): m for m in self._moves(name, _APPLIED)}
        for spec, moves in self.by_table(list(last.values())):
            self._point(spec, {m.ref: m.new for m in moves}, self.catalog(spec))

    def vacuum(self, older_than_seconds: float = 7 * 24 * 3600) -> int:
        """Remove the folders that applied commits older than that replaced. Returns how many went."""
        limit = time.time_ns() - int(older_than_seconds * 1e9)
        held = {place for spec in ALL_TABLES for place in self.catalog(spec).values()}
        gone = 0
        for name in self._logged(_APPLIED):
            if int(name.partition("-")[0]) > limit:
                break
            for m in self._moves(name, _APPLIED):
                if m.old and m.old not in held and self.files.exists(m.old):
                    self.files.delete(m.old)
                    gone += 1
        return gone

    # -- parts ------------------------------------------------------------------------------

    def folder(self, spec: TableSpec, name: str = "") -> str:
        return self.files.qualified(f"{self.wh.location(spec.path_suffix)}/{_VERSIONS}/{name}")

    def by_table(self, moves: list[Move]) -> list[tuple[TableSpec, list[Move]]]:
        return [(s, own) for s in ALL_TABLES if (own := [m for m in moves if m.table == s.full_name])]

    def catalog(self, spec: TableSpec) -> dict[str, str]:
        """Folder of every slice, as the catalog has it: the slices of a table, never its rows."""
        spark = self.wh.spark
        state, jvm = spark._jsparkSession.sessionState(), spark._jvm
        name = state.sqlParser().parseTableIdentifier(self.wh.name(spec))
        parts = state.catalog().listPartitions(name, jvm.scala.Option.empty())
        found = jvm.scala.jdk.javaapi.CollectionConverters.asJava(parts)
        return {p.spec().apply(SLICE_KEY): self.files.qualified(p.location().toString()) for p in found}

    def _undo(self, name: str) -> None:
        for spec in ALL_TABLES:
            if self.files.exists(self.folder(spec, name)):
                self.files.delete(self.folder(spec, name))

    def _logged(self, state: str) -> list[str]:
        return [n.removesuffix(state) for n in self.files.names(self.log) if n.endswith(state)]

    def _moves(self, name: str, state: str) -> list[Move]:
        return [Move(**m) for m in json.loads(self.files.read(f"{self.log}/{name}{state}"))]

    def _point(self, spec: TableSpec, places: dict[str, str | None], held: dict[str, str]) -> None:
        table, sql = self.wh.name(spec), self.wh.spark.sql
        part = lambda ref: f"PARTITION ({SLICE_KEY} = '{require_ref(ref)}')"
        new = [f"{part(ref)} LOCATION '{place}'" for ref, place in places.items() if place is not None and ref not in held]
        gone = [part(ref) for ref, place in places.items() if place is None and ref in held]
        for at in range(0, len(new), _AT_ONCE):
            sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(new[at : at + _AT_ONCE])}")
        for at in range(0, len(gone), _AT_ONCE):
            sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(gone[at : at + _AT_ONCE])}")
        for ref, place in places.items():
            if place is not None and held.get(ref, place) != place:
                sql(f"ALTER TABLE {table} {part(ref)} SET LOCATION '{place}'")
        self.wh.spark.catalog.refreshTable(table)
