"""Catalog tables: life cycle, slice scans and idempotent slice replacement."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ouvidoria.schemas import ALL_TABLES, BRONZE, GOLD, SILVER, SLICE_KEY, TableSpec
from ouvidoria.session import path_exists, require_ref, shuffles_released


def as_list(refs: str | Iterable[str] | None) -> list[str] | None:
    if refs is None:
        return None
    return [require_ref(r) for r in dict.fromkeys([refs] if isinstance(refs, str) else refs)]


@dataclass(frozen=True)
class Warehouse:
    """The twelve tables under one base path.

    ``prefix`` goes before the database names, so that several warehouses share a catalog.
    """

    spark: SparkSession
    base_path: str
    prefix: str = ""

    @classmethod
    def for_env(cls, spark: SparkSession, env: str, template: str, prefix: str = "") -> Warehouse:
        """Base path by environment: ``template`` holds ``{env}``."""
        if not env:
            raise ValueError("the environment 'env' is mandatory")
        return cls(spark, template.format(env=env), prefix)

    def location(self, suffix: str) -> str:
        return f"{self.base_path.rstrip('/')}/{suffix}"

    def name(self, spec: TableSpec) -> str:
        return f"{self.prefix}{spec.full_name}"

    # -- life cycle ---------------------------------------------------------------------

    def create(self, specs: Iterable[TableSpec] = tuple(ALL_TABLES)) -> DataFrame:
        """Create databases and tables where they are missing; raises if any of them fails.

        A new table takes up the slices that already lie at its location, or where commits have put them.
        """
        specs = list(specs)
        found_again = False
        phases = [
            ([f"CREATE DATABASE IF NOT EXISTS {self.prefix}{db}"], db, None)
            for db in dict.fromkeys(s.database for s in specs)
        ]
        for spec in specs:
            statements = [self._ddl(spec)]
            known = self.spark.catalog.tableExists(self.name(spec))
            if not known and path_exists(self.spark, self.location(spec.path_suffix)):
                statements.append(f"ALTER TABLE {self.name(spec)} RECOVER PARTITIONS")
                found_again = True
            phases.append((statements, spec.database, spec.name))
        report = self._phases(phases)
        if found_again:
            from ouvidoria.sources.commit import Commits

            Commits(self).restore()
        return report

    def drop(self) -> DataFrame:
        """Drop tables, then databases, gold first. Data files stay, as the tables are external."""
        phases = []
        for database in (GOLD, SILVER, BRONZE):
            if not self.spark.catalog.databaseExists(f"{self.prefix}{database}"):
                continue
            phases += [
                ([f"DROP TABLE IF EXISTS {self.name(spec)}"], database, spec.name)
                for spec in ALL_TABLES
                if spec.database == database
            ]
            phases.append(([f"DROP DATABASE IF EXISTS {self.prefix}{database} CASCADE"], database, None))
        return self._phases(phases)

    def _ddl(self, spec: TableSpec) -> str:
        """The table itself says that an overwrite replaces only the slices it writes; no session setting is touched."""
        columns = ", ".join(f"{name} {dtype}" for name, dtype in spec.stored_columns())
        return (
            f"CREATE TABLE IF NOT EXISTS {self.name(spec)} ({columns}) USING parquet "
            "OPTIONS ('partitionOverwriteMode' = 'dynamic', 'compression' = 'zstd') "
            f"PARTITIONED BY ({SLICE_KEY}) LOCATION '{self.location(spec.path_suffix)}'"
        )

    def _phases(self, phases: list[tuple[list[str], str, str | None]]) -> DataFrame:
        """Run every phase, even after a failure; then report, or raise if any failed."""
        rows, failures = [], []
        for statements, database, table in phases:
            try:
                for statement in statements:
                    self.spark.sql(statement)
                rows.append((database, table, True))
            except Exception as error:  # noqa: BLE001 - collected and raised below
                rows.append((database, table, False))
                failures.append(f"{database}.{table or '*'}: {error}")
        if failures:
            raise RuntimeError("catalog phases failed: " + "; ".join(failures))
        return self.spark.createDataFrame(rows, "database string, table_name string, ok boolean")

    # -- reads --------------------------------------------------------------------------

    def table(self, spec: TableSpec) -> DataFrame:
        """The whole table in its declared column order."""
        return self.spark.table(self.name(spec)).select(*spec.column_names)

    def slice(self, spec: TableSpec, ref: str) -> DataFrame:
        """One load: partition pruning leaves only its folder to read."""
        return self.table(spec).where(F.col(SLICE_KEY) == require_ref(ref))

    def slice_like(self, spec: TableSpec, ref: str, column: str, pattern: str) -> DataFrame:
        return self.slice(spec, ref).where(F.col(column).like(pattern))

    # -- writes -------------------------------------------------------------------------

    def replace(
        self,
        spec: TableSpec,
        df: DataFrame,
        refs: str | Iterable[str] | None = None,
        rebalance: bool | None = None,
    ) -> list[str]:
        """Replace whole slices and return their names; running it again changes nothing.

        The new files are staged and moved in when the job commits, so a failed task leaves the old slice in place.
        Slices named in ``refs`` for which ``df`` has no row are emptied; a row of any other slice is an error, raised
        before anything is replaced. Without ``refs`` exactly the slices that occur in ``df`` are replaced.

        ``rebalance`` shuffles rows so that each slice gets few, evenly sized files. The default
        does it for several slices at once, where each task might hold rows of all of them; turn
        it off when the source is already cut by slice or its rows are wide, as whole texts would be
        shuffled only to be written, and on where a filter left little behind.
        """
        with shuffles_released(self.spark):
            return self._replace(spec, df, as_list(refs), rebalance)

    def replace_many(self, frames: dict[TableSpec, DataFrame], refs: str | Iterable[str] | None = None) -> None:
        """Replace slices of several tables side by side: small writes are mostly waiting."""
        wanted = as_list(refs)
        with shuffles_released(self.spark), ThreadPoolExecutor(max_workers=max(1, len(frames))) as pool:
            run = inheritable_thread_target(self.spark)(self._replace)
            for done in [pool.submit(run, spec, df, wanted, None) for spec, df in frames.items()]:
                done.result()

    def _replace(self, spec: TableSpec, df: DataFrame, wanted: list[str] | None, rebalance: bool | None) -> list[str]:
        rows = spec.conform(df, stored=True)
        if wanted is not None and len(wanted) == 1:
            self._replace_one(spec, rows, wanted[0], bool(rebalance))
            return wanted
        if wanted is not None:
            rows = self.only(spec, rows, F.col(SLICE_KEY).isin(wanted))
        # The write itself tells which slices it met: the source is evaluated once.
        seen = Observation()
        rows = rows.observe(seen, F.collect_set(F.coalesce(SLICE_KEY, F.lit(""))).alias("refs"))
        even = rows if rebalance is False else rows.hint("rebalance", SLICE_KEY)
        even.write.mode("overwrite").insertInto(self.name(spec))
        present = sorted(seen.get["refs"])
        for ref in set(wanted or []) - set(present):
            self.clear(spec, ref)
        return present if wanted is None else wanted

    def only(self, spec: TableSpec, rows: DataFrame, known: Column) -> DataFrame:
        """A row of another slice fails the write, before anything is moved in."""
        key = F.col(SLICE_KEY)
        message = F.concat(F.lit(f"{spec.full_name}: a row of a slice that was not named: "), F.coalesce(key, F.lit("null")))
        return rows.withColumn(SLICE_KEY, F.when(known, key).otherwise(F.raise_error(message)).cast("string"))

    def _replace_one(self, spec: TableSpec, rows: DataFrame, ref: str, rebalance: bool) -> None:
        """The slice stays a dynamic one: a static PARTITION clause would delete it before the new rows are written."""
        checked = self.only(spec, rows, F.col(SLICE_KEY).eqNullSafe(ref))
        seen = Observation()
        written = (checked.hint("rebalance") if rebalance else checked).observe(seen, F.count(F.lit(1)).alias("n"))
        written.write.mode("overwrite").insertInto(self.name(spec))
        if not seen.get["n"]:
            self.clear(spec, ref)

    def clear(self, spec: TableSpec, ref: str) -> None:
        """Empty one slice: a dynamic overwrite never touches a slice without new rows."""
        data = ", ".join(f"CAST(NULL AS {dtype}) AS {name}" for name, dtype in spec.stored_columns()[:-1])
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.name(spec)} PARTITION ({SLICE_KEY} = '{require_ref(ref)}') "
            f"SELECT {data} WHERE false"
        )

    def append(self, spec: TableSpec, df: DataFrame, rebalance: bool = True) -> None:
        """Plain insert: a second run doubles the slice. Prefer ``replace``."""
        rows = spec.conform(df, stored=True)
        rows = rows.hint("rebalance", SLICE_KEY) if rebalance else rows
        rows.write.mode("append").insertInto(self.name(spec))
