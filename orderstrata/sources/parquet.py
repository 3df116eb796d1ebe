"""Tables kept as Parquet folders under one root."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderstrata.contracts import Contract
from orderstrata.operators.integrity import conform
from orderstrata.sources.empty import empty_rows, empty_table
from orderstrata.sources.files import delete, names_in, read_small, write_new
from orderstrata.sources.parts import (
    KEPT,
    MALFORMED,
    PART,
    Layout,
    Parts,
    counted,
    counted_by_part,
)

MANIFESTS = "_manifests"
# Of the raw lines a third of what Spark's default takes, and no slower to write.
COMPRESSION = "zstd"


@dataclass(frozen=True)
class Version:
    """One state of a table: its folder, the rows of each part, and how they are laid out.

    ``parted`` says that each part has a folder of its own in there; else all rows are the
    table's own.
    """

    folder: str
    rows: dict[str, int] = field(default_factory=dict)
    parted: bool = False
    layout: Layout | None = None

    def text(self) -> str:
        layout = self.layout and [self.layout.column, self.layout.buckets]
        return json.dumps({**vars(self), "layout": layout})

    @staticmethod
    def of(text: str) -> Version:
        told = json.loads(text)
        return Version(**{**told, "layout": told["layout"] and Layout(*told["layout"])})


class ParquetTables:
    """Named tables below ``root``; every write replaces the whole table, at once or not at all.

    A write goes to a folder of its own. When all rows are there, a small file, the next in
    number of the table's manifests, names that folder, and readers follow the last such
    file: until then, and after a write that fails, they see the old rows. Frames that were
    read before stay with the rows they were planned on, which are kept for a while: the
    last ``versions_kept`` states of a table are, older ones go with the next write. Of two
    writers at a time one fails. A folder of Parquet files without manifests is a table too.
    """

    def __init__(self, spark: SparkSession, root: str, versions_kept: int = 2):
        self.spark = spark
        self.root = root.rstrip("/")
        self.versions_kept = max(1, versions_kept)

    # --- states of a table ------------------------------------------------------------

    def _folder(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _versions(self, name: str) -> list[tuple[int, Version | None]]:
        """Numbers and states, the last one first; None for a file not written to its end."""
        found: list[tuple[int, Version | None]] = []
        folder = f"{self._folder(name)}/{MANIFESTS}"
        for file in reversed(names_in(self.spark, folder)):
            number = file.removesuffix(".json")
            if number.isdigit():
                try:
                    version = Version.of(read_small(self.spark, f"{folder}/{file}"))
                except ValueError:
                    version = None
                found.append((int(number), version))
        return found

    def version(self, name: str) -> Version | None:
        """The state that readers see; None for a folder without manifests, or for no table."""
        return next((version for _, version in self._versions(name) if version), None)

    def _replace(self, name: str, write: Callable[[str], Version]) -> Version:
        """Has a new state written to a folder of its own, then lets readers see it."""
        table = self._folder(name)
        before = self._versions(name)
        number = before[0][0] + 1 if before else 1
        folder = f"{table}/v-{uuid.uuid4().hex}"
        try:
            version = write(folder)
            write_new(self.spark, self._manifest(name, number), version.text())
        except BaseException:
            delete(self.spark, folder)
            raise
        outdated = [at for at, old in before if old][self.versions_kept - 1 :]
        for at, old in before:
            if outdated and at <= outdated[0]:
                delete(self.spark, self._manifest(name, at))
                if old:
                    delete(self.spark, f"{table}/{old.folder}")
        return version

    def _manifest(self, name: str, number: int) -> str:
        return f"{self._folder(name)}/{MANIFESTS}/{number:012d}.json"

    def exists(self, contract: Contract) -> bool:
        return bool(names_in(self.spark, self._folder(contract.name)))

    def path(self, name: str) -> str:
        """Where the table's rows are now."""
        version = self.version(name)
        if version is None:
            return self._folder(name)
        whole = f"{self._folder(name)}/{version.folder}"
        return f"{whole}/{PART}={KEPT}" if version.parted else whole

    # --- raw tables -------------------------------------------------------------------

    def read_raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def write_raw(self, name: str, df: DataFrame) -> int:
        """Rows written."""
        return self._write(name, df)

    def _write(self, name: str, df: DataFrame) -> int:
        rows, counts = counted(df)

        def write(folder: str) -> Version:
            rows.write.parquet(folder, compression=COMPRESSION)
            return Version(folder.rpartition("/")[2], counts())

        return self._replace(name, write).rows[KEPT]

    # --- typed tables -------------------------------------------------------------------

    def read(self, contract: Contract, laid_out: bool = True) -> DataFrame:
        """A typed table; its schema is the contract's, so no file is opened to plan the scan.

        With ``laid_out``, a table in buckets is read as such, at the price of fewer and larger
        tasks where that serves a join.
        """
        version = self.version(contract.name)
        if version and version.parted and not version.rows[KEPT]:
            return empty_table(self.spark, contract)
        path = self.path(contract.name)
        if version and version.layout and laid_out:
            return self._in_buckets(contract.schema, path, version.layout)
        return self.spark.read.schema(contract.schema).parquet(path)

    def read_for_join(self, left: Contract, right: Contract) -> tuple[DataFrame, DataFrame]:
        """Two tables to be joined: in buckets if both are laid out alike, else neither is.

        So that, where one is not, the join is left to a shuffle on both sides, which adaptive
        execution can split.
        """
        layouts = [v and v.layout for v in map(self.version, (left.name, right.name))]
        alike = layouts[0] is not None and layouts[0] == layouts[1]
        return self.read(left, laid_out=alike), self.read(right, laid_out=alike)

    def write(self, contract: Contract, df: DataFrame) -> int:
        """Rows written, counted by the job that writes them."""
        return self._write(contract.name, conform(df, contract))

    def write_parts(
        self,
        contract: Contract,
        df: DataFrame,
        layout: Layout | None = None,
        placed: bool = False,
    ) -> Parts:
        """Replaces a table by the rows of ``df`` whose ``part`` is ``kept``, and keeps the others.

        One job writes all parts and counts them. Only the rows kept must be as the contract
        says; all columns of the others stay. ``placed`` rows have been put into the layout's
        buckets by one task each and are not shuffled again.
        """
        checked = conform(df, contract, among=F.col(PART) == KEPT)
        rows, counts = counted_by_part(checked)

        def write(folder: str) -> Version:
            if layout:
                self._write_buckets(rows, folder, layout, placed)
            else:
                rows.write.partitionBy(PART).parquet(folder, compression=COMPRESSION)
            return Version(folder.rpartition("/")[2], counts(), parted=True, layout=layout)

        version = self._replace(contract.name, write)
        folder = f"{self._folder(contract.name)}/{version.folder}"
        schema = checked.drop(PART).schema
        frames = {
            part: self.spark.read.schema(schema).parquet(f"{folder}/{PART}={part}")
            if count
            else empty_rows(self.spark, schema)
            for part, count in version.rows.items()
        }
        return Parts(version.rows, frames)

    def count(self, contract: Contract) -> int:
        """Rows of a table, as counted when it was written; else from its file footers."""
        version = self.version(contract.name)
        return self.read(contract).count() if version is None else version.rows[KEPT]

    def create(self, contract: Contract) -> None:
        """The table without rows, in place of whatever it held."""
        self._write(contract.name, empty_table(self.spark, contract))

    # --- buckets ------------------------------------------------------------------------

    def _write_buckets(self, df: DataFrame, folder: str, layout: Layout, placed: bool) -> None:
        """One file for each bucket and part. The catalog holds the table's name meanwhile."""
        if not placed:
            spread = layout.spread(df, F.col(PART) == MALFORMED)
            df = spread.repartition(layout.buckets, layout.column)
        writer: DataFrameWriter = df.write.format("parquet").option("compression", COMPRESSION)
        writer = writer.partitionBy(PART).option("path", folder)
        name = f"written_{uuid.uuid4().hex}"
        try:
            writer.bucketBy(layout.buckets, layout.column).sortBy(layout.column).saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _in_buckets(self, schema: StructType, path: str, layout: Layout) -> DataFrame:
        """Files as buckets. The catalog knows the table until it is planned, no longer."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        name = f"read_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{layout.column}`)"
            f" SORTED BY (`{layout.column}`) INTO {layout.buckets} BUCKETS LOCATION '{path}'"
        )
        try:
            return self.spark.read.table(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")
