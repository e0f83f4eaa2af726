"""Versioned tables as plain Parquet folders ``data/version=N`` and one small table of versions.

A write puts its rows into a folder of its own and then adds a row to the table of versions, which says from which
folder on the folders make up the version: ``since = N`` after an overwrite, the older start after an append. What a
version holds is a range of folders, what came after a version the later part of that range, and every other question
(history, latest, as of a time) is a query on the table of versions. A folder without a row belongs to a write that
never finished; the next write replaces it. One writer per table is assumed.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.sources.readers import read_optional
from feira.sources.sinks import written_rows

VERSIONS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("operation", T.StringType()),
        T.StructField("parameters", T.MapType(T.StringType(), T.StringType())),
        T.StructField("rows", T.LongType()),
        T.StructField("since", T.LongType()),
        T.StructField("table_schema", T.StringType()),
        T.StructField("version", T.LongType()),
    ]
)


def _schema(version: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(version["table_schema"]))


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def versions(self) -> DataFrame:
        """The table of versions; empty before the first write."""
        return read_optional(self.spark, f"{self.path}/versions", VERSIONS)

    def history(self) -> DataFrame:
        """Versions, newest first."""
        columns = ["version", "timestamp", "operation", "parameters", "rows"]
        return self.versions().select(columns).orderBy(F.desc("version"))

    def exists(self) -> bool:
        return not self.versions().isEmpty()

    def latest_version(self) -> int:
        return self._latest()["version"]

    def overwrite(
        self,
        df: DataFrame,
        operation: str = "WRITE",
        cluster_by: tuple[str, ...] = (),
        compression: str = "snappy",
        **parameters: str,
    ) -> int:
        """Replace the table, schema included; returns the new version.

        ``cluster_by`` deals the rows to files by ranges of these columns, so that a range of the first one reaches few
        files (and row groups); the others split a value that holds much of the table. ``compression="zstd"`` halves
        tables that are not joined as a lookup (a lookup is broadcast by the size of its files).
        """
        if cluster_by:
            df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
            parameters = {"clusterBy": ", ".join(cluster_by), **parameters}
        parameters = {"mode": "Overwrite", **parameters}
        return self._write(df, operation, parameters, self._newest(), extend=False, compression=compression)

    def append(self, df: DataFrame, operation: str = "WRITE", **parameters: str) -> int:
        """Add rows; only the new rows are written."""
        last = self._newest()
        if last:
            if [(f.name, f.dataType) for f in _schema(last)] != [(f.name, f.dataType) for f in df.schema]:
                raise ValueError("appended rows must have the table's schema")
        return self._write(df, operation, {"mode": "Append", **parameters}, last, extend=last is not None)

    def restore(self, version: int) -> int:
        """Make an older version current again: its rows are written once more, as a new version."""
        return self._write(self.read(version=version), "RESTORE", {"version": str(version)}, self._latest(), extend=False)

    def read(self, version: int | None = None, as_of: dt.datetime | str | None = None) -> DataFrame:
        """The latest version, version ``version``, or the newest one committed at or before ``as_of``."""
        if version is not None and as_of is not None:
            raise ValueError("give either a version or a timestamp")
        if as_of is not None:
            version = self.version_as_of(as_of)
        return self._scan(self._latest() if version is None else self._version(version))

    def read_if_exists(self) -> DataFrame | None:
        last = self._newest()
        return self._scan(last) if last else None

    def version_as_of(self, as_of: dt.datetime | str) -> int:
        moment = dt.datetime.fromisoformat(as_of) if isinstance(as_of, str) else as_of
        if moment.tzinfo is None:
            moment = moment.replace(tzinfo=dt.timezone.utc)
        known = self.versions().filter(F.col("timestamp") <= F.lit(moment.isoformat()).cast("timestamp"))
        newest = known.agg(F.max("version")).first()[0]
        if newest is None:
            raise ValueError(f"no version of {self.path} at or before {as_of}")
        return newest

    def added_since(self, version: int) -> DataFrame:
        """Rows committed after ``version``: the later folders alone, or a multiset difference after a rewrite."""
        old, new = self._version(version), self._latest()
        if old["since"] == new["since"]:
            return self._scan(new, version + 1)
        return self._scan(new).exceptAll(self._scan(old))

    def row_counts(self) -> DataFrame:
        """Rows of the previous and the latest version, counted; empty when there is only one."""
        latest = self.latest_version()
        if latest == 0:
            return self.spark.createDataFrame([], "version bigint, row_count bigint")
        counts = [
            self.read(version=v).agg(F.count("*").alias("row_count")).select(
                F.lit(v).cast("bigint").alias("version"), "row_count"
            )
            for v in (latest - 1, latest)
        ]
        return counts[0].unionByName(counts[1])

    def diff(self, key: str, old: int, new: int) -> DataFrame:
        """Change of every key between two versions: ``added``, ``removed`` or ``changed``."""
        before, after = self.read(version=old), self.read(version=new)
        columns = [c for c in before.columns if c != key]
        left = before.select(key, F.struct(*columns).alias("before"))
        right = after.select(key, F.struct(*columns).alias("after"))
        change = (
            F.when(F.col("before").isNull(), "added")
            .when(F.col("after").isNull(), "removed")
            .when(~F.col("before").eqNullSafe(F.col("after")), "changed")
        )
        return left.join(right, key, "full_outer").select(key, change.alias("change")).filter("change is not null")

    def _write(
        self,
        df: DataFrame,
        operation: str,
        parameters: dict[str, str],
        last: Row | None,
        extend: bool,
        compression: str = "snappy",
    ) -> int:
        """Write ``df`` as the version after ``last``, on top of its folders if ``extend``."""
        version = last["version"] + 1 if last else 0
        df.write.mode("overwrite").parquet(self._folder(version), compression=compression)
        rows = written_rows(self.spark, self._folder(version), df.schema) + (last["rows"] if extend else 0)
        now = dt.datetime.now(dt.timezone.utc)
        since = last["since"] if extend else version
        row = self.spark.createDataFrame([(now, operation, parameters, rows, since, df.schema.json(), version)], VERSIONS)
        row.drop("version").coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/versions/version={version}")
        return version

    def _newest(self) -> Row | None:
        return self.versions().orderBy(F.desc("version")).first()

    def _latest(self) -> Row:
        last = self._newest()
        if last is None:
            raise ValueError(f"no version of {self.path}")
        return last

    def _version(self, version: int) -> Row:
        found = self.versions().filter(F.col("version") == version).first()
        if found is None:
            raise ValueError(f"no version {version} of {self.path}")
        return found

    def _folder(self, version: int) -> str:
        return f"{self.path}/data/version={version}"

    def _scan(self, version: Row, start: int = 0) -> DataFrame:
        """The folders of a version, from folder ``start`` on."""
        schema = _schema(version)
        folders = [self._folder(v) for v in range(max(version["since"], start), version["version"] + 1)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)
