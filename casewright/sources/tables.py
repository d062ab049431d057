"""Tables as plain Parquet: changes by partition, state by bucket; JSON and report output.

Changes lie in one data set per table, partitioned by source and batch. A commit writes
only its own partition (dynamic overwrite), so its cost does not grow with the table, and a
replay overwrites just what its first attempt left. The state, every key's latest row, is a
table of the session catalog bucketed by key: joining changes to it shuffles the changes
only. On a cluster the catalog is a metastore, which also names the present state.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from casewright import contracts as C

#: Files up to which a bucketed table is written without a shuffle.
_FILES = 1 << 15
_ORDER = ("_seq", "_source", "_batch")
_EXTRA = T.StructType([
    T.StructField("_group", T.StringType()), T.StructField("_gone", T.BooleanType()),
    T.StructField("_seq", T.LongType()), T.StructField("_source", T.StringType()),
    T.StructField("_batch", T.StringType()),
])


def store_bucketed(rows: DataFrame, path: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """``rows`` as a catalog table below ``path``, hashed by ``keys`` into as many buckets as
    shuffles have partitions. A join or a grouping by ``keys`` reads it without a shuffle.

    Tasks write their rows straight to sorted files of each bucket, as a shuffle would hold whole
    rows on disk a second time. Only where all cores together would leave over ``_FILES`` files
    are rows shuffled first, to one file a bucket.
    """
    spark = rows.sparkSession
    n, name = buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), f"stored_{uuid.uuid4().hex}"
    tasks = _FILES // n
    rows = rows.repartition(n, *keys) if tasks < spark.sparkContext.defaultParallelism else rows.coalesce(tasks)
    rows.write.bucketBy(n, *keys).sortBy(*keys).option("path", path).option("compression", "zstd").saveAsTable(name)
    table = spark.table(name)
    table.stored_name = name
    return table


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@dataclass(frozen=True)
class Table:
    """One table below ``root``.

    ``groups`` names sets of columns that change apart (a ticket's record and its document
    outcome); a key exists once its first group does. ``defaults`` fill nulls of columns
    that nothing has set. Keys may be null: the state is bucketed by a digest of them.
    """

    spark: SparkSession
    root: str
    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    groups: dict[str, tuple[str, ...]] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def _groups(self) -> dict[str, tuple[str, ...]]:
        return self.groups or {"row": tuple(n for n in self.schema.names if n not in self.keys)}

    @property
    def _folder(self) -> str:
        return f"{self.root}/{self.name}/changes"

    @property
    def _state(self) -> str:
        """The catalog view of the present state."""
        return f"state_{self.name}_{hashlib.md5(self.root.encode()).hexdigest()}"

    def changes(self, without: tuple[str, str | int] | None = None) -> DataFrame:
        """Change rows not yet folded, but those of one (source, batch): its partition is pruned."""
        schema = T.StructType([*self.schema.fields, *_EXTRA.fields])
        try:
            rows = self.spark.read.schema(schema).parquet(self._folder)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
        if without is not None:
            rows = rows.where((F.col("_source") != without[0]) | (F.col("_batch") != str(without[1])))
        return rows

    def _carried(self, group: str, columns: Sequence[str] | None) -> list[str]:
        return [*_ORDER, "_gone", *[c for c in self._groups[group] if columns is None or c in columns]]

    def _latest(self, changes: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        """Keys with the latest change of each group; combines before the shuffle."""
        order = F.struct(*_ORDER)
        return changes.groupBy(*self.keys).agg(*[
            F.max_by(F.struct(*self._carried(g, columns)), F.when(F.col("_group") == g, order)).alias(f"_{g}")
            for g in self._groups
        ])

    def _keyed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_key", F.unhex(F.md5(F.to_json(F.struct(*self.keys)))))

    def latest(self, without: tuple[str, str | int] | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """Keys with the latest change of each group (its ``columns`` only, if they are named),
        folded or not. Only changes are shuffled."""
        changed = self._latest(self.changes(without), columns)
        if not self.spark.catalog.tableExists(self._state):
            return changed
        stored = {g: F.struct(*[F.col(f"_{g}.{c}").alias(c) for c in self._carried(g, columns)]) for g in self._groups}
        old = self.spark.table(self._state).select("_key", F.struct(*self.keys).alias("_old_keys"), *[
            F.when(F.col(f"_{g}").isNotNull(), s).alias(f"_old_{g}") for g, s in stored.items()])
        new = self._keyed(changed).select("_key", F.struct(*self.keys).alias("_new_keys"), *[f"_{g}" for g in self._groups])
        joined = old.join(new, "_key", "full_outer")
        keys = F.coalesce("_new_keys", "_old_keys")

        def later(g: str) -> Column:
            order = {side: F.struct(*[F.col(f"{side}{g}.{c}") for c in _ORDER]) for side in ("_", "_old_")}
            stays = F.col(f"_{g}").isNull() | (F.col(f"_old_{g}").isNotNull() & (order["_old_"] > order["_"]))
            return F.when(stays, F.col(f"_old_{g}")).otherwise(F.col(f"_{g}")).alias(f"_{g}")

        return joined.select(*[keys.getField(k).alias(k) for k in self.keys], *[later(g) for g in self._groups])

    def read(self, without: tuple[str, str | int] | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """The present rows; ``without`` leaves one commit out, as a replay of it must.

        Only the ``columns`` named are read and shuffled (all by default)."""
        latest, first = self.latest(without, columns), f"_{next(iter(self._groups))}"
        of = {c: F.col(f"_{g}.{c}") for g, own in self._groups.items() for c in own}
        values = {c: F.coalesce(of[c], F.lit(v)) for c, v in self.defaults.items()}
        read = [(F.col(f.name) if f.name in self.keys else values.get(f.name, of.get(f.name)))
                .cast(f.dataType).alias(f.name) for f in self.schema.fields if columns is None or f.name in columns]
        return latest.where(F.col(first).isNotNull() & ~F.col(f"{first}._gone")).select(*read)

    def append(self, rows: DataFrame, source: str, batch: str | int, seq: str | Column, group: str | None = None,
               gone: Column | None = None) -> None:
        """Commit changes: keys and the columns of ``group`` (the first by default). Of
        changes of one key the one with the largest ``seq`` counts; where ``gone`` holds, the
        row leaves the table. A commit without rows leaves no partition."""
        group = group or next(iter(self._groups))
        carried = {*self.keys, *self._groups[group]}
        typed = [(F.col(f.name) if f.name in carried else F.lit(None)).cast(f.dataType).alias(f.name)
                 for f in self.schema.fields]
        rows.select(
            *typed, F.lit(group).alias("_group"),
            F.coalesce(gone, F.lit(False)).alias("_gone") if gone is not None else F.lit(False).alias("_gone"),
            (F.col(seq) if isinstance(seq, str) else seq).cast("long").alias("_seq"),
            F.lit(source).alias("_source"), F.lit(str(batch)).alias("_batch"),
        ).write.partitionBy("_source", "_batch").mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").parquet(self._folder)

    def fold(self, buckets: int | None = None) -> None:
        """Take changes over into the state, so that reads do not grow with the number of commits.

        The last batch of every source stays among the changes: it may be replayed, and a
        replay must be able to leave itself out. The new state is written beside the old one,
        the view is moved to it, then the partitions taken over and the old state go. Taking a
        change over twice changes nothing, so a fold that breaks off anywhere can be repeated.
        """
        batches = self.changes().select("_source", "_batch").distinct()
        number = F.struct(F.length("_batch"), "_batch")
        last = batches.groupBy("_source").agg(F.max(number).getField("_batch").alias("_last"))
        done = batches.join(F.broadcast(last), "_source").where("_batch != _last")  # one row per source
        done = [(r["_source"], r["_batch"]) for r in done.select("_source", "_batch").collect()]  # one row per commit
        old = self._stored()
        new = store_bucketed(self._keyed(self.latest()), f"{self.root}/{self.name}/state/{uuid.uuid4().hex}", ["_key"], buckets)
        self.spark.sql(f"CREATE OR REPLACE VIEW `{self._state}` TBLPROPERTIES ('stored' = '{new.stored_name}') "
                       f"AS SELECT * FROM `{new.stored_name}`")
        paths = [f"{self._folder}/_source={s}/_batch={b}" for s, b in done]
        if old:
            paths.append(self._location(old))
            self.spark.sql(f"DROP TABLE `{old}`")
        for path in paths:
            remove(self.spark, path)
        self.spark.catalog.refreshByPath(self._folder)

    def _stored(self) -> str | None:
        """The catalog table behind the view."""
        if not self.spark.catalog.tableExists(self._state):
            return None
        told = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES `{self._state}`").collect()}
        return told["stored"]

    def _location(self, name: str) -> str:
        told = {r["col_name"]: r["data_type"] for r in self.spark.sql(f"DESCRIBE EXTENDED `{name}`").collect()}
        return told["Location"]


def open_table(spark: SparkSession, root: str, name: str) -> Table:
    """A table of the contract."""
    if name == "complaints":
        record = tuple(f.name for f in C.COMPLAINT_FIELDS if f.name != "ticket_no")
        return Table(spark, root, name, C.COMPLAINT_SCHEMA, ("ticket_no",),
                     {"record": record, "outcome": C.DOCUMENT_COLUMNS}, {"document_downloaded": False})
    schema = {
        "districts": C.DISTRICT_SCHEMA, "action_history": C.ACTION_SCHEMA,
        "cell_tracking": C.CELL_TRACKING_SCHEMA, "ticket_tracking": C.TICKET_TRACKING_SCHEMA,
    }[name]
    return Table(spark, root, name, schema, tuple(C.UNIQUE_KEYS[name]))


def read_jdbc_table(spark: SparkSession, url: str, table: str, key: str, bounds, partitions: int,
                    properties: dict | None = None) -> DataFrame:
    """Range-partitioned read of a relational table (the driver jar must be present)."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=bounds[0], upperBound=bounds[1],
        numPartitions=partitions, properties=properties or {},
    )


def write_json(rows: DataFrame, path: str) -> None:
    """JSON lines with explicit nulls."""
    rows.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def write_reports(reports: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Each report as a Parquet folder; returns the folders."""
    written = {}
    for name, report in reports.items():
        written[name] = f"{root}/{name}"
        report.write.mode("errorifexists").parquet(written[name])
    return written
