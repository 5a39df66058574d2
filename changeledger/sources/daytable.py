"""A stored table of days whose versions are published by a pointer.

``data/run=<id>/event_date=<day>/`` holds the rows of a day as one run wrote them, never changed afterwards.
``versions/version=<n>/`` is the pointer: for each day of the version the folder that holds it, with the version's parents,
branch and time; ``lineage/`` keeps the parents alone.  A write stages the days it changes in a new run folder, checks them, and writes the pointer last, so
readers see the version before or the version after, and a failed or repeated run leaves the table as it was.
Days that a version didn't change point to the folders of its parent, so a version costs what it changed.

A branch is a version whose parent is another branch's; its days are read from the same folders until they change.
``merge`` compares branch, main and the version both come from, reading only days whose folders differ.

One writer publishes at a time: a second one finds the version taken and fails, and can run again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import branches as br
from ..operators import history as h
from ..operators import layout as lay
from ..operators import quality as qc
from ..session import cut_lineage

DAY = "event_date"
POINTER = ("parents array<long>, branch string, committed_at timestamp_ntz, operation string, run string, table_schema string, "
           "days array<struct<day:string,folder:string,rows:long>>, version long")
#: The folder name that Spark gives rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Version:
    """A pointer as the driver holds it: a few values and a folder for each day."""

    number: int
    parents: tuple[int, ...]
    branch: str
    schema: T.StructType
    days: dict[str, str]
    rows: dict[str, int]


class Rejected(ValueError):
    """A check failed, so nothing was published; ``report`` tells which."""

    def __init__(self, report: DataFrame):
        super().__init__("not published: " + ", ".join(r.check_name for r in report.where(~F.col("passed")).collect()))
        self.report = report


class DayTable:
    """The table at ``root``; ``key`` names its business key and ``ts`` the column whose day a row belongs to.

    ``unit="month"`` keeps a month's rows under its first day, for tables of few rows a day.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "order_id", ts: str = "event_ts", unit: str = "day"):
        self.spark, self.root, self.key, self.ts, self.unit = spark, root.rstrip("/"), key, ts, unit

    def _day(self) -> Column:
        return F.to_date(F.date_trunc(self.unit, F.col(self.ts)))

    # ---- reading

    def versions(self) -> DataFrame:
        """One row per version: its pointer."""
        try:
            return self.spark.read.schema(POINTER).parquet(f"{self.root}/versions")
        except AnalysisException:  # none yet
            return self.spark.createDataFrame([], POINTER)

    def commits(self) -> DataFrame:
        """The versions as snapshots, for tags and retention."""
        return self.versions().select(F.col("version").alias("snapshot_id"), "committed_at", "operation", "branch", "parents")

    def head(self, branch: str = "main") -> int:
        row = self.versions().where(F.col("branch") == branch).agg(F.max("version")).first()
        if row[0] is None:
            raise ValueError(f"no branch {branch}")
        return row[0]

    def version(self, number: int | None = None, branch: str = "main") -> Version:
        """A version's pointer; by default the newest of ``branch``."""
        number = self.head(branch) if number is None else number
        row = self.versions().where(F.col("version") == number).first()
        if row is None:
            raise ValueError(f"no version {number}")
        return Version(number, tuple(row.parents), row.branch, T.StructType.fromJson(json.loads(row.table_schema)),
                       {d.day: d.folder for d in row.days}, {d.day: d.rows for d in row.days})

    def _folders(self, schema: T.StructType, folders: list[str]) -> DataFrame:
        """The rows of day folders.  The day is a partition column, so a filter on it prunes folders."""
        day = T.StructField(DAY, T.DateType())
        if not folders:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, day]))
        full = T.StructType([*schema.fields, T.StructField("run", T.StringType()), day])
        rows = self.spark.read.schema(full).option("basePath", f"{self.root}/data").parquet(*[f"{self.root}/data/{f}" for f in folders])
        return rows.drop("run")

    def read(self, number: int | None = None, branch: str = "main", days: set[str] | None = None) -> DataFrame:
        """The rows of a version with their day; ``days`` restricts it to these."""
        return self._read(self.version(number, branch), days)

    def _read(self, v: Version, days: set[str] | None = None) -> DataFrame:
        return self._folders(v.schema, [f for d, f in sorted(v.days.items()) if days is None or d in days])

    # ---- writing

    def _stage(self, rows: DataFrame, files: dict[str, int] | None = None) -> tuple[str, dict[str, str], dict[str, int]]:
        """Write rows by day into a run folder of their own: its name, each day's folder, each day's number of rows.

        With ``files`` a day gets that many at most: its rows are dealt into so many groups, and a group isn't split."""
        run = uuid.uuid4().hex[:16]
        path = f"{self.root}/data/run={run}"
        dated = rows.withColumn(DAY, self._day())
        if files:
            wanted = self.spark.createDataFrame(list(files.items()), "_day string, _files long")  # a row a day
            day = F.coalesce(F.col(DAY).cast("string"), F.lit(NO_DAY))
            dated = dated.join(F.broadcast(wanted), day == F.col("_day"), "left") \
                .withColumn("_group", F.pmod(F.xxhash64(self.key, self.ts), F.coalesce("_files", F.lit(1)))) \
                .repartition(max(1, min(sum(files.values()), 8 * lay.write_tasks(self.spark))), DAY, "_group").sortWithinPartitions(DAY).drop("_day", "_files", "_group")
        else:
            dated = lay.distribute_for_write(dated, DAY, [self.key])
        dated.write.option("partitionOverwriteMode", "static").partitionBy(DAY).parquet(path)
        staged = self.spark.read.schema(T.StructType([T.StructField(DAY, T.StringType())])).parquet(path)
        counts = {r[0] or NO_DAY: r[1] for r in staged.groupBy(DAY).count().collect()}  # a row a day
        return run, {d: f"run={run}/{DAY}={d}" for d in counts}, counts

    def _publish(self, branch: str, parents: tuple[int, ...], operation: str, run: str, schema: T.StructType,
                 days: dict[str, str], rows: dict[str, int]) -> int:
        """The pointer of a new version, written last.  Its folder must not exist: another writer's version is never replaced."""
        newest = self.versions().agg(F.max("version")).first()[0]
        number = 1 if newest is None else newest + 1
        if parents and branch == self.version(parents[0]).branch and parents[0] != self.head(branch):
            raise RuntimeError(f"branch {branch} has moved on from version {parents[0]}")
        pointer = self.spark.createDataFrame(
            [(list(parents), branch, operation, run, schema.json(), [(d, f, rows[d]) for d, f in sorted(days.items())])],
            "parents array<long>, branch string, operation string, run string, table_schema string, days array<struct<day:string,folder:string,rows:long>>")
        now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")
        pointer.select("parents").write.mode("overwrite").parquet(f"{self.root}/lineage/version={number}")
        pointer.withColumn("committed_at", now).coalesce(1).write.mode("error").parquet(f"{self.root}/versions/version={number}")
        return number

    def create(self, rows: DataFrame, operation: str = "create") -> int:
        """The first version of ``main`` (O10); a table that has one already is an error."""
        if not self.versions().isEmpty():
            raise ValueError(f"{self.root} holds a table")
        run, days, counts = self._stage(rows)
        return self._publish("main", (), operation, run, T.StructType([f for f in rows.schema.fields if f.name != DAY]), days, counts)

    def branch(self, name: str, at: str = "main") -> int:
        """A branch that starts as ``at`` is now; no data is copied."""
        if not self.versions().where(F.col("branch") == name).isEmpty():
            raise ValueError(f"branch {name} exists")
        v = self.version(branch=at)
        return self._publish(name, (v.number,), "branch", "", v.schema, v.days, v.rows)

    def replace_days(self, rows: DataFrame, days: set[str], branch: str = "main", operation: str = "replace_days", parent: int | None = None,
                     also: tuple[int, ...] = (), files: dict[str, int] | None = None, check: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> int:
        """Publish ``rows`` as the whole content of ``days`` (and of days they bring), other days as they are.

        ``check(before, staged)`` gives a quality report; when a check fails nothing is published and ``Rejected`` is raised.
        """
        v = self.version(parent, branch)
        run, staged, counts = self._stage(rows, files)
        if check is not None:
            report = cut_lineage(check(self._read(v, days | set(staged)), self._folders(v.schema, sorted(staged.values()))), "quality")
            if not qc.all_passed(report):
                raise Rejected(report)
        kept = {d: f for d, f in v.days.items() if d not in days and d not in staged}
        return self._publish(branch, (v.number, *also), operation, run, v.schema, kept | staged, {d: v.rows[d] for d in kept} | counts)

    def upsert(self, source: DataFrame, branch: str = "main", check: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> int:
        """Merge rows, one per key, into the table (O24, O61): only days that gain or lose a row are rewritten.

        Source rows without a key match nothing and are inserted, so a second run with such rows adds them again.
        """
        v = self.version(branch=branch)
        columns = [f.name for f in v.schema.fields]
        source = cut_lineage(source.select(*columns), "upsert-source")
        table, keys = self._read(v), source.select(self.key).where(F.col(self.key).isNotNull())
        held = table.join(keys, self.key, "left_semi")
        days = {r[0] for r in held.select(F.coalesce(F.col(DAY).cast("string"), F.lit(NO_DAY))).distinct().collect()}
        days |= {r[0] for r in source.select(F.coalesce(self._day().cast("string"), F.lit(NO_DAY))).distinct().collect()}
        kept = self._read(v, days).join(keys, self.key, "left_anti").select(*columns)
        return self.replace_days(kept.unionByName(source), days, branch, "upsert", v.number, check=check)

    # ---- merging branches

    def common_version(self, a: int, b: int) -> int:
        """The newest version that both come from and that isn't expired.  The lineage outlives the versions."""
        lineage = self.spark.read.schema("parents array<long>, version long").parquet(f"{self.root}/lineage")
        parents = {r.version: tuple(r.parents) for r in lineage.collect()}  # a few numbers a version
        held = {r[0] for r in self.versions().select("version").collect()}

        def line(n: int) -> set[int]:
            seen, todo = set(), [n]
            while todo:
                n = todo.pop()
                if n not in seen:
                    seen.add(n)
                    todo += parents.get(n, ())
            return seen

        common = line(a) & line(b) & held
        if not common:
            raise ValueError(f"versions {a} and {b} have no version in common")
        return max(common)

    def compared(self, branch: str, into: str = "main") -> tuple[DataFrame, set[str], Version, Version]:
        """``operators.branches.compare`` of two branches over the days whose folders differ, those days, and both versions."""
        ours, theirs = self.version(branch=into), self.version(branch=branch)
        base = self.version(self.common_version(ours.number, theirs.number))
        sides = (base, ours, theirs)
        days = {d for v in sides for d in v.days if len({s.days.get(d) for s in sides}) > 1}
        columns = [f.name for f in ours.schema.fields]
        rows = [self._read(v, days).select(*columns) for v in sides]
        return br.compare(*rows, self.key), days, ours, theirs

    def conflicts(self, branch: str, into: str = "main") -> DataFrame:
        """What stands against a merge; empty when the branch can be merged."""
        return br.conflicts(self.compared(branch, into)[0], self.key)

    def merge(self, branch: str, into: str = "main", prefer: str | None = None,
              check: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> int | None:
        """Merge a branch (O64, O65).  The new version's number, or None when conflicts block it; ``prefer`` decides conflicts for one side.

        Repeated keys and rows without a key that changed block in any case.
        """
        compared, days, ours, theirs = self.compared(branch, into)
        compared = cut_lineage(compared, "branch-compare")
        blocked = F.col("kind").isNotNull() if prefer is None else F.col("kind").isin("no_key", "repeated_key")
        if not compared.where(blocked).isEmpty():
            return None
        columns = [f.name for f in ours.schema.fields]
        rows = br.merged_rows(compared, self._read(ours, days).select(*columns), self.key, prefer)
        return self.replace_days(rows, days, into, f"merge {branch}", ours.number, (theirs.number,), check=check)

    def signed_changes(self, v_from: int, v_to: int) -> DataFrame:
        """What lies between two versions as signed rows, read from the days whose folders differ alone: the rows of the old folders
        with ``sign`` -1, of the new ones with 1.  Rows that a day kept appear with both signs and cancel in every sum."""
        old, new = self.version(v_from), self.version(v_to)
        days = {d for d in {*old.days, *new.days} if old.days.get(d) != new.days.get(d)}
        rows = [self._read(v, days).select(*[f.name for f in v.schema.fields], F.lit(sign).alias("sign")) for v, sign in ((old, -1), (new, 1))]
        return rows[0].unionByName(rows[1], allowMissingColumns=True)

    # ---- erasure

    def erase(self, keys: DataFrame) -> int:
        """Remove every row of the listed keys from the heads of all branches, and all that is older (O29): the number of rows removed.

        Only days that hold such rows are rewritten.  Older versions and tags still hold them, so both go at once, whatever their
        retention; branches that have lost the version they came from can't be merged any more.
        """
        listed = cut_lineage(keys.select(self.key).where(F.col(self.key).isNotNull()).distinct(), "erase-keys")
        gone = 0
        for branch in sorted(r[0] for r in self.versions().select("branch").distinct().collect()):
            v = self.version(branch=branch)
            hit = self._read(v).join(listed, self.key, "left_semi").groupBy(F.coalesce(F.col(DAY).cast("string"), F.lit(NO_DAY)).alias("day")).count().collect()
            if hit:
                days = {r.day for r in hit}
                kept = self._read(v, days).join(listed, self.key, "left_anti").select(*[f.name for f in v.schema.fields])
                self.replace_days(kept, days, branch, "erase", v.number)
                gone += sum(r["count"] for r in hit)
        h.delete_files(lay.file_stats(self.spark, self.root).where(h.plain_path(F.col("path")).contains("/tags/tag=")), dry_run=False)
        self.expire("9999-01-01 00:00:00", 0, joints=False)
        return gone

    # ---- maintenance

    def file_groups(self, target_bytes: int, branch: str = "main", min_files: int = 2, small_ratio: float = 0.75) -> DataFrame:
        """Each day's number of files, bytes, mean size and whether it is worth rewriting (O57), with the number of files it should have."""
        days = self.spark.createDataFrame(sorted(self.version(branch=branch).days.items()), "day string, folder string")
        listed = lay.file_stats(self.spark, f"{self.root}/data") \
            .withColumn("folder", F.regexp_extract(h.plain_path(F.col("path")), rf"/data/(run=[^/]+/{DAY}=[^/]+)/", 1))
        sized = lay.compaction_candidates(listed.join(days, "folder"), target_bytes, "day", min_files, small_ratio)
        return sized.withColumn("wanted", F.ceil(F.col("bytes") / F.lit(target_bytes)))

    def compact(self, target_bytes: int, branch: str = "main", min_files: int = 2, small_ratio: float = 0.75) -> int | None:
        """Rewrite the days of many small files into files near the target, as a new version.

        Other days keep their folders and files.  Gives the version, or None when no day is worth it.  A day whose number of rows would change
        is an error, and nothing is published.
        """
        flagged = self.file_groups(target_bytes, branch, min_files, small_ratio).where("compact").collect()  # a row a day
        if not flagged:
            return None
        v, days = self.version(branch=branch), {r.day for r in flagged}
        rows = self._read(v, days).select(*[f.name for f in v.schema.fields])
        return self.replace_days(rows, days, branch, "compact", v.number, files={r.day: r.wanted for r in flagged}, check=self._same_rows)

    def _same_rows(self, before: DataFrame, staged: DataFrame) -> DataFrame:
        counts = [df.groupBy(DAY).agg(F.count(F.lit(1)).alias(n)) for df, n in ((before, "a"), (staged, "b"))]
        wrong = counts[0].join(counts[1].withColumnRenamed(DAY, "_d"), F.col(DAY).eqNullSafe(F.col("_d")), "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
        return wrong.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit("rows_of_a_day").alias("check_name"), "value", F.lit(0.0).alias("threshold"), (F.col("value") == 0).alias("passed"))

    def tag(self, policy: list[tuple[str, str]], branch: str = "main") -> DataFrame:
        """Store the policy's tags of a branch's versions (O47); a tag that exists already moves."""
        (h.tag_snapshots(self.spark, self.commits().where(F.col("branch") == branch), policy).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("tag").parquet(f"{self.root}/tags"))
        return self.tags()

    def tags(self) -> DataFrame:
        try:
            return self.spark.read.schema("snapshot_id long, committed_at timestamp_ntz, tag string").parquet(f"{self.root}/tags")
        except AnalysisException:  # none yet
            return self.spark.createDataFrame([], "snapshot_id long, committed_at timestamp_ntz, tag string")

    def maintain(self, name: str, target_bytes: int, retention_days: int, tag_policy: list[tuple[str, str]], now: str) -> DataFrame:
        """Compact, tag, expire, in this order (O60): a report of what was done, one row a step."""
        before = self.version()
        compacted = self.compact(target_bytes)
        tags = self.tag(tag_policy).count() if tag_policy else self.tags().count()
        removed = self.expire(now, retention_days).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("b")).first()
        after = self.version()
        steps = [("compacted_days", sum(before.days[d] != after.days.get(d) for d in before.days) if compacted else 0), ("tags", tags),
                 ("versions_kept", self.versions().count()), ("files_removed", removed.n), ("bytes_removed", removed.b), ("rows", sum(after.rows.values()))]
        return self.spark.createDataFrame([(name, step, int(value)) for step, value in steps], "table_name string, step string, value long")

    # ---- retention

    def keep(self, now: str, retention_days: int, tags: list[int] | None = None, joints: bool = True) -> DataFrame:
        """The versions that stay (O50): heads of branches, tagged ones (stored or given), those younger than the retention, and (``joints``) the versions
        that two kept branches come from, which a later merge needs."""
        versions = self.versions().select("version", "branch", "committed_at", "parents")
        heads = versions.groupBy("branch").agg(F.max("version").alias("version")).select("version")
        young = versions.where(F.col("committed_at") >= F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(F.lit(retention_days))).select("version")
        numbers = sorted(r[0] for r in heads.collect())
        parted = {self.common_version(a, b) for a in numbers for b in numbers if a < b} if joints else set()
        pinned = self.spark.createDataFrame([(int(n),) for n in {*(tags or []), *parted}], "version long")
        return heads.unionByName(young).unionByName(pinned).unionByName(self.tags().select(F.col("snapshot_id").alias("version"))).distinct()

    def expire(self, now: str, retention_days: int, tags: list[int] | None = None, dry_run: bool = False, joints: bool = True) -> DataFrame:
        """Remove versions past their retention, then the day folders that no kept version points to.

        Gives ``(path, length)`` of the files removed.  Pointers go first, so no reader finds a version whose folders are gone.
        """
        keep = cut_lineage(self.keep(now, retention_days, tags, joints), "kept-versions")
        pointers = self.versions()
        needed = (pointers.join(keep, "version", "left_semi").select(F.explode("days.folder").alias("folder")).distinct())
        listed = lay.file_stats(self.spark, self.root)
        plain = listed.withColumn("_plain", h.plain_path(F.col("path")))
        gone_pointers = plain.withColumn("version", F.regexp_extract("_plain", r"/versions/version=(\d+)/", 1).try_cast("long")) \
            .where(F.col("version").isNotNull()).join(keep, "version", "left_anti")
        # a run that is still being written has no pointer yet: only folders older than the newest pointer can be gone
        newest = pointers.agg(F.max("committed_at")).first()[0]
        data = plain.withColumn("folder", F.regexp_extract("_plain", rf"/data/(run=[^/]+/{DAY}=[^/]+)/", 1)).where("folder <> ''")
        gone_data = data.join(needed, "folder", "left_anti")
        if newest is not None:
            gone_data = gone_data.where(F.to_utc_timestamp("modificationTime", F.current_timezone()).cast("timestamp_ntz") <= F.lit(newest))
        files = cut_lineage(gone_pointers.select("path", "length", F.lit(0).alias("step")).unionByName(gone_data.select("path", "length", F.lit(1).alias("step"))), "gone-files")
        for step in (0, 1):
            h.delete_files(files.where(F.col("step") == step), dry_run)
        return files.select("path", "length")
