"""Snapshots, time travel, tags, diffs and retention over a change log.

A table's history is its change log plus a small ``commits`` dataset
(``snapshot_id, committed_at, operation, added_rows, total_rows``): snapshot
``v`` contains every change committed up to and including ``v``.  Reading a
table "as of" anything first resolves a snapshot id on the commits (a handful of
rows per day), then replays only the log rows of that prefix, so the log
predicate is a literal that reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import DEFAULT_RETENTION_DAYS
from .changes import VALUE_COLUMNS, accumulators, current, exists, replay


def commits_by_day(changes: DataFrame, ts: str = "event_ts") -> DataFrame:
    """One commit per day of changes: id = dense rank of the day, committed at
    the next midnight (O44).  The window runs over one row per day; changes
    without a time belong to no day and shift no snapshot id."""
    days = changes.where(F.to_date(ts).isNotNull()).groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("added_rows"))
    w = Window.orderBy("day")
    return days.select(
        F.dense_rank().over(w).cast("long").alias("snapshot_id"),
        F.date_add("day", 1).cast("timestamp_ntz").alias("committed_at"),
        F.lit("append").alias("operation"),
        "added_rows",
        F.sum("added_rows").over(w.rowsBetween(Window.unboundedPreceding, 0))
         .cast("long").alias("total_rows"))


def latest_snapshot(commits: DataFrame) -> DataFrame:
    """Newest snapshot: ``ORDER BY committed_at DESC LIMIT 1``."""
    return commits.orderBy(F.col("committed_at").desc(), F.col("snapshot_id").desc()) \
                  .limit(1).select("snapshot_id", "committed_at")


def first_snapshot(commits: DataFrame) -> DataFrame:
    """Oldest snapshot."""
    return commits.agg(
        F.min_by("snapshot_id", F.struct("committed_at", "snapshot_id")).alias("snapshot_id"),
        F.min("committed_at").alias("committed_at"))


def commit_times(commits: DataFrame, versions: list[int]) -> dict:
    """Commit time of each requested snapshot, in one small job."""
    rows = commits.where(F.col("snapshot_id").isin(*versions)) \
                  .select("snapshot_id", "committed_at").collect()
    found = {r[0]: r[1] for r in rows}
    missing = [v for v in versions if v not in found]
    if missing:
        raise ValueError(f"unknown snapshot(s) {missing}")
    return found


def commit_time(commits: DataFrame, version: int):
    return commit_times(commits, [version])[version]


def snapshot_at(commits: DataFrame, ts: str) -> int | None:
    """Newest snapshot committed at or before ``ts``."""
    row = (commits.where(F.col("committed_at") <= F.lit(ts).cast("timestamp_ntz"))
                  .agg(F.max_by("snapshot_id", F.struct("committed_at", "snapshot_id"))).first())
    return None if row is None else row[0]


def with_batches(changes: DataFrame, commits: DataFrame, ts: str = "event_ts",
                 batch: str = "batch_id") -> DataFrame:
    """Mark each change with the snapshot of ``commits_by_day`` that brought it."""
    days = commits.select(F.col("snapshot_id").alias(batch),
                          F.date_sub(F.col("committed_at").cast("date"), 1).alias("_day"))
    return changes.join(days, F.to_date(ts) == F.col("_day"), "left").drop("_day")


def as_of_version(changes: DataFrame, commits: DataFrame, version: int,
                  batch: str = "batch_id") -> DataFrame:
    """State of the table at snapshot ``version`` (O45): the changes of the commits up to it,
    whatever their own times say."""
    commit_time(commits, version)       # an unknown version raises
    return replay(changes.where(F.col(batch) <= version))


def as_of_timestamp(changes: DataFrame, commits: DataFrame, at: str,
                    batch: str = "batch_id") -> DataFrame:
    """State at a point in time: newest commit not after ``at``."""
    version = snapshot_at(commits, at)
    if version is None:
        return replay(changes.limit(0))
    return replay(changes.where(F.col(batch) <= version))


def tag_snapshots(spark: SparkSession, commits: DataFrame, policy: list[tuple[str, str]]) -> DataFrame:
    """Resolve tag policy ``(tag, 'latest' | 'first' | <id>)`` to snapshot ids (O47); an unknown id raises."""
    commit_times(commits, [int(spec) for _, spec in policy if spec not in ("latest", "first")])
    ends = commits.agg(
        F.max_by("snapshot_id", F.struct("committed_at", "snapshot_id")).alias("latest"),
        F.min_by("snapshot_id", F.struct("committed_at", "snapshot_id")).alias("first")).first()
    rows = []
    for tag, spec in policy:
        sid = ends[spec] if spec in ("latest", "first") else int(spec)
        rows.append((tag, sid))
    tags = spark.createDataFrame(rows, "tag string, snapshot_id long")
    return tags.join(commits.select("snapshot_id", "committed_at"), "snapshot_id") \
               .select("tag", "snapshot_id", "committed_at")


def as_of_tag(changes: DataFrame, commits: DataFrame, tags: DataFrame, tag: str) -> DataFrame:
    """Table frozen at a tag."""
    return as_of_version(changes, commits, tagged(tags, tag))


def tagged(tags: DataFrame, tag: str) -> int:
    """The snapshot id of a tag."""
    row = tags.where(F.col("tag") == tag).select("snapshot_id").first()
    if row is None:
        raise ValueError(f"unknown tag {tag}")
    return row[0]


def snapshot_diff(old: DataFrame, new: DataFrame, key: str = "order_id") -> DataFrame:
    """Rows added, removed or changed between two versions.

    One full outer join on the key; values compared null-safely.
    """
    cols = [c for c in old.columns if c != key]
    o = old.select(key, *[F.col(c).alias(f"_old_{c}") for c in cols], F.lit(True).alias("_in_old"))
    n = new.select(key, *[F.col(c).alias(f"_new_{c}") for c in cols], F.lit(True).alias("_in_new"))
    j = o.join(n, key, "full_outer")
    same = F.lit(True)
    for c in cols:
        same = same & F.col(f"_old_{c}").eqNullSafe(F.col(f"_new_{c}"))
    change = (F.when(F.col("_in_old").isNull(), "added")
               .when(F.col("_in_new").isNull(), "removed")
               .when(~same, "changed"))
    changed_cols = F.concat_ws(",", *[F.when(~F.col(f"_old_{c}").eqNullSafe(F.col(f"_new_{c}")),
                                             F.lit(c)) for c in cols])
    return (j.withColumn("change", change).where(F.col("change").isNotNull())
             .select(key, "change",
                     F.when(F.col("change") == "changed", changed_cols).alias("changed_columns")))


def diff_versions(changes: DataFrame, commits: DataFrame, v_from: int, v_to: int,
                  key: str = "order_id", batch: str = "batch_id") -> DataFrame:
    """Diff of two snapshots, older → newer, computed from the log (O49 at scale).

    One scan and one shuffle: each key folds the changes up to either version side by
    side, and keys without a change between the two are left out.
    """
    lo, hi = sorted((v_from, v_to))
    commit_times(commits, [lo, hi])     # an unknown version raises
    rows = changes.where(F.col(batch) <= hi)
    return diff_marked(rows.withColumn("_in_old", F.col(batch) <= lo).withColumn("_in_new", F.lit(True)), lo, key, batch)


def fold_sides(changes: DataFrame, lo: int, key: str = "order_id", batch: str = "batch_id") -> DataFrame:
    """Two folds of one log side by side, ``_old_…`` of rows with ``_in_old`` and ``_new_…`` of rows with ``_in_new``, of
    the keys that a snapshot after ``lo`` touched."""
    cols = [c for c in VALUE_COLUMNS if c in changes.columns]
    one_sided = F.col("_in_old") != F.col("_in_new")
    return (changes.where(F.col(key).isNotNull()).groupBy(key)
            .agg(*accumulators(cols, F.col("_in_old"), "_old_"), *accumulators(cols, F.col("_in_new"), "_new_"),
                 F.max((F.col(batch) > lo) | one_sided).alias("_touched"))
            .where(F.col("_touched")))


def signed_rows(folded: DataFrame, key: str = "order_id") -> DataFrame:
    """Each touched key's row before (``sign`` -1) and after (``sign`` 1), where it exists; equal rows cancel and are left out."""
    cols = [c.removeprefix("_old_") for c in folded.columns if c.startswith("_old_") and not c.startswith("_old__")]
    image = {side: F.struct(*[current(c, f"_{side}_").alias(c) for c in cols]) for side in ("old", "new")}
    both = F.array_compact(F.array(F.when(exists("_old_"), F.struct(F.lit(-1).alias("sign"), image["old"].alias("row"))),
                                   F.when(exists("_new_"), F.struct(F.lit(1).alias("sign"), image["new"].alias("row")))))
    moved = ~(exists("_old_") & exists("_new_") & image["old"].eqNullSafe(image["new"]))
    return folded.where(moved).select(key, F.explode(both).alias("_r")).select(key, "_r.sign", "_r.row.*")


def diff_marked(changes: DataFrame, lo: int, key: str = "order_id", batch: str = "batch_id") -> DataFrame:
    """The difference of two folds of one log: rows with ``_in_old`` against rows with ``_in_new``.

    Keys whose rows all stand in both and belong to snapshots up to ``lo`` can't differ and are left out.
    """
    cols = [c for c in VALUE_COLUMNS if c in changes.columns]
    folded = fold_sides(changes, lo, key, batch)
    pairs = {c: current(c, "_old_").eqNullSafe(current(c, "_new_")) for c in cols}
    both = exists("_old_") & exists("_new_")
    changed_cols = F.concat_ws(",", *[F.when(~same, F.lit(c)) for c, same in pairs.items()])
    change = (F.when(both & (changed_cols != ""), "changed")
               .when(exists("_new_") & ~exists("_old_"), "added")
               .when(exists("_old_") & ~exists("_new_"), "removed"))
    return (folded.select(key, change.alias("change"), F.when(both, changed_cols).alias("changed_columns"))
                  .where(F.col("change").isNotNull()))


def expire_snapshots(commits: DataFrame, retention: DataFrame, tags: DataFrame,
                     now: str, table_col: str = "table_name") -> DataFrame:
    """Snapshots that expire (O50): older than the table's retention, not tagged,
    never the newest of the table.

    ``commits`` carries ``table_name``; ``retention`` maps table → days (a
    missing table uses the default), ``tags`` lists ``(table_name, snapshot_id)``.
    """
    newest = commits.groupBy(table_col).agg(F.max("snapshot_id").alias("_newest"))
    days = F.coalesce(F.col("retention_days"), F.lit(DEFAULT_RETENTION_DAYS))
    limit = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(days)
    return (commits.join(retention, table_col, "left")
                   .join(newest, table_col)
                   .where((F.col("committed_at") < limit) & (F.col("snapshot_id") != F.col("_newest")))
                   .join(tags.select(table_col, "snapshot_id"), [table_col, "snapshot_id"], "left_anti")
                   .select(table_col, "snapshot_id", "committed_at"))


def plain_path(path: Column) -> Column:
    """A path without scheme slashes and percent-encoding, however often it was encoded."""
    for _ in range(2):
        path = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    return F.regexp_replace(path, "^file:/+", "/")


def orphan_files(files: DataFrame, live_paths: DataFrame, older_than: str | None = None) -> DataFrame:
    """Files present in storage that no live snapshot references (O52). Report only.

    Listings give plain paths and scans percent-encoded ones, so both are compared in decoded
    form.  With ``older_than`` (a timestamp; needs ``modificationTime``) younger
    files are left out: a running write may still commit them.
    """
    if older_than is not None:
        files = files.where(F.col("modificationTime") < F.lit(older_than).cast("timestamp"))
    live = live_paths.select(plain_path(F.col("path")).alias("_plain")).distinct()
    return files.withColumn("_plain", plain_path(F.col("path"))).join(live, "_plain", "left_anti").drop("_plain")


def delete_files(files: DataFrame, dry_run: bool = True) -> int:
    """The explicit delete step after an orphan report (O52) or a TTL report.

    ``dry_run`` (the default) only counts.  Otherwise executors delete their
    share of the listed paths in parallel, so a long list never passes through
    the driver; a retried task simply finds some files already gone.
    """
    def delete_partition(rows) -> None:
        # defined here so it is shipped by value: executors need no copy of this package
        from pyarrow import fs as pafs
        for row in rows:
            uri = row["path"]
            if uri.startswith("file:") and not uri.startswith("file://"):
                uri = "file://" + uri[len("file:"):]
            filesystem, path = pafs.FileSystem.from_uri(uri)
            try:
                filesystem.delete_file(path)
            except FileNotFoundError:
                pass              # already gone: deleting is idempotent

    paths = files.select("path").distinct()
    n = paths.count()
    if not dry_run and n:
        paths.foreachPartition(delete_partition)
    return n


def raw_ttl(partitions: DataFrame, run_date: str, days: int, dt: str = "dt") -> DataFrame:
    """Landed date partitions older than ``days`` before ``run_date``."""
    limit = F.date_sub(F.lit(run_date).cast("date"), days)
    return partitions.select(F.col(dt).cast("date").alias("dt")).distinct() \
                     .where(F.col("dt") < limit)
