"""Reading a ledger written by the change stream: log, commits, state, base, tags.

Every version is a cut of the log by ``batch_id``, which is the snapshot id of the
commit.  A base is the fold of a prefix of batches; a base with the batches after it
gives the same rows as the whole log, also when late rows arrived after the base.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cdc import CHANGE_OUT
from ..operators import aggregates as agg
from ..operators import history as h
from ..operators.changes import (KEY, fold, folded_state, id_deletes, id_pairs, keyed_by_id,
                                 merge_folds, replay, resolve_deletes)
from ..schemas import CHANGE_ROW, DELETE_OP
from ..session import cut_lineage

# Given, so that no read has to infer it; logs of before without a source_id read it as null.
LOG_SCHEMA = T.StructType([
    *CHANGE_ROW.fields,
    T.StructField("source_id", T.StringType()),
    T.StructField("_reason", T.StringType()),
    T.StructField("_payload", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("_lane", T.StringType()),
])


_SEQ_TYPES: dict[str, T.DataType] = {}
COMMIT_SCHEMA = "snapshot_id long, committed_at timestamp_ntz, operation string, added_rows long, id_deletes long, batch_id long"


RUN_SCHEMA = COMMIT_SCHEMA + ", job string, run_id string, sources array<string>, records long, first_offset long, last_offset long"


def runs(spark: SparkSession, root: str) -> DataFrame:
    """The record of the run behind each commit (O14): job, query, source files (or topic partitions), records and offsets."""
    return spark.read.schema(RUN_SCHEMA).parquet(f"{root}/commits").drop("batch_id")


def _log(spark: SparkSession, root: str) -> DataFrame:
    """The log in ``LOG_SCHEMA``; ``seq`` has the type it was written with, a number or a composite place."""
    if root not in _SEQ_TYPES:
        _SEQ_TYPES[root] = spark.read.parquet(f"{root}/log").schema["seq"].dataType
    fields = [T.StructField(f.name, _SEQ_TYPES[root] if f.name == "seq" else f.dataType) for f in LOG_SCHEMA.fields]
    return spark.read.schema(T.StructType(fields)).parquet(f"{root}/log")


def _commit_rows(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(COMMIT_SCHEMA).parquet(f"{root}/commits")


def _has_id_deletes(spark: SparkSession, root: str, upto: int | None) -> bool:
    """Whether a commit brought deletes by database id; commits of before the count was kept may have."""
    some = F.coalesce(F.col("id_deletes") > 0, F.lit(True))
    rows = _commit_rows(spark, root)
    return not (rows if upto is None else rows.where(F.col("batch_id") <= upto)).where(some).isEmpty()


def _rows(spark: SparkSession, root: str, upto: int | None = None, after: int | None = None) -> DataFrame:
    """Usable rows of committed batches as they came, deletes under the id they brought.

    ``batch_id`` and ``_lane`` are partition columns, so the filters prune folders.
    """
    log = _log(spark, root).where(F.col("_lane") == "ok")
    commits = _commit_rows(spark, root).select("batch_id")
    if upto is not None:
        log = log.where(F.col("batch_id") <= upto)
        commits = commits.where(F.col("batch_id") <= upto)
    if after is not None:
        log = log.where(F.col("batch_id") > after)
        commits = commits.where(F.col("batch_id") > after)
    return log.join(commits, "batch_id", "left_semi").select("batch_id", *CHANGE_OUT, "source_id")


def committed_log(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """Usable change rows of committed batches (optionally up to snapshot ``upto``), deletes
    under the business key of the documents they remove."""
    rows = _rows(spark, root, upto)
    if _has_id_deletes(spark, root, upto):
        rows = resolve_deletes(rows, _pairs_of(rows, rows))
    return rows.select("batch_id", *CHANGE_OUT)


def _pairs_of(rows: DataFrame, deletes: DataFrame) -> DataFrame:
    """``id_pairs`` of the ids that occur among the deletes alone: AQE broadcasts a small set of them, so the upserts aren't shuffled for it."""
    return id_pairs(rows.join(id_deletes(deletes).select("source_id"), "source_id", "left_semi"))


def dead_letter_log(spark: SparkSession, root: str) -> DataFrame:
    return (_log(spark, root).where(F.col("_lane") == "dlq")
            .select("batch_id", "seq", F.col("_reason").alias("reason"),
                    F.col("_payload").alias("payload")))


def commits(spark: SparkSession, root: str) -> DataFrame:
    return _commit_rows(spark, root).drop("batch_id", "id_deletes")


def _ids_path(base: str) -> str:
    return base.rstrip("/") + "_ids"


def _deletes_path(base: str) -> str:
    return base.rstrip("/") + "_deletes"


def _base_batch(spark: SparkSession, base: str) -> int | None:
    return spark.read.parquet(base).agg(F.max("base_batch")).first()[0]


def _tail(spark: SparkSession, root: str, base: str, upto: int | None = None) -> DataFrame:
    """Rows of the batches after the base, their deletes resolved by the documents of base and tail.

    A folded delete can belong to a document that only the tail brings (late): it
    comes again under that document's key, with a null ``batch_id``.
    """
    rows = _rows(spark, root, upto, after=_base_batch(spark, base))
    pairs = id_pairs(rows)
    ids = id_deletes(rows).select("source_id").distinct()
    known = spark.read.parquet(_ids_path(base)).join(ids, "source_id", "left_semi")
    tail = resolve_deletes(rows, _joined_pairs(pairs, known)).select("batch_id", *CHANGE_OUT)
    again = (pairs.join(spark.read.parquet(_deletes_path(base)), "source_id")
             .where(F.col("last_seq") > F.col("first_seq"))
             .select(F.col("last_seq").alias("seq"), KEY, F.lit(DELETE_OP).alias("op")))
    return tail.unionByName(again, allowMissingColumns=True)


def _joined_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("source_id", KEY).agg(F.min("first_seq").alias("first_seq"))


def _fold_on(spark: SparkSession, root: str, base: str, upto: int | None = None) -> DataFrame:
    folded = fold(_tail(spark, root, base, upto))
    return merge_folds(spark.read.parquet(base).drop("base_batch"), folded)


def state(spark: SparkSession, root: str, upto: int | None = None,
          base: str | None = None) -> DataFrame:
    """Table state: replay of the committed log, or merge-on-read over a base.

    With a base, the folded tail is merged with the base's fold: AQE broadcasts the tail
    when it is small, so the base is not shuffled.  Late rows take their place by
    ``seq``.  A version older than the base is replayed from the log.
    """
    if base is not None and upto is not None:
        folded = _base_batch(spark, base)
        if folded is not None and folded > upto:
            base = None
    if base is None:
        return replay(committed_log(spark, root, upto).drop("batch_id"))
    return folded_state(_fold_on(spark, root, base, upto))


def late_events(spark: SparkSession, root: str, base: str) -> DataFrame:
    """Committed rows after the base's batches that belong before it, per key (O43): their
    key already had a folded event with a higher or equal ``seq``."""
    tail = _tail(spark, root, base).where(F.col("batch_id").isNotNull())
    marks = spark.read.parquet(base).select(KEY, F.greatest("_last_del", "_last_up").alias("_mark"))
    marks = marks.join(tail.select(KEY).distinct(), KEY, "left_semi")
    return tail.join(marks, KEY).where(F.col("seq") <= F.col("_mark")).select("batch_id", *CHANGE_OUT)


def write_base(spark: SparkSession, root: str, upto_batch: int, path: str, base: str | None = None) -> str:
    """Fold committed batches ``<= upto_batch`` into a base dataset at ``path``.

    The base keeps the fold itself (each key's last delete and last upsert, each column's
    last value and its ``seq``; deleted keys included), so that late rows merge
    exactly.  Next to it lie the database ids with their business keys and the last
    delete of each id.  With an older ``base`` only the batches after it are read.
    """
    after = _base_batch(spark, base) if base else None
    rows = _rows(spark, root, upto_batch, after)
    if base is None and rows.isEmpty():
        raise ValueError(f"no committed rows up to batch {upto_batch}")
    pairs = id_pairs(rows)
    deletes = id_deletes(rows).select("source_id", F.col("seq").alias("last_seq"))
    if base:
        folded = _fold_on(spark, root, base, upto_batch)
        pairs = _joined_pairs(pairs, spark.read.parquet(_ids_path(base)))
        deletes = deletes.unionByName(spark.read.parquet(_deletes_path(base)))
    else:
        folded = fold(resolve_deletes(rows, pairs))
    folded.withColumn("base_batch", F.lit(upto_batch).cast("long")).write.mode("overwrite").parquet(path)
    pairs.write.mode("overwrite").parquet(_ids_path(path))
    deletes.groupBy("source_id").agg(F.max("last_seq").alias("last_seq")) \
        .write.mode("overwrite").parquet(_deletes_path(path))
    return path


def fold_expired(spark: SparkSession, root: str, expired: DataFrame, path: str) -> int | None:
    """Fold the expired prefix of the log into a base (O50 → O55).

    Only the longest run of batches ``0..b`` that are *all* expired is folded,
    so a tagged or otherwise retained snapshot stays readable through
    ``state(upto=v, base=…)``.  Returns ``b`` (None when nothing can fold).
    """
    ids = commits(spark, root).select("snapshot_id").join(
        expired.select("snapshot_id").withColumn("_exp", F.lit(True)), "snapshot_id", "left")
    first_kept = ids.where(F.col("_exp").isNull()).agg(F.min("snapshot_id")).first()[0]
    upto = (ids.where(F.col("snapshot_id") < first_kept) if first_kept is not None else ids) \
        .agg(F.max("snapshot_id")).first()[0]
    if upto is None:
        return None
    write_base(spark, root, upto, path)
    return upto


def as_of_version(spark: SparkSession, root: str, version: int, base: str | None = None) -> DataFrame:
    """State at a committed snapshot (O45); an unknown one raises."""
    h.commit_time(commits(spark, root), version)
    return state(spark, root, version, base)


def as_of_timestamp(spark: SparkSession, root: str, at: str, base: str | None = None) -> DataFrame:
    """State at the newest commit not after ``at`` (O46); no rows before the first one."""
    version = h.snapshot_at(commits(spark, root), at)
    return state(spark, root, -1 if version is None else version, base)


def tag(spark: SparkSession, root: str, policy: list[tuple[str, str]]) -> DataFrame:
    """Store the policy's tags (O47); a tag that exists already moves."""
    (h.tag_snapshots(spark, commits(spark, root), policy).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("tag").parquet(f"{root}/tags"))
    return tags(spark, root)


def tags(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("snapshot_id long, committed_at timestamp_ntz, tag string").parquet(f"{root}/tags")


def as_of_tag(spark: SparkSession, root: str, name: str, base: str | None = None) -> DataFrame:
    """State at a stored tag."""
    return state(spark, root, h.tagged(tags(spark, root), name), base)


def diff(spark: SparkSession, root: str, v_from: int, v_to: int) -> DataFrame:
    """Rows added, removed or changed between two committed snapshots, older → newer.

    One fold of the log, both versions side by side.  A delete by database id is resolved for each version by the
    documents of that version, so the result is the difference of the two states also when a document arrives after its delete.
    """
    lo, hi = sorted((v_from, v_to))
    return h.diff_marked(_marked(spark, root, lo, hi), lo)


def _marked(spark: SparkSession, root: str, lo: int, hi: int) -> DataFrame:
    """Rows up to ``hi`` with ``_in_old`` (they make version ``lo``) and ``_in_new`` (version ``hi``)."""
    h.commit_times(commits(spark, root), [lo, hi])  # an unknown version raises
    rows = _rows(spark, root, hi)
    old, both = F.col("batch_id") <= lo, F.lit(True)
    if not _has_id_deletes(spark, root, hi):
        return rows.select("batch_id", *CHANGE_OUT).withColumn("_in_old", old).withColumn("_in_new", both)
    plain = rows.where(~keyed_by_id()).withColumn("_in_old", old).withColumn("_in_new", both)
    deletes = id_deletes(rows)
    before, upto = rows.where(old), rows
    sides = [resolve_deletes(deletes.where(old), _pairs_of(before, before)).withColumn("_in_old", F.lit(True)).withColumn("_in_new", F.lit(False)),
             resolve_deletes(deletes, _pairs_of(upto, upto)).withColumn("_in_old", F.lit(False)).withColumn("_in_new", F.lit(True))]
    return plain.unionByName(sides[0]).unionByName(sides[1]).select("batch_id", *CHANGE_OUT, "_in_old", "_in_new")


def signed_changes(spark: SparkSession, root: str, v_from: int, v_to: int, base: str | None = None) -> DataFrame:
    """What happened between two versions as signed rows: ``sign`` -1 with a row as it was, 1 with it as it is.

    Without a base the touched keys are folded from the log; a base that isn't newer than ``v_from`` stands for
    the batches that it holds, and of both only the touched keys' rows are folded.
    """
    h.commit_times(commits(spark, root), [v_from, v_to])
    folded = _base_batch(spark, base) if base else None
    if folded is None or folded > v_from:
        marked = _marked(spark, root, v_from, v_to)
        touched = marked.where((F.col("batch_id") > v_from) | (F.col("_in_old") != F.col("_in_new"))).select(KEY).distinct()
        return h.signed_rows(h.fold_sides(marked.join(touched, KEY, "left_semi"), v_from))
    before, after = (_tail(spark, root, base, v) for v in (v_from, v_to))
    touched = after.where(F.col("batch_id").isNull() | (F.col("batch_id") > v_from)).select(KEY).distinct()
    held = spark.read.parquet(base).drop("base_batch").join(touched, KEY, "left_semi")
    sides = [cut_lineage(merge_folds(held, fold(tail.join(touched, KEY, "left_semi"))), "touched-keys") for tail in (before, after)]
    old, new = (side.select(KEY, *[F.col(c).alias(f"_{name}_{c}") for c in side.columns if c != KEY]) for name, side in zip(("old", "new"), sides))
    return h.signed_rows(new.join(old, KEY, "left").select(KEY, *[c for c in (*old.columns, *new.columns) if c != KEY]))


def refresh_totals(spark: SparkSession, root: str, path: str, base: str | None = None, dim: str = "merchant_id") -> DataFrame:
    """The stored totals of the newest version (O31), brought up to date by the changes since they were stored.

    Totals of a version lie in ``upto=<version>`` below ``path``; a run writes the newest version's and reads the one before, so a
    repeated or failed run counts nothing twice.
    """
    newest = commits(spark, root).agg(F.max("snapshot_id")).first()[0]
    if newest is None:
        raise ValueError(f"{root} has no commits")
    try:
        stored = spark.read.schema(f"{dim} string, sum_exact decimal(38,2), amount_count long, order_count long, upto long").parquet(path)
        have = stored.where(F.col("upto") <= newest).agg(F.max("upto")).first()[0]
    except AnalysisException:  # the first run
        stored, have = None, None
    if have != newest:
        if have is None:
            totals = agg.exact_totals(state(spark, root, newest, base), dim)
        else:
            totals = agg.apply_signed(stored.where(F.col("upto") == have).drop("upto"), signed_changes(spark, root, have, newest, base), dim)
        totals.write.mode("overwrite").parquet(f"{path}/upto={newest}")
    return agg.totals_view(spark.read.parquet(f"{path}/upto={newest}"), dim)
