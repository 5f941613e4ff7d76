"""Follow the event log as a stream and keep the state up to date.

The state is kept in hash buckets of the tid, as ``base=<v>``, all objects, and
``delta=<v>``, the objects that batch ``v`` touched, each with a folder per bucket. A
batch opens only the buckets of the objects it names, so its work grows with those and
not with the state. A table ``versions`` names the folders that are complete, so one
that a lost job left half written is never read. Every ``deltas_per_base`` batches
the parts are merged into a new base, and the parts before the base that it replaces
are removed: whoever began to read that one can finish. Versions are the
stream's batch numbers: a state and its checkpoint belong together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.apply import confirm_in_bulk, empty_state, fold
from tidelog.sources.eventlog import CONTENTS, SCHEMA
from tidelog.specs import CollectionSpec

BUCKETS = 64


def _bucket(tid: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(tid), F.lit(buckets)).cast("int")


def _parts(spark: SparkSession, path: str) -> tuple[list[int], list[int], int]:
    """The versions of all bases, those of the deltas after the newest base, in order, and the number of buckets."""
    try:
        complete = spark.read.schema("kind string, version long, buckets int").parquet(f"{path}/versions").distinct().collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return [], [], BUCKETS
    bases = sorted(r["version"] for r in complete if r["kind"] == "base")
    deltas = sorted(r["version"] for r in complete if r["kind"] == "delta" and (not bases or r["version"] > bases[-1]))
    return bases, deltas, complete[0]["buckets"]


def write_part(rows: DataFrame, path: str, kind: str, version: int, buckets: int = BUCKETS) -> None:
    """Write ``rows`` as the ``base`` or ``delta`` of a version and name it as complete. What an earlier attempt left is overwritten.

    The number of buckets is that of the first part: more for larger states, as a bucket is one task's work.
    """
    bases, deltas, known = _parts(rows.sparkSession, path)
    buckets = known if bases or deltas else buckets
    dealt = rows.withColumn("_bucket", _bucket(F.col("_tid"), buckets)).repartition("_bucket")
    dealt.write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/{kind}={version}")
    rows.sparkSession.createDataFrame([(kind, version, buckets)], "kind string, version long, buckets int").coalesce(1).write.mode("append").parquet(f"{path}/versions")


def latest(spark: SparkSession, path: str, coll: CollectionSpec, buckets: list[int] | None = None) -> tuple[DataFrame, int]:
    """The state below ``path`` and its version; an empty one and -1 where there is none. With ``buckets`` only those folders are opened.

    Of an object's rows the one of the newest delta counts. Rows without tid can only
    be in the base and stay as they are.
    """
    bases, deltas, _ = _parts(spark, path)
    empty = empty_state(coll, spark)

    def read(kind: str, v: int) -> DataFrame:
        part = spark.read.schema(empty.withColumn("_bucket", F.lit(0)).schema).parquet(f"{path}/{kind}={v}")
        return (part if buckets is None else part.where(F.col("_bucket").isin(buckets))).drop("_bucket")

    state = read("base", bases[-1]) if bases else empty
    if deltas:
        rows = reduce(DataFrame.unionByName, (read("delta", v).select(F.lit(v).alias("v"), F.struct("*").alias("row")) for v in deltas))
        newest = rows.groupBy(F.col("row._tid").alias("tid")).agg(F.max_by("row", "v").alias("row"))
        state = state.join(rows.select(F.col("row._tid").alias("_tid")).distinct(), "_tid", "left_anti").select(*empty.columns).unionByName(newest.select("row.*"))
    return state, max([-1, *bases[-1:], *deltas])


def _named(events: DataFrame) -> DataFrame:
    """``_tid`` of all objects that a batch names, itself or in a bulk confirm."""
    confirmed = events.where("action = 'BULKCONFIRM'").select(F.explode(F.from_json("contents", CONTENTS)["confirms"]).alias("m")).select(F.col("m.tid").alias("_tid"))
    return events.select(F.col("tid").alias("_tid")).unionByName(confirmed).where("_tid IS NOT NULL").distinct()


def touched_state(events: DataFrame, path: str, coll: CollectionSpec) -> DataFrame:
    """The rows of the objects that a batch names, from their buckets only (as many numbers as there are buckets reach the driver)."""
    spark = events.sparkSession
    names, buckets = _named(events), _parts(spark, path)[2]
    wanted = [r[0] for r in names.select(_bucket(F.col("_tid"), buckets)).distinct().collect()]
    state, _ = latest(spark, path, coll, wanted)
    return state.join(names, "_tid", "left_semi").select(*state.columns)


def expire(spark: SparkSession, path: str) -> list[str]:
    """Remove the parts that came before the newest base but one, and return their names. Their entries in ``versions`` go stale and do no harm."""
    bases, _, _ = _parts(spark, path)
    if len(bases) < 2:
        return []
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files, removed = root.getFileSystem(spark._jsc.hadoopConfiguration()), []
    for status in files.listStatus(root):
        name = status.getPath().getName()
        kind, _, version = name.partition("=")
        old = {"base": lambda v: v < bases[-2], "delta": lambda v: v <= bases[-2]}.get(kind)
        if old and old(int(version)) and files.delete(status.getPath(), True):
            removed.append(name)
    return sorted(removed)


def apply_batch(events: DataFrame, path: str, coll: CollectionSpec, epoch: int, deltas_per_base: int = 16) -> None:
    """Fold one batch, bulk confirms after it, into the objects it names and write those as a delta.

    A batch that is seen again changes nothing: a version already complete isn't written
    twice, and events at or below an object's last event are passed over. A batch
    without events writes an empty delta.
    """
    spark = events.sparkSession
    bases, deltas, _ = _parts(spark, path)
    if epoch > max([-1, *bases[-1:], *deltas]):
        write_part(confirm_in_bulk(fold(touched_state(events, path, coll), events, coll).state, events), path, "delta", epoch)
        deltas.append(epoch)
    if len(deltas) >= deltas_per_base:
        state, version = latest(spark, path, coll)
        write_part(state, path, "base", version)
        expire(spark, path)


def apply_stream(spark: SparkSession, log_path: str, state_path: str, checkpoint: str, coll: CollectionSpec, files_per_batch: int = 64, deltas_per_base: int = 16) -> StreamingQuery:
    """Start following the log; the checkpoint is the offset. With ``availableNow`` it stops when it has caught up."""
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(log_path)
    own = stream.where((F.col("catalogue") == coll.catalogue) & (F.col("entity") == coll.name))
    return own.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, epoch: apply_batch(df, state_path, coll, epoch, deltas_per_base)).start()
