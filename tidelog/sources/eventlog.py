"""The append-only event log: Parquet partitioned by catalogue, entity and source."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.functions.ranges import parts_for
from tidelog.operators.diff import spread_key
from tidelog.sources.shared import written

SCHEMA = "eventid long, timestamp timestamp, version string, action string, source_id string, contents string, application string, tid string, catalogue string, entity string, source string"
CONTENTS = "entity map<string,string>, modifications array<struct<key:string,old_value:string,new_value:string>>, confirms array<struct<tid:string,last_event:long>>, _last_event long, _hash string"


def assign_ids(events: DataFrame, start: int, buckets: int | None = None) -> DataFrame:
    """Add dense ``eventid``s above ``start``: numbers within hash buckets of the tid, plus the buckets' offsets.

    No task sees more than a bucket; the offsets are a row per bucket. There are 256 buckets,
    or more for very many events, which are written first then, so that they are computed
    once. Within a tid, ids follow the event type. Packs (``pack`` of ``pack_confirms``) come after
    all other events: only their numbers are sorted, their members stay where they are, and
    all rows of a pack get its one id.
    """
    if buckets is None:
        events = written(events, "events")
        buckets = parts_for(events, 256)
    if "pack" in events.columns:
        single, packed = events.where("pack IS NULL"), events.where("pack IS NOT NULL")
        nth = F.row_number().over(W.orderBy("pack"))
        ids = packed.select("pack").distinct().select("pack", (F.lit(start + single.count()) + nth).alias("eventid"))  # a row per pack
        return assign_ids(single.drop("pack"), start, buckets).unionByName(packed.join(F.broadcast(ids), "pack").drop("pack"))
    rows = events.withColumn("_bucket", spread_key(F.coalesce("tid", F.lit("")), buckets))
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = sizes.select("_bucket", (F.sum("_n").over(W.orderBy("_bucket")) - F.col("_n")).alias("_before"))
    numbered = rows.withColumn("_rn", F.row_number().over(W.partitionBy("_bucket").orderBy("tid", "event")))
    return numbered.join(F.broadcast(before), "_bucket").withColumn("eventid", F.lit(start) + F.col("_before") + F.col("_rn")).drop("_bucket", "_before", "_rn")  # ``buckets`` rows


def log_rows(events: DataFrame, catalogue: str, entity: str, source: str, application: str, timestamp: str) -> DataFrame:
    """Log rows of events with ids; the payload as JSON, null values of an entity kept."""
    confirms = F.col("confirms") if "confirms" in events.columns else F.lit(None).cast("array<struct<tid:string,last_event:long>>")
    payload = F.struct("entity", "modifications", confirms.alias("confirms"), F.col("last_event").alias("_last_event"), F.col("hash").alias("_hash"))
    return events.select(
        "eventid", F.lit(timestamp).cast("timestamp").alias("timestamp"), "version", F.col("event").alias("action"), F.lit(None).cast("string").alias("source_id"),
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("contents"), F.lit(application).alias("application"), "tid",
        F.lit(catalogue).alias("catalogue"), F.lit(entity).alias("entity"), F.lit(source).alias("source"),
    )


def append(rows: DataFrame, path: str) -> None:
    """Append to the log; partitions appear as they are needed."""
    rows.write.mode("append").partitionBy("catalogue", "entity", "source").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log with its fixed schema; filters on catalogue, entity and source prune folders."""
    return spark.read.schema(SCHEMA).parquet(path)


def _files(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    """Some of the log's files, with the columns that their folders stand for."""
    return spark.read.schema(SCHEMA).option("basePath", path).parquet(*files)


def index_files(spark: SparkSession, path: str) -> DataFrame:
    """The log's manifest, ``file, least, last, events``: brought up to date from the files that it doesn't have yet, and without those that are gone.

    It lies in ``_manifest`` below the log, which readers of the log pass over. Files
    never change once written, so each is read once, its ids only.
    """
    present = set(read_log(spark, path).inputFiles())
    empty = spark.createDataFrame([], "file string, least long, last long, events long")
    try:
        known = spark.read.schema(empty.schema).parquet(f"{path}/_manifest").dropDuplicates(["file"])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        known = empty
    missing = sorted(present - {r["file"] for r in known.select("file").collect()})
    if missing:
        found = _files(spark, path, missing).select(F.input_file_name().alias("file"), "eventid").groupBy("file")
        found = found.agg(F.min("eventid").alias("least"), F.max("eventid").alias("last"), F.count("*").alias("events"))
        found.coalesce(1).write.mode("append").parquet(f"{path}/_manifest")
        known = spark.read.schema(empty.schema).parquet(f"{path}/_manifest").dropDuplicates(["file"])
    return known.join(F.broadcast(spark.createDataFrame([(f,) for f in present], "file string")), "file", "left_semi")


def tail_of_files(spark: SparkSession, path: str, after: int, catalogue: str | None = None, entity: str | None = None, source: str | None = None) -> DataFrame:
    """``tail`` of the log below ``path``, of which only the files are opened that have events after id ``after`` by the manifest."""
    files = [r["file"] for r in index_files(spark, path).where(F.col("last") > after).select("file").collect()]
    log = _files(spark, path, sorted(files)) if files else spark.createDataFrame([], SCHEMA)
    return tail(log, after, catalogue, entity, source)


def _folder(spark: SparkSession, path: str, catalogue: str, entity: str):
    """The file system and the folder of a collection's events."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/catalogue={catalogue}/entity={entity}")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def purge_files(spark: SparkSession, path: str, catalogue: str, entity: str) -> bool:
    """Remove a collection's folder from the log; no other file is touched. Whether there was one."""
    files, folder = _folder(spark, path, catalogue, entity)
    return files.delete(folder, True)


def rename_files(spark: SparkSession, path: str, catalogue: str, old: str, new: str) -> None:
    """Give a collection's events a new entity: its folder is written anew under the new name, then removed; no other file is touched.

    If it ends midway it can be run again: the new folder is overwritten until the
    old one is gone. A new name that has other events already is an error.
    """
    rows = read_log(spark, path).where((F.col("catalogue") == catalogue) & (F.col("entity").isin(old, new)))
    ids = rows.groupBy("entity").agg(F.count("*").alias("n"), F.min("eventid").alias("least"), F.max("eventid").alias("last")).collect()
    by = {r["entity"]: r for r in ids}
    if old not in by:
        return
    if new in by and (by[new]["n"] > by[old]["n"] or by[new]["least"] < by[old]["least"] or by[new]["last"] > by[old]["last"]):
        raise ValueError(f"{catalogue} {new} has events of its own")
    moved = rows.where(F.col("entity") == old).withColumn("entity", F.lit(new))
    moved.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("catalogue", "entity", "source").parquet(path)
    purge_files(spark, path, catalogue, old)


def _chosen(log: DataFrame, catalogue: str | None, entity: str | None, source: str | None) -> DataFrame:
    for name, value in (("catalogue", catalogue), ("entity", entity), ("source", source)):
        if value is not None:
            log = log.where(F.col(name) == value)
    return log


def tail(log: DataFrame, after: int, catalogue: str | None = None, entity: str | None = None, source: str | None = None) -> DataFrame:
    """The events after id ``after``; order within a tid is for the reader to set by ``eventid``."""
    return _chosen(log, catalogue, entity, source).where(F.col("eventid") > after)


def sources(log: DataFrame, catalogue: str | None = None, entity: str | None = None, source: str | None = None) -> DataFrame:
    """The combinations of source, catalogue and entity that have events; None stands for any."""
    return _chosen(log, catalogue, entity, source).select("source", "catalogue", "entity").distinct()


def dependencies_met(log: DataFrame, depends_on: list[dict[str, str]]) -> DataFrame:
    """``dependency, met`` for each list of key-value conditions (a leading ``_`` of a key is ignored): met if any event fits."""
    checks = []
    for condition in depends_on:
        fits = F.lit(True)
        for key, value in sorted(condition.items()):
            fits &= F.col(key.lstrip("_")) == value
        checks.append((", ".join(f"{k}={v}" for k, v in sorted(condition.items())), fits))
    found = log.agg(*[F.count_if(fits).alias(f"c{i}") for i, (_, fits) in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(name).alias("dependency"), (F.col(f"c{i}") > 0).alias("met")) for i, (name, _) in enumerate(checks)])
    return found.select(F.inline(rows))


def has_any(df: DataFrame, **conditions) -> bool:
    """Whether a row fits all conditions."""
    for key, value in conditions.items():
        df = df.where(F.col(key) == value)
    return not df.isEmpty()


def any_row(df: DataFrame, **conditions) -> DataFrame:
    """One row ``found``: whether a row fits all conditions; the answer as a table, for plans."""
    for key, value in conditions.items():
        df = df.where(F.col(key) == value)
    return df.limit(1).agg((F.count("*") > 0).alias("found"))


def store(log: DataFrame, events: DataFrame, state: DataFrame, path: str, catalogue: str, entity: str, source: str, application: str, timestamp: str, applied: int | None = None) -> DataFrame:
    """Store new ``events`` in the log below ``path`` and return ``update_stats`` of them.

    Only a state that has all of its log may take events: one that is behind or ahead
    is an error, as its events were made on something else. ``applied`` says up to which
    event the state has its log, where its last events (bulk confirms, say) left no
    mark in a row of it. Stale and repeated events are counted and not stored. Ids go
    on above the highest of the whole log.
    """
    own = log.where((F.col("catalogue") == catalogue) & (F.col("entity") == entity))
    status = model_status(state, own, applied).first()["status"]
    if status != "up to date":
        raise ValueError(f"{catalogue} {entity}: the state is {status}")
    top = log.agg(F.coalesce(F.max("eventid"), F.lit(0))).first()[0]
    validated = validate_events(events, state)
    validated = written(validated, "validated")  # stored and counted from one evaluation
    stored = assign_ids(validated.where("valid").drop("valid"), top, parts_for(validated, 256))
    append(log_rows(stored, catalogue, entity, source, application, timestamp), path)
    return update_stats(validated)


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    """``collection, applied``: up to which event each collection's state has its log."""
    return spark.read.schema("collection string, applied long").parquet(path).groupBy("collection").agg(F.max("applied").alias("applied"))


def write_marks(marks: DataFrame, path: str) -> None:
    """Add marks (``collection, applied``), after the states they speak of are written; earlier ones of a collection count no more."""
    marks.select("collection", F.col("applied").cast("long").alias("applied")).coalesce(1).write.mode("append").parquet(path)


def model_status(state: DataFrame, log: DataFrame, applied: int | None = None) -> DataFrame:
    """One row ``entity_max, log_max, status``: a state ahead of its log is corrupted, behind it out of date, else up to date.

    ``entity_max`` is the state's greatest last event, or ``applied`` where that is more:
    bulk confirms, orphans and violations raise the log's head and no row's last event.
    """
    top = F.coalesce(F.max("_last_event"), F.lit(0))
    top = top if applied is None else F.greatest(top, F.lit(applied))
    s = state.agg(top.cast("long").alias("entity_max"))
    e = log.agg(F.coalesce(F.max("eventid"), F.lit(0)).cast("long").alias("log_max"))
    status = F.when(F.col("entity_max") > F.col("log_max"), "corrupted").when(F.col("entity_max") == F.col("log_max"), "up to date").otherwise("out of date")
    both = s.withColumn("_k", F.lit(1)).join(e.withColumn("_k", F.lit(1)), "_k").drop("_k")
    return both.withColumn("status", status)


def validate_events(events: DataFrame, state: DataFrame) -> DataFrame:
    """Add ``valid``: an ADD of an unknown tid, or an event made on the entity's last event (both unknown counts as equal).

    A stale or repeated event isn't valid, so storing is idempotent. Packs of confirms have no
    tid and fit no row; they are dealt out by their first member, or one task would get all of them.
    """
    known = state.select(F.col("_tid").alias("_known"), F.col("_last_event").alias("_known_event"))
    dealt = F.coalesce("tid", F.get("confirms", F.lit(0))["tid"]) if "confirms" in events.columns else F.col("tid")
    events = events.withColumn("_dealt", dealt)
    joined = events.join(known, (events["_dealt"] == known["_known"]) & events["tid"].isNotNull(), "left")
    valid = ((F.col("event") == "ADD") & F.col("_known").isNull()) | F.col("last_event").eqNullSafe(F.col("_known_event"))
    return joined.withColumn("valid", valid).drop("_dealt", "_known", "_known_event")


def update_stats(validated: DataFrame) -> DataFrame:
    """``action, stored, skipped, share``; a BULKCONFIRM counts its members as CONFIRM; share is of all that is stored."""
    size = F.when(F.col("event") == "BULKCONFIRM", F.size("confirms")).otherwise(1) if "confirms" in validated.columns else F.lit(1)
    action = F.when(F.col("event") == "BULKCONFIRM", "CONFIRM").otherwise(F.col("event"))
    rows = validated.select(action.alias("action"), "valid", size.cast("long").alias("n"))
    sums = rows.groupBy("action").agg(F.coalesce(F.sum(F.when(F.col("valid"), F.col("n"))), F.lit(0)).alias("stored"), F.coalesce(F.sum(F.when(~F.col("valid"), F.col("n"))), F.lit(0)).alias("skipped"))
    return sums.withColumn("share", F.round(F.col("stored") / F.greatest(F.lit(1), F.sum("stored").over(W.partitionBy())), 6))


def needs_analysis(stats: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One row ``changed_share, analyze``: whether more than ``threshold`` of what is stored are changes."""
    share = 1 - F.coalesce(F.sum(F.when(F.col("action") == "CONFIRM", F.col("share"))), F.lit(0.0))
    return stats.agg(F.round(share, 6).alias("changed_share")).withColumn("analyze", F.col("changed_share") > threshold)
