"""Grades of streams whose files come one by one: each file is read once, its partial result is kept, and partial results merge.

A partial result holds what a file's neighbours can't change, and its borders:

* totals: counts, first and last time, place in the order of arrival, number of snapshots, last id at its end;
* gaps: pairs of consecutive event times at least the threshold apart. Between two of them the file has a run of times
  that no gap of the whole day can lie in, so the day's gaps are those between the union of all files' runs, and files
  may overlap in time as they like;
* segments: sums of each snapshot's segment. Segment 0 goes on with the one that an earlier file left open; its updates
  that come before the file's first id are kept as numbers of rows an id, to be compared with the id the file begins at.

Files of a stream and day must not overlap in the order of arrival. Rows of all parts share one table, a folder a stream and
day; a day's partial results are a few rows a file, gap and snapshot, so windows over them are small: a file and day has at
most a day over the threshold of gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import seconds
from ..functions.staging import staged
from .continuity import KEY, followed, time_gaps_sorted
from .quality import bad_segment, graded

COUNTS = ["lines", "json_errors", "updates", "snapshots", "control_events"]
#: Columns of a partial result after keys, file and part.
PARTIALS = {
    "threshold": "double", "arrival": "long", "lines": "long", "json_errors": "long", "updates": "long", "snapshots": "long", "control_events": "long", "first_us": "long", "last_us": "long", "border": "struct<last_id: long>",
    "prev_us": "long", "us": "long", "segment": "long", "head_id": "long", "rows": "long", "snap_id": "long", "with_ids": "long", "first": "struct<arrival: long, first_id: long, last_id: long>", "sequence_gaps": "long",
}


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    on = F.lit(True)
    for c in columns:
        on &= a[c].eqNullSafe(b[c])
    return on


def file_partials(messages: DataFrame, threshold: float = 2.0, keys: list[str] = KEY, file: str = "file") -> DataFrame:
    """Partial results of each file: keys, file, part (totals, gap, segment), and the columns of PARTIALS that the part has."""
    by = [*keys, file]
    update, snapshot = F.col("msg") == "update", F.col("msg") == "snapshot"
    count = lambda m: F.count_if(F.col("msg") == m)
    none = F.lit(None).cast("long")
    seen = F.when(snapshot, F.struct(none.alias("last_id"))).when(update & F.col("last_id").isNotNull(), F.struct("last_id"))
    totals = messages.groupBy(*by).agg(
        F.min("arrival").alias("arrival"), F.count("*").alias("lines"), count("json_error").alias("json_errors"), count("update").alias("updates"), count("snapshot").alias("snapshots"), count("control").alias("control_events"),
        F.min(F.when(update, F.col("us"))).alias("first_us"), F.max(F.when(update, F.col("us"))).alias("last_us"), F.max_by(seen, F.when(seen.isNotNull(), F.col("arrival"))).alias("border"),
    )
    gaps = time_gaps_sorted(messages.where(update), by).where(F.col("seconds") >= threshold).select(*by, "prev_us", "us")
    rows = followed(messages, by)
    head = F.when((F.col("segment") == 0) & F.col("_seen").isNull(), F.col("first_id"))
    with_ids = update & F.col("first_id").isNotNull() & F.col("last_id").isNotNull()
    segments = rows.withColumn("head_id", head).groupBy(*by, "segment", "head_id").agg(
        F.count("*").alias("rows"), F.max(F.when(snapshot, F.col("snap_id"))).alias("snap_id"), F.count_if(with_ids).alias("with_ids"),
        F.min(F.when(with_ids, F.struct("arrival", "first_id", "last_id"))).alias("first"), F.count_if("is_gap").alias("sequence_gaps"),
    )
    out = None
    for part, df in (("totals", totals), ("gap", gaps), ("segment", segments)):
        df = df.withColumns({"part": F.lit(part), "threshold": F.lit(float(threshold))})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out.select(*keys, file, "part", *[F.col(c).cast(t).alias(c) for c, t in PARTIALS.items()])


def merge_partials(partials: DataFrame, threshold: float = 2.0, keys: list[str] = KEY, file: str = "file") -> DataFrame:
    """The grade of each stream and day over all its files, as grade_capture has it.

    The threshold may be over the one that the files were read with; a smaller one is an error.
    """
    fits = F.when(F.col("threshold") <= threshold, F.lit(True)).otherwise(F.raise_error(F.lit("the files were read with a larger threshold")).cast("boolean"))
    files = partials.where((F.col("part") == "totals") & fits).select(*keys, file, "arrival", *COUNTS, "first_us", "last_us", "border")
    totals = files.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in COUNTS], F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"))

    # Runs of times: from a gap's end (or the first time) to the next gap's start (or the last time).
    starts = files.where("first_us IS NOT NULL").select(*keys, file, F.col("first_us").alias("start"), F.lit(None).cast("long").alias("before"), "last_us")
    starts = starts.unionByName(partials.where("part = 'gap'").select(*keys, file, F.col("us").alias("start"), F.col("prev_us").alias("before"), F.lit(None).cast("long").alias("last_us")))
    in_file = Window.partitionBy(*keys, file).orderBy("start", F.col("before").asc_nulls_first())
    whole = in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = starts.select(*keys, "start", F.coalesce(F.lead("before").over(in_file), F.max("last_us").over(whole)).alias("end"))
    earlier = Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    over = runs.withColumn("gap", F.col("start") - F.max("end").over(earlier)).where(seconds(F.col("gap")) >= threshold)
    gaps = over.groupBy(*keys).agg(F.count("*").alias("time_gaps"), F.sum("gap").alias("_sum"), F.max("gap").alias("_max"))

    # What each file begins with: snapshots so far, and the last id since the last of them.
    before = Window.partitionBy(*keys).orderBy("arrival", file).rowsBetween(Window.unboundedPreceding, -1)
    begins = files.select(*keys, file, F.coalesce(F.sum("snapshots").over(before), F.lit(0)).alias("_base"), F.last("border", ignorenulls=True).over(before)["last_id"].alias("_last"))
    parts = partials.where("part = 'segment'").select(*keys, file, "segment", "head_id", "rows", "snap_id", "with_ids", "first", "sequence_gaps")
    joined = parts.join(begins.select(*[F.col(c).alias(f"_{c}") for c in [*keys, file]], "_base", "_last"), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*keys, file]], "left")
    broken = F.when(F.col("head_id") != F.col("_last") + 1, F.col("rows")).otherwise(0)
    segments = joined.groupBy(*keys, (F.col("segment") + F.col("_base")).alias("segment")).agg(F.max("snap_id").alias("snap_id"), F.sum("with_ids").alias("n"), F.min("first").alias("f"), F.sum(F.col("sequence_gaps") + broken).alias("sequence_gaps"))
    target = F.col("snap_id") + 1
    bridge = F.when(F.col("n") > 0, F.coalesce((F.col("f.first_id") <= target) & (target <= F.col("f.last_id")), F.lit(False)))
    summed = segments.withColumn("bridges_snapshot", bridge).groupBy(*keys).agg(F.sum("sequence_gaps").alias("seq_gaps"), F.count_if(bad_segment()).alias("bad_segments"))
    return graded(totals.join(gaps, keys, "left").join(summed, keys, "left"), keys)


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def stored_partials(messages: DataFrame, store: str, keys: list[str] = KEY, file: str = "file") -> DataFrame:
    """The partial results in a store, typed as those of messages; empty where there is no store yet."""
    spark = messages.sparkSession
    fields = {f.name: f.dataType.simpleString() for f in messages.schema.fields}
    schema = ", ".join([*(f"`{c}` {fields[c]}" for c in [*keys, file]), "part string", *(f"{c} {t}" for c, t in PARTIALS.items())])
    if not _exists(spark, store):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(store)


def new_files(files: DataFrame, store: str, keys: list[str] = KEY, file: str = "file") -> DataFrame:
    """Those of the listed files (keys, file) that have no partial result yet."""
    done = stored_partials(files, store, keys, file).where("part = 'totals'").select(*keys, file)
    return files.join(done, _same(files, done, [*keys, file]), "left_anti")


def add_files(messages: DataFrame, store: str, threshold: float = 2.0, keys: list[str] = KEY, file: str = "file") -> DataFrame:
    """Takes in the messages of some whole files and grades the days they belong to anew; no other file is read.

    A file that is added again replaces its partial result, so a retried run changes nothing. The days' folders are replaced
    whole, from a table that is written first; one run at a time may write to a store.
    """
    new = staged(file_partials(messages, threshold, keys, file), "partials")
    old = stored_partials(messages, store, keys, file)
    days, files = new.select(*keys).distinct(), new.where("part = 'totals'").select(*keys, file)
    old = old.join(days, _same(old, days, keys), "left_semi")
    old = old.join(files, _same(old, files, [*keys, file]), "left_anti")
    both = staged(old.unionByName(new), "partials-days")
    both.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(store)
    return merge_partials(both, threshold, keys, file)


def stored_grades(messages: DataFrame, store: str, threshold: float = 2.0, keys: list[str] = KEY, file: str = "file") -> DataFrame:
    """The grades of all days in a store, from partial results alone."""
    return merge_partials(stored_partials(messages, store, keys, file), threshold, keys, file)
