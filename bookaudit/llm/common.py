"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_DIR: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or where that is unset a local one, in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIR:
        _LOCAL_DIR[app] = tempfile.mkdtemp(prefix="spark-stage-")
    return _LOCAL_DIR[app]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused_name(name: str, *frames: DataFrame) -> str:
    """name, lengthened until no frame has a column that begins with it."""
    taken = [c.lower() for f in frames for c in f.columns]
    while any(c.startswith(name.lower()) for c in taken):
        name = f"{name}_"
    return name


#: Bits of a key bitmap: 2,048 pieces of 32,768 bits, 8 MB at most whatever the data.
KEY_BITS = 1 << 26


def with_flag(df: DataFrame, key: list[str], wanted: DataFrame, flag: str) -> DataFrame:
    """df with a boolean column: false where no row of wanted (its first columns, in the order of key) can have this key.

    A bitmap of hashed keys is broadcast; it has at most 8 MB. True only says maybe, so a join decides on what is left,
    and need not shuffle the rest.
    """
    place = lambda cols: F.pmod(F.xxhash64(*cols), F.lit(KEY_BITS)) + 1
    p = place(map(F.col, wanted.columns[: len(key)]))
    maps = wanted.select(F.bitmap_bucket_number(p).alias("_piece"), F.bitmap_bit_position(p).alias("_bit")).groupBy("_piece").agg(F.bitmap_construct_agg("_bit").alias("_map"))
    q = place(map(F.col, key))
    piece, bits, at = (unused_name(f"_{n}", df) for n in ("piece", "map", "at"))
    maps = maps.withColumnsRenamed({"_piece": piece, "_map": bits})
    out = df.withColumns({piece: F.bitmap_bucket_number(q), at: F.bitmap_bit_position(q)}).join(F.broadcast(maps), piece, "left")
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, (F.col(at) % 8).cast("int")) == 1
    return out.withColumn(flag, F.coalesce(hit, F.lit(False))).drop(piece, bits, at)


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; every other code point stays."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(doc_id: str | Column, k: int) -> Column:
    """crc32(doc_id as text) mod k."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string").cast("binary")) % k


def unit_hash(*cols: Column) -> Column:
    """A repeatable uniform number in [0, 1) from a row's own values."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit counter hash, on uint64 arrays."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def batch_bytes(array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string array, end to end, and the offsets of its rows (null: empty)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = pc.fill_null(array, "").cast(pa.large_string())
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64, count=len(array) + 1 + array.offset)[array.offset :]
    data = array.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]
