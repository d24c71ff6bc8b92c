"""Many small files: a folder for each value of a column, with one file in it."""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's name for NULL and an empty text
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")
_SUM_BYTES = 512  # of a file, for each checksum
_BLOCK = 128 * _SUM_BYTES


def write_folders(df: DataFrame, column: str, path: str, kind: str, replace: bool = False) -> None:
    """Add to ``path`` a folder for each value of ``column``, named as by ``partitionBy``, with a file of
    its rows in it. ``kind`` is csv (with a header), json or text. With ``replace`` what a folder held before
    goes; other folders stay.

    The cost lies in the files and not in their bytes, so the number of tasks is given and not left to
    their size. On Hadoop's local file system each file that Spark's writer makes starts a program twice
    (``chmod``, also for the checksums), which takes longer than all the rest, so there the tasks write the
    lines themselves: those of Spark's functions, with checksums that Spark verifies. A file shows once it is
    whole, and a task that is run again writes the same name.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = _local_place(spark, path)
    if place is None:
        # Tasks move their files into place themselves, not the driver one folder after the other.
        writer = df.repartition(tasks, column).write.partitionBy(column).option("header", True)
        writer = writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        if replace:
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.mode("overwrite" if replace else "append").format(kind).save(path)
        return
    cells = [name for name in df.columns if name != column]
    row = F.struct(*[f"`{name}`" for name in cells])
    line = {"csv": F.to_csv, "json": F.to_json, "text": lambda one: one[cells[0]]}[kind](row)
    header = None
    if kind == "csv":
        header = spark.range(1).select(F.to_csv(F.struct(*map(F.lit, cells)))).first()[0]
    value = F.col(column).cast("string")
    folder = F.coalesce(F.nullif(value, F.lit("")), F.lit(_NO_VALUE))
    # The lines are made before the shuffle, so that nothing but texts is moved.
    lines = df.select(folder.alias("folder"), F.coalesce(line, F.lit("")).alias("line"))
    os.makedirs(place, exist_ok=True)
    write = _writer(f"{place}/{column}=", f"{uuid.uuid4().hex}.{'txt' if kind == 'text' else kind}", header, replace)
    files = lines.repartition(tasks, "folder").sortWithinPartitions("folder").mapInArrow(write, "files bigint")
    files.write.format("noop").mode("overwrite").save()


def _local_place(spark: SparkSession, path: str) -> str | None:
    """The path on Hadoop's local file system; None on any other."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(target).toUri().getPath() if system.getUri().getScheme() == "file" else None


class _File:
    """A file in the making, with its checksums as Hadoop's local file system keeps them."""

    def __init__(self, folder: str, name: str) -> None:
        os.makedirs(folder, exist_ok=True)
        self.folder, self.name, self.rest = folder, name, b""
        self.making = f"{folder}/.{name}.{uuid.uuid4().hex}"
        self.file = open(self.making, "wb")
        self.sums = [b"crc\0", _SUM_BYTES.to_bytes(4, "big")]

    def _add(self, data: bytes) -> None:
        self.file.write(data)
        self.sums += [zlib.crc32(data[n : n + _SUM_BYTES]).to_bytes(4, "big") for n in range(0, len(data), _SUM_BYTES)]

    def write(self, data: bytes) -> None:
        data = self.rest + data
        whole = len(data) // _BLOCK * _BLOCK
        self._add(data[:whole])
        self.rest = data[whole:]

    def close(self, alone: bool) -> None:
        self._add(self.rest)
        self.file.close()
        with open(f"{self.making}.crc", "wb") as file:
            file.write(b"".join(self.sums))
        before = os.listdir(self.folder) if alone else []
        os.replace(f"{self.making}.crc", f"{self.folder}/.{self.name}.crc")
        os.replace(self.making, f"{self.folder}/{self.name}")
        for name in before:
            if name not in (self.name, f".{self.name}.crc", os.path.basename(self.making), f"{os.path.basename(self.making)}.crc"):
                os.remove(f"{self.folder}/{name}")


def _writer(start: str, ending: str, header: str | None, replace: bool):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Files of lines that come folder by folder; how many."""
        name = f"part-{TaskContext.get().partitionId():05d}-{ending}"
        current, file, files = None, None, 0
        for batch in batches:
            folders, lines = (column.to_pylist() for column in batch.columns)
            low = 0
            while low < len(folders):
                folder = folders[low]
                high = low + 1
                while high < len(folders) and folders[high] == folder:
                    high += 1
                if folder != current:
                    if file:
                        file.close(replace)
                    escaped = _ESCAPED.sub(lambda found: f"%{ord(found[0]):02X}", folder)
                    current, file, files = folder, _File(f"{start}{escaped}", name), files + 1
                    if header is not None:
                        file.write(f"{header}\n".encode())
                file.write("".join(f"{line}\n" for line in lines[low:high]).encode())
                low = high
        if file:
            file.close(replace)
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], ["files"])

    return write
