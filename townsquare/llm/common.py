"""Small helpers shared by the operators: tables, scratch paths, Arrow slices, word splitting."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from townsquare.config import is_local

#: Bytes A-Z lower-cased; every other ASCII byte that is no digit or letter is a blank. Bytes from 0x80 are word bytes.
_BLANKED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_LOWERED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: The six white-space bytes are the only separators of ``bytes.split``.
_SPACES = b" \t\n\r\x0b\x0c"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the supplied tables, read by Spark."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The shared folder for intermediate data: ``spark.checkpoint.dir`` of the session.

    Where a local session names none, checkpoints go below the warehouse. On a cluster that is an error: the default
    warehouse is a folder of the driver's machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not spark.conf.get("spark.checkpoint.dir", None) and not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
        context.setCheckpointDir(root)
    return context.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage and survives lost executors.

    ``batch_rows``: at most so many rows at a time go to and from Python in this write, where rows hold whole texts.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    with _arrow_rows(spark, batch_rows):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _arrow_rows(spark: SparkSession, most: int | None) -> Iterator[None]:
    """Arrow batches of ``most`` rows at most; where the session asks for fewer, or ``most`` is None, its setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, now = spark.conf.get(key, None), int(spark.conf.get(key))
    if most is None or 0 < now <= most:
        yield
        return
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stored_small(df: DataFrame, name: str) -> DataFrame:
    """``stored`` for few rows that many tasks hold: they are put together first, into files of a useful size. Where a file
    is local, Hadoop starts processes for each one (chmod), and each looks as large as the executor until it runs."""
    return stored(df.hint("rebalance"), name)


def hashed_words(data: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 text with A-Z lower-cased."""
    return data.translate(_BLANKED).split()


def spaced_words(data: bytes, lower: bool) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text, optionally with A-Z lower-cased."""
    return (data.translate(_LOWERED) if lower else data).split()


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the text of a slice stays below ``limit`` bytes (a longer row is a slice of its own)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if len(sizes) > start:
            yield batch.slice(start)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a task's function over Arrow data; when it ends, the memory that Arrow keeps for later goes back to the
    system. Workers outlive their tasks, and an executor's idle ones count like busy ones."""

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return whole


def texts(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 3. Rows of fold 1 are held out of every fit; a NULL id has no fold."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(fold(doc_id) == 1, F.lit(False))


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark application, as ``--py-files`` would."""
    context = spark.sparkContext
    if _SHIPPED.get("application") == context.applicationId:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED["application"] = context.applicationId


_SHIPPED: dict[str, str] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed vocabulary file of a public tokenizer lies; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
