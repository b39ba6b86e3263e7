"""Helpers shared by the operators on whole texts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isohyet.session import checkpoint_dir

# Bytes of text held as Python objects at a time.
CHUNK_CHARS = 2_000_000
# The white space that separates words; every other character belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_SPACES = str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})


def ascii_lower(text: str) -> str:
    """Lower-case A-Z only."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def words_of(text: str) -> list[str]:
    """Maximal runs of characters other than space, tab, LF, VT, FF and CR."""
    flat = text.translate(_SPACES) if not text.isascii() or _has_controls(text) else None
    if flat is None:
        return text.split()
    return [w for w in flat.split(" ") if w]


def _has_controls(text: str) -> bool:
    # str.split() also splits at these four, which are word characters here.
    return "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator needs; null texts become empty, other columns are left out."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def map_texts(df: DataFrame, schema: str, start: Callable[[], Callable[[list, list[str]], list[list]]],
              size: int = CHUNK_CHARS) -> DataFrame:
    """Apply a function to chunks of (ids, texts) inside the tasks.

    `start` is called once per task and returns the function, so that it can
    hold models and caches. The function returns one list per output column.
    A chunk holds about `size` bytes, or one longer text.
    """
    columns = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    out_schema = arrow_schema(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for low, high in chunks(texts, size):
                got = work(ids.slice(low, high - low).to_pylist(), texts.slice(low, high - low).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=f.type) for v, f in zip(got, out_schema, strict=True)], schema=out_schema)

    return df.mapInArrow(run, columns)


def arrow_schema(columns: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(columns)


def chunks(texts: pa.Array, size: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about `size` bytes together."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    low, total = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > size:
            yield low, i
            low, total = i, 0
        total += n
    if low < len(lengths):
        yield low, len(lengths)


#: The folder in which the operators of a workspace store their tables; none outside.
_WORKSPACE: ContextVar[str | None] = ContextVar("workspace", default=None)
_LEFT: list[str] = []


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder, or below the workspace that is open."""
    return f"{_WORKSPACE.get() or checkpoint_dir(spark)}/isohyet-llm-{uuid.uuid4().hex}"


@contextmanager
def workspace(spark: SparkSession, source: DataFrame) -> Iterator[None]:
    """A folder for all tables that operators store inside.

    It outlasts the block, since results are read later. The next workspace of the application removes it,
    unless that one's `source` is still read from it.
    """
    files = source.inputFiles() if _LEFT else []
    for folder in [f for f in _LEFT if not any(f.split(":", 1)[-1].lstrip("/") in x for x in files)]:
        discard(spark, folder)
        _LEFT.remove(folder)
    folder = f"{checkpoint_dir(spark)}/isohyet-stage-{uuid.uuid4().hex}"
    token = _WORKSPACE.set(folder)
    try:
        yield
    finally:
        _WORKSPACE.reset(token)
        _LEFT.append(folder)


def settled(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage."""
    spark = df.sparkSession
    path = folder or scratch(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a stored intermediate table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
