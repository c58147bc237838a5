"""Helpers shared by the operators: tables, shared folder, shipped package, words."""

from __future__ import annotations

import io
import sys
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.session import ensure_checkpoint_dir

#: Words are what lies between the six ASCII white-space characters; bytes.split() splits at these.
WORD = r"[^\x20\x09-\x0D]+"
#: Work on texts in pieces of about so many bytes, so that a batch of long texts stays small.
SLICE_BYTES = 1 << 20
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession, what: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/canopy-{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str, narrow: bool = False) -> DataFrame:
    """The frame as a Parquet table in the shared folder: cuts lineage, survives lost executors.

    `narrow` tables, of a few numbers a row, are written by an eighth of the shuffle's tasks: without
    adaptive coalescing they would be many tiny files.
    """
    spark = df.sparkSession
    path = work_dir(spark, what)
    if narrow:
        df = df.coalesce(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, rows: int) -> DataFrame:
    """A written table, sent to all tasks if it has at most so many rows; else joined as Spark plans it."""
    return F.broadcast(df) if df.count() <= rows else df


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI of the shared folder (file, hdfs, s3 ...); for tasks too."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def ship(spark: SparkSession) -> None:
    """Give the package to the executors once per application, as --py-files would, and bound the
    Arrow batches of texts: BATCH_ROWS rows unless the session has a number of its own."""
    sc = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":  # Spark's default
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    if getattr(sc, "_canopy_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    folder = work_dir(spark, "package")
    fs, path = filesystem(folder)
    fs.create_dir(path)
    with fs.open_output_stream(f"{path}/canopy_files.zip") as f:
        f.write(blob.getvalue())
    sc.addPyFile(f"{folder}/canopy_files.zip")
    sc._canopy_shipped = True


def aside(docs: DataFrame, *used: str) -> DataFrame:
    """All columns under numbered names, and the `used` ones under their own: no name can clash."""
    return docs.select(*(F.col(f"`{c}`").alias(f"_col{i}") for i, c in enumerate(docs.columns)), *used)


def restored(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns that `aside` renamed, under their names; `changed` ones get a new value."""
    return df.select(*(changed.get(c, F.col(f"_col{i}")).alias(c) for i, c in enumerate(columns)))


def _tidy(uses: tuple[str, ...]) -> None:
    """In a worker: empty the caches that operators before this one have left."""
    for name in ("words", "nbsvm", "tokens", "transducer"):
        module = sys.modules.get(f"canopy.llm.{name}")
        if module is not None and name not in uses:
            module.drop_caches()


def map_rows(df: DataFrame, rows: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str,
             uses: tuple[str, ...] = ()) -> DataFrame:
    """`uses` names the modules whose worker caches the function fills. `rows` turns tuples of a partition into tuples of `schema`; Arrow batches in and out.

    Batches are cut so that each slice holds about SLICE_BYTES of the last column (the text).
    """
    from pyspark.sql.types import StructType

    ship(df.sparkSession)
    out_schema = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        _tidy(uses)
        arrow = to_arrow_schema(out_schema)

        def tuples() -> Iterator[tuple]:
            for b in batches:
                for part in sliced(b):
                    yield from zip(*(c.to_pylist() for c in part.columns), strict=True)

        held: list[tuple] = []
        size = 0
        for r in rows(tuples()):
            held.append(r)
            size += sum(len(x) for x in r if isinstance(x, (bytes, str, list))) + 64
            if size >= 4 * SLICE_BYTES or len(held) >= 8192:
                yield _batch(held, arrow)
                held, size = [], 0
        if held:
            yield _batch(held, arrow)

    return df.mapInArrow(run, schema)


def append(df: DataFrame, column: str, made: Callable[[list[bytes | None]], list[tuple]], schema: str,
           keep: list[str], uses: tuple[str, ...] = ()) -> DataFrame:
    """The columns `keep`, as they are, and new ones that `made` computes from a text (or binary) column.

    The text crosses to Python once, also if it is kept."""
    from pyspark.sql.types import StructType

    ship(df.sparkSession)
    new = StructType.fromDDL(schema)
    at = keep.index(column) if column in keep else len(keep)
    inner = df.select(*keep) if column in keep else df.select(*keep, raw_text(column).alias("_text"))
    out_schema = StructType(df.select(*keep).schema.fields + new.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        _tidy(uses)
        arrow = to_arrow_schema(new)
        for b in batches:
            for part in sliced(b):
                added = _batch(made(part.column(at).cast(pa.binary()).to_pylist()), arrow)
                yield pa.RecordBatch.from_arrays(part.columns[:len(keep)] + added.columns,
                                                 names=part.schema.names[:len(keep)] + added.schema.names)

    return inner.mapInArrow(run, out_schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about SLICE_BYTES."""
    n = batch.num_rows
    if not n:
        return
    step = max(1, min(n, n * SLICE_BYTES // max(1, batch.nbytes)))
    for i in range(0, n, step):
        yield batch.slice(i, step)


def raw_text(col: str = "text") -> Column:
    """The text as UTF-8 bytes, null as null."""
    return F.col(col).cast("binary")
