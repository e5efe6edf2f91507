"""Shared pieces of the text operators: reading, splits, words, reliable cuts of lineage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

import tallygrid
from tallygrid.session import cut_lineage

# Fixed value: a word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Limits of one Arrow batch. Texts may be very long, so bytes count; a batch is all that a task holds.
BATCH_ROWS, BATCH_BYTES = 8_192, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; Spark alone touches the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id's text, modulo ``of``. A null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(of))


def whole_text(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words(text: str) -> list[bytes]:
    """Words as UTF-8: ``bytes.split`` splits at exactly the six ASCII white-space characters of WORD."""
    return text.encode("utf-8", "surrogatepass").split()


def lower_words(text: str) -> list[bytes]:
    """Words with A-Z (and no other letter) in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def ready(spark: SparkSession) -> None:
    """Before a Python stage: executors get this package (once a session), and Arrow batches stay small."""
    sc = spark.sparkContext
    if not getattr(sc, "_has_tallygrid", False):
        root = Path(tallygrid.__file__).resolve().parent
        packed = Path(os.path.realpath(tempfile.mkdtemp(prefix="tallygrid-"))) / "tallygrid.zip"
        with zipfile.ZipFile(packed, "w") as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        sc.addPyFile(str(packed))  # the driver serves it; nobody else reads the driver's folder
        sc._has_tallygrid = True
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_batches(
    df: DataFrame, schema: str | T.StructType, fn: Callable[[Iterator[dict[str, list]]], Iterable[dict[str, list]]],
) -> DataFrame:
    """``mapInArrow`` with columns as Python lists; ``fn`` sees the batches of one partition in order."""
    ready(df.sparkSession)
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)} for b in batches)
        for out in fn(columns):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, struct)


def map_arrow(
    df: DataFrame, schema: str | T.StructType, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[dict]],
) -> DataFrame:
    """``mapInArrow`` with batches as they are; ``fn`` gives columns as arrays or lists."""
    ready(df.sparkSession)
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fn(batches):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, struct)


def settle(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later reads survive lost executors and do not repeat the work."""
    return cut_lineage(df)


def row_key(*columns: str) -> Column:
    """A 128-bit key of a row's identity as text, nulls included."""
    of = [F.col(f"`{c}`") for c in columns]
    return F.concat_ws("-", F.hex(F.xxhash64(*of)), F.hex(F.xxhash64(F.lit("row"), *of)))


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, or the first of ``name_``, ``name__``, ... that no column has (names differ by more than case)."""
    held = {c.lower() for c in taken}
    while name.lower() in held:
        name += "_"
    return name


def one_row_each(docs: DataFrame, chosen: DataFrame, identity: tuple[str, ...], times: bool = False) -> DataFrame:
    """The rows of ``docs`` whose ``row_key`` of ``identity`` is in ``chosen`` (row, n: how often the key occurs), each key once.

    With ``times``, each row of ``chosen`` brings a number of that name, and its row comes so often, numbered by
    ``copy``. The other columns of ``chosen`` are added. A column of ``docs`` never changes: its columns travel in one
    struct, and an added column whose name is taken gets underscores. Texts are shuffled once; only rows that occur more
    than once are compared.
    """
    more = [c for c in chosen.columns if c not in ("row", "n", "times")]
    own = docs.select(row_key(*identity).alias("mark"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    right = chosen.select(F.col("row").alias("mark"), "n", *[F.col(c).alias(f"add_{c}") for c in more], *(["times"] if times else []))
    met = own.repartition("mark").join(right.repartition("mark"), "mark")
    out = met.where("n = 1").unionByName(met.where("n > 1").dropDuplicates(["mark"]))
    if times:
        out, more = out.withColumn("add_copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))), [*more, "copy"]
    names = [*docs.columns]
    for c in more:
        names.append(free_name(c, names))
    return out.select(*[F.col(f"doc.`{c}`") for c in docs.columns], *[F.col(f"add_{c}") for c in more]).toDF(*names)
