"""Written intermediates, document keys and small helpers that the operators share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from deskwise.session import scratch_dir

# Bytes 0x20 and 0x09-0x0D separate words in every contract of this subpackage. ``bytes.split()``
# splits on exactly these six; ``str.split()`` does not.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def held(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends there, and a lost executor
    costs a re-read instead of a recomputation."""
    path = scratch_dir(rows.sparkSession, purpose)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if getattr(context, "_deskwise_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="deskwise-package-")) / "deskwise.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._deskwise_shipped = True


def typed(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def by_size(batch: pa.RecordBatch, column: int, most: int):
    """Runs of a batch's rows with about ``most`` bytes in a column, one row at least; nothing is copied."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, end - start)
        start = end


def text_of(column: str = "text") -> Column:
    """The text, a null one being empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_key(id_column: str = "doc_id", text_column: str = "text") -> list[Column]:
    """What identifies a document: its id and a hash of its text, computed the same way wherever it is
    asked for. Rows that repeat both are one document that occurs several times."""
    return [F.col(id_column).alias("key_id"), F.xxhash64(text_of(text_column)).alias("key_text")]


def column(name: str) -> Column:
    """A column by its name, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_rows(docs: DataFrame) -> DataFrame:
    """The caller's row as one column, beside what identifies its document: no name of the caller's can meet
    one of ours. ``select("row.*")`` gives the rows back as they were."""
    return docs.select(F.struct(*map(column, docs.columns)).alias("row"), *row_key())


def fresh_name(columns: list[str], name: str) -> str:
    """The name, or the first longer one that none of the columns has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def rank_struct(id_column: str, *more: Column) -> Column:
    """Sorts by the id, rows without one last; then by what follows."""
    return F.struct(F.col(id_column).isNull().alias("no_id"), F.col(id_column).alias("id"), *more)
