"""Helpers shared by the operators: tables, the shared scratch folder, Arrow batches."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


SLICE_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Longer texts are given to a tokenizer in parts of about this many characters.
PART = 1 << 20
#: Runs of so much white space (Unicode's, a fixed set) are too deep for the tokenizers' pattern.
_WHITE_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{100000,}")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for drivers started without ``--py-files``.

    Arrow batches are bounded by bytes, where the session has no bound of its own: texts may be long."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(2 * SLICE_BYTES))
    context, package = spark.sparkContext, Path(__file__).parents[1]
    if getattr(context, "_namewright_shipped", False):
        return
    target = Path(tempfile.mkdtemp(prefix="namewright-")) / "namewright.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    context._namewright_shipped = True


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (``spark.checkpoint.dir``).

    Only where the setting is absent, in a plain local session, a temporary folder is chosen and remembered in the session."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("namewright.scratch", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="namewright-")
        spark.conf.set("namewright.scratch", root)
    return root.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: this cuts the lineage,
    computes a frame that is used several times only once, and survives lost executors. An aggregate that is
    written before it is joined on its own key also lets adaptive execution split a hot key: both sides then
    have a shuffle of their own right below the join."""
    path = f"{scratch_dir(df.sparkSession)}/namewright-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame) -> Column:
    """All columns in one struct named ``row``, out of the way of an operator's own names."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).alias("row")


def carried(df: DataFrame, keep: list[str | Column], ddl: str) -> tuple[list[tuple[str, pa.DataType]], StructType]:
    """Arrow fields of the columns of ``df`` that a pass hands on, and its output schema: those columns and ``ddl``."""
    kept = df.select(*keep).schema
    return [(f.name, f.type) for f in to_arrow_schema(kept)], StructType(kept.fields + StructType.fromDDL(ddl).fields)


def encode_text(encoding, text: str, part: int = PART, border: re.Pattern | None = None) -> np.ndarray:
    """Token ids of ``text`` by a tiktoken encoding whose pattern keeps the last blank of a run for the next word.

    Long texts are encoded in parts that end before a space after a letter or digit, and a very long run of white space (but
    its last character, where more follows that is no ``border``) as the one piece it is: the ids are those of the whole text.
    """
    ids: list[list[int]] = []

    def plain(a: int, b: int) -> None:
        while b - a > part:
            cut = a + part
            while cut < b and not (text[cut] == " " and text[cut - 1].isalnum()):
                cut += 1
            ids.append(encoding.encode(text[a:cut], allowed_special="all", disallowed_special=()))
            a = cut
        ids.append(encoding.encode(text[a:b], allowed_special="all", disallowed_special=()))

    at = 0
    for run in _WHITE_RUN.finditer(text):
        last = run.end() == len(text) or border is not None and border.match(text, run.end()) is not None
        plain(at, run.start())
        at = run.end() - (not last)
        ids.append(encoding._encode_single_piece(text[run.start() : at]))
    plain(at, len(text))
    return np.concatenate([np.array(i, np.int64) for i in ids])


def give_back() -> None:
    """Return freed memory to the system: a worker waits for its next task beside others that need it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def by_batch(
    rows: Callable[[pa.RecordBatch], Iterable[dict[str, pa.Array | list]]],
    types: list[tuple[str, pa.DataType]],
    last: Callable[[], Iterable[dict[str, pa.Array | list]]] | None = None,
    slice_bytes: int = SLICE_BYTES,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function from one that turns a batch into dicts of output columns.

    Batches are handed on in slices of about ``slice_bytes`` (one row at least), which bounds what a worker holds.
    ``last`` is called at the end of each partition, for what ``rows`` still holds back."""
    schema = pa.schema(types)

    def batch_of(out: dict[str, pa.Array | list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, int(batch.num_rows * slice_bytes / max(1, batch.nbytes)))
            for at in range(0, batch.num_rows, step):
                yield from map(batch_of, rows(batch.slice(at, step)))
        if last:
            yield from map(batch_of, last())
        give_back()

    return run
