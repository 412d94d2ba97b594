"""What the corpus operators share: shared-folder checkpoints, hashed words, held-out rows."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_PACKAGE = Path(__file__).resolve().parents[1]


def _ship(context: SparkContext) -> None:
    """Send this package's sources to the workers with the job, once for each context."""
    if getattr(context, "_curaspark_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="curaspark-ship-")) / f"{_PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(_PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(_PACKAGE.parent).as_posix())
    context.addPyFile(str(archive))
    context._curaspark_shipped = True


def ship(spark: SparkSession) -> None:
    """Before a grouped map by functions of this package."""
    _ship(spark.sparkContext)


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` by a function of this package."""
    _ship(df.sparkSession.sparkContext)
    return df.mapInArrow(run, schema)


def _set_shared(spark: SparkSession) -> None:
    """The folder is the session's ``spark.checkpoint.dir``. Only a session in one process, as in tests, may go without."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.partition("[")[0] == "local":
            raise ValueError("a cluster's session must name a shared folder in spark.checkpoint.dir")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="curaspark-checkpoint-"))


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through a file copy in the folder that driver and executors share."""
    _set_shared(df.sparkSession)
    return df.checkpoint()


def remainder(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, modulo three: 1 marks the held-out rows."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % 3


def held_out(doc_id: str | Column = "doc_id") -> Column:
    return F.coalesce(remainder(doc_id) == 1, F.lit(False))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that text operators read; any further column is left alone."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


# ---- words of whole Arrow text columns, hashed without making a Python string for each ----

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Odd, so that it has an inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                powers = np.full(size, base, dtype=np.uint64)
                powers[0] = 1
                _POWERS[name] = np.multiply.accumulate(powers)
    return _POWERS["up"], _POWERS["down"]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets into them (null: empty)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def hashed_words(raw: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` in order, and n + 1 offsets of each text's words.

    A-Z are lower-cased first. A word never crosses the end of its text.
    """
    n_docs = len(offsets) - 1
    if len(raw) == 0:
        return np.zeros(0, np.uint64), np.zeros(n_docs + 1, np.int64)
    inside = ~_SPACE[raw]
    first = np.ones(len(raw), dtype=bool)
    first[1:] = ~inside[:-1]
    cut = offsets[:-1]
    first[cut[cut < len(raw)]] = True
    starts = np.flatnonzero(inside & first)
    last = np.ones(len(raw), dtype=bool)
    last[:-1] = first[1:] | ~inside[1:]
    ends = np.flatnonzero(inside & last) + 1
    up, down = _powers(len(raw))
    with np.errstate(over="ignore"):
        values = (_LOWER[raw] if lower else raw).astype(np.uint64)
        values += np.uint64(1)
        values *= up[: len(raw)]
        running = np.empty(len(raw) + 1, np.uint64)
        running[0] = 0
        np.cumsum(values, out=running[1:])
        hashes = (running[ends] - running[starts]) * down[starts]
        hashes = mix64(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes, np.searchsorted(starts, offsets)


def chunks(raw: np.ndarray, offsets: np.ndarray, size: int = 1 << 20):
    """Runs of texts of about ``size`` bytes together (a longer text is a run of its own)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        j = min(j, n)
        yield i, j, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


#: Words and hashes of a run take some 40 times its bytes while it is worked on; a worker keeps that memory.
RUN_BYTES = 1 << 18


def runs_of(texts: pa.Array, size: int):
    """(first row, last row, slice) of runs of texts of about ``size`` bytes together, without a copy of the column."""
    n, wide = len(texts), pa.types.is_large_string(texts.type)
    if n == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1]
    i = 0
    while i < n:
        j = min(max(i + 1, int(np.searchsorted(offsets, int(offsets[i]) + size, side="right")) - 1), n)
        yield i, j, texts.slice(i, j - i)
        i = j


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share."""
    _set_shared(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/table-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it again: the lineage ends at its files."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name: str, *tables: DataFrame) -> str:
    """A column name that none of the tables has, whatever the case."""
    taken = {c.lower() for df in tables for c in df.columns}
    name = f"_{name}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: Rows of a few numbers up to which a counted side may be broadcast (16 MB or so).
SMALL_ROWS = 500_000


def if_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A broadcast hint for a stored table of counted size, the table itself beyond it."""
    return F.broadcast(df) if df.count() <= rows else df
