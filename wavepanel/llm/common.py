"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters of one text that a task turns into Python words at a time.
SPAN_CHARS = 1 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# Rows and bytes of a batch that Spark hands to Python at a time.
BATCH_ROWS, BATCH_BYTES = 1_000, 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after its session's Arrow batches were made small.

    Texts are a thousand times longer than the numbers that the defaults are
    meant for; a session that sets its own sizes keeps them.
    """
    conf = df.sparkSession.conf
    for key, default, value in (
            ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", BATCH_ROWS),
            ("spark.sql.execution.arrow.maxBytesPerBatch", None, BATCH_BYTES)):
        try:
            now = conf.get(key)
        except Exception:                      # a Spark version without it
            continue
        if now == default or default is None and int(now.rstrip("bB") or 0) >= 64 << 20:
            conf.set(key, str(value))
    return df


def give_back() -> None:
    """Returns what a finished task has freed to the system.

    Spark keeps Python workers for later tasks, and the allocators keep freed
    memory; on an executor it is missing elsewhere.  Without glibc nothing is
    done.
    """
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def own_columns(df: DataFrame, taken: list[str]) -> DataFrame:
    """``df`` without the columns an operator is about to add (any case)."""
    low = {t.lower() for t in taken}
    return df.drop(*[c for c in df.columns if c.lower() in low])


def text_of(name: str):
    """The text column, a null text read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def text_key(name: str):
    """128 bits of SHA-256 that name a text; a null text counts as empty.

    The key is a hex string, so it also orders the texts in a fixed way that
    does not depend on how the rows are stored.
    """
    return F.substring(F.sha2(text_of(name).cast("binary"), 256), 1, 32)


def quiet_tokenizer(path: str):
    """The tokenizer at ``path``, encoding in the calling thread only."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def spans(text: str, size: int = SPAN_CHARS) -> Iterator[str]:
    """``text`` cut before spaces into parts of about ``size`` characters."""
    start = 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:] if start else text


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
