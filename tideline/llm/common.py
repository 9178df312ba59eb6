"""Small helpers shared by the document operators."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[ \x09-\x0D]"
CHARS = 1 << 18            # characters that array code handles together


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """One third of the documents, which no model may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def whole(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def portions(texts: list[str], chars: int = CHARS):
    """(first row, texts) in runs of about ``chars`` characters."""
    part, size, at = [], 0, 0
    for i, t in enumerate(texts):
        if part and size + len(t) > chars:
            yield at, part
            part, size, at = [], 0, i
        part.append(t)
        size += len(t)
    if part:
        yield at, part


def per_batch(fn: Callable, df: DataFrame, schema: str) -> DataFrame:
    """``fn(pyarrow.RecordBatch) -> pyarrow.RecordBatch`` over the Arrow batches of ``df``."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
    return df.mapInArrow(run, schema)


def kept_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with the columns of ``like`` in their order."""
    return df.select(*[F.col(f"`{c}`") for c in like.columns])


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
