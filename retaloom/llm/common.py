"""Helpers shared by the operators: stored tables, Arrow passes, word rules."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from retaloom.session import shared_folder

# Bytes that separate words of the white-space rule are what bytes.split() splits on:
# space and 0x09 to 0x0D. bytes.lower() lowers A-Z alone.
_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
ALNUM = bytes(
    b if b in _KEPT else (b + 32 if 0x41 <= b <= 0x5A else 0x20) for b in range(256))


def space_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lowered."""
    return text.lower().split()


def alnum_words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and anything beyond ASCII, with A-Z lowered."""
    return text.translate(ALNUM).split()


def stored(
    df: DataFrame, label: str, options: dict[str, str] | None = None, by: list[str] | None = None
) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there.

    A lost executor then costs a read, not a recomputation, and later passes see the
    very same rows. The table stays until the folder is cleaned by whoever owns it.
    """
    path = f"{shared_folder(df.sparkSession)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).partitionBy(*(by or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: str, schema: str) -> DataFrame:
    """A frame of driver-made rows, given as a JSON array; its caller bounds its size."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows), f"array<struct<{schema}>>")))


def fraction(column: str, seed: int) -> Column:
    """A number in [0, 1) that depends on the value of the column alone."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(column)), F.lit(1 << 30)) / float(1 << 30)


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo n; NULL counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def row_order(whole: str, df: DataFrame) -> Column:
    """An order of rows by all values of a struct column: equal only for equal rows."""
    text = df.schema[whole].dataType.simpleString()
    # Maps have no order and no hash of their own.
    return F.xxhash64(F.to_json(whole)) if "map<" in text else F.xxhash64(whole)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column as bytes, NULL as empty."""
    col = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    return [b or b"" for b in col.to_pylist()]


def slices(batch: list[bytes], most: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Places of runs of texts of about ``most`` bytes, at least one text each."""
    start = size = 0
    for i, text in enumerate(batch):
        size += len(text)
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(batch):
        yield start, len(batch)


def appended(
    df: DataFrame,
    text: str,
    make: Callable[[list[bytes]], dict[str, pa.Array]],
    schema: str,
    setup: Callable[[], Callable] | None = None,
) -> DataFrame:
    """``df`` with the columns that ``make`` computes from each batch of texts.

    With ``setup``, ``make`` is ignored and the function that setup returns, once per
    task, takes its place. An input column whose name is among the new ones (in any
    case) gives way to the new one.
    """
    new = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    taken = {f.name.lower() for f in new.fields}
    kept = [c for c in df.columns if c.lower() not in taken]
    # A text that stays goes to Python once; one that gives way goes there beside the rest.
    beside = [] if text in kept else [F.col(f"`{text}`").alias("__text__")]
    source = df.select(*[F.col(f"`{c}`") for c in kept], *beside)
    names, column = kept + [f.name for f in new.fields], "__text__" if beside else text
    n = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = setup() if setup else make
        for batch in batches:
            found = work(texts(batch, column))
            columns = list(batch.columns[:n]) + [found[f.name] for f in new.fields]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    out = T.StructType([source.schema[c] for c in kept] + list(new.fields))
    return source.mapInArrow(run, out)


def hash_words(words: list[bytes], cache: dict[bytes, int]) -> np.ndarray:
    """64-bit hashes of words through a cache that knows how to fill itself."""
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


class HashCache(dict):
    """word -> xxh64, forgetting everything when it has grown past ``most`` words."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value
