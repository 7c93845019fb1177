"""What the text operators share: reading tables, Arrow batches, word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# [\x20\x09-\x0D], which is also what bytes.split() and bytes.strip() take as white space.
WHITE = b" \t\n\x0b\x0c\r"
MEMO_LIMIT = 250_000
SLICE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, changed where the table already has one of that name."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def byte_values(column: pa.Array) -> Iterator[bytes | None]:
    """UTF-8 bytes of a string column, a slice at a time."""
    column = column.cast(pa.large_binary())
    for start in range(0, len(column), SLICE):
        yield from column.slice(start, SLICE).to_pylist()


def add_by_text(
    df: DataFrame,
    text: str,
    fields: list[T.StructField],
    make: Callable[[Iterable[bytes | None]], dict[str, list]],
) -> DataFrame:
    """df with columns computed from a text column, an Arrow batch at a time.

    make gets the texts of a batch as UTF-8 bytes and returns a list per field.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    added = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(added)
        for batch in batches:
            made = make(byte_values(batch.column(batch.schema.get_field_index(text))))
            arrays = [pa.array(made[f.name], f.type) for f in schema]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *arrays], names=[*batch.schema.names, *added.names]
            )

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))


class WordHashes:
    """64-bit hashes of words, remembered until there are too many."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def of(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > MEMO_LIMIT:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.get, words), np.uint64, len(words))


# Shared by the tasks of a worker process; hashes do not depend on it.
WORDS = WordHashes()


def mixed(values: np.ndarray) -> np.ndarray:
    """Each 64-bit value with its bits spread (an invertible mix)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash per window of so many words; of a shorter text one for all its words."""
    size = min(size, len(hashes))
    if not size:
        return hashes
    count = len(hashes) - size + 1
    total = np.full(count, size, np.uint64)
    for i in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + count]
    return mixed(total)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def text_or_empty(column: str):
    return F.coalesce(F.col(column), F.lit(""))
