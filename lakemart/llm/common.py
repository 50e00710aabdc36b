"""Helpers shared by the text operators.

A *word* of the whitespace kind is ``[^\\x20\\x09-\\x0D]+``; of the
alphanumeric kind ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing
A-Z. Texts reach Python tasks as UTF-8 bytes, where ``bytes.split`` and
``bytes.lower`` follow exactly these ASCII rules.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from ..session import checkpoint_dir

SPACES = " \t\n\x0b\x0c\r"
SPACE_RE = r"[\x20\x09-\x0D]+"
WORD_RE = r"[^\x20\x09-\x0D]+"
#: Rows that an explicit broadcast may hold; larger sides take a shuffle join.
BROADCAST_ROWS = 1_000_000


def split_words(text: Column) -> Column:
    """Whitespace words of a text as an array (null or blank: empty)."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RE))


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body
    (or a lambda inside it) refers to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def persisted(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, lineage cut."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sized(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A narrow ``df``, materialised and marked for broadcast if it has at
    most ``max_rows`` rows; beyond that joins with it shuffle."""
    df = persisted(df)
    return F.broadcast(df) if df.count() <= max_rows else df


def apart(key: Column) -> Column:
    """A long key in another form, for joining rows with an aggregate of
    theirs by that key. Joined by the key itself, the aggregate's side is not
    shuffled again, and adaptive execution cannot split a hot key; with both
    sides keyed ``apart`` it can."""
    return F.bitwise_not(key)


def row_key(df: DataFrame, text: str = "text") -> Column:
    """64-bit digest of (doc_id, text): with doc_id, the key under which
    per-document results return to their rows. Rows equal in both get equal
    results, so they may share a key; null ids are told apart by text."""
    return F.xxhash64(F.col("doc_id"), F.col(text))


def without(df: DataFrame, *added: str) -> DataFrame:
    """``df`` less the columns that an operator is about to add: columns of
    the same name are replaced. (Names that begin with two underscores are
    the operators' own.)"""
    names = {a.lower() for a in added}
    return df.drop(*[c for c in df.columns if c.lower() in names])


def keep_columns(docs: DataFrame, needed: tuple[str, ...], fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``fn`` (which filters or repeats rows) over ``docs`` with the columns
    of ``docs`` unchanged, also those named like columns that ``fn`` adds."""
    inner = [c if c in needed else f"__c{i}" for i, c in enumerate(docs.columns)]
    return fn(docs.toDF(*inner)).select(*[F.col(i).alias(c) for i, c in zip(inner, docs.columns)])


def annotate(df: DataFrame, text: str, added: str, make: Callable[[], Callable[[pa.RecordBatch, list], list]]) -> DataFrame:
    """All columns of ``df`` plus the columns of the DDL ``added``. In each
    task ``make()`` gives a function (batch, texts as bytes or None) -> list
    of Arrow arrays. Narrow: no shuffle, batch-wise memory."""
    extra = StructType.fromDDL(added).fields
    df = without(df, *(f.name for f in extra))
    names = [*df.columns, *(f.name for f in extra)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for b in batches:
            new = fn(b, b.column(b.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *new], names=names)

    src = df.select("*", F.col(text).cast("binary").alias("__utf8"))
    return src.mapInArrow(run, StructType([*df.schema.fields, *extra]))


def exact_share(part: Column, total: Column, thousands: int) -> Column:
    """``floor(1000^thousands * part / total)`` of longs (0 <= part, 0 < total
    < 9e15) by long division, three digits a step: no product passes 64 bits
    as long as the result does not."""
    def div(a: Column, b: Column) -> Column:
        return F.call_function("div", a, b)
    part, total = part.cast("long"), total.cast("long")
    out, rest = div(part, total), part % total
    for _ in range(thousands):
        out, rest = out * 1000 + div(rest * 1000, total), (rest * 1000) % total
    return out
