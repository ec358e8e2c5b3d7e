"""Documents dealt into blocks of bounded size.

Operators that look for repeats send fingerprints away and get answers back.
Both passes group the documents by the same block column, so Spark plans one
exchange of the texts and reuses it.  A fingerprint leaves a block once however
often it occurs there, so a hot one makes a row per block, not a row per place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 2 << 20


def text_bytes(docs: DataFrame, text_col: str) -> int:
    return int(docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0)


def row_struct(docs: DataFrame, text_col: str, carry: list[str] | None = None, results: tuple[str, ...] = ()):
    """The carried columns as one struct, so no input name can clash with a working column.

    A carried column that is named like one of the ``results`` gives way to it.
    """
    names = [c for c in (docs.columns if carry is None else carry) if c != text_col and c.lower() not in results]
    return F.struct(*[docs[f"`{c}`"].alias(c) for c in names]) if names else F.struct(F.lit(0).alias("none"))


def blocked(docs: DataFrame, text_col: str, carry: list[str] | None = None, results: tuple[str, ...] = (), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``blk int, txt string, row struct``: every row in one of about total / block_bytes blocks.

    The block is a hash of the row's text and its carried columns, hence the same in every run and retry.
    """
    n = max(1, -(-text_bytes(docs, text_col) // block_bytes))
    out = docs.select(F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("txt"), row_struct(docs, text_col, carry, results).alias("row"))
    return out.select(F.pmod(F.xxhash64("txt", "row"), F.lit(n)).cast("int").alias("blk"), "txt", "row")


#: Bits of the filter that keeps rows without a partner out of a shuffle; 2 MB, however many keys there are.
FILTER_BITS = 23


def possible(rows: DataFrame, hashed: Column, keys: DataFrame, key_hash: Column, name: str = "possible") -> DataFrame:
    """``rows`` with a flag: false where no key has the row's hash, so that an exact join need not see the row.

    The keys set bits of a bitmap of fixed size, which is broadcast; more keys only make more flags true.
    """
    bit = keys.select(F.pmod(key_hash, F.lit(1 << FILTER_BITS)).alias("_bit"))
    bitmap = bit.groupBy((F.col("_bit") / 64).cast("long").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_bit % 64 as int))")).alias("_bits"))
    at = rows.withColumn("_at", F.pmod(hashed, F.lit(1 << FILTER_BITS)))
    at = at.join(F.broadcast(bitmap), (F.col("_at") / 64).cast("long") == F.col("_word"), "left")
    flag = F.coalesce(F.expr("shiftright(_bits, cast(_at % 64 as int)) & 1"), F.lit(0)) == 1
    return at.withColumn(name, flag).drop("_at", "_word", "_bits")


def whole_groups(batches, column: str, rows: int = 40_000):
    """Arrow tables of about ``rows`` rows out of batches sorted by ``column``; no value is split between two tables."""
    import pyarrow as pa

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(column).to_numpy()
        cut = int((keys != keys[-1]).nonzero()[0][-1]) + 1 if (keys != keys[-1]).any() else 0
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held)
