"""Leave rows out of a shuffle that cannot find a partner in it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.operators import keyfilter
from chartloom.session import materialize

#: Blocks of 4 KB that are broadcast at most: 8 MB. With more keys than these are for, more rows pass.
BLOCKS = 1 << 11


def may_be_in(rows: DataFrame, key: str, keys: DataFrame, mark: str) -> DataFrame:
    """``rows`` with a column that is false only where ``key`` is not among the stored ``keys`` (a column
    of the same name). The rows meet a Bloom filter of bounded size where they are; none is moved."""
    blocks = min(BLOCKS, keyfilter.blocks_for(keys.count()))
    filters = materialize(keyfilter.build(keys.select(key), key, blocks), "filter")
    return keyfilter.ask(rows, key, F.broadcast(filters), blocks, mark)
