"""Rows of a wide table that a narrow list names, taken out or picked without moving their texts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit.llm import bitmaps
from assaykit.llm.columns import unused
from assaykit.operators.skew import ROWS_PER_TASK
from assaykit.session import cut

#: Rows of a list that may be broadcast; a row is an id and a hash.
LISTED = 500_000
LEAST_HOT = 1_000


def even_share(df: DataFrame, rows: int) -> int:
    """Rows above which a key is split: an even share of a task, so at most as many keys are hot as there
    are tasks."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(ROWS_PER_TASK, max(LEAST_HOT, rows // tasks))


def _named(docs: DataFrame, listed: DataFrame, id_col: str, text_col: str) -> Column:
    return docs[id_col].eqNullSafe(listed["_id"]) & (F.xxhash64(docs[text_col]) == listed["_hash"])


def without(docs: DataFrame, listed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of `docs` that `listed` does not name by (_id, _hash), id and text hash; a null id is an
    id like others. `listed` is written and has a row once.

    Up to LISTED rows are broadcast. A longer list becomes a bitmap of fixed size over the scan: rows
    that do not pass stay where they are; of the keys that pass, those that are not listed after all are
    found by a narrow join, and picked from the scan in the same way. No text is shuffled, unless more
    than LISTED rows pass the bitmap by chance; then those that pass are.
    """
    if listed.count() <= LISTED:
        return docs.join(F.broadcast(listed), _named(docs, listed, id_col, text_col), "left_anti")
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmaps.build(listed.select(F.xxhash64("_id", "_hash").alias("h")), "h"))

    @F.pandas_udf("boolean")
    def passes(h: pd.Series) -> pd.Series:
        return pd.Series(bitmaps.passes(bitmap.value, h.to_numpy(np.int64)))

    mark = unused(docs, "passes")
    marked = docs.withColumn(mark, passes(F.xxhash64(F.col(id_col), F.xxhash64(text_col))))
    able = marked.filter(mark).drop(mark)
    keys = able.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_hash")).distinct()
    same = keys["_id"].eqNullSafe(listed["_id"]) & (keys["_hash"] == listed["_hash"])
    chance = keys.join(listed, same, "left_anti")
    chance = cut(chance)
    if chance.count() <= LISTED:
        chance = F.broadcast(chance)
    more = able.join(chance, _named(able, chance, id_col, text_col), "left_semi")
    return marked.filter(~F.col(mark)).drop(mark).unionByName(more)
