"""Members of a bucket met by each other in blocks of bounded size.

A bucket of any size is cut into blocks, and each two blocks are one group of rows, so no task
holds a whole bucket.  Members of one crowd (a class that is joined already) need not meet each
other: the crowd's blocks only meet those of the others, and a member is copied once for each
block that it has to meet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierwise.llm.frames import partitions
from tierwise.llm.skew import heavy_keys, spread_join

#: Members in a block, on average.
BLOCK = 256
_GROUP = ("bucket", "_one", "_two")

#: Gets the rows of a group and, for each row, the rows it has to meet; gives the result rows.
Meet = Callable[[pa.Table, Iterator[tuple[int, np.ndarray]]], pa.RecordBatch]


def _meetings(one: int, two: int, slot: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if one == two:
        for i in range(len(slot) - 1):
            yield i, np.arange(i + 1, len(slot))
    else:
        others = np.flatnonzero(slot == two)
        for i in np.flatnonzero(slot == one).tolist():
            yield i, others


def meet_in_blocks(members: DataFrame, schema: str | T.StructType, meet: Meet, crowd: Column | None = None, block: int = BLOCK) -> DataFrame:
    """What ``meet`` gives for ``members(bucket, node, ...)``, one row a member of a bucket.

    Any two members of a bucket meet in one group, unless both are of the ``crowd``.
    """
    known = members.withColumn("_crowd", F.lit(False) if crowd is None else crowd)
    sizes = known.groupBy("bucket").agg(F.count_if(~F.col("_crowd")).alias("_n"), F.count_if("_crowd").alias("_c"))
    sizes = sizes.where("_n > 0 and _n + _c > 1").select(
        F.col("bucket"),
        F.ceil(F.col("_n") / block).cast("int").alias("_blocks"),
        F.ceil(F.col("_c") / block).cast("int").alias("_crowds"),
        (F.col("_n") + F.col("_c")).alias("_members"),
    )
    known = spread_join(known, sizes.drop("_members"), "bucket", heavy_keys(sizes, "bucket", "_members"), ["node"])
    own = F.pmod(F.xxhash64("node"), F.when(F.col("_crowd"), F.col("_crowds")).otherwise(F.col("_blocks"))).cast("int")
    known = known.withColumn("_slot", own + F.when(F.col("_crowd"), F.col("_blocks")).otherwise(0))
    last = F.when(F.col("_crowd"), F.col("_blocks")).otherwise(F.col("_blocks") + F.col("_crowds")) - 1
    known = known.withColumn("_other", F.explode(F.sequence(F.lit(0), last)))
    known = known.withColumn("_one", F.least("_slot", "_other")).withColumn("_two", F.greatest("_slot", "_other"))
    known = known.drop("_crowd", "_blocks", "_crowds", "_other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []  # the group that the batch so far ended with

        def groups(table: pa.Table, ended: bool) -> Iterator[tuple[int, int]]:
            keys = [table.column(c).to_numpy() for c in _GROUP]
            new = np.zeros(len(table), bool)
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            cuts = [0, *np.flatnonzero(new).tolist(), len(table)]
            yield from list(zip(cuts, cuts[1:]))[: None if ended else -1]

        def done(table: pa.Table, ended: bool) -> Iterator[pa.RecordBatch]:
            upto = 0
            one, two, slot = (table.column(c).to_numpy() for c in ("_one", "_two", "_slot"))
            for low, high in groups(table, ended):
                upto = high
                if high - low > 1:
                    found = meet(table.slice(low, high - low), _meetings(one[low], two[low], slot[low:high]))
                    if len(found):
                        yield found
            rest = table.slice(upto)
            waiting[:] = rest.to_batches() if len(rest) else []

        for batch in batches:
            if len(batch):
                yield from done(pa.Table.from_batches([*waiting, batch]), False)
        if waiting:
            yield from done(pa.Table.from_batches(waiting), True)

    dealt = known.repartition(partitions(members.sparkSession), *_GROUP).sortWithinPartitions(*_GROUP)
    return dealt.mapInArrow(run, schema)
