"""Running sums over a whole sorted table without a task that sees it whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import stored


def running_sums(rows: DataFrame, order: list[str], sums: dict[str, str], carry: list[str]) -> DataFrame:
    """The ``carry`` columns, and for each name in ``sums`` the sum of its column over all rows before, in the given order.

    Rows are range-partitioned and summed within their partition, batch after batch; the sums of whole
    partitions, one row each, shift them. ``order`` should be unique, or equal rows stand in any order.
    ``rows`` should be a stored table: the range partitioning looks at it once more.
    """
    spark = rows.sparkSession
    kinds = dict(rows.dtypes)
    names = list(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), dict.fromkeys(names, 0)
        for batch in batches:
            if not len(batch):
                continue
            columns = [batch.column(batch.schema.get_field_index(c)) for c in carry]
            for name in names:
                sizes = batch.column(batch.schema.get_field_index(sums[name])).to_numpy()
                ends = before[name] + np.cumsum(sizes)
                before[name] = int(ends[-1])
                columns += [pa.array(ends - sizes), pa.array(ends)]
            columns.append(pa.array(np.full(len(batch), part, np.int32)))
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, *(f"_{side}_{n}" for n in names for side in ("from", "to")), "_part"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = [*(f"`{c}` {kinds[c]}" for c in carry), *(f"`_{side}_{n}` long" for n in names for side in ("from", "to")), "_part int"]
    local = stored(sorted_.mapInArrow(run, ", ".join(schema)))
    # one row per range partition
    ends = sorted(local.groupBy("_part").agg(*[F.max(f"_to_{n}").alias(n) for n in names]).collect())
    shifts, total = [], dict.fromkeys(names, 0)
    for row in ends:
        shifts.append((row["_part"], *(total[n] for n in names)))
        total = {n: total[n] + row[n] for n in names}
    shift = spark.createDataFrame(shifts, ", ".join(["_part int", *(f"`_shift_{n}` long" for n in names)]))
    placed = local.join(F.broadcast(shift), "_part")
    return placed.select(*[F.col(f"`{c}`") for c in carry], *[(F.col(f"_from_{n}") + F.col(f"_shift_{n}")).alias(n) for n in names])
