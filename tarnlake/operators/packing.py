"""Rows packed into files of a size, and budgets cut, exactly or by running sums."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tarnlake.session import stage


def running_sum(df: DataFrame, keys: list[str], order: list[str], size: str, name: str, block_rows: int = 1 << 20) -> DataFrame:
    """``df`` with the running sum ``name`` of ``size`` by ``keys`` in the order of ``order``; a null size adds nothing.

    No group gathers in one task, however many rows a key has: rows are range-partitioned by keys and order into blocks
    of about ``block_rows``, summed as they stream by, and a block's first key gets what earlier blocks summed for it.
    A row for each block reaches the driver. Pass narrow rows (an id and a size) and join the rest back. ``order`` must
    be unique within a key.
    """
    blocks = df.count() // block_rows + 1
    key = F.xxhash64(*keys) if keys else F.lit(0).cast("long")
    rows = df.withColumn("_key", key).repartitionByRange(blocks, *keys, *order).sortWithinPartitions(*keys, *order)
    schema = StructType([*rows.schema.fields, StructField("_within", LongType()), StructField("_at", LongType()), StructField("_block", IntegerType())])

    def summed(batches):
        block, at, last, carry = TaskContext.get().partitionId(), 0, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            k = b.column("_key").to_numpy(zero_copy_only=False)
            n = pc.fill_null(b.column(size), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            upto = np.cumsum(n)
            new = np.concatenate([[k[0] != last], k[1:] != k[:-1]])
            start = np.maximum.accumulate(np.where(new, np.arange(len(k)), -1))  # -1: the run goes on from the batch before
            upto = np.where(start < 0, upto + carry, upto - (upto - n)[np.maximum(start, 0)])
            last, carry = k[-1], int(upto[-1])
            more = [pa.array(upto), pa.array(np.arange(at, at + len(k))), pa.array(np.full(len(k), block, np.int32))]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, "_within", "_at", "_block"])
            at += len(k)

    parts = stage(rows.mapInArrow(summed, schema), "blocks")
    ends = parts.groupBy("_block").agg(F.min_by("_key", "_at").alias("first"), F.max_by("_key", "_at").alias("last"), F.max_by("_within", "_at").alias("tail")).orderBy("_block").collect()
    before, carry = [], 0
    for b, up in zip(ends[1:], ends):
        carry = up.tail + (carry if up.first == up.last else 0)
        if b.first == up.last:
            before.append((b["_block"], b.first, carry))
        else:
            carry = 0
    if before:
        add = F.broadcast(df.sparkSession.createDataFrame(before, "_block int, _key long, _before long"))
        parts = parts.join(add, ["_block", "_key"], "left").withColumn("_within", F.col("_within") + F.coalesce("_before", F.lit(0))).drop("_before")
    return parts.withColumnRenamed("_within", name).drop("_block", "_key", "_at")


def files_by_running_sum(df: DataFrame, keys: list[str], order: list[str], size: str, limit: int) -> DataFrame:
    """``file_no`` by the bytes before a row: files of about ``limit``, at any scale."""
    s = running_sum(df, keys, order, size, "_upto")
    return s.withColumn("file_no", F.floor((F.col("_upto") - F.col(size)) / limit)).drop("_upto")


def pack_exactly(df: DataFrame, keys: list[str], order: str, size: str, limit: int, block_rows: int = 1 << 20) -> DataFrame:
    """``file_no`` by greedy packing: a row opens a new file if it would bring the current one to ``limit`` or over.

    Every file depends on where the one before ended, yet no group gathers anywhere: rows stream by in sorted blocks. A
    block can be entered with any number of bytes in the open file, but that only matters for which row opens the first
    new file; from there on the files are the same. So each block reports, for each row that may be the first to open
    one, how the block ends; the driver links the blocks (a row for each distinct end), and a second pass numbers the
    files. ``order`` must be unique within a key; a null size counts as 0.
    """
    work = running_sum(df.select(*keys, order, F.coalesce(F.col(size), F.lit(0)).cast("long").alias("_n")), keys, [order], "_n", "_upto", block_rows)
    blocks = work.count() // block_rows + 1
    key = F.xxhash64(*keys) if keys else F.lit(0).cast("long")
    rows = stage(work.withColumn("_key", key).repartitionByRange(blocks, *keys, order).sortWithinPartitions(*keys, order).withColumn("_block", F.spark_partition_id()), "packed")

    def runs(batches):
        """The rows of a task, one block's and key's at a time: (table, key, sizes, running sums)."""
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        k, b = table.column("_key").to_numpy(), table.column("_block").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero((k[1:] != k[:-1]) | (b[1:] != b[:-1])) + 1, [len(k)]])
        for a, e in zip(cuts[:-1], cuts[1:]):
            part = table.slice(a, e - a)
            yield part, int(k[a]), part.column("_n").to_numpy(), part.column("_upto").to_numpy()

    def openers(n: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Of each row, if a file begins with it: the row that opens the next file; the number of rows if none here does."""
        before = upto - n
        at = np.searchsorted(upto, before + limit, "left")
        return np.maximum(at, np.arange(1, len(n) + 1))

    def ends(batches):
        for part, key, n, upto in runs(batches):
            block, m = part.column("_block")[0].as_py(), len(n)
            nxt = np.append(openers(n, upto), m)
            last, hops, step = np.append(np.arange(m), m), np.ones(m + 1, np.int64), nxt.copy()
            hops[m] = 0
            # last file opened and files opened, from each row on, by doubling the steps
            at, count = last.copy(), hops.copy()
            while (step < m).any():
                on = step < m
                at[on], count[on] = at[step[on]], count[on] + count[step[on]]
                step = step[step]
            # entered with u bytes, row j opens the first file: u + (bytes of the block before j) < limit <= u + those and j's
            base = upto[0] - n[0]
            far = np.searchsorted(upto, base + limit, "left")
            cand = np.arange(0, min(far + 1, m))
            held = upto[-1] - (upto[at[cand]] - n[at[cand]])
            same = np.concatenate([[True], (held[1:] != held[:-1]) | (count[cand][1:] != count[cand][:-1])])
            rows_ = [(block, key, int(upto[j] - base), int(h), int(c)) for j, h, c in zip(cand[np.append(np.flatnonzero(same)[1:] - 1, len(cand) - 1)], held[same], count[cand][same])]
            out = pd.DataFrame(rows_, columns=["block", "key", "reach", "held", "opened"])
            out["total"] = int(upto[-1] - base)
            yield pa.RecordBatch.from_pandas(out.astype({"block": "int32"}), preserve_index=False)

    summary = rows.mapInArrow(ends, "block int, key long, reach long, held long, opened long, total long").orderBy("block", "key", "reach").collect()
    enter: list[tuple[int, int, int, int]] = []
    grouped: dict[tuple[int, int], list] = {}
    for r in summary:
        grouped.setdefault((r.block, r.key), []).append(r)
    state: dict[int, tuple[int, int]] = {}
    for (block, k), options in grouped.items():
        used, no = state.get(k, (0, -1))
        enter.append((block, k, used, no))
        if no < 0:  # the key's first row opens its first file
            first = options[0]
            state[k] = first.held, first.opened - 1
            continue
        hit = next((o for o in options if used + o.reach >= limit), None) if used + options[0].total >= limit else None
        state[k] = (hit.held, no + hit.opened) if hit else (used + options[0].total, no)
    entered = {(b, k): (u, no) for b, k, u, no in enter}

    schema = StructType([f for f in rows.schema.fields if f.name in (*keys, order)] + [StructField("file_no", LongType())])

    def numbered(batches):
        for part, key, n, upto in runs(batches):
            used, no = entered[(part.column("_block")[0].as_py(), key)]
            m, base = len(n), upto[0] - n[0]
            nxt = openers(n, upto)
            at = 0 if no < 0 else int(np.searchsorted(upto, base + limit - used, "left"))
            new = np.zeros(m, np.int64)
            while at < m:
                new[at] = 1
                at = int(nxt[at])
            out = part.select([*keys, order]).append_column("file_no", pa.array(max(no, -1) + np.cumsum(new)))
            yield from out.combine_chunks().to_batches()

    numbers = rows.mapInArrow(numbered, schema)
    return df.join(numbers, [*keys, order])


def within_budget(df: DataFrame, keys: list[str], order: list[str], size: str, budget: int) -> DataFrame:
    """The rows, in order, whose running sum stays within ``budget``."""
    return running_sum(df, keys, order, size, "_upto").where(F.col("_upto") <= budget).drop("_upto")


def greedy_with_skip(df: DataFrame, order: list[str], size: str, budget: int) -> DataFrame:
    """The rows that a greedy walk in ``order`` takes: each whose ``size`` still fits what is left of ``budget``, larger ones
    are skipped and later, smaller ones still taken. Null sizes are left out, sizes of 0 always fit.

    What is left only shrinks, so a row that is larger than it is out for good. Each round takes, of those that could fit,
    the rows up to the first that doesn't, by a distributed running sum; the next begins behind it. Only sums reach the driver.
    """
    rows = stage(df.where(F.col(size).isNotNull()), "greedy")
    left, taken, after = budget, [], None
    while True:
        fits = rows.where(F.col(size) <= left)
        if after is not None:
            fits = fits.where(F.struct(*order) > F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, after)]))
        upto = running_sum(fits, [], order, size, "_upto")
        inside = upto.where(F.col("_upto") <= left)
        used, first_over = inside.agg(F.max("_upto")).first()[0], upto.where(F.col("_upto") > left).agg(F.min(F.struct(*order))).first()[0]
        if used is not None:
            taken.append(inside.drop("_upto"))
        if first_over is None:
            break
        left, after = left - (used or 0), tuple(first_over)
    return reduce(DataFrame.unionByName, taken) if taken else df.limit(0)


def partition_lines(df: DataFrame, order: list[str], files: int) -> DataFrame:
    """``df`` with in_order and in_turn: the file of each row if ``files`` are filled one after another, each with an equal
    number of lines rounded up, or if rows are dealt to them in turn. ``order`` must be unique."""
    numbered = running_sum(df.withColumn("_one", F.lit(1)), [], order, "_one", "_no").withColumn("_no", F.col("_no") - 1).drop("_one")
    each = max(1, -(-numbered.count() // files))
    return numbered.withColumn("in_order", F.floor(F.col("_no") / each)).withColumn("in_turn", F.col("_no") % files).drop("_no")
