"""Exact top-k by inner product on a bit-sliced index.

Vectors are quantised to integers.  The index cuts them into blocks; in a block each
attribute, shifted to start at 0, is stored as bit slices: bitmap i holds bit i of that
attribute for all rows.  A query's score for every row of a block is one sum of shifted
slices: bit j of a weight adds the attribute's slices j places higher, and a negative weight
adds the complement instead.  Bitmaps of the same place are added three at a time by a
carry-save adder, so sums stay bitmaps.  The top rows are then taken from the most
significant slice downward: rows with the bit stay while there are k of them at least.
The rows left at the boundary all have the same score; ids decide between them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catchframe.llm.common import map_arrow

BLOCK_ROWS = 16_384
# Components of this size and scores of twice its square root fail the job: sums of slices have 64 bits.
LIMIT = 1 << 61


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component as a long; one that 64 bits cannot hold fails the job."""
    def one(x: Column) -> Column:
        y = x.cast("double") * scale
        return F.when(F.abs(y) < F.lit(float(LIMIT)), F.floor(y)).otherwise(
            F.raise_error(F.concat(F.lit("component too large to be quantised: "), x.cast("string"))).cast("long")
        )

    return F.transform(vector, one)


def usable(vector: Column) -> Column:
    """Vectors that take part: not missing, without missing or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _grid(vectors: list[list[int]], dims: int) -> np.ndarray:
    """One row per vector; shorter ones end in zeros, longer ones lose what has no partner."""
    out = np.zeros((len(vectors), dims), dtype=np.int64)
    for i, v in enumerate(vectors):
        v = v[:dims]
        out[i, :len(v)] = v
    return out


class SlicedBlock:
    """Bit slices of up to a few thousand rows."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, values = ids[order], values[order]
        self.rows, self.dims = values.shape
        self.words = -(-self.rows // 64)
        self.least = values.min(axis=0, initial=0) if self.rows else np.zeros(self.dims, dtype=np.int64)
        shifted = values - self.least
        self.bits = [int(x).bit_length() for x in shifted.max(axis=0, initial=0)]
        self.slices = [np.stack([self._bitmap((shifted[:, d] >> b) & 1) for b in range(n)]) if n else None for d, n in enumerate(self.bits)]
        self.flipped = [None if s is None else ~s for s in self.slices]
        self.all = self._bitmap(np.ones(self.rows, dtype=np.int64))
        self.largest = [max(abs(int(a)), abs(int(b))) for a, b in zip(values.min(axis=0, initial=0), values.max(axis=0, initial=0))]

    def _bitmap(self, flags: np.ndarray) -> np.ndarray:
        packed = np.zeros(self.words * 8, dtype=np.uint8)
        data = np.packbits(flags.astype(bool), bitorder="little")
        packed[:len(data)] = data
        return packed.view(np.uint64)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray | None], int]:
        """Slices of the sums from the lowest place up, and the constant that the sums lack."""
        places: dict[int, list[np.ndarray]] = {}
        # Python's integers have no end; a component shifted to start at 0 is at most twice the largest.
        if 4 * sum(abs(w) * x for w, x in zip(query.tolist(), self.largest)) >= LIMIT:
            raise ValueError("scores do not fit 64 bits")
        constant = int(query @ self.least)
        for d in np.flatnonzero(query).tolist():
            if not self.bits[d]:
                continue
            weight = int(query[d])
            source = self.slices[d] if weight > 0 else self.flipped[d]
            if weight < 0:
                # -w * u = w * (complement of u) - w * (2**bits - 1)
                constant += weight * ((1 << self.bits[d]) - 1)
                weight = -weight
            for j in range(weight.bit_length()):
                if weight >> j & 1:
                    for b in range(self.bits[d]):
                        places.setdefault(j + b, []).append(source[b:b + 1])
        out: list[np.ndarray | None] = []
        p = 0
        while places:
            maps = places.pop(p, [])
            if maps:
                pile = np.concatenate(maps)
                while len(pile) > 1:
                    pile, carry = self._add(pile)
                    places.setdefault(p + 1, []).append(carry)
                out.append(pile[0])
            else:
                out.append(None)
            p += 1
        return out, constant

    @staticmethod
    def _add(pile: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Carry-save addition of one place: about a third of the bitmaps is left, the carries go one place up."""
        n = len(pile) // 3
        if not n:
            return pile[:1] ^ pile[1:], pile[:1] & pile[1:]
        a, b, c = pile[:n], pile[n:2 * n], pile[2 * n:3 * n]
        half = a ^ b
        return np.concatenate([half ^ c, pile[3 * n:]]), (a & b) | (half & c)

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows but those with the query's own id; equal scores by smaller id."""
        slices, constant = self.scores(query)
        sure, open_ = np.zeros(self.words, dtype=np.uint64), self.all.copy()
        mine = slice(*np.searchsorted(self.ids, [own, own + 1]))
        for row in range(mine.start, mine.stop):
            open_[row >> 6] &= ~(np.uint64(1) << np.uint64(row & 63))
        found = 0
        for s in reversed(slices):
            if s is None:
                continue
            with_bit = open_ & s
            n = int(np.bitwise_count(with_bit).sum())
            if found + n > k:
                open_ = with_bit
            else:
                sure |= with_bit
                open_ = open_ & ~s
                found += n
                if found == k:
                    break
        rows = self._rows(sure)
        if found < k:
            # Equal scores at the boundary: rows are in the order of ids.
            rows = np.concatenate([rows, self._rows(open_)[:k - found]])
        total = np.zeros(len(rows), dtype=np.int64)
        for p, s in enumerate(slices):
            if s is not None:
                total += (s[rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64) << p
        return self.ids[rows], total + constant

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64, id_column: str = "vec_id", column: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score``: the k best rows of ``vectors`` for each query.

    Slices follow the real size of the components; scores that 64 bits cannot hold fail the job.

    All rows but those with the query's own id are candidates.  Equal scores go by the
    smaller id; rows that repeat an id are candidates of their own.  Rows
    without an id or with an unusable vector take no part.  Vectors of unequal length count
    as ended by zeros; an empty one scores 0.  Each task holds one index block, through
    which all queries stream; per block k rows of each query go on.
    """
    def take(df: DataFrame) -> DataFrame:
        return df.where(F.col(id_column).isNotNull() & usable(F.col(column))).select(
            F.col(id_column).cast("long").alias("id"), quantised(F.col(column), scale).alias("v")
        )

    spark = vectors.sparkSession
    rows = take(vectors)
    n_blocks = max(spark.sparkContext.defaultParallelism, -(-rows.count() // block_rows))
    # Blocks of equal size: rows are dealt in turn, whatever their ids.
    part = F.spark_partition_id()
    members = rows.repartition(n_blocks).select(part.alias("block"), F.lit(0).alias("kind"), "id", "v")
    asked = take(queries).select(
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.lit(1).alias("kind"), "id", "v"
    )
    # One block per task, by its own number.
    stream = members.unionByName(asked).repartitionById(n_blocks, "block").sortWithinPartitions("block", "kind")
    names = ["query_id", "vec_id", "score"]

    def run(batches):
        block, ids, held, sliced = None, [], [], None
        for batch in batches:
            out = [[], [], []]
            for b, kind, i, v in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if b != block:
                    block, ids, held, sliced = b, [], [], None
                if kind == 0:
                    ids.append(i)
                    held.append(v)
                    continue
                if sliced is None:
                    dims = max(map(len, held), default=0)
                    sliced = SlicedBlock(np.array(ids, dtype=np.int64), _grid(held, dims))
                    ids, held = [], []
                got, score = sliced.top(_grid([v], sliced.dims)[0], i, k)
                out[0] += [i] * len(got)
                out[1] += got.tolist()
                out[2] += score.tolist()
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    best = map_arrow(stream, run, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
