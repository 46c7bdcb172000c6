"""Best-fit packing of token pieces into sequences of bounded length.

Texts are tokenized where they are read; only (id, piece, start, length, crc) rows go on.  Pieces are dealt to
groups of bounded size, and each group is packed by best-fit decreasing: a segment tree over remaining capacities
gives the tightest open bin in logarithmic time.  Bins that stay loose are dissolved and their pieces packed once
more in coarser groups, so that little is lost at the borders of groups.

Defined results: null text is the empty text, whose only token is the end id; repeated rows are packed each on their
own; ties in length may be placed in any order; null ids and extra columns do no harm; an empty table packs to no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annotspark.llm.common import text_or_empty, written
from annotspark.llm.tokens import slices, word_encoder

#: Pieces in a group of the first pass; a group of the second pass takes the leftovers of as many groups as COARSER says.
GROUP_PIECES = 2048
COARSER = 16
#: Entries of the encoder's memo, which a task of the pipeline holds beside what earlier stages left in its executor.
MEMO_ENTRIES = 200_000


class OpenBins:
    """Segment tree over remaining capacities 1..size: how many open bins have each; finds the least capacity >= want."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(self.leaves)]

    def put(self, capacity: int, bin_id: int) -> None:
        if capacity > 0:
            self.bins[capacity].append(bin_id)
            self._add(capacity, 1)

    def _add(self, capacity: int, by: int) -> None:
        k = self.leaves + capacity
        while k:
            self.count[k] += by
            k >>= 1

    def take(self, want: int) -> tuple[int, int] | None:
        """A bin of the tightest capacity that holds ``want``, or None."""
        k = self.leaves + want
        if not self.count[k]:
            while k > 1 and (k & 1 or not self.count[k + 1]):
                k >>= 1
            if k == 1:
                return None
            k += 1
            while k < self.leaves:
                k = 2 * k if self.count[2 * k] else 2 * k + 1
        capacity = k - self.leaves
        self._add(capacity, -1)
        return capacity, self.bins[capacity].pop()


def best_fit(lengths, size: int) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece, and the fill of each bin; longest pieces first."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins, offsets, fill, open_bins = [0] * len(lengths), [0] * len(lengths), [], OpenBins(size)
    for i in order:
        n = int(lengths[i])
        found = open_bins.take(n)
        if found is None:
            found = (size, len(fill))
            fill.append(0)
        capacity, b = found
        bins[i], offsets[i] = b, fill[b]
        fill[b] += n
        open_bins.put(capacity - n, b)
    return bins, offsets, fill


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``size`` tokens: id, piece, start, length, ids_crc32."""
    fields = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc, end = word_encoder(tokenizer, MEMO_ENTRIES), end_id.to_bytes(4, "little")
        for batch in (part for whole in batches for part in slices(whole, 1)):
            which, piece, start, length, crc = [], [], [], [], []
            offsets, ids = enc.encode(batch.column(1))
            raw, offsets = ids.astype("<u4").tobytes(), offsets.tolist()
            for k in range(len(batch)):
                own = raw[4 * offsets[k] : 4 * offsets[k + 1]] + end
                for p, at in enumerate(range(0, len(own), 4 * size)):
                    part = own[at : at + 4 * size]
                    which.append(k)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(which, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                names=[id_col, "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col(id_col), text_or_empty(text_col).alias("_text")).mapInArrow(run, fields)


def _packed(pieces: DataFrame, group_col: str, size: int, level: int, id_type: str, id_col: str) -> DataFrame:
    fields = f"{id_col} {id_type}, piece int, start long, length long, ids_crc32 long, _row long, sequence_id long, offset long, _fill long"

    def run(table):
        import numpy as np
        import pyarrow as pa

        group = table.column(group_col)[0].as_py()
        lengths = table.column("length").to_numpy()
        bins, offsets, fill = best_fit(lengths.tolist(), size)
        bins = np.array(bins, dtype=np.int64)
        cols = [table.column(c) for c in (id_col, "piece", "start", "length", "ids_crc32", "_row")]
        ids = (np.int64(level) << 62) + (np.int64(group) << 24) + bins
        return pa.Table.from_arrays(
            [*cols, pa.array(ids), pa.array(offsets, pa.int64()), pa.array(np.array(fill, dtype=np.int64)[bins])],
            names=[id_col, "piece", "start", "length", "ids_crc32", "_row", "sequence_id", "offset", "_fill"],
        )

    return pieces.groupBy(group_col).applyInArrow(run, fields)


def pack(pieces: DataFrame, size: int = 4096, id_col: str = "doc_id", group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` (gapless from 0) to the pieces."""
    id_type = pieces.schema[id_col].dataType.simpleString()
    kept = written(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-kept.count() // group_pieces))
    spread = F.pmod(F.xxhash64("_row"), F.lit(groups))
    first = written(_packed(kept.withColumn("_g", spread), "_g", size, 0, id_type, id_col), "packed")
    loose = F.col("_fill") < size - size // 8
    again = first.where(loose).drop("sequence_id", "offset", "_fill")
    spread = F.pmod(F.xxhash64("_row"), F.lit(max(1, groups // COARSER)))
    second = _packed(again.withColumn("_g", spread), "_g", size, 1, id_type, id_col)
    return first.where(~loose).unionByName(second).drop("_row", "_fill")
