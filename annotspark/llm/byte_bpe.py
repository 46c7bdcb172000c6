"""Byte-level BPE: encoding by a rank table and decoding.

Each piece that the split pattern gives is merged on its own.  A segment tree stands over its byte positions; every
leaf holds the rank of the pair that begins there, every inner node the leftmost least rank below it.  A merge takes
the root's position, joins it with its live right neighbour and updates the leaves of the pairs it touched, each in
logarithmic time, so a piece of n bytes costs O(n log n) whatever it holds.  The short pieces of a batch are merged
side by side, one numpy row for each piece's tree.

Defined results: null text is the empty text (no ids, empty bytes); repeated rows are encoded each on their own; null
ids and extra columns pass untouched; an empty table gives an empty one.  Runs per Arrow batch, without a shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annotspark.llm.common import text_or_empty
from annotspark.llm.tokens import MEMO_ENTRIES, ChunkEncoder

#: Pieces up to this many bytes are merged side by side.
SHORT = 64
_NONE = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class BytePairs(ChunkEncoder):
    """Encoder and decoder for one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        import regex

        self.ranks = ranks
        self.split = regex.compile(pattern)
        self.pieces: dict[str, bytes] = {}
        top = max(ranks.values()) + 1
        self.bytes_of = [b""] * top
        for b, i in ranks.items():
            self.bytes_of[i] = b
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.width = top
        joined = {
            ranks[b[:k]] * top + ranks[b[k:]]: i for b, i in ranks.items() for k in range(1, len(b)) if b[:k] in ranks and b[k:] in ranks
        }
        self.pair_keys = np.array(sorted(joined), dtype=np.int64)
        self.pair_rank = np.array([joined[k] for k in self.pair_keys.tolist()], dtype=np.int64)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the least rank first, leftmost among equals."""
        ranks, n = self.ranks, len(piece)
        if piece in ranks or n < 2:
            return [ranks[piece]] if n else []
        size = 1 << (n - 1).bit_length()
        end = list(range(1, n + 1))  # of the token that starts here
        before = list(range(-1, n - 1))  # start of the live token to the left
        tree = [_NONE] * (2 * size)  # rank * size + position, so that the least is the leftmost too

        def pair(i: int) -> int:
            r = ranks.get(piece[i : end[end[i]]]) if end[i] < n else None
            return _NONE if r is None else r * size + i

        def put(i: int, value: int) -> None:
            k = size + i
            tree[k] = value
            while k > 1:
                k >>= 1
                least = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == least:
                    return
                tree[k] = least

        for i in range(n):
            tree[size + i] = pair(i)
        for k in range(size - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        while tree[1] < _NONE:
            i = tree[1] & (size - 1)
            j = end[i]
            end[i] = end[j]
            if end[j] < n:
                before[end[j]] = i
            put(j, _NONE)
            put(i, pair(i))
            if before[i] >= 0:
                put(before[i], pair(before[i]))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def _rank_of(self, left, right):
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_rank[at], -1)

    def _merge_rows(self, pieces: list[bytes], size: int) -> list[bytes]:
        """:meth:`merge` for many pieces of 2 to ``size`` bytes; column ``size`` is a stop behind every row."""
        m, bits = len(pieces), size.bit_length() - 1
        n = np.fromiter(map(len, pieces), dtype=np.int64, count=m)
        raw = np.zeros((m, size), dtype=np.uint8)
        raw[np.arange(size) < n[:, None]] = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        token = np.zeros((m, size + 1), dtype=np.int64)
        token[:, :size] = self.byte_id[raw]
        live = np.arange(size) < n[:, None]
        after = np.tile(np.minimum(np.arange(1, size + 2), size), (m, 1))
        after[:, :size] = np.where(np.arange(1, size + 1) < n[:, None], after[:, :size], size)
        before = np.tile(np.arange(-1, size), (m, 1))
        tree = np.full((m, 2 * size), _NONE, dtype=np.int64)
        row, col = np.nonzero(np.arange(1, size + 1) < n[:, None])
        rank = self._rank_of(token[row, col], token[row, col + 1])
        tree[row, size + col] = np.where(rank >= 0, (rank << bits) + col, _NONE)
        for k in range(size - 1, 0, -1):
            tree[:, k] = np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1])

        def pair(r, i):
            j = after[r, i]
            rank = self._rank_of(token[r, i], token[r, j])
            return np.where((j < size) & (rank >= 0), (rank << bits) + i, _NONE)

        def put(r, i, value):
            k = size + i
            tree[r, k] = value
            for _ in range(bits):
                k = k >> 1
                tree[r, k] = np.minimum(tree[r, 2 * k], tree[r, 2 * k + 1])

        r = np.flatnonzero(tree[:, 1] < _NONE)
        while len(r):
            i = tree[r, 1] & (size - 1)
            j = after[r, i]
            token[r, i] = tree[r, 1] >> bits
            live[r, j] = False
            after[r, i] = after[r, j]
            before[r, after[r, j]] = i
            put(r, j, _NONE)
            put(r, i, pair(r, i))
            left = before[r, i]
            has = left >= 0
            put(r[has], left[has], pair(r[has], left[has]))
            r = r[tree[r, 1] < _NONE]
        flat = token[:, :size][live].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(axis=1)) * 4
        return [flat[a:b] for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist())]

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        classes: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            if p in self.ranks or len(p) > SHORT or len(p) < 2:
                out[k] = array("I", self.merge(p)).tobytes()
            else:
                classes.setdefault(1 << (len(p) - 1).bit_length(), []).append(k)
        for size, which in classes.items():
            for at in range(0, len(which), 20_000):
                some = which[at : at + 20_000]
                for k, ids in zip(some, self._merge_rows([pieces[k] for k in some], size)):
                    out[k] = ids
        return out

    def new_chunks(self, chunks: list[str]) -> list[bytes]:
        split = [self.split.findall(c) for c in chunks]
        if len(self.pieces) > MEMO_ENTRIES:
            self.pieces.clear()
        known = self.pieces
        new = list({p for s in split for p in s if p not in known})
        known.update(zip(new, self.merge_all([p.encode("utf-8") for p in new])))
        return [known[s[0]] if len(s) == 1 else b"".join([known[p] for p in s]) for s in split]


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> BytePairs:
    return BytePairs(read_ranks(path), pattern)


def decode(offsets, ids, bytes_of: list[bytes]):
    """The bytes of each document of a batch, from its ids."""
    import pyarrow as pa
    import pyarrow.compute as pc

    parts = pa.array(bytes_of, pa.large_binary()).take(pa.array(ids))
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), parts), pa.scalar(b"", pa.large_binary()))


def _numbers(offsets, ids, top: int):
    """The decimal ids of each document, joined by one space."""
    import pyarrow as pa
    import pyarrow.compute as pc

    parts = pa.array([b"%d" % i for i in range(top)], pa.large_binary()).take(pa.array(ids))
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), parts), pa.scalar(b" ", pa.large_binary()))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Per document: id, ``ids`` (array, when kept), ``n_tokens``, the digest of the ids and of the decoded bytes."""
    fields = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    fields += ", ids array<int>" if keep_ids else ""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = encoder(ranks_path, pattern)
        sha = lambda column: pa.array([hashlib.sha256(x).hexdigest() for x in column.to_pylist()], pa.string())
        for batch in batches:
            offsets, ids = enc.encode(batch.column(1))
            columns = [batch.column(0), pa.array(np.diff(offsets)), sha(_numbers(offsets, ids, enc.width)), sha(decode(offsets, ids, enc.bytes_of))]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))
                columns, names = [*columns, lists], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(id_col), text_or_empty(text_col).alias("_text")).mapInArrow(run, fields)
