"""Token ids as wavelet-matrix files.

Documents are put in id order by a range shuffle, tokenized, and written as shard files of bounded size.  A shard
file holds the wavelet matrix of its ids, a bit plane for every bit of an id, most significant first; one more plane
that marks the last id of each document; and the documents' own ids.  Planes are compressed in chunks, each with a count
of ones per 512 bits, so that any token can be read, counted or located from that file alone, inflating only the
chunks that it needs: ranks come from the counts and the bits of one block, selects from a search in the counts.

Defined results: null text is the empty text (only the end id); documents with equal ids keep any order among
themselves; null ids come first; extra columns are ignored; an empty table writes no file and gives no rows.
Tasks write under names of their own attempt and return them, so files of lost attempts are never read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annotspark.llm.common import shared_dir, text_or_empty, written
from annotspark.llm.tokens import word_encoder

SHARD_TOKENS = 1 << 20
#: Bits for which ones are counted, and bytes of a plane that are compressed together.
_BLOCK = 512
_CHUNK = 1 << 14
_ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)
_MAGIC = b"WVM2"


class BitPlane:
    """Bits with rank and select over counts per block; chunks are inflated when they are first needed."""

    def __init__(self, n: int, chunks: list[bytes], blocks: np.ndarray):
        self.n, self.chunks, self.blocks = n, chunks, blocks
        self.ones = int(blocks[-1])
        self._open: dict[int, np.ndarray] = {}

    @classmethod
    def build(cls, bits: np.ndarray) -> BitPlane:
        packed = np.packbits(bits, bitorder="little")
        step = _BLOCK // 8
        padded = np.zeros(-(-len(packed) // step) * step, dtype=np.uint8)
        padded[: len(packed)] = packed
        counts = _ONES[padded].reshape(-1, step).sum(axis=1, dtype=np.int64)
        chunks = [zlib.compress(padded[k : k + _CHUNK].tobytes(), 1) for k in range(0, len(padded), _CHUNK)]
        return cls(len(bits), chunks, np.concatenate([[0], np.cumsum(counts)]).astype("<u4"))

    def _chunk(self, k: int) -> np.ndarray:
        if k not in self._open:
            self._open[k] = np.frombuffer(zlib.decompress(self.chunks[k]), dtype=np.uint8)
        return self._open[k]

    def _blocks(self, which: np.ndarray) -> np.ndarray:
        """The bytes of the given blocks, a row each."""
        step, per = _BLOCK // 8, _CHUNK * 8 // _BLOCK
        out = np.zeros((len(which), step), dtype=np.uint8)
        for k in np.unique(which // per).tolist():
            if k < len(self.chunks):
                here = np.flatnonzero(which // per == k)
                rows = self._chunk(k).reshape(-1, step)
                inside = which[here] - k * per
                some = inside < len(rows)
                out[here[some]] = rows[inside[some]]
        return out

    def rank(self, pos) -> np.ndarray:
        """Ones before each position."""
        pos = np.asarray(pos, dtype=np.int64).ravel()
        block = pos // _BLOCK
        rows = self._blocks(block)
        byte, bit = (pos % _BLOCK) >> 3, pos & 7
        before = np.where(np.arange(rows.shape[1]) < byte[:, None], _ONES[rows], 0).sum(axis=1)
        inside = _ONES[rows[np.arange(len(pos)), byte] & ((1 << bit) - 1)]
        return self.blocks[block].astype(np.int64) + before + inside

    def get(self, pos) -> np.ndarray:
        pos = np.asarray(pos, dtype=np.int64).ravel()
        rows = self._blocks(pos // _BLOCK)
        return (rows[np.arange(len(pos)), (pos % _BLOCK) >> 3] >> (pos & 7) & 1).astype(np.int64)

    def select(self, bit: int, k) -> np.ndarray:
        """Where the k-th (from 0) one or zero stands."""
        k = np.asarray(k, dtype=np.int64).ravel()
        counts = self.blocks.astype(np.int64)
        if not bit:
            counts = np.arange(len(counts)) * _BLOCK - counts
        block = np.searchsorted(counts, k, side="right") - 1
        bits = np.unpackbits(self._blocks(block), axis=1, bitorder="little") == bit
        return block * _BLOCK + (np.cumsum(bits, axis=1) > (k - counts[block])[:, None]).argmax(axis=1)

    def all(self) -> np.ndarray:
        """All bits, without keeping what is inflated."""
        raw = b"".join(map(zlib.decompress, self.chunks))
        return np.unpackbits(np.frombuffer(raw, dtype=np.uint8), bitorder="little", count=self.n).view(bool)


class WaveletMatrix:
    """Access, count and lookup over the bit planes of a sequence of ids that is divided into documents."""

    def __init__(self, n: int, planes: list[BitPlane], ends: BitPlane, names: bytes = b""):
        self.n, self.planes, self.ends, self.names = n, planes, ends, names
        self.zeros = [n - p.ones for p in planes]

    @classmethod
    def build(cls, ids: np.ndarray, lengths=None, names: bytes = b"") -> WaveletMatrix:
        """``lengths`` are those of the documents (one, if left out), ``names`` their ids as :func:`named`."""
        top = int(ids.max()) if len(ids) else 0
        depth = max(1, top.bit_length())
        now = ids.astype(np.uint16 if depth <= 16 else np.uint32)
        planes = []
        for shift in range(depth - 1, -1, -1):
            bit = (now >> shift & 1).astype(bool)
            planes.append(BitPlane.build(bit))
            now = np.concatenate([now[~bit], now[bit]])
        end = np.zeros(len(ids), dtype=bool)
        end[np.cumsum(lengths if lengths is not None else [len(ids)]) - 1] = True
        return cls(len(ids), planes, BitPlane.build(end), names)

    def to_bytes(self) -> bytes:
        planes = [*self.planes, self.ends]
        head = {"n": self.n, "depth": len(self.planes), "names": len(self.names), "chunks": [[len(c) for c in p.chunks] for p in planes]}
        raw = json.dumps(head).encode()
        return b"".join([_MAGIC, len(raw).to_bytes(4, "little"), raw, self.names, *(p.blocks.tobytes() for p in planes), *(c for p in planes for c in p.chunks)])

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        head, at = cls.head(raw)
        n, names = head["n"], raw[at : at + head["names"]]
        at += head["names"]
        counts = -(-n // _BLOCK) + 1
        blocks = []
        for _ in head["chunks"]:
            blocks.append(np.frombuffer(raw, "<u4", counts, at))
            at += 4 * counts
        planes = []
        for own, sizes in zip(blocks, head["chunks"]):
            chunks = []
            for size in sizes:
                chunks.append(raw[at : at + size])
                at += size
            planes.append(BitPlane(n, chunks, own))
        return cls(n, planes[:-1], planes[-1], names)

    @staticmethod
    def head(raw: bytes) -> tuple[dict, int]:
        """A file's head, and where it ends; needs the file's beginning only."""
        if raw[:4] != _MAGIC:
            raise ValueError("not a wavelet-matrix file")
        size = int.from_bytes(raw[4:8], "little")
        return json.loads(raw[8 : 8 + size]), 8 + size

    def access(self, pos) -> np.ndarray:
        """The ids at the given positions."""
        pos = np.asarray(pos, dtype=np.int64).ravel()
        value = np.zeros(pos.shape, dtype=np.int64)
        for plane, zeros in zip(self.planes, self.zeros):
            bit, ones = plane.get(pos), plane.rank(pos)
            pos = np.where(bit == 1, zeros + ones, pos - ones)
            value = value << 1 | bit
        return value

    def _range(self, symbol: int, low: int, high: int) -> tuple[int, int]:
        depth = len(self.planes)
        if symbol >> depth:
            return 0, 0
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            a, b = plane.rank([low, high]).tolist()
            low, high = (zeros + a, zeros + b) if symbol >> (depth - 1 - level) & 1 else (low - a, high - b)
        return low, high

    def count(self, symbol: int, low: int, high: int) -> int:
        """How often the id stands in [low, high)."""
        a, b = self._range(symbol, low, high)
        return b - a

    def find(self, symbol: int) -> np.ndarray:
        """All positions of the id, by selecting upwards from its run in the last order."""
        low, high = self._range(symbol, 0, self.n)
        pos, depth = np.arange(low, high), len(self.planes)
        for level in range(depth - 1, -1, -1):
            one = symbol >> (depth - 1 - level) & 1
            pos = self.planes[level].select(one, pos - self.zeros[level] if one else pos)
        return np.sort(pos)

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document, without those of the others."""
        bounds = self.ends.select(1, [k - 1, k] if k else [k]) + 1
        return self.access(np.arange(bounds[0] if k else 0, bounds[-1]))

    def bounds(self) -> np.ndarray:
        """Where each document ends."""
        return np.flatnonzero(self.ends.all()) + 1

    def all(self) -> np.ndarray:
        """The whole sequence, undoing one stable split per plane."""
        depth = len(self.planes)
        kind = np.uint16 if depth <= 16 else np.uint32
        value = np.zeros(self.n, dtype=kind)
        for level in range(depth - 1, -1, -1):
            bit = self.planes[level].all()
            up = np.empty(self.n, dtype=kind)
            up[~bit] = value[: self.zeros[level]]
            up[bit] = value[self.zeros[level] :] | kind(1 << (depth - 1 - level))
            value = up
        return value


def named(ids) -> bytes:
    """Document ids, an Arrow array, as a compressed stream."""
    import pyarrow as pa

    out = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([ids], names=["id"])
    with pa.ipc.new_stream(out, batch.schema) as stream:
        stream.write_batch(batch)
    return zlib.compress(out.getvalue(), 1)


def names_of(raw: bytes):
    import pyarrow as pa

    with pa.ipc.open_stream(zlib.decompress(raw)) as stream:
        return stream.read_all().column("id").combine_chunks()


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, folder: str, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the shard files and returns which they are, in order: part, shard, path."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part, enc, mark = TaskContext.get().partitionId(), word_encoder(tokenizer), uuid.uuid4().hex[:8]
        store, base = _file_system(folder)
        store.create_dir(base, recursive=True)
        held, owners, lengths, size, shard = [], [], [], 0, 0

        def flush():
            name = f"part-{part:05d}-{shard:05d}-{mark}.wvm"
            matrix = WaveletMatrix.build(np.concatenate(held), lengths, named(pa.concat_arrays(owners)))
            with store.open_output_stream(f"{base}/{name}") as f:
                f.write(matrix.to_bytes())
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([name])], names=["part", "shard", "path"])

        for batch in batches:
            offsets, ids = enc.encode(batch.column(1))
            offsets = offsets.tolist()
            for k in range(len(batch)):
                held.append(np.append(ids[offsets[k] : offsets[k + 1]], np.uint32(end_id)))
                owners.append(batch.column(0).slice(k, 1))
                lengths.append(len(held[-1]))
                size += lengths[-1]
                if size >= shard_tokens:
                    yield flush()
                    held, owners, lengths, size, shard = [], [], [], 0, shard + 1
        if size:
            yield flush()

    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    ordered = rows.repartitionByRange(parts, F.col(id_col), F.xxhash64("_text")).sortWithinPartitions(id_col)
    return written(ordered.mapInArrow(run, "part int, shard int, path string"), "wavelet-manifest")


def _sizes(manifest: DataFrame, folder: str) -> DataFrame:
    """Adds ``n``, the ids of each file, from the file's head."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        store, base = _file_system(folder)
        for batch in batches:
            n = []
            for path in batch.column(2).to_pylist():
                with store.open_input_file(f"{base}/{path}") as f:
                    first = f.read(8)
                    n.append(WaveletMatrix.head(first + f.read(int.from_bytes(first[4:8], "little")))[0]["n"])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], names=["part", "shard", "path", "n"])

    return manifest.select("part", "shard", "path").mapInArrow(run, "part int, shard int, path string, n long")


def read_shards(manifest: DataFrame, folder: str, id_col: str = "doc_id", decode=None, fields: str = "ids array<int>", id_type: str = "bigint") -> DataFrame:
    """One row per document from the files: id, start, n_tokens and what ``decode(ids of a document)`` returns.

    The manifest only says which files there are, and their order; all else is read from them.  Only the token total
    of each part comes to the driver: as many numbers as the range shuffle had partitions.
    """
    sizes = _sizes(manifest, folder)
    found = sizes.groupBy("part").agg(F.sum("n").alias("n"), F.count("*").alias("files")).collect()
    totals, files = {r["part"]: r["n"] for r in found}, sum(r["files"] for r in found)
    offset, at = {}, 0
    for p in sorted(totals):
        offset[p], at = at, at + totals[p]
    before = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # what is few rows here is a file each to read
    placed = sizes.withColumn("before", before).select("part", "path", "before").repartition(max(1, files))
    whole, decode = decode is None, decode or (lambda ids: ids.tolist())

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        store, base = _file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{base}/{row['path']}") as f:
                    matrix = WaveletMatrix.from_bytes(f.read())
                ids, ends = matrix.all(), matrix.bounds()
                starts = np.concatenate([[0], ends[:-1]])
                found = [decode(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [names_of(matrix.names), pa.array(starts + offset[row["part"]] + row["before"]), pa.array(ends - starts), pa.array(found, pa.list_(pa.int32())) if whole else pa.array(found)],
                    names=[id_col, "start", "n_tokens", fields.split()[0]],
                )

    return placed.mapInArrow(run, f"{id_col} {id_type}, start long, n_tokens long, {fields}")


def export(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, **cols) -> tuple[DataFrame, str]:
    folder = folder or shared_dir(docs.sparkSession, "wavelet")
    return write_shards(docs, tokenizer, end_id, folder, **cols), folder
