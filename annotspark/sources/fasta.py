"""FASTA files in byte ranges: a whole chromosome is read by many tasks, and comes out as tiles of a fixed number of bases.

A data source plans ranges of about ``split`` bytes and says of each which record it ends in and how many bases stand
where; a window over a file's ranges (a few rows) tells every range the record and the base it begins with.  Then each
range gives the tiles whose first base it holds, reading on behind its end for the last one.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range, bases of a tile, and bytes that are looked back or read on at a time.
SPLIT, TILE, STEP = 1 << 24, 8192, 1 << 16
_INDEX = "file string, begin long, size long, heads int, first_bases long, last_record long, last_head string, last_bases long"


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _open(path: str):
    """A file that can be read anywhere; compressed ones are inflated first, which one task does for one file."""
    store, base = _store(path)
    if base.endswith(".gz"):
        with store.open_input_stream(base, compression="gzip") as f:
            return io.BytesIO(f.read())
    return store.open_input_file(base)


class _Range:
    """Bytes [begin, end) of a file, with the headers that begin there and which bytes are bases."""

    def __init__(self, f, begin: int, end: int):
        import numpy as np

        self.f, self.begin = f, begin
        f.seek(begin)
        self.data = np.frombuffer(f.read(end - begin), dtype=np.uint8)
        self.end = begin + len(self.data)
        at_line, in_head = self._line()
        breaks = np.flatnonzero(self.data == 10)
        starts = breaks + 1
        starts = starts[starts < len(self.data)]
        if at_line and len(self.data):
            starts = np.concatenate([[0], starts])
        self.heads = starts[self.data[starts] == 62]
        space = np.zeros(256, dtype=bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        self.base = ~space[self.data]
        ends = np.append(breaks, len(self.data))
        self.ends = ends[np.searchsorted(breaks, self.heads)]
        if in_head:
            self.base[: ends[0]] = False
        for a, b in zip(self.heads.tolist(), self.ends.tolist()):
            self.base[a:b] = False

    def _line(self) -> tuple[bool, bool]:
        """Whether the range begins with a line, and whether inside of a header."""
        at = self.begin
        if at == 0:
            return True, False
        self.f.seek(at - 1)
        if self.f.read(1) == b"\n":
            return True, False
        while at > 0:
            low = max(0, at - STEP)
            self.f.seek(low)
            piece = self.f.read(at - low)
            k = piece.rfind(b"\n")
            if k >= 0 and k + 1 < len(piece):
                return False, piece[k + 1 : k + 2] == b">"
            if k >= 0:
                break
            at = low
            if not at:
                return False, piece[:1] == b">"
        self.f.seek(at)
        return False, self.f.read(1) == b">"

    def head(self, k: int) -> str:
        text = self.data[self.heads[k] + 1 : self.ends[k]].tobytes()
        if self.ends[k] == len(self.data):  # the line goes on
            self.f.seek(self.end)
            while piece := self.f.read(STEP):
                cut = piece.find(b"\n")
                text += piece if cut < 0 else piece[:cut]
                if cut >= 0:
                    break
        return text.decode("utf-8", "replace").rstrip("\r")

    def following(self, need: int) -> bytes:
        """Up to ``need`` bases behind the range, as far as its last record goes on."""
        out, at, line = b"", self.end, bool(len(self.data)) and self.data[-1] == 10
        if len(self.heads) and self.ends[-1] == len(self.data):  # it ends inside a header
            self.f.seek(at)
            while (piece := self.f.read(STEP)) and b"\n" not in piece:
                at += len(piece)
            at, line = at + piece.find(b"\n") + 1 if piece else at, True
        self.f.seek(at)
        while len(out) < need and (piece := self.f.read(STEP)):
            cut = 0 if line and piece[:1] == b">" else piece.find(b"\n>")
            out += b"".join((piece if cut < 0 else piece[:cut]).split())
            if cut >= 0:
                break
            line = piece[-1:] == b"\n"
        return out[:need]


class FastaRanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fasta_ranges"

    def schema(self) -> str:
        return _INDEX

    def reader(self, schema) -> DataSourceReader:
        return _IndexReader(self.options["path"], int(self.options.get("split", SPLIT)))


class _Part(InputPartition):
    def __init__(self, path: str, begin: int, size: int):
        self.path, self.begin, self.size = path, begin, size


class _IndexReader(DataSourceReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def partitions(self) -> list[_Part]:
        from pyarrow import fs

        store, base = _store(self.path)
        scheme = self.path[: self.path.index(base)] if base in self.path else ""
        found = store.get_file_info(base)
        files = [found] if found.type == fs.FileType.File else store.get_file_info(fs.FileSelector(base, recursive=True))
        parts = []
        for f in files:
            if f.type != fs.FileType.File or f.base_name.startswith((".", "_")):
                continue
            step = f.size if f.path.endswith(".gz") else self.split
            parts += [_Part(scheme + f.path, k, step) for k in range(0, f.size, step)]
        return parts

    def read(self, part: _Part) -> Iterator[tuple]:
        with _open(part.path) as f:
            r = _Range(f, part.begin, part.begin + part.size if not part.path.endswith(".gz") else 1 << 60)
            total = int(r.base.sum())
            if len(r.heads):
                first, k = int(r.base[: r.heads[0]].sum()), len(r.heads) - 1
                last = int(r.base[r.heads[k] :].sum())
                yield part.path, part.begin, part.size, k + 1, first, part.begin + int(r.heads[k]), r.head(k), last
            else:
                yield part.path, part.begin, part.size, 0, total, None, None, total


def fasta_tiles(spark: SparkSession, path: str, upper: bool = True, last_wins: bool = False, split: int = SPLIT, tile: int = TILE) -> DataFrame:
    """(file, record, seqid, description, tile, part): the sequences below ``path`` in tiles of ``tile`` bases, from 0.

    ``record`` is the byte at which a record begins.  Text before a file's first header and records without bases give no
    rows.  With ``last_wins`` only the last record of an id in a file stays.
    """
    from annotspark.tables import written

    spark.dataSource.register(FastaRanges)
    index = written(spark.read.format("fasta_ranges").option("path", path).option("split", str(split)).load(), "fasta")
    along = Window.partitionBy("file").orderBy("begin")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    # the record that goes on into a range, and its bases so far: those behind the last header and in ranges without one
    group = F.count("last_record").over(along)
    rows = index.withColumn("_g", group)
    so_far = F.sum("last_bases").over(Window.partitionBy("file", "_g").orderBy("begin"))
    rows = rows.withColumn("_sum", so_far).select(
        "file", "begin", "size", F.last("last_record", True).over(before).alias("record"), F.last("last_head", True).over(before).alias("head"), F.coalesce(F.lag("_sum").over(along), F.lit(0)).alias("bases")
    )

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["file", "record", "seqid", "description", "tile", "part"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string()]
        for batch in batches:
            for row in batch.to_pylist():
                with _open(row["file"]) as f:
                    whole = row["file"].endswith(".gz")
                    r = _Range(f, row["begin"], row["begin"] + row["size"] if not whole else 1 << 60)
                    bounds = [0, *r.heads.tolist(), len(r.data)]
                    out = []
                    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                        record, head, at = (row["record"], row["head"], row["bases"]) if k == 0 else (row["begin"] + a, r.head(k - 1), 0)
                        if record is None:
                            continue
                        seq = r.data[a:b][r.base[a:b]].tobytes()
                        first, last = -(-at // tile), (at + len(seq) - 1) // tile
                        if b == len(r.data) and last >= first and (last + 1) * tile > at + len(seq):
                            seq += r.following((last + 1) * tile - at - len(seq))
                        for t in range(first, last + 1):
                            part = seq[t * tile - at : (t + 1) * tile - at]
                            text = (part.upper() if upper else part).decode("ascii", "replace")
                            out.append((row["file"], record, (head.split() or [""])[0], head, t, text))
                        if len(out) * tile > 1 << 24:
                            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names=names)
                            out = []
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names=names)

    ranges = rows.repartition(max(1, index.count()))
    found = ranges.mapInArrow(cut, "file string, record long, seqid string, description string, tile int, part string")
    if not last_wins:
        return found
    # one row a record, from its first tile
    newest = written(found, "tiles")
    keep = newest.where("tile = 0").groupBy("file", "seqid").agg(F.max("record").alias("record"))
    return newest.join(keep, ["file", "seqid", "record"], "left_semi")
