"""MD5 and SHA-256 of whole files, through Spark's own readers and without a whole file in memory.

A digest runs through its file in order, so one task makes it.  Many tasks read a file's ranges and cut them into pieces
of a few kilobytes, which are sorted on disk where memory ends; the task that digests them holds a batch at a time.

Ranges come as lines, as no reader gives bytes by their place: what stands between two line breaks is one row.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a piece; an Arrow batch holds up to 10,000 of them.
PIECE = 2048
_PIECES = "path string, bytes long, begin long, at long, piece binary"


def _steps(piece: int):
    """The two Arrow functions; made here, they go to tasks by value and need no import there."""

    def runs(batch, keys: list[str]) -> Iterator[tuple]:
        """(values of the keys, rows) of the stretches of a batch in which the keys stay what they are."""
        import numpy as np

        if not batch.num_rows:
            return
        cuts = np.zeros(batch.num_rows - 1, dtype=bool)
        for k in keys:
            c = batch.column(k)
            codes = np.asarray(c.dictionary_encode().indices)
            cuts |= codes[1:] != codes[:-1]
        bounds = [0, *(np.flatnonzero(cuts) + 1).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            rows = batch.slice(a, b - a)
            yield {n: rows.column(n)[0].as_py() for n in rows.schema.names if n != "piece"}, rows.column("piece")

    def joined(values) -> memoryview:
        """The bytes of an Arrow array's values, one value behind the other."""
        import numpy as np
        import pyarrow as pa

        values = values.cast(pa.large_binary())
        at = np.frombuffer(values.buffers()[1], dtype=np.int64, count=len(values) + 1, offset=8 * values.offset)
        return memoryview(values.buffers()[2] or b"")[at[0] : at[-1]]

    class Running:
        """Digests of a file so far."""

        def __init__(self, row: dict):
            import hashlib

            self.row, self.seen = row, 0
            self.md5, self.sha256 = hashlib.md5(usedforsecurity=False), hashlib.sha256()

        def take(self, data: memoryview) -> None:
            # each line came with a break, which the file's last one need not have
            own = data[: max(0, self.row["bytes"] - self.seen)]
            self.md5.update(own)
            self.sha256.update(own)
            self.seen += len(data)

        def done(self) -> dict:
            if self.seen - self.row["bytes"] not in (0, 1):
                raise ValueError(f"{self.row['path']} has {self.row['bytes']} bytes, and {self.seen} were read")
            return {k: self.row[k] for k in ("path", "bytes")} | {"md5": self.md5.hexdigest(), "sha256": self.sha256.hexdigest()}

    def table(rows: list[dict], schema: list[tuple]):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kind) for n, kind in schema], names=[n for n, _ in schema])

    def cut(batches: Iterator) -> Iterator:
        """Ranges as pieces: where a piece's range begins in its file, and where the piece begins in the range."""
        import pyarrow as pa

        schema = [("path", pa.string()), ("bytes", pa.int64()), ("begin", pa.int64()), ("at", pa.int64()), ("piece", pa.binary())]
        now, at = None, 0
        for batch in batches:
            for row, values in runs(batch, ["path", "begin"]):
                if row != now:
                    now, at = row, 0
                data = joined(values)
                for k in range(0, len(data), 1024 * piece):
                    part = data[k : k + 1024 * piece]
                    yield table([row | {"at": at + j, "piece": part[j : j + piece].tobytes()} for j in range(0, len(part), piece)], schema)
                    at += len(part)

    def digest(batches: Iterator) -> Iterator:
        """(path, bytes, md5, sha256) of the files whose pieces come in order."""
        import pyarrow as pa

        schema = [("path", pa.string()), ("bytes", pa.int64()), ("md5", pa.string()), ("sha256", pa.string())]
        one = None
        for batch in batches:
            for row, values in runs(batch, ["path"]):
                if one and row["path"] != one.row["path"]:
                    yield table([one.done()], schema)
                    one = None
                one = one or Running(row)
                one.take(joined(values))
        if one:
            yield table([one.done()], schema)

    return cut, digest


def digests(spark: SparkSession, paths: list[str], piece: int = PIECE) -> DataFrame:
    """(path, name, bytes, md5, sha256) of the Parquet files at or below ``paths``; files without a byte give no row."""
    cut, digest = _steps(piece)
    read = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").text(paths)
    about = {"path": "file_path", "bytes": "file_size", "begin": "file_block_start"}
    ranges = read.select(*[F.col(f"_metadata.{c}").alias(n) for n, c in about.items()], F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("piece"))
    pieces = ranges.mapInArrow(cut, _PIECES).repartition("path").sortWithinPartitions("path", "begin", "at")
    files = pieces.mapInArrow(digest, "path string, bytes long, md5 string, sha256 string")
    # paths are URIs, in which a plus stands for itself
    name = F.url_decode(F.replace(F.element_at(F.split("path", "/"), -1), F.lit("+"), F.lit("%2B")))
    return files.select("path", name.alias("name"), "bytes", "md5", "sha256")
