"""Near-duplicate embeddings by Euclidean p-stable hashing and exact cosine checks.

Vectors are normalised; equal ones form one class.  In each of several tables a class falls into the bucket given by
``hashes`` random projections, shifted and cut into steps of ``width``.  Classes that share a bucket are compared by
their cosine in double precision.  Large buckets are cut into blocks, and every pair of blocks is compared on its own,
so no task holds a whole bucket and no pair of rows is ever emitted: what returns is how many vectors each class links
with and a spanning forest of the links.  Pairs of blocks travel many to a group of bounded size.  A pair is counted in
the first table it shares only.

The number of projections grows with the logarithm of the number of vectors, so that buckets stay small, and the
number of tables follows from it so that a pair at the threshold is found with probability ``recall``; closer pairs
are found more often.  No link below the threshold is ever made.

Defined results: vectors that are null, zero, or hold null or non-finite components link with nothing; equal vectors
link with one another; vectors of different lengths never link, whatever rows they stand beside; repeated rows are
vectors of their own; labels and other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annotspark.llm.common import written
from annotspark.llm.components import components, salted_join

THRESHOLD = 0.95
WIDTH = 2.0
RECALL = 0.97
#: Members of a block of a small bucket; blocks grow slowly with the bucket.
BLOCK = 128
#: Rows of a group of pairs of blocks, on average.
GROUP = 4096


def collision(distance: float, width: float = WIDTH) -> float:
    """Probability that one hash agrees for two vectors at a distance."""
    r = width / distance
    return 1 - 2 * (0.5 * math.erfc(r / math.sqrt(2))) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(hashes per table, tables) for n vectors: about four unrelated vectors to a bucket."""
    near, far = collision(math.sqrt(2 - 2 * threshold)), collision(math.sqrt(2))
    hashes = max(8, math.ceil(math.log(max(n, 8) / 4) / -math.log(far)))
    tables = math.ceil(math.log(1 - recall) / math.log(1 - near**hashes))
    return hashes, tables


def _units(column) -> list[bytes | None]:
    """Each vector normalised, as bytes of doubles, or None where it links with nothing."""
    lists = column.to_pylist()
    sizes = np.array([0 if x is None or None in x else len(x) for x in lists], dtype=np.int64)
    out: list[bytes | None] = [None] * len(lists)
    for size in np.unique(sizes[sizes > 0]).tolist():
        which = np.flatnonzero(sizes == size)
        data = np.array([lists[k] for k in which], dtype=np.float64)
        most = np.abs(data).max(axis=1)
        fine = np.isfinite(most) & (most > 0)
        data = data[fine] / most[fine, None]  # squares of very large or small components stay finite
        unit = data / np.linalg.norm(data, axis=1)[:, None] + 0.0
        for k, u in zip(which[fine].tolist(), unit):
            out[k] = u.tobytes()
    return out


def unit_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, unit): the normalised vector as bytes of doubles, null where a vector links with nothing."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_units(batch.column(1)), pa.binary())], names=["id", "unit"])

    kind = vectors.schema[id_col].dataType.simpleString()
    return vectors.select(F.col(id_col), F.col(vec_col)).mapInArrow(run, f"id {kind}, unit binary")


def bucket_keys(classes: DataFrame, hashes: int, tables: int, width: float = WIDTH, seed: int = 7) -> DataFrame:
    """Adds ``keys``: the class's bucket in every table."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        mixer = np.random.default_rng(seed).integers(1, 2**63 - 1, size=(tables, hashes), dtype=np.int64) | 1
        for batch in batches:
            units = batch.column(batch.schema.get_field_index("unit")).to_pylist()
            sizes = np.array([len(u) for u in units])
            keys = np.zeros((len(units), tables), dtype=np.int64)
            for size in np.unique(sizes):
                rng = np.random.default_rng(seed + 1)
                dim = int(size) // 8
                lines, shift = rng.standard_normal((dim, tables * hashes)), rng.uniform(0, width, tables * hashes)
                which = np.flatnonzero(sizes == size)
                data = np.frombuffer(b"".join([units[k] for k in which]), dtype=np.float64).reshape(-1, dim)
                cells = np.floor((data @ lines + shift) / width).astype(np.int64).reshape(-1, tables, hashes)
                with np.errstate(over="ignore"):
                    mixed = (cells * mixer).sum(axis=2)
                    mixed ^= mixed >> 31
                    keys[which] = mixed * np.int64(0x2545F4914F6CDD1D) + dim
            lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), tables).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "keys"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema.fields)
    return classes.mapInArrow(run, f"{fields}, keys array<long>")


def _compare(threshold: float):
    """For the pairs of blocks in a group: the weight linked to each class, and a forest of the links."""

    def run(table):
        import pyarrow as pa

        names = table.column("cls").to_pylist()
        weight = table.column("weight").to_numpy()
        keys = np.array(table.column("keys").to_pylist(), dtype=np.int64)
        units = table.column("unit").to_pylist()
        tab, key, lo, hi, block = (table.column(c).to_numpy() for c in ("tab", "key", "lo", "hi", "block"))
        linked = np.zeros(len(names), dtype=np.int64)
        root = np.arange(len(names))

        def top(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        order = np.lexsort((hi, lo, key, tab))
        new = np.logical_or.reduce([x[order][1:] != x[order][:-1] for x in (tab, key, lo, hi)])
        for rows in np.split(order, np.flatnonzero(new) + 1):
            if len(rows) < 2:
                continue
            t, inner = int(tab[rows[0]]), lo[rows[0]] == hi[rows[0]]
            unit = np.frombuffer(b"".join([units[k] for k in rows]), dtype=np.float64).reshape(len(rows), -1)
            left = np.flatnonzero(block[rows] == lo[rows[0]])
            right = left if inner else np.flatnonzero(block[rows] == hi[rows[0]])
            for at in range(0, len(left), 512):
                a = left[at : at + 512]
                hit = unit[a] @ unit[right].T >= threshold
                if not hit.any():
                    continue
                for s in range(t):
                    hit &= keys[rows[a], s][:, None] != keys[rows[right], s][None, :]
                if inner:
                    hit &= right[None, :] > a[:, None]
                linked[rows[a]] += hit @ weight[rows[right]]
                linked[rows[right]] += hit.T @ weight[rows[a]]
                for x, y in zip(*np.nonzero(hit)) if hit.sum() < 4 * len(rows) else _forest(hit):
                    p, q = top(rows[a[x]]), top(rows[right[y]])
                    if p != q:
                        root[max(p, q)] = min(p, q)
        some = np.flatnonzero(linked)
        text = lambda x: pa.array(x, pa.string())
        return pa.table({"cls": text([names[k] for k in some]), "linked": linked[some], "root": text([names[top(k)] for k in some])})

    return run


def _forest(hit):
    """Enough of the links for the same components: each row's first link, and each column's link to its first row,
    with all links of rows that join two columns of different first rows."""
    rows, cols = np.nonzero(hit)
    first = np.full(hit.shape[1], -1, dtype=np.int64)
    seen, cs = np.unique(cols, return_index=True)
    first[seen] = rows[cs]
    key = rows * hit.shape[0] + first[cols]
    _, keep = np.unique(key, return_index=True)
    keep = np.union1d(keep, cs)
    return zip(rows[keep], cols[keep])


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Per vector: id, ``n_links``, ``component_id`` (least id reachable) and ``kept`` (is that least id)."""
    rows = written(unit_vectors(vectors, id_col, vec_col).withColumn("cls", F.md5("unit")), "units")
    classes = rows.where("cls IS NOT NULL").groupBy("cls").agg(F.first("unit").alias("unit"), F.count("*").alias("weight"), F.min("id").alias("least"))
    hashes, tables = plan(rows.count(), threshold, recall)
    keyed = written(bucket_keys(classes, hashes, tables), "classes")

    slots = keyed.select("cls", F.posexplode("keys").alias("tab", "key"))
    shared = slots.groupBy("tab", "key").agg(F.count("*").alias("m")).where("m > 1")
    members = slots.join(shared, ["tab", "key"]).withColumn("blocks", F.least(F.ceil(F.col("m") / BLOCK), 8 + F.floor(F.col("m") / (32 * BLOCK))).cast("int"))
    members = members.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    pairs = members.select(
        "cls", "tab", "key", "block",
        F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("lo"), F.greatest("block", o).alias("hi")))).alias("p"),
    ).select("cls", "tab", "key", "block", "p.lo", "p.hi")
    groups = -(-pairs.count() // GROUP) + 1
    pairs = pairs.withColumn("g", F.pmod(F.xxhash64("tab", "key", "lo", "hi"), F.lit(groups)))
    full = pairs.join(keyed.select("cls", "unit", "weight", "keys"), "cls")
    found = written(full.groupBy("g").applyInArrow(_compare(threshold), "cls string, linked long, root string"), "links")

    groups = components(found, "cls", "root")
    counts = found.groupBy("cls").agg(F.sum("linked").alias("linked"))
    classed = keyed.select("cls", "least", "weight").join(groups.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    least = classed.groupBy("label").agg(F.min("least").alias("component_id"))
    per_class = salted_join(classed, least, "label", "cls").join(counts, "cls", "left").select("cls", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = rows.join(per_class, "cls", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )
