"""Exact removal of repeated byte strings: suffix order, Burrows-Wheeler transform, interval expansion to a bound.

Every byte covered by a ``length``-byte string that also starts in a document with a smaller id is removed.

1. *Anchors.*  A window of ``length`` bytes holds short strings of ``gram`` bytes.  It is filed under the first of those
   with the least hash, taken together with the ``(length - gram) // 2`` bytes before it, or behind it where the window
   ends too soon for those before it.  This key depends on the window's bytes alone, so equal windows share it wherever
   they stand; and it covers most of a window, so that few others do.  Neighbouring windows of one key are a fragment.
   Keys seen in documents of one id only are dropped; a filter of bounded size tells which are left.
2. *Blocks.*  A key whose fragments are all equal has its least document already.  Of every other key a copy of each
   fragment is gathered, with the least document that holds it, in blocks of about ``BLOCK`` bytes.  Keys with more
   than that are dealt to several.
3. *Expansion.*  In a block the fragments are put in suffix order, their Burrows-Wheeler transform is taken, and
   intervals are extended backwards, breadth first, from the empty string: each level gives the places where neighbours
   share exactly that many bytes, by increasing value, and the search stops at ``length``.  What is still undivided then
   shares ``length`` bytes, and has a least document.  For keys over several blocks those minima are combined by the
   string's hash, one row for each block and string.
4. Windows whose least document is smaller than their own are removed from the text.

All shuffles carry hashes or distinct fragments, combined before they are sent; a passage in a third of all documents
is one fragment.  A long text is worked on in pieces and a long fragment is cut, so that neither has to fit in a block.
Keys are told apart by 64-bit hashes, the fragments of a key by another one; which windows of a block are equal is told by the transform.

Defined results: null text is the empty text; a null id is greater than all others, and rows with equal (or null) ids
remove nothing from one another; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annotspark.llm.common import discard, let, text_or_empty, written
from annotspark.llm.filters import filter_bits, hits, passing

LENGTH = 50
#: Bytes of the short strings that anchor a window.
GRAM = 8
#: Bytes of fragments in a block.
BLOCK = 1 << 18
#: Windows of a fragment at most, and bytes of text worked on at a time.
WINDOWS = 1 << 12
SLICE = 1 << 18
#: Fragments of a task that are held before they are passed on.
HELD = 1 << 20
#: Turns in which shared keys are looked for, each among its part of the keys.
TURNS = 2
_LAST = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15
#: Low bits of a hash that give way to the place inside a slice, so that the least value is also the first.
_PLACE = (1 << 20) - 1


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, and a hash for every byte."""

    def powers(x: int) -> np.ndarray:
        out = np.full(n, x, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return powers(_BASE), powers(pow(_BASE, -1, 1 << 64)), _mix(np.arange(1, 257, dtype=np.uint64))


def fragments(data: np.ndarray, owner: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(owner, start, windows, key, fragment hash) of the fragments in a slice of joined pieces of text.

    ``owner`` numbers the piece of every byte; no window reaches from one piece into another.
    """
    n, m, span = len(data), len(data) - length + 1, length - gram + 1
    if m < 1:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    if n > _PLACE:
        raise ValueError("a slice has to be shorter")
    up, down, letter = _powers(_PLACE + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(letter[data] * up[:n], out=sums[1:])
    text_hash = lambda a, size: (sums[a + size] - sums[a]) * down[a]
    low = (sums[gram:] - sums[:-gram]) * down[: n - gram + 1]
    low = (low ^ (low >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    # fragments are told apart by their short strings: sums of single letters' hashes agree for some long words
    grams = np.zeros(len(low) + 1, dtype=np.uint64)
    np.cumsum((low ^ (low >> np.uint64(32))) * up[: len(low)], out=grams[1:])
    low = (low & ~np.uint64(_PLACE)) | np.arange(len(low), dtype=np.uint64)
    k = 1
    while 2 * k <= span:
        low = np.minimum(low[: len(low) - k], low[k:])
        k *= 2
    place = (np.minimum(low[:m], low[span - k : span - k + m]) & np.uint64(_PLACE)).astype(np.int32)
    more = (length - gram) // 2
    before = place - np.arange(m, dtype=np.int32) >= more
    inside = owner[:m] == owner[length - 1 :]
    cut = np.ones(m, dtype=bool)
    cut[1:] = (place[1:] != place[:-1]) | (before[1:] != before[:-1]) | (inside[1:] != inside[:-1]) | (owner[1:m] != owner[: m - 1])
    start = np.flatnonzero(cut)
    end = np.append(start[1:], m)
    good = inside[start]
    start, end = start[good], end[good]
    side = before[start]
    key = _mix(text_hash(place[start].astype(np.int64) - side * more, gram + more) + side.astype(np.uint64))
    if len(start):  # in periodic text neighbours have one key, and are one fragment up to a bounded length
        new = np.ones(len(start), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (start[1:] != end[:-1]) | (owner[start[1:]] != owner[start[:-1]])
        run = np.flatnonzero(new)
        part = (start - np.repeat(start[run], np.diff(np.append(run, len(start))))) // WINDOWS
        new[1:] |= part[1:] != part[:-1]
        at = np.flatnonzero(new)
        start, end, key = start[at], end[np.append(at[1:], len(start)) - 1], key[at]
    made = _mix((grams[end + length - gram] - grams[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(_BASE) + key)
    return owner[start].astype(np.int64), start, end - start, key, made


def _slices(batches: Iterator, length: int, gram: int) -> Iterator:
    """Fragments of rows (doc, row, text): arrays of key, fragment, doc, row, start and windows, and their bodies' places.

    Each turn also gives the bytes that those places are counted in.
    """
    import pyarrow as pa

    for batch in batches:
        doc, row = (batch.column(k).to_numpy() for k in (0, 1))
        text = batch.column(2).cast(pa.large_binary())
        ends = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
        bytes_ = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)
        windows = np.diff(ends) - length + 1
        step = SLICE // 2
        count = np.maximum(-(-windows // step), 0)
        of = np.repeat(np.arange(len(text)), count)
        begin = (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)) * step
        size = np.minimum(windows[of] - begin, step) + length - 1
        at, held, parts = 0, 0, []
        total = np.cumsum(size)
        while at < len(of):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + SLICE, side="right")))
            first = ends[of[at:to]] + begin[at:to]
            data = np.concatenate([bytes_[a : a + n] for a, n in zip(first.tolist(), size[at:to].tolist())])
            owner, start, wide, key, made = fragments(data, np.repeat(np.arange(to - at, dtype=np.int32), size[at:to]), length, gram)
            start = start - (total[at:to] - size[at:to] - (total[at - 1] if at else 0))[owner]
            k = of[at:to][owner]
            parts.append((key, made, doc[k], row[k], start + begin[at:to][owner], wide, first[owner] + start))
            held += len(key)
            at = to
            if held >= HELD or at == len(of):
                yield tuple(np.concatenate(x) for x in zip(*parts)), bytes_
                held, parts = 0, []


def _least(key: np.ndarray, doc: np.ndarray):
    """Distinct keys, where each first stands, and the least and greatest document of each."""
    order = np.argsort(key, kind="stable")
    key, doc = key[order], doc[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    if not len(at):
        return key, order, doc, doc
    return key[at], order[at], np.minimum.reduceat(doc, at), np.maximum.reduceat(doc, at)


def shared_keys(rows: DataFrame, length: int, gram: int, turn: int) -> DataFrame:
    """(key, low, mixed): keys that stand in documents of different ids, the least of those, and whether their fragments differ.

    Of one turn's keys: this shuffle is the largest, and the texts are cheaper to hash again than all of it is to keep.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for (key, made, doc, *_), _ in _slices(batches, length, gram):
            mine = np.flatnonzero((key >> np.uint64(40)) % np.uint64(TURNS) == np.uint64(turn))
            key, made, doc = key[mine], made[mine], doc[mine]
            order = np.argsort(key, kind="stable")
            key, made, doc = key[order], made[order].view(np.int64), doc[order]
            at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
            ends = [f.reduceat(x, at) if len(at) else x for x in (doc, made) for f in (np.minimum, np.maximum)]
            yield pa.RecordBatch.from_arrays([pa.array(key[at].view(np.int64)), *map(pa.array, ends)], names=["key", "low", "high", "f1", "f2"])

    found = rows.mapInArrow(run, "key long, low long, high long, f1 long, f2 long")
    found = found.groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("f1").alias("f1"), F.max("f2").alias("f2"))
    return found.where("low < high").select("key", "low", (F.col("f1") != F.col("f2")).alias("mixed"))


def occurrences(rows: DataFrame, bits: np.ndarray, mixed: np.ndarray, length: int, gram: int) -> DataFrame:
    """Fragments whose key passes the filter: key, fragment, doc, row, start, windows.

    Those of keys that pass the filter ``mixed`` have, at one of a task's places, also their body, and the least and
    greatest document of those places; of all other keys the fragments are equal and stay 0.
    """
    spread = rows.sparkSession.sparkContext.broadcast((bits, mixed))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bits, mixed = spread.value
        for found, text in _slices(batches, length, gram):
            hit = hits(bits, found[0])
            key, made, doc, row, start, windows, place = (x[hit] for x in found)
            some = hits(mixed, key)
            _, at, low, high = _least(made[some], doc[some])
            at = some[at]
            body: list = [None] * len(key)
            for k, a, n in zip(at.tolist(), place[at].tolist(), windows[at].tolist()):
                body[k] = text[a : a + n + length - 1].tobytes()
            ends = np.zeros((2, len(key)), dtype=np.int64)
            ends[:, at] = low, high
            other = np.ones(len(key), dtype=bool)
            other[at] = False
            told = np.zeros(len(key), dtype=np.int64)
            told[some] = made[some].view(np.int64)
            columns = [key.view(np.int64), told, doc, row, start.astype(np.int32), windows.astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns), pa.array(body, pa.binary()), *(pa.array(x, mask=other) for x in ends)],
                names=["key", "fragment", "doc", "row", "start", "windows", "body", "low", "high"],
            )

    return rows.mapInArrow(run, "key long, fragment long, doc long, row long, start int, windows int, body binary, low long, high long")


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols (0 to 256), by doubling from seven symbols that fit a word."""
    n, width = len(text), 7
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(width, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for k in range(width):
        key = (key << 9) | padded[k : n + k]
    while True:
        order = np.argsort(key)
        new = np.zeros(n, dtype=np.int64)
        np.cumsum(key[order][1:] != key[order][:-1], out=new[1:])
        if width >= depth or new[-1] == n - 1:
            return order
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        ahead = np.zeros(n, dtype=np.int64)
        ahead[: max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 1) + ahead
        width *= 2


def prefix_bounds(text: np.ndarray, order: np.ndarray, bound: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in order, or ``bound`` where it is that or more.

    Intervals of strings are extended backwards over the Burrows-Wheeler transform, breadth first: the strings of one
    length are met together, and an end that was not met before divides there neighbours that share one byte less.
    An interval is extended by each letter in it at that letter's last place; where the letter's first place leads is
    looked up among its places.
    """
    n = len(text)
    bwt = text[order - 1].astype(np.int64)
    places = np.argsort(bwt, kind="stable")
    back = np.empty(n, dtype=np.int64)
    back[places] = np.arange(n)
    listed = bwt[places] * (n + 1) + places
    again = np.full(n, n, dtype=np.int64)
    same = bwt[places][1:] == bwt[places][:-1]
    again[places[:-1][same]] = places[1:][same]
    shared = np.full(n + 1, bound, dtype=np.int16)
    met = np.zeros(n + 1, dtype=bool)
    low, high = np.array([0]), np.array([n])
    for size in range(bound):
        wide = high - low
        at = np.repeat(low - (np.cumsum(wide) - wide), wide) + np.arange(int(wide.sum()))
        last = np.flatnonzero(again[at] >= np.repeat(high, wide))
        last = last[~met[back[at[last]] + 1]]
        if not len(last):
            break
        begin = np.repeat(low, wide)[last]
        at = at[last]
        high = back[at] + 1
        low = np.searchsorted(listed, bwt[at] * (n + 1) + begin)
        met[high] = True
        shared[high] = size
    shared[0] = 0
    return shared[:n]


def block_minima(bodies: list[bytes], docs: np.ndarray, length: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each fragment: the least document of every window over the whole block, and the window's class."""
    sizes = np.array([len(b) for b in bodies], dtype=np.int64)
    first = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int(sizes.sum()) + len(bodies), dtype=np.int16)
    owner = np.repeat(np.arange(len(bodies)), sizes + 1)
    place = np.arange(len(text)) - first[owner]
    text[place < sizes[owner]] = np.frombuffer(b"".join(bodies), dtype=np.uint8).astype(np.int16) + 1
    order = suffix_order(text, length + 1)
    new = prefix_bounds(text, order, length) < length
    doc = np.where(place <= sizes[owner] - length, docs[owner], _LAST)
    least = np.minimum.reduceat(doc[order], np.flatnonzero(new))
    of = np.empty(len(text), dtype=np.int64)
    of[order] = np.cumsum(new) - 1
    spans = [(int(f), int(f + s - length + 1)) for f, s in zip(first, sizes)]
    return [least[of[a:b]] for a, b in spans], [of[a:b] for a, b in spans]


def _block(table, whole: bool) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """The distinct fragments of a block: keys, hashes, bodies, least and greatest document.

    Where the block has ``whole`` keys, those that stand in one document are left out.
    """
    import pyarrow as pa

    key, made, low, high = (table.column(c).to_numpy() for c in ("key", "fragment", "low", "high"))
    some = np.arange(len(key))
    if whole:
        _, _, key_low, _ = _least(key, low)
        keys, _, _, key_high = _least(key, high)
        of = np.searchsorted(keys, key)
        some = np.flatnonzero(key_low[of] < key_high[of])
        key, made, low, high = key[some], made[some], low[some], high[some]
    names, at, least, _ = _least(made, low)
    greatest = _least(made, high)[3]
    return key[at], names, table.column("body").take(pa.array(some[at])).to_pylist(), least, greatest


def _minima(length: int):
    """Of blocks with all fragments of their keys: (key, fragment, low, least) where a document beyond the least one holds a window."""

    def run(table):
        import pyarrow as pa

        keys, names, bodies, low, high = _block(table, True)
        least = block_minima(bodies, low, length)[0] if len(names) else []
        return _told(keys, names, high, least)

    return run


def _told(keys, names, high, least):
    import pyarrow as pa

    low = np.array([x.min() for x in least], dtype=np.int64)
    some = np.flatnonzero(low < high[: len(low)])
    lists = [None if least[k].max() == low[k] else least[k] for k in some.tolist()]
    return pa.table({"key": pa.array(keys[some], pa.int64()), "fragment": pa.array(names[some], pa.int64()), "low": pa.array(low[some], pa.int64()), "least": pa.array(lists, pa.list_(pa.int64()))})


def _parts(length: int):
    """Of one of several blocks of a key: every distinct window's hash and least document, and the fragments' windows."""

    def run(table):
        import pyarrow as pa
        import xxhash

        _, names, bodies, low, high = _block(table, False)
        least, groups = block_minima(bodies, low, length) if len(names) else ([], [])
        digest: dict[int, int] = {}
        minimum: dict[int, int] = {}
        rows = []
        for body, group, low_of in zip(bodies, groups, least):
            for k, (g, x) in enumerate(zip(group.tolist(), low_of.tolist())):
                if g not in digest:
                    digest[g] = int(np.uint64(xxhash.xxh3_64_intdigest(body[k : k + length])).view(np.int64))
                    minimum[digest[g]] = x
            rows.append([digest[g] for g in group.tolist()])
        n, m = len(names), len(minimum)
        key, sub = table.column("key")[0].as_py(), table.column("sub")[0].as_py()
        return pa.table({
            "key": pa.array([key] * (n + m), pa.int64()), "sub": pa.array([sub] * (n + m), pa.int32()),
            "fragment": pa.array([*names.tolist(), *[None] * m], pa.int64()), "high": pa.array([*high.tolist(), *[None] * m], pa.int64()), "windows": pa.array(rows + [None] * m, pa.list_(pa.int64())),
            "window": pa.array([None] * n + list(minimum), pa.int64()), "low": pa.array([None] * n + list(minimum.values()), pa.int64()),
        })

    return run


def _resolved(key, parts, lows):
    """Fragments of a block with their windows' least documents over all blocks."""
    windows, order = lows.column("window").to_numpy(), np.argsort(lows.column("window").to_numpy())
    low = lows.column("low").to_numpy()[order]
    rows = parts.column("windows").to_pylist()
    least = [low[np.searchsorted(windows, np.array(r, dtype=np.int64), sorter=order)] for r in rows]
    return _told(parts.column("key").to_numpy(), parts.column("fragment").to_numpy(), parts.column("high").to_numpy(), least)


def window_minima(found: DataFrame, length: int) -> DataFrame:
    """(key, fragment, low, least): the least document of each window, or of all where they have one (``least`` is null)."""
    told = "key long, fragment long, low long, least array<long>"
    copies = found.where("body IS NOT NULL").select("key", "fragment", "low", "high", "body")
    total = copies.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    large = copies.groupBy("key").agg(F.sum(F.octet_length("body")).alias("bytes")).where(F.col("bytes") > BLOCK)
    large = written(large.select("key", F.ceil(F.col("bytes") / BLOCK).cast("int").alias("split")), "large")
    dealt = copies.join(large, "key", "left")
    blocks = -(-2 * total // BLOCK) + 1
    few = dealt.where("split IS NULL").withColumn("g", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    whole = few.groupBy("g").applyInArrow(_minima(length), told)

    many = dealt.where("split IS NOT NULL").withColumn("sub", F.pmod(F.xxhash64("fragment"), F.col("split")).cast("int"))
    parts = written(many.groupBy("key", "sub").applyInArrow(_parts(length), "key long, sub int, fragment long, high long, windows array<long>, window long, low long"), "parts")
    seen = parts.where("window IS NOT NULL").select("key", "sub", "window", "low")
    lows = seen.select(F.col("key").alias("of"), F.col("sub").alias("part"), "window").join(seen.groupBy("window").agg(F.min("low").alias("low")), "window")
    mine = parts.where("fragment IS NOT NULL").select("key", "sub", "fragment", "high", "windows")
    joined = mine.groupBy("key", "sub").cogroup(lows.groupBy("of", "part")).applyInArrow(_resolved, told)
    out = written(whole.unionByName(joined), "minima")
    discard(large, parts)
    return out


def removed_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, row, spans): stretches [a, b) to remove, unsorted, for rows (_doc, _row, _text)."""
    if gram >= length:
        raise ValueError("a window has to hold several short strings")
    shared = reduce(DataFrame.unionByName, [written(shared_keys(rows, length, gram, k), "shared") for k in range(TURNS)])
    alike = shared.where("NOT mixed").select("key", "low")
    found = written(occurrences(rows, filter_bits(shared.select("key")), filter_bits(shared.where("mixed").select("key")), length, gram), "occurrences")
    minima = window_minima(found, length)
    whole = passing(found.select("key", "doc", "row", "start", "windows"), "key", filter_bits(alike.select("key"))).join(alike, "key").where("low < doc")
    whole = whole.select("doc", "row", F.col("start").alias("a"), (F.col("start") + F.col("windows") + length - 1).alias("b"))

    def edges(flags):  # where runs of removed windows begin and end, in turn
        at = lambda k: F.coalesce(F.get(flags, k), F.lit(False))
        return F.filter(F.sequence(F.lit(0), F.size(flags)), lambda k: at(k) != at(k - 1))

    every = F.array(F.lit(0), F.col("windows"))
    cuts = F.when(F.col("least").isNull(), every).otherwise(let(F.transform("least", lambda x: x < F.col("doc")), edges))
    spans = let(
        cuts,
        lambda e: F.transform(
            F.filter(e, lambda x, k: k % 2 == 0),
            lambda x, k: F.struct((F.col("start") + x).alias("a"), (F.col("start") + F.get(e, 2 * k + 1) + length - 1).alias("b")),
        ),
    )
    places = found.where("fragment <> 0").select("key", "fragment", "doc", "row", "start", "windows")
    parts = passing(places, "fragment", filter_bits(minima.select("fragment"))).join(minima, ["key", "fragment"]).where("low < doc")
    parts = parts.select("doc", "row", F.explode(spans).alias("s")).select("doc", "row", "s.*")
    out = written(whole.unionByName(parts).groupBy("doc", "row").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "spans")
    discard(shared, found, minima)
    return out


def _cut(text: bytes, spans) -> tuple[bytes, int]:
    """The text without the spans, and how many separate stretches were removed."""
    kept, at, runs = [], 0, 0
    end = -1
    for a, b in sorted(spans):
        if a > end:
            runs += 1
            if end >= 0:
                kept.append(text[at:a])
            else:
                kept.append(text[:a])
            end = b
        elif b > end:
            end = b
        at = end
    return (b"".join(kept) + text[at:], runs) if runs else (text, 0)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, as_text: bool = False) -> DataFrame:
    """All columns of ``docs`` but the text as ``doc`` (a struct), and ``kept`` (what is left), n_bytes, n_removed, n_spans.

    ``kept`` is bytes, or a string without characters cut in two with ``as_text``.
    """
    cols = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols if c != text_col]).alias("doc"), text_or_empty(f"`{text_col}`").alias("_text"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_LAST)).alias("_doc"))
    # a text's hash tells apart rows of one id only
    packed = packed.withColumn("_row", F.xxhash64("_text"))
    spans = removed_spans(packed.select("_doc", "_row", "_text"), length, gram)
    spans = spans.select(F.col("doc").alias("_doc"), F.col("row").alias("_row"), "spans")
    joined = packed.join(spans, ["_doc", "_row"], "left").select("doc", "_text", "spans")
    kind = joined.schema["doc"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            kept, size, gone, runs = [], [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                text = text.encode("utf-8", "replace")
                left, n = _cut(text, [(x["a"], x["b"]) for x in found or ()])
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
                size.append(len(text))
                gone.append(len(text) - len(left))
                runs.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string() if as_text else pa.binary()), *(pa.array(x, pa.int64()) for x in (size, gone, runs))], names=["doc", "kept", "n_bytes", "n_removed", "n_spans"])

    return joined.mapInArrow(run, f"doc {kind}, kept {'string' if as_text else 'binary'}, n_bytes long, n_removed long, n_spans long")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(F.col(f"doc.{id_col}").alias(id_col), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int | None, str | None]], length: int = LENGTH) -> list[tuple]:
    """The result by looking up every window; for tests."""
    texts = [(t or "").encode("utf-8", "replace") for _, t in rows]
    order = [_LAST if i is None else i for i, _ in rows]
    least: dict[bytes, int] = {}
    for d, t in zip(order, texts):
        for k in range(len(t) - length + 1):
            w = t[k : k + length]
            if d < least.get(w, _LAST + 1):
                least[w] = d
    out = []
    for (i, _), d, t in zip(rows, order, texts):
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if least[t[k : k + length]] < d:
                gone[k : k + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out
