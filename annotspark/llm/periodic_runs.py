"""Runs of repeated words: every stretch of a text that repeats its first ``q`` words four times or more.

The words of many documents are coded as numbers and put in one sequence, each document closed by a number of its own,
so that nothing matches across documents.

* *Longest common extensions.*  Of the sequence only the suffixes that begin at a difference cover's places (6 of every
  31) are sorted, by doubling and among ties only.  Any two positions reach such places together after fewer than 31
  words, which are compared one by one; from there on the least common prefix between neighbours in the sorted order,
  read from a sparse table, tells how far two positions agree.  The reversed sequence answers backwards.
* *Enumeration on a harmonic grid.*  A run of period ``q`` agrees with itself shifted by ``q`` for ``3 q`` words or more,
  so some multiple of ``3 q`` lies in that part.  For every ``q`` those places are looked at, which is ``n / 3`` times a
  harmonic sum in all; where the words there agree, both extensions give the whole run.  A stretch found under several
  periods has the least of them.

Defined results: null, empty and blank texts have no words and no runs; repeated rows are documents of their own; null
ids and extra columns, of whatever name, don't matter; an empty table gives no rows.  Texts are read whole, by slices of
about a megabyte of whole documents, in tasks without a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annotspark.llm.common import text_or_empty

#: A perfect difference set: any two residues modulo 31 are brought into it by one common shift.
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)
#: Words whose numbers are packed into one sort key.
PACKED = 3
#: Bytes of whole documents that are worked on together.
SLICE = 1 << 20
#: Length of a run in words and in periods, at least.
WORDS, TIMES = 6, 4


def _shifts() -> np.ndarray:
    inside = np.isin(np.arange(2 * MODULUS) % MODULUS, COVER)
    out = np.empty((MODULUS, MODULUS), dtype=np.int64)
    for a in range(MODULUS):
        for b in range(MODULUS):
            out[a, b] = next(d for d in range(MODULUS) if inside[a + d] and inside[(b + d) % MODULUS])
    return out


_SHIFT = _shifts()


class Extensions:
    """How far two positions of a sequence of numbers agree."""

    def __init__(self, codes: np.ndarray):
        """``codes`` are at least 0; whatever repeats has to end before the sequence does."""
        self.n = n = len(codes)
        self.codes = np.concatenate([codes, -1 - np.arange(2 * MODULUS, dtype=np.int64)])
        residue = np.full(MODULUS, -1, dtype=np.int64)
        residue[list(COVER)] = np.arange(len(COVER))
        self.places = np.flatnonzero(np.isin(np.arange(n) % MODULUS, COVER))
        self.at = np.full(n + 1, -1, dtype=np.int64)
        self.at[self.places] = np.arange(len(self.places))
        levels = self._sort()
        self.table = self._sparse(self._neighbours(levels))

    def _sort(self) -> list[np.ndarray]:
        """Ranks of the sampled suffixes; the result has a level for each doubling, the last one without ties."""
        places, m = self.places, len(self.places)
        base = int(self.codes.max(initial=0)) + 2 * MODULUS + 2
        low = self.codes + 2 * MODULUS + 1
        packed = min(PACKED, 63 // max(1, base.bit_length()))
        rank = np.zeros(m, dtype=np.int64)
        tied = np.arange(m)

        def refine(key: np.ndarray) -> None:
            """Split the groups of equal rank by ``key``, given for the tied places."""
            nonlocal tied
            order = np.lexsort((key, rank[tied]))
            who, old, k = tied[order], rank[tied][order], key[order]
            new_old = np.concatenate([[True], old[1:] != old[:-1]])
            new = new_old | np.concatenate([[True], k[1:] != k[:-1]])
            index = np.arange(len(who))
            rank[who] = old + np.maximum.accumulate(np.where(new, index, 0)) - np.maximum.accumulate(np.where(new_old, index, 0))
            alone = new & np.concatenate([new[1:], [True]])
            tied = who[~alone]

        done = 0
        while done < MODULUS and len(tied):
            key = np.zeros(len(tied), dtype=np.int64)
            for k in range(packed):
                # at most a few words past the modulus, where the padding ends
                key = key * base + low[np.minimum(places[tied] + done + k, len(low) - 1)]
            refine(key)
            done += packed
        levels, step = [rank.copy()], MODULUS
        while len(tied):
            to = places[tied] + step
            refine(np.where(to < self.n, rank[self.at[np.minimum(to, self.n)]], -1))
            levels.append(rank.copy())
            step *= 2
        return levels

    def _neighbours(self, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each sampled suffix and the next one in order."""
        self.rank = levels[-1]
        order = np.argsort(self.rank)
        a, b = order[:-1], order[1:]
        pa, pb = self.places[a].copy(), self.places[b].copy()
        for k in range(len(levels) - 1, -1, -1):
            # equal ranks of a level are equal words, as many as its doublings have reached
            step = MODULUS << k
            fine = np.flatnonzero((pa < self.n) & (pb < self.n))
            same = fine[levels[k][self.at[pa[fine]]] == levels[k][self.at[pb[fine]]]]
            pa[same] += step
            pb[same] += step
        return pa - self.places[a] + self._direct(pa, pb, 2 * MODULUS)[0]

    def _direct(self, i: np.ndarray, j: np.ndarray, most: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Words in which positions agree, ``most`` at most, and whether a difference was met."""
        most = np.broadcast_to(most, i.shape)
        far = np.zeros(len(i), dtype=np.int64)
        differ = np.zeros(len(i), dtype=bool)
        live, k = np.flatnonzero(most > 0), 0
        last = len(self.codes) - 1
        while len(live):
            p, q = i[live] + k, j[live] + k
            same = (self.codes[np.minimum(p, last)] == self.codes[np.minimum(q, last)]) & (p < self.n) & (q < self.n)
            differ[live[~same]] = True
            live = live[same]
            k += 1
            far[live] = k
            live = live[most[live] > k]
        return far, differ

    def _sparse(self, least: np.ndarray) -> list[np.ndarray]:
        table, width = [least], 1
        while 2 * width <= len(least):
            prev = table[-1]
            table.append(np.minimum(prev[:-width], prev[width:]))
            width *= 2
        return table

    def agree(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For each pair of different positions, how many words agree from there on."""
        far, differ = self._direct(i, j, _SHIFT[i % MODULUS, j % MODULUS])
        left = np.flatnonzero(~differ)
        p, q = i[left] + far[left], j[left] + far[left]
        inside = (p < self.n) & (q < self.n)
        left, p, q = left[inside], p[inside], q[inside]
        if len(left):
            x, y = self.rank[self.at[p]], self.rank[self.at[q]]
            low, high = np.minimum(x, y), np.maximum(x, y)
            level = np.frexp(high - low)[1] - 1
            for k in np.unique(level).tolist():
                some = np.flatnonzero(level == k)
                t = self.table[k]
                far[left[some]] += np.minimum(t[low[some]], t[high[some] - (1 << k)])
        return far


def find_runs(codes: np.ndarray, starts: np.ndarray, words: int = WORDS, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs in joined documents, by start, then period.

    Document ``d`` is ``codes[starts[d]:starts[d + 1] - 1]``, and its last number stands nowhere else.
    """
    n, none = len(codes), np.zeros(0, dtype=np.int64)
    longest = int(np.diff(starts).max(initial=1)) - 1
    at, period = [], []
    for q in range(1, longest // times + 1):
        step = (times - 1) * q
        hit = np.flatnonzero(codes[: n - q : step] == codes[q::step])
        if len(hit):
            at.append(hit * step)
            period.append(np.full(len(hit), q, dtype=np.int64))
    if not at:
        return none, none, none
    at, period = np.concatenate(at), np.concatenate(period)
    ahead, behind = Extensions(codes), Extensions(codes[::-1])
    end = at + period + ahead.agree(at, at + period)
    # what cannot be long enough with a whole grid step before it needs no look back
    some = np.flatnonzero(end - at + (times - 1) * period + 1 > np.maximum(words, times * period))
    at, period, end = at[some], period[some], end[some]
    start = at.copy()
    back = np.flatnonzero(at > 0)
    start[back] -= behind.agree(n - at[back], n - at[back] - period[back])
    long_ = np.flatnonzero(end - start >= np.maximum(words, times * period))
    start, end, period = start[long_], end[long_], period[long_]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def slices(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and bounds of the texts of an Arrow string array without nulls, those of about a megabyte at a time."""
    import pyarrow as pa

    text = column.cast(pa.large_binary())
    ends = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE, side="right")) - 1)
        yield data[ends[at] : ends[to]], ends[at : to + 1] - ends[at]
        at = to


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' bytes, one after another, their bounds in these, and how many words stand before each text."""
    own = ~_SPACE[data]
    new = own.copy()
    new[1:] &= ~own[:-1]
    heads = bounds[:-1][bounds[:-1] < len(data)]
    new[heads] = own[heads]
    begin = np.flatnonzero(new)
    before = np.concatenate([[0], np.cumsum(own)])
    return data[own], np.append(before[begin], before[-1]), np.searchsorted(begin, bounds)


def _gather(letters: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given words, each with one space behind it, and where each one ends."""
    size = bounds[which + 1] - bounds[which]
    ends = np.cumsum(size + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, 32, dtype=np.uint8)
    put = np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)
    take = np.arange(int(size.sum())) + np.repeat(bounds[which] - (np.cumsum(size) - size), size)
    out[put] = letters[take]
    return out, ends


def runs_of(column, words: int = WORDS, times: int = TIMES) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """Per text of an Arrow string array: number of words, its runs (start, length, period), and the collapsed text."""
    import pyarrow as pa

    for data, bounds in slices(column):
        letters, edges, first = _words(data, bounds)
        m, docs = len(edges) - 1, len(bounds) - 1
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), m, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(letters)]).dictionary_encode()
        starts = first + np.arange(docs + 1)
        codes = np.empty(m + docs, dtype=np.int64)
        inner = np.ones(m + docs, dtype=bool)
        inner[starts[1:] - 1] = False
        codes[inner] = coded.indices.to_numpy()
        codes[~inner] = len(coded.dictionary) + np.arange(docs)
        start, end, period = find_runs(codes, starts, words, times)
        cover = np.zeros(m + docs + 1, dtype=np.int64)
        np.add.at(cover, start + period, 1)
        np.add.at(cover, end, -1)
        kept = np.flatnonzero((np.cumsum(cover[:-1]) == 0)[inner])
        text, ends = _gather(letters, edges, kept)
        of = np.searchsorted(kept, first)
        cuts = np.concatenate([[0], ends])[of]
        whole = text.tobytes()
        run_at = np.searchsorted(start, starts)
        own = np.repeat(starts[:-1], np.diff(run_at))
        found = list(zip((start - own).tolist(), (end - start).tolist(), period.tolist()))
        n, cuts, run_at = np.diff(first).tolist(), cuts.tolist(), run_at.tolist()
        for d in range(docs):
            yield n[d], found[run_at[d] : run_at[d + 1]], whole[cuts[d] : max(cuts[d], cuts[d + 1] - 1)]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, times: int = TIMES, collapsed: bool = True) -> DataFrame:
    """Per document: id, ``n_words``, ``runs`` as (start, length, period) by start, then period, ``collapsed_sha256`` and,
    when asked for, ``collapsed``: the words that no run repeats, one space between them."""
    kind = docs.schema[id_col].dataType.simpleString()
    fields = f"{id_col} {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed_sha256 string" + (", collapsed string" if collapsed else "")
    triple = [("start", "length", "period")]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = pa.list_(pa.struct([(c, pa.int64()) for c in triple[0]]))
        for batch in batches:
            found = list(runs_of(batch.column(1), words, times))
            columns = [
                batch.column(0),
                pa.array([n for n, _, _ in found], pa.int64()),
                pa.array([[dict(zip(triple[0], r)) for r in rs] for _, rs, _ in found], kinds),
                pa.array([hashlib.sha256(t).hexdigest() for _, _, t in found], pa.string()),
            ]
            if collapsed:
                columns.append(pa.array([t for _, _, t in found], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in ([id_col, "n_words", "runs", "collapsed_sha256", "collapsed"] if collapsed else [id_col, "n_words", "runs", "collapsed_sha256"])])

    return docs.select(F.col(id_col), text_or_empty(text_col).alias("_text")).mapInArrow(run, fields)


def stretched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with long repetitions written into every tenth document, as the query's contract says.

    With ``h`` the crc32 of the decimal id and ``g = h div 10``, a document of ``h mod 10 = 0`` has its words from
    ``a = g mod n`` on replaced by the ``p = 1 + (n - a) div (3 + g mod 8)`` words that begin there, over and over.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    base = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"), h.alias("_h"))
    words = F.array_remove(F.split("_text", "[\\x20\\x09-\\x0D]+"), "")
    base = base.withColumn("_w", F.when(F.col("_h") % 10 == 0, words)).withColumn("_g", F.floor(F.col("_h") / 10))
    n = F.size("_w")
    base = base.withColumn("_n", n.cast("long")).withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    base = base.withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8)))
    source = F.expr("array_join(transform(sequence(0, _n - 1), i -> _w[int(if(i < _a, i, _a + (i - _a) % _p))]), ' ')")
    return base.select(id_col, F.when(F.col("_n") > 0, source).otherwise(F.col("_text")).alias("text"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The contract's columns from the runs: the longest one and digests of all."""
    longest = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    out = found.select(id_col, F.size("runs").cast("long").alias("n_runs"), longest.alias("_x"), F.sha2(lines, 256).alias("runs_sha256"), "collapsed_sha256")
    x = lambda c: F.col(f"_x.{c}")
    return out.select(
        id_col, "n_runs", (-x("start")).alias("start"), x("length").alias("length"), (-x("period")).alias("period"),
        F.floor(1000 * x("length") / -x("period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
