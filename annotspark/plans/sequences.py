"""Sequence functions and translation."""

from __future__ import annotations

import functools
import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annotspark.registry import query

#: The standard genetic code, codons in the order T, C, A, G of each base.
STANDARD = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
#: Fixed values of the public translation tables: what a codon means where it isn't the standard, codons besides ATG
#: that begin a protein, and names.  In 27, 28 and 31 some stops depend on what stands around them; here they are read.
CODES = {
    1: ("", "", "standard"),
    2: ("AGA* AGG* ATAM TGAW", "ATT ATC ATA GTG", "vertebrate-mito vertebrate_mitochondrial"),
    3: ("ATAM CTTT CTCT CTAT CTGT TGAW", "ATA", "yeast-mito yeast_mitochondrial"),
    4: ("TGAW", "TTA TTG CTG ATT ATC ATA GTG", "mold-mito mold_mitochondrial mold protozoan mycoplasma spiroplasma"),
    5: ("AGAS AGGS ATAM TGAW", "ATT ATC ATA GTG", "invertebrate-mito invertebrate_mitochondrial"),
    6: ("TAAQ TAGQ", "", "ciliate ciliate_nuclear dasycladacean hexamita"),
    9: ("AAAN AGAS AGGS TGAW", "GTG", "echinoderm-mito flatworm-mito"),
    10: ("TGAC", "", "euplotid euplotid_nuclear"),
    11: ("", "GTG TTG ATT CTG", "bacterial archaeal plastid"),
    12: ("CTGS", "CTG", "candida ctg ctg-clade alt-yeast alternative_yeast_nuclear"),
    13: ("AGAG AGGG ATAM TGAW", "ATA GTG TTG", "ascidian-mito"),
    14: ("AAAN AGAS AGGS TAAY TGAW", "", "alt-flatworm-mito"),
    16: ("TAGL", "", "chlorophycean-mito"),
    21: ("TGAW ATAM AGAS AGGS AAAN", "GTG", "trematode-mito"),
    22: ("TCA* TAGL", "", "scenedesmus-mito"),
    23: ("TTA*", "ATT GTG", "thraustochytrium-mito"),
    24: ("AGAS AGGK TGAW", "GTG TTG CTG", "rhabdopleuridae-mito"),
    25: ("TGAG", "TTG GTG", "sr1 gracilibacteria"),
    26: ("CTGA", "CTG", "pachysolen pachysolen_nuclear"),
    27: ("TAAQ TAGQ TGAW", "", "karyorelict karyorelict_nuclear"),
    28: ("TAAQ TAGQ TGAW", "", "condylostoma condylostoma_nuclear"),
    29: ("TAAY TAGY", "", "mesodinium mesodinium_nuclear"),
    30: ("TAAE TAGE", "", "peritrich peritrich_nuclear"),
    31: ("TAAE TAGE TGAW", "", "blastocrithidia blastocrithidia_nuclear"),
    33: ("AGAS AGGK TAAY TGAW", "GTG TTG CTG", "cephalodiscidae-mito"),
}


def codons(table: int = 1) -> dict[str, str]:
    standard = dict(zip(map("".join, itertools.product("TCAG", repeat=3)), STANDARD))
    return standard | {x[:3]: x[3] for x in CODES[table][0].split()}


def _lookup(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def code_of(name: Column) -> Column:
    """The table that a number or a name, in any case, stands for; the standard one for others."""
    names = {n: k for k, (_, _, all_) in CODES.items() for n in [str(k), *all_.split()]}
    return F.coalesce(F.try_element_at(_lookup(names), F.lower(F.trim(name))), F.lit(1))


def is_start(code: Column, codon: Column) -> Column:
    """Whether the codon begins proteins in a table."""
    starts = _lookup({k: f"ATG {s}" for k, (_, s, _) in CODES.items()})
    return F.array_contains(F.split(F.try_element_at(starts, code), " "), F.upper(codon))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgtUu", "TGCAtgcaAa"))


def subsequence(seq: Column, start: Column, end: Column) -> Column:
    """1-based inclusive slice; empty when the start is 0 or behind the end."""
    return F.when((start >= 1) & (start <= end), F.substring(seq, start, end - start + 1)).otherwise(F.lit(""))


@functools.lru_cache(maxsize=None)
def _translator(table: int):
    """An Arrow function of sequences: codons of a whole batch are looked up at once, by the places of their letters in TCAG."""
    known = codons(table)
    amino = "".join(known.get(a + b + c, "X") for a in "TCAG-" for b in "TCAG-" for c in "TCAG-").encode()

    def one(seq: str) -> str:
        letters = seq.upper()
        found = "".join(known.get(letters[k : k + 3], "X") for k in range(0, len(letters) - 2, 3))
        return found.removesuffix("*")

    def run(seqs):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute

        large = seqs.cast(pa.large_string()).fill_null("")
        at = np.frombuffer(large.buffers()[1], dtype=np.int64, count=len(large) + 1, offset=8 * large.offset)
        bases = np.frombuffer(large.buffers()[2] or b"", dtype=np.uint8)[at[0] : at[-1]] if len(large) else np.zeros(0, dtype=np.uint8)
        gone = pa.array(seqs.is_null().to_numpy(zero_copy_only=False))
        none = pa.scalar(None, pa.string())
        if len(bases) and bases.max() > 127:
            found = pa.array([one(s) for s in large.to_pylist()], pa.string())
        else:
            place = np.full(128, 4, dtype=np.uint8)
            for k, letters in enumerate(("Tt", "Cc", "Aa", "Gg")):
                place[[ord(x) for x in letters]] = k
            digits = place[bases]
            n = np.diff(at) // 3
            ends = np.cumsum(n)
            first = 3 * np.arange(n.sum()) + np.repeat(at[:-1] - at[0] - 3 * (ends - n), n)
            letters = np.frombuffer(amino, dtype=np.uint8)[25 * digits[first] + 5 * digits[first + 1] + digits[first + 2]]
            last = ends[n > 0] - 1
            stop = last[letters[last] == ord("*")]
            keep = np.ones(len(letters), dtype=bool)
            keep[stop] = False
            lost = np.concatenate([[0], np.cumsum(~keep)])
            offsets = np.concatenate([[0], ends - lost[ends]]).astype(np.int64)
            found = pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(offsets), pa.py_buffer(letters[keep].tobytes())).cast(pa.string())
        return pa.compute.if_else(gone, none, found)

    # so that a filter on a protein is no second translation
    return F.arrow_udf(run, "string").asNondeterministic()


def translate(seq: Column, table: int = 1) -> Column:
    """Protein of a coding sequence: unknown codons X, an incomplete last codon and one final stop dropped."""
    return _translator(table)(seq)


def internal_stops(protein: Column) -> Column:
    """0-based places of stops before the last letter."""
    letters = F.split(F.substring(protein, F.lit(1), F.length(protein) - 1), "")
    return F.filter(F.transform(letters, lambda x, i: F.when(x == "*", i)), lambda i: i.isNotNull())


_CODE = "MAP {" + ", ".join(f"'{c}': '{a}'" for c, a in codons().items()) + "}"


def protein_sql(seq: str) -> str:
    """:func:`translate` in the oracle's SQL."""
    return f"regexp_replace(coalesce(array_to_string(list_transform(regexp_extract_all(upper({seq}), '...'), lambda c: coalesce(({_CODE})[c], 'X')), ''), ''), '\\*$', '')"


_PROT = f"(SELECT seq_id, {protein_sql('seq')} AS protein FROM fx_seq)"


def proteins(seqs: DataFrame) -> DataFrame:
    return seqs.select("seq_id", translate(F.col("seq")).alias("protein"))


@query("P04_subsequence", "fx_seq", "SELECT seq_id, CASE WHEN seq_id % 20 BETWEEN 1 AND 60 THEN substr(seq, CAST(seq_id % 20 AS BIGINT), CAST(60 - seq_id % 20 + 1 AS BIGINT)) ELSE '' END AS part FROM fx_seq")
def p04(seqs):
    return seqs.select("seq_id", subsequence(F.col("seq"), (F.col("seq_id") % 20).cast("int"), F.lit(60)).alias("part"))


@query("P05_reverse_complement", "fx_seq", "SELECT seq_id, reverse(translate(seq, 'ACGTacgtUu', 'TGCAtgcaAa')) AS rc FROM fx_seq")
def p05(seqs):
    return seqs.select("seq_id", reverse_complement(F.col("seq")).alias("rc"))


@query("P06_translate_codons", "fx_seq", f"SELECT * FROM {_PROT}")
def p06(seqs):
    return proteins(seqs)


_CODE_ROWS = ", ".join(f"({k}, '{s}')" for k, (_, s, _) in CODES.items())


@query("P07_genetic_code_lookup", "fx_go", f"""SELECT DISTINCT n AS name, coalesce(k, 1) AS code, coalesce(contains(s, 'GTG'), false) AS gtg, true AS atg FROM
(SELECT CASE WHEN CAST(go[4:] AS INT) % 3 = 0 THEN concat(' ', CAST(CAST(go[4:] AS INT) AS VARCHAR)) WHEN CAST(go[4:] AS INT) % 3 = 1 THEN 'Candida' ELSE 'martian' END AS n, CASE WHEN CAST(go[4:] AS INT) % 3 = 0 THEN CAST(go[4:] AS INT) WHEN CAST(go[4:] AS INT) % 3 = 1 THEN 12 ELSE 0 END AS want FROM fx_go)
LEFT JOIN (VALUES {_CODE_ROWS}) v(k, s) ON k = want""")  # fmt: skip
def p07(go):
    n = F.substring("go", 4, 9).cast("int")
    name = F.when(n % 3 == 0, F.concat(F.lit(" "), n.cast("string"))).when(n % 3 == 1, "Candida").otherwise("martian")
    rows = go.select(name.alias("name")).distinct().withColumn("code", code_of(F.col("name")))
    return rows.select("name", "code", is_start(F.col("code"), F.lit("gtg")).alias("gtg"), is_start(F.col("code"), F.lit("ATG")).alias("atg"))


@query("P08_internal_stop_positions", "fx_seq", f"""SELECT seq_id, len(p) AS n, p[1] AS first, p[-1] AS last FROM (SELECT seq_id, list_filter(range(0, length(protein) - 1),
lambda i: substr(protein, CAST(i + 1 AS BIGINT), 1) = '*') AS p FROM {_PROT})""")  # fmt: skip
def p08(seqs):
    p = proteins(seqs).select("seq_id", internal_stops(F.col("protein")).alias("p"))
    return p.select("seq_id", F.size("p").cast("long").alias("n"), F.get("p", F.lit(0)).cast("long").alias("first"), F.try_element_at("p", F.lit(-1)).cast("long").alias("last"))


_CLEAN = f"(SELECT seq_id, protein, CASE WHEN strpos(protein, '*') > 0 THEN substr(protein, 1, strpos(protein, '*') - 1) ELSE protein END AS c FROM {_PROT})"


def clean_protein(protein: Column) -> tuple[Column, Column, Column]:
    """(cleaned, reason it is skipped, note): cut at the first stop, 10 to 40,000 letters, what is no amino acid becomes X, at most 80% X or ACGT."""
    cut = F.upper(F.substring_index(protein, "*", 1))
    fixed = F.regexp_replace(cut, "[^ACDEFGHIKLMNPQRSTVWYX]", "X")
    share = lambda letters: F.length(fixed) - F.length(F.regexp_replace(fixed, f"[{letters}]", ""))
    n = F.length(fixed)
    reason = (
        F.when(n < 10, "too_short").when(n > 40000, "too_long").when(share("X") * 10 > n * 8, "mostly_unknown").when(share("ACGT") * 10 > n * 8, "looks_like_dna").otherwise("ok")
    )
    note = F.concat_ws(",", F.when(cut != F.upper(protein), "cut_at_stop"), F.when(fixed != cut, "letters_replaced"))
    return fixed, reason, note


@query("P09_clean_protein", "fx_seq", f"""SELECT seq_id, c AS cleaned, CASE WHEN length(c) < 10 THEN 'too_short' WHEN length(c) > 40000 THEN 'too_long' WHEN (length(c) - length(replace(c, 'X', ''))) * 10 > length(c) * 8 THEN 'mostly_unknown'
WHEN (length(c) - length(regexp_replace(c, '[ACGT]', '', 'g'))) * 10 > length(c) * 8 THEN 'looks_like_dna' ELSE 'ok' END AS reason, CASE WHEN strpos(protein, '*') > 0 THEN 'cut_at_stop' ELSE '' END AS note FROM {_CLEAN}""")  # fmt: skip
def p09(seqs):
    cut, reason, note = clean_protein(F.col("protein"))
    return proteins(seqs).select("seq_id", cut.alias("cleaned"), reason.alias("reason"), note.alias("note"))


@query("P21_softmask_case", "fx_seq", """SELECT CAST(sum(length(regexp_replace(seq, '[^a-z]', '', 'g'))) AS BIGINT) AS masked, CAST(sum(length(regexp_replace(seq, '[^A-Za-z]', '', 'g'))) AS BIGINT) AS letters,
round(sum(length(regexp_replace(seq, '[^a-z]', '', 'g'))) / CAST(sum(length(regexp_replace(seq, '[^A-Za-z]', '', 'g'))) AS DOUBLE), 6) AS fraction FROM fx_seq""")  # fmt: skip
def p21(seqs):
    n = lambda p: F.sum(F.length(F.regexp_replace("seq", p, "")).cast("long"))
    return seqs.agg(n("[^a-z]").alias("masked"), n("[^A-Za-z]").alias("letters")).withColumn("fraction", F.round(F.col("masked") / F.col("letters"), 6))


_RUNS = "SELECT seq_id, unnest(regexp_extract_all(seq, '[a-z]+')) AS run FROM fx_seq"


@query("A08_mask_stats", "fx_seq", f"SELECT CAST(sum(length(run)) AS BIGINT) AS masked, count(*) AS regions, max(length(run)) AS longest FROM ({_RUNS})")
def a08(seqs):
    runs = seqs.select(F.explode(F.regexp_extract_all("seq", F.lit("[a-z]+"), F.lit(0))).alias("run")).select(F.length("run").cast("long").alias("n"))
    return runs.agg(F.sum("n").alias("masked"), F.count("*").alias("regions"), F.max("n").alias("longest"))


@query("V07_validate_proteins", "fx_seq", f"""SELECT count(*) AS proteins, count(*) FILTER (WHERE strpos(substr(protein, 1, length(protein) - 1), '*') > 0) AS with_stops,
count(*) FILTER (WHERE length(replace(protein, '*', '')) < 10) AS short, count(*) FILTER (WHERE regexp_matches(protein, '[^A-Z*]')) AS odd FROM {_PROT}""")  # fmt: skip
def v07(seqs):
    p = F.col("protein")
    inner = F.substring(p, F.lit(1), F.length(p) - 1)
    return proteins(seqs).agg(F.count("*").alias("proteins"), F.count_if(F.contains(inner, F.lit("*"))).alias("with_stops"), F.count_if(F.length(F.replace(p, F.lit("*"), F.lit(""))) < 10).alias("short"), F.count_if(p.rlike("[^A-Z*]")).alias("odd"))


@query("K15_fasta_fastq_rejoin", "fx_seq", "SELECT seq_id, concat('@s', CAST(seq_id AS VARCHAR), chr(10), seq, chr(10), '+', chr(10), repeat('I', length(seq))) AS record FROM fx_seq")
def k15(seqs):
    return seqs.select("seq_id", F.concat(F.lit("@s"), F.col("seq_id").cast("string"), F.lit("\n"), "seq", F.lit("\n+\n"), F.repeat(F.lit("I"), F.length("seq"))).alias("record"))


@query("K16_wrap_fasta", "fx_seq", "SELECT seq_id, concat('>s', CAST(seq_id AS VARCHAR), chr(10), rtrim(regexp_replace(seq, '(.{60})', '\\1' || chr(10), 'g'), chr(10))) AS record FROM fx_seq")
def k16(seqs):
    return seqs.select("seq_id", F.concat(F.lit(">s"), F.col("seq_id").cast("string"), F.lit("\n"), F.regexp_replace("seq", "(.{60})(?=.)", "$1\n")).alias("record"))


@query("B05_decoy_names", "fx_ctg", "SELECT DISTINCT seqid FROM fx_ctg")
def b05(contigs):
    return contigs.select("seqid").distinct()
