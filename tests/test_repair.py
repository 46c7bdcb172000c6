"""Repairs and names on small literal tables, and against plain Python."""

import random
from collections import Counter

from pyspark.sql import functions as F

from annotspark.operators.names import ranked, running, unique_names
from annotspark.plans import repair

ROW = "seqid string, type string, f_start long, f_end long, strand string, id string, parent string"


def order():
    return [F.asc("seqid"), F.asc("f_start"), F.asc("f_end"), F.asc("type"), F.asc_nulls_first("id")]


def fixed(spark, rows, **more):
    out, actions = repair.repair_structure(spark.createDataFrame(rows, ROW), order(), **more)
    return {(r["type"], r["f_start"], r["f_end"], r["id"], r["parent"]) for r in out.collect()}, Counter(r["action"] for r in actions.collect())


def test_names_until_free(spark):
    names = ["a", "a", "a_dup2", "b", None, None, "a", "a_dup4", "a_dup4", "a_dup02", "b_dup1", "b"]
    df = spark.createDataFrame(list(enumerate(names)), "n int, id string")
    got = {r["n"]: r["id"] for r in unique_names(df, "id", [F.asc("n")]).collect()}
    assert got == {0: "a", 1: "a_dup3", 2: "a_dup2", 3: "b", 4: None, 5: None, 6: "a_dup5", 7: "a_dup4", 8: "a_dup4_dup2", 9: "a_dup02", 10: "b_dup1", 11: "b_dup2"}
    taken = spark.createDataFrame([("c",), ("a_dup3",)], "id string")
    more = {r["n"]: r["id"] for r in unique_names(df.where("n < 2").union(spark.createDataFrame([(50, "c")], "n int, id string")), "id", [F.asc("n")], taken=taken).collect()}
    assert more == {0: "a", 1: "a_dup2", 50: "c_dup2"}


def test_names_of_random_tables_and_genomes(spark):
    rng = random.Random(7)
    pool = ["x", "y"] + [f"x_dup{k}" for k in range(1, 9)] + [None]
    rows = [(n, rng.choice(["g1", "g2", None]), rng.choice(pool)) for n in range(400)]
    df = spark.createDataFrame(rows, "n int, genome string, id string").repartition(7)
    got = {r["n"]: r["id"] for r in unique_names(df, "id", [F.asc("n")], ["genome"]).collect()}
    for g in ("g1", "g2", None):
        own = [(n, i) for n, h, i in rows if h == g and i is not None]
        out = [got[n] for n, _ in own]
        assert len(set(out)) == len(out)
        seen, names, free = set(), {i for _, i in own}, {}
        for n, i in own:  # the first holder keeps it, the next one takes the least number that no row has
            if i not in seen:
                seen.add(i)
                assert got[n] == i
                continue
            k = free.get(i, 1) + 1
            while f"{i}_dup{k}" in names:
                k += 1
            free[i] = k
            assert got[n] == f"{i}_dup{k}"
    assert all(got[n] is None for n, _, i in rows if i is None)


def test_running_sums_over_ranges(spark):
    rng = random.Random(8)
    rows = [(n, rng.choice(["hot"] * 8 + ["cold", None]), rng.randint(0, 3)) for n in range(300)]
    df = spark.createDataFrame(rows, "n int, k string, v int")
    got = {r["n"]: (r["s"], r["p"]) for r in ranked(running(df, ["k"], [F.asc("n")], F.col("v"), "s"), ["k"], [F.asc("n")], "p").collect()}
    sums, places = Counter(), Counter()
    for n, k, v in rows:
        sums[k] += v
        places[k] += 1
        assert got[n] == (sums[k], places[k])


def test_orphaned_parts_get_a_transcript_and_a_gene(spark):
    rows = [("c", "CDS", 100, 200, "+", None, "m1"), ("c", "CDS", 300, 400, "+", None, "m1"), ("c", "mRNA", 900, 950, "-", "m2", "g2"), ("c", "mRNA", 910, 990, "-", "m3", "g2")]
    got, actions = fixed(spark, rows)
    assert {r for r in got if r[0] in ("gene", "mRNA")} == {
        ("gene", 100, 400, "m1.gene", None), ("mRNA", 100, 400, "m1", "m1.gene"), ("gene", 900, 990, "g2", None), ("mRNA", 900, 950, "m2", "g2"), ("mRNA", 910, 990, "m3", "g2"),
    }
    assert actions == {"made up": 3}
    again = repair.structure_issues(spark.createDataFrame([("c", t, a, b, "+", i, p) for t, a, b, i, p in got], ROW))
    assert again.count() == 0


def test_missing_ids_and_parents(spark):
    rows = [("c", "gene", 1, 90, "+", None, None), ("c", "mRNA", 1, 90, "+", None, None), ("c", "exon", 5, 9, "+", "e", None), ("c", "CDS", 5, 9, "+", "k", ""), ("c", "gene", 1, 9, "+", "fix_gene_0007", None), ("c", "tRNA", 1, 9, "+", None, None)]
    got, actions = fixed(spark, rows)
    # numbers go on behind the ones that are there
    assert {r[3] for r in got if r[0] == "gene" and r[2] == 90 and r[4] is None} >= {"fix_gene_0008"}
    assert {r[4] for r in got if r[0] in ("exon", "CDS")} == {"fix_orphan_0009", "fix_orphan_0010"}
    assert [r[4] for r in got if r[0] == "mRNA" and r[2] == 90] == ["fix_orphan_0008"]
    assert ("tRNA", 1, 9, None, None) in got
    assert actions == {"assigned id": 2, "named a parent": 3, "made up": 5}


def test_what_cannot_be_repaired_stays_as_an_issue(spark):
    rows = [("c", "gene", 1, 90, "+", "g", None), ("c", "mRNA", 1, 50, "+", "m", "g"), ("c", "CDS", 40, 60, "+", None, "m,other"), ("c", "mRNA", 1, 50, "+", "n", "m"), ("c", "exon", 1, 5, "+", None, "gone")]
    issues = {(r["kind"], r["repairable"]) for r in repair.structure_issues(spark.createDataFrame(rows, ROW)).collect()}
    assert issues == {("CdsOutsideMrna", False), ("MrnaParentNotGene", False), ("OrphanParent", True)}
    got, _ = fixed(spark, rows)
    assert ("CDS", 40, 60, None, "m,other") in got
    left = repair.structure_issues(spark.createDataFrame([("c", t, a, b, "+", i, p) for t, a, b, i, p in got], ROW))
    assert {r["kind"] for r in left.collect()} == {"CdsOutsideMrna", "MrnaParentNotGene"}


def test_made_up_genes_have_free_names(spark):
    got, _ = fixed(spark, [("c", "CDS", 1, 9, "+", "x.gene", "x"), ("c", "CDS", 20, 29, "+", "x.gene_dup2", "x")])
    assert ("gene", 1, 29, "x.gene_dup3", None) in got and ("mRNA", 1, 29, "x", "x.gene_dup3") in got


def test_two_genomes_are_repaired_apart(spark):
    rows = [("c", "CDS", 100, 200, "+", None, "m"), ("c", "gene", 5, 9, "+", None, None), ("c", "CDS", 5, 9, "+", None, None)]
    both = spark.createDataFrame([(g, *r) for g in ("g1", "g2") for r in rows], f"genome_id string, {ROW}")
    out, actions = repair.repair_structure(both, order(), ["genome_id"])
    alone, _ = fixed(spark, rows)
    for g in ("g1", "g2"):
        assert {(r["type"], r["f_start"], r["f_end"], r["id"], r["parent"]) for r in out.where(F.col("genome_id") == g).collect()} == alone
    assert actions.groupBy("genome_id").count().collect()[0]["count"] * 2 == actions.count()


def test_cleaned_lines(spark):
    lines = ["c\ts\tgene\t0\t9\t.\t+\t.\tID=a", "c\ts\tCDS\t90\t20\t.\t+\t.\tID=b;Parent=a", "c\ts\tCDS\t1\t3\t.\t+\t.\tID=d", "c\ts\tCDS\tx\t9\t.\t+\t.\tID=e", "c\ts\tCDS\t1\t50\t.\t+\t.\tParent=zz,a", "# note", "one\ttwo"]
    rows = repair.clean_lines(spark.createDataFrame([(x,) for x in lines], "value string"), least=5, drop_orphans=True).collect()
    assert Counter(r["action"] for r in rows) == {"raised": 1, "swapped": 1, "short": 1, "unparseable": 2, "orphan": 1}
    assert {(r["start"], r["end"]) for r in rows if r["action"] in ("raised", "swapped")} == {(1, 9), (20, 90)}
    assert Counter(r["action"] for r in repair.clean_lines(spark.createDataFrame([(lines[1],)], "value string"), swap=False).collect()) == {"unparseable": 1}


def test_cleaned_lines_are_parsed_without_filters_on_their_fields(spark):
    row = lambda kind, a, b, attrs: "\t".join(["c", "x", kind, a, b, ".", "+", ".", attrs])
    rows = [row("gene", "10", "20", "ID=a;ID =g"), row("mRNA", "10", "20", "Parent=g;ID=m"), row("CDS", "20", "10", "Parent=a"), row("CDS", "x", "20", "ID=lost"), row("CDS", "10", "20", "ID=c;Parent=lost"), row("exon", "0", "9", "Parent="), row("gene", "1", "9", ".")]
    done = repair.clean_lines(spark.createDataFrame([(r,) for r in rows], "value string"), drop_orphans=True).select("type", "action", "start", "end")
    assert sorted(tuple(r) for r in done.collect()) == sorted([("gene", "kept", 10, 20), ("mRNA", "kept", 10, 20), ("CDS", "orphan", 10, 20), ("CDS", "unparseable", None, 20), ("CDS", "orphan", 10, 20), ("exon", "orphan", 1, 9), ("gene", "kept", 1, 9)])
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert not any("split(" in line or "regexp_extract" in line for line in filters)
