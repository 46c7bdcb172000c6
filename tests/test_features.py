"""Feature checks against figures of the survey's source."""

from pyspark.sql import functions as F

from annotspark.plans import features


def test_taxon_ranges_are_the_six_of_the_reference(spark):
    genes = spark.range(13_000).select(F.lit(1).alias("g_start"), F.lit(1600).alias("g_end"), F.lit(5).alias("n_seg"))
    got = {r["taxon"]: (r["gene_count"], r["gene_length"], r["exons"]) for r in features.a07(genes).collect()}
    assert got == {
        "fungi": ("ok", "ok", "ok"),
        "ascomycota": ("high", "high", "high"),
        "basidiomycota": ("ok", "ok", "ok"),
        "plants": ("low", "ok", "ok"),
        "animals": ("low", "ok", "ok"),
        "mammals": ("low", "ok", "low"),
    }
