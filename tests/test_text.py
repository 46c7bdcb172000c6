"""Text queries against plain Python."""

from annotspark.plans import text


def test_paragraphs_end_at_blank_lines(spark):
    short = "a line of thirty letters or so"
    texts = {1: f"{short}\n{short}\n\n{short}\n\n \u00a0{'x' * 50}\n \n\n{'y' * 600}", 2: "é" * 26, 3: "", 4: f"{short}\n{short}\n\n\n{short}\n{short}\n"}
    want = []
    for i, t in texts.items():
        want += [(i, n, p[:500]) for n, p in enumerate(p for p in t.split("\n\n") if len(p.strip().encode()) > 50)]
    got = text.r02(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == want
