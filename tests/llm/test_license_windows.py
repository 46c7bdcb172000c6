"""License windows against brute force, wherever a passage stands."""

import random

from annotspark.llm import license_scan


def brute(text):
    ws = license_scan.words(text)
    best = {}
    for label, template in license_scan.TEMPLATES.items():
        t = set(license_scan.words(template))
        n = max(len(t & set(ws[s : s + 2 * len(t)])) for s in range(max(len(ws), 1)))
        if n >= -(-8 * len(t) // 10):
            best[label] = n / len(t)
    return best


def check(text):
    """Whether the scanner finds what brute force finds, and that."""
    *_, base, labels, score = license_scan.Scanner(license_scan.TEMPLATES, license_scan.PHRASES, {}, license_scan.THRESHOLD).scan(text)
    want = brute(text)
    assert labels == base | want.keys() and score == max(want.values(), default=0.0), text
    return want


def test_edited_passages_are_found_at_every_offset():
    r = random.Random(1)
    for label, template in license_scan.TEMPLATES.items():
        ws = [w.decode() for w in license_scan.words(template)]
        distinct = sorted(set(ws))
        gone = set(r.sample(distinct, len(distinct) - -(-8 * len(distinct) // 10)))
        kept = [w for w in ws if w not in gone]
        for _ in range(3):
            kept.insert(r.randrange(1, len(kept)), "inserted")
        for offset in range(0, 2 * len(distinct) + 1, 1 + len(distinct) // 20):
            assert label in check(" ".join(["x"] * offset + kept + ["y"] * 60))
            assert check(" ".join(["x"] * offset + ws + ["y"] * 60))[label] == 1.0


def test_random_mixtures():
    r = random.Random(2)
    pool = [w for t in license_scan.TEMPLATES.values() for w in t.split()]
    for _ in range(150):
        text = []
        for _ in range(r.randrange(1, 8)):
            t = r.choice(list(license_scan.TEMPLATES.values())).split()
            text += r.choices(["x", "y", *pool], k=r.randrange(30)) + [w for w in t if r.random() < 0.9]
        check(" ".join(text))
