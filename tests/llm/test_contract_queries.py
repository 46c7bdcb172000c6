"""The registered queries, as they are called, against plain Python on a small folder of tables."""

import base64
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__
from annotspark.llm import license_scan
from annotspark.llm import secret_scan as ss
from annotspark.llm.tokens import tokenizer_path
from tests.llm.conftest import TRICKY
from tests.llm.test_license_windows import brute as licenses
from tests.llm.test_ngram_join import brute as groups
from tests.llm.test_secret_scan import brute as secrets

ROWS = [(100 + k if i is None else i * 2 + k % 2, t) for k, (i, t) in enumerate(TRICKY)] + [
    (200, "x " * 30 + license_scan.TEMPLATES["mit"] + " y" * 20),
    (201, "Released under the MIT License. cc by CC BY all rights reserved <|endoftext|>"),
    (202, "    odd spaces 　 and <s>marks</s> " * 5),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, t, "e", i) for i, t in ROWS], "doc_id long, text string, kept string, n_words long").write.parquet(f"{path}/documents.parquet")
    return path


def run(spark, folder, name):
    return {r["doc_id"]: r for r in __spark_entry__.queries()[name](spark, folder).collect()}


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def test_op1(spark, folder):
    got = run(spark, folder, "op1_secret_scan")
    for i, t in ROWS:
        found = secrets(t)
        shown = lambda some: ",".join(f"{ss.RULES[k].kind}:{a}:{b}" for a, k, b in some)
        base = [x for x in found if x[1] < 3]
        assert got[i]["base_sha256"] == sha(shown(base)) and got[i]["spans"] == shown(found)
        assert [got[i][f"n_{r.kind}"] for r in ss.RULES[:3]] == [sum(x[1] == k for x in base) for k in range(3)]


def test_op4(spark, folder):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokenizer_path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = run(spark, folder, "op4_byte_bpe")
    for i, t in ROWS:
        ids = enc.encode_ordinary(t or "")
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids))), sha((t or "").encode()))


def test_op5_and_op7(spark, folder):
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    crc = lambda x: zlib.crc32(np.array(x, dtype="<u4").tobytes())
    got, at = run(spark, folder, "op5_wavelet_ids"), 0
    packed = __spark_entry__.queries()["op7_best_fit_packing"](spark, folder).toPandas()
    for i, t in sorted(ROWS):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids) + 1, crc([*ids, 2]))
        at += len(ids) + 1
        whole = [*ids, 1]
        own = packed[packed.doc_id == i].sort_values("piece")
        assert own.start.tolist() == list(range(0, len(whole), 4096))
        assert own.ids_crc32.tolist() == [crc(whole[k : k + 4096]) for k in range(0, len(whole), 4096)]
    assert packed.groupby("sequence_id").length.sum().max() <= 4096


def test_op6(spark, folder):
    got = run(spark, folder, "op6_ngram_jaccard")
    assert sorted((str(i), r["n_shingles"], str(r["component_id"])) for i, r in got.items()) == groups(ROWS)


def test_op10(spark, folder):
    got = run(spark, folder, "op10_license_scan")
    for i, t in ROWS:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(k, label) for p, label in license_scan.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        base, more = {label for _, label in places}, licenses(t or "")
        assert (got[i]["n_words"], got[i]["n_base"]) == (len(w), len(places))
        assert (got[i]["first_word"], got[i]["last_word"]) == (min((k for k, _ in places), default=None), max((k for k, _ in places), default=None))
        assert got[i]["base_labels"] == ",".join(sorted(base)) and got[i]["labels"] == ",".join(sorted(base | more.keys()))
        assert got[i]["score"] == max(more.values(), default=0.0)
    assert "mit" in got[200]["labels"].split(",") and got[200]["score"] == 1.0
