"""Encoding against the public tokenizers' own libraries, and packing by its invariants."""

import base64
import random

import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sthalam.llm.packing import fill_containers, fill_report, pack_histogram
from sthalam.llm.pair_bpe import PATTERN, TOKENIZERS, PairIndexEncoder, encode_corpus, encoder

JSON = f"{TOKENIZERS}/byte_bpe_50k.json"
TEXTS = ["", None, " ", "\n", "  two  blanks\t\n\n end ", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 40, "नमस्ते दुनिया, पिन 210001", "café naïve 😀🏠 ​x", "<|endoftext|> as text", "I'll we've don't 12345 --- ###", "x" * 20_000, "Mepema Nagar 210001 " * 300, "same", "same"]


def test_encoding_matches_both_libraries(spark):
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    with open(f"{TOKENIZERS}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    k = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    d = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(TEXTS)] + [(None, "null key", "")], "doc_id bigint, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in encode_corpus(d).collect()}
    for i, x in enumerate(TEXTS):
        assert got[i] == t.encode(x or "", add_special_tokens=False).ids == k.encode_ordinary(x or ""), i
        assert t.decode(got[i]) == (x or "")
    assert len(got[None]) > 0
    n = {r["doc_id"]: r["n"] for r in encode_corpus(d, out="n", lengths_only=True).collect()}
    assert n == {i: len(x) for i, x in got.items()}
    assert encode_corpus(d.limit(0)).count() == 0


def test_random_bytes_against_library():
    t, e, r = Tokenizer.from_file(JSON), encoder(JSON), random.Random(1)
    t.encode_special_tokens = True
    texts = ["".join(r.choice("ab  éñक्ष\n.'1") for _ in range(r.randrange(200))) for _ in range(200)]
    ids, n = e.encode(texts)
    at = 0
    for x, k in zip(texts, n.tolist(), strict=True):
        assert ids[at : at + k].tolist() == t.encode(x, add_special_tokens=False).ids
        at += k


def test_store_is_emptied(monkeypatch):
    import sthalam.llm.pair_bpe as m

    monkeypatch.setattr(m, "KEPT_PIECES", 3)
    e = PairIndexEncoder({chr(256 + b) if not (33 <= b <= 126) else chr(b): b for b in range(256)} | {c: i for i, c in enumerate(m._byte_letters())} | {"ab": 256}, [("a", "b")])
    assert len(e.encode(["a b c d e ab"])[0]) and len(e.store) > 3
    e.encode(["ab"])
    assert len(e.store) == 1


@pytest.mark.parametrize("histogram", [{}, {10: 1}, {10: 5}, {3: 7}, {7: 3, 3: 3, 1: 2}, {k: (k * 7) % 11 + 1 for k in range(1, 11)}, {5: 10**12, 1: 3}])
def test_patterns_hold_every_item(histogram):
    patterns = pack_histogram(histogram, 10)
    placed = {}
    for n, lengths in patterns:
        assert n > 0 and 0 < sum(lengths) <= 10
        for x in lengths:
            placed[x] = placed.get(x, 0) + n
    assert placed == {k: n for k, n in histogram.items() if n}
    least = -(-sum(k * n for k, n in histogram.items()) // 10)
    assert sum(n for n, _ in patterns) <= 1.3 * least + 2


def test_containers(spark):
    r = random.Random(4)
    sizes = [(i, r.choice([0, 1, 5, 5, 5, 30, 64, 64, 65, 129, 200])) for i in range(400)] + [(None, 7), (7, 7), (7, 7), (500, None)]
    d = spark.createDataFrame([(*x, "clash", 1) for x in sizes], "doc_id bigint, n_tokens bigint, part string, tokens int")
    out = fill_containers(d, capacity=64).collect()
    used, spans = {}, {}
    for x in out:
        if x["container_id"] is None:
            assert x["tokens"] == 0
            continue
        used[x["container_id"]] = used.get(x["container_id"], 0) + x["tokens"]
        spans.setdefault(x["container_id"], []).append((x["start"], x["start"] + x["tokens"]))
    assert max(used.values()) <= 64 and sum(used.values()) == sum(n or 0 for _, n in sizes)
    for s in spans.values():
        s.sort()
        assert all(a[1] <= b[0] for a, b in zip(s, s[1:], strict=False)) and s[-1][1] <= 64
    assert sorted(used) == list(range(len(used)))
    assert sum(1 for x in out if x["tokens"] not in (0, 64)) == sum(1 for _, n in sizes if n and n % 64)
    rep = fill_report(fill_containers(d, capacity=64), 64).first()
    assert rep["containers"] == len(used) and rep["fullest"] <= 64 and rep["containers"] <= rep["least_containers"] * 1.05 + 1
    assert fill_containers(d.limit(0)).count() == 0 and fill_report(fill_containers(d.limit(0))).first()["containers"] == 0
    assert fill_containers(d.where(F.col("n_tokens") == 0)).where("container_id IS NOT NULL").count() == 0
