import base64
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tiergrain.llm import token_counts as C

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def brute(library, text, spans, rule):
    """Token by token, byte by byte."""
    owner = []
    for i, c in enumerate(text):
        s = next((k for k, (a, z) in enumerate(spans) if a <= i < z), len(spans))
        owner += [s] * len(c.encode())
    out, at = [0] * (len(spans) + 1), 0
    for t in library.encode_ordinary(text):
        n = len(library.decode_single_token_bytes(t))
        own = owner[at:at + n]
        at += n
        pick = {"first": own[0], "last": own[-1]}.get(rule)
        if pick is None:
            top = max(own.count(x) for x in own)
            pick = next(x for x in own if own.count(x) == top)
        out[pick] += 1
    return out


@pytest.mark.parametrize("rule", C.RULES)
def test_rules_against_plain_code(library, rule):
    rng = random.Random(3)
    sizes = np.array([len(t) for t in C.read_ranks(PATH)])
    for _ in range(150):
        text = "".join(rng.choice(["the ", "of", "\n", "é", "𝄞", "word", " ", "12", "ción"]) for _ in range(rng.randint(0, 60)))
        cuts = sorted(rng.sample(range(len(text) + 1), min(len(text) + 1, rng.randint(2, 9))))
        spans = [(a, z) for a, z in zip(cuts, cuts[1:]) if rng.random() < 0.8]
        byte = lambda i: len(text[:i].encode())
        starts, ends = (np.array([byte(s[k]) for s in spans], dtype=np.int64) for k in (0, 1))
        if not spans:
            continue
        got = C.attribute(sizes[np.array(library.encode_ordinary(text), dtype=np.int64)], starts, ends, rule)
        assert got.tolist() == brute(library, text, spans, rule)


def test_sections():
    assert C.line_sections("") == [(0, 0)]
    assert C.line_sections("ab\n\nc\n") == [(0, 3), (3, 4), (4, 6)]
    assert C.field_sections(["a", "", "bc"]) == ("a\n\nbc", [(0, 1), (2, 2), (3, 5)])


def test_edges_and_totals(spark, library):
    long = "lorem ipsum\n" * 40_000
    rows = [(1, "one\ntwo two\n", 0), (1, "one\ntwo two\n", 0), (2, None, 0), (None, "", 0), (3, long, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, section int")
    out = C.count_tokens(df, PATH, P.PATTERN).collect()
    assert [(r.section, r.start, r.end, r.n_tokens) for r in out if r.doc_id in (2, None)] == [(0, 0, 0, 0)] * 2
    assert sum(r.n_tokens for r in out if r.doc_id == 3) == len(library.encode_ordinary(long))
    assert sum(r.n_tokens for r in out if r.doc_id == 1) == 2 * len(library.encode_ordinary(rows[0][1]))
    assert C.count_tokens(df.limit(0), PATH, P.PATTERN).count() == 0


def test_query_against_plain_code(spark, library):
    from tiergrain.llm.registry import op3_token_counts

    d = "/root/testdata/sf0.001"
    got = {}
    for r in op3_token_counts(spark, d).collect():
        got.setdefault(r.doc_id, {})[r.section] = r.n_tokens
    for r in spark.read.parquet(f"{d}/documents.parquet").limit(60).collect():
        spans = C.line_sections(r.text)
        want = brute(library, r.text, spans, "first")
        assert [got[r.doc_id][i] for i in range(len(spans))] == want[:-1]
