import random

import numpy as np
import xxhash

from tiergrain.llm import simhash as S


def brute_fp(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, w = [], ""
    for c in text + " ":
        if c == " " or "\x09" <= c <= "\x0d":
            if w:
                words.append(w)
            w = ""
        else:
            w += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(pairs):
    """pairs of (doc_id, fp) -> smallest doc_id reachable, by fingerprint."""
    fps = sorted({f for _, f in pairs})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 3:
                root[find(a)] = find(b)
    least = {}
    for d, f in pairs:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return {f: least.get(find(f)) for f in fps}


def signed(x):
    return x - 2 ** 64 if x >= 2 ** 63 else x


def test_fingerprint_against_plain_code():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 4, 50, 400):
        t = " \t".join("".join(rng.choice("abÀCé .") for _ in range(rng.randint(1, 6))) for _ in range(n))
        assert S.fingerprint(t) == brute_fp(t)
    assert S.fingerprint(" \n\x0b\x0c\r\t") == 0 == S.fingerprint("")


def test_close_fingerprints_share_an_anchor():
    rng = random.Random(5)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            b ^= 1 << bit
        ka, kb = (set(S._anchors(np.array([signed(x)], dtype=np.int64))[0].tolist()) for x in (a, b))
        assert ka & kb and len(ka) <= 32


def clustered(n, seed):
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        a = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 5, 40])):
            out.append(a)
            for bit in rng.sample(range(64), rng.choice([0, 1, 2, 3, 5])):
                a ^= 1 << bit
    return out[:n]


def check_links(spark, fps, bucket):
    df = spark.createDataFrame([(signed(f),) for f in sorted(set(fps))], "fp long")
    got = {r.node: r.root for r in S.components(S.link_fingerprints(df, bucket=bucket)).collect()}
    want = brute_components([(signed(f), signed(f)) for f in fps])
    assert {f: got.get(f, f) for f in want} == want


def test_links_and_groups_against_all_pairs(spark):
    check_links(spark, clustered(600, 1), 512)


def test_hot_anchors_are_divided_without_loss(spark):
    base = random.Random(9).getrandbits(64)
    ball = [base] + [base ^ (1 << i) for i in range(64)] + [base ^ (1 << i) ^ (1 << (i + 7) % 64) for i in range(64)]
    check_links(spark, ball + clustered(150, 2), 6)


def test_query_against_plain_code(spark):
    from tiergrain.llm.registry import op6_simhash

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    fp = {r.doc_id: brute_fp(r.text) for r in docs}
    comp = brute_components([(k, signed(v)) for k, v in fp.items()])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op6_simhash(spark, d).collect()}
    assert got == {k: (f"{v:016x}", comp[signed(v)]) for k, v in fp.items()}


def test_edges(spark):
    long = "lorem ipsum dolor " * 40_000
    rows = [(1, None, 0), (2, "", 1), (5, "A b", 2), (5, "a B", 3), (9, "x " * 50, 4), (None, "x " * 50, 5),
            (7, long, 6), (8, long + "sit", 7), (None, "only here once", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = [(r.doc_id, r.component_id) for r in S.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (2, 1), (5, 5), (5, 5), (9, 9), (None, 9), (7, 7), (8, 7),
                                           (None, None)], key=str)
    assert S.near_duplicates(df.limit(0)).count() == 0


def test_a_large_group_of_copies_is_dealt_over_places(spark, monkeypatch):
    written = {}

    def watched(df, name, real=S.stored):
        written[name] = real(df, name)
        return written[name]
    monkeypatch.setattr(S, "stored", watched)
    rows = [(i, "the same words in every copy" if i % 3 else f"words of text {i} alone {i * i}") for i in range(3, 3003)]
    got = S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert len(got) == 3000 and {r.component_id for r in got if r.doc_id % 3} == {4}
    sizes = [r["count"] for r in written["simhash-fingerprints"].groupBy("fp", "place").count().collect()]
    assert max(sizes) < 2000 / 8 * 1.5
