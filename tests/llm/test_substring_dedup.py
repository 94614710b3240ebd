import hashlib
import random
import re

import numpy as np

from tiergrain.llm import substring_dedup as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """rows of (doc_id, text) -> (doc_id, n_words, n_removed, kept text)."""
    least = {}
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in split:
        if d is not None:
            for i in range(len(w) - 12):
                k = tuple(w[i:i + 13])
                least[k] = min(least.get(k, d), d)
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - 12 if d is not None else 0):
            if least[tuple(w[i:i + 13])] < d:
                gone.update(range(i, i + 13))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def got(df, **kw):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in S.remove_repeats(df, **kw).collect()), key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["é", "Ab", "𝄞x"]
    passages = [[rng.choice(vocab) for _ in range(rng.randint(10, 60))] for _ in range(12)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(vocab) for _ in range(rng.randint(1, 40))]
        if words and rng.random() < 0.3:
            words[rng.randrange(len(words))] = "changed"
        rows.append((rng.randrange(n), rng.choice([" ", "\n", " \t"]).join(words)))
    return rows


def test_backward_search_finds_every_repeat():
    rng = random.Random(1)
    lines, owners = [], []
    for i in range(400):
        w = [rng.choice("abc") for _ in range(rng.randint(13, 21))]
        lines.append(" ".join(w).encode())
        owners.append(rng.randrange(1000))
    want = {}
    for line, o in zip(lines, owners):
        w = line.split()
        for i in range(len(w) - 12):
            want[tuple(w[i:i + 13])] = min(want.get(tuple(w[i:i + 13]), o), o)
    for line, found in zip(lines, S.least_owners(lines, owners)):
        w = line.split()
        assert found.tolist() == [want[tuple(w[i:i + 13])] for i in range(len(w) - 12)]


def test_ranks():
    rng = np.random.default_rng(2)
    text = rng.integers(0, 37, 1000)
    m = S.WaveletMatrix(text, 37)
    for s in range(37):
        at = rng.integers(0, 1001, 50)
        assert m.rank(np.full(50, s), at).tolist() == [int((text[:a] == s).sum()) for a in at]


def test_against_plain_code(spark):
    rows = corpus(3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows)


def test_hot_minimizers_give_the_same(spark):
    rows = corpus(4, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, hot_texts=2) == brute(rows)


def test_small_shards_give_the_same(monkeypatch):
    import pyarrow as pa
    rng = random.Random(6)
    # words of one route occur in no other, as with minimizers
    lines = [" ".join(f"{i % 7}{rng.choice('ab')}" for _ in range(13 + i % 9)).encode() for i in range(60)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([i % 7 for i in range(60)], pa.int64()), pa.array(range(60), pa.int64()), pa.array(lines, pa.binary()),
         pa.array(range(60), pa.int64()), pa.array([99] * 60, pa.int64())], names=["route", "content", "words", "lo", "hi"])
    rows = batch.take(pa.array(np.argsort([i % 7 for i in range(60)], kind="stable")))
    whole = {r["content"]: r["least"] for b in S._search(iter([rows])) for r in b.to_pylist()}
    monkeypatch.setattr(S, "SHARD_WORDS", 1)
    apart = {}
    for b in S._search(iter([rows])):
        apart.update({r["content"]: r["least"] for r in b.to_pylist()})
    assert apart == whole


def test_edges(spark):
    t = " ".join(f"a{i}" for i in range(30))
    long = " ".join(f"b{i % 5000}" for i in range(60_000))
    rows = [(3, t), (3, t), (1, None), (2, ""), (None, t), (None, t), (7, "short " + t + " tail"), (8, t + " x " + t),
            (9, long), (10, "q " + long)]
    df = spark.createDataFrame([(d, x, 1, 2) for d, x in rows], "doc_id long, text string, key int, start int")
    assert got(df) == brute(rows)
    assert got(df.limit(0)) == []
    only = [(5, t + " " + t)]
    assert got(spark.createDataFrame(only, "doc_id long, text string")) == brute(only)


def test_query_against_plain_code(spark):
    from tiergrain.llm.registry import op8_substring_dedup

    d = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    want = [(a, b, c, hashlib.sha256(k.encode()).hexdigest()) for a, b, c, k in brute(rows)]
    found = op8_substring_dedup(spark, d).collect()
    assert sorted(tuple(r) for r in found) == sorted(want) and any(r.n_removed for r in found)
