import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from tiergrain.llm import weighted_fingerprints as W


def jaccard(a, b):
    a, b = Counter(a.lower().split()), Counter(b.lower().split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def edited(text, nxt):
    h = len(text) // 2
    return text[:len(text) - h] + nxt[:h]


def test_query_against_plain_code(spark):
    from tiergrain.llm.registry import op9_fingerprints

    d = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    rows.sort(key=lambda r: -r.doc_id)
    got = {r.doc_id: r for r in op9_fingerprints(spark, d).collect()}
    assert len(got) == len(rows)
    errors = []
    for i, r in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)]
        e = edited(r.text, nxt.text)
        g = got[r.doc_id]
        assert (g.n_chars, g.edited_sha256) == (len(r.text), hashlib.sha256(e.encode()).hexdigest())
        errors += [g.near_edited - jaccard(r.text, e), g.near_next - jaccard(r.text, nxt.text)]
        quads = [[f[k:k + 4] for k in range(0, 4 * W.SAMPLES, 4)] for f in (g.fingerprint, g.edited_fingerprint, got[nxt.doc_id].fingerprint)]
        alike = [sum(x == y for x, y in zip(quads[0], q)) / W.SAMPLES for q in quads[1:]]
        assert [g.near_edited, g.near_next] == alike                # of the fingerprints returned
    assert abs(sum(errors) / len(errors)) < 0.02                    # unbiased
    assert (sum(x * x for x in errors) / len(errors)) ** 0.5 < 0.1       # spread of 32 samples
    same = {}
    for r in rows:
        assert same.setdefault(r.text, got[r.doc_id].fingerprint) == got[r.doc_id].fingerprint


def test_collision_rate_is_the_generalised_jaccard(spark):
    rng = random.Random(2)
    a = " ".join(f"w{i}" for i in range(60) for _ in range(rng.randint(1, 6)))
    b = " ".join(f"w{i}" for i in range(20, 80) for _ in range(rng.randint(1, 6)))
    df = spark.createDataFrame([(2, a), (1, b)], "doc_id long, text string")
    got = {r.doc_id: r.near_next for r in W.fingerprint_documents(df, samples=512, buckets=2).collect()}
    assert got[1] == got[2] and abs(got[1] - jaccard(a, b)) < 0.06


def test_order_with_ties_nulls_and_extra_columns(spark):
    rng = random.Random(8)
    rows = [(i, f"text {i} " + "ab c" * (i % 7), 1) for i in rng.sample(range(1000), 60)]
    rows += [(5000, f"same id {i} é𝄞", 2) for i in range(40)]
    rows += [(None, f"no id {i}", 3) for i in range(30)] + [(None, None, 3), (None, "", 3), (7000, "rep", 4)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket int")
    out = W.with_successors(df, buckets=16).where("extra = 0").collect()
    assert len(out) == len(rows)
    assert sorted((str(r.doc_id), r.text) for r in out) == sorted((str(i), t or "") for i, t, _ in rows)
    # following one another visits every text as often as it occurs
    assert Counter(r.following for r in out) == Counter(r.text for r in out)
    ids = {t: i for i, t, _ in rows if t}
    for r in out:
        if r.doc_id is not None and r.following in ids and ids[r.following] is not None:
            assert ids[r.following] <= r.doc_id
    assert len({r.bucket for r in out}) > 8
    full = W.fingerprint_documents(df, samples=8, buckets=16).collect()
    assert Counter((r.doc_id, r.n_chars) for r in full) == Counter((i, len(t or "")) for i, t, _ in rows)


def test_very_many_buckets_are_about_equally_full(spark):
    rows = spark.range(60_000).select((F.col("id") * 7919 % 60_013).alias("doc_id"), F.lit("x").alias("text"))
    sizes = [r["count"] for r in W._bucketed(rows, 20_000).groupBy("bucket").count().collect()]
    assert len(sizes) > 19_000 and max(sizes) <= 12


def test_single_row_and_empty_table(spark):
    df = spark.createDataFrame([(3, "A a b")], "doc_id long, text string")
    r = W.fingerprint_documents(df, samples=8).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"A aA ").hexdigest()
    assert W.fingerprint_documents(df.limit(0), samples=8).count() == 0
    e = W.fingerprint_documents(spark.createDataFrame([(1, ""), (2, "x y")], "doc_id long, text string"), samples=8)
    got = {r.doc_id: r for r in e.collect()}
    assert got[1].near_edited == 1.0 and got[1].near_next == 0.0
