import hashlib
import random
import re

from pyspark.sql import functions as F

from tiergrain.llm import pii as P

# The contract's expressions as they stand.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(ds):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(ds))) % 10 == 0


def brute(text):
    out = []
    for no, (kind, rx) in enumerate(PLAIN.items()):
        for m in re.finditer(rx, text or ""):
            ds = [int(c) for c in m[0] if c in "0123456789"]
            ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                  "card": lambda: 12 <= len(ds) <= 19 and luhn(ds), "phone": lambda: 9 <= len(ds) <= 15}[kind]()
            if ok:
                out.append((m.start(), no, kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def odd_texts():
    rng = random.Random(11)
    parts = ["a@b.c", "x.y%z@q-1.de.org", "1.2.3.4", "256.1.1.1", "0255.001.2.3", "4111 1111 1111 1111", "4111-1111",
             "+49 (0)30 123-4567", "+1", "@", ".", "é", "𝄞", " ", "\n", "7", "12", "-", "000000000000", "+12345678",
             "tok_9A8b7C6d", "..", "%", "4111111111111111", "1.1.1.1.1.1.1.1"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(400)]


def base_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = P.entities(df).select("doc_id", P.span_text(F.sort_array(F.transform("base", lambda x: F.struct(
        x["start"].alias("start"), x["no"].alias("no"), x["end"].alias("end"))))).alias("s"))
    return {r.doc_id: r.s for r in rows.collect()}


def test_base_spans_against_the_plain_expressions(spark):
    texts = odd_texts()
    assert base_of(spark, texts) == {i: brute(t) for i, t in enumerate(texts)}


def test_long_and_empty_texts(spark):
    def texts(n):
        return [None, "", "a" * n + "@", "1" * n, "1 " * n, "a@" + "b." * n, "+" * n, "+1" + "(" * n,
                "1.2.3.4 " * (n // 8), "1.2.3." * (n // 6)]

    small = texts(1200)
    got = base_of(spark, small)
    assert got == {i: brute(t) for i, t in enumerate(small)}
    large = texts(120_000)      # the plain expressions would take hours on these
    got = base_of(spark, large)
    assert [got[i] for i in (0, 1, 2, 3, 4, 6, 7)] == [""] * 7
    assert got[5] == f"email:0:{2 * 120_000 + 1}"
    assert got[8] == ",".join(f"ip:{8 * i}:{8 * i + 7}" for i in range(15_000))
    assert len(got[9].split(",")) == 15_000


def test_query_against_the_plain_expressions(spark):
    from tiergrain.llm.registry import op5_pii

    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    for r in op5_pii(spark, d).collect():
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(s.startswith(f"{k}:") for s in want.split(",")) for k in PLAIN]
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))


def test_patterns_find_unseen_identifiers(spark):
    rng = random.Random(4)
    words = "alpha beta gamma delta epsilon the of and".split()

    def filler():
        return " ".join(rng.choice(words) for _ in range(12))

    texts = [f"{filler()} reach me: user{i}@mail{i}.example.org {filler()}" for i in range(6)]
    texts += [f"{filler()} call desk at +49 30 1234{i:03d}9 {filler()}" for i in range(6)]
    texts += [f"{filler()} of the 10.0.{i}.7 {filler()} of the end" for i in range(6)]
    unseen = f"{filler()} call desk at 030/7788990 {filler()} of the QX-884422 {filler()}"
    texts += [unseen, "reach me: nobody", filler(), None, ""]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, key string")
    got = {r.doc_id: r for r in P.personal_data(df).collect()}
    at = unseen.index("030/7788990")
    assert [(x.start, x.end) for x in got[18].added] == [(at, at + 11)]
    assert sum(len(r.added) for r in got.values()) == 1
    assert got[21].base == [] == got[22].base


def test_repeated_rows_null_ids_and_empty_table(spark):
    t = "mail a@b.de now"
    df = spark.createDataFrame([(1, t), (1, t), (1, "x"), (None, t), (None, None)], "doc_id long, text string")
    got = P.personal_data(df).collect()
    assert sorted((r.doc_id or 0, len(r.base)) for r in got) == [(0, 0), (0, 1), (1, 0), (1, 1), (1, 1)]
    assert P.personal_data(df.limit(0)).count() == 0


def test_redaction(spark):
    t = "mail a@b.de, ip 1.2.3.4!"
    df = spark.createDataFrame([(1, t), (2, "none")], "doc_id long, text string")
    rows = P.personal_data(df).join(df, "doc_id").select("doc_id", P.redact(F.col("text"), F.col("base")).alias("r"))
    assert {r.doc_id: r.r for r in rows.collect()} == {1: "mail [EMAIL], ip [IP]!", 2: "none"}
