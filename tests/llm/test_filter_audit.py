import random
import re
from itertools import permutations

from pyspark.sql import types as T

from tiergrain.llm import filter_audit as A

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("mask", T.StringType())])
LABELS = "doc_id long, quality int, toxic int, n int"


def fails(rows):
    out = []
    for d, t, p in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append("".join(x for x, bad in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search(r"[#$%&*|]", t)),
            d is not None and any((u or "") == t and e is not None and e < d for e, u, _ in rows))) if bad))
    return out


def brute(rows, labels):
    failed = fails(rows)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    out = {}
    for part in {p or "" for _, _, p in rows}:
        own = [(d, f) for (d, _, p), f in zip(rows, failed) if (p or "") == part]
        steps = {}
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                steps[order, step] = [
                    len(left), len(gone), sum(x in f for _, f in own) - len(gone), sum(f == x for _, f in own),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for (order, step), v in steps.items():
            x = order[step - 1]
            out[part, order, step] = (*v, sum(w[1] for (o, s), w in steps.items() if o[s - 1] == x))
    return out


def got(spark, rows, labels):
    docs = spark.createDataFrame([(d, t, p, "clash") for d, t, p in rows], SCHEMA)
    marks = spark.createDataFrame([(*r, 0) for r in labels], LABELS)
    found = A.audit_filters(docs, marks).collect()
    out = {(r[0], r[1], r[2]): tuple(r[3:]) for r in found}
    assert len(out) == len(found)
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(900)}" for _ in range(rng.choice([3, 99, 100, 101, 140]))]
        if rng.random() < 0.3:
            words = words[:20] * (len(words) // 20 + 1)
        text = rng.choice([" ", "\n", "\t "]).join(words)
        if rng.random() < 0.3:
            text = text.upper()
        if rng.random() < 0.3:
            text += rng.choice("#$%&*|")
        rows.append((rng.choice([None, rng.randrange(n)]) if rng.random() < 0.2 else i, text, rng.choice(["a", "b", None])))
    return rows + rng.choices(rows, k=n // 2) + [(n + 1, None, "é"), (n + 2, "", "é"), (None, "", None)]


def test_counts_equal_a_step_by_step_run(spark):
    for seed in (1, 2):
        rows = corpus(seed, 40)
        rows += [(1000 + i, rows[0][1], "a") for i in range(30)]          # a text that many rows share
        rng = random.Random(seed)
        labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d, _, _ in rng.choices(rows, k=60)]
        labels += [(None, 1, 1), (99_999, 1, 1)]
        assert got(spark, rows, labels) == brute(rows, labels)


def test_thresholds_are_exact():
    assert A.text_mask(" ".join(f"w{i}" for i in range(100))) == 0
    assert A.text_mask(" ".join(f"w{i}" for i in range(99))) == 1
    assert A.text_mask(" ".join(f"w{i}" for i in range(80)) + " w0" * 20) == 0
    assert A.text_mask(" ".join(f"w{i}" for i in range(79)) + " w0" * 21) == 2
    assert A.text_mask("") == 1 and A.text_mask("Aé|") == 1 + 4 + 8 and A.text_mask("A123456789") == 1


def test_fields_do_not_run_over():
    many = 1 << 62
    total = many * A.packed_outcomes(0b11111, True, True) + (many - 1) * A.packed_outcomes(0, False, False)
    counts, unique = A.unpacked(total)
    assert counts[:, 0, 1].tolist() == [many] * 120 and counts[:, 1:, 2].min() == many
    assert counts[:, :, 0].min() == counts[:, :, 0].max() == many - 1 and unique.tolist() == [0] * 5


def test_empty_tables_and_one_long_text(spark):
    assert got(spark, [], []) == {}
    rows = [(5, "word " * 400_000, "x")]
    assert got(spark, rows, []) == brute(rows, [])
