import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from tiergrain.llm import decontaminate as D
from tiergrain.llm.common import may_be_in


def brute(docs, items):
    """All diagonals of all pairs, each verified."""
    best = {}
    for d, t in docs:
        w = D.tokens(t or "")
        for i, it in items:
            q = D.tokens(it or "")
            for g in range(-len(q) + 1, len(w)):
                o = D.overlap(w, q, g) if w and q else None
                if o:
                    k = (d, i, t)
                    rank = (o[2], -o[1], -o[0])
                    best[k] = max(best.get(k, rank), rank)
    return sorted(((d, i, -r[2], -r[1], r[0]) for (d, i, _), r in best.items()), key=str)


def got(spark, docs, items):
    a = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id", "2 as seed")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as key", "2 as doc_id")
    return sorted(((r.doc_id, r.item_id, r.start, r.n_tokens, r.n_equal) for r in D.find_overlaps(a, b).collect()),
                  key=str)


def test_masks_hit_every_pair_of_substitutions():
    for bad in itertools.combinations(range(D.MIN_TOKENS), 2):
        assert any(not {b - o for b in bad} & set(m) for m in D.MASKS for o in range(D.MIN_TOKENS - m[-1]))


def test_best_stretch():
    for bits in itertools.product([False, True], repeat=7):
        e = np.array(bits)
        a, z = D.best_stretch(e)
        score = lambda x, y: sum(1 if v else D.MISMATCH for v in e[x:y])
        assert score(a, z) == max(score(x, y) for x in range(7) for y in range(x + 1, 8))


def test_against_all_diagonals(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(200)] + ["the", "of", "é"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 7, 8, 12, 13, 14, 30, 60])))) for i in range(25)]
    items += [(90, None), (91, ""), (92, items[0][1])]
    docs = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(0, 4)):
            part = rng.choice(items)[1]
            part = (part or "").split() if rng.random() < 0.6 else [rng.choice(vocab) for _ in range(20)]
            part = part[rng.randint(0, 3):]
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                if part:
                    part[rng.randrange(len(part))] = "swapped"
            words += part
        docs.append((i, ", ".join(words).upper()))
    docs += [(70, None), (71, ""), (3, docs[3][1]), (None, docs[4][1])]
    found, want = got(spark, docs, items), brute(docs, items)
    # lossless for whole short items and up to 2 substitutions in 13 tokens; never a false overlap
    sure = [w for w in want if w[4] == w[3] or w[3] - w[4] <= 2 and w[3] >= D.MIN_TOKENS]
    plain = [f for f in set(found)]
    assert set(plain) <= set(want) | {f for f in plain if any(f[:2] == w[:2] for w in want)}
    assert set(w[:2] for w in sure) <= set(f[:2] for f in found) and len(sure) > 20


def test_query_finds_every_whole_item(spark):
    from tiergrain.llm.registry import op2_decontaminate

    d = "/root/testdata/sf0.01"
    docs = [(r.doc_id, D.tokens(r.text)) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    items = [(r.item_id, D.tokens(r.text)) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    text = {i: f" {' '.join(w)} " for i, w in docs}
    want = {(i, j) for i, t in text.items() for j, w in items if f" {' '.join(w)} " in t}
    found = op2_decontaminate(spark, d).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and want
    assert all(r.similarity == 1.0 for r in found)


def test_empty_tables(spark):
    one = [(1, "a b c d e f g h i j k l m n o p")]
    assert got(spark, one, []) == [] == got(spark, [], one)
    long = [(1, "x " * 50_000 + one[0][1])]
    assert got(spark, long, one) == [(1, 1, 50_000, 16, 16)]


def plain_overlaps(words, item):
    """The rule read plainly: any stretch of any diagonal, counted token by token."""
    least = min(13, len(item))
    for g in range(-len(item) + 1, len(words)):
        same = [words[g + q] == item[q] for q in range(max(0, -g), min(len(item), len(words) - g))]
        for a in range(len(same)):
            for z in range(a + least, len(same) + 1):
                if 5 * sum(same[a:z]) >= 4 * (z - a):
                    return True
    return False


def test_substituted_copies_against_plain_rule(spark):
    items = [(n, [f"i{n}x{k}" for k in range(n)]) for n in (1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 16, 20)]
    docs, placed = [], {}
    for n, w in items:
        for k in range(3):
            for out in itertools.combinations(range(n), k):
                copy = ["zz" if q in out else t for q, t in enumerate(w)]
                placed[len(docs)] = (n, k)
                docs.append((len(docs), ["before", "it"] + copy + ["after"]))
    item = dict(items)
    want = {(d, placed[d][0]) for d, w in docs if plain_overlaps(w, item[placed[d][0]])}
    found = got(spark, [(d, " ".join(w)) for d, w in docs], [(n, " ".join(w)) for n, w in items])
    assert {f[:2] for f in found} == want
    assert sum(placed[d] == (13, 2) for d, _ in want) == 78 and sum(placed[d] == (8, 1) for d, _ in want) == 8
    assert all(f[3] >= min(13, f[1]) and 5 * f[4] >= 4 * f[3] for f in found)


def test_every_equality_row_against_plain_rule():
    rng = random.Random(9)
    for _ in range(3000):
        n = rng.choice([3, 8, 12, 13, 14, 17, 26, 40, 70])
        share = rng.choice([0.7, 0.78, 0.85])
        item = [f"i{k}" for k in range(n)]
        words = [t if rng.random() < share else "zz" for t in item]
        same = [a == b for a, b in zip(words, item)]
        least = min(13, n)
        plain = any(5 * sum(same[a:z]) >= 4 * (z - a) for a in range(n) for z in range(a + least, n + 1))
        assert (D.overlap(words, item, 0) is not None) == plain


def test_only_texts_that_were_hit_are_shuffled(spark):
    keys = spark.range(2000).select(F.xxhash64("id").alias("key"))
    rows = spark.range(50_000).select("id", F.xxhash64("id").alias("key"))
    kept = rows.where(may_be_in(keys, "key", D.HIT_BITS))
    assert kept.where("id < 2000").count() == 2000 and kept.count() < 2000 + 48_000 * 0.01
    assert rows.where(may_be_in(keys.limit(0), "key", D.HIT_BITS)).count() == 0
