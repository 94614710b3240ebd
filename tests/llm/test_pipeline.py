import hashlib

import corpus_pipeline as CP
import public_tokenizers as P
from test_pii import brute as brute_pii
from test_simhash import brute_components, brute_fp, signed

from tiergrain.llm import decontaminate as D
from tiergrain.llm import toxicity as tox
from tiergrain.llm.byte_bpe import BytePairCodec, read_ranks

DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DIR}/documents.parquet")
            .select("doc_id", "text", "lang", "source", "n_chars").collect()]
    t = rows[0][1]
    rows += [(None, None, None, None, None), (None, None, "x", None, 3), (None, t, "x", "s", 1), rows[3], rows[3],
             (5000, "only here + once: mail a@b.org or 10.0.0.1", "en", "s", 42), (5001, "", "en", "s", 0)]
    return rows


def test_filters_against_plain_code(spark):
    rows = documents(spark)
    docs = spark.createDataFrame(rows, SCHEMA)
    model = tox.fit(docs, spark.read.parquet(f"{DIR}/labels.parquet"))
    want = [r for r in rows if model.probabilities(r[1] or "")[0] < 0.5]
    assert rows_of(CP.toxicity(spark, docs, DIR)) == sorted(want, key=str)

    fp = {r[1]: signed(brute_fp(r[1])) for r in rows}
    comp = brute_components([(signed(f), signed(f)) for f in fp.values()])
    got = rows_of(CP.near_duplicate(spark, docs, DIR))
    groups = {}
    for r in rows:
        groups.setdefault(comp[fp[r[1]]], []).append(r)
    assert len(got) == len(groups)
    for r in got:
        ids = [m[0] for m in groups[comp[fp[r[1]]]] if m[0] is not None]
        assert r[0] == min(ids, default=None)

    items = [D.tokens(r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    out = rows_of(CP.decontamination(spark, docs, DIR))
    dirty = [r for r in rows if any(f" {' '.join(i)} " in f" {' '.join(D.tokens(r[1] or ''))} " for i in items)]
    assert dirty and out == sorted((r for r in rows if r not in dirty), key=str)


def test_redaction_and_bpe_against_plain_code(spark):
    rows = documents(spark)
    docs = spark.createDataFrame(rows, SCHEMA)
    out = {(r[0], r[2], r[3]): r for r in rows_of(CP.redaction(spark, docs, DIR))}
    for r in rows:
        text = r[1]
        if text is not None:
            at, parts = 0, []
            spans = sorted((int(a), ["email", "ip", "card", "phone"].index(k), int(z), k)
                           for k, a, z in (s.split(":") for s in brute_pii(text).split(",") if s))
            for a, _, z, kind in spans:
                if a >= at:
                    parts += [text[at:a], f"[{kind.upper()}]"]
                at = max(at, z)
            text = "".join(parts) + text[at:]
        assert out[(r[0], r[2], r[3])][1] == text and out[(r[0], r[2], r[3])][4] == (None if text is None else len(text))
    assert "[EMAIL] or [IP]" in out[(5000, "en", "s")][1]
    codec = BytePairCodec(read_ranks(P.path(CP.VOCABULARY)), P.PATTERN)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = sorted(((r[0], len(p := codec.encode_packed(r[1] or "")) // 4, sha(p), sha((r[1] or "").encode()))
                   for r in rows), key=str)
    assert rows_of(CP.bpe(spark, docs, DIR)) == want


def test_whole_run_and_empty_table(spark):
    assert [n for n, _ in CP.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "bpe"]
    out = CP.run(spark, DIR)
    n = spark.read.parquet(f"{DIR}/documents.parquet").count()
    assert 0.5 * n < out.count() < n
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in CP.STAGES:
        assert stage(spark, docs, DIR).count() == 0


def test_stages_keep_columns_with_the_stages_own_names(spark):
    clash = ("d_key", "d_id", "d_spans", "key", "root", "n", "m", "fp", "base", "id", "toxic", "no_id")
    rows = documents(spark)
    docs = spark.createDataFrame([(*r, *(f"{c}{i}" for c in clash)) for i, r in enumerate(rows)],
                                 SCHEMA + "".join(f", {c} string" for c in clash))
    docs = docs.unionByName(docs.where("doc_id = 5000"))
    for name, stage in CP.STAGES[:-1]:
        out = stage(spark, docs, DIR)
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert len({r[c].removeprefix(c) for c in clash}) == 1
    assert CP.bpe(spark, docs, DIR).count() == len(rows) + 1
