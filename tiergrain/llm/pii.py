"""Operator 5: personal data by patterns and bootstrapped contexts (native).

**Base entities.** Emails, IPv4 addresses, payment cards and phone numbers are
found with the contract's regular expressions. They are written with
possessive parts and start guards, which keeps their matches and makes them
linear on long runs. Offsets come from the gaps between the matches
(``split`` by the same expression), added up in blocks. Matches that fail the
numeric test (parts over 255, Luhn, digit count) are dropped.

**Bootstrapping.** Every base entity is a seed. Its lexical pattern is the two
words before it. Other identifier-like strings (six or more characters, four
or more digits) are candidate instances with patterns of their own. A pattern's
score is the trust in the instances it introduces, over *all* its occurrences
in the corpus, whatever follows, so ordinary word pairs score low. An
instance's trust is one minus the chance that all its accepted patterns are
wrong; seeds have trust one. Spark repeats pattern scoring and instance scoring
over the pattern-instance graph for a fixed number of rounds, each written to
the shared folder. Candidates that reach the threshold and do not overlap a
base entity become spans of kind ``id``.

Everything is DataFrame functions. Documents are read twice: for entities and
candidates, and to count the patterns that at least ``MIN_SUPPORT`` distinct
strings follow. The second pass tests each word pair against a bit field of
fixed size before anything is exploded further, then counts exactly.

Defined results: null or empty text has no spans; equal rows get equal spans;
a null id is kept; offsets are code points; a pattern's two
words lie within the 100 characters before an entity and after the last match; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiergrain.llm.common import id_text, stored

KINDS = ("email", "ip", "card", "phone", "id")     # the last is the method's own
ROUNDS = 3
MIN_SUPPORT = 3        # distinct trusted instances a pattern needs
MIN_PATTERN = 0.5      # accepted pattern
MIN_TRUST = 0.8        # accepted instance
FIELD_BITS = 1 << 18   # bit field of pattern hashes: 32 KB, whatever the data

# The contract's expressions, each as (expression, a string that must occur).
_LOCAL = r"A-Za-z0-9._%+-"
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_RUN = r"A-Za-z0-9_%/.+-"
CANDIDATE = rf"(?<![{_RUN}])(?=(?:[A-Za-z_%/.+-]*+[0-9]){{4}})[{_RUN}]{{6,}}+"
SPACE = r"[\x20\x09-\x0D]+"
_PIECE = "array<struct<gap:bigint,value:string,pattern:string>>"
_SPAN = "array<struct<start:bigint,end:bigint,value:string,pattern:string>>"
_BLOCK = 256


def _pattern(gap: Column, first: Column) -> Column:
    """The two whole words at the end of a gap, in lower case; null if there are none.

    What stands between the last space and the entity (a quote, a bracket) is
    skipped. The first of the two words must have a space or the text's start
    before it.
    """
    whole = F.concat(F.when(first, F.lit(" ")).otherwise(F.lit("")), gap)
    return F.element_at(F.transform(F.array(F.split(whole, SPACE)), lambda w: F.when(
        F.size(w) >= 4,
        F.lower(F.concat_ws(" ", F.get(w, F.size(w) - 3), F.get(w, F.size(w) - 2))))), 1)


def _pieces(text: Column, expression: str, guard: Column) -> Column:
    """(gap before, match, pattern) of all matches, or an empty array."""
    gaps = F.split(text, expression, -1)
    found = F.regexp_extract_all(text, F.lit(expression), F.lit(0))
    pairs = F.filter(F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("g"), m.alias("value"))),
                     lambda x: x["value"].isNotNull())
    pieces = F.transform(pairs, lambda x, i: F.struct(
        F.length(x["g"]).cast("long").alias("gap"), x["value"].alias("value"),
        _pattern(x["g"], i == 0).alias("pattern")))
    return F.when(guard, pieces).otherwise(F.array().cast(_PIECE))


def _located(pieces: Column) -> Column:
    """Spans from gaps and matches: running offsets, block by block.

    ``pieces`` must be a plain column. Appending to one array would copy it for
    every match; blocks keep that small for texts with very many matches.
    """
    none = F.array().cast(_SPAN)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(pieces, b * _BLOCK + 1, _BLOCK))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["value"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"), x["value"].alias("value"),
            x["pattern"].alias("pattern")))).alias("out"))

    def add_block(acc: Column, block: Column) -> Column:
        done = F.aggregate(block, F.struct(acc["at"].alias("at"), none.alias("out")), add)
        return F.struct(F.element_at(done["out"], -1)["end"].alias("at"),
                        F.concat(acc["out"], F.array(done["out"])).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out"))
    return F.when(F.size(pieces) > 0, F.flatten(F.aggregate(blocks, start, add_block)["out"])).otherwise(none)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(c: Column) -> Column:
    digits = F.reverse(_digits(c))
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, F.substr(digits, i, F.lit(1)).cast("int")).otherwise(
            F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                         F.substr(digits, i, F.lit(1)).cast("int") + 1)))
    return total % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        part = "0*+(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return v.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        n = F.length(_digits(v))
        return F.when(n.between(12, 19), _luhn(v)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(v)).between(9, 15)
    return F.lit(True)


def entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``key``, ``base`` and ``candidates`` of every row.

    ``base`` spans carry their kind; both carry the text found and the two words
    before it. ``key`` tells texts of one id apart.
    """
    t = F.col("text")
    digit = t.rlike("[0-9]")
    rows = id_text(docs, id_col, text_col).select(
        "doc_id", "text", F.xxhash64("text").alias("key"),
        _pieces(t, EMAIL, t.contains("@")).alias("p_email"), _pieces(t, IP, digit).alias("p_ip"),
        _pieces(t, CARD, digit).alias("p_card"), _pieces(t, PHONE, t.contains("+")).alias("p_phone"),
        _pieces(t, CANDIDATE, digit).alias("p_id"))
    rows = rows.select("doc_id", "key", *[_located(F.col(f"p_{k}")).alias(f"s_{k}") for k in KINDS])

    def spans(kind: str) -> Column:
        found = F.filter(F.col(f"s_{kind}"), lambda x: _valid(kind, x["value"]))
        return F.transform(found, lambda x: F.struct(
            x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("no"), x["end"].alias("end"),
            x["value"].alias("value"), x["pattern"].alias("pattern")))

    def trimmed(x: Column) -> Column:
        v = F.regexp_replace(x["value"], r"[_%/.+-]+$", "")
        return F.struct(x["start"].alias("start"), (x["start"] + F.length(v)).alias("end"),
                        v.alias("value"), x["pattern"].alias("pattern"))

    candidates = F.filter(F.transform(F.col("s_id"), trimmed),
                          lambda x: (F.length(x["value"]) >= 6) & x["pattern"].isNotNull())
    return rows.select("doc_id", "key", F.concat(*[spans(k) for k in KINDS[:-1]]).alias("base"),
                       candidates.alias("candidates"))


def _pattern_totals(docs: DataFrame, patterns: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``pattern``, ``total``: how often each pattern occurs before any word.

    The hashes of the wanted patterns make a bit field of ``FIELD_BITS`` bits, at
    most 4,096 longs on the driver, whatever the data. Word pairs outside it are
    dropped where they are read.
    """
    slot = F.pmod(F.xxhash64("pattern"), F.lit(FIELD_BITS))
    words = patterns.select(F.floor(slot / 64).cast("int").alias("i"),
                            F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int")).alias("b"))
    field = [0] * (FIELD_BITS // 64)
    for r in words.groupBy("i").agg(F.bit_or("b").alias("b")).collect():
        field[r.i] = r.b
    w = F.split(F.trim(F.regexp_replace(F.lower("text"), SPACE, " ")), " ")
    rows = id_text(docs, id_col, text_col).select(w.alias("w")).where(F.size("w") > 2)
    pairs = rows.select("w", F.explode(F.sequence(F.lit(1), F.size("w") - 2)).alias("i")).select(
        F.concat_ws(" ", F.element_at("w", F.col("i")), F.element_at("w", F.col("i") + 1)).alias("pattern"))
    bits = F.split(F.lit(",".join(map(str, field))), ",").cast("array<bigint>")      # folded to one literal
    hit = F.getbit(F.element_at(bits, (F.floor(slot / 64) + 1).cast("int")), (slot % 64).cast("int")) == 1
    counted = pairs.where(hit).groupBy("pattern").agg(F.count("*").alias("total"))
    return counted.join(patterns.select("pattern"), "pattern")      # a semi-join would be pushed below the count


def bootstrap(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Accepted ``pattern``s and trusted ``value``s after some rounds of scoring."""
    base = found.select(F.explode("base").alias("x")).select("x.pattern", "x.value", F.lit(1).alias("seed"))
    other = found.select(F.explode("candidates").alias("x")).select("x.pattern", "x.value", F.lit(0).alias("seed"))
    graph = stored(base.unionByName(other).where(F.col("pattern").isNotNull())
                   .groupBy("pattern", "value").agg(F.count("*").alias("n"), F.max("seed").alias("seed")), "pii-graph")
    wide = stored(graph.groupBy("pattern").agg(F.count("*").alias("v")).where(F.col("v") >= MIN_SUPPORT)
                  .select("pattern"), "pii-patterns")
    totals = _pattern_totals(docs, wide, id_col, text_col)
    graph = stored(graph.join(totals, "pattern"), "pii-scored-graph")
    trust = graph.where(F.col("seed") == 1).select("value").distinct().withColumn("trust", F.lit(1.0))
    patterns = None
    for i in range(rounds):
        scored = graph.join(trust, "value")
        patterns = scored.groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("trust")) / F.max("total")).alias("score"),
            F.sum(F.when(F.col("trust") >= MIN_TRUST, 1).otherwise(0)).alias("support"))
        patterns = stored(patterns.where((F.col("score") >= MIN_PATTERN) & (F.col("support") >= MIN_SUPPORT))
                          .select("pattern", F.least("score", F.lit(1.0)).alias("score")), f"pii-round-{i}")
        reach = graph.join(patterns, "pattern").groupBy("value").agg(
            F.max("seed").alias("seed"), F.sum(F.log1p(-F.least("score", F.lit(1 - 1e-12)))).alias("wrong"))
        seeds = graph.where(F.col("seed") == 1).select("value").distinct()
        reached = reach.where(F.col("seed") == 0).select("value", (1 - F.exp("wrong")).alias("trust"))
        trust = stored(seeds.withColumn("trust", F.lit(1.0)).unionByName(
            reached.join(seeds, "value", "left_anti")), f"pii-trust-{i}")
    return patterns, trust


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, ``key``, ``base`` and ``added`` spans (start, no, end) of every row.

    ``no`` is the kind's place in ``KINDS``; spans are sorted by start, then kind.
    """
    found = stored(entities(docs, id_col, text_col), "pii-entities")
    patterns, trust = bootstrap(docs, found, id_col, text_col, rounds)
    trusted = trust.where(F.col("trust") >= MIN_TRUST).select("value")
    own = found.where(F.size("candidates") > 0).select("doc_id", "key", "candidates").distinct()
    extra = (own.select("doc_id", "key", F.explode("candidates").alias("x"))
             .select("doc_id", "key", "x.start", "x.end", "x.value", "x.pattern")
             .join(patterns.select("pattern"), "pattern", "left_semi").join(trusted, "value", "left_semi")
             .groupBy("doc_id", "key").agg(F.collect_set(F.struct("start", "end")).alias("ids")))
    # the key makes null ids and repeated ids safe to join on
    rows = found.select("doc_id", "key", "base").alias("d").join(
        extra.alias("e"), F.col("d.doc_id").eqNullSafe(F.col("e.doc_id")) & (F.col("d.key") == F.col("e.key")), "left")
    plain = F.sort_array(F.transform("d.base", lambda x: F.struct(
        x["start"].alias("start"), x["no"].alias("no"), x["end"].alias("end"))))
    ids = F.coalesce(F.col("e.ids"), F.array().cast("array<struct<start:bigint,end:bigint>>"))
    added = F.transform(
        F.filter(ids, lambda c: ~F.exists("d.base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))),
        lambda c: F.struct(c["start"].alias("start"), F.lit(KINDS.index("id")).alias("no"), c["end"].alias("end")))
    return rows.select("d.doc_id", "d.key", plain.alias("base"), F.sort_array(added).alias("added"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(kinds, x["no"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every sorted span replaced by ``[KIND]``; overlapping spans merge into the first."""
    kinds = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substr(text, (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int"))
        fresh = F.concat(acc["out"], F.array(gap, F.element_at(kinds, x["no"] + 1)))
        return F.when(x["start"] >= acc["at"], F.struct(x["end"].alias("at"), fresh.alias("out"))).otherwise(
            F.struct(F.greatest(acc["at"], x["end"]).alias("at"), acc["out"].alias("out")))

    def finish(acc: Column) -> Column:
        return F.array_join(F.concat(acc["out"], F.array(F.substr(
            text, (acc["at"] + 1).cast("int"), F.length(text)))), "")

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)
