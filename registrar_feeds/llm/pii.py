"""Personal data by bootstrapped contextual extraction, in SQL functions only.

One pass over the texts extracts, for each of four kinds, the leftmost
non-overlapping matches of a fixed pattern, and all other identifier-like
tokens (candidates), each with the words around it.  Matches that pass their
kind's check are seed entities.  Two kinds of seeds are found among the
candidates: account numbers (IBAN, by their check digits) and secrets (long
tokens of letters and digits after a word such as ``key`` or ``token`` and a
mark).  The words left and right of an occurrence are its lexical patterns;
patterns and instances form a graph, held as edges.  Each round scores a pattern
for a kind by the known instances among all it occurs with, accepts the confident
ones, and scores instances by the accepted patterns they occur in (noisy or);
confident instances of a plausible form are known in the next round, and a round
that changes nothing is the last.  What is known at the end and no seed is
reported as well, wherever it stands clear of the seeds' spans.

Everything after the first pass moves match-sized rows.  A pattern or instance
that holds a large part of all edges is pre-aggregated; joins on it are plain
equi-joins whose skew Spark splits.  Overlaps are found with window functions
over one document, never as pairs.

Defined cases: a null or empty text has no spans; equal rows are separate
documents; matches that fail their check are dropped and not tried again from
a later place; an instance that two kinds reach with one score has the kind last
in the alphabet; a very long text is read whole, in one row; an empty table gives
an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registrar_feeds.llm.common import kept, table, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: Kinds of seeds beside the base ones.
MORE_KINDS = ("iban", "secret")
#: Bootstrapping: most rounds, least confidence of patterns and instances, least
#: confidence of the pattern of a single word, and least number of known instances
#: a pattern must occur with.
ROUNDS = 8
CONFIDENCE = 0.75
WORD_CONFIDENCE = 0.9
SUPPORT = 4
#: Characters around an occurrence in which its context words are looked for.
CONTEXT = 48

# The patterns as specified, with possessive quantifiers and run starts: they
# match the same spans, in time linear in the text and without recursion.
_PATTERN = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "other": r"(?<![A-Za-z0-9._%+@-])(?:[+(]?[0-9][0-9().-]*+(?:\x20[0-9(][0-9().-]*+)*+(?![A-Za-z@_%+])"
             r"|(?=[A-Za-z._%+-]*+[0-9@])[A-Za-z0-9._%+@-]++)",
}
_MAY = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "other": lambda t: t.rlike(r"[0-9@]"),
}


def _luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled (less 9 above 9)."""
    places = F.sequence(F.lit(1), F.length(digits))
    value = F.transform(places, lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int") * (2 - i % 2))
    return F.aggregate(value, F.lit(0), lambda s, v: s + v - F.when(v > 9, 9).otherwise(0)) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    return (F.when(kind == "email", True)
            .when(kind == "ip", value.rlike(rf"^{part}(?:\.{part}){{3}}$"))
            .when(kind == "card", F.when(n.between(13, 19), _luhn(digits)).otherwise(False))
            .when(kind == "phone", n.between(9, 15))
            .otherwise(True))


#: What a secret stands after, and its form: 16 characters or more with letters
#: and three digits at least.
_SECRET_AFTER = (r"(?i)(?:key|token|secret|password|passwd|pwd|passphrase|credential|credentials|bearer)"
                 r"[\"']?\s*(?:[:=]+>?|\bis\b)?\s*[\"'`(<]*$")
_SECRET = r"^(?=(?:[^0-9]*[0-9]){3})(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9_+%.-]{16,}$"


def _iban(value: Column) -> Column:
    """Check digits: the number with its first four characters last is 1 modulo 97."""
    moved = F.filter(F.split(F.concat(F.substring(value, 5, 30), F.substring(value, 1, 4)), ""), lambda c: c != "")
    rest = F.aggregate(moved, F.lit(0), lambda s, c: F.when(c <= "9", s * 10 + F.ascii(c) - 48).otherwise(s * 100 + F.ascii(c) - 55) % 97)
    return F.when(value.rlike(r"^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"), rest == 1).otherwise(False)


def _seed_kind(value: Column, left: Column) -> Column:
    """The kind of a candidate that is a seed, else ``other``."""
    return (F.when(_iban(value), "iban")
            .when(value.rlike(_SECRET) & ~F.contains(value, F.lit("@")) & left.rlike(_SECRET_AFTER), "secret")
            .otherwise("other"))


def _plausible(kind: Column, value: Column) -> Column:
    """Forms that an instance found by its contexts may have."""
    return (F.when(kind == "email", value.rlike(r"^[^@]+@[^@]+$"))
            .when(kind == "ip", value.rlike(r"^[0-9]{1,3}+(?:\.[0-9]{1,3}+){2,}+$"))
            .when(kind == "card", value.rlike(r"^[0-9]{12,19}$"))
            .when(kind == "phone", value.rlike(r"^\+?[0-9.]{7,17}$"))
            .when(kind == "iban", value.rlike(r"^[a-z]{2}[0-9]{2}[a-z0-9]{11,30}$"))
            .when(kind == "secret", value.rlike(_SECRET)))


def occurrences(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows (__uid, doc_id), and the valid matches and the candidates as
    rows: __uid, kind, start, end (code points, end exclusive), value, left,
    right (the text around)."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("__uid"),
                       text_or_empty(docs).alias("__text"))
    none = F.array().cast("array<string>")
    found = rows.select("*", *[
        F.when(_MAY[k](F.col("__text")), F.regexp_extract_all("__text", F.lit(p), F.lit(0))).otherwise(none).alias(f"__m_{k}")
        for k, p in _PATTERN.items()])
    apart = found.select("doc_id", "__uid", *[f"__m_{k}" for k in _PATTERN], *[
        F.when(F.size(f"__m_{k}") > 0, F.split("__text", p, -1)).otherwise(none).alias(f"__g_{k}")
        for k, p in _PATTERN.items()])

    def placed(k: str) -> Column:
        gaps = F.col(f"__g_{k}")
        return F.transform(F.col(f"__m_{k}"), lambda v, i: F.struct(
            F.lit(k).alias("kind"), i.alias("i"), v.alias("value"), F.length(gaps[i]).alias("gap"),
            F.right(gaps[i], F.lit(CONTEXT)).alias("left"), F.left(gaps[i + 1], F.lit(CONTEXT)).alias("right")))

    held = kept(apart.select("doc_id", "__uid", F.concat(*[placed(k) for k in _PATTERN]).alias("__all")), "pii-matches")
    each = held.where(F.size("__all") > 0).select("__uid", F.explode("__all").alias("o")).select("__uid", "o.*")
    before = Window.partitionBy("__uid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("value")).over(before)
    spans = (each.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))
             .where(_valid(F.col("kind"), F.col("value"))))
    # candidates that touch a seed's span are no further entities
    seed = F.col("kind") != "other"
    doc = Window.partitionBy("__uid").orderBy("start")
    past = F.max(F.when(seed, F.col("end"))).over(doc.rangeBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(seed, F.col("start"))).over(doc.rangeBetween(0, Window.unboundedFollowing))
    spans = (spans.withColumn("__past", past).withColumn("__ahead", ahead)
             .where(seed | (F.coalesce(F.col("__past") <= F.col("start"), F.lit(True))
                            & F.coalesce(F.col("__ahead") >= F.col("end"), F.lit(True))))
             .select("__uid", "kind", "start", "end", "value", "left", "right"))
    # a candidate ends before the marks of its sentence
    lead, core = F.regexp_extract("value", r"^[.,]*", 0), F.regexp_replace("value", r"^[.,]+|(?<![.,])[.,]++$", "")
    spans = spans.select("__uid", "kind", F.when(seed, F.col("start")).otherwise(F.col("start") + F.length(lead)).alias("start"),
                         "end", F.when(seed, F.col("value")).otherwise(core).alias("value"), "left", "right")
    spans = spans.where(F.length("value") > 0).select(
        "__uid", F.when(seed, F.col("kind")).otherwise(_seed_kind(F.col("value"), F.col("left"))).alias("kind"), "start",
        F.when(seed, F.col("end")).otherwise(F.col("start") + F.length("value")).alias("end"), "value", "left", "right")
    return held.select("__uid", "doc_id"), kept(spans, "pii-spans")


def _instance(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(value), r"[\x20()-]", ""), r"^[.,]+|(?<![.,])[.,]++$", "")


def edges(spans: DataFrame) -> DataFrame:
    """Distinct (pattern, instance): patterns are the two words before, the
    word before, the word before with its mark (as in ``tel:`` or ``token = "``),
    and the words on both sides."""
    left, right = F.lower("left"), F.lower("right")
    l2 = F.regexp_extract(left, r"(\S+\s+\S+)\s*$", 1)
    l1 = F.regexp_extract(left, r"(\S+)\s*$", 1)
    r1 = F.regexp_extract(right, r"^\s*(\S+)", 1)
    word = F.regexp_extract(left, r"(\p{L}[\p{L}0-9_-]*)[\s\"'`(<]*$", 1)
    marked = F.regexp_replace(F.regexp_extract(left, r"(\p{L}[\p{L}0-9_.-]*[\"']?\s*[:=#]+>?[\s\"'`(<]*)$", 1), r"[\s\"'`(<]", "")
    patterns = F.array(F.when(l2 != "", F.concat(F.lit("2:"), F.regexp_replace(l2, r"\s+", " "))),
                       F.when(F.length(word) > 1, F.concat(F.lit("1:"), word)),
                       F.when(marked != "", F.concat(F.lit("m:"), marked)),
                       F.when((l1 != "") & (r1 != ""), F.concat(F.lit("b:"), l1, F.lit(" _ "), r1)))
    return (spans.select(_instance(F.col("value")).alias("instance"), F.explode(F.array_compact(patterns)).alias("pattern"))
            .distinct())


def bootstrap(spans: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, support: int = SUPPORT,
              word_confidence: float = WORD_CONFIDENCE) -> DataFrame:
    """(instance, kind) of what the patterns discover, and of the account numbers
    and secrets that are seeds: they are the same ones in any other place."""
    graph = kept(edges(spans), "pii-edges")
    totals = kept(graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support), "pii-totals")
    seeds = kept(spans.where("kind <> 'other'").select(_instance(F.col("value")).alias("instance"), "kind").distinct()
                 .withColumn("score", F.lit(1.0)), "pii-seeds")
    least = F.when(F.col("pattern").startswith("1:"), F.lit(word_confidence)).otherwise(F.lit(confidence))
    known, new, before = seeds, None, (0, None)
    for _ in range(rounds):
        scored = (graph.join(known, "instance").groupBy("pattern", "kind")
                  .agg(F.sum("score").alias("hits"), F.count(F.lit(1)).alias("known"))
                  .join(totals, "pattern")
                  .withColumn("confidence", F.col("hits") / (F.col("n") + 1))
                  .where((F.col("confidence") >= least) & (F.col("known") >= support)))
        reached = (graph.join(scored.select("pattern", "kind", "confidence"), "pattern")
                   .where(_plausible(F.col("kind"), F.col("instance")))
                   .groupBy("instance", "kind")
                   .agg((1 - F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(0.999)))))).alias("score"))
                   .where(F.col("score") >= confidence)
                   .join(seeds.select("instance").distinct(), "instance", "left_anti"))
        best = reached.groupBy("instance").agg(F.max(F.struct("score", "kind")).alias("b"))
        new = kept(best.select("instance", "b.kind", "b.score"), "pii-known")
        after = tuple(new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("instance", "kind").cast("decimal(38,0)"))).first())
        if after == before:
            break
        known, before = seeds.unionByName(new), after
    own = seeds.where(F.col("kind").isin(*MORE_KINDS)).groupBy("instance").agg(F.max("kind").alias("kind"))
    return own if new is None else own.unionByName(new.select("instance", "kind"))


def find_pii(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_<kind> (seeds of the base kinds), base_sha256,
    spans (kind:start:end by kind, then start), n_iban and n_secret (spans of these
    kinds) and n_found (all spans beside the base ones)."""
    rows, spans = occurrences(docs)
    found = bootstrap(spans, **options)
    more = (spans.where("kind = 'other'").drop("kind").withColumn("instance", _instance(F.col("value")))
            .join(found, "instance").select("__uid", "kind", "start", "end", F.lit(False).alias("base")))
    every = (spans.where("kind <> 'other'").select("__uid", "kind", "start", "end", F.col("kind").isin(*KINDS).alias("base"))
             .unionByName(more))
    kinds = (*KINDS, *MORE_KINDS)
    rank = reduce(lambda c, i: c.when(F.col("kind") == kinds[i], i), range(1, len(kinds)), F.when(F.col("kind") == kinds[0], 0))
    per = every.groupBy("__uid").agg(
        F.sort_array(F.collect_list(F.struct(rank.alias("k"), "start", "end", "kind", "base"))).alias("s"))

    def joined(spans_: Column) -> Column:
        return F.concat_ws(",", F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    base = F.filter("s", lambda s: s["base"])

    def count(kind: str, among: Column) -> Column:
        return F.coalesce(F.size(F.filter(among, lambda s: s["kind"] == kind)), F.lit(0)).cast("long")

    return rows.join(per, "__uid", "left").select(
        "doc_id",
        *[count(k, base).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce(joined(base), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(joined(F.col("s")), F.lit("")).alias("spans"),
        *[count(k, F.col("s")).alias(f"n_{k}") for k in MORE_KINDS],
        F.coalesce(F.size("s") - F.size(base), F.lit(0)).cast("long").alias("n_found"))


def op1_pii(spark, sf_dir):
    return find_pii(table(spark, sf_dir, "documents"))
