"""Personal data by strict shapes, and by contexts learned from them.

Strict expressions find e-mail and IP addresses, card and phone numbers; those are the seeds. Looser shapes (``LOOSE``) name
what might be an identifier: an address with ``(at)``, digits without a plus sign, a number that fails its check sum. Whether it is one
is told by the words around it, in a graph of contexts and instances:

* An instance is a kind with a string, a context the two words before it, or the word before and the word after
  (lower case, digits as 0). Both are gathered over all documents, an edge once however often it occurs.
* In each round a context of a kind scores ``known / (known + others + unknown / 2 + 1)``: the trust in its instances of this kind,
  the trust in those of other kinds, the instances of this kind that nothing is known of. With ``min_score`` and at least
  ``min_support`` different trusted instances it is trusted itself. A loose instance is then trusted by
  ``1 - product(1 - score)`` over the trusted contexts that hold it; seeds are trusted fully. So new identifiers lend support
  to further contexts.
* After the last round every loose match in a trusted context of its kind becomes a span; of matches that overlap the one in the
  better context stays, then the earlier kind, then the earlier place. Spans of strict shapes always stay.

Contexts with fewer than ``min_support`` instances of any kind can never be trusted and leave the graph before the rounds. Columns and
SQL functions only; every round is a join on instances and a join on contexts and writes its result.

Defined cases: a null or empty text has no spans; white space and punctuation alone make no context words, the ends of a text count as
``^``; rows with equal doc_id and text get the same spans and add nothing to the graph; a null doc_id is a document like any other;
an empty table gives no rows; texts of any length are searched whole; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadwright.llm import tools

KINDS = ("email", "ip", "card", "phone")
ROUNDS, MIN_SUPPORT, MIN_SCORE = 3, 5, 0.7
#: Characters before and after a match in which its context words are looked for, at most up to the next match of the shape.
BEFORE, AFTER = 64, 32
#: Matches of one text that are added up or looked through together.
BLOCK = 128

# Possessive repeats and the look-behinds change no match: they keep the search linear on long runs.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++(?:@|\x20?[(\[]at[)\]]\x20?)[\p{L}\p{N}-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[\p{L}\p{N}-]++)*+",
    "ip": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}|[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![0-9A-Za-z:.])",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9+])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,14}(?![0-9])",
}
#: What a text must hold for a strict and for a loose match of a kind; looked for first, as it is cheaper.
_NEEDS = {"email": ("@", r"@|[(\[]at[)\]]"), "ip": (r"[0-9]\.[0-9]", r"[0-9][.:]|::"), "card": (r"[0-9][\x20-]?[0-9]",) * 2, "phone": (r"\+[0-9]", "[0-9]{2}")}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
_PLACE = "array<struct<start:int,end:int,value:string,before:string,after:string>>"
_SPANS = "array<struct<kind:int,start:int,end:int>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def _places(text: Column, pattern: str, needs: str) -> Column:
    """All matches in order: start and end in code points, value, and what stands before and after it up to the next match.

    The start is the sum of the lengths of the matches and gaps before; it is taken from sums of blocks, so that texts with very many matches
    stay cheap.
    """
    def measured(s: Column) -> Column:
        lens = F.zip_with(s["gaps"], s["hits"], lambda g, h: F.length(g) + F.coalesce(F.length(h), F.lit(0)))
        return _let(F.struct(s["gaps"].alias("gaps"), s["hits"].alias("hits"), lens.alias("lens")), blocked)

    def blocked(s: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), (F.size(s["lens"]) / BLOCK).cast("int")),
                           lambda b: _total(F.slice(s["lens"], b * BLOCK + 1, F.lit(BLOCK))))
        return _let(F.struct(s["gaps"].alias("gaps"), s["hits"].alias("hits"), s["lens"].alias("lens"), sums.alias("sums")), summed)

    def summed(s: Column) -> Column:
        ahead = F.transform(s["sums"], lambda x, b: _total(F.slice(s["sums"], F.lit(1), b)))
        return _let(F.struct(s["gaps"].alias("gaps"), s["hits"].alias("hits"), s["lens"].alias("lens"), ahead.alias("ahead")), located)

    def located(s: Column) -> Column:
        def place(hit: Column, i: Column) -> Column:
            block = (i / BLOCK).cast("int")
            start = F.get(s["ahead"], block) + _total(F.slice(s["lens"], block * BLOCK + 1, i - block * BLOCK)) + F.length(F.get(s["gaps"], i))
            return _let(start.cast("int"), lambda at: F.struct(
                at.alias("start"), (at + F.length(hit)).alias("end"), hit.alias("value"),
                F.substring(F.get(s["gaps"], i), -BEFORE, BEFORE).alias("before"),
                F.substring(F.get(s["gaps"], i + 1), 1, AFTER).alias("after")))

        return F.transform(s["hits"], place)

    found = _let(F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits")), measured)
    return F.when(text.rlike(needs), found).otherwise(F.array().cast(_PLACE))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    size = F.length(digits)

    def worth(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int") * F.when((size - i) % 2 == 1, 2).otherwise(1)
        return F.when(digit > 9, digit - 9).otherwise(digit)

    return F.aggregate(F.transform(F.sequence(F.lit(1), size), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str) -> Callable[[Column], Column]:
    if kind == "ip":
        return lambda x: x["value"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return lambda x: F.when(F.length(_digits(x["value"])).between(16, 19), _luhn(_digits(x["value"]))).otherwise(False)
    if kind == "phone":
        return lambda x: F.length(_digits(x["value"])).between(8, 15)
    return lambda x: F.lit(True)


def _of_kind(number: int) -> Callable[[Column], Column]:
    return lambda x: F.struct(F.lit(number).alias("kind"), x["start"].alias("start"), x["end"].alias("end"))


def _contexts(x: Column) -> Column:
    """The contexts of a match: two words before it; one before and one after."""
    tokens = lambda s: F.regexp_extract_all(
        F.regexp_replace(F.lower(s), r"\p{N}+", "0"), F.lit(r"[\p{L}\p{M}0]+|[^\s\p{L}\p{M}0]+"), F.lit(0))

    def named(s: Column) -> Column:
        last = lambda i: F.coalesce(F.get(s["left"], F.size(s["left"]) - i), F.lit("^"))
        return F.array(F.concat_ws(" ", F.lit("2:"), last(2), last(1)),
                       F.concat_ws(" ", F.lit("1:"), last(1), F.lit("_"), F.coalesce(F.get(s["right"], F.lit(0)), F.lit("^"))))

    return _let(F.struct(tokens(x["before"]).alias("left"), tokens(x["after"]).alias("right")), named)


def _apart_from(spans: Column) -> Callable[[Column], Column]:
    """Whether a match overlaps none of ``spans``, which are looked through by blocks."""
    meets = lambda b, x: (b["start"] < x["end"]) & (x["start"] < b["end"])
    return lambda x: ~F.exists(spans, lambda block: meets(block, x) & F.exists(block["spans"], lambda b: meets(b, x)))


def _blocks(spans: Column) -> Column:
    def block(s: Column) -> Callable[[Column], Column]:
        return lambda b: _let(F.slice(s, b * BLOCK + 1, F.lit(BLOCK)), lambda part: F.struct(
            F.array_min(F.transform(part, lambda x: x["start"])).alias("start"), F.array_max(F.transform(part, lambda x: x["end"])).alias("end"),
            part.alias("spans")))

    return _let(spans, lambda s: F.transform(F.sequence(F.lit(0), (F.size(s) / BLOCK).cast("int")), block(s)))


def places(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), base (spans of strict shapes) and seen: base and loose matches with their contexts."""
    # Each step has a column of its own, so that no lambda works a step out again.
    base = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    for i, kind in enumerate(KINDS):
        base = base.withColumn(f"strict{i}", F.filter(_places(F.col("text"), STRICT[kind], _NEEDS[kind][0]), _valid(kind)))
    spans = F.concat(*[F.transform(f"strict{i}", _of_kind(i)) for i in range(len(KINDS))])
    base = base.withColumn("base", spans)

    def seen(i: int, found: Column, seed: bool) -> Column:
        return F.transform(found, lambda x: F.struct(
            F.lit(i).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"), F.lit(seed).alias("seed"),
            _contexts(x).alias("contexts")))

    def every(blocks: Column) -> Column:
        loose = [F.filter(_places(F.col("text"), LOOSE[kind], _NEEDS[kind][1]), _apart_from(blocks)) for kind in KINDS]
        return F.concat(*[seen(i, F.col(f"strict{i}"), True) for i in range(len(KINDS))], *[seen(i, loose[i], False) for i in range(len(KINDS))])

    return base.select("doc_id", F.xxhash64("text").alias("h"), "base", _let(_blocks(F.col("base")), every).alias("seen"))


def _scored(edges: DataFrame, trust: DataFrame, min_support: int, min_score: float) -> DataFrame:
    """context, kind, score of the trusted contexts."""
    held = edges.join(trust, ["kind", "value"])
    by_kind = held.groupBy("context", "kind").agg(F.sum("trust").alias("known"), F.sum(1 - F.col("trust")).alias("unknown"),
                                                  F.sum(F.when(F.col("trust") >= 0.5, 1).otherwise(0)).alias("support"))
    every = by_kind.groupBy("context").agg(F.sum("known").alias("all_known"))
    score = F.col("known") / (F.col("all_known") + F.col("unknown") / 2 + 1)
    return by_kind.filter(F.col("support") >= min_support).join(every, "context").select("context", "kind", score.alias("score")).filter(
        F.col("score") >= min_score)


def trusted_contexts(seen: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT, min_score: float = MIN_SCORE) -> DataFrame:
    """context, kind, score, learned from matches (kind, value, seed, contexts)."""
    rows = seen.select("kind", "value", "seed", F.explode("contexts").alias("context")).groupBy("context", "kind", "value").agg(
        F.max("seed").alias("seed"))
    rows = tools.materialise(rows, "pii-edges")
    able = rows.groupBy("context", "kind").agg(F.count("*").alias("n")).filter(F.col("n") >= min_support).select("context").distinct()
    edges = tools.materialise(rows.join(able, "context"), "pii-graph")
    instances = edges.groupBy("kind", "value").agg(F.max("seed").alias("seed"))
    trust = tools.materialise(instances.select("kind", "value", F.when(F.col("seed"), 1.0).otherwise(0.0).alias("trust")), "pii-trust")
    graph = edges.select("context", "kind", "value")
    for _ in range(rounds):
        found = _scored(graph, trust, min_support, min_score)
        lent = graph.join(found, ["context", "kind"]).groupBy("kind", "value").agg(
            (1 - F.exp(F.sum(F.log1p(-F.col("score"))))).alias("lent"))
        trust = tools.materialise(instances.join(lent, ["kind", "value"], "left").select(
            "kind", "value", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("lent", F.lit(0.0))).alias("trust")), "pii-trust")
    return tools.materialise(_scored(graph, trust, min_support, min_score), "pii-contexts")


def _apart(found: Column) -> Column:
    """Of spans ordered by worth those that overlap no better one."""
    def after(kept: Column, x: Column) -> Column:
        meets = F.exists(kept, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
        place = F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))
        return F.when(meets, kept).otherwise(F.concat(kept, F.array(place)))

    return F.aggregate(found, F.array().cast(_SPANS), after)


def find(docs: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT, min_score: float = MIN_SCORE) -> DataFrame:
    """doc_id, base and added: arrays of (kind number, start, end), those of base by kind and start."""
    table = tools.materialise(places(docs), "pii-places")
    seen = table.select("doc_id", "h", F.explode("seen").alias("s")).select("doc_id", "h", "s.*")
    contexts = trusted_contexts(seen, rounds, min_support, min_score)
    met = seen.filter("NOT seed").withColumn("context", F.explode("contexts")).join(contexts, ["context", "kind"]).groupBy(
        "doc_id", "h", "kind", "start", "end").agg(F.max("score").alias("score"))
    worth = F.struct((-F.col("score")).alias("worst"), "kind", "start", "end")
    added = met.groupBy("doc_id", "h").agg(F.array_sort(F.collect_list(worth)).alias("found")).select(
        F.col("doc_id").alias("of"), F.col("h").alias("of_h"), _apart(F.col("found")).alias("added"))
    return table.select("doc_id", "h", "base").join(added, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h")), "left").select(
        "doc_id", "base", F.coalesce("added", F.array().cast(_SPANS)).alias("added"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, by kind and start, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def span_facts(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (strict shapes), base_sha256 and spans (all of them)."""
    kinds = F.transform("base", lambda x: x["kind"])
    counts = [F.size(F.filter(kinds, F.lit(i).eqNullSafe)).cast("long").alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return find(docs, **options).select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"),
                                        written(F.concat("base", "added")).alias("spans"))
