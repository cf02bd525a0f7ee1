"""Personal data spans: base patterns, and more spans by weak supervision. DataFrame functions only.

Base spans are the matches of four patterns that pass their check. Patterns are written so that a
search never reads a run of characters twice (possessive repeats; a match starts at the start of a
run or where the last match ended), and give the leftmost non-overlapping matches.

Candidates are all matches of the base patterns, passed or not, and of wider patterns (keys and
passwords, national phone numbers, identity numbers). Four labelers vote on each (yes, no, or no
opinion): the shape check, a gazetteer of issuers, domains and countries, words in the context
before, and the characters around. Expectation-maximisation estimates from the votes alone how
reliable each labeler is and how likely each pattern of votes is a true span (a one-class-or-other
naive Bayes mixture). A logistic regression over votes, kind and length is trained on those
probabilities and decides; a candidate that it accepts, and that no base span overlaps, is added.

Both models work on counts of vote patterns: the table they see is bounded by kinds, votes and
length classes, whatever the corpus. Only that table comes to the driver.

Defined cases: a null text is empty and has no spans; positions are code points, end exclusive; rows
are told apart by content, so repeated rows get the same result each; an empty table, or one
without candidates, adds no spans; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from math import exp, log

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyshelf.llm import shared

_LOCAL = "[A-Za-z0-9._%+-]"
_PART = "(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}))"

#: Patterns in the order in which kinds are listed; the first four are the base kinds.
KINDS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "identity": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "national_phone": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}(?![0-9A-Z])|(?i:password|passwd|secret|token|api[_-]?key)\x20?[=:]\x20?[!-~]++)",
}
BASE = ("email", "ip", "card", "phone")
#: What a text holds if it can hold a match; keeps the other texts out.
MAY_HOLD = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9])",
    "phone": r"\+[0-9]",
    "identity": r"[0-9]-[0-9]{2}-[0-9]",
    "national_phone": r"[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-]",
    "secret": "AKIA|[=:]",
}
# Cues of the gazetteer and of the context, as patterns.
GAZETTEER = {
    "email": r"(?i)@(?:mail|smtp|inbox|gmail|outlook|yahoo|hotmail)|\.(?:com|org|net|edu|de|fr|es|uk|io)$",
    "ip": r"^(?:10|172|192|[1-9][0-9]?|1[0-9]{2}|2[01][0-9]|22[0-3])\.",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))",
    "phone": r"^\+(?:1|7|2[07]|3[0-4]|39|4[0-9]|5[1-8]|6[0-6]|8[1-6]|9[0-8])",
    "identity": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
    "national_phone": r"^\(?[2-9]",
    "secret": r"AKIA|[0-9a-f]{12}|[A-Za-z0-9+/]{16}",
}
NOT_IN_GAZETTEER = r"^(?:127\.|0\.|255\.)|^([0-9])(?:[\x20-]?\1)++$"
CONTEXT = r"(?i)(?:mail|contact|phone|call|tel|fax|card|visa|credit|ip|host|server|address|login|password|key|user|konto|karte|telefon|correo|tarjeta|carte|courriel)[^0-9A-Za-z]{0,3}[A-Za-z]{0,12}[^0-9A-Za-z]{0,3}$"
AGAINST = r"(?i)(?:version|section|chapter|isbn|release|figure|page)[^0-9A-Za-z]{0,3}$"
#: Code points before and after a span that labelers look at.
AROUND = 40
LENGTHS = (8, 12, 16, 20, 28)
LABELERS = ("shape", "gazetteer", "context", "around")


def _matches(body: Column, kind: str) -> Column:
    """Matches of a kind in order: code points since the last match, the match, and what stands around it."""
    found = F.regexp_extract_all(body, F.lit(KINDS[kind]), F.lit(0))
    pieces = F.split(body, KINDS[kind], -1)
    ends = F.transform(
        pieces, lambda p: F.struct(F.length(p).alias("gap"), F.right(p, F.lit(AROUND)).alias("left"), F.left(p, F.lit(AROUND)).alias("right"))
    )
    # Piece i stands before match i and piece i + 1 behind it; each array is made once.
    before = F.zip_with(found, ends, lambda m, p: F.struct(m.alias("match"), p.alias("piece")))
    whole = F.zip_with(
        before,
        F.slice(ends, F.lit(2), F.lit(2**31 - 1)),
        lambda b, after: F.struct(
            F.lit(kind).alias("kind"),
            b["piece"]["gap"].alias("gap"),
            b["match"].alias("match"),
            b["piece"]["left"].alias("left"),
            after["right"].alias("right"),
        ),
    )
    spans_ = F.filter(whole, lambda x: x["match"].isNotNull())
    empty = F.array().cast("array<struct<kind:string,gap:int,match:string,left:string,right:string>>")
    return F.when(body.rlike(MAY_HOLD[kind]), spans_).otherwise(empty)


def _starts(found: Column, kind: str) -> Column:
    """Matches of a kind with their place: gaps up to it and matches before it."""
    own = F.filter(found, lambda s: s["kind"] == kind)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))

    def step(a: Column, s: Column) -> Column:
        start = a["at"] + s["gap"]
        return F.struct((start + F.length(s["match"])).alias("at"), F.concat(a["starts"], F.array(start)).alias("starts"))

    starts = F.aggregate(own, zero, step)["starts"]
    return F.zip_with(
        own,
        starts,
        lambda s, at: F.struct(
            s["kind"].alias("kind"),
            s["match"].alias("match"),
            at.alias("start"),
            (at + F.length(s["match"])).alias("stop"),
            s["left"].alias("left"),
            s["right"].alias("right"),
        ),
    )


def _luhn(digits: Column) -> Column:
    """Whether a string of digits has a check sum that ends in 0."""
    value = F.split(F.reverse(digits), "")
    doubled = F.transform(
        value,
        lambda d, i: F.when(i % 2 == 1, (d.cast("int") * 2 % 10) + F.floor(d.cast("int") / 5).cast("int")).otherwise(d.cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def passes(kind: Column, match: Column) -> Column:
    """Whether a match passes the check of its kind."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(kind == "ip", match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(kind == "card", F.when((n >= 13) & (n <= 19), _luhn(digits)).otherwise(False))
        .when(kind == "phone", (n >= 9) & (n <= 15))
        .otherwise(True)
    )


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, row key and candidates (kind, match, start, stop, left, right)."""
    rows = docs.select(F.col(key).alias("id"), *shared.row_key(F.col(key), F.col(text)), shared.whole(F.col(text)).alias("body"))
    found = rows.select("id", "row_a", "row_b", F.concat(*(_matches(F.col("body"), kind) for kind in KINDS)).alias("found"))
    every = F.concat(*(_starts(F.col("found"), kind) for kind in KINDS))
    return found.select("id", "row_a", "row_b", F.when(F.size("found") > 0, every).alias("spans"))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def votes(spans: DataFrame) -> DataFrame:
    """``spans`` (kind, match, left, right) with a vote of each labeler and a length class."""
    kind, match = F.col("kind"), F.col("match")
    known = reduce(lambda a, k: a.when(kind == k, match.rlike(GAZETTEER[k])), KINDS, F.when(F.lit(False), False))
    embedded = F.col("left").rlike(r"[0-9A-Za-z_.-]$") | F.col("right").rlike("^[0-9A-Za-z_]")
    ok = passes(kind, match)
    return spans.select(
        "*",
        ok.alias("passed"),
        _vote(ok, ~ok).alias("shape"),
        _vote(F.coalesce(known, F.lit(False)), match.rlike(NOT_IN_GAZETTEER)).alias("gazetteer"),
        _vote(F.col("left").rlike(CONTEXT), F.col("left").rlike(AGAINST)).alias("context"),
        _vote(F.col("left").rlike(r"(?:^|[\x20\x09-\x0D(\[<\"':])$"), embedded).alias("around"),
        reduce(lambda a, n: a + (F.length(match) > n).cast("int"), LENGTHS, F.lit(0)).alias("size"),
    )


def reliabilities(table: list[dict], rounds: int = 50) -> tuple[list[float], dict]:
    """Expectation-maximisation over counted vote patterns.

    Returns the probability that each pattern is a true span, and per kind and labeler the chance of
    each vote for true and for false spans. Starts from a majority of the votes.
    """
    belief = [1 / (1 + exp(-sum(r[v] for v in LABELERS))) for r in table]
    model: dict = {}
    for _ in range(rounds):
        prior, tally = {}, {}
        for r, p in zip(table, belief):
            for true, mass in ((1, p * r["n"]), (0, (1 - p) * r["n"])):
                prior[r["kind"], true] = prior.get((r["kind"], true), 0.5) + mass
                for v in LABELERS:
                    at = v, r[v], true
                    tally[at] = tally.get(at, 0.0) + mass
        chance = lambda v, x, t: (tally.get((v, x, t), 0.0) + 0.5) / (sum(tally.get((v, y, t), 0.0) for y in (-1, 0, 1)) + 1.5)
        model = {(v, x, t): chance(v, x, t) for v in LABELERS for x in (-1, 0, 1) for t in (0, 1)}
        belief = []
        for r in table:
            odds = log(prior[r["kind"], 1]) - log(prior[r["kind"], 0])
            odds += sum(log(model[v, r[v], 1]) - log(model[v, r[v], 0]) for v in LABELERS)
            belief.append(1 / (1 + exp(-max(-30.0, min(30.0, odds)))))
    return belief, model


def _features(r: dict) -> list[tuple]:
    return [("offset",), ("kind", r["kind"]), ("size", r["size"]), *((v, r[v]) for v in LABELERS)]


def span_classifier(table: list[dict], belief: list[float], rounds: int = 400, ridge: float = 0.01) -> dict[tuple, float]:
    """Logistic regression on the probabilities, weighted by counts; a weight for each feature value."""
    weights: dict[tuple, float] = {}
    total = sum(r["n"] for r in table) or 1
    for _ in range(rounds):
        slope: dict[tuple, float] = {}
        for r, p in zip(table, belief):
            margin = sum(weights.get(f, 0.0) for f in _features(r))
            error = (1 / (1 + exp(-max(-30.0, min(30.0, margin)))) - p) * r["n"] / total
            for f in _features(r):
                slope[f] = slope.get(f, 0.0) + error
        for f, s in slope.items():
            weights[f] = weights.get(f, 0.0) - 1.0 * (s + ridge * weights.get(f, 0.0) / 10)
    return weights


def _margin(weights: dict[tuple, float]) -> Column:
    def part(name: str) -> Column:
        cases = [(f[1], w) for f, w in weights.items() if f[0] == name]
        return reduce(lambda a, c: a.when(F.col(name) == c[0], c[1]), cases, F.when(F.lit(False), 0.0)).otherwise(0.0)

    return reduce(lambda a, b: a + b, (part(n) for n in ("kind", "size", *LABELERS)), F.lit(weights.get(("offset",), 0.0)))


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text", accept: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """All rows (id, row_a, row_b) and their spans (row_a, row_b, kind, start, stop, base, probability).

    Rows with the same content share one set of spans. Intermediate tables are written when this is called.
    """
    scratch = shared.Scratch(docs.sparkSession, "pii")
    # The text ends here: a candidate keeps what stands around it.
    narrow = scratch.write(candidates(docs, key, text))
    rows = narrow.select("id", "row_a", "row_b")
    one = narrow.where(F.size("spans") > 0).dropDuplicates(["row_a", "row_b"]).select("row_a", "row_b", F.explode("spans").alias("s"))
    voted = scratch.write(votes(one.select("row_a", "row_b", "s.*")).drop("left", "right"))
    pattern = ["kind", "size", *LABELERS]
    table = [r.asDict() for r in voted.groupBy(*pattern).agg(F.count("*").alias("n")).orderBy(*pattern).collect()]
    belief, _ = reliabilities(table) if table else ([], {})
    probability = 1 / (1 + F.exp(-_margin(span_classifier(table, belief))))
    judged = voted.select(
        "row_a", "row_b", "kind", "start", "stop",
        (F.col("kind").isin(*BASE) & F.col("passed")).alias("base"), probability.alias("probability"),
    )
    # Accepted candidates stand where no span of higher standing (base, then likelier, then earlier) reaches.
    row = Window.partitionBy("row_a", "row_b").orderBy("start", "stop", "kind")
    base_reach = F.max(F.when(F.col("base"), F.col("stop"))).over(row.rowsBetween(Window.unboundedPreceding, -1))
    next_base = F.min(F.when(F.col("base"), F.col("start"))).over(row.rowsBetween(1, Window.unboundedFollowing))
    judged = judged.withColumn("reach", base_reach).withColumn("next", next_base)
    clear = (F.coalesce("reach", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("stop")) >= F.col("stop"))
    added = (F.col("probability") >= accept) & clear
    return rows, judged.where(F.col("base") | added).drop("reach", "next")


def written(spans_: Column, kinds: Iterable[str]) -> Column:
    """``kind:start:stop`` of an array of structs, in the order of the kinds and then of starts, comma-joined."""
    order = F.array(*(F.lit(k) for k in kinds))
    own = F.filter(spans_, lambda s: F.array_contains(order, s["kind"]))
    ranked = F.transform(own, lambda s: F.struct(F.array_position(order, s["kind"]).alias("k"), s["start"].alias("a"), s["stop"].alias("b"), s["kind"].alias("kind")))
    text = lambda s: F.concat_ws(":", s["kind"], s["a"].cast("string"), s["b"].cast("string"))
    return F.array_join(F.transform(F.array_sort(ranked), text), ",")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, counts of base spans, digest of base spans, all spans."""
    rows, found = spans(docs, key, text)
    listed = found.groupBy("row_a", "row_b").agg(F.collect_list(F.struct("kind", "start", "stop", "base")).alias("spans"))
    joined = rows.join(listed, ["row_a", "row_b"], "left")
    none = F.array().cast("array<struct<kind:string,start:int,stop:int,base:boolean>>")
    joined = joined.withColumn("spans", F.coalesce("spans", none))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return joined.select(
        F.col("id").alias(key),
        *(count(k) for k in BASE),
        F.sha2(F.encode(written(base, BASE), "UTF-8"), 256).alias("base_sha256"),
        written(F.col("spans"), KINDS).alias("spans"),
    )
