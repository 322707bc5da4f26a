"""Personal data by weak supervision, in DataFrame expressions only.

Strict patterns find the base spans, which are always kept. Looser patterns find
candidates. On every candidate, labelers vote yes, no or nothing: its strict
pattern, a check of its digits, gazetteers (top-level domains, card issuers,
country codes), the words before it, and its shape. Expectation maximisation over
the counts of vote patterns estimates how reliable each labeler is and how likely
each pattern marks personal data. With these as soft labels a span classifier
(naive Bayes over a span's own features) is trained; the candidates that it is
sure of, and that no base span overlaps, are added.

Patterns do not track back over a run of characters, so long texts take linear
time. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import rows_where, without

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
# How sure the classifier must be of a span that it adds.
SURE = 0.95
ROUNDS = 50
# Characters before a span that are its context.
BEFORE = 24
# Matches whose places are counted in one go.
_BLOCK = 256
# Characters of a secret in which no base span may lie; what lies behind them does not rule it out.
HEAD = 64

_USER = "[A-Za-z0-9._%+-]"
# A match begins where a run begins, or where the match before it ended.
_STRICT = {
    "email": rf"(?:(?<!{_USER})|\G){_USER}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_LOOSE = {
    "email": rf"(?i)(?<!{_USER}){_USER}++ ?(?:\(at\)|\[at\]) ?[a-z0-9-]++(?: ?(?:\(dot\)|\[dot\]|\.) ?[a-z0-9-]++)++",
    "phone": r"(?<![0-9.+-])\(?[0-9]{2,4}\)?(?:[ .-][0-9]{2,4}){2,4}(?![0-9])",
    "secret": r"(?i)(?:password|passwd|token|secret|api_?key)\s{0,2}[=:]\s{0,2}[\"']?[^\s\"']{8,}+[\"']?",
}
# What a text must hold for a pattern to be tried.
_NEEDS = {
    "email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]", "phone": r"\+[0-9]",
    "loose email": r"(?i)[(\[]at[)\]]", "loose phone": r"[0-9][ .-][0-9]", "loose secret": r"[=:]",
}
_SPAN = "array<struct<start:int,kind:int,end:int,value:string,strict:boolean>>"

# Gazetteers: fixed values.
DOMAINS = "com org net edu gov io de fr es it uk eu info co us"
ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[4-7]|6(?:011|5))"
COUNTRY_CODES = r"^\+(?:1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"
CONTEXT = {
    "email": r"(?i)mail|contact|write", "ip": r"(?i)\bip\b|host|server|address", "card": r"(?i)card|visa|credit",
    "phone": r"(?i)tel|phone|call|fax|mobile", "secret": r"(?i)key|login|user|auth",
}
AGAINST = r"(?i)version|isbn|page|chapter|\bv$|no\.? ?$"

LABELERS = ("pattern", "check", "gazetteer", "context", "shape")


def _found(text: Column, pattern: str, need: str, kind: int, strict: bool) -> Column:
    """All matches with their places: gaps and matches take turns, and lengths add up."""
    gaps = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    nothing = F.array().cast(_SPAN)

    def step(done, pair):
        first = done["at"] + F.length(pair["gap"])
        end = first + F.length(pair["value"])
        span = F.struct(
            first.alias("start"), F.lit(kind).alias("kind"), end.alias("end"),
            pair["value"].alias("value"), F.lit(strict).alias("strict"),
        )
        return F.when(pair["value"].isNull(), done).otherwise(
            F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))
        )

    pairs = F.zip_with(gaps, matches, lambda g, m: F.struct(g.alias("gap"), m.alias("value")))
    spans = _by_blocks(pairs, nothing, f"array<{_SPAN}>", step, lambda at, out: F.flatten(out))
    return F.when(text.rlike(need), spans).otherwise(nothing)


def _by_blocks(items: Column, nothing: Column, kind: str, step, finish) -> Column:
    """``aggregate`` of a state ``at`` and an output that grows with the items, which it copies at every step.

    So each block of _BLOCK items begins an output of its own, and copying stays in
    proportion to the items. ``finish`` gets the last ``at`` and the blocks' outputs.
    """
    def block_step(done, block):
        start = F.struct(done["at"].alias("at"), nothing.alias("out"))
        return F.transform(
            F.array(F.aggregate(block, start, step)),
            lambda own: F.struct(own["at"].alias("at"), F.concat(done["out"], F.array(own["out"])).alias("out")),
        )[0]

    def run(known):
        last = F.floor(F.greatest(F.size(known) - 1, F.lit(0)) / F.lit(_BLOCK)).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(known, k * _BLOCK + 1, F.lit(_BLOCK)))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
        return F.aggregate(blocks, start, block_step, lambda done: finish(done["at"], done["out"]))

    # A name for the items, which else would be computed for every block.
    return F.transform(F.array(items), run)[0]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
        small = lambda p: F.when(F.length(part(p)) <= 3, part(p).cast("int") <= 255).otherwise(False)
        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        number = F.length(_digits(value)).between(14, 19)
        return F.when(number, F.call_function("luhn_check", _digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _pattern_spans(text: Column) -> dict[str, Column]:
    return {k: _found(text, _STRICT[k], _NEEDS[k], KINDS.index(k), True) for k in BASE}


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_base`` (sorted base spans) and ``_maybe`` (all other candidates)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select("*", *(s.alias(f"_{k}") for k, s in _pattern_spans(text).items()))
    loose = [_found(text, p, _NEEDS[f"loose {k}"], KINDS.index(k), False) for k, p in _LOOSE.items()]

    def kept(kind):
        return F.filter(f"_{kind}", lambda s: _valid(kind, s["value"]))

    def failed(kind):
        # Numbers that are no cards are everywhere and are not candidates.
        long = lambda s: F.length(_digits(s["value"])) >= 14 if kind == "card" else F.lit(True)
        return F.filter(f"_{kind}", lambda s: long(s) & ~_valid(kind, s["value"]))

    docs = docs.select(
        "*",
        F.array_sort(F.concat(*map(kept, BASE))).alias("_base"),
        F.concat(*map(failed, ("ip", "card", "phone")), *loose).alias("_loose"),
    ).drop(*(f"_{k}" for k in BASE))

    def mark(done, s):
        start, further = F.greatest(done["at"], s["start"]), F.greatest(done["at"], s["end"])
        marks = F.concat(F.repeat(F.lit("."), start - done["at"]), F.repeat(F.lit("x"), further - start))
        return F.struct(further.alias("at"), F.concat(done["out"], marks).alias("out"))

    # A byte for each character up to the last base span: any stretch of it is found at once.
    marked = _by_blocks(
        F.col("_base"), F.lit(""), "array<string>", mark, lambda at, out: F.array_join(out, "").cast("binary")
    )

    def free(marks, c):
        secret = c["kind"] == KINDS.index("secret")
        end = F.when(secret, F.least(c["end"], c["start"] + HEAD)).otherwise(c["end"])
        return F.instr(F.substring(marks, c["start"] + 1, end - c["start"]).cast("string"), F.lit("x")) == 0

    kept = F.transform(F.array(marked), lambda marks: F.filter("_loose", lambda c: free(marks, c)))[0]
    alone = (F.size("_base") == 0) | (F.size("_loose") == 0)
    return docs.withColumn("_maybe", F.when(alone, F.col("_loose")).otherwise(kept)).drop("_loose")


def _by_kind(kind: Column, choose) -> Column:
    out = F.lit(None)
    for number, name in enumerate(KINDS):
        out = F.when(kind == number, choose(name)).otherwise(out)
    return out


def _vote(yes: Column, no: Column | None = None) -> Column:
    vote = F.when(yes, "y")
    return (vote if no is None else vote.when(no, "n")).otherwise("-")


def _votes(span: Column, before: Column) -> Column:
    """One letter for each labeler: y, n or -."""
    value, kind = span["value"], span["kind"]
    check = _by_kind(kind, lambda k: _valid(k, value))
    listed = _by_kind(kind, lambda k: {
        "email": F.array_contains(F.lit(DOMAINS.split()), F.lower(F.regexp_extract(value, "([A-Za-z]+)$", 1))),
        "card": _digits(value).rlike(ISSUERS),
        "phone": F.length(_digits(value)) >= 10 if k != "phone" else value.rlike(COUNTRY_CODES),
    }.get(k, F.lit(None).cast("boolean")))
    near = _by_kind(kind, lambda k: before.rlike(CONTEXT[k]))
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    shape = _by_kind(kind, lambda k: mixed if k == "secret" else F.length(_digits(value)) <= 19)
    return F.concat(
        _vote(span["strict"] & check),
        F.when(kind == KINDS.index("secret"), "-").otherwise(_vote(check, ~check)),
        _vote(listed, ~listed),
        _vote(near, before.rlike(AGAINST)),
        _vote(shape, ~shape),
    )


def _features(span: Column, before: Column) -> Column:
    """The classifier's features, as names: none depends on the votes' outcome."""
    value = span["value"]
    share = F.floor(4 * F.length(_digits(value)) / F.greatest(F.length(value), F.lit(1)))
    return F.array(
        F.concat(F.lit("length "), F.least(F.floor(F.length(value) / 6), F.lit(6)).cast("string")),
        F.concat(F.lit("digits "), share.cast("string")),
        F.concat(F.lit("before "), F.when(F.trim(before).rlike("[:=(]$"), "mark").when(before.rlike("[A-Za-z] $"), "word").otherwise("other")),
        F.concat(F.lit("strict "), span["strict"].cast("string")),
        F.concat(F.lit("letters "), value.rlike("[A-Za-z]").cast("string")),
    )


def _before(text: Column, span: Column) -> Column:
    first = F.greatest(span["start"] - BEFORE, F.lit(0))
    return F.substr(text, first + 1, span["start"] - first)


def estimate(counts: list[tuple[str, int]]) -> dict[str, float]:
    """How likely each vote pattern marks personal data, by expectation maximisation.

    Votes are taken as independent given the truth. Starts from the majority.
    """
    def majority(votes):
        yes, no = votes.count("y"), votes.count("n")
        return (yes + 0.5) / (yes + no + 1)

    belief = {v: majority(v) for v, _ in counts}
    for _ in range(ROUNDS):
        total = [1.0, 1.0]
        tables = [[defaultdict(lambda: 1.0) for _ in LABELERS] for _ in (0, 1)]
        for votes, n in counts:
            for truth, share in ((1, belief[votes]), (0, 1 - belief[votes])):
                total[truth] += n * share
                for place, vote in enumerate(votes):
                    tables[truth][place][vote] += n * share
        for votes, _ in counts:
            odds = math.log(total[1] / total[0])
            for place, vote in enumerate(votes):
                if vote != "-":
                    odds += math.log(tables[1][place][vote] / (total[1] + 2)) - math.log(tables[0][place][vote] / (total[0] + 2))
            belief[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return belief


def train(docs: DataFrame) -> dict[str, float]:
    """Weights of the span classifier, by ``kind: feature`` and ``kind:`` for the constant.

    Runs one job over all texts. What comes to the driver is one row for each
    combination of kind, votes and features that occurs; each has few values.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    spanned = with_spans(docs.select("text"))
    each = spanned.select(text.alias("text"), F.explode(F.concat("_base", "_maybe")).alias("span"))
    before = _before(F.col("text"), F.col("span"))
    seen = each.select(
        F.col("span.kind").alias("kind"),
        _votes(F.col("span"), before).alias("votes"),
        _features(F.col("span"), before).alias("features"),
    )
    rows = seen.groupBy("kind", "votes", "features").count().orderBy("kind", "votes", "features").collect()
    weights = {}
    for number, kind in enumerate(KINDS):
        own = [r for r in rows if r["kind"] == number]
        if not own:
            continue
        counts: dict[str, int] = defaultdict(int)
        for r in own:
            counts[r["votes"]] += r["count"]
        belief = estimate(sorted(counts.items()))
        total, tables = [1.0, 1.0], [defaultdict(lambda: 0.5), defaultdict(lambda: 0.5)]
        for r in own:
            p = belief[r["votes"]]
            for truth, share in ((1, p), (0, 1 - p)):
                total[truth] += r["count"] * share
                for f in r["features"]:
                    tables[truth][f] += r["count"] * share
        weights[f"{kind}:"] = math.log(total[1] / total[0])
        for f in {f for r in own for f in r["features"]}:
            weights[f"{kind}:{f}"] = math.log(tables[1][f] / (total[1] + 1)) - math.log(tables[0][f] / (total[0] + 1))
    return weights


def find(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``, arrays of ``(start, kind, end, value)``.

    ``kind`` is a place in KINDS. Spans are in order of start, then kind. ``spans``
    has the base spans and those that the classifier adds. A null text counts as
    an empty one, which has none.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = without(docs, ["base_spans", "spans"])
    # Other columns are set aside under names that no column here has.
    aside = {c: "text" if c.lower() == "text" else f"own{k}" for k, c in enumerate(docs.columns)}
    docs = with_spans(docs.select(*(F.col(f"`{c}`").alias(n) for c, n in aside.items())))
    known = F.create_map(*(F.lit(x) for pair in sorted(weights.items()) for x in pair)) if weights else None

    def sure(span):
        if known is None:
            return F.lit(False)
        name = F.concat(_by_kind(span["kind"], lambda k: F.lit(k)), F.lit(":"))
        weight = lambda key: F.coalesce(F.try_element_at(known, key), F.lit(0.0))
        # A kind that was not seen in training has no constant and is never added.
        odds = F.coalesce(F.try_element_at(known, name), F.lit(-99.0))
        features = _features(span, _before(text, span))
        odds = odds + F.aggregate(features, F.lit(0.0), lambda s, f: s + weight(F.concat(name, f)))
        return odds >= math.log(SURE / (1 - SURE))

    plain = lambda spans: F.transform(spans, lambda s: F.struct(*(s[c].alias(c) for c in ("start", "kind", "end", "value"))))
    added = F.filter("_maybe", sure)
    return docs.select(
        *(F.col(n).alias(c) for c, n in aside.items()),
        plain(F.col("_base")).alias("base_spans"),
        plain(F.array_sort(F.concat("_base", F.array_distinct(added)))).alias("spans"),
    )


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    one = lambda s: F.concat_ws(":", _by_kind(s["kind"], lambda k: F.lit(k)), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span, or group of overlapping ones, replaced by its kind in brackets."""
    def step(done, s):
        further = F.greatest(done["at"], s["end"]).alias("at")
        name = F.concat(F.lit("["), F.upper(_by_kind(s["kind"], lambda k: F.lit(k))), F.lit("]"))
        new = F.concat(done["out"], F.substr(text, done["at"] + 1, s["start"] - done["at"]), name)
        return F.struct(further, F.when(s["start"] < done["at"], done["out"]).otherwise(new).alias("out"))

    def finish(at, out):
        return F.concat(F.array_join(out, ""), F.substr(text, at + 1, F.length(text)))

    whole = _by_blocks(spans, F.lit(""), "array<string>", step, finish)
    return F.when(F.size(spans) == 0, text).otherwise(whole)


def redact(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``docs`` with the spans in ``text`` replaced; ``n_chars``, if there, is counted anew.

    Null texts stay null. All columns keep their order.
    """
    def operator(d):
        found = find(d, weights)
        text = F.when(F.col("text").isNotNull(), redacted(F.col("text"), F.col("spans")))
        return found.withColumn("text", text)

    out = rows_where(docs, ["text"], operator, "true")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
