"""Personal data by weak supervision, in DataFrame functions only.

Spans come from four base patterns, which stay as they are, and from looser
patterns of the same kinds.  Labelers (pattern, check digits, gazetteer,
context) vote on every candidate or abstain; expectation-maximisation over the
counts of vote patterns estimates their reliabilities; a logistic span
classifier is trained on the posteriors and decides on the added spans.  Votes
are small integers, so candidates fall into a bounded number of patterns and
the classifier's verdicts are a short list of pattern codes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.llm.common import let, materialise
from textlens.llm.votes import fit_logistic, fit_votes

#: The kinds in order of precedence.
KINDS = ("email", "ip", "card", "phone")
#: The base patterns of the contract, written so that the regex
#: engine neither recurses per character nor starts anew inside a run that has
#: already failed; they match the same spans.
BASE = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
#: Looser patterns whose matches are only candidates.
LOOSE = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]++"
              r"(?: ?(?:\.|[\[(](?:dot|DOT)[\])]) ?[A-Za-z0-9-]++)++", r"[\[(](?:at|AT)[\])]"),
    "phone": (r"(?<![0-9+.\x20-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9.-])",
              r"[0-9]{3}\)?[.\x20-]?[0-9]{3}[.\x20-][0-9]{4}"),
}
#: Gazetteers: words near a span that speak for its kind or against any.
CUES = {
    "email": "(?i)mail|contact|write|reach|send|address",
    "ip": r"(?i)\bip\b|addr|host|server|client|login|from",
    "card": r"(?i)card|visa|master|amex|credit|debit|pay",
    "phone": r"(?i)phone|tel|call|mobile|cell|fax|contact|sms|dial|reach",
}
AGAINST = r"(?i)isbn|issn|order|invoice|version|build|item|ticket|serial|article|page|token|hash|id[:=#]"
DOMAINS = r"(?i)\.(?:com|org|net|edu|gov|info|io|eu|de|fr|es|it|uk|nl|us|ca)\z"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|3(?:0|6|8)|35)"
LABELERS = ("pattern", "check", "gazetteer", "context", "edges")
#: Characters of context on the left of a span.
CONTEXT = 40
#: Characters of the blocks that a text is redacted in.
BLOCK = 4096
ACCEPT = 0.9


def _luhn(digits: Column) -> Column:
    """Luhn check of a digit string: from the right every second digit counts
    double, less nine above nine."""
    back = F.split(F.reverse(digits), "")
    total = F.aggregate(
        F.transform(back, lambda d, i: let(
            F.coalesce(d.try_cast("int"), F.lit(0)) * F.when(i % 2 == 1, 2).otherwise(1),
            lambda v: F.when(v > 9, v - 9).otherwise(v))),
        F.lit(0), lambda acc, x: acc + x)
    return total % 10 == 0


def _valid(kind: str, span: Column) -> Column:
    digits = F.regexp_replace(span, "[^0-9]+", "")
    if kind == "ip":
        return F.forall(F.split(span, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return let(digits, lambda d: F.length(d).between(14, 19) & _luhn(d))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def running(values: Column, start: Column, combine, part: int = 128) -> Column:
    """What ``combine`` makes of ``start`` and the values before each one.
    Arrays grow by copying, so values are folded in parts and the parts' ends
    in turn: the work is a bounded multiple of the values' number up to some
    ``part`` squared of them."""
    def fold(items: Column, first: Column) -> Column:
        zero = F.struct(first.alias("at"), F.filter(F.array(first), lambda _: F.lit(False)).alias("out"))
        return F.aggregate(items, zero, lambda acc, x: F.struct(
            combine(acc["at"], x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"])

    def all_of(v: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / part).cast("int"))
        parts = F.transform(places, lambda i: F.slice(v, i * part + 1, F.lit(part)))
        ends = F.transform(parts, lambda p: F.aggregate(p, start, combine))
        return F.when(F.size(v) <= part, fold(v, start)).otherwise(F.flatten(F.zip_with(parts, fold(ends, start), fold)))

    return let(values, all_of)


def _matches(text: Column, pattern: str, trigger: str, make) -> Column:
    """Array of ``make(start, span, before, after)`` over the leftmost
    non-overlapping matches; start in code points.

    Splitting at the pattern gives the pieces between the matches, so the
    starts are running sums of lengths.  Texts without the trigger, which any
    match contains, are not searched."""
    def of(pair: Column) -> Column:
        gaps, spans = pair["gaps"], pair["spans"]
        sized = F.transform(spans, lambda s, i: F.struct(
            F.get(gaps, i).alias("gap"), s.alias("span"), F.get(gaps, i + 1).alias("next")))
        steps = F.transform(sized, lambda x: F.length(x["gap"]) + F.length(x["span"]))
        return let(running(steps, F.lit(0), lambda a, x: a + x), lambda st: F.transform(sized, lambda x, i: make(
            F.get(st, i) + F.length(x["gap"]), x["span"], x["gap"], x["next"])))

    found = let(F.struct(F.split(text, pattern).alias("gaps"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("spans")), of)
    return F.when(text.rlike(trigger), found)


def _candidate(kind: str, base: bool):
    def make(start: Column, span: Column, before: Column, after: Column) -> Column:
        left = F.right(before, F.lit(CONTEXT))
        ok = _valid(kind, span)
        digits = F.regexp_replace(span, "[^0-9]+", "")
        if kind == "email":
            dotted = F.regexp_replace(span, r"(?i) ?[\[(]dot[\])] ?", ".")
            check = F.when(dotted.rlike(r"\.[A-Za-z]{2,6}\z"), 1).otherwise(0)
            known = F.when(dotted.rlike(DOMAINS), 1)
        elif kind == "card":
            check = F.when(ok, 1).otherwise(0)
            known = F.when(digits.rlike(ISSUERS), 1).otherwise(0)
        elif kind == "phone":
            check = F.when(F.length(digits).between(10, 15), 1).otherwise(0)
            known = F.when(digits.rlike("^(?:1[2-9]|3|4|5|6|7|8|9|[2-9][0-9]{9}$)"), 1)
        else:
            check = F.when(ok, 1).otherwise(0)
            known = F.when(span.rlike(r"^(?:0|255)\."), 0).otherwise(1)
        context = F.when(left.rlike(AGAINST), 0).when(left.rlike(CUES[kind]), 1)
        glued = left.rlike(r"[A-Za-z0-9_/=#]\z") | after.rlike(r"^[A-Za-z0-9_/]")
        votes = {"pattern": F.when(F.lit(base) & ok, 1).when(F.lit(base), 0), "check": check,
                 "gazetteer": known, "context": context, "edges": F.when(glued, 0).otherwise(1)}
        # three digits 0, 1, 2 (abstain) per labeler, the kind in front
        code = F.lit(KINDS.index(kind))
        for name in LABELERS:
            code = code * 3 + F.coalesce(votes[name], F.lit(2))
        return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                        (start + F.length(span)).alias("end"), code.cast("int").alias("code"),
                        (F.lit(base) & ok).alias("base"))

    return make


def candidates(text: Column) -> Column:
    """Sorted array of (start, kind, end, code, base) of a whole text; null
    text: none.  ``base`` marks spans of the base patterns that pass their
    check, ``code`` the kind and the labelers' votes."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    kind = "array<struct<start:int,kind:int,end:int,code:int,base:boolean>>"
    found = [_matches(t, *BASE[k], _candidate(k, True)) for k in KINDS]
    found += [_matches(t, *LOOSE[k], _candidate(k, False)) for k in LOOSE]
    return F.sort_array(F.concat(*(F.coalesce(f.cast(kind), F.array().cast(kind)) for f in found)))


def accepted_codes(spans: DataFrame, accept: float = ACCEPT) -> list[int]:
    """Codes of the candidates that the span classifier takes for personal
    data, learnt from a table with the candidates array ``__c``."""
    code = F.col("code")
    base = 3 ** len(LABELERS)
    counted = (spans.select(F.explode("__c").alias("c")).groupBy(F.col("c")["code"].alias("code"))
               .agg(F.count(F.lit(1)).alias("n")))
    columns = {}
    for i, name in enumerate(LABELERS):
        digit = F.floor(code / 3 ** (len(LABELERS) - 1 - i)) % 3
        columns[name] = F.when(digit < 2, digit).cast("int")
    patterns = materialise(
        counted.select("code", "n", F.floor(code / base).cast("int").alias("kind"),
                       *(c.alias(k) for k, c in columns.items())), "pii-patterns")
    # the pattern labeler is null for loose candidates: reliabilities come from
    # the labelers' agreement, not from the base spans alone
    model = fit_votes(patterns, list(LABELERS), start=(0.8, 0.2), most_miss=0.9)
    features = {f"v_{k}": F.when(F.col(k) == 1, 1.0).when(F.col(k) == 0, -1.0).otherwise(0.0) for k in LABELERS}
    features |= {f"k_{k}": F.when(F.col("kind") == i, 1.0).otherwise(0.0) for i, k in enumerate(KINDS) if i}
    rows = patterns.select("code", "n", model.posterior({k: F.col(k) for k in LABELERS}).alias("p"),
                           *(c.alias(k) for k, c in features.items()))
    w = fit_logistic(rows, list(features), "n", "p")
    z = sum((F.col(k) * c for k, c in zip(features, w[1:])), F.lit(w[0]))
    # at most 4 * 3^5 codes exist
    return sorted(r["code"] for r in rows.where(1 / (1 + F.exp(-z)) >= accept).select("code").collect())


def chosen(spans: Column, codes: list[int]) -> Column:
    """The base spans and the accepted ones that touch no base span."""
    firm = F.filter(spans, lambda s: s["base"])
    if not codes:
        return firm
    return let(firm, lambda b: F.filter(spans, lambda s: s["base"] | (
        s["code"].isin(codes) & ~F.exists(b, lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"])))))


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat(
        F.get(names, s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, ``base`` and ``spans`` (arrays of
    start, kind, end, code, base; code points, end exclusive).  Null or empty
    text: no spans.  Repeated rows are searched each; an empty table gives no
    rows."""
    found = materialise(docs.select("doc_id", candidates(F.col("text")).alias("__c")), "pii-candidates")
    codes = accepted_codes(found)
    return found.select("doc_id", F.filter("__c", lambda s: s["base"]).alias("base"),
                        chosen(F.col("__c"), codes).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; where spans
    overlap, the one that starts first (in KINDS order) names the whole.  The
    text is cut into blocks once, and each gap between spans reads its own
    blocks, so the work grows with the text and the spans, not their product."""
    tags = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def between(blocks: Column, a: Column, b: Column) -> Column:
        i, j = F.floor(a / BLOCK).cast("int"), F.floor((b - 1) / BLOCK).cast("int")
        one = F.substring(F.get(blocks, i), a - i * BLOCK + 1, b - a)
        many = F.concat(F.substring(F.get(blocks, i), a - i * BLOCK + 1, F.lit(BLOCK)),
                        F.array_join(F.slice(blocks, i + 2, j - i - 1), ""),
                        F.substring(F.get(blocks, j), F.lit(1), b - j * BLOCK))
        return F.when(a >= b, F.lit("")).when(i == j, one).otherwise(many)

    def joined(blocks: Column) -> Column:
        ends = F.transform(spans, lambda s: s["end"])
        done = running(ends, F.lit(0), lambda a, x: F.greatest(a, x))
        pieces = let(done, lambda at: F.transform(spans, lambda s, i: F.when(s["start"] >= F.get(at, i), F.concat(
            between(blocks, F.get(at, i), s["start"]), F.get(tags, s["kind"]))).otherwise(F.lit(""))))
        return F.concat(F.array_join(pieces, ""), between(blocks, F.array_max(ends), F.length(text)))

    return let(F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % BLOCK), F.lit(0)), joined)


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text``; ``n_chars``, where
    there is one, follows a changed text.  Other columns stay.  Null and
    empty texts and repeated rows stay as they are, row for row; an empty
    table gives no rows."""
    codes = accepted_codes(docs.select(candidates(F.col("text")).alias("__c")))
    text = F.col("text")
    new = let(chosen(candidates(text), codes), lambda s: F.when(F.size(s) > 0, redact(text, s)).otherwise(text))
    out = docs.withColumn("__new", new)
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("__new").cast(docs.schema["text"].dataType).alias("text"))
        elif c == "n_chars":
            columns.append(F.when(F.col("__new") != text, F.length("__new")).otherwise(F.col(c))
                           .cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(c))
    return out.select(*columns)


def pii_query(docs: DataFrame) -> DataFrame:
    """Counts and digests of ``find_pii``, one row per row of ``docs``."""
    found = find_pii(docs)

    def count(i: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long").alias(f"n_{KINDS[i]}")

    return found.select("doc_id", *(count(i) for i in range(len(KINDS))), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                        _listed(F.col("spans")).alias("spans"))
