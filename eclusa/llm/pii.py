"""Personal data by weak supervision, with DataFrame functions only.

Candidate spans come from strict patterns (those that pass are the base spans and
always stay; those that fail stay candidates) and from wider ones. Four labelers vote
on each candidate, for (1), against (-1) or not at all (0): a pattern of the form in which
its kind is usually written, which only speaks against others, a check of its digits
whatever their form, a gazetteer of prefixes and domains, and the words before it.
Votes are counted by pattern over all documents; there are at most a few hundred
patterns, and only they reach the driver. Expectation-maximisation estimates the
labelers' reliabilities and each pattern's chance; a logistic span classifier is
trained on these chances and decides which candidates are added to the base spans.

All rows are handled by themselves; the only shuffle is that of pattern counts. A null
or empty text has no spans. Repeated rows are each returned. Without candidates the
classifier adds nothing. Added spans never overlap a base span.

The patterns' loops are possessive where that changes no match, so that very long
runs neither recurse nor backtrack; a look-behind starts a match only where a run of
its characters begins or where the last match ended, which is where the leftmost
match begins as well.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eclusa.llm.frames import free_name, staged

# Kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")

# Strict patterns, as the contract has them.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Wider patterns: written-out addresses, IPv6, short cards and other separators, national numbers.
WIDE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+\x20?[(\[{]at[)\]}]\x20?[a-z0-9-]{1,63}+"
    r"(?:\x20?(?:\.|[(\[{]dot[)\]}])\x20?[a-z0-9-]{1,63}+)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?:3[47][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}|[0-9]{4}(?:[._/][0-9]{4}){3})(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+.(-])(?:\([0-9]{2,5}\)|00?[1-9])[0-9\x20().-]{5,18}[0-9](?![0-9A-Za-z])",
}
# What a text must have before its patterns are tried.
NEEDS = {
    "email": ("@", r"(?i)[(\[{]at[)\]}]"),
    "ip": (r"[0-9]\.[0-9]", r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:"),
    "card": ("[0-9][0-9\x20-]{14}", "[0-9]{4}"),
    "phone": (r"\+[0-9]", r"[0-9)][0-9\x20().-]{5}"),
}
# Gazetteer of well-known domains, issuers' digits and dialling prefixes.
GAZETTEER = {
    "email": r"(?i)(gmail|hotmail|outlook|yahoo|icloud|proton|gmx|web|mail|example)[a-z0-9-]*\.[a-z.]+$",
    "ip": r"^(10|127|192\.168|172\.(1[6-9]|2[0-9]|3[01])|8\.8)\.|^(fe80|fd|2001)",
    "card": r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^(\+|00)(1|20|27|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])",
}
# Words that speak for a kind, or against it, shortly before a span.
CUES = {
    "email": r"(?i)\b(e-?mail|mail|contact|write|correo|courriel|kontakt)\b",
    "ip": r"(?i)\b(ip|host|server|address|addr|client|login|adresse)\b",
    "card": r"(?i)\b(card|visa|mastercard|amex|credit|carte|karte|tarjeta|pan)\b",
    "phone": r"(?i)\b(tel|phone|call|mobile|cell|fax|whatsapp|telefon|anruf|movil|t[eé]l[eé]fono)\b",
}
AGAINST = (
    r"(?i)\b(version|release|order|invoice|isbn|issn|doi|serial|section|chapter|price|total|id|no|nr)[\x20.:#=]*$"
)
# How each kind is usually written, whatever its numbers are.
FORM = {
    "email": r"\.[A-Za-z]{2,}$",
    "ip": r"^(?:(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7})$",
    "card": r"^(?:[0-9]+|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|3[47][0-9]{2}([\x20-])[0-9]{6}\2[0-9]{5})$",
    "phone": r"^(?:\+|00?)?\(?[0-9]++\)?+(?:[\x20.-]?+\(?+[0-9]++\)?+)*+$",
}
# Characters before a span that are searched for words.
BEFORE = 32
# Numbers of an array that are put together one by one.
BLOCK = 128
# Beyond all positions in a text.
_FAR = 2**31 - 1
ROUNDS = 25
THRESHOLD = 0.5
_VOTES = ("regex", "digits", "gazetteer", "context")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, zero: int, step: Callable[[Column, Column], Column]) -> Column:
    """For each of an array's whole numbers, all those before it put together by ``step``.

    The numbers are taken in blocks, first each block as a whole, then block by block: an
    array that grows by one number at a time is copied each time, so blocks keep the work
    in proportion to the array, up to millions of numbers.
    """
    before = "struct<at:int,before:array<int>>"
    first = lambda at: F.struct(at.alias("at"), F.array().cast("array<int>").alias("before"))

    def add(acc: Column, value: Column) -> Column:
        return F.struct(
            step(acc["at"], value).alias("at"), F.concat(acc["before"], F.array(acc["at"])).alias("before")
        ).cast(before)

    def each(array: Column, at: Column) -> Column:
        return F.aggregate(array, first(at).cast(before), add, lambda acc: acc["before"])

    def whole(array: Column) -> Column:
        many = F.sequence(F.lit(0), F.ceil(F.size(array) / BLOCK).cast("int") - 1)
        blocks = F.transform(many, lambda i: F.slice(array, i * BLOCK + 1, F.lit(BLOCK)))
        totals = lambda bs: F.transform(bs, lambda b: F.aggregate(b, F.lit(zero), step))
        joined = lambda bs: F.flatten(F.zip_with(bs, each(totals(bs), F.lit(zero)), each))
        return F.when(F.size(array) > BLOCK, _let(blocks, joined)).otherwise(each(array, F.lit(zero)))

    return _let(values, whole)


def _matches(text: Column, pattern: str) -> Column:
    """All matches of a pattern: start and end in characters, match, what stands before."""

    def placed(found: Column) -> Column:
        # One piece of text more than matches: match i lies behind piece i.
        pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        return _let(F.arrays_zip(found.alias("m"), pieces.alias("p")), spans)

    def spans(pairs: Column) -> Column:
        lengths = F.transform(pairs, lambda x: F.char_length(x["p"]) + F.char_length(x["m"]))
        return F.zip_with(pairs, running(lengths, 0, lambda a, b: a + b), span)

    def span(pair: Column, at: Column) -> Column:
        start = at + F.char_length(pair["p"])
        return F.struct(
            start.alias("start"),
            (start + F.char_length(pair["m"])).alias("end"),
            pair["m"].alias("m"),
            F.substring(pair["p"], -BEFORE, BEFORE).alias("before"),
        )

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if the string of digits passes Luhn's check."""

    def value(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = 2 * d
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(
        F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + value(i)
    )
    return F.when(F.length(digits) == 0, False).otherwise(total % 10 == 0)


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"


def _checked(kind: str, m: Column, wide: bool) -> Column | None:
    """Whether a candidate's numbers add up; None for kinds without any to check."""
    digits = _digits(m)
    if kind == "email" or (kind == "ip" and wide):
        return None
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        least = 15 if wide else 16
        return F.when(F.length(digits).between(least, 19), luhn(digits)).otherwise(False)
    return F.length(digits).between(8, 15)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _candidates(text: Column, kind: str, wide: bool) -> Column:
    """Candidates of one kind with their votes; all but the base ones are kept apart."""
    found = _matches(text, (WIDE if wide else STRICT)[kind])
    no = F.lit(False)

    def voted(x: Column) -> Column:
        m, ok = x["m"], _checked(kind, x["m"], wide)
        known = F.regexp_replace(m, r"(?i)\x20?[(\[{]dot[)\]}]\x20?", ".") if kind == "email" else m
        usual = known.rlike(FORM[kind])
        known = _digits(m) if kind == "card" else known
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            x["start"].alias("start"),
            x["end"].alias("end"),
            (F.lit(not wide) & (F.lit(True) if ok is None else ok)).alias("base"),
            _vote(no, ~usual).alias("regex"),
            (F.lit(0) if ok is None else _vote(ok, ~ok)).alias("digits"),
            _vote(known.rlike(GAZETTEER[kind]), no).alias("gazetteer"),
            _vote(x["before"].rlike(CUES[kind]), x["before"].rlike(AGAINST)).alias("context"),
            F.least(F.length(m) / 8, F.lit(3)).cast("int").alias("length"),
        )

    if wide and _checked(kind, text, wide) is not None:
        found = F.filter(found, lambda x: _checked(kind, x["m"], wide))
    # A card candidate needs a card's digits; shorter runs are plain numbers.
    if kind == "card" and not wide:
        found = F.filter(found, lambda x: F.length(_digits(x["m"])).between(13, 24))
    spans = F.transform(found, voted)
    return F.when(text.rlike(NEEDS[kind][int(wide)]), spans).otherwise(F.array())


_TYPE = (
    "array<struct<kind:int,start:int,end:int,base:boolean,regex:int,digits:int,"
    "gazetteer:int,context:int,length:int>>"
)


def candidates(text: Column) -> Column:
    """All candidate spans of a text, by kind and start."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    strict = F.concat(*(_candidates(whole, kind, False).cast(_TYPE) for kind in KINDS))
    wide = F.concat(*(_candidates(whole, kind, True).cast(_TYPE) for kind in KINDS))
    return F.array_sort(F.concat(strict, wide))


def _apart(spans: Column) -> Column:
    """Base spans, and the others that overlap none of them, by kind and start.

    In order of their starts, a span overlaps one before it if the furthest end so far lies
    beyond its start, and one after it if the nearest start to come lies before its end.
    """

    def sifted(ordered: Column) -> Column:
        ends = F.transform(ordered, lambda x: F.when(x["s"]["base"], x["s"]["end"]).otherwise(-1))
        starts = F.transform(
            F.reverse(ordered), lambda x: F.when(x["s"]["base"], x["start"]).otherwise(_FAR)
        )
        seen = running(ends, -1, lambda a, b: F.greatest(a, b))
        ahead = F.reverse(running(starts, _FAR, lambda a, b: F.least(a, b)))
        each = F.arrays_zip(ordered.alias("x"), seen.alias("seen"), ahead.alias("ahead"))
        kept = F.filter(
            each,
            lambda e: e["x"]["s"]["base"]
            | ((e["seen"] <= e["x"]["start"]) & (e["ahead"] >= e["x"]["s"]["end"])),
        )
        return F.array_sort(F.transform(kept, lambda e: e["x"]["s"]))

    def whole(found: Column) -> Column:
        mixed = F.exists(found, lambda s: s["base"]) & F.exists(found, lambda s: ~s["base"])
        ordered = F.array_sort(
            F.transform(found, lambda s: F.struct(s["start"].alias("start"), s.alias("s")))
        )
        return F.when(mixed, _let(ordered, sifted)).otherwise(found)

    return _let(spans, whole)


# --- reliabilities and classifier, over counts of vote patterns ---

Pattern = tuple[int, tuple[int, ...], int, float]


def pattern_counts(found: DataFrame, spans: str) -> list[Pattern]:
    """Kind, votes, length class and number of candidates, for each pattern there is.

    At most 4 x 3^4 x 4 rows, whatever the input.
    """
    each = found.select(F.explode(f"`{spans}`").alias("s"))
    rows = each.groupBy("s.kind", *(f"s.{v}" for v in _VOTES), "s.length").count().collect()
    return sorted((r["kind"], tuple(r[v] for v in _VOTES), r["length"], float(r["count"])) for r in rows)


def reliabilities(patterns: Iterable[Pattern], rounds: int = ROUNDS) -> dict[Pattern, float]:
    """Chance that the candidates of each pattern are personal data.

    Two-class model of independent labelers for each kind: expectation-maximisation
    over how often each labeler's votes are for and against in either class, from the sum of
    the votes on, where the check of the digits, the only one that computes, counts double. Counts are smoothed by one vote each; no vote says nothing.
    """
    chance: dict[Pattern, float] = {}
    for kind in range(len(KINDS)):
        own = [p for p in patterns if p[0] == kind]
        check = _VOTES.index("digits")
        y = {p: min(max(0.5 + 0.2 * (sum(p[1]) + p[1][check]), 0.05), 0.95) for p in own}
        for _ in range(rounds):
            n1 = 1 + sum(p[3] * y[p] for p in own)
            n0 = 1 + sum(p[3] * (1 - y[p]) for p in own)
            votes = {}
            for j in range(len(_VOTES)):
                # How often the labeler is for and against, of the times it votes at all.
                yes = {v: 1 + sum(p[3] * y[p] for p in own if p[1][j] == v) for v in (-1, 1)}
                no = {v: 1 + sum(p[3] * (1 - y[p]) for p in own if p[1][j] == v) for v in (-1, 1)}
                for v in (-1, 1):
                    votes[j, v] = math.log(yes[v] / sum(yes.values())) - math.log(no[v] / sum(no.values()))
            for p in own:
                z = math.log(n1 / n0) + sum(votes[j, v] for j, v in enumerate(p[1]) if v)
                y[p] = 1 / (1 + math.exp(-max(min(z, 30), -30)))
        chance.update(y)
    return chance


def _features(kind: int, votes: tuple[int, ...], length: int) -> list[str]:
    return [
        "bias",
        f"kind={kind}",
        *(f"{name}={v}" for name, v in zip(_VOTES, votes, strict=True) if v),
        f"length={kind},{length}",
    ]


def train(patterns: list[Pattern], chance: dict[Pattern, float], steps: int = 600) -> dict[str, float]:
    """Weights of a logistic classifier of spans, fitted to the patterns' chances.

    A pattern weighs as the logarithm of its count, so that a common one can't hide the rest.
    """
    weights: dict[str, float] = {}
    rows = [(_features(*p[:3]), chance[p], math.log1p(p[3])) for p in patterns]
    total = sum(w for *_, w in rows) or 1.0
    for _ in range(steps):
        slope = {f: 0.001 * w for f, w in weights.items()}
        for names, y, w in rows:
            z = sum(weights.get(f, 0.0) for f in names)
            error = w / total * (1 / (1 + math.exp(-max(min(z, 30), -30))) - y)
            for f in names:
                slope[f] = slope.get(f, 0.0) + error
        for f, s in slope.items():
            weights[f] = weights.get(f, 0.0) - s
    return weights


def score(span: Column, weights: dict[str, float]) -> Column:
    """The classifier's chance for a candidate, as an expression."""
    z = F.lit(weights.get("bias", 0.0))
    for k in range(len(KINDS)):
        z += F.when(span["kind"] == k, weights.get(f"kind={k}", 0.0)).otherwise(0.0)
        for n in range(4):
            at = (span["kind"] == k) & (span["length"] == n)
            z += F.when(at, weights.get(f"length={k},{n}", 0.0)).otherwise(0.0)
    for name in _VOTES:
        z += (
            F.when(span[name] == 1, weights.get(f"{name}=1", 0.0))
            .when(span[name] == -1, weights.get(f"{name}=-1", 0.0))
            .otherwise(0.0)
        )
    return 1 / (1 + F.exp(-z))


def _kept(spans: Column, weights: dict[str, float], threshold: float) -> Column:
    return F.filter(spans, lambda s: s["base"] | (score(s, weights) >= threshold))


def fit(found: DataFrame, spans: str) -> dict[str, float]:
    patterns = pattern_counts(found, spans)
    return train(patterns, reliabilities(patterns))


def scan(documents: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id`` and ``spans`` of each document row: kind, start, end, base and votes."""
    spans = _apart(candidates(F.col(f"`{text}`")))
    found = staged(documents.select("doc_id", spans.alias("spans")), "pii-candidates")
    weights = fit(found, "spans")
    return found.select("doc_id", _kept(F.col("spans"), weights, threshold).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, by kind and start, with commas between."""
    names = F.array(*(F.lit(k) for k in KINDS))
    ordered = F.array_sort(
        F.transform(
            spans, lambda s: F.struct(s["kind"].alias("k"), s["start"].alias("a"), s["end"].alias("b"))
        )
    )
    return F.concat_ws(
        ",",
        F.transform(
            ordered, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["a"].cast("string"), s["b"].cast("string"))
        ),
    )


def masked(documents: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with each span replaced by its kind in brackets, columns as before."""
    name = free_name(documents.columns, "spans")
    found = documents.withColumn(name, _apart(candidates(F.col(f"`{text}`"))))
    kept = _kept(F.col(f"`{name}`"), fit(found, name), threshold)
    # Read once as a column of its own, so that the texts are searched once.
    whole = F.col(f"`{text}`")
    tags = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    ordered = F.array_sort(
        F.transform(
            kept, lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"), s["kind"].alias("k"))
        )
    )

    def disjoint(spans: Column) -> Column:
        # A span that begins within an earlier one is covered by that one's mark.
        reach = running(F.transform(spans, lambda s: s["b"]), 0, lambda x, y: F.greatest(x, y))
        both = F.arrays_zip(spans.alias("s"), reach.alias("reach"))
        rest = F.substring(whole, F.array_max(F.transform(spans, lambda s: s["b"])) + 1, F.length(whole))
        return F.concat(_let(F.filter(both, lambda x: x["s"]["a"] >= x["reach"]), blocks), rest)

    def blocks(kept: Column) -> Column:
        # A piece of a long text is searched from its start, so each block has a cut of its own.
        many = F.sequence(F.lit(0), F.ceil(F.size(kept) / BLOCK).cast("int") - 1)
        parts = F.transform(many, lambda i: F.slice(kept, i * BLOCK + 1, F.lit(BLOCK)))
        return F.array_join(F.transform(parts, block), "")

    def block(part: Column) -> Column:
        at = F.get(part, F.lit(0))["reach"]
        cut = F.substring(whole, at + 1, F.element_at(part, -1)["s"]["a"] - at)
        return _let(cut, lambda c: F.array_join(F.transform(part, lambda x: marked(c, x, at)), ""))

    def marked(cut: Column, x: Column, at: Column) -> Column:
        before = F.substring(cut, x["reach"] - at + 1, x["s"]["a"] - x["reach"])
        return F.concat(before, F.get(tags, x["s"]["k"]))

    clean = _let(ordered, disjoint)
    fresh = F.when(F.size(ordered) > 0, clean).otherwise(whole)
    return found.select(
        *(fresh.alias(c) if c == text else F.col(f"`{c}`") for c in documents.columns)
    )
