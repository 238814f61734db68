"""Quality rules by weak supervision, with DataFrame functions only.

Each rule looks at one measure of a whole text and votes for it (1), against it (-1) or
abstains (0), as where the measure lies between two bounds or the text is too short to tell. Votes are counted by pattern over all documents. Expectation-maximisation estimates how
often each rule votes for, against and not at all in good and in bad texts, and the share of good ones; a
text's chance of being good, given all its rules' votes, decides. So a text may break a rule
that turns out to say little, and no rule decides alone.

The pattern counts are at most 3 to the power of the number of rules, whatever the input; only
they reach the driver. Rows are handled by themselves, and the only shuffle is that of the
counts.

A null text has no words and counts as an empty one. Texts of few words, or mostly of repeated
ones, fail beforehand whatever the rules say (``base_failed``); they don't vote. Repeated rows
are each returned. Very long texts are measured whole, in time near their length (repeated
windows are found by sorting). Without voting texts there is no estimate, and no text to judge.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eclusa.llm.frames import free_name, staged

# What separates words, what counts as a symbol, and the least words of a text.
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 50
# A word of letters, maybe with a mark or two around it.
PLAIN_WORD = (
    r"(?<![^\x20\x09-\x0D])[\"'(\[]?[\p{L}\p{M}'’-]++[.,;:!?)\]\"']{0,2}+(?![^\x20\x09-\x0D])"
)
# Bits of a number that hold a run's place in the text; the others hold its hash.
PLACE_BITS = 24
ROUNDS = 50
THRESHOLD = 0.5
# Share of good texts to begin with, and how often rules vote in good texts and in bad ones;
# each estimate starts from so many texts that do.
PRIOR, BEFORE = 0.8, 10.0
IN_GOOD = {1: 0.55, 0: 0.4, -1: 0.05}
IN_BAD = {1: 0.25, 0: 0.4, -1: 0.35}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value in it, which is computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- measures ---


def _neighbours(ordered: Column, same: Callable[[Column, Column], Column]) -> Column:
    """Elements of a sorted array, ``x``, that are the same as the one before or after."""
    beside = F.arrays_zip(
        ordered.alias("x"),
        F.concat(F.array(F.lit(None)), ordered).alias("before"),
        F.slice(ordered, F.lit(2), F.size(ordered)).alias("after"),
    )
    kept = F.filter(
        beside, lambda z: same(z["x"], z["before"]) | F.coalesce(same(z["x"], z["after"]), F.lit(False))
    )
    return F.transform(kept, lambda z: z["x"])


def _repeated_words(words: Column) -> Column:
    """Words that lie in a run of three that the text has more than once.

    Runs whose hashes recur are the candidates, found by sorting numbers of a hash and a place;
    among them runs are the same only if their words are.
    """
    places = (1 << PLACE_BITS) - 1

    def hashed(w: Column, i: Column) -> Column:
        h = F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
        return h.bitwiseAND(F.lit(~places)).bitwiseOR(i.cast("long"))

    def same_hash(a: Column, b: Column) -> Column:
        return F.shiftright(a, PLACE_BITS) == F.shiftright(b, PLACE_BITS)

    last = F.size(words) - 2
    numbers = F.sort_array(F.slice(F.transform(words, hashed), F.lit(1), last))
    recurring = F.transform(
        let(numbers, lambda n: _neighbours(n, same_hash)), lambda x: x.bitwiseAND(F.lit(places)).cast("int")
    )
    # In a text of more words than a place has room for every run is a candidate.
    whole = F.sequence(F.lit(0), last - 1)
    candidates = F.when(last <= places, recurring).otherwise(whole)
    # Words have no blanks, so that joined runs are equal only if all three words are.
    keyed = F.transform(
        candidates,
        lambda i: F.struct(
            F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("k"), i.alias("i")
        ),
    )
    same = let(F.array_sort(keyed), lambda x: _neighbours(x, lambda a, b: a["k"] == b["k"]))
    found = F.array_sort(F.transform(same, lambda x: x["i"]))

    def cover(acc: Column, i: Column) -> Column:
        return F.struct((acc["n"] + i + 3 - F.greatest(i, acc["end"])).alias("n"), (i + 3).alias("end"))

    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.when(F.size(words) < 4, 0).otherwise(F.aggregate(found, start, cover, lambda acc: acc["n"]))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def measured(documents: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """The documents with a struct of their texts' measures, ``measures`` or the next free name."""
    name = free_name(documents.columns, "measures")
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    # A text that begins or ends with blanks has an empty piece there.
    words = F.array_remove(F.split(whole, BLANKS), "")
    by_words = let(
        words,
        lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeated_words(w).cast("long").alias("repeated")),
    )
    by_lines = let(
        lines,
        lambda n: F.struct(
            F.size(n).cast("long").alias("n"),
            (F.size(n) - F.size(F.array_distinct(n))).cast("long").alias("repeated"),
        ),
    )
    small = F.char_length(whole) - F.char_length(F.regexp_replace(whole, r"\p{Ll}++", ""))

    def measures(w: Column, n: Column) -> Column:
        return F.struct(
            w["n"].alias("n_words"),
            F.char_length(F.translate(whole, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
            _count(whole, SYMBOLS).alias("n_symbols"),
            n["repeated"].alias("n_dup_lines"),
            w["repeated"].alias("n_repeat_words"),
            n["n"].alias("n_lines"),
            _count(whole, PLAIN_WORD).alias("n_plain"),
            small.cast("long").alias("n_lower"),
            _count(whole, r"\p{Lu}").alias("n_upper"),
            _count(whole, "[.!?,;:]").alias("n_marks"),
            _count(whole, "!").alias("n_shouts"),
        )

    return documents.withColumn(name, let(by_words, lambda w: let(by_lines, lambda n: measures(w, n)))), name


def base_failed(m: Column) -> Column:
    return (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


# --- rules ---


@dataclass(frozen=True)
class Rule:
    """Votes for texts whose share of ``part`` in ``whole`` lies within ``good``, and against
    those where it is outside ``fair``; abstains otherwise, and where ``whole`` is under ``least``.
    Without ``good`` it only ever votes against: to be without a fault says little.
    """

    name: str
    part: str
    whole: str
    fair: tuple[float, float]
    good: tuple[float, float] | None = None
    least: int = 1

    def vote(self, m: Column) -> Column:
        share = m[self.part] / m[self.whole]
        against = F.when(m[self.whole] < self.least, 0).when(~share.between(*self.fair), -1)
        return (against.when(share.between(*self.good), 1) if self.good else against).otherwise(0)


RULES = (
    Rule("symbols", "n_symbols", "n_words", (0, 0.1)),
    Rule("shouts", "n_shouts", "n_words", (0, 0.2)),
    Rule("capitals", "n_upper", "word_chars", (0, 0.4)),
    Rule("word_length", "word_chars", "n_words", (2.5, 13)),
    Rule("repeats", "n_repeat_words", "n_words", (0, 0.3)),
    Rule("lines", "n_dup_lines", "n_lines", (0, 0.3), None, 3),
    Rule("plain_words", "n_plain", "n_words", (0.5, 1), (0.85, 1)),
    Rule("small_letters", "n_lower", "word_chars", (0.6, 1), (0.85, 1)),
    Rule("marks", "n_marks", "n_words", (0.002, 0.7), (0.02, 0.4)),
)

Votes = tuple[int, ...]


def votes(m: Column, rules: Sequence[Rule] = RULES) -> Column:
    return F.array(*(r.vote(m) for r in rules))


# --- accuracies ---


@dataclass(frozen=True)
class Model:
    """Log odds of a good text, and what each rule's vote adds to them, by the vote."""

    bias: float
    weights: tuple[dict[int, float], ...]

    def chance(self, voted: Column) -> Column:
        """The chance of a good text, as an expression of its votes."""
        z = F.lit(self.bias)
        for j, own in enumerate(self.weights):
            vote = F.get(voted, F.lit(j))
            z += F.when(vote == 1, own[1]).when(vote == -1, own[-1]).otherwise(own[0])
        return 1 / (1 + F.exp(-z))


def _weights(good: dict[int, float], bad: dict[int, float]) -> dict[int, float]:
    """Log odds of each vote; a vote never speaks for the opposite of what it means."""
    own = {
        v: math.log(good[v] / sum(good.values())) - math.log(bad[v] / sum(bad.values())) for v in (1, 0, -1)
    }
    return {1: max(own[1], 0.0), 0: own[0], -1: min(own[-1], 0.0)}


def accuracies(patterns: dict[Votes, float], n: int, rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over the counts of vote patterns, for ``n`` rules.

    Rules are taken to vote independently in good texts and in bad ones, at rates that are
    estimated from the texts' chances, and the chances from the rates by turns.
    """
    model = Model(math.log(PRIOR / (1 - PRIOR)), (_weights(IN_GOOD, IN_BAD),) * n)
    for _ in range(rounds):
        chance = {}
        for p in patterns:
            z = model.bias + sum(w[v] for v, w in zip(p, model.weights, strict=True))
            chance[p] = 1 / (1 + math.exp(-max(min(z, 500), -500)))
        weights = []
        for j in range(n):
            good = {v: BEFORE * x for v, x in IN_GOOD.items()}
            bad = {v: BEFORE * x for v, x in IN_BAD.items()}
            for p, c in patterns.items():
                good[p[j]] += c * chance[p]
                bad[p[j]] += c * (1 - chance[p])
            weights.append(_weights(good, bad))
        good = PRIOR * BEFORE + sum(c * chance[p] for p, c in patterns.items())
        bad = (1 - PRIOR) * BEFORE + sum(c * (1 - chance[p]) for p, c in patterns.items())
        model = Model(math.log(good / bad), tuple(weights))
    return model


def pattern_counts(voted: DataFrame, name: str) -> dict[Votes, float]:
    """Number of texts by their votes: at most three to the power of the number of rules."""
    rows = voted.groupBy(f"`{name}`").count().collect()
    return {tuple(r[0]): float(r[1]) for r in sorted(rows)}


def scan(
    documents: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id``, ``measures``, ``votes``, ``base_failed``, ``quality`` and ``kept`` of each row.

    ``quality`` is the chance of a good text by its rules' votes.
    """
    found, name = measured(documents, text)
    found = found.select("doc_id", F.col(f"`{name}`").alias("measures"))
    m = F.col("measures")
    found = staged(found.withColumns({"votes": votes(m, rules), "base_failed": base_failed(m)}), "rules-votes")
    model = accuracies(pattern_counts(found.filter("not base_failed"), "votes"), len(rules))
    chance = found.withColumn("quality", model.chance(F.col("votes")))
    return chance.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
