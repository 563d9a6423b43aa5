"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document; the ledger keeps one bit per failed rule and the numbers
behind them. A policy is a named, versioned mask of rules: applying it, or asking what would change
without one of its rules, is bit arithmetic on the ledger, never another pass over the texts.

Everything is an expression on one row: nothing is shuffled but the sums of an ablation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devicepulse.llm.common import SPACES, words


@dataclass(frozen=True)
class Rule:
    """A document fails where the condition on its measurements holds."""

    name: str
    fails: str


# Base rules first. The order fixes the bits: add new rules at the end.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "4 * n_symbols > n_words"),
    Rule("repeated_lines", "n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("capitals", "100 * n_capitals > 50 * word_chars"),
    Rule("exclamations", "4 * n_exclamations > n_words"),
)
BASE = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """Which rules reject a document, under a name and version."""

    name: str
    version: int
    rules: tuple[str, ...] = field(default_factory=tuple)

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        at = {r.name: i for i, r in enumerate(rules)}
        return sum(1 << at[name] for name in self.rules)


POLICIES = (
    Policy("base", 1, BASE),
    Policy("web", 1, (*BASE, "symbols", "repeated_lines", "word_length")),
    Policy("web", 2, tuple(r.name for r in RULES)),
)
PRODUCTION = POLICIES[-1]


def _windows(found: Column) -> Column:
    """Hashes of the three-word windows, in order."""
    at = F.when(F.size(found) >= 3, F.sequence(F.lit(0), F.size(found) - 3)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(at, lambda i: F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2)))


def _bind(value: Column, then) -> Column:
    """A column bound as the element of a one-element array, which evaluates it once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _repeated_places(hashes: Column) -> Column:
    """Places of the hashes that occur at least twice, sorted by whole hashes."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.cast("bigint").alias("at"))))

    def found(sorted_pairs: Column) -> Column:
        hash_at = lambda j: F.get(sorted_pairs, j)["hash"]
        hit = lambda p, j: (
            F.coalesce(hash_at(j - 1) == p["hash"], F.lit(False)) | F.coalesce(hash_at(j + 1) == p["hash"], F.lit(False))
        )
        return F.sort_array(F.transform(F.filter(sorted_pairs, hit), lambda p: p["at"]))

    return _bind(pairs, found)


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs at least twice.

    The hashes are sorted with their place packed into the low bits, so that equal ones are neighbours:
    n log n on a primitive array, for texts of any length. Neighbours are compared by their whole
    hashes. Where two unlike hashes share the bits that are left, equal ones need not be neighbours; such
    a text is sorted anew by whole hash and place. Each repeated window covers three words, less those
    that the next one covers too.
    """

    def places(sizes: Column) -> Column:
        low = F.call_function("shiftleft", F.lit(1).cast("bigint"), sizes) - 1

        low_free = F.bitwise_not(low)

        def repeated(packed: Column) -> Column:
            whole = lambda j: F.get(hashes, F.get(packed, j).bitwiseAND(low).cast("int"))
            high = lambda j: F.get(packed, j).bitwiseAND(low_free)
            hit = lambda p, j: (
                F.coalesce(whole(j) == whole(j - 1), F.lit(False))
                | F.coalesce(whole(j) == whole(j + 1), F.lit(False))
            )
            clash = lambda p, j: (high(j) == high(j + 1)) & (whole(j) != whole(j + 1))
            found = F.sort_array(F.transform(F.filter(packed, hit), lambda p: p.bitwiseAND(low)))
            return F.when(F.size(F.filter(packed, clash)) > 0, _repeated_places(hashes)).otherwise(found)

        packed = F.sort_array(F.transform(hashes, lambda h, i: h.bitwiseAND(low_free).bitwiseOR(i)))
        return _bind(packed, repeated)

    def total(starts: Column) -> Column:
        steps = F.transform(
            starts, lambda s, j: F.least(F.lit(3), F.coalesce(F.get(starts, j + 1) - s, F.lit(3)))
        )
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    bits = F.length(F.bin(F.size(hashes)))
    found = _bind(_bind(bits, places), total)
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(found)


def _only(text: Column, characters: str) -> Column:
    """How many characters of a text are in a class."""
    return F.length(F.regexp_replace(text, f"[^{characters}]+", "")).cast("bigint")


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements that rules read, as bigint columns.

    n_words, word_chars (code points in words), n_symbols (of `#*$%&|<>`), n_lines (lines with a word),
    n_dup_lines (lines with a word, equal to an earlier line), n_repeat_words (words in three-word
    windows found twice or more, the first included), n_capitals, n_exclamations. A null or empty
    text has 0 of each. Columns of these names are replaced. Windows are compared by 64-bit hashes.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(f"[^{SPACES}]"))
    # Words and hashes are columns of their own, so that each is made once.
    kept = [F.col(f"`{c}`") for c in df.columns if c not in MEASURES]
    held = df.select(*kept, words(whole).alias(_WORDS), lines.alias(_LINES))
    held = held.withColumn(_HASHES, _windows(F.col(_WORDS)))
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    made = {
        "n_words": F.size(_WORDS).cast("bigint"),
        "word_chars": F.length(F.array_join(_WORDS, "")).cast("bigint"),
        "n_symbols": _only(whole, "#*$%&|<>"),
        "n_lines": F.size(_LINES).cast("bigint"),
        "n_dup_lines": (F.size(_LINES) - F.size(F.array_distinct(_LINES))).cast("bigint"),
        "n_repeat_words": _covered(F.col(_HASHES)),
        "n_capitals": _only(whole, r"\p{Lu}"),
        "n_exclamations": _only(whole, "!"),
    }
    return held.select(*kept, *[made[name].alias(name) for name in MEASURES])


MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_capitals",
    "n_exclamations",
)
_WORDS, _LINES, _HASHES = "__rule_words", "__rule_lines", "__rule_hashes"


def ledger(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add the measurements and `failed_rules`, a bigint with bit i set where rule i fails."""
    if len(rules) > 63:
        raise ValueError("a ledger holds at most 63 rules")
    bits = [F.expr(f"CASE WHEN {r.fails} THEN {1 << i}L ELSE 0L END") for i, r in enumerate(rules)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(df, text).withColumn("failed_rules", failed)


def passes(policy: Policy, rules: Sequence[Rule] = RULES, failed: str = "failed_rules") -> Column:
    """Whether a ledger row has none of the policy's bits."""
    return F.col(failed).bitwiseAND(F.lit(policy.mask(rules)).cast("bigint")) == 0


def apply(df: DataFrame, policy: Policy = PRODUCTION, text: str = "text") -> DataFrame:
    """The documents that a policy keeps, with the columns and types that they had.

    Every row is judged on its own, repeated ones too. Columns named like a measurement are carried
    along as they are.
    """
    held = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")
    slim = df.select(held, F.col(f"`{text}`").alias("__text"))
    # A generator between the ledger and the filter: a filter pushed below would take the measurements'
    # expressions with it and evaluate them once for every place that they are used in.
    whole = F.struct("__row", "failed_rules")
    judged = ledger(slim, "__text").select(F.inline(F.array(whole)))
    return judged.where(passes(policy)).select("__row.*")


def ablation(
    ledgered: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """What each rule of each policy does: (policy, version, rule, n_documents, n_kept, n_failed,
    n_only): the documents in all, kept, failing the rule, and failing no other rule of the policy, which
    are those that come back without the rule.

    Documents fold to one row per distinct set of failed bits, at most 2^rules, before anything else.
    An empty ledger gives no rows.
    """
    patterns = ledgered.groupBy("failed_rules").agg(F.count("*").alias("n"))
    asked = [
        F.struct(
            F.lit(p.name).alias("policy"),
            F.lit(p.version).alias("version"),
            F.lit(name).alias("rule"),
            F.lit(p.mask(rules)).cast("bigint").alias("mask"),
            F.lit(1 << [r.name for r in rules].index(name)).cast("bigint").alias("bit"),
        )
        for p in policies
        for name in p.rules
    ]
    rows = patterns.select("failed_rules", "n", F.inline(F.array(*asked)))
    hit = F.col("failed_rules").bitwiseAND(F.col("mask"))
    count = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return rows.groupBy("policy", "version", "rule").agg(
        F.sum("n").alias("n_documents"),
        count(hit == 0).alias("n_kept"),
        count(hit.bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count(hit == F.col("bit")).alias("n_only"),
    )
