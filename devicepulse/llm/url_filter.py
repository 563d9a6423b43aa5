"""URL filters: domain rules, and a character model for what no rule decides.

Two variable-order Markov models of characters, one of accepted and one of rejected URLs, are counted over
all URLs that rules decide. The probability of a character after a context is smoothed towards that
after the shorter contexts by how many different characters were seen to follow (Witten-Bell). A URL's
score is the difference of its two log-likelihoods over its length; it is rejected below a
threshold that is calibrated on all decided URLs, each fifth of them scored by the counts of the others.

URLs are counted and scored as grams of `ORDER` + 1 characters over a small alphabet, so the model has a
bounded number of rows whatever the number of URLs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devicepulse.llm.common import stored

ORDER = 3  # characters of context
FOLDS = 5  # parts of the decided URLs, each left out of the counts once, to calibrate on
STEP = 0.01  # of the threshold


@dataclass(frozen=True)
class DomainRule:
    """Fits `host` and its subdomains where the path starts with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    DomainRule("block", "net", "/"),
    DomainRule("allow", "example.net", "/en/"),
    DomainRule("block", "example.com", "/de/"),
    DomainRule("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    """Between the first `://` and the next `/`, `?`, `#` or the end, A-Z lower-cased."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host, up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[DomainRule] = RULES) -> Column:
    """The longest rule that fits, as (rule, verdict); null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    # The last `when` put around is looked at first.
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(
            fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        ).otherwise(found)
    return found


def _letters(url: Column) -> Column:
    """The URL over the model's alphabet: a-z, `/.-_?=&#:%`, 0 for every digit, and * for the rest; with a
    beginning for the first contexts and an end."""
    small = F.translate(
        F.coalesce(url, F.lit("")),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789",
        "abcdefghijklmnopqrstuvwxyz000000000",
    )
    plain = F.regexp_replace(small, r"[^a-z0/.\-_?=&#:%]", "*")
    return F.concat(F.lit("^" * ORDER), plain, F.lit("$"))


def _grams(letters: Column) -> Column:
    """All runs of ORDER + 1 letters, one per predicted letter."""
    at = F.sequence(F.lit(1), F.length(letters) - ORDER)
    return F.explode(F.transform(at, lambda i: F.substr(letters, i, F.lit(ORDER + 1))))


def _probabilities(counts: DataFrame, models: Sequence[str] = ()) -> DataFrame:
    """(gram, kept, dropped) counts to (gram, ratio): log P(last letter | context) under the model of
    accepted URLs less that under the model of rejected ones, for every gram in `counts`. Columns named
    in `models` tell apart counts that make models of their own."""
    classes = ("kept", "dropped")
    alphabet = 26 + 10 + 1 + 1 + 1
    table = counts
    for c in classes:
        table = table.withColumn(f"p_{c}", F.lit(1.0 / alphabet))
    for order in range(ORDER + 1):
        # The gram's last order + 1 letters; its context is all but the last of them.
        tail = F.substring("gram", ORDER + 1 - order, order + 1)
        context = F.substring("gram", ORDER + 1 - order, order)
        table = table.withColumn("_tail", tail).withColumn("_context", context)
        sums = table.groupBy(*models, "_tail", "_context").agg(*[F.sum(c).alias(f"n_{c}") for c in classes])
        # At most a row per letter of the alphabet in each context.
        beside = Window.partitionBy(*models, "_context")
        made = sums
        for c in classes:
            made = made.withColumn(f"all_{c}", F.sum(f"n_{c}").over(beside)).withColumn(
                f"kinds_{c}", F.sum((F.col(f"n_{c}") > 0).cast("int")).over(beside)
            )
        table = table.join(made.drop("_context"), [*models, "_tail"])
        for c in classes:
            seen = F.col(f"all_{c}") + F.col(f"kinds_{c}")
            mixed = (F.col(f"n_{c}") + F.col(f"kinds_{c}") * F.col(f"p_{c}")) / seen
            table = table.withColumn(f"p_{c}", F.when(seen > 0, mixed).otherwise(F.col(f"p_{c}")))
        extra = [f"{x}_{c}" for c in classes for x in ("n", "all", "kinds")]
        table = table.drop("_tail", "_context", *extra)
    return table.select(*models, "gram", (F.log("p_kept") - F.log("p_dropped")).alias("ratio"))


def _model_counts(known: DataFrame) -> DataFrame:
    """(_letters, verdict, n) to (model, gram, kept, dropped): model f counts the decided URLs outside fold f,
    model FOLDS all of them. Every gram of any URL has a row in each model."""
    grams = known.select(_grams(F.col("_letters")).alias("gram"), _fold(F.col("_letters")).alias("fold"), "verdict", "n")
    parts = grams.groupBy("gram", "fold").agg(
        *[
            F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)).alias(c)
            for c, v in (("kept", "allow"), ("dropped", "block"))
        ]
    )
    apart = lambda c, m: F.sum(F.when(F.col("fold") == m, 0).otherwise(F.col(c))).alias(c)
    sums = [F.struct(F.lit(m).alias("model"), apart("kept", m), apart("dropped", m)) for m in range(FOLDS + 1)]
    return parts.groupBy("gram").agg(F.array(*sums).alias("_models")).select("gram", F.inline("_models"))


def _fold(letters: Column) -> Column:
    return F.pmod(F.xxhash64(letters), F.lit(FOLDS)).cast("int")


def _scores(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """(_letters, model) to (_letters, score), one row per distinct URL."""
    grams = urls.select("_letters", "model", _grams(F.col("_letters")).alias("gram"))
    return grams.join(ratios, ["model", "gram"]).groupBy("_letters").agg(F.avg("ratio").alias("score"))


def _threshold(scored: DataFrame) -> float:
    """Where the mean of the two classes' error rates is least on (score, verdict, n) rows; in steps, so
    that only one row per step is put in order, and of equal steps the one nearest to 0. Without both
    classes, below every score: then nothing is rejected."""
    counts = scored.groupBy(F.floor(F.col("score") / STEP).alias("at"), "verdict").agg(F.sum("n").alias("n"))
    upto = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    steps = counts.groupBy("at").agg(
        F.sum(F.when(F.col("verdict") == "allow", F.col("n")).otherwise(0)).alias("kept"),
        F.sum(F.when(F.col("verdict") == "block", F.col("n")).otherwise(0)).alias("dropped"),
    )
    lost = F.coalesce(F.sum("kept").over(upto), F.lit(0)) / F.nullif(F.sum("kept").over(whole), F.lit(0))
    caught = F.coalesce(F.sum("dropped").over(upto), F.lit(0)) / F.nullif(F.sum("dropped").over(whole), F.lit(0))
    # Anywhere between two steps that hold URLs the error is the same; take the place nearest to 0.
    above = F.coalesce(F.lag("at").over(Window.orderBy("at")) + 1, F.least("at", F.lit(0)))
    best = (
        steps.select(F.least("at", F.greatest(above, F.lit(0))).alias("at"), (lost - caught).alias("loss"))
        .where(F.col("loss").isNotNull())
        .orderBy("loss", F.abs("at"), "at")
        .limit(1)
        .collect()
    )
    return best[0]["at"] * STEP if best else float("-inf")


def judge(pages: DataFrame, rules: Sequence[DomainRule] = RULES, url: str = "url") -> DataFrame:
    """Add host, path, rule, verdict (`allow` or `block`) and score to every row.

    A rule decides where one fits; its rows have no score. Other URLs are blocked if their score is below
    the threshold, by the counts of all decided URLs. A null URL, or one without `://`, has an empty host and path and is judged by the model
    as the text it has. Repeated URLs are scored once. Where rules decide no URL, or all alike,
    everything else is allowed. Columns of the added names are replaced.
    """
    added = ("host", "path", "rule", "verdict", "score")
    kept = [c for c in pages.columns if c not in added]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row")
    text = F.col(f"`{url}`")
    cut = pages.select(row, host_of(text).alias("host"), path_of(text).alias("path"), _letters(text).alias("_letters"))
    ruled = cut.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    known = stored(
        ruled.groupBy("_letters", F.col("_rule.verdict").alias("verdict")).agg(F.count("*").alias("n")), "known"
    )
    ratios = stored(_probabilities(stored(_model_counts(known), "grams"), ["model"]), "ratios")
    decided = known.where(F.col("verdict").isNotNull())
    apart = decided.select("_letters", _fold(F.col("_letters")).alias("model")).distinct()
    bar = _threshold(decided.join(_scores(apart, ratios), "_letters"))
    scores = _scores(known.where(F.col("verdict").isNull()).select("_letters", F.lit(FOLDS).alias("model")), ratios)
    model = F.when(F.col("score") < F.lit(bar), "block").otherwise("allow")
    open_to_it = (ruled["_letters"] == scores["_letters"]) & F.col("_rule").isNull()
    return ruled.join(scores, open_to_it, "left").select(
        *[F.col(f"_row.`{c}`") for c in kept],
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", model).alias("verdict"),
        "score",
    )
