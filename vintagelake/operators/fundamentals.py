"""Reported facts to canonical concepts, with an explicit conflict policy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintagelake.functions.temporal import day_start
from vintagelake.operators.select import absent_from, append_missing, first_per_key

# Fixed value: values of one filing that differ by more than this conflict.
CONFLICT_TOLERANCE = 0.005
# Inclusive day counts of annual and quarterly flows.
ANNUAL_DAYS = (350, 380)
QUARTER_DAYS = (85, 95)

# A larger alias table than this is no dictionary and is refused.
MAX_ALIASES = 10_000
GROUP = ["security_id", "accession", "concept", "period_start", "period_end"]


def confidence_rank(column: str = "confidence") -> Column:
    return (
        F.when(F.col(column) == "HIGH", 0).when(F.col(column) == "MEDIUM", 1)
        .when(F.col(column) == "LOW", 2).otherwise(9)
    )


def alias_index(aliases: DataFrame, concepts: DataFrame) -> DataFrame:
    """One alias per tag, the smallest priority number first, with its concept's rules."""
    one = first_per_key(aliases, ["tag"], [F.col("priority"), F.col("concept")])
    rules = concepts.select("concept", "statement", "expected_unit", "prefer_higher_confidence")
    return one.join(rules, "concept")


def unit_matches(unit: str = "unit", expected: str = "expected_unit") -> Column:
    """Trimmed text equals the expected unit; USD, USD/shares and shares ignore case."""
    got = F.trim(F.col(unit))
    folded = F.lower(got)
    normal = (
        F.when(folded == "usd", "USD").when(folded == "usd/shares", "USD/shares")
        .when(folded == "shares", "shares").otherwise(got)
    )
    return F.col(expected).isNull() | (got == F.col(expected)) | (normal == F.col(expected))


def small(df: DataFrame, most: int) -> DataFrame:
    """A dictionary table for broadcasting, after its size was checked."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows in a dictionary table")
    return F.broadcast(df)


def map_facts(raw: DataFrame, index: DataFrame) -> DataFrame:
    """Every raw fact with its concept, or with the tag text to log as unmapped."""
    joined = raw.join(small(index, MAX_ALIASES), "tag", "left")
    mismatch = F.format_string(
        "%s#UNIT_MISMATCH(expected=%s,got=%s)", F.col("tag"), F.col("expected_unit"), F.col("unit")
    )
    unmapped = F.when(F.col("concept").isNull(), F.col("tag")).when(~unit_matches(), mismatch)
    return joined.withColumn("unmapped_tag", unmapped)


def mapped(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("unmapped_tag").isNull())


def unmapped(facts: DataFrame) -> DataFrame:
    """Log rows keyed by filing, so a second run adds nothing."""
    return facts.where(F.col("unmapped_tag").isNotNull()).select(
        "security_id", "accession", F.col("unmapped_tag").alias("tag"), "value", "unit", "ordinal"
    )


def new_unmapped(existing: DataFrame, facts: DataFrame) -> DataFrame:
    return absent_from(unmapped(facts), existing, ["accession", "tag", "value", "unit", "ordinal"])


def _pick() -> list:
    """What a chosen fact carries to storage."""
    return ["value", "unit", "form", "fiscal_period", "filed_date"]


def group_summary(facts: DataFrame) -> DataFrame:
    """One row per (filing, concept, period) with all that the policy needs, in one aggregation.

    A tag has one confidence, so the strongest tags are those of the rows with the best rank. The set of tags
    is bounded by the alias table.
    """
    ranked = facts.withColumn("_rank", confidence_rank())
    choice = F.struct("priority", "tag", "ordinal", *_pick())
    return ranked.groupBy(*GROUP).agg(
        F.size(F.collect_set("tag")).cast("bigint").alias("n_tags"),
        F.min(F.struct("value", "ordinal", "tag", "unit")).alias("lo"),
        F.max(F.struct("value", (-F.col("ordinal")).alias("ordinal"), "tag")).alias("hi"),
        F.min(choice).alias("choice"),
        F.min(F.struct(F.col("_rank").alias("rank"), choice.alias("choice"))).alias("strong"),
        F.max(F.struct((-F.col("_rank")).alias("r"), "tag")).alias("last_strong"),
        F.min(F.struct(F.col("_rank").alias("rank"), "tag")).alias("first_strong"),
        F.max("prefer_higher_confidence").alias("prefer"),
    )


def _resolution() -> Column:
    """agreed, by_confidence or conflict, from the summary of a group."""
    base = F.greatest(F.abs("lo.value"), F.abs("hi.value"), F.lit(1.0))
    differ = (F.col("hi.value") - F.col("lo.value")) / base > CONFLICT_TOLERANCE
    disagree = (F.col("n_tags") > 1) & differ
    unique_best = F.col("first_strong.tag") == F.col("last_strong.tag")
    return F.when(~disagree, "agreed").when(F.col("prefer") & unique_best, "by_confidence").otherwise("conflict")


def resolve_groups(facts: DataFrame) -> DataFrame:
    """Adds resolution: agreed, by_confidence or conflict."""
    return group_summary(facts).withColumn("resolution", _resolution())


def chosen_facts(facts: DataFrame) -> DataFrame:
    """One fact per group without a conflict: by priority, or the strongest tag's."""
    c = F.when(F.col("resolution") == "by_confidence", F.col("strong.choice")).otherwise(F.col("choice"))
    ok = resolve_groups(facts).where(F.col("resolution") != "conflict").withColumn("c", c)
    return ok.select(*GROUP, F.col("c.tag").alias("tag"), "resolution", *[F.col(f"c.{x}").alias(x) for x in _pick()])


def conflicts(facts: DataFrame) -> DataFrame:
    """The two disagreeing facts: smallest and largest value, or the first differently tagged pair.

    One pass over the facts: each tag of a group is reduced to its first and extreme facts, then the tags of a
    group meet. A group lists one struct for each tag, which the alias table bounds.
    """
    ranked = facts.withColumn("_rank", confidence_rank())
    by_tag = ranked.groupBy(*GROUP, "tag").agg(
        F.min(F.struct("ordinal", "value", "tag")).alias("first"),
        F.min(F.struct("value", "ordinal", "tag")).alias("lo"),
        F.max(F.struct("value", (-F.col("ordinal")).alias("ordinal"), "tag")).alias("hi"),
        F.min(F.struct(F.col("_rank").alias("rank"), "tag")).alias("strong"),
        F.max("prefer_higher_confidence").alias("prefer"),
    )
    weaker = F.struct((-F.col("strong.rank")).alias("r"), F.col("tag"))
    groups = by_tag.groupBy(*GROUP).agg(
        F.count("tag").alias("n_tags"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.min("strong").alias("first_strong"), F.max(weaker).alias("last_strong"), F.max("prefer").alias("prefer"),
        F.sort_array(F.collect_list("first")).alias("firsts"),
    )
    # Extremes of one tag say nothing about a disagreement of tags.
    same = F.col("lo.tag") == F.col("hi.tag")
    a = F.when(same, F.col("firsts")[0]).otherwise(F.struct("lo.ordinal", "lo.value", "lo.tag"))
    b = F.when(same, F.col("firsts")[1]).otherwise(F.struct("hi.ordinal", "hi.value", "hi.tag"))
    bad = groups.where(_resolution() == "conflict").select(*GROUP, a.alias("a"), b.alias("b"))
    return bad.select(
        *GROUP, F.col("a.tag").alias("tag_a"), F.col("a.value").alias("value_a"),
        F.col("b.tag").alias("tag_b"), F.col("b.value").alias("value_b"),
    )


def filings(facts: DataFrame) -> DataFrame:
    """One filing per accession, first seen wins."""
    return first_per_key(
        facts.select("security_id", "accession", "form", "period_end", "fiscal_period", "filed_date", "ordinal"),
        ["accession"],
        [F.col("ordinal"), F.col("period_end"), F.col("form")],
    ).drop("ordinal")


def new_filings(existing: DataFrame, facts: DataFrame) -> DataFrame:
    return absent_from(filings(facts), existing, ["accession"])


FACT_KEY = ["accession", "concept", "period_end", "period_start"]


def new_facts(existing: DataFrame, chosen: DataFrame) -> DataFrame:
    """Facts to append; a null period_start equals a null period_start."""
    return append_missing(existing, chosen, FACT_KEY, [F.col("tag"), F.col("value")])


def stored_form(chosen: DataFrame) -> DataFrame:
    """Chosen facts as stored: decimal value, filed date at midnight UTC."""
    return chosen.select(
        "security_id", "accession", "concept", "period_start", "period_end", "fiscal_period",
        F.col("value").cast("decimal(38,9)").alias("value"), F.trim("unit").alias("unit"),
        day_start(F.col("filed_date")).alias("filed_at"),
    )


def duration_days(start: str = "period_start", end: str = "period_end") -> Column:
    return F.datediff(end, start)


def duration_class(start: str = "period_start", end: str = "period_end") -> Column:
    days = duration_days(start, end)
    return (
        F.when(F.col(start).isNull(), "instant")
        .when(days.between(*QUARTER_DAYS), "quarterly")
        .when(days.between(*ANNUAL_DAYS), "annual")
        .otherwise("other")
    )


# Concepts computed on read as a sum of two reported ones.
COMPUTED = {
    "total_debt": ("debt_current", "debt_noncurrent"),
    "ebitda": ("operating_income", "depreciation_amortization"),
    "fcf": ("cfo", "capex"),
}


def computed_concepts(facts: DataFrame, capex_sign: int = 1, names: Sequence[str] = tuple(COMPUTED)) -> DataFrame:
    """Sums of two reported concepts over the same period; null when a part is missing.

    facts: one known value per (security, concept, period); of repeated ones the largest counts. capex_sign=-1 turns
    reported payments into outflows.
    """
    parts = sorted({p for n in names for p in COMPUTED[n]})
    wide = (
        facts.where(F.col("concept").isin(parts))
        .groupBy("security_id", "period_start", "period_end")
        .pivot("concept", parts)
        .agg(F.max("value"))
    )

    def part(name: str) -> Column:
        return F.col(name) * capex_sign if name == "capex" else F.col(name)

    sums = F.array(
        *[
            F.struct(F.lit(n).alias("concept"), (part(COMPUTED[n][0]) + part(COMPUTED[n][1])).alias("value"))
            for n in names
        ]
    )
    return (
        wide.select("security_id", "period_start", "period_end", F.explode(sums).alias("s"))
        .select("security_id", "s.concept", "period_start", "period_end", "s.value")
        .where(F.col("value").isNotNull())
    )
