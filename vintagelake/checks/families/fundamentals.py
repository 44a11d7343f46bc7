"""Fundamentals normalisation."""

from pyspark.sql import functions as F

from vintagelake import seeds
from vintagelake.checks.registry import check
from vintagelake.checks.views import AS_OF, SQL_VIEWS, Views
from vintagelake.operators import asof, fundamentals
from vintagelake.sources import bronze

_FORMS = "('10-K', '10-Q', '10-K/A', '10-Q/A')"
SQL_VIEWS["concept_rules"] = (
    "SELECT *, concept IN ('debt_current', 'debt_noncurrent') AS prefer FROM ("
    + seeds.values_sql(seeds.CONCEPTS, "concept, statement, expected_unit") + ")"
)
SQL_VIEWS["tag_alias"] = seeds.values_sql(seeds.ALIASES, "concept, tag, priority, confidence")
SQL_VIEWS["accepted"] = f"SELECT * FROM raw_facts WHERE form IN {_FORMS}"
SQL_VIEWS["mapping"] = """
    SELECT r.*, a.concept, a.priority, a.confidence, c.statement, c.expected_unit, c.prefer,
      CASE WHEN a.concept IS NULL THEN r.tag
        WHEN NOT (c.expected_unit IS NULL OR lower(trim(r.unit)) = lower(c.expected_unit))
          THEN r.tag || '#UNIT_MISMATCH(expected=' || c.expected_unit || ',got=' || r.unit || ')' END AS unmapped_tag
    FROM accepted r LEFT JOIN tag_alias a ON a.tag = r.tag LEFT JOIN concept_rules c ON c.concept = a.concept"""
SQL_VIEWS["mapped_facts"] = "SELECT * FROM mapping WHERE unmapped_tag IS NULL"
_G = "security_id, accession, concept, period_start, period_end"
_RANK = "CASE confidence WHEN 'HIGH' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'LOW' THEN 2 ELSE 9 END"
SQL_VIEWS["fact_groups"] = f"""
    SELECT {_G}, count(DISTINCT tag) AS n_tags, min(value) AS lo, max(value) AS hi, bool_or(prefer) AS prefer,
      count(DISTINCT CASE WHEN rank = best THEN tag END) AS best_tags
    FROM (SELECT *, {_RANK} AS rank, min({_RANK}) OVER (PARTITION BY {_G}) AS best FROM mapped_facts)
    GROUP BY {_G}"""
SQL_VIEWS["fact_resolution"] = """
    SELECT *, CASE WHEN NOT (n_tags > 1 AND (hi - lo) / greatest(abs(lo), abs(hi), 1) > 0.005) THEN 'agreed'
      WHEN prefer AND best_tags = 1 THEN 'by_confidence' ELSE 'conflict' END AS resolution FROM fact_groups"""
_ON = "r.security_id = m.security_id AND r.accession = m.accession AND r.concept = m.concept AND r.period_end = m.period_end AND r.period_start IS NOT DISTINCT FROM m.period_start"
SQL_VIEWS["chosen"] = f"""
    SELECT m.*, r.resolution FROM mapped_facts m JOIN fact_resolution r ON {_ON}
    WHERE r.resolution <> 'conflict'
    QUALIFY row_number() OVER (PARTITION BY m.security_id, m.accession, m.concept, m.period_start, m.period_end
      ORDER BY CASE WHEN r.resolution = 'by_confidence' THEN {_RANK} ELSE 0 END, m.priority, m.tag, m.ordinal) = 1"""
SQL_VIEWS["conflicting"] = f"""
    SELECT m.security_id, m.accession, m.concept, m.period_start, m.period_end,
      arg_min(struct_pack(t := m.tag, v := m.value), (m.value, m.ordinal)) AS lo,
      arg_max(struct_pack(t := m.tag, v := m.value), (m.value, -m.ordinal)) AS hi,
      arg_min(struct_pack(t := m.tag, v := m.value), m.ordinal) AS first,
      list(struct_pack(o := m.ordinal, t := m.tag, v := m.value) ORDER BY m.ordinal) AS everyone
    FROM mapped_facts m JOIN fact_resolution r ON {_ON}
    WHERE r.resolution = 'conflict' GROUP BY ALL"""

_DATES = "CAST(period_start AS VARCHAR) AS period_start, CAST(period_end AS VARCHAR) AS period_end"
_KEY = f"security_id, accession, concept, {_DATES}"


def _documents(v: Views):
    """A company-facts document per reported entry, with entries that must be ignored beside it."""
    one = F.struct(
        F.col("period_start").cast("string").alias("start"), F.col("period_end").cast("string").alias("end"),
        F.col("value").alias("val"), F.col("accession").alias("accn"), F.lit(2000).alias("fy"),
        F.col("fiscal_period").alias("fp"), "form", F.col("filed_date").cast("string").alias("filed"),
    )
    no_end = F.struct(
        F.lit(None).cast("string").alias("start"), F.lit(None).cast("string").alias("end"), F.col("value").alias("val"),
        F.col("accession").alias("accn"), F.lit(2000).alias("fy"), F.col("fiscal_period").alias("fp"), "form",
        F.col("filed_date").cast("string").alias("filed"),
    )
    bad_day = F.struct(
        F.lit("1999-13-45").alias("start"), F.col("period_end").cast("string").alias("end"), F.col("value").alias("val"),
        F.col("accession").alias("accn"), F.lit(2000).alias("fy"), F.col("fiscal_period").alias("fp"), "form",
        F.col("filed_date").cast("string").alias("filed"),
    )
    entries = F.array(no_end, one, bad_day)
    gaap = F.create_map("tag", F.struct(F.create_map("unit", entries).alias("units")))
    facts = F.create_map(F.lit("us-gaap"), gaap, F.lit("dei"), gaap)
    doc = F.to_json(F.struct(F.col("security_id").cast("string").alias("cik"), facts.alias("facts")))
    return v.raw_facts.select("security_id", F.col("ordinal").alias("line"), doc.alias("text"))


def _raw(v: Views):
    return v.raw_facts.where(F.col("form").isin(*bronze.FORMS))


def _mapping(v: Views):
    index = fundamentals.alias_index(seeds.aliases(v.spark), seeds.concepts(v.spark))
    return fundamentals.map_facts(_raw(v), index)


def _mapped(v: Views):
    return fundamentals.mapped(_mapping(v))


@check(
    "source_company_facts",
    f"""SELECT security_id, tag, unit, value, {_DATES}, form, 2000 AS fiscal_year, fiscal_period, accession,
          CAST(filed_date AS VARCHAR) AS filed_date, ordinal AS line, 1 AS ordinal FROM accepted""",
)
def _(v: Views):
    return bronze.company_facts(_documents(v))


@check(
    "fund_alias_index",
    """SELECT a.concept, a.tag, a.priority, a.confidence, c.statement, c.expected_unit,
         c.prefer AS prefer_higher_confidence, coalesce(f.n, 0) AS facts
       FROM tag_alias a JOIN concept_rules c USING (concept)
       LEFT JOIN (SELECT tag, count(*) AS n FROM raw_facts GROUP BY tag) f ON f.tag = a.tag""",
)
def _(v: Views):
    index = fundamentals.alias_index(seeds.aliases(v.spark), seeds.concepts(v.spark))
    used = v.raw_facts.groupBy("tag").agg(F.count(F.lit(1)).alias("facts"))
    return index.join(used, "tag", "left").withColumn("facts", F.coalesce("facts", F.lit(0)))


@check(
    "fund_map",
    f"SELECT {_KEY}, tag, unit, ordinal, value, unmapped_tag FROM mapping",
)
def _(v: Views):
    return _mapping(v).select(*fundamentals.GROUP, "tag", "unit", "ordinal", "value", "unmapped_tag")


@check(
    "fund_unit_check",
    """SELECT accession, ordinal, unit, c.expected_unit,
         c.expected_unit IS NULL OR lower(trim(r.unit)) = lower(c.expected_unit) AS matches
       FROM raw_facts r JOIN tag_alias a ON a.tag = r.tag JOIN concept_rules c ON c.concept = a.concept""",
)
def _(v: Views):
    index = fundamentals.alias_index(seeds.aliases(v.spark), seeds.concepts(v.spark))
    return v.raw_facts.join(index, "tag").select(
        "accession", "ordinal", "unit", "expected_unit", fundamentals.unit_matches().alias("matches")
    )


@check(
    "fund_group_resolution",
    f"SELECT {_KEY}, n_tags, lo, hi, resolution FROM fact_resolution",
)
def _(v: Views):
    out = fundamentals.resolve_groups(_mapped(v))
    return out.select(
        *fundamentals.GROUP, "n_tags", F.col("lo.value").alias("lo"), F.col("hi.value").alias("hi"), "resolution"
    )


@check(
    "fund_chosen",
    f"SELECT {_KEY}, tag, resolution, value, unit, form, fiscal_period, CAST(filed_date AS VARCHAR) AS filed_date FROM chosen",
)
def _(v: Views):
    return fundamentals.chosen_facts(_mapped(v))


@check(
    "fund_conflicts",
    f"""SELECT {_KEY},
          CASE WHEN lo.t = hi.t THEN first.t ELSE lo.t END AS tag_a,
          CASE WHEN lo.t = hi.t THEN first.v ELSE lo.v END AS value_a,
          CASE WHEN lo.t = hi.t THEN list_filter(everyone, lambda x: x.t <> first.t)[1].t ELSE hi.t END AS tag_b,
          CASE WHEN lo.t = hi.t THEN list_filter(everyone, lambda x: x.t <> first.t)[1].v ELSE hi.v END AS value_b
        FROM conflicting""",
)
def _(v: Views):
    return fundamentals.conflicts(_mapped(v))


@check(
    "fund_filings",
    """SELECT security_id, accession, form, CAST(period_end AS VARCHAR) AS period_end, fiscal_period,
         CAST(filed_date AS VARCHAR) AS filed_date FROM mapped_facts
       QUALIFY row_number() OVER (PARTITION BY accession ORDER BY ordinal, period_end, form) = 1""",
)
def _(v: Views):
    return fundamentals.filings(_mapped(v))


@check(
    "fund_filings_append",
    f"""SELECT security_id, accession, form, CAST(period_end AS VARCHAR) AS period_end, fiscal_period,
          CAST(filed_date AS VARCHAR) AS filed_date FROM mapped_facts WHERE accession NOT IN (
            SELECT accession FROM mapped_facts WHERE filed_date <= DATE '{AS_OF}')
        QUALIFY row_number() OVER (PARTITION BY accession ORDER BY ordinal, period_end, form) = 1""",
)
def _(v: Views):
    facts = _mapped(v)
    stored = fundamentals.filings(facts.where(F.col("filed_date") <= F.lit(AS_OF)))
    return fundamentals.new_filings(stored, facts)


@check(
    "fund_append",
    f"""SELECT {_KEY}, tag, value FROM chosen WHERE filed_date > DATE '{AS_OF}'""",
)
def _(v: Views):
    # Facts filed by AS_OF are stored already; appending everything again adds only the later ones.
    chosen = fundamentals.chosen_facts(_mapped(v))
    stored = chosen.where(F.col("filed_date") <= F.lit(AS_OF))
    return fundamentals.new_facts(stored, chosen).select(*fundamentals.GROUP, "tag", "value")


@check(
    "fund_unmapped_append",
    f"""SELECT security_id, accession, unmapped_tag AS tag, value, unit, ordinal FROM mapping
        WHERE unmapped_tag IS NOT NULL AND filed_date > DATE '{AS_OF}'""",
)
def _(v: Views):
    facts = _mapping(v)
    logged = fundamentals.unmapped(facts.where(F.col("filed_date") <= F.lit(AS_OF)))
    return fundamentals.new_unmapped(logged, facts)


_STORED = """SELECT security_id, concept, period_start, period_end, value FROM chosen WHERE filed_date <= DATE '{d}'
    QUALIFY row_number() OVER (PARTITION BY security_id, concept, period_end, period_start
      ORDER BY filed_date DESC, accession DESC, value DESC, trim(unit) DESC) = 1""".format(d=AS_OF)


def _stored(v: Views):
    return fundamentals.stored_form(fundamentals.chosen_facts(_mapped(v)))


@check(
    "fund_computed",
    f"""WITH s AS ({_STORED}), w AS (
          SELECT security_id, period_start, period_end, max(value) FILTER (WHERE concept = 'debt_current') AS dc,
            max(value) FILTER (WHERE concept = 'debt_noncurrent') AS dn, max(value) FILTER (WHERE concept = 'cfo') AS cfo,
            max(value) FILTER (WHERE concept = 'capex') AS capex, max(value) FILTER (WHERE concept = 'operating_income') AS oi,
            max(value) FILTER (WHERE concept = 'depreciation_amortization') AS da FROM s GROUP BY ALL)
        SELECT security_id, 'total_debt' AS concept, {_DATES}, dc + dn AS value FROM w WHERE dc + dn IS NOT NULL
        UNION ALL SELECT security_id, 'ebitda', {_DATES}, oi + da FROM w WHERE oi + da IS NOT NULL
        UNION ALL SELECT security_id, 'fcf', {_DATES}, cfo + capex FROM w WHERE cfo + capex IS NOT NULL""",
)
def _(v: Views):
    return fundamentals.computed_concepts(asof.fundamentals_asof(_stored(v), AS_OF))


@check(
    "fund_duration_class",
    """SELECT accession, ordinal, period_end - period_start AS days,
         CASE WHEN period_start IS NULL THEN 'instant' WHEN period_end - period_start BETWEEN 85 AND 95 THEN 'quarterly'
           WHEN period_end - period_start BETWEEN 350 AND 380 THEN 'annual' ELSE 'other' END AS duration
       FROM raw_facts""",
)
def _(v: Views):
    return v.raw_facts.select(
        "accession", "ordinal", fundamentals.duration_days().alias("days"), fundamentals.duration_class().alias("duration")
    )
