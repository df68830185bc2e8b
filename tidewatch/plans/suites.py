"""Gate suites over incidents, claims and derived tables, and their summary by suite."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import gates
from tidewatch.operators.scratch import cut
from tidewatch.plans import catalogue, cohorts, incidents, matching, scoring
from tidewatch.plans.tables import ASSERTIONS, OBSERVATIONS, assertions, observations, table

DAY = lambda s: F.lit(s).cast("date")


def _rows(checks):
    """UNION of (name, severity, passed, measured) from (name, measured SQL, operator, limit, FROM, severity)."""
    one = [f"SELECT '{n}' AS name, '{sev}' AS severity, coalesce(({m})::DOUBLE {op} {limit}, false) AS passed, round(({m})::DOUBLE, 6) AS measured FROM {frm}" for n, m, op, limit, frm, sev in checks]
    return " UNION ALL ".join(one)


def breach_gates(spark, sf_dir):
    """Incidents and claims: sources, parse share, dates, people, identities, follow-ups, pairs, events, claims, placeholders."""
    r = cut(matching.records(spark, sf_dir))
    names = matching.organisation_names(spark, sf_dir)
    # each of these is measured by several checks
    f, p = (cut(q(spark, sf_dir)) for q in (incidents.follow_ups, incidents.unit_placement))
    within, across, rows = incidents.unit_pairs(spark, sf_dir)
    u = within.select("a", "b").unionByName(across.select("a", "b"))
    # pairs of records that are there once are made in one place, in a slice of a group or across groups, and are counted there
    once = rows.groupBy("l.row").count().where("count > 1").isEmpty()
    pairs = within.groupBy("grp", "part", "a", "b").count().select("count").unionByName(across.groupBy("a", "b").count().select("count")) if once else u.groupBy("a", "b").count()
    w, h = incidents.claim_winners(spark, sf_dir), incidents.placeholder_disagreement(spark, sf_dir)
    x = matching.record_features(spark, sf_dir)
    i = incidents.organisation_identity(spark, sf_dir)
    known = r.select(F.col("iid").alias("k"))
    return gates.suite([
        gates.check(r, "all_classes_present", F.count_distinct("cls"), "measured = 5"),
        gates.unique_key(r, "one_row_a_record", ["iid"]),
        gates.none_of(r, "names_not_empty", F.coalesce(F.col("nn"), F.lit("")) == ""),
        gates.check(r, "undated_share", F.avg(F.col("ev").isNull().cast("int")), "measured <= 0.9", gates.WARN),
        gates.none_of(r, "events_plausible", F.col("ev") < DAY("1990-01-01")),
        gates.none_of(r, "people_not_negative", F.col("people") < 0),
        gates.none_of(names, "labels_of_domains", F.col("domain").isNotNull() & F.col("label").isNull()),
        gates.none_of(i, "owners_not_later", F.col("owner") > F.col("org")),
        gates.no_orphans(f.where("incident is not null").select(F.col("incident").alias("k")), known, ["k"], "follow_ups_attach_to_records"),
        gates.check(f, "ambiguous_share", F.avg((F.col("how") == "ambiguous").cast("int")), "measured <= 0.05", gates.WARN),
        gates.none_of(f, "reasons_given", F.col("how").isNull()),
        gates.none_of(u, "pairs_in_order", F.col("a") >= F.col("b")),
        gates.none_of(pairs, "one_row_a_pair", F.col("count") > 1),
        gates.unique_key(p, "one_event_a_unit", ["unit"]),
        gates.none_of(p, "placed_in_a_living_event", (F.col("outcome") == "placed") != F.col("event").isNotNull()),
        gates.none_of(x, "country_conflict_is_barred", (F.col("country") == "conflict") & ~F.col("cannot").contains("country_differs")),
        gates.none_of(w, "winners_have_a_value", F.col("quantity").isNull()),
        gates.check(h, "disagreement_share", F.avg(F.col("disagree").cast("int")), "measured <= 0.99", gates.WARN),
        gates.none_of(h, "placeholders_alone", (F.col("lo") == 50) & (F.col("hi") != 50)),
    ]).withColumn("measured", F.round("measured", 6))


_NAMES = f"({matching._NAMES_SQL})"
_BREACH = "WITH r AS (WITH " + matching._RECORDS + " SELECT * FROM recs), nm AS " + _NAMES + ", " + ", ".join(
    f"{k} AS ({m.ORACLE_SQL[q]})" for k, m, q in (("f", incidents, "follow_ups"), ("u", incidents, "unit_links"), ("p", incidents, "unit_placement"), ("w", incidents, "claim_winners"),
                                                ("h", incidents, "placeholder_disagreement"), ("x", matching, "record_features"), ("i", incidents, "organisation_identity"))) + " " + _rows([
    ("all_classes_present", "count(DISTINCT cls)", "=", 5, "r", "ERROR"), ("one_row_a_record", "count(*)", "=", 0, "(SELECT iid FROM r GROUP BY iid HAVING count(*) > 1)", "ERROR"),
    ("names_not_empty", "count(*) FILTER (WHERE coalesce(nn, '') = '')", "=", 0, "r", "ERROR"), ("undated_share", "avg((ev IS NULL)::INT)", "<=", 0.9, "r", "WARN"),
    ("events_plausible", "count(*) FILTER (WHERE ev < DATE '1990-01-01')", "=", 0, "r", "ERROR"), ("people_not_negative", "count(*) FILTER (WHERE people < 0)", "=", 0, "r", "ERROR"),
    ("labels_of_domains", "count(*) FILTER (WHERE domain IS NOT NULL AND label IS NULL)", "=", 0, "nm", "ERROR"), ("owners_not_later", "count(*) FILTER (WHERE owner > org)", "=", 0, "i", "ERROR"),
    ("follow_ups_attach_to_records", "count(*)", "=", 0, "(SELECT * FROM f WHERE incident IS NOT NULL AND incident NOT IN (SELECT iid FROM r))", "ERROR"),
    ("ambiguous_share", "avg((how = 'ambiguous')::INT)", "<=", 0.05, "f", "WARN"), ("reasons_given", "count(*) FILTER (WHERE how IS NULL)", "=", 0, "f", "ERROR"),
    ("pairs_in_order", "count(*) FILTER (WHERE a >= b)", "=", 0, "u", "ERROR"), ("one_row_a_pair", "count(*)", "=", 0, "(SELECT a, b FROM u GROUP BY ALL HAVING count(*) > 1)", "ERROR"),
    ("one_event_a_unit", "count(*)", "=", 0, "(SELECT unit FROM p GROUP BY ALL HAVING count(*) > 1)", "ERROR"), ("placed_in_a_living_event", "count(*) FILTER (WHERE (outcome = 'placed') <> (event IS NOT NULL))", "=", 0, "p", "ERROR"),
    ("country_conflict_is_barred", "count(*) FILTER (WHERE country = 'conflict' AND NOT contains(cannot, 'country_differs'))", "=", 0, "x", "ERROR"),
    ("winners_have_a_value", "count(*) FILTER (WHERE quantity IS NULL)", "=", 0, "w", "ERROR"), ("disagreement_share", "avg(disagree::INT)", "<=", 0.99, "h", "WARN"),
    ("placeholders_alone", "count(*) FILTER (WHERE lo = 50 AND hi <> 50)", "=", 0, "h", "ERROR")])


def derived_gates(spark, sf_dir):
    """Derived tables: consolidation, agreement, cohorts, weeks, technology, scores and scans against their contracts."""
    a, o = assertions(spark, sf_dir), observations(spark, sf_dir)
    k, d = catalogue.kev_consolidated(spark, sf_dir), catalogue.cve_detail(spark, sf_dir)
    g = catalogue.source_agreement_jaccard(spark, sf_dir)
    c, week = cohorts.corpus_cohorts(spark, sf_dir), cohorts.corpus_weekly(spark, sf_dir)
    t, cov, lt = scoring.technology_of(spark, sf_dir), scoring.evidence_coverage(spark, sf_dir), scoring.listed_technology(spark, sf_dir)
    card, s, act = scoring.rule_scorecard(spark, sf_dir), scoring.score_transitions(spark, sf_dir), scoring.activity_ninety(spark, sf_dir)
    part = table(spark, sf_dir, "part").select("p_partkey")
    return gates.suite([
        gates.no_orphans(k.select("vuln"), a.select("vuln"), ["vuln"], "consolidated_has_no_orphans"),
        gates.no_orphans(a.select("vuln"), k.select("vuln"), ["vuln"], "every_listed_one_is_consolidated"),
        gates.unique_key(k, "consolidated_one_row", ["vuln"]), gates.unique_key(d, "detail_one_row", ["vuln"]),
        gates.none_of(k, "sources_within_entries", F.col("source_count") > F.col("entry_count")),
        gates.none_of(g, "jaccard_in_range", ~F.col("jaccard").between(0, 1)),
        gates.check(g, "agreement_ceiling", F.max("jaccard"), "measured < 0.95", gates.WARN),
        gates.check(week, "weeks_present", F.count("*"), "measured >= 100"),
        gates.unique_key(t, "one_category_a_part", ["p_partkey"]), gates.no_orphans(part, t.select("p_partkey"), ["p_partkey"], "every_part_has_a_category"),
        gates.check(cov, "part_shares_sum", F.sum("part_share"), "measured between 99.4 and 100.6"),
        gates.check(cov, "line_shares_sum", F.sum("line_share"), "measured between 99.4 and 100.6"),
        gates.none_of(lt, "emergency_within_all", ~F.col("within_all")),
        gates.check(lt.groupBy("scope", "year").agg(F.sum("share").alias("s")), "technology_shares_sum", F.max(F.abs(F.col("s") - 100)), "measured <= 0.6"),
        gates.none_of(card, "hits_within_backlog", (F.col("hit_all") > F.col("backlog")) | (F.col("hit_new") > F.col("hit_all")) | (F.col("hit_new_clean") > F.col("hit_new"))),
        gates.check(card, "twelve_rules", F.count("*"), "measured = 12"),
        gates.unique_key(s, "one_turn_a_day", ["cve", "day"]), gates.none_of(s, "rises_are_high", (F.col("direction") == "rise") & (F.col("score") < 0.1)),
        gates.none_of(act, "activity_positive", F.col("attempts") <= 0),
        gates.check(o, "sightings_per_day", F.count("*") / F.count_distinct("day"), "measured >= 1", gates.INFO),
        gates.check(c, "cohorts_not_empty", F.count("*"), "measured > 0"),
    ]).withColumn("measured", F.round("measured", 6))


_DERIVED = f"WITH {ASSERTIONS}, {OBSERVATIONS}, " + ", ".join(f"{k} AS ({m.ORACLE_SQL[q]})" for k, m, q in (
    ("kc", catalogue, "kev_consolidated"), ("dt", catalogue, "cve_detail"), ("ga", catalogue, "source_agreement_jaccard"), ("cc", cohorts, "corpus_cohorts"), ("wk", cohorts, "corpus_weekly"), ("tt", scoring, "technology_of"),
    ("cov", scoring, "evidence_coverage"), ("lt", scoring, "listed_technology"), ("card", scoring, "rule_scorecard"), ("st", scoring, "score_transitions"), ("act", scoring, "activity_ninety"))) + " " + _rows([
    ("consolidated_has_no_orphans", "count(*)", "=", 0, "kc WHERE vuln NOT IN (SELECT vuln FROM a)", "ERROR"), ("every_listed_one_is_consolidated", "count(*)", "=", 0, "a WHERE vuln NOT IN (SELECT vuln FROM kc)", "ERROR"),
    ("consolidated_one_row", "count(*)", "=", 0, "(SELECT vuln FROM kc GROUP BY 1 HAVING count(*) > 1)", "ERROR"), ("detail_one_row", "count(*)", "=", 0, "(SELECT vuln FROM dt GROUP BY 1 HAVING count(*) > 1)", "ERROR"),
    ("sources_within_entries", "count(*) FILTER (WHERE source_count > entry_count)", "=", 0, "kc", "ERROR"), ("jaccard_in_range", "count(*) FILTER (WHERE NOT jaccard BETWEEN 0 AND 1)", "=", 0, "ga", "ERROR"),
    ("agreement_ceiling", "max(jaccard)", "<", 0.95, "ga", "WARN"), ("weeks_present", "count(*)", ">=", 100, "wk", "ERROR"), ("one_category_a_part", "count(*)", "=", 0, "(SELECT p_partkey FROM tt GROUP BY 1 HAVING count(*) > 1)", "ERROR"),
    ("every_part_has_a_category", "count(*)", "=", 0, "part WHERE p_partkey NOT IN (SELECT p_partkey FROM tt)", "ERROR"),
    ("part_shares_sum", "sum(part_share)", "BETWEEN", "99.4 AND 100.6", "cov", "ERROR"), ("line_shares_sum", "sum(line_share)", "BETWEEN", "99.4 AND 100.6", "cov", "ERROR"),
    ("emergency_within_all", "count(*) FILTER (WHERE NOT within_all)", "=", 0, "lt", "ERROR"), ("technology_shares_sum", "max(abs(s - 100))", "<=", 0.6, "(SELECT sum(share) AS s FROM lt GROUP BY scope, year)", "ERROR"),
    ("hits_within_backlog", "count(*) FILTER (WHERE hit_all > backlog OR hit_new > hit_all OR hit_new_clean > hit_new)", "=", 0, "card", "ERROR"), ("twelve_rules", "count(*)", "=", 12, "card", "ERROR"),
    ("one_turn_a_day", "count(*)", "=", 0, "(SELECT cve, day FROM st GROUP BY ALL HAVING count(*) > 1)", "ERROR"), ("rises_are_high", "count(*) FILTER (WHERE direction = 'rise' AND score < 0.1)", "=", 0, "st", "ERROR"),
    ("activity_positive", "count(*) FILTER (WHERE attempts <= 0)", "=", 0, "act", "ERROR"), ("sightings_per_day", "count(*) / count(DISTINCT day)", ">=", 1, "o", "INFO"), ("cohorts_not_empty", "count(*)", ">", 0, "cc", "ERROR")])

QUERIES = {"breach_gates": breach_gates, "derived_gates": derived_gates}
ORACLE_SQL = {"breach_gates": _BREACH, "derived_gates": _DERIVED}
