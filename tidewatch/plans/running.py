"""Runs in parts, active versions, repair of links, verdicts by evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import gates, runs
from tidewatch.operators.scratch import cut, new_path
from tidewatch.plans import incidents
from tidewatch.plans.tables import table

#: The runs of staged_runs, with the day before which orders count; the second one's board is faulty, the last repeats the first.
WEEKS = (("week-1", "1997-01-01"), ("week-2", "1999-01-01"), ("week-3", "2003-01-01"), ("week-1", "1997-01-01"))


def staged_runs(spark, sf_dir):
    """Four weekly runs with two parts each: what each step wrote and blocked, and the board that is visible after it.

    The second run lists every list twice, which its gate blocks: the board of the first stays, the other part and the run's record don't wait.
    """
    store = runs.RunStore(spark, new_path(spark, "runs"))
    o = cut(table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("list"), F.to_date("o_orderdate").alias("day"), "o_custkey"))
    steps = []
    for k, (run, until) in enumerate(WEEKS, 1):
        seen = o.where(F.col("day") < F.lit(until).cast("date"))
        board = seen.groupBy("list").agg(F.count("*").alias("n"))
        if run == "week-2":
            board = board.unionByName(board)
        part = lambda name, df, keys: runs.Part({name: df}, lambda t: gates.suite([
            gates.unique_key(t[name], f"one_row_{name}", keys), gates.check(t[name], f"{name}_not_empty", F.count("*"), "measured > 0")]))
        store.run(run, {"fetches": seen.groupBy("list").count()}, {"board": part("board", board, ["list"]), "customers": part("customers", seen.select("o_custkey").distinct(), ["o_custkey"])})
        now = store.runs().where(F.col("run") == run)
        shown = store.visible("board").agg(F.count("*").alias("visible_lists"), F.sum("n").alias("visible_orders"))
        wrote = now.select(F.lit(k).alias("step"), "run", F.coalesce("part", F.lit("all")).alias("part"), "ok", F.concat_ws(",", "blocked").alias("blocked"), "rows")
        # one row shown beside three rows written
        steps.append(wrote.crossJoin(F.broadcast(shown)))
    out = steps[0]
    for s in steps[1:]:
        out = out.unionByName(s)
    return out.join(store.records("fetches").agg(F.count("*").alias("records")), F.lit(True))


def _step(k: int, run: str, until: str, shown: str, ok: bool) -> str:
    seen = f"(SELECT * FROM o WHERE day < DATE '{until}')"
    board = f"(SELECT count(DISTINCT list) FROM {seen})"
    people = f"(SELECT count(DISTINCT o_custkey) FROM {seen})"
    rows = {"board": f"{board} * {int(ok)}", "customers": people, "all": f"{board} * {int(ok)} + {people}"}
    good = {"board": ok, "customers": True, "all": ok}
    return " UNION ALL ".join(
        f"SELECT {k} AS step, '{run}' AS run, '{p}' AS part, {str(good[p]).lower()} AS ok, '{'' if good[p] else 'one_row_board'}' AS blocked, {n} AS rows,"
        f" (SELECT count(DISTINCT list) FROM o WHERE day < DATE '{shown}') AS visible_lists, (SELECT count(*) FROM o WHERE day < DATE '{shown}') AS visible_orders" for p, n in rows.items())


_RUNS = "WITH o AS (SELECT o_orderpriority AS list, CAST(o_orderdate AS DATE) AS day, o_custkey FROM orders), s AS (" + " UNION ALL ".join(
    _step(k, run, until, shown, run != "week-2") for k, ((run, until), shown) in enumerate(zip(WEEKS, ("1997-01-01", "1997-01-01", "2003-01-01", "2003-01-01")), 1)) + """)
SELECT *, (SELECT sum(n) FROM (""" + " UNION ALL ".join(f"SELECT count(DISTINCT list) AS n FROM o WHERE day < DATE '{u}'" for _, u in WEEKS[:3]) + ")) AS records FROM s"


def _scores(spark, sf_dir):
    """Score files of fields (flags) and languages (line states): each quarter's lines, of which those above a quantity count as right."""
    l = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", F.to_date("l_shipdate").alias("ship"))
    day, quarter = F.to_date(F.date_trunc("quarter", "ship")), F.quarter("ship")
    version = F.concat(F.lit("p"), F.year("ship").cast("string"))
    foreign = (quarter == 3) & (F.year("ship") % 2 == 0) & (F.col("l_linenumber") == 1)
    old = (quarter == 4) & (F.year("ship") % 3 == 0) & (F.col("l_linenumber") == 2)
    return l.select(
        F.col("l_returnflag").alias("field"), F.col("l_linestatus").alias("lang"), version.alias("version"), day.alias("day"), F.when(foreign, "x").otherwise(F.col("l_linestatus")).alias("file_lang"),
        F.when(old, "p0").otherwise(version).alias("file_version"), F.lit(1).cast("long").alias("accepted"), (F.col("l_quantity") > quarter).cast("long").alias("correct"))


def version_activations(spark, sf_dir):
    """Verdict on each version and day of scores: activated, or the first rule it misses."""
    return runs.activations(_scores(spark, sf_dir))


def facts_by_version(spark, sf_dir):
    """Each line with the version of its field and language that was active on its day."""
    facts = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("field"), F.col("l_linestatus").alias("lang"), F.to_date("l_shipdate").alias("day"), "l_orderkey", "l_partkey")
    return runs.active_on(facts, cut(runs.activations(_scores(spark, sf_dir)))).select("l_orderkey", "l_partkey", "field", "lang", "day", "version")


_ACTIVATED = """WITH s AS (SELECT l_returnflag AS field, l_linestatus AS lang, CAST(l_shipdate AS DATE) AS ship, l_linenumber, l_quantity FROM lineitem),
f AS (SELECT field, lang, 'p' || year(ship) AS version, date_trunc('quarter', ship)::DATE AS day, CASE WHEN quarter(ship) = 3 AND year(ship) % 2 = 0 AND l_linenumber = 1 THEN 'x' ELSE lang END AS file_lang,
  CASE WHEN quarter(ship) = 4 AND year(ship) % 3 = 0 AND l_linenumber = 2 THEN 'p0' ELSE 'p' || year(ship) END AS file_version, (l_quantity > quarter(ship))::BIGINT AS correct FROM s),
v AS (SELECT field, lang, version, day, count(*) AS accepted, sum(correct)::BIGINT AS correct, CASE WHEN NOT bool_and(file_lang = lang) THEN 'other language' WHEN NOT bool_and(file_version = version) THEN 'other prompt'
  WHEN count(*) < 5 THEN 'too few' WHEN sum(correct) < 0.95 * count(*) THEN 'not precise' ELSE 'activated' END AS verdict FROM f GROUP BY ALL)"""
_BY_VERSION = f"""{_ACTIVATED}, a AS (SELECT field, lang, day, max(version) AS version FROM v WHERE verdict = 'activated' GROUP BY ALL),
x AS (SELECT l_orderkey, l_partkey, l_returnflag AS field, l_linestatus AS lang, CAST(l_shipdate AS DATE) AS day FROM lineitem)
SELECT l_orderkey, l_partkey, x.field, x.lang, x.day, version FROM x ASOF LEFT JOIN a ON x.field = a.field AND x.lang = a.lang AND x.day >= a.day"""


def _press(spark, sf_dir):
    """(press-only rows, incidents of all classes): some follow-ups, some with stated years, some linked already."""
    r = incidents._rows(spark, sf_dir)
    dup = F.when(F.col("row") % 17 == 0, F.col("row") - 1)
    year = F.when(F.col("row") % 4 == 0, F.array(F.year("public") - (F.col("row") % 5).cast("int"))).otherwise(F.array().cast("array<int>"))
    rows = r.where("cls = 'press'").select("row", "org", "event", "public", (F.col("people") % 3 == 0).alias("follow_up"), year.alias("years"), dup.alias("dup_of"))
    return rows, r.select(F.col("row").alias("incident"), "org", "event", "public", F.col("cls").isin("reg", "sec", "hibp").alias("structured"), dup.alias("dup_of"))


def press_repair(spark, sf_dir):
    """The repair of each press-only row, and why it can't be applied to the rows as they have become since."""
    rows, known = _press(spark, sf_dir)
    plan = cut(runs.repair_plan(rows, known))
    # since the plan was made every 13th row went and every 29th was linked by hand to the next one
    later = F.when(F.col("incident") % 29 == 0, F.col("incident") + 1).otherwise(F.col("dup_of"))
    current = known.where("incident % 13 <> 0").select(F.col("incident").alias("row"), later.alias("dup_of"))
    return runs.checked_plan(plan, current)


_PLAN = f"""WITH RECURSIVE {incidents._R}, k AS (SELECT row AS incident, org, event AS iev, public AS ipub, cls IN ('reg', 'sec', 'hibp') AS structured, CASE WHEN row % 17 = 0 THEN row - 1 END AS idup FROM rw),
p AS (SELECT row, org, event, public, people % 3 = 0 AS follow_up, CASE WHEN row % 4 = 0 THEN [year(public) - row % 5] ELSE [] END AS years, CASE WHEN row % 17 = 0 THEN row - 1 END AS dup_of FROM rw WHERE cls = 'press'),
j AS (SELECT p.*, k.incident, iev, ipub, idup, (NOT structured, idup IS NOT NULL, ipub, incident) AS rank, coalesce(ipub <= public - 180, false) AS is_older,
  event IS NOT NULL AND CASE WHEN iev IS NOT NULL THEN abs(iev - event) <= 30 ELSE ipub - event BETWEEN 0 AND 270 END AS ev_ok,
  len(years) > 0 AND CASE WHEN iev IS NOT NULL THEN year(iev) = years[1] ELSE ipub BETWEEN make_date(years[1], 1, 1) AND make_date(years[1], 12, 31) + 270 END AS year_ok
  FROM p LEFT JOIN k ON k.org = p.org AND incident <> row AND ipub <= public AND idup IS DISTINCT FROM row),
g AS (SELECT row, arg_min(incident, rank) FILTER (WHERE ev_ok) AS by_event, arg_min(incident, rank) FILTER (WHERE year_ok) AS by_year, count(*) FILTER (WHERE is_older AND idup IS NULL) AS roots,
  arg_min(incident, rank) FILTER (WHERE is_older AND idup IS NULL) AS root, bool_or(is_older) AS older FROM j GROUP BY row),
f AS (SELECT p.*, g.by_event, g.by_year, g.roots, g.root, coalesce(older, false) AS older, len(years) > 0 AND years[1] <= year(public) - 2 AS old_year FROM p LEFT JOIN g USING (row)),
h AS (SELECT *, CASE WHEN NOT (follow_up OR old_year OR older) THEN NULL WHEN by_event IS NOT NULL THEN 'event_window' WHEN by_year IS NOT NULL AND event IS NULL THEN 'stated_year'
  WHEN follow_up AND event IS NULL AND len(years) = 0 AND roots = 1 THEN 'only_older_incident' END AS found FROM f),
pl AS (SELECT row, follow_up, old_year, older, CASE WHEN found IS NOT NULL THEN CASE WHEN dup_of IS NOT NULL THEN 'review' ELSE 'duplicate' END WHEN follow_up THEN 'review' ELSE 'keep' END AS action,
  CASE found WHEN 'event_window' THEN by_event WHEN 'stated_year' THEN by_year WHEN 'only_older_incident' THEN root END AS target,
  CASE WHEN found IS NOT NULL THEN CASE WHEN dup_of IS NOT NULL THEN 'already_linked' ELSE found END WHEN follow_up THEN 'no_older_incident' WHEN old_year THEN 'late_notice' WHEN older THEN 'older_row_no_shared_date' END AS how FROM h),
cu AS (SELECT incident AS row, CASE WHEN incident % 29 = 0 THEN incident + 1 ELSE idup END AS dup FROM k WHERE incident % 13 <> 0),
ck AS (SELECT pl.*, c.row IS NOT NULL AS here, c.dup, t.row IS NOT NULL AS there FROM pl LEFT JOIN cu c ON c.row = pl.row LEFT JOIN cu t ON t.row = pl.target),
lk AS (SELECT row AS a, target AS b FROM ck WHERE action = 'duplicate' AND dup IS NULL AND here AND there UNION ALL SELECT row, dup FROM cu WHERE dup IS NOT NULL),
wk AS (SELECT a, b, 1 AS n FROM lk UNION ALL SELECT wk.a, lk.b, n + 1 FROM wk JOIN lk ON lk.a = wk.b WHERE wk.a <> wk.b AND n < 200),
ci AS (SELECT DISTINCT a FROM wk WHERE a = b)
SELECT row, follow_up, old_year, older, action, target, how, CASE WHEN action = 'duplicate' THEN CASE WHEN NOT here THEN 'row is gone' WHEN dup IS NOT NULL THEN 'linked meanwhile' WHEN NOT there THEN 'target is gone'
  WHEN row IN (SELECT a FROM ci) THEN 'would close a circle' END END AS refused FROM ck"""

QUERIES = {f.__name__: f for f in (staged_runs, version_activations, facts_by_version, press_repair)}
ORACLE_SQL = dict(zip(QUERIES, (_RUNS, f"{_ACTIVATED} SELECT * FROM v", _BY_VERSION, _PLAN)))
