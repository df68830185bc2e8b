"""Runs, cursors, decisions, candidates, retention and queues over the tables in their roles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions import text as T
from tidewatch.operators import ledger
from tidewatch.plans.tables import ASSERTIONS, OBSERVATIONS, assertions, observations, table

DAY = lambda s: F.lit(s).cast("date")


def decision_withdrawal(spark, sf_dir):
    """Entries withdrawn by listed decisions: two lists decide on dear entries, and the earlier decision counts."""
    a = assertions(spark, sf_dir)
    live = a.select("entry", "vuln", F.when(F.col("withdrawn"), DAY("1999-01-01")).alias("withdrawn_at"))
    dear = a.where("price > 300000")
    decisions = dear.where("source = '1-URGENT'").select("entry", F.date_add("added", 30).alias("decided")).unionByName(
        dear.where("price > 450000").select("entry", F.date_add("added", 10).alias("decided")))
    return ledger.withdraw_listed(live, decisions, ["entry"], "decided")


_DECISION = f"""WITH {ASSERTIONS}, d AS (SELECT entry, min(decided) AS decided FROM (
  SELECT entry, added + 30 AS decided FROM a WHERE price > 300000 AND source = '1-URGENT' UNION ALL SELECT entry, added + 10 FROM a WHERE price > 450000) GROUP BY 1)
SELECT entry, vuln, coalesce(CASE WHEN withdrawn THEN DATE '1999-01-01' END, decided) AS withdrawn_at FROM a LEFT JOIN d USING (entry)"""


def scd2_deferred(spark, sf_dir):
    """New and changed customers of 1998 against 1997: two hundred are appended in a run, the others deferred."""
    a = assertions(spark, sf_dir).withColumn("year", F.year("added"))
    last = lambda y: a.where(F.col("year") == y).groupBy("vuln").agg(F.max_by("source", F.struct("added", "entry")).alias("digest"))
    return ledger.append_capped(last(1997), last(1998), "vuln", "digest", 200)


_DEFERRED = f"""WITH {ASSERTIONS}, l AS (SELECT year(added) AS y, vuln, arg_max(source, (added, entry)) AS digest FROM a GROUP BY ALL),
m AS (SELECT n.vuln, n.digest FROM (SELECT * FROM l WHERE y = 1998) n LEFT JOIN (SELECT * FROM l WHERE y = 1997) o USING (vuln) WHERE n.digest IS DISTINCT FROM o.digest)
SELECT vuln, digest, CASE WHEN row_number() OVER (ORDER BY vuln) <= 200 THEN 'appended' ELSE 'deferred' END AS outcome FROM m"""


def _runs(spark, sf_dir):
    """A run per sensor and day; one with fewer than half the sensor's mean sightings has failed."""
    o = observations(spark, sf_dir).groupBy("source", "day").agg(F.sum("n").alias("n"))
    mean = o.groupBy("source").agg(F.avg("n").alias("mean"))
    return o.join(mean, "source").select("source", "day", (F.col("n") >= F.col("mean") / 2).alias("ok"))


_RUNS = f"""{OBSERVATIONS}, n AS (SELECT source, day, sum(n) AS n FROM o GROUP BY ALL), runs AS (SELECT source, day, n >= avg(n) OVER (PARTITION BY source) / 2 AS ok FROM n)"""


def source_watermarks(spark, sf_dir):
    return ledger.source_state(_runs(spark, sf_dir), "source", "day", "ok")


_WATERMARKS = f"""WITH {_RUNS}, g AS (SELECT source, max(day) AS last_run, max(day) FILTER (WHERE ok) AS last_success FROM runs GROUP BY source)
SELECT g.*, (SELECT count(*) FROM runs r WHERE r.source = g.source AND (last_success IS NULL OR r.day > last_success)) AS failures FROM g"""


def resume_cursors(spark, sf_dir):
    """Per sensor: where the next collection starts, from daily windows with their outcome."""
    w = _runs(spark, sf_dir).select("source", F.col("day").alias("lo"), F.date_add("day", 1).alias("hi"), "ok")
    return ledger.resume_points(w, "source", "lo", "hi", "ok")


_RESUME = f"WITH {_RUNS} SELECT source, coalesce(min(day) FILTER (WHERE NOT ok), max(day) + 1) AS resume_at FROM runs GROUP BY source"


def unseen_candidates(spark, sf_dir):
    """Hosts of pages in other languages that no English page is on."""
    p = table(spark, sf_dir, "pages").select(T.domain_of(F.col("url")).alias("host"), F.col("url").rlike("/en/").alias("known"))
    return ledger.unseen(p.where("not known"), p.where("known"), ["host"])


_HOST = r"regexp_replace(regexp_extract(lower(trim(url)), '^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@]*@)?([^/:?#]+)', 1), '^www\.|\.$', '', 'g')"
_UNSEEN = f"""WITH p AS (SELECT {_HOST} AS host, regexp_matches(url, '/en/') AS known FROM pages)
SELECT DISTINCT host FROM p WHERE NOT known AND host NOT IN (SELECT host FROM p WHERE known)"""


def registry_replace(spark, sf_dir):
    """Customers listed in 1996 replaced as a whole by those of 1997."""
    a = assertions(spark, sf_dir)
    return ledger.replaced_whole(a.where("year(added) = 1996"), a.where("year(added) = 1997"), "vuln")


_REPLACE = f"""WITH {ASSERTIONS}, x AS (SELECT DISTINCT vuln FROM a WHERE year(added) = 1996), y AS (SELECT DISTINCT vuln, true AS n FROM a WHERE year(added) = 1997)
SELECT vuln, CASE WHEN x.o IS NULL THEN 'added' WHEN n IS NULL THEN 'removed' ELSE 'kept' END AS outcome FROM (SELECT vuln, true AS o FROM x) x FULL JOIN y USING (vuln)"""


def payloads_kept(spark, sf_dir):
    """Hourly deltas per day that no day bundle has superseded; a day is bundled once a fifth of its sightings are purchases."""
    e = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), F.hour("ts").alias("hour"), "event_type")
    bundles = e.groupBy("day").agg(F.count_if(F.col("event_type") == "purchase").alias("p"), F.count("*").alias("n")).where("5 * p >= n")
    deltas = e.groupBy("day", "hour").agg(F.count("*").alias("n"))
    return ledger.without_superseded(deltas, bundles, "day")


_PAYLOADS = """WITH e AS (SELECT CAST(ts AS DATE) AS day, hour(ts)::INT AS hour, event_type FROM events)
SELECT day, hour, count(*) AS n FROM e WHERE day NOT IN (SELECT day FROM e GROUP BY day HAVING 5 * count(*) FILTER (WHERE event_type = 'purchase') >= count(*)) GROUP BY ALL"""


def event_records(spark, sf_dir):
    """One record per customer from three origins, the first wins: urgent entries, open high ones, all others by their latest."""
    a = assertions(spark, sf_dir).select("vuln", "added", "entry", "source", "withdrawn")
    pick = lambda d: d.groupBy("vuln").agg(F.min(F.struct("added", "entry")).alias("r")).select("vuln", "r.*")
    return ledger.first_by_origin([pick(a.where("source = '1-URGENT'")), pick(a.where("source = '2-HIGH' and not withdrawn")), pick(a)], "vuln")


_RECORDS = f"""WITH {ASSERTIONS}, u AS (SELECT 0 AS origin, * FROM a WHERE source = '1-URGENT' UNION ALL SELECT 1, * FROM a WHERE source = '2-HIGH' AND NOT withdrawn UNION ALL SELECT 2, * FROM a)
SELECT vuln, origin, added, entry FROM u QUALIFY row_number() OVER (PARTITION BY vuln ORDER BY origin, added, entry) = 1"""


def event_rows(spark, sf_dir):
    """An order's row comes from its best kind of line (returned, accepted, none), then the earliest, then the smallest part."""
    l = table(spark, sf_dir, "lineitem")
    rank = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    best = F.min(F.struct(rank.alias("rank"), F.to_date("l_shipdate").alias("day"), "l_partkey", "l_suppkey"))
    return l.groupBy("l_orderkey").agg(best.alias("b"), F.count_distinct("l_returnflag").alias("kinds")).select("l_orderkey", "kinds", "b.*")


_ROWS = """WITH l AS (SELECT *, CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS rank, count(DISTINCT l_returnflag) OVER (PARTITION BY l_orderkey) AS kinds FROM lineitem)
SELECT l_orderkey, kinds, rank::INT AS rank, CAST(l_shipdate AS DATE) AS day, l_partkey, l_suppkey FROM l
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY rank, CAST(l_shipdate AS DATE), l_partkey, l_suppkey) = 1"""


def previous_weeks(spark, sf_dir):
    """Each list's week with the last week before it, within 21 days, that was not provisional (at least two entries)."""
    w = assertions(spark, sf_dir).groupBy("source", F.to_date(F.date_trunc("week", "added")).alias("week")).agg(F.count("*").alias("n"))
    return ledger.latest_before(w, ["source"], "week", F.col("n") >= 2, 21)


_PREVIOUS = f"""WITH {ASSERTIONS}, w AS (SELECT source, date_trunc('week', added)::DATE AS week, count(*) AS n FROM a GROUP BY ALL),
p AS (SELECT *, max(CASE WHEN n >= 2 THEN week END) OVER (PARTITION BY source ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM w)
SELECT source, week, n, CASE WHEN week - p <= 21 THEN p END AS previous FROM p"""


def first_seen(spark, sf_dir):
    """First day of each (network, flag, line number) and the parts seen on it."""
    l = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linenumber", F.to_date("l_shipdate").alias("day"), "l_partkey")
    return l.groupBy("l_suppkey", "l_returnflag", "l_linenumber").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.min_by("l_partkey", F.struct("day", "l_partkey")).alias("first_part"))


_FIRST = """SELECT l_suppkey, l_returnflag, l_linenumber, min(CAST(l_shipdate AS DATE)) AS first_day, max(CAST(l_shipdate AS DATE)) AS last_day,
  arg_min(l_partkey, (CAST(l_shipdate AS DATE), l_partkey)) AS first_part FROM lineitem GROUP BY ALL"""


def latest_claim_texts(spark, sf_dir):
    """Per order the parts of its lines, the latest version of each line number, joined in order."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey")
    return ledger.latest_texts(l, "l_orderkey", "l_linenumber", ["l_shipdate", "l_partkey"], "l_partkey").withColumnRenamed("l_partkey", "parts")


_TEXTS = """WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC) = 1)
SELECT l_orderkey, string_agg(l_partkey::VARCHAR, ' ' ORDER BY l_linenumber) AS parts, count(*) AS versions FROM v GROUP BY l_orderkey"""


def extraction_backlog(spark, sf_dir):
    """The next two hundred entries of the last 21 days to read: not read yet, fewer than two failures, newest first (the limit is the feature)."""
    a = assertions(spark, sf_dir)
    last = a.agg(F.max("added").alias("last"))
    recent = a.crossJoin(F.broadcast(last)).where(F.col("added") > F.date_sub("last", 21)).select("entry", "vuln", "added")
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("entry"), "l_returnflag", "l_linestatus")
    done = l.where("l_returnflag = 'R' and l_linestatus = 'F'").select("entry").distinct()
    failed = l.where("l_returnflag = 'N'").groupBy("entry").agg(F.count("*").alias("failures"))
    left = recent.join(done, "entry", "left_anti").join(failed, "entry", "left").withColumn("failures", F.coalesce("failures", F.lit(0)))
    return left.where("failures < 2").orderBy(F.desc("added"), F.desc("entry")).limit(200)


_BACKLOG = f"""WITH {ASSERTIONS}, f AS (SELECT l_orderkey AS entry, count(*) AS n FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1)
SELECT entry, vuln, added, coalesce(n, 0) AS failures FROM a LEFT JOIN f USING (entry) WHERE added > (SELECT max(added) FROM a) - 21
  AND entry NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F') AND coalesce(n, 0) < 2 ORDER BY added DESC, entry DESC LIMIT 200"""


def month_schedule(spark, sf_dir):
    """Months in order: stored, stored as refused (few entries), and all from the first that must wait for a missing list."""
    m = assertions(spark, sf_dir).groupBy(F.trunc("added", "month").alias("month")).agg(F.count("*").alias("entries"), F.count_distinct("source").alias("lists"))
    verdict = F.when((F.col("lists") < 5) | (F.col("month") >= DAY("2001-06-01")), "wait").when(F.col("entries") % 10 < 3, "refuse").otherwise("store")
    return ledger.due_months(m.withColumn("verdict", verdict), "month", "verdict")


_SCHEDULE = f"""WITH {ASSERTIONS}, m AS (SELECT date_trunc('month', added)::DATE AS month, count(*) AS entries, count(DISTINCT source) AS lists FROM a GROUP BY 1),
v AS (SELECT *, CASE WHEN lists < 5 OR month >= DATE '2001-06-01' THEN 'wait' WHEN entries % 10 < 3 THEN 'refuse' ELSE 'store' END AS verdict FROM m),
f AS (SELECT *, min(month) FILTER (WHERE verdict = 'wait') OVER () AS f FROM v)
SELECT month, entries, lists, verdict, CASE WHEN month = f THEN 'wait' WHEN month > f THEN 'blocked' WHEN verdict = 'refuse' THEN 'store refused' ELSE 'store' END AS action FROM f"""


def unchanged_feeds(spark, sf_dir):
    """Per week and sensor: its digest, whether it is the week before's, and whether all four sensors have come in by then."""
    o = observations(spark, sf_dir).withColumn("week", F.to_date(F.date_trunc("week", "day")))
    w = o.groupBy("source", "week").agg(F.sum("n").alias("n"), F.max("day").alias("last_day"))
    before = w.select("source", F.date_add("week", 7).alias("week"), F.col("n").alias("was"))
    full = w.groupBy("week").agg((F.count("*") == 4).alias("all_collected"))
    lag = F.datediff(F.date_add("week", 6), "last_day") * 24
    return w.join(before, ["source", "week"], "left").join(full, "week").select(
        "source", "week", "n", F.coalesce(F.col("n") == F.col("was"), F.lit(False)).alias("unchanged"), lag.alias("lag_hours"), "all_collected")


_UNCHANGED = f"""WITH {OBSERVATIONS}, w AS (SELECT source, date_trunc('week', day)::DATE AS week, sum(n)::BIGINT AS n, max(day) AS last_day FROM o GROUP BY ALL)
SELECT w.source, w.week, w.n, coalesce(w.n = b.n, false) AS unchanged, ((w.week + 6 - w.last_day) * 24)::INT AS lag_hours, count(*) OVER (PARTITION BY w.week) = 4 AS all_collected
FROM w LEFT JOIN w b ON b.source = w.source AND b.week = w.week - 7"""


def folded_fetches(spark, sf_dir):
    """The responses of an order folded into one fetch row: bytes, statuses, and whether 97 per cent were covered."""
    l = table(spark, sf_dir, "lineitem")
    good = F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(0))
    return l.groupBy("l_suppkey").agg(
        F.count("*").alias("responses"), F.sum("l_quantity").cast("long").alias("asked"), good.cast("long").alias("covered"),
        F.concat_ws(",", F.array_sort(F.collect_set("l_returnflag"))).alias("statuses")).withColumn("complete", F.col("covered") >= 0.97 * F.col("asked"))


_FOLDED = """SELECT l_suppkey, count(*) AS responses, sum(l_quantity)::BIGINT AS asked, coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 0)::BIGINT AS covered,
  string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS statuses, coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 0) >= 0.97 * sum(l_quantity) AS complete FROM lineitem GROUP BY l_suppkey"""


def unanswered_questions(spark, sf_dir):
    """Questions (conversation, digest of the user's turn) without an answer to the same text anywhere: nothing is asked twice."""
    c = table(spark, sf_dir, "conversations").withColumn("digest", F.md5("text"))
    asked = c.where("role = 'user'").select("conv_id", "turn", "digest")
    replies = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"))
    answered = asked.join(replies, ["conv_id", "turn"], "left_semi").select("digest").distinct()
    return asked.join(answered, "digest", "left_anti").select("conv_id", "turn", "digest")


_UNANSWERED = """WITH c AS (SELECT *, md5(text) AS digest FROM conversations), u AS (SELECT conv_id, turn, digest FROM c WHERE role = 'user'),
y AS (SELECT DISTINCT u.digest FROM u SEMI JOIN (SELECT conv_id, turn - 1 AS turn FROM c WHERE role = 'assistant') r USING (conv_id, turn))
SELECT conv_id, turn, digest FROM u ANTI JOIN y USING (digest)"""


def evidence_chunks(spark, sf_dir):
    """Documents still to judge (without a label), dealt per language into chunks of fifty by id."""
    from pyspark.sql import Window

    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")
    w = Window.partitionBy("lang", "source").orderBy("doc_id")
    return d.withColumn("chunk", F.floor((F.row_number().over(w) - 1) / 50).cast("long"))


_CHUNKS = """SELECT doc_id, lang, source, ((row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) - 1) // 50)::BIGINT AS chunk
FROM documents ANTI JOIN labels USING (doc_id)"""

QUERIES = {f.__name__: f for f in (
    decision_withdrawal, scd2_deferred, source_watermarks, resume_cursors, unseen_candidates, registry_replace, payloads_kept, event_records,
    event_rows, previous_weeks, first_seen, latest_claim_texts, extraction_backlog, month_schedule, unchanged_feeds, folded_fetches,
    unanswered_questions, evidence_chunks)}
ORACLE_SQL = dict(zip(QUERIES, (
    _DECISION, _DEFERRED, _WATERMARKS, _RESUME, _UNSEEN, _REPLACE, _PAYLOADS, _RECORDS, _ROWS, _PREVIOUS, _FIRST, _TEXTS, _BACKLOG, _SCHEDULE,
    _UNCHANGED, _FOLDED, _UNANSWERED, _CHUNKS)))
