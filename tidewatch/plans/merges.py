"""Write semantics as queries: an old state and a batch are cut from one table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import merge
from tidewatch.plans.tables import ASSERTIONS, OBSERVATIONS, assertions, observations

OLD, NEW, STAMP = "1998-06-30", "1998-01-01", "2001-01-01"



def _state(spark, sf_dir):
    """Old rows by key; the batch overlaps them in time, and changes the price where the entry is a multiple of three."""
    a = assertions(spark, sf_dir)
    old = merge.last_per_key(a.where(f"added <= date '{OLD}'"), ["source", "vuln"], [F.col("entry").desc()]).select(
        "source", "vuln", "entry", "price", F.lit("1999-01-01").alias("last_changed_at"),
        F.when(F.col("withdrawn"), "1999-01-01").alias("withdrawn_at"))
    new = merge.last_per_key(a.where(f"added >= date '{NEW}'"), ["source", "vuln"], [F.col("entry").desc()]).select(
        "source", "vuln", "entry", "price")
    return old.withColumn("hash", F.col("entry").cast("string")), new.withColumn("hash", F.col("entry").cast("string"))


_BASE = f"""{ASSERTIONS},
old AS (SELECT source, vuln, entry, price, '1999-01-01' AS last_changed_at, CASE WHEN withdrawn THEN '1999-01-01' END AS withdrawn_at
  FROM a WHERE added <= DATE '{OLD}' QUALIFY row_number() OVER (PARTITION BY source, vuln ORDER BY entry DESC) = 1),
new AS (SELECT source, vuln, entry, price FROM a WHERE added >= DATE '{NEW}'
  QUALIFY row_number() OVER (PARTITION BY source, vuln ORDER BY entry DESC) = 1)"""


def upsert_merge(spark, sf_dir):
    old, new = _state(spark, sf_dir)
    return merge.upsert(old, new, ["source", "vuln"], "hash", F.lit(STAMP)).drop("hash")


_UPSERT = f"""WITH {_BASE}
SELECT source, vuln, coalesce(new.entry, old.entry) AS entry, coalesce(new.price, old.price) AS price,
  CASE WHEN new.entry IS NOT NULL AND new.entry IS DISTINCT FROM old.entry THEN '{STAMP}' ELSE last_changed_at END AS last_changed_at,
  CASE WHEN new.entry IS NULL THEN withdrawn_at END AS withdrawn_at
FROM old FULL JOIN new USING (source, vuln)"""


def owned_column_upsert(spark, sf_dir):
    """The batch owns only ``entry``; a row seen again stays withdrawn; the price is the least seen."""
    old, new = _state(spark, sf_dir)
    return merge.upsert(old, new, ["source", "vuln"], "hash", F.lit(STAMP), owned=["entry", "hash"], least=("price",), revive=False).drop("hash")


_OWNED = f"""WITH {_BASE}
SELECT source, vuln, coalesce(new.entry, old.entry) AS entry, least(old.price, new.price) AS price,
  CASE WHEN new.entry IS NOT NULL AND new.entry IS DISTINCT FROM old.entry THEN '{STAMP}' ELSE last_changed_at END AS last_changed_at,
  withdrawn_at FROM old FULL JOIN new USING (source, vuln)"""


def snapshot_withdrawal(spark, sf_dir):
    old, new = _state(spark, sf_dir)
    return merge.withdraw_missing(old, new, ["source", "vuln"], F.lit(STAMP), complete=True).select("source", "vuln", "entry", "withdrawn_at")


_WITHDRAW = f"""WITH {_BASE} SELECT source, vuln, old.entry,
  CASE WHEN new.entry IS NULL AND withdrawn_at IS NULL THEN '{STAMP}' ELSE withdrawn_at END AS withdrawn_at
FROM old LEFT JOIN new USING (source, vuln)"""


def scd2_versions(spark, sf_dir):
    old, new = _state(spark, sf_dir)
    keep = ["source", "vuln", "hash"]
    return merge.append_versions(old.select(*keep).withColumn("version", F.lit(1)), new.select(*keep), ["source", "vuln"], "hash")


_SCD2 = f"""WITH {_BASE} SELECT source, vuln, entry::VARCHAR AS hash, 1 AS version FROM old
UNION ALL SELECT source, vuln, new.entry::VARCHAR, CASE WHEN old.entry IS NULL THEN 1 ELSE 2 END
FROM new LEFT JOIN old USING (source, vuln) WHERE new.entry IS DISTINCT FROM old.entry"""


def changed_fields(spark, sf_dir):
    old, new = _state(spark, sf_dir)
    out = merge.changed_fields(old, new, ["source", "vuln"], ignore=("hash",))
    return out.select("source", "vuln", F.concat_ws(",", F.array_sort("changed")).alias("changed"))


_CHANGED = f"""WITH {_BASE} SELECT * FROM (SELECT source, vuln, concat_ws(',', CASE WHEN old.entry IS DISTINCT FROM new.entry THEN 'entry' END,
  CASE WHEN old.price IS DISTINCT FROM new.price THEN 'price' END) AS changed FROM old JOIN new USING (source, vuln)) WHERE changed <> ''"""


def insert_or_earlier(spark, sf_dir):
    a = assertions(spark, sf_dir)
    old = a.where("source in ('1-URGENT', '2-HIGH')").groupBy("vuln").agg(F.min("added").alias("day"))
    new = a.where("source not in ('1-URGENT', '2-HIGH')").groupBy("vuln").agg(F.min("added").alias("day"))
    return merge.insert_or_earlier(old, new, ["vuln"], "day")


_EARLIER = f"""WITH {ASSERTIONS}, x AS (SELECT vuln, min(added) AS d FROM a WHERE source IN ('1-URGENT', '2-HIGH') GROUP BY vuln),
y AS (SELECT vuln, min(added) AS day FROM a WHERE source NOT IN ('1-URGENT', '2-HIGH') GROUP BY vuln)
SELECT vuln, day FROM y LEFT JOIN x USING (vuln) WHERE d IS NULL OR day < d"""


def replace_partition(spark, sf_dir):
    o = observations(spark, sf_dir)
    new = o.where("day >= date '2024-01-20' and source <> 'click'").withColumn("n", F.col("n") + 100)
    return merge.replaced(o, new, ["day", "source"])


_REPLACE = f"""WITH {OBSERVATIONS} SELECT source, vuln, day,
  CASE WHEN day >= DATE '2024-01-20' AND source <> 'click' THEN n + 100 ELSE n END AS n FROM o"""


def keep_newest_partitions(spark, sf_dir):
    o = observations(spark, sf_dir)
    used = o.where("source = 'purchase'").agg(F.min("day").alias("day"))
    return merge.newest_partitions(o, "day", 5, used).groupBy("day").agg(F.sum("n").alias("n"))


_NEWEST = f"""WITH {OBSERVATIONS} SELECT day, sum(n)::BIGINT AS n FROM o WHERE day IN (SELECT day FROM (SELECT DISTINCT day FROM o ORDER BY day DESC LIMIT 5))
  OR day = (SELECT min(day) FROM o WHERE source = 'purchase') GROUP BY day"""


def export_manifest_key(spark, sf_dir):
    """The export's key must be unique: rows, distinct keys and a digest independent of row order."""
    o = observations(spark, sf_dir)
    line = F.concat_ws("|", "source", "vuln", F.date_format("day", "yyyy-MM-dd"), F.col("n").cast("string"))
    return o.agg(
        F.count("*").alias("n_rows"), F.count_distinct(F.struct("source", "vuln", "day")).alias("keys"),
        F.sum(F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")).alias("digest"))


_MANIFEST = f"""WITH {OBSERVATIONS} SELECT count(*) AS n_rows, count(DISTINCT (source, vuln, day)) AS keys,
  sum(('0x' || substr(md5(concat_ws('|', source, vuln, strftime(day, '%Y-%m-%d'), n)), 1, 8))::BIGINT)::BIGINT AS digest FROM o"""

QUERIES = {f.__name__: f for f in (
    upsert_merge, owned_column_upsert, snapshot_withdrawal, scd2_versions, changed_fields, insert_or_earlier,
    replace_partition, keep_newest_partitions, export_manifest_key)}
ORACLE_SQL = dict(zip(QUERIES, (_UPSERT, _OWNED, _WITHDRAW, _SCD2, _CHANGED, _EARLIER, _REPLACE, _NEWEST, _MANIFEST)))
