"""Whether a claimed victim is a real organisation: one verdict per group of names, from evidence that the group shares, fanned out to its claims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import text as T

#: Kinds of evidence for a site; those of trackers are the claim's own.
TRACKERS, ALLOWED = ("tracker_domain", "leak_post"), ("tracker_domain", "leak_post", "slug_guess", "official_site")


def packed(evidence: DataFrame) -> DataFrame:
    """(grp, pack, items): a digest of all evidence of a group, whatever the order, the repeats and the claims it came from.

    ``evidence`` has (grp, kind, source, host, title, entity, person, live, country). The digest is the number of distinct items and the sum of their
    hashes, so it is combined before the shuffle and no group is collected.
    """
    fields = ["kind", "source", "host", "title", "entity", "person", "live", "country"]
    item = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in fields]))
    d = evidence.select("grp", item.alias("item")).distinct()
    number = F.conv(F.substring("item", 1, 8), 16, 10).cast("long")
    return d.groupBy("grp").agg(F.count("*").alias("items"), F.sum(number).alias("sum")).select("grp", F.concat_ws(":", "items", "sum").alias("pack"), "items")


def named_by(text, words):
    """Whether a title holds all words of a name."""
    return F.size(F.array_except(words, F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"))) == 0


def group_verdicts(groups: DataFrame, evidence: DataFrame) -> DataFrame:
    """(grp, label, subtype, via, domain, person_risk, pack): the first rule of the cascade that decides for a group (grp, name, words, person_like, weak, country).

    A1: masked names are unresolved, placeholders no organisation. E1: a live site of an allowed source whose title names the group; guessed hosts don't
    count for one word of four letters or less, nor anything but the claim's own sites for a name like a person's. Several hosts: the only one of
    the claim's own, else real without a domain, but ambiguous for weak or person-like names. A host that is not the claim's own needs a second
    signal (its country, a registry) to be the domain. E2: an exact registry entry that is no person, unless the name is weak or person-like. E3: others confirm it.
    """
    g = groups.select("grp", "name", "words", "person_like", "weak", F.col("country").alias("own_country"))
    e = evidence.join(g, "grp")
    own = F.col("source").isin(*TRACKERS)
    short = (F.size("words") == 1) & (F.length(F.get("words", F.lit(0))) <= 4)
    site = (
        (F.col("kind") == "site") & F.col("live") & F.col("source").isin(*ALLOWED) & named_by(F.col("title"), F.col("words")) & (own | ~short) & (own | ~F.col("person_like")))
    near = F.coalesce(F.col("country") == F.col("own_country"), F.lit(False))
    entry = (F.col("kind") == "registry") & (F.lower("entity") == F.array_join("words", " "))
    one = lambda ok, c: F.min(F.when(ok, F.col(c)))
    s = e.groupBy("grp").agg(
        F.count_distinct(F.when(site, F.col("host"))).alias("hosts"), one(site, "host").alias("host"), F.count_distinct(F.when(site & own, F.col("host"))).alias("own_hosts"),
        one(site & own, "host").alias("own_host"), F.count_distinct(F.when(site, F.lower("title"))).alias("titles"), F.coalesce(F.bool_or(site & near), F.lit(False)).alias("near"),
        F.coalesce(F.bool_or((F.col("kind") == "site") & F.col("live") & ~own & F.col("source").isin(*ALLOWED) & named_by(F.col("title"), F.col("words")) & F.col("person_like")), F.lit(False)).alias("guarded"),
        F.coalesce(F.bool_or(entry & ~F.col("person")), F.lit(False)).alias("registered"), F.coalesce(F.bool_or(F.col("kind") == "confirmed"), F.lit(False)).alias("confirmed"))
    d = g.join(s, "grp", "left").join(packed(evidence), "grp", "left")
    d = d.withColumn("hosts", F.coalesce("hosts", F.lit(0))).withColumn("own_hosts", F.coalesce("own_hosts", F.lit(0)))
    settled = (F.col("hosts") == 1) | (F.col("own_hosts") == 1)
    several = (F.col("hosts") > 1) & (F.col("own_hosts") != 1) & (F.col("titles") > 1)
    shaky = F.col("weak") | F.col("person_like")
    placeholder = F.lower(F.trim("name")).rlike(r"^(test|example|unknown|n/?a|tba|tbd)\b.{0,3}$")
    e2 = F.coalesce("registered", F.lit(False)) & ~shaky
    via = (
        F.when(placeholder, "A1").when(T.is_masked(F.col("name")), "mask").when((F.col("hosts") == 0) & F.coalesce("guarded", F.lit(False)), "person_guard")
        .when(several & shaky, "multi_host").when(several, "multi_host_real").when(F.col("hosts") > 0, "E1").when(e2, "E2").when(F.coalesce("confirmed", F.lit(False)), "E3").otherwise("none"))
    d = d.withColumn("via", via)
    label = (
        F.when(F.col("via") == "A1", "not_org").when(F.col("via") == "mask", "redacted_unresolved").when(F.col("via").isin("multi_host_real", "E1", "E2", "E3"), "real_org").otherwise("ambiguous"))
    subtype = F.when(F.col("via") == "A1", "placeholder").when(F.col("via") == "multi_host", "multi_candidate").when(F.col("via").isin("person_guard", "none"), "no_evidence")
    second = F.col("near") | F.col("registered")
    domain = F.when((F.col("via") == "E1") & settled, F.coalesce("own_host", F.when(second, F.col("host"))))
    return d.select("grp", label.alias("label"), subtype.alias("subtype"), "via", domain.alias("domain"), (F.col("person_like") & (label == "ambiguous")).alias("person_risk"), F.coalesce("pack", F.lit("0:0")).alias("pack"))


def fanned_out(claims: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(claim, verdict columns): the verdict of its group for every claim (claim, grp)."""
    return claims.select("claim", "grp").join(verdicts, "grp").drop("grp")
