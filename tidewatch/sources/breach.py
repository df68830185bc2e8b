"""Disclosures of regulators, leak posts, news, actors, sizes, and the capability registry."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.functions import dates
from tidewatch.functions import text as T
from tidewatch.sources import SourceError, register
from tidewatch.sources.common import documents, lines, split

EARLIEST = "1990-01-01"
#: Counts that a filing form sets when the number is unknown.
PLACEHOLDERS = (500, 501)


def disclosure(name: Column, filed: Column, event: Column, people: Column):
    """Common columns: dates before 1990 are null, an event after its filing is null, a placeholder is marked."""
    early = F.lit(EARLIEST).cast("date")
    f = F.when(filed >= early, filed)
    e = F.when((event >= early) & (f.isNull() | (event <= f)), event)
    n = F.regexp_replace(people, "[^0-9]", "").try_cast("bigint")
    return [F.trim(name).alias("organisation"), T.normal_name_udf(name).alias("norm_name"), f.alias("filed"), e.alias("event_date"),
            n.alias("people"), n.isin(*PLACEHOLDERS).alias("placeholder")]


def _csv_disclosures(columns: dict[str, str]):
    def read(spark, path):
        d = spark.read.csv(path, header=True)
        missing = set(columns.values()) - set(d.columns)
        if missing:
            raise SourceError(f"columns missing: {sorted(missing)}")
        c = {k: F.col(f"`{v}`") for k, v in columns.items()}
        rows = d.select(*disclosure(c["name"], dates.any_date(c["filed"]), dates.any_date(c["event"]), c["people"]))
        return split(rows, (F.coalesce(F.col("organisation") == "", F.lit(True)), "no organisation"), (F.col("filed").isNull(), "no filing date"))

    return read


register("regulator_wa")(_csv_disclosures({"name": "Name", "filed": "DateSubmitted", "event": "DateStart", "people": "WashingtoniansAffected"}))
register("regulator_ca")(_csv_disclosures({"name": "Organization Name", "filed": "Reported Date", "event": "Date(s) of Breach", "people": "People"}))
register("regulator_hhs")(_csv_disclosures({"name": "Name of Covered Entity", "filed": "Breach Submission Date", "event": "Breach Date", "people": "Individuals Affected"}))
register("regulator_de")(_csv_disclosures({"name": "Organization", "filed": "Reported", "event": "Breach", "people": "Affected"}))


@register("hibp")
def hibp(spark, path):
    """Index entries that name a victim: combined and stealer lists do not."""
    d = documents(spark, path, "Name string, Title string, Domain string, BreachDate string, AddedDate string, PwnCount bigint, IsFabricated boolean, IsSpamList boolean, IsStealerLog boolean, IsMalware boolean")
    off = F.coalesce("IsFabricated", F.lit(False)) | F.coalesce("IsSpamList", F.lit(False)) | F.coalesce("IsStealerLog", F.lit(False)) | F.coalesce("IsMalware", F.lit(False))
    rows = d.select("Name", off.alias("off"), T.domain_of(F.col("Domain")).alias("domain"), *disclosure(
        F.col("Title"), dates.any_date(F.col("AddedDate")), dates.any_date(F.col("BreachDate")), F.col("PwnCount").cast("string")))
    good, bad = split(rows, (F.col("off") | F.lower("organisation").rlike("combo|collection #|stealer"), "no single victim"))
    return good.drop("off"), bad


@register("sec_filings")
def sec_filings(spark, path):
    """Search hits of filings: one row per filer and filing day."""
    d = documents(spark, path, "hits struct<hits:array<struct<_id:string,_source:struct<display_names:array<string>,file_date:string,ciks:array<string>>>>>")
    h = d.select(F.explode("hits.hits").alias("h")).select("h.*")
    rows = h.select(F.col("_id").alias("record"), F.col("_source.ciks")[0].alias("cik"), F.trim(F.regexp_replace(F.col("_source.display_names")[0], r"\(.*$", "")).alias("organisation"),
                    dates.any_date(F.col("_source.file_date")).alias("filed"))
    return split(rows.dropDuplicates(["cik", "filed"]), (F.col("cik").isNull(), "no filer"), (F.col("filed").isNull(), "no date"))


class _Cells(HTMLParser):
    """Rows of cells of all tables; the first link of a row is its last cell."""

    def __init__(self):
        super().__init__()
        self.rows, self._row, self._cell, self._link = [], None, None, ""

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self._row, self._link = [], ""
        elif tag in ("td", "th") and self._row is not None:
            self._cell = []
        elif tag == "a" and self._row is not None and not self._link:
            self._link = dict(attrs).get("href") or ""

    def handle_data(self, data):
        if self._cell is not None:
            self._cell.append(data)

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self._cell is not None:
            self._row.append(" ".join("".join(self._cell).split()))
            self._cell = None
        elif tag == "tr" and self._row is not None:
            if self._row:
                self.rows.append([*self._row, self._link])
            self._row = None


@register("notice_tables")
def notice_tables(spark, path):
    """Tables of HTML pages: date, name, people, what was taken; ids from the content, so they stay the same."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for text in batch.column(0).to_pylist():
                p = _Cells()
                p.feed(text or "")
                if p.rows:
                    yield pa.record_batch([pa.array(p.rows, pa.list_(pa.string()))], names=["cells"])

    cells = spark.read.text(path, wholetext=True).mapInArrow(run, "cells array<string>").where("size(cells) >= 5")
    rows = cells.select(*disclosure(F.col("cells")[1], dates.any_date(F.col("cells")[0]), F.lit(None).cast("date"), F.col("cells")[2]),
                        F.split(F.col("cells")[3], r"\s*;\s*").alias("data_types"), F.sha2(F.concat_ws("|", "cells"), 256).alias("record_id"))
    return split(rows, (F.col("filed").isNull(), "no date"))


@register("leak_posts")
def leak_posts(spark, path):
    """Tracker posts; a post without an id gets one from its content; names stay as posted, facts are parsed."""
    good, bad = lines(spark, path, "id string, group_name string, post_title string, discovered string, website string, description string")
    own = F.sha2(F.concat_ws("|", "group_name", "post_title", "discovered"), 256)
    rows = good.select(
        F.coalesce("id", own).alias("post_id"), F.lower(F.trim("group_name")).alias("actor"), F.col("post_title").alias("victim"), T.normal_name_udf("post_title").alias("norm_name"),
        T.domain_of(F.coalesce("website", "post_title")).alias("domain"), dates.any_date(F.col("discovered")).alias("seen_at"),
        F.regexp_extract("description", r"(?i)([0-9][0-9,]*)\s+employees", 1).alias("employees"), F.array_max(T.numbers_udf("description")).alias("largest_number"))
    ok, refused = split(rows, (F.coalesce(F.trim("victim") == "", F.lit(True)), "no victim"), (F.col("seen_at").isNull(), "no date"))
    return ok, bad.unionByName(refused)


@register("news_feeds")
def news_feeds(spark, path):
    """RSS and Atom items that speak of a breach."""

    def run(batches):
        import xml.etree.ElementTree as ET
        import pyarrow as pa

        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                try:
                    root = ET.fromstring(text)
                except ET.ParseError:
                    out.append((None, None, None, text[:200]))
                    continue
                for e in root.iter():
                    if e.tag.rpartition("}")[2] in ("item", "entry"):
                        got = {c.tag.rpartition("}")[2]: (c.get("href") or "".join(c.itertext())).strip() for c in e}
                        out.append((got.get("title"), got.get("link"), got.get("pubDate") or got.get("updated") or got.get("published"), None))
            cols = list(zip(*out)) or [()] * 4
            yield pa.record_batch([pa.array(c, pa.string()) for c in cols], names=["title", "link", "published", "bad"])

    d = spark.read.text(path, wholetext=True).mapInArrow(run, "title string, link string, published string, bad string")
    day = F.coalesce(dates.any_date(F.col("published")), F.to_date(F.try_to_timestamp(F.regexp_extract("published", r"(\d{1,2} [A-Z][a-z]{2} \d{4})", 1), F.lit("d MMM yyyy"))))
    rows = d.select("title", "link", day.alias("day"), F.col("bad"), F.coalesce(F.lower("title").rlike(r"breach|ransom|leak|stolen|hack|extort"), F.lit(False)).alias("relevant"))
    good, bad = split(rows, (F.col("bad").isNotNull(), "not XML"), (F.col("title").isNull(), "no title"))
    return good.drop("bad"), bad


@register("actors")
def actors(spark, path):
    """Actors and their unambiguous aliases: an alias that two actors claim names none."""
    good, bad = lines(spark, path, "value string, synonyms array<string>")
    norm = lambda c: F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]", "")
    names = good.select(F.col("value").alias("actor"), F.explode(F.concat(F.array("value"), F.coalesce("synonyms", F.array().cast("array<string>")))).alias("alias"))
    one = names.select("actor", norm(F.col("alias")).alias("alias")).where("alias <> ''").distinct()
    clear = one.groupBy("alias").agg(F.count_distinct("actor").alias("n"), F.min("actor").alias("actor")).where("n = 1").drop("n")
    return clear.select("actor", "alias"), bad


@register("organisation_sizes")
def organisation_sizes(spark, path):
    """Employees by exact domain; the latest statement, and only if it is positive."""
    d = documents(spark, path, "results struct<bindings:array<struct<website:struct<value:string>,employees:struct<value:string>,asof:struct<value:string>>>>")
    b = d.select(F.explode("results.bindings").alias("b"))
    rows = b.select(T.domain_of(F.col("b.website.value")).alias("domain"), F.col("b.employees.value").try_cast("double").cast("bigint").alias("employees"), dates.any_date(F.substring("b.asof.value", 1, 10)).alias("as_of"))
    good, bad = split(rows, (F.col("domain").isNull(), "no domain"), (F.coalesce(F.col("employees") <= 0, F.lit(True)), "no number"))
    return good.groupBy("domain").agg(F.max_by("employees", F.struct(F.coalesce("as_of", F.lit("1900-01-01").cast("date")), "employees")).alias("employees"), F.max("as_of").alias("as_of")), bad


@register("capability_results")
def capability_results(spark, path):
    """Published benchmark results; a score must be finite and inside its scale."""
    d = documents(spark, path, "benchmark string, version string, model string, developer string, score double, ci array<double>, stderr double, n int, published_on string, source_url string, evidence string")
    rows = d.withColumn("published", dates.any_date(F.col("published_on"))).drop("published_on")
    inside = F.size("ci") != 2
    return split(rows, (F.col("benchmark").isNull() | F.col("model").isNull(), "no benchmark or model"),
                 (F.coalesce(F.isnan("score") | (F.abs("score") == float("inf")), F.lit(True)), "score not finite"),
                 (~F.coalesce(F.col("source_url").startswith("https://"), F.lit(False)), "no https source"),
                 (F.coalesce(~inside & ((F.col("score") < F.col("ci")[0]) | (F.col("score") > F.col("ci")[1])), F.lit(False)), "score outside its interval"))
