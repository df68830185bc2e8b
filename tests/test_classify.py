"""Codes of filings to classes, and posts folded into episodes."""

import datetime as dt

from pyspark.sql import functions as F

from tidewatch.functions import classify as C
from tidewatch.operators import windows


def one(spark, *cols):
    return list(spark.range(1).select(*[c.alias(f"c{k}") for k, c in enumerate(cols)]).first())


def test_classes(spark):
    v = F.lit
    assert one(spark, C.industry_of_health_filing(v(" Health Plan ")), C.industry_of_health_filing(v("business associate")),
               C.industry_of_state_filing(v("Business"), v("Legal")), C.industry_of_state_filing(v("Business"), v("Home")),
               C.industry_of_state_filing(v("Education"), v(None))) == ["healthcare", None, "professional_services", None, "education"]
    assert one(spark, C.breach_type_of_health_filing(v("Hacking/IT Incident"), v("Email"), v("No"), v("Health Plan")),
               C.breach_type_of_health_filing(v("Hacking/IT Incident"), v("Email"), v("Yes"), v("Health Plan")),
               C.breach_type_of_health_filing(v("Theft"), v("Laptop"), v("No"), v(None)), C.breach_type_of_health_filing(v("Theft"), v("Paper"), v(None), v(None)),
               C.breach_type_of_state_filing(v("Cyberattack"), v("Phishing")), C.breach_type_of_state_filing(v("Theft"), v("")),
               C.breach_type_of_index(v("Hack"), v("Ransomware"), v("TRUE")), C.breach_type_of_index(v("Hack"), v(""), v("TRUE"))) == [
        "intrusion_hacking", "third_party_vendor", "lost_stolen_device", None, "credential_abuse", None, "ransomware_extortion", "third_party_vendor"]
    assert one(spark, *[C.size_band(v(n)) for n in ("0", "249", "250", "5000", "x")]) == [None, "lt_250", "250_4999", "5000_plus", None]
    assert one(spark, *[C.country_of_domain(v(d)) for d in ("a.co.uk", "x.de.", "y.io", "z.com")], C.country_code(v(" usa ")), C.country_code(v("xx")), C.country_code(v("fr"))) == [
        "GB", "DE", None, None, "US", None, "FR"]


def test_posts_fold_into_the_nearest_open_episode(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    posts = spark.createDataFrame([("a", "x", day(n)) for n in (0, 10, 14, 15, 29, 30)] + [("b", "x", day(1))], "actor string, subject string, day date")
    got = {(r["actor"], r["day"]): r["episode_start"] for r in windows.folded_posts(posts, "actor", "subject", "day").collect()}
    assert [got["a", day(n)] for n in (0, 10, 14, 15, 29, 30)] == [day(n) for n in (0, 0, 0, 15, 15, 30)] and got["b", day(1)] == day(1)


def test_industry_codes(spark):
    sic = {"2834": "healthcare", "2899": "manufacturing", "3571": None, "4841": "media", "4813": "technology_telecom", "5812": "hospitality_leisure", "6798": "construction_real_estate",
           "6700": "finance_insurance", "9999": None, "x": None, "1700": "construction_real_estate"}
    assert one(spark, *[C.industry_of_sic(F.lit(k)) for k in sic]) == list(sic.values())
    naics = {"325412": "healthcare", "3259": "manufacturing", "334111": None, "541512": "technology_telecom", "5411": "professional_services", "624": None, "62": "healthcare", "1": None, "81": None, "813-9": "nonprofit"}
    assert one(spark, *[C.industry_of_naics(F.lit(k)) for k in naics]) == list(naics.values())
