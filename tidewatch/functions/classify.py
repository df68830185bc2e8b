"""Classes from the codes of filings: industry, breach type, size band, country. Null where a code spans classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kind of covered entity in health filings.
HEALTH_ENTITIES = {"healthcare provider": "healthcare", "health plan": "healthcare", "healthcare clearing house": "healthcare"}
#: Industry and business columns of state filings.
STATE_INDUSTRIES = {
    "health": "healthcare", "finance": "finance_insurance", "education": "education", "government": "government_public",
    "non-profit/charity": "nonprofit"}
STATE_BUSINESSES = {
    "retail": "retail_consumer", "professional services": "professional_services", "manufacturing": "manufacturing", "legal": "professional_services",
    "software": "technology_telecom", "hospitality": "hospitality_leisure", "construction": "construction_real_estate", "consumable": "retail_consumer",
    "web services": "technology_telecom", "real estate": "construction_real_estate", "shipping": "transport_logistics",
    "telecommunications": "technology_telecom", "human resources": "professional_services", "cosmetic": "retail_consumer", "clothing": "retail_consumer"}
#: Kind of attack in state filings.
STATE_ATTACKS = {"ransomware": "ransomware_extortion", "malware": "intrusion_hacking", "phishing": "credential_abuse", "skimmers": "intrusion_hacking"}
#: Country domains that are sold to anyone.
OPEN_DOMAINS = ("io", "co", "ai", "me", "tv", "cc", "ws", "fm", "ly", "gg", "la", "to", "nu", "am", "vc", "sh", "ac", "tk", "ml", "ga", "cf", "gq", "so", "st", "eu")


def _plain(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit(""))))


def _looked_up(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def industry_of_health_filing(entity: Column) -> Column:
    return _looked_up(HEALTH_ENTITIES, _plain(entity))


def industry_of_state_filing(industry: Column, business: Column) -> Column:
    i = _plain(industry)
    return F.when(i == "business", _looked_up(STATE_BUSINESSES, _plain(business))).otherwise(_looked_up(STATE_INDUSTRIES, i))


def breach_type_of_health_filing(kind: Column, location: Column, associate: Column, entity: Column) -> Column:
    """A named associate makes it a third party's breach, unless the filer is the associate."""
    third = _plain(associate).isin("yes", "true") & (_plain(entity) != "business associate")
    device = _plain(kind).isin("theft", "loss") & _plain(location).rlike("laptop|portable|desktop|device|computer")
    return F.when(third, "third_party_vendor").when(_plain(kind).contains("hacking"), "intrusion_hacking").when(device, "lost_stolen_device")


def breach_type_of_state_filing(cause: Column, attack: Column) -> Column:
    known = (_plain(cause) == "cyberattack") | (_plain(attack) != "")
    return F.when(known, _looked_up(STATE_ATTACKS, _plain(attack)))


def breach_type_of_index(kind: Column, malware: Column, third_party: Column) -> Column:
    return (
        F.when(_plain(malware) == "ransomware", "ransomware_extortion").when(_plain(third_party) == "true", "third_party_vendor")
        .when(_plain(kind).isin("hack", "virus"), "intrusion_hacking"))


def size_band(employees: Column) -> Column:
    n = employees.try_cast("bigint")
    return F.when(n <= 0, F.lit(None)).when(n < 250, "lt_250").when(n < 5000, "250_4999").when(n >= 5000, "5000_plus")


def country_of_domain(domain: Column) -> Column:
    """The country of a two-letter top-level domain that is not sold to anyone."""
    tld = F.regexp_extract(F.lower(F.rtrim(domain, F.lit("."))), r"(?:^|\.)([a-z]{2})$", 1)
    return F.when((tld != "") & ~tld.isin(*OPEN_DOMAINS), F.when(tld == "uk", "GB").otherwise(F.upper(tld)))


def country_code(text: Column) -> Column:
    c = F.upper(F.trim(text))
    return (
        F.when(c == "UK", "GB").when(c.isin("USA", "UNITED STATES", "US"), "US")
        .when(c.rlike("^[A-Z]{2}$") & ~c.isin("XX", "ZZ"), c))


#: Ranges of standard industrial codes; of those that hold a code the narrowest decides, null spans classes.
SIC_RANGES = (
    (100, 999, "agriculture"), (1000, 1499, "energy_utilities"), (1500, 1799, "construction_real_estate"), (2000, 3999, "manufacturing"),
    (2711, 2741, "media"), (2833, 2836, "healthcare"), (3570, 3579, None), (3670, 3679, None), (3840, 3851, None),
    (4000, 4799, "transport_logistics"), (4800, 4899, "technology_telecom"), (4830, 4830, "media"), (4832, 4833, "media"), (4840, 4841, "media"),
    (4900, 4999, "energy_utilities"), (5200, 5999, "retail_consumer"), (5800, 5899, "hospitality_leisure"), (6000, 6499, "finance_insurance"),
    (6500, 6599, "construction_real_estate"), (6700, 6799, "finance_insurance"), (6798, 6798, "construction_real_estate"),
    (7000, 7099, "hospitality_leisure"), (7310, 7319, "professional_services"), (7360, 7369, "professional_services"), (7370, 7379, "technology_telecom"),
    (7800, 7899, "media"), (7900, 7999, "hospitality_leisure"), (8000, 8099, "healthcare"), (8100, 8199, "professional_services"),
    (8200, 8299, "education"), (8600, 8699, "nonprofit"), (8710, 8749, "professional_services"), (9100, 9799, "government_public"))
#: Prefixes of industry classification codes; the longest decides, null spans classes.
NAICS_PREFIXES = {
    "11": "agriculture", "21": "energy_utilities", "22": "energy_utilities", "23": "construction_real_estate", "31": "manufacturing", "32": "manufacturing",
    "3254": "healthcare", "33": "manufacturing", "3341": None, "3344": None, "3345": None, "44": "retail_consumer", "45": "retail_consumer",
    "48": "transport_logistics", "49": "transport_logistics", "5111": "media", "5112": "technology_telecom", "512": "media", "5132": "technology_telecom",
    "515": "media", "516": "media", "517": "technology_telecom", "518": "technology_telecom", "519": "technology_telecom", "52": "finance_insurance",
    "53": "construction_real_estate", "532": None, "54": "professional_services", "5415": "technology_telecom", "5613": "professional_services",
    "61": "education", "62": "healthcare", "624": None, "71": "hospitality_leisure", "72": "hospitality_leisure", "813": "nonprofit", "92": "government_public"}


def industry_of_sic(code: Column) -> Column:
    n = F.trim(code.cast("string")).try_cast("int")
    out = None
    for lo, hi, name in sorted(SIC_RANGES, key=lambda r: (r[1] - r[0], r[0])):
        out = F.when(n.between(lo, hi), F.lit(name)) if out is None else out.when(n.between(lo, hi), F.lit(name))
    return out


def industry_of_naics(code: Column) -> Column:
    digits = F.regexp_replace(F.coalesce(code.cast("string"), F.lit("")), "[^0-9]", "")
    table = {k: v or "" for k, v in NAICS_PREFIXES.items()}
    found = F.coalesce(*[F.when(F.length(digits) >= n, _looked_up(table, F.substring(digits, 1, n))) for n in (4, 3, 2)])
    return F.nullif(found, F.lit(""))
