"""Readers on small files written here: good rows, rejected rows with reasons, and files refused as a whole."""

import json
import zipfile

import pytest

from tidewatch import sources
from tidewatch.sources import SourceError, catalogues, common, networks, sensors


def put(path, text):
    path.write_text(text if isinstance(text, str) else json.dumps(text))
    return str(path)


def both(result):
    return [d.collect() for d in result]


def test_cisa(spark, tmp_path):
    entry = {"cveID": "CVE-2024-12345", "vendorProject": "v", "product": "p", "dateAdded": "2024-02-01", "notes": "https://a.example/x, https://b.example; text https://a.example/x",
             "knownRansomwareCampaignUse": "Known", "cwes": ["CWE-79", "CWE-79"]}
    doc = {"count": 3, "vulnerabilities": [entry, {**entry, "cveID": "nope"}, {**entry, "cveID": "CVE-2024-1111", "dateAdded": "soon"}]}
    good, bad = both(sources.reader("cisa_kev")(spark, put(tmp_path / "a.json", doc)))
    assert [r["cve_id"] for r in good] == ["CVE-2024-12345"] and good[0]["urls"] == ["https://a.example/x", "https://b.example"] and good[0]["cwe_ids"] == ["CWE-79"]
    assert sorted(r["reason"] for r in bad) == ["identifier is not a CVE", "no date"]
    with pytest.raises(SourceError):
        sources.reader("cisa_kev")(spark, put(tmp_path / "b.json", {**doc, "count": 9}))


def test_euvd_and_circl(spark, tmp_path):
    item = {"id": "EUVD-2025-1", "aliases": "GHSA-xxxx\nCVE-2025-10001\n", "references": "https://r.example\nhttps://s.example", "exploitedSince": "Jul 29, 2025, 11:29:31 PM", "baseScore": 9.8}
    good, _ = both(sources.reader("euvd_kev")(spark, put(tmp_path / "e.json", {"total": 1, "items": [item, item]})))
    assert len(good) == 1 and good[0]["cve_id"] == "CVE-2025-10001" and str(good[0]["date_added"]) == "2025-07-29"
    line = {"uuid": "u1", "vulnerability": {"vulnId": "CVE-2023-5555"}, "timestamps": {"asserted_at": "2023-05-01T00:00:00Z"},
            "evidence": [{"type": "report", "source": "s", "signal": "x", "confidence": 3.5}, {"type": "Honeypot", "source": "t"}]}
    good, bad = both(sources.reader("circl_kev")(spark, put(tmp_path / "c.ndjson", json.dumps(line) + "\n\nnot json\n")))
    assert [(r["source_entry_id"], r["confidence"]) for r in good] == [("u1#0", 1.0)] and [r["reason"] for r in bad] == ["malformed line"]


def test_vulncheck_zip_and_cvelist(spark, tmp_path):
    record = {"vendorProject": "v", "product": "p", "cve": ["CVE-2022-1000", "bad"], "date_added": "2022-03-01T00:00:00Z",
              "vulncheck_reported_exploitation": [{"url": "https://x.example", "date_added": "2022-02-01T00:00:00Z"}, {"url": "https://y.example", "date_added": "2022-01-15T00:00:00Z"}]}
    with zipfile.ZipFile(tmp_path / "v.zip", "w") as z:
        z.writestr("kev.json", json.dumps([record]))
    good, bad = both(sources.reader("vulncheck_kev")(spark, str(tmp_path / "v.zip")))
    assert str(good[0]["exploited_since"]) == "2022-01-15" and len(bad) == 1
    cve = {"cveMetadata": {"cveId": "CVE-2021-44228", "state": "PUBLISHED", "datePublished": "2021-12-10T00:00:00Z"}, "containers": {"cna": {
        "descriptions": [{"lang": "fr", "value": "non"}, {"lang": "en", "value": "yes"}], "metrics": [{"cvssV3_1": {"baseScore": 10.0}}, {"cvssV4_0": {"baseScore": 9.3}}],
        "problemTypes": [{"descriptions": [{"cweId": "CWE-502"}]}], "references": [{"url": f"https://r/{k}"} for k in range(30)]}}}
    with zipfile.ZipFile(tmp_path / "inner.zip", "w") as z:
        z.writestr("cves/CVE-2021-44228.json", json.dumps(cve))
    with zipfile.ZipFile(tmp_path / "outer.zip", "w") as z:
        z.write(tmp_path / "inner.zip", "inner.zip")
    (row,), _ = both(sources.reader("cvelist_bundle")(spark, str(tmp_path / "outer.zip")))
    assert (row["description"], row["score"], row["cwe_ids"], len(row["urls"]), row["cve_year"]) == ("yes", 9.3, ["CWE-502"], 20, 2021)
    with zipfile.ZipFile(tmp_path / "empty.zip", "w") as z:
        z.writestr("readme.txt", "x")
    with pytest.raises(SourceError):
        catalogues.cvelist_bundle(spark, str(tmp_path / "empty.zip"))
    assert catalogues.cvelist_bundle(spark, str(tmp_path / "empty.zip"), baseline=False)[0].count() == 0


def test_nvd_epss_and_rates(spark, tmp_path):
    metric = lambda kind, score: {"type": kind, "cvssData": {"version": "3.1", "baseScore": score}}
    page = {"vulnerabilities": [{"cve": {"id": "CVE-2020-0001", "published": "2020-01-08T19:15:12.843", "metrics": {"cvssMetricV31": [metric("Secondary", 1.0), metric("Primary", 7.8)]},
                                         "weaknesses": [{"description": [{"value": "CWE-20"}, {"value": "NVD-CWE-noinfo"}]}]}}]}
    (row,), _ = both(sources.reader("nvd_pages")(spark, put(tmp_path / "n.json", page)))
    assert (row["score"], row["cwe_ids"], str(row["date_published"])) == (7.8, ["CWE-20"], "2020-01-08")
    text = "#model_version:v2025,score_date:2025-03-01T00:00:00+0000\ncve,epss,percentile\nCVE-2020-1234,0.5,0.9\nCVE-2020-1234,0.6,0.9\nbad,0.1,0.1\nCVE-2020-9999,1.5,0.1\nCVE-2020-8888,x,0.1\n"
    good, bad = both(sources.reader("epss_csv")(spark, put(tmp_path / "e.csv", text)))
    assert [(r["cve_id"], float(r["score"]), r["model_version"]) for r in good] == [("CVE-2020-1234", 0.5, "v2025")]
    assert sorted(r["reason"] for r in bad) == ["malformed identifier", "not a number", "out of range", "repeated"]
    with pytest.raises(SourceError):
        sources.reader("epss_csv")(spark, put(tmp_path / "f.csv", "cve,epss,percentile\nCVE-2020-1234,0.5,0.9\n"))
    good, _ = both(sources.reader("ecb_rates")(spark, put(tmp_path / "r.csv", "Date,USD,JPY\n2024-01-02,1.1,N/A\n")))
    assert [(r["currency"], r["rate"]) for r in good] == [("USD", 1.1)]


def test_sensors(spark, tmp_path):
    board = {"data": {"x": "x", "columns": [["x", "2024-01-01", "2024-01-02"], ["CVE-2024-1234", "5", "0"], ["other", "1", "2"]]}}
    good, _ = both(sources.reader("shadowserver_dashboard")(spark, put(tmp_path / "s.json", board)))
    assert sorted((r["vuln"], r["n"]) for r in good) == [("CVE-2024-1234", 5), ("other", 1), ("other", 2)]
    with pytest.raises(SourceError):
        sensors.shadowserver_dashboard(spark, str(tmp_path / "s.json"), limit=2)
    hp = {"vulnerability": "CVE-2024-1234", "vendor": "V", "product": "P", "iot": "yes", "cisa_kev": "", "vulnerability_score": 99.0, "connections": 7, "1d": "3", "first_seen": "2024-01-01"}
    (row,), bad = both(sources.reader("honeypot_ndjson")(spark, put(tmp_path / "h.ndjson", json.dumps(hp) + "\n" + json.dumps({**hp, "vulnerability": " "}))))
    assert (row["iot"], row["in_kev"], row["score"], row["yesterday"]) == (True, None, None, 3) and bad[0]["reason"] == "no identifier"
    text = "\n".join(json.dumps({"cve": "CVE-2024-1234", "timestamp": t, "count": n}) for t, n in (("2024-01-01T01:00:00Z", 2), ("2024-01-01T05:00:00Z", 3), ("2024-01-02T00:00:00Z", 0), ("2024-01-03T00:00:00Z", 9)))
    good, _ = both(sensors.crowdsec_timeline(spark, put(tmp_path / "c.ndjson", text), upto="2024-01-03"))
    assert sorted((str(r["day"]), r["n"]) for r in good) == [("2024-01-01", 5), ("2024-01-02", 0)]
    vuln = lambda cve, day, value: {"CVE": cve, "Threats": [{"Type": 1, "Description": {"Value": value}}], "RevisionHistory": [{"Date": day}]}
    doc = {"DocumentTracking": {"InitialReleaseDate": "2024-02-13T08:00:00", "ID": {"Value": "2024-Feb"}}, "Vulnerability": [
        vuln("CVE-2024-1111", "2024-02-13T08:00:00", "Publicly Disclosed:No;Exploited:Yes"), vuln("CVE-2024-2222", "2024-02-25T08:00:00", "Exploited:No")]}
    path = put(tmp_path / "m.json", doc)
    assert [r["cve_id"] for r in both(sources.reader("msrc_exploited")(spark, path))[0]] == ["CVE-2024-1111"]
    assert [r["cve_id"] for r in both(sources.reader("msrc_fixes")(spark, path))[0]] == ["CVE-2024-1111"]
    threat = {"id": "0" * 8 + "-0000-0000-0000-" + "0" * 12, "last_updated": "2024-01-01T00:00:00Z", "package": "a"}
    good, bad = both(sources.reader("osm_threats")(spark, put(tmp_path / "o.ndjson", "\n".join(json.dumps(x) for x in (threat, {**threat, "package": "b"}, {**threat, "id": "x"}, {**threat, "last_updated": "2024-01-01T00:00:00"})))))
    assert [r["package"] for r in good] == ["b"] and len(bad) == 2


def test_networks(spark, tmp_path):
    text = "1.2.3.4 # x\n1.2.3.4\n10.0.0.1\n;\n999.1.1.1\n5.6.7.8\n"
    good, bad = both(sources.reader("blocklist")(spark, put(tmp_path / "b.txt", text)))
    assert sorted(r["slash24"] for r in good) == [1 * 65536 + 2 * 256 + 3, 5 * 65536 + 6 * 256 + 7] and len(bad) == 2
    assert all("1.2.3.4" not in str(r) for r in good)
    good, bad = both(sources.reader("pfx2as")(spark, put(tmp_path / "p.tsv", "1.2.0.0\t16\t100_200\n1.2.3.0\t24\t300\n1.2.3.128\t25\t400\n")))
    assert sorted((r["lo24"], r["hi24"], r["asn"], r["moas"]) for r in good) == [(66048, 66303, 100, [200]), (66051, 66051, 300, [])] and len(bad) == 1
    hits = sources.reader("blocklist")(spark, str(tmp_path / "b.txt"))[0]
    lookup = spark.createDataFrame([(66051, 300)], "slash24 long, asn long")
    per = {r["asn"]: r["ips"] for r in networks.per_network(hits, lookup, lookup.limit(0)).collect()}
    assert per == {300: 1, None: 1}


def test_breach_files(spark, tmp_path):
    csv = "Name,DateSubmitted,DateStart,WashingtoniansAffected\nAcme & Sons Inc.,01/05/2024,02/01/2024,500\n,01/05/2024,,3\nOld Co,01/05/1980,,x\n"
    good, bad = both(sources.reader("regulator_wa")(spark, put(tmp_path / "w.csv", csv)))
    assert [(r["norm_name"], r["event_date"], r["placeholder"]) for r in good] == [("acme and sons", None, True)] and len(bad) == 2
    html = "<table><tr><th>Date</th></tr><tr><td>01/02/2024</td><td>Foo <b>GmbH</b></td><td>1,234</td><td>Name; SSN</td><td><a href='x.pdf'>n</a></td></tr></table>"
    (row,), _ = both(sources.reader("notice_tables")(spark, put(tmp_path / "t.html", html)))
    assert (row["norm_name"], row["people"], row["data_types"]) == ("foo", 1234, ["Name", "SSN"])
    rss = "<rss><channel><item><title>Huge data breach at X</title><link>https://n</link><pubDate>Mon, 05 Feb 2024 10:00:00 +0000</pubDate></item><item><title>Weather</title></item></channel></rss>"
    good, _ = both(sources.reader("news_feeds")(spark, put(tmp_path / "r.xml", rss)))
    assert sorted((r["relevant"], str(r["day"])) for r in good) == [(False, "None"), (True, "2024-02-05")]
    post = {"group_name": "G", "post_title": "www.victim.example", "discovered": "2024-01-01", "description": "over 1,200 employees and 3 million records"}
    (row,), _ = both(sources.reader("leak_posts")(spark, put(tmp_path / "l.ndjson", json.dumps(post))))
    assert (row["domain"], row["employees"], row["largest_number"], len(row["post_id"])) == ("victim.example", "1,200", 3e6, 64)
    actors = "\n".join(json.dumps(a) for a in ({"value": "Alpha", "synonyms": ["A-1", "Shared"]}, {"value": "Beta", "synonyms": ["shared"]}))
    good, _ = both(sources.reader("actors")(spark, put(tmp_path / "a.ndjson", actors)))
    assert sorted((r["alias"], r["actor"]) for r in good) == [("a1", "Alpha"), ("alpha", "Alpha"), ("beta", "Beta")]
    res = [{"benchmark": "b", "model": "m", "score": 0.5, "ci": [0.4, 0.6], "source_url": "https://s", "published_on": "2025-01-01"}]
    res += [{**res[0], "source_url": "http://s"}, {**res[0], "score": 0.9}, {**res[0], "model": None}]
    good, bad = both(sources.reader("capability_results")(spark, put(tmp_path / "c.json", res)))
    assert len(good) == 1 and len(bad) == 3


def test_registry():
    assert len(sources.names()) >= 35
    with pytest.raises(ValueError):
        sources.register("cisa_kev")(lambda s, p: None)
    assert common.split
