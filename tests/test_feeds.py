"""Hand-written payloads per feed, with the oddities each is known for."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import functions as F

from tidemark.operators import snapshot
from tidemark.plans import jobs as jobs_plan
from tidemark.plans import rentals as rentals_plan
from tidemark.session import scratch_path
from tidemark.sources import feeds, jobs, rentals


def landed(spark, feed, *bodies, slug="acme"):
    rows = [(feed, slug, i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, feeds.LANDING_SCHEMA)


def records(spark, feed, *bodies, **options):
    return [r.asDict() for r in jobs.normalise(landed(spark, feed, *bodies, **options), feed).orderBy("ord").collect()]


def some(row, **want):
    got = {k: row[k] for k in want}
    assert got == want


def test_gupy(spark):
    page = {"data": [
        {"id": 1, "name": " Dev ", "careerPageName": "Acme", "jobUrl": "u", "isRemoteWork": True, "workplaceType": "on-site", "city": None,
         "publishedDate": "2024-05-06T00:00:00Z", "skills": [{"name": "sql"}, "py", {"x": 1}, ""], "description": "<p>a &amp; b</p>"},
        {"id": 1, "name": "Again"}, {"id": "2", "name": None, "workplaceType": "hybrid"}]}
    first, second = records(spark, "gupy", page)
    some(first, native_id="1", title="Dev", company="Acme", work_model="remote", city="", country="BR", market="BR",
         published_date=date(2024, 5, 6), skills=["sql", "py"], description="a & b", salary_min=None, levels=[])
    some(second, native_id="2", title="", work_model="hybrid", published_date=None)


def test_a_broken_page_does_not_stop_the_feed_and_is_counted(spark):
    pages = ("{oops", {"data": [{"id": 5}, {"id": 6}]}, {"other": 1}, "", '{"data":[{"id":7}', {"data": []})
    assert [r["native_id"] for r in records(spark, "gupy", *pages)] == ["5", "6"]
    landing = landed(spark, "gupy", *pages).unionByName(landed(spark, "lever", "nothing"))
    lost = {r.page: r.reason for r in feeds.lost_pages(landing, "gupy").collect()}
    assert lost == {0: "unreadable", 2: "no records field", 3: "empty", 4: "unreadable"}
    report = {r.feed: tuple(r)[1:] for r in feeds.feed_report(landing, ["gupy", "lever", "ashby"]).collect()}
    assert report == {"gupy": (6, 4, 2, False), "lever": (1, 1, 0, True), "ashby": (0, 0, 0, True)}


def test_themuse(spark):
    job = {"id": 3, "name": "Dev", "company": {"name": "C"}, "locations": [{"name": "NY"}, {"name": "Flexible / Remote"}],
           "levels": [{"name": "Mid Level"}, {"name": ""}], "categories": [{"name": "Data"}], "refs": {"landing_page": "u"},
           "publication_date": "2024-01-02T03:04:05Z", "contents": "x"}
    first, second = records(spark, "themuse", {"results": [job, {"id": 4, "locations": None}]})
    some(first, url="u", city="NY", country="Remote", market="Global remote", work_model="remote", levels=["Mid Level"], categories=["Data"])
    some(second, city="", country="", market="Global", work_model="", company="", levels=[])


def test_remotive_and_jobicy(spark):
    rows = records(spark, "remotive", {"jobs": [{"url": "u", "tags": ["", *"abcdefghij"]}, {"id": "u"}, {"id": 9, "category": "Data"}]})
    assert [r["native_id"] for r in rows] == ["u", "9"]
    some(rows[0], skills=list("abcdefghij"), categories=[])
    capped = jobs.normalise(landed(spark, "remotive", {"jobs": [{"url": "u", "tags": ["", *"abcdefghij"]}]}), "remotive", max_tags=8)
    assert capped.first().skills == list("abcdefgh")
    some(rows[1], categories=["Data"])
    rows = records(spark, "jobicy", {"jobs": [{"id": 1, "jobIndustry": ["A", "B"]}, {"id": 2, "jobIndustry": "C"}, {"id": 3}]})
    assert [r["categories"] for r in rows] == [["A", "B"], ["C"], []]


def test_remoteok(spark):
    rows = records(spark, "remoteok", [{"legal": "notice"}, {"id": "7", "position": "P", "salary_min": 0, "salary_max": 5000, "date": 1700000000},
                                       {"id": "8", "url": "u"}])
    some(rows[0], native_id="7", url="https://remoteok.com/remote-jobs/7", salary_min=None, salary_max=5000.0, salary_currency="USD",
         published_date=date(2023, 11, 14))
    some(rows[1], url="u", salary_currency=None)


def test_himalayas_nomads_arbeitnow(spark):
    rows = records(spark, "himalayas", {"jobs": [{"guid": "g", "title": "T", "locationRestrictions": ["BR", "PT"]},
                                                 {"title": "T", "applicationLink": "a", "locationRestrictions": "EU"}]})
    some(rows[0], native_id="g", url="g", country="BR, PT")
    some(rows[1], native_id="T", url="a", country="EU")
    some(records(spark, "workingnomads", [{"url": "u", "location": "Anywhere", "category_name": "X"}])[0],
         native_id="u", work_model="remote", country="Anywhere", categories=["X"])
    rows = records(spark, "arbeitnow", {"data": [{"slug": "s", "remote": True, "location": "Berlin", "created_at": 1700000000}, {"url": "v", "remote": False}]})
    some(rows[0], native_id="s", work_model="remote", published_date=date(2023, 11, 14))
    some(rows[1], native_id="v", work_model="")


def test_rss(spark):
    item = ("<item><link> l1 </link><title>Acme: Dev: Lead</title><region>EU</region><category>Data</category>"
            "<pubDate>Mon, 06 May 2024 23:30:00 -0800</pubDate><description>&lt;p&gt;x&lt;/p&gt;</description></item>")
    page = f"<rss><channel>{item}{item}<item><link>l2</link><title>Dev</title><country>PT</country></item><item><title>no link</title></item></channel></rss>"
    first, second = records(spark, "weworkremotely", page)
    some(first, native_id="l1", company="Acme", title="Dev: Lead", country="EU", published_date=date(2024, 5, 6), description="x", categories=["Data"])
    some(second, company="", title="Dev", country="PT", categories=[], published_date=None)


def test_company_boards(spark):
    gh = {"jobs": [{"id": i, "title": "T", "location": {"name": "São Paulo"}, "departments": [{"name": "D"}, {"name": ""}], "first_published": "2024-02-03"}
                   for i in range(130)]}
    rows = records(spark, "greenhouse", gh, slug="wildlifestudios")
    assert [r["native_id"] for r in rows] == [str(i) for i in range(130)]
    capped = jobs.normalise(landed(spark, "greenhouse", gh, slug="wildlifestudios"), "greenhouse", cap=120)
    assert [r.native_id for r in capped.orderBy("ord").collect()] == [str(i) for i in range(120)]
    some(rows[0], company="Wildlife Studios", country="BR", market="BR", city="São Paulo", categories=["D"], published_date=date(2024, 2, 3))
    lever = [{"id": "x", "text": "T", "createdAt": 1700000000000, "categories": {"location": "Berlin", "commitment": "Remote", "team": "Ops"}}, {"id": "y"}]
    first, second = records(spark, "lever", lever)
    some(first, work_model="remote", market="Global", country="Berlin", categories=["Ops"], published_date=None)
    some(second, categories=[""], city="")
    in_ms = jobs.lever(feeds.unpack(landed(spark, "lever", lever), "lever"), epoch_unit="ms").where("native_id = 'x'").first()
    assert in_ms.published_date == date(2023, 11, 14)
    first, second = records(spark, "ashby", {"jobs": [{"jobId": "j", "locationName": "Curitiba", "isRemote": True, "applyUrl": "a", "teamName": "T"}, {"id": 1, "location": "Remote"}]})
    some(first, native_id="j", work_model="remote", country="BR", market="Global remote", url="a", categories=["T"])
    some(second, market="Global remote", work_model="remote", categories=[""])


LISTING = {
    "id": "11", "status": "ACTIVE", "usageTypes": ["", "RESIDENTIAL"], "unitTypes": ["FARM"], "title": " Sítio ", "description": "zap 11 91234-5678 <b>piscina</b>",
    "pricingInfos": [{"businessType": "SALE", "price": "290000"}, {"businessType": "RENTAL", "price": "0"},
                     {"businessType": "RENTAL", "price": "9000", "rentalInfo": {"period": "DAILY"}},
                     {"businessType": "RENTAL", "price": "7.500", "monthlyCondoFee": "300", "yearlyIptu": "1200", "rentalInfo": {"period": "monthly"}}],
    "address": {"city": "Itu", "state": "SP"}, "displayAddressGeolocation": {"lat": -23.0, "lon": -47.1}, "totalAreas": ["6000"], "bedrooms": ["3"],
    "amenities": ["POOL"], "mergedAmenities": [], "portals": ["ZAP", "VIVAREAL", ""], "createdAt": "2024-03-04T00:00:00Z",
}
MEDIA = [{"id": "a1", "type": "IMAGE"}, {"id": "b2", "type": "VIDEO"}, {"id": "c-3"}, {"id": "d4"}, {"id": "e" * 41}, {"id": None}]


def listing(**other):
    return {"listing": {**LISTING, **other}, "account": {"name": " Agency "}, "medias": MEDIA}


def test_listing(spark):
    rows = rentals.normalise(landed(spark, "rentals", {"listings": [
        listing(), listing(title="second copy"), listing(id="12", status="INACTIVE"), listing(id="13", usageTypes=["COMMERCIAL"]),
        listing(id="14", pricingInfos=[]), listing(id=None), listing(id="15", portals=["ZAP"], usageTypes=None, displayAddressGeolocation=None)]}), "zap")
    got = {r.native_id: r for r in rows.collect()}
    assert set(got) == {"11", "15"}
    r = got["11"]
    assert (r.title, r.url, r.rent, r.condo_fee, r.iptu) == ("Sítio", "https://www.vivareal.com.br/imovel/id-11/", 7500, 300, 1200)
    assert (r.description, r.photos, r.amenities_raw, r.portals, r.advertiser) == ("zap [phone] piscina", ["a1", "d4"], ["POOL"], ["ZAP", "VIVAREAL"], "Agency")
    assert (r.total_area, r.usable_area, r.bedrooms, r.lat, r.unit_type_raw) == (6000, None, 3, -23.0, "FARM")
    assert got["15"].url == "https://www.zapimoveis.com.br/imovel/id-15/" and got["15"].lat is None


def test_rentals_run_over_two_days(spark):
    base = spark.createDataFrame([], rentals_schema())
    rents = spark.createDataFrame([], "listing_uid string, date date, rent bigint")
    centroids = None
    states = []
    for today, price in (("2024-03-05", "7000"), ("2024-03-06", "6500")):
        pricing = [{"businessType": "RENTAL", "price": price}]
        run = rentals_plan.collect(landed(spark, "rentals", {"listings": [
            listing(pricingInfos=pricing), listing(id="15", pricingInfos=pricing, displayAddressGeolocation=None),
            listing(id="16", address={"city": "Far", "state": "SP"}, displayAddressGeolocation={"lat": 10, "lon": 10})]}), centroids)
        after = rentals_plan.update_base(base, run.batch, today)
        rents = rentals_plan.update_rents(rents, base, after, run.batch, today)
        folder = scratch_path(spark, "rentals")
        for name, df in (("base", after), ("rents", rents), ("centroids", run.centroids)):
            df.write.parquet(f"{folder}/{name}")
        base, rents, centroids = (spark.read.parquet(f"{folder}/{n}") for n in ("base", "rents", "centroids"))
        states.append({r.listing_uid: r for r in base.collect()})
    assert set(states[1]) == {"grupozap:11", "grupozap:15"}
    last = states[1]["grupozap:15"]
    assert (last.rent, last.geo_approx, last.dedupe_key, str(last.first_seen_date), str(last.last_seen_date)) == (6500, 1, "", "2024-03-05", "2024-03-06")
    assert last.features == ["Piscina"] and last.is_match == 1
    assert rents.count() == 4
    shot = rentals_plan.serve(base, rents, "2024-03-06")
    assert {(r.uid, r.rent0, r.nads) for r in shot.rows.collect()} == {("grupozap:11", 7000, 1), ("grupozap:15", 7000, 1)}
    assert set(shot.rows.columns) >= set(snapshot.LISTING_CODES.values()) | {"feat", "ph"}


def rentals_schema():
    return (
        "listing_uid string, source string, portals array<string>, title string, url string, property_type string, city string, state string, "
        "lat double, lon double, distance_km double, distance_band string, geo_approx int, rent bigint, condo_fee bigint, iptu bigint, "
        "total_area bigint, usable_area bigint, price_per_m2 double, bedrooms bigint, suites bigint, bathrooms bigint, parking bigint, "
        "features array<string>, photos array<string>, advertiser string, is_match int, published_date date, description string, "
        "dedupe_key string, first_seen_date date, last_seen_date date")


def test_jobs_run_serves_a_snapshot(spark):
    page = {"data": [{"slug": f"s{i}", "title": "Senior Data Engineer", "company_name": f"C{i % 3}", "url": f"u{i}", "created_at": 1714500000 + i * 86400,
                      "location": "Berlin"} for i in range(6)]}
    batch = jobs_plan.collect(landed(spark, "arbeitnow", page), ["arbeitnow"])
    base = jobs_plan.update_base(jobs_plan.empty_base(spark), batch, "2024-05-06")
    shot = jobs_plan.serve(base, "2024-05-06")
    rows = shot.rows.orderBy("position").collect()
    assert len(rows) == 6 and rows[0].src == 0 and {r.np for r in rows} == {1}
    labels = {(r.column, r.value) for r in shot.dictionary.collect()}
    assert {("area", "data"), ("seniority", "senior"), ("country", "Berlin"), ("work_model", "")} <= labels
    document = snapshot.columnar_document(shot.rows, 9).first().document
    assert len(json.loads(document)["title"]) == 6


def test_landing_files_round_trip(spark):
    path = scratch_path(spark, "feed-files")
    feeds.write_landing(landed(spark, "workingnomads", [{"url": "u"}]), path)
    feeds.write_landing(landed(spark, "rentals", {"listings": []}), path)
    assert jobs.normalise_all(feeds.read_landing(spark, path)).select("native_id").first().native_id == "u"
    assert feeds.read_landing(spark, path).select(F.max("page")).first()[0] == 0
    plan = feeds.unpack(feeds.read_landing(spark, path), "rentals")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(feed" in plan  # other feeds' folders are not read


def test_a_bad_record_leaves_its_page_alone(spark):
    bodies = [
        '{"data":[{"id":"1","name":"a","isRemoteWork":true},"oops",{"id":"2","isRemoteWork":"maybe","skills":7},null,[],{"id":"3"}]}',
        '{"data":[{"id":"4"},{"id":5,"skills":["x"]}]}', '{"data":[]}', '{"data":"x"}', "{broken", None, '{"other":[1]}',
    ]
    landing = spark.createDataFrame([("gupy", None, n, b) for n, b in enumerate(bodies)], feeds.LANDING_SCHEMA)
    rows = feeds.unpack(landing, "gupy").orderBy("ord").collect()
    assert [(r.ord % feeds.RECORDS_PER_PAGE, r.r.id, r.r.isRemoteWork) for r in rows] == [
        (0, "1", True), (2, "2", None), (5, "3", None), (0, "4", None), (1, "5", None)]
    bad = feeds.quarantine(landing, "gupy").orderBy("page", "place").collect()
    assert [(r.page, r.place, r.reason, r.fields) for r in bad] == [
        (0, 1, "not a record", []), (0, 2, "unreadable fields", ["isRemoteWork", "skills"]), (0, 3, "not a record", []), (0, 4, "not a record", [])]
    assert feeds.quarantine(landing, "lever").count() == 0
    assert feeds.quarantine(landing.withColumn("feed", F.lit("weworkremotely")), "weworkremotely").count() == 0
