import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from vetline.plans import jobs, risk, sanctions, screening
from vetline.plans import vacancies as vac
from vetline.plans.manifest import build_manifest, file_order
from vetline.plans.profiles import DEFAULT_PROFILES, PROFILE_SCHEMA, Profile, profile_rows, tag_profiles
from vetline.session import scratch_path
from vetline.sources import jsonl, payloads, sinks
from vetline.sources.store import KeyedStore
from vetline.sources.xml import read_entities, read_individuals

import pytest

D = dt.date


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def vacancy(i, **changes):
    base = dict(
        vacancy_id=i, title="t", published_at="2026-01-04", area_name="a", employer_id=1, salary_from=1, salary_to=1,
        archived=False, load_dt=D(2026, 1, 4), expected_risk_category="office",
    )
    return base | changes


def signals(spark, vacancies, text=(), employers=((1, "Acme"),), sanctioned=None):
    schema = (
        "vacancy_id bigint, title string, published_at string, area_name string, employer_id bigint, salary_from int, "
        "salary_to int, archived boolean, load_dt date, expected_risk_category string"
    )
    hits = None if sanctioned is None else spark.createDataFrame([(e,) for e in sanctioned], "employer_id bigint")
    got = risk.risk_signals(
        spark.createDataFrame(vacancies, schema),
        spark.createDataFrame(list(text), "vacancy_id bigint, description_text string, load_dt date"),
        spark.createDataFrame(list(employers), "employer_id bigint, name string"),
        hits,
    )
    return got


def test_risk_levels(spark):
    day, long_text = D(2026, 1, 4), "x" * 300
    text = [(i, long_text, day) for i in (1, 2, 3, 4, 6)] + [(5, long_text, D(2026, 1, 5)), (7, "x" * 299, day)]
    got = signals(
        spark,
        [
            vacancy(1),
            vacancy(2, salary_from=500000),
            vacancy(3, salary_from=None, salary_to=None, expected_risk_category="scam"),
            vacancy(4, employer_id=9),
            vacancy(5),
            vacancy(6, employer_id=2, archived=None),
            vacancy(7, salary_to=700000),
        ],
        text,
        [(1, "Acme"), (2, "")],
    )
    levels = {r.vacancy_id: (r.risk_level, r.downstream_action, r.risk_warning_count) for r in got.collect()}
    assert levels[1] == ("OK", "monitor", 0)
    assert levels[2] == ("WARNING", "analytics", 1)
    assert levels[3] == ("WARNING", "analytics", 1)
    assert levels[4][:2] == ("CRITICAL", "manual_review") == levels[6][:2]
    assert levels[5] == ("WARNING", "analytics", 1)  # text of another day does not count
    assert levels[7] == ("WARNING", "analytics", 2)


def test_sanctioned_employer_and_long_form(spark):
    got = signals(spark, [vacancy(1), vacancy(2, employer_id=2)], employers=[(1, "A"), (2, "B")], sanctioned=[2, 2])
    assert rows(got, "vacancy_id", "risk_level", "downstream_action") == [(1, "WARNING", "analytics"), (2, "CRITICAL", "alert")]
    long = risk.risk_signals_long(got)
    assert long.count() == 10
    fired = long.filter("signal_value AND severity = 'critical'")
    assert rows(fired, "vacancy_id", "risk_signal_name", "blocking") == [(2, "sanctions_match_employer", True)]
    cases = risk.case_queue(got)
    assert rows(cases, "vacancy_id", "risk_case_type", "action_type") == [
        (1, "VAGUE_DESCRIPTION", "REVIEW_LIGHT"),
        (2, "POTENTIAL_SANCTIONS", "BLOCK_ESCALATE"),
    ]


def test_bronze_validity(spark):
    schema = "id bigint, published_at string, archived boolean, load_dt date"
    first = spark.createDataFrame(
        [(1, "2026-01-04T23:30:00+0300", False, D(2026, 1, 5)), (2, None, None, D(2026, 1, 5))], schema
    )
    bronze = vac.with_validity(first)
    open_end = D(2999, 1, 1)
    assert rows(bronze, "id", "active_from", "active_to") == [(1, D(2026, 1, 4), open_end), (2, D(2026, 1, 5), open_end)]
    again = spark.createDataFrame([(1, "2026-02-01T00:00:00+0300", True, D(2026, 2, 2))], schema)
    merged = vac.upsert_bronze(bronze, again)
    assert rows(merged, "id", "active_from", "active_to")[0] == (1, D(2026, 1, 4), D(2026, 2, 2))
    assert rows(vac.upsert_bronze(merged, again)) == rows(merged)


def test_profiles(spark):
    df = spark.createDataFrame(
        [(1, "Менеджер: быстрый заработок"), (2, "Трейдер, КРИПТОвалюта"), (3, "менеджеры казино"), (4, None)],
        "id int, text string",
    )
    got = tag_profiles(df, "text", DEFAULT_PROFILES)
    assert rows(got, "id", "search_profile") == [(1, "P5_scam_baits"), (2, "P2_crypto")]
    config = spark.createDataFrame([("A", [["x"], ["y*"]], "c", True), ("B", [["x"]], "c", False), ("C", [["x"]], "c", None)], PROFILE_SCHEMA)
    text = spark.createDataFrame([(1, "X, yes"), (2, "x")], "id int, text string")
    assert rows(tag_profiles(text, "text", config), "id", "search_profile", "expected_risk_category") == [(1, "A", "c")]
    assert rows(tag_profiles(text, "text", profile_rows(spark, [Profile("A", (("x",),), "c")])), "id") == [(1,), (2,)]
    for nothing in ([], [("A", [[""]], "c", True)], [("A", [[], ["x"]], "c", True)], [("A", [], "c", True)], [("A", [["*"], ["x"]], "c", True)]):
        assert tag_profiles(text, "text", spark.createDataFrame(nothing, PROFILE_SCHEMA)).count() == 0


def _profile_pattern(terms):
    """The terms of a group as one regular expression: whole words, an open ending for `*`."""
    import re

    words = [re.escape(t[:-1].lower()) + r"[^\W_]*" if t.endswith("*") else re.escape(t.lower()) for t in terms]
    return re.compile(r"(?:^|[\W_])(?:" + "|".join(words) + r")(?:[\W_]|$)")


def test_profiles_of_all_shapes_are_brute_force(spark):
    import random

    rng = random.Random(3)
    atoms = ["ab", "abc", "b", "c++", ".net", "на карту", "ab-c", "x y z", "c+", "d", "a1", "é"]
    texts = ["".join(rng.choice(atoms) + rng.choice([" ", " ", ", ", "-", "  ", "", "\n"]) for _ in range(rng.randrange(0, 9))) for _ in range(120)]
    texts += ["Ab", "AB c++", "c++x", "x.net", ".NET", "", " ", texts[5], texts[5]]
    terms = [*atoms, "ab*", "b*", "c+*", "на к*", "x y*", "AB", "a*", "ab -", "- b"]
    profiles = [(f"p{i}", [[rng.choice(terms) for _ in range(rng.randrange(1, 4))] for _ in range(rng.randrange(1, 4))], f"c{i % 3}", True) for i in range(150)]
    table = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = rows(tag_profiles(table, "text", spark.createDataFrame(profiles, PROFILE_SCHEMA)), "id", "search_profile", "expected_risk_category")
    want = [(i, name, category) for i, text in enumerate(texts) for name, groups, category, _ in profiles if all(_profile_pattern(g).search(text.lower()) for g in groups)]
    assert sorted(got) == sorted(want)


def test_ten_thousand_profiles_need_no_plan_of_their_own(spark):
    profiles = spark.range(10_000).selectExpr(
        "concat('p', id) AS profile_id", "array(array(concat('w', id)), array('common', concat('v', id, '*')))  AS groups", "'c' AS expected_risk_category", "true AS enabled"
    )
    texts = spark.createDataFrame([(1, "w17 common w9999"), (2, "w18 v18x"), (3, "v17 common")], "id int, text string")
    tagged = tag_profiles(texts, "text", profiles)
    assert rows(tagged, "id", "search_profile") == [(1, "p17"), (1, "p9999"), (2, "p18")]
    assert len(tagged._jdf.queryExecution().optimizedPlan().toString()) < 20_000


LIST = [("1", "ADF/NALU"), ("1", "Allied Democratic Forces"), ("2", "FRANK KAKOLELE BWAMBALE"), ("3", "ADF NALU"), ("4", "--")]


def listed(spark):
    entities = spark.createDataFrame(LIST, "entity_id string, primary_name string")
    aliases = spark.createDataFrame([("5", "Adf  Nalu"), ("6", None)], "entity_id string, alias_name string")
    stamp = {"source_list": F.lit("UN_SC_1267"), "load_timestamp": F.lit("t")}
    return sanctions.screening_names(entities.withColumns(stamp), aliases.withColumns(stamp))


def test_screening_golden(spark):
    inputs = spark.createDataFrame(
        [
            (1, "ADF NALU"), (2, "Allied Democrtic Forces"), (3, "Frank Kakolele Bwambal"), (4, "Привет"), (5, "ADF NALU"),
            (6, None),
        ],
        "input_id int, input_name string",
    )
    names = listed(spark)
    best = screening.screen_fuzzy_best(inputs, names)
    demo = rows(screening.demo_results(best), "input_name", "similarity_score", "screening_result")
    assert demo == [
        ("ADF NALU", 1.0, "MATCH"),
        ("Allied Democrtic Forces", 0.8148, "POSSIBLE_MATCH"),
        ("Frank Kakolele Bwambal", 0.9167, "POSSIBLE_MATCH"),
        ("Привет", 0.0, "MATCH"),  # both sides normalise to the empty text
    ]
    top = screening.screen_fuzzy_top(inputs, names).filter("input_name = 'ADF NALU'")
    # the name is listed twice, so its best matches appear twice
    assert rows(top, "rn", "matched_name") == [(1, "ADF NALU"), (2, "ADF NALU"), (3, "ADF/NALU")]
    exact = screening.screen_exact(inputs, names)
    assert exact.filter("input_id = 1").count() == 3 and exact.filter("screening_result = 'NO_MATCH'").count() == 4
    chosen = screening.screen_exact_best(inputs, names)
    assert rows(chosen.filter("input_id = 1"), "matched_name", "name_type") == [("ADF NALU", "primary")]
    assert chosen.count() == 6


XML = """<?xml version="1.0"?><CONSOLIDATED_LIST><INDIVIDUALS>
<INDIVIDUAL><DATAID>1</DATAID><VERSIONNUM>2</VERSIONNUM><FIRST_NAME> Ann </FIRST_NAME><THIRD_NAME>Lee</THIRD_NAME>
<LISTED_ON>2015-04-07-04:00</LISTED_ON><NATIONALITY><VALUE>X</VALUE><VALUE2/></NATIONALITY>
<INDIVIDUAL_ALIAS><ALIAS_NAME>Annie</ALIAS_NAME></INDIVIDUAL_ALIAS><INDIVIDUAL_ALIAS><ALIAS_NAME/></INDIVIDUAL_ALIAS>
<INDIVIDUAL_DOCUMENT><NUMBER>7</NUMBER></INDIVIDUAL_DOCUMENT><INDIVIDUAL_DOCUMENT/></INDIVIDUAL>
</INDIVIDUALS><ENTITIES><ENTITY><DATAID>9</DATAID><VERSIONNUM>1</VERSIONNUM><FIRST_NAME>Org &amp; Co</FIRST_NAME>
<ENTITY_ALIAS><ALIAS_NAME>O-C</ALIAS_NAME></ENTITY_ALIAS></ENTITY></ENTITIES></CONSOLIDATED_LIST>"""


def test_sanctions_xml(spark, tmp_path):
    path = tmp_path / "list.xml"
    path.write_text(XML)
    people, orgs = read_individuals(spark, str(path)), read_entities(spark, str(path))
    tables = sanctions.flatten_sanctions(people, orgs)
    assert rows(tables["entities"], "entity_id", "data_id", "entity_type", "primary_name", "listed_on") == [
        ("1", "2", "INDIVIDUAL", "Ann Lee", "2015-04-07"),
        ("9", "1", "ENTITY", "Org & Co", None),
    ]
    assert rows(tables["aliases"], "entity_id", "alias_name") == [("1", "Annie"), ("9", "O-C")]
    assert rows(tables["nationalities"], "entity_id", "nationality") == [("1", "X")]
    assert rows(tables["documents"], "entity_id", "doc_type", "doc_number") == [("1", None, "7")]
    stored = jobs.load_sanctions(spark, str(path), str(tmp_path / "wh"))
    assert rows(stored, "name_value", "normalized_name") == [
        ("Ann Lee", "ann lee"), ("Annie", "annie"), ("O-C", "o c"), ("Org & Co", "org co"),
    ]


def test_quarantine_numbers_lines(spark, tmp_path):
    folder = tmp_path / "land" / "dt=2026-01-04"
    folder.mkdir(parents=True)
    (folder / "a.jsonl").write_text('{"id":1}\n\n{"id":\n{"id":2}\n')
    (folder / "b.jsonl").write_text('oops\n{"id":3,"extra":1}\n')
    good, bad = jsonl.read_jsonl_quarantine(spark, str(tmp_path / "land"), "id bigint")
    assert rows(good, "id") == [(1,), (2,), (3,)]
    got = [(r.file_path.rsplit("/", 1)[1], r.line_no, r.line) for r in bad.collect()]
    assert sorted(got) == [("a.jsonl", 3, '{"id":'), ("b.jsonl", 1, "oops")]


def test_manifest_keeps_file_order(spark, tmp_path):
    path = tmp_path / "list.jsonl"
    lines = [{"id": "2", "search_profile": "a"}, {"id": "2", "search_profile": "b"}, {"id": ""}, {"search_profile": "c"}]
    path.write_text("\n".join(json.dumps(line) for line in lines))
    schema = "id string, search_profile string, expected_risk_category string, load_dt string, load_type string"
    items = jsonl.read_jsonl(spark, str(path), schema)
    items = items.select("*", F.struct(*file_order()).alias("place"))
    got = build_manifest(items, "2026-01-04", "daily", [F.col("place")])
    assert rows(got) == [("2", "a", None, "2026-01-04", "daily")]


def test_csv_append_is_idempotent(spark):
    path, schema = scratch_path(spark, "csv"), "id string, name string"
    old = spark.createDataFrame([("1", "a"), ("2", None)], schema)
    new = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", None)], schema)
    sinks.overwrite_csv(old, path)
    for _ in range(2):
        sinks.append_new_csv(new, path, schema)
    assert rows(spark.read.schema(schema).option("header", True).csv(path)) == [("1", "a"), ("1", "b"), ("2", None)]


def test_payload_registry(spark):
    schema = "object_key string, payload string, inserted_at timestamp_ntz"
    stamp = dt.datetime
    raw = payloads.with_payload_hash(
        spark.createDataFrame([("k1", "x", stamp(2026, 1, 1)), ("k2", "x", stamp(2026, 1, 2))], schema)
    )
    first = payloads.register_payloads(raw.limit(0), raw)
    assert rows(first, "object_key") == [("k1",)]
    assert payloads.register_payloads(first, raw).count() == 0
    assert payloads.latest_payload(raw).first().object_key == "k2"
    with pytest.raises(Exception, match="no payload"):
        payloads.latest_payload(raw.limit(0)).collect()


def test_store_rewrites_touched_buckets_only(spark):
    store = KeyedStore(spark, scratch_path(spark, "store"), "k int, v string", ["k"], buckets=4)
    assert store.read().count() == 0
    first = spark.createDataFrame([(i, "a") for i in range(40)], "k int, v string")
    store.upsert(first, [F.col("v")])
    files = lambda: {r[0] for r in store.read().select("_metadata.file_path").collect()}
    before = files()
    delta = spark.createDataFrame([(7, "b"), (7, "c")], "k int, v string")
    for _ in range(2):
        store.upsert(delta, [F.col("v").desc()])
    assert rows(store.read()) == sorted([(i, "c" if i == 7 else "a") for i in range(40)], key=repr)
    assert len(before - files()) == 1
    store.insert_ignore(spark.createDataFrame([(7, "z"), (99, "z")], "k int, v string"), [F.col("v")])
    assert rows(store.read().filter("k in (7, 99)")) == [(7, "c"), (99, "z")]


def test_jobs_from_files_to_signals(spark, tmp_path):
    landing, warehouse = tmp_path / "land", str(tmp_path / "wh")

    def land(entity, ds, records):
        folder = landing / entity / "load_type=daily" / f"dt={ds}"
        folder.mkdir(parents=True)
        (folder / "part-000.jsonl").write_text("\n".join([json.dumps(r) for r in records] + ["", "{broken"]))

    def item(i, name, archived, trusted):
        return {
            "id": i, "name": name, "archived": archived, "published_at": "2026-01-03T10:00:00+0300",
            "area": {"id": "40", "name": "X"}, "salary": {"from": 600000, "to": None, "currency": "KZT"},
            "employer": {"id": "5", "name": "Acme", "trusted": trusted}, "schedule": {"name": "full"},
            "expected_risk_category": "office",
        }

    skills = [{"name": "SQL"}, {"name": "SQL"}, {"name": "ETL"}]
    for ds, name, archived in (("2026-01-04", "old", False), ("2026-01-05", "new", True)):
        land("vacancies_list", ds, [item(1, name, archived, archived), {"id": 2, "name": "no employer"}])
        land("vacancy_details", ds, [{"id": 1, "description": "<p>" + "x" * 400 + "</p>", "key_skills": skills}])
        for _ in range(2):  # a rerun changes nothing
            jobs.load_day(spark, str(landing), warehouse, ds, buckets=2)
    got = jobs.refresh_risk_signals(spark, warehouse).collect()
    assert [(r.vacancy_id, r.title, r.is_active, r.employer_name, r.risk_level) for r in got] == [
        (1, "new", False, "Acme", "WARNING")
    ]
    stores = jobs.silver_stores(spark, warehouse)
    assert rows(stores["employers"].read(), "trusted", "first_seen_dt", "last_seen_dt") == [
        (True, D(2026, 1, 4), D(2026, 1, 5))
    ]
    assert rows(stores["vacancy_skills"].read(), "skill_name", "load_dt") == [
        ("ETL", D(2026, 1, 4)), ("SQL", D(2026, 1, 4)),
    ]
    vacancies = stores["vacancies"].read()
    assert rows(vacancies, "active_from", "active_to") == [(D(2026, 1, 3), D(2026, 1, 5))]
    quarantined = spark.read.json(f"{warehouse}/quarantine/vacancies_list")
    assert rows(quarantined, "line", "line_no") == [("{broken", 4), ("{broken", 4)]


def test_jobs_bronze_manifest_and_report(spark, tmp_path):
    landing, warehouse, ds = tmp_path / "land", str(tmp_path / "wh"), "2026-01-04"

    def land(entity, day, name, records):
        folder = landing / entity / "load_type=daily" / f"dt={day}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("\n".join([json.dumps(r) for r in records] + ["", "{broken"]))

    def item(i, title, archived):
        return {"id": i, "name": title, "archived": archived, "published_at": "2026-01-03T10:00:00+0300", "search_profile": f"P{i}"}

    land("vacancies_list", ds, "part-000.jsonl", [item(1, "a", False), item(1, "twice", False), item(2, "b", False), item(3, "c", False), {"name": "no id"}])
    land("vacancy_details", ds, "part-000.jsonl", [{"id": "1", "name": "a"}, {"id": 4, "name": "not asked for"}])
    land("vacancy_details", ds, "part-001.jsonl", [{"id": 1, "name": "a"}])
    land("vacancy_details_failures", ds, "part-000.jsonl", [{"reason": "not_found", "http_status": "404"}, {"reason": None}, {"reason": "not_found", "http_status": 404}])
    for _ in range(2):  # a rerun changes nothing
        jobs.load_day(spark, str(landing), warehouse, ds, buckets=2)
        jobs.write_day_manifest(spark, str(landing), ds)
        report = jobs.report_day(spark, str(landing), warehouse, ds, buckets=2).first()
    manifest = spark.read.json(f"{landing}/vacancies_ids/load_type=daily/dt={ds}")
    assert rows(manifest, "vacancy_id", "search_profile", "load_dt", "load_type") == [(str(i), f"P{i}", ds, "daily") for i in (1, 2, 3)]
    assert (report.expected_count, report.loaded_count, report.missing_count, report.found_files, report.failures_files) == (3, 2, 2, 2, 1)
    assert (report.severity, report.coverage_reason, report.sample_missing_ids) == ("WARNING", "OK", ["2", "3"])
    assert report.failures_by_reason == {"not_found": 2, "unknown": 1} and report.failures_by_status == {"404": 2, "unknown": 1}
    # a day without files
    empty = jobs.report_day(spark, str(landing), warehouse, "2026-01-09", buckets=2).first()
    assert (empty.coverage_reason, empty.severity, empty.found_files, empty.failures_files) == ("NO_MANIFEST", "CRITICAL", 0, 0)
    kept = jobs.KeyedStore(spark, f"{warehouse}/bronze/details_coverage_report", *jobs.REPORT_STORE).read()
    assert rows(kept, "load_dt", "severity", "failures_by_reason") == [(D(2026, 1, 4), "WARNING", '{"not_found":2,"unknown":1}'), (D(2026, 1, 9), "CRITICAL", "{}")]

    land("vacancies_list", "2026-01-05", "part-000.jsonl", [item(1, "new", True)])
    land("vacancy_details", "2026-01-05", "part-000.jsonl", [{"id": 1, "name": "new"}])
    jobs.load_day(spark, str(landing), warehouse, "2026-01-05", buckets=2)
    bronze = jobs.bronze_stores(spark, warehouse)
    first, last, never = D(2026, 1, 3), D(2026, 1, 5), D(2999, 1, 1)
    assert rows(bronze["vacancies"].read(), "id", "name", "active_from", "active_to") == [(1, "new", first, last), (2, "b", first, never), (3, "c", first, never)]
    assert rows(bronze["vacancy_details"].read(), "id", "name", "load_dt") == [(1, "new", last), (4, "not asked for", D(2026, 1, 4))]


def test_screening_job_compares_only_what_is_new(spark, tmp_path):
    warehouse = str(tmp_path / "wh")
    listed = [(i, n, "primary", "UN") for i, n in LIST]
    names = spark.createDataFrame(listed, "entity_id string, name_value string, name_type string, source_list string")
    names = names.withColumn("normalized_name", screening.normalize_name("name_value"))
    inputs = spark.createDataFrame([(1, "ADF NALU"), (2, "Allied Democrtic Forces"), (3, "nobody")], "input_id int, input_name string")
    jobs.screen(inputs.filter("input_id < 2"), names.filter("entity_id < 2"), warehouse)
    marts = jobs.screen(inputs, names, warehouse)
    assert rows(marts["sanctions_exact_matches"]) == rows(screening.screen_exact(inputs, names))
    assert rows(marts["sanctions_fuzzy_matches"]) == rows(screening.screen_fuzzy_top(inputs, names))
    assert rows(marts["sanctions_fuzzy_matches_best"]) == rows(screening.screen_fuzzy_best(inputs, names))
    assert rows(marts["sanctions_screening_results_demo"]) == rows(screening.demo_results(screening.screen_fuzzy_best(inputs, names)))
    store = jobs.PairStore(spark, f"{warehouse}/gold/similar_names", screening.THRESHOLD)
    batches = store.last_batch()
    jobs.screen(inputs, names, warehouse)
    assert store.last_batch() == batches == 1


def test_store_keeps_its_bucket_count(spark):
    path, schema = scratch_path(spark, "store"), "k int, v string"
    first = spark.createDataFrame([(i, "a") for i in range(40)], schema)
    KeyedStore(spark, path, schema, ["k"], buckets=6).upsert(first, [F.col("v")])
    for buckets in (4, 8):
        with pytest.raises(ValueError, match="6 buckets"):
            KeyedStore(spark, path, schema, ["k"], buckets=buckets)
    again = KeyedStore(spark, path, schema, ["k"])
    again.upsert(spark.createDataFrame([(1, "b")], schema), [F.col("v")])
    assert again.buckets == 6 and again.read().count() == 40
    with pytest.raises(ValueError, match="null"):
        again.upsert(spark.createDataFrame([(None, "b")], schema), [F.col("v")])
    assert again.read().count() == 40


def test_store_survives_a_failure_before_the_switch(spark, monkeypatch):
    path, schema = scratch_path(spark, "store"), "k int, v string"
    store = KeyedStore(spark, path, schema, ["k"], buckets=3)
    store.upsert(spark.createDataFrame([(i, "a") for i in range(20)], schema).repartition(16), [F.col("v")])
    files = store.read().select("_metadata.file_path").distinct().count()
    assert files <= 3
    monkeypatch.setattr(KeyedStore, "_switch", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.upsert(spark.createDataFrame([(i, "b") for i in range(20)], schema), [F.col("v")])
    assert rows(store.read()) == sorted([(i, "a") for i in range(20)], key=repr)


def test_quoted_keys_load_and_unkeyed_lines_do_not(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id":"101","n":"x"}\n{"id":102,"n":5}\n\n{"id":"no"}\n{"n":1}\n{"id":\n')
    good, bad = jsonl.read_jsonl_quarantine(spark, str(tmp_path), "id bigint, n string", ["id"])
    assert rows(good, "id", "n") == [(101, "x"), (102, "5")]
    assert rows(bad, "line_no", "reason") == [(4, "no key"), (5, "no key"), (6, "not JSON")]


def test_variants_are_parsed_once_and_read_by_path(spark):
    from vetline.plans import variants

    records = [
        (1, "a", '{"id":"7","name":"Acme"}', '{"from":1.5,"to":null,"currency":"KZT"}'),
        (2, "b", '{"name":"no id"}', None),
        (3, "c", "{broken", "[]"),
        (4, "d", '{"id":8}', '{"from":"x"}'),
    ]
    rest = {name: F.lit(None).cast("string") for name in ("area", "schedule", "employment", "experience", "published_at", "search_profile", "expected_risk_category")}
    dates = {name: F.lit(None).cast("date") for name in ("active_from", "active_to", "load_dt")}
    bronze = spark.createDataFrame(records, "id int, name string, employer string, salary string").withColumns({**rest, **dates, "archived": F.lit(False)})
    path = scratch_path(spark, "variants")
    variants.with_variants(bronze, variants.LIST_JSON).write.parquet(path)
    flat = variants.flatten_vacancies(spark.read.parquet(path))
    assert rows(flat, "vacancy_id", "employer_id", "salary_from", "salary_currency") == [(1, 7, Decimal("1.50"), "KZT"), (4, 8, None, None)]
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert "parse_json" not in plan and "from_json" not in plan


def test_columns_are_discovered_from_the_data(spark):
    from vetline.plans import variants

    texts = ['{"a":1,"b":"x"}', '{"a":2.5,"c":{"d":1}}', '{"b":7,"e f":true}', None, "[1]", '{"a":null}', "{broken"]
    table = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", F.try_parse_json("t").alias("v"))
    objects = table.filter("schema_of_variant(v) LIKE 'OBJECT%'")
    got = variants.discovered_columns(objects, "v", ["i"])
    assert set(got.columns) == {"i", "a", "b", "c", "e f"}
    assert rows(got.select("i", F.col("a").cast("double"), "b", "c", "`e f`")) == sorted(
        [(0, 1.0, "x", None, None), (1, 2.5, None, '{"d":1}', None), (2, None, "7", None, True), (5, None, None, None, None)], key=repr
    )
    assert variants.discovered_columns(objects.filter("false"), "v", ["i"]).columns == ["i"]


def test_bitmaps_merge_and_count_like_ids(spark):
    from vetline import operators as op

    expected = spark.createDataFrame([("d1", str(i)) for i in [*range(0, 100_000, 7), 5, 5]] + [("d1", None), ("d1", "x"), ("d2", "1")], "day string, id string")
    loaded = [spark.createDataFrame([("d1", str(i)) for i in part], "day string, id string") for part in (range(0, 50_000, 14), range(40_000, 100_001, 2))]
    merged = op.merge_bitmaps(op.id_bitmaps(loaded[0], "id", ["day"]).union(op.id_bitmaps(loaded[1], "id", ["day"])), ["day"])
    want, held = {*range(0, 100_000, 7), 5}, {*range(0, 50_000, 14), *range(40_000, 100_001, 2)}
    got = rows(op.bitmap_coverage(op.id_bitmaps(expected, "id", ["day"]), merged, ["day"]))
    assert got == [("d1", len(want), len(held), len(want - held)), ("d2", 1, 0, 1)]
    # one row per bucket and day in the shuffle, not one per id
    assert merged.count() <= 100_000 // 32_768 + 2
    assert op.bitmap_coverage(merged.filter("false"), merged.filter("false"), ["day"]).count() == 0


def test_a_load_stops_at_a_missing_value_before_it_is_read(spark):
    from vetline.operators.quality import QualityError, store_checked, store_observed

    table = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "id int, name string")
    stored, nulls = store_observed(table, "t", ["id", "name"])
    assert nulls == {"id": 1, "name": 1} and stored.count() == 3
    with pytest.raises(QualityError, match="id"):
        store_checked(table, "t", ["id"])
    assert store_checked(table.filter("id IS NOT NULL"), "t", ["id"]).count() == 2
    assert store_observed(table.filter("false"), "t", ["id"])[1] == {"id": 0}


def test_the_manifest_grows_as_files_land(spark, tmp_path):
    import os
    import shutil

    from vetline.streaming.manifest import manifest_store, stream_manifest

    landing, at = tmp_path / "vacancies_list", iter(range(1_700_000_000, 1_800_000_000, 60))

    def land(day, name, records):
        folder = landing / "load_type=daily" / f"dt={day}"
        folder.mkdir(parents=True, exist_ok=True)
        path = folder / name
        path.write_text("\n".join([json.dumps(r) for r in records] + ["{broken"]))
        stamp = next(at)
        os.utime(path, (stamp, stamp))

    def take(store, checkpoint, files=1000):
        stream_manifest(spark, str(landing), store, str(tmp_path / checkpoint), files_per_trigger=files)
        return rows(store.read(), "vacancy_id", "dt", "search_profile")

    item = lambda i, profile: {"id": i, "search_profile": profile}
    store = manifest_store(spark, str(tmp_path / "manifest"), buckets=2)
    land("2026-01-04", "b.jsonl", [item("1", "first"), item("1", "twice"), item("2", "x"), {"search_profile": "no id"}, item("", "empty")])
    assert take(store, "one") == [("1", D(2026, 1, 4), "first"), ("2", D(2026, 1, 4), "x")]
    land("2026-01-04", "a.jsonl", [item("1", "later file"), item("3", "y")])
    land("2026-01-05", "a.jsonl", [item("1", "next day")])
    want = [("1", D(2026, 1, 4), "first"), ("1", D(2026, 1, 5), "next day"), ("2", D(2026, 1, 4), "x"), ("3", D(2026, 1, 4), "y")]
    assert take(store, "one") == want
    assert take(store, "one") == want  # nothing new
    # from the start, file by file, and replayed over a store that has all of it: the same
    assert take(manifest_store(spark, str(tmp_path / "again"), buckets=2), "two", files=1) == want
    assert take(store, "three", files=1) == want
    # a failure between the store and the end of the batch: its commit is missing, the batch runs again
    shutil.rmtree(tmp_path / "one" / "commits")
    assert take(store, "one") == want
