import os

import pytest

from vetline.catalog import QUERIES
from vetline.catalog.registry import Data
from vetline.operators.referred import Referred, join_referred
from vetline.plans.risk import join_text
from vetline.plans.vacancies import silver_text

FOLDER = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def _rows(df) -> list:
    return sorted(map(repr, (tuple(r[name] for name in sorted(df.columns)) for r in df.collect())))


def _exchanges_of(plan, names: set) -> int:
    held = {plan.output().apply(i).name() for i in range(plan.output().size())}
    here = plan.nodeName() == "Exchange" and bool(held & names)
    return here + sum(_exchanges_of(plan.children().apply(i), names) for i in range(plan.children().size()))


@given
@pytest.mark.parametrize("name", ["join_vacancy_text", "risk_signals"])
def test_a_text_is_shuffled_once_however_many_vacancies_have_it(spark, name):
    held = {key: spark.conf.get(key) for key in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan()
        assert _exchanges_of(plan, {"text", "description", "description_text"}) == 1
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)


@given
def test_parts_of_the_text_records_give_the_records(spark):
    t = Data(spark, FOLDER)
    whole = t.referred_text().whole()
    assert whole.count() > 0
    assert _rows(whole) == _rows(t["text_bronze"])


def test_joined_parts_equal_the_joined_whole(spark):
    vacancies = spark.createDataFrame([(i % 9, f"d{i % 2}", i) for i in range(20)] + [(None, "d0", 20), (3, None, 21)], "vacancy_id int, load_dt string, n int")
    # rows without a body, without a reference, and several of one vacancy; bodies without a row, and several of one reference
    rows = [(0, "d0", 1), (0, "d0", 99), (1, "d1", 99), (2, "d0", None), (3, "d1", 1), (3, "d1", 2), (4, "d0", 2), (None, "d0", 1), (5, "d0", 2), (5, "d1", 2)]
    bodies = [(1, "<b>one</b>"), (2, "two"), (2, "<i>two</i> again"), (3, "nobody's"), (None, "lost"), (1, None)]
    text = Referred(spark.createDataFrame(rows, "id int, load_dt string, ref int"), spark.createDataFrame(bodies, "ref int, description string"), "ref")
    assert _rows(join_referred(vacancies.withColumnRenamed("vacancy_id", "id"), text, ["id", "load_dt"])) == _rows(vacancies.withColumnRenamed("vacancy_id", "id").join(text.whole(), ["id", "load_dt"], "left"))
    parts, whole = join_text(vacancies, silver_text(text)), join_text(vacancies, silver_text(text.whole()))
    assert parts.columns == whole.columns
    assert _rows(parts) == _rows(whole)
