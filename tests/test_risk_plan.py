from pyspark.sql import functions as F

from vetline.plans.risk import join_text, risk_signals


def test_texts_join_last_and_are_not_sorted(spark):
    vacancies = spark.range(3).select(
        F.col("id").alias("vacancy_id"), F.lit("2024-01-01").cast("date").alias("load_dt"), F.col("id").alias("employer_id"), F.lit("a").alias("area_name"), F.lit("t").alias("title"),
        F.lit("p").alias("published_at"), F.lit(False).alias("archived"), F.lit(1).alias("salary_from"), F.lit(1).alias("salary_to"), F.lit("c").alias("expected_risk_category"),
    )
    text = spark.createDataFrame([(0, "x" * 300), (1, "short")], "vacancy_id long, description_text string").withColumn("load_dt", F.lit("2024-01-01").cast("date"))
    employers = spark.createDataFrame([(0, "e")], "employer_id long, name string")
    plan = join_text(vacancies, text)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BuildLeft" in plan
    signals = risk_signals(vacancies, text, employers)
    tree = signals._jdf.queryExecution().optimizedPlan().toString()
    # the outermost join is that of the texts
    assert "vacancy_id" in next(line for line in tree.splitlines() if "Join" in line)
    got = {(r.vacancy_id, r.employer_name, r.description_text and len(r.description_text), r.risk_signal_vague_job_description) for r in signals.collect()}
    assert got == {(0, "e", 300, 0), (1, None, 5, 1), (2, None, None, 1)}
