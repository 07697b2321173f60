"""Report texts, the log reader and stage artefacts."""

from pyspark.sql import functions as F

from corvidex.operators import reports
from corvidex.sources import artifacts


def test_quality_report_lists_faults_and_advice(spark):
    df = spark.createDataFrame([(62.5, 65.0, ["too_short", "off_topic"]), (95.0, 90.0, [])], "score double, answer double, issues array<string>")
    advice = reports.recommendations(F.col("issues"), answer=F.col("answer"))
    low, high = [r[0] for r in df.select(reports.quality_report(F.col("score"), {"answer": F.col("answer")}, F.col("issues"), advice)).collect()]
    assert low.startswith("score: 62.5/100\nlevel: acceptable\npassed: yes\n  - answer: 65.0/100\nissues: 2\n  - too_short\n  - off_topic\n")
    assert low.endswith(f"  1. {reports.ADVICE['too_short']}\n  2. {reports.ADVICE['off_topic']}\n  3. {reports.LOW['answer']}\n")
    assert high == "score: 95.0/100\nlevel: excellent\npassed: yes\n  - answer: 90.0/100\nissues: 0\n"


def test_null_scores_give_no_advice(spark):
    df = spark.createDataFrame([(None, ["unknown"])], "answer double, issues array<string>")
    assert df.select(reports.recommendations(F.col("issues"), answer=F.col("answer"))).first()[0] == []


def test_sampling_statistics_of_an_empty_sample(spark):
    row = reports.sampling_statistics(spark.createDataFrame([], "text string, source string")).first()
    assert (row["total"], row["sources"], row["short"], row["per_source"]) == (0, 0, 0, None)


def test_sampling_statistics_counts_nulls_as_unknown_and_short(spark):
    row = reports.sampling_statistics(spark.createDataFrame([(None, None), ("x" * 500, "a"), ("x" * 1500, "a")], "text string, source string")).first()
    assert (row["total"], row["sources"], row["short"], row["medium"], row["long"], row["per_source"]) == (3, 2, 1, 1, 1, 1.5)


def test_log_lines_belong_to_the_last_stage(spark):
    lines = ["t | INFO | m | before any", "== stage one ==", "t | INFO | m | first", "t | WARN | m | no", "t | INFO | m | ====", "t | INFO | m | stage two", "t | DEBUG | m | last", "INFO | short"]
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file string, line_no int, value string")
    got = reports.log_stages(df, ["stage one", "stage two"]).orderBy("line_no").collect()
    assert [(r["stage"], r["content"]) for r in got] == [("stage one", "first"), ("stage two", "stage two"), ("stage two", "last")]


def test_artefacts_come_back_in_stage_order(spark, tmp_path):
    artifacts.save(spark.createDataFrame([(1, "a")], "n int, t string"), str(tmp_path), "answer")
    artifacts.save(spark.createDataFrame([(2, "b")], "n int, t string"), str(tmp_path), "text")
    assert artifacts.saved(spark, str(tmp_path)) == ["text", "answer"]
    assert artifacts.view(spark, str(tmp_path), "text").first()["t"] == "b"
