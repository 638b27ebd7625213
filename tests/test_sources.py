import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from cardsentry.operators.features import FeatureStore
from cardsentry.operators.preprocess import Preprocessor
from cardsentry.operators.scoring import Ensemble
from cardsentry.sources import files, kafka, state
from tests.test_features import sample

SMALL = T.StructType([T.StructField("trans_num", T.StringType()), T.StructField("amt", T.DoubleType())])


def full(spark, **changes):
    return sample(spark, first="f", last="l", **changes)


def test_csv_round_trip_with_stray_index_and_copies(spark, tmp_path):
    df = full(spark).withColumn("Unnamed: 0", F.lit(1)).withColumn("merch_state", F.lit("NC"))
    files.write_transactions_csv(df.unionByName(df), str(tmp_path / "t"), single_file=True)
    got = files.load_transactions(spark, str(tmp_path / "t"))
    assert "Unnamed: 0" not in got.columns and dict(got.dtypes)["merch_state"] == "string"
    assert dict(got.dtypes)["trans_date_trans_time"] == "timestamp" and dict(got.dtypes)["dob"] == "date"
    assert got.count() == 5
    assert got.select("trans_num", "amt", "dob").exceptAll(df.select("trans_num", "amt", "dob")).count() == 0


def test_the_first_copy_in_the_input_stays(spark, tmp_path):
    for i, v in enumerate((7, 9, 8)):
        files.write_transactions_csv(full(spark, city_pop=v).limit(1), str(tmp_path / "t" / f"part={i}"), single_file=True)
    assert files.load_transactions(spark, str(tmp_path / "t")).first()["city_pop"] == 7


def test_loading_refuses_missing_columns(spark, tmp_path):
    files.write_transactions_csv(full(spark).drop("state"), str(tmp_path / "t"))
    with pytest.raises(ValueError, match="state"):
        files.load_transactions(spark, str(tmp_path / "t"))


def test_json_lines_skip_blank_and_keep_broken_aside(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"trans_num": "a", "amt": 1.5}\n\n{"trans_num": "b", "am\n   \n{"trans_num": "c"}\n')
    good, bad = files.good_and_bad(files.read_jsonl(spark, str(tmp_path / "in.jsonl"), SMALL))
    assert {(r[0], r[1]) for r in good.collect()} == {("a", 1.5), ("c", None)}
    assert [r[0] for r in bad.collect()] == ['{"trans_num": "b", "am']


def test_replay_writes_nulls_and_honours_the_limit(spark, tmp_path):
    files.write_jsonl(full(spark, job=None), str(tmp_path / "r"), limit=3)
    lines = [r[0] for r in spark.read.text(str(tmp_path / "r")).collect()]
    assert len(lines) == 3 and all('"job":null' in x and '"trans_date_trans_time":"2020-06-21 12:14:25"' in x for x in lines)


def test_kafka_messages(spark):
    df = spark.createDataFrame([('{"trans_num": "a", "amt": 2}',), ("nonsense",), ("",)], "value string")
    out = kafka.parse_messages(df.select(F.col("value").cast("binary").alias("value")), SMALL).collect()
    assert [(r["trans_num"], r["amt"], r["_corrupt_record"]) for r in out] == [("a", 2.0, None), (None, None, "nonsense")]


def test_prediction_log(spark, tmp_path):
    path = str(tmp_path / "log")
    assert files.read_prediction_log(spark, path).count() == 0
    scored = spark.createDataFrame([("a", 0.5, "LOW", 1.0)], "transaction_id string, fraud_score double, risk_tier string, processing_time_ms double")
    files.append_prediction_log(files.prediction_records(scored), path)
    files.append_prediction_log(files.prediction_records(scored), path)
    for _ in range(2):  # a batch that is delivered twice
        files.append_prediction_log(files.prediction_records(scored, version="2.0.0"), path, batch=7)
    nameless = scored.withColumn("transaction_id", F.lit(""))
    files.append_prediction_log(files.prediction_records(nameless.union(nameless), version="3"), path)
    rows = files.read_prediction_log(spark, path).collect()
    assert sorted(r["model_version"] for r in rows) == ["1.0.0", "2.0.0", "3", "3"]
    assert all(r["timestamp"].endswith("+00:00") for r in rows)
    later = scored.withColumn("fraud_score", F.lit(0.9))  # scored again under a new batch id: the newest record counts
    files.append_prediction_log(files.prediction_records(later), path, batch="again")
    again = {r["model_version"]: r["fraud_score"] for r in files.read_prediction_log(spark, path).where("transaction_id = 'a'").collect()}
    assert again == {"1.0.0": 0.9, "2.0.0": 0.5}
    files.compact_prediction_log(spark, path, str(tmp_path / "merged"))
    merged = files.read_prediction_log(spark, str(tmp_path / "merged"))
    assert merged.exceptAll(files.read_prediction_log(spark, path)).count() == 0 and merged.count() == 4


@pytest.mark.parametrize("limit", [0, 1, 7, 40, 41, 60, 1000])
def test_limit_counts_valid_lines_only(spark, tmp_path, limit):
    lines = [f'{{"n": {i}}}' if i % 3 else ("" if i % 2 else '{"n": ') for i in range(90)]
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"f{k}.txt").write_text("\n".join(lines[30 * k : 30 * k + 30]) + "\n")
    schema = StructType.fromDDL("n long")
    got = files.read_jsonl(spark, str(tmp_path / "in"), schema, limit=limit, valid=F.col("n") % 4 != 1).collect()
    want = [i for i in range(90) if i % 3 and i % 4 != 1][:limit]
    assert sorted(r["n"] for r in got) == want


def test_state_round_trips(spark, tmp_path):
    df = full(spark, cc_num=[1, 1, 2, 2, 3], merchant=list("abcab"))
    store = FeatureStore.fit(df)
    state.save_feature_store(store, spark, str(tmp_path / "s"))
    again = state.load_feature_store(spark, str(tmp_path / "s"))
    assert again.transform(df).exceptAll(store.transform(df)).count() == 0
    pre = Preprocessor.fit(df)
    state.save_preprocessor(pre, spark, str(tmp_path / "p"))
    assert state.load_preprocessor(spark, str(tmp_path / "p")).transform(df).exceptAll(pre.transform(df)).count() == 0
    e = Ensemble((0.2, 0.3, 0.5), 0.44)
    state.save_ensemble(e, spark, str(tmp_path / "e"))
    assert state.load_ensemble(spark, str(tmp_path / "e")) == e
