"""A payload is parsed once, whatever is asked of its fields; the rows stay those of the plain parser."""

import pytest
from pyspark.sql import functions as F

from changeledger.functions import cdc
from changeledger.schemas import ENVELOPE, FULL_DOCUMENT

PAYLOADS = ['{"operationType":"update","fullDocument":{"_id":"a","order_id":"o","amount":1.5},"documentKey":{"_id":"a"}}', '{"operationType":"delete","documentKey":{"_id":"a"}}',
            '{"operationType":"update","fullDocument":{"order_id":"o","amount":"x"},"documentKey":{"_id":"a"}}', "{bad", "", "null", "[]", None, '{"_id":"a","order_id":"o","amount":2}', '{"amount":[]}']


def records(spark):
    return spark.createDataFrame(list(enumerate(PAYLOADS)), "seq long, value string")


def parsers(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json(")


@pytest.mark.parametrize("parse", [cdc.parse_envelope, cdc.parse_full_documents])
def test_one_parser_in_the_plan(spark, parse):
    made = spark.range(10).select(F.col("id").alias("seq"), F.to_json(F.struct(F.lit("x").alias("operationType"), F.col("id").cast("string").alias("_id"))).alias("value"))
    projected = cdc.cdc_project(parse(made))
    for df in (cdc.dead_letters(projected).select("seq", "reason"), cdc.good_changes(projected), projected):
        assert parsers(df) == 1


def test_same_rows_as_the_plain_parser(spark):
    df = records(spark)
    plain = df.select("seq", F.col("value").alias("_payload"), cdc.read_json(F.col("value"), ENVELOPE).alias("e")).select("seq", "_payload", "e.*")
    got = cdc.parse_envelope(df)
    assert got.schema.simpleString() == plain.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    doc = cdc.read_json(F.col("value"), FULL_DOCUMENT)
    plain = df.select("seq", F.when(doc.isNotNull(), F.lit("update")).alias("op"), doc.alias("doc"))
    got = cdc.parse_full_documents(df).select("seq", F.col("operationType").alias("op"), F.col("fullDocument").alias("doc"))
    assert got.schema.simpleString() == plain.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
