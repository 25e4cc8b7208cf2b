from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewake.functions import times
from tradewake.functions.codes import code_label, code_table
from tradewake.functions.text import camel_columns, camel_name, in_comma_list, is_blank, joined_key, words
from tradewake.schemas import TRANSIENT, drop_transient
from tradewake.session import sizing
from tradewake.sources import jdbc
from tradewake.sources.topics import KafkaTopics


def one(spark, *columns):
    return spark.range(1).select(*columns).collect()[0][:]


def test_times(spark):
    text = F.lit("2021-06-18 11:09:00")
    assert one(spark, times.text_millis(text)) == (1623985740000,)
    assert one(spark, times.day_millis(text)) == (1623974400000,)
    assert one(spark, times.day_millis(F.lit("soon")), times.text_millis(F.lit("x"))) == (None, None)
    assert one(spark, times.day_key(F.lit(1623985740000))) == ("20210618",)
    assert one(spark, times.time_text(times.rowtime_seconds(F.lit(1999)))) == (
        "1970-01-01 00:00:01",)
    assert one(spark, times.processing_millis(7)) == (7,)
    assert one(spark, times.processing_millis())[0] % 1000 == 0


def test_zone_of_text_does_not_follow_the_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, times.text_millis(F.lit("2021-06-18 11:09:00"))) == (1623985740000,)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_age(spark):
    as_of = F.lit("2021-06-18").cast("date")
    assert one(spark, times.age_years(F.lit("2000-01-01"), as_of),
               times.age_years(F.lit("never"), as_of)) == (21, None)


def test_text(spark):
    assert one(spark, is_blank(F.lit(None)), is_blank(F.lit("")), is_blank(F.lit(" "))) == (
        True, True, False)
    assert one(spark, joined_key(F.lit("a"), F.lit("b"))) == ("a:b",)
    assert one(spark, in_comma_list(F.lit("b"), F.lit("a,b")),
               in_comma_list(F.lit("b"), F.lit("a, b"))) == (True, False)
    assert one(spark, words(F.lit("Été à l'hôtel, 2 fois!"))) == (
        ["été", "à", "l", "hôtel", "2", "fois"],)


def test_names(spark):
    assert camel_name("sink_table_name") == "sinkTableName"
    df = spark.createDataFrame([(1, 2)], "source_table int, id int")
    assert camel_columns(df).columns == ["sourceTable", "id"]


def test_codes(spark):
    assert one(spark, code_label(F.lit("1002"), "order_status"),
               code_label(F.lit("1101"), "order_status"),
               code_label(F.lit("1101"), "payment_type")) == ("paid", None, "alipay")
    table = code_table(spark)
    assert table.count() == table.select("code").distinct().count() == 38


def test_transient_columns_stay_out_of_sinks(spark):
    schema = T.StructType([T.StructField("a", T.LongType()),
                           T.StructField("ids", T.StringType(), metadata=TRANSIENT)])
    assert drop_transient(spark.createDataFrame([], schema)).columns == ["a"]


def test_connection_options():
    topics = KafkaTopics("host:1", {"kafka.security.protocol": "SSL"})
    source = topics.source_options("t", "g")
    assert source["subscribe"] == "t" and source["startingOffsets"] == "latest"
    assert source["groupIdPrefix"] == "g" and source["kafka.security.protocol"] == "SSL"
    assert topics.sink_options("t")["topic"] == "t" and "topic" not in topics.sink_options()
    assert topics.sink_options()["kafka.transaction.timeout.ms"] == "900000"
    read = jdbc.read_options("jdbc:x", "d", {"user": "u"}, ("id", 0, 9, 3))
    assert read["dbtable"] == "d" and read["numPartitions"] == "3" and read["user"] == "u"
    assert jdbc.write_options("jdbc:x", "d", batch_rows=5)["batchsize"] == "5"


def test_sizing():
    assert sizing(0, 100)["spark.sql.shuffle.partitions"] == "200"
    assert sizing(10 << 40, 8000)["spark.sql.shuffle.partitions"] == "40960"
    assert sizing(100 << 40, 8000)["spark.sql.shuffle.partitions"] == "409600"
    assert sizing(100 << 40, 8000, most=50_000)["spark.sql.shuffle.partitions"] == "50000"
