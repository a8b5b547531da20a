import pytest
from pyspark.sql import functions as F

from tests.helpers import points, spans, tag
from trendloom.functions.encoding import encode_name
from trendloom.functions.keys import flat_tags, key_metric, key_tags, trend_key
from trendloom.functions.spans import is_error
from trendloom.operators.enrich import add_tags
from trendloom.operators.filters import valid_points, valid_spans
from trendloom.operators.points import DEFAULT_TRANSFORMERS, PointSpec, to_points
from trendloom.operators.rules import classify
from trendloom.options import HistogramOptions, TrendOptions, encoder_name, parse_tags
from trendloom.sources.readers import start_position

ERROR_CASES = [
    ([tag("error", "BOOL", v_bool=False)], False),
    ([tag("error", "BOOL", v_bool=True)], True),
    ([tag("error", None, v_str="true")], True),
    ([tag("error", None, v_str="500")], True),
    ([tag("error", "LONG", v_long=100)], True),
    ([], False),
    (None, False),
    ([tag("ERROR", "BOOL", v_bool=True)], True),
    ([tag("error", "STRING", v_str="False")], False),
    ([tag("error", "STRING", v_str="")], True),
    ([tag("error", None, v_bool=False)], True),
    ([tag("error", "BOOL", v_bool=False), tag("error", "BOOL", v_bool=True)], False),
    ([tag("other", "BOOL", v_bool=True), tag("Error", "STRING", v_str="x")], True),
]


def test_error_tag(spark):
    df = spans(spark, [{"tags": t} for t, _ in ERROR_CASES])
    got = [r.e for r in df.orderBy("arrival").select(is_error().alias("e")).collect()]
    assert got == [e for _, e in ERROR_CASES]


@pytest.mark.parametrize("service_level,count", [(True, 4), (False, 2)])
def test_points_of_a_span(spark, service_level, count):
    df = spans(spark, [{"service_name": "my.service", "operation_name": "my.op"}])
    rows = to_points(df, TrendOptions(service_level=service_level)).collect()
    assert len(rows) == count
    assert {r.ts_sec for r in rows} == {1_529_042_838}
    assert sorted({r.metric for r in rows}) == ["duration", "success-span"]
    assert all(r.tags["serviceName"] == "my___service" for r in rows)
    assert sum("operationName" in r.tags for r in rows) == 2
    duration = next(r for r in rows if r.metric == "duration")
    assert duration.value == 1000.0
    assert duration.tags["unit"] == "microseconds" and duration.tags["mtype"] == "gauge"


def test_eight_spans_make_thirty_two_points(spark):
    df = spans(spark, [{"duration_us": 3, "tags": [tag("error", "STRING", v_str="some-error")]}] * 8)
    rows = to_points(valid_spans(df)).collect()
    assert len(rows) == 32
    assert sum(r.metric == "failure-span" for r in rows) == 16


def test_key_of_known_tags_is_the_general_key(spark):
    df = spans(spark, [{"service_name": "a=b,c%", "operation_name": "x%2Cy"}])
    rows = to_points(df, TrendOptions(encoder="noop")).withColumn("general", trend_key(F.col("metric"), F.col("tags")))
    rows = rows.withColumn("m", key_metric(F.col("trend_key")))
    rows = rows.withColumn("t", flat_tags(key_tags(F.col("trend_key")))).withColumn("t0", flat_tags(F.col("tags")))
    for r in rows.collect():
        assert r.trend_key == r.general
        assert r.m == r.metric
        assert r.t == r.t0


@pytest.mark.parametrize(
    "service,operation,deny,valid",
    [
        ("testService", "testSpan", (), True),
        ("", "", (), False),
        (None, "x", (), False),
        ("x", None, (), False),
        ("testService", "testSpan", ("testService",), False),
        ("testservice", "testSpan", ("^[a-z]*$",), False),
        ("testService", "testSpan", ("^[a-z]*",), False),
        ("testService", "testSpan", ("^[a-z]*$",), True),
        ("testService", "testSpan", ("nothing", "Serv"), False),
    ],
)
def test_valid_spans(spark, service, operation, deny, valid):
    df = spans(spark, [{"service_name": service, "operation_name": operation}])
    assert valid_spans(df, deny).count() == int(valid)


def test_encoders(spark):
    long_name = "service." * 30
    row = spark.createDataFrame([("a.b", long_name)], "a string, b string").select(
        encode_name(F.col("a"), "periodreplacement").alias("p"),
        encode_name(F.col("a"), "base64").alias("b"),
        encode_name(F.col("b"), "base64").alias("l"),
        encode_name(F.col("a"), "noop").alias("n"),
    ).first()
    assert (row.p, row.b, row.n) == ("a___b", "YS5i", "a.b")
    assert "\n" not in row.l and "\r" not in row.l
    with pytest.raises(ValueError):
        encoder_name("rot13")


def test_rules_and_precedence(spark):
    cases = [
        ("success-span", "gauge", "Count"),
        ("Failure-Span", "GAUGE", "Count"),
        ("duration", "gauge", "Histogram"),
        ("p99-latency", "gauge", "Histogram"),
        ("success-span-duration", "gauge", "Count"),
        ("duration", "count", None),
        ("invalid-metric", "gauge", None),
    ]
    df = spark.createDataFrame([(m, {"mtype": t}) for m, t, _ in cases], "metric string, tags map<string,string>")
    assert [r.agg_type for r in classify(df).collect()] == [c[2] for c in cases]
    untyped = spark.createDataFrame([("duration", {"unit": "x"})], "metric string, tags map<string,string>")
    assert classify(untyped).first().agg_type is None


def test_invalid_points(spark):
    df = points(spark, "duration", [(-1, 1), (0, 1), (float("nan"), 1), (2, 1)])
    assert [r.value for r in valid_points(df).collect()] == [2.0]
    assert valid_points(df.withColumn("trend_key", F.lit(None).cast("string"))).count() == 0


def test_extra_tags(spark):
    df = points(spark, "duration", [(1, 1)], {"product": "p", "mtype": "gauge"}).withColumnRenamed("trend_key", "out_key")
    assert add_tags(df, {}).collect() == df.collect()
    row = add_tags(df, {"k1": "v1", "product": "won"}).first()
    assert row.tags == {"product": "won", "mtype": "gauge", "k1": "v1"}
    assert row.out_key == "duration,k1=v1,mtype=gauge,product=won"


def test_own_transformer(spark):
    def slow_point():
        return PointSpec(
            F.lit("slow-latency"), F.col("duration_us") * 2, "microseconds",
            tags={"trace": F.col("trace_id")}, when=F.col("duration_us") > 500,
        )

    opts = TrendOptions(transformers=(*DEFAULT_TRANSFORMERS, slow_point))
    df = spans(spark, [{"duration_us": 400}, {"duration_us": 600}])
    own = to_points(df, opts).where(F.col("metric") == "slow-latency").collect()
    assert len(own) == 2 and {r.value for r in own} == {1200.0} and {r.tags["trace"] for r in own} == {"1"}


def test_options():
    assert parse_tags('{"k": "v", "n": 1, "b": true, "o": {"p": "q"}}') == {"k": "v", "n": "1", "b": "true", "o.p": "q"}
    assert parse_tags("") == {} and parse_tags(None) == {}
    assert HistogramOptions(unit="MILLIS").unit_us == 1000
    assert HistogramOptions(unit=None).unit == "micros"
    assert start_position("Earliest") == "earliest"
    for wrong in (lambda: HistogramOptions(unit="hours"), lambda: start_position("middle"), lambda: TrendOptions(emit="x")):
        with pytest.raises(ValueError):
            wrong()


def test_a_key_is_taken_apart_once(spark):
    keys = spark.createDataFrame([("m,a=1,b=2,a=3",), ("m,a=1%2C2,b=%253D",), ("m",)], "k string")
    read = keys.select(key_tags(F.col("k")).alias("t"))
    assert [r["t"] for r in read.collect()] == [{"a": "1", "b": "2"}, {"a": "1,2", "b": "%3D"}, {}]
    assert read._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
