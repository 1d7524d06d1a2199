import pytest
from pyspark.sql import functions as F

from reviewloom.functions import formats, paths, text


def one(spark, value, column, type_="string"):
    frame = spark.createDataFrame([(value,)], f"v {type_}")
    return frame.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("Não abre às vezes.", "NAO ABRE AS VEZES."),
        ("ÄÇÈÉÊÍÑÓÖÜäçèéêíñóöü", "ACEEEINOOUACEEEINOOU"),
        ("Straße", "STRASSE"),
        ("æ ø œ đ ł", "AE O OE D L"),
        ("é", "E"),
        ("nº 1ª", "NO 1A"),
        ("bom 👍🏽 ❤️ fim", "BOM   FIM"),
        ("“é” – ‘ok’…", "\"E\" - 'OK'..."),
        ("«10 €» — 5°\u00a0• d´água", "<<10 EUR>> -- 5DEG * D'AGUA"),
        ("⭐⭐ bom", " BOM"),
        ("½ ĳ ﬁm ™", "1/2 IJ FIM TM"),
        ("ok Привет да Ωmega", "OK   MEGA"),
        ("own \ue000\ue058 é ½\ufb03", "OWN  E 1/2FFI"),
        ("e\u0301", "E"),
        ("plain", "PLAIN"),
        ("", ""),
        (None, None),
    ],
)
def test_shout(spark, given, expected):
    assert one(spark, given, text.shout(F.col("v"))) == expected


@pytest.mark.parametrize(
    "given, expected",
    [
        ("4", 4),
        (" 3 ", 3),
        ("\t4\n", 4),
        ("4.7", 4),
        (".5", 0),
        ("-2.", -2),
        ("+1", 1),
        ("1e3", None),
        ("x", None),
        ("", None),
        (".", None),
        ("99999999999", None),
        (None, None),
    ],
)
def test_whole_number(spark, given, expected):
    assert one(spark, given, text.whole_number(F.col("v"))) == expected


@pytest.mark.parametrize(
    "path, app, segment",
    [
        ("/lake/appleStore/bank-br_pf/odate=20240130/a.parquet", "bank-br_pf", "pf"),
        ("/lake/appleStore/my_app_pj/odate=20240130/a.parquet", "my_app_pj", "pj"),
        ("/lake/appleStore/bank_fp/odate=20240130/a.parquet", "bank_fp", ""),
        ("/lake/appleStore/bank/odate=20240130/a.parquet", "bank", ""),
        ("/lake/other/x/a.parquet", "", ""),
    ],
)
def test_path_attributes(spark, path, app, segment):
    assert one(spark, path, paths.app_of(F.col("v"))) == app
    assert one(spark, path, paths.segment_of(F.col("v"))) == segment


def test_percent_guards_against_nothing(spark):
    frame = spark.createDataFrame([(1, 4), (0, 0)], "a bigint, b bigint")
    shares = [r[0] for r in frame.select(formats.percent_of(F.col("a"), F.col("b"))).collect()]
    assert shares == [25.0, 0.0]


@pytest.mark.parametrize("names, label", [(["pf", "pj"], "PF,PJ"), ([], "NA")])
def test_label(spark, names, label):
    assert one(spark, names, formats.label_of(F.col("v")), "array<string>") == label


@pytest.mark.parametrize(
    "line, pair",
    [
        ("numStages => 3", ("numStages", "3")),
        ("\tparallelism = 8 ", ("parallelism", "8")),
        ("elapsedTime => 1234 (1 s)", ("elapsedTime", "1234 (1 s)")),
        ("Scheduling mode = FIFO", None),
        ("a => b = c", None),
        ("no pair", None),
        ("   ", None),
        (None, None),
    ],
)
def test_report_pair(spark, line, pair):
    found = one(spark, line, formats.report_pair(F.col("v")))
    assert (tuple(found) if found else None) == pair


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_times_are_utc_in_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moment = F.timestamp_millis(F.lit(1706608891250))
        assert one(spark, "", formats.to_seconds_text(moment)) == "2024-01-30 10:01:31"
        assert one(spark, "", formats.to_millis_text(moment)) == "2024-01-30T10:01:31.250Z"
        later = F.timestamp_millis(F.lit(1706608891250 + 90_000))
        assert one(spark, "", formats.minutes_between(moment, later)) == "1.50 min"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
