import pytest
from pyspark.sql import functions as F

from coursetrail.functions import predicates as P
from coursetrail.sources.sanitize import sanitize


def evaluate(spark, expression, **values):
    columns = ", ".join(f"CAST({'NULL' if v is None else repr(v)} AS {'string' if isinstance(v, str) else 'int'}) AS {k}"
                        for k, v in values.items())
    return spark.sql(f"SELECT {columns}").select(expression).first()[0]


@pytest.mark.parametrize("year, duration, allowed", [
    (1, 1, True), (2, 1, False), (1, 2, True), (2, 2, True), (3, 2, False), (None, 1, True), (0, 1, True), (3, None, True)])
def test_year(spark, year, duration, allowed):
    assert evaluate(spark, P.year_allows(F.col("y"), F.col("d")), y=year, d=duration) is allowed


@pytest.mark.parametrize("path, flag, allowed", [
    ("non_ple", 0, True), ("non_ple", 1, False), ("non_ple", 2, True), ("ple", 0, False), ("ple", 1, True),
    ("ple", 2, True), ("staff", 0, True), ("staff", 1, True), ("staff", 2, True), ("staff", None, False), ("ple", 3, False)])
def test_platform(spark, path, flag, allowed):
    got = evaluate(spark, F.coalesce(P.platform_allows(F.col("p"), F.col("f")), F.lit(False)), p=path, f=flag)
    assert got is allowed


@pytest.mark.parametrize("kind, mt, student, facilitator, master, sees", [
    (1, None, 0, 0, 0, True), (2, None, 1, 1, 0, True), (2, 0, 1, 0, 1, False), (2, 1, 0, 1, 0, False), (2, 1, 0, 0, 1, True),
    (3, None, 1, 0, 0, True), (4, None, 0, 1, 1, False), (3, 1, None, 1, 1, False), (2, None, 1, None, 1, False)])
def test_access(spark, kind, mt, student, facilitator, master, sees):
    role = P.access_role(F.col("k"), F.col("mt"))
    got = evaluate(spark, P.role_sees(role, F.col("s"), F.col("f"), F.col("m")),
                   k=kind, mt=mt, s=student, f=facilitator, m=master)
    assert got is sees


@pytest.mark.parametrize("flags, kind", [
    ((1, 0, 0), "student"), ((1, 1, 1), "student"), ((0, 1, 1), "facilitator"), ((0, 0, 1), "master"), ((0, 0, 0), None),
    ((None, None, 1), "master")])
def test_toolkit(spark, flags, kind):
    got = evaluate(spark, P.toolkit_type(F.col("a"), F.col("b"), F.col("c")), a=flags[0], b=flags[1], c=flags[2])
    assert got == kind


@pytest.mark.parametrize("kind, excluded", [
    ("pdf", True), (" PDF ", True), ("MP4\t", True), ("Pdf Web", True), ("\npdf", True), ("pdfx", False), (None, False), ("", False)])
def test_excluded_type(spark, kind, excluded):
    frame = spark.createDataFrame([(kind,)], "t string")
    assert frame.select(P.is_excluded_type(F.col("t"))).first()[0] is excluded


@pytest.mark.parametrize("flag, name, expected", [
    (1, "x", 1), (0, "Final Assessment 2", 1), (0, "x", 0), (None, None, 0), (None, "ASSESSMENT", 1)])
def test_assessment(spark, flag, name, expected):
    frame = spark.createDataFrame([(flag, name)], "f int, n string")
    assert frame.select(P.assessment_flag(F.col("f"), F.col("n"))).first()[0] == expected


@pytest.mark.parametrize("kind, ple, path", [(1, 1, "staff"), (2, None, "staff"), (3, 1, "ple"), (4, None, "non_ple"),
                                             (3, 0, "non_ple"), (3, 2, "non_ple")])
def test_path(spark, kind, ple, path):
    assert evaluate(spark, P.allocation_path(F.col("k"), F.col("p")), k=kind, p=ple) == path


@pytest.mark.parametrize("value", [2.675, 0.125, 0.375, 1.005, 33.335, 66.665, 100 / 3, 200 / 3, 12.5])
def test_rounding_is_that_of_numpy(spark, value):
    import numpy as np
    frame = spark.createDataFrame([(value,)], "v double")
    assert frame.select(P.round_half_even(F.col("v"), 2)).first()[0] == float(np.round(value, 2))


def test_sanitize(spark):
    raw = spark.sql("""SELECT * FROM VALUES ('0000-00-00 00:00:00', '7', 1.50BD), ('2024-02-30 00:00:00', 'x', NULL),
        ('2024-02-29 10:00:00', NULL, 2.25BD), ('0001-01-01 00:00:00', '1.5', 0.00BD) AS v(at, n, money)""")
    clean = sanitize(raw, {"at": "timestamp_ntz", "n": "double"})
    assert [f.dataType.simpleString() for f in clean.schema] == ["timestamp_ntz", "double", "double"]
    got = [(str(r["at"]) if r["at"] else None, r["n"], r["money"]) for r in clean.collect()]
    assert got == [(None, 7.0, 1.5), (None, None, None), ("2024-02-29 10:00:00", None, 2.25), (None, 1.5, 0.0)]


def test_year_one_in_a_timestamp_column(spark):
    raw = spark.sql("SELECT TIMESTAMP_NTZ '0001-01-01 00:00:00' AS at")
    assert sanitize(raw, {"at": "timestamp_ntz"}, clean_times=True).first()["at"] is None
