from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from eavcube.functions import dates as D
from eavcube.functions import keys as K
from eavcube.functions import numbers as N
from eavcube.functions import text as X


def apply(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_text_is_folded_trimmed_and_labelled(spark):
    got = apply(spark, ["  ÁRBOL Ñandú ", "Selva", None], "string", X.normalise_text)
    assert got == ["arbol nandu", "selva", "no especificado"]


def test_whitespace_removal(spark):
    assert apply(spark, [" 15-\t01 \n2", None], "string", X.strip_whitespace) == ["15-012", None]
    assert apply(spark, ["\t a b \n"], "string", X.trim_whitespace) == ["a b"]


def test_text_tests(spark):
    values = [" a", "á", "Ab", "ab"]
    assert apply(spark, values, "string", X.is_untrimmed) == [True, False, False, False]
    assert apply(spark, values, "string", X.has_accents) == [False, True, False, False]
    assert apply(spark, values, "string", X.is_mixed_case) == [False, False, True, False]


def test_size_midpoint_ignores_case_and_accepts_the_padded_label(spark):
    values = ["0 a 5 Hectáreas", "06 a 10", "mayor a 100", "otra", None]
    assert apply(spark, values, "string", X.size_midpoint) == [2.5, 8.0, 150.0, None, None]
    assert apply(spark, ["06 a 10"], "string", X.repair_size_label) == ["6 a 10"]


def test_keyword_weight_takes_the_first_keyword(spark):
    weights = {"bosque": 0.9, "selva": 0.95}
    got = apply(spark, ["Bosque de pino", "SELVA", "otro"], "string", lambda c: X.keyword_weight(c, weights, 0.5))
    assert got == [0.9, 0.95, 0.5]


def test_key_repair_and_swap(spark):
    assert apply(spark, ["1215", "15102", "915", None], "string", K.repair_short_key) == [
        "15012", "15102", "15009", None,
    ]
    assert apply(spark, ["10215", "15102", "15015", "1215"], "string", K.swap_inverted_key) == [
        "15102", "15102", "15015", "1215",
    ]


def test_zero_fill_never_truncates(spark):
    assert apply(spark, [" 9", "150021", "15001"], "string", K.zero_fill) == ["00009", "150021", "15001"]


def test_dates_in_two_formats(spark):
    day = dt.date(2025, 3, 2)
    got = apply(spark, ["2025-03-02 00:00:00", "02/03/2025", " 2/3/2025 ", "pronto", "", None], "string", D.parse_date)
    assert got == [day, day, day, None, None, None]


def test_clock_and_duration(spark):
    assert apply(spark, ["12:30", "0:00:05", "24:10", "x", "12:60"], "string", D.clock_seconds) == [
        45000, 5, None, None, None,
    ]
    got = apply(spark, ["36:10:00", "2:05", "3 days", "1 day", "-", None], "string", D.duration_seconds)
    assert got == [130200, 7500, 259200, 86400, None, None]


def test_seasons_months_and_weekends(spark):
    days = [dt.date(2024, m, 1) for m in (12, 2, 3, 8, 11)]
    assert apply(spark, days, "date", D.season_number) == [1, 1, 2, 3, 4]
    assert apply(spark, days, "date", D.season_name)[-1] == "Otoño"
    assert apply(spark, days, "date", D.month_name)[0] == "Diciembre"
    assert apply(spark, [dt.date(2024, 6, 1), dt.date(2024, 6, 3)], "date", D.is_weekend) == [True, False]


def test_numbers_from_text(spark):
    assert apply(spark, ["19,35", " -99.2 ", "nan", "x", "", "12d", "1.f", None], "string", N.to_number) == [
        19.35, -99.2, None, None, None, None, None, None,
    ]
    assert apply(spark, ["3.7", "2", "x"], "string", N.to_integer) == [4, 2, None]


def test_measures(spark):
    assert apply(spark, [-1.0, 2.0, None], "double", N.clamp_negative) == [0.0, 2.0, None]
    assert apply(spark, [-999.0, 2.0], "double", N.sentinel_to_null) == [None, 2.0]
    assert apply(spark, [1.0, 5.0, None], "double", lambda c: N.outside(c, 2, 6)) == [True, False, None]


def test_row_sums_means_and_differences(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None)], "a double, b double, c double")
    got = df.select(N.row_sum(["a", "b", "c"]), N.row_mean(["a", "b", "c"])).collect()
    assert [tuple(r) for r in got] == [(4.0, 2.0), (0.0, None)]
    pairs = spark.createDataFrame([(3.0, 1.0), (0.0, 0.0), (-1.0, 2.0)], "a double, b double")
    got = pairs.select(N.normalised_difference(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [0.5, None, None]
