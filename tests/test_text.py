import unicodedata

import pytest
from pyspark.sql import functions as F

from placeloom.functions import fixed, text


def ask(spark, column, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", column(F.col("v")).alias("x")).orderBy("i").collect()]


def test_tables_are_whole():
    assert len(fixed.lines(fixed.TAXONOMY)) == 36 and len(fixed.inverted(fixed.PLACE_CATEGORIES)) == 67 and len(fixed.inverted(fixed.TAG_CATEGORIES)) == 28 and len(fixed.SHARED_HOSTS) == 20


def test_names(spark):
    assert ask(spark, text.name_norm, ["Кофейня «Әлем»", "Ёлка", None, "STRASSE ẞ", "a_b"]) == ["kofeinya alem", "elka", "", "strasse ss", "a b"]
    cores = ['ТОО "Coffee Boom" №12', "Аптека Европа филиал", "Starbucks #1234", "Аптека", "Старбакс", None, ""]
    assert ask(spark, text.core_name, cores) == ["boom", "evropa", "starbucks", "apteka", "starbaks", "", ""]


def test_phones(spark):
    kz = ["+7 701 111 22 33", "8 701 111 22 33", "7011112233", "87011112233", "8 (727) 250-00-00", "call us", "123", None, "00 7 701 1112233"]
    assert ask(spark, lambda c: text.normalize_phone(c, "KZ"), kz) == ["+77011112233"] * 4 + ["+77272500000", None, None, None, "+77011112233"]
    for country, raw, want in (("DE", "030 1234567", "+49301234567"), ("US", "(212) 555-0100", "+12125550100"), ("AE", "04 123 4567", "+97141234567"), ("XX", "123456789", None)):
        assert ask(spark, lambda c, country=country: text.normalize_phone(c, country), [raw]) == [want]


def test_domains(spark):
    urls = ["https://www.Example.kz/menu", "example.kz", "https://instagram.com/x", "http://m.2gis.kz/a", "not a url", None, "user@host.kz:80/x"]
    assert ask(spark, text.normalize_domain, urls) == ["example.kz", "example.kz", None, None, None, None, "host.kz"]


@pytest.mark.parametrize("a,b,want", [("martha", "marhta", 0.961), ("dixon", "dicksonx", 0.8133), ("dwayne", "duane", 0.84), ("", "x", 0.0), ("", "", 0.0), ("same", "same", 1.0), ("abcdef", "bcaxyz", 0.5)])
def test_jaro_winkler(a, b, want):
    assert text.jaro_winkler_of(a, b) == pytest.approx(want, abs=1e-3)


def test_similarity(spark):
    df = spark.createDataFrame([("coffee boom", "boom"), ("a b", "c d"), ("", "x"), (None, "x"), ("bahandi burger", "bahandy")], "a string, b string")
    got = [r.s for r in df.select(text.name_similarity(F.col("a"), F.col("b")).alias("s")).collect()]
    assert got[0] == 1.0 and got[2] == got[3] == 0.0 and 0.75 <= got[4] < 0.92


def test_uuid_matches_the_standard(spark):
    import uuid

    assert ask(spark, lambda c: text.name_uuid(str(uuid.NAMESPACE_URL), c), ["overture:x", "ü"]) == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in ("overture:x", "ü")]
    assert unicodedata.normalize("NFKC", "№") == "No"
