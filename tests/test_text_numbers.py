import pytest
from pyspark.sql import functions as F

from starload.functions.numbers import parse_number, try_int
from starload.functions.text import clean_all_text, clean_text


def _python_clean(s):
    return " ".join(s.split())


def test_clean_text_matches_python_split_on_every_space(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    samples = [f"{sp}a{sp}{sp}b{sp}" for sp in spaces] + ["  x  y\t\r\nz ", "", "plain"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(clean_text("s")).collect()]
    assert got == [_python_clean(s) for s in samples]


def test_clean_all_text_is_null_safe_and_honours_exclusions(spark):
    df = spark.createDataFrame(
        [(None, " a  b ", " 007 ", 1), (" c ", None, " 08 ", 2)],
        "x string, y string, tax string, n int",
    )
    rows = clean_all_text(df, exclude=["tax"]).orderBy("n").collect()
    assert [tuple(r) for r in rows] == [(None, "a b", " 007 ", 1), ("c", None, " 08 ", 2)]


@pytest.mark.parametrize(
    "text, expected",
    [("1\u00a0234,56", 1234), ("-3,9", -3), ("42", 42), ("0,5", 0), ("abc", None), (None, None),
     ("1\u00a0000\u00a0000", 1000000), ("5d", None), ("7f", None), ("NaN", None), ("1e3", 1000), (".5", 0)],
)
def test_parse_number_lenient(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(parse_number("s")).first()[0] == expected


def test_parse_number_strict_raises(spark):
    df = spark.createDataFrame([("12,5",), ("oops",)], "s string")
    with pytest.raises(Exception):
        df.select(parse_number("s", strict=True)).collect()


@pytest.mark.parametrize("text", ["5d", "7f", "0x1p3", "Infinity"])
def test_parse_number_strict_refuses_what_only_java_reads(spark, text):
    with pytest.raises(Exception):
        spark.createDataFrame([(text,)], "s string").select(parse_number("s", strict=True)).collect()


def test_try_int_keeps_text(spark):
    df = spark.createDataFrame([("12",), ("c_1",)], "s string")
    assert [tuple(r) for r in df.select("s", try_int("s")).collect()] == [("12", 12), ("c_1", None)]


def test_clean_text_random_strings_match_python(spark):
    import random

    rng = random.Random(7)
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    alphabet = spaces + list("abcАБВ,.\"'#_-") + ["\u200b", "\u00ad"]
    samples = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string")
    got = {r["i"]: r["c"] for r in df.select("i", clean_text("s").alias("c")).collect()}
    assert all(got[i] == _python_clean(s) for i, s in enumerate(samples))


def test_parse_number_random_localised_values(spark):
    import math
    import random

    rng = random.Random(11)
    values = [rng.uniform(-1e7, 1e7) for _ in range(2000)] + [float(rng.randint(-10**6, 10**6)) for _ in range(500)]

    def localise(x):
        whole, _, frac = f"{abs(x):.2f}".partition(".")
        groups = []
        while whole:
            groups.insert(0, whole[-3:])
            whole = whole[:-3]
        return ("-" if x < 0 else "") + "\u00a0".join(groups) + "," + frac

    texts = [localise(v) for v in values]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["n"] for r in df.select("i", parse_number("t").alias("n")).collect()}
    expected = {i: int(math.trunc(float(t.replace("\u00a0", "").replace(",", "."))))
                for i, t in enumerate(texts)}
    assert got == expected


def test_mixed_cells_keep_their_kind(spark, tmp_dir):
    from starload.functions.numbers import mixed_cell

    texts = ["12", " 7 ", "-3", "007", "1.5", "x", "", "99999999999", None]
    spark.createDataFrame([(t,) for t in texts], "t string").select("t", mixed_cell("t").alias("v")).write.parquet(
        f"{tmp_dir}/v")
    got = {r["t"]: (r["k"], r["s"]) for r in spark.read.parquet(f"{tmp_dir}/v").selectExpr(
        "t", "schema_of_variant(v) AS k", "CAST(v AS STRING) AS s").collect()}
    assert got == {"12": ("BIGINT", "12"), " 7 ": ("BIGINT", "7"), "-3": ("BIGINT", "-3"), "007": ("BIGINT", "7"),
                   "1.5": ("STRING", "1.5"), "x": ("STRING", "x"), "": ("STRING", ""),
                   "99999999999": ("STRING", "99999999999"), None: (None, None)}
