from pyspark.sql import functions as F

from webloom.functions import text as T

# Index terms recorded by the reference (each must be exactly one token and
# survive the number filter).
GOLDEN_TERMS = ["0'1", "0'23.08", "0,4458,360183_395924,00", "0,5px", "0.0.0", "0.0000e", "0.001lux"]


def one(spark, col, data, schema="s string"):
    return [r[0] for r in spark.createDataFrame([(d,) for d in data], schema).select(col).collect()]


def test_golden_terms_single_tokens(spark):
    got = one(spark, T.tokenize("s"), GOLDEN_TERMS)
    assert got == [[t] for t in GOLDEN_TERMS]
    kept = one(spark, T.index_terms("s"), GOLDEN_TERMS)
    assert kept == [[t] for t in GOLDEN_TERMS]


def test_tokenize_word_breaks(spark):
    got = one(spark, T.tokenize("s"), ["Hello, World! a.b.c x:y 1,2 a,b don't 3.14 ___ ÉTÉ"])[0]
    assert got == ["hello", "world", "a.b.c", "x:y", "1,2", "a", "b", "don't", "3.14", "été"]


def test_long_tokens_kept(spark):
    assert one(spark, T.tokenize("s"), ["x" * 256 + " ok " + "y" * 255])[0] == ["x" * 256, "ok", "y" * 255]


def test_stop_words_and_numbers_removed(spark):
    got = one(spark, T.index_terms("s"), ["The cat and a dog 42 0x1F face bad fox 1.5"])[0]
    assert got == ["cat", "dog", "fox"]


def test_is_number_string(spark):
    cases = {"bad": True, "face": True, "0x1f": True, "0x": False, "0xg": False, "1.2.3": False,
             "a.1": False, "": True, "1,000.5": True, "abc1": True, "hello": False, "12": True,
             "0X1F": True, "1e5": True, "1.5e": False}
    got = dict(zip(cases, one(spark, T.is_number_string("s"), list(cases))))
    assert got == cases


def test_doc_key(spark):
    got = one(spark, T.doc_key("s"), ["clueweb09-en0000-01-19826", "12-ab-34", "xen9y8"])
    assert got == ["00000119826", "1234", "98"]


def test_strip_http_header(spark):
    got = one(spark, T.strip_http_header("s"), [
        "HTTP/1.1 200\nContent-Length: 5\n\n<html>x", "Content-Length: 5 no tag", "<p>plain</p>"])
    assert got == ["<html>x", "", "<p>plain</p>"]


def test_header_split(spark):
    df = spark.createDataFrame([("WARC-Type: response",), ("a:b:c",), ("novalue",)], "s string")
    rows = df.select(T.header_key("s"), T.header_value("s")).collect()
    assert [tuple(r) for r in rows] == [("WARC-Type", "response"), ("a", "b:c"), ("novalue", "")]


def test_fill_command_and_base_name(spark):
    df = spark.createDataFrame([("run #_INPUTFILE_# > #_OUTPUTFILE_#", "/d/in.fa", "/o/x")], "t string, i string, o string")
    r = df.select(T.fill_command("t", "i", "o"), T.base_name("i")).first()
    assert tuple(r) == ("run /d/in.fa > /o/x", "in.fa")
