"""Word breaks: literal cases; the words of the Unicode break tests, written by hand."""

import time

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from webloom.functions.text import tokenize
from webloom.plans.oracle import tokens_expr

CASES = [
    # ideographs and Hiragana one by one, Katakana and Hangul in runs
    ("我们是中国人", ["我", "们", "是", "中", "国", "人"]),
    ("東京タワーへ行く", ["東", "京", "タワー", "へ", "行", "く"]),
    ("ﾃｽﾄ カタカナ", ["ﾃｽﾄ", "カタカナ"]),
    ("한국어 문서", ["한국어", "문서"]),
    ("ひらがな", ["ひ", "ら", "が", "な"]),
    ("ガキ", ["ガキ"]),            # a voiced mark stays with its letter
    ("漢\U000E0100字", ["漢\U000E0100", "字"]),  # so does a variation selector
    ("𠀀𠀁", ["𠀀", "𠀁"]),
    ("二〇二四年", ["二", "〇", "二", "四", "年"]),
    ("ABC漢字123", ["abc", "漢", "字", "123"]),
    ("ab12カタ34", ["ab12", "カタ", "34"]),
    ("スパーク3", ["スパーク", "3"]),
    # scripts without spaces: a run each
    ("สวัสดีชาวโลก hello", ["สวัสดีชาวโลก", "hello"]),
    ("ພາສາລາວ", ["ພາສາລາວ"]),
    ("ភាសាខ្មែរ", ["ភាសាខ្មែរ"]),
    # marks and format characters
    ("été", ["été"]),
    ("co­op", ["co­op"]),
    ("a‍b", ["a‍b"]),
    (" ́abc", ["abc"]),
    ("हिन्दी भाषा", ["हिन्दी", "भाषा"]),
    # joiners
    ("can't can’t", ["can't", "can’t"]),
    ("a·b a‧b", ["a·b", "a‧b"]),
    ("a:b a::b a.b. .a", ["a:b", "a", "b", "a.b", "a"]),
    ("1,2 1,,2 1.2.3 1;2 1:2", ["1,2", "1", "2", "1.2.3", "1;2", "1", "2"]),
    ("a,b 1.a a.1 a'1", ["a", "b", "1", "a", "a", "1", "a", "1"]),
    ("3a 3.2a a1.2b", ["3a", "3.2a", "a1.2b"]),
    ("a.́b", ["a.́b"]),
    # connectors
    ("a_b _a a_ __ a__1 1_a", ["a_b", "_a", "a_", "a__1", "1_a"]),
    ("a_カ_漢", ["a_カ_", "漢"]),
    ("a‿b", ["a‿b"]),
    ("a_'b", ["a_", "b"]),
    # other scripts
    ("Привет, мир", ["привет", "мир"]),
    ("السلام عليكم", ["السلام", "عليكم"]),
    ("١٢٣٬٤٥٦", ["١٢٣٬٤٥٦"]),
    ("👍 ok 👍🏽", ["ok"]),
]


@pytest.fixture(scope="module")
def got(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    return {r[0]: r[1] for r in df.select("i", tokenize("t")).collect()}


@pytest.mark.parametrize("i", range(len(CASES)), ids=[repr(c[0]) for c in CASES])
def test_literal_breaks(got, i):
    assert got[i] == CASES[i][1]


ALPHABET = "aé1٣_‿.,:;'’漢字かなカター한국ไทย ລາວ゙́­‍-\n𠀀"


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=30))
def test_equals_sql(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "s string").select(tokenize("s")).collect()
    want = duckdb.connect().execute(
        f"SELECT {tokens_expr('s')} FROM (SELECT unnest(?::VARCHAR[]) AS s, generate_subscripts(?::VARCHAR[], 1) AS i) ORDER BY i",
        [texts, texts]).fetchall()
    assert [list(r[0]) for r in rows] == [list(r[0]) for r in want]


@pytest.mark.parametrize("text", ["_" * 300_000, "漢" * 300_000, "ア" * 300_000, "a_" * 150_000, "ก" * 300_000, "á" * 150_000,
                                  "." * 300_000, "a:" * 150_000, "1a" * 150_000, "́" * 300_000])
def test_very_long_runs_are_linear(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(tokenize("t"))
    begin = time.monotonic()
    tokens = df.first()[0]
    assert time.monotonic() - begin < 30
    assert sum(map(len, tokens)) in (0, len(text), len(text) - 1, len(text) // 2)


def test_null_text(spark):
    assert spark.createDataFrame([(None,)], "t string").select(tokenize("t")).first()[0] is None
