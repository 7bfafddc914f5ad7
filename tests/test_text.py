import re
import sys

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contentloom.functions import text as X

CLEAN_CASES = {
    None: None,
    "": "",
    " Hello,  World 42! ": "hello  world",
    "\tTab\n": "tab",
    "don't": "dont",
    "שלום עולם": "",
    "École": "cole",
    "a b": "a b",
    "　x y ": "x y",
    "İstanbul": "stanbul",
    "one\x1ctwo": "one\x1ctwo",
}
TOKEN_CASES = {
    None: [],
    "": [],
    "hello  world": ["hello", "world"],
    "a to cat": ["cat"],
    "  lead and trail ": ["lead", "and", "trail"],
    "naïve été x": ["naïve", "été"],
    "a\U0001f600b cd": ["a\U0001f600b"],
}


def python_clean(text):
    if text is None:
        return None
    return re.sub(r"[^a-zA-Z\s]", "", text).lower().strip()


def python_tokens(text):
    return [] if text is None else [w for w in text.split() if len(w) > 2]


def test_whitespace_is_pythons():
    code_points = [cp for cp in range(sys.maxunicode + 1) if chr(cp).isspace()]
    assert code_points == list(X.WHITESPACE_CODE_POINTS)


def test_clean_text(apply):
    assert apply(X.clean_text, CLEAN_CASES) == list(CLEAN_CASES.values())


def test_tokenize(apply):
    assert apply(X.tokenize, TOKEN_CASES) == list(TOKEN_CASES.values())


text_lists = st.lists(
    st.one_of(
        st.none(),
        st.text(st.characters(exclude_categories=["Cs"]), max_size=40),
        st.text(st.sampled_from("aZé7'- \t\n\r\x0b\x1c\x85    　א"), max_size=40),
    ),
    min_size=1,
    max_size=60,
)
few = settings(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


@few
@given(texts=text_lists)
def test_clean_and_tokenize_equal_python(apply, texts):
    assert apply(X.clean_text, texts) == [python_clean(t) for t in texts]
    assert apply(X.tokenize, texts) == [python_tokens(t) for t in texts]
    assert apply(X.strip, texts) == [None if t is None else t.strip() for t in texts]
    assert apply(lambda c: X.clean_tokens(X.clean_text(c)), texts) == [
        python_tokens(python_clean(t)) for t in texts
    ]


def test_words(apply):
    texts = ["The  cat's Hat", "", None, " a b "]
    assert apply(X.words, texts) == [["the", "cats", "hat"], [], None, ["a", "b"]]
    assert apply(lambda c: X.words(c, keep_empty=True), texts) == [
        ["the", "", "cats", "hat"],
        [""],
        None,
        ["", "a", "b"],
    ]


def test_normalize_label(apply):
    values = ["  Nature ", "\tTab ", "", None]
    assert apply(X.normalize_label, values) == ["nature", "\ttab", "", None]


def test_truncate_counts_characters(apply):
    assert apply(lambda c: X.truncate(c, 3), ["abcdef", "é\U0001f600xy", "a", None]) == [
        "abc",
        "é\U0001f600x",
        "a",
        None,
    ]


@few
@given(
    numbers=st.lists(
        st.one_of(
            st.floats(-1e9, 1e9),
            st.integers(-100000, 100000).map(lambda n: n / 1000),
            st.integers(-4000, 4000).map(lambda n: n / 8),
        ),
        min_size=1,
        max_size=100,
    )
)
def test_two_decimals_equals_python(apply, numbers):
    numbers += [0.125, 0.145, 0.005, 2.675, 1.005, 1e9 + 0.375, 0.0, 0.995, 0.999, 99.995]
    expected = [f"{n:.2f}" for n in numbers]
    expected = ["0.00" if e == "-0.00" else e for e in expected]
    got = apply(X.two_decimals, numbers, "double")
    assert ["0.00" if g == "-0.00" else g for g in got] == expected


def test_two_decimals_of_null(apply):
    assert apply(X.two_decimals, [None], "double") == [None]


def test_native_only(spark):
    df = spark.range(1).select(F.lit("A b").alias("t"))
    plan = df.select(X.clean_text(F.col("t")), X.tokenize(F.col("t")))._jdf.queryExecution().toString()
    assert "Python" not in plan
