import html
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleanwell.functions import text


def test_decode_entities_like_the_standard_rule(column):
    cases = [
        "a &amp; b", "&notit; x", "&copy 5", "&#65;&#x42;&#128;&#0;&#xD800;&#99999999999999999999;&#x1F600;",
        "&unknown; &", "&amp", "&hellip;&nbsp;&apos;", "plain", "&#xFDD0;.&#11;&#13;", "&&&é", "&ampx;",
        "&CounterClockwiseContourIntegral;", "&lt", "a&ltb", "&#x10FFFF;", "",
    ]
    assert column(text.decode_entities("x"), cases) == [html.unescape(c) for c in cases]


def test_decode_entities_random_texts(column):
    rnd = random.Random(7)
    pieces = ["&", "#", "x", "amp", "lt", ";", "12", "9731", " ", "é", "copy", "notin", "&amp;", "&#39;"]
    cases = ["".join(rnd.choices(pieces, k=rnd.randint(1, 9))) for _ in range(1500)]
    assert column(text.decode_entities("x"), cases) == [html.unescape(c) for c in cases]


def test_strict_decoding_needs_the_semicolon(column):
    cases = ["?a=1&amp;b=2", "?a=1&copy=2", "&eacute;t&#233;", "&nosuch;"]
    assert column(text.decode_entities("x", lenient=False), cases) == ["?a=1&b=2", "?a=1&copy=2", "été", "&nosuch;"]


def test_sanitize_text_strips_all_whitespace(column):
    cases = ["  test word \n ", "\xa0A ", "\x1f b\x0b", ""]
    assert column(text.sanitize_text("x"), cases) == [c.strip().lower() for c in cases]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(min_value=-1e9, max_value=1e9), min_size=1, max_size=60))
def test_round_exact_rounds_the_binary_value(column, values):
    assert column(text.round_exact("x"), values, "double") == [round(v, 3) for v in values]


def test_round_exact_near_ties(column):
    values = [n / 100 / 60 for n in range(1, 20000)] + [0.0005, 0.0015, 1.0005, 2.5e-4, -1.2345]
    assert column(text.round_exact("x"), values, "double") == [round(v, 3) for v in values]


def test_float_text_has_no_exponent(column):
    values = [0.0, 2.0, 0.033, 1 / 60, 1e7, 123456789.125, 0.0005, -20000000.5]
    assert column(text.float_text("x"), values, "double") == [str(v) for v in values]


def test_scripts(column):
    cases = ["ಕನ್ನಡ news", "KANNADA songs", "ಕx news", "plain", "", "a ಕ"]
    assert column(text.has_kannada("x"), cases) == [True, True, False, False, False, True]
    assert column(text.has_tamil("x"), ["xதமிழ்", "Tamil", "none"]) == [True, True, False]


def test_let_binds_once(column):
    assert column(text.let(F.length("x"), lambda n: n + n), ["ab", "c"]) == [4, 2]
