from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pageloom.functions import text as X

NBSP, NARROW = " ", " "


def test_tokens_split_at_any_blank_and_skip_empty_ones(evaluate):
    got = evaluate(X.tokens("s"), ["  a b", f"a{NBSP}b{NARROW}c", "\r\n\t", "", None])
    assert got == [["a", "b"], ["a", "b", "c"], [], [], None]


def test_nth_token_is_null_when_short(evaluate):
    assert evaluate(X.nth_token("s", 2), ["RCS 123", "RCS", f"SIREN{NBSP}9"]) == ["123", None, "9"]


def test_token_range_needs_seven_words(evaluate):
    got = evaluate(X.token_range("s", 5, 3), ["1 2 3 4 5 6 7", "1 2 3 4 5 6", "a b c d e f g h"])
    assert got == ["5 6 7", None, "e f g"]


def test_trim_takes_no_break_blanks(evaluate):
    assert evaluate(X.trim_blank("s"), [f" {NBSP}a b{NARROW}\n", f"{NBSP}"]) == ["a b", ""]


def test_entities_are_decoded_once(evaluate):
    got = evaluate(X.decode_entities("s"), [
        "a &amp;lt; b", "&eacute;&#233;&#xE9;", "&#8364;&euro;", "&nosuch; & &", "&nbsp;x", "plain",
        "&#99999999999999999999;", "&#xFFFFFFFF;", "&#0;", "&quot;&#39;&apos;&copy;&middot;", None])
    assert got == ["a &lt; b", "ééé", "€€", "&nosuch; & &", f"{NBSP}x", "plain",
                   "&#99999999999999999999;", "&#xFFFFFFFF;", "&#0;", "\"''©·", None]


def test_amounts(evaluate):
    got = evaluate(X.amount("s"), [f"750{NBSP}000 €", f"750{NARROW}000 €", "750 000 €", "43,33 m²",
                                   "Prix nous consulter", "", None, "1,2,3"])
    assert got == [Decimal("750000.00")] * 3 + [Decimal("43.33"), None, None, None, None]


def test_criteria_of_the_sample_record(evaluate):
    block = ('<div class="c-pa-criterion">\r\n            \r\n\r\n\r\n\t<em>1 p</em>\r\n\r\n\r\n\t'
             '<em>43,33 m²</em>\r\n\r\n\r\n\t<em>3 etg</em>\r\n\r\n        </div>')
    assert evaluate(X.criteria_items("s"), [block]) == [["1 p", "43,33 m²", "3 etg"]]
    typed = X.typed_criteria(X.criteria_items("s"))
    assert evaluate(typed["rooms"], [block, "<em>x</em>"]) == [1, None]
    assert evaluate(typed["surface_m2"], [block]) == [Decimal("43.33")]
    assert evaluate(typed["floor"], [block]) == [3]


def test_empty_values(evaluate):
    assert evaluate(X.null_if_empty("s"), ["", "a", None]) == [None, "a", None]
    assert evaluate(X.null_if_no_items("split(s, ',')"), ["a,b"]) == [["a", "b"]]
    assert evaluate(X.null_if_no_items("filter(array(s), x -> x <> '')"), [""]) == [None]
    assert evaluate(X.fill_blank_items("array(s, 'x')"), ["", None, "a"]) == [
        ["None", "x"], ["None", "x"], ["a", "x"]]
    assert evaluate(X.labelled("Ads_Url :", "s"), ["u", None]) == ["Ads_Url :u", None]


def test_json_keeps_null_fields(evaluate):
    assert evaluate(X.json_record(a="s", b="1"), ["x", None]) == ['{"a":"x","b":1}',
                                                                  '{"a":null,"b":1}']


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 10**12 - 1), st.sampled_from([NBSP, NARROW, " "])),
                min_size=40, max_size=40))
def test_reading_a_rendered_price_gives_it_back(evaluate, prices):
    shown = [f"{cents // 100:,}".replace(",", blank) + f",{cents % 100:02d} €"
             for cents, blank in prices]
    assert evaluate(X.amount("s"), shown) == [Decimal(c) / 100 for c, _ in prices]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \t\n\r\x0b\x0c\x1c\x1f\x85    　é"),
                min_size=40, max_size=40))
def test_tokens_agree_with_python_split(evaluate, strings):
    assert evaluate(X.tokens("s"), strings) == [s.split() for s in strings]


def test_the_first_number_counts(evaluate):
    shown = ["43 m2", "de 750 000 à 900 000 €", "1 200 € (charges 50 €)", "-12,5 €", "1 200 000 €",
             "2 43,33", "1234 567", "", "Prix nous consulter", None]
    want = [43, 750000, 1200, -12.5, 1200000, 2, 1234, None, None, None]
    got = evaluate(X.amount("s"), shown)
    assert [None if v is None else float(v) for v in got] == want


def test_hex_references_padded_with_zeros_are_decoded(evaluate):
    assert evaluate(X.decode_entities("s"), ["&#x000000041;", "&#X00000000000000e9;", "&#x0;", "&#x123456789;"]) == [
        "A", "é", "&#x0;", "&#x123456789;"]


def test_amounts_beyond_the_type_are_told_from_none(evaluate):
    texts = ["750 000 €", "1" * 20 + " €", "-" + "9" * 13 + ",5", "Prix nous consulter", "", None, "9" * 12 + ",99"]
    got = evaluate(f"array({X.amount('s')} IS NULL, {X.amount_too_large('s')})", texts)
    assert got == [[False, False], [True, True], [True, True], [True, False], [True, False], [True, False], [False, False]]


def test_the_time_of_extraction(spark):
    from datetime import datetime, timedelta

    from pageloom.sources.pages import fetched_pages
    pages = spark.createDataFrame([("a", "x", None), ("b", "y", datetime(2024, 1, 1))], "url string, html string, fetched_at timestamp")
    plain = {r.url: r.fetched_at for r in fetched_pages(pages).collect()}
    assert plain == {"a": None, "b": datetime(2024, 1, 1)}
    for df in (pages, pages.drop("fetched_at")):
        rows = {r.url: r.fetched_at for r in fetched_pages(df, clock=True).collect()}
        assert abs(rows["a"] - datetime.utcnow()) < timedelta(minutes=10) or abs(rows["a"] - datetime.now()) < timedelta(minutes=10)
        assert rows["b"] == (datetime(2024, 1, 1) if df is pages else rows["a"])
