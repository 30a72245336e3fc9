"""Text that browsers draw within formulas, diagrams and lists of a form."""

import pytest
from episodica.llm import html


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("a <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>tex</annotation></math> b", "a x=1 b"),
        ("<svg><title>t</title><desc>d</desc><defs/><path d='M0'/><text>one</text><text>two</text></svg>", "one\ntwo"),
        ("<svg><defs><text>no</text></defs><text>yes</text></svg><p>end</p>", "yes\n\nend"),
        ("<select><option>red<option>blue</select>", "red\nblue"),
    ],
)
def test_drawn_text(source, text):
    assert html.render(source) == text


def test_row_spans_keep_columns():
    rows = "<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e<tr><td>f<td rowspan=0>g<td>h<tr><td>i<td>j</table>"
    assert html.render(rows) == "a | b | c\n  | d | e\nf | g | h\ni |   | j"
    assert html.render("<table><tr><td colspan=2 rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e<td>f</table>") == "a |   | b\n  |   | c\nd | e | f"
    assert html.render("<table><tr><td rowspan=99999999 colspan=x>a<td>b</table>") == "a | b"


def test_stray_tags_take_linear_time():
    import time

    began = time.perf_counter()
    for source in ("<b><table><tr><td>" + "<i>" * 40_000 + "</b>" * 40_000, "<ul>" + "<div>" * 40_000 + "<li>x</li>" * 40_000, "<table>" + "<div>" * 40_000 + "<td>x</td>" * 40_000):
        html.render(source + "end")
    assert time.perf_counter() - began < 10
