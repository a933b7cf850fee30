"""Sentence spans: the listed cases, and what holds for any text."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafwright.functions.sentences import outer_brackets, sentence_spans

CASES = {
    "two": ("Cells were taken from bone. The yield was high.", ["Cells were taken from bone.", "The yield was high."]),
    "no stop": ("The cause remains unclear", ["The cause remains unclear"]),
    "empty": ("", []),
    "marks": ("Does it last? We think so. Good!", ["Does it last?", "We think so.", "Good!"]),
    "figure": ("It exceeded 90% (Fig. 2A). This was stable.", ["It exceeded 90% (Fig. 2A).", "This was stable."]),
    "et al": ("Huard et al. reported a yield. We agree.", ["Huard et al. reported a yield.", "We agree."]),
    "eg": ("Markers (e.g. CD73, CD90) were found, i.e. the type held.", ["Markers (e.g. CD73, CD90) were found, i.e. the type held."]),
    "versus": ("One vs. PBS differed. It lasted.", ["One vs. PBS differed.", "It lasted."]),
    "approx": ("Seeded at approx. 5000 a well. Medium was changed.", ["Seeded at approx. 5000 a well.", "Medium was changed."]),
    "number": ("Kit No. 4 (Acme Inc. Germany) was used. Staining followed.", ["Kit No. 4 (Acme Inc. Germany) was used.", "Staining followed."]),
    "route": ("Mice got 100 µL i.p. daily. They were scored.", ["Mice got 100 µL i.p. daily.", "They were scored."]),
    "country": ("It came from the U.S. Samples were cold.", ["It came from the U.S. Samples were cold."]),
    "brackets": ("Stained (BD, San Jose, CA, USA. Flow Cat.# 5) [9]. Gates were set.", ["Stained (BD, San Jose, CA, USA. Flow Cat.# 5) [9].", "Gates were set."]),
    "open bracket": ("The device (see Methods was used. Cells were washed.", ["The device (see Methods was used.", "Cells were washed."]),
    "decimal": ("It rose (p = 0.0020). Others agreed.", ["It rose (p = 0.0020).", "Others agreed."]),
    "version": ("We used Prism 9.5.1. The level was 0.05.", ["We used Prism 9.5.1.", "The level was 0.05."]),
    "initial": ("We thank J. Huard for help.", ["We thank J. Huard for help."]),
    "initials": ("Idea, J. K. Huard and R. Smith.", ["Idea, J. K. Huard and R. Smith."]),
    "degree": ("Kept at 37 °C. Medium was changed.", ["Kept at 37 °C.", "Medium was changed."]),
    "unit": ("Kept at 4 C. Thawing was fast.", ["Kept at 4 C.", "Thawing was fast."]),
    "group": ("Some were in group A. The rest were not.", ["Some were in group A.", "The rest were not."]),
    "minutes": ("Left for 30 min. Cells were washed.", ["Left for 30 min.", "Cells were washed."]),
    "quote": ('They call it "bold." We agree.', ['They call it "bold."', "We agree."]),
    "dots": ("It went on... Then it stopped.", ["It went on...", "Then it stopped."]),
    "lower": ("It ended. then went on.", ["It ended. then went on."]),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    text, want = CASES[name]
    assert [text[a:b] for a, b in sentence_spans(text)] == want


def test_citations_behind_the_stop():
    text = "It lies at 0.6–2.2%.1,2 The effect held in both.3,4 The cause is unclear.5–7 More is needed."
    at = lambda x: (text.index(x), text.index(x) + len(x))
    ones = [(at(".1,2")[0] + k, at(".1,2")[0] + k + 1) for k in (1, 3)] + [(at(".3,4")[0] + k, at(".3,4")[0] + k + 1) for k in (1, 3)] + [at("5–7")]
    assert len(sentence_spans(text, [], ones)) == 4
    assert sentence_spans(text) == [(0, len(text))]


def test_list_items_begin_sentences():
    text = "Criteria were: age over 40 grade 2 or 3 no surgery"
    cuts = [text.index("grade"), text.index("no surgery")]
    assert [text[a:b] for a, b in sentence_spans(text, cuts)] == ["Criteria were: age over 40", "grade 2 or 3", "no surgery"]


@settings(max_examples=300, deadline=None)
@given(st.text("AbZ. ?!()[]é1,\"'", max_size=60).map(lambda t: " ".join(t.split())))
def test_nothing_is_lost(text):
    spans = sentence_spans(text)
    assert all(0 <= a < b <= len(text) and text[a] != " " and text[b - 1] != " " for a, b in spans)
    assert all(b <= c for (_, b), (c, _) in zip(spans[:-1], spans[1:], strict=True))
    assert " ".join(text[a:b] for a, b in spans).replace(" ", "") == text.replace(" ", "")


def test_brackets():
    assert outer_brackets("a (b [c) d] (e") == [(2, 7)]
    assert outer_brackets("([{}])") == [(0, 5)]
