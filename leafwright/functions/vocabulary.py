"""Vocabularies of the document model: section types, roles, certainty, and the terms that rules look for."""

# Section types.
SECTION_TYPES = (
    "abstract", "introduction", "methods", "results", "case", "discussion", "conclusions", "limitations",
    "supplementary", "acknowledgements", "funding", "conflicts", "ethics", "data-availability", "abbreviations", "other",
)

# Fixed values: @sec-type to section type.
SEC_TYPES = {
    "intro": "introduction",
    "introduction": "introduction",
    "background": "introduction",
    "methods": "methods",
    "materials|methods": "methods",
    "materials-and-methods": "methods",
    "subjects|methods": "methods",
    "results": "results",
    "results|discussion": "results",
    "discussion": "discussion",
    "conclusion": "conclusions",
    "conclusions": "conclusions",
    "supplementary_material": "supplementary",
    "supplementary-material": "supplementary",
    "ack": "acknowledgements",
    "funding": "funding",
    "coi_statement": "conflicts",
    "abbreviations": "abbreviations",
}

# Fixed values: @notes-type to section type.
NOTES_TYPES = {
    "coi-statement": "conflicts",
    "conflict": "conflicts",
    "funding-information": "funding",
    "data-availability": "data-availability",
}

#: A word's edge on either side, by ASCII letters, digits and underscore.
EDGE_BEFORE, EDGE_AFTER = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"

# Title patterns in order, with the type and whether the title of a subsection may decide by it.
TITLE_RULES = (
    (r"{b}limitation", "limitations", True),
    (r"{b}strengths?\s+and\s+limitations?{e}", "limitations", True),
    (r"{b}introduction{e}", "introduction", True),
    (r"^\s*background{e}", "introduction", True),
    (r"{b}(materials?|subjects?|patients?){e}.*{b}methods?{e}", "methods", True),
    (r"{b}methods?{e}", "methods", True),
    (r"{b}results?{e}", "results", True),
    (r"{b}case\s+(report|presentation|description|history|study){e}", "case", True),
    (r"^\s*case\s*\d*\s*$", "case", True),
    (r"{b}discussion{e}", "discussion", True),
    (r"{b}conclusions?{e}", "conclusions", True),
    (r"{b}concluding\s+remarks{e}", "conclusions", True),
    (r"{b}supplementary{e}", "supplementary", True),
    (r"{b}acknowledg", "acknowledgements", True),
    (r"{b}funding{e}", "funding", True),
    (r"{b}financial\s+support{e}", "funding", True),
    (r"{b}(conflicts?\s+of\s+interest|competing\s+interests?|disclosure)", "conflicts", True),
    (r"{b}(institutional\s+review\s+board|informed\s+consent|ethic)", "ethics", True),
    (r"{b}data\s+availability{e}", "data-availability", True),
    (r"{b}abbreviations?{e}", "abbreviations", True),
    (r"{b}methodology{e}", "methods", False),
    (r"{b}study\s+design{e}", "methods", False),
    (r"{b}statistical\s+analys", "methods", False),
    (r"{b}experimental{e}", "methods", False),
    (r"{b}findings?{e}", "results", False),
)


def title_patterns() -> list[tuple[str, str, bool]]:
    """The title rules as patterns that Java and Python read alike."""
    return [("(?i)" + p.replace("{b}", EDGE_BEFORE).replace("{e}", EDGE_AFTER), kind, strong) for p, kind, strong in TITLE_RULES]


TITLE_NUMBER = r"^\s*[0-9]+(\.[0-9]+)*\.?\s*"

# Article types of which no introduction, methods, results and discussion are expected.
FREE_FORM_TYPES = ("case-report", "editorial", "review-article", "letter", "correction", "retraction", "book-review", "news", "other")
REQUIRED_TYPES = ("introduction", "methods", "results", "discussion")

# The back elements that hold text, with their type (None: by notes-type or title).
BACK_ELEMENTS = {"sec": None, "notes": None, "ack": "acknowledgements", "glossary": "abbreviations", "app": "supplementary", "funding-group": "funding", "bio": "other"}
SKIPPED_BACK_TYPES = ("display-objects", "supplementary-material")
#: Top-level types with which the end of an article begins.
BACK_TYPES = ("supplementary", "acknowledgements", "funding", "conflicts", "ethics", "data-availability", "abbreviations")

# Paragraph roles and sentence certainty, from measured to speculative.
ROLES = ("background", "gap", "objective", "study_design", "method", "result", "interpretation", "claim", "limitation", "conclusion", "other")
CERTAINTY = ("measured", "supported", "hedged", "speculative")
NO_STANCE_ROLES = ("method", "study_design")

# Sections that each annotation pass covers.
PARAGRAPH_SECTIONS = ("abstract", "introduction", "methods", "results", "case", "discussion", "conclusions", "limitations")
SENTENCE_SECTIONS = ("abstract", "introduction", "results", "case", "discussion", "conclusions", "limitations")

# Words that hedge, in a source text and, further, in a summary.
SOURCE_HEDGES = (
    "may", "might", "could", r"would\s+likely",
    r"suggest\w*", r"appear\w*", r"seem\w*", r"propos\w*", r"hypothesi\w*", r"argu\w*", r"thought\s+to", r"believed\s+to",
    "likely", "unlikely", "possible", "possibly", r"plausibl\w*", r"presumabl\w*", r"speculativ\w*", r"tentativ\w*",
    r"uncertain\w*", "unclear", "unproven", r"not\s+established", r"remains?\s+to\s+be", r"cannot\s+be\s+excluded",
    r"no\s+clinical\s+data", r"based\s+on\s+a\s+single",
)
SUMMARY_HEDGES = (
    r"potential\w*", r"indicat\w*", r"apparent\w*", r"warrant\w*",
    r"not\s+(?:yet\s+)?(?:been\s+)?(?:tested|shown|established|proven|confirmed|verified)",
    r"had\s+not\s+been", r"still\s+needed", r"needs?\s+(?:further|external|independent)",
    r"further\s+(?:study|studies|work|research)", r"generaliz\w*", r"only\s+trend\w*", r"did\s+not\s+reach", r"no\s+direct\s+evidence",
)


def _any_of(terms: tuple[str, ...]) -> str:
    return f"(?i){EDGE_BEFORE}(?:{'|'.join(t.replace(r'\w', '[A-Za-z0-9_]') for t in terms)}){EDGE_AFTER}"


SOURCE_HEDGE = _any_of(SOURCE_HEDGES)
SUMMARY_HEDGE = _any_of(SOURCE_HEDGES + SUMMARY_HEDGES)

# Abbreviations after which no sentence ends.
ABBREVIATIONS = frozenset((
    "fig.", "figs.", "tab.", "tabs.", "eq.", "eqs.", "ref.", "refs.", "suppl.", "supp.", "chap.", "vol.", "no.", "nos.", "pp.",
    "et.", "al.", "e.g.", "i.e.", "cf.", "vs.", "viz.", "resp.", "approx.", "ca.",
    "dr.", "prof.", "mr.", "mrs.", "ms.", "jr.", "sr.", "st.", "ph.d.", "m.d.", "d.v.m.", "b.sc.", "m.sc.",
    "inc.", "ltd.", "co.", "corp.", "univ.", "dept.", "natl.", "assoc.",
    "i.p.", "i.v.", "s.c.", "p.o.", "i.m.", "i.c.v.", "i.a.",
    "u.s.", "u.k.", "u.s.a.",
))

# Words that may begin a sentence after a single capital.
STARTERS = frozenset((
    "the", "this", "these", "those", "that", "a", "an", "it", "its", "we", "our", "they", "there", "here",
    "however", "therefore", "thus", "hence", "moreover", "furthermore", "additionally", "similarly", "conversely", "consistently",
    "notably", "importantly", "overall", "finally", "collectively", "together", "taken",
    "in", "on", "at", "by", "for", "from", "to", "as", "with", "within", "after", "before", "during", "when", "while",
    "although", "though", "because", "since", "if", "both", "all", "each", "no", "not", "such", "given",
    "statistical", "data", "mice", "rats", "animals", "cells", "samples", "patients", "results", "values",
))

# Code points of the blanks that normalisation collapses.
_BLANK_CODES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)
BLANKS = "".join(map(chr, _BLANK_CODES))
#: The same as a class that Java and Python read alike.
BLANK = "[" + "".join("\\u%04x" % c for c in _BLANK_CODES) + "]"

# Prices of the model tiers per million tokens, in and out.
PRICES = {"large": (5.0, 25.0), "medium": (3.0, 15.0), "small": (1.0, 5.0)}
