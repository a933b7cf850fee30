"""Journal-article XML to flat, span-annotated rows, without Spark.

Every span is a half-open range of code points of its paragraph's normalised text. Text
is normalised while it is put together, so offsets that were noted never move.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from html.parser import HTMLParser
from xml.parsers import expat

from leafwright.functions.headings import notes_type, section_type
from leafwright.functions.sentences import sentence_spans
from leafwright.functions.vocabulary import BACK_ELEMENTS, BLANK, FREE_FORM_TYPES, REQUIRED_TYPES, SKIPPED_BACK_TYPES

_BLANKS = re.compile(BLANK + "+")
_MARKS = ("italic", "bold", "sup", "sub")
_NOT_IN_TEXT = ("fig", "table-wrap", "supplementary-material", "boxed-text")
_LINKED = ("graphic", "ext-link", "uri", "license")
_LICENCE_LINK = re.compile(r"creativecommons\.org|/licenses?/", re.I)

Node = ET.Element
# Deeper documents end with an error, as they do wherever a rule follows the elements down.
MAX_DEPTH = 950


def normalised(text: str) -> str:
    return _BLANKS.sub(" ", text).strip(" ")


def elements(node: Node | None, *tags: str) -> list[Node]:
    """Child elements, of the given tags if any are given."""
    return [] if node is None else [n for n in node if not tags or n.tag in tags]


def only(node: Node | None, *tags: str) -> Node | None:
    """The first child of the first tag that has one."""
    return None if node is None else next((found for tag in tags if (found := node.find(tag)) is not None), None)


def below(node: Node | None, tag: str) -> list[Node]:
    return [] if node is None else [n for n in node.iter(tag) if n is not node]


def first_below(node: Node | None, *tags: str) -> Node | None:
    return None if node is None else next((n for tag in tags for n in node.iter(tag) if n is not node), None)


def attribute(node: Node | None, name: str) -> str | None:
    return None if node is None else node.get(name) or None


def link_of(node: Node | None) -> str | None:
    return attribute(node, "xlink:href") or attribute(node, "href")


def plain(node: Node | None) -> str:
    return "" if node is None else normalised("".join(node.itertext()))


def text_below(node: Node | None, *tags: str) -> str | None:
    """The first non-empty text among the first elements of each tag."""
    return next((t for tag in tags if (t := plain(first_below(node, tag)))), None)


class SpanText:
    """Text under construction: blanks collapse as pieces come, and what is written stays."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.length = 0
        self._blank = True

    def add(self, raw: str) -> None:
        piece = _BLANKS.sub(" ", raw)
        if self._blank and piece.startswith(" "):
            piece = piece[1:]
        if piece:
            self.parts.append(piece)
            self.length += len(piece)
            self._blank = piece.endswith(" ")

    def text(self) -> str:
        return "".join(self.parts).rstrip(" ")


def inline(node: Node) -> tuple[str, list[dict]]:
    """A paragraph's text and its marks, inner ones first."""
    text, marks = SpanText(), []

    def mark(kind: str, start: int, **more: str | None) -> None:
        marks.append({"type": kind, "start": start, "end": text.length, "rid": None, "ref_type": None, "href": None} | more)

    def walk_all(n: Node) -> None:
        if n.text:
            text.add(n.text)
        for c in n:
            if c.tag not in _NOT_IN_TEXT:
                walk(c)
            if c.tail:
                text.add(c.tail)

    def walk(n: Node) -> None:
        tag, start = n.tag, text.length
        if tag == "list":
            for item in elements(n, "list-item"):
                start = text.length
                walk_all(item)
                if text.length > start:
                    mark("list-item", start)
                    text.add(" ")
            return
        formula = tag in ("inline-formula", "disp-formula")
        tex = first_below(n, "tex-math") if formula else None
        if tex is not None:
            text.add(plain(tex))
        else:
            walk_all(n)
        if tag == "xref":
            mark("xref", start, rid=attribute(n, "rid"), ref_type=attribute(n, "ref-type"))
        elif tag in ("ext-link", "uri"):
            mark("ext-link", start, href=link_of(n))
        elif formula:
            mark("formula", start)
        elif tag in _MARKS:
            mark(tag, start)

    walk_all(node)
    whole = text.text()
    for m in marks:
        m["start"], m["end"] = min(m["start"], len(whole)), min(m["end"], len(whole))
    return whole, [m for m in marks if m["end"] > m["start"]]


def paragraph(node: Node, key: str) -> dict:
    text, marks = inline(node)
    ids: dict[str, list[str]] = {"bibr": [], "fig": [], "table": []}
    for m in marks:
        if m["type"] == "xref" and m["rid"] and m["ref_type"] in ids:
            ids[m["ref_type"]] += [r for r in _BLANKS.split(m["rid"]) if r and r not in ids[m["ref_type"]]]
    ids = {k: list(dict.fromkeys(v)) for k, v in ids.items()}
    breaks = [m["start"] for m in marks if m["type"] == "list-item"]
    citations = [(m["start"], m["end"]) for m in marks if m["type"] == "xref" and m["ref_type"] in ("bibr", None)]
    spans = sentence_spans(text, breaks, citations)
    return {
        "paragraph_id": key, "xml_id": attribute(node, "id"), "text": text, "marks": marks,
        "ref_ids": ids["bibr"], "fig_ids": ids["fig"], "table_ids": ids["table"],
        "sentences": [{"sentence_id": f"{key}-s{k}", "start": a, "end": b} for k, (a, b) in enumerate(spans, 1)],
    }


def _paragraphs(node: Node, key: str) -> list[dict]:
    """Direct paragraphs with text; numbers count the empty ones too."""
    return [p for k, n in enumerate(elements(node, "p"), 1) if (p := paragraph(n, f"{key}-p{k}"))["text"]]


def _section(key: str, node: Node | None, title: str | None, level: int, kind: str, paragraphs: list[dict], sections: list[dict]) -> dict:
    return {"section_id": key, "xml_id": attribute(node, "id"), "title": title, "level": level, "type": kind, "paragraphs": paragraphs, "sections": sections}


def _sections(node: Node, prefix: str, level: int, parent: str | None, warnings: list[str]) -> list[dict]:
    out = []
    for k, n in enumerate(elements(node, "sec"), 1):
        key = f"{prefix}-{k}" if prefix else f"s{k}"
        heading = only(n, "title")
        title = plain(heading) if heading is not None else None
        kind = section_type(title, attribute(n, "sec-type"), level, parent)
        if not title and level == 1:
            warnings.append(f"{key}: untitled top-level section")
        out.append(_section(key, n, title, level, kind, _paragraphs(n, key), _sections(n, key, level + 1, kind, warnings)))
    return out


def _figures(root: Node) -> list[dict]:
    return [
        {"xml_id": attribute(f, "id"), "label": plain(only(f, "label")) or None, "caption": plain(only(f, "caption")) or None, "graphics": [h for g in below(f, "graphic") if (h := link_of(g))]}
        for f in below(root, "fig")
    ]


def _tables(root: Node) -> list[dict]:
    out = []
    for wrap in below(root, "table-wrap"):
        table = first_below(wrap, "table")
        cells = lambda tr: [plain(c) for c in elements(tr, "td", "th")]
        rows = below(table, "tr")
        inside = {tr for thead in below(table, "thead") for tr in below(thead, "tr")}
        head = [r for tr in rows if tr in inside and (r := cells(tr))]
        body = [r for tr in rows if tr not in inside and (r := cells(tr))]
        out.append({
            "xml_id": attribute(wrap, "id"), "label": plain(only(wrap, "label")) or None, "caption": plain(only(wrap, "caption")) or None,
            "rows": head + body, "header_rows": len(head), "footnotes": [t for n in below(wrap, "fn") if (t := plain(n))],
        })
    return out


def _references(root: Node) -> list[dict]:
    out = []
    for ref in (r for refs in below(root, "ref-list") for r in elements(refs, "ref")):
        cite = only(ref, "element-citation", "mixed-citation", "citation")
        source = ref if cite is None else cite
        ids = {kind: text for n in reversed(below(ref, "pub-id")) if (kind := attribute(n, "pub-id-type")) and (text := plain(n))}
        names = [", ".join(filter(None, (plain(only(n, "surname")), plain(only(n, "given-names"))))) for n in below(source, "name")]
        pages = [p for tag in ("fpage", "lpage") if (p := text_below(source, tag))]
        out.append({
            "xml_id": attribute(ref, "id"), "label": plain(only(ref, "label")) or None, "authors": names,
            "title": text_below(source, "article-title", "chapter-title"), "source": text_below(source, "source"), "year": text_below(source, "year"),
            "volume": text_below(source, "volume"), "pages": "–".join(pages) or None, "doi": ids.get("doi"), "pmid": ids.get("pmid"),
            "raw": (plain(source) or None) if cite is None or cite.tag == "mixed-citation" else None,
        })
    return out


def _authors(meta: Node, warnings: list[str]) -> list[dict]:
    places: dict[str, str] = {}
    for aff in below(meta, "aff"):
        if key := attribute(aff, "id"):
            text, label = plain(aff), plain(only(aff, "label"))
            places[key] = text[len(label) :].strip() if label and text.startswith(label) else text
    out = []
    for c in (c for group in below(meta, "contrib-group") for c in elements(group, "contrib")):
        if attribute(c, "contrib-type") not in (None, "author"):
            continue
        name = only(c, "name", "string-name")
        surname, given = plain(only(name, "surname")) or None, plain(only(name, "given-names")) or None
        full = " ".join(filter(None, (given, surname))) or plain(name) or plain(only(c, "collab"))
        if not full:
            continue
        links = [(attribute(x, "ref-type"), attribute(x, "rid") or "") for x in below(c, "xref")]
        found = [places[r] for kind, rid in links if kind == "aff" for r in _BLANKS.split(rid) if places.get(r)]
        if not found and len(places) == 1:
            found = list(places.values())
        orcid = next((n for n in below(c, "contrib-id") if attribute(n, "contrib-id-type") == "orcid"), None)
        out.append({"surname": surname, "given_names": given, "full": full, "orcid": plain(orcid) or None, "affiliations": found, "corresponding": attribute(c, "corresp") == "yes" or any(kind == "corresp" for kind, _ in links)})
    if not out:
        warnings.append("no authors")
    return out


def _funding(meta: Node | None) -> list[str]:
    out = []
    for group in below(meta, "funding-group"):
        for award in below(group, "award-group"):
            out.append(" — ".join(filter(None, (text_below(award, "institution", "funding-source"), text_below(award, "award-id")))))
        out.append(text_below(group, "funding-statement") or "")
    return [x for x in out if x]


def _meta(article: Node, warnings: list[str]) -> dict:
    front = only(article, "front")
    journal, meta = only(front, "journal-meta"), only(front, "article-meta")
    ids = below(meta, "article-id")
    found = lambda kind: plain(next((n for n in ids if attribute(n, "pub-id-type") == kind), None)) or None
    dates = below(meta, "pub-date")
    wanted = ([d for d in dates if attribute(d, "pub-type") == "epub"], [d for d in dates if attribute(d, "date-type") == "pub"], dates)
    date = next((found[0] for found in wanted if found), None)
    year = plain(only(date, "year")) or None
    licence = first_below(meta, "license")
    title = text_below(only(meta, "title-group"), "article-title")
    out = {
        "doi": found("doi"), "pmid": found("pmid"), "pmcid": found("pmc") or found("pmcid"), "title": title,
        "journal": text_below(journal, "journal-title", "abbrev-journal-title"), "issn": text_below(journal, "issn"), "publisher": text_below(journal, "publisher-name"),
        "year": year, "pub_date": f"{year}-{plain(only(date, 'month')).rjust(2, '0')}-{plain(only(date, 'day')).rjust(2, '0')}" if year else None,
        "volume": plain(only(meta, "volume")) or None, "issue": plain(only(meta, "issue")) or None, "fpage": plain(only(meta, "fpage")) or None,
        "article_type": attribute(article, "article-type"), "keywords": [t for n in below(meta, "kwd") if (t := plain(n))],
        "authors": _authors(meta, warnings) if meta is not None else [],
        "license_url": link_of(licence) or next((h for n in below(licence, "ext-link") if (h := link_of(n)) and _LICENCE_LINK.search(h)), None),
        "license_text": plain(licence) or None, "funding": _funding(meta),
    }
    warnings += [f"no {k}" for k in ("doi", "title") if not out[k]]
    return out


def _abstract(meta: Node | None, warnings: list[str]) -> list[dict]:
    node = next((a for a in below(meta, "abstract") if not attribute(a, "abstract-type")), None)
    if node is None:
        return []
    structured = _sections(node, "abs", 1, "abstract", warnings)
    if structured:
        return [s | {"type": "abstract"} for s in structured]
    loose = _paragraphs(node, "abs")
    return [_section("abs", None, plain(only(node, "title")) or "Abstract", 1, "abstract", loose, [])] if loose else []


def _back(node: Node, warnings: list[str]) -> list[dict]:
    out: list[dict] = []
    for n in (x for c in elements(node) for x in (elements(c, "app") if c.tag == "app-group" else [c])):
        if n.tag not in BACK_ELEMENTS or attribute(n, "sec-type") in SKIPPED_BACK_TYPES:
            continue
        key, title = f"b{len(out) + 1}", plain(only(n, "title")) or None
        kind = notes_type(attribute(n, "notes-type")) or BACK_ELEMENTS[n.tag] or section_type(title, attribute(n, "sec-type"), 1, None)
        section = _section(key, n, title, 1, kind, _paragraphs(n, key), _sections(n, key, 2, kind, warnings))
        if section["paragraphs"] or section["sections"]:
            out.append(section)
    return out


def _pruned(sections: list[dict]) -> list[dict]:
    kept = [s | {"sections": _pruned(s["sections"])} for s in sections]
    return [s for s in kept if s["paragraphs"] or s["sections"]]


def audit(types: list[str], article_type: str | None) -> list[str]:
    """What the top-level types of an article lack."""
    out = []
    if article_type not in FREE_FORM_TYPES:
        excused = ("methods", "results") if "case" in types else ()
        out = [f"missing section: {k}" for k in REQUIRED_TYPES if k not in types and k not in excused]
    n = types.count("other")
    return out + ([f"most sections are other: {n}/{len(types)}"] if 2 * n > len(types) else [])


def slug(doi: str | None, fallback: str = "unknown") -> str:
    return re.sub(r"[^a-zA-Z0-9]+", "-", re.sub(r"^https?://(dx\.)?doi\.org/", "", doi)) if doi else fallback


def _flavor(meta: dict) -> str:
    if meta["pmcid"]:
        return "pmc-jats"
    publisher = (meta["publisher"] or "").lower()
    return next((f"{k}-jats" for k in ("mdpi", "frontiers", "elsevier") if k in publisher), "jats")


def _flat(sections: list[dict], part: str, parent: str | None, path: list[int], out: dict[str, list]) -> None:
    for k, s in enumerate(sections):
        own = [*path, k]
        out["sections"].append({x: s[x] for x in ("section_id", "xml_id", "title", "level", "type")} | {"parent_id": parent, "part": part, "path": own, "ord": len(out["sections"])})
        for p in s["paragraphs"]:
            out["paragraphs"].append(p | {"section_id": s["section_id"], "section_type": s["type"], "section_title": s["title"], "part": part, "ord": len(out["paragraphs"])})
        _flat(s["sections"], part, s["section_id"], own, out)


class _Mender(HTMLParser):
    """Reads what is not well-formed: an end tag closes its element and all within, one without a start is left out, and the end closes the rest."""

    CDATA_CONTENT_ELEMENTS = ()
    RCDATA_CONTENT_ELEMENTS = ()

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.builder = ET.TreeBuilder()
        self.open: list[str] = []
        self.begun = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.open or not self.begun:
            self.builder.start(tag, {name: value or "" for name, value in attrs})
            self.open.append(tag)
            self.begun = True

    def handle_endtag(self, tag: str) -> None:
        if tag in self.open:
            while self.open[-1] != tag:
                self.builder.end(self.open.pop())
            self.builder.end(self.open.pop())

    def handle_data(self, data: str) -> None:
        if self.open:
            self.builder.data(data)

    def root(self) -> Node | None:
        self.close()
        while self.open:
            self.builder.end(self.open.pop())
        return self.builder.close() if self.begun else None


_DECLARED = re.compile(r"""xmlns(?::([^\s=]+))?\s*=\s*(?:"([^"]*)"|'([^']*)')""")
_ENCODING = re.compile(r"""\s*<\?xml[^>]*encoding\s*=\s*["'](?!utf-8["'])""", re.I)


def _prefixes(xml: str) -> dict[str, str] | None:
    """Namespaces by prefix if each has one prefix throughout and none is the default, so that a name's namespace tells its prefix; None if not, or
    if declarations could change what names and attributes there are."""
    declared = _DECLARED.findall(xml)
    pairs = {(prefix, a or b) for prefix, a, b in declared}
    found = dict(pairs)
    odd = "" in found or not len(found) == len(pairs) == len(set(found.values())) or any(not uri or " " in uri or "&" in uri for uri in found.values())
    return None if odd or xml.count("xmlns") != len(declared) or "<!ATTLIST" in xml or "<!ENTITY" in xml or _ENCODING.match(xml) else found


def _read_plain(xml: str) -> Node | None:
    """A document whose names can be told without their prefixes, by the compiled reader; None if it has to be read name by name."""
    prefixes = _prefixes(xml)
    if prefixes is None:
        return None
    try:
        root = ET.fromstring(xml.encode())
    except (ET.ParseError, ValueError, LookupError):
        return None
    if "xlink" in prefixes:
        link = f"{{{prefixes['xlink']}}}href"
        for tag in _LINKED:
            for n in root.iter(tag):
                if (href := n.get(link)) is not None:
                    n.set("xlink:href", href)
    return root


def _qualified(name: str) -> str:
    """A name as it is written; the reader gives namespace, local name and prefix, with blanks between."""
    if " " not in name:
        return name
    _, local, *prefix = name.split(" ")
    if len(prefix) > 1:
        raise ValueError(f"Unsupported syntax: spaces in URIs not supported: {name!r}")
    return f"{prefix[0]}:{local}" if prefix else local


def _read_named(xml: bytes) -> Node:
    """A well-formed document with its names as they are written; CDATA is text, comments and instructions are left out."""
    builder = ET.TreeBuilder()
    parser = expat.ParserCreate(namespace_separator=" ")
    parser.namespace_prefixes = parser.buffer_text = parser.specified_attributes = True
    parser.StartElementHandler = lambda name, attributes: builder.start(_qualified(name), {_qualified(k): v for k, v in attributes.items()})
    parser.EndElementHandler = lambda name: builder.end(_qualified(name))
    parser.CharacterDataHandler = builder.data
    parser.ExternalEntityRefHandler = lambda *_: 1
    parser.Parse(xml, True)
    return builder.close()


def _read(xml: str | bytes, warnings: list[str]) -> Node | None:
    if isinstance(xml, str) and (root := _read_plain(xml)) is not None:
        return root
    try:
        return _read_named(xml.encode() if isinstance(xml, str) else xml)
    except expat.ExpatError as e:
        warnings.append(f"not well-formed: {e}")
        mender = _Mender()
        mender.feed(xml if isinstance(xml, str) else xml.decode("utf-8", "replace"))
        return mender.root()


def read_document(xml: str | bytes, warnings: list[str]) -> Node | None:
    """The document's root; what is not well-formed is mended as far as it goes, with a warning."""
    root = _read(xml, warnings)
    begun = xml.count("<" if isinstance(xml, str) else b"<")
    depth, level = 0, [] if root is None or begun < MAX_DEPTH else [root]
    while level:
        depth, level = depth + 1, [c for n in level for c in n]
    if depth > MAX_DEPTH:
        raise RecursionError("maximum recursion depth exceeded")
    return root


def parse_article(xml: str | bytes, fallback: str = "unknown", columns: tuple[str, ...] = ("figures", "tables", "references")) -> dict:
    """One article as flat lists, of the first article element; raises ValueError if there is none to be read. Of figures, tables and references only those in columns are looked for."""
    warnings: list[str] = []
    document = read_document(xml, warnings)
    article = None if document is None else next(document.iter("article"), None)
    if article is None:
        raise ValueError("; ".join(["no article element", *warnings]))
    meta = _meta(article, warnings)
    abstract = _abstract(only(only(article, "front"), "article-meta"), warnings)
    body, back = only(article, "body"), only(article, "back")
    sections: list[dict] = []
    if body is not None:
        sections = _sections(body, "", 1, None, warnings)
        if loose := _paragraphs(body, "s0"):
            sections.insert(0, _section("s0", None, None, 1, "other", loose, []))
            warnings.append("paragraphs outside sections: s0")
    else:
        warnings.append("no body")
    if back is not None:
        sections += _back(back, warnings)
    sections = _pruned(sections)
    warnings += audit([s["type"] for s in sections if not s["section_id"].startswith("b")], meta["article_type"])
    out: dict[str, list] = {"sections": [], "paragraphs": []}
    _flat(abstract, "abstract", None, [], out)
    _flat(sections, "sections", None, [], out)
    return {
        "article_id": slug(meta["doi"], fallback), "meta": meta, **out, **{k: find(article) for k, find in (("figures", _figures), ("tables", _tables), ("references", _references)) if k in columns},
        "warnings": warnings, "flavor": _flavor(meta),
    }
