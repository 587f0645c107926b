"""Journal articles in XML (JATS) as tree nodes, and their metadata.

Bodies hold text and elements mixed, so each article is walked once (``articles``); titles, authors and the like are
looked up by path in columns (``metadata``).
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.sources.html_tables import Tables, placed
from vellum.sources.markup import NODES, Nodes

#: Elements whose text is left out, those that end the text before them, and headings where a section has none.
SILENT = {"term", "disp-formula", "inline-formula"}
BREAKS = {"ack", "sec", "list", "boxed-text", "disp-formula", "fig"}
ABSTRACT, THANKS, REFERENCES, AND_OTHERS = "Abstract", "Acknowledgments", "References", "et al."
#: Where titles of a work and of what a citation names are found.
TITLE_GROUPS, TITLES = ["article-meta", "collection-meta", "book-meta", "book-part-meta"], ["article-title", "subtitle", "title", "label"]
CITED = ["article-title", "chapter-title", "data-title", "issue-title", "part-title", "trans-title"]


def flat(text: str | None) -> str:
    return (text or "").replace("\n", " ")


def text_of(node: ET.Element | None) -> str:
    """All text in an element, without formulas and terms."""
    if node is None:
        return ""
    own = flat(node.text) if node.tag not in SILENT else ""
    return own + "".join((text_of(c) if c.tag not in SILENT else "") + flat(c.tail) for c in node)


def first(node: ET.Element, *names: str) -> ET.Element | None:
    return next((found for found in (node.find(n) for n in names) if found is not None), None)


def word(node: ET.Element, *names: str) -> str:
    found = first(node, *names)
    return "" if found is None else flat(found.text).strip()


def captioned(node: ET.Element) -> str:
    """Label and caption of a figure or table, without supplements."""
    caption = node.find("caption")
    parts = [] if caption is None else [text_of(c).strip() for c in caption if c.find(".//supplementary-material") is None]
    return " ".join(p for p in [text_of(node.find("label")).strip(), *parts] if p)


def citation(node: ET.Element) -> str:
    """A citation of named elements as one line: names, title, source, publisher, volume:pages (year), identifiers."""
    names = [f"{word(n, 'surname')} {word(n, 'given-names')}".strip() for n in node.iter("name")]
    others = node.find(".//etal")
    if others is not None:
        names.append(others.text or AND_OTHERS)
    title = first(node, *CITED)
    place, publisher = word(node, "publisher-loc"), word(node, "publisher-name")
    sentences = [", ".join(names).rstrip("."), (text_of(title) if title is not None else flat(node.text).strip()), word(node, "source")]
    if publisher:
        sentences.append(f"{place}: {publisher}" if place else publisher)
    out = "".join(f"{s}. " for s in sentences if s)
    volume, page, year = word(node, "volume"), word(node, "elocation-id"), word(node, "year")
    if not page and node.find("fpage") is not None:
        page = word(node, "fpage") + ("–" + word(node, "lpage") if node.find("lpage") is not None else "")
    if volume:
        out = f"{out.rstrip('. ')} {volume}. "
    if page:
        out = out.rstrip(". ") + (":" if volume else "") + page + ". "
    if year:
        out = f"{out.rstrip('. ')} ({year})."
    ids = [(i.get("assigning-authority") or i.get("pub-id-type"), i.text) for i in node.findall("pub-id")]
    named = ", ".join(f"{flat(kind).strip().upper()}: {flat(text).strip()}" for kind, text in ids if kind and text)
    return out.rstrip(".") + ". " + named if named else out


class ArticleWalk(Nodes):
    def __init__(self, article: ET.Element) -> None:
        super().__init__()
        self.level = 0
        self.root = self.add("title", self.title(article))
        self.front(article)
        for part in ("body", "back"):
            found = next(article.iter(part), None)
            if found is not None:
                self.walk(found, self.root, None)

    @staticmethod
    def title(article: ET.Element) -> str:
        groups = [g for name in TITLE_GROUPS for meta in article.iter(name) for g in meta.findall("title-group")]
        return " - ".join(" ".join(flat(t.text).strip() for t in g if t.tag in TITLES).strip() for g in groups)

    def front(self, article: ET.Element) -> None:
        meta = next((m for name in ("article-meta", "book-part-meta") for m in article.iter(name)), None)
        if meta is not None:
            places = {}
            for aff in meta.iter("aff"):
                label = aff.find("label")
                text = flat(", ".join(t for t in aff.itertext() if t.strip()))
                places[aff.get("id")] = text.removeprefix(f"{label.text}, ") if label is not None else text
            authors = [c for group in meta.iter("contrib-group") for c in group.findall("contrib") if c.get("contrib-type") == "author"]
            names = [f"{word(a, 'name/given-names')} {word(a, 'name/surname')}".strip() for a in authors]
            at = [places[x.get("rid")] for a in authors for x in a.findall("xref") if x.get("ref-type") == "aff" and x.get("rid") in places]
            for line in (", ".join(n for n in names if n), "; ".join(dict.fromkeys(at))):
                if line:
                    self.add("paragraph", line, self.root)
        for abstract in article.iter("abstract"):
            text = " ".join(text_of(p).strip() for p in abstract.findall("p"))
            if text:
                heading = self.add("section_header", word(abstract, "title", "label") or ABSTRACT, self.root, self.level + 1)
                self.add("text", text, heading)

    def figure(self, node: ET.Element, parent: int) -> None:
        at = self.add("picture", "", parent)
        if text := captioned(node):
            self.add("caption", text, at)

    def table(self, node: ET.Element, parent: int) -> None:
        found, reader = first(node, "table", "alternatives/table"), Tables()
        if found is not None:
            reader.feed(ET.tostring(found, encoding="unicode"))
            reader.close()
        for rows in reader.found:
            slots: dict[int, dict[int, str]] = {}
            for _, row, down, column, across, _, _, text in placed(rows):
                for r in range(row, row + down):
                    slots.setdefault(r, {}).update({c: text.replace("|", "/") for c in range(column, column + across)})
            at = self.add("table", "\n".join("|" + "|".join(slots[r].get(c, "") for c in range(max(slots[r]) + 1)) + "|" for r in sorted(slots)), parent)
            if text := captioned(node):
                self.add("caption", text, at)

    def cited(self, text: str, parent: int) -> None:
        self.add("list_item" if self.rows[parent][3] == "list" else "text", text, parent)

    def opened(self, child: ET.Element, within: str, parent: int, now: int) -> tuple[int, bool, bool]:
        """(what the rest hangs on, whether to go into the child, whether it is a section with a heading)."""
        match child.tag:
            case "sec" | "ack":
                head = first(child, "title", "label")
                text = text_of(head) if head is not None else THANKS if child.tag == "ack" else ""
                if text:
                    self.level += 1
                    return self.add("section_header", text, parent, self.level), True, True
            case "list":
                return self.add("list", "", parent), True, False
            case "list-item":
                return self.add("list_item", text_of(child).strip(), parent), False, False
            case "fig":
                self.figure(child, parent)
                return now, False, False
            case "table-wrap":
                self.table(child, parent)
                return now, False, False
            case "ref-list" if within != "ref-list":
                head = first(child, "title", "label")
                heading = self.add("section_header", text_of(head) if head is not None else REFERENCES, parent, 1)
                return self.add("list", "", heading), True, False
            case "element-citation":
                self.cited(citation(child), parent)
                return now, False, False
            case "mixed-citation":
                self.cited(text_of(child).strip(), parent)
                return now, False, False
            case "tex-math":
                parts = (child.text or "").split("$$")
                if len(parts) == 3:
                    self.add("formula", parts[1], parent)
                return now, False, False
            case "fn-group" | "suplementary-material" | "inline-formula":
                return now, False, False
        return now, True, False

    def walk(self, node: ET.Element, parent: int, above: str | None) -> str:
        """Nodes of what is in an element; the text that no paragraph in it has taken.

        Siblings after a section or list hang on it as well, unless they open one of their own.
        """
        text, now = flat(node.text) if node.tag != "term" else "", parent
        for child in node:
            if node.tag == "p" and text.strip() and child.tag in BREAKS:
                self.add("text", text.strip(), parent)
                text = ""
            if child.tag in ("title", "label") and node.tag in ("sec", "ack", "ref-list"):
                text += flat(child.tail)
                continue
            now, inside, section = self.opened(child, node.tag, parent, now)
            if inside:
                more = self.walk(child, now, node.tag)
                if not (above == "p" and node.tag in BREAKS):
                    text += more
                self.level -= section
            text += flat(child.tail)
        if node.tag == "p" and text.strip():
            self.add("text", text.strip(), parent)
            return ""
        return text


def articles(files: DataFrame) -> DataFrame:
    """``NODES`` rows of articles (doc_id, text): title, authors, abstract, sections, lists, figures, tables (rows between bars), formulas and references.

    A text that is no XML is one node ``invalid`` with the reason; a null text has no nodes.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.doc_id, batch.text, strict=True):
                if text is None:
                    continue
                try:
                    found = ArticleWalk(ET.fromstring(text)).rows
                except ET.ParseError as why:
                    found = [(0, None, 0, "invalid", "body", 0, 1, str(why), None, None)]
                out += [(doc_id, *row) for row in found]
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in NODES.split(", ")])
            yield frame.astype({"parent_id": "Int64"})

    return files.select("doc_id", "text").mapInPandas(run, NODES)


def metadata(files: DataFrame) -> DataFrame:
    """(doc_id, title, surnames, year, sections, references) of articles, by path."""
    xml = F.col("text")
    path: Column = lambda p: F.xpath_string(xml, F.lit(p))
    return files.select(
        "doc_id", path("normalize-space(//article-meta/title-group/article-title)").alias("title"), F.xpath(xml, F.lit("//article-meta/contrib-group/contrib[@contrib-type='author']/name/surname/text()")).alias("surnames"),
        path("//article-meta/pub-date[1]/year").alias("year"), F.xpath_long(xml, F.lit("count(//body//sec)")).alias("sections"), F.xpath_long(xml, F.lit("count(//ref)")).alias("references"),
    )
