"""Raw documents to sections: JATS and Atom XML in Arrow functions, JSON documents natively, dispatched by source.

A document that can't be parsed has no sections; it never breaks a batch.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECTIONS = "array<struct<sec_type:string,sec_title:string,text:string,n_figures:int,n_tables:int>>"
# Name spaces of Atom feeds and of their extension.
ATOM, ARXIV = "{http://www.w3.org/2005/Atom}", "{http://arxiv.org/schemas/atom}"


def _flat(parts) -> str:
    return re.sub(r"\s+", " ", "".join(parts)).strip()


def _inner(node: ET.Element | None) -> str:
    return "" if node is None else _flat(node.itertext())


def _root(xml: str | None) -> ET.Element | None:
    try:
        return ET.fromstring(xml or "")
    except ET.ParseError:
        return None


def _section(kind: str, title: str | None, text: str, at: ET.Element | None = None) -> dict:
    count = lambda tag: 0 if at is None else len(at.findall(tag))
    return {"sec_type": kind, "sec_title": title, "text": text, "n_figures": count("fig"), "n_tables": count("table-wrap")}


def _own_text(node: ET.Element) -> str:
    """Of the paragraphs right below, not of the sections inside."""
    return _flat(" ".join(_inner(p) for p in node.findall("p")))


def jats(xml: str | None) -> list[dict]:
    """Title, abstracts, then body: paragraphs outside sections first, then each section with text of its own, headings joined by ' > '."""
    root = _root(xml)
    if root is None:
        return []
    article = root if root.tag == "article" else root.find(".//article")
    article = root if article is None else article
    out = [_section("title", None, t)] if (t := _inner(article.find(".//front//article-title"))) else []
    out += [_section("abstract", a.get("abstract-type") or "abstract", t) for a in article.findall(".//front//abstract") if (t := _inner(a))]
    body = article.find(".//body")
    if body is None:
        return out
    if text := _own_text(body):
        out.append(_section("body", None, text, body))
    todo = [(s, ()) for s in reversed(body.findall("sec"))]
    while todo:  # depth first, in the order of the document
        sec, above = todo.pop()
        path = (*above, t) if (t := _inner(sec.find("title"))) else above
        if text := _own_text(sec):
            out.append(_section("body", " > ".join(path) or None, text, sec))
        todo += [(s, path) for s in reversed(sec.findall("sec"))]
    return out


def jats_meta(xml: str | None) -> dict:
    """title, journal, doi, pmid, pmcid, pub_year, authors of an article; {} if it can't be parsed."""
    root = _root(xml)
    if root is None:
        return {}
    article = root if root.tag == "article" else root.find(".//article")
    article = root if article is None else article
    ids: dict[str, str | None] = {}
    for e in article.findall(".//front//article-id"):
        ids.setdefault(e.get("pub-id-type") or "", (e.text or "").strip() or None)
    pmc = ids.get("pmc") or ids.get("pmcid")
    people = [" ".join(p for p in (_inner(c.find(".//given-names")), _inner(c.find(".//surname"))) if p) for c in article.findall(".//front//contrib[@contrib-type='author']")]
    return {
        "title": _inner(article.find(".//front//article-title")), "journal": _inner(article.find(".//front//journal-title")), "doi": ids.get("doi"), "pmid": ids.get("pmid"),
        "pmcid": f"PMC{pmc.removeprefix('PMC')}" if pmc else None, "pub_year": _inner(article.find(".//front//pub-date/year")) or None, "authors": [p for p in people if p],
    }


def _child(entry: ET.Element, path: str) -> str | None:
    e = entry.find(path)
    return e.text.strip() if e is not None and e.text else None


def atom_meta(entry: ET.Element) -> dict:
    published, primary = _child(entry, f"{ATOM}published"), entry.find(f"{ARXIV}primary_category")
    return {
        "arxiv_id": (_child(entry, f"{ATOM}id") or "").rsplit("/", 1)[-1], "title": " ".join((_child(entry, f"{ATOM}title") or "").split()), "abstract": " ".join((_child(entry, f"{ATOM}summary") or "").split()),
        "authors": ", ".join(a.text.strip() for a in entry.findall(f"{ATOM}author/{ATOM}name") if a.text), "doi": _child(entry, f"{ARXIV}doi"), "journal": _child(entry, f"{ARXIV}journal_ref"),
        "primary_category": None if primary is None else primary.get("term"), "categories": ",".join(t for c in entry.findall(f"{ATOM}category") if (t := c.get("term"))),
        "pub_year": published[:4] if published else None, "published": published, "pdf_url": next((x.get("href") for x in entry.findall(f"{ATOM}link") if x.get("title") == "pdf"), None),
    }


def atom(xml: str | None) -> list[dict]:
    """Title, abstract, and the full text that was put into the entry."""
    entry = _root(xml)
    if entry is None:
        return []
    meta = atom_meta(entry)
    out = [_section(kind, label, meta[key]) for kind, label, key in (("title", None, "title"), ("abstract", "abstract", "abstract")) if meta[key]]
    full = entry.find(f"{ARXIV}fulltext")
    return [*out, _section("body", "full text", full.text)] if full is not None and full.text else out


def with_full_text(entry: ET.Element, text: str) -> None:
    """Put a full text into an entry, without characters that XML can't hold."""
    node = entry.find(f"{ARXIV}fulltext")
    node = ET.SubElement(entry, f"{ARXIV}fulltext") if node is None else node
    text = re.sub(r"[ \t]+", " ", re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", " ", text))
    node.text = re.sub(r"\n{3,}", "\n\n", text).strip()


def json_sections(raw: Column) -> Column:
    """Title and abstract of a JSON document."""
    doc = F.from_json(raw, "title string, abstract string")
    make = lambda kind, label, text: F.struct(F.lit(kind).alias("sec_type"), F.lit(label).cast("string").alias("sec_title"), text.alias("text"), F.lit(0).alias("n_figures"), F.lit(0).alias("n_tables"))
    return F.filter(F.array(make("title", None, doc["title"]), make("abstract", "abstract", doc["abstract"])), lambda s: s["text"].isNotNull() & (s["text"] != ""))


def _arrow(parse: Callable[[str | None], list[dict]]) -> Callable[[Column], Column]:
    def run(raw: pd.Series) -> pd.Series:
        return raw.map(parse)

    return lambda raw: F.pandas_udf(run, SECTIONS)(raw)


#: Sources and how their documents become sections; any other source is JATS.
PARSERS: dict[str, Callable[[Column], Column]] = {"arxiv": _arrow(atom)} | dict.fromkeys(["openalex", "patents", "surechembl", "epo_ops", "google_patents"], json_sections)
_JATS = _arrow(jats)


def parsed(docs: DataFrame, raw: str = "raw_xml", source: str = "source") -> DataFrame:
    """docs with an array of sections. Sources that share a parser are parsed together; each row is parsed once."""
    groups: dict[Callable, list[str]] = {}
    for name, parse in PARSERS.items():
        groups.setdefault(parse, []).append(name)
    named = F.coalesce(F.col(source), F.lit(""))
    out = docs.filter(~named.isin(list(PARSERS))).withColumn("sections", _JATS(F.col(raw)))
    for parse, names in groups.items():
        out = out.unionByName(docs.filter(named.isin(names)).withColumn("sections", parse(F.col(raw)).cast(SECTIONS)))
    return out
