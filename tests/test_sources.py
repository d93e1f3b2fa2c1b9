import io
import json
import urllib.error
import xml.etree.ElementTree as ET

import pytest
import seed

from corpusengine.sources import connectors as C
from corpusengine.sources import flatten, net, parsers


def one(spark, f, payload, **keys):
    names = ["raw", *keys]
    df = spark.createDataFrame([(json.dumps(payload), *keys.values())], ", ".join(f"{n} string" for n in names))
    return [r.asDict() for r in f(df).collect()]


def test_jats():
    secs = parsers.jats(seed.article(extra="<fig/><fig/><table-wrap/><sec><title>Sub</title><p>Inner text.</p></sec><sec><title>Empty</title><sec><p>Deep.</p></sec></sec>"))
    assert [(s["sec_type"], s["sec_title"]) for s in secs] == [("title", None), ("abstract", "abstract"), ("body", "Results"), ("body", "Results > Sub"), ("body", "Results > Empty")]
    assert (secs[2]["n_figures"], secs[2]["n_tables"]) == (2, 1) and secs[1]["text"] == "A study of fentanyl." and secs[4]["text"] == "Deep."
    assert parsers.jats("<not valid") == parsers.jats(None) == [] and parsers.jats_meta("<x") == {}
    meta = parsers.jats_meta(seed.article())
    assert meta == {"title": "Fentanyl pharmacology", "journal": "Journal of Tests", "doi": "10.1/x", "pmid": None, "pmcid": "PMC77", "pub_year": "2024", "authors": ["Jo Doe"]}
    assert [s["sec_title"] for s in parsers.jats("<article><body><p>Stray</p><sec><title>A</title><p>x</p></sec></body></article>")] == [None, "A"]


ENTRY = '<entry xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom"><id>http://arxiv.org/abs/2401.1v1</id><title>A\n  title</title><summary>Some text</summary><published>2024-01-02T00:00:00Z</published><author><name>X Y</name></author><arxiv:doi>10.2/z</arxiv:doi><category term="q-bio"/><link title="pdf" href="http://p"/></entry>'


def test_atom():
    assert [s["sec_type"] for s in parsers.atom(ENTRY)] == ["title", "abstract"]
    e = ET.fromstring(ENTRY)
    parsers.with_full_text(e, "Full\x0c text\n\n\n\nend ")
    body = parsers.atom(ET.tostring(e, encoding="unicode"))[-1]
    assert (body["sec_title"], body["text"]) == ("full text", "Full text\n\nend")
    m = parsers.atom_meta(e)
    assert (m["arxiv_id"], m["title"], m["pub_year"], m["pdf_url"], m["doi"]) == ("2401.1v1", "A title", "2024", "http://p", "10.2/z")
    assert parsers.atom("<") == []


def test_dispatch(spark):
    df = spark.createDataFrame([("1", "arxiv", ENTRY), ("2", "openalex", '{"title":"T","abstract":""}'), ("3", "surechembl", "nonsense"), ("4", "europepmc", seed.article()), ("5", None, None)], "pmcid string, source string, raw_xml string")
    assert {r["pmcid"]: len(r["sections"] or []) for r in parsers.parsed(df).collect()} == {"1": 2, "2": 1, "3": 0, "4": 3, "5": 0}


def test_flatten_chembl(spark):
    m = {"molecule_chembl_id": "C1", "pref_name": "X", "max_phase": "4.0", "first_approval": "1968", "oral": True, "molecule_properties": {"full_mwt": "336.5", "hba": "2", "alogp": "n/a"}, "molecule_structures": {"standard_inchi_key": "K"}, "molecule_synonyms": [{"molecule_synonym": "Duragesic", "syn_type": "TRADE_NAME"}, {"molecule_synonym": "DURAGESIC", "syn_type": "TRADE_NAME"}, {"molecule_synonym": "code-1", "syn_type": "RESEARCH_CODE"}, {"molecule_synonym": " ", "syn_type": "INN"}]}
    got = one(spark, flatten.chembl_molecules, m)[0]
    assert (got["max_phase"], got["first_approval"], got["mw"], got["hba"], got["alogp"], got["inchi_key"], got["smiles"]) == (4.0, 1968, 336.5, 2, None, "K", None)
    assert one(spark, flatten.chembl_synonyms, m) == [{"chembl_id": "C1", "syn_type": "TRADE_NAME", "name": "Duragesic"}]
    assert one(spark, flatten.chembl_molecules, {})[0]["chembl_id"] is None and one(spark, flatten.chembl_synonyms, {}) == []


def test_flatten_trial(spark):
    s = {"protocolSection": {"identificationModule": {"nctId": "N1", "briefTitle": "T"}, "designModule": {"phases": ["PHASE2", "PHASE3"], "enrollmentInfo": {"count": 50}}, "armsInterventionsModule": {"interventions": [{"type": "DRUG", "name": "X"}, {"type": "DRUG"}]}, "conditionsModule": {"conditions": []}}}
    got = one(spark, flatten.clinical_trials, s)[0]
    assert (got["phases"], got["interventions"], got["conditions"], got["enrollment"], got["lead_sponsor"]) == ("PHASE2; PHASE3", "DRUG:X", None, 50, None)


def test_flatten_protein(spark):
    r = {"primaryAccession": "P1", "uniProtkbId": "E", "proteinDescription": {"recommendedName": {"fullName": {"value": "Mu receptor"}, "shortNames": [{"value": "MOR"}]}, "alternativeNames": [{"fullName": {"value": "Opioid receptor"}}]}, "genes": [{"geneName": {"value": "OPRM1"}, "synonyms": [{"value": "MOR"}, {"value": "MOR1"}]}], "comments": [{"commentType": "SUBUNIT"}, {"commentType": "FUNCTION", "texts": [{"value": "Binds."}]}], "uniProtKBCrossReferences": [{"database": "PDB", "id": "5C1M"}, {"database": "ChEMBL", "id": "T1"}, {"database": "PDB", "id": "8E0G"}], "sequence": {"length": 400}}
    got = one(spark, flatten.uniprot_proteins, r)[0]
    assert (got["aliases"], got["function"], got["pdb_ids"], got["chembl_target"], got["gene"], got["length"]) == ("Mu receptor; MOR; Opioid receptor; MOR1", "Binds.", "5C1M; 8E0G", "T1", "OPRM1", 400)
    assert one(spark, flatten.uniprot_proteins, {"primaryAccession": "P2", "proteinDescription": {"submissionNames": [{"fullName": {"value": "S"}}]}})[0]["protein_name"] == "S"


def test_flatten_others(spark):
    assert one(spark, flatten.binding_affinities, {"query": "T", "affinity": " >10.5", "affinity_type": "Ki", "pmid": ""}, accession="P")[0] | {} == {"accession": "P", "target": "T", "monomer_id": None, "smiles": None, "affinity_type": "Ki", "affinity_nm": 10.5, "pmid": None, "doi": None}
    assert one(spark, flatten.ensembl_genes, {"id": "E1", "start": 5, "strand": -1}, gene="G")[0]["strand"] == -1
    assert one(spark, flatten.pdb_structures, {"rcsb_entry_info": {"resolution_combined": [2.1]}}, pdb_id="X")[0]["resolution"] == 2.1
    assert one(spark, flatten.pubchem_compounds, {"CID": 1, "MolecularWeight": "18.0"}, query="w")[0]["mw"] == 18.0
    w = {"id": "https://openalex.org/W9", "doi": "https://doi.org/10.1/a", "title": "T", "abstract_inverted_index": {"b": [1], "a": [0]}, "authorships": [{"author": {"display_name": "A"}}, {"author": {}}], "concepts": [{"display_name": "C"}]}
    got = one(spark, flatten.openalex_works, w)[0]
    assert (got["id"], got["doi"], got["abstract"], got["authors"], got["concepts"]) == ("W9", "10.1/a", "a b", "A", "C")
    got = one(spark, flatten.patents, {"patent_id": "1", "patent_date": "2020-02-03", "assignees": [{"assignee_organization": "Org"}], "cpc_current": [{"cpc_group_id": "A61"}]})[0]
    assert (got["pub_year"], got["assignees"], got["keywords"]) == ("2020", "Org", "Org; A61")
    hit = {"pmcid": "PMC1", "journalInfo": {"journal": {"title": "J"}}, "meshHeadingList": {"meshHeading": [{"descriptorName": "M"}]}, "grantsList": {"grant": [{"agency": "B"}, {"agency": "A"}, {"agency": "B"}]}}
    got = one(spark, flatten.europepmc_hits, hit)[0]
    assert (got["journal"], got["mesh"], got["grants"], got["keywords"]) == ("J", "M", "A; B", None) and one(spark, flatten.europepmc_hits, {"pmid": "1"}) == []


def test_patent_chain(spark):
    compounds = spark.createDataFrame([(1, "K1"), (2, "K2")], "id long, inchi_key string")
    mapping = spark.createDataFrame([(1, 10), (1, 11), (2, 12), (1, 11)], "compound_id long, patent_id long")
    pats = spark.createDataFrame([(10, "US1", "US", "T", "2020-01-01", ["A"], ["O"]), (11, "US2", "US", "T", None, None, None), (12, "US3", "US", "T", "2024-01-01", [], [])], "id long, patent_number string, country string, title string, publication_date string, cpc array<string>, assignee array<string>")
    out = flatten.patents_disclosing(compounds, mapping, pats, spark.createDataFrame([("K1",), (None,)], "inchi_key string"), 5)
    assert [r["patent_number"] for r in out.collect()] == ["US1", "US2"]
    assert flatten.surechembl_patents(out).first()["pub_year"] == "2020"
    loc = "array<struct<language:string,text:string>>"
    g = spark.createDataFrame([("P1", "US", [("en", "Title")], [("de", "wort"), ("en", "A Word here")], 20200101, [("Org",)]), ("P2", "US", [], [("de", "word")], 1, [])], f"publication_number string, country_code string, title_localized {loc}, abstract_localized {loc}, publication_date int, assignee_harmonized array<struct<name:string>>")
    assert [r["patent_number"] for r in flatten.google_patents(g, "WORD%", 5).collect()] == ["P1"]
    assert flatten.ops_records({"a": [{"document-id": {"country": {"$": "EP"}, "doc-number": {"$": "1"}, "kind": {"$": "A1"}}}, {"invention-title": [{"$": "T"}]}]}) == [{"patent_number": "EP1A1", "country": "EP", "title": "T"}]


def test_publications_keep_their_own_titles():
    """A publication without a title doesn't take that of the next one."""
    ident = lambda n: {"document-id": [{"@document-id-type": "docdb", "country": {"$": "EP"}, "doc-number": {"$": n}, "kind": {"$": "B1"}}, {"doc-number": {"$": f"EP{n}"}}]}
    documents = [{"@country": "EP", "@doc-number": "7", "@kind": "A1", "bibliographic-data": ident("7")}, {"bibliographic-data": ident("8") | {"invention-title": [{"@lang": "de", "$": "Titel"}, {"@lang": "en", "$": "Title"}]}}, {"bibliographic-data": {}}]
    reply = {"ops:world-patent-data": {"exchange-documents": [{"exchange-document": documents[0]}, {"exchange-document": documents[1:]}]}}
    assert flatten.ops_records(reply) == [{"patent_number": "EP7A1", "country": "EP", "title": None}, {"patent_number": "EP8B1", "country": "EP", "title": "Title"}]
    assert flatten.ops_records({}) == []


def test_ops_pages(monkeypatch):
    monkeypatch.setenv("EPO_OPS_KEY", "k")
    monkeypatch.setenv("EPO_OPS_SECRET", "s")
    asked = []

    def fetch(url, data=None, headers=None):
        if "accesstoken" in url:
            return b'{"access_token": "t"}'
        asked.append(headers["X-OPS-Range"])
        first, last = map(int, headers["X-OPS-Range"].split("-"))
        numbers = range(first, min(last, 130) + 1)
        return json.dumps({"x": [{"exchange-document": {"@country": "EP", "@doc-number": str(n), "@kind": "A1"}} for n in numbers]}).encode()

    got, after = C.epo_ops("word", 120, fetch=fetch)
    assert [r["patent_number"] for r in got] == [f"EP{n}A1" for n in range(1, 121)] and after == "121" and asked == ["1-100", "101-120"]
    got, after = C.epo_ops("word", 120, after, fetch=fetch)
    assert len(got) == 10 and after is None and asked[2:] == ["121-220"]


def test_paging():
    pages = {None: ([1, 2], "a"), "a": ([3], "b"), "b": ([], None)}
    assert C.paged(2, None, lambda m, room: pages[m]) == ([1, 2], "a")
    assert C.paged(9, None, lambda m, room: pages[m]) == ([1, 2, 3], None)


def test_landing_with_recorded_replies(store):
    study = {"protocolSection": {"identificationModule": {"nctId": "N1"}}}
    replies = {"bindingdb": {"odd name": {"affinities": [{"affinity": "5", "affinity_type": "Ki"}]}}, "clinicaltrials.gov": {"studies": [study], "nextPageToken": "next"}, "uniprot": {"results": [{"primaryAccession": "P1", "genes": [{"geneName": {"value": "G1"}}], "uniProtKBCrossReferences": [{"database": "PDB", "id": "1ABC"}]}]}, "rcsb": {"struct": {"title": "S"}}, "ensembl": {"id": "E1"}, "/mechanism": {"mechanisms": []}, "/molecule/search": {"molecules": [{"molecule_chembl_id": "C1"}]}, "openalex": {"results": [{"id": "https://openalex.org/W1", "title": "An open work"}], "meta": {}}, "europepmc": {"resultList": {"result": [{"pmcid": "PMC5", "title": "T"}, {"title": "no id"}]}}}

    def fetch(url, **_):
        if "efetch" in url:
            return seed.article().encode()
        return json.dumps(next(v for k, v in replies.items() if k in url)).encode()

    assert C.land_trials(store, "pain", 1, fetch=fetch) == ((1, 1), "next")
    assert C.land_chembl(store, "x", fetch=fetch) == (1, 1) and C.land_uniprot(store, "x", fetch=fetch) == (1, 1)
    assert C.land_pdb(store, fetch=fetch) == C.land_ensembl(store, fetch=fetch) == C.land_bindingdb(store, fetch=fetch) == (1, 1)
    assert C.land_openalex(store, "x", fetch=fetch) == (1, None) and C.land_europepmc(store, "x", fetch=fetch) == (1, None) and C.land_europepmc(store, "x", fetch=fetch) == (0, None)
    from corpusengine.operators.quality import Thresholds
    from corpusengine.plans import corpus, graph

    assert graph.load_datasets(store)["clinical_trials"] == 1 and store.read("pdb_structures").first()["title"] == "S"
    assert corpus.build(store, Thresholds(0, 0, 0))["documents"] == 2
    assert C.patentsview("x") == ([], None) and C.epo_ops("x") == ([], None) and C.land_surechembl(store) == 0


class Reply(io.BytesIO):
    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()


def script(*steps):
    todo = list(steps)

    def opener(request, timeout):
        step = todo.pop(0)
        if isinstance(step, int):
            raise urllib.error.HTTPError(request.full_url, step, "x", {"Retry-After": "7"} if step == 429 else {}, None)
        if isinstance(step, Exception):
            raise step
        return Reply(step)

    return opener, todo


def test_net():
    slept = []
    pacer = lambda **k: net.Traffic(clock=lambda: 0.0, sleep=slept.append, by_host={}, **k)
    opener, _ = script(503, b"ok")
    assert net.request("http://h/x", pacer=pacer(), opener=opener) == b"ok"
    opener, _ = script(429, b"ok")
    slept.clear()
    net.request("http://h/x", pacer=pacer(), opener=opener)
    assert 7 in slept
    opener, left = script(404, b"never")
    with pytest.raises(net.PermanentError) as e:
        net.request("http://h/x", pacer=pacer(), opener=opener)
    assert e.value.status == 404 and left
    opener, _ = script(OSError("a"), OSError("b"), OSError("c"))
    with pytest.raises(net.TransientError):
        net.request("http://h/x", pacer=pacer(), opener=opener)
    p = pacer(failures=2)
    opener, _ = script(500, 500)
    with pytest.raises(net.TransientError):
        net.request("http://h/x", retries=2, pacer=p, opener=opener)
    with pytest.raises(net.CircuitOpen):
        net.request("http://h/x", pacer=p, opener=opener)
