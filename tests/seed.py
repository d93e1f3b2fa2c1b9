"""A small landed knowledge base: two drugs, a trial, a protein, a structure, and documents of several kinds."""

import json
import os

DOC = {"pmid": None, "doi": None, "journal": "Journal of Tests", "pub_year": 2025, "authors": "A Writer", "query": "seed", "fetched_at": "2025-01-01T00:00:00+00:00", "mesh": None, "keywords": None, "grants": None, "cited_by": 3}


def put(root, path, text):
    full = os.path.join(root, "raw", path)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "w", encoding="utf-8") as f:
        f.write(text)


def lines(root, path, rows):
    put(root, path, "".join(json.dumps(r) + "\n" for r in rows))


def article(title="Fentanyl pharmacology", body="Fentanyl binds the mu-opioid receptor OPRM1. Fentanyl is potent.", head="Results", extra=""):
    return f"""<pmc-articleset><article><front><journal-meta><journal-title>Journal of Tests</journal-title></journal-meta><article-meta><article-id pub-id-type="doi">10.1/x</article-id>
    <article-id pub-id-type="pmc">77</article-id><title-group><article-title>{title}</article-title></title-group><contrib-group><contrib contrib-type="author"><name><surname>Doe</surname><given-names>Jo</given-names></name></contrib></contrib-group>
    <pub-date><year>2024</year></pub-date><abstract><p>A study of   fentanyl.</p></abstract></article-meta></front><body><sec><title>{head}</title><p>{body}</p>{extra}</sec></body></article></pmc-articleset>"""


def documents(root, source, rows):
    """rows: (pmcid, raw text, fields)."""
    out = []
    for pmcid, raw, more in rows:
        name = f"{pmcid.replace(':', '_').replace('/', '_')}.{'json' if raw.startswith('{') else 'xml'}"
        put(root, f"{source}/{name}", raw)
        out.append(DOC | {"pmcid": pmcid, "title": "Fentanyl pharmacology", "abstract": "A study of fentanyl.", "source": source, "has_body": source == "europepmc", "xml_file": f"/elsewhere/data/raw/{source}/{name}"} | more)
    lines(root, f"{source}/manifest.jsonl", out)


def datasets(root):
    lines(root, "chembl/molecules.jsonl", [{"chembl_id": "C1", "pref_name": "FENTANYL", "max_phase": 4.0, "inchi_key": "KEY-F"}, {"chembl_id": "C2", "pref_name": "NALOXONE HYDROCHLORIDE DIHYDRATE", "max_phase": 4.0}])
    lines(root, "chembl/synonyms.jsonl", [{"chembl_id": "C1", "syn_type": "TRADE_NAME", "name": "Duragesic"}, {"chembl_id": "C2", "syn_type": "TRADE_NAME", "name": "Narcan"}])
    lines(root, "chembl/mechanisms.jsonl", [{"molecule_chembl_id": "C1", "target_chembl_id": "T1", "action_type": "AGONIST", "mechanism_of_action": "Mu opioid receptor agonist"}])
    lines(root, "clinicaltrials/trials.jsonl", [{"nct_id": "NCT1", "title": "Pain after surgery", "status": "COMPLETED", "phases": "PHASE3", "conditions": "Pain", "interventions": "DRUG:Fentanyl"}, {"nct_id": "NCT2", "title": "Naloxone at home", "status": "RECRUITING", "phases": "PHASE2", "conditions": "Overdose", "interventions": None}])
    lines(root, "uniprot/proteins.jsonl", [{"accession": "P35372", "protein_name": "Mu-type opioid receptor", "gene": "OPRM1", "organism": "Homo sapiens", "length": 400, "function": "Receptor for opioids", "pdb_ids": "5C1M; 8E0G", "chembl_target": "T1", "aliases": "Mu-type opioid receptor; Mu opioid receptor; MOR-1"}])
    lines(root, "pdb/structures.jsonl", [{"pdb_id": "5C1M", "title": "Mu opioid receptor", "method": "X-RAY", "resolution": 2.1}])
    lines(root, "pubchem/compounds.jsonl", [{"cid": 3345, "query": "fentanyl", "inchi_key": "KEY-F", "molecular_formula": "C22H28N2O", "mw": 336.5}])
    lines(root, "ensembl/genes.jsonl", [{"gene": "OPRM1", "ensembl_id": "ENSG00000112038", "biotype": "protein_coding", "chromosome": "6", "description": "opioid receptor mu 1"}])
    lines(root, "bindingdb/affinities.jsonl", [{"accession": "P35372", "target": "OPRM1", "affinity_type": "Ki", "affinity_nm": 1.234}, {"accession": "P35372", "target": "OPRM1", "affinity_type": "Ki", "affinity_nm": 7.0}])
