"""Schemas of every feed and table. Nothing is inferred: an absent key is a null column."""

from __future__ import annotations

from pyspark.sql.types import StructType

_DDL = {
    # landing feeds
    "manifest": "pmcid string, pmid string, doi string, title string, journal string, pub_year string, authors string, source string, query string, fetched_at string, has_body boolean, abstract string, mesh string, keywords string, grants string, cited_by int, xml_file string",
    "events_raw": "event_id string, user_id string, event_type string, country string, value double, ts string",
    "chembl_molecules": "chembl_id string, pref_name string, molecule_type string, max_phase double, first_approval int, oral boolean, parenteral boolean, topical boolean, mw double, alogp double, psa double, hba int, hbd int, ro5_violations int, qed_weighted double, smiles string, inchi_key string, query string, fetched_at string",
    "chembl_synonyms": "chembl_id string, syn_type string, name string",
    "chembl_mechanisms": "molecule_chembl_id string, target_chembl_id string, action_type string, mechanism_of_action string",
    "clinical_trials": "nct_id string, title string, status string, study_type string, phases string, enrollment int, start_date string, completion_date string, conditions string, interventions string, lead_sponsor string, query string, fetched_at string",
    "uniprot_proteins": "accession string, entry_name string, protein_name string, gene string, organism string, length int, function string, pdb_ids string, chembl_target string, aliases string, query string, fetched_at string",
    "pdb_structures": "pdb_id string, title string, method string, resolution double, fetched_at string",
    "pubchem_compounds": "cid bigint, query string, iupac_name string, molecular_formula string, mw double, xlogp double, smiles string, inchi_key string, fetched_at string",
    "ensembl_genes": "gene string, ensembl_id string, biotype string, chromosome string, start bigint, end bigint, strand int, description string, fetched_at string",
    "binding_affinities": "accession string, target string, monomer_id string, smiles string, affinity_type string, affinity_nm double, pmid string, doi string, fetched_at string",
    # warehouse
    "events": "event_id string, user_id string, event_type string, country string, value double, ts timestamp, event_date date",
    "daily_metrics": "event_date date, event_type string, events bigint, unique_users bigint, revenue double",
    "documents_raw": "pmcid string, pmid string, doi string, title string, journal string, pub_year int, authors string, source string, query string, fetched_at string, has_body boolean, abstract string, mesh string, keywords string, grants string, cited_by int, raw_xml string",
    "documents_rejected": "pmcid string, source string, doi string, title string, reasons string, checks string, query string, fetched_at string, rejected_at string",
    "doc_clusters": "pmcid string, source string, doi_norm string, cluster_id string, is_primary boolean",
    "doc_sections": "pmcid string, ordinal int, sec_type string, sec_kind string, sec_title string, text string, n_words int, n_figures int, n_tables int",
    "doc_chunks": "pmcid string, chunk_id int, sec_type string, sec_kind string, sec_title string, text string, n_words int, is_methods boolean, is_results boolean, n_figures int, n_tables int",
    "entity_drug_molecules": "chembl_id string, drug_norm string, pref_name string, max_phase double",
    "entity_drugs": "drug_norm string, n_forms bigint, max_phase double, sample_name string",
    "entity_drug_names": "drug_norm string, term string",
    "entity_proteins": "accession string, gene string, protein_name string, organism string, chembl_target string, gene_norm string",
    "entity_protein_names": "accession string, gene string, term string, pattern string",
    "link_drug_trial": "drug_norm string, nct_id string, in_intervention boolean",
    "link_drug_document": "drug_norm string, pmcid string, in_metadata boolean, n_body bigint, confidence string, score double",
    "link_trial_document": "nct_id string, pmcid string, drug_norm string",
    "link_drug_protein": "drug_norm string, chembl_id string, accession string, gene string, action_type string",
    "link_protein_structure": "accession string, gene string, pdb_id string",
    "link_protein_document": "accession string, gene string, pmcid string, in_metadata boolean, n_body bigint, confidence string, score double",
    "link_drug_pubchem": "drug_norm string, chembl_id string, cid bigint, inchi_key string",
    "link_protein_gene": "accession string, gene string, ensembl_id string",
    "chunk_vectors": "pmcid string, chunk_id int, text_hash string, vector array<float>",
}

#: Structured feeds: table -> path below the landing zone.
DATASETS = {
    "chembl_molecules": "chembl/molecules.jsonl", "chembl_synonyms": "chembl/synonyms.jsonl", "chembl_mechanisms": "chembl/mechanisms.jsonl",
    "clinical_trials": "clinicaltrials/trials.jsonl", "uniprot_proteins": "uniprot/proteins.jsonl", "pdb_structures": "pdb/structures.jsonl",
    "pubchem_compounds": "pubchem/compounds.jsonl", "ensembl_genes": "ensembl/genes.jsonl", "binding_affinities": "bindingdb/affinities.jsonl",
}


def schema(table: str) -> StructType:
    return StructType.fromDDL(_DDL[table])


def tables() -> list[str]:
    return list(_DDL)
