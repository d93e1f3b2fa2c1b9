"""A knowledge base derived from the shared test tables, for the queries of catalog_kb: each feed is one SQL text that Spark and the
answering SQL engine both run. Parts are molecules, suppliers proteins, orders trials and documents, line items their mentions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from corpusengine.plans import corpus, graph
from corpusengine.plans.registry import table
from corpusengine.schemas import schema
from corpusengine.store import fit

_NAME = "replace(p_name, ' ', '')"
FEEDS = {
    "chembl_molecules": f"""SELECT 'CHEMBL' || CAST(p_partkey AS STRING) AS chembl_id, CASE WHEN p_size < 48 THEN upper({_NAME}) || CASE WHEN p_size > 30 THEN ' Hydrochloride' ELSE '' END END AS pref_name,
      CAST(p_size AS DOUBLE) / 10 AS max_phase, CASE WHEN p_size > 3 THEN 'KEY-' || CAST(p_partkey AS STRING) END AS inchi_key FROM {{part}}""",
    "chembl_synonyms": """SELECT 'CHEMBL' || CAST(p_partkey AS STRING) AS chembl_id, 'INN' AS syn_type, CASE WHEN p_size < 20 THEN p_type || 'ol' WHEN p_size < 40 THEN p_name ELSE 'Water' END AS name FROM {part}""",
    "chembl_mechanisms": """SELECT DISTINCT 'CHEMBL' || CAST(l_partkey AS STRING) AS molecule_chembl_id, 'T' || CAST(l_suppkey AS STRING) AS target_chembl_id, l_returnflag AS action_type FROM {lineitem} WHERE l_quantity >= 46""",
    "clinical_trials": f"""SELECT 'NCT' || CAST(o_orderkey AS STRING) AS nct_id, 'Trial of ' || min(p_type) || ' and ' || min({_NAME}) AS title, min(o_orderstatus) AS status, 'PHASE' || substr(min(o_orderpriority), 1, 1) AS phases,
      CASE WHEN min(o_totalprice) > 50000 THEN min(o_orderpriority) END AS conditions, CASE WHEN min(o_orderstatus) <> 'P' THEN 'DRUG:' || upper(max({_NAME})) || '; OTHER:' || max(p_brand) END AS interventions
      FROM {{orders}} JOIN {{lineitem}} ON l_orderkey = o_orderkey JOIN {{part}} ON p_partkey = l_partkey WHERE l_discount > 0.05 AND o_totalprice < 100000 GROUP BY o_orderkey""",
    "uniprot_proteins": """SELECT 'P' || CAST(s_suppkey AS STRING) AS accession, CASE WHEN s_nationkey > 2 THEN 'GEN' || CAST(s_suppkey AS STRING) END AS gene, s_name AS protein_name, 'Organism ' || CAST(s_nationkey AS STRING) AS organism,
      CASE WHEN s_acctbal > 0 THEN 'X' || CAST(s_suppkey AS STRING) || '; Y' || CAST(s_nationkey AS STRING) || ' ;' END AS pdb_ids, 'T' || CAST(s_suppkey AS STRING) AS chembl_target,
      'Vendor number ' || CAST(s_suppkey AS STRING) || ' of steel;receptor;alpha beta;stock' || CAST(s_suppkey AS STRING) AS aliases FROM {supplier}""",
    "pubchem_compounds": "SELECT p_partkey AS cid, 'KEY-' || CAST(p_partkey AS STRING) AS inchi_key, p_name AS query FROM {part} WHERE p_retailprice < 1000",
    "ensembl_genes": "SELECT CASE WHEN s_acctbal > 2000 THEN 'GEN' ELSE 'gen' END || CAST(s_suppkey AS STRING) AS gene, 'ENSG' || CAST(s_suppkey AS STRING) AS ensembl_id, CAST(s_nationkey AS STRING) AS chromosome, 'protein_coding' AS biotype FROM {supplier}",
    "binding_affinities": "SELECT 'P' || CAST(l_suppkey AS STRING) AS accession, 'T' || CAST(l_suppkey AS STRING) AS target, l_returnflag AS affinity_type, CASE WHEN l_tax > 0 THEN l_extendedprice END AS affinity_nm FROM {lineitem}",
    "documents_raw": f"""SELECT 'PMC' || CAST(o_orderkey AS STRING) AS pmcid, CASE WHEN min(o_custkey) > 5 THEN 'About ' || min({_NAME}) ELSE ' ' END AS title, 'Uses of ' || max({_NAME}) || ' and stock' || CAST(min(l_suppkey) AS STRING) AS abstract,
      CASE WHEN min(o_orderpriority) < '2' THEN 'europepmc' WHEN min(o_orderpriority) < '4' THEN 'openalex' ELSE 'arxiv' END AS source, CASE WHEN min(o_orderstatus) <> 'P' THEN ' 10.' || CAST(min(o_custkey) AS STRING) || '/X' END AS doi,
      CASE WHEN min(o_custkey) > 20 THEN CAST(year(min(o_orderdate)) AS INT) ELSE 12 END AS pub_year, min(p_type) || '; ' || max(p_brand) AS mesh, max(p_type) || '; ;' || min(p_type) AS keywords, min(o_orderstatus) = 'F' AS has_body, 'Journal ' || min(p_type) AS journal
      FROM {{orders}} JOIN {{lineitem}} ON l_orderkey = o_orderkey JOIN {{part}} ON p_partkey = l_partkey WHERE o_totalprice > 400000 GROUP BY o_orderkey""",
    "doc_sections": f"""SELECT 'PMC' || CAST(l_orderkey AS STRING) AS pmcid, l_linenumber AS ordinal, CASE WHEN l_tax < 0.04 THEN 'abstract' ELSE 'body' END AS sec_type, 'body' AS sec_kind,
      CASE WHEN l_quantity > 1 THEN {_NAME} || ', ' || {_NAME} || ' from Vendor-Number ' || CAST(l_suppkey AS STRING) || ' of Steel, gen' || CAST(l_suppkey AS STRING) ELSE '' END AS text, CAST(l_quantity AS INT) - 1 AS n_words
      FROM {{lineitem}} JOIN {{part}} ON p_partkey = l_partkey WHERE l_quantity > 30 OR l_quantity < 2""",
    "doc_chunks": "SELECT 'PMC' || CAST(l_orderkey AS STRING) AS pmcid, l_linenumber AS chunk_id, 'words' AS text, CAST(l_quantity * 10 AS INT) AS n_words, l_returnflag = 'A' AS is_methods FROM {lineitem}",
}
_BASE = "region nation customer supplier part orders lineitem".split()


class Frames:
    """Reads like a store: feeds as above, and what the engine's own plans derive from them."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d
        self._made: dict[str, DataFrame] = {}

    def has(self, name: str) -> bool:
        return name in FEEDS or hasattr(self, f"_{name}")

    def read(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in FEEDS:
                used = {t: table(self.spark, self.d, t) for t in _BASE if f"{{{t}}}" in FEEDS[name]}
                made = fit(self.spark.sql(FEEDS[name], **used), schema(name))
            else:
                made = getattr(self, f"_{name}")() if hasattr(self, f"_{name}") else self.spark.createDataFrame([], schema(name))
            self._made[name] = made
        return self._made[name]

    def _doc_clusters(self) -> DataFrame:
        return corpus.clusters(self.read("documents_raw"))

    def _entity_drug_molecules(self) -> DataFrame:
        return graph.drug_molecules(self.read("chembl_molecules"))

    def _entity_drugs(self) -> DataFrame:
        return graph.drugs(self.read("entity_drug_molecules"))

    def _entity_drug_names(self) -> DataFrame:
        return graph.drug_names(self.read("entity_drug_molecules"), self.read("chembl_synonyms"))

    def _entity_proteins(self) -> DataFrame:
        return graph.proteins(self.read("uniprot_proteins"))

    def _entity_protein_names(self) -> DataFrame:
        return graph.protein_names(self.read("uniprot_proteins"))

    def _link_drug_trial(self) -> DataFrame:
        return graph.drug_trials(self.read("entity_drug_names"), self.read("clinical_trials"))

    def _texts(self) -> tuple[DataFrame, DataFrame]:
        return graph.metadata_text(self.read("documents_raw")), graph.body_text(self.read("doc_sections"))

    def _link_drug_document(self) -> DataFrame:
        return graph.drug_documents(self.read("entity_drug_names"), *self._texts())

    def _link_protein_document(self) -> DataFrame:
        return graph.protein_documents(self.read("entity_protein_names"), *self._texts())

    def _link_trial_document(self) -> DataFrame:
        return graph.trial_documents(self.read("link_drug_trial"), self.read("link_drug_document"))

    def _link_drug_protein(self) -> DataFrame:
        return graph.drug_proteins(self.read("chembl_mechanisms"), self.read("uniprot_proteins"), self.read("entity_drug_molecules"))

    def _link_protein_structure(self) -> DataFrame:
        return graph.protein_structures(self.read("uniprot_proteins"))

    def _link_drug_pubchem(self) -> DataFrame:
        return graph.drug_compounds(self.read("entity_drug_molecules"), self.read("chembl_molecules"), self.read("pubchem_compounds"))

    def _link_protein_gene(self) -> DataFrame:
        return graph.protein_genes(self.read("entity_proteins"), self.read("ensembl_genes"))


def answering(names: dict[str, str], body: str) -> str:
    """SQL with the feeds and the further named queries (in order) that the body needs."""
    every = {k: v.format(**{t: t for t in _BASE}) for k, v in FEEDS.items()} | names
    used, todo = set(), [body]
    while todo:
        text = todo.pop()
        for k, v in every.items():
            if k not in used and re.search(rf"\b{k}\b", text):
                used.add(k)
                todo.append(v)
    return "WITH " + ", ".join(f"{k} AS ({v})" for k, v in every.items() if k in used) + " " + body
