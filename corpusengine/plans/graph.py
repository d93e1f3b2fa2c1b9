"""The link graph: canonical drugs, proteins and their names, and the edges between drugs, trials, documents, proteins, structures, compounds and genes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusengine.functions import text as T
from corpusengine.operators import matching as M
from corpusengine.operators import relational
from corpusengine.schemas import DATASETS, schema
from corpusengine.store import Store

LINKS = ["entity_drugs", "entity_drug_names", "link_drug_trial", "link_drug_document", "link_trial_document", "link_drug_protein", "link_protein_structure", "link_protein_document", "link_drug_pubchem", "link_protein_gene"]


def load_datasets(store: Store) -> dict[str, int]:
    """Structured feeds to tables. A feed that hasn't landed gives an empty table, so that a build never mixes generations."""
    out = {}
    for table in DATASETS:
        feed = store.feed(table)
        out[table] = store.write(table, store.spark.createDataFrame([], schema(table)) if feed is None else feed).count()
    return out


def drug_molecules(molecules: DataFrame) -> DataFrame:
    """Molecules under their base name; those without one are no drugs."""
    return molecules.select("chembl_id", T.drug_norm(F.col("pref_name")).alias("drug_norm"), "pref_name", "max_phase").filter("drug_norm is not null")


def drugs(forms: DataFrame) -> DataFrame:
    return forms.groupBy("drug_norm").agg(F.countDistinct("chembl_id").alias("n_forms"), F.max("max_phase").alias("max_phase"), F.min("pref_name").alias("sample_name"))


def drug_names(forms: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Search terms: the base name itself and its forms' one-word synonyms. A molecule with several names counts with each."""
    terms = synonyms.select("chembl_id", T.drug_term(F.col("name")).alias("term")).filter("term is not null")
    named = forms.select("chembl_id", "drug_norm").distinct().join(terms, "chembl_id").select("drug_norm", "term")
    return forms.select("drug_norm", F.col("drug_norm").alias("term")).unionByName(named).distinct()


def protein_names(proteins: DataFrame) -> DataFrame:
    out = proteins.filter("accession is not null").select("accession", "gene", F.explode(T.protein_terms(F.col("gene"), F.col("aliases"))).alias("term"))
    return out.withColumn("pattern", T.name_pattern(F.col("term")))


def proteins(feed: DataFrame) -> DataFrame:
    return feed.filter("accession is not null").withColumn("gene_norm", F.lower("gene"))


def metadata_text(docs: DataFrame) -> DataFrame:
    return docs.select("pmcid", F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("title", "abstract", "keywords", "mesh")]).alias("blob"))


def body_text(sections: DataFrame) -> DataFrame:
    return relational.joined_text(sections, ["pmcid"], "ordinal", "text")


def drug_trials(names: DataFrame, trials: DataFrame) -> DataFrame:
    """Drugs named in a trial's interventions or title. in_intervention: null where the trial has no interventions. Trials are read once."""
    iv = F.col("interventions")
    rows = trials.select("nct_id", iv.isNotNull().alias("_iv"), T.runs(iv).alias("_i"), T.runs(F.col("title")).alias("_t"))
    marked = F.transform(F.array_union("_i", "_t"), lambda t: F.struct(t.alias("term"), F.when(F.col("_iv"), F.array_contains("_i", t)).alias("inside")))
    each = rows.select("nct_id", F.explode(marked).alias("x")).select("nct_id", "x.term", "x.inside")
    return each.join(names.select("drug_norm", "term"), "term").groupBy("drug_norm", "nct_id").agg(F.bool_or("inside").alias("in_intervention"))


def _document_links(names: DataFrame, keys: list[str], meta: DataFrame, body: DataFrame, digits: bool, longest: int) -> DataFrame:
    more = {"digits": digits, "longest": longest}
    found = M.counted(M.mentions(names.select(*keys, "term"), body, ["pmcid"], "blob", **more), body, ["pmcid"], "blob", digits=digits)
    sums = found.groupBy(*keys, "pmcid").agg(F.sum("n").alias("n"))
    return relational.graded(M.mentions(names.select(*keys, "term"), meta, ["pmcid"], "blob", **more), sums, [*keys, "pmcid"])


def drug_documents(names: DataFrame, meta: DataFrame, body: DataFrame) -> DataFrame:
    return _document_links(names, ["drug_norm"], meta, body, False, 1)


def protein_documents(names: DataFrame, meta: DataFrame, body: DataFrame) -> DataFrame:
    """Genes may be null; they join as the text that they are."""
    longest = int(names.agg(F.max(F.size(F.split("term", " ")))).first()[0] or 1)  # one number
    keyed = names.withColumn("gene", F.coalesce("gene", F.lit("")))
    return _document_links(keyed, ["accession", "gene"], meta, body, True, longest).withColumn("gene", F.nullif("gene", F.lit("")))


def trial_documents(drug_trial: DataFrame, drug_document: DataFrame) -> DataFrame:
    """Trials that test a drug and documents with a strong link to it."""
    return relational.bridge(drug_trial.filter("in_intervention").select("drug_norm", "nct_id"), drug_document.filter("confidence = 'strong'").select("drug_norm", "pmcid"), "drug_norm")


def drug_proteins(mechanisms: DataFrame, proteins: DataFrame, forms: DataFrame) -> DataFrame:
    t = proteins.select("accession", "gene", F.col("chembl_target").alias("target_chembl_id"))
    f = forms.select(F.col("chembl_id").alias("molecule_chembl_id"), "drug_norm").distinct()
    return mechanisms.join(t, "target_chembl_id").join(f, "molecule_chembl_id").select("drug_norm", F.col("molecule_chembl_id").alias("chembl_id"), "accession", "gene", "action_type").distinct()


def protein_structures(proteins: DataFrame) -> DataFrame:
    out = proteins.select("accession", "gene", F.explode(F.split("pdb_ids", ";")).alias("pdb_id")).withColumn("pdb_id", F.trim("pdb_id"))
    return out.filter("pdb_id <> ''").distinct()


def drug_compounds(forms: DataFrame, molecules: DataFrame, compounds: DataFrame) -> DataFrame:
    m = molecules.select("chembl_id", "inchi_key").filter("inchi_key is not null")
    return forms.select("drug_norm", "chembl_id").join(m, "chembl_id").join(compounds.select("cid", "inchi_key"), "inchi_key").select("drug_norm", "chembl_id", "cid", "inchi_key").distinct()


def protein_genes(proteins: DataFrame, genes: DataFrame) -> DataFrame:
    """By the symbol as it is written."""
    return proteins.select("accession", "gene").join(genes.select("gene", "ensembl_id"), "gene").select("accession", "gene", "ensembl_id").distinct()


def build(store: Store) -> dict[str, int]:
    """All entity and link tables anew; row counts."""
    read, write = store.read, store.write
    molecules, feed = read("chembl_molecules"), read("uniprot_proteins")
    forms = write("entity_drug_molecules", drug_molecules(molecules))
    write("entity_drugs", drugs(forms))
    names = write("entity_drug_names", drug_names(forms, read("chembl_synonyms")))
    meta, body = metadata_text(read("documents_raw")).persist(), body_text(read("doc_sections")).persist()
    trials = write("link_drug_trial", drug_trials(names, read("clinical_trials")))
    papers = write("link_drug_document", drug_documents(names, meta, body))
    write("link_trial_document", trial_documents(trials, papers))
    write("entity_proteins", proteins(feed))
    aliases = write("entity_protein_names", protein_names(feed))
    write("link_drug_protein", drug_proteins(read("chembl_mechanisms"), feed, forms))
    write("link_protein_structure", protein_structures(feed))
    write("link_protein_document", protein_documents(aliases, meta, body))
    write("link_drug_pubchem", drug_compounds(forms, molecules, read("pubchem_compounds")))
    write("link_protein_gene", protein_genes(read("entity_proteins"), read("ensembl_genes")))
    meta.unpersist()
    body.unpersist()
    return {t: read(t).count() for t in LINKS}
