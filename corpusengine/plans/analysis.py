"""What the warehouse knows: facts, dataset and link reports, exploration of one drug or protein, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusengine.functions import text as T
from corpusengine.operators import chunking, merge, quality, relational
from corpusengine.store import Store


def _rows(df: DataFrame) -> list[list]:
    """For results of bounded size: limits, small groups, one row."""
    return [list(r) for r in df.collect()]


# ---- facts


def overview(s: Store) -> dict:
    stats = merge.cluster_stats(s.read("doc_clusters")).first()
    docs = s.read("documents_raw")
    return {
        "unique_papers": stats["clusters"], "source_rows": stats["rows"], "cross_source_dupes": stats["duplicates"],
        "by_source": _rows(docs.groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source")), "full_text": docs.filter("has_body").count(), "chunks": s.read("doc_chunks").count(),
    }


def trends(s: Store) -> DataFrame:
    """Unique papers by year."""
    primary = s.read("doc_clusters").filter("is_primary").select("pmcid", "cluster_id")
    docs = s.read("documents_raw").filter("pub_year is not null").select("pmcid", "pub_year")
    return docs.join(primary, "pmcid").groupBy("pub_year").agg(F.countDistinct("cluster_id").alias("papers")).orderBy("pub_year")


def _drug_arms(s: Store) -> list[tuple[str, DataFrame, str]]:
    return [("trials", s.read("link_drug_trial").filter("in_intervention"), "nct_id"), ("papers", s.read("link_drug_document").filter("confidence = 'strong'"), "pmcid")]


def top_drugs(s: Store, k: int = 12) -> DataFrame:
    out = relational.star(s.read("entity_drugs").select("drug_norm", "max_phase"), "drug_norm", [*_drug_arms(s), ("targets", s.read("link_drug_protein"), "gene")])
    return out.orderBy(F.desc(F.col("trials") + F.col("papers") + F.col("targets")), "drug_norm").limit(k)


def top_targets(s: Store, k: int = 12) -> DataFrame:
    genes = s.read("entity_proteins").filter("gene is not null").select("gene").distinct()
    arms = [("drugs", s.read("link_drug_protein"), "drug_norm"), ("structures", s.read("link_protein_structure"), "pdb_id"), ("papers", s.read("link_protein_document").filter("confidence = 'strong'"), "pmcid")]
    return relational.star(genes, "gene", arms).orderBy(F.desc(F.col("drugs") + F.col("structures") + F.col("papers")), "gene").limit(k)


def gaps(s: Store, k: int = 8) -> dict[str, DataFrame]:
    proteins, drugs = s.read("entity_proteins").select("gene"), s.read("entity_drugs").select("drug_norm", "max_phase")
    trials, papers = s.read("link_drug_trial").filter("in_intervention"), s.read("link_drug_document").filter("confidence = 'strong'")
    return {
        "targets_without_drugs": relational.without(proteins, s.read("link_drug_protein"), "gene", "gene").orderBy("gene").limit(k),
        "drugs_without_trials": relational.without(drugs, trials, "drug_norm", "drug_norm").orderBy(F.desc_nulls_last("max_phase"), "drug_norm").limit(k),
        "drugs_without_papers": relational.without(drugs.select("drug_norm"), papers, "drug_norm", "drug_norm").orderBy("drug_norm").limit(k),
    }


def asymmetries(s: Store, k: int = 8) -> dict[str, DataFrame]:
    genes = relational.without(s.read("entity_proteins").select("gene").distinct(), s.read("link_drug_protein"), "gene", "gene")
    arms = [("structures", s.read("link_protein_structure"), "pdb_id"), ("papers", s.read("link_protein_document").filter("confidence = 'strong'"), "pmcid")]
    trials = s.read("link_drug_trial").filter("in_intervention")
    drugs = relational.without(s.read("entity_drugs").select("drug_norm", "max_phase"), trials, "drug_norm", "drug_norm")
    rich = relational.star(drugs, "drug_norm", [_drug_arms(s)[1]]).select("drug_norm", "papers", "max_phase").filter("papers >= 3")
    wide = trials.join(s.read("clinical_trials").select("nct_id", "conditions").filter("conditions is not null"), "nct_id").groupBy("drug_norm").agg(F.countDistinct("conditions").alias("conditions")).filter("conditions >= 2")
    return {
        "structurally_studied_but_undrugged": relational.star(genes, "gene", arms).filter("structures >= 3").orderBy(F.desc("structures"), "gene").limit(k),
        "research_rich_but_untrialed": rich.orderBy(F.desc("papers"), "drug_norm").limit(k),
        "drugs_spanning_many_conditions": wide.orderBy(F.desc("conditions"), "drug_norm").limit(k),
    }


def _counted(df: DataFrame, by: str, k: int) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(by)).limit(k)


def trials(s: Store, k: int = 8) -> dict[str, DataFrame]:
    t = s.read("clinical_trials")
    return {"by_phase": _counted(t, "phases", k), "by_status": _counted(t, "status", k)}


def binding(s: Store, k: int = 10) -> DataFrame:
    rows = s.read("binding_affinities").filter("affinity_nm is not null").groupBy("target", "affinity_type")
    return rows.agg(F.count("*").alias("n"), F.round(F.min("affinity_nm"), 2).alias("best_nm")).orderBy("best_nm", "target", "affinity_type").limit(k)


def topics(s: Store, k: int = 12) -> dict[str, DataFrame]:
    docs = s.read("documents_raw")
    return {"mesh": relational.top_values(docs, "mesh", ";", k), "concepts": relational.top_values(docs.filter("source = 'openalex'"), "keywords", ";", k)}


def facts(s: Store) -> dict:
    """Every block as plain lists."""
    each = lambda blocks: {name: _rows(df) for name, df in blocks.items()}
    return {
        "overview": overview(s), "trends": _rows(trends(s)), "top_drugs": _rows(top_drugs(s)), "top_targets": _rows(top_targets(s)), "gaps": each(gaps(s)),
        "asymmetries": each(asymmetries(s)), "trials": each(trials(s)), "binding": _rows(binding(s)), "topics": each(topics(s)),
    }


def sheet(f: dict) -> str:
    """Facts as Markdown; a block without rows says so."""
    o = f["overview"]
    out = ["# Facts", f"- papers: {o['unique_papers']} ({o['source_rows']} source rows, {o['cross_source_dupes']} duplicates), full text: {o['full_text']}, chunks: {o['chunks']}"]

    def block(title: str, rows: list[list]) -> None:
        out.append(f"\n## {title.replace('_', ' ')}")
        out.extend("- " + " | ".join("-" if v is None else str(v) for v in r) for r in rows)
        if not rows:
            out.append("_none_")

    for name in ("trends", "top_drugs", "top_targets", "binding"):
        block(name, f[name])
    for name in ("gaps", "asymmetries", "trials", "topics"):
        for part, rows in f[name].items():
            block(part, rows)
    return "\n".join(out)


# ---- reports


def connectivity(s: Store, k: int = 12) -> DataFrame:
    """Drugs by their trials and papers, intended and strong ones only; those without either stay out."""
    out = relational.star(s.read("entity_drugs").select("drug_norm", "max_phase"), "drug_norm", _drug_arms(s)).filter("trials > 0 or papers > 0")
    return out.orderBy(F.desc(F.col("trials") + F.col("papers")), "drug_norm").limit(k)


def datasets(s: Store) -> dict[str, list[list]]:
    """Sizes, distributions and samples of the structured tables; tables without rows stay out."""
    r = s.read
    m, t, p, c, g, b = (r(x) for x in ("chembl_molecules", "clinical_trials", "uniprot_proteins", "pubchem_compounds", "ensembl_genes", "binding_affinities"))
    parts = {
        "rows": None,
        "molecules_by_phase": m.groupBy("max_phase").agg(F.count("*").alias("n")).orderBy(F.desc_nulls_last("max_phase")),
        "molecules": m.filter("pref_name is not null").select("chembl_id", "pref_name", "max_phase").orderBy(F.desc_nulls_last("max_phase"), "chembl_id").limit(6),
        "trials_by_status": _counted(t, "status", 6), "trials_by_phase": _counted(t, "phases", 6),
        "proteins": p.filter("gene is not null").select("gene", "organism", "length", "chembl_target").orderBy("gene").limit(6),
        "compounds": c.select("cid", "molecular_formula", F.round("mw", 1)).orderBy("cid").limit(5),
        "genes": g.select("gene", "ensembl_id", "chromosome", "biotype").orderBy("gene").limit(5),
        "affinities": b.groupBy("affinity_type").agg(F.count("*").alias("n"), F.round(F.min("affinity_nm"), 1)).orderBy(F.desc("n"), "affinity_type").limit(5),
    }
    out = {k: _rows(v) for k, v in parts.items() if v is not None}
    sizes = [[x, r(x).count()] for x in ("chembl_molecules", "clinical_trials", "uniprot_proteins", "pdb_structures", "pubchem_compounds", "ensembl_genes", "binding_affinities")]
    return {"rows": [x for x in sizes if x[1]]} | {k: v for k, v in out.items() if v}


def explore_drug(s: Store, drug: str) -> dict:
    """Entity, names, trials, strong papers, number of weak ones, and targets of one drug."""
    norm = s.spark.range(1).select(T.drug_norm(F.lit(drug))).first()[0] or drug.lower()
    mine = lambda t: s.read(t).filter(F.col("drug_norm") == norm)
    papers = mine("link_drug_document")
    shown = papers.filter("confidence = 'strong'").join(s.read("documents_raw").select("pmcid", "source", "title"), "pmcid")
    tested = mine("link_drug_trial").join(s.read("clinical_trials").select("nct_id", "phases", "status", "title"), "nct_id")
    return {
        "drug": norm, "entity": _rows(mine("entity_drugs").select("n_forms", "max_phase", "sample_name").limit(1)), "names": [r[0] for r in _rows(mine("entity_drug_names").select("term").orderBy("term"))],
        "trials": _rows(tested.select("nct_id", "phases", "status", "in_intervention", "title").orderBy(F.desc_nulls_last("in_intervention"), "nct_id").limit(8)),
        "papers": _rows(shown.select("pmcid", "source", "in_metadata", "n_body", "title").orderBy(F.desc("in_metadata"), F.desc("n_body"), "pmcid").limit(8)), "weak": papers.filter("confidence = 'weak'").count(),
        "targets": _rows(mine("link_drug_protein").select("gene", "action_type").distinct().orderBy("gene", "action_type")),
    }


def explore_protein(s: Store, gene: str) -> dict:
    """Entity, drugs, structures by resolution and strong papers of one gene, in any case."""
    mine = lambda t: s.read(t).filter(F.lower("gene") == gene.lower())
    structures = mine("link_protein_structure")
    shown = mine("link_protein_document").filter("confidence = 'strong'").join(s.read("documents_raw").select("pmcid", "source", "title"), "pmcid")
    return {
        "gene": gene, "entity": _rows(mine("entity_proteins").select("accession", "protein_name", "organism").orderBy("accession").limit(1)), "n_structures": structures.count(),
        "drugs": _rows(mine("link_drug_protein").select("drug_norm", "action_type").distinct().orderBy("drug_norm", "action_type").limit(12)),
        "structures": _rows(structures.join(s.read("pdb_structures"), "pdb_id").select("pdb_id", "method", "resolution", "title").distinct().orderBy(F.asc_nulls_last("resolution"), "pdb_id").limit(6)),
        "papers": _rows(shown.select("pmcid", "source", "in_metadata", "n_body", "title").orderBy(F.desc("in_metadata"), F.desc("n_body"), "pmcid").limit(6)),
    }


# ---- validation

#: Accepted shapes of ids by source; sources not named are only asked for an id.
ID_PATTERNS = {"europepmc": r"^PMC\d+$", "arxiv": r"(?i)^arXiv:.+", "openalex": r"(?i)^(openalex:|https?://openalex\.org/)?W\d+$"}
YEARS = (1500, 2100)


def bad_id() -> Column:
    bad = F.lit(False)
    for source, pattern in ID_PATTERNS.items():
        bad = bad | ((F.col("source") == source) & ~F.col("pmcid").rlike(pattern))
    return F.coalesce(F.col("pmcid") == "", F.lit(True)) | F.coalesce(bad, F.lit(False))


def validate(s: Store, examples: int = 5) -> dict:
    """Counts of what shouldn't be, with a few ids each, and the quarantine's reasons (which are no issue). One aggregate a table."""
    if not s.has("documents_raw"):
        return {"checks": {}, "examples": {}, "ok": True, "n_documents": 0, "n_issues": 0, "quarantined": 0, "quarantine_reasons": {}}
    docs, secs, parts = s.read("documents_raw"), s.read("doc_sections"), s.read("doc_chunks")
    bodies = secs.filter("sec_type = 'body'").select("pmcid")
    tests = {
        "missing_title": F.col("title").isNull() | (F.trim("title") == ""),
        "year_out_of_range": F.col("pub_year").isNotNull() & ~F.col("pub_year").between(*YEARS),
        "bad_id_format": bad_id(),
    }
    one = docs.agg(F.count("*").alias("n"), *[F.count_if(t).alias(k) for k, t in tests.items()]).first().asDict()
    n = one.pop("n")
    broken = docs.filter("has_body").join(bodies, "pmcid", "left_anti")
    blank = (F.col("n_words") == 0) | F.col("text").isNull() | (F.trim("text") == "")
    checks = one | {"body_flag_without_sections": broken.count(), "empty_sections": secs.filter(blank).count()}
    checks |= parts.agg(F.count_if(F.col("n_words") > 2 * chunking.settings()[0]).alias("oversized_chunks"), F.count_if(F.col("n_words") == 0).alias("empty_chunks")).first().asDict()
    found = {k: docs.filter(t) for k, t in tests.items()} | {"body_flag_without_sections": broken}
    shown = {k: [r[0] for r in _rows(df.select("pmcid").orderBy("pmcid").limit(examples))] for k, df in found.items() if checks[k]}
    rejected = s.read("documents_rejected")
    issues = sum(checks.values())
    return {"checks": checks, "examples": shown, "ok": issues == 0, "n_documents": n, "n_issues": issues, "quarantined": rejected.count(), "quarantine_reasons": {r["reason"]: r["documents"] for r in quality.rollup(rejected).collect()}}
