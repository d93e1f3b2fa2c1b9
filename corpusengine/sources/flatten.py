"""API payloads to flat records: from_json with explicit schemas and a projection, natively.

Each function takes a DataFrame with a column of JSON text (one entity a row) and returns the feed's columns.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusengine.functions.text import inverted_to_text

# Kinds of molecule synonyms that are names in use.
SYNONYM_TYPES = ["TRADE_NAME", "INN", "BAN", "USAN", "FDA", "USP", "JAN", "BNF"]


def _read(rows: DataFrame, raw: str, ddl: str) -> DataFrame:
    return rows.withColumn("j", F.from_json(raw, ddl))


def _real(c: Column) -> Column:
    return c.try_cast("double")


def _whole(c: Column) -> Column:
    return _real(c).try_cast("int")


def joined(values: Column, separator: str = "; ") -> Column:
    """The values that are there, joined; null if there are none."""
    kept = F.filter(values, lambda v: v.isNotNull() & (v != ""))
    return F.when(F.size(kept) > 0, F.array_join(kept, separator))


_MOLECULE = """molecule_chembl_id string, pref_name string, molecule_type string, max_phase string, first_approval string, oral boolean, parenteral boolean, topical boolean,
 molecule_properties struct<full_mwt:string,alogp:string,psa:string,hba:string,hbd:string,num_ro5_violations:string,qed_weighted:string>,
 molecule_structures struct<canonical_smiles:string,standard_inchi_key:string>, molecule_synonyms array<struct<molecule_synonym:string,syn_type:string>>"""


def chembl_molecules(rows: DataFrame, raw: str = "raw") -> DataFrame:
    j, p, s = F.col("j"), F.col("j.molecule_properties"), F.col("j.molecule_structures")
    return _read(rows, raw, _MOLECULE).select(
        j["molecule_chembl_id"].alias("chembl_id"), j["pref_name"].alias("pref_name"), j["molecule_type"].alias("molecule_type"), _real(j["max_phase"]).alias("max_phase"), _whole(j["first_approval"]).alias("first_approval"),
        j["oral"].alias("oral"), j["parenteral"].alias("parenteral"), j["topical"].alias("topical"), _real(p["full_mwt"]).alias("mw"), _real(p["alogp"]).alias("alogp"), _real(p["psa"]).alias("psa"),
        _whole(p["hba"]).alias("hba"), _whole(p["hbd"]).alias("hbd"), _whole(p["num_ro5_violations"]).alias("ro5_violations"), _real(p["qed_weighted"]).alias("qed_weighted"), s["canonical_smiles"].alias("smiles"), s["standard_inchi_key"].alias("inchi_key"),
    )


def chembl_synonyms(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """Names in use, once for each kind whatever their case: the first of those that differ in case only."""
    each = _read(rows, raw, _MOLECULE).select(F.col("j.molecule_chembl_id").alias("chembl_id"), F.posexplode("j.molecule_synonyms").alias("pos", "s"))
    each = each.select("chembl_id", "pos", F.col("s.syn_type").alias("syn_type"), F.trim("s.molecule_synonym").alias("name")).filter(F.col("syn_type").isin(SYNONYM_TYPES) & (F.col("name") != ""))
    return each.groupBy("chembl_id", "syn_type", F.lower("name").alias("_k")).agg(F.min_by("name", "pos").alias("name")).drop("_k")


def chembl_mechanisms(rows: DataFrame, raw: str = "raw") -> DataFrame:
    return _read(rows, raw, "molecule_chembl_id string, target_chembl_id string, action_type string, mechanism_of_action string").select("j.*")


_STUDY = """protocolSection struct<identificationModule:struct<nctId:string,briefTitle:string>,statusModule:struct<overallStatus:string,startDateStruct:struct<date:string>,completionDateStruct:struct<date:string>>,
 designModule:struct<studyType:string,phases:array<string>,enrollmentInfo:struct<count:double>>,conditionsModule:struct<conditions:array<string>>,
 armsInterventionsModule:struct<interventions:array<struct<type:string,name:string>>>,sponsorCollaboratorsModule:struct<leadSponsor:struct<name:string>>>"""


def clinical_trials(rows: DataFrame, raw: str = "raw") -> DataFrame:
    p = lambda path: F.col(f"j.protocolSection.{path}")
    given = F.transform(p("armsInterventionsModule.interventions"), lambda i: F.when(i["name"] != "", F.concat(F.coalesce(i["type"], F.lit("None")), F.lit(":"), i["name"])))
    return _read(rows, raw, _STUDY).select(
        p("identificationModule.nctId").alias("nct_id"), p("identificationModule.briefTitle").alias("title"), p("statusModule.overallStatus").alias("status"), p("designModule.studyType").alias("study_type"),
        joined(p("designModule.phases")).alias("phases"), p("designModule.enrollmentInfo.count").try_cast("int").alias("enrollment"), p("statusModule.startDateStruct.date").alias("start_date"), p("statusModule.completionDateStruct.date").alias("completion_date"),
        joined(p("conditionsModule.conditions")).alias("conditions"), joined(given).alias("interventions"), p("sponsorCollaboratorsModule.leadSponsor.name").alias("lead_sponsor"),
    )


_NAME = "fullName:struct<value:string>,shortNames:array<struct<value:string>>"
_PROTEIN = f"""primaryAccession string, uniProtkbId string, proteinDescription struct<recommendedName:struct<{_NAME}>,alternativeNames:array<struct<{_NAME}>>,submissionNames:array<struct<{_NAME}>>>,
 genes array<struct<geneName:struct<value:string>,synonyms:array<struct<value:string>>>>, organism struct<scientificName:string>, sequence struct<length:int>,
 comments array<struct<commentType:string,texts:array<struct<value:string>>>>, uniProtKBCrossReferences array<struct<database:string,id:string>>"""


def uniprot_proteins(rows: DataFrame, raw: str = "raw") -> DataFrame:
    j, d = F.col("j"), F.col("j.proteinDescription")
    empty = F.array().cast("array<string>")
    names = lambda b: F.concat(F.array(b["fullName"]["value"]), F.coalesce(F.transform(b["shortNames"], lambda s: s["value"]), empty))
    blocks = F.concat(F.when(d["recommendedName"].isNotNull(), names(d["recommendedName"])).otherwise(empty), F.coalesce(F.flatten(F.transform(d["alternativeNames"], names)), empty))
    synonyms = F.coalesce(F.flatten(F.transform(j["genes"], lambda g: F.coalesce(F.transform(g["synonyms"], lambda s: s["value"]), empty))), empty)
    refs = lambda db: F.transform(F.filter(j["uniProtKBCrossReferences"], lambda x: x["database"] == db), lambda x: x["id"])
    told = F.filter(j["comments"], lambda c: (c["commentType"] == "FUNCTION") & (F.size(c["texts"]) > 0))
    return _read(rows, raw, _PROTEIN).select(
        j["primaryAccession"].alias("accession"), j["uniProtkbId"].alias("entry_name"), F.coalesce(d["recommendedName"]["fullName"]["value"], F.when(d["recommendedName"].isNull(), F.get(d["submissionNames"], F.lit(0))["fullName"]["value"])).alias("protein_name"),
        F.get(j["genes"], F.lit(0))["geneName"]["value"].alias("gene"), j["organism"]["scientificName"].alias("organism"), j["sequence"]["length"].alias("length"), F.get(F.get(told, F.lit(0))["texts"], F.lit(0))["value"].alias("function"),
        joined(refs("PDB")).alias("pdb_ids"), F.get(refs("ChEMBL"), F.lit(0)).alias("chembl_target"), joined(F.array_distinct(F.concat(blocks, synonyms))).alias("aliases"),
    )


def pdb_structures(rows: DataFrame, raw: str = "raw", pdb_id: str = "pdb_id") -> DataFrame:
    ddl = "struct struct<title:string>, rcsb_entry_info struct<experimental_method:string,resolution_combined:array<double>>"
    return _read(rows, raw, ddl).select(F.col(pdb_id).alias("pdb_id"), F.col("j.struct.title").alias("title"), F.col("j.rcsb_entry_info.experimental_method").alias("method"), F.get("j.rcsb_entry_info.resolution_combined", F.lit(0)).alias("resolution"))


def pubchem_compounds(rows: DataFrame, raw: str = "raw", query: str = "query") -> DataFrame:
    ddl = "CID bigint, IUPACName string, MolecularFormula string, MolecularWeight string, XLogP string, CanonicalSMILES string, InChIKey string"
    j = F.col("j")
    return _read(rows, raw, ddl).select(j["CID"].alias("cid"), F.col(query).alias("query"), j["IUPACName"].alias("iupac_name"), j["MolecularFormula"].alias("molecular_formula"), _real(j["MolecularWeight"]).alias("mw"), _real(j["XLogP"]).alias("xlogp"), j["CanonicalSMILES"].alias("smiles"), j["InChIKey"].alias("inchi_key"))


def ensembl_genes(rows: DataFrame, raw: str = "raw", gene: str = "gene") -> DataFrame:
    ddl = "id string, biotype string, seq_region_name string, start bigint, end bigint, strand int, description string"
    j = F.col("j")
    return _read(rows, raw, ddl).select(F.col(gene).alias("gene"), j["id"].alias("ensembl_id"), j["biotype"].alias("biotype"), j["seq_region_name"].alias("chromosome"), j["start"].alias("start"), j["end"].alias("end"), j["strand"].alias("strand"), j["description"].alias("description"))


def binding_affinities(rows: DataFrame, raw: str = "raw", accession: str = "accession") -> DataFrame:
    """raw: one affinity. Relations such as > before the number are dropped."""
    ddl = "query string, monomerid string, smile string, affinity_type string, affinity string, pmid string, doi string"
    j, none = F.col("j"), F.lit("")
    value = _real(F.regexp_replace(j["affinity"], "^[<>=~ ]+", ""))
    return _read(rows, raw, ddl).select(F.col(accession).alias("accession"), j["query"].alias("target"), j["monomerid"].alias("monomer_id"), j["smile"].alias("smiles"), j["affinity_type"].alias("affinity_type"), value.alias("affinity_nm"), F.nullif(j["pmid"], none).alias("pmid"), F.nullif(j["doi"], none).alias("doi"))


_WORK = """id string, doi string, title string, abstract_inverted_index map<string,array<int>>, primary_location struct<source:struct<display_name:string>>, publication_year int, type string,
 authorships array<struct<author:struct<display_name:string>>>, concepts array<struct<display_name:string>>, cited_by_count int"""


def openalex_works(rows: DataFrame, raw: str = "raw") -> DataFrame:
    j = F.col("j")
    return _read(rows, raw, _WORK).select(
        F.element_at(F.split(F.regexp_replace(F.coalesce(j["id"], F.lit("")), "/+$", ""), "/"), -1).alias("id"), F.nullif(F.replace(j["doi"], F.lit("https://doi.org/"), F.lit("")), F.lit("")).alias("doi"), j["title"].alias("title"),
        inverted_to_text(j["abstract_inverted_index"]).alias("abstract"), j["primary_location"]["source"]["display_name"].alias("journal"), j["publication_year"].alias("pub_year"), j["type"].alias("type"),
        F.coalesce(joined(F.transform(j["authorships"], lambda a: a["author"]["display_name"]), ", "), F.lit("")).alias("authors"), F.coalesce(joined(F.transform(j["concepts"], lambda c: c["display_name"])), F.lit("")).alias("concepts"), j["cited_by_count"].alias("cited_by"),
    )


def patents(rows: DataFrame, raw: str = "raw") -> DataFrame:
    ddl = "patent_id string, patent_title string, patent_abstract string, patent_date string, assignees array<struct<assignee_organization:string>>, cpc_current array<struct<cpc_group_id:string>>"
    j = F.col("j")
    empty = F.array().cast("array<string>")
    owners, classes = F.coalesce(F.transform(j["assignees"], lambda a: a["assignee_organization"]), empty), F.coalesce(F.transform(j["cpc_current"], lambda c: c["cpc_group_id"]), empty)
    return _read(rows, raw, ddl).select(j["patent_id"].alias("patent_id"), j["patent_title"].alias("title"), j["patent_abstract"].alias("abstract"), F.nullif(F.substring(j["patent_date"], 1, 4), F.lit("")).alias("pub_year"), joined(owners).alias("assignees"), joined(F.concat(owners, classes)).alias("keywords"))


def surechembl_patents(rows: DataFrame) -> DataFrame:
    """From the columnar patent table: patent_number, country, title, publication_date, cpc and assignee arrays."""
    return rows.select("patent_number", "country", "title", F.substring(F.col("publication_date").cast("string"), 1, 4).alias("pub_year"), joined(F.col("assignee")).alias("assignees"), joined(F.col("cpc")).alias("keywords"))


_EPMC = """pmcid string, pmid string, doi string, title string, journalTitle string, journalInfo struct<journal:struct<title:string>>, pubYear string, authorString string, abstractText string,
 meshHeadingList struct<meshHeading:array<struct<descriptorName:string>>>, keywordList struct<keyword:array<string>>, grantsList struct<grant:array<struct<agency:string>>>, citedByCount int"""


def europepmc_hits(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """Hits with a full-text id."""
    j = F.col("j")
    agencies = F.array_sort(F.array_distinct(F.transform(j["grantsList"]["grant"], lambda g: g["agency"])))
    return _read(rows, raw, _EPMC).filter("j.pmcid <> ''").select(
        j["pmcid"].alias("pmcid"), j["pmid"].alias("pmid"), j["doi"].alias("doi"), j["title"].alias("title"), F.coalesce(F.nullif(j["journalTitle"], F.lit("")), j["journalInfo"]["journal"]["title"]).alias("journal"), j["pubYear"].alias("pub_year"),
        j["authorString"].alias("authors"), j["abstractText"].alias("abstract"), joined(F.transform(j["meshHeadingList"]["meshHeading"], lambda m: m["descriptorName"])).alias("mesh"), joined(j["keywordList"]["keyword"]).alias("keywords"), joined(agencies).alias("grants"), j["citedByCount"].alias("cited_by"),
    )


def google_patents(rows: DataFrame, keyword: str, limit: int) -> DataFrame:
    """Keyword search over localized titles and abstracts (arrays of structs): English ones, the word in the abstract."""
    word = F.lit(keyword.lower().replace("\\", "").replace("'", "").replace("%", ""))
    english = lambda c: F.filter(c, lambda t: t["language"] == "en")
    hit = F.exists(english(F.col("abstract_localized")), lambda a: F.lower(a["text"]).contains(word))
    first = lambda c: F.get(english(F.col(c)), F.lit(0))["text"]
    out = rows.filter(hit).select(F.col("publication_number").alias("patent_number"), F.col("country_code").alias("country"), first("title_localized").alias("title"), first("abstract_localized").alias("abstract"), F.col("publication_date").cast("string").alias("pub_date"), F.get("assignee_harmonized", F.lit(0))["name"].alias("assignee"))
    return out.orderBy("patent_number").limit(limit)


def patents_disclosing(compounds: DataFrame, mapping: DataFrame, patents: DataFrame, inchi_keys: DataFrame, limit: int) -> DataFrame:
    """The newest ``limit`` patents that disclose one of the compounds (inchi_keys: one column inchi_key): two semi-joins, the key list first."""
    keys = inchi_keys.select("inchi_key").filter("inchi_key is not null").distinct()
    wanted = compounds.join(keys, "inchi_key", "left_semi").select(F.col("id").alias("compound_id"))
    ids = mapping.join(wanted, "compound_id", "left_semi").select(F.col("patent_id").alias("id"))
    out = patents.join(ids, "id", "left_semi").select("patent_number", "country", "title", "publication_date", "cpc", "assignee")
    return out.orderBy(F.desc_nulls_last("publication_date"), "patent_number").limit(limit)


def _under(node, key: str) -> Iterator:
    """Everything that stands under a key, at any depth, in the order of the reply; lists come one by one."""
    for k, v in node.items() if isinstance(node, dict) else enumerate(node) if isinstance(node, list) else ():
        if k == key:
            yield from v if isinstance(v, list) else [v]
        yield from _under(v, key)


def _value(node) -> str:
    return str(node.get("$") or "") if isinstance(node, dict) else ""


def _numbers(node) -> list[tuple[str, str | None]]:
    """(number, country) of the document ids below a node that have one."""
    ids = [[_value(d.get(k)) for k in ("country", "doc-number", "kind")] for d in _under(node, "document-id") if isinstance(d, dict)]
    return [("".join(x), x[0] or None) for x in ids if x[1]]


def _titles(node) -> list[str]:
    """Titles below a node, English ones first."""
    found = [t for t in _under(node, "invention-title") if _value(t)]
    return [_value(t) for t in sorted(found, key=lambda t: t.get("@lang") != "en")]


def ops_records(reply) -> list[dict]:
    """Publications of a bibliographic reply, one for each exchange document with its own title. A reply without those pairs numbers and titles by position."""
    row = lambda number, title: {"patent_number": number[0], "country": number[1], "title": title}
    documents = [d for d in _under(reply, "exchange-document") if isinstance(d, dict)]
    if documents:
        out = []
        for d in documents:
            named = [("".join(str(d.get(f"@{k}") or "") for k in ("country", "doc-number", "kind")), d.get("@country"))] if d.get("@doc-number") else _numbers(d)
            out += [row(named[0], next(iter(_titles(d)), None))] if named else []
        return out
    return [row(number, title) for number, title in zip_longest(_numbers(reply), [_value(t) for t in _under(reply, "invention-title") if _value(t)]) if number]
