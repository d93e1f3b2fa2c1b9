"""The document and graph pipelines on the seeded knowledge base."""

import json

import pytest
import seed

from corpusengine import api, cli
from corpusengine.operators import events, merge, quality, retrieval
from corpusengine.plans import analysis, corpus, graph, harvest, suggest
from corpusengine.plans import retrieval as R

EASY = quality.Thresholds(min_title_chars=0, min_body_words=0, min_abstract_words=0)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    from corpusengine.store import Store

    root = str(tmp_path_factory.mktemp("kb"))
    seed.datasets(root)
    seed.documents(root, "europepmc", [
        ("PMC1", seed.article(), {"doi": "10.1/X ", "mesh": "Pain; Opioids"}),
        ("PMC2", seed.article("Duragesic patches", "Patients wore Duragesic patches and slept well."), {"doi": "10.1/y", "title": "Patches", "abstract": "Transdermal delivery."}),
        ("PMC3", "<not valid", {"title": "Broken full text"}),
        ("PMC4", seed.article(), {"title": ""}),
    ])
    seed.documents(root, "openalex", [("openalex:W1", json.dumps({"title": "Fentanyl pharmacology", "abstract": "A study of fentanyl."}), {"doi": "10.1/x", "keywords": "Opioid; Chemistry", "has_body": False}), ("openalex:W2", json.dumps({"title": "Eigenvalues", "abstract": "Spectral theory of matrices."}), {"title": "Eigenvalues", "abstract": "Spectral theory of matrices.", "has_body": False})])
    s = Store(spark, root)
    out = {"datasets": graph.load_datasets(s), "corpus": corpus.build(s, EASY), "links": graph.build(s)}
    out["index"] = R.build_index(s, dims=8, min_df=1)
    return s, out


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_corpus(built):
    s, out = built
    c = out["corpus"]
    assert (c["stored"], c["documents"], c["rejected"]) == (4, 4, 2)
    assert (c["clusters"], c["duplicates"]) == (3, 1)
    assert corpus.quarantine(s) == {"body_missing": 1, "missing_title": 1}
    primary = {r["pmcid"]: r["is_primary"] for r in s.read("doc_clusters").collect()}
    assert primary == {"PMC1": True, "PMC2": True, "openalex:W1": False, "openalex:W2": True}
    assert corpus.search(s, "SPECTRAL")[0]["pmcid"] == "openalex:W2"
    assert corpus.report(s)["mesh"] == [("Opioids", 1), ("Pain", 1)]


def test_rebuild_is_idempotent(built):
    s, out = built
    assert corpus.build(s, EASY) == out["corpus"]


def test_sections(built):
    s, _ = built
    got = [tuple(r) for r in s.read("doc_sections").filter("pmcid = 'PMC1'").orderBy("ordinal").select("ordinal", "sec_type", "sec_kind", "sec_title").collect()]
    assert got == [(0, "title", "title", None), (1, "abstract", "abstract", "abstract"), (2, "body", "results", "Results")]


def test_links(built):
    s, _ = built
    assert ("fentanyl", "fentanyl") in rows(s.read("entity_drug_names")) and ("fentanyl", "duragesic") in rows(s.read("entity_drug_names"))
    assert {r[0] for r in s.read("entity_drugs").select("drug_norm").collect()} == {"fentanyl", "naloxone"}
    assert rows(s.read("link_drug_trial")) == [("fentanyl", "NCT1", True), ("naloxone", "NCT2", None)]
    links = {(r["drug_norm"], r["pmcid"]): r for r in s.read("link_drug_document").collect()}
    assert links["fentanyl", "PMC1"]["confidence"] == "strong" and 0.6 < links["fentanyl", "PMC1"]["score"] <= 1
    assert links["fentanyl", "PMC2"]["confidence"] == "strong" and not links["fentanyl", "PMC2"]["in_metadata"] and links["fentanyl", "PMC2"]["n_body"] == 3  # title and abstract sections count, too
    assert rows(s.read("link_drug_protein")) == [("fentanyl", "C1", "P35372", "OPRM1", "AGONIST")]
    assert {r["pdb_id"] for r in s.read("link_protein_structure").collect()} == {"5C1M", "8E0G"}
    protein = {r["pmcid"]: r for r in s.read("link_protein_document").collect()}
    assert set(protein) == {"PMC1"} and protein["PMC1"]["n_body"] == 2  # its symbol, and an alias with a hyphen
    assert rows(s.read("link_drug_pubchem")) == [("fentanyl", "C1", 3345, "KEY-F")]
    assert rows(s.read("link_protein_gene")) == [("P35372", "OPRM1", "ENSG00000112038")]
    assert ("NCT1", "PMC1", "fentanyl") in rows(s.read("link_trial_document"))


def test_facts(built):
    s, _ = built
    f = analysis.facts(s)
    assert (f["overview"]["unique_papers"], f["overview"]["source_rows"], f["overview"]["cross_source_dupes"]) == (3, 4, 1)
    assert f["trends"] == [[2025, 3]]
    assert f["top_drugs"][0] == ["fentanyl", 4.0, 1, 3, 1] and f["top_targets"] == [["OPRM1", 1, 2, 1]]
    assert f["gaps"]["drugs_without_trials"] == [["naloxone", 4.0]] and f["gaps"]["targets_without_drugs"] == []
    assert f["binding"] == [["OPRM1", "Ki", 2, 1.23]] and f["topics"]["concepts"] == [["Chemistry", 1], ["Opioid", 1]]
    text = analysis.sheet(f)
    assert "_none_" in text and "fentanyl" in text
    assert ["chembl_molecules", 2] in analysis.datasets(s)["rows"]
    assert rows(analysis.connectivity(s)) == [("fentanyl", 4.0, 1, 3)]


def test_explore(built):
    s, _ = built
    d = analysis.explore_drug(s, "Fentanyl citrate")
    assert d["drug"] == "fentanyl" and d["names"] == ["duragesic", "fentanyl"] and d["trials"][0][0] == "NCT1" and d["targets"] == [["OPRM1", "AGONIST"]]
    p = analysis.explore_protein(s, "oprm1")
    assert p["n_structures"] == 2 and [x[0] for x in p["structures"]] == ["5C1M"] and p["drugs"] == [["fentanyl", "AGONIST"]]


def test_validate(built, store):
    s, _ = built
    v = analysis.validate(s)
    assert v["ok"] and v["n_documents"] == 4 and v["quarantined"] == 2 and v["quarantine_reasons"] == {"body_missing": 1, "missing_title": 1}
    assert analysis.validate(store)["n_documents"] == 0
    bad = [("X9", "europepmc", "", 1200, True), ("arXiv:1", "arxiv", "t", 2000, False), (None, "patents", "t", 2000, False)]
    store.write("documents_raw", store.spark.createDataFrame(bad, "pmcid string, source string, title string, pub_year int, has_body boolean"))
    v = analysis.validate(store)
    assert not v["ok"] and v["checks"]["missing_title"] == v["checks"]["year_out_of_range"] == v["checks"]["body_flag_without_sections"] == 1 and v["checks"]["bad_id_format"] == 2


def test_index_and_retrieval(built):
    s, out = built
    again = R.build_index(s, dims=8, min_df=1)
    assert again["skipped"] and again["n_chunks"] == out["index"]["n_chunks"]
    assert not R.build_index(s, dims=8, min_df=1, force=True).get("skipped")
    hit = R.retrieve(s, "spectral theory matrices", 2)
    assert hit["chunks"][0]["id"] == "openalex:W2" and hit["chunks"][0]["score"] > 0.9
    assert {c["source"] for c in R.retrieve(s, "fentanyl", 3, sources=["europepmc"])["chunks"]} == {"europepmc"}
    assert R.retrieve(s, "fentanyl", 3, kinds=["methods"])["n"] == 0
    g = R.retrieve(s, "does fentanyl act on OPRM1?", 2)["graph"]
    assert g["drugs"] == [{"drug": "fentanyl", "matched": "fentanyl", "targets": ["OPRM1"], "trials": 1}] and g["genes"] == [{"gene": "OPRM1", "drugs": ["fentanyl"]}]


def test_discover(built):
    s, _ = built
    profile, papers = R.papers_for_drug(s, "fentanyl")
    assert profile["proteins"] == ["Mu-type opioid receptor"] and papers[0][0] in ("PMC1", "openalex:W1") and papers[0][2]
    assert ("openalex:W2", False) in [(p, d) for p, _, d in papers] or len(papers) < 4
    assert R.papers_for_gene(s, "OPRM1")[0]["drugs"] == ["fentanyl"] and R.papers_for_gene(s, "NOPE")[1] == []


def test_routes(built, monkeypatch):
    s, _ = built
    go = lambda path, ok=True, body=None, **params: api.route(s, "GET", path, {k: [v] for k, v in params.items()}, body or {}, ok)
    assert go("/health", ok=False)[0] == 200 and go("/facts", ok=False)[0] == 401 and go("/nowhere")[0] == 404
    assert go("/retrieve")[0] == 400 and go("/discover")[0] == 400 and go("/retrieve", q="x", k="many")[0] == 400
    assert go("/retrieve", body={"query": "fentanyl", "k": 1})[1]["n"] == 1
    assert go("/discover", gene="OPRM1")[1]["gene"] == "OPRM1"
    monkeypatch.setenv("CORPUSENGINE_API_KEY", "s3cret")
    assert not api.authorised({}) and api.authorised({"Authorization": "Bearer s3cret"})


def test_cli(built, capsys, tmp_path):
    s, _ = built
    assert cli.main(["--root", s.root, "facts"]) == 0 and "# Facts" in capsys.readouterr().out
    assert cli.main(["--root", s.root, "rag", "fentanyl", "-k", "1", "--source", "openalex"]) == 0 and json.loads(capsys.readouterr().out)["n"] == 1
    assert cli.main(["--root", s.root, "report", "--topic", "fentanyl", "--save"]) == 0 and "## Evidence" in capsys.readouterr().out
    assert cli.main(["--root", str(tmp_path), "run", "--n", "200"]) == 0 and json.loads(capsys.readouterr().out)[1] == {"events_raw": 200}


def test_gate(spark):
    ok = dict(pmcid="PMC1", title="A proper title", abstract="word " * 3 + "and some other words that make it long enough", pub_year="2020", has_body=False, body_words=None)
    cases = [
        ({}, ""), ({"title": " "}, "missing_title"), ({"title": "Short"}, "title_too_short"), ({"pmcid": None}, "bad_id"), ({"pub_year": "1200"}, "year_out_of_range"), ({"pub_year": "n.d."}, "year_out_of_range"), ({"pub_year": None}, ""),
        ({"title": "Retracted: a proper title"}, "withdrawn_or_retracted"), ({"title": "On retractions in science"}, ""), ({"abstract": "This article has been withdrawn " + "by its several authors for reasons of their own"}, "withdrawn_or_retracted"),
        ({"has_body": True, "body_words": 0}, "body_missing"), ({"has_body": True, "body_words": 39}, "body_missing"), ({"has_body": True, "body_words": 50, "abstract": None}, ""), ({"abstract": "too short"}, "no_indexable_content"),
        ({"abstract": "12 34 56 78 90 " * 10}, "garbage_text"), ({"abstract": "spam " * 40}, "garbage_text"), ({"title": None, "abstract": None}, "missing_title;no_indexable_content"),
    ]
    rows_ = [tuple((ok | c)[k] for k in ok) + (i,) for i, (c, _) in enumerate(cases)]
    df = spark.createDataFrame(rows_, "pmcid string, title string, abstract string, pub_year string, has_body boolean, body_words long, i int")
    got = quality.gate(df, quality.Thresholds()).orderBy("i").collect()
    assert [r["reasons"] for r in got] == [w for _, w in cases]
    assert json.loads(got[0]["checks"])["abstract_words"] == 12


def test_thresholds_from_env(monkeypatch):
    monkeypatch.setenv("CORPUSENGINE_Q_MIN_TITLE_CHARS", "3")
    monkeypatch.setenv("CORPUSENGINE_Q_YEAR_MAX", "soon")
    assert quality.Thresholds.from_env() == quality.Thresholds(min_title_chars=3)


def test_keyed_landing(store, spark):
    ddl = "chembl_id string, pref_name string"
    assert store.land("chembl_molecules", spark.createDataFrame([("a", "x"), ("b", "x")], ddl), ["chembl_id"]) == (2, 2)
    assert store.land("chembl_molecules", spark.createDataFrame([("a", "y"), ("c", "x"), ("a", "z"), (None, "n")], ddl).coalesce(1), ["chembl_id"]) == (4, 2)
    assert rows(store.feed("chembl_molecules").select("chembl_id", "pref_name")) == [("a", "z"), ("b", "x"), ("c", "x"), (None, "n")]
    ddl = "chembl_id string, syn_type string, name string"
    store.land("chembl_synonyms", spark.createDataFrame([("a", "INN", "x")], ddl), ["chembl_id", "syn_type", "name"])
    assert store.land("chembl_synonyms", spark.createDataFrame([("a", "INN", "x"), ("a", "BAN", "x")], ddl), ["chembl_id", "syn_type", "name"]) == (2, 1)


def test_landings_are_compacted(store, spark, monkeypatch):
    from corpusengine import store as module

    monkeypatch.setattr(module, "MOST_LANDINGS", 2)
    ddl = "chembl_id string, syn_type string, name string"
    for k in range(4):
        assert store.land("chembl_synonyms", spark.createDataFrame([("a", None, f"n{k}"), ("b", "INN", str(k))], ddl), ["chembl_id", "syn_type"]) == (2, 0 if k else 2)
        assert rows(store.feed("chembl_synonyms")) == [("a", None, f"n{k}"), ("b", "INN", str(k))]
    assert len(store._deltas("chembl_synonyms")) == 2


def test_versions(store, spark):
    assert not store.has("doc_clusters") and store.read("doc_clusters").count() == 0
    for n in (1, 2, 3):
        store.write("doc_clusters", spark.range(n).selectExpr("cast(id as string) as pmcid"))
    assert store.read("doc_clusters").count() == 3 and store.read("doc_clusters").columns[-1] == "is_primary"


def test_events(spark):
    e = spark.createDataFrame([("1", "u", "View", "de", "2.5", "2025-01-02T10:00:00+00:00"), ("1", "u", "view", "de", "9", "2025-01-01T10:00:00+00:00"), ("2", "v", "BUY", None, "oops", "2025-01-01T23:30:00+00:00"), (None, "v", "x", "y", "1", "2025-01-01T00:00:00+00:00"), ("3", "v", "x", "y", "1", None)], "event_id string, user_id string, event_type string, country string, value string, ts string")
    silver = events.clean(e)
    assert [(r["event_id"], r["event_type"], r["country"], r["value"], str(r["event_date"])) for r in silver.orderBy("event_id").collect()] == [("1", "view", "DE", 9.0, "2025-01-01"), ("2", "buy", None, None, "2025-01-01")]
    a, b = events.generate(spark, 500, 1), events.generate(spark, 500, 2)
    assert a.select("event_id").exceptAll(b.select("event_id")).count() == 0 and a.exceptAll(events.generate(spark, 500, 1)).count() == 0
    assert events.clean(a.unionByName(b)).count() == 500 and a.filter("value is not null and event_type <> 'purchase'").count() == 0


def test_streaming_twin(spark, tmp_path):
    from corpusengine.streaming import events as stream

    src = str(tmp_path / "in")
    events.generate(spark, 300, 3).unionByName(events.generate(spark, 300, 3)).write.json(src)
    raw = spark.readStream.schema("event_id string, user_id string, event_type string, country string, value double, ts string").json(src)
    q = stream.cleaned(raw).writeStream.format("memory").queryName("cleaned_events").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("cleaned_events").count() == 300
    stream.run(stream.daily(stream.cleaned(raw)), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0


def test_clusters(spark):
    df = spark.createDataFrame([("b", "k", 1), ("a", "k", 1), ("c", None, 0), ("d", "k", 0)], "id string, key string, pref int")
    from pyspark.sql import functions as F

    assert rows(merge.clusters(df, "id", F.col("key"), F.col("pref")).select("id", "cluster_id", "is_primary")) == [("a", "k", False), ("b", "k", False), ("c", "c", True), ("d", "k", True)]


def test_retrieval_quality(spark, store):
    texts = [("PMC_NLX", "Naloxone reverses opioid overdose as a receptor antagonist in emergencies."), ("PMC_BUP", "Buprenorphine is a partial agonist for treatment of opioid dependence."), ("PMC_MATH", "Eigenvalue problems of symmetric matrices and spectral decomposition."), ("PMC_GEO", "Rivers carry sediment and shape valleys over time.")]
    store.write("doc_chunks", spark.createDataFrame([(p, 0, t) for p, t in texts], "pmcid string, chunk_id int, text string"))
    R.build_index(store, dims=16, min_df=1)
    gold = [("overdose antagonist", "PMC_NLX"), ("partial agonist", "PMC_BUP"), ("eigenvalue matrices", "PMC_MATH")]
    hits = [(q, r["pmcid"], r["score"]) for q, _ in gold for r in R.rank(store, q, 3).collect()]
    m = retrieval.recall_at(spark.createDataFrame(hits, "query string, id string, score double"), spark.createDataFrame(gold, "query string, id string"), 3).first()
    assert m["recall"] >= 0.66 and m["mrr"] >= 0.5


def test_decomposition_spans_the_right_space(spark):
    import numpy as np

    from corpusengine.operators import vectors

    rng = np.random.RandomState(1)
    words = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(10)]
    texts = [" ".join(rng.choice(words[10 * k : 10 * k + 10], 30)) for k in range(6) for _ in range(20)]
    df = spark.createDataFrame([(str(i), 0, t) for i, t in enumerate(texts)], "pmcid string, chunk_id int, text string")
    m = vectors.fit(df, "text", dims=6, min_df=1)
    i, j, w = m.rows(texts)
    a = np.zeros((len(texts), len(m.terms)))
    a[i, j] = w
    exact = np.linalg.svd(a, full_matrices=False)[2][:6]
    assert np.linalg.svd(exact @ m.directions)[1].min() > 0.999
    v = np.array([r["vector"] for r in vectors.embed(df, "text", m).collect()])
    assert np.allclose(np.linalg.norm(v, axis=1), 1, atol=1e-5) and m.embed(["nothing known"]).any() == False  # noqa: E712


def test_embedding_holds_one_text_at_a_time():
    """All texts' terms x dims numbers at once were 8 GB for a batch of 10,000 documents of 800 terms."""
    import tracemalloc

    import numpy as np

    from corpusengine.operators import vectors

    rng = np.random.RandomState(2)
    names = [f"w{chr(97 + k // 676)}{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}" for k in range(2000)]
    m = vectors.Lsa({t: k for k, t in enumerate(names)}, rng.rand(2000) + 1, rng.randn(2000, 64))
    texts = [" ".join(rng.choice(names, 500)) for _ in range(400)]
    i, j, w = m.rows(texts)
    a = np.zeros((len(texts), 2000))
    a[i, j] = w
    tracemalloc.start()
    got = m.embed(texts)
    embedding = tracemalloc.get_traced_memory()[1]
    total, ends = np.zeros((2000, 64)), np.searchsorted(i, np.arange(len(texts) + 1))
    tracemalloc.reset_peak()
    vectors._add_gram(total, j, w, ends, m.directions)
    product = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    x = a @ m.directions
    assert np.allclose(got, x / np.linalg.norm(x, axis=1, keepdims=True), atol=1e-6) and np.allclose(total, a.T @ x)
    assert embedding < 5e6 and product < 5e6


def test_partitions_without_known_words(spark):
    """As a table of one row group read in many splits: most partitions are empty, some hold no word of the vocabulary."""
    from corpusengine.operators import vectors

    ddl = "pmcid string, chunk_id int, text string"
    df = spark.createDataFrame([("a", 0, "opioid receptor pain"), ("b", 0, "receptor opioid"), ("c", 0, "4 5 6"), ("d", 0, None)], ddl).repartition(50)
    m = vectors.fit(df, "text")
    assert sorted(m.terms) == ["opioid", "receptor"]
    assert {r["pmcid"]: any(r["vector"]) for r in vectors.embed(df, "text", m).collect()} == {"a": True, "b": True, "c": False, "d": False}
    empty = vectors.fit(df.limit(0), "text")
    assert empty.terms == {} and vectors.embed(df.limit(0), "text", empty).collect() == []
    again = vectors.Lsa.of(m.state())
    assert again.embed(["opioid pain"]).tolist() == m.embed(["opioid pain"]).tolist()


def test_backends(spark, monkeypatch):
    import importlib.util
    import pickle
    import sys
    import types

    from corpusengine.operators import vectors

    assert vectors.backend("auto") == ("st" if importlib.util.find_spec("sentence_transformers") else "lsa") and vectors.backend("lsa") == "lsa"
    with pytest.raises(ValueError):
        vectors.backend("none such")
    loads = []

    class Encoder:
        def __init__(self, name):
            loads.append(name)

        def get_sentence_embedding_dimension(self):
            return 2

        def encode(self, texts, batch_size, normalize_embeddings):
            return [[1.0, 0.0] if "a" in t else [0.0, 1.0] for t in texts]

    monkeypatch.setitem(sys.modules, "sentence_transformers", types.SimpleNamespace(SentenceTransformer=Encoder))
    monkeypatch.setattr(vectors.Pretrained, "_loaded", {})
    m = pickle.loads(pickle.dumps(vectors.Pretrained("tiny")))
    assert loads == []  # nothing is loaded before the first text
    assert m.embed_query("a") == [1.0, 0.0] and m.embed(["b", None]).tolist() == [[0.0, 1.0]] * 2 and m.dims == 2 and loads == ["tiny"]
    assert vectors.Pretrained.of(m.state()).dims == 2 and loads == ["tiny"]


def test_refreshed_embeds_only_what_is_new(spark):
    from corpusengine.operators import vectors

    ddl, seen = "pmcid string, chunk_id int, text string", []
    old = spark.createDataFrame([("a", 0, "one"), ("b", 0, "two"), ("c", 0, "three")], ddl)
    new = spark.createDataFrame([("a", 0, "one"), ("b", 0, "changed"), ("d", 0, "four")], ddl)
    index = old.selectExpr("pmcid", "chunk_id", "md5(text) as text_hash", "array(1f) as vector")

    def fresh(df):
        seen.extend(r["pmcid"] for r in df.collect())
        return df.selectExpr("pmcid", "chunk_id", "md5(text) as text_hash", "array(2f) as vector")

    got = {r["pmcid"]: r["vector"][0] for r in vectors.refreshed(new, "text", index, fresh).collect()}
    assert got == {"a": 1.0, "b": 2.0, "d": 2.0} and sorted(seen) == ["b", "d"]


FACTS = {"asymmetries": {"structurally_studied_but_undrugged": [["GPR6", 7, 1]]}, "gaps": {"targets_without_drugs": [["GPR6"], ["HTR7"]], "drugs_without_papers": [["lofexidine"]]}, "top_targets": [["OPRK1", 5, 12, 1], ["OPRD1", 4, 9, 40]], "topics": {"mesh": [["Humans", 90], ["Opioid Epidemic", 12]], "concepts": [["Chemistry", 50], ["Nociception", 8]]}}


def test_suggest(tmp_path):
    path = tmp_path / "topics.json"
    path.write_text(json.dumps({"documents": {"europepmc": ["opioid epidemic"]}, "structured": {"uniprot": ["HTR7"]}}))
    got = suggest.suggest(FACTS, path, per_source=2, dry_run=True)
    assert not suggest.generated_beside(path).exists()
    assert {"Humans", "Chemistry", "Opioid Epidemic", "HTR7"}.isdisjoint({g["query"] for g in got})
    assert max(sum(g["source"] == s for g in got) for s in ("europepmc", "uniprot", "openalex", "pubchem")) == 2
    every = suggest.proposals(FACTS | {"top_targets": [["OPRK1", 5, 12, 1], ["OPRM1", 1, 0, 0], [None, 1]], "gaps": {"targets_without_drugs": [[""], []]}})
    assert [(p["source"], p["query"], p["signal"]) for p in every][:4] == [("europepmc", "GPR6 structure function disease mechanism", 12), ("uniprot", "GPR6", 12), ("europepmc", "OPRK1 signaling pharmacology therapeutic target", 12), ("europepmc", "Opioid Epidemic", 12)]
    assert {p["query"] for p in every}.isdisjoint({"", "Humans", "Chemistry"}) and suggest.proposals({}) == []
    first = suggest.suggest(FACTS, path)
    assert first and suggest.topics(path)["documents"]["europepmc"][0] == "opioid epidemic"
    for _ in range(5):
        suggest.suggest(FACTS, path, total=40)
    assert suggest.suggest(FACTS, path) == []  # nothing new is left
    assert suggest.suggest({"topics": {"mesh": [["Something New", 9]]}}, path, total=1) == []
    assert [x[:2] for x in suggest.stale({"a\tq": {"last_run": "2020-01-01T00:00:00+00:00"}, "b\tq": {"last_run": None}, "c\tq": {"last_run": "bad"}})] == [("a", "q")]


def test_harvest_loop():
    from corpusengine.sources.net import PermanentError

    calls, state = [], {}

    def pages(query, limit, cursor=None):
        calls.append(cursor)
        if cursor == "2":
            raise PermanentError("gone")
        return None, str(int(cursor or 0) + 1)

    def broken(query, limit):
        raise ValueError("no")

    for _ in range(4):
        suggest.harvest({"p": ["q"], "b": ["q"], "unknown": ["q"]}, {"p": pages, "b": broken}, 5, state, "now")
    assert calls == [None, "1", "2", None] and state["p\tq"]["runs"] == 4 and state["b\tq"]["last_ok"] is False and "unknown\tq" not in state


def test_harvest_all(store, tmp_path):
    path = tmp_path / "topics.json"
    path.write_text(json.dumps({"structured": {"chembl": ["fentanyl"]}, "documents": {}}))
    def land(s, query, limit):
        return s.land("chembl_molecules", s.spark.createDataFrame([("C1", "FENTANYL")], "chembl_id string, pref_name string"), ["chembl_id"])

    out = harvest.run(store, str(path), structured={"chembl": land}, documents={})
    assert out["structured"] == 1 and out["datasets"]["chembl_molecules"] == 1 and out["links"]["entity_drugs"] == 1 and harvest.state(store)["chembl\tfentanyl"]["last_ok"]
    assert out["index"]["n_chunks"] == 0 and out["validate"]["ok"]


def test_log(tmp_path, monkeypatch):
    from corpusengine import obs

    monkeypatch.setenv("CORPUSENGINE_LOG", str(tmp_path / "log"))
    with obs.span("good", a=1) as more:
        more["n"] = 2
    with pytest.raises(ValueError), obs.span("bad"):
        raise ValueError("x")
    good, bad = map(json.loads, (tmp_path / "log").read_text().splitlines())
    assert (good["event"], good["ok"], good["a"], good["n"]) == ("good", True, 1, 2) and not bad["ok"] and bad["error"] == "ValueError: x"


def test_rebuild(built):
    s, out = built
    again = harvest.rebuild(s)
    assert again["datasets"] == out["datasets"] and again["links"]["entity_drugs"] == 2 and again["validate"]["n_documents"] == again["corpus"]["documents"]
