"""Command line: python -m corpusengine.cli --root FOLDER <command>."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import functions as F

from corpusengine.operators import events
from corpusengine.plans import analysis, corpus, graph, harvest, retrieval, suggest
from corpusengine.schemas import schema
from corpusengine.session import session
from corpusengine.sources import connectors
from corpusengine.store import Store


def _events_ingest(s: Store, a) -> object:
    events.generate(s.spark, a.n, a.seed).select(*schema("events_raw").names).write.mode("append").json(s.raw("events"))
    return {"ingested": a.n}


def _events_store(s: Store, a) -> object:
    return {"events_raw": s.write("events_raw", s.spark.read.schema(schema("events_raw")).json(s.raw("events"))).count()}


def _events_process(s: Store, a) -> object:
    silver = s.write("events", events.clean(s.read("events_raw")))
    return {"events": silver.count(), "daily_metrics": s.write("daily_metrics", events.daily(silver)).count()}


def _events_query(s: Store, a) -> object:
    rows, e = (lambda df: [list(r) for r in df.collect()]), s.read("events")
    return {"totals": rows(events.totals(e)), "by_type": rows(events.by_type(e)), "countries": rows(events.top_revenue(e, "country")), "daily": rows(events.daily_revenue(s.read("daily_metrics")).withColumn("event_date", F.col("event_date").cast("string")))}


def _events_run(s: Store, a) -> object:
    return [f(s, a) for f in (_events_ingest, _events_store, _events_process, _events_query)]


def _fetch(registry: dict[str, Callable]) -> Callable:
    def run(s: Store, a) -> object:
        return {a.source: registry[a.source](s, a.query, limit=a.limit)}

    return run


def _report(s: Store, a) -> object:
    text = analysis.sheet(analysis.facts(s))
    if a.topic:
        found = retrieval.retrieve(s, a.topic, 8, graph=False)["chunks"]
        text += "\n\n## Evidence\n" + "\n".join(f"- [{x['id']}] {x['text'][:320].strip()}" for x in found)
    if a.save:
        s.put_text(f"reports/{datetime.now(UTC):%Y-%m-%dT%H%M%S}.md", text)
    return text


def _serve(s: Store, a) -> object:
    from corpusengine.api import serve

    serve(s, a.host, a.port).serve_forever()
    return None


Q = ("query", {})
K = ("-k", {"type": int, "default": 8})
_FETCH = [("--source", {"required": True}), Q, ("--limit", {"type": int, "default": 25})]
_EVENTS = [("--n", {"type": int, "default": 10_000}), ("--seed", {"type": int, "default": 0})]
_TOPICS = [("--topics", {"default": "topics.json"})]

#: command path -> (what it does, its arguments)
COMMANDS: dict[tuple[str, ...], tuple[Callable, list]] = {
    ("corpus", "fetch"): (_fetch(connectors.DOCUMENTS), _FETCH),
    ("corpus", "build"): (lambda s, a: corpus.build(s), []),
    ("corpus", "run"): (lambda s, a: [_fetch(connectors.DOCUMENTS)(s, a), corpus.build(s)], _FETCH),
    ("corpus", "report"): (lambda s, a: corpus.report(s), []),
    ("corpus", "search"): (lambda s, a: corpus.search(s, a.query, a.k), [Q, K]),
    ("corpus", "index"): (lambda s, a: retrieval.build_index(s, a.backend, a.dims, force=a.force), [("--backend", {"default": "lsa"}), ("--dims", {"type": int, "default": 128}), ("--force", {"action": "store_true"})]),
    ("corpus", "semantic"): (lambda s, a: [list(r) for r in (retrieval.rank(s, a.query, a.k) or s.spark.range(0)).collect()], [Q, K]),
    ("data", "fetch"): (_fetch(connectors.STRUCTURED), _FETCH),
    ("data", "build"): (lambda s, a: graph.load_datasets(s), []),
    ("data", "report"): (lambda s, a: analysis.datasets(s), []),
    ("links", "build"): (lambda s, a: graph.build(s), []),
    ("links", "report"): (lambda s, a: [list(r) for r in analysis.connectivity(s).collect()], []),
    ("links", "explore"): (lambda s, a: analysis.explore_drug(s, a.query), [Q]),
    ("links", "protein"): (lambda s, a: analysis.explore_protein(s, a.query), [Q]),
    ("links", "discover"): (lambda s, a: retrieval.papers_for_drug(s, a.query, a.k), [Q, K]),
    ("links", "discover-protein"): (lambda s, a: retrieval.papers_for_gene(s, a.query, a.k), [Q, K]),
    ("facts",): (lambda s, a: analysis.facts(s) if a.json else analysis.sheet(analysis.facts(s)), [("--json", {"action": "store_true"})]),
    ("report",): (_report, [("--topic", {}), ("--save", {"action": "store_true"})]),
    ("validate",): (lambda s, a: analysis.validate(s), [("--json", {"action": "store_true"})]),
    ("rag",): (
        lambda s, a: retrieval.retrieve(s, a.query, a.k, not a.no_graph, min_score=a.min_score, sources=a.source, sec_types=a.section, kinds=a.kind),
        [Q, K, ("--no-graph", {"action": "store_true"}), ("--min-score", {"type": float, "default": 0.0}), ("--source", {"action": "append"}), ("--section", {"action": "append"}), ("--kind", {"action": "append"})],
    ),
    ("serve",): (_serve, [("--host", {"default": "127.0.0.1"}), ("--port", {"type": int, "default": 8787})]),
    ("harvest",): (lambda s, a: harvest.run(s, a.topics, a.limit), [*_TOPICS, ("--limit", {"type": int, "default": 15})]),
    ("suggest",): (lambda s, a: suggest.suggest(analysis.facts(s), a.topics, a.per_source, a.total, a.dry_run), [*_TOPICS, ("--per-source", {"type": int, "default": 3}), ("--total", {"type": int, "default": 40}), ("--dry-run", {"action": "store_true"})]),
    ("rebuild",): (lambda s, a: harvest.rebuild(s), []),
    ("run",): (_events_run, _EVENTS),
    ("ingest",): (_events_ingest, _EVENTS),
    ("store",): (_events_store, []),
    ("process",): (_events_process, []),
    ("query",): (_events_query, []),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="corpusengine")
    top.add_argument("--root", default="data", help="folder of the warehouse, on any file system that Spark reads")
    level = top.add_subparsers(required=True)
    groups: dict[str, object] = {}
    for path, (run, arguments) in COMMANDS.items():
        at = level
        if len(path) == 2:
            if path[0] not in groups:
                groups[path[0]] = level.add_parser(path[0]).add_subparsers(required=True)
            at = groups[path[0]]
        command = at.add_parser(path[-1])
        for name, options in arguments:
            command.add_argument(name, **options)
        command.set_defaults(run=run)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    out = args.run(Store(session(), args.root), args)
    if out is not None:
        print(out if isinstance(out, str) else json.dumps(out, indent=2, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
