"""The whole cycle: structured feeds, datasets, documents, corpus, links, index, validation, suggestions."""

from __future__ import annotations

import json
from datetime import UTC, datetime
from functools import partial

from corpusengine.obs import span
from corpusengine.plans import analysis, corpus, graph, retrieval, suggest
from corpusengine.sources import connectors
from corpusengine.store import Store

STATE = "harvest/state.json"


def state(store: Store) -> dict:
    try:
        return json.loads(store.get_text(STATE) or "{}")
    except ValueError:
        return {}


def rebuild(store: Store, backend: str = "lsa") -> dict:
    """Every layer from what has landed, the index anew."""
    steps = {"datasets": graph.load_datasets, "corpus": corpus.build, "links": graph.build, "index": partial(retrieval.build_index, backend=backend, force=True), "validate": analysis.validate}
    out = {}
    for name, step in steps.items():
        with span(f"rebuild.{name}") as more:
            more["result"] = out[name] = step(store)
    return out


def run(store: Store, topics_path: str, limit: int = 15, backend: str = "lsa", suggestions: bool = True, structured: dict | None = None, documents: dict | None = None) -> dict:
    """Structured searches come first, so that a stop half-way loses documents only."""
    plan, held, now = suggest.topics(topics_path), state(store), datetime.now(UTC).isoformat()
    bind = lambda registry: {name: partial(f, store) for name, f in registry.items()}
    out = {"structured": suggest.harvest(plan.get("structured", {}), bind(connectors.STRUCTURED if structured is None else structured), limit, held, now)}
    out["datasets"] = graph.load_datasets(store)
    store.put_text(STATE, json.dumps(held, indent=2, sort_keys=True))
    out["documents"] = suggest.harvest(plan.get("documents", {}), bind(connectors.DOCUMENTS if documents is None else documents), limit, held, now)
    store.put_text(STATE, json.dumps(held, indent=2, sort_keys=True))
    for name, step in {"corpus": corpus.build, "links": graph.build, "index": partial(retrieval.build_index, backend=backend), "validate": analysis.validate}.items():
        with span(f"harvest.{name}") as more:
            more["result"] = out[name] = step(store)
    if suggestions:
        out["suggested"] = suggest.suggest(analysis.facts(store), topics_path)
    return out
