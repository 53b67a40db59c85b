"""Topologies from properties (T4, T5, J24): sources, processors with one or more parents, sinks."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from taskspire.operators.upsert import union_all

Processor = Callable[[DataFrame], DataFrame]


@dataclass
class Topology:
    """Nodes by name. A processor's input is the union of its parents."""

    sources: dict[str, list[str]] = field(default_factory=dict)
    processors: dict[str, tuple[str, list[str]]] = field(default_factory=dict)
    sinks: dict[str, tuple[str, list[str]]] = field(default_factory=dict)

    @classmethod
    def of(cls, properties: dict[str, str]) -> Topology:
        """From 'sources = a,b', 'a.topics = t,u', 'processors = p', 'p.class = module:function', 'p.parents = a,b', 'sinks = s', 's.topic = t', 's.parents = p'."""
        names = lambda k: [x.strip() for x in properties.get(k, "").split(",") if x.strip()]
        out = cls({s: names(f"{s}.topics") for s in names("sources")}, {p: (properties[f"{p}.class"], names(f"{p}.parents")) for p in names("processors")}, {s: (properties[f"{s}.topic"], names(f"{s}.parents")) for s in names("sinks")})
        known = {*out.sources, *out.processors}
        for name, (_, parents) in {**out.processors, **out.sinks}.items():
            if not parents or not set(parents) <= known:
                raise ValueError(f"{name} has unknown parents or none: {parents}")
        out.order()
        return out

    def order(self) -> list[str]:
        """Processors, each after its parents; a cycle is an error."""
        done: list[str] = []
        rest = dict(self.processors)
        while rest:
            ready = [p for p, (_, parents) in rest.items() if all(x in self.sources or x in done for x in parents)]
            if not ready:
                raise ValueError(f"a cycle among {sorted(rest)}")
            done += ready
            for p in ready:
                del rest[p]
        return done

    def build(self, read: Callable[[list[str]], DataFrame], supply: dict[str, Processor] | None = None) -> dict[str, DataFrame]:
        """The tables or streams of all sinks, by topic. Processors come from ``supply`` or by import path."""
        nodes = {name: read(topics) for name, topics in self.sources.items()}
        for p in self.order():
            path, parents = self.processors[p]
            nodes[p] = self._processor(path, supply or {})(union_all(*(nodes[x] for x in parents)))
        return {topic: union_all(*(nodes[x] for x in parents)) for topic, parents in self.sinks.values()}

    @staticmethod
    def _processor(path: str, supply: dict[str, Processor]) -> Processor:
        if path in supply:
            return supply[path]
        module, _, name = path.partition(":")
        return getattr(importlib.import_module(module), name)
