"""Names of types and topics, brought to one form by rules of a configuration."""

from __future__ import annotations

import re
import tomllib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a type may be named (pkg/Type, pkg/msg/Type, pkg.Type); `*` may stand for the last part of a rule.
TYPE_NAME = re.compile(r"^[A-Za-z][A-Za-z0-9_]*([./][A-Za-z][A-Za-z0-9_]*)*([./]\*)?$")


def _renamed(name: Column, exact: dict[str, str], prefixes: dict[str, str]) -> Column:
    """The exact rule's name, else that of the longest prefix rule with its rest kept, else the name itself."""
    out = name
    for start, to in sorted(prefixes.items(), key=lambda x: len(x[0])):
        out = F.when(name.startswith(start), F.concat(F.lit(to), F.substr(name, F.lit(len(start) + 1)))).otherwise(out)
    if exact:
        table = F.create_map(*[F.lit(x) for pair in sorted(exact.items()) for x in pair])
        out = F.coalesce(F.try_element_at(table, name), out)
    return out


def _split(rules: dict[str, str]) -> tuple[dict[str, str], dict[str, str]]:
    wild = {k[:-1]: v.removesuffix("*") for k, v in rules.items() if k.endswith("*")}
    return {k: v for k, v in rules.items() if not k.endswith("*")}, wild


@dataclass(frozen=True)
class Normalize:
    """A topic's own type rule goes before exact type rules, and these before wildcards; of wildcards the longest holds."""

    types: dict[str, str] = field(default_factory=dict)
    topic_types: tuple[tuple[str, str, str], ...] = ()
    topics: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for name in [*self.types, *self.types.values(), *(x for r in self.topic_types for x in r[1:])]:
            if not TYPE_NAME.match(name):
                raise ValueError(f"{name!r} is no type name")
        if any(k.endswith("*") != v.endswith("*") for rules in (self.types, self.topics) for k, v in rules.items()):
            raise ValueError("a wildcard goes to a wildcard")

    def type_of(self, topic: Column, name: Column) -> Column:
        out = _renamed(name, *_split(self.types))
        for t, old, new in self.topic_types:
            out = F.when((topic == t) & (name == old), F.lit(new)).otherwise(out)
        return out

    def topic_of(self, topic: Column) -> Column:
        return _renamed(topic, *_split(self.topics))

    def applied(self, messages: DataFrame) -> DataFrame:
        """messages(topic, type) with both renamed; type rules see topics as they were."""
        return messages.withColumns({"type": self.type_of(F.col("topic"), F.col("type")), "topic": self.topic_of(F.col("topic"))})


def normalize_from_toml(text: str) -> Normalize:
    """[type_mappings], [wildcard_mappings], [[topic_type_mappings]] topic, from, to, and [[topic_mappings]] from, to."""
    raw = tomllib.loads(text)
    own = tuple((r["topic"], r["from"], r["to"]) for r in raw.get("topic_type_mappings", []))
    return Normalize(raw.get("type_mappings", {}) | raw.get("wildcard_mappings", {}), own, {r["from"]: r["to"] for r in raw.get("topic_mappings", [])})
