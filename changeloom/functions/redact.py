"""Redaction and YAML: stable hashes of sensitive text, also inside documents.

Names are matched when the plan is built (top level) or per document path (inside YAML or
JSON). Only the hash and the documents need Python, in Arrow batches; a table without
matching columns has neither.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import yaml
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from .cityhash import city_hash64

_RUBY_HEADER = "--- !ruby/hash:ActiveSupport::HashWithIndifferentAccess"


class Patterns:
    """A list of unanchored regexes; a name matches if any is found in it."""

    def __init__(self, patterns: tuple[str, ...] = ()):
        self.patterns = tuple(patterns)
        self._compiled = tuple(re.compile(p) for p in self.patterns)
        self.matches = lru_cache(maxsize=65_536)(self._any)

    def _any(self, name: str) -> bool:
        return any(p.search(name) for p in self._compiled)

    def __bool__(self) -> bool:
        return bool(self.patterns)

    def __reduce__(self):
        return Patterns, (self.patterns,)


class Redaction:
    """What to hash and what to keep; the skip list wins."""

    def __init__(self, anonymize: tuple[str, ...] = (), skip: tuple[str, ...] = ()):
        self.anonymize, self.skip = Patterns(anonymize), Patterns(skip)

    def applies(self, *paths: str) -> bool:
        """Any spelling of the path is to be hashed and none is to be kept."""
        return any(map(self.anonymize.matches, paths)) and not any(map(self.skip.matches, paths))


@pandas_udf(StringType())
def _hash_text(values):
    hashes = city_hash64(pa.array(values, pa.string()))
    return values.where(values.isna(), hashes.astype(str))


def hash_text(text: Column) -> Column:
    """The hash as decimal text; null stays null."""
    return _hash_text(text)


class _Loader(getattr(yaml, "CSafeLoader", yaml.SafeLoader)):
    """Core scalars only: null, booleans, integers, floats; all else is text, keys too. Read by
    the C library where it is there."""


_Loader.yaml_implicit_resolvers = {}
for _tag, _regex, _first in (
    ("null", r"^(?:~|null|Null|NULL|)$", ["~", "n", "N", ""]),
    ("bool", r"^(?:true|True|TRUE|false|False|FALSE)$", list("tTfF")),
    ("int", r"^[-+]?(?:0|[1-9][0-9]*)$", list("-+0123456789")),
    ("float", r"^[-+]?(?:\.[0-9]+|[0-9]+\.[0-9]*)(?:[eE][-+]?[0-9]+)?$|^[-+]?[0-9]+[eE][-+]?[0-9]+$", list("-+.0123456789")),
):
    _Loader.add_implicit_resolver(f"tag:yaml.org,2002:{_tag}", re.compile(_regex), _first)


def _any_tag(loader: _Loader, _: str, node: yaml.Node):
    if isinstance(node, yaml.MappingNode):
        return loader.construct_mapping(node, deep=True)
    return loader.construct_sequence(node, deep=True) if isinstance(node, yaml.SequenceNode) else loader.construct_scalar(node)


_Loader.add_multi_constructor("", _any_tag)


def _bare(key: str) -> str:
    """A key without one leading colon; an empty key stays empty."""
    return key[1:] if key.startswith(":") else key


def _key(key: object) -> str:
    if key is None:
        return "null"
    return str(key).lower() if isinstance(key, bool) else str(key)


class _Hidden:
    """The place of a text that is to be hashed, by its number in a batch."""

    def __init__(self, number: int):
        self.number = number


def redact_document(value, raw: str, bare: str, rules: Redaction, hash_all: bool, hidden: list[str]):
    """A document's value with text under matching paths taken out into `hidden`. Paths are
    tested with and without the colons of their keys."""
    if isinstance(value, dict):
        return {_bare(_key(k)): redact_document(v, f"{raw}.{_key(k)}", f"{bare}.{_bare(_key(k))}", rules, hash_all, hidden) for k, v in value.items()}
    if isinstance(value, list):
        return [redact_document(v, f"{raw}.{i}", f"{bare}.{i}", rules, hash_all, hidden) for i, v in enumerate(value)]
    if isinstance(value, str) and (hash_all or rules.applies(raw, bare)):
        hidden.append(value)
        return _Hidden(len(hidden) - 1)
    return value


def read_yaml(text: str):
    """A YAML object; what can't be read is kept with its error."""
    text = text.replace(_RUBY_HEADER, "---", 1)
    try:
        found = yaml.load(text, _Loader)  # noqa: S506 - a safe loader
        if found is None:
            found = {}
        if not isinstance(found, dict):
            raise yaml.YAMLError(f"not a mapping: {type(found).__name__}")
    except (yaml.YAMLError, ValueError, TypeError, RecursionError) as error:
        found = {"rawYaml": text, "errorParsingYaml": str(error)}
    return found


def redact_documents(texts: list[str | None], path: str, rules: Redaction, as_yaml: bool, hash_all: bool = False) -> list[str | None]:
    """Documents as JSON text, redacted by path, all hidden text hashed at once as 64-bit numbers.

    YAML objects have sorted keys. JSON documents may be of any kind; one that can't be read is
    redacted as a whole.
    """
    hidden: list[str] = []
    found: list = []
    for text in texts:
        if text is None:
            found.append(None)
            continue
        try:
            value = read_yaml(text) if as_yaml else json.loads(text)
        except ValueError:
            if hash_all or rules.anonymize:
                hidden.append(text)
                found.append(_Hidden(len(hidden) - 1))
            else:
                found.append(text)
            continue
        found.append([redact_document(value, path, path, rules, hash_all, hidden)])
    hashes = city_hash64(pa.array(hidden, pa.string())).tolist() if hidden else []
    spell = lambda o: hashes[o.number] if isinstance(o, _Hidden) else str(o)
    out: list[str | None] = []
    for value in found:
        if isinstance(value, list):
            out.append(json.dumps(value[0], sort_keys=as_yaml, ensure_ascii=False, default=spell))
        else:
            out.append(str(spell(value)) if isinstance(value, _Hidden) else value)
    return out


def yaml_to_json(text: str | None, path: str, rules: Redaction, hash_all: bool = False) -> str | None:
    return redact_documents([text], path, rules, True, hash_all)[0]


def json_document(text: str | None, path: str, rules: Redaction, hash_all: bool = False) -> str | None:
    return redact_documents([text], path, rules, False, hash_all)[0]


def document_udf(path: str, rules: Redaction, as_yaml: bool, hash_all: bool = False):
    """A vectorised function over a column of YAML or JSON documents."""

    @pandas_udf(StringType())
    def run(values):
        texts = [None if missing else t for t, missing in zip(values, values.isna(), strict=True)]
        return pd.Series(redact_documents(texts, path, rules, as_yaml, hash_all), index=values.index, dtype=object)

    return run


def redact_text(text: Column, table: str, column: str, rules: Redaction, uint64: bool) -> Column:
    """A top-level text column: hashed if its name says so, or if the destination is a number."""
    if uint64 or rules.applies(f"{table}.{column}"):
        return hash_text(text)
    return text
