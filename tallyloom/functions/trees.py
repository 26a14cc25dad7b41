"""Rich-text trees in JSON strings and text that needs Unicode forms: Arrow UDFs, batch by batch."""

import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.text import plain_slug


def _nodes(value: str | None) -> list[tuple[str, str]]:
    """(path, text) of a tree's text nodes in order; none if the value is no JSON object."""
    try:
        tree = json.loads(value or "")
    except ValueError:
        return []
    found, todo = [], [("", tree)]
    while todo:
        path, node = todo.pop()
        if not isinstance(node, dict):
            continue
        if node.get("type") == "text" and isinstance(node.get("value"), str):
            found.append((path, node["value"]))
        children = node.get("children")
        if isinstance(children, list):
            todo += [(f"{path}.{k}".lstrip("."), child) for k, child in reversed(list(enumerate(children)))]
    return found


@F.pandas_udf(T.StringType())
def rich_text(values: pd.Series) -> pd.Series:
    """Texts of all text nodes, joined by spaces; null without any."""
    return values.map(lambda v: " ".join(t for _, t in _nodes(v)) or None)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("path", T.StringType()), T.StructField("value", T.StringType())])))
def rich_text_nodes(values: pd.Series) -> pd.Series:
    return values.map(lambda v: [{"path": p, "value": t} for p, t in _nodes(v)])


@F.pandas_udf(T.StringType())
def _folded_slug(values: pd.Series) -> pd.Series:
    """Handle in ASCII: compatibility forms taken apart, other letters left out, runs of the rest one hyphen, 255 at most."""

    def slug(v: str | None) -> str | None:
        if v is None:
            return None
        plain = unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode().lower()
        return re.sub("[^a-z0-9]+", "-", plain).strip("-")[:255]

    return values.map(slug)


def ascii_slug(c: Column) -> Column:
    """Handle in ASCII. Only texts with other letters go through Python."""
    plain = F.length(c) == F.octet_length(c)
    return F.coalesce(F.when(plain, plain_slug(c)), _folded_slug(F.when(~plain, c)))


def unicode_slug(c: Column) -> Column:
    """Handle in any script: signs out, & spelled, blanks and hyphens one hyphen."""
    plain = F.length(c) == F.octet_length(c)
    text = F.coalesce(F.when(plain, c), composed(F.when(~plain, c)))
    text = F.replace(F.regexp_replace(text, "[™®©]", ""), F.lit("&"), F.lit("and"))
    text = F.regexp_replace(F.lower(F.regexp_replace(text, r"(?U)[^\w\s-]", "")), r"(?U)[-\s]+", "-")
    return F.regexp_replace(text, "^-+|-+$", "")


def _walk(node, path: tuple = ()):
    """(path, node) of every object and array member, in order."""
    yield path, node
    for key, child in node.items() if isinstance(node, dict) else enumerate(node) if isinstance(node, list) else ():
        if isinstance(child, (dict, list)):
            yield from _walk(child, (*path, key))


def _parsed(value):
    try:
        return json.loads(value)
    except (TypeError, ValueError):
        return None


def _written(tree) -> str:
    return json.dumps(tree, ensure_ascii=False)


@F.pandas_udf(T.StringType())
def with_texts(values: pd.Series, texts: pd.Series) -> pd.Series:
    """Rich-text trees with the texts of some nodes replaced. texts: array of (path, value) with paths as rich_text_nodes gives them; paths that lead
    nowhere are passed over, and a value that is no tree comes back as it is."""

    def one(value, wanted):
        tree = _parsed(value)
        if wanted is None or not isinstance(tree, dict):
            return value
        for item in wanted:
            node = tree
            for step in item["path"].split(".") if item["path"] else ():
                children = node.get("children") if isinstance(node, dict) else None
                node = children[int(step)] if isinstance(children, list) and int(step) < len(children) else None
            if isinstance(node, dict) and node.get("type") == "text":
                node["value"] = item["value"]
        return _written(tree)

    return pd.Series([one(v, t) for v, t in zip(values, texts, strict=True)], dtype=object)


_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")
_LINE_END = re.compile(r"\\?(?:\r\n|\n|\r)")


@F.pandas_udf(T.StringType())
def sane_json(values: pd.Series) -> pd.Series:
    """JSON objects with raw line ends and control characters in their strings, written again without: line ends are escaped first, then all control
    characters left out. What neither mends, and what is no object, comes back as it is."""

    def one(value):
        if not value or not value.strip().startswith("{"):
            return value
        attempts = (lambda: value, lambda: _CONTROL.sub("", _LINE_END.sub(r"\\n", value)), lambda: re.sub("[\x00-\x1f]", "", value))
        return next((_written(tree) for tree in (_parsed(attempt()) for attempt in attempts) if tree is not None), value)

    return values.map(one)


@F.pandas_udf(T.StringType())
def mended_tree(values: pd.Series, models: pd.Series) -> pd.Series:
    """Translated trees made like their sources: what follows the first whole object is cut, a list without listType gets the source's (or unordered), and a
    paragraph where the source has a list-item becomes one. Values that hold no object come back as they are."""

    def one(value, model):
        if not value or not model:
            return value
        tree = _parsed(value)
        if tree is None:
            try:
                tree, _ = json.JSONDecoder().raw_decode(value, value.index("{"))
            except ValueError:
                return value
        pairs = [(tree, _parsed(model))]
        while pairs:
            mine, its = pairs.pop()
            if not isinstance(mine, dict) or not isinstance(its, dict):
                continue
            if mine.get("type") == "list":
                mine.setdefault("listType", its.get("listType", "unordered"))
            children = list(zip(mine.get("children") or [], its.get("children") or [], strict=False))
            for a, b in children:
                if isinstance(a, dict) and isinstance(b, dict) and (a.get("type"), b.get("type")) == ("paragraph", "list-item"):
                    a["type"] = "list-item"
            pairs += children
        return _written(tree)

    return pd.Series([one(v, m) for v, m in zip(values, models, strict=True)], dtype=object)


@F.pandas_udf(T.ArrayType(T.StringType()))
def texts_anywhere(values: pd.Series) -> pd.Series:
    """Texts of text nodes under any key of a JSON value, not only under children; null if it is none."""

    def one(value):
        tree = _parsed(value)
        return None if tree is None else [n["value"] for _, n in _walk(tree) if isinstance(n, dict) and n.get("type") == "text" and isinstance(n.get("value"), str)]

    return values.map(one)


@F.pandas_udf(T.MapType(T.StringType(), T.StringType()))
def dotted(values: pd.Series) -> pd.Series:
    """Leaves of a nested JSON object by dotted key, as text; arrays are leaves in JSON. Null if the value is no object."""

    def one(value):
        tree = _parsed(value)
        if not isinstance(tree, dict):
            return None
        out, todo = {}, [("", tree)]
        while todo:
            prefix, node = todo.pop()
            for key, child in node.items():
                if isinstance(child, dict):
                    todo.append((f"{prefix}{key}.", child))
                else:
                    out[prefix + key] = child if child is None or isinstance(child, str) else _written(child)
        return out

    return values.map(one)


@F.pandas_udf(T.StringType())
def nested(values: pd.Series) -> pd.Series:
    """A JSON object of a map of dotted keys; keys in order, a key that would lead through a text replaces it. An empty map gives an empty object."""

    def one(pairs):
        if pairs is None:
            return None
        tree: dict = {}
        for key, value in sorted(dict(pairs).items()):
            *above, last = key.split(".")
            node = tree
            for step in above:
                if not isinstance(node.get(step), dict):
                    node[step] = {}
                node = node[step]
            node[last] = value
        return _written(tree)

    return values.map(one)


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("path", T.StringType()), T.StructField("value", T.StringType())])))
def json_leaves(values: pd.Series) -> pd.Series:
    """(path, value) of every text in a JSON value, in order, paths with dots and places; empty if it is none."""

    def one(value):
        tree, out = _parsed(value), []
        for path, node in _walk(tree) if isinstance(tree, (dict, list)) else ():
            members = node.items() if isinstance(node, dict) else enumerate(node)
            out += [{"path": ".".join(map(str, (*path, k))), "value": v} for k, v in members if isinstance(v, str)]
        return out

    return values.map(one)


_FENCE = re.compile(r"```(?:json)?\s*")


@F.pandas_udf(T.ArrayType(T.StringType()))
def answered_items(values: pd.Series) -> pd.Series:
    """Members of all JSON arrays in a model's answer, each as JSON; code fences and text around them are passed over. Null without a bracket."""

    def one(value):
        if value is None or "[" not in value:
            return None
        text, out, at, decode = _FENCE.sub("", value), [], 0, json.JSONDecoder().raw_decode
        while (at := text.find("[", at)) >= 0:
            try:
                found, at = decode(text, at)
                out += map(_written, found)
            except ValueError:
                at += 1
        return out

    return values.map(one)


@F.pandas_udf(T.StringType())
def composed(values: pd.Series) -> pd.Series:
    """The canonical composition of a text. Give it nulls where a text is pure ASCII."""
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFC", v))
