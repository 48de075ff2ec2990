"""JSON functions that stay inside the JVM.

All of them parse with one ``from_json`` per distinct shape, so asking for
several paths of the same column costs a single parse per row.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Strict JSON: Spark's reader is lenient about quotes and NaN unless told.
STRICT = {
    "mode": "PERMISSIVE",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    # Whole texts: no limit below what a string can hold.
    "maxStringLen": "2147483647",
}
# The same, plus NaN, Infinity and -Infinity (and a few spellings too many,
# see is_json).
WITH_NAN = {**STRICT, "allowNonNumericNumbers": "true"}

_PATH = re.compile(r"\$(?:\.[A-Za-z_][A-Za-z0-9_]*)+")


def _keys(path: str) -> list[str]:
    if not _PATH.fullmatch(path):
        raise ValueError(f"expected a member path such as $.a.b, got {path!r}")
    return path.split(".")[1:]


def _ddl(tree: Mapping, leaf: str) -> str:
    def typed(sub) -> str:
        return leaf if sub is None else f"STRUCT<{', '.join(f'`{k}`: {typed(v)}' for k, v in sub.items())}>"

    return ", ".join(f"`{k}` {typed(v)}" for k, v in tree.items())


def _insert(tree: dict, keys: list[str]) -> bool:
    """Add a leaf; False if it would have to be a leaf and a parent at once."""
    for key in keys[:-1]:
        if key in tree and tree[key] is None:
            return False
        tree = tree.setdefault(key, {})
    if isinstance(tree.get(keys[-1]), dict):
        return False
    tree[keys[-1]] = None
    return True


def _read(text: Column, tree: Mapping, leaf: str) -> Column:
    # An array at the root would be read as its first element; the path of a
    # member does not match an array.
    is_object = text.rlike(r"^\s*\{")
    return F.from_json(F.when(is_object, text), _ddl(tree, leaf), STRICT)


def _at(parsed: Column, keys: list[str]) -> Column:
    for key in keys:
        parsed = parsed.getField(key)
    return parsed


def _scalar(text: Column, parsed: Column, keys: list[str]) -> Column:
    leaf = _at(parsed, keys)
    tree: dict = {}
    _insert(tree, keys)
    # Objects and arrays come back as their JSON text, as does a string that
    # only looks like one. Just these rare rows are parsed again, typed.
    kind = F.schema_of_variant(_at(_read(text, tree, "VARIANT"), keys))
    composite = F.when(leaf.rlike(r"^[{\[]"), F.when(kind == "STRING", "")).otherwise("")
    # Joined instead of CASE ... THEN leaf: an expression that every row needs
    # twice is evaluated once, one used inside a branch again.
    return F.concat(leaf, composite)


def json_values(text: Column, paths: Mapping[str, str]) -> dict[str, Column]:
    """Scalars at several member paths as strings, sharing parses.

    NULL where the path is missing, holds null, an object or an array, or
    where the text is not JSON.
    """
    groups: list[tuple[dict, dict[str, list[str]]]] = []
    for name, path in paths.items():
        keys = _keys(path)
        for tree, members in groups:
            if _insert(tree, keys):
                members[name] = keys
                break
        else:
            tree = {}
            _insert(tree, keys)
            groups.append((tree, {name: keys}))
    found = {}
    for tree, members in groups:
        parsed = _read(text, tree, "STRING")
        found.update({name: _scalar(text, parsed, keys) for name, keys in members.items()})
    return {name: found[name] for name in paths}


def json_value(text: Column, path: str) -> Column:
    """The scalar at a member path as a string, else NULL."""
    return json_values(text, {"value": path})["value"]


def register_json_value(spark: SparkSession, name: str = "json_value") -> None:
    """Make a scalar at a path callable in SQL as ``json_value(text, '$.a.b')``.

    NULL where the path is missing, holds null, an object or an array, or
    where the text is not JSON.
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(json_text STRING, json_path STRING) RETURNS STRING RETURN
        get(transform(array(try_variant_get(try_parse_json(json_text), json_path, 'variant')), v ->
            CASE WHEN schema_of_variant(v) RLIKE '^(ARRAY|OBJECT|VOID)' THEN NULL
                 ELSE try_variant_get(v, '$', 'string') END), 0)""")


def object_parse(text: Column, schema: str) -> Column:
    """The whole event as a typed struct, in one pass; NULL unless the text is one JSON object and no more.

    The reader ignores what follows a value. Inside an array only something
    that closes it could follow unnoticed; texts that may have that, and only
    these, are checked by ``is_json`` as well.
    """
    events = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"ARRAY<{schema}>", STRICT)
    alone = F.is_valid_utf8(text) & F.when(text.rlike(r"\}\s*\]"), is_json(text)).otherwise(True)
    return F.when(alone & (F.size(events) == 1), F.get(events, F.lit(0)))


def json_parse(text: Column, schema: str) -> Column:
    """The whole event as a typed struct; NULL fields where it does not parse."""
    return F.from_json(text, schema, STRICT)


def _parses_whole(text: Column, options: Mapping[str, str]) -> Column:
    # The reader stops after the first value and ignores what follows. Wrapped
    # both ways, text after the value breaks at least one of the two: what may
    # follow inside an array may not follow inside an object.
    as_array = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "ARRAY<STRING>", options)
    as_object = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "MAP<STRING, STRING>", options)
    return as_array.isNotNull() & as_object.isNotNull()


def is_json(text: Column) -> Column:
    """True where the whole text is one JSON value; NULL text is not.

    Duplicate keys and the tokens NaN, Infinity and -Infinity are accepted,
    trailing text, comments, single quotes and invalid UTF-8 are not.
    """
    outside_strings = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*+"', '""')
    only_known_tokens = ~outside_strings.rlike(r"INF|\+[IN]")
    relaxed = F.when(text.rlike("NaN|Infinity"), _parses_whole(text, WITH_NAN) & only_known_tokens)
    valid = F.when(_parses_whole(text, STRICT), True).otherwise(F.coalesce(relaxed, F.lit(False)))
    return F.when(F.is_valid_utf8(text), valid).otherwise(False)
