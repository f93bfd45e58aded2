"""What only Python's own parser can say about a code column, as one vectorised column function.

Only the code (and, for slots, its slot entries) crosses to Python; every other column stays in the
JVM. The result is a struct with just the asked-for fields; filters, joins, counts and statistics on
them are plain DataFrame work.
"""

from __future__ import annotations

import ast
import copy
import io
import tokenize
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import accumulate, chain
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, functions as F

from pairloom.functions.text import _col

# Types of the action grammar that hold words or literals, not further nodes.
PRIMITIVES = ("identifier", "int", "string", "bytes", "object", "singleton", "constant")
# Node fields newer than the action grammar.
NEWER_FIELDS = ("posonlyargs", "type_ignores", "kind", "type_comment", "type_params")
# The action grammar's own names for literals, by Python type: constructor, field type, field.
LITERALS = {
    "bool": ("NameConstant", "singleton", "value"),
    "NoneType": ("NameConstant", "singleton", "value"),
    "int": ("Num", "object", "n"),
    "float": ("Num", "object", "n"),
    "complex": ("Num", "object", "n"),
    "str": ("Str", "string", "s"),
    "bytes": ("Bytes", "bytes", "s"),
}

FIELD_TYPES = {
    "status": "string",
    "depth": "int",
    "nodes": "int",
    "comments": "array<string>",
    "actions": "array<struct<action:string,flag:string,parent_type:string,parent_field:string,cardinality:string>>",
    "stripped": "string",
    "slotted": "string",
}
ACTION_NAMES = ("action", "flag", "parent_type", "parent_field", "cardinality")


class Parent(NamedTuple):
    """Where in the grammar an action fills a place; all None at the root."""

    type: str | None = None
    field: str | None = None
    cardinality: str | None = None


@lru_cache(maxsize=None)
def _declared(node_class: type) -> tuple[tuple[str, Parent], ...]:
    """Fields of a node class as the grammar declares them, read from the class's own annotations; once per class."""
    return tuple(_read_fields(node_class))


def _read_fields(node_class: type) -> Iterator[tuple[str, Parent]]:
    for name, annotation in node_class._field_types.items():
        if name in NEWER_FIELDS:
            continue
        text = annotation.__name__ if isinstance(annotation, type) and not hasattr(annotation, "__args__") else str(annotation)
        cardinality = "-"
        if text.startswith("list["):
            text, cardinality = text[len("list[") : -1], "+"
        elif text.endswith(" | None"):
            text, cardinality = text[: -len(" | None")], "?"
        text = text.removeprefix("ast.")
        kind = {"str": "identifier", "object": "constant"}.get(text, text)
        if node_class is ast.Subscript and name == "slice":
            kind = "slice"
        yield name, Parent(kind, name, cardinality)


def grammar_rows() -> list[tuple[str, str, str, str]]:
    """Dimension table of the node classes: constructor, field, type, cardinality."""
    classes = [c for c in vars(ast).values() if isinstance(c, type) and issubclass(c, ast.AST) and getattr(c, "_field_types", None)]
    return sorted((c.__name__, name, p.type, p.cardinality) for c in set(classes) for name, p in _declared(c))


def childless_nodes() -> list[str]:
    """Node classes without fields that stand for themselves: operators, contexts, ``pass`` and its like."""
    classes = {c for c in vars(ast).values() if isinstance(c, type) and issubclass(c, ast.AST)}
    parents = {base for c in classes for base in c.__bases__}
    return sorted(c.__name__ for c in classes - parents if not c._fields and c.__name__ != "AST")


def plain(text: str) -> str:
    """Text that can be written as UTF-8: half of a surrogate pair, which a literal may hold, is spelled out."""
    return text.encode("utf-8", "backslashreplace").decode("utf-8")


Action = tuple[str, str, str | None, str | None, str | None]


def _node_actions(node: ast.AST, flag: str, parent: Parent, out: list[Action]) -> None:
    if parent.type == "slice" and not isinstance(node, ast.Slice):
        _wrapped_index(node, flag, parent, out)
        return
    if isinstance(node, ast.Constant):
        if node.value is Ellipsis:
            out.append(("Ellipsis", flag, *parent))
            return
        constructor, kind, field = LITERALS[type(node.value).__name__]
        out.append((constructor, flag, *parent))
        out.append((plain(str(node.value)), "-", kind, field, "-"))
        return
    out.append((type(node).__name__, flag, *parent))
    for name, place in _declared(type(node)):
        _value_actions(getattr(node, name, None), place, out)


def _wrapped_index(node: ast.AST, flag: str, parent: Parent, out: list[Action]) -> None:
    """The grammar has a node around an index, and one around several slices; Python no longer has."""
    if isinstance(node, ast.Tuple) and any(isinstance(e, ast.Slice) for e in node.elts):
        out.append(("ExtSlice", flag, *parent))
        _value_actions(node.elts, Parent("slice", "dims", "+"), out)
    else:
        out.append(("Index", flag, *parent))
        _value_actions(node, Parent("expr", "value", "-"), out)


def _value_actions(value: object, place: Parent, out: list[Action], flag: str | None = None) -> None:
    if isinstance(value, list):
        for i, item in enumerate(value):
            _value_actions(item, place, out, "*" if i else "+")
        if value:
            out.append(("Reduce", "-", *place))
        else:
            out.append((_closing(place), "+", *place))
    elif isinstance(value, ast.AST):
        _node_actions(value, flag or "-", place, out)
    elif value is None:
        out.append((_closing(place), flag or "?", *place))
    else:
        out.append((plain(str(value)), flag or "-", *place))


def _closing(place: Parent) -> str:
    return "Reduce_primitif" if place.type in PRIMITIVES else "Reduce"


def actions_of(tree: ast.AST) -> list[Action]:
    """The tree as its actions in order; each knows the place it fills."""
    out: list[Action] = []
    _node_actions(tree, "-", Parent(), out)
    return out


def depth_of(tree: ast.AST) -> int:
    depth, level = 0, [tree]
    while level:
        depth += 1
        level = [child for node in level for child in ast.iter_child_nodes(node)]
    return depth


def comments_of(code: str) -> list[str]:
    """Comments of the code; none when it cannot be tokenized."""
    try:
        return [plain(t.string) for t in tokenize.generate_tokens(io.StringIO(code).readline) if t.type == tokenize.COMMENT]
    except (tokenize.TokenError, SyntaxError, ValueError):
        return []


def without_docstrings(tree: ast.AST) -> str:
    """Source without the docstrings of functions and classes; a body left empty becomes ``pass``. Changes the tree."""
    for node in ast.walk(tree):
        if isinstance(node, ast.FunctionDef | ast.AsyncFunctionDef | ast.ClassDef) and ast.get_docstring(node, clean=False) is not None:
            node.body = node.body[1:] or [ast.Pass()]
    return ast.unparse(tree)


def with_slots(tree: ast.AST, slots: dict[str, str]) -> str:
    """Source whose names and text constants that equal a slot value are that slot. Changes the tree."""
    for node in ast.walk(tree):
        for field, value in ast.iter_fields(node):
            if isinstance(value, str) and value in slots:
                setattr(node, field, slots[value])
    return ast.unparse(tree)


# Errors a text that is no valid program may raise in the parser.
UNPARSABLE = (SyntaxError, ValueError, RecursionError, MemoryError)


def _facts(code: str | None, slots: dict[str, str], want: Sequence[str]) -> dict[str, object]:
    facts: dict[str, object] = dict.fromkeys(want)
    try:
        if code is None:
            raise ValueError
        tree = ast.parse(code)
        if not tree.body:
            facts["status"] = "empty"
        else:
            facts["status"] = "ok"
            if "depth" in want:
                facts["depth"] = depth_of(tree)
            if "nodes" in want:
                facts["nodes"] = sum(1 for _ in ast.walk(tree))
            if "actions" in want:
                facts["actions"] = actions_of(tree.body[0])
            if "stripped" in want:
                facts["stripped"] = plain(without_docstrings(copy.deepcopy(tree) if "slotted" in want else tree))
            if "slotted" in want:
                facts["slotted"] = plain(with_slots(tree, slots))
    except UNPARSABLE as error:
        facts.update(dict.fromkeys(want))
        kind = "SyntaxError" if isinstance(error, SyntaxError) else type(error).__name__
        facts["status"] = "missing" if code is None else kind
    if "comments" in want and code is not None:
        facts["comments"] = comments_of(code)
    return {name: facts[name] for name in want}


def _listed(rows: Sequence[Sequence[Action] | None]) -> pa.ListArray:
    """Lists of actions, filled column by column; a null list stays null."""
    columns = list(zip(*chain.from_iterable(r for r in rows if r))) or [()] * len(ACTION_NAMES)
    actions = pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], ACTION_NAMES)
    ends = accumulate((len(r or ()) for r in rows), initial=0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), actions, mask=pa.array([r is None for r in rows], pa.bool_()))


ARROW_TYPES = {"int": pa.int32(), "string": pa.string(), "array<string>": pa.list_(pa.string())}


def _table(rows: Sequence[dict[str, object]], wanted: Sequence[str]) -> pa.StructArray:
    columns = []
    for name in wanted:
        values = [row[name] for row in rows]
        columns.append(_listed(values) if name == "actions" else pa.array(values, ARROW_TYPES[FIELD_TYPES[name]]))
    return pa.StructArray.from_arrays(columns, list(wanted))


def code_facts(code: Column | str, *want: str, slots: Column | None = None) -> Column:
    """Struct of the wanted facts of a code column; ``status`` is ok, empty, missing or an error kind.

    ``slots`` (array of structs with slot and value) is needed for ``slotted``.
    """
    unknown = [w for w in want if w not in FIELD_TYPES]
    if unknown:
        raise ValueError(f"unknown facts {unknown}")
    wanted = tuple(dict.fromkeys(("status", *want)))
    schema = ",".join(f"{w}:{FIELD_TYPES[w]}" for w in wanted)

    @F.arrow_udf(f"struct<{schema}>")
    def facts(codes: pa.Array) -> pa.Array:
        return _table([_facts(c, {}, wanted) for c in codes.to_pylist()], wanted)

    @F.arrow_udf(f"struct<{schema}>")
    def slotted_facts(codes: pa.Array, entries: pa.Array) -> pa.Array:
        slots_of = ({e["value"]: e["slot"] for e in es or ()} for es in entries.to_pylist())
        return _table([_facts(c, found, wanted) for c, found in zip(codes.to_pylist(), slots_of)], wanted)

    if slots is None:
        return facts(_col(code))
    slim = F.transform(slots, lambda e: F.struct(e["value"].alias("value"), e["slot"].alias("slot")))
    return slotted_facts(_col(code), slim)
