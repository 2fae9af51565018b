"""JSON as VARIANT: every value of a document by levels, and schemas compiled to checks.

Both stay in the JVM. Documents that aren't JSON, or that repeat a key, are null
variants.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.elements import once
from millrace.streaming.files import shared_folder

#: What a schema may say beside its checks; it changes no result.
NOTES = frozenset("$schema $id $defs definitions $comment title description default examples deprecated readOnly writeOnly format".split())
NUMBERS = ("integer", "number")
FAULTS = "array<struct<path: string, rule: string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """The faults that ``body`` finds in a value computed once.

    An aggregate over one element has the type of its start, known without a look at
    the body; a transform would ask the whole expression below for its type, row by row.
    """
    return F.aggregate(F.array(value), F.array().cast(FAULTS), lambda _, x: body(x))


def items_of(v: Column) -> Column:
    """The elements of an array; null for anything else."""
    return F.try_variant_get(v, "$", "array<variant>")


def fields_of(v: Column) -> Column:
    """The fields of an object as a map; null for anything else."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def kind_of(v: Column, items: Column | None = None, fields: Column | None = None) -> Column:
    """object, array, string, integer, number, boolean or null; null for no value. 2.0 is an integer.

    ``items`` and ``fields`` are those of the value, where a caller has them already. A
    cast of a number costs far more than a look at its type, so only fractions get one.
    """
    items, fields = items_of(v) if items is None else items, fields_of(v) if fields is None else fields
    whole = lambda: let(F.try_variant_get(v, "$", "double"), lambda n: F.when(n == F.rint(n), "integer").otherwise("number"))
    scalar = lambda s: F.when(s == "STRING", "string").when(s == "BIGINT", "integer").when(s == "BOOLEAN", "boolean").when(s.endswith(",0)"), "integer").otherwise(whole())
    out = F.when(v.isNull(), F.lit(None)).when(F.is_variant_null(v), "null").when(items.isNotNull(), "array").when(fields.isNotNull(), "object")
    return out.otherwise(let(F.schema_of_variant(v), scalar))


def scalar_text(v: Column) -> Column:
    """A string as it is, anything else as JSON."""
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))


def nodes(documents: DataFrame, key: list[str], document: str, depth: int = 64) -> DataFrame:
    """(key, path, name, kind, value) of every value in every document, containers and the document itself included.

    One lateral ``variant_explode`` a level, until no level is left: a level is a
    checkpoint, so no step is computed twice and a lost executor costs one level.
    ``path`` is ``$`` with ``.name`` and ``[place]``, ``name`` the nearest field's
    name ('' at the top), ``value`` a VARIANT. Null or malformed documents have no
    rows; empty containers have their own row and none below. Raises where documents
    nest deeper than ``depth``.
    """
    spark = documents.sparkSession
    shared_folder(spark)
    level = documents.select(*[F.col(f"`{c}`") for c in key], F.lit("$").alias("path"), F.lit("").alias("name"), F.try_parse_json(F.col(f"`{document}`").cast("string")).alias("value")).where("value is not null")
    named = [*[F.col(f"`{c}`") for c in key], "path", "name"]
    done = None
    for _ in range(depth):
        level = level.select(*named, kind_of(F.col("value")).alias("kind"), "value").checkpoint()
        done = level if done is None else done.unionByName(level)
        inner = level.where("kind in ('object', 'array')")
        if inner.isEmpty():
            return done
        below = inner.withColumnsRenamed({"path": "_path", "name": "_name", "value": "_value"}).lateralJoin(spark.tvf.variant_explode(F.col("_value").outer()))
        step = F.when(F.col("kind") == "object", F.concat(F.lit("."), F.col("key"))).otherwise(F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
        level = below.select(*[F.col(f"`{c}`") for c in key], F.concat("_path", step).alias("path"), F.coalesce(F.when(F.col("kind") == "object", F.col("key")), F.col("_name")).alias("name"), "value")
    raise ValueError(f"documents nest deeper than {depth} levels")


def scalars(documents: DataFrame, key: list[str], document: str) -> DataFrame:
    """(key, path, name, kind, value) of every scalar at any depth, its value as text."""
    found = nodes(documents, key, document).where("kind not in ('object', 'array')")
    return found.select(*[F.col(f"`{c}`") for c in key], "path", "name", "kind", scalar_text(F.col("value")).alias("value"))


def typed_fields(documents: DataFrame, key: list[str], document: str, mark: str, fields: list[str]) -> DataFrame:
    """(key, path, name, fields) of every object at any depth that has the field ``mark``, also inside another such object."""
    of = fields_of(F.col("value"))
    found = nodes(documents, key, document).where("kind = 'object'").withColumn("_f", of).where(F.map_contains_key("_f", mark))
    said = lambda c: F.try_element_at("_f", F.lit(c))
    return found.select(*[F.col(f"`{c}`") for c in key], "path", "name", *[F.when(~F.is_variant_null(said(c)), scalar_text(said(c))).alias(c) for c in fields])


def _same(s: Column, value: object) -> Column:
    """Whether a judged value equals a scalar that a schema names."""
    if value is None:
        return s["k"] == "null"
    if isinstance(value, bool):
        return (s["k"] == "boolean") & (F.try_variant_get(s["v"], "$", "boolean") == value)
    if isinstance(value, (int, float)):
        return s["n"] == float(value)
    if isinstance(value, str):
        return s["t"] == value
    raise ValueError("only scalars can be named by enum or const")


def _resolved(schema: object, root: Mapping, trail: tuple[str, ...]) -> tuple[object, tuple[str, ...]]:
    """What a schema's ``$ref`` points at, with the references followed so far."""
    while isinstance(schema, Mapping) and "$ref" in schema:
        ref = schema["$ref"]
        if not ref.startswith("#"):
            raise ValueError(f"only references inside the schema are followed, not {ref}")
        if ref in trail:
            raise ValueError(f"{ref} refers to itself; a check has a fixed depth")
        target: object = root
        for part in ref[1:].strip("/").split("/") if ref != "#" else []:
            target = target[part.replace("~1", "/").replace("~0", "~")]
        beside = {k: s for k, s in schema.items() if k != "$ref"}
        schema, trail = ({"allOf": [target, beside]} if set(beside) - NOTES else target), (*trail, ref)
    return schema, trail


#: What of a value each keyword looks at: its fields, its items, its number, its text; all else looks at its kind.
LOOKS = {
    "f": ("required", "properties", "additionalProperties", "minProperties", "maxProperties"), "i": ("items", "prefixItems", "minItems", "maxItems", "uniqueItems"),
    "n": ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf"), "t": ("minLength", "maxLength", "pattern"),
}


def _looks(schema: object, root: Mapping, trail: tuple[str, ...]) -> set[str]:
    """The parts of a value that a schema needs, with those of the schemas it combines."""
    schema, trail = _resolved(schema, root, trail)
    if isinstance(schema, bool):
        return set()
    out = {part for part, words in LOOKS.items() if any(w in schema for w in words)}
    for value in [*schema.get("enum", []), *([schema["const"]] if "const" in schema else [])]:
        out |= {"t"} if isinstance(value, str) else {"n"} if isinstance(value, (int, float)) and not isinstance(value, bool) else set()
    for inner in [*schema.get("allOf", []), *schema.get("anyOf", []), *schema.get("oneOf", []), *([schema["not"]] if "not" in schema else [])]:
        out |= _looks(inner, root, trail)
    return out


def _check(v: Column, path: Column, schema: object, root: Mapping, trail: tuple[str, ...]) -> Column:
    """The faults of one value, a variant that is there; what its schema looks at is taken from it once."""
    looks = _looks(schema, root, trail)

    def by_kind(s: Column) -> Column:
        parts = [s[c].alias(c) for c in ("v", "i", "f", "k") if c in "vk" or c in looks]
        if "n" in looks:
            parts.append(F.when(s["k"].isin(*NUMBERS), F.try_variant_get(s["v"], "$", "double")).alias("n"))
        if "t" in looks:
            parts.append(F.when(s["k"] == "string", F.try_variant_get(s["v"], "$", "string")).alias("t"))
        return _with(F.struct(*parts), lambda x: _judged(x, path, schema, root, trail)) if looks & {"n", "t"} else _judged(s, path, schema, root, trail)

    held = [v.alias("v"), *([items_of(v).alias("i")] if "i" in looks else []), *([fields_of(v).alias("f")] if "f" in looks else [])]
    kind = lambda s: F.struct(*[s[c].alias(c) for c in ("v", "i", "f") if c == "v" or c in looks], kind_of(s["v"], s["i"] if "i" in looks else None, s["f"] if "f" in looks else None).alias("k"))
    return _with(F.struct(*held), lambda s: _with(kind(s), by_kind))


def _plain(word: str, said: object, s: Column | Mapping[str, Column]) -> list[tuple[Column, str]] | None:
    """(whether it holds, rule) for a keyword that looks at a value alone; None for any other keyword."""
    either = lambda part, ok: s[part].isNull() | ok
    sizes = {"minLength": ("t", F.char_length, 1), "maxLength": ("t", F.char_length, -1), "minItems": ("i", F.size, 1), "maxItems": ("i", F.size, -1), "minProperties": ("f", F.size, 1), "maxProperties": ("f", F.size, -1)}
    bounds = {"minimum": lambda n, x: n >= x, "maximum": lambda n, x: n <= x, "exclusiveMinimum": lambda n, x: n > x, "exclusiveMaximum": lambda n, x: n < x, "multipleOf": lambda n, x: (n / x) == F.rint(n / x)}
    if word == "type":
        kinds = [said] if isinstance(said, str) else list(said)
        return [(s["k"].isin(*kinds, *(["integer"] if "number" in kinds else [])), f"type {' or '.join(kinds)}")]
    if word in ("enum", "const"):
        fits = F.lit(False)
        for value in said if word == "enum" else [said]:
            fits = fits | F.coalesce(_same(s, value), F.lit(False))
        return [(fits, word)]
    if word in bounds:
        return [(either("n", bounds[word](s["n"], float(said))), word)]
    if word in sizes:
        part, size, sign = sizes[word]
        return [(either(part, size(s[part]) * sign >= said * sign), word)]
    if word == "pattern":
        return [(either("t", s["t"].rlike(said)), word)]
    if word == "uniqueItems":
        return [(either("i", F.size(F.array_distinct(F.transform(items_of(s["v"]), lambda x: F.to_json(x)))) == F.size(s["i"])), word)] if said else []
    if word == "required":
        return [(either("f", F.map_contains_key(s["f"], name)), f"required {name}") for name in said]
    return None


def _pointer(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


def _judged(s: Column, path: Column, schema: object, root: Mapping, trail: tuple[str, ...]) -> Column:
    """The faults of a value whose parts stand in ``s``."""
    schema, trail = _resolved(schema, root, trail)
    none = F.array().cast(FAULTS)
    fault = lambda rule: F.array(F.struct(path.alias("path"), F.lit(rule).alias("rule")))
    if isinstance(schema, bool):
        return none if schema else fault("false")
    out: list[Column] = []
    unless = lambda ok, rule: out.append(F.when(F.coalesce(ok, F.lit(False)), none).otherwise(fault(rule)))
    for word, said in schema.items():
        if (rules := _plain(word, said, s)) is not None:
            for ok, rule in rules:
                unless(ok, rule)
        elif word == "properties":
            for name, part in said.items():
                there = s["f"].isNotNull() & F.map_contains_key(s["f"], name)
                at = F.concat(path, F.lit("/"), _pointer(F.lit(name)))
                out.append(F.when(there, _check(F.try_element_at(s["f"], F.lit(name)), at, part, root, trail)).otherwise(none))
        elif word == "additionalProperties":
            known = list(schema.get("properties", {}))
            others = F.map_filter(s["f"], lambda k, _: ~k.isin(*known)) if known else s["f"]
            below = F.transform(F.map_entries(others), lambda e: _check(e["value"], F.concat(path, F.lit("/"), _pointer(e["key"])), said, root, trail))
            out.append(F.coalesce(F.flatten(below), none))
        elif word == "items":
            skip = len(schema.get("prefixItems", []))
            below = F.transform(s["i"], lambda x, i: F.when(i >= skip, _check(x, F.concat(path, F.lit("/"), i.cast("string")), said, root, trail)).otherwise(none))
            out.append(F.coalesce(F.flatten(below), none))
        elif word == "prefixItems":
            for i, part in enumerate(said):
                out.append(F.when(F.size(s["i"]) > i, _check(F.get(s["i"], F.lit(i)), F.concat(path, F.lit(f"/{i}")), part, root, trail)).otherwise(none))
        elif word == "allOf":
            out.extend(_judged(s, path, part, root, trail) for part in said)
        elif word in ("anyOf", "oneOf"):
            n = F.size(F.filter(F.array(*[F.size(_judged(s, path, part, root, trail)) for part in said]), lambda k: k == 0))
            unless(n >= 1 if word == "anyOf" else n == 1, word)
        elif word == "not":
            unless(F.size(_judged(s, path, said, root, trail)) > 0, word)
        elif word not in NOTES:
            raise ValueError(f"no check for the keyword {word}")
    return F.concat(*out, none)


def schema_faults(document: Column, schema: Mapping | bool) -> Column:
    """array<struct<path,rule>>: where a JSON document breaks a recursive schema, and which keyword says so.

    The schema is compiled to one expression: types, enum, const, numeric bounds,
    lengths, pattern, items and their number, properties, additional and required ones,
    allOf, anyOf, oneOf, not, and references inside the schema. An unknown keyword, or a
    reference to itself, raises when compiling; nothing is passed over. Paths are JSON
    pointers, '' for the document. A null or malformed document has the rule "not json".
    Numbers are compared as doubles, repeated items as their JSON.
    """
    said = lambda v: F.when(v.isNull(), F.array(F.struct(F.lit("").alias("path"), F.lit("not json").alias("rule")))).otherwise(_check(v, F.lit(""), schema, schema if isinstance(schema, Mapping) else {}, ()))
    return _with(F.try_parse_json(document), said)


#: Keywords that speak of the values inside a value.
BELOW = ("properties", "additionalProperties", "items", "prefixItems")
#: A fault, or with ``at`` a value that the schema of that number has still to judge.
STEP = "struct<path: string, rule: string, at: int, value: variant>"
#: Arrays and objects as these show their size and their names, while what is inside is not copied.
SLOTS, NAMES = "array<array<boolean>>", "map<string,array<boolean>>"
#: Columns worked out in one step, so that the method which Spark makes of a step stays one that the JVM compiles.
TOGETHER = 8


def _alone(s: Mapping[str, Column], schema: object, root: Mapping, trail: tuple[str, ...]) -> list[tuple[Column, str]] | None:
    """(whether it holds, rule) for all that a schema says; None where it speaks of values inside."""
    schema, trail = _resolved(schema, root, trail)
    if isinstance(schema, bool):
        return [] if schema else [(F.lit(False), "false")]
    out: list[tuple[Column, str]] = []
    for word, said in schema.items():
        rules = _plain(word, said, s)
        if rules is None and word in ("allOf", "anyOf", "oneOf", "not"):
            parts = [_alone(s, part, root, trail) for part in ([said] if word == "not" else said)]
            if None in parts:
                return None
            n = F.lit(0)
            for part in parts:
                holds = F.lit(True)
                for ok, _ in part:
                    holds = holds & F.coalesce(ok, F.lit(False))
                n = n + holds.cast("int")
            rules = [x for part in parts for x in part] if word == "allOf" else [({"anyOf": n >= 1, "oneOf": n == 1, "not": n == 0}[word], word)]
        elif rules is None and word in BELOW:
            return None
        elif rules is None and word not in NOTES:
            raise ValueError(f"no check for the keyword {word}")
        out += rules or []
    return out


def _views(schema: object, root: Mapping, trail: tuple[str, ...]) -> list[tuple[object, tuple[str, ...]]]:
    """A schema and those of its allOf, which all judge the same value."""
    schema, trail = _resolved(schema, root, trail)
    if isinstance(schema, bool) or "allOf" not in schema:
        return [(schema, trail)]
    return [({k: s for k, s in schema.items() if k != "allOf"}, trail), *[x for part in schema["allOf"] for x in _views(part, root, trail)]]


def _field(v: Column, name: str) -> Column:
    """A field's value; null where there is none. Names that a path can't say are looked up in a map."""
    return F.try_variant_get(v, f"$.{name}", "variant") if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name) else F.try_element_at(fields_of(v), F.lit(name))


class _Parts(Mapping):
    """The columns with a value's parts, which remembers those that were asked for."""

    def __init__(self, number: int) -> None:
        self.number, self.used = number, set()

    def __getitem__(self, part: str) -> Column:
        self.used.add(part)
        return F.col(f"_{part}{self.number}")

    def __iter__(self):
        return iter(self.used)

    def __len__(self) -> int:
        return len(self.used)

    def columns(self) -> list[dict[str, Column]]:
        """What was asked for, and what it takes: items and fields without what is inside, type, number and text, kind."""
        v, c, i, f, n = (F.col(f"_{x}{self.number}") for x in "vcifn")
        named = lambda **parts: {f"_{x}{self.number}": column for x, column in parts.items()}
        slots = {"i": F.try_variant_get(v, "$", SLOTS), "f": F.try_variant_get(v, "$", NAMES)}
        out = [named(**{x: slots[x] for x in "if" if x in self.used}), {}, {}, {}]
        if not self.used & {"n", "t", "k"}:
            return out
        held = [F.when(v.isNull(), F.lit(None)).when(F.is_variant_null(v), "null"), i if "i" in self.used else slots["i"], f if "f" in self.used else slots["f"]]
        out[1] = named(c=held[0].when(held[1].isNotNull(), "array").when(held[2].isNotNull(), "object").otherwise(F.schema_of_variant(v)))
        number = ~c.isin("null", "array", "object", "STRING", "BOOLEAN")
        number = number if "n" in self.used else number & (c != "BIGINT") & ~c.endswith(",0)")
        if self.used & {"n", "k"}:
            out[2] |= named(n=F.when(number, F.try_variant_get(v, "$", "double")))
        if "t" in self.used:
            out[2] |= named(t=F.when(c == "STRING", F.try_variant_get(v, "$", "string")))
        if "k" in self.used:
            whole = (c == "BIGINT") | c.endswith(",0)") | (n == F.rint(n))
            out[3] = named(k=F.when(c.isNull() | c.isin("null", "array", "object"), c).when(c == "STRING", "string").when(c == "BOOLEAN", "boolean").when(whole, "integer").otherwise("number"))
        return out


def _level(rows: DataFrame, names: list[str], points: list[tuple[object, tuple[str, ...]]], first: int, root: Mapping) -> DataFrame:
    """``rows`` with the faults and the inner values of all values that wait for the schemas from ``first`` on; inner ones add schemas to ``points``."""
    values: list[dict[str, Column]] = []
    parts: list[_Parts] = []
    found: list[Column] = []
    inner: list[Column] = []
    step = lambda path, rule=None, at=None, value=None: F.struct(path.alias("path"), F.lit(rule).cast("string").alias("rule"), F.lit(at).cast("int").alias("at"), (F.lit(None).cast("variant") if value is None else value).alias("value"))
    none = F.array().cast(f"array<{STEP}>")

    def wait(schema: object, trail: tuple[str, ...]) -> int:
        points.append((schema, trail))
        return len(points) - 1

    def judge(value: Column, path: Column, schema: object, trail: tuple[str, ...], depth: int) -> None:
        s = _Parts(len(parts))
        parts.append(s)
        values.extend({} for _ in range(depth + 1 - len(values)))
        values[depth][f"_v{s.number}"] = value
        there = s["v"].isNotNull()
        for view, at in _views(schema, root, trail):
            says = {} if isinstance(view, bool) else view
            here = view if isinstance(view, bool) else {k: x for k, x in view.items() if k not in BELOW}
            rules = _alone(s, here, root, at)
            if rules is None:  # an alternative that looks inside
                inner.append(F.when(there, F.transform(_check(s["v"], path, here, root, at), lambda f: F.struct(f["path"].alias("path"), f["rule"].alias("rule"), F.lit(None).cast("int").alias("at"), F.lit(None).cast("variant").alias("value")))).otherwise(none))
            found.extend(F.when(there & ~F.coalesce(ok, F.lit(False)), step(path, rule)) for ok, rule in rules or [])
            for name, part in says.get("properties", {}).items():
                judge(_field(s["v"], name), F.concat(path, F.lit("/"), _pointer(F.lit(name))), part, at, depth + 1)
            for i, part in enumerate(says.get("prefixItems", [])):
                judge(F.try_variant_get(s["v"], f"$[{i}]", "variant"), F.concat(path, F.lit(f"/{i}")), part, at, depth + 1)
            if "items" in says:
                to, skip = wait(says["items"], at), len(says.get("prefixItems", []))
                below = F.transform(items_of(s["v"]), lambda x, i: F.when(i >= skip, step(F.concat(path, F.lit("/"), i.cast("string")), at=to, value=x)))
                inner.append(F.when(s["i"].isNotNull(), below).otherwise(none))
            if "additionalProperties" in says:
                to = wait(says["additionalProperties"], at)
                other = F.array_except(F.map_keys(s["f"]), F.array(*[F.lit(x) for x in says.get("properties", {})]).cast("array<string>"))
                below = F.transform(other, lambda k: step(F.concat(path, F.lit("/"), _pointer(k)), at=to, value=F.try_element_at(fields_of(s["v"]), k)))
                inner.append(F.when(F.size(other) > 0, below).otherwise(none))

    for number in range(first, len(points)):
        judge(F.when(F.col("_step.at") == number, F.col("_step.value")), F.col("_step.path"), *points[number], 0)
    for columns in [*values, *({k: c for of in part for k, c in of.items()} for part in zip(*[s.columns() for s in parts]))]:
        listed = list(columns.items())
        for at in range(0, len(listed), TOGETHER):
            rows = once(rows, **dict(listed[at : at + TOGETHER]))
    faults = [F.array(*found[at : at + 2 * TOGETHER]) for at in range(0, len(found), 2 * TOGETHER)]
    for at, some in enumerate(faults[1:]):
        rows, faults[at + 1] = once(rows, **{f"_faults{at}": some}), F.col(f"_faults{at}")
    rows = rows.select(*names, F.when(F.col("_step.at").isNull(), F.array("_step")).otherwise(F.concat(*faults, *inner, none)).alias("_all"))
    # an inner explode would have Spark add a filter on the array's size, which works everything out twice
    return rows.select(*names, F.explode_outer("_all").alias("_step")).where("_step IS NOT NULL")


def fault_rows(documents: DataFrame, key: list[str], document: str, schema: Mapping | bool) -> DataFrame:
    """(key, path, rule): the faults of :func:`schema_faults`, a row each, for large tables.

    What lies at fixed names is judged in a row of columns, which Spark compiles; items
    and additional properties become rows of their own, one explode a level of the
    schema. Only alternatives that look inside a value go the way of the expression.
    """
    root = schema if isinstance(schema, Mapping) else {}
    names = [f"_key{i}" for i in range(len(key))]
    rows = documents.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(key, names)], F.try_parse_json(F.col(f"`{document}`").cast("string")).alias("_v"))
    none = F.col("_v").isNull()
    rows = rows.select(*names, F.struct(F.lit("").alias("path"), F.when(none, "not json").alias("rule"), F.when(~none, 0).alias("at"), F.col("_v").alias("value")).alias("_step"))
    points: list[tuple[object, tuple[str, ...]]] = [(schema, ())]
    first = 0
    while first < len(points):
        first, rows = len(points), _level(rows, names, points, first, root)
    return rows.select(*[F.col(n).alias(c) for c, n in zip(key, names)], "_step.path", "_step.rule")
