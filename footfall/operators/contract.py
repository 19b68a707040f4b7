"""Records held against their declared schema, with what is wrong told apart.

The declaration (a DDL text such as ``schemas.FRAME_RECORD``) is compiled to checks on the record as
VARIANT, which keeps what was written: a field may be ``missing`` (absent or null), of the ``wrong_type``,
or ``unknown`` (not declared), and a text may be ``unreadable`` as a JSON object. Fields inside something of the wrong
type are not reported on their own. A whole number is a fitting double; a text is never a number.

One pass over the records, no Python. What a record holds is read first, each place once: the types found at
the declared places, and the names in its objects. The checks then compare these, so no part of a record
is taken apart twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from footfall.schemas import FRAME_RECORD, struct_of

# Fields of the frame record that may be absent.
OPTIONAL = frozenset({"detections[].track_id", "runtime", "runtime.model_name", "runtime.tracker_type",
                      "runtime.conf_thres", "runtime.class_filter", "source_uri"})
WHOLE = ("tinyint", "smallint", "int", "bigint")
OBJECT, LIST = "map<string,variant>", "array<variant>"
FAULT = "struct<field:string,problem:string>"


@dataclass(frozen=True)
class Place:
    """A declared place: its path from the object that holds it, and the place of the object above it."""
    path: str
    kind: DataType
    above: int


def _places(kind: StructType, path: str = "$", above: int = 0, found: list[Place] | None = None) -> list[Place]:
    """The object itself and all places below it, not those within lists."""
    found = [Place("$", kind, -1)] if found is None else found
    for f in kind.fields:
        found.append(Place(f"{path}.{f.name}", f.dataType, above))
        if isinstance(f.dataType, StructType):
            _places(f.dataType, f"{path}.{f.name}", len(found) - 1, found)
    return found


def _names(value: Column, places: list[Place]) -> Column:
    """The names in the objects at the places, null where there is none."""
    return F.array(*[F.map_keys(F.try_variant_get(value, p.path, OBJECT)) for p in places if isinstance(p.kind, StructType)])


def _seen(value: Column, names: Column, places: list[Place], lists: dict[str, Column]) -> Column:
    """``types`` at the places, and ``names`` in the objects there; ``lists`` are those already taken, by path."""
    objects = [p.path for p in places if isinstance(p.kind, StructType)]

    def type_at(place: Place) -> Column:
        found = F.schema_of_variant(F.try_variant_get(value, place.path, "variant"))
        if isinstance(place.kind, StructType):
            return F.when(names[objects.index(place.path)].isNotNull(), F.lit("OBJECT")).otherwise(found)
        if isinstance(place.kind, ArrayType):
            held = lists.get(place.path, F.try_variant_get(value, place.path, LIST))
            return F.when(held.isNotNull(), F.lit("ARRAY")).otherwise(found)
        return found

    return F.struct(F.array(*map(type_at, places)).alias("types"), names.alias("names"))


def _fits(found: Column, kind: DataType) -> Column:
    """Whether the type of a JSON value, as ``schema_of_variant`` names it, is the declared one."""
    name = kind.simpleString()
    if isinstance(kind, (StructType, ArrayType)):
        return found == ("OBJECT" if isinstance(kind, StructType) else "ARRAY")
    if name in WHOLE:
        return found == "BIGINT"
    if name in ("double", "float") or name.startswith("decimal"):
        return found.isin("BIGINT", "DOUBLE", "FLOAT") | found.startswith("DECIMAL")
    return found == name.upper()


def _faults(seen: Column, places: list[Place], prefix: str, optional: frozenset[str]) -> Column:
    """The faults of one object, from what was seen of it."""
    def fault(field: Column | str, problem: str) -> Column:
        return F.struct((F.lit(field) if isinstance(field, str) else field).alias("field"), F.lit(problem).alias("problem"))

    name = lambda p: prefix + p.path[2:]
    types, single = seen["types"], []
    for i, p in enumerate(places[1:], 1):
        found = types[i]
        absent = found.isNull() | (found == "VOID")
        problem = F.when(~absent & ~_fits(found, p.kind), fault(name(p), "wrong_type"))
        if name(p) not in optional:
            problem = F.when(absent, fault(name(p), "missing")).otherwise(problem)
        single.append(F.when(types[p.above] == "OBJECT", problem))
    parts = [F.filter(F.array(*single), lambda x: x.isNotNull())]
    for i, p in enumerate(x for x in places if isinstance(x.kind, StructType)):
        known = F.array(*[F.lit(f.name) for f in p.kind.fields])
        more = F.array_except(F.coalesce(seen["names"][i], F.array().cast("array<string>")), known)
        below = prefix + "".join(f"{step}." for step in p.path.split(".")[1:])
        parts.append(_each(more, below, fault))
    return F.concat(*parts)


def _clean(seen: Column, places: list[Place], prefix: str, optional: frozenset[str]) -> Column:
    """Whether an object is as declared, told without building faults. Its names are unique, so that it has
    no further ones if there are as many as declared fields were found."""
    types = seen["types"]
    ok = types[0] == "OBJECT"
    for i, p in enumerate(places[1:], 1):
        fits = _fits(types[i], p.kind)
        may_lack = prefix + p.path[2:] in optional
        ok = ok & (F.coalesce(fits | (types[i] == "VOID"), F.lit(True)) if may_lack else fits)
    objects = [i for i, p in enumerate(places) if isinstance(p.kind, StructType)]
    for at, above in enumerate(objects):
        found = [types[i].isNotNull().cast("int") for i, p in enumerate(places) if p.above == above]
        ok = ok & (F.size(seen["names"][at]) == sum(found, F.lit(0)))
    return F.coalesce(ok, F.lit(False))


def _each(names: Column, below: str, fault) -> Column:
    return F.transform(names, lambda n: fault(F.concat(F.lit(below), n), "unknown"))


def _of_items(items: Column, kind: DataType, places: list[Place] | None, name: str, optional: frozenset[str]) -> Column:
    """The faults of a list's items, from what was seen of each."""
    def wrong() -> Column:
        return F.struct(F.lit(f"{name}[]").alias("field"), F.lit("wrong_type").alias("problem"))

    none = F.array().cast(f"array<{FAULT}>")
    if places is None:
        return F.flatten(F.transform(items, lambda t: F.when(F.coalesce(_fits(t, kind), F.lit(False)), none).otherwise(F.array(wrong()))))
    return F.flatten(F.transform(items, lambda s: F.when(_clean(s, places, f"{name}[].", optional), none).when(
        s["types"][0] == "OBJECT", _faults(s, places, f"{name}[].", optional)).otherwise(F.array(wrong()))))


def _list_seen(items: Column, places: list[Place] | None) -> Column:
    if places is None:
        return F.transform(items, F.schema_of_variant)
    named = F.transform(items, lambda item: F.struct(item.alias("item"), _names(item, places).alias("names")))
    return F.transform(named, lambda x: _seen(x["item"], x["names"], places, {}))


def with_faults(records: DataFrame, payload: str = "payload", schema: str = FRAME_RECORD,
                optional: frozenset[str] = OPTIONAL) -> DataFrame:
    """``records`` with ``faults``, an array of ``field, problem``, empty for a record as declared. Lists may
    hold objects or plain values, not further lists of objects."""
    places = _places(struct_of(schema))
    lists = [(p, p.kind.elementType) for p in places if isinstance(p.kind, ArrayType)]
    inside = [_places(kind) if isinstance(kind, StructType) else None for _, kind in lists]
    if any(isinstance(q.kind, ArrayType) and isinstance(q.kind.elementType, StructType) for own in inside if own for q in own):
        raise ValueError("lists of objects within lists of objects are not supported")
    value = F.col("_value")
    # Each step leaves through a generator, so that the next does not repeat its expressions.
    parsed = records.select("*", F.inline(F.array(F.struct(F.try_parse_json(payload).alias("_value")))))
    opened = parsed.select(*records.columns, "_value", F.inline(F.array(F.struct(
        _names(value, places).alias("_names"),
        *[F.try_variant_get(value, p.path, LIST).alias(f"_items{i}") for i, (p, _) in enumerate(lists)]))))
    held = {p.path: F.col(f"_items{i}") for i, (p, _) in enumerate(lists)}
    seen = F.struct(_seen(value, F.col("_names"), places, held).alias("top"), *[
        _list_seen(held[p.path], own).alias(f"list{i}") for i, ((p, _), own) in enumerate(zip(lists, inside))])
    looked = opened.select(*records.columns, F.inline(F.array(F.struct(seen.alias("_seen")))))
    none = F.array().cast(f"array<{FAULT}>")
    top = F.col("_seen.top")
    parts = [_faults(top, places, "", optional)] + [
        F.coalesce(_of_items(F.col(f"_seen.list{i}"), kind, own, p.path[2:], optional), none)
        for i, ((p, kind), own) in enumerate(zip(lists, inside))]
    broken = F.array(F.struct(F.lit("record").alias("field"), F.lit("unreadable").alias("problem")))
    return looked.select(*records.columns, F.when(top["types"][0] == "OBJECT", F.concat(*parts)).otherwise(broken).alias("faults"))


def rejects(records: DataFrame, **how) -> DataFrame:
    """The records with faults."""
    return with_faults(records, **how).where(F.size("faults") > 0)


def accepted(records: DataFrame, **how) -> DataFrame:
    """The records as declared, without a further column."""
    return with_faults(records, **how).where(F.size("faults") == 0).drop("faults")


def fault_report(records: DataFrame, **how) -> DataFrame:
    """``field, problem, faults, records``: how often each problem occurs, and in how many records."""
    found = with_faults(records, **how).select("faults", F.posexplode("faults").alias("at", "fault"))
    first = (F.array_position("faults", F.col("fault")) == F.col("at") + 1).cast("bigint")
    return found.select("fault.*", first.alias("first")).groupBy("field", "problem").agg(
        F.count(F.lit(1)).alias("faults"), F.sum("first").alias("records"))
