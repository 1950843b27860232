"""Versioned schemas: fields keep their id through renames, every change is a new version, keys can't be changed.

The sequence column is part of the logical schema, the row kind isn't. Options name both (``sequence.field``,
``rowkind.field``) and the optional columns for transaction, operation and row id (``metadata.xid|op|tid``).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.sql import types as T

from tidelog.functions.kinds import KIND, SEQ, fnv1a32

# Field ids that no user column gets.
SEQ_FIELD_ID = 32767
METADATA_IDS = {"xid": 0xFF00, "op": 0xFF01, "tid": 0xFF02}


class SchemaError(ValueError):
    pass


@dataclass(frozen=True)
class Field:
    id: int
    name: str
    type: T.DataType
    nullable: bool = True


@dataclass(frozen=True)
class Schema:
    id: int
    fields: tuple[Field, ...]
    highest: int
    keys: tuple[str, ...] = ()
    options: tuple[tuple[str, str], ...] = ()

    @classmethod
    def of(cls, struct: T.StructType, keys: tuple[str, ...] = (), options: dict[str, str] | None = None) -> Schema:
        names = [f.name for f in struct.fields]
        for key in keys:
            if key not in names:
                raise SchemaError(f"no key column {key}")
        fields = tuple(Field(i, f.name, f.dataType, f.nullable and f.name not in keys) for i, f in enumerate(struct.fields, 1))
        merge = {"merge-engine": "deduplicate", "sequence.field": SEQ, "changelog-producer": "input"} if keys else {}
        return cls(0, fields, len(fields), tuple(keys), tuple(sorted((merge | (options or {})).items())))

    def option(self, name: str, default: str = "") -> str:
        return dict(self.options).get(name) or default

    @property
    def seq(self) -> str:
        return self.option("sequence.field", SEQ)

    @property
    def kind(self) -> str:
        return self.option("rowkind.field", KIND)

    def metadata(self) -> dict[str, str]:
        """Column names of the metadata that the options ask for, by xid, op and tid."""
        return {k: name for k in METADATA_IDS if (name := self.option(f"metadata.{k}"))}

    def logical(self) -> T.StructType:
        """The user's columns, the metadata's and the sequence."""
        return T.StructType([*self.struct().fields, *(T.StructField(n, T.LongType()) for n in self.metadata().values()), T.StructField(self.seq, T.LongType(), False)])

    def fingerprint(self) -> int:
        """32 bits that change with a column's id, name or type and with the metadata asked for."""
        told = [f"{f.id}:{f.name}:{f.type.simpleString()}" for f in self.fields] + [f"{k}:{n}" for k, n in self.metadata().items()]
        return fnv1a32(";".join(told).encode())

    def check(self, given: T.StructType) -> None:
        """An error for columns that the table doesn't have; system columns aside. Missing columns are null."""
        known = {f.name for f in self.fields} | {self.seq, self.kind, "_tid", *self.metadata().values()}
        unknown = [f.name for f in given.fields if f.name not in known]
        if unknown:
            raise SchemaError(f"the table has no column {', '.join(unknown)}")
        for f in self.fields:
            if f.name in given.names and isinstance(f.type, (T.ArrayType, T.MapType, T.StructType)) != isinstance(given[f.name].dataType, (T.ArrayType, T.MapType, T.StructType)):
                raise SchemaError(f"column {f.name} is {f.type.simpleString()}, not {given[f.name].dataType.simpleString()}")

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type, f.nullable) for f in self.fields])

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise SchemaError(f"no column {name}")

    def _next(self, fields: tuple[Field, ...], **more) -> Schema:
        return replace(self, id=self.id + 1, fields=fields, **more)

    def add(self, name: str, kind: T.DataType, nullable: bool = True) -> Schema:
        if any(f.name == name for f in self.fields):
            raise SchemaError(f"column {name} exists")
        if not nullable:
            raise SchemaError("an added column must allow null: rows written before have no value")
        if name.startswith("_KEY_") or name in (self.seq, self.kind, "_SEQUENCE_NUMBER", "_VALUE_KIND", *self.metadata().values()):
            raise SchemaError(f"column name {name} is taken")
        return self._next((*self.fields, Field(self.highest + 1, name, kind)), highest=self.highest + 1)

    def drop(self, name: str) -> Schema:
        self.field(name)
        if name in self.keys:
            raise SchemaError("changing the primary key is not supported")
        return self._next(tuple(f for f in self.fields if f.name != name))

    def rename(self, old: str, new: str) -> Schema:
        self.field(old)
        if any(f.name == new for f in self.fields):
            raise SchemaError(f"column {new} exists")
        return self._next(tuple(replace(f, name=new) if f.name == old else f for f in self.fields), keys=tuple(new if k == old else k for k in self.keys))

    def retype(self, name: str, kind: T.DataType) -> Schema:
        self.field(name)
        return self._next(tuple(replace(f, type=kind) if f.name == name else f for f in self.fields))

    def with_keys(self, keys: tuple[str, ...]) -> Schema:
        if tuple(keys) != self.keys:
            raise SchemaError("changing the primary key is not supported")
        return self

    def to_json(self) -> str:
        fields = [{"id": f.id, "name": f.name, "type": f.type.jsonValue(), "nullable": f.nullable} for f in self.fields]
        system = [(METADATA_IDS[k], name) for k, name in self.metadata().items()] + [(SEQ_FIELD_ID, self.seq)]
        fields += [{"id": i, "name": name, "type": "long", "nullable": False} for i, name in system]
        return json.dumps({"id": self.id, "fields": fields, "highestFieldId": self.highest, "primaryKeys": self.keys, "partitionKeys": [], "options": dict(self.options)})

    @classmethod
    def of_json(cls, text: str) -> Schema:
        data = json.loads(text)
        listed = [f for f in data["fields"] if f["id"] not in (SEQ_FIELD_ID, *METADATA_IDS.values())]
        struct = T.StructType.fromJson({"type": "struct", "fields": [{"name": f["name"], "type": f["type"], "nullable": f["nullable"], "metadata": {}} for f in listed]})
        fields = tuple(Field(raw["id"], f.name, f.dataType, f.nullable) for raw, f in zip(listed, struct.fields, strict=True))
        return cls(data["id"], fields, data["highestFieldId"], tuple(data["primaryKeys"]), tuple(sorted(data["options"].items())))
