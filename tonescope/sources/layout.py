"""The 58 positional fields of an event line."""

from __future__ import annotations

# Field names, types and order of the event file.
_ACTOR = [
    ("code", "string"), ("name", "string"), ("countryCode", "string"),
    ("knownGroupCode", "string"), ("ethnicCode", "string"),
    ("religion1Code", "string"), ("religion2Code", "string"),
    ("type1Code", "string"), ("type2Code", "string"), ("type3Code", "string"),
]
_PLACE = [
    ("type", "int"), ("name", "string"), ("countryCode", "string"), ("adm1Code", "string"),
    ("lat", "double"), ("long", "double"), ("featureId", "int"),
]
_LAYOUT = [
    ("globalEventID", "int"), ("day", "date"), ("month", "int"), ("year", "int"),
    ("fracDate", "double"),
    ("actor1Code", _ACTOR), ("actor2Code", _ACTOR),
    ("isRoot", "boolean"),
    ("eventCode", "string"), ("eventBaseCode", "string"), ("eventRootCode", "string"),
    ("quadClass", "int"), ("goldstein", "double"),
    ("numMentions", "int"), ("numSources", "int"), ("numArticles", "int"),
    ("avgTone", "double"),
    ("actor1Geo", _PLACE), ("actor2Geo", _PLACE), ("eventGeo", _PLACE),
    ("dateAdded", "date"), ("sourceUrl", "string"),
]

FIELDS: list[tuple[str, str]] = [
    field
    for name, kind in _LAYOUT
    for field in ([(name, kind)] if isinstance(kind, str)
                  else [(f"{name}_{part}", part_kind) for part, part_kind in kind])
]
NAMES = [name for name, _ in FIELDS]
EVENT_DDL = ", ".join(f"`{name}` {kind}" for name, kind in FIELDS)

# Columns the pipelines read.
COUNTRY = "actor1Code_countryCode"
PLACES = ("actor1Geo_countryCode", "actor2Geo_countryCode")
ACTOR_TYPES = tuple(f"actor{actor}Code_type{n}Code" for actor in (1, 2) for n in (1, 2, 3))
TONE = "avgTone"
ADDED = "dateAdded"
