"""The given tables as feeds: a single-country one, a country-pair one, and event lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescope.sources.layout import FIELDS

COUNTRY = "click"
PLACES = ("c1", "c2")
TYPES = ("a1_type1", "a1_type2", "a1_type3", "a2_type1", "a2_type2", "a2_type3")
BATCHES = 4
DELIVERIES = 6
#: Lines of a file that a feed is written in, about.
FILE_LINES = 200_000

# Runs unchanged in Spark and in DuckDB.
TONE_EVENTS = """
SELECT l_orderkey, l_linenumber, l_shipdate AS ts, l_discount AS tone,
       nullif(cn.n_name, 'NATION_7') AS c1, nullif(sn.n_name, 'NATION_3') AS c2,
       c_mktsegment AS a1_type1, nullif(l_linestatus, 'O') AS a1_type2,
       nullif(l_returnflag, 'N') AS a1_type3, o_orderpriority AS a2_type1,
       p_brand AS a2_type2, nullif(o_orderstatus, 'P') AS a2_type3
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation cn ON c_nationkey = cn.n_nationkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation sn ON s_nationkey = sn.n_nationkey
JOIN part ON l_partkey = p_partkey
"""
_TABLES = ("lineitem", "orders", "customer", "nation", "supplier", "part")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def tone_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in _TABLES}
    query = TONE_EVENTS
    for name in _TABLES:
        query = query.replace(f"FROM {name}\n", f"FROM {{{name}}} {name}\n")
        query = query.replace(f"JOIN {name} ON", f"JOIN {{{name}}} {name} ON")
        query = query.replace(f"JOIN {name} cn", f"JOIN {{{name}}} cn")
        query = query.replace(f"JOIN {name} sn", f"JOIN {{{name}}} sn")
    return spark.sql(query, **tables)


# Every field of an event line as an expression over ``events`` that Spark and DuckDB both run.
_ACTOR1 = {"code": "upper(event_type)", "name": "props", "countryCode": "event_type",
           "knownGroupCode": "nullif(event_type, 'error')", "ethnicCode": "'eth'",
           "religion1Code": "cast(user_id AS varchar(20))", "type1Code": "'GOV'",
           "type2Code": "nullif(upper(event_type), 'CLICK')"}
_ACTOR2 = {"code": "'B'", "name": "concat('user \"', cast(user_id AS varchar(20)), '\"')",
           "countryCode": "nullif(event_type, 'view')", "religion2Code": "'r;2'",
           "type1Code": "'MIL'", "type3Code": "' padded '"}
_PLACE = {"type": "cast(event_id % 5 AS int)", "name": "concat(event_type, ', place')",
          "countryCode": "substring(event_type, 1, 2)", "lat": "value / 4",
          "long": "-value", "featureId": "cast(-user_id AS int)"}
_FIELD_SQL = {
    "globalEventID": "cast(event_id AS int)", "day": "cast(ts AS date)",
    "month": "cast(year(ts) * 100 + month(ts) AS int)", "year": "cast(year(ts) AS int)",
    "fracDate": "value / 3", "isRoot": "event_id % 2 = 1", "eventCode": "'010'",
    "eventBaseCode": "'01'", "eventRootCode": "substring(props, 2, 3)",
    "quadClass": "cast(event_id % 4 AS int)", "goldstein": "value - 50",
    "numMentions": "cast(user_id AS int)", "numSources": "cast(user_id * 2 AS int)",
    "avgTone": "value", "dateAdded": "cast(ts AS date)",
    "sourceUrl": "concat('http://example.org/', props)",
    **{f"actor1Code_{part}": sql for part, sql in _ACTOR1.items()},
    **{f"actor2Code_{part}": sql for part, sql in _ACTOR2.items()},
    **{f"actor1Geo_{part}": sql for part, sql in _PLACE.items()},
    **{f"eventGeo_{part}": sql for part, sql in _PLACE.items()},
}


def field_sql(name: str, kind: str) -> str:
    """The typed value of a field; fields without a source are null."""
    return _FIELD_SQL.get(name, f"cast(NULL AS {'varchar(1)' if kind == 'string' else kind})")


def _cell_text(name: str, kind: str) -> Column:
    value = F.expr(field_sql(name, kind))
    if kind == "date":
        value = F.date_format(value, "yyyyMMdd")
    elif kind == "boolean":
        value = F.when(value, "1").otherwise("0")
    return F.coalesce(value.cast("string"), F.lit(""))


def cells() -> dict[str, Column]:
    """Text of every field of an event line, in order."""
    return {name: _cell_text(name, kind) for name, kind in FIELDS}


def event_lines(spark: SparkSession, sf_dir: str, *kept: str) -> DataFrame:
    return lines_of(events(spark, sf_dir), *kept)


def lines_of(rows: DataFrame, *kept: str) -> DataFrame:
    """The event lines of ``rows`` of ``events``, in their order."""
    return rows.select(F.concat_ws("\t", *cells().values()).alias("value"), *kept)


def quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with ``quarter``, 0 to 3, by time: event ids ascend with it."""
    rows = events(spark, sf_dir)
    n = rows.count()
    return rows.withColumn("quarter", F.floor((F.col("event_id") - _first_id(rows)) * 4 / n).cast("int"))


def _first_id(rows: DataFrame) -> int:
    return rows.agg(F.min("event_id")).first()[0]


# Good and bad cells: per class event_id % 8, the text of a cell and the SQL of what it means.
RULES = {
    "quadClass": [("3", "3"), ("+5", "5"), ("-5", "-5"), ("1.0", None), ("1e3", None),
                  ("2147483648", None), (" 5 ", None), ("", None)],
    "goldstein": [("-2.5", "-2.5"), ("abc", None), ("", None), ("1e3", "1000"), ("1d", "1"),
                  ("nan", None), (" 7.25 ", "7.25"), ("inf", None)],
    "day": [("20180101", "DATE '2018-01-01'"), ("20180230", None), ("2018010", None),
            ("20180101x", None), ("", None), (" 20180101", None),
            ("20200229", "DATE '2020-02-29'"), ("20181301", None)],
    "isRoot": [("1", "true"), ("0", "false"), ("x", "false"), ("", None), ("true", "false"),
               ("1 ", "false"), ("01", "false"), ("1", "true")],
    "actor1Code_name": [("plain", "'plain'"), ('"q', "'\"q'"), ("", None),
                        (" padded ", "' padded '"), ("a;b,c", "'a;b,c'"), ("é", "'é'"),
                        ("it's", "'it''s'"), ("\\N", "'\\N'")],
}


def rule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = cells()
    for name, classes in RULES.items():
        texts = F.array(*[F.lit(text) for text, _ in classes])
        line[name] = F.get(texts, (F.col("event_id") % 8).cast("int"))
    return events(spark, sf_dir).select(F.concat_ws("\t", *line.values()).alias("value"))


def odd_lines(spark: SparkSession, sf_dir: str, *kept: str) -> DataFrame:
    """By event_id % 8: whole, 57 fields, 40 fields, 59 fields, blank, bad date, one surplus empty
    field, spaces only."""
    texts = list(cells().values())
    added = [name for name, _ in FIELDS].index("dateAdded")
    whole = F.concat_ws("\t", *texts)
    shapes = F.array(
        whole, F.concat_ws("\t", *texts[:57]), F.concat_ws("\t", *texts[:40]),
        F.concat_ws("\t", *texts, F.lit("x")), F.lit(""),
        F.concat_ws("\t", *texts[:added], F.lit("20189999"), *texts[added + 1:]),
        F.concat_ws("\t", *texts, F.lit("")), F.lit("   "))
    return events(spark, sf_dir).select(
        F.get(shapes, (F.col("event_id") % 8).cast("int")).alias("value"), *kept)


ODD_REASONS = {2: "no_date", 3: "too_many_fields", 4: "blank", 5: "no_date", 7: "blank"}
