"""The same results in plain SQL over the given tables."""

from __future__ import annotations

from tonescope.sources.layout import FIELDS

from . import feeds

C, B = feeds.COUNTRY, feeds.BATCHES


def _week(day: str, week_start: str = "iso") -> str:
    shifted = f"CAST({day} AS DATE)" + (" + INTERVAL 1 DAY" if week_start == "us" else "")
    return f"CAST(date_trunc('week', {shifted}) AS DATE)"


def _parse_events() -> str:
    columns = ", ".join(f'{feeds.field_sql(name, kind)} AS "{name}"' for name, kind in FIELDS)
    return f"SELECT {columns} FROM events"


def _parse_rules() -> str:
    kinds = dict(FIELDS)
    def column(name, classes):
        kind = {"string": "VARCHAR"}.get(kinds[name], kinds[name])
        whens = " ".join(f"WHEN {i} THEN {sql or 'NULL'}" for i, (_, sql) in enumerate(classes))
        return f'CAST(CASE event_id % 8 {whens} END AS {kind}) AS "{name}"'
    columns = ", ".join(column(name, classes) for name, classes in feeds.RULES.items())
    return f'SELECT CAST(event_id AS INT) AS "globalEventID", {columns} FROM events'


def _cell_errors() -> str:
    def errors(name):
        bad = [str(i) for i, (text, sql) in enumerate(feeds.RULES.get(name, []))
               if text and sql is None]
        n = f"count(*) FILTER (WHERE event_id % 8 IN ({', '.join(bad)}))" if bad else "0 * count(*)"
        return f"SELECT '{name}' AS column_name, {n} AS n_errors FROM events"
    return " UNION ALL ".join(errors(name) for name, kind in FIELDS
                              if kind not in ("string", "boolean"))


_REASON = ("CASE event_id % 8 " + " ".join(f"WHEN {i} THEN '{reason}'"
                                           for i, reason in feeds.ODD_REASONS.items()) + " END")
_QUARANTINE = f"""SELECT {_REASON} AS reason, count(*) AS n FROM events
WHERE {_REASON} IS NOT NULL GROUP BY 1"""

_EVENT_TABLE = f"""
SELECT coalesce({_REASON}, 'ok') AS status,
       CASE WHEN {_REASON} IS NULL THEN CAST(year(ts) * 100 + month(ts) AS INT) END AS added_month,
       count(*) AS n,
       count(*) FILTER (WHERE {_REASON} IS NULL AND event_id % 8 <> 1) AS n_urls,
       CAST(sum(CASE WHEN {_REASON} IS NULL THEN event_id END) AS BIGINT) AS id_sum
FROM events GROUP BY 1, 2"""

_BOTH = f"""
WITH t AS ({feeds.TONE_EVENTS}), known AS (SELECT * FROM t WHERE c1 IS NOT NULL AND c2 IS NOT NULL)
SELECT l_orderkey, l_linenumber, tone, c1, c2 FROM known
UNION ALL SELECT l_orderkey, l_linenumber, tone, c2 AS c1, c1 AS c2 FROM known"""

_LABELLED = "coalesce(c1, 'UKNOWN') AS c1, coalesce(c2, 'UKNOWN') AS c2"
_UNPIVOT = f"WITH t AS ({feeds.TONE_EVENTS}) " + " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, {_LABELLED}, {t} AS actor_type FROM t WHERE {t} IS NOT NULL"
    for t in feeds.TYPES)

_DAILY = f"""
SELECT event_type, round(sum(value), 6) AS tone_sum,
       CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
       CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end
FROM events WHERE event_type = '{C}' GROUP BY event_type, date_trunc('day', ts)"""

_LATE = """
WITH b AS (SELECT event_id, ts, event_id * 7 % 10 AS batch FROM events),
m AS (SELECT batch, max(ts) AS latest FROM b GROUP BY batch),
w AS (SELECT a.batch, max(m.latest) AS mark FROM m a LEFT JOIN m ON m.batch <= a.batch - 2
      GROUP BY a.batch)
SELECT b.event_id, b.batch,
       coalesce(date_trunc('day', b.ts) + INTERVAL 1 DAY <= w.mark - INTERVAL 2 DAY, false) AS late
FROM b JOIN w ON b.batch = w.batch"""

_WEEKLY = f"""SELECT {_week('ts')} AS week, round(sum(value), 6) AS tone_sum
FROM events WHERE event_type = '{C}' GROUP BY 1"""



def _halving(batch: str) -> str:
    """CTE ``h``: the average of a week after each batch; ``batch`` is over ``events``."""
    return f"""
WITH b AS (SELECT *, {batch} AS batch FROM events),
s AS (SELECT {_week('ts')} AS week, batch, sum(value) AS s
      FROM b WHERE event_type = '{C}' GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY week ORDER BY batch) - 1 AS k FROM s),
h AS (SELECT week, batch, sum(s * pow(2, k)) OVER (PARTITION BY week ORDER BY batch)
             / pow(2, k + 1) AS average FROM k)
"""


_HALVING = _halving(f"event_id % {B}")
_DELIVERY = f"""(row_number() OVER (ORDER BY event_id) - 1)
// CAST(ceil(count(*) OVER () / {feeds.DELIVERIES}) AS BIGINT)"""


def _pairs(week_start: str) -> str:
    return f"""
WITH t AS ({feeds.TONE_EVENTS}),
known AS (SELECT {_week('ts', week_start)} AS week, c1, c2, tone FROM t
          WHERE c1 IS NOT NULL AND c2 IS NOT NULL),
two AS (SELECT week, c1, c2, tone FROM known
         UNION ALL SELECT week, c2 AS c1, c1 AS c2, tone FROM known),
r AS (SELECT week, c1, c2, count(*) AS n, round(avg(tone), 6) AS mean_tone FROM two
      GROUP BY week, c1, c2)
"""


def _types(week_start: str = "iso", batch: str = "") -> str:
    """CTE ``legs``: a row per event, type and direction."""
    extra = f", {batch} AS batch" if batch else ""
    kept = ", batch" if batch else ""
    legs = " UNION ALL ".join(f"SELECT week, c1, c2, tone, {t} AS actor_type{kept} FROM l "
                              f"WHERE {t} IS NOT NULL" for t in feeds.TYPES)
    return f"""
WITH t AS ({feeds.TONE_EVENTS}),
l AS (SELECT {_week('ts', week_start)} AS week, {_LABELLED}, tone, {', '.join(feeds.TYPES)}{extra}
      FROM t),
u AS ({legs}),
legs AS (SELECT week, c1, c2, actor_type, tone{kept} FROM u
         UNION ALL SELECT week, c2 AS c1, c1 AS c2, actor_type, tone{kept} FROM u),
"""


_STATS = """stats AS (SELECT week, c1, c2, actor_type, count(*) AS n, avg(tone) AS mean
                      FROM legs GROUP BY week, c1, c2, actor_type)"""
_TOP = f"""{_STATS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY week, c1, c2 ORDER BY n DESC, actor_type)
           AS rank FROM stats),
top AS (SELECT * FROM ranked WHERE rank <= 5)"""
_TOP_ROWS = """SELECT week, c1, c2, actor_type, n, round(mean, 6) AS mean_tone,
CAST(rank AS INT) AS rank FROM top"""
_TOP_TEXT = """'[' || string_agg('(' || actor_type || ',' || n || ',' ||
printf('%.6f', round(mean, 6)) || ')', ', ' ORDER BY rank) || ']'"""

_TOUCHED = _types(batch=f"(l_orderkey + l_linenumber) % {B}") + """
sums AS (SELECT batch, week, c1, c2, actor_type, count(*) AS n, sum(tone) AS s FROM legs
         GROUP BY batch, week, c1, c2, actor_type),
run AS (SELECT batch, week, c1, c2, actor_type, CAST(sum(n) OVER so_far AS BIGINT) AS n,
               sum(s) OVER so_far AS s FROM sums
        WINDOW so_far AS (PARTITION BY week, c1, c2, actor_type ORDER BY batch)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY batch, week, c1, c2
                                        ORDER BY n DESC, actor_type) AS rank FROM run)
SELECT batch, week, c1, c2, actor_type, n, round(s / n, 6) AS mean_tone,
       CAST(rank AS INT) AS rank FROM ranked WHERE rank <= 5"""

_PAIR_LINES = _pairs("iso") + """SELECT c1 || ';' || c2 || ';' || strftime(week, '%Y-%m-%d') || ';'
|| printf('%.6f', mean_tone) AS value FROM r"""
_TOP5_LINES = _types() + _TOP + f""" SELECT c1 || ';' || c2 || ';' || strftime(week, '%Y-%m-%d')
|| ';' || {_TOP_TEXT} AS value FROM top GROUP BY week, c1, c2"""

def _exact(value: str) -> str:
    """The sum of whole numbers that a double is split into, put together once."""
    step = 1 << 30
    below = f"({value} - floor({value})) * {step}"
    whole, first = f"sum(CAST(floor({value}) AS HUGEINT))", f"sum(CAST(floor({below}) AS HUGEINT))"
    second = f"sum(CAST(floor(({below} - floor({below})) * {step}) AS HUGEINT))"
    carried = f"({first} + {second} // {step})"
    return (f"(CAST({whole} + {carried} // {step} AS DOUBLE) + CAST(({carried} % {step}) * {step} + "
            f"{second} % {step} AS DOUBLE) / {float(step * step)!r})")


def _exact_pairs(rows: str, kept: str = "") -> str:
    """Means of ordered pairs from exact sums of unordered ones; ``kept`` are further keys."""
    return f"""
s AS (SELECT week, {kept} least(c1, c2) AS x, greatest(c1, c2) AS y, count(*) AS n,
             {_exact('tone')} AS s FROM {rows} GROUP BY ALL),
t2 AS (SELECT *, CASE WHEN x = y THEN 2 ELSE 1 END AS times FROM s)
SELECT week, {kept} x AS c1, y AS c2, n * times AS n, s * times / (n * times) AS mean_tone FROM t2
UNION ALL
SELECT week, {kept} y AS c1, x AS c2, n, s / n AS mean_tone FROM t2 WHERE x <> y"""


_EXACT_DAYS = _DAILY.replace("round(sum(value), 6)", _exact("value"))
_EXACT_TYPES = _types().rstrip().rstrip(",") + ", " + _exact_pairs("u", "actor_type,")

ORACLES = {
    "daily_tone_sum_exact": _EXACT_DAYS,
    "bilateral_tone_exact": _pairs("iso").rstrip() + ", " + _exact_pairs("known"),
    "actor_type_stats_exact": _EXACT_TYPES,
    "parse_events": _parse_events(),
    "parse_events_files": _parse_events(),
    "parse_rules": _parse_rules(),
    "quarantine": _QUARANTINE,
    "cell_errors": _cell_errors(),
    "event_table_roundtrip": _EVENT_TABLE,
    "country_filter": f"SELECT event_id, event_type, value FROM events WHERE event_type = '{C}'",
    "week_bucket_iso": f"SELECT event_id, {_week('ts')} AS week FROM events",
    "week_bucket_us": f"SELECT event_id, {_week('ts', 'us')} AS week FROM events",
    "pair_fanout": _BOTH,
    "type_unpivot": _UNPIVOT,
    "daily_tone_sum": _DAILY,
    "late_split": _LATE,
    "weekly_tone_sum": _WEEKLY,
    "weekly_halving_avg": _HALVING + "SELECT week, batch, round(average, 6) AS average FROM h",
    "bilateral_tone": _pairs("iso") + "SELECT * FROM r",
    "bilateral_tone_us": _pairs("us") + "SELECT * FROM r",
    "actor_type_stats": _types() + _STATS + """
SELECT week, c1, c2, actor_type, n, round(mean, 6) AS mean_tone FROM stats""",
    "actor_type_top5": _types() + _TOP + _TOP_ROWS,
    "actor_type_top5_us": _types("us") + _TOP + _TOP_ROWS,
    "actor_type_top5_list": _types() + _TOP + f"""
SELECT week, c1, c2, {_TOP_TEXT} AS ranking FROM top GROUP BY week, c1, c2""",
    "actor_type_top5_touched": _TOUCHED,
    "render_bilateral": _PAIR_LINES,
    "render_top5": _TOP5_LINES,
    "render_weekly": _HALVING + f"""SELECT 'Country({C}), Week(' || strftime(week, '%Y-%m-%d')
|| '), AvgTone(' || printf('%.6f', round(average, 6)) || ')' AS value FROM h""",
    "text_sink_roundtrip": _PAIR_LINES,
}

# Streams end with the results of the batch queries; only the last day of a daily sum stays open.
ORACLES |= {
    "parse_events_stream": ORACLES["parse_events"],
    "daily_tone_sum_stream": f"""SELECT * FROM ({_DAILY}) WHERE window_end <=
(SELECT max(ts) FROM events WHERE event_type = '{C}')""",
    "weekly_halving_avg_stream": ORACLES["weekly_halving_avg"],
    "bilateral_tone_stream": ORACLES["bilateral_tone"],
    "actor_type_top5_stream": ORACLES["actor_type_top5"],
    "actor_type_top5_touched_stream": ORACLES["actor_type_top5_touched"],
}

# The numbers of the batches are those of the deliveries; a pair shows where a batch touched it.
_RUNNING = _types(batch=f"(l_orderkey + l_linenumber) % {B}") + """
sums AS (SELECT batch, week, c1, c2, actor_type, count(*) AS n, sum(tone) AS s FROM legs
         GROUP BY batch, week, c1, c2, actor_type),
touched AS (SELECT DISTINCT batch, week, c1, c2 FROM sums),
run AS (SELECT t.batch, t.week, t.c1, t.c2, s.actor_type, CAST(sum(n) AS BIGINT) AS n, sum(s) AS s
        FROM touched t JOIN sums s ON t.week = s.week AND t.c1 = s.c1 AND t.c2 = s.c2
        AND s.batch <= t.batch GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY batch, week, c1, c2
                                        ORDER BY n DESC, actor_type) AS rank FROM run)
SELECT batch, week, c1, c2, actor_type, n, round(s / n, 6) AS mean_tone,
       CAST(rank AS INT) AS rank FROM ranked WHERE rank <= 5"""

_QUARTERS = """(SELECT *, CAST(floor((event_id - min(event_id) OVER ()) * 4 / count(*) OVER ()) AS INT)
AS quarter FROM events)"""
_LATE_DAYS = f"""SELECT * FROM ({_DAILY.replace("FROM events", f"FROM {_QUARTERS}").replace(
    "GROUP BY", "AND quarter <> 1 GROUP BY")})
WHERE window_end <= (SELECT max(ts) FROM events WHERE event_type = '{C}')"""
_TWO_FEEDS = f"""SELECT * FROM ({_DAILY}) WHERE window_end <= (SELECT min(latest) FROM (
SELECT max(ts) AS latest FROM events WHERE event_type = '{C}' GROUP BY event_id % 2))"""

_WEEK_LINES = f"""SELECT 'Country({C}), Week(' || strftime({_week('ts', 'us')}, '%Y-%m-%d') ||
'), AvgTone(' || printf('%.6f', round(sum(value) / 2, 6)) || ')' AS value
FROM events WHERE event_type = '{C}' GROUP BY {_week('ts', 'us')}"""

_TOP3_US = (_types("us").replace("'UKNOWN'", "'NONE'") + _TOP.replace("rank <= 5", "rank <= 3") + f"""
SELECT c1 || ';' || c2 || ';' || strftime(week, '%Y-%m-%d') || ';' || {_TOP_TEXT} AS value
FROM top GROUP BY week, c1, c2""")

# Both text outputs of each batch: running values of what the batch touched.
_BATCH = f"(l_orderkey + l_linenumber) % {B}"
_FILES = _TOUCHED.replace("SELECT batch, week, c1, c2, actor_type, n, round(s / n, 6) AS mean_tone,\n"
                          "       CAST(rank AS INT) AS rank FROM ranked WHERE rank <= 5", "") + f""",
known AS (SELECT {_week('ts')} AS week, c1, c2, tone, {_BATCH} AS batch FROM t
          WHERE c1 IS NOT NULL AND c2 IS NOT NULL),
two AS (SELECT week, c1, c2, tone, batch FROM known
        UNION ALL SELECT week, c2 AS c1, c1 AS c2, tone, batch FROM known),
brought AS (SELECT batch, week, c1, c2, count(*) AS n, sum(tone) AS s FROM two
            GROUP BY batch, week, c1, c2),
pairs AS (SELECT batch, week, c1, c2, sum(s) OVER so_far / sum(n) OVER so_far AS mean FROM brought
          WINDOW so_far AS (PARTITION BY week, c1, c2 ORDER BY batch)),
top AS (SELECT *, s / n AS mean FROM ranked WHERE rank <= 5)
SELECT 'bilateral_relationships' AS output, batch, c1 || ';' || c2 || ';' ||
       strftime(week, '%Y-%m-%d') || ';' || printf('%.6f', round(mean, 6)) AS value FROM pairs
UNION ALL
SELECT 'week' AS output, batch, c1 || ';' || c2 || ';' || strftime(week, '%Y-%m-%d') || ';' ||
       {_TOP_TEXT} AS value FROM top GROUP BY batch, week, c1, c2"""

ORACLES |= {
    "parse_events_interval_stream": ORACLES["parse_events"],
    "event_table_two_feeds": _EVENT_TABLE,
    "event_table_compacted": _EVENT_TABLE,
    "daily_tone_sum_late_stream": _LATE_DAYS,
    "daily_tone_two_feeds_stream": _TWO_FEEDS,
    "daily_tone_job_lines": f"""SELECT * FROM ({_DAILY}) WHERE window_end <=
(SELECT max(CAST(ts AS DATE)) FROM events WHERE event_type = '{C}')""",
    "weekly_tone_job_lines": _WEEK_LINES,
    "weekly_halving_file_stream": _halving(_DELIVERY) + """SELECT week, batch,
round(average, 6) AS average FROM h""",
    "bilateral_tone_log_stream": ORACLES["bilateral_tone"],
    "bilateral_tone_feeds": ORACLES["bilateral_tone"],
    "actor_type_top5_sums_stream": ORACLES["actor_type_top5"],
    "actor_type_top5_running_stream": _RUNNING,
    "relations_job_us": _TOP3_US,
    "relation_files_stream": _FILES,
}
