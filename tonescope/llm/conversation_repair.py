"""Operator 12, repair of the structure of conversations by iterative-deepening A*.

Every conversation becomes alternating turns of a user and an assistant, after a system turn if it
begins with one, or nothing. Its rows stream through a task in order. What stays in memory of a
conversation is some bytes per row: its role and fault, and a digest that tells copies. The search
then finds the cheapest edits; rows meet them again in a second pass, which writes the repaired turns.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonescope.session import work_folder

SPACES = " \t\n\x0b\x0c\r"
SOUND, UNWANTED, TRUNCATED = 0, 1, 2
DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3
#: What has been written so far: nothing, a system, a user or an assistant turn last.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
_KEPT = {(START, "s"): AFTER_SYSTEM, (START, "u"): AFTER_USER, (AFTER_SYSTEM, "u"): AFTER_USER,
         (AFTER_ASSISTANT, "u"): AFTER_USER, (AFTER_USER, "a"): AFTER_ASSISTANT}


class Search:
    """The cheapest edits of one conversation, by the rows' role initials and faults.

    Depth-first search takes edits in ASCII order, D, I, K and R, and turns back where the cost so far
    and a lower bound of the rest exceed the bound, which starts at the bound of the whole and is
    raised to the least that would let the search go on. As no cheaper way exists then, the first
    accepting path has the least cost, and of the cheapest ones comes first in ASCII order.
    """

    def __init__(self, initials: str, faults: bytes):
        self.initials, self.faults = initials, faults
        self.tails = self._tails()
        #: Proven costs of states from which the search failed: what the rest costs at least.
        self.failed: dict[tuple[int, int], int] = {}

    def _tails(self) -> tuple[list[int], list[int], int]:
        """What rows from i on cost at least when a user's (or an assistant's) turn comes next and no
        system turn is kept; and the last row that could be kept as system turn."""
        n = len(self.initials)
        user, assistant, system = [0] * (n + 1), [INSERT] * (n + 1), -1
        for i in range(n - 1, -1, -1):
            to_user, to_assistant = user[i + 1] + DELETE, assistant[i + 1] + DELETE
            fault = self.faults[i]
            if fault != UNWANTED:
                initial, cut = self.initials[i], CUT if fault == TRUNCATED else 0
                system = max(system, i if initial == "s" else -1)
                to_user = min(to_user, assistant[i + 1] + cut + (0 if initial == "u" else REROLE))
                to_assistant = min(to_assistant, user[i + 1] + cut + (0 if initial == "a" else REROLE))
            user[i] = min(to_user, to_assistant + INSERT)
            assistant[i] = min(to_assistant, to_user + INSERT)
        return user, assistant, system

    def _at_least(self, i: int, state: int) -> int:
        proven = self.failed.get((i, state))
        if proven is not None:
            return proven
        user, assistant, system = self.tails
        if state == AFTER_USER:
            return assistant[i]
        # A path that keeps a system turn could delete it for four more.
        return max(user[i] - DELETE, 0) if state == START and i <= system else user[i]

    def _edits(self, i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """Letter, cost, next row and next state, in ASCII order."""
        other = AFTER_ASSISTANT if state == AFTER_USER else AFTER_USER
        if i == len(self.initials):
            yield "I", INSERT, i, other
            return
        yield "D", DELETE, i + 1, state
        yield "I", INSERT, i, other
        fault = self.faults[i]
        if fault != UNWANTED:
            cut = CUT if fault == TRUNCATED else 0
            kept = _KEPT.get((state, self.initials[i]))
            if kept is not None:
                yield "K", cut, i + 1, kept
            yield "R", cut + REROLE, i + 1, other

    def _within(self, bound: int) -> str | None:
        """The first path that costs at most ``bound``; without one, the start's bound rises."""
        # Frames: row, state, what may still be spent, edits left, edit taken, least cost seen.
        n = len(self.initials)
        frames = [[0, START, bound, self._edits(0, START), "", None]]
        if not n:
            return ""
        while frames:
            frame = frames[-1]
            i, state, left = frame[:3]
            for letter, cost, row, then in frame[3]:
                least = cost + self._at_least(row, then)
                if least > left:
                    frame[5] = least if frame[5] is None else min(frame[5], least)
                    continue
                frame[4] = letter
                if row == n and then in (START, AFTER_ASSISTANT):
                    return "".join(f[4] for f in frames)
                frames.append([row, then, left - cost, self._edits(row, then), "", None])
                break
            else:
                frames.pop()
                self.failed[i, state] = frame[5]
                if frames:
                    above = frames[-1]
                    least = above[2] - left + frame[5]
                    above[5] = least if above[5] is None else min(above[5], least)
        return None

    def run(self) -> tuple[int, str]:
        """The least cost and the audit: a letter per edit."""
        while True:
            bound = self._at_least(0, START)
            path = self._within(bound)
            if path is not None:
                return bound, path


def _ordered(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    return conversations.select(
        conversations[conv_id].cast("long").alias("conv_id"),
        conversations[turn].cast("long").alias("turn"),
        F.coalesce(conversations[role], F.lit(" ")).alias("role"),
        F.coalesce(conversations[text], F.lit(" ")).alias("text"))


_ORDER = ("turn", "role", "text")


def audits(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` per conversation.

    Rows are ordered by turn (null first), role and text, so rows that repeat each other are
    neighbours; a null role or text is one space. All rows without a ``conv_id`` are one conversation.
    The first fault of a row counts: blank, without a character other than ASCII white space; duplicate,
    with role and text of an earlier row; truncated, its last such character none of ``.!?``.
    ``gaps`` are turn numbers missing between the least and the greatest. ``illegal`` are neighbours
    whose role initials are not su, ua or au. The ``audit`` has a letter per edit: K keeps a row for
    nothing, R gives it the role of a user or assistant for 3, D deletes it for 4, as it must with blank
    rows and duplicates, I inserts an empty turn of either for 3; a truncated row that stays costs 3
    more. The edits are the cheapest that leave initials ``(s?(ua)+)?``; of the cheapest, the first in
    ASCII order. A row whose role begins otherwise (or is empty) cannot be kept. Very long texts are
    seen in one row each. An empty table gives no rows; other columns are not read.
    """
    rows = _ordered(conversations, conv_id, turn, role, text)
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER)

    def run(batches) -> Iterator:
        import hashlib

        import pyarrow as pa

        class Conversation:
            def __init__(self, number):
                self.number, self.seen = number, set()
                self.initials, self.faults = [], bytearray()
                self.counts, self.first, self.last, self.turns = [0, 0, 0], None, None, 0
                self.illegal = 0

            def add(self, turn, role, text):
                if turn is not None and turn != self.last:
                    self.first = turn if self.first is None else self.first
                    self.last, self.turns = turn, self.turns + 1
                shown = text.rstrip(SPACES)
                digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"),
                                         digest_size=16).digest()
                fault = SOUND
                for kind, (found, what) in enumerate(((not shown, UNWANTED),
                                                      (digest in self.seen, UNWANTED),
                                                      (shown[-1:] not in (".", "!", "?"), TRUNCATED))):
                    if found:
                        self.counts[kind] += 1
                        fault = what
                        break
                self.seen.add(digest)
                initial = role[:1]
                if self.faults and self.initials[-1] + initial not in ("su", "ua", "au"):
                    self.illegal += 1
                self.initials.append(initial)
                self.faults.append(fault)

            def closed(self):
                letters = "".join(x if x in ("s", "u", "a") else "?" for x in self.initials)
                gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
                return (self.number, gaps, *self.counts, self.illegal,
                        *Search(letters, bytes(self.faults)).run())

        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        kinds = [pa.int64()] * 7 + [pa.string()]

        def batch_of(done):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)],
                names=names)

        current = None
        for batch in batches:
            done = []
            for number, *row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if current is None or current.number != number:
                    if current is not None:
                        done.append(current.closed())
                    current = Conversation(number)
                current.add(*row)
            if done:
                yield batch_of(done)
        if current is not None:
            yield batch_of([current.closed()])

    return dealt.mapInArrow(run, "conv_id long, gaps long, blank long, duplicate long, "
                                 "truncated long, illegal long, cost long, audit string")


def repaired_turns(conversations: DataFrame, audited: DataFrame, conv_id: str = "conv_id",
                   turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, part, edit, turn, role, text``: the turns that the edits of ``audits`` leave, in order.

    ``part`` counts the turns of a conversation from 0, ``edit`` is K, R or I; an inserted turn has an
    empty text and no number. Deleted rows are missing, and so are conversations that lose all.
    """
    rows = _ordered(conversations, conv_id, turn, role, text)
    heads = audited.select("conv_id", F.col("audit").alias("audit"))
    both = rows.unionByName(heads, allowMissingColumns=True)
    # A conversation's edits come before its rows, whose order is that of the audit.
    dealt = (both.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("audit").isNull(), *_ORDER)
        .select("conv_id", "turn", "role", "text", "audit"))

    def run(batches) -> Iterator:
        import pyarrow as pa
        names = ["conv_id", "part", "edit", "turn", "role", "text"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
        number, edits, at, part, last, out = None, "", 0, 0, "", []

        def write(edit, turn, role, text):
            nonlocal part, last
            # A user's turn is due first, and after a system's and an assistant's.
            role = role if edit == "K" else "assistant" if last == "u" else "user"
            out.append((number, part, edit, turn, role, text))
            part, last = part + 1, role[0]

        def insert():
            nonlocal at
            while edits[at:at + 1] == "I":
                write("I", None, None, "")
                at += 1

        for batch in batches:
            out.clear()
            for conv, turn, role, text, audit in zip(
                    *(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if audit is not None:
                    number, edits, at, part, last = conv, audit, 0, 0, ""
                else:
                    edit, at = edits[at], at + 1
                    if edit != "D":
                        write(edit, turn, role, text)
                insert()
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=names)

    return dealt.mapInArrow(run, "conv_id long, part long, edit string, turn long, role string, "
                                 "text string")


def turn_hashes(turns: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of the ``role:text`` of a conversation's turns, joined by line feeds.

    ``turns`` must be what ``repaired_turns`` returned, whose tasks hold whole conversations in order:
    each turn only passes through.
    """
    def run(batches) -> Iterator:
        import hashlib

        import pyarrow as pa
        current, digest = None, None

        def batch_of(done):
            return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()),
                                               pa.array([d[1] for d in done], pa.string())],
                                              names=["conv_id", "sha256"])

        for batch in batches:
            done = []
            for number, part, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)),
                                                strict=True):
                if part == 0:
                    if digest is not None:
                        done.append((current, digest.hexdigest()))
                    current, digest = number, hashlib.sha256()
                digest.update(f"{chr(10) if part else ''}{role}:{text}".encode("utf-8", "replace"))
            if done:
                yield batch_of(done)
        if digest is not None:
            yield batch_of([(current, digest.hexdigest())])

    return turns.select("conv_id", "part", "role", "text").mapInArrow(
        run, "conv_id long, sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` of conversations with faults by the CRC-32 c of ``conv_id:turn``:
    c % 20 = 0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it a
    user's. A null is one space in every column's text."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn"))) % 20
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"),
                                shown("text").alias("text"), fault.alias("fault"))
    rows = rows.where("fault != 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.drop("copy")


def repaired_digests(conversations: DataFrame) -> DataFrame:
    """The audit and the hash of the repaired turns of every conversation after ``damaged``; of one
    that has lost all its rows, zeros, no edits and the hash of nothing."""
    spark = conversations.sparkSession
    rows, folder = damaged(conversations), work_folder(spark, "audits")
    audits(rows).write.parquet(folder)
    audited = spark.read.parquet(folder)
    hashed = turn_hashes(repaired_turns(rows, audited))
    numbers = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = (numbers.alias("n")
             .join(audited.alias("a"), F.expr("n.conv_id <=> a.conv_id"), "left")
             .join(hashed.alias("h"), F.expr("n.conv_id <=> h.conv_id"), "left"))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        "n.conv_id", *[F.coalesce(f"a.{c}", F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("a.audit", F.lit("")).alias("audit"),
        F.coalesce("h.sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def repair_sql() -> str:
    """The rows of ``op12_conversation_repair`` in DuckDB's SQL.

    Row by row from the end, the best edits are kept for each state as text: cost in nine digits,
    then the letters, so that the least text is the cheapest and first in ASCII order.
    """
    from .oracle_parts import crc32_sql
    crc = crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || "
                    "coalesce(CAST(turn AS VARCHAR), ' ')")

    def step(cost: int, letter: str, rest: str) -> str:
        return (f"(printf('%09d', CAST({rest}[1:9] AS INT) + {cost}) || '{letter}' || "
                f"{rest}[10:])")

    def plus(extra: int, letter: str, rest: str) -> str:
        cut, whole = step(extra + CUT, letter, rest), step(extra, letter, rest)
        return f"CASE WHEN fault = 2 THEN {cut} WHEN fault = 0 THEN {whole} END"

    def kept(state: int) -> str:
        letters = [(x, then) for (at, x), then in _KEPT.items() if at == state]
        cases = " ".join(f"WHEN initial = '{x}' THEN {plus(0, 'K', f'b{then}')}" for x, then in letters)
        return f"CASE {cases} END"

    def best(state: int) -> str:
        other = AFTER_ASSISTANT if state == AFTER_USER else AFTER_USER
        return (f"least({step(DELETE, 'D', f'b{state}')}, {kept(state)}, "
                f"{plus(REROLE, 'R', f'b{other}')}) AS c{state}")

    bests = ", ".join(best(q) for q in range(4))
    spaces = r"[\x20\x09-\x0D]"
    return f"""
WITH RECURSIVE given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                                {crc} % 20 AS c FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN c = 4 THEN 'user' ELSE role END AS role,
                   CASE c WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(CASE WHEN c = 3 THEN [0, 1] ELSE [0] END) AS copy FROM given WHERE c <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text,
                                          copy) AS i FROM damaged),
marked AS (SELECT *, regexp_replace(text, '{spaces}+$', '') AS shown, role[1:1] AS initial,
                  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                  lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM numbered),
faulty AS (SELECT *, shown = '' AS blank, shown <> '' AND again AS duplicate,
                  shown <> '' AND NOT again AND right(shown, 1) NOT IN ('.', '!', '?') AS truncated
           FROM marked),
f AS (SELECT *, CASE WHEN blank OR duplicate THEN 1 WHEN truncated THEN 2 ELSE 0 END AS fault
      FROM faulty),
counted AS (SELECT conv_id, count(*) AS n,
                   coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
                   count(*) FILTER (WHERE truncated) AS truncated,
                   count(*) FILTER (WHERE before IS NOT NULL AND before[1:1] || initial NOT IN
                                    ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
r AS (SELECT conv_id, n AS i, '000000000' AS b0, '000000006II' AS b1, '000000003I' AS b2,
             '000000000' AS b3 FROM counted
      UNION ALL
      SELECT conv_id, i - 1 AS i, least(c0, {step(INSERT, 'I', 'd2')}) AS b0,
             least(c1, {step(INSERT, 'I', 'd2')}) AS b1, d2 AS b2,
             least(c3, {step(INSERT, 'I', 'c2')}) AS b3
      FROM (SELECT *, least(c2, {step(INSERT, 'I', 'c3')}) AS d2 FROM
            (SELECT r.conv_id, r.i, {bests} FROM r JOIN f ON r.conv_id = f.conv_id AND r.i = f.i))),
audited AS (SELECT conv_id, CAST(b0[1:9] AS BIGINT) AS cost, b0[10:] AS audit FROM r WHERE i = 0),
letters AS (SELECT conv_id, unnest(string_split(audit, '')) AS edit,
                   generate_subscripts(string_split(audit, ''), 1) AS place FROM audited
            WHERE audit <> ''),
placed AS (SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER (PARTITION BY conv_id ORDER BY place) AS i
           FROM letters),
written AS (SELECT p.conv_id, p.edit, p.place, f.role, f.text,
                   p.edit = 'K' AND f.initial = 's' AS system
            FROM placed p LEFT JOIN f ON p.conv_id = f.conv_id AND p.i = f.i AND p.edit <> 'I'
            WHERE p.edit <> 'D'),
due AS (SELECT *, count(*) FILTER (WHERE NOT system) OVER (PARTITION BY conv_id ORDER BY place) % 2 AS odd
        FROM written),
hashed AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN odd = 1 THEN 'user'
                  ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY place)) AS hash
           FROM due GROUP BY conv_id)
SELECT n.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       coalesce(hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) n
LEFT JOIN counted c ON n.conv_id = c.conv_id LEFT JOIN audited a ON n.conv_id = a.conv_id
LEFT JOIN hashed h ON n.conv_id = h.conv_id"""
