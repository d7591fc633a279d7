"""Operator 3, chat formatting by a template compiler.

A template is parsed to a syntax tree, constants are folded, and the tree becomes Python closures.
The language is a sandbox: names, attributes and keys of plain dictionaries, literals, comparison,
``and``/``or``/``not``, ``+``, ``a if c else b``, listed filters; ``if``, ``for``, ``set``, and
``generation`` blocks, whose text a model learns from. There are no calls, and no Python attribute can be
reached. What a template gets wrong, when it is compiled or on some row, is a ``TemplateError``.

A template renders a conversation by a loop ``{% for message in messages %}`` (role, text) at its top
level, with Jinja's ``loop``: ``index``, ``index0``, ``first``, ``last``, and the neighbours ``previtem`` and
``nextitem``, of which the role is known. Turns are numbered in Spark and the loop's rounds are rendered
row by row, what stands before and after the loop with the first and the last row, so a conversation of
any length is never gathered in one row. Its parts, in order, are its formatted text. A template without
this loop renders each turn by itself, with ``message``, ``index``, ``first`` and ``last``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT = (
    "<|begin|>{% for message in messages %}<|turn|>{{ message.role | escape }}\n"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}"
    "{% endgeneration %}{% else %}{{ message.text | escape }}{% endif %}<|end|>\n"
    "{% endfor %}<|stop|>")
#: What only the loop at the top level may ask for.
MESSAGES = "messages"

# Every control string starts with one of the two opening characters, which no escaped text holds.
_CODES = {"\\": "\\\\", "<": "\\l", "[": "\\b", "\n": "\\n"}
_PLAIN = {"\\": "\\", "l": "<", "b": "[", "n": "\n"}
_TURN = re.compile(r"<\|turn\|>([^<\n]*)\n([^<]*)<\|end\|>\n")


def escape(text: str) -> str:
    """No ``<``, ``[`` or line end is left, so no control string can be."""
    return re.sub(r"[\\<\[\n]", lambda m: _CODES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN[m[1]], text)


FILTERS: dict[str, Callable] = {
    "escape": lambda x: escape(str(x)), "upper": lambda x: str(x).upper(),
    "lower": lambda x: str(x).lower(), "trim": lambda x: str(x).strip(), "length": len,
    "lines": lambda x: str(x).split("\n")}

_TOKEN = re.compile(r"\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_]\w*)"
                    r"|(==|!=|<=|>=|[-+<>|.()\[\]]))")
# A block ends behind its strings, whatever they hold.
_STRINGS = r"(?:'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|.)*?"
_BLOCK = re.compile(r"(\{\{" + _STRINGS + r"\}\}|\{%" + _STRINGS + r"%\})", re.S)


class TemplateError(ValueError):
    """A template that the language does not allow."""


class Parser:
    """Expressions to trees: tuples of a kind and its parts."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.strip()
        while at < len(source):
            if not (m := _TOKEN.match(source, at)):
                raise TemplateError(f"unexpected {source[at:at + 10]!r}")
            number, string, name, sign = m.groups()
            self.tokens.append(("number", int(number)) if number else ("string", re.sub(
                r"\\(.)", lambda e: {"n": "\n", "t": "\t"}.get(e[1], e[1]), string[1:-1]))
                if string else ("name", name) if name else ("sign", sign))
            at = m.end()
        self.at = 0

    def peek(self, *words: str) -> bool:
        return (self.at < len(self.tokens) and self.tokens[self.at][0] in ("name", "sign")
                and self.tokens[self.at][1] in words)

    def accept(self, *words: str) -> str | None:
        if self.peek(*words):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("a name is missing")
        self.at += 1
        found = self.tokens[self.at - 1][1]
        if found.startswith("_"):
            raise TemplateError(f"{found} is out of reach")
        return found

    def whole(self) -> tuple:
        tree = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def choice(self) -> tuple:
        tree = self.binary(0)
        if self.accept("if"):
            condition = self.binary(0)
            other = self.choice() if self.accept("else") else ("const", "")
            return ("choice", condition, tree, other)
        return tree

    LEVELS = (("or",), ("and",), ("==", "!=", "<", ">", "<=", ">=", "in"), ("+",))

    def binary(self, level: int) -> tuple:
        if level == len(self.LEVELS):
            return self.filtered()
        if level == 2 and self.accept("not"):
            return ("not", self.binary(2))
        tree = self.binary(level + 1)
        while sign := self.accept(*self.LEVELS[level]):
            tree = (sign, tree, self.binary(level + 1))
        return tree

    def filtered(self) -> tuple:
        tree = self.member()
        while self.accept("|"):
            name = self.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name}")
            tree = ("filter", name, tree)
        return tree

    def member(self) -> tuple:
        tree = self.atom()
        while True:
            if self.accept("."):
                tree = ("key", tree, ("const", self.name()))
            elif self.accept("["):
                tree = ("key", tree, self.choice())
                if not self.accept("]"):
                    raise TemplateError("] is missing")
            else:
                return tree

    def atom(self) -> tuple:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, value = self.tokens[self.at]
        if kind in ("number", "string"):
            self.at += 1
            return ("const", value)
        if self.accept("("):
            tree = self.choice()
            if not self.accept(")"):
                raise TemplateError(") is missing")
            return tree
        name = self.name()
        fixed = {"true": True, "false": False, "none": None}
        return ("const", fixed[name]) if name in fixed else ("name", name)


def parse(template: str) -> list[tuple]:
    """A template's statements: text, show, if, for, set, generation."""
    parts = _BLOCK.split(template)
    stack: list[tuple[str, list]] = [("", [])]
    for part in parts:
        body = stack[-1][1]
        if part.startswith("{{"):
            body.append(("show", Parser(part[2:-2]).whole()))
        elif part.startswith("{%"):
            word, _, rest = part[2:-2].strip().partition(" ")
            if word == "if":
                branches: list = [[Parser(rest).whole(), []]]
                body.append(("if", branches))
                stack.append(("if", branches[0][1]))
            elif word in ("elif", "else") and stack[-1][0] == "if":
                stack.pop()
                branches = stack[-1][1][-1][1]
                condition = Parser(rest).whole() if word == "elif" else ("const", True)
                if word == "else" and rest.strip():
                    raise TemplateError(f"unexpected {rest}")
                branches.append([condition, []])
                # Behind else, only the end of the block is left.
                stack.append(("if" if word == "elif" else "if ", branches[-1][1]))
            elif word == "for":
                name, found, over = re.match(r"(\S*)\s*(in\b)?(.*)", rest, re.S).groups()
                if not found:
                    raise TemplateError(f"unexpected {part}")
                inside = []
                body.append(("for", Parser(name).name(), Parser(over).whole(), inside))
                stack.append(("for", inside))
            elif word == "generation":
                inside = []
                body.append(("generation", inside))
                stack.append(("generation", inside))
            elif word == "set":
                name, _, value = rest.partition("=")
                body.append(("set", Parser(name).name(), Parser(value).whole()))
            elif word in ("endif", "endfor", "endgeneration") and stack[-1][0].strip() == word[3:]:
                if rest.strip():
                    raise TemplateError(f"unexpected {rest}")
                stack.pop()
            else:
                raise TemplateError(f"unexpected {part}")
        elif part:
            body.append(("text", part))
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0].strip()} is not closed")
    return stack[0][1]


def checked(run: Callable, what: str) -> Callable:
    """``run``, whose operands may not fit it."""
    def run_checked(*values):
        try:
            return run(*values)
        except TypeError as error:
            raise TemplateError(f"{what}: {error}") from None
    return run_checked


_APPLY: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b,
    ">": lambda a, b: a > b, "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b, "+": lambda a, b: a + b}
_APPLY = {sign: checked(run, sign) for sign, run in _APPLY.items()}


def fold(tree: tuple) -> tuple:
    """The tree with every part that depends on no name computed."""
    kind = tree[0]
    if kind in ("const", "name"):
        return tree
    parts = [fold(p) if isinstance(p, tuple) else p for p in tree[1:]]
    if kind in ("and", "or", "choice") and parts[0][0] == "const":
        if kind == "choice":
            return parts[1] if parts[0][1] else parts[2]
        return parts[0] if bool(parts[0][1]) == (kind == "or") else parts[1]
    folded = (kind, *parts)
    if all(p[0] == "const" for p in parts if isinstance(p, tuple)):
        return ("const", expression(folded)({}))
    return folded


def fold_body(body: list[tuple]) -> list[tuple]:
    """Statements with folded expressions, decided branches inlined and texts joined."""
    out: list[tuple] = []

    def add(statement: tuple) -> None:
        if statement[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + statement[1])
        elif statement != ("text", ""):
            out.append(statement)
    for statement in body:
        kind = statement[0]
        if kind == "show":
            tree = fold(statement[1])
            add(("text", _shown(tree[1])) if tree[0] == "const" else ("show", tree))
        elif kind == "if":
            open_branches: list = []
            for condition, inside in statement[1]:
                tree = fold(condition)
                if tree[0] == "const" and not tree[1]:
                    continue
                open_branches.append((tree, fold_body(inside)))
                if tree[0] == "const":
                    break
            if open_branches and open_branches[0][0][0] == "const":
                for inner in open_branches[0][1]:
                    add(inner)
            elif open_branches:
                add(("if", open_branches))
        elif kind == "set":
            add(("set", statement[1], fold(statement[2])))
        elif kind == "for":
            add(("for", statement[1], fold(statement[2]), fold_body(statement[3])))
        elif kind == "generation":
            add(("generation", fold_body(statement[1])))
        else:
            add(statement)
    return out


def mentions(part, name: str) -> bool:
    """Whether a tree or body asks for a name."""
    if part == ("name", name):
        return True
    return isinstance(part, (tuple, list)) and any(mentions(p, name) for p in part)


def _shown(value) -> str:
    return "" if value is None else str(value)


def expression(tree: tuple) -> Callable[[dict], object]:
    """A closure from the names' values to the expression's."""
    kind = tree[0]
    if kind == "const":
        return lambda names, value=tree[1]: value
    if kind == "name":
        return lambda names, name=tree[1]: names.get(name)
    if kind == "filter":
        run, inner = checked(FILTERS[tree[1]], tree[1]), expression(tree[2])
        return lambda names: run(inner(names))
    parts = [expression(p) for p in tree[1:]]
    if kind == "key":
        def key(names):
            value = parts[0](names)
            return value.get(parts[1](names)) if isinstance(value, dict) else None
        return key
    if kind == "not":
        return lambda names: not parts[0](names)
    if kind == "and":
        return lambda names: parts[0](names) and parts[1](names)
    if kind == "or":
        return lambda names: parts[0](names) or parts[1](names)
    if kind == "choice":
        return lambda names: parts[1](names) if parts[0](names) else parts[2](names)
    apply = _APPLY[kind]
    return lambda names: apply(parts[0](names), parts[1](names))


class Output:
    """Text that grows, and the spans of it that are generated."""

    def __init__(self):
        self.parts: list[str] = []
        self.size = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def statements(body: list[tuple]) -> Callable[[dict, Output], None]:
    steps: list[Callable] = []
    for statement in body:
        kind = statement[0]
        if kind == "text":
            steps.append(lambda names, out, text=statement[1]: out.write(text))
        elif kind == "show":
            steps.append(lambda names, out, value=expression(statement[1]):
                         out.write(_shown(value(names))))
        elif kind == "set":
            def put(names, out, name=statement[1], value=expression(statement[2])):
                names[name] = value(names)
            steps.append(put)
        elif kind == "for":
            def rounds(names, out, name=statement[1], over=expression(statement[2]),
                       inside=statements(statement[3])):
                values = over(names)
                if not isinstance(values, (list, tuple, type(None))):
                    raise TemplateError(f"for: {type(values).__name__} is no list")
                values = values or ()
                for i, value in enumerate(values):
                    loop = loop_of(i, i == len(values) - 1, values[i - 1] if i else None,
                                   values[i + 1] if i + 1 < len(values) else None)
                    # What a round sets, it sets for itself.
                    inside({**names, name: value, "loop": loop}, out)
            steps.append(rounds)
        elif kind == "generation":
            def generate(names, out, inside=statements(statement[1])):
                start = out.size
                inside(names, out)
                out.spans.append((start, out.size))
            steps.append(generate)
        else:
            branches = [(expression(c), statements(b)) for c, b in statement[1]]

            def decide(names, out, branches=branches):
                for condition, inside in branches:
                    if condition(names):
                        inside(names, out)
                        return
            steps.append(decide)

    def run(names: dict, out: Output) -> None:
        for step in steps:
            step(names, out)
    return run


def loop_of(index: int, last: bool, before, after) -> dict:
    return {"index": index + 1, "index0": index, "first": index == 0, "last": last,
            "previtem": before, "nextitem": after}


def compile_template(template: str) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """Template to a function from names to the rendered text and its generated spans.

    Of a template with the loop over ``messages``, the function renders the round of one ``message``,
    given its ``index``, ``last`` and the ``previous`` and ``next`` message.
    """
    body = fold_body(parse(template))
    loops = [i for i, s in enumerate(body) if s[0] == "for" and s[2] == ("name", MESSAGES)]
    at = loops[0] if loops else len(body)
    others = [*body[:at], *body[at + 1:], *(body[at][3] if loops else [])]
    if mentions(others, MESSAGES):
        raise TemplateError(f"{MESSAGES} may only be looped over, once and at the top level")
    if not loops:
        run = statements(body)

        def render(names: dict) -> tuple[str, list[tuple[int, int]]]:
            out = Output()
            run(dict(names), out)
            return "".join(out.parts), out.spans
        return render

    before, inside, after = (statements(part) for part in (body[:at], body[at][3], body[at + 1:]))

    def render_round(names: dict) -> tuple[str, list[tuple[int, int]]]:
        index, last, out, outer = names.get("index", 0), bool(names.get("last")), Output(), {}
        # The first round's text holds what stands before the loop; others need what is set there.
        before(outer, out if index == 0 else Output())
        loop = loop_of(index, last, names.get("previous"), names.get("next"))
        inside({**outer, body[at][1]: names.get("message"), "loop": loop}, out)
        if last:
            after(outer, out)
        return "".join(out.parts), out.spans
    return render_round


def format_turns(conversations: DataFrame, template: str = DEFAULT, conv_id: str = "conv_id",
                 turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, part, formatted, spans``: the parts of each conversation from 0, a row per turn.

    Turns are ordered by number (null first), role and text; turns of one number are all kept. A null
    role or text is empty. A null ``conv_id`` is one conversation. ``spans`` are the generated parts
    of the row's text in characters. Very long texts are rendered whole, in one row each; rows that
    repeat each other are turns of their own. An empty table gives no rows. Other columns are not read.
    """
    rows = conversations.select(
        conversations[conv_id].cast("long").alias("conv_id"),
        conversations[turn].cast("long").alias("turn"),
        F.coalesce(conversations[role], F.lit("")).alias("role"),
        F.coalesce(conversations[text], F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("part"),
                       F.lag("role").over(order).alias("before"),
                       F.lead("role").over(order).alias("after"), "role", "text")
    compile_template(template)  # a bad template fails here, not in the tasks

    def run(batches) -> Iterator:
        import pyarrow as pa
        render = compile_template(template)

        def neighbour(role):
            return None if role is None else {"role": role}
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            texts, spans = [], []
            for part, before, after, who, what in zip(
                    *(batch.column(i).to_pylist() for i in range(1, 6)), strict=True):
                rendered, found = render({
                    "message": {"role": who, "text": what}, "index": part, "first": part == 0,
                    "last": after is None, "previous": neighbour(before), "next": neighbour(after)})
                texts.append(rendered)
                spans.append([{"start": a, "end": b} for a, b in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array(spans, kind)], names=["conv_id", "part", "formatted", "spans"])

    return rows.mapInArrow(run, "conv_id long, part long, formatted string, "
                                "spans array<struct<start: int, end: int>>")


def conversation_digests(parts: DataFrame) -> DataFrame:
    """What ``DEFAULT`` wrote, parsed back: ``conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars`` per conversation.

    Hashes run over the ordered parts, which stream through a task one after another.
    """
    def run(batches) -> Iterator:
        import hashlib

        import pyarrow as pa
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                 "formatted_chars"]
        current, state = None, None

        def closed(conv, turns, everything, chars, loss, size):
            return conv, turns, everything.hexdigest(), chars, loss.hexdigest(), size

        def batch_of(rows):
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=names)

        for batch in batches:
            done = []
            for conv, part, text, spans in zip(*(batch.column(i).to_pylist() for i in range(4)),
                                               strict=True):
                if state is None or part == 0:
                    if state is not None:
                        done.append(closed(current, *state))
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for found in _TURN.finditer(text):
                    state[0] += 1
                    state[1].update(f"{unescape(found[1])}\n{unescape(found[2])}\n".encode())
                for span in spans:
                    learnt = unescape(text[span["start"]:span["end"]])
                    state[2] += len(learnt)
                    state[3].update(learnt.encode())
                state[4] += len(text)
            if done:
                yield batch_of(done)
        if state is not None:
            yield batch_of([closed(current, *state)])

    ordered = (parts.select("conv_id", "part", "formatted", "spans").repartition("conv_id")
               .sortWithinPartitions("conv_id", "part"))
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, "
                                   "loss_chars long, loss_sha256 string, formatted_chars long")
