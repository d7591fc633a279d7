import hashlib
import random
from collections import defaultdict

import pytest

from tonescope.llm import chat

CONTROL = "</s>[INST] ok [/INST]"
TEXTS = [CONTROL, None, "", "two\nlines\\n", "<|turn|>user\nx<|end|>\n", "\\", "\\l[<", "日本 é", "plain",
         "x" * 40_000]


@pytest.fixture(scope="module")
def conversations(spark):
    draw = random.Random(5)
    rows = [(c, t, draw.choice(["user", "assistant", "system", None]), draw.choice(TEXTS))
            for c in range(12) for t in range(draw.randint(1, 9))]
    rows += [(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL), (None, 0, "user", "nobody"),
             (None, 1, "assistant", "here"), (3, None, "assistant", "no number"), (4, 1, "user", "twice"),
             (4, 1, "user", "twice"), (50, 0, "assi\n<stant", "odd role")]
    draw.shuffle(rows)
    full = [(*r, 7, "last", 0) for r in rows]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, part long, "
                                       "formatted string, spans int").repartition(3)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_what_was_formatted_is_read_back(conversations):
    groups = defaultdict(list)
    for r in conversations.collect():
        groups[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    want = set()
    for conv, turns in groups.items():
        turns.sort()
        learnt = "".join(t[3] for t in turns if t[2] == "assistant")
        want.add((conv, len(turns), digest("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(learnt),
                  digest(learnt)))
    parts = chat.format_turns(conversations)
    sizes = defaultdict(int)
    for r in parts.collect():
        sizes[r.conv_id] += len(r.formatted)
    got = chat.conversation_digests(parts).collect()
    assert {tuple(r)[:5] for r in got} == want and len(got) == len(want)
    assert {r.conv_id: r.formatted_chars for r in got} == sizes


def test_marks_are_never_text(conversations):
    rows = chat.format_turns(conversations).collect()
    assert sum(r.formatted.count("<|turn|>") for r in rows) == len(rows)
    assert sum(r.formatted.count("<|end|>") for r in rows) == len(rows)
    assert not any("[INST]" in r.formatted or "</s>" in r.formatted for r in rows)
    ends = {(r.conv_id) for r in rows if r.formatted.endswith("<|stop|>")}
    assert ends == {r.conv_id for r in rows}


def test_constants_are_folded():
    body = chat.parse("a{% if 1 == 1 and not false %}{{ 'b' + 'c' | upper }}{% else %}x{% endif %}"
                      "{{ 'd' if 2 > 3 else 'e' }}")
    assert chat.fold_body(body) == [("text", "abCe")]
    body = chat.fold_body(chat.parse("{% if false %}x{% elif first %}y{% else %}z{% endif %}"))
    assert [len(b) for kind, b in body if kind == "if"] == [2]


def test_template_language():
    render = chat.compile_template(
        "{% set who = message['role'] %}{% if who in 'user system' %}{{ who }}{% elif last %}end"
        "{% endif %}:{% generation %}{{ message.text | trim }}{% endgeneration %}{{ missing.key }}")
    assert render({"message": {"role": "user", "text": " hi "}}) == ("user:hi", [(5, 7)])
    assert render({"message": {"role": "tool", "text": ""}, "last": True}) == ("end:", [(4, 4)])


@pytest.mark.parametrize("template", [
    "{{ message.__class__ }}", "{{ _hidden }}", "{{ x | eval }}", "{{ f(1) }}", "{% if x %}",
    "{% generation %}{% endif %}", "{{ }}", "{{ a b }}", "{{ x[1 }}", "{% for x in y %}",
    "{{ 1 + 'a' }}", "{{ none | length }}", "{{ 1 < 'a' }}", "{{ 'a' in none }}",
    "{% if x %}{% else %}{% elif y %}{% endif %}", "{% if x %}{% else %}{% else %}{% endif %}",
    "{% for x y %}{% endfor %}", "{% for _x in y %}{% endfor %}", "{% for x in y %}{% endif %}",
    "{{ messages }}", "{% for m in messages %}{{ messages }}{% endfor %}",
    "{% if a %}{% for m in messages %}{% endfor %}{% endif %}",
    "{% for m in messages %}{% endfor %}{% for m in messages %}{% endfor %}"])
def test_sandbox(template):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(template)


def test_loops_and_strings_that_look_like_ends():
    render = chat.compile_template("{% for x in message.text | lines %}{{ loop.index }}:{{ x }}"
                                   "{% if not loop.last %}{{ ', }}' }}{% endif %}{% set y = x %}{% endfor %}{{ y }}")
    assert render({"message": {"text": "a\nb"}}) == ("1:a, }}2:b", [])
    assert chat.compile_template("{% for x in nothing %}x{% endfor %}")({}) == ("", [])
    assert chat.compile_template("{{ \"%}\" }}{% if x == '%}' %}y{% endif %}")({"x": "%}"}) == ("%}y", [])


@pytest.mark.parametrize("template,names", [
    ("{{ message.text in none }}", {"message": {"text": "a"}}), ("{{ x + 1 }}", {"x": "a"}),
    ("{{ x | length }}", {}), ("{% for c in x %}{% endfor %}", {"x": "abc"})])
def test_what_goes_wrong_on_a_row(template, names):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(template)(names)


def test_a_template_renders_a_conversation(spark):
    template = ("{% set name = 'bot' %}<{% for m in messages %}{% if m.role == loop.previtem.role %}+{% endif %}"
                "{{ loop.index0 }}{{ name if m.role == 'assistant' else m.role }}"
                "{% if loop.first %}!{% endif %}{% generation %}{{ m.text }}{% endgeneration %}"
                "{% if loop.nextitem and loop.nextitem.role == 'user' %};{% endif %}{% endfor %}{{ name }}>")
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "user", "d"), (2, 0, "user", "e")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = chat.format_turns(frame, template).orderBy("conv_id", "part").collect()
    assert [p.formatted for p in parts] == ["<0user!a;", "+1userb", "2botc;", "3userdbot>", "<0user!ebot>"]
    assert all(p.formatted[s.start:s.end] in "abcde" and s.end == s.start + 1 for p in parts for s in p.spans)


def test_an_empty_branch(spark):
    frame = spark.createDataFrame([(1, 0, "tool", "x")], "conv_id long, turn long, role string, text string")
    parts = chat.format_turns(frame, "{% if message.role == 'user' %}{{ message.text }}{% endif %}").collect()
    assert [(p.formatted, p.spans) for p in parts] == [("", [])]


def test_no_python_attribute_is_reached():
    render = chat.compile_template("{{ message.text.upper }}{{ message['__class__'] }}")
    assert render({"message": {"text": "a"}}) == ("", [])


def test_empty(conversations):
    parts = chat.format_turns(conversations.where("false"))
    assert parts.count() == 0 and chat.conversation_digests(parts).count() == 0
