import hashlib
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tests.conftest import SF_SMALL
from tidemark.llm import chat_template as ct
from tidemark.llm.queries import CONTROL_TALK, LLM_QUERIES


def brute(rows):
    """Digest rows from (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append(((turn is not None, turn or 0, role or "", text or ""), role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort(key=lambda t: t[0])
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[c] = (c, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def check(df, rows):
    want = brute(rows)
    got = df.collect()
    assert {r["conv_id"]: tuple(r)[:5] for r in got} == want and len(got) == len(want)
    for r in got:
        turns = sorted(((t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == r["conv_id"]))
        text, _ = ct.Template(ct.TEMPLATE).render(messages=[{"role": a, "text": b} for _, a, b in turns])
        assert r["formatted_chars"] == len(text)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", CONTROL_TALK), (-1, 1, "assistant", CONTROL_TALK)]
    check(LLM_QUERIES["op3_chat_template"](spark, SF_SMALL), rows)


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 2, None, "x"), (2, 0, "to]ol\n", "a\n[ROLE]b"), (2, 0, "assistant", "[/INST"),
            (None, 1, "user", "hi"), (None, None, "assistant", " </s> "), (3, 5, "system", "<\\s>"), (3, 5, "system", "<\\s>"),
            (4, 0, "assistant", "long " * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    check(ct.read_back(ct.format_conversations(df.selectExpr("*", "turn as part", "text as formatted"))), rows)
    assert ct.read_back(ct.format_conversations(df.limit(0))).collect() == []


def test_one_conversation_with_many_turns_streams(spark):
    rows = [(9, i, "user" if i % 2 else "assistant", f"turn {i} [INST]") for i in range(3000)] + [(10, 0, "user", "x")]
    check(ct.read_back(ct.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))), rows)


@given(st.text(alphabet=st.sampled_from("<>[]/\\sINSTROLEU x")))
def test_escape_is_reversible_and_hides_controls(text):
    hidden = ct.escape(text)
    assert ct.unescape(hidden) == text and not any(c in hidden for c in ct.CONTROLS)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "[/ROLE]"]),
                          st.text(alphabet=st.sampled_from("<>[]/\\sINST \n")))))
def test_turns_read_back(turns):
    t = ct.Template(ct.TEMPLATE)
    parts, now = [], []
    for p in t.stream(messages=[{"role": r, "text": x} for r, x in turns]):
        if p is None:
            parts.append("".join(now))
            now = []
        else:
            now.append(p[0])
    assert [ct.read_turn(p) for p in parts] == [(r, x) for r, x in turns]


def render(src, **kw):
    return ct.Template(src).render(**kw)[0]


def test_language():
    assert render("a{{ 1 + 2 * 3 }}b") == "a7b"
    assert render("{% for x in xs %}{{ loop.index }}{{ x }}{% if not loop.last %},{% endif %}{% endfor %}", xs=["p", "q"]) == "1p,2q"
    assert render("{% if a and b %}y{% elif a %}n{% else %}e{% endif %}", a=1, b=0) == "n"
    assert render("{{ m['k'] | upper ~ '!' }}{# note #}", m={"k": "v"}) == "V!"
    assert render("  {%- if 'x' in ['x'] -%}  ok  {%- endif -%}  ") == "ok"
    assert render("{% set a = 'q' %}{{ a | replace('q', 'r') }}") == "r"
    assert ct.Template("x{% generation %}yz{% endgeneration %}w").render() == ("xyzw", [(1, 3)])


def test_constants_are_folded():
    assert ct.Template("a{{ 'b' ~ 1 }}{% if 1 > 2 %}no{% endif %}{{ 'c' | upper }}").tree == [ct.Put(ct.Const("ab1C"))]
    assert len(ct.Template("{% if 2 > 1 %}{{ x }}{% else %}{{ y }}{% endif %}").tree) == 1


def test_sandbox():
    class Thing:
        secret = 1

    assert render("{{ t.secret }}", t=Thing()) == ""
    assert render("{{ s.upper }}", s="text") == ""
    for bad in ["{{ __import__ }}", "{{ x._y }}", "{{ f() }}", "{{ x | nothing }}", "{% if a %}", "{% endfor %}", "{% import os %}", "{{ 'a }}"]:
        with pytest.raises(ct.TemplateError):
            ct.Template(bad)
