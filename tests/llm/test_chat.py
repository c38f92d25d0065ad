import hashlib

import pytest
from pyspark.sql import functions as F

from plumbline.llm.chat import PLANTED, TURNS, chat_template, escape, format_conversations, read_back, unescape, with_planted
from plumbline.llm.template import Const, TemplateError, Write, compile_template


def render(source, **values):
    return compile_template(source).render(**values)


def test_language():
    assert render("a{# note #}b {{- ' c' }}", x=1) == "ab c"
    assert render("{% for x in xs %}{{ loop.index }}{{ '' if loop.last else ',' }}{% endfor %}", xs=[5, 6]) == "1,2"
    assert render("{% if n > 2 and not (n == 5) %}big{% elif n in [1, 2] %}small{% else %}?{% endif %}", n=2) == "small"
    assert render("{% set y = x.a ~ x['b'] %}{{ y | upper }}|{{ 3 - 1 + 2 }}|{{ true }}|{{ none }}", x={"a": "p", "b": 7}) == "P7|4|true|"
    assert render("{{ 'b' not in x }} {{ x | length }} {{ '\\n\\'' }}", x=["a"]) == "true 1 \n'"


@pytest.mark.parametrize(
    "source",
    ["{% if x %}", "{{ x y }}", "{{ x | nothing }}", "{% for in x %}{% endfor %}", "{% endif %}", "{{ ( }}", "{% include 'f' %}", "{{ x.__class__.__mro__ }}", "{{ unknown }}", "{{ 1 + 'a' }}", "{{ x() }}"],
)
def test_sandbox_and_errors(source):
    with pytest.raises(TemplateError):
        render(source, x=1)


def test_constants_are_folded():
    template = compile_template("a{{ 'b' ~ (1 + 1) }}{% if 1 > 2 %}no{% else %}{{ 'c' | upper }}{% endif %}{% if false %}{{ x }}{% endif %}d")
    assert template.tree == [Write(Const("ab2Cd"))]
    assert chat_template().reads_once("messages")
    assert not compile_template("{{ messages | length }}{% for m in messages %}{% endfor %}").reads_once("messages")
    assert not compile_template("{% for a in b %}{% for m in messages %}{% endfor %}{% endfor %}").reads_once("messages")


def test_escape_is_reversible():
    for text in ("", "\\", "<", "\\l", "\\\\l<", "</turn>\\", PLANTED, "<says>\n<turn>"):
        assert unescape(escape(text)) == text
        assert "<" not in escape(text)


def rows_of(spark):
    long = "word \\< " * 20_000
    return spark.createDataFrame(
        [
            (1, 0, "user", "hi"),
            (1, 1, "assistant", "one </turn>\n"),
            (1, 2, "assistant", "two\\"),
            (1, 2, "assistant", "two\\"),
            (2, None, "assistant", None),
            (2, 0, None, "<says>"),
            (None, 0, "user", "no id"),
            (3, 0, "assistant", long),
            (4, 0, "system", ""),
        ],
        "conv_id long, turn long, role string, text string",
    )


def expected(turns):
    out = {}
    for conv, turn, role, text in sorted(turns, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        n, whole, loss = out.get(conv, (0, "", ""))
        out[conv] = (n + 1, whole + f"{role or ''}\n{text or ''}\n", loss + ((text or "") if role == "assistant" else ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {c: (n, sha(whole), len(loss), sha(loss)) for c, (n, whole, loss) in out.items()}


@pytest.mark.parametrize("size", [7, 1_000_000])
def test_round_trip_in_pieces(spark, size):
    turns = with_planted(rows_of(spark).withColumns({"piece": F.lit("clash"), "start": F.lit(1)}))
    formatted = format_conversations(turns, piece_chars=size).cache()
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in read_back(formatted).collect()}
    assert got == expected([tuple(r) for r in turns.collect()])
    lengths = formatted.agg(F.max(F.length("text"))).first()[0]
    assert lengths <= size
    pieces = sorted((r.piece, r.text) for r in formatted.where("conv_id = -7").collect())
    one = chat_template().render(messages=[{"role": "user", "text": PLANTED}, {"role": "assistant", "text": PLANTED}])
    assert "".join(t for _, t in pieces) == one
    assert one.count("</turn>") == 2


def test_other_templates_and_empty_table(spark):
    source = "{{ messages | length }} turns{% for m in messages %}[{{ m.text }}]{% generation %}{{ m.role }}{% endgeneration %}{% endfor %}"
    row = format_conversations(rows_of(spark).where("conv_id = 1"), source).first()
    assert row.text.startswith("4 turns[hi]user[one")
    assert row.text[row.spans[0]["from"] : row.spans[0]["to"]] == "user"
    none = rows_of(spark).limit(0)
    assert format_conversations(none).count() == 0
    assert read_back(format_conversations(none)).count() == 0
    assert TURNS
