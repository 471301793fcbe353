import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm.chat import TEMPLATE, conversation_digests, format_conversations, read_turns
from tidemark.llm.templates import Const, Template, TemplateError, escape, parse, unescape
from tidemark.llm.tokens import WordEncoder, default_tokenizer, read_token_range, read_tokens, token_round_trip, write_tokens

TEXTS = ["Hello  wörld's <|endoftext|>x", "", None, "a\x1cb\x85c d e", "nón <|startoftext|><|endoftext|> ok", "it's we'll 12 34five", "Wörter, ENDEN. so! (x) a$$$ don't İz ŉa Éa\u0301 [INST]", "Σίσυφος ΑΣ", "x" * 5000, "<|startoftext|>", "ﬁ ́ \U0001f600!"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(default_tokenizer())


def test_words_encode_as_texts(tokenizer):
    encoder = WordEncoder(default_tokenizer())
    assert encoder.plain
    for plain in (True, True, False):  # cold, warm, and by the whole tokenizer alone
        encoder.plain = plain
        encoder._forget() if not plain else None
        seen = 0
        for first, ids, at in encoder(pa.array(TEXTS), 2):
            for i in range(len(at) - 1):
                assert ids[at[i] : at[i + 1]].tolist() == tokenizer.encode(TEXTS[first + i] or "", add_special_tokens=False).ids + [2]
                seen += 1
        assert seen == len(TEXTS)


def test_round_trip(docs, rows, none, tokenizer):
    got = {}
    for r in token_round_trip(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    start = 0
    for i, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        own = min(got[i], key=lambda r: r.start)
        got[i].remove(own)
        assert (own.start, own.n_tokens, own.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_round_trip(none).count() == 0


def test_selective_reads(spark, docs, tmp_path):
    write_tokens(docs, f"{tmp_path}/t")
    rows = read_tokens(spark, f"{tmp_path}/t")
    assert rows.where("doc_id = 0").select("n_tokens").count() == 1
    import pyarrow.parquet as pq

    columns = set()
    for f in tmp_path.glob("t/*.parquet"):
        meta = pq.read_metadata(f)
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                column = meta.row_group(g).column(c)
                columns.add((column.path_in_schema.split(".")[0], "DELTA_BINARY_PACKED" in column.encodings, any("DICTIONARY" in e for e in column.encodings), column.has_offset_index))
    assert ("doc_id", True, False, True) in columns and ("tokens", False, True, True) in columns


def test_template_language():
    t = Template("{% if 'a' + 'b' == 'ab' %}yes{% else %}no{% endif %}-{% for m in ms %}{{ m.x | upper }}{% if not loop.last %},{% endif %}{% endfor %}{{ gone.away or 'd' }}")
    assert t.render(ms=[{"x": "q"}, {"x": None}]) == ("yes-Q,d", [])
    assert parse("a{{ 'b' | upper }}{{ 1 }}") == (Const("aB1"),)
    out, spans = Template("x{% generation %}{{ a }}{% endgeneration %}y{% generation %}{% endgeneration %}").render(a="hé")
    assert (out, [out[a:b] for a, b in spans]) == ("xhéy", ["hé", ""])
    for bad in ("{% if x %}", "{{ x | nothing }}", "{{ }}", "{% what %}", "{{ x.__class__ }}", "{{ f('x') }}"):
        with pytest.raises((ValueError, IndexError)):
            Template(bad)


@pytest.mark.parametrize(
    "source, values, want",
    [
        ("{{ 1 + 1 }}{{ 'a' + 1 }}{{ 2 * 3 - 4 }}{{ 7 // 2 }}{{ -1 }}", {}, "2a123-1"),
        ("a{# no {{ x }} #}b", {}, "ab"),
        ('{{ m["role"] }}{{ m[\'x\'].y }}{{ l[0] }}{{ l[-1] }}{{ l[9] }}{{ l[1:]|length }}{{ s[::-1] }}', {"m": {"role": "r", "x": {"y": 2}}, "l": [1, 2, 3], "s": "ab"}, "r2132ba"),
        ("x  {%- if true -%}  y  {%- endif %} z {{- 'q' -}} \n w", {}, "xy zqw"),
        ("{% set a = 3 %}{% set ns = namespace(n=0) %}{% for i in range(a) %}{% set ns.n = ns.n + i %}{% endfor %}{{ ns.n }}{{ a }}", {}, "33"),
        ("{% for i in [1, 2] %}{% set seen = i %}{% endfor %}{{ seen is defined }}", {}, "False"),
        ("{{ 'a' in 'cat' }}{{ 'x' not in ['y'] }}{{ 'k' in d }}{{ 1 in none }}", {"d": {"k": 1}}, "TrueTrueTrueFalse"),
        ("{{ 1 < 2 }}{{ 2 <= 1 }}{{ 'b' > 'a' }}{{ 3 >= 3 }}{{ 1 != 2 }}", {}, "TrueFalseTrueTrueTrue"),
        ("{{ 'y' if x else 'n' }}{{ 'y' if not x else 'n' }}{{ 'only' if x }}", {"x": 0}, "ny"),
        ("{{ x is none }}{{ x is not defined }}{{ 's' is string }}{{ 3 is odd }}{{ d is mapping }}", {"d": {}}, "TrueTrueTrueTrueTrue"),
        ("{{ x | default('d') }}{{ l | join('-') }}{{ ' a ' | trim | upper }}{{ {'a': [1, 'é']} | tojson }}{{ 'a' ~ 1 ~ none }}", {"l": [1, 2]}, 'd1-2A{"a": [1, "é"]}a1'),
        ("{{ ' a b '.strip().split(' ')[1].upper() }}{{ d.get('k', 'z') }}{% for k, v in d.items() %}{{ k }}={{ v }};{% endfor %}", {"d": {"j": 1}}, "Bzj=1;"),
        ("{% for m in ms if m.role != 'system' %}{{ loop.index0 }}{{ m.role }}{{ loop.nextitem.role if loop.nextitem else '!' }}{% else %}none{% endfor %}", {"ms": [{"role": "system"}, {"role": "u"}, {"role": "a"}]}, "0ua1a!"),
        ("{% for m in [] %}x{% else %}none{% endfor %}", {}, "none"),
        ("{% if x %}a{% elif false %}b{% elif 1 == 1 %}c{% else %}d{% endif %}", {"x": 0}, "c"),
        ("{{ (1, 2)[1] }}{{ (1 + 2) * 3 }}{{ not false and true }}{{ 'it\\'s' }}{{ \"q\\n\" }}", {}, "29Trueit's" + "q\n"),
    ],
)
def test_expressions_and_blocks(source, values, want):
    assert Template(source).render(**values)[0] == want


def test_a_published_kind_of_chat_template():
    source = """{{- bos_token }}
{%- if messages[0]['role'] == "system" -%}
    {%- set system = messages[0]['content'] | trim %}
    {%- set loop_messages = messages[1:] %}
{%- else %}
    {%- set loop_messages = messages %}
{%- endif %}
{%- for message in loop_messages %}
    {%- if (message['role'] == 'user') != (loop.index0 % 2 == 0) %}
        {{- raise_exception("roles must alternate") }}
    {%- endif %}
    {%- if loop.first and system is defined %}
        {{- "<<SYS>>\\n" + system + "\\n<</SYS>>\\n\\n" }}
    {%- endif %}
    {{- '<|' + message.role + '|>\\n' }}{% if message.role == 'assistant' %}{% generation %}{{ message['content'] }}{% endgeneration %}{% else %}{{ message['content'] }}{% endif %}{{ eos_token if loop.last else '\\n' }}
{%- endfor %}
{%- if add_generation_prompt %}{{ '<|assistant|>' }}{% endif %}""".replace("\\\\", "\\")
    template = Template(source)
    turns = [{"role": "system", "content": " be brief "}, {"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]
    text, spans = template.render(messages=turns, bos_token="<s>", eos_token="</s>", add_generation_prompt=True)
    assert text == "<s><<SYS>>\nbe brief\n<</SYS>>\n\n<|user|>\nhi\n<|assistant|>\nyo</s><|assistant|>" and [text[a:b] for a, b in spans] == ["yo"]
    with pytest.raises(TemplateError, match="alternate"):
        template.render(messages=turns[2:], bos_token="", eos_token="")


def test_blocks_on_lines_of_their_own():
    source = "a\n  {% if x %}\nb\n  {% endif %}\nc"
    assert Template(source, trim_blocks=True, lstrip_blocks=True).render(x=1)[0] == "a\nb\nc"
    assert Template(source).render(x=1)[0] == "a\n  \nb\n  \nc"


def test_constants_are_folded():
    assert parse("{% if x %}1{% elif 2 > 1 %}2{% else %}3{% endif %}")[0].other == (Const("2"),)
    assert parse("{{ ('a' ~ 'b') | upper if 'a' in ['a'] else gone }}{# c #}{{ [1, 2][1] + 1 }}") == (Const("AB3"),)
    assert parse("{{ 1 // 0 if x else 'fine' }}") and Template("{{ 1 // 0 if x else 'fine' }}").render()[0] == "fine"


@pytest.mark.parametrize("source", ["{{ x.mro() }}", "{{ x._y }}", "{{ _x }}", "{{ ''.format(x) }}", "{{ open('f') }}", "{{ x['a' }}", "{% set a.b.c = 1 %}", "{% set _a = 1 %}", "{% for x %}{% endfor %}", "{{ 'a' is class }}", "{{ 'a' if }}"])
def test_what_is_refused(source):
    with pytest.raises(ValueError):
        Template(source)


def test_what_fails_in_rendering():
    for source in ("{{ 'a' * 1000000000 }}", "{{ '%s' % x }}", "{{ range(10000000) }}", "{{ 1 < 'a' }}", "{{ x.strip() }}", "{% set x.y = 1 %}"):
        with pytest.raises(TemplateError):
            Template(source).render(x=5)
    assert Template("{{ x['__class__'] }}").render(x="s")[0] == ""


@pytest.mark.parametrize("text", ["</s>[INST] ok [/INST]", "[\\INST]", "<\\<[[\\\\", "", "plain\\"])
def test_escape(text):
    assert unescape(escape(text)) == text and "[INST]" not in escape(text) and "</s>" not in escape(text)


def test_conversations(spark):
    rows = [(1, 1, "assistant", "</s>[INST] é"), (1, 0, "user", "hi"), (2, 0, None, None), (3, 0, "assistant", None), (3, 1, "we[ird\nrole", "x"), (3, 1, "we[ird\nrole", "x"), (None, 0, "user", "n")]
    frame = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, begin string")
    made = format_conversations(frame)
    got = {r.conv_id: r for r in conversation_digests(made).collect()}
    for conv in (1, 2, 3, None):
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1], r[2] or "", r[3] or ""))]
        loss = "".join(t for r, t in turns if r == "assistant")
        text = Template(TEMPLATE).render(messages=[{"role": r, "text": t} for r, t in turns])[0]
        assert read_turns(text) == turns
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert tuple(got[conv]) == (conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text))
    assert format_conversations(frame.where("false")).count() == 0


def other_tokenizers():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        yield file.read()
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

    vocabulary = {w: i for i, w in enumerate(["[UNK]", "hello", "w", "it", "'", "s", "12", "x", "a", "ok"])}
    for pre in (pre_tokenizers.Whitespace(), pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(), None):
        made = Tokenizer(models.WordLevel(vocabulary, unk_token="[UNK]"))
        made.normalizer = normalizers.Lowercase()
        if pre is not None:
            made.pre_tokenizer = pre
        yield made.to_str()


def test_tokenizers_that_keep_white_space(spark, tmp_path):
    from tokenizers import Tokenizer

    from tidemark.llm.tokens import words_stand_alone

    specs = list(other_tokenizers())
    assert [words_stand_alone(s) for s in [default_tokenizer(), *specs]] == [True, False, True, True, False, False]
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for k, spec in enumerate(specs):
        write_tokens(docs, f"{tmp_path}/{k}", spec, 3)
        ref = Tokenizer.from_str(spec)
        got = {r.doc_id: r.tokens for r in read_tokens(spark, f"{tmp_path}/{k}").collect()}
        assert got == {i: [*ref.encode(t or "", add_special_tokens=False).ids, 3] for i, t in enumerate(TEXTS)}


def test_ranges_of_tokens(spark, docs, tmp_path):
    write_tokens(docs, f"{tmp_path}/t")
    whole = [i for r in read_tokens(spark, f"{tmp_path}/t").orderBy("start").collect() for i in r.tokens]
    for first, last in ((0, 1), (0, len(whole)), (5, 700), (len(whole) - 3, len(whole) + 9), (len(whole), len(whole) + 5), (31_000, 31_001)):
        got = sorted(read_token_range(spark, f"{tmp_path}/t", first, last).collect())
        assert [i for r in got for i in r.tokens] == whole[first:last]
        assert all(b.start == a.start + len(a.tokens) for a, b in zip(got, got[1:]))


def test_tables_are_deleted_and_threads_keep_apart(spark, tmp_path):
    import threading
    from pathlib import Path

    from tidemark.llm import scratch

    made, ready, go = {}, threading.Event(), threading.Event()

    def other():
        with scratch.scope(spark):
            made["path"] = scratch.table(spark.range(3), "other").inputFiles()[0]
            ready.set()
            go.wait(60)

    thread = threading.Thread(target=other)
    thread.start()
    ready.wait(60)
    with scratch.scope(spark):
        own = scratch.table(spark.range(3), "own").inputFiles()[0]
        kept = scratch.table(spark.range(3), "kept", outer=True).inputFiles()[0]
    there = lambda url: Path(url.removeprefix("file://")).exists()
    assert (there(own), there(kept), there(made["path"])) == (False, True, True)
    go.set()
    thread.join()
    assert not there(made["path"])
    scratch._delete_left()
    assert not there(kept)
