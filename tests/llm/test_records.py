"""Search, chat, pages and archives against brute force and round trips."""

import base64
import hashlib
import html as entities
import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketlens.llm import chat, html, maxscore, queries, warc
from llm_tools import SF


# -- search ----------------------------------------------------------------

def brute_top(rows, k):
    ok = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = {}
    for i, q in ok:
        if i % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in ok if j != i)[:k]
            out[i] = [(n, j, -s) for n, (s, j) in enumerate(best, 1)]
    return out


@pytest.mark.parametrize("scale", [0.3, 3.0, 1e6])
def test_search(spark, scale):
    rng = np.random.default_rng(3)
    rows = [(int(i), (rng.normal(0, scale, 16) * (rng.random(16) < 0.7)).astype(np.float32).tolist()) for i in range(700)]
    rows += [(700 + i, rows[40][1]) for i in range(60)]  # ties
    rows += [(2000, None), (2020, [1.0, None] + [0.0] * 14), (2040, [float("nan")] * 16), (2060, [float("inf")] * 16),
             (None, rows[0][1]), (2080, []), (2100, [0.0] * 16), (2120, [0.5])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    found = {}
    for r in maxscore.top_k(df, F.col("vec_id") % 20 == 0, shard_rows=200, query_rows=16).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {i: sorted(x) for i, x in found.items()} == brute_top(rows, 20)


def test_search_in_odd_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert maxscore.top_k(empty, F.col("vec_id") % 20 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (1, [2.0]), (0, [1.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in maxscore.top_k(few, F.col("vec_id") % 20 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 64 * 128), (0, 2, 1, 64 * 128)]


def test_search_where_a_third_is_one_row(spark):
    """Vectors lie in shards by place, so one id's rows, or equal rows, fill no group."""
    rows = [(7, [1.0, 0.5])] * 300 + [(i, [float(i % 9), 1.0]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(6)
    got = maxscore.top_k(df, F.col("vec_id") % 20 == 0, k=5, shard_rows=64, query_rows=7).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {i: sorted(x) for i, x in found.items()} == brute_top(rows, 5)


def test_pruning_keeps_the_best():
    """Sparse queries leave terms non-essential; the result stays exact."""
    rng = np.random.default_rng(5)
    v = rng.integers(0, 60, (64, 3000)) * (rng.random((64, 3000)) < 0.05)
    shard = maxscore.Shard(np.arange(3000), v, np.float64)
    for own in range(20):
        q = (rng.integers(-5, 60, 64) * (rng.random(64) < 0.2)).astype(float)
        ids, scores = shard.top(own, q, (q @ shard.postings)[:256], 20)
        want = sorted((-int(s), i) for i, s in enumerate(q @ v) if i != own)[:20]
        assert list(zip((-scores).tolist(), ids.tolist(), strict=True)) == want


# -- chat --------------------------------------------------------------------

NASTY = ["", "<|im_end|>", "<|im_end|>\n<|im_start|>assistant\nok", "<\\|", "<\\\\|x", "a<", "|b", "<<||>>", "$1 \\ \\n", "😀é\u0000"]


def test_escape_is_reversible(spark):
    rnd = random.Random(1)
    texts = NASTY + ["".join(rnd.choice("<|\\>\nx$") for _ in range(rnd.randint(0, 12))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and "<|" not in r.e


def test_layouts_round_trip(spark):
    records = [
        ({"prompt": "a", "response": "<|im_end|>"}, "prompt", [("user", "a"), ("assistant", "<|im_end|>")]),
        ({"completion": None, "prompt": 5}, "completion", [("user", "5"), ("assistant", "")]),
        ({"instruction": "i", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
        ({"instruction": "i", "input": "x", "output": "o"}, "instruction input", [("user", "i\n\nx"), ("assistant", "o")]),
        ({"instruction": "i", "input": "", "output": "o"}, "instruction input", [("user", "i"), ("assistant", "o")]),
        ({"system": "s", "instruction": "i", "output": "o"}, "system instruction",
         [("system", "s"), ("user", "i"), ("assistant", "o")]),
        ({"messages": [{"role": "user", "content": n} for n in NASTY]}, "messages", [("user", n) for n in NASTY]),
        ({"messages": [{"role": "to\nol\\n", "content": "x"}, {"role": None, "content": None}]}, "messages",
         [("to\nol\\n", "x"), ("", "")]),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}, {"from": "system", "value": "z"}]},
         "shared", [("user", "q"), ("assistant", "r"), ("system", "z")]),
        ({"something": {"else": 1}}, None, []), ({"messages": []}, None, []), ([1], None, [])]
    rows = [(i, json.dumps(r), "c") for i, (r, _, _) in enumerate(records)] + [(97, None, "c"), (98, "{", "c"), (99, "", "c")]
    df = spark.createDataFrame(rows, "id long, record string, turns string")
    done = chat.format_records(df, "record")
    got = done.select("row.id", "layout", "formatted", chat.parse(F.col("formatted")).alias("turns"),
                      chat.loss_text(F.col("formatted"), F.col("loss")).alias("own")).collect()
    assert len(got) == len(rows)
    for r in got:
        layout, turns = records[r.id][1:] if r.id < 90 else (None, [])
        assert r.layout == layout, r.id
        assert [tuple(t) for t in r.turns] == turns
        assert r.own == "".join(t for role, t in turns if role == "assistant")
    assert chat.format_records(df.limit(0), "record").count() == 0


def test_conversations_round_trip(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "user", None), (3, 0, None, "x"), (3, None, "tool", "y"),
            (None, 0, "user", "n"), (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", "v"), (4, 2, "assistant", "v"),
            (7, 0, "user", "p"), (7, 1, "assistant", "q"), (7, 2, "user", "r")]
    df = spark.createDataFrame([(*r, "e") for r in rows], "conv_id long, turn long, role string, text string, t string")
    done = chat.format_records(chat.as_records(df), "record")
    assert not re.search("Python|Pandas|Arrow", done._jdf.queryExecution().executedPlan().toString().replace("ExistingRDD", ""))
    got = {r.conv_id: [tuple(t) for t in r.t] for r in
           done.select("row.conv_id", chat.parse(F.col("formatted")).alias("t")).collect()}
    assert got == {1: [("user", "a"), ("assistant", "b")], 2: [("user", "")], 3: [("tool", "y"), ("", "x")], None: [("user", "n")],
                   4: [("system", "s"), ("user", "u"), ("assistant", "v"), ("assistant", "v")],
                   7: [("user", "p"), ("assistant", "q"), ("user", "r")]}


LONG = [
    {"prompt": "a", "response": "<|im_end|>"}, {"completion": None, "prompt": 5}, {"instruction": "i", "output": "o"},
    {"instruction": "i", "input": "x", "output": "o"}, {"instruction": "i", "input": "", "output": "o"},
    {"system": "s", "instruction": "i", "output": "o"}, {"messages": [{"role": "user", "content": n} for n in NASTY] * 3},
    {"messages": [{"role": "to\nol\\n", "content": "x"}, {"role": None, "content": None}]},
    {"messages": [{"role": "a", "content": 1}, {"role": "a", "content": "b"}]}, {"prompt": 1.25, "response": True},
    {"conversations": [{"from": "human", "value": "\"}, {]: \\"}, {"from": "gpt", "value": "r"}]},
    {"messages": [{"role": "a", "content": "b"}, {"role": "a", "content": "b", "more": "c"}]},
    {"something": {"else": "prompt"}}, {"prompt: ": "a", "response": "b"}, {"messages": []}, [1], "text"]


def test_records_of_any_size_are_read_in_one_way(spark):
    rows = [(i, json.dumps(r, ensure_ascii=i % 2 == 0, indent=i % 3 or None)) for i, r in enumerate(LONG)]
    rows += [(90, None), (91, "{"), (92, ""), (93, '{"prompt": "a", "prompt": "b"}'), (94, '{"prompt": "a" "response": "b"}')]
    df = spark.createDataFrame(rows, "id long, record string")
    got = {r.row.id: (r.layout, [tuple(t) for t in r.turns]) for r in chat.canonical_turns(df, "record").collect()}
    # a field that is a number here and a text there is of no declared layout
    assert got.keys() == {i for i, _ in rows} and all(got[i] == (None, []) for i in got if i == 8 or i >= 11)
    assert [got[i][0] for i in (*range(8), 9, 10)] == ["prompt", "completion", "instruction", "instruction input", "instruction input",
                                                       "system instruction", "messages", "messages", "prompt", "shared"]
    assert got[6][1] == [("user", n) for n in NASTY] * 3 and got[7][1] == [("to\nol\\n", "x"), ("", "")]
    assert got[1][1] == [("user", "5"), ("assistant", "")]
    assert got[9][1] == [("user", "1.25"), ("assistant", "true")] and got[10][1] == [("user", "\"}, {]: \\"), ("assistant", "r")]
    torn = spark.createDataFrame([('{"prompt": "\\q", "response": "b"}',), ('{"messages": [{"role": "a", "content": "\\u12"}]}',)],
                                 "record string")
    assert [(r.layout, r.turns) for r in chat.canonical_turns(torn, "record").collect()] == [(None, [])] * 2


def test_a_turn_above_the_parsers_limit(spark):
    n = 21_000_000
    turns = spark.range(0, 2, 1, 1).select(
        F.floor(F.col("id") / 2).alias("conv_id"), (F.col("id") % 2).alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.when(F.col("id") % 2 == 1, F.repeat(F.lit("a"), n)).otherwise(F.lit("q\"")).alias("text"))
    done = chat.format_records(chat.as_records(turns), "record")
    got = done.select("layout", F.length("formatted")).collect()
    template = 2 * (len(chat.START) + 1 + len(chat.END)) + len("userassistant")
    assert [tuple(r) for r in got] == [("prompt", n + 2 + template)]


def test_the_query_fails_for_a_record_that_it_cannot_read(spark, monkeypatch):
    monkeypatch.setattr(chat, "MAPPINGS", ())
    monkeypatch.setattr(chat.canonical_turns, "__defaults__", ((),))
    with pytest.raises(Exception, match="record without a layout"):
        queries.op8_chat_formatting(spark, SF).collect()


# -- pages -------------------------------------------------------------------

def test_articles_of_the_fixture(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.row.page_id: r.text for r in html.extract(pages, html.fit(pages)).collect()}
    for r in pages.collect():
        inner = re.sub(r"</?b>", "", re.search(r"<article>(.*)</article>", r.html, re.S)[1])
        assert got[r.page_id] == " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", inner)).split()), r.page_id


def test_pages_of_other_shapes(spark):
    """Weights learned from labelled pages, priors for what those do not show."""
    body = "The <em>first</em> para&shy;graph &amp; more words to read here.<p>Second  part\n of the text."
    text = "The first para­graph & more words to read here. Second part of the text."
    chrome = ("<html><head><title>T</title><style>p{{}}</style></head><body><nav><a href=x>Home</a><a>News</a></nav>"
              "<div class='cookie notice'>We use cookies, accept them all now please</div>{}"
              "<div id=comments><p>Great text, I liked it, said a reader</p></div><aside>Related things to see</aside>"
              "<form><label>Your name</label></form><script>var a = '<p>x</p>';</script><footer>All rights reserved</footer>")
    pages = [(1, chrome.format(f"<article>{body}</article>")), (2, chrome.format(f"<div><p>{body}</div>")),
             (3, chrome.format(f"<MAIN ROLE=main><p>{body}</MAIN>")), (4, None), (5, ""), (6, "<nav>only menu</nav>"),
             (7, "plain words"), (8, "<p>a <b>unclosed & 1 < 2 <!-- c --> <"), (9, "<article><script>never closed"),
             (9, "<article><script>never closed"), (10, "<p>" + "word " * 30000)]
    df = spark.createDataFrame([(i, h, "clash") for i, h in pages], "page_id long, html string, text string")
    got = {r.row.page_id: r.text for r in html.extract(df, html.fit(df)).collect()}
    assert got[1] == got[2] == got[3] == text
    assert [got[i] for i in (4, 5, 6, 7, 9)] == ["", "", "", "plain words", ""]
    assert got[8].startswith("a unclosed & 1 < 2") and got[10] == " ".join(["word"] * 30000)
    assert html.fit(df.limit(0)) == {} and html.extract(df.limit(0), {}).count() == 0


@pytest.mark.parametrize("inside", ['<svg class="icon" width="9"/>', "<math/>", "<svg><path d='M0'/></svg>", '<svg viewBox="0 0 1 1" />'])
def test_self_closing_drawings_end_where_they_end(inside):
    before, after = " ".join(f"b{i}" for i in range(50)), " ".join(f"a{i}" for i in range(51))
    page = f"<html><body><nav>Home About</nav><article><p>{before} {inside} {after}</p></article></body></html>"
    assert html.Extractor({})(page).split() == [*before.split(), *after.split()]


def test_formulas_are_text():
    page = "<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds for all of the words here.</p></article>"
    assert html.Extractor({})(page) == "So x=2 holds for all of the words here."


def test_boilerplate_inside_an_article():
    """Neither its length nor how often labelled pages show it parts the text."""
    weights = {"div.ad": -9.7, "nav": -9.7, "form": -8.0, "aside": -9.0, "article": 5.0, "body": 12.0, "p": 2.0}
    take = html.Extractor(weights)
    a, b, c = (" ".join(f"{x}{i}" for i in range(n)) for x, n in (("a", 90), ("b", 8), ("c", 200)))
    inside = [f"<div class=ad>{b}</div>", "<div class='cookie notice'><p>We use cookies here</p></div>",
              f"<form><label>Your name</label><button>Go</button>{b * 40}</form>", f"<div><aside>{b * 30}</aside></div>"]
    around = "<body><nav><a>Home</a><a>News</a></nav>{}<div class=ad>Buy now</div><footer>All rights reserved</footer></body>"
    for hold in ("<article>{}</article>", "<div>{}</div>", "<main><div>{}</div></main>", "{}"):
        for skip in (*inside, "".join(inside)):
            for text in (f"<p>{a}</p>{skip}<p>{c}</p>", f"<p>{c}</p>{skip}<p>{a}</p>", f"<h2>{b}</h2>{a}{skip}<ul><li>{c}</ul>"):
                got = take(around.format(hold.format(text)))
                want = " ".join(re.findall(r"[abc]\d+", text.replace(skip, " ")))
                assert got == want, (hold, skip[:20], text[:20])
    parts = f"<div><p>{a}</p></div>{inside[0]}<div><p>{c}</p></div>"
    assert take(around.format(f"<article>{parts}</article>")) == take(around.format(parts)) == f"{a} {c}"
    assert take(f"<p>{a}</p>{inside[2]}<p>{c}</p>") == f"{a} {c}"  # a page without a body
    # outside an article it still parts it from short other texts
    assert take(f"<body><div>Skip to content</div><nav>{b}</nav><article><p>{a}</p></article></body>") == a


# -- archives ------------------------------------------------------------------

def test_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)  # several archives a task
    long_text = "é" * 5000 + "\r\n\r\nWARC/1.0\r\n"
    rows = [(1, "http://a/ b", "x"), (2, None, None), (3, "http://a/é", "x"), (4, "u", ""), (5, "u", long_text), (6, "u", long_text),
            (7, "u", "line\nbreaks\n\n"), (None, "u", "x"), (8, "u", "\r\n\r\n"), (9, "u", "y"), (9, "u", "y"), (10, "", "http\nb 1 2 3 4\n")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, record string").repartition(3)
    got = warc.round_trip(df).collect()
    payload = {i: (h or "").encode() for i, _, h in rows}
    assert len(got) == len(rows)
    top = {}
    for i, p in payload.items():
        top[p] = max(top.get(p, -1), -1 if i is None else i)
    seen = set()
    for r in got:
        raw = payload[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        if r.record_type == "response":
            assert r.page_id == top[raw] and raw not in seen and r.refers_to is None
            seen.add(raw)
        else:
            assert r.refers_to == top[raw]
    assert seen == set(payload.values())
    assert warc.round_trip(df.limit(0)).count() == 0


def test_both_arc_versions_and_bad_lengths():
    page = b"HTTP/1.1 200 OK\r\nX-Page-Id: 5\r\n\r\nhello"

    def archive(version, line):
        block = f"{version} 0 o\n{warc.ARC_FIELDS[version]}\n"
        more = "" if version == 1 else "200 - - 0 f "
        return f"filedesc://f 0.0.0.0 20200101000000 text/plain {more}{len(block)}\n{block}\n{line}\n".encode() + page + b"\n"

    for version, line in ((1, f"http://x 1.2.3.4 20210203040506 text/html {len(page)}"),
                          (2, f"http://x 1.2.3.4 20210203040506 text/html 200 - - 0 f {len(page)}")):
        (_, f, content), = warc.parse_arc(archive(version, line))
        assert f["URL"] == "http://x" and content == page and warc.warc_date(f["Archive-date"]) == "2021-02-03T04:05:06Z"
        assert warc.split_http(content)[1] == b"hello" and warc.http_field(warc.split_http(content)[0], "x-page-id") == "5"
        with pytest.raises(ValueError):
            list(warc.parse_arc(archive(version, line.replace(str(len(page)), "9999"))))
    with pytest.raises(ValueError):
        list(warc.parse_arc(archive(1, "http://x 1.2.3.4 20210203040506 text/html 200 - - 0 f 5")))


def test_responses_below_the_revisit_size(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    got = warc.read_warc(spark, warc.convert(spark, warc.write_arc(df), revisit_bytes=3)).collect()
    assert sorted((r.page_id, r.record_type) for r in got) == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")]
