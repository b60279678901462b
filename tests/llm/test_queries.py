"""Registered queries against their SQL, and the pipeline's stages against
plain Python, on the small tables."""

import hashlib
import math
import os
import sys
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from basketlens.llm import langid, lines, queries  # noqa: E402
from basketlens.llm.common import read, stage  # noqa: E402
from check_oracle import rows_of  # noqa: E402
from llm_tools import SF  # noqa: E402
from test_mixing import check_mix  # noqa: E402
from test_near_duplicates import brute, check_lines  # noqa: E402
from test_text import hits, spans  # noqa: E402

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLE_SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    want = [dict(zip(cols, r, strict=True)) for r in cur.fetchall()]
    assert rows_of([r.asDict() for r in df.collect()], sorted(cols), False) == rows_of(want, sorted(cols), False)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_personal_data_query(spark):
    texts = {r.doc_id: r.text for r in read(spark, SF, "documents").collect()}
    got = queries.QUERIES["op3_pii"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        base = spans(texts[r.doc_id])
        told = [f"{k}:{a}:{b}" for k, a, b in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in ("email", "ip", "card", "phone")]
        assert r.base_sha256 == sha(",".join(told)) and set(told) <= set(filter(None, r.spans.split(",")))
    assert any(r.n_email for r in got)


def test_decontamination_query(spark):
    docs = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    want = hits(docs, [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()])
    for r in queries.QUERIES["op7_decontamination"](spark, SF).collect():
        n, hit, items = want.pop(r.doc_id)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(items), hit > 0 and 20 * hit >= n)
        assert r.items_sha256 == sha(",".join(sorted(map(str, items))))
    assert not want


def slots(word):
    raw = b" " + word.encode() + b" "
    return [(int.from_bytes(raw[i:i + 3], "big") * 0x9E3779B1 & 0xFFFFFFFF) >> 16 for i in range(len(raw) - 2)]


def script(c):
    return [name for start, name in langid._SCRIPTS if start <= ord(c)][-1]


def test_language_query(spark):
    """Counts, scores and best paths of the whole table in plain Python."""
    docs = [(r.doc_id, r.text, r.lang) for r in read(spark, SF, "documents").collect()]
    held = {i for i, _, _ in docs if zlib.crc32(str(i).encode()) % 4 == 2}
    grams, scripts = defaultdict(Counter), defaultdict(Counter)
    for i, t, lang in docs:
        if i not in held and t is not None and lang is not None:
            grams[lang].update(x for w in t.lower().split() for x in slots(w))
            scripts[lang].update(script(c) for c in t.lower() if ord(c) >= 0xAA or "a" <= c <= "z")
    langs = sorted(grams)
    total = {x: sum(grams[x].values()) + 0.1 * 2**16 for x in langs}
    open_to = {k: [x for x in langs if scripts[x][k] >= 0.005 * max(1, scripts[x].total())] or langs for k in langid.SCRIPTS}
    known = {}

    def scored(w):
        if w not in known:
            first = next((c for c in w if c.isalpha()), None)
            known[w] = [0.0] * len(langs) if first is None else [
                sum(math.log((grams[x][k] + 0.1) / total[x]) for k in slots(w)) - 100 * (x not in open_to[script(first)]) for x in langs]
        return known[w]

    def path(rows):
        best, back = list(rows[0]), []
        for row in rows[1:]:
            top = max(range(len(langs)), key=best.__getitem__)
            back.append([k if best[k] >= best[top] - 12 else top for k in range(len(langs))])
            best = [best[j] - 12 * (j != k) + x for k, (j, x) in enumerate(zip(back[-1], row, strict=True))]
        out = [max(range(len(langs)), key=best.__getitem__)]
        for step in reversed(back):
            out.append(step[out[-1]])
        return out[::-1]

    got = {r.doc_id: (r.held_out, r.lang_pred, round(r.score, 6)) for r in queries.QUERIES["op10_language_id"](spark, SF).collect()}
    assert len(got) == len(docs)
    for i, t, _ in docs:
        ws = (t or "").lower().split()
        if any(c.isalpha() for w in ws for c in w):
            votes = Counter(k for k, w in zip(path([scored(w) for w in ws]), ws, strict=True) if any(c.isalpha() for c in w))
            n, k = max((n, -k) for k, n in votes.items())
            want = (i in held, langs[-k], round(n / votes.total(), 6))
        else:
            want = (i in held, "und", 0.0)
        assert got[i] == want, i


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14)) and [n for n, _ in corpus_pipeline.STAGES] == [
        "language id", "line dedup", "minhash near-dedup", "benchmark decontamination", "mixing"]


def test_stages(spark):
    docs = read(spark, SF, "documents")
    columns = docs.columns
    steps = []
    for _, fn in corpus_pipeline.STAGES:
        given = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(fn(spark, docs, SF), "test")
        steps.append((given, docs.collect()))
        if fn is not corpus_pipeline.mix:
            assert docs.columns == columns

    given, kept = steps[0]
    assert {r.doc_id for r in kept} == {i for i, t in given.items() if any(c.isalpha() for c in t or "")}
    given, kept = steps[1]
    first = {(r.doc_id, r.line_no): (r.first_doc, r.first_line) for r in
             lines.line_components(spark.createDataFrame(sorted(given.items()), "doc_id long, text string")).collect()}
    check_lines(first, given.items(), 0.99)
    want = {}
    for i, t in given.items():
        rows = t.split("\n")
        left = [x for n, x in enumerate(rows) if first.get((i, n), (i, n)) == (i, n)]
        if left == rows or any(x.strip(" \t\n\r\x0b\x0c") for x in left):
            want[i] = "\n".join(left)
    assert {r.doc_id: r.text for r in kept} == want and all(r.n_chars == len(r.text) for r in kept)
    given, kept = steps[2]
    assert {r.doc_id for r in kept} == {i for i, c in brute(list(given.items())).items() if i == c}
    given, kept = steps[3]
    bench = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
    found = hits(given.items(), bench)
    assert {r.doc_id for r in kept} == {i for i, (n, hit, _) in found.items() if not (hit > 0 and 20 * hit >= n)}
    given, kept = steps[4]
    check_mix(given, kept, only_taken=True)
